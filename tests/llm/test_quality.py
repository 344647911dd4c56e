import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import quality, queries
from tidemark.llm.common import Words

BLANK = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in BLANK:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def plain(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            copies += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), copies, len(hit), failed


def numbers(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é", "#", "\n", " ", "\x1c", "\x85", "c&", "\t", "\x0b"]), max_size=40).map("".join), max_size=6))
def test_counts(texts):
    out = quality.judged(texts, Words(), np.zeros(quality.BUCKETS), -1.0)
    got = list(zip(*(out[c].tolist() for c in (*quality.COUNTS, "base_failed"))))
    assert got == [plain(t) for t in texts]


def test_triples_with_a_large_vocabulary():
    codes = np.array([5, 1 << 40, 7, 5, 1 << 40, 7, 9])
    assert quality.repeated_words(codes % ((1 << 21) + 3), np.array([7])).tolist() == [6]


def grams(text):
    """Bucket numbers one by one, with Python's integers."""
    mask = (1 << 64) - 1
    h = [zlib.crc32(w.encode()) * 0x9E3779B97F4A7C15 & mask for w in words_of(text)]
    out = [((x ^ (x << 17)) & mask) >> 48 for x in h]
    for a, b in zip(h, h[1:]):
        p = (a * 0xC2B2AE3D27D4EB4F + b) & mask
        out.append(((p ^ (p >> 29)) * 0x165667B19E3779F9 & mask) >> 48)
    return out


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    got = queries.op6_quality_rules(spark, small).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(numbers(r) == plain(texts[r.doc_id]) for r in got)
    ids = {r.known_id: r for r in quality.labelled(labels).collect()}
    raw, target = Counter(), Counter()
    for i, t in texts.items():
        raw.update(grams(t or ""))
        if i in ids and ids[i].fits:
            target.update(grams(t or ""))
    n, m, buckets = sum(raw.values()), sum(target.values()), quality.BUCKETS

    def score(text):
        total, own = 0.0, grams(text or "")
        for g in own:
            base = (raw[g] + 1) / (n + buckets)
            total += math.log((target[g] + buckets * base) / (m + buckets)) - math.log(base)
        return total / max(len(own), 1)

    cut = quality.fit(docs, labels)[1]
    for r in got:
        assert r.score == pytest.approx(score(texts[r.doc_id]), abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= cut)


def test_cut():
    assert quality._cut(np.array([3.0, 1, 2, 5]), np.array([True, False, False, True])) == 2.5
    assert quality._cut(np.array([1.0]), np.array([True])) == quality.THRESHOLD
    # One good document low down weighs more than the bad ones above it.
    assert quality._cut(np.array([1.0, 2, 3, 4]), np.array([True, False, False, True])) == 0.0


def test_held_out_accuracy(spark):
    """Labelled documents that fitted nothing: the verdict agrees with their labels."""
    where = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    ratios, cut = quality.fit(docs, labels, sample=400)
    used = {r.known_id for r in quality.labelled(labels, 400).collect()}
    rows = quality.score(docs, ratios, cut).join(labels, "doc_id").where("not base_failed").collect()
    rest = [r for r in rows if r.doc_id not in used]
    good = [r.kept for r in rest if r.quality == 1 and not r.toxic]
    bad = [not r.kept for r in rest if r.quality == 0]
    assert len(good) > 1000 and np.mean(good) > 0.99
    assert not bad or np.mean(bad) > 0.9


def test_odd_rows(odd, odd_rows, odd_labels, none):
    got = quality.score(odd, *quality.fit(odd, odd_labels)).collect()
    assert sorted(map(repr, ((r.doc_id, *numbers(r)) for r in got))) == sorted(repr((r[0], *plain(r[1]))) for r in odd_rows)
    kept = quality.keep(odd, odd_labels)
    assert kept.schema == odd.schema and {r.doc_id for r in kept.collect()} <= {4, 7, 8, 9}
    assert quality.score(none, *quality.fit(none, odd_labels)).count() == 0
    ratios, cut = quality.fit(odd, odd_labels.limit(0))
    assert not ratios.any() and cut == quality.THRESHOLD

import hashlib
import itertools
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, secrets


def plain_base(text):
    """Straight from the contract: find all, then drop what is too short."""
    out = []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


PIECES = ["password", "PassWd", "ſecret", "toKen", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abcdef012345", "AKIA", "AB12CD34EF56GH78", "é", "\n", "secret", "0123456789abcdef"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_spans(text):
    assert [f"{k}:{a}:{b}" for a, b, k in secrets.base_spans(text)] == plain_base(text)
    import pyarrow as pa

    hit = pa.compute.match_substring_regex(pa.array([text]), secrets.LIKELY)[0].as_py()
    assert hit or not plain_base(text)  # the quick screen never hides one


def some_crf(seed=0, scale=2.0):
    rng = np.random.default_rng(seed)
    emit = rng.normal(0, scale, (secrets.FEATURES + 1, 3))
    emit[:, 0] += 1
    return secrets.Crf(emit, rng.normal(0, scale, (3, 3)))


def all_scores(crf, text):
    found, rows = secrets.tokens_of(text), []
    for i, m in enumerate(found):
        score = crf.own(m[0]) + crf.file(text)
        score = score + (crf.near(found[i - 1][0], "before") if i else 0) + (crf.near(found[i + 1][0], "after") if i + 1 < len(found) else 0)
        rows.append(score)
    return np.array(rows)


def test_viterbi_is_the_best_of_all_paths():
    text = 'the token = "aZ9" and\nmore x1y2 !!'
    for seed in range(30):
        crf = some_crf(seed)
        score = all_scores(crf, text)
        def value(p):
            return sum(score[i, t] for i, t in enumerate(p)) + sum(crf.move[a, b] for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=len(score)), key=value)
        runs, before = [], 0
        for i, t in enumerate(best):
            if t == 1 or t == 2 and before == 0:
                runs.append([i, i])
            elif t == 2:
                runs[-1][1] = i
            before = t
        got = secrets.Tagger(crf).tag(["other words", text, ""])[1]
        assert [list(r) for r in got] == runs


def test_cutting_to_live_stretches_loses_nothing():
    rng = np.random.default_rng(5)
    vocabulary = ["the", "of", "Key", "a1b2c3d4", "x", "=", "deadBEEF00", "été", "12345", "zz-top/9"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(200)]
    for seed in range(4):
        crf = some_crf(seed, 1.0)
        crf.emit[:, 0] += 0.6 * seed
        tagger = secrets.Tagger(crf)
        together = tagger.tag(texts)
        for text, got in zip(texts, together):
            score = all_scores(crf, text)
            whole = tagger._best(score[:, 1:] - score[:, :1], False, False) if len(score) else []
            assert got == whole


def test_training_learns_a_rule():
    texts = [f"words and more {'aB3' * 7}{i} then text goes on" for i in range(40)] + [f"only plain words here number {i}" for i in range(40)]
    examples = []
    for t in texts:
        for rows, tags in secrets.windows(t):
            gold = [1 if m[0].startswith("aB3aB3") else 0 for m in secrets.tokens_of(t)][: len(tags)]
            examples.append((rows, gold))
    crf = secrets.train(examples)
    tagger = secrets.Tagger(crf)
    assert tagger.tag(["some other xY7xY7xY7xY7xY7xY7xY71 value", "nothing at all here"]) == [[(2, 2)], []]


def test_gradient_is_that_of_the_likelihood(monkeypatch):
    """After enough steps a tiny problem is fitted: every tag is the gold one."""
    monkeypatch.setattr(secrets, "ROUNDS", 200)
    examples = [([[1], [2], [3]], [0, 1, 2]), ([[3], [1], [2]], [0, 0, 1]), ([[1], [1]], [0, 0])]
    crf = secrets.train(examples)
    for rows, tags in examples:
        score = np.array([crf.emit[r].sum(axis=0) for r in rows])
        best = max(itertools.product(range(3), repeat=len(tags)), key=lambda p: sum(score[i, t] for i, t in enumerate(p)) + sum(crf.move[a, b] for a, b in zip(p, p[1:])))
        assert list(best) == tags


HAND = [
    ("the password is aB3xK9pQ2mZ7rT5w so keep it", "aB3xK9pQ2mZ7rT5w"), ("key DEADBEEF0123456789ABCDEF01 end", "DEADBEEF0123456789ABCDEF01"),
    ("use ghp_16C7e42F292c6912E7710c838347Ae178B4a now", "ghp_16C7e42F292c6912E7710c838347Ae178B4a"), ("password: abc,def1234567890XYZ done", "def1234567890XYZ"),
    ("aws key wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY here", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"),
]


def test_held_out_secrets(spark):
    """Secrets whose names, prefixes and places the training never showed, planted in plain documents; and how many clean documents get a span."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    crf = secrets.fit(docs)
    tagger = secrets.Tagger(crf)
    for (text, value), ((_, spans),) in zip(HAND, (secrets.spans_of([t], [True], tagger) for t, _ in HAND)):
        assert value in [text[a:b] for a, b, kind in spans if kind == "crf"], text
    plain = [r.text for r in docs.orderBy("doc_id").collect() if r.text and not secrets.base_spans(r.text)]
    marked = sum(bool(r) for r in tagger.tag(plain))
    assert marked <= 0.002 * len(plain)
    rnd = random.Random(4)
    kinds = {
        "mixed": lambda: "".join(rnd.choice(secrets.ALPHABETS[0]) for _ in range(24)), "upper hex": lambda: "".join(rnd.choice("0123456789ABCDEF") for _ in range(32)),
        "prefixed": lambda: "glpat-" + "".join(rnd.choice(secrets.ALPHABETS[2]) for _ in range(22)), "slashes": lambda: "".join(rnd.choice(secrets.ALPHABETS[5]) for _ in range(40)),
    }
    names = ["wifi code ", "vault entry: ", "session cookie=", "it was ", "recovery phrase is ", "("]
    assert not {n.strip(" :=(") for n in names} & set(secrets.NAMES[:-1])
    for kind, make in kinds.items():
        texts, where = [], []
        for words in (t.split() for t in rnd.sample(plain, 150)):
            at, name, value = rnd.randint(0, len(words)), rnd.choice(names), make()
            head = " ".join(words[:at]) + " " + name
            texts.append(head + value + " " + " ".join(words[at:]))
            # Signs at a value's ends may stay.
            signs = len(value) - len(value.lstrip("+/"))
            where.append((len(head) + signs, len(head) + len(value.rstrip("+/"))))
        found = [spans for _, spans in secrets.spans_of(texts, [True] * len(texts), tagger)]
        hits = sum(any(a <= start and end <= b for a, b, _ in spans) for spans, (start, end) in zip(found, where))
        assert hits >= 0.9 * len(texts), (kind, hits)


def test_what_a_pattern_cuts_short(spark):
    """Base spans stay; the rest of a run beside them is a span of its own, and is redacted too."""
    text = "token = abcdef012345,GHIJ-67890xyz! and more"
    base = secrets.base_spans(text)
    run = (text.index("token"), text.index("!") + 1, "crf")
    (part,) = secrets.outside(text, run, base)
    assert text[part[0] : part[1]] == "GHIJ-67890xyz" and base == secrets.base_spans(text)
    assert secrets.outside(text, (base[0][0], base[0][1], "crf"), base) == []
    assert secrets.outside("a (b) c", (2, 5, "crf"), []) == [(3, 4, "crf")] and secrets.outside("a () c", (2, 4, "crf"), []) == []


def test_withheld_kinds_are_not_shown():
    text = "password: abcDEF123456ghi and 0123456789abcdef01 here"
    assert {text[a:b] for a, b in secrets.values(text, ("hex",))} == {"0123456789abcdef01"}
    assert all(copy.startswith("password: abcDEF123456ghi") and copy[a:b] for copy, (a, b) in secrets.altered(text, ("hex",)))
    assert list(secrets.altered(text)) == list(secrets.altered(text)) and len(list(secrets.altered(text))) == 2 * secrets.COPIES


def test_query_on_whole_table(spark, small):
    texts = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op1_secret_scan(spark, small).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        base = plain_base(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base) for k in secrets.KINDS]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("crf")] == base


def test_odd_rows(spark, odd, odd_rows, none):
    crf = secrets.fit(odd)
    got = secrets.find(odd, crf).collect()
    assert len(got) == len(odd_rows)
    texts = {r[0]: r[1] or "" for r in odd_rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            assert [f"{s.kind}:{s.start}:{s.end}" for s in r.base] == plain_base(texts[r.doc_id])
    out = secrets.redacted(odd, crf)
    assert out.schema == odd.schema and out.count() == len(odd_rows)
    kept = {r.doc_id: r.text for r in out.select("doc_id", "text").collect()}
    assert kept[1] is None and kept[5] == "one two" and "hunter2hunter2" not in kept[10] and "[SECRET]" in kept[10]
    assert secrets.find(none, secrets.fit(none)).count() == 0


def test_the_sample_is_of_all_documents(spark):
    """Three documents with secrets among 40 000 are found, whatever the hash of their ids, and all are ranked by it."""
    from pyspark.sql import functions as F

    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain words only, number "), "id").alias("text"))
    hashed = [r.doc_id for r in rows.orderBy(F.xxhash64("doc_id")).select("doc_id").collect()]
    last = hashed[-3:]
    secret = F.when(F.col("doc_id").isin(last), F.concat(F.lit("password: aB3dE6gH9jK2mN5 "), "text")).otherwise(F.col("text"))
    docs = rows.withColumn("text", secret).repartition(7)
    got = secrets.sampled(docs, 20).collect()
    assert sorted(r.doc_id for r in got if r.secret) == sorted(last)
    assert sorted(r.doc_id for r in got if not r.secret) == sorted(hashed[:20])
    assert secrets.fit(docs, 20).emit.any()

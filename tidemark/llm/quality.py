"""Quality rules and a hashed n-gram log-likelihood ratio.

Every document gets plain counts (words, symbols, repeated lines and word triples) and a
score: the mean over its words and word pairs of log p(target) - log p(raw), where both
are multinomials over hashed n-grams. Raw is every document of the corpus; target is the
documents labelled good and not toxic. A document is kept if the plain rules pass and the
score reaches a threshold.

The target and the threshold are fitted on at most ``sample`` trusted and ``sample`` bad
documents, those with the smallest hash of their id, so that their ids can be broadcast.
One half of the trusted ones makes the target; the other half and the bad ones, scored
like any other document, give the cut. The raw counts, the scores and the decisions cover
every document whatever the size of the corpus, by the same rule for all. Counts are
summed in each task before the shuffle, at most 2 x ``BUCKETS`` rows a task, and the model
is a table of ``BUCKETS`` numbers.

Null, empty and blank texts have no words: all counts are zero and the base rule fails.
A null ``doc_id`` is carried along and is never a trusted one. Without any trusted
document all scores are zero and only the base rules decide. Repeated labels of a document
count once; one that is labelled both ways is bad. Other columns pass through
``keep`` untouched; the counts are internal there and can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, in_arrow, runs
from tidemark.session import written

BUCKETS = 1 << 16
#: Bound of the labelled sample: so many trusted and so many bad documents.
SAMPLE = 20_000
#: The score to reach where the labels can't tell, and how much a good document that is
#: lost counts against a bad one that is kept.
THRESHOLD, KEEP_WEIGHT = -0.5, 10
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\r\x0b\x0c"


def grams(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each word and each pair of neighbouring words."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pair = hashes[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[1:]
    pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    near = doc[:-1] == doc[1:]
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    mixed = np.concatenate([hashes ^ (hashes << np.uint64(17)), pair[near]])
    return (mixed >> shift).astype(np.int64), np.concatenate([doc, doc[:-1][near]])


def repeated_words(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text, its words that lie in a three-word window found twice or more in it."""
    if len(codes) < 3:
        return np.zeros(len(sizes), np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    most = int(codes.max()) + 1
    windows = codes[:-2] * most + codes[1:-1]
    if most >= 1 << 20:  # three codes don't fit into 63 bits: number the pairs first
        windows = np.unique(windows, return_inverse=True)[1]
    windows = windows * most + codes[2:]
    at = np.flatnonzero(doc[:-2] == doc[2:])
    at = at[np.argsort(windows[at], kind="stable")]
    same = (windows[at[:-1]] == windows[at[1:]]) & (doc[at[:-1]] == doc[at[1:]])
    twice = np.zeros(len(at), bool)
    twice[:-1] |= same
    twice[1:] |= same
    marked = np.zeros(len(codes), bool)
    for step in range(3):
        marked[at[twice] + step] = True
    return np.bincount(doc[marked], minlength=len(sizes))


def counts(texts: list[str], codes: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    def repeated_lines(text: str) -> int:
        lines = [x for x in text.split("\n") if x.strip(BLANKS)]
        return len(lines) - len(set(lines))

    return {
        "n_words": sizes,
        "word_chars": np.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeated_words(codes, sizes),
    }


def labelled(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(known_id, good, fits): at most ``sample`` trusted and ``sample`` bad documents.

    Those with the smallest hash of their id; every other one, by hash, fits the target.
    """
    votes = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("known_id")).agg(
        F.min(F.expr("coalesce(quality = 1 and toxic = 0, false)")).alias("good"),
        F.max(F.expr("coalesce(quality = 0, false)")).alias("bad"),
    )
    hashed = votes.withColumn("h", F.xxhash64("known_id"))
    first = [hashed.where(kind).orderBy("h", "known_id").limit(sample) for kind in ("good", "bad")]
    return first[0].unionByName(first[1]).selectExpr("known_id", "good", "good and h % 2 = 0 as fits")


def _known(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """At most two ids for each row of the bounded sample are broadcast."""
    return docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids), F.col("doc_id") == F.col("known_id"), how)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """The log ratio of each bucket, and the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, raw, target = Words(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                _, hashes, sizes = words.read(texts)
                bucket, doc = grams(hashes, sizes)
                raw += np.bincount(bucket, minlength=BUCKETS)
                trusted = piece.column("fits").to_numpy(zero_copy_only=False).astype(bool)
                target += np.bincount(bucket[trusted[doc]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, raw[at], target[at])], ["bucket", "raw", "target"])

    ids = written(labelled(labels, sample), "quality-labelled")
    marked = _known(docs, ids, "left").select("text", F.expr("coalesce(fits, false)").alias("fits"))
    sums = in_arrow(marked, run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, r, t in sums.collect():  # BUCKETS rows at most
        raw[bucket], target[bucket] = r, t
    if not target.any():
        return np.zeros(BUCKETS), THRESHOLD
    # The target is smoothed towards raw, so that a gram it never shows counts against a
    # document by a bounded amount and a rare one by little.
    base = (raw + 1) / (raw + 1).sum()
    ratios = np.log((target + BUCKETS * base) / (target.sum() + BUCKETS)) - np.log(base)
    held_out = _known(docs, ids.where("not fits"), "left_semi")
    judged_ones = score(held_out, ratios).where("not base_failed").join(F.broadcast(ids), F.col("doc_id") == F.col("known_id"))
    scores = judged_ones.select("score", "good").collect()  # 2 x sample rows at most
    return ratios, _cut(np.array([s for s, _ in scores]), np.array([g for _, g in scores], dtype=bool))


def _cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The cut with the best sum of shares, good ones kept counting ``KEEP_WEIGHT`` times."""
    if good.all() or not good.any():
        return THRESHOLD
    order = np.lexsort((good, scores))
    scores, good = scores[order], good[order]
    # A cut before position i keeps i and all above it.
    kept = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    dropped = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    i = int(np.argmax(np.round(KEEP_WEIGHT * kept + dropped, 12)))
    return float(scores[0] - 1 if i == 0 else scores[-1] + 1 if i == len(scores) else (scores[i - 1] + scores[i]) / 2)


def score(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, the counts, score, base_failed, kept) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                out = judged(texts, words, ratios, threshold)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, out.values())], ["doc_id", *out])

    schema = f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, score double, base_failed boolean, kept boolean"
    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def judged(texts: list[str], words: Words, ratios: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    codes, hashes, sizes = words.read(texts)
    out = counts(texts, codes, sizes)
    bucket, doc = grams(hashes, sizes)
    total = np.bincount(doc, weights=ratios[bucket], minlength=len(texts))
    out["score"] = total / np.maximum(np.bincount(doc, minlength=len(texts)), 1)
    out["base_failed"] = (sizes < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * sizes)
    out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
    return out


def keep(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that pass, with all their columns."""
    ratios, threshold = fit(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                yield piece.filter(pa.array(judged(texts, words, ratios, threshold)["kept"]))

    return in_arrow(docs, run, docs.schema)

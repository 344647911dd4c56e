"""Mixing by soft membership: rates at which documents meet domain targets.

A softmax classifier over the presence of hashed words, fitted on the labelled table, gives
every document posteriors p over the domains (good, bad and toxic, or others that ``domains``
names). A document of n words that is taken at rate r adds r n p expected words to the
domains. The targets are given: ``total`` times the words there are, shared out by
``shares``. The rates are the nonnegative ones that bring the domains' expected totals
closest to the targets, by projected-gradient least squares from rate 1.

With residual d = sum(r n p) - target and G = sum(n p p'), what is minimised is the sum of
d_k^2 / G_kk: a domain's miss counts by how hard it is to move. A step is
r <- max(0, r - p' w), w_k = d_k / (L G_kk), with momentum: gradient descent with documents
weighted by 1/n, for which this is safe if L is the largest eigenvalue of G scaled to a
diagonal of ones. A step needs one sum over the documents; only the residual, a number for
each domain, comes to the driver, and only the weights w go back. Every ``KEPT`` steps the rates are written, so that a round
folds a few steps at most. Steps go on until the totals are within ``CLOSE`` of the targets,
or make no progress: targets that no rates reach are approached as long as that helps.

Sums are of whole numbers (2^-16 words), so that they do not depend on the order of tasks.
A document is taken floor(r) times, and once more if a hash of its id falls below the
rest; expected totals are those of the rates. The classifier is fitted on at most
``sample`` labelled documents of each domain, those with the smallest hash of their id;
everything else covers all documents.

Null, empty and blank texts have no words and no say in the totals; their posteriors are
the classifier's prior, and so is their rate. A null ``doc_id`` hashes like a value.
Conflicting labels count as the worst of them, the domain named last. If no document is
labelled, posteriors are even. Repeated rows are documents of their own with equal rates.
``mixed`` passes other columns through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Words, in_arrow, runs
from tidemark.session import written

#: Domains in rising order of harm, and how a label's columns tell them.
DOMAINS = {"good": "quality = 1", "bad": "quality = 0", "toxic": "toxic = 1"}
#: Target shares of the domains, and all target words as a multiple of the words there are.
SHARES, TOTAL = (0.94, 0.03, 0.03), 1.1
#: Labelled documents of each domain for the classifier, its features, steps, rate and decay.
SAMPLE, FEATURES, STEPS, RATE, DECAY = 4_000, 1 << 18, 100, 0.3, 1e-4
#: A word tells if so many sampled documents have it, so many standard deviations from chance.
LEAST_DOCS, SIGMAS = 5, 4
#: Most steps; the share of the target words that may be missed; the progress below which ``PATIENCE`` steps in a row are the last.
ROUNDS, CLOSE, PROGRESS, PATIENCE = 200, 1e-6, 0.001, 10
#: After so many steps the rates are written; sums are of words times ``GRAIN``, as whole numbers.
KEPT, GRAIN = 8, 1 << 16


def features(words: Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document) of each different hashed word of a document, and the documents' words."""
    _, hashes, sizes = words.read(texts)
    bucket = (hashes >> np.uint64(64 - (FEATURES - 1).bit_length())).astype(np.int64)
    both = np.unique(np.repeat(np.arange(len(texts)), sizes) * FEATURES + bucket)
    return both % FEATURES, both // FEATURES, sizes


def logits(bucket: np.ndarray, doc: np.ndarray, n: int, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(doc, weights=weights[bucket, k], minlength=n) for k in range(len(bias))], axis=1) + bias


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


@dataclass
class Classifier:
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, words: Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        bucket, doc, sizes = features(words, texts)
        return softmax(logits(bucket, doc, len(texts), self.weights, self.bias)), sizes


def telling(flat: np.ndarray, of: np.ndarray, domains: np.ndarray, k: int) -> np.ndarray:
    """Buckets of words that some domain has far more or less often than chance would."""
    share = np.bincount(domains, minlength=k) / len(domains)
    seen = np.stack([np.bincount(flat[of == i], minlength=FEATURES) for i in range(k)], axis=1)
    docs = seen.sum(axis=1)
    chance = docs[:, None] * share
    far = np.abs(seen - chance) >= SIGMAS * np.sqrt(chance * (1 - share))
    return (docs >= LEAST_DOCS) & (far & (share > 0) & (share < 1)).any(axis=1)


def train(buckets: list[np.ndarray], domains: np.ndarray, k: int) -> Classifier:
    """Softmax regression over the telling words, with AdaGrad steps over the whole sample."""
    n, weights, bias = len(domains), np.zeros((FEATURES, k)), np.zeros(k)
    if not n:
        return Classifier(weights.astype(np.float32), bias)
    flat, doc = np.concatenate(buckets), np.repeat(np.arange(n), list(map(len, buckets)))
    kept = telling(flat, domains[doc], domains, k)[flat]
    used, flat = np.unique(flat[kept], return_inverse=True)
    doc, want = doc[kept], np.eye(k)[domains]
    own, seen, seen_bias = np.zeros((len(used), k)), np.full((len(used), k), 1e-8), np.full_like(bias, 1e-8)
    for _ in range(STEPS):
        off = (softmax(logits(flat, doc, n, own, bias)) - want) / n
        slope = np.stack([np.bincount(flat, weights=off[doc, i], minlength=len(used)) for i in range(k)], axis=1) + DECAY * own
        seen += slope**2
        seen_bias += off.sum(axis=0) ** 2
        own -= RATE * slope / np.sqrt(seen)
        bias -= RATE * off.sum(axis=0) / np.sqrt(seen_bias)
    weights[used] = own
    return Classifier(weights.astype(np.float32), bias)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, domains: dict[str, str] = DOMAINS) -> Classifier:
    """Fits the classifier on the driver, on at most ``sample`` documents of each domain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                bucket, doc, _ = features(words, texts)
                cuts = np.searchsorted(doc, np.arange(1, len(texts)))
                lists = [x.astype("<i4").tobytes() for x in np.split(bucket, cuts)]
                yield pa.RecordBatch.from_arrays([piece.column("domain"), pa.array(lists, pa.binary())], ["domain", "buckets"])

    votes = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("known_id"))
    worst = " ".join(f"when {rule} then {k}" for k, rule in reversed(list(enumerate(domains.values()))))
    domain = votes.agg(F.max(F.expr(f"case {worst} end")).alias("domain"))
    hashed = domain.where("domain is not null").withColumn("h", F.xxhash64("known_id"))
    first = [hashed.where(F.col("domain") == k).orderBy("h", "known_id").limit(sample) for k in range(len(domains))]
    chosen = written(reduce(DataFrame.unionByName, first).select("known_id", "domain"), "mixing-labelled")
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("known_id"))
    made = in_arrow(rows.select("domain", "text"), run, "domain int, buckets binary").collect()  # bounded by sample
    made = sorted((r.domain, bytes(r.buckets)) for r in made)
    return train([np.frombuffer(b, "<i4").astype(np.int64) for _, b in made], np.array([d for d, _ in made], dtype=int), len(domains))


def posteriors(docs: DataFrame, model: Classifier, n_words: str = "n_words", p: str = "p") -> DataFrame:
    """``docs`` with their words' number and the posteriors of every document, in the order of the domains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                found, sizes = model.posteriors(words, texts)
                yield piece.append_column(n_words, pa.array(sizes)).append_column(p, pa.array(list(found), pa.list_(pa.float64())))

    schema = T.StructType([*docs.schema, T.StructField(n_words, T.LongType()), T.StructField(p, T.ArrayType(T.DoubleType()))])
    return in_arrow(docs, run, schema)


def rate_of(steps: list[list[float]], p: str = "p", start: str | None = None) -> Column:
    """The state after the steps as a column: weights, then the share of the last move added.

    ``start`` names a column with the state before them; without it all rates are 1.
    """
    if start is None:
        begin = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    else:
        begin = F.struct(F.col(start)["rate"].alias("rate"), F.col(start)["ahead"].alias("ahead"))
    if not steps:
        return begin

    def move(state: Column, step: Column) -> Column:
        dot = sum((F.col(p)[i] * step[i] for i in range(1, len(steps[0]) - 1)), F.col(p)[0] * step[0])
        new = F.greatest(F.lit(0.0), state["ahead"] - dot)
        return F.struct(new.alias("rate"), (new + step[len(steps[0]) - 1] * (new - state["rate"])).alias("ahead"))

    return F.aggregate(F.array(*[F.array(*map(F.lit, s)) for s in steps]), begin, move, lambda s: s)


def folded(p: np.ndarray, steps: list[list[float]]) -> np.ndarray:
    """The same for rows of posteriors in memory."""
    rate = ahead = np.ones(len(p))
    for *weights, share in steps:
        new = np.maximum(0, ahead - p @ np.array(weights))
        rate, ahead = new, new + share * (new - rate)
    return rate


def scaled(gram: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights 1 / G_kk of the domains' misses, and the step length that is safe for them."""
    diagonal = np.diag(gram)
    weight = np.where(diagonal > 1e-9 * diagonal.max(initial=0.0), 1 / np.maximum(diagonal, 1e-300), 0.0)
    root = np.sqrt(weight)
    most = float(np.linalg.eigvalsh(root[:, None] * ((gram + gram.T) / 2) * root).max(initial=0.0))
    return weight, 1 / most if most else 0.0


@dataclass
class Solution:
    """All steps, the targets, what the rates reach, and the members with the rates."""

    steps: list[list[float]]
    target: np.ndarray
    reached: np.ndarray
    rated: DataFrame

    @property
    def missed(self) -> float:
        """Words that are off target, as a share of the target words."""
        return float(np.abs(self.reached - self.target).sum() / max(self.target.sum(), 1))


def solve(members: DataFrame, shares=SHARES, total: float = TOTAL, rounds: int = ROUNDS, n_words: str = "n_words", p: str = "p", rate: str = "rate") -> Solution:
    """Projected-gradient steps for ``members(n_words, p)`` until the shares are met."""
    k, state = len(shares), _fresh("__state", members.columns)
    item = lambda i, of=F.lit(1.0): F.col(p)[i] * F.col(n_words) * of
    words = lambda c: F.coalesce(F.sum(F.round(c * GRAIN).cast("long")), F.lit(0))
    first = members.agg(*[words(item(i)) for i in range(k)], *[words(item(i, F.col(p)[j])) for i in range(k) for j in range(k)], F.coalesce(F.sum(n_words), F.lit(0))).first()
    now, gram = np.array(first[:k]) / GRAIN, np.array(first[k:-1]).reshape(k, k) / GRAIN
    target = total * first[-1] * np.array(shares)
    weight, safe = scaled(gram)
    ahead, pace, far, idle = now, 1.0, np.inf, 0
    steps: list[list[float]] = []
    held, kept = members, 0
    for _ in range(rounds):
        off, last = now - target, far
        far = off @ (weight * off)
        idle = idle + 1 if far > last * (1 - PROGRESS) else 0
        if np.abs(off).sum() <= CLOSE * max(target.sum(), 1) or idle == PATIENCE:
            break
        # Momentum as in Nesterov's method, dropped whenever the distance grows.
        slower = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        share, pace = ((pace - 1) / slower, slower) if far <= last else (0.0, 1.0)
        step = safe * weight * (ahead - target)
        steps.append([*map(float, step), float(share)])
        moved = held.withColumn(state, rate_of(steps[kept:], p, state if kept else None))
        if len(steps) - kept == KEPT:
            held, kept = written(moved.select(n_words, p, state), "mixing-rates"), len(steps)
            moved = held
        both = moved.agg(*[words(item(i, F.col(state)[part])) for part in ("rate", "ahead") for i in range(k)]).first()
        now, ahead = np.array(both[:k]) / GRAIN, np.array(both[k:]) / GRAIN
    return Solution(steps, target, now, members.withColumn(rate, rate_of(steps, p)["rate"]))


def _fresh(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _copies(rate: str, doc_id: str = "doc_id") -> Column:
    chance = F.pmod(F.xxhash64(F.col(doc_id), F.lit("mix")), F.lit(1 << 30)) / F.lit(1 << 30)
    return (F.floor(rate) + (chance < F.col(rate) - F.floor(rate)).cast("long")).cast("long")


def rates(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, domains: dict[str, str] = DOMAINS, **targets) -> DataFrame:
    """(doc_id, n_words, p, rate, copies) of every document."""
    found = posteriors(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs, labels, sample, domains))
    members = written(found.drop("text"), "mixing-members")
    return solve(members, **targets).rated.withColumn("copies", _copies("rate"))


def mixed(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, domains: dict[str, str] = DOMAINS, **targets) -> DataFrame:
    """All columns of the documents, each row as often as its rate says."""
    n_words, p, rate, copies = (_fresh(f"__{name}", docs.columns) for name in ("n_words", "p", "rate", "copies"))
    # The texts are classified once: written with their posteriors, then only copied.
    members = written(posteriors(docs, fit(docs, labels, sample, domains), n_words, p), "mixing-members")
    rated = solve(members, n_words=n_words, p=p, rate=rate, **targets).rated
    taken = rated.withColumn(copies, _copies(rate)).where(F.col(copies) > 0)
    again = F.explode(F.array_repeat(F.lit(True), F.col(copies).cast("int")))
    return taken.withColumn(rate, again).select(*[F.col(f"`{c}`") for c in docs.columns])

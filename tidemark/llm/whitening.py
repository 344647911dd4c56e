"""Whitening of vectors by the leading components of their covariance.

An entry c becomes the integer x = floor(1024 c) + 100000. One pass over the table gives
the number of rows n and the sums S, a second one the covariance: each row is centred at
the whole numbers m nearest to S / n before anything is multiplied, what that rounding
leaves is taken off at the end, and every sum is a whole number kept exactly. The results
hence do not depend on how the rows are dealt to tasks. A task returns one row for each
line of the matrix; the lines are added up in two steps, so that no task reads more than
about the square root of all tasks' rows. The driver gets one matrix, whose size is that
of a vector squared, whatever the table's size; ``eigen.leading`` takes it apart. A third
pass measures the whitened columns' covariance, a fourth gives the rows.

Rows whose vector is null, empty or holds null or non-finite entries are dropped, and so
are those with an entry beyond ``LARGEST``, for which no long x exists. Vectors of
different lengths have no common covariance: each length is a table of its own, with its
own n and components. Components without variance beyond rounding (equal rows, dimensions
that follow from others) can't be scaled to one and are left out; a table of one row has
none. A row without ``vec_id`` counts and is returned with a null id, repeated rows are
rows of their own, other columns are ignored. ``deviation`` is null if no long holds it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import eigen
from tidemark.llm.common import FINITE, by_group, by_width, in_arrow, matrix

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Entries from here on have no long x.
LARGEST = float(1 << 51)
#: An eigenvalue below this share of the largest is rounding.
NOTHING = 1e-12
#: Whitened values are measured in these steps, so that their sums are exact too.
STEP = 2.0**-32
#: Bits of the words in which whole numbers are multiplied, rows multiplied at once.
BITS, ROWS = 18, 1 << 14


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * SCALE).astype(np.int64) + SHIFT


def exact_products(z: np.ndarray) -> np.ndarray:
    """z' z in Python's integers: words of 18 bits, whose products of 16 384 rows doubles hold exactly."""
    out = np.zeros((z.shape[1], z.shape[1]), object)
    for at in range(0, len(z), ROWS):
        part, words = z[at : at + ROWS], []
        while True:
            if np.abs(part).max(initial=0) < 1 << (BITS + 1):
                words.append(part.astype(np.float64))
                break
            low = part & ((1 << BITS) - 1)
            words.append(low.astype(np.float64))
            part = (part - low) >> BITS
        for i, a in enumerate(words):
            for j, b in enumerate(words):
                out += (a.T @ b).astype(np.int64).astype(object) << (BITS * (i + j))
    return out


def added(partials: DataFrame) -> DataFrame:
    """Sums of whole numbers as text, by (width, line): first in groups of tasks, then of those."""

    def run(group: pa.Table) -> pa.Table:
        total = None
        for text in group.column("sums"):
            part = np.array([int(x) for x in text.as_py().split()], object)
            total = part if total is None else total + part
        first = group.slice(0, 1).select(["width", "line"])
        rows = sum(group.column("rows").to_pylist())
        return first.append_column("rows", pa.array([rows], pa.int64())).append_column("sums", pa.array([" ".join(map(str, total))]))

    schema = "width int, line int, rows long, sums string"
    salts = max(1, math.isqrt(int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = partials.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    once = by_group(salted, ["width", "line", "salt"], lambda t: run(t), schema)
    return by_group(once, ["width", "line"], lambda t: run(t), schema)


def partial_sums(rows: DataFrame, start, step, lines) -> DataFrame:
    """One row a task, width and line: state from ``start(width)`` fed with each batch by ``step``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict = {}
        for batch in batches:
            for width, piece in by_width(batch, "embedding"):
                state, n = states.get(width) or (start(width), 0)
                states[width] = step(width, state, matrix(piece.column("embedding"))), n + piece.num_rows
        for width, (state, n) in states.items():
            sums = [" ".join(map(str, line)) for line in lines(state)]
            k = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([width] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array([n] * k, pa.int64()), pa.array(sums)], ["width", "line", "rows", "sums"]
            )

    return added(in_arrow(rows.select("embedding"), run, "width int, line int, rows long, sums string"))


def collected(sums: DataFrame) -> dict[int, tuple[int, list]]:
    """width: (rows, lines of whole numbers). One matrix for each length of vectors."""
    out: dict = {}
    for r in sorted(sums.collect(), key=lambda r: (r.width, r.line)):
        out.setdefault(r.width, (r.rows, []))[1].append([int(x) for x in r.sums.split()])
    return out


@dataclass
class Model:
    """Fit of one length of vectors: n, S, the centre m, eigenvalues, components as columns, trace."""

    n: int
    sums: np.ndarray
    centre: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on the components, over the roots of their eigenvalues."""
        offset = np.array([float(s) for s in self.sums - self.n * self.centre]) / self.n
        z = (x - self.centre.astype(np.int64)).astype(np.float64) - offset
        onto = np.ascontiguousarray((self.vectors / np.sqrt(self.values)).T)
        # Not a matrix product: its rounding would depend on the rows beside.
        return np.stack([(z * line).sum(axis=1) for line in onto], axis=1) if len(onto) else np.zeros((len(x), 0))

    def deviation(self, x: np.ndarray) -> list:
        """Sum over dimensions of (n x - S)^2, in Python's integers where longs might not do."""
        centre, rest = self.centre.astype(np.int64), self.n * self.centre - self.sums
        z = x - centre
        most = int(np.abs(z).max(initial=0)) * self.n + max(map(abs, rest))
        if most * most * x.shape[1] < 1 << 63:
            return ((z * self.n + rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((z.astype(object) * self.n + rest) ** 2).sum(axis=1)
        return [s if s < 1 << 63 else None for s in exact]


def usable(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(FINITE)
    return rows.where(f"forall(embedding, x -> abs(x) < {LARGEST:.1f}D)")


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for each length of vectors."""
    rows = usable(vectors)

    def plus(width, state, values):
        # Words of 31 bits, so that sums over any batch stay whole longs.
        x = whole(values)
        low = x & ((1 << 31) - 1)
        return state + low.sum(axis=0).astype(object) + (((x - low) >> 31).sum(axis=0).astype(object) << 31)

    first = collected(partial_sums(rows, lambda w: np.zeros(w, object), plus, lambda s: [s]))
    sums = {w: (n, np.array(lines[0], object)) for w, (n, lines) in first.items()}
    centres = {w: (2 * s + n) // (2 * n) for w, (n, s) in sums.items()}

    def squares(width, state, values):
        return state + exact_products(whole(values) - centres[width].astype(np.int64))

    models = {}
    for width, (n, lines) in collected(partial_sums(rows, lambda w: np.zeros((w, w), object), squares, list)).items():
        rest = sums[width][1] - n * centres[width]
        # n^2 V in whole numbers; only the quotients are rounded.
        exact = np.array(lines, object) * n - np.outer(rest, rest)
        cov = np.array([[float(_quotient(v, n * n)) for v in line] for line in exact])
        values, columns = eigen.leading(cov, components)
        some = values > NOTHING * max(values.max(initial=0.0), 0.0)
        models[width] = Model(n, sums[width][1], centres[width], values[some], columns[:, some], float(_quotient(sum(np.diag(exact)), n * n)))
    return models


def _quotient(a: int, b: int) -> float:
    return int(a) / int(b)


def identity_errors(vectors: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length: how far the whitened columns' covariance is from the identity, at most."""
    shared = vectors.sparkSession.sparkContext.broadcast(models)  # matrices of components, one for each length

    def fixed(width, state, values):
        w = np.rint(shared.value[width].whitened(whole(values)) / STEP).astype(np.int64)
        return state[0] + w.astype(object).sum(axis=0), state[1] + exact_products(w)

    def start(width):
        k = len(shared.value[width].values)
        return np.zeros(k, object), np.zeros((k, k), object)

    errors = {}
    for width, (n, lines) in collected(partial_sums(usable(vectors), start, fixed, lambda s: [s[0], *s[1]])).items():
        mean, products = lines[0], lines[1:]
        cov = [[_quotient(products[i][j] * n - mean[i] * mean[j], n * n) * STEP * STEP for j in range(len(mean))] for i in range(len(mean))]
        errors[width] = float(np.abs(np.array(cov) - np.eye(len(mean))).max(initial=0.0)) if len(mean) else 0.0
    return errors


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    models = fit(vectors, components)
    errors = identity_errors(vectors, models)
    shared = vectors.sparkSession.sparkContext.broadcast((models, errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, far = shared.value
        for batch in batches:
            for width, piece in by_width(batch, "embedding"):
                model, x = fits[width], whole(matrix(piece.column("embedding")))
                k, rows = len(model.values), piece.num_rows
                again = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays([
                    piece.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, model.n), pa.int64()),
                    pa.array(model.deviation(x), pa.int64()).take(again), pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.values / model.trace if k else model.values, rows)), pa.array(np.full(rows * k, far[width])),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return in_arrow(usable(vectors), run, schema)

"""Hard negatives by coordinate pruning over length buckets.

Components become integers floor(256 x); a score is an integer inner product. Rows are cut
by their length into buckets, buckets by hash into blocks of bounded size; a block is one
row of a table, with its vectors and, for each coordinate, the list of its rows sorted by
that coordinate of their directions. Anchors are packed into chunks of bounded size, and a
tile is a chunk with a block.

In a tile an anchor first scores a few rows of the block: the k-th best of these bounds
the score from below. With the block's shortest and longest vector, the wanted scores
limit the angle B between anchor and row; with the angle A between anchor and a coordinate
axis, the row's angle to that axis lies between |A - B| and A + B. For the ``FOCUS``
coordinates that weigh most in the anchor this is a range of the sorted list, found by
bisection. Only rows in all ranges are scored exactly; no row that could be in the answer
is left out, and whole blocks whose lengths can't reach the bound are passed over.

The first round of tiles finds each anchor's positives, the second the negatives for the
windows that these set. A tile returns k rows at most for an anchor and window, never
pairs; all rows of a label, of an equal vector or of one length may be a third of the
table without meeting in one task. What reaches the driver are the bucket borders and
counts, ``BUCKETS`` numbers for each length of vectors.

Rows without label, ``vec_id`` or vector, with an empty vector, with a null or non-finite
component, or whose squared length exceeds ``LONGEST`` (their scores need not fit a long)
take no part. Vectors of different lengths are never compared. Repeated rows of one id,
label and vector count once; rows of one id that differ are rows of their own, but never
each other's positives or negatives. Zero vectors score 0 with all others. Other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import FINITE, by_width, find_package, in_arrow, matrix
from tidemark.session import written

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: The squared length from which products of two vectors might not fit a long.
LONGEST = float(1 << 62)
#: Most rows of a block (by hash, a little more), blocks that a large table has at least, buckets, anchors of a chunk.
BLOCK, BLOCKS, BUCKETS, ANCHORS = 8192, 24, 64, 8192
#: Coordinates whose ranges are intersected, rows that are scored for a first bound, anchors that are scored at once.
FOCUS, SEEDS, TOGETHER = 4, 256, 128
#: Bounds are widened by so much for their rounding.
SLACK = 1e-9


def smallest(values: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as hold them."""
    most = max(int(values.max(initial=0)), -int(values.min(initial=0)) - 1)
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products, rows by anchors: in doubles while these hold them, else in longs."""
    most = float(np.abs(rows.astype(np.float64)).max(initial=0)) * float(np.abs(anchors.astype(np.float64)).max(initial=0)) * rows.shape[1]
    if most < 1 << 53:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return rows.astype(np.int64) @ anchors.astype(np.int64).T  # sums may wrap around and come back


def directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = rows.astype(np.float64)
    length = np.sqrt((wide * wide).sum(axis=1))
    return wide / np.where(length, length, 1)[:, None], length


def sorted_lists(rows: np.ndarray) -> np.ndarray:
    """For each coordinate the rows of a block, by that coordinate of their directions."""
    return np.argsort(directions(rows)[0], axis=0, kind="stable").T.astype(np.uint16 if len(rows) <= 1 << 16 else np.uint32)


class Block:
    """Vectors of about one length, with their sorted coordinate lists."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, lists: np.ndarray):
        self.rows, self.ids, self.labels, self.lists = rows, ids, labels, lists
        #: For products in doubles, while these hold them.
        self.wide = rows.astype(np.float64)
        self.most = float(np.abs(self.wide).max(initial=0)) * rows.shape[1]
        unit, self.length = directions(rows)
        self.unit = np.ascontiguousarray(unit.T)
        self.sorted = np.take_along_axis(self.unit, lists.astype(np.int64), axis=1)
        there = self.length[self.length > 0]
        self.shortest, self.longest = (float(there.min()), float(there.max())) if len(there) else (0.0, 0.0)
        self.zero = np.flatnonzero(self.length == 0)

    def candidates(self, anchor: np.ndarray, low: float, high: float) -> np.ndarray:
        """Rows that may score between ``low`` and ``high``: never too few, seldom all."""
        reach = math.sqrt(float((anchor.astype(np.float64) ** 2).sum()))
        zero = self.zero if low <= 0 <= high else self.zero[:0]
        if not reach:
            return np.arange(len(self.rows)) if low <= 0 <= high else zero
        if not self.longest:
            return zero
        # The cosines that a row of any length in the block can have.
        least = low / (reach * (self.longest if low >= 0 else self.shortest)) - SLACK
        most = high / (reach * (self.shortest if high >= 0 else self.longest)) + SLACK
        if least > 1 or most < -1 or least > most:
            return zero
        near, far = math.acos(min(1.0, max(-1.0, most))), math.acos(min(1.0, max(-1.0, least)))
        ranges = []
        for f in np.argsort(-np.abs(anchor), kind="stable")[:FOCUS]:
            axis = math.acos(min(1.0, max(-1.0, float(anchor[f]) / reach)))
            # A row's angle to the axis, as the angle to the anchor goes from near to far.
            closest = max(0.0, axis - far, near - axis)
            widest = math.pi if axis + near <= math.pi <= axis + far else axis + far if axis + far < math.pi else 2 * math.pi - axis - near
            bottom, top = math.cos(widest) - SLACK, math.cos(closest) + SLACK
            a, b = np.searchsorted(self.sorted[f], bottom), np.searchsorted(self.sorted[f], top, side="right")
            if b - a < len(self.rows):
                ranges.append((b - a, f, a, b, bottom, top))
        if not ranges:
            return np.arange(len(self.rows))
        _, f, a, b, _, _ = min(ranges)
        found = self.lists[f, a:b].astype(np.int64)
        for _, g, _, _, bottom, top in ranges:
            if g != f:
                found = found[(self.unit[g, found] >= bottom) & (self.unit[g, found] <= top)]
        return np.union1d(found, zero) if len(zero) else found

    def scores(self, anchors: np.ndarray, found: np.ndarray | None = None) -> np.ndarray:
        """Exact scores, rows by anchors, of all rows or some."""
        if self.most * float(np.abs(anchors.astype(np.float64)).max(initial=0)) < 1 << 53:
            return (self.wide if found is None else self.wide[found]) @ anchors.astype(np.float64).T
        return scores(self.rows if found is None else self.rows[found], anchors)


def first(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by id."""
    if len(score) > 4 * k:
        bound = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= bound)
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]


def best(block: Block, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, windows: list[list[tuple[int, int]]], same: bool, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, window, rows, scores): the k best rows of each window, of the anchor's label or of others."""
    seeds = np.unique(np.linspace(0, len(block.rows) - 1, min(SEEDS, len(block.rows))).astype(int))
    for at in range(0, len(anchors), TOGETHER):
        some = range(at, min(at + TOGETHER, len(anchors)))
        tried, whole = block.scores(anchors[at : at + TOGETHER], seeds), None
        for i in some:
            wanted = (block.labels == labels[i]) == same
            wanted &= block.ids != ids[i]
            seeded, bounds = tried[wanted[seeds], i - at], []
            for low, high in windows[i]:
                inside = seeded[(seeded >= low) & (seeded <= high)]
                bounds.append((int(np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else low, high))
            if not bounds:
                continue
            found = block.candidates(anchors[i], min(b for b, _ in bounds), max(b for _, b in bounds))
            found = found[wanted[found]]
            # Where most of a block is left, all rows are scored for these anchors at once.
            if 4 * len(found) > len(block.rows):
                whole = np.ascontiguousarray(block.scores(anchors[at : at + TOGETHER]).T) if whole is None else whole
                score = whole[i - at, found].astype(np.int64)
            else:
                score = block.scores(anchors[i : i + 1], found)[:, 0].astype(np.int64)
            for w, (low, high) in enumerate(bounds):
                here = np.flatnonzero((score >= low) & (score <= high))
                here = here[first(block.ids[found[here]], score[here], k)]
                yield i, w, found[here], score[here]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector): each row that takes part, once."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.where("vec_id is not null and label is not null").where(FINITE)
    short = f"aggregate(embedding, 0D, (s, x) -> s + floor({SCALE}D * x) * 1D * floor({SCALE}D * x)) < {LONGEST:.1f}D and forall(embedding, x -> abs(x) < {2.0**31 / SCALE:.1f}D)"
    return rows.where(short).select("vec_id", "label", F.expr(f"transform(embedding, x -> floor({SCALE}D * x))").alias("vector")).distinct()


def blocks_of(rows: DataFrame) -> DataFrame:
    """(width, block, n, kind, data): the packed blocks, cut by length and then by hash."""
    spark = rows.sparkSession
    sized = rows.withColumn("width", F.size("vector")).withColumn("length", F.expr("sqrt(aggregate(vector, 0D, (s, x) -> s + x * 1D * x))"))
    steps = [i / BUCKETS for i in range(1, BUCKETS)]
    borders, layout = {}, {}
    for r in sized.groupBy("width").agg(F.count("*").alias("n"), F.percentile_approx("length", steps, 1000).alias("cuts")).collect():  # a row for each length of vectors
        blocks = max(math.ceil(r.n / BLOCK), min(BLOCKS, math.ceil(r.n / 64)))
        buckets = min(BUCKETS, blocks)
        borders[r.width] = np.unique([r.cuts[i * BUCKETS // buckets - 1] for i in range(1, buckets)])
        layout[r.width] = math.ceil(r.n / blocks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, piece in by_width(batch, "vector"):
                bucket = np.searchsorted(borders[width], piece.column("length").to_numpy(), side="left")
                yield piece.drop_columns(["length"]).append_column("bucket", pa.array(bucket, pa.int32()))

    kept = sized.withColumn("h", F.expr("xxhash64(vector, vec_id, label)"))
    bucketed = written(in_arrow(kept, cut, "vec_id long, label long, vector array<long>, width int, h long, bucket int"), "negatives-buckets")
    # A bucket of equal lengths may hold any share of the rows: as many blocks as that takes.
    pieces = {(r.width, r.bucket): max(1, math.ceil(r["count"] / layout[r.width])) for r in bucketed.groupBy("width", "bucket").count().collect()}  # at most BUCKETS a width
    start, at = {}, 0
    for key in sorted(pieces):
        start[key], at = at, at + pieces[key]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column("width").to_pylist(), batch.column("bucket").to_pylist()))
            turn = np.fromiter((pieces[k] for k in keys), np.int64, len(keys))
            block = np.fromiter((start[k] for k in keys), np.int64, len(keys)) + batch.column("h").to_numpy() % turn
            yield batch.drop_columns(["bucket", "h"]).append_column("block", pa.array(block, pa.int32()))

    def pack(group: pa.Table) -> pa.Table:
        vectors = smallest(matrix(group.column("vector"), np.int64))
        lists = sorted_lists(vectors)
        made = {
            "vectors": vectors.tobytes(), "ids": group.column("vec_id").to_numpy().tobytes(),
            "labels": group.column("label").to_numpy().tobytes(), "lists": np.ascontiguousarray(lists).tobytes(),
        }
        out = group.slice(0, 1).select(["width", "block"]).append_column("kind", pa.array([vectors.dtype.str])).append_column("list_kind", pa.array([lists.dtype.str]))
        for name, data in made.items():
            out = out.append_column(name, pa.array([data], pa.binary()))
        return out

    find_package(spark)
    dealt = in_arrow(bucketed, deal, "vec_id long, label long, vector array<long>, width int, block int")
    schema = "width int, block int, kind string, list_kind string, vectors binary, ids binary, labels binary, lists binary"
    return written(dealt.groupBy("width", "block").applyInArrow(lambda t: pack(t), schema), "negatives-blocks")


def opened(r: dict) -> Block:
    rows = np.frombuffer(r["vectors"], r["kind"]).reshape(-1, r["width"])
    lists = np.frombuffer(r["lists"], r["list_kind"]).reshape(r["width"], -1)
    return Block(rows, np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64), lists)


def tiles(anchors: DataFrame, blocks: DataFrame, run, schema: str) -> DataFrame:
    """``run(anchors, block)`` for each chunk of ``anchors(width, a, ...)`` with each block of its width."""
    chunks = max(1, math.ceil(anchors.count() * 1.2 / ANCHORS))
    chunked = anchors.withColumn("chunk", F.pmod("a", F.lit(chunks)).cast("int"))
    packed = chunked.groupBy("width", "chunk").agg(F.collect_list(F.struct(*[c for c in anchors.columns if c != "width"])).alias("anchors"))
    packed = written(packed, "negatives-anchors")
    # Both sides know the other's numbers: lists of integers, one for each width.
    numbers = F.broadcast(written(blocks.groupBy("width").agg(F.collect_list("block").alias("blocks")), "negatives-numbers"))
    asked = F.broadcast(written(packed.groupBy("width").agg(F.collect_list("chunk").alias("chunks")), "negatives-chunks"))
    left = packed.join(numbers, "width").select("*", F.explode("blocks").alias("block")).drop("blocks")
    right = blocks.join(asked, "width").select("*", F.explode("chunks").alias("chunk")).drop("chunks")

    def meet(some: pa.Table, block: pa.Table) -> pa.Table:
        out = [run(r["anchors"], opened(b)) for r in some.to_pylist() for b in block.to_pylist()]
        return pa.concat_tables(out) if out else run([], None)

    keys = ["width", "block", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: meet(a, b), schema)


def positives(anchors: DataFrame, blocks: DataFrame, k: int = POSITIVES) -> DataFrame:
    """(a, vec_id, score, rank): the k best rows of each anchor's label."""
    fields = pa.schema([("a", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(some: list, block: Block) -> pa.Table:
        if not some:
            return fields.empty_table()
        vectors, ids, labels = (np.array([r[c] for r in some], np.int64) for c in ("vector", "vec_id", "label"))
        all_scores = [[(-(1 << 63), (1 << 63) - 1)]] * len(some)
        keys, out = [r["a"] for r in some], []
        for i, _, rows, score in best(block, vectors, ids, labels, all_scores, True, k):
            out.append(pa.table([pa.array([keys[i]] * len(rows), pa.int64()), block.ids[rows], score], schema=fields))
        return pa.concat_tables(out) if out else fields.empty_table()

    found = tiles(anchors, blocks, run, "a long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: str = "vec_id % 100 = 0", k: int = NEGATIVES, of: int = POSITIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` picks."""
    rows = written(usable(vectors), "negatives-rows")
    blocks = blocks_of(rows)
    anchors = rows.where(anchor).select(F.size("vector").alias("width"), F.expr("xxhash64(vec_id, label, vector)").alias("a"), "vec_id", "label", "vector")
    anchors = written(anchors, "negatives-asked")
    near = written(positives(anchors, blocks, of), "negatives-positives")
    grouped = near.groupBy("a").agg(F.collect_list(F.struct("rank", "vec_id", "score")).alias("positives"))
    fields = pa.schema([(n, pa.int64()) for n in ("a", "turn", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")])

    def run(some: list, block: Block) -> pa.Table:
        if not some:
            return fields.empty_table()
        vectors, ids, labels = (np.array([r[c] for r in some], np.int64) for c in ("vector", "vec_id", "label"))
        windows, whose = [], []
        for r in some:
            # A negative positive leaves no room below itself.
            bounds = [(p, -(-low * p["score"] // 100), high * p["score"] // 100) for p in r["positives"]]
            bounds = [b for b in bounds if b[1] <= b[2]]
            windows.append([b[1:] for b in bounds])
            whose.append([b[0] for b in bounds])
        out = []
        for i, w, found, score in best(block, vectors, ids, labels, windows, False, k):
            p, n = whose[i][w], len(found)
            fixed = [some[i]["a"], p["rank"], ids[i], p["vec_id"], p["score"]]
            out.append(pa.table([*[pa.array([int(x)] * n, pa.int64()) for x in fixed], block.ids[found], score], schema=fields))
        return pa.concat_tables(out) if out else fields.empty_table()

    asked = written(anchors.join(grouped, "a"), "negatives-windows")
    schema = ", ".join(f"{f.name} long" for f in fields)
    found = tiles(asked, blocks, run, schema)
    rank = F.row_number().over(Window.partitionBy("a", "turn").orderBy(F.desc("negative_score"), "negative_id"))
    kept = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return kept.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

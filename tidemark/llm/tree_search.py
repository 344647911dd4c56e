"""Approximate nearest neighbours by Euclidean distance in a hierarchical k-means tree.

The tree is fitted on a bounded sample (``VALUES`` numbers, drawn by hash), each node by
k-means into ``BRANCHES`` children, until a leaf stands for ``LEAF`` vectors of the table.
Every vector of the table then goes down to its leaf. A query goes best bin first: a priority queue holds the nodes that it knows,
the one with the nearest centre is opened next, and the leaves come out in the order in
which they are worth a visit.

How many leaves a query visits is calibrated, not guessed: for up to ``PROBES`` of the
queries, drawn by hash, the true neighbours are found by comparing them with every vector;
the visits are widened until the probes' leaves hold the wanted share of these. A query
whose leaves hold too few vectors goes on until they hold enough.

Equal vectors are one point with the k + 1 smallest ids, so that a vector copied over and
over costs no more than others; the cut keeps every id that can be in an answer. Leaves
that lie next to each other in the tree share a pack of at most ``BLOCK`` vectors, and a
larger leaf has several. A query is sent to each pack once, with the leaves that it visits
there; a pack meets at most ``QUERIES`` queries in a tile, and a tile returns k rows for a
query at most. Nothing but the tree, the probes and one number for each leaf comes to the
driver or is broadcast, all bounded by ``VALUES``.

Distances are sqrt(sum((a - b)^2)) in double precision on the original vectors; beyond its
range they are infinite and tie. Vectors
that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without ``vec_id``. Vectors of different lengths have no distance: each length has its own
tree. Repeated rows of one id and vector count once. Rows of one id with different vectors
are queries of their own, and never candidates of each other. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import FINITE, by_width, find_package, in_arrow, matrix
from tidemark.session import written

NEIGHBOURS, RECALL = 10, 0.95
#: Numbers in the sample of each length of vectors; vectors a leaf stands for; the fewest sampled ones in it.
VALUES, LEAF, LEAST = 1 << 21, 256, 8
BRANCHES, ITERATIONS = 8, 8
#: Vectors of a pack, queries of a tile, queries whose true neighbours are looked for, growth of the visits.
BLOCK, QUERIES, PROBES, WIDER = 4096, 1024, 256, 1.25
GRAIN = 1 << 30
#: What a pack holds: vectors, the ids of each and how many these are, the leaf of each.
PARTS = ("points", "ids", "sizes", "leaves")


@dataclass
class Tree:
    """Nodes in the order in which they were made; a leaf has no children but a number."""

    centres: np.ndarray
    first: np.ndarray
    children: np.ndarray
    leaf: np.ndarray
    #: By leaf: its first pack, and over how many packs its vectors are dealt.
    pack: np.ndarray
    spread: np.ndarray

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: always down to the nearest child."""
        node = np.zeros(len(points), np.int64)
        open_rows = np.flatnonzero(self.children[node] > 0)
        while len(open_rows):
            for n in np.unique(node[open_rows]):
                rows = open_rows[node[open_rows] == n]
                at = self.first[n]
                node[rows] = at + nearest_centre(points[rows], self.centres[at : at + self.children[n]])
            open_rows = open_rows[self.children[node[open_rows]] > 0]
        return self.leaf[node]

    def best_first(self, query: np.ndarray) -> Iterator[int]:
        """Leaves by the distance of the nodes that lead to them, the nearest known node first."""
        known = [(0.0, 0)]
        while known:
            _, node = heapq.heappop(known)
            if not self.children[node]:
                yield int(self.leaf[node])
                continue
            at, count = self.first[node], self.children[node]
            for i, d in enumerate(((self.centres[at : at + count] - query) ** 2).sum(axis=1).tolist()):
                heapq.heappush(known, (d, int(at + i)))


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * (points @ centres.T)).argmin(axis=1)


def parts(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """k-means: the label of each point and the centres that have any; None if nothing divides them."""
    centres = points[rng.choice(len(points), min(BRANCHES, len(points)), replace=False)]
    for _ in range(ITERATIONS):
        labels = nearest_centre(points, centres)
        used, labels = np.unique(labels, return_inverse=True)
        sums = np.zeros((len(used), points.shape[1]))
        np.add.at(sums, labels, points)
        centres = sums / np.bincount(labels)[:, None]
    labels = nearest_centre(points, centres)
    used, labels = np.unique(labels, return_inverse=True)
    return (labels, centres[used]) if len(used) > 1 else None


def grow(sample: np.ndarray, share: float, leaf: int = LEAF) -> Tree:
    """The tree of a sample that is ``share`` of its table."""
    rng, most = np.random.default_rng(11), max(LEAST, int(leaf * share))
    centres, first, children, numbers, sizes = [sample.mean(axis=0)], [0], [0], [-1], []
    todo, at = [sample], 0
    while at < len(todo):
        points, todo[at] = todo[at], None
        split = parts(points, rng) if len(points) > most else None
        if split is None:
            numbers[at] = len(sizes)
            sizes.append(1.2 * len(points) / share)
        else:
            labels, means = split
            first[at], children[at] = len(centres), len(means)
            for i, mean in enumerate(means):
                centres.append(mean)
                first.append(0)
                children.append(0)
                numbers.append(-1)
                todo.append(points[labels == i])
        at += 1
    tree = Tree(np.array(centres), np.array(first), np.array(children), np.array(numbers), np.zeros(len(sizes), int), np.ones(len(sizes), int))
    # From left to right, so that a pack's leaves are neighbours.
    down, pack, held = [0], -1, math.inf
    while down:
        node = down.pop()
        down += range(first[node] + children[node] - 1, first[node] - 1, -1) if children[node] else []
        if not children[node]:
            size, own = sizes[numbers[node]], numbers[node]
            tree.spread[own] = math.ceil(size / BLOCK)
            if tree.spread[own] > 1 or held + size > BLOCK:
                pack, held = pack + 1, 0
            tree.pack[own], held = pack, held + size
            if tree.spread[own] > 1:
                pack, held = pack + tree.spread[own] - 1, math.inf
    return tree


def points_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.where("vec_id is not null").where(FINITE).where("exists(embedding, x -> x <> 0)")


def classes(points: DataFrame, k: int) -> DataFrame:
    """(embedding, width, h, ids): each different vector with its k + 1 smallest ids.

    The limit on the row number is pushed below the shuffle, so each task sends k + 1 rows of a vector at most.
    """
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    some = points.distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    grouped = some.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select("embedding", F.size("embedding").alias("width"), F.pmod(F.xxhash64("embedding"), F.lit(GRAIN)).alias("h"), "ids")


def sampled(rows: DataFrame, shares: dict[int, float]) -> DataFrame:
    """Of each length of vectors about so large a share, drawn by ``h``."""
    share = F.create_map(*[F.lit(x) for w, s in shares.items() for x in (w, float(s))])[F.col("width")]
    return rows.where(F.col("h") < share * GRAIN)


@dataclass
class Index:
    """The trees by length of vectors, and their packs as a written table."""

    trees: dict[int, Tree]
    packs: DataFrame
    #: How many ids each leaf holds, up to k + 1 of each vector.
    sizes: dict[int, np.ndarray]


def index(vectors: DataFrame, k: int = NEIGHBOURS, leaf: int = LEAF, values: int = VALUES) -> Index:
    """Fits the trees on a sample, then puts every vector into its leaf's pack."""
    spark = vectors.sparkSession
    rows = written(classes(points_of(vectors), k), "tree-classes")
    counts = {r.width: r["count"] for r in rows.groupBy("width").count().collect()}  # one row for each length of vectors
    shares = {w: min(1.0, max(1000, values // w) / n) for w, n in counts.items()}
    trees: dict[int, Tree] = {}
    if counts:
        sample: dict[int, list] = {w: [] for w in counts}
        for r in sampled(rows, shares).select("width", "h", "embedding").sort("h", "embedding").collect():  # bounded by ``values``
            sample[r.width].append(r.embedding)
        trees = {w: grow(np.array(s), shares[w], leaf) for w, s in sample.items() if s}
    # A length whose sample came out empty has few vectors: one leaf holds them.
    for w, n in counts.items():
        nothing = np.zeros(1, int)
        trees.setdefault(w, Tree(np.zeros((1, w)), nothing, nothing, nothing, nothing, np.array([math.ceil(n / BLOCK)])))
    shared = spark.sparkContext.broadcast(trees)  # smaller than the samples

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, piece in by_width(batch, "embedding"):
                tree = shared.value[width]
                leaves = tree.leaves(matrix(piece.column("embedding")))
                pack = tree.pack[leaves] + piece.column("h").to_numpy() % tree.spread[leaves]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("width"), pa.array(pack, pa.int32()), pa.array(leaves, pa.int32()), piece.column("embedding"), piece.column("ids")],
                    ["width", "pack", "leaf", "embedding", "ids"],
                )

    placed = in_arrow(rows, place, "width int, pack int, leaf int, embedding array<double>, ids array<long>")

    def pack(group: pa.Table) -> pa.Table:
        first = group.slice(0, 1).select(["width", "pack"])
        ids = group.column("ids").combine_chunks()
        found = {
            "points": matrix(group.column("embedding")).tobytes(), "ids": np.ascontiguousarray(ids.flatten().to_numpy()).tobytes(),
            "sizes": ids.value_lengths().to_numpy().astype(np.int64).tobytes(), "leaves": group.column("leaf").to_numpy().astype(np.int64).tobytes(),
        }
        for name, data in found.items():
            first = first.append_column(name, pa.array([data], pa.binary()))
        return first

    schema = "width int, pack int, " + ", ".join(f"{n} binary" for n in PARTS)
    packs = written(placed.groupBy("width", "pack").applyInArrow(lambda t: pack(t), schema), "tree-packs")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                held = np.bincount(np.frombuffer(r["leaves"], np.int64), weights=np.frombuffer(r["sizes"], np.int64))
                some = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays([pa.array([r["width"]] * len(some), pa.int32()), pa.array(some), pa.array(held[some].astype(np.int64))], ["width", "leaf", "n"])

    sizes = {w: np.zeros(len(t.pack), np.int64) for w, t in trees.items()}
    counted = in_arrow(packs.select("width", "sizes", "leaves"), count, "width int, leaf long, n long")
    for r in counted.groupBy("width", "leaf").agg(F.sum("n").alias("n")).collect():  # one row a leaf
        sizes[r.width][r.leaf] = r.n
    return Index(trees, packs, sizes)


def distances(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - query) ** 2).sum(axis=1))


@dataclass
class Pack:
    points: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray
    leaves: np.ndarray


def opened(r: dict) -> Pack:
    return Pack(np.frombuffer(r["points"]).reshape(-1, r["width"]), *(np.frombuffer(r[c], np.int64) for c in PARTS[1:]))


def nearest(queries: np.ndarray, own: np.ndarray, pack: Pack, k: int, visited: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, distance, point) of the k nearest ids in a pack of each query, its own id left out.

    ``visited`` says for each query and point whether the query looks at the point's leaf.
    """
    points, ids, sizes = pack.points, pack.ids, pack.sizes
    ends = np.cumsum(sizes)
    # Products only choose whom to measure: what they round is far below the slack.
    square, mine = (points * points).sum(axis=1), (queries * queries).sum(axis=1)
    near = square - 2 * (queries @ points.T)
    if visited is not None:
        near[~visited] = np.inf
    slack = 1e-9 * (mine + square.max(initial=0.0))
    # Of the nearest points, those with a query's own id may count for nothing.
    mine_here = max(1, max(int((ids == o).sum()) for o in own))
    take = min(k + mine_here, len(points))
    reach = np.partition(near, take - 1, axis=1)[:, take - 1] + slack
    found = []
    for q in range(len(queries)):
        # A comparison that overflows holds for no one: then all are measured.
        some = near[q] <= reach[q] if np.isfinite(slack[q]) else np.ones(len(points), bool)
        rows = np.flatnonzero(some if visited is None else some & visited[q])
        measured = distances(queries[q], points[rows])
        again = np.repeat(np.arange(len(rows)), sizes[rows])
        whose = ids[np.concatenate([np.arange(ends[r] - sizes[r], ends[r]) for r in rows])] if len(rows) else ids[:0]
        again = again[whose != own[q]]
        whose = whose[whose != own[q]]
        best = np.lexsort((whose, measured[again]))[:k]
        found.append((np.full(len(best), q), whose[best], measured[again][best], rows[again][best]))
    return tuple(np.concatenate(x) for x in zip(*found))  # type: ignore[return-value]


def calibrate(idx: Index, queries: DataFrame, k: int, recall: float, probes: int = PROBES) -> dict[int, int]:
    """By length of vectors: how many leaves to visit, so that the probes find ``recall`` of their neighbours."""
    spark = queries.sparkSession
    counts = {r.width: r["count"] for r in queries.groupBy("width").count().collect()}
    if not counts:
        return {}
    chosen = sampled(queries, {w: min(1.0, probes / n) for w, n in counts.items()}).sort("h", "vec_id").select("width", "vec_id", "embedding").collect()  # about ``probes``
    asked = {w: ([r.vec_id for r in chosen if r.width == w], np.array([r.embedding for r in chosen if r.width == w])) for w in {r.width for r in chosen}}
    shared = spark.sparkContext.broadcast(asked)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task keeps k rows a probe, however many packs it reads.
        best: dict = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["width"] in shared.value:
                    own, vectors = shared.value[r["width"]]
                    pack = opened(r)
                    q, ids, far, at = nearest(vectors, np.array(own), pack, k)
                    found = np.rec.fromarrays([q, far, ids, pack.leaves[at]], names="probe,score,vec_id,leaf")
                    found = np.concatenate([best.get(r["width"], found[:0]), found])
                    found = found[np.lexsort((found["vec_id"], found["score"], found["probe"]))]
                    starts = np.searchsorted(found["probe"], found["probe"])
                    best[r["width"]] = found[np.arange(len(found)) - starts < k]
        for width, found in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([width] * len(found), pa.int32()), *[pa.array(np.ascontiguousarray(found[c])) for c in ("probe", "leaf", "vec_id", "score")]],
                ["width", "probe", "leaf", "vec_id", "score"],
            )

    pairs = in_arrow(idx.packs.select("width", *PARTS), compare, "width int, probe long, leaf long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("width", "probe").orderBy("score", "vec_id"))
    true = pairs.withColumn("place", place).where(F.col("place") <= k).select("width", "probe", "leaf").collect()  # k rows a probe
    visits = {}
    for w in counts:
        vectors = asked.get(w, ([], []))[1]
        turn = []
        for v in vectors:
            order = np.zeros(len(idx.trees[w].pack), np.int64)
            order[list(idx.trees[w].best_first(v))] = np.arange(len(order))
            turn.append(order)
        turns = np.array([turn[r.probe][r.leaf] for r in true if r.width == w])
        wide = 1
        while len(turns) and (turns < wide).mean() < recall and wide < len(idx.trees[w].pack):
            wide = max(wide + 1, int(wide * WIDER))
        # No probe, no calibration: all leaves.
        visits[w] = min(wide, len(idx.trees[w].pack)) if len(turns) else len(idx.trees[w].pack)
    return visits


def search(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, recall: float = RECALL, leaf: int = LEAF, values: int = VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query the k nearest that were found among ``vectors``."""
    spark = vectors.sparkSession
    find_package(spark)
    idx = index(vectors, k, leaf, values)
    known = [w for w in idx.trees]
    asked = points_of(queries).distinct().select(
        "vec_id", "embedding", F.size("embedding").alias("width"), F.pmod(F.xxhash64("embedding", "vec_id"), F.lit(GRAIN)).alias("h")
    )
    asked = written(asked.where(F.col("width").isin(known)), "tree-queries")
    wide = calibrate(idx, asked, k, recall)
    shared = spark.sparkContext.broadcast((idx.trees, idx.sizes, wide))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, sizes, most = shared.value
        for batch in batches:
            for width, piece in by_width(batch, "embedding"):
                tree, rows, packs, lists = trees[width], [], [], []
                for i, v in enumerate(matrix(piece.column("embedding"))):
                    held, of_pack = 0, {}
                    for turn, at in enumerate(tree.best_first(v)):
                        if turn >= most[width] and held > k:
                            break
                        held += sizes[width][at]
                        for p in range(tree.pack[at], tree.pack[at] + tree.spread[at]):
                            of_pack.setdefault(p, []).append(at)
                    rows += [i] * len(of_pack)
                    packs += of_pack
                    lists += of_pack.values()
                for at in range(0, len(rows), 1 << 13):
                    part = slice(at, at + (1 << 13))
                    some = piece.select(["width", "vec_id", "embedding", "h"]).take(pa.array(rows[part]))
                    yield some.append_column("pack", pa.array(packs[part], pa.int32())).append_column("leaves", pa.array(lists[part], pa.list_(pa.int64())))

    schema = "width int, vec_id long, embedding array<double>, h long, pack int, leaves array<long>"
    visits = written(in_arrow(asked, visit, schema), "tree-visits")
    # A row for each pack: how many tiles its queries need.
    tiles = visits.groupBy("width", "pack").agg(F.ceil(F.count("*") * 1.2 / QUERIES).cast("int").alias("tiles"))
    tiles = F.broadcast(written(tiles, "tree-tiles"))
    left = visits.join(tiles, ["width", "pack"]).withColumn("tile", F.pmod("h", "tiles").cast("int")).drop("tiles")
    right = idx.packs.join(tiles, ["width", "pack"]).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles")

    def meet(queries: pa.Table, packs: pa.Table) -> pa.Table:
        own, number, found = queries.column("vec_id").to_numpy(), queries.column("h").to_numpy(), []
        schema = pa.schema([("query_id", pa.int64()), ("h", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if queries.num_rows and packs.num_rows:
            asking, lists = matrix(queries.column("embedding")), queries.column("leaves").to_pylist()
            pack = opened(packs.to_pylist()[0])
            there, place = np.unique(pack.leaves, return_inverse=True)
            visited = np.zeros((len(own), len(there)), bool)
            for i, leaves in enumerate(lists):
                visited[i] = np.isin(there, leaves)
            for at in range(0, len(own), 256):
                some = slice(at, at + 256)
                q, ids, far, _ = nearest(asking[some], own[some], pack, k, visited[some][:, place])
                found.append(pa.table([own[some][q], number[some][q], ids, far], schema=schema))
        return pa.concat_tables(found) if found else schema.empty_table()

    keys = ["width", "pack", "tile"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: meet(a, b), "query_id long, h long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "h").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

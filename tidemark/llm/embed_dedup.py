"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

A unit vector u is stored as s * q with q in int8 and the length e of what that loses,
u - s q, rounded up. For two vectors |u.v - sq.tr| <= e_v + e_u |t r|, so a pair whose int8
product plus this bound stays below the threshold can't reach it, and one whose product
less the bound reaches it is linked. Only int8 rows travel to the tiles. The double
precision rows are fetched just for vectors that have pairs in between in a tile, and only
these pairs are recomputed, with their plain product.

Equal vectors are one class with a count before anything is compared. Classes are dealt
by hash into strips of bounded size; each strip is packed into one row, and a task gets
the two rows of a tile. A tile never returns its pairs: it returns how many links each
vector has in it, and for connectivity a spanning forest, at most one edge a vector. Whole
groups of near copies therefore cost no more rows than scattered ones.

Vectors that are null, empty, zero or hold null or non-finite components have no links;
vectors of different lengths never link. A row without a ``vec_id`` counts as a link of
the others but has a null component. Rows that repeat a ``vec_id`` are vectors of their
own, and share a component's name only if they are linked.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_group
from tidemark.llm.components import components
from tidemark.session import written

THRESHOLD = 0.9
#: The largest strip of vectors, and into how many strips at least a large table is cut.
STRIP, STRIPS = 16_384, 8
#: For the rounding of single-precision sums and of the bounds themselves.
SLACK = 1e-5
ROWS = 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, whatever their scale."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the length of what the rounding loses."""
    scale = np.abs(units).max(axis=1) / 127
    q = np.rint(units / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((units - q * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows: single precision holds sums of 1 000 products exactly."""
    out = np.zeros((len(a), len(b)), np.float32 if a.shape[1] <= 1000 else np.float64)
    for at in range(0, a.shape[1], 1000):
        out += a[:, at : at + 1000].astype(np.float32) @ b[:, at : at + 1000].astype(np.float32).T
    return out


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a[i] and b[i]; labels point at the smallest member."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def tile(left: dict, right: dict, same: bool, threshold: float, exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of each row of both sides, weighted by the other's copies, a forest's labels, and which rows have unsure pairs.

    From int8 rows alone: the links that their bounds are sure of. With ``exact``: the
    links among all other pairs, by the product of their double precision rows.
    """
    n, m = len(left["node"]), len(right["node"])
    of_left, of_right = np.zeros(n, np.int64), np.zeros(m, np.int64)
    unsure_left, unsure_right = np.zeros(n, bool), np.zeros(m, bool)
    labels = np.arange(n if same else n + m)
    length = np.sqrt((right["q"].astype(np.float64) ** 2).sum(axis=1)) * right["scale"]
    longest = float(length.max()) if m else 0.0
    for at in range(0, n, ROWS):
        rows = slice(at, min(at + ROWS, n))
        near = products(left["q"][rows], right["q"])
        near *= left["scale"][rows, None].astype(near.dtype)
        near *= right["scale"][None].astype(near.dtype)
        # Few pairs come near the threshold; these are looked at more closely.
        a, b = np.nonzero(near + right["error"][None].astype(near.dtype) >= (threshold - SLACK - left["error"][rows] * longest)[:, None].astype(near.dtype))
        value = near[a, b].astype(np.float64)
        a = a + at
        if same:
            value, a, b = value[a < b], a[a < b], b[a < b]
        bound = right["error"][b] + left["error"][a] * length[b] + SLACK
        sure, far = value - bound >= threshold, value + bound < threshold
        if exact:
            a, b = a[~sure & ~far], b[~sure & ~far]
            linked = np.concatenate([np.zeros(0, bool)] + [
                np.einsum("ij,ij->i", left["unit"][a[k : k + 65_536]], right["unit"][b[k : k + 65_536]]) >= threshold for k in range(0, len(a), 65_536)
            ])
        else:
            unsure_left[a[~sure & ~far]] = True
            unsure_right[b[~sure & ~far]] = True
            linked = sure
        a, b = a[linked], b[linked]
        of_left += np.bincount(a, weights=right["copies"][b], minlength=n).astype(np.int64)
        of_right += np.bincount(b, weights=left["copies"][a], minlength=m).astype(np.int64)
        joined(labels, a, b if same else b + n)
    return of_left, of_right, labels, unsure_left, unsure_right


_KINDS = {"node": np.int64, "copies": np.int64, "q": np.int8, "scale": np.float64, "error": np.float64}
FOUND = "width int, low int, high int, node long, links long, root long, unsure boolean"


def _side(node: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> dict:
    units = unit(vectors)
    q, scale, error = quantised(units)
    return {"node": node, "copies": copies, "q": q, "scale": scale, "error": error, "unit": units}


def _packed(group: pa.Table) -> pa.Table:
    vectors = np.array(group.column("embedding").to_pylist(), dtype=np.float64)
    made = _side(group.column("node").to_numpy(), group.column("copies").to_numpy(), vectors)
    fields = {k: pa.array([np.ascontiguousarray(made[k]).tobytes()], pa.binary()) for k in _KINDS}
    return pa.table({"strip": group.column("strip")[:1], "width": pa.array([vectors.shape[1]], pa.int32()), **fields})


def _opened(row: dict) -> dict:
    out = {k: np.frombuffer(row[k], kind) for k, kind in _KINDS.items()}
    return out | {"q": out["q"].reshape(-1, row["width"])}


def _found(key: tuple, left: dict, right: dict, same: bool, threshold: float, exact: bool) -> pa.Table:
    """What a tile found: rows that have links or unsure pairs."""
    of_left, of_right, labels, unsure_left, unsure_right = tile(left, right, same, threshold, exact)
    node = left["node"] if same else np.concatenate([left["node"], right["node"]])
    links = of_left + of_right if same else np.concatenate([of_left, of_right])
    unsure = unsure_left | unsure_right if same else np.concatenate([unsure_left, unsure_right])
    rows = (links > 0) | unsure
    fixed = [pa.array(np.full(int(rows.sum()), k), pa.int32()) for k in key]
    made = [*fixed, pa.array(node[rows], pa.int64()), pa.array(links[rows], pa.int64()), pa.array(node[labels][rows], pa.int64()), pa.array(unsure[rows])]
    return pa.table(made, names=["width", "low", "high", "node", "links", "root", "unsure"])


def tiles(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): what each tile found; root is a smaller node that is linked, if any."""
    spark = classes.sparkSession
    schema = "strip int, width int, node binary, copies binary, q binary, scale binary, error binary"
    packed = written(by_group(classes, ["width", "strip"], lambda t: _packed(t), schema), "embed-strips")
    # Strip b of a width meets every strip a <= b: its row goes to that many tiles.
    top = packed.groupBy("width").agg(F.max("strip").alias("top"))
    dealt = packed.join(F.broadcast(top), "width").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("other")
    ).withColumn("low", F.least("strip", "other")).withColumn("high", F.greatest("strip", "other"))

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["strip"])
        sides, key = [_opened(r) for r in rows], (rows[0]["width"], rows[0]["low"], rows[0]["high"])
        return _found(key, sides[0], sides[-1], len(sides) == 1, threshold, False)

    count = max(1, packed.count())
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")) * 4, count * count)
    dealt = dealt.drop("top", "other").repartition(parts, "width", "low", "high")
    sure = written(by_group(dealt, ["width", "low", "high"], lambda t: run(t), FOUND), "embed-sure")

    def again(group: pa.Table) -> pa.Table:
        key = tuple(group.column(c)[0].as_py() for c in ("width", "low", "high"))
        strip, node, copies = (group.column(c).to_numpy() for c in ("strip", "node", "copies"))
        vectors = np.array(group.column("embedding").to_pylist(), dtype=np.float64)
        sides = [_side(node[strip == s], copies[strip == s], vectors[strip == s]) for s in dict.fromkeys(key[1:])]
        return _found(key, sides[0], sides[-1], len(sides) == 1, threshold, True)

    # Double precision rows go only to the tiles in which they have unsure pairs.
    fetched = sure.where("unsure").select("low", "high", "node").join(classes, "node").repartition(parts, "width", "low", "high")
    rest = by_group(fetched, ["width", "low", "high"], lambda t: again(t), FOUND)
    return sure.where("links > 0").unionByName(rest.where("links > 0")).select("node", "links", "root")


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding)``."""
    finite = "exists(embedding, x -> x <> 0) and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").withColumn("good", F.expr(f"coalesce({finite}, false)"))
    distinct = rows.where("good").groupBy("embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    distinct = written(distinct, "embed-classes")
    strips = max(1, distinct.count())
    strips = max(math.ceil(strips / STRIP * 1.1), min(STRIPS, math.ceil(strips / 64)))
    dealt = distinct.withColumn("width", F.size("embedding")).withColumn("strip", F.pmod(F.xxhash64("embedding"), F.lit(strips)).cast("int"))
    number = F.row_number().over(Window.partitionBy("width", "strip").orderBy("embedding"))
    # Widths and strips fit into 20 bits each, places into 24.
    node = F.expr("shiftleft(cast(width as long), 44) | shiftleft(cast(strip as long), 24)").bitwiseOR(number.cast("long"))
    classes = written(dealt.withColumn("node", node), "embed-nodes")
    found = written(tiles(classes.select("node", "width", "strip", "copies", "embedding"), threshold), "embed-links")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("root <> node").select(F.col("node").alias("a"), F.col("root").alias("b")), "embed")
    joined_up = classes.join(sums, "node", "left").join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = joined_up.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = joined_up.join(least, "component").select(
        F.col("embedding").alias("vector"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.join(written(named, "embed-named"), F.expr("good and embedding = vector"), "left")
    component = F.expr("case when vec_id is null then null when good then component_id else vec_id end")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id")).withColumn(
        "kept", F.expr("coalesce(vec_id = component_id, false)")
    )

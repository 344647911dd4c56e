"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints within ``max_distance`` bits of each other are cut into so few segments that
one segment differs by at most one bit (two segments for two bits). Two segments that
differ by at most one bit agree once the right bit is deleted, so every fingerprint is
indexed under each one-bit deletion of each segment; an equality join gives the
candidates and a bit count verifies them.

Scale: exact copies of a fingerprint meet in an aggregate before anything is indexed. An
index bucket of more than ``BUCKET`` fingerprints is not joined with itself. Its members
are linked exactly through their one-bit neighbours instead: two fingerprints differ by
at most two bits if and only if some value is within one bit of both. That takes 65 rows
a member and no pairs.

Null, empty and blank texts have fingerprint zero and are linked like any other. Rows
without a ``doc_id`` are not compared: their component is null. ``one_of_each`` compares them like
all others: of each group it keeps one row, the one with the smallest (id, fingerprint,
digest of the whole row), rows without id last; two texts that share an id are two rows.
Extra columns only enter the digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import in_arrow, runs
from tidemark.llm.components import components
from tidemark.session import written

SHINGLE, MAX_DISTANCE, SEED = 3, 2, 42
#: Larger index buckets are linked through one-bit neighbours.
BUCKET = 64


def fingerprint_of(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of a document's shingles, repeats included."""
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - shingle + 1)


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the columns to keep: bit set where more than half of the shingles' hashes have it; fp is signed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                fps = np.array([_majority(fingerprint_of(t.encode().lower().split(), shingle)) for t in texts], dtype=np.uint64)
                columns = [piece.column("doc_id"), pa.array(fps.view(np.int64)), *[piece.column(c) for c in keep]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *keep])

    rows = docs.select(F.col("doc_id").cast("long"), "text", *keep)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), *[rows.schema[c] for c in keep]])
    return in_arrow(rows, run, schema)


def signatures(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(key, fp) for every one-bit deletion of every segment."""
    segments = max_distance // 2 + 1
    width = 64 // segments
    # Few bytes of fingerprints become many of signatures: deal them to all tasks first.
    spread = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    at = spread.select("fp", F.explode(F.sequence(F.lit(0), F.lit(segments * width - 1))).alias("bit"))
    low = (F.col("bit") / width).cast("int") * width
    part = F.expr("shiftrightunsigned(fp, low)")
    if width < 64:
        part = part.bitwiseAND(F.lit((1 << width) - 1))
    part = part.bitwiseAND(F.expr("~shiftleft(1L, bit - low)"))
    keyed = at.withColumn("low", low)
    # Up to 32 bits of segment leave room for the deleted bit's place; a 64-bit one does not.
    key = F.shiftleft(part, 6).bitwiseOR(F.col("bit").cast("long")) if width <= 32 else F.struct(part, "bit")
    return keyed.select(key.alias("key"), "fp")


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(a, b): edges between distinct fingerprints at most ``max_distance`` bits apart.

    All links of small buckets; of large ones enough to hold together what is linked.
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance is 1 or 2: beyond that, large buckets have no exact way without pairs")
    index = signatures(fps, max_distance)
    # Stored, so that the partition of a value which millions share can be split in the join.
    sizes = written(index.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "simhash-sizes")
    # They grow with the input, so they are never broadcast.
    shared = written(index.join(sizes.hint("merge"), "key"), "simhash-shared")
    small = shared.where(F.col("size") <= bucket).select("key", "fp")
    left, right = small.withColumnRenamed("fp", "a"), small.withColumnRenamed("fp", "b")
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance))
    crowd = shared.where(F.col("size") > bucket)
    if max_distance == 2:
        crowd = crowd.select("fp").distinct().select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit"))
        crowd = crowd.select("fp", F.expr("case when bit < 0 then fp else fp ^ shiftleft(1L, bit) end").alias("key"))
    middle = written(crowd.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1"), "simhash-middles")
    stars = crowd.join(middle, "key").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.select("a", "b").unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links, itself included."""
    rows = written(fingerprints(docs, shingle), "simhash-fingerprints")
    known = rows.where("doc_id is not null")
    distinct = written(known.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), max_distance), "simhash")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first_id", F.coalesce("component", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = written(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-components")
    out = rows.join(of_print, "fp", "left")
    return out.select("doc_id", "fp", F.expr("case when doc_id is not null then component_id end").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows that stay, with all their columns: of each group one, and no text without a near copy that stays."""
    # 128 bits tell rows apart; rows that are equal in every column are told by their number.
    whole = [F.col(f"`{c}`") for c in docs.columns]
    digest = {"__high": F.xxhash64(*whole), "__low": F.xxhash64(F.lit("low"), *whole)}
    marked = docs.select(F.col("doc_id").cast("long"), "text", *[c.alias(n) for n, c in digest.items()])
    rows = written(fingerprints(marked, shingle, tuple(digest)).groupBy("doc_id", "fp", *digest).agg(F.count("*").alias("n")), "simhash-rows")
    roots = components(links(written(rows.select("fp").distinct(), "simhash-distinct"), max_distance), "simhash")
    rooted = rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp", *digest, "n")
    first = rooted.groupBy("root").agg(F.min(order).alias("first")).select("first.__high", "first.__low", "first.n")
    first = written(first, "simhash-first")
    high, low = (_fresh(n, docs.columns) for n in digest)
    told = docs.withColumns({high: digest["__high"], low: digest["__low"]})
    same = lambda kept: (told[high] == kept["__high"]) & (told[low] == kept["__low"])
    single, several = first.where("n = 1"), first.where("n > 1")
    lone = told.join(single, same(single), "left_semi")
    again = told.join(several, same(several), "left_semi").dropDuplicates([high, low])
    return lone.unionByName(again).drop(high, low)


def _fresh(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name

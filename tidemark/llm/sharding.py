"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring. A document belongs to the first point clockwise
of its id's hash; where that shard is full, it goes on clockwise to the next point whose
shard has room. Capacities add up to the number of rows (``slack`` 0), so that the counts
of any two shards differ by one at most, or leave some slack, so that less moves when a
shard is added.

Documents arrive in ring order: by stretch of the ring, then by a digest of their text,
then by position. Because shards only fill up, all that the flow needs is how many rows
each stretch has. The driver gets these counts (at most ``(2 ** CUTS + points) * PARTS``,
set by parameters, not by data), and sends back which ranks of a stretch go to which
shard: at most one range for each stretch and one for each shard that fills up. Ranks
come from windows over (stretch, part), so that many rows with one id are sorted in
several tasks as long as their texts differ.

Null texts have no bytes. A null ``doc_id`` has its own place on the ring. Repeated rows
are separate rows next to each other. Other columns only travel with ``carry``.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Points of each shard, the ring's even cuts as a power of two, parts of a stretch.
POINTS, CUTS, PARTS = 64, 8, 16
RING = 1 << 63


def ring_points(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(position, shard) clockwise."""
    place = lambda s, p: int.from_bytes(hashlib.md5(f"{s}:{p}".encode()).digest()[:8], "big") >> 1
    return sorted((place(s, p), s) for s in range(shards) for p in range(points))


def stretches(points: list[tuple[int, int]], cuts: int = CUTS) -> list[tuple[int, int, int, int]]:
    """(even cut, from, to, point) of each stretch, clockwise; it belongs to one point and one even cut."""
    places = [p for p, _ in points]
    width = RING >> cuts
    # A position equal to a point belongs to it, so a stretch ends behind its point.
    edges = sorted({0, RING, *(i * width for i in range(1 << cuts)), *(p + 1 for p in places)})
    return [(a // width, a, b, bisect.bisect_left(places, a) % len(points)) for a, b in zip(edges, edges[1:])]


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack:
        return [-int(-(1 + slack) * rows // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def flow(counts: list[int], owners: list[int], points: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(stretch, first rank, end rank, shard, first slot): where the rows of each stretch go."""
    room, filled, out = list(room), [0] * len(room), []
    for stretch, (count, point) in enumerate(zip(counts, owners)):
        rank = 0
        while rank < count:
            while not room[points[point][1]]:
                point = (point + 1) % len(points)
            shard = points[point][1]
            some = min(count - rank, room[shard])
            out.append((stretch, rank, rank + some, shard, filled[shard]))
            room[shard] -= some
            filled[shard] += some
            rank += some
    return out


def assign(docs: DataFrame, shards: int = 8, points: int = POINTS, slack: float = 0.0, carry: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), with ``carry`` also the whole row as ``row``."""
    spark = docs.sparkSession
    ring = ring_points(shards, points)
    parts = stretches(ring)
    table = spark.createDataFrame([(i, cut, low, high - 1) for i, (cut, low, high, _) in enumerate(parts)], "stretch int, cut long, low long, last long").coalesce(1)
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id", (F.length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.expr("shiftrightunsigned(xxhash64(doc_id), 1)").alias("place"), *([F.struct("*").alias("row")] if carry else []),
    )
    width = (RING >> CUTS).bit_length() - 1
    at = rows.withColumn("cut", F.shiftrightunsigned("place", width)).join(F.broadcast(table), "cut")
    at = at.where("place between low and last").withColumn("part", F.pmod("text_crc32", F.lit(PARTS)).cast("int"))
    counts = {(s, p): n for s, p, n in at.groupBy("stretch", "part").count().collect()}
    before, sums = [], []
    for s in range(len(parts)):
        total = 0
        for p in range(PARTS):
            if (s, p) in counts:
                before.append((s, p, total))
                total += counts[s, p]
        sums.append(total)
    ranges = flow(sums, [p[3] for p in parts], ring, capacities(sum(sums), shards, slack))
    small = lambda rows, schema: F.broadcast(spark.createDataFrame(rows, schema).coalesce(1))
    order = Window.partitionBy("stretch", "part").orderBy("place", "doc_id", "size", "text_crc32")
    ranked = at.withColumn("n", F.row_number().over(order) - 1)
    ranked = ranked.join(small(before, "stretch int, part int, skipped long"), ["stretch", "part"]).withColumn("rank", F.col("n") + F.col("skipped"))
    found = ranked.join(small(ranges, "stretch int, low_rank long, end_rank long, shard int, low_slot long"), "stretch")
    found = found.where("rank >= low_rank and rank < end_rank").withColumn("slot", F.col("low_slot") + F.col("rank") - F.col("low_rank"))
    return found.select("doc_id", "size", "text_crc32", "shard", "slot", *(["row"] if carry else []))


def write_shards(docs: DataFrame, path: str, shards: int = 8, rows_per_file: int = 1_000_000, **how) -> None:
    """Writes the whole rows, one folder for each shard, a file for each run of its slots."""
    placed = assign(docs, shards, carry=True, **how).withColumn("file", F.floor(F.col("slot") / rows_per_file))
    placed = placed.repartition("shard", "file").sortWithinPartitions("shard", "slot")
    placed.select("shard", "slot", "row").write.partitionBy("shard").parquet(path)

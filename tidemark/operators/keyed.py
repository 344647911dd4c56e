"""Ordered per-key columns that also hold up when a few keys own most rows.

A window partitioned by key sorts the whole history of a key in one task.  For keys that
are smaller than a task that is what we want: one shuffle, one sort.  A key that fills
whole tasks is scanned in segments.  All rows in the order (key, time, ties) are cut at
quantiles into as many segments as there are shuffle partitions; a key in which two cuts
fall is worked on by (key, segment).  Each segment leaves one summary row, summaries are
composed in order, and what a row needs from other segments (the row before, the row
after, how many rows precede it) is handed back by broadcast: at most one row a segment.

The cuts are whole rows, not times, so that a key whose rows share a single time is cut as
well.  They only decide how the work is spread; the result is the same with any cuts,
including none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import written

CELL = "_cell"

# Rows sampled for each segment, and in all.
SAMPLED = 32
MOST = 1 << 18


@dataclass(frozen=True)
class Cuts:
    """Keys that fill whole segments, each with the rows at which it is cut, in order."""

    at: DataFrame  # _key, _rows: at most one row a segment
    order: tuple[str, ...]  # the columns of these rows
    depth: int  # halvings that find a place among a key's rows
    copies: DataFrame | None  # _key, _row: rows that fill a segment with their own copies

    def shared(self, order: Sequence[str]) -> list[str]:
        """The leading columns in which another order agrees with that of the cuts."""
        n = 0
        while n < min(len(order), len(self.order)) and order[n] == self.order[n]:
            n += 1
        return list(order[:n])

    def place(self, df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
        """Add the segment of every row, found by bisection; -1 for keys that are not cut.

        Rows may be ordered by further columns, or by fewer of the cuts' columns.
        """
        columns = self.shared(order)
        if not columns:
            raise ValueError(f"cuts by {self.order} do not fit an order by {list(order)}")
        at = self.at.select("_key", F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in columns])).alias("_rows"))
        here = F.struct(*[F.col(c) for c in columns])

        def halve(place: Column, width: Column) -> Column:
            return F.when(F.get(F.col("_rows"), place + width - 1) <= here, place + width).otherwise(place)

        widths = F.array(*[F.lit(1 << b) for b in reversed(range(self.depth))])
        found = F.aggregate(widths, F.lit(0), halve)
        return (
            df.join(F.broadcast(at), df[key] == at["_key"], "left")
            .withColumn(CELL, F.when(F.col("_rows").isNotNull(), found).otherwise(F.lit(-1)))
            .drop("_key", "_rows")
        )

    def split(self, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(rows of cut keys, all other rows)."""
        keys = F.broadcast(self.at.select(F.col("_key").alias(key)))
        return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")

    def once(self, df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
        """Without further copies of rows whose copies fill a segment; no cut can part equal rows.

        Only for rows that are told apart by all their columns.
        """
        if self.copies is None or tuple(order) != self.order or {key, *order} != set(df.columns):
            return df
        copies = F.broadcast(self.copies)
        same = (df[key] == copies["_key"]) & F.struct(*[df[c] for c in order]).eqNullSafe(copies["_row"])
        kept = self.copies.select(*[F.col("_key").alias(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])
        return df.join(copies, same, "left_anti").unionByName(kept)


def find_cuts(df: DataFrame, key: str, order: Sequence[str], segments: int | None = None) -> Cuts | None:
    """Cut the rows of ``df`` into segments of about equal size; None if no key fills two of them.

    One pass takes a random sample of at most ``SAMPLED`` rows a segment.  A key in which
    two cuts fall is cut there; any other key is smaller than two segments.  ``segments``
    are the shuffle partitions unless given, so a cluster that sets these for its data sets
    the size of a task here too.
    """
    segments = segments or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if segments < 2:
        return None
    size = segments * max(2, min(SAMPLED, MOST // segments))
    rows = df.select(F.col(key).alias("_key"), F.struct(*order).alias("_row")).filter(F.col("_key").isNotNull())
    # A bounded sample, sorted in one task.
    ranked = rows.orderBy(F.rand(7)).limit(size).select(
        "*", F.row_number().over(Window.orderBy("_key", "_row")).alias("_n"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_all")
    )
    ends = ranked.filter(F.floor(F.col("_n") * segments / F.col("_all")) > F.floor((F.col("_n") - 1) * segments / F.col("_all")))
    marks = ends.groupBy("_key", "_row").agg(F.count(F.lit(1)).alias("_times"))
    per_key = marks.groupBy("_key").agg(
        F.sort_array(F.collect_list("_row")).alias("_rows"), F.sum("_times").alias("_cuts"),
        F.filter(F.collect_list(F.struct("_times", "_row")), lambda m: m["_times"] > 1).alias("_copies"),
    ).filter(F.col("_cuts") > 1)
    if per_key.isEmpty():
        return None
    kept = written(per_key, "cuts")
    most, copied = kept.agg(F.max(F.size("_rows")), F.max(F.size("_copies"))).first()
    copies = kept.select("_key", F.explode("_copies").alias("_copy")).select("_key", F.col("_copy._row").alias("_row"))
    return Cuts(kept.select("_key", "_rows"), tuple(order), int(most).bit_length(), copies if copied else None)


def match(
    left: DataFrame, per_key: DataFrame, key: str, how: str, cuts: Cuts | None = None
) -> DataFrame:
    """Join to a table that holds each key at most once.

    Rows of cut keys meet their few counterparts by broadcast instead of being
    shuffled to one task; ``how`` is inner, left, left_semi or left_anti.
    """
    if cuts is None:
        return left.join(per_key, key, how)
    heavy, light = cuts.split(left, key)
    few, _ = cuts.split(per_key, key)
    return light.join(per_key, key, how).unionByName(heavy.join(F.broadcast(few), key, how))


def ordered(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    *,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    fill: Mapping[str, Column] | None = None,
    number: str | None = None,
    peak: Mapping[str, Column] | None = None,
    reach: Mapping[str, Column] | None = None,
    cuts: Cuts | None = None,
    summary_of: DataFrame | None = None,
) -> DataFrame:
    """Add columns computed along each key's rows in ``order`` (ascending, NULLs first).

    lag     value on the row before            lead   value on the row after
    fill    last non-null value up to the row  number position, from 1
    peak    maximum over all rows of the key        reach  maximum over the rows before

    ``order`` starts with the time column and should be a total order.  With cuts,
    segments are summarised from ``summary_of`` if given: rows that lead to the
    same neighbours as ``df`` at less cost (``number`` then counts those rows).
    """
    lag, lead, fill, peak, reach = lag or {}, lead or {}, fill or {}, peak or {}, reach or {}
    sort = [F.col(c).asc_nulls_first() for c in order]
    if cuts is None:
        w = Window.partitionBy(key).orderBy(*sort)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(key)
        added = {a: F.lag(c).over(w) for a, c in lag.items()}
        added |= {a: F.lead(c).over(w) for a, c in lead.items()}
        added |= {a: F.last(c, ignorenulls=True).over(upto) for a, c in fill.items()}
        if number:
            added[number] = F.row_number().over(w)
        added |= {a: F.max(c).over(whole) for a, c in peak.items()}
        added |= {a: F.max(c).over(w.rowsBetween(Window.unboundedPreceding, -1)) for a, c in reach.items()}
        return df.withColumns(added)

    placed = cuts.place(df, key, order)
    source = placed if summary_of is None else cuts.place(summary_of, key, order)
    edges = cell_edges(source, cuts, key, order, lag, lead, fill, peak, reach)
    w = Window.partitionBy(key, CELL).orderBy(*sort)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = {"_at": F.row_number().over(w), "_more": F.lead(F.lit(True)).over(w)}
    inner |= {f"_lag_{a}": F.lag(c).over(w) for a, c in lag.items()}
    inner |= {f"_lead_{a}": F.lead(c).over(w) for a, c in lead.items()}
    inner |= {f"_fill_{a}": F.last(c, ignorenulls=True).over(upto) for a, c in fill.items()}
    # Keys that are not cut have one segment, so their peak is the segment's.
    inner |= {f"_peak_{a}": F.max(c).over(Window.partitionBy(key, CELL)) for a, c in peak.items()}

    inner |= {f"_reach_{a}": F.max(c).over(w.rowsBetween(Window.unboundedPreceding, -1)) for a, c in reach.items()}

    joined = placed.withColumns(inner).join(F.broadcast(edges), [key, CELL], "left")
    first, last = F.col("_at") == 1, F.col("_more").isNull()
    outer = {a: F.when(first, F.col(f"_before.{a}")).otherwise(F.col(f"_lag_{a}")) for a in lag}
    outer |= {a: F.when(last, F.col(f"_after.{a}")).otherwise(F.col(f"_lead_{a}")) for a in lead}
    outer |= {a: F.coalesce(F.col(f"_fill_{a}"), F.col(f"_carry_{a}")) for a in fill}
    outer |= {a: F.coalesce(F.col(f"_top_{a}"), F.col(f"_peak_{a}")) for a in peak}
    # A maximum of two, either of which may be missing; greatest() leaves missing ones out.
    outer |= {a: F.array_max(F.array(f"_reach_{a}", f"_high_{a}")) for a in reach}
    if number:
        outer[number] = (F.col("_at") + F.coalesce(F.col("_skip"), F.lit(0))).cast("int")
    return joined.select(*[F.col(c) for c in df.columns], *[c.alias(a) for a, c in outer.items()])


def cell_edges(placed, cuts: Cuts, key, order, lag, lead, fill, peak, reach) -> DataFrame:
    """One row per (cut key, segment) with what rows of that segment need from others."""
    at = F.struct(*order)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs.append(F.max_by(_row(lag), at).alias("_tail"))
    aggs.append(F.min_by(_row(lead), at).alias("_head"))
    aggs += [F.max_by(c, F.when(c.isNotNull(), at)).alias(f"_carry_{a}") for a, c in fill.items()]
    aggs += [F.max(c).alias(f"_top_{a}") for a, c in peak.items()]
    aggs += [F.max(c).alias(f"_high_{a}") for a, c in reach.items()]
    found = placed.filter(F.col(CELL) >= 0).groupBy(key, CELL).agg(*aggs)
    # Segments in which there is nothing to summarise still hand on what came before.
    cells = cuts.at.select(F.col("_key").alias(key), F.explode(F.sequence(F.lit(0), F.size("_rows"))).alias(CELL))
    cells = cells.join(found, [key, CELL], "left")

    w = Window.partitionBy(key).orderBy(CELL)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    future = w.rowsBetween(1, Window.unboundedFollowing)
    return cells.select(
        key,
        CELL,
        F.last("_tail", ignorenulls=True).over(past).alias("_before"),
        F.first("_head", ignorenulls=True).over(future).alias("_after"),
        F.sum("_n").over(past).alias("_skip"),
        *[F.last(f"_carry_{a}", ignorenulls=True).over(past).alias(f"_carry_{a}") for a in fill],
        *[F.max(f"_top_{a}").over(Window.partitionBy(key)).alias(f"_top_{a}") for a in peak],
        *[F.max(f"_high_{a}").over(past).alias(f"_high_{a}") for a in reach],
    )


def _row(values: Mapping[str, Column]) -> Column:
    return F.struct(*[c.alias(a) for a, c in values.items()]) if values else F.lit(True)

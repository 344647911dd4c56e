"""Type-2 histories: change detection, versioning, currency and validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.clean import default_false
from tidemark.functions.ids import hash_id, version_id
from tidemark.operators.keyed import CELL, Cuts, ordered
from tidemark.operators.staging import in_lists
from tidemark.spec import HistorySpec

NEEDED = "needs_scd_record"


def prev(column: str) -> str:
    return f"prev_{column}"


def changed(kind: T.DataType, now: Column, before: Column) -> Column:
    """TRUE on a change; a change *to* NULL is no change, a change *from* NULL is one."""
    if isinstance(kind, T.StringType):
        return now != F.coalesce(before, F.lit(""))
    return now.isNotNull() & (before.isNull() | (now != before))


def watched(spec: HistorySpec, track_deletes: bool) -> list[str]:
    """The columns whose change opens a version."""
    return [*spec.tracked, *([spec.deleted] if track_deletes else [])]


def _opens(df: DataFrame, spec: HistorySpec, track_deletes: bool, now, before) -> Column:
    """Whether a row differs from the one before; ``now`` and ``before`` give a column's values."""
    flag = F.when(F.lit(False), True)
    for c in spec.tracked:
        flag = flag.when(changed(df.schema[c].dataType, now(c), before(c)), True)
    if track_deletes:
        flag = flag.when(now(spec.deleted) != before(spec.deleted), True)
    return flag.otherwise(False)


def detect_changes(
    df: DataFrame,
    spec: HistorySpec,
    cuts: Cuts | None = None,
    track_deletes: bool = False,
) -> DataFrame:
    """Flag rows that open a version: the first of a key, and any with a tracked change.

    Adds ``rn``, the values on the key's row before, and the flag.
    ``track_deletes`` also opens a version when the delete marker flips.
    """
    seen = ordered(
        df,
        spec.key,
        spec.order(df.columns),
        lag={prev(c): F.col(c) for c in [*spec.tracked, spec.ts, *([spec.deleted] if track_deletes else [])]},
        number="rn",
        cuts=cuts,
    )
    flag = _opens(seen, spec, track_deletes, F.col, lambda c: F.col(prev(c)))
    return seen.withColumn(NEEDED, (F.col("rn") == 1) | flag)


def change_feed(
    df: DataFrame, spec: HistorySpec, cuts: Cuts | None = None, track_deletes: bool = False
) -> DataFrame:
    """Only the version-opening rows, each with its values before the change."""
    return detect_changes(df, spec, cuts, track_deletes).filter(NEEDED).drop(NEEDED)


def required_and_valid(df: DataFrame, spec: HistorySpec) -> DataFrame:
    return in_lists(df.dropna(subset=[spec.key, *spec.required, spec.ts]), spec.valid)


def is_current(ts: Column, latest: Column, deleted: Column) -> Column:
    """A version is current when it is the key's latest and not deleted."""
    return F.when(deleted, False).when(ts == latest, True).otherwise(False)


def currency(key: str, ts: str, deleted: str) -> Column:
    """The same as a reusable window expression over the whole key."""
    whole = (
        Window.partitionBy(key)
        .orderBy(ts)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return is_current(F.col(ts), F.max(ts).over(whole), F.col(deleted))


def ensure_currency(df: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """Recompute the current flag of a stored history."""
    if cuts is None:
        return df.withColumn(spec.current, currency(spec.key, spec.ts, spec.deleted))
    latest = ordered(df, spec.key, spec.order(df.columns), peak={"_latest": F.col(spec.ts)}, cuts=cuts)
    flag = is_current(F.col(spec.ts), F.col("_latest"), F.col(spec.deleted))
    return latest.withColumn(spec.current, flag).drop("_latest")


def number_versions(
    versions: DataFrame,
    spec: HistorySpec,
    cuts: Cuts | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Turn version-opening rows into dimension rows: ids, sequence and current flag."""
    rows = versions.withColumn(spec.deleted, default_false(spec.deleted))
    numbered = ordered(
        rows,
        spec.key,
        spec.order(rows.columns),
        number=spec.sequence,
        peak={"_latest": F.col(spec.ts)},
        cuts=cuts,
    )
    return dimension_rows(numbered, rows.columns, spec, now)


def dimension_rows(numbered: DataFrame, payload: Sequence[str], spec: HistorySpec, now) -> DataFrame:
    return numbered.select(
        hash_id(numbered, [spec.key, spec.ts]).alias(spec.surrogate),
        *payload,
        is_current(F.col(spec.ts), F.col("_latest"), F.col(spec.deleted)).alias(spec.current),
        (F.current_timestamp() if now is None else now).alias(spec.stamp),
        version_id(numbered, spec.key, spec.ts, spec.tracked, spec.deleted).alias(spec.version_id),
        spec.sequence,
    )


def scd2_build(
    df: DataFrame,
    spec: HistorySpec,
    cuts: Cuts | None = None,
    filter_first: bool = False,
    track_deletes: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """The whole Type-2 history of ``df``.

    Change detection and numbering share one shuffle and one sort on the key.
    Rows with values outside ``spec.valid`` take part in both and are left out at
    the end, so a key whose latest version is invalid has no current row; pass
    ``filter_first`` to leave them out at the start instead.

    Keys that fill whole segments go a way of their own, the others are not held up by it.
    """
    # A row without a key belongs to no history; all of them would meet in one task.
    df = df.filter(F.col(spec.key).isNotNull())
    if filter_first:
        df = required_and_valid(df, spec)
    light = df
    if cuts is not None:
        heavy, light = cuts.split(df, spec.key)
    versions = change_feed(light, spec, track_deletes=track_deletes).select(*df.columns)
    dim = number_versions(versions, spec, now=now)
    if cuts is not None:
        dim = dim.unionByName(_build_cut(heavy, spec, cuts, track_deletes, now))
    return required_and_valid(dim, spec)


def _build_cut(heavy: DataFrame, spec: HistorySpec, cuts: Cuts, track_deletes: bool, now) -> DataFrame:
    """Versions of cut keys by a segmented scan: one shuffle and one sort by (key, segment).

    A segment can't tell whether its first row opens a version, all others it can.  Its
    summary is its first and last row and the versions it is sure of; composing the
    summaries in order settles the first rows, the numbers and the latest times.
    """
    order, look = spec.order(heavy.columns), watched(spec, track_deletes)
    rows = cuts.place(cuts.once(heavy, spec.key, order), spec.key, order)
    by = Window.partitionBy(spec.key, CELL).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    seen = rows.withColumns({"_at": F.row_number().over(by), **{prev(c): F.lag(c).over(by) for c in look}})
    flag = _opens(seen, spec, track_deletes, F.col, lambda c: F.col(prev(c)))
    seen = seen.withColumn(NEEDED, (F.col("_at") > 1) & flag)
    edge = F.struct(*look, spec.ts)
    summaries = seen.groupBy(spec.key, CELL).agg(
        F.min_by(edge, "_at").alias("_head"), F.max_by(edge, "_at").alias("_tail"),
        F.count_if(NEEDED).alias("_sure"), F.max(F.when(F.col(NEEDED), F.col(spec.ts))).alias("_last"),
    )
    # From here on one row a segment.
    line = Window.partitionBy(spec.key).orderBy(CELL)
    carried = summaries.withColumn("_before", F.lag("_tail").over(line))
    differs = _opens(heavy, spec, track_deletes, lambda c: F.col("_head")[c], lambda c: F.col("_before")[c])
    carried = carried.withColumn("_opens", F.col("_before").isNull() | differs)
    total = F.col("_sure") + F.col("_opens").cast("bigint")
    latest = F.greatest("_last", F.when(F.col("_opens"), F.col("_head")[spec.ts]))
    carried = carried.select(
        spec.key, CELL, "_opens",
        F.coalesce(F.sum(total).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_skip"),
        F.max(latest).over(Window.partitionBy(spec.key)).alias("_latest"),
    )
    found = seen.join(F.broadcast(carried), [spec.key, CELL])
    found = found.filter(F.when(F.col("_at") == 1, F.col("_opens")).otherwise(F.col(NEEDED)))
    number = (F.col("_skip") + F.row_number().over(by)).cast("int")
    numbered = found.withColumns({spec.deleted: default_false(spec.deleted), spec.sequence: number})
    return dimension_rows(numbered, heavy.columns, spec, now)


def preliminary_currency(versions: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """Diagnostics: current flag by "no later version", and how many of these a key has.

    Only one row of a key has no later one, so the count is 0 or 1.
    """
    order = spec.order(versions.columns)
    seen = ordered(versions, spec.key, order, lead={"_later": F.lit(True)}, cuts=cuts)
    live = F.col("_later").isNull() & ~F.col(spec.deleted)
    seen = seen.withColumn("preliminary_current", live).drop("_later")
    flag = F.when(F.col("preliminary_current"), 1).otherwise(0).cast("bigint")
    return ordered(seen, spec.key, order, peak={"current_record_count": flag}, cuts=cuts)


def version_tracking(df: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """Sequence, neighbouring version dates and is-latest for a history."""
    tracked = ordered(
        df.drop(spec.sequence),
        spec.key,
        spec.order([c for c in df.columns if c != spec.sequence]),
        lag={"previous_version_date": F.col(spec.ts)},
        lead={"next_version_date": F.col(spec.ts)},
        number=spec.sequence,
        peak={"_latest": F.col(spec.ts)},
        cuts=cuts,
    )
    return tracked.withColumn("is_latest_version", F.col(spec.ts) == F.col("_latest")).drop("_latest")


def with_validity(df: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """Half-open validity ``[effective_from, effective_to)``; open end is NULL."""
    out = ordered(
        df, spec.key, spec.order(df.columns), lead={"effective_to": F.col(spec.ts)}, cuts=cuts
    )
    return out.withColumn("effective_from", F.col(spec.ts))


def snapshot_by_timestamp(df: DataFrame, key: str, ts: str, cuts: Cuts | None = None) -> DataFrame:
    """A new version whenever the time advances, whatever the other columns say."""
    order = [ts, *sorted(c for c in df.columns if c not in (key, ts))]
    firsts = ordered(df, key, order, lag={"_before": F.col(ts)}, cuts=cuts)
    firsts = firsts.filter(F.col("_before").isNull() | (F.col("_before") != F.col(ts))).drop("_before")
    out = ordered(firsts, key, order, lead={"valid_to": F.col(ts)}, cuts=cuts)
    return out.withColumn("valid_from", F.col(ts))

"""Incremental maintenance of histories, as joins that leave the target unwritten.

``sources.tables`` applies the results to stored tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.times import moment
from tidemark.operators.history import (
    NEEDED,
    detect_changes,
    number_versions,
    required_and_valid,
    scd2_build,
)
from tidemark.operators.keyed import Cuts, match
from tidemark.session import written
from tidemark.spec import HistorySpec

BEGINNING = "1900-01-01 00:00:00"


def high_water_mark(target: DataFrame, ts: str, default: str | None = BEGINNING) -> DataFrame:
    """One row, one column: the latest time in the target."""
    mark = F.max(ts)
    if default is not None:
        mark = F.coalesce(mark, moment(target, ts, default))
    return target.agg(mark.alias("mark"))


def updated_keys(
    staged: DataFrame, target: DataFrame, spec: HistorySpec, per_key: bool = False
) -> DataFrame:
    """Keys with rows newer than the target.

    By default newer than the target's overall latest time, which overlooks a late
    row of a quiet key; ``per_key`` compares each key with its own latest time.
    """
    if not per_key:
        mark = high_water_mark(target, spec.ts).scalar()
        return staged.filter(F.col(spec.ts) > mark).select(spec.key).distinct()
    have = target.groupBy(spec.key).agg(F.max(spec.ts).alias("_have"))
    come = staged.groupBy(spec.key).agg(F.max(spec.ts).alias("_come"))
    newer = F.col("_have").isNull() | (F.col("_come") > F.col("_have"))
    return come.join(have, spec.key, "left").filter(newer).select(spec.key)


def close_versions(
    target: DataFrame,
    keys: DataFrame,
    spec: HistorySpec,
    rederived: DataFrame | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Current versions of ``keys``, marked not current.

    Versions that ``rederived`` produces again are left to it.  If ``keys`` has a
    column ``_until``, only versions older than that are closed.
    """
    old = _to_close(target, keys, spec)
    if rederived is not None:
        old = old.join(rederived.select(spec.version_id), spec.version_id, "left_anti")
    return old.withColumns(
        {spec.current: F.lit(False), spec.stamp: F.current_timestamp() if now is None else now}
    )


def _to_close(target: DataFrame, keys: DataFrame, spec: HistorySpec) -> DataFrame:
    current = target.filter(spec.current)
    if "_until" not in keys.columns:
        return current.join(keys, spec.key, "left_semi")
    return current.join(keys, spec.key).filter(F.col(spec.ts) < F.col("_until")).drop("_until")


def combine(closed: DataFrame, new: DataFrame, spec: HistorySpec) -> DataFrame:
    rows = closed.unionByName(new, allowMissingColumns=True)
    return rows.dropna(subset=[spec.key, *spec.required, spec.ts, spec.version_id])


def merge_on_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """MERGE: matched rows take ``update`` from the source, new rows are added.

    ``source`` must hold a key once; one full outer join on the key.
    """
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_s"))
    on = [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys]
    out = []
    for c in target.columns:
        old, new = F.col(f"_t_{c}"), F.col(f"_s_{c}") if c in source.columns else F.lit(None)
        first = F.when(F.col("_s"), new).otherwise(old) if c in update else F.when(F.col("_t"), old).otherwise(new)
        out.append(first.alias(c))
    return t.join(s, on, "full_outer").select(*out)


def merge_update_columns(spec: HistorySpec, seeded: bool = False) -> list[str]:
    """A seeded merge numbers the stored versions that follow a late row anew."""
    return [spec.current, spec.stamp] + [spec.sequence] * seeded


def seed_versions(
    target: DataFrame, staged: DataFrame, spec: HistorySpec, cuts: Cuts | None = None
) -> DataFrame:
    """For each staged key, the stored version in force just before its first staged row."""
    firsts = staged.groupBy(spec.key).agg(F.min(spec.ts).alias("_first"))
    before = match(target, firsts, spec.key, "inner", cuts).filter(F.col(spec.ts) < F.col("_first"))
    order = spec.order([c for c in target.columns if c != spec.sequence])
    kept = [c for c in target.columns if c != spec.key]
    latest = before.groupBy(spec.key).agg(
        F.max_by(F.struct(*kept), F.struct(spec.sequence, *order)).alias("_seed")
    )
    return latest.select(spec.key, *[F.col(f"_seed.{c}").alias(c) for c in kept])


def later_versions(
    target: DataFrame, staged: DataFrame, spec: HistorySpec, cuts: Cuts | None = None
) -> DataFrame:
    """The stored versions of each staged key from its first staged row on."""
    firsts = staged.groupBy(spec.key).agg(F.min(spec.ts).alias("_first"))
    return match(target, firsts, spec.key, "inner", cuts).filter(F.col(spec.ts) >= F.col("_first")).drop("_first")


def seeded_versions(
    staged: DataFrame,
    target: DataFrame,
    spec: HistorySpec,
    cuts: Cuts | None = None,
    track_deletes: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """Versions of a partial staging, continued from the stored history.

    Without the stored predecessor the first staged row of every key would pass
    for a new version.  The predecessor joins the change detection as a row of its
    own and leaves again; numbering goes on from its sequence.  Stored versions
    from the first staged row on take part like staged rows, so that late rows are
    compared with what follows them, and all are numbered anew.  A predecessor whose
    values are not valid was never stored and cannot take part, and a stored version
    that a late row makes redundant stays stored.
    """
    # Both are read more than once. Written, they also have no partitioning by key left: a union
    # whose sides all have one is zipped, and fails where their numbers of partitions differ.
    seeds = written(seed_versions(target, staged, spec, cuts), "seeds")
    later = written(later_versions(target, staged, spec, cuts).select(*staged.columns), "later")
    sides = [(seeds.select(*staged.columns), True), (later, False), (staged, False)]
    rows = reduce(DataFrame.unionByName, [side.withColumn("_seed", F.lit(seed)) for side, seed in sides])
    found = detect_changes(rows, spec, cuts, track_deletes)
    versions = found.filter(F.col(NEEDED) & ~F.col("_seed")).select(*staged.columns)
    if cuts is not None:
        # Numbering cut keys reads the versions twice.
        versions = written(versions, "versions")
    numbered = number_versions(versions, spec, cuts, now)
    base = seeds.select(spec.key, F.col(spec.sequence).alias("_base"))
    stored = target.groupBy(spec.key).agg(F.max(spec.ts).alias("_stored"))
    overtaken = F.coalesce(F.col("_stored") > F.col(spec.ts), F.lit(False))
    known = base.join(stored, spec.key, "full_outer")
    return (
        match(numbered, known, spec.key, "left", cuts)
        .withColumns(
            {
                spec.sequence: (F.col(spec.sequence) + F.coalesce("_base", F.lit(0))).cast("int"),
                spec.current: F.col(spec.current) & ~overtaken,
            }
        )
        .select(*numbered.columns)
    )


def derive(
    target: DataFrame,
    staged: DataFrame,
    spec: HistorySpec,
    cuts: Cuts | None = None,
    seeded: bool = False,
    per_key: bool = False,
    keys: DataFrame | None = None,
    now: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(versions of the updated keys, keys whose current version is to be closed).

    Versions are derived for updated keys only; the other keys' cannot differ.
    ``keys`` are the updated keys if they are known.  ``seeded`` is for a staging that holds just the recent rows of a key: there a
    key is closed only when it got a later version.
    """
    keys = updated_keys(staged, target, spec, per_key) if keys is None else keys
    rows = match(staged, keys, spec.key, "left_semi", cuts)
    if not seeded:
        return scd2_build(rows, spec, cuts, now=now), keys
    new = seeded_versions(rows, target, spec, cuts, now=now)
    later = new.groupBy(spec.key).agg(F.max(spec.ts).alias("_until"))
    return required_and_valid(new, spec), later


def scd2_changes(target: DataFrame, staged: DataFrame, spec: HistorySpec, **options) -> DataFrame:
    """What an incremental pass has to merge: closed old versions and derived ones.

    Options as for :func:`derive`.
    """
    new, closing = derive(target, staged, spec, **options)
    return combine(close_versions(target, closing, spec, new, options.get("now")), new, spec)


def scd2_merge(target: DataFrame, staged: DataFrame, spec: HistorySpec, **options) -> DataFrame:
    """The target after an incremental pass over ``staged``; options as for :func:`derive`.

    Equal to merging :func:`scd2_changes`, but the versions are derived once: the
    target meets the ids to close and the derived versions on the same version
    id, so it is shuffled once.
    """
    new, keys = derive(target, staged, spec, **options)
    now = options.get("now")
    stamp = F.current_timestamp() if now is None else now
    closing = closing_ids(target, keys, spec)
    closed = target.join(closing, spec.version_id, "left").withColumns(
        {
            spec.current: F.col(spec.current) & F.col("_close").isNull(),
            spec.stamp: F.when(F.col("_close"), stamp).otherwise(F.col(spec.stamp)),
        }
    )
    return merge_on_key(
        closed.select(*target.columns), new, [spec.version_id], merge_update_columns(spec, options.get("seeded", False))
    )


def closing_ids(target: DataFrame, keys: DataFrame, spec: HistorySpec) -> DataFrame:
    """Ids of the current versions of ``keys``, marked ``_close``."""
    old = _to_close(target, keys, spec).dropna(subset=[spec.key, *spec.required])
    return old.select(spec.version_id, F.lit(True).alias("_close"))


def merge_stats(target: DataFrame, changes: DataFrame, spec: HistorySpec) -> DataFrame:
    """Counts of a merge: versions created, versions whose flag moves, delete versions."""
    have = target.select(spec.version_id, F.col(spec.current).alias("_was"))
    pairs = changes.select(spec.version_id, spec.current, spec.deleted).join(have, spec.version_id, "left")
    new = F.col("_was").isNull()
    return pairs.agg(
        F.count_if(new & ~F.col(spec.deleted)).alias("records_created"),
        F.count_if(~new & (F.col("_was") != F.col(spec.current))).alias("records_updated"),
        F.count_if(new & F.col(spec.deleted)).alias("records_deleted"),
    )


def upsert_latest(target: DataFrame, source: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per key, the latest by ``ts``; at equal times the source's.

    An aggregate with map-side combine rather than a per-key sort.
    """
    rows = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)))
    rest = [c for c in target.columns if c != key]
    order = [ts, "_new", *sorted(c for c in rest if c != ts)]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in target.columns])


# The second, simpler dimension: every staged row is an interval of its own.


def dim_full(staged: DataFrame, ts: str = "lastmodifieddate") -> DataFrame:
    return staged.withColumns(
        {
            "dwh_start_ts": F.col(ts),
            "dwh_end_ts": F.lit(None).cast(staged.schema[ts].dataType),
            "dwh_active_flag": F.lit(True),
        }
    )


def first_difference(source: DataFrame, key: str, ts: str, tracked: Sequence[str]) -> DataFrame:
    """Per key and tracked column: the earliest value with its time, and the earliest
    time of any other value.

    Enough to tell, for any given value, when the source first differs from it.  Values
    keep their types, so that equal decimals of another scale are equal.  Of each value a
    map task sends its earliest time, and of these the two earliest: no task has to order
    the rows of a key.
    """
    kind = {c: source.schema[c].dataType for c in tracked}
    held = lambda c: F.struct(
        F.lit(c).alias("_column"), *[(F.col(x) if x == c else F.lit(None).cast(kind[x])).alias(f"_v_{x}") for x in tracked]
    )
    long = source.select(key, F.col(ts).alias("_ts"), F.explode(F.array(*map(held, tracked))).alias("_r")).select(key, "_ts", "_r.*")
    there = reduce(lambda a, b: a | b, [F.col(f"_v_{c}").isNotNull() for c in tracked])
    values = [f"_v_{c}" for c in tracked]
    firsts = long.filter(there).groupBy(key, "_column", *values).agg(F.min("_ts").alias("_ts"))
    w = Window.partitionBy(key, "_column").orderBy("_ts", *values)
    two = firsts.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    aggs = []
    for c in tracked:
        mine = F.col("_column") == c
        aggs.append(F.min(F.when(mine & (F.col("_rn") == 1), F.col(f"_v_{c}"))).alias(f"_value_{c}"))
        aggs.append(F.min(F.when(mine & (F.col("_rn") == 1), F.col("_ts"))).alias(f"_first_{c}"))
        aggs.append(F.min(F.when(mine & (F.col("_rn") == 2), F.col("_ts"))).alias(f"_other_{c}"))
    return two.groupBy(key).agg(*aggs)


def changed_active_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str = "lastmodifieddate",
    active: str = "dwh_active_flag",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Active target rows for which the source holds a differing row, with the first such time.

    The same rows as joining target and source on the key with ``t.a != s.a or
    t.b != s.b``, but against one source row per key, so no pairs are formed.
    """
    ended = _closing(target.filter(active), source, key, tracked, ts, cuts)
    return ended.filter(F.col("changed_at").isNotNull())


def _closing(rows, source, key: str, tracked: Sequence[str], ts: str, cuts: Cuts | None) -> DataFrame:
    per_key = first_difference(source, key, ts, tracked)
    times = [
        F.when(F.col(c) != F.col(f"_value_{c}"), F.col(f"_first_{c}")).when(
            F.col(c).isNotNull(), F.col(f"_other_{c}")
        )
        for c in tracked
    ]
    at = F.least(*times) if len(times) > 1 else times[0]
    joined = match(rows, per_key, key, "left", cuts).withColumn("changed_at", at)
    return joined.select(*rows.columns, "changed_at")


def newer_than_target(staged: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Staged rows past the target's latest time; an empty target matches nothing."""
    return staged.filter(F.col(ts) > high_water_mark(target, ts, default=None).scalar())


def dim_changes(
    target: DataFrame,
    staged: DataFrame,
    key: str = "id",
    ts: str = "lastmodifieddate",
    tracked: Sequence[str] = ("division", "audit_phase__c"),
    cuts: Cuts | None = None,
) -> DataFrame:
    """Closed rows and inserted rows of one incremental pass."""
    latest = newer_than_target(staged, target, ts)
    closed = changed_active_rows(target, latest, key, tracked, ts, cuts=cuts)
    closed = closed.withColumns({"dwh_end_ts": F.col("changed_at"), "dwh_active_flag": F.lit(False)})
    return closed.drop("changed_at").unionByName(dim_full(latest, ts))


def dim_merge(
    target: DataFrame,
    staged: DataFrame,
    key: str = "id",
    ts: str = "lastmodifieddate",
    tracked: Sequence[str] = ("division", "audit_phase__c"),
    cuts: Cuts | None = None,
) -> DataFrame:
    """The target after an incremental pass: rows closed in place, new rows added.

    Inserts are later than every stored row and cannot match one, so no outer
    join is needed.
    """
    latest = newer_than_target(staged, target, ts)
    ended = _closing(target, latest, key, tracked, ts, cuts)
    close = F.col("dwh_active_flag") & F.col("changed_at").isNotNull()
    kept = ended.withColumns(
        {
            "dwh_end_ts": F.when(close, F.col("changed_at")).otherwise(F.col("dwh_end_ts")),
            "dwh_active_flag": F.col("dwh_active_flag") & ~close,
        }
    )
    return kept.drop("changed_at").unionByName(dim_full(latest, ts))

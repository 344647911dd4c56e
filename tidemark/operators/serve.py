"""Questions asked of a history: current rows, one key, a point in time, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.times import moment
from tidemark.operators.keyed import find_cuts, ordered
from tidemark.spec import HistorySpec


def current(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    return dim.filter(F.col(spec.current) & ~F.col(spec.deleted))


def history_of(dim: DataFrame, spec: HistorySpec, key_value) -> DataFrame:
    """One key's versions in order."""
    return dim.filter(F.col(spec.key) == F.lit(key_value)).orderBy(spec.sequence)


def change_analysis(dim: DataFrame, spec: HistorySpec, column: str) -> DataFrame:
    """How often, first and last when, a value was changed to; most frequent first."""
    return (
        dim.filter(F.col(spec.sequence) > 1)
        .groupBy(column)
        .agg(
            F.count(F.lit(1)).alias("change_count"),
            F.min(spec.ts).alias("first_change"),
            F.max(spec.ts).alias("last_change"),
        )
        .orderBy(F.col("change_count").desc(), column)
    )


def state_at(dim: DataFrame, spec: HistorySpec, at) -> DataFrame:
    """The version of each key in force at a time.

    One aggregate with map-side combine: the last version up to then, and the first
    time after it.  A history that carries its validity is only filtered.
    """
    when = moment(dim, spec.ts, at)
    if "effective_to" in dim.columns:
        ended = F.col("effective_to").isNull() | (F.col("effective_to") > when)
        return dim.filter((F.col("effective_from") <= when) & ended)
    started, rest = F.col(spec.ts) <= when, [c for c in dim.columns if c != spec.key]
    order = F.struct(*[F.col(c) for c in spec.order(dim.columns)])
    found = dim.groupBy(spec.key).agg(
        F.max_by(F.struct(*rest), F.when(started, order)).alias("_version"),
        F.min(F.when(F.col(spec.ts) > when, F.col(spec.ts))).alias("effective_to"),
    )
    out = found.filter(F.col("_version").isNotNull())
    out = out.select(*[F.col(c) if c == spec.key else F.col(f"_version.{c}").alias(c) for c in dim.columns], "effective_to")
    return out.withColumn("effective_from", F.col(spec.ts))


def as_of(
    facts: DataFrame,
    dim: DataFrame,
    spec: HistorySpec,
    fact_key: str,
    fact_ts: str,
    columns: Sequence[str],
    segments: int | None = None,
) -> DataFrame:
    """Each fact with ``columns`` of the version in force at its time (NULL before the first).

    Facts and versions are merged into one time line per key and the last version
    is carried forward: work is linear in both, no fact-version pairs are formed.
    Keys whose part of the time line fills whole segments are scanned in segments;
    only the versions are summarised for that. Both sides are read twice: give stored
    tables. Facts that are equal in every column share a segment.
    """
    order = spec.order(dim.columns)
    versions = dim.select(
        F.col(spec.key).alias("_k"),
        F.col(spec.ts).alias("_t"),
        F.lit(0).alias("_fact"),
        # Versions at one time are ordered as everywhere else; facts come after them.
        F.struct(*[F.col(c) for c in order[1:]]).alias("_tie"),
        F.lit(None).cast("bigint").alias("_salt"),
        F.struct(*[F.col(c) for c in columns]).alias("_version"),
    )
    keyed = facts.filter(F.col(fact_key).isNotNull())
    asked = keyed.select(
        F.col(fact_key).alias("_k"),
        F.col(fact_ts).alias("_t"),
        F.lit(1).alias("_fact"),
        # Facts of one time have no order of their own; by their hash they can be cut too.
        F.xxhash64(*[F.col(c) for c in facts.columns]).alias("_salt"),
        F.struct(*[F.col(c) for c in facts.columns]).alias("_row"),
    )
    line = versions.unionByName(asked, allowMissingColumns=True)
    order = ["_t", "_fact", "_tie", "_salt"]
    cuts = find_cuts(line, "_k", order, segments)
    filled = ordered(line, "_k", order, fill={"_found": F.col("_version")}, cuts=cuts, summary_of=line.filter(F.col("_fact") == 0))
    found = filled.filter(F.col("_fact") == 1).select(
        *[F.col(f"_row.{c}").alias(c) for c in facts.columns],
        *[F.col(f"_found.{c}").alias(c) for c in columns],
    )
    # Facts without a key match nothing; keep them out of the shuffle.
    lone = facts.filter(F.col(fact_key).isNull())
    return found.unionByName(lone, allowMissingColumns=True)


def table_counts(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(spec.current)).alias("current_records"),
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def scd_statistics(dim: DataFrame, spec: HistorySpec, name: str = "sf_user_scd") -> DataFrame:
    """One row of totals for monitoring."""
    live, now = ~F.col(spec.deleted), F.col(spec.current)
    return dim.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct(spec.key).alias("unique_users"),
        F.count_if(now & live).alias("current_active_records"),
        F.count_if(~now & live).alias("historical_records"),
        F.count_if(F.col(spec.deleted)).alias("deleted_records"),
        F.min(spec.ts).alias("earliest_record_date"),
        F.max(spec.ts).alias("latest_record_date"),
        F.max(spec.stamp).alias("last_dbt_run"),
    ).select(F.lit(name).alias("table_name"), "*")


def performance_metrics(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    """One row of ratios over the live versions."""
    n, keys = F.count(F.lit(1)), F.countDistinct(spec.key)
    valid = {
        f"valid_{c.removesuffix('__c')}_ratio": F.try_divide(F.count_if(F.col(c).isin(*v)), n)
        for c, v in spec.valid.items()
    }
    got = dim.filter(~F.col(spec.deleted)).agg(
        n.alias("total_records"),
        keys.alias("unique_users"),
        F.avg(spec.sequence).alias("avg_versions_per_user"),
        F.max(spec.sequence).cast("bigint").alias("max_versions_per_user"),
        F.min(spec.ts).alias("earliest_record"),
        F.max(spec.ts).alias("latest_record"),
        F.count_if(F.col(spec.current)).alias("_current"),
        *[c.alias(a) for a, c in valid.items()],
    )
    span = F.expr("cast(extract(day from (latest_record - earliest_record)) as bigint)")
    return got.select(
        "total_records",
        "unique_users",
        F.round("avg_versions_per_user", 2).alias("avg_versions_per_user"),
        "max_versions_per_user",
        span.alias("date_range_days"),
        F.round(F.try_divide("total_records", "unique_users"), 2).alias("avg_scd_records_per_user"),
        F.round(F.try_divide("_current", "unique_users"), 4).alias("current_records_ratio"),
        *[F.round(a, 4).alias(a) for a in valid],
    )


def performance_json(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    got = performance_metrics(dim, spec)
    return got.select(
        F.lit("performance_metrics").alias("metric_category"),
        F.to_json(F.struct(*got.columns)).alias("metrics"),
    )

"""Quality and integrity checks; a check returns the rows (or keys) that break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clean import is_blank
from tidemark.functions.times import moment, whole_days
from tidemark.operators.history import prev
from tidemark.operators.keyed import Cuts, ordered
from tidemark.spec import HistorySpec


def _live_current(spec: HistorySpec) -> Column:
    return F.col(spec.current) & ~F.col(spec.deleted)


# Integrity of a history. Counting checks aggregate map-side, so hot keys are safe.


def multiple_current(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    return (
        dim.filter(_live_current(spec))
        .groupBy(spec.key)
        .agg(F.count(F.lit(1)).alias("current_record_count"))
        .filter(F.col("current_record_count") > 1)
    )


def not_exactly_one_current(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    """Strict form; also reports keys without a current row, deleted ones included."""
    return (
        dim.groupBy(spec.key)
        .agg(
            F.count_if(_live_current(spec)).alias("current_record_count"),
            F.count(F.lit(1)).alias("total_versions"),
            F.max(spec.ts).alias("latest_update_date"),
            F.count_if(_live_current(spec)).alias("active_current_count"),
        )
        .filter((F.col("current_record_count") != 1) | (F.col("active_current_count") > 1))
    )


def missing_current(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys with live versions, latest one not a delete, but no current row."""
    by_time = F.struct(spec.ts, ~F.col(spec.deleted))
    return (
        dim.groupBy(spec.key)
        .agg(
            F.count_if(_live_current(spec)).alias("current_record_count"),
            F.max_by(spec.deleted, by_time).alias("_gone"),
            F.max(spec.ts).alias("latest_update_date"),
        )
        .filter((F.col("current_record_count") == 0) & ~F.col("_gone"))
        .drop("_gone", "current_record_count")
    )


def deleted_current(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    return dim.filter(F.col(spec.deleted) & F.col(spec.current))


def duplicate_ids(dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    return unique(dim, columns)


def sequence_gaps(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys whose sequence is not 1..n."""
    return (
        dim.groupBy(spec.key)
        .agg(
            F.count(F.lit(1)).alias("total_versions"),
            F.max(spec.sequence).cast("bigint").alias("last_sequence"),
        )
        .filter(F.col("total_versions") != F.col("last_sequence"))
    )


def current_not_latest(dim: DataFrame, spec: HistorySpec) -> DataFrame:
    """Current rows that are older than their key's latest version."""
    latest = dim.groupBy(spec.key).agg(F.max(spec.ts).alias("latest_update_date"))
    return (
        dim.filter(spec.current)
        .join(latest, spec.key)
        .filter(F.col(spec.ts) < F.col("latest_update_date"))
    )


def history_gaps(dim: DataFrame, spec: HistorySpec, days: int = 1, cuts: Cuts | None = None) -> DataFrame:
    """Neighbouring live versions more than ``days`` whole days apart."""
    live = dim.filter(~F.col(spec.deleted)).select(spec.key, spec.ts, spec.current, spec.deleted)
    before = prev(spec.ts)
    seen = ordered(live, spec.key, [spec.ts], lag={before: F.col(spec.ts)}, cuts=cuts)
    return (
        seen.withColumn("days_gap", whole_days(spec.ts, before))
        .filter(F.col("days_gap") > days)
        .select(spec.key, spec.ts, before, "days_gap")
    )


def unchanged_versions(dim: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """Live versions after the first in which no tracked column differs from the one before."""
    columns = [spec.key, spec.ts, *spec.tracked]
    live = dim.filter(~F.col(spec.deleted)).select(*columns)
    seen = ordered(
        live,
        spec.key,
        [spec.ts, *spec.tracked],
        lag={prev(c): F.col(c) for c in spec.tracked},
        number="rn",
        cuts=cuts,
    )
    same = F.col("rn") > 1
    for c in spec.tracked:
        same = same & (F.col(c) == F.coalesce(F.col(prev(c)), F.col(c)))
    return seen.filter(same)


def with_violation(df: DataFrame, rules: Sequence[tuple[str, Column]], column: str = "violation_type") -> DataFrame:
    """Name the first rule a row breaks; rows that break none are left out."""
    label = F.lit(None).cast("string")
    for name, broken in reversed(list(rules)):
        label = F.when(broken, name).otherwise(label)
    return df.withColumn(column, label).filter(F.col(column).isNotNull())


# The labels of the business rules.
RULE_LABELS = {"division": "Invalid Division", "audit_phase__c": "Invalid Audit Phase", "name": "Missing Name"}


def business_rules(dim: DataFrame, spec: HistorySpec, labels: Mapping[str, str] = RULE_LABELS) -> DataFrame:
    """Live rows with a value outside its list (NULL passes) or a missing required text."""
    rules = [(labels.get(c, f"Invalid {c}"), ~F.col(c).isin(*v)) for c, v in spec.valid.items()]
    rules += [(labels.get(c, f"Missing {c}"), is_blank(c)) for c in spec.required]
    live = dim.filter(~F.col(spec.deleted))
    return with_violation(live.select(spec.key, *spec.required, *spec.valid, spec.ts), rules)


def interval_overlaps(dim: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """Validity intervals that overlap an earlier one, follow a hole, or end before they begin.

    A sweep along each key by (effective_from, effective_to) that carries the greatest end
    so far, ``reached``; an open end is null and reaches everything.  An interval that
    begins before it overlaps, however far back the one that it overlaps lies; one that
    begins after it follows a hole.  Intervals without a point in time cover nothing.
    ``cuts`` are by this order.
    """
    start, end = F.col("effective_from"), F.col("effective_to")
    solid = end.isNull() | (end > start)
    # Open ends are the greatest.
    far = F.when(solid, F.struct(end.isNull().alias("open"), end.alias("end")))
    rows = dim.filter(start.isNotNull()).select(spec.key, "effective_from", "effective_to")
    seen = ordered(rows, spec.key, ["effective_from", "effective_to"], reach={"_far": far}, cuts=cuts)
    reached = F.col("_far.end")
    kind = (
        F.when(end < start, "inverted")
        .when(solid & (F.col("_far.open") | (reached > start)), "overlap")
        .when(solid & ~F.col("_far.open") & (reached < start), "gap")
    )
    return (
        seen.withColumn("problem", kind)
        .filter(F.col("problem").isNotNull())
        .select(spec.key, "effective_from", "effective_to", reached.alias("reached"), "problem")
    )


# Generic column checks.


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL counts of all columns from one pass: (column_name, null_count), offenders only."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return unpivot(counts, columns, "column_name", "null_count").filter(F.col("null_count") > 0)


def unpivot(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    parts = ", ".join(f"'{c}', `{c}`" for c in columns)
    return df.select(F.expr(f"stack({len(columns)}, {parts}) as ({name}, {value})"))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    rows = df if where is None else df.filter(where)
    for c in columns:
        rows = rows.filter(F.col(c).isNotNull())
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def dq_profile(
    df: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    max_null: float = 0.05,
    max_duplicate: float = 0.01,
    min_success: float = 0.95,
    digest: bool = False,
) -> DataFrame:
    """Null share per column, duplicate share of the key, and success rate, against limits.

    One row per measure: (measure, value, threshold, passed).  ``success_rate`` is
    the share of rows with no NULL in ``columns``.  ``digest`` is for keys that are
    long texts: their SHA-256 is shuffled in their place.
    """
    n = F.count(F.lit(1))
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    # Count the copies of every key first (map-side), then roll everything up.
    by = [F.sha2(F.col(c).cast("string"), 256).alias(f"_key_{c}") if digest else F.col(c) for c in key]
    per_key = df.groupBy(*by).agg(
        n.alias("_n"),
        F.count_if(complete).alias("_complete"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)],
    )
    total = F.sum("_n")
    one = per_key.agg(
        *[F.try_divide(F.sum(f"_null_{i}"), total).alias(f"null_share:{c}") for i, c in enumerate(columns)],
        F.try_divide(total - F.count(F.lit(1)), total).alias("duplicate_share"),
        F.try_divide(F.sum("_complete"), total).alias("success_rate"),
    )
    long = unpivot(one, one.columns, "measure", "value")
    limit = (
        F.when(F.col("measure") == "duplicate_share", max_duplicate)
        .when(F.col("measure") == "success_rate", min_success)
        .otherwise(max_null)
    )
    ok = F.when(F.col("measure") == "success_rate", F.col("value") >= limit).otherwise(F.col("value") <= limit)
    return long.select("measure", F.round("value", 6).alias("value"), limit.alias("threshold"), ok.alias("passed"))


def apply_rules(df: DataFrame, rules: Mapping[str, Sequence]) -> DataFrame:
    """Violation counts for ``{"required": [...], "unique": [...], "accepted": {col: [...]}}``.

    Required and accepted rules share one pass; each unique rule groups its column.
    """
    aggs, names = [], []
    for c in rules.get("required", ()):
        names.append(f"required:{c}")
        aggs.append(F.count_if(F.col(c).isNull()))
    for c, values in dict(rules.get("accepted", {})).items():
        names.append(f"accepted:{c}")
        aggs.append(F.count_if(~F.col(c).isin(*values)))
    reports = []
    if aggs:
        one = df.agg(*[a.alias(n) for a, n in zip(aggs, names)])
        reports.append(unpivot(one, names, "rule", "violations"))
    for c in rules.get("unique", ()):
        n = unique(df, [c]).agg(F.count(F.lit(1)).alias("violations"))
        reports.append(n.select(F.lit(f"unique:{c}").alias("rule"), "violations"))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out.withColumn("passed", F.col("violations") == 0)


# Freshness and volume.


def freshness(raw: DataFrame, extracted: str, as_of, max_age_hours: int = 6) -> DataFrame:
    """Latest extraction and rows of the last day before ``as_of``; stale when too old."""
    now = moment(raw, extracted, as_of)
    day = raw.filter((F.col(extracted) >= now - F.expr("interval 1 day")) & (F.col(extracted) <= now))
    got = day.agg(F.max(extracted).alias("latest_extraction"), F.count(F.lit(1)).alias("total_records"))
    fresh = F.col("latest_extraction") >= now - F.expr(f"interval {int(max_age_hours)} hours")
    return got.withColumn("is_stale", ~F.coalesce(fresh, F.lit(False)))


def min_records(df: DataFrame, minimum: int = 100) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("record_count"))
    return n.select("record_count", F.lit(minimum).cast("bigint").alias("minimum"), (F.col("record_count") >= minimum).alias("passed"))


def partition_count(raw: DataFrame, column: str, value: str) -> DataFrame:
    """Rows of one partition; reads no other partition."""
    return raw.filter(F.col(column) == value).agg(F.count(F.lit(1)).alias("record_count"))


def batch_guard(df: DataFrame, limit: int = 50_000) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("record_count"))
    return n.select("record_count", F.lit(limit).cast("bigint").alias("batch_limit"), (F.col("record_count") <= limit).alias("passed"))


def volume_anomaly(
    runs: DataFrame, series: str, order: str, count: str, low: int = 4_000, high: int = 6_000, percent: float = 20.0
) -> DataFrame:
    """Runs outside the expected range, or too far from the run of their ``series`` before.

    ``runs`` is one row per run; each series, say a job, is followed apart.
    """
    seen = ordered(runs, series, [order], lag={"previous_count": F.col(count)})
    before = F.col("previous_count")
    shift = F.try_divide(F.abs(F.col(count) - before) * 100.0, before)
    return seen.select(
        *runs.columns,
        "previous_count",
        F.round(shift, 4).alias("deviation_pct"),
        (~F.col(count).between(low, high)).alias("out_of_range"),
        F.coalesce(shift > percent, F.lit(False)).alias("deviates"),
    )


def volume_baseline(
    runs: DataFrame, series: str, at: str, count: str, spread: float = 1.5, least: float = 1.0
) -> DataFrame:
    """Runs far from what is usual for their series on that day of the week.

    Usual is the median, far more than ``spread`` times the distance of the quartiles, or
    ``least`` rows if that is more.  Quartiles come from histograms of counts that are
    merged map-side; nothing is ordered.
    """
    day = F.dayofweek(at).alias("weekday")
    quartiles = [F.percentile(count, q).alias(name) for q, name in ((0.25, "_low"), (0.5, "usual"), (0.75, "_high"))]
    base = runs.filter(F.col(count).isNotNull()).groupBy(F.col(series).alias("_series"), day).agg(*quartiles)
    base = base.select("_series", "weekday", "usual", (F.col("_high") - F.col("_low")).alias("spread"))
    same = F.col(series).eqNullSafe(F.col("_series")) & F.col("_day").eqNullSafe(F.col("weekday"))
    seen = runs.withColumn("_day", F.dayofweek(at)).join(base, same, "left")
    far = F.abs(F.col(count) - F.col("usual")) > F.greatest(spread * F.col("spread"), F.lit(float(least)))
    return seen.select(*runs.columns, "usual", "spread", F.coalesce(far, F.lit(False)).alias("unusual"))


# Scores, quarantine and the gate.


def any_broken(rules: Sequence[tuple[str, Column]]) -> Column:
    broken = F.lit(False)
    for _, rule in rules:
        broken = broken | F.coalesce(rule, F.lit(False))
    return broken


def quality_scores(
    staged: DataFrame, rules: Sequence[tuple[str, Column]], dim: DataFrame, spec: HistorySpec
) -> DataFrame:
    """``DataQualityScore``: percent of rows breaking no rule.
    ``SCDIntegrityScore``: percent of keys with exactly one current row."""
    data = staged.agg(
        F.lit("DataQualityScore").alias("metric"),
        F.round(100 * (1 - F.try_divide(F.count_if(any_broken(rules)), F.count(F.lit(1)))), 4).alias("score"),
    )
    per_key = dim.groupBy(spec.key).agg(F.count_if(_live_current(spec)).alias("n"))
    scd = per_key.agg(
        F.lit("SCDIntegrityScore").alias("metric"),
        F.round(100 * (1 - F.try_divide(F.count_if(F.col("n") != 1), F.count(F.lit(1)))), 4).alias("score"),
    )
    return data.unionByName(scd)


def with_reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """``reject_reason`` is the first rule broken, NULL for accepted rows."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(list(rules)):
        reason = F.when(broken, name).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def quarantine(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reason)."""
    marked = with_reject_reason(df, rules)
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())


def reject_rate(df: DataFrame, rules: Sequence[tuple[str, Column]], max_percent: float = 5.0) -> DataFrame:
    """Whether a batch may go on: rejected share against the limit, one row."""
    n = F.count(F.lit(1))
    got = df.agg(n.alias("total"), F.count_if(any_broken(rules)).alias("rejected"))
    rate = F.coalesce(F.try_divide(F.col("rejected") * 100.0, F.col("total")), F.lit(0.0))
    return got.select("total", "rejected", F.round(rate, 4).alias("rejected_pct"), (rate <= max_percent).alias("batch_accepted"))


class QualityGateClosed(RuntimeError):
    """Raised when a gated measure failed; ``measures`` names all of them."""

    def __init__(self, measures: Sequence[str]):
        super().__init__("failed: " + ", ".join(measures))
        self.measures = list(measures)


def gate(report: DataFrame, passed: str = "passed", name: str = "measure") -> None:
    """Go on only if every row of a small report passed; reads the report once."""
    failed = [str(r[0]) for r in report.filter(~F.col(passed)).select(name).orderBy(name).collect()]
    if failed:
        raise QualityGateClosed(failed)

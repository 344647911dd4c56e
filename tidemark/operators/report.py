"""Check suites and their reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clean import is_blank
from tidemark.functions.times import whole_days
from tidemark.operators.checks import QualityGateClosed
from tidemark.operators.history import prev
from tidemark.operators.keyed import Cuts, ordered
from tidemark.spec import HistorySpec

# The names and descriptions of the suite's lines.
SUITE = {
    "scd_integrity": "Each user should have exactly one current record",
    "scd_history_completeness": "SCD history should be complete without gaps",
    "tracked_field_changes": "SCD records should only be created when tracked fields change",
    "business_rules": "All business rules should be satisfied",
}
STATISTICS = "overall_statistics"


def union_reports(*reports: DataFrame) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def order_report(report: DataFrame, first: str = STATISTICS) -> DataFrame:
    return report.orderBy(F.when(F.col("test_name") == first, 1).otherwise(2), "test_name")


def count_violations(violations: DataFrame, name: str, description: str) -> DataFrame:
    return violations.agg(
        F.lit(name).alias("test_name"),
        F.count(F.lit(1)).alias("violation_count"),
        F.lit(description).alias("description"),
    )


COUNTS = ("live", "current", "gaps", "unchanged", "broken", "gone")


def scd_suite(dim: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """The four history checks and a statistics line, statistics first."""
    return suite_of(key_counts(dim, spec, cuts))


def key_counts(dim: DataFrame, spec: HistorySpec, cuts: Cuts | None = None) -> DataFrame:
    """What the suite counts, for each key: rows by kind and violations.

    The checks are not run one by one: a single pass over the per-key windows leaves all
    counts.  No check looks beyond a key, so the counts of other keys stay as they are
    when a merge changes some; see ``sources.kept``.
    """
    live = ~F.col(spec.deleted)
    columns = list(dict.fromkeys([spec.key, spec.ts, *spec.tracked, *spec.required, *spec.valid, spec.current, spec.deleted]))
    order = [spec.ts, *spec.tracked, spec.current]
    rows = dim.select(*columns)
    # Deleted rows do not take part in the neighbour checks, only in the totals.
    seen = ordered(
        rows.filter(live),
        spec.key,
        order,
        lag={"_ts": F.col(spec.ts), **{prev(c): F.col(c) for c in spec.tracked}},
        number="rn",
        cuts=cuts,
    )
    same = F.col("rn") > 1
    for c in spec.tracked:
        same = same & (F.col(c) == F.coalesce(F.col(prev(c)), F.col(c)))
    broken = F.lit(False)
    for c, values in spec.valid.items():
        broken = broken | F.coalesce(~F.col(c).isin(*values), F.lit(False))
    for c in spec.required:
        broken = broken | is_blank(c)
    now = F.count_if(F.col(spec.current))
    n = F.count(F.lit(1))
    of_live = seen.groupBy(spec.key).agg(
        n.alias("live"),
        now.alias("current"),
        F.count_if(whole_days(spec.ts, "_ts") > 1).alias("gaps"),
        F.count_if(same).alias("unchanged"),
        F.count_if(broken).alias("broken"),
        F.lit(0).cast("bigint").alias("gone"),
    )
    of_deleted = rows.filter(~live).groupBy(spec.key).agg(
        *[F.lit(0).cast("bigint").alias(c) for c in ("live", "current", "gaps", "unchanged", "broken")],
        n.alias("gone"),
    )
    return of_live.unionByName(of_deleted).groupBy(spec.key).agg(*[F.sum(c).alias(c) for c in COUNTS])


def integrity_score(per_key: DataFrame) -> DataFrame:
    """``SCDIntegrityScore``: percent of keys with exactly one current row."""
    wrong = F.try_divide(F.count_if(F.col("current") != 1), F.count(F.lit(1)))
    return per_key.agg(F.lit("SCDIntegrityScore").alias("metric"), F.round(100 * (1 - wrong), 4).alias("score"))


def suite_of(per_key: DataFrame) -> DataFrame:
    """The suite's lines as sums over :func:`key_counts`, which roll up to one row that is then unfolded."""
    zero = F.lit(0).cast("bigint")
    total = per_key.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col("current") > 1).alias("scd_integrity"),
        F.coalesce(F.sum("gaps"), zero).alias("scd_history_completeness"),
        F.coalesce(F.sum("unchanged"), zero).alias("tracked_field_changes"),
        F.coalesce(F.sum("broken"), zero).alias("business_rules"),
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("live", "gone")],
        F.coalesce(F.sum("current"), zero).alias("now"),
    )
    text = F.concat(
        F.lit("Total records: "), F.col("live") + F.col("gone"),
        F.lit(", Unique users: "), F.col("users"),
        F.lit(", Current records: "), F.col("now"),
        F.lit(", Historical records: "), F.col("live") - F.col("now"),
        F.lit(", Deleted records: "), F.col("gone"),
    )
    lines = [F.struct(F.lit(STATISTICS).alias("test_name"), zero.alias("violation_count"), text.alias("description"))]
    lines += [
        F.struct(F.lit(name).alias("test_name"), F.col(name).alias("violation_count"), F.lit(about).alias("description"))
        for name, about in SUITE.items()
    ]
    return order_report(total.select(F.explode(F.array(*lines)).alias("line")).select("line.*"))


def scd_report(suite: DataFrame, now: Column | None = None, report_type: str = "sf_user_scd_test_report") -> DataFrame:
    """The suite with time, type and status.

    The statistics line has no violations, so it reads PASS and never INFO.
    """
    bad = F.col("violation_count") > 0
    status = (
        F.when(F.col("violation_count") == 0, "PASS")
        .when(bad & (F.col("test_name") != STATISTICS), "FAIL")
        .otherwise("INFO")
    )
    return suite.select(
        (F.current_timestamp() if now is None else now).alias("report_generated_at"),
        F.lit(report_type).alias("report_type"),
        "test_name",
        "violation_count",
        status.alias("test_status"),
        "description",
    )


def suite_summary(results: DataFrame, success: Column) -> DataFrame:
    """Total, passed, failed and success rate in percent (0 for an empty suite)."""
    got = results.agg(F.count(F.lit(1)).alias("total_tests"), F.count_if(success).alias("passed"))
    rate = F.coalesce(F.try_divide(F.col("passed"), F.col("total_tests")) * 100, F.lit(0.0))
    return got.select(
        "total_tests",
        "passed",
        (F.col("total_tests") - F.col("passed")).alias("failed"),
        F.round(rate, 2).alias("success_rate"),
    )


def run_groups(
    groups: Mapping[str, tuple[str, Mapping[str, Callable[[], DataFrame]]]],
    critical: Sequence[str] = ("data_quality", "scd_integrity"),
) -> list[dict]:
    """Run groups of checks in order; a failed critical group of severity ``error`` ends the run.

    ``groups`` maps a name to ``(severity, {check name: function that returns the
    violating rows})``.  Each group is one Spark job; one count per check comes back.
    """
    results: list[dict] = []
    for group, (severity, checks) in groups.items():
        if not checks:
            continue
        counts = union_reports(*[count_violations(run(), name, "") for name, run in checks.items()])
        found = {r["test_name"]: r["violation_count"] for r in counts.collect()}
        for name in checks:
            results.append(
                {"test_name": name, "group": group, "severity": severity,
                 "violations": found[name], "success": found[name] == 0}
            )
        failed = any(not r["success"] for r in results if r["group"] == group)
        if failed and severity == "error" and group in critical:
            break
    return results


def require_success(report: DataFrame) -> None:
    """Raise if the report holds a FAIL line."""
    failed = report.filter(F.col("test_status") == "FAIL").select("test_name").orderBy("test_name").collect()
    if failed:
        raise QualityGateClosed([r[0] for r in failed])


__all__ = [
    "SUITE", "count_violations", "order_report", "require_success", "run_groups",
    "scd_report", "scd_suite", "suite_summary", "union_reports",
]

"""Metric series and alarms: tables of (metric, ts, value) in, tables out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.times import from_micros, micros, moment
from tidemark.session import small_table


@dataclass(frozen=True)
class AlarmRule:
    """One alarm: a statistic per period against a threshold.

    ``missing`` says how a period without data counts: "breaching" or "notBreaching".
    """

    alarm: str
    metric: str
    statistic: str
    period: int
    operator: str
    threshold: float
    periods: int = 1
    missing: str = "notBreaching"
    severity: str = "warning"


# The alarms of the monitored pipeline.
ALARMS = (
    AlarmRule("pipeline-failures", "ExecutionsFailed", "Sum", 300, ">=", 1),
    AlarmRule("pipeline-duration", "ExecutionTime", "Average", 300, ">", 3_600_000),
    AlarmRule("ingestion-failures", "NumFailedTasks", "Sum", 300, ">=", 1),
    AlarmRule("data-quality", "DataQualityScore", "Average", 300, "<", 95, 2, "breaching"),
    AlarmRule("scd-integrity", "SCDIntegrityScore", "Average", 300, "<", 98, 1, "breaching"),
    AlarmRule("record-volume", "RecordsProcessed", "Sum", 21_600, "<", 100, 1, "breaching"),
    AlarmRule("runner-errors", "RunnerErrors", "Sum", 300, ">=", 1),
    AlarmRule("validator-errors", "ValidatorErrors", "Sum", 300, ">=", 1),
)
# The alarms that make up overall health; volume and duration do not.
HEALTH_MEMBERS = (
    "pipeline-failures",
    "ingestion-failures",
    "data-quality",
    "scd-integrity",
    "runner-errors",
    "validator-errors",
)
# Duration limits in seconds.
DURATION_LIMITS = {"extraction": 1_800, "transformation": 900, "pipeline": 3_600}

STATISTICS = {"Sum": F.sum, "Average": F.avg}


def metric_windows(
    metrics: DataFrame, period: int, statistic: str, dims: Sequence[str] = (), ts: str = "ts"
) -> DataFrame:
    """One statistic per metric and tumbling window of ``period`` seconds.

    Partial sums are made before the shuffle, so a busy metric does not matter.
    Works on a stream as well, with a watermark on ``ts``.
    """
    return (
        metrics.groupBy("metric", *dims, F.window(ts, f"{int(period)} seconds").alias("w"))
        .agg(STATISTICS[statistic]("value").alias("value"))
        .select("metric", *dims, F.col("w.start").alias("window_start"), "value")
    )


def fill_missing(
    windows: DataFrame, period: int, start, end, names: Sequence[str] | None = None
) -> DataFrame:
    """Add the periods of ``[start, end)`` that have no data, with NULL value and ``missing``.

    ``names`` are the metrics expected; by default those that occur.
    """
    spark = windows.sparkSession
    if names is None:
        metrics = windows.select("metric").distinct()
    else:
        metrics = small_table(spark, [(n,) for n in names], "metric string")
    first, last = moment(windows, "window_start", start), moment(windows, "window_start", end)
    step = F.expr(f"interval {int(period)} seconds")
    spine = metrics.select("metric", F.explode(F.sequence(first, last - step, step)).alias("window_start"))
    return spine.join(windows, ["metric", "window_start"], "left").withColumn("missing", F.col("value").isNull())


def rule_table(spark, rules: Sequence[AlarmRule]) -> DataFrame:
    schema = (
        "alarm string, metric string, statistic string, period int, operator string, "
        "threshold double, periods int, missing string, severity string"
    )
    rows = [tuple({**asdict(r), "threshold": float(r.threshold)}.values()) for r in rules]
    return small_table(spark, rows, schema)


def evaluate_rules(windows: DataFrame, rules: Sequence[AlarmRule]) -> DataFrame:
    """Each window against each rule of its metric; ``breach`` by the rule's operator."""
    table = rule_table(windows.sparkSession, rules).withColumnRenamed("missing", "treat_missing")
    joined = windows.drop("missing").join(F.broadcast(table), "metric")
    return _judged(joined, "treat_missing").select(*STATE_COLUMNS)


STATE_COLUMNS = ("alarm", "metric", "window_start", "value", "operator", "threshold", "severity", "breach")


def _judged(rows: DataFrame, missing: str) -> DataFrame:
    value, limit = F.col("value"), F.col("threshold")
    breach = (
        F.when(value.isNull(), F.col(missing) == "breaching")
        .when(F.col("operator") == ">=", value >= limit)
        .when(F.col("operator") == ">", value > limit)
        .when(F.col("operator") == "<", value < limit)
    )
    return rows.withColumn("breach", breach)


def consecutive_breach(evals: DataFrame, n: int) -> DataFrame:
    """``in_alarm`` when the window and the ``n-1`` before it all breach."""
    w = Window.partitionBy("alarm").orderBy("window_start").rowsBetween(-(n - 1), 0)
    breaches = F.count_if(F.col("breach")).over(w)
    return evals.withColumn("in_alarm", breaches == n)


def alarm_states(
    metrics: DataFrame,
    rules: Sequence[AlarmRule],
    start,
    end,
    ts: str = "ts",
    dims: Sequence[str] = (),
    series: DataFrame | None = None,
    carried: DataFrame | None = None,
) -> DataFrame:
    """State of every alarm in every period of ``[start, end)``, for each value of ``dims`` apart.

    One pass for all rules: a row counts in one window of each period there is, and sums
    and counts meet in one map-side aggregate.  The rest is as long as the rules' periods.

    ``series`` are the dimension values that are watched, with or without data; by default
    those that a metric has.  ``carried`` are the :func:`streaks` of the evaluation up to
    ``start``: going on from them gives the states that one evaluation of both would give.
    With dimensions the states have a column ``streak``, the breaching periods up to each.
    """
    table = rule_table(metrics.sparkSession, rules)
    names, periods = sorted({r.metric for r in rules}), sorted({r.period for r in rules})
    first, last = moment(metrics, ts, start), moment(metrics, ts, end)
    wide = metrics.filter(F.col("metric").isin(names) & (F.col(ts) < last)).withColumn("_us", micros(metrics, ts))
    wide = wide.withColumn("period", F.explode(F.array(*[F.lit(p) for p in periods])))
    step = F.col("period").cast("bigint") * 1_000_000
    wide = wide.withColumn("_start", F.col("_us") - F.pmod(F.col("_us"), step))
    seen = wide.groupBy("metric", "period", *dims, "_start").agg(*[f("value").alias(f"_{name}") for name, f in STATISTICS.items()])
    watched = table
    if dims and series is not None:
        # As many rows a series as there are rules.
        each = F.array(*[F.struct(*[F.lit(v).cast(table.schema[c].dataType).alias(c) for c, v in asdict(r).items()]) for r in rules])
        watched = series.select(*dims).distinct().withColumn("_rule", F.explode(each)).select("_rule.*", *dims)
    elif dims:
        watched = metrics.filter(F.col("metric").isin(names)).select("metric", *dims).distinct().join(F.broadcast(table), "metric")
    bounds = watched.withColumns({"_first": first, "_last": last})
    bounds = bounds.withColumns({"_first": micros(bounds, "_first"), "_last": micros(bounds, "_last")})
    line = F.explode(F.sequence(F.col("_first"), F.col("_last") - step, step)).alias("_start")
    full = bounds.select(*table.columns, *dims, line)
    full = _match(full, seen, ["metric", "period", *dims, "_start"])
    value = F.coalesce(*[F.when(F.col("statistic") == name, F.col(f"_{name}")) for name in STATISTICS])
    states = _judged(full.withColumns({"value": value, "window_start": from_micros(metrics, ts, F.col("_start"))}), "missing")
    # The periods since the last one that did not breach.
    order = Window.partitionBy("alarm", *dims).orderBy("_start")
    states = states.withColumn("_place", F.row_number().over(order))
    quiet = F.max(F.when(~F.col("breach"), F.col("_place"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.lit(0)
    if carried is not None:
        states = _match(states, carried.withColumnRenamed("streak", "_carried"), ["alarm", *dims])
        before = F.coalesce(F.col("_carried"), F.lit(0))
    states = states.withColumn("streak", F.col("_place") - F.coalesce(quiet, -before))
    kept = [c for c in STATE_COLUMNS if c != "window_start"]
    out = states.withColumn("in_alarm", F.col("streak") >= F.col("periods"))
    return out.select(*kept[:2], *dims, "window_start", *kept[2:], "in_alarm", *(["streak"] if dims else []))


def streaks(states: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(alarm, dims, streak) at the end of an evaluation, for the next one to go on from."""
    return states.groupBy("alarm", *dims).agg(F.max_by("streak", "window_start").alias("streak"))


def _match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which missing dimension values are equal."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    return left.join(named, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on], "left").drop(*[f"_r_{c}" for c in on])


def volume_alarm(metrics: DataFrame, start, end, minimum: int = 100, metric: str = "RecordsProcessed") -> DataFrame:
    """Periods of six hours with fewer than ``minimum`` records; no data counts as too few."""
    rule = AlarmRule("record-volume", metric, "Sum", 21_600, "<", minimum, 1, "breaching")
    return alarm_states(metrics, [rule], start, end)


def composite(states: DataFrame, members: Sequence[str] = HEALTH_MEMBERS) -> DataFrame:
    """Overall alarm per window: any member in alarm."""
    return (
        states.filter(F.col("alarm").isin(*members))
        .groupBy("window_start")
        .agg(F.bool_or("in_alarm").alias("in_alarm"))
    )


def metric_pivot(windows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per window, one column per metric; the names are given, not searched for."""
    return windows.groupBy("window_start").pivot("metric", list(names)).agg(F.first("value"))


def durations(runs: DataFrame, started: str, ended: str, job: str) -> DataFrame:
    """Seconds per run, as a metric table row."""
    seconds = F.unix_timestamp(F.col(ended).cast("timestamp")) - F.unix_timestamp(F.col(started).cast("timestamp"))
    return runs.select(
        F.concat(F.col(job), F.lit("_duration")).alias("metric"),
        F.col(started).alias("ts"),
        seconds.cast("double").alias("value"),
    )


def run_metrics(raw: DataFrame, broken: Column, failures: dict[str, Column], dim: DataFrame, spec, key: str, started: str, ended: str, run: str) -> DataFrame:
    """(metric, ts, value): what the alarms watch, from the landed rows of each run and the history.

    ``broken`` tells rejected rows, ``failures`` further counts by metric name.  The
    integrity score is the percent of a run's keys with exactly one current version.
    """
    n, bad = F.count(F.lit(1)), F.count_if(F.coalesce(broken, F.lit(False)))
    at = F.min(ended).alias("ts")
    values = {
        "RecordsProcessed": n,
        "DataQualityScore": 100 * (1 - F.try_divide(bad, n)),
        "ExecutionTime": _millis(F.max(ended)) - _millis(F.min(started)),
        **{name: F.count_if(F.coalesce(c, F.lit(False))) for name, c in failures.items()},
    }
    runs = raw.groupBy(run).agg(at, *[F.round(v.cast("double"), 4).alias(k) for k, v in values.items()])
    pairs = ", ".join(f"'{k}', `{k}`" for k in values)
    long = runs.select("ts", F.expr(f"stack({len(values)}, {pairs}) as (metric, value)"))
    live = dim.groupBy(F.col(spec.key).alias(key)).agg((F.count_if(F.col(spec.current)) == 1).alias("_one"))
    keys = raw.filter(F.col(key).isNotNull()).groupBy(run, key).agg(F.min(ended).alias("ts")).join(live, key)
    whole = keys.groupBy(run).agg(F.min("ts").alias("ts"), F.round(100 * F.avg(F.col("_one").cast("int")), 4).alias("value"))
    return long.select("metric", "ts", "value").unionByName(whole.select(F.lit("SCDIntegrityScore").alias("metric"), "ts", "value"))


def _millis(at: Column) -> Column:
    return F.unix_timestamp(at.cast("timestamp")) * 1000


def error_tail(logs: DataFrame, pattern: str = "ERROR", n: int = 20) -> DataFrame:
    """The ``n`` latest log lines matching a pattern."""
    return logs.filter(F.col("message").rlike(pattern)).orderBy(F.col("ts").desc(), "message").limit(n)

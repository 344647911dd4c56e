"""The lifecycle as one function: pull, land, stage, gate, merge, check, measure."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.clean import is_blank
from tidemark.functions.times import from_micros, micros
from tidemark.operators import checks, report, staging
from tidemark.operators.keyed import find_cuts, match
from tidemark.sources import landing, runs, states, tables
from tidemark.spec import USERS

JOB = "ingest"
MODIFIED = "lastmodifieddate"


@dataclass(frozen=True)
class Paths:
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def history(self) -> str:
        return f"{self.root}/history"

    @property
    def log(self) -> str:
        return f"{self.root}/ingest_runs"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"


def raw_rules() -> list[tuple[str, Column]]:
    """What staging would silently drop, with a name for each case."""
    return [
        ("missing_id", F.col("id").isNull()),
        ("missing_name", is_blank("name")),
        ("missing_lastmodifieddate", F.col("lastmodifieddate").isNull()),
    ]


def ingest(
    spark: SparkSession, source: DataFrame, paths: Paths, run_id: str, now: Column | None = None, overlap_days: int = 0
) -> int:
    """Pull what is new since the last success, land it, then move the bookmark.

    The bookmark moves only after the write, and a run writes into a directory of its
    own: one that is lost in between is pulled again and replaces what it had landed.
    Count and mark are taken by the write itself; the mark is kept in microseconds, so
    that it does not depend on a session's time zone.

    Rows that earlier runs may have landed are compared with what these landed as bags, a
    row given three times being three rows: with ``overlap_days`` those of so many days
    before the bookmark, for rows that reached the source late, and always those without
    a modification time, which no bookmark can tell apart.
    """
    since, at = runs.last_mark(spark, paths.log, JOB), F.col(MODIFIED)
    new, again = source, source.filter(at.isNull())
    if since is not None:
        mark = from_micros(source, MODIFIED, F.lit(int(since)).cast("bigint"))
        new = landing.read_incremental(source, MODIFIED, mark)
        if overlap_days:
            start = mark - F.expr(f"interval {int(overlap_days)} days")
            again = source.filter(at.isNull() | ((at > start) & (at <= mark)))
    if runs.any_state(spark, paths.log, JOB, "succeeded"):
        raw = tables.read_raw(spark, paths.raw, landing.stamp_extraction(source, run_id, now).schema)
        had = raw.filter(F.col("_extraction_run_id") != run_id).select(*source.columns)
        had = had.filter(at.isNull() if since is None or not overlap_days else at.isNull() | ((at > start) & (at <= mark)))
        new = new.filter(at.isNotNull()).unionByName(again.exceptAll(had))
    stamped = landing.stamp_extraction(new, run_id, now)
    seen = tables.land_run(stamped, paths.raw, run_id, F.max(micros(source, MODIFIED)).alias("mark"))
    # Late rows alone do not move the bookmark back.
    marks = [int(m) for m in (seen["mark"], since) if m is not None]
    runs.record(spark, paths.log, JOB, run_id, "succeeded", str(max(marks)) if marks else None)
    return seen["rows"]


def run_once(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    run_id: str,
    max_reject_percent: float = 5.0,
    segments: int | None = None,
    lookback_days: int | None = None,
    as_of=None,
    now: Column | None = None,
    overlap_days: int = 0,
) -> dict:
    """One scheduled run. Raises :class:`~tidemark.operators.checks.QualityGateClosed`
    before the merge when too many rows are rejected.

    By default the history goes on from its keys' states (``sources.states``): the batch is
    all that is read, but for keys with a late row, which are derived from all their raw
    rows.  Versions come out as in a full build.  With ``lookback_days`` only that many days
    of extracts before ``as_of`` are read and the stored history is continued without
    states; the next run without it derives all keys anew.
    ``overlap_days``: see :func:`ingest`.
    """
    paths, began = Paths(root), datetime.now(timezone.utc)
    # A run that was lost after it landed its batch goes on from there.
    landed = runs.has_state(spark, paths.log, JOB, run_id, "succeeded")
    pulled = 0 if landed else ingest(spark, source, paths, run_id, now, overlap_days)
    result = {"run_id": run_id, "pulled": pulled}
    if not pulled and not landed:
        return result
    raw = tables.read_raw(spark, paths.raw, landing.stamp_extraction(source, run_id, now).schema)
    if lookback_days is not None:
        raw = landing.lookback(raw, as_of or began.replace(tzinfo=None), lookback_days)
    batch = raw.filter(F.col("_extraction_run_id") == run_id)
    rate = checks.reject_rate(batch, raw_rules(), max_reject_percent)
    _, rejected = checks.quarantine(batch, raw_rules())
    tables.write_quarantine(rejected, f"{paths.quarantine}/{run_id}", mode="overwrite")
    checks.gate(rate.withColumn("measure", F.lit("reject_rate")), passed="batch_accepted")

    rows = staging.to_history_names(staging.stage_users(raw))
    cuts = None
    if lookback_days is not None:
        keys = batch.select(F.col("id").alias(USERS.key)).distinct()
        cuts = find_cuts(rows, USERS.key, USERS.order(rows.columns), segments)
        staged = match(rows, keys, USERS.key, "left_semi", cuts)
        result |= tables.merge_into(spark, paths.history, staged, USERS, run_id=run_id, cuts=cuts, seeded=True, now=now, keys=keys)
    else:
        new = staging.to_history_names(staging.stage_users(batch))
        past = lambda keys: rows if keys is None else rows.join(keys, USERS.key, "left_semi")
        number = runs.number(spark, paths.log, JOB, run_id)
        result |= states.go_on(spark, paths.history, new, past, number, USERS, segments=segments, now=now)
    dim = tables.read_history(spark, paths.history)
    suite = report.scd_report(report.scd_suite(dim, USERS, cuts))
    tables.write_report(suite, f"{paths.reports}/{run_id}")
    result["seconds"] = (datetime.now(timezone.utc) - began).total_seconds()
    return result

"""A small append-only table of run states: bookmarks, and merges begun and finished."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "job string, run_id string, state string, mark string, path string, recorded_at timestamp"


def record(spark: SparkSession, log: str, job: str, run_id: str, state: str, mark: str | None = None, path: str | None = None) -> None:
    """Append one state; states are only ever added."""
    row = (job, run_id, state, mark, path, datetime.now(timezone.utc))
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(log)


def read(spark: SparkSession, log: str) -> DataFrame:
    """All recorded states; an absent log is an empty one."""
    try:
        return spark.read.schema(SCHEMA).parquet(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def latest_marks(log: DataFrame) -> DataFrame:
    """High-water mark of each job's last successful run."""
    done = log.filter(F.col("state") == "succeeded")
    return done.groupBy("job").agg(F.max_by("mark", "recorded_at").alias("mark"))


def last_mark(spark: SparkSession, log: str, job: str) -> str | None:
    found = latest_marks(read(spark, log)).filter(F.col("job") == job).first()
    return found["mark"] if found else None


def has_state(spark: SparkSession, log: str, job: str, run_id: str, state: str) -> bool:
    rows = read(spark, log).filter(
        (F.col("job") == job) & (F.col("run_id") == run_id) & (F.col("state") == state)
    )
    return not rows.isEmpty()


def any_state(spark: SparkSession, log: str, job: str, state: str) -> bool:
    return not read(spark, log).filter((F.col("job") == job) & (F.col("state") == state)).isEmpty()


def number(spark: SparkSession, log: str, job: str, run_id: str) -> int:
    """How many other runs of a job had succeeded before this one did, for the first time."""
    done = read(spark, log).filter((F.col("job") == job) & (F.col("state") == "succeeded"))
    firsts = done.groupBy("run_id").agg(F.min("recorded_at").alias("at"))
    mine = firsts.filter(F.col("run_id") == run_id).select(F.col("at").alias("_mine"))
    return firsts.join(F.broadcast(mine), firsts["at"] < F.col("_mine")).count()


def standing(spark: SparkSession, log: str, job: str, run_id: str) -> tuple[bool, list[tuple[str, str]]]:
    """(whether ``run_id`` was applied, runs staged but never applied, oldest first).

    One look at the log; unfinished runs come as (run id, staged path).
    """
    states = read(spark, log).filter(F.col("job") == job)
    found = (
        states.groupBy("run_id")
        .agg(
            F.bool_or(F.col("state") == "applied").alias("done"),
            F.max(F.when(F.col("state") == "staged", F.col("path"))).alias("path"),
            F.min("recorded_at").alias("at"),
        )
        .filter((F.col("run_id") == run_id) | (~F.col("done") & F.col("path").isNotNull()))
        .collect()
    )
    open_runs = sorted((r for r in found if not r["done"] and r["path"]), key=lambda r: r["at"])
    done = any(r["run_id"] == run_id and (r["done"] or r["path"]) for r in found)
    return done, [(r["run_id"], r["path"]) for r in open_runs]

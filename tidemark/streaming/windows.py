"""Metric windows over a stream, kept as partial aggregates that later batches add to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.session import written

#: Days of windows that share a directory, by number since 1970.
DAY = "_day"
PARTS = {"total": F.sum, "n": F.sum, "low": F.min, "high": F.max}
VALUES = {
    "Sum": lambda: F.col("total"),
    "Average": lambda: F.col("total") / F.col("n"),
    "SampleCount": lambda: F.col("n").cast("double"),
    "Minimum": lambda: F.col("low"),
    "Maximum": lambda: F.col("high"),
}


def window_partials(metrics: DataFrame, period: int, dims: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Sum, count, minimum and maximum for each metric and tumbling window of ``period`` seconds.

    Made before the shuffle, so a busy metric does not matter.  Rows without a value or a
    time count in no window.
    """
    value = F.col("value").cast("double")
    return (
        metrics.filter(F.col("value").isNotNull() & F.col(ts).isNotNull())
        .groupBy("metric", *dims, F.window(ts, f"{int(period)} seconds").alias("w"))
        .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        .select("metric", *dims, F.col("w.start").alias("window_start"), *PARTS)
    )


def merge_partials(path: str, partials: DataFrame, batch_id: int, dims: Sequence[str] = ()) -> None:
    """Add a batch's partials to those stored, in the days they touch; no other is read or written.

    Each stored window names the last batch it took in, so a replayed batch changes nothing
    that it had reached before it was lost.
    """
    spark, keys = partials.sparkSession, ["metric", *dims, "window_start"]
    day = F.datediff(F.col("window_start").cast("date"), F.lit("1970-01-01").cast("date"))
    new = written(partials.withColumn(DAY, day).withColumn("_batch", F.lit(batch_id).cast("bigint")), "partials")
    # One number for each day that the batch has rows of.
    days = [r[0] for r in new.select(DAY).distinct().collect()]
    if not days:
        return
    old = _stored(spark, path)
    if old is not None:
        old = old.filter(F.col(DAY).isin(days))
        # Windows that took this batch in already keep what they have.
        done = old.filter(F.col("_batch") >= batch_id).select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        new = old.select(*new.columns).unionByName(new.join(done, same, "left_anti"))
        new = new.groupBy(*keys, DAY).agg(*[f(c).alias(c) for c, f in PARTS.items()], F.max("_batch").alias("_batch"))
        # The days are replaced while they are read: what replaces them is made first.
        new = written(new, "partials")
    new.hint("rebalance", F.col(DAY)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def stream_windows(
    stream: DataFrame, period: int, path: str, checkpoint: str, ts: str = "ts", dims: Sequence[str] = ()
) -> StreamingQuery:
    """Windows of a stream; read them with :func:`read_windows`.

    The stream itself keeps no state, so none grows, and no row comes too late: a late one
    is added to its window like any other, at the cost of its day.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_partials(path, window_partials(batch, period, dims, ts), batch_id, dims)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_windows(spark: SparkSession, path: str, statistic: str = "Sum", dims: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Any statistic of the windows; each is stored once."""
    rows = spark.read.parquet(path)
    rows = rows if where is None else rows.filter(where)
    return rows.select("metric", *dims, "window_start", VALUES[statistic]().alias("value"))

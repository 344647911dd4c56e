"""Check counts kept beside a stored history, replaced for the buckets that a merge touched only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.ids import bucket_of
from tidemark.operators.keyed import Cuts
from tidemark.operators.report import key_counts
from tidemark.sources import tables
from tidemark.spec import HistorySpec


def counts_path(path: str) -> str:
    return path.rstrip("/") + "_counts"


def refresh_counts(spark: SparkSession, path: str, spec: HistorySpec, keys: DataFrame | None = None, cuts: Cuts | None = None) -> list[int] | None:
    """Count the keys of the history anew; with ``keys`` only the hash buckets these lie in.

    Returns the buckets that were read.  Doing it again gives the same counts, so a run that
    is lost is repeated.
    """
    layout, used = tables.layout_of(spark, path), None
    if keys is not None:
        # At most layout.buckets numbers.
        used = sorted(r[0] for r in keys.select(bucket_of(spec.key, layout.buckets)).distinct().collect())
    counts = key_counts(tables.read_history(spark, path, used), spec, cuts)
    placed = counts.withColumn(tables.BUCKET, bucket_of(spec.key, layout.buckets)).hint("rebalance", F.col(tables.BUCKET))
    how = "static" if keys is None else "dynamic"
    placed.write.mode("overwrite").option("partitionOverwriteMode", how).partitionBy(tables.BUCKET).parquet(counts_path(path))
    return used


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(key, counts) of every key; the suite and the scores are sums over it."""
    return spark.read.parquet(counts_path(path)).drop(tables.BUCKET)

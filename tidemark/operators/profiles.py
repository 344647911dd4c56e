"""Profiles of extracts that can be merged, so that a new extract is profiled without reading old ones.

Each extract leaves one row: its rows, its NULLs, its rows without any, and for each key a
HyperLogLog sketch of the key's values.  Merging adds the counts and unites the sketches,
which never see a value twice.  A united sketch tells the number of different keys to
about 1.04 / sqrt(2^PRECISION); where a limit lies within ``SIGMAS`` of that, the keys are
counted exactly from the extracts themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

PRECISION, SIGMAS = 14, 4
ERROR = SIGMAS * 1.04 / 2 ** (PRECISION / 2)
EXTRACT = "_extract"


def profile_extracts(df: DataFrame, columns: Sequence[str], keys: Mapping[str, Sequence[str]], extract: str) -> DataFrame:
    """One row for each extract; partial aggregates are made map-side, no key is shuffled."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return df.groupBy(F.col(extract).alias(EXTRACT)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(complete).alias("complete"),
        *[F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in columns],
        *[F.hll_sketch_agg(F.xxhash64(*[F.col(c) for c in by]), PRECISION).alias(f"keys:{name}") for name, by in keys.items()],
    )


def keep_profiles(profiles: DataFrame, path: str) -> None:
    """Store profiles; an extract that is profiled again replaces what it left before."""
    profiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EXTRACT).parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_profile(
    profiles: DataFrame,
    extracts: DataFrame,
    columns: Sequence[str],
    keys: Mapping[str, Sequence[str]],
    max_null: float = 0.05,
    max_duplicate: float = 0.01,
    min_success: float = 0.95,
) -> DataFrame:
    """(measure, value, error, threshold, passed) over all extracts.

    ``error`` is how far the value may be off, 0 for what is counted.  ``extracts`` are only
    read for keys whose share of duplicates is too near its limit to tell.
    """
    one = profiles.agg(
        F.sum("n").alias("n"), F.sum("complete").alias("complete"), *[F.sum(f"`null:{c}`").alias(f"null:{c}") for c in columns],
        *[F.hll_sketch_estimate(F.hll_union_agg(f"keys:{name}")).alias(f"keys:{name}") for name in keys],
    ).first()  # one row
    n = one["n"] or 0
    share = lambda x: None if not n else x / n
    rows = [(f"null_share:{c}", share(one[f"null:{c}"] or 0), 0.0, max_null) for c in columns]
    rows.append(("success_rate", share(one["complete"] or 0), 0.0, min_success))
    for name, by in keys.items():
        different, error = one[f"keys:{name}"] or 0, ERROR
        value = share(max(0, n - different))
        if n and abs(value - max_duplicate) <= error * different / n:
            different, error = extracts.select(*by).distinct().count(), 0.0
            value = share(n - different)
        rows.append((f"duplicate_share:{name}", value, None if not n else error * different / n, max_duplicate))
    spark = profiles.sparkSession
    out = spark.createDataFrame(rows, "measure string, value double, error double, threshold double").coalesce(1)
    ok = F.when(F.col("measure") == "success_rate", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    return out.withColumn("passed", ok)

"""Deterministic identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.times import micros

NULL_PART = "_null_"


def _text(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        value = micros(df, column)
    else:
        value = F.col(column)
    return F.coalesce(value.cast("string"), F.lit(NULL_PART))


def hash_id(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 over the columns' text; times enter as microseconds, NULL as ``_null_``."""
    return F.md5(F.concat_ws("-", *[_text(df, c) for c in columns]))


def hash_bigint(df: DataFrame, columns: Sequence[str]) -> Column:
    """The 64-bit form of :func:`hash_id`, for tables that want a bigint key."""
    return F.xxhash64(*[_text(df, c) for c in columns])


def version_id(
    df: DataFrame,
    key: str,
    ts: str,
    tracked: Sequence[str] = (),
    deleted: str | None = "is_deleted",
) -> Column:
    """Identity of one version: key, time, tracked values and the delete marker."""
    return hash_id(df, [key, ts, *tracked, *([deleted] if deleted else [])])


def bucket_of(key: str, buckets: int) -> Column:
    """Hash bucket of a key, ``0 .. buckets-1``."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")

"""Column clean-up used by staging and by the dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def standardize_enum(column: str, values: Sequence[str]) -> Column:
    """Accepted values in any case and padding become ``Initcap``; others stay as they are."""
    trimmed = F.trim(F.col(column))
    known = F.upper(trimmed).isin(*[v.upper() for v in values])
    return F.when(known, F.initcap(trimmed)).otherwise(F.col(column))


def default_false(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(False))


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column)) == "")


def delete_status(deleted: str, ts: str) -> Column:
    """Struct describing how a source row takes part in the history.

    A deleted row is never current; for a live row currency is still open (NULL).
    """
    gone = F.coalesce(F.col(deleted), F.lit(False))
    return F.struct(
        gone.alias("is_deleted"),
        F.when(gone, F.lit(False)).alias("is_current"),
        F.col(ts).alias("update_date"),
        F.when(gone, "DELETED").otherwise("ACTIVE").alias("record_status"),
    )

"""Audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def audit_columns(df: DataFrame, invocation_id: str, started_at, now: Column | None = None) -> DataFrame:
    """Add processing time, invocation id and run start; extraction columns stay."""
    return df.withColumns(
        {
            "_dbt_updated_at": F.current_timestamp() if now is None else now,
            "_dbt_invocation_id": F.lit(invocation_id),
            "_dbt_run_started_at": F.lit(str(started_at)),
        }
    )

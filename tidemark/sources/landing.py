"""Reading extracts: landed JSON records, increments and lookback windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.times import moment

# The fields pulled from the source, with the delete marker staging needs.
USER_FIELDS = (
    "Id", "Name", "Username", "Email", "Division", "Audit_Phase__c", "IsActive",
    "CreatedDate", "LastModifiedDate", "LastLoginDate", "IsDeleted",
)
_BOOLEAN = ("IsActive", "IsDeleted")
_TIMES = ("CreatedDate", "LastModifiedDate", "LastLoginDate")
ENVELOPE = "attributes"


def user_record_schema() -> T.StructType:
    """Record schema as landed: booleans typed, times still ISO text."""
    fields = [T.StructField(c, T.BooleanType() if c in _BOOLEAN else T.StringType()) for c in USER_FIELDS]
    return T.StructType([T.StructField(ENVELOPE, T.MapType(T.StringType(), T.StringType())), *fields])


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON-lines records with a fixed schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def parse_records(lines: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The same from a text column of JSON records."""
    return lines.select(F.from_json(column, schema).alias("_r")).select("_r.*")


def strip_envelope(df: DataFrame) -> DataFrame:
    return df.drop(ENVELOPE)


def type_times(df: DataFrame, columns: Sequence[str] = _TIMES, ntz: bool = False) -> DataFrame:
    """ISO text to timestamps; text that is no time becomes NULL instead of failing the job."""
    kind = "timestamp_ntz" if ntz else "timestamp"
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {kind})") for c in columns if c in df.columns})


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_incremental(df: DataFrame, ts: str, since=None, fields: Sequence[str] | None = None, ordered: bool = False) -> DataFrame:
    """All rows, or those modified strictly after ``since``; the filter reaches the scan.

    ``since`` that nothing follows gives an empty frame with the full schema.
    """
    rows = df if since is None else df.filter(F.col(ts) > moment(df, ts, since))
    rows = rows if fields is None else rows.select(*fields)
    return rows.orderBy(ts) if ordered else rows


def stamp_extraction(df: DataFrame, run_id: str | Column, now: Column | None = None) -> DataFrame:
    """Extraction time, run id and the date the raw table is partitioned by."""
    at = F.current_timestamp() if now is None else now
    return df.withColumns(
        {
            "_extracted_at": at,
            "_extraction_run_id": F.lit(run_id) if isinstance(run_id, str) else run_id,
        }
    ).withColumn("_extracted_date", F.date_format("_extracted_at", "yyyy-MM-dd"))


def lookback(raw: DataFrame, as_of, days: int = 7, extracted: str = "_extracted_at", partition: str = "_extracted_date") -> DataFrame:
    """Extracts of the last ``days`` days before ``as_of``, to catch late rows.

    The date partition is compared as well, so older partitions are not read; it gets
    a day of slack, since a run around midnight may file rows under either date.
    """
    start = F.date_sub(moment(raw, extracted, as_of).cast("date"), days)
    rows = raw.filter(F.col(extracted) >= start.cast(raw.schema[extracted].dataType))
    if partition in raw.columns:
        rows = rows.filter(F.col(partition) >= F.date_format(F.date_sub(start, 1), "yyyy-MM-dd"))
    return rows

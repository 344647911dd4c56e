"""A stream of changes merged into a stored history, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.ids import bucket_of
from tidemark.sources.states import BATCH, go_on
from tidemark.sources.tables import BUCKET, Layout, layout_of
from tidemark.spec import HistorySpec


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A parquet table as a stream; ``path`` may be a directory or a single file."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # As a pattern the path may also name one file.
    path = path.rstrip("/")
    return reader.parquet(path[:-1] + f"[{path[-1]}]")


def keep_batch(rows: DataFrame, store: str, batch_id: int, spec: HistorySpec, buckets: int) -> DataFrame:
    """Store a batch's staged rows by hash bucket and return them; reads no other batch.

    A batch has a directory of its own, which a replay replaces.
    """
    path = f"{store}/{BATCH}={batch_id}"
    placed = rows.withColumn(BUCKET, bucket_of(spec.key, buckets))
    placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path)
    whole = T.StructType([*rows.schema, T.StructField(BUCKET, T.IntegerType())])
    return rows.sparkSession.read.schema(whole).parquet(path).drop(BUCKET)


def kept_rows(spark: SparkSession, store: str, batch_id: int, keys: DataFrame | None, schema: T.StructType, spec: HistorySpec, buckets: int) -> DataFrame:
    """All rows that ``keys`` had up to a batch, from their hash buckets; without keys all rows."""
    whole = T.StructType([*schema, T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    kept = spark.read.schema(whole).parquet(store).filter(F.col(BATCH) <= batch_id)
    if keys is not None:
        # At most ``buckets`` numbers.
        used = [r[0] for r in keys.select(bucket_of(spec.key, buckets)).distinct().collect()]
        kept = kept.filter(F.col(BUCKET).isin(*used)).join(keys, spec.key, "left_semi")
    return kept.select(*schema.names)


def stream_scd2(
    stream: DataFrame,
    spec: HistorySpec,
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    layout: Layout | None = None,
    segments: int | None = None,
) -> StreamingQuery:
    """Process what is available and stop; start again to go on from the checkpoint.

    ``prepare`` turns a batch into staged rows, which are kept next to the history, as is
    a state for each key (see ``operators.state``).  Keys whose rows all come later than
    their state go on from it: their batch is all that is read.  Only keys with a row that
    is late are derived from all rows they ever had.  Either way the history is that of a
    full build, with rows in any order and values that are not valid.  A batch replayed
    after a failure gives what it gave before: its states are those of earlier batches, and
    merging versions that are there already changes nothing.
    """
    store = path.rstrip("/") + "_staged"

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        buckets = layout_of(spark, path, layout).buckets
        rows = keep_batch(prepare(batch), store, batch_id, spec, buckets)
        past = lambda keys: kept_rows(spark, store, batch_id, keys, rows.schema, spec, buckets)
        go_on(spark, path, rows, past, batch_id, spec, layout, segments)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Stored tables: raw appends, histories in hash buckets, merges, compaction, reports."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.ids import bucket_of
from tidemark.functions.times import micros
from tidemark.operators.history import scd2_build
from tidemark.operators import state
from tidemark.operators.keyed import Cuts, match
from tidemark.operators.merge import (
    closing_ids,
    derive,
    merge_on_key,
    merge_update_columns,
    updated_keys,
)
from tidemark.session import small_table, written
from tidemark.sources import runs
from tidemark.spec import HistorySpec

BUCKET, PERIOD = "_bucket", "_period"
DAY = 86_400_000_000
MERGE, LAYOUT = "merge", "layout"
COUNTS = ("records_created", "records_updated", "records_deleted")


# Plain sinks.


def append_measured(df: DataFrame, path: str, *measures: Column, partition: str = "_extracted_date") -> dict:
    """Append to the raw table; returns ``rows`` and the measures, taken by the write itself."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    counted.write.mode("append").partitionBy(partition).parquet(path)
    return seen.get


def append_raw(df: DataFrame, path: str, partition: str = "_extracted_date") -> int:
    """Append to the raw table and return the row count."""
    return append_measured(df, path, partition=partition)["rows"]


def land_run(
    df: DataFrame, path: str, run_id: str, *measures: Column,
    run: str = "_extraction_run_id", partition: str = "_extracted_date",
) -> dict:
    """Write one run's rows into a directory of its own; returns ``rows`` and the measures.

    A run that is repeated replaces what it left there before, so nothing is doubled.
    """
    seen = Observation()
    counted = df.drop(run).observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(
        f"{path}/{run}={quote(run_id, safe='')}"
    )
    return seen.get


def read_raw(
    spark: SparkSession, path: str, schema: T.StructType | None = None, partition: str = "_extracted_date"
) -> DataFrame:
    """The raw table; the date stays text.

    Give the schema if it is known.  Without one every file's footer is read, to
    find every column any extract ever had.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.option("mergeSchema", "true").parquet(path)
    named = [c for c in (partition, "_extraction_run_id") if c in df.columns]
    return df.withColumns({c: F.col(c).cast("string") for c in named}) if named else df


def create_or_replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def analyze(spark: SparkSession, table: str) -> None:
    """Table and column statistics of a catalog table."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def write_quarantine(rejected: DataFrame, path: str, mode: str = "append") -> None:
    rejected.write.mode(mode).partitionBy("reject_reason").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report (a handful of rows) as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


# Histories.


@dataclass(frozen=True)
class Layout:
    """Directory layout of a history: hash bucket of the key, then period of the version's time.

    Neither ever changes for a stored version and versions are never deleted, so a
    directory never becomes empty and can safely be replaced on its own.  The
    period keeps the cold past of a busy key out of a merge's rewrite.
    """

    buckets: int = 16
    period_days: int = 30

    def place(self, df: DataFrame, spec: HistorySpec) -> DataFrame:
        period = F.floor(micros(df, spec.ts) / (self.period_days * DAY)).cast("int")
        return df.withColumns({BUCKET: bucket_of(spec.key, self.buckets), PERIOD: period})


def _write_parts(df: DataFrame, path: str, dynamic: bool) -> None:
    # Rebalance splits a directory that is too large for one task and joins small ones.
    (
        df.hint("rebalance", F.col(BUCKET), F.col(PERIOD))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(BUCKET, PERIOD)
        .parquet(path)
    )


def write_history(dim: DataFrame, path: str, spec: HistorySpec, layout: Layout = Layout()) -> None:
    """Full refresh: replace the stored history and its layout; repeat it if its driver is lost."""
    _keep_layout(dim.sparkSession, path, spec, layout)
    _write_parts(layout.place(dim, spec), path, dynamic=False)


def _keep_layout(spark: SparkSession, path: str, spec: HistorySpec, layout: Layout) -> None:
    mark = json.dumps({**asdict(layout), "sequence": spec.sequence})
    runs.record(spark, _log(path), LAYOUT, uuid.uuid4().hex, "succeeded", mark)


def stored_layout(spark: SparkSession, path: str) -> tuple[Layout | None, str | None]:
    """The layout a table was written with and its sequence column; None if it has no record of them."""
    mark = runs.last_mark(spark, _log(path), LAYOUT)
    if mark is None:
        return None, None
    known = json.loads(mark)
    sequence = known.pop("sequence")
    return Layout(**known), sequence


def layout_of(spark: SparkSession, path: str, wanted: Layout | None = None) -> Layout:
    """The layout to merge by: the table's own.  Another one asked for is refused."""
    known, _ = stored_layout(spark, path)
    if known is not None and wanted is not None and wanted != known:
        raise ValueError(f"{path} is laid out by {known}, not by {wanted}")
    return known or wanted or Layout()


def _parts_schema(schema: T.StructType) -> T.StructType:
    plain = [f for f in schema if f.name not in (BUCKET, PERIOD)]
    return T.StructType([*plain, T.StructField(BUCKET, T.IntegerType()), T.StructField(PERIOD, T.IntegerType())])


def _read_parts(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    schema = schema or spark.read.parquet(path).schema
    return spark.read.schema(_parts_schema(schema)).parquet(path)


def read_history(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The versions in force, all or those of some hash buckets; versions that were taken back stay stored with the sequence 0."""
    _, sequence = stored_layout(spark, path)
    rows = _read_parts(spark, path)
    rows = (rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET, PERIOD)
    return rows if sequence is None else rows.filter(F.col(sequence) > 0)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of a stored table, None if there is none yet."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _only(df: DataFrame, parts: list) -> DataFrame:
    """Rows of the given directories, as a filter on the directory columns that prunes the files read."""
    periods: dict[int, list] = {}
    for p in parts:
        periods.setdefault(p[BUCKET], []).append(p[PERIOD])
    # Buckets mostly share their periods: one test for each set of these.
    buckets: dict[tuple, list] = {}
    for b, found in periods.items():
        buckets.setdefault(tuple(sorted(found, key=lambda x: (x is None, x))), []).append(b)
    tests = [F.col(BUCKET).isin(*bs) & F.col(PERIOD).isin(*ps) for ps, bs in buckets.items()]
    return df.filter(reduce(lambda a, b: a | b, tests)) if tests else df.limit(0)


def _log(path: str) -> str:
    return path.rstrip("/") + "_runs"


def _pending(path: str) -> str:
    """Where a merge puts its directories before they replace the table's.

    Next to the table, not in scratch space: it is needed until the run is applied,
    and may be deleted after that.
    """
    return f"{path.rstrip('/')}_pending/{uuid.uuid4().hex}"


def _apply(spark: SparkSession, path: str, run_id: str, staged: str, schema=None) -> None:
    """Replace directories of the table by the staged ones; doing it twice is harmless."""
    schema = schema or stored_schema(spark, staged)
    if schema is not None:
        rows = _read_parts(spark, staged, schema)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            BUCKET, PERIOD
        ).parquet(path)
    runs.record(spark, _log(path), MERGE, run_id, "applied")


def recover(spark: SparkSession, path: str, run_id: str = "") -> bool:
    """Finish merges that were staged but not applied when their driver was lost.

    Returns whether ``run_id`` is applied.
    """
    done, left = runs.standing(spark, _log(path), MERGE, run_id)
    for other, staged in left:
        _apply(spark, path, other, staged)
    return done


def _replace(df: DataFrame, path: str, run_id: str) -> None:
    spark = df.sparkSession
    staged = _pending(path)
    _write_parts(df, staged, dynamic=False)
    runs.record(spark, _log(path), MERGE, run_id, "staged", path=staged)
    _apply(spark, path, run_id, staged, df.schema)


def merge_into(
    spark: SparkSession,
    path: str,
    staged: DataFrame,
    spec: HistorySpec,
    run_id: str | None = None,
    layout: Layout | None = None,
    cuts: Cuts | None = None,
    seeded: bool = False,
    per_key: bool = True,
    now: Column | None = None,
    keys: DataFrame | None = None,
    complete: bool = False,
) -> dict[str, int]:
    """Merge staged rows into a stored history and return the merge's counts.

    ``keys`` are the keys to derive, if they are known; else those with rows newer than
    their own latest stored one, or with ``per_key`` off than the table's latest.

    ``complete`` says that all rows these keys ever had are staged.  Then the stored
    versions become those of a full build, however late a row came: they are numbered
    anew, and one that is no version any more is taken back (see :func:`read_history`).

    The table's layout is kept with it; ``layout`` is for its first load.  Only buckets
    of staged keys are read, and only directories that hold a changed row are rewritten:
    next to the table first, then over the old ones.  A run id that was applied before
    is skipped, so a replayed batch changes nothing.  Versions that stay as they are
    keep their stamp.
    """
    if seeded and complete:
        raise ValueError("a staging of recent rows is not complete")
    run_id = run_id or uuid.uuid4().hex
    if recover(spark, path, run_id):
        return dict.fromkeys(COUNTS, 0)
    schema = stored_schema(spark, path)
    if schema is None:
        return _first_load(path, staged, spec, run_id, layout or Layout(), cuts, now)
    layout = layout_of(spark, path, layout)
    table = _read_parts(spark, path, schema)
    # At most layout.buckets numbers.
    source = staged if keys is None else keys
    used = source.select(bucket_of(spec.key, layout.buckets).alias(BUCKET)).distinct().collect()
    near = table.filter(F.col(BUCKET).isin(*[r[0] for r in used])) if used else table.limit(0)
    # The overall mark is the whole table's; all the rest needs only the near buckets.
    if keys is None:
        keys = updated_keys(staged, near if per_key else table, spec, per_key)
    standing = near.filter(F.col(spec.sequence) > 0).drop(BUCKET, PERIOD)
    new, closers = derive(standing, staged, spec, cuts, seeded, keys=keys, now=now)
    theirs = match(near, keys, spec.key, "left_semi", cuts)
    changes = written(_changes(theirs, layout.place(new, spec), closers, spec, now, seeded, complete), "changes")

    parts, counts = _touched(changes, spec)
    if parts:
        merged = merge_on_key(
            _only(table, parts), changes.drop("_was"), [spec.version_id], merge_update_columns(spec, True)
        )
        _replace(merged, path, run_id)
    else:
        runs.record(spark, _log(path), MERGE, run_id, "applied")
    return counts


def _touched(changes: DataFrame, spec: HistorySpec) -> tuple[list, dict[str, int]]:
    """The directories that written changes name, never more than the table has, and the merge's counts."""
    fresh, gone = F.col("_was").isNull(), F.col(spec.deleted)
    parts = changes.groupBy(BUCKET, PERIOD).agg(
        F.count_if(fresh & ~gone).alias("records_created"),
        F.count_if(~fresh & (F.col("_was") != F.col(spec.current))).alias("records_updated"),
        F.count_if(fresh & gone).alias("records_deleted"),
    ).collect()
    return parts, {c: sum(p[c] for p in parts) for c in COUNTS}


def _rewrite(path: str, table: DataFrame, changes: DataFrame, spec: HistorySpec) -> dict[str, int]:
    """Bring changes into the directories they name, by Spark's own partition overwrite.

    That replaces directories when all of them have been made, so they can be read for it.
    Doing it again changes nothing: versions that are there already only get the same flags.
    """
    parts, counts = _touched(changes, spec)
    if parts:
        merged = merge_on_key(_only(table, parts), changes.drop("_was"), [spec.version_id], merge_update_columns(spec, True))
        _write_parts(merged, path, dynamic=True)
    return counts


def merge_derived(
    spark: SparkSession,
    path: str,
    derived: DataFrame,
    columns: list[str],
    spec: HistorySpec,
    layout: Layout | None = None,
    late: DataFrame | None = None,
    now: Column | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Merge written results of :func:`~tidemark.operators.state.advance`; returns the keys' new states and the merge's counts.

    ``columns`` are those of the staged rows.  Keys that follow their state add versions and
    close those their state names, so only the directories these lie in are read.  ``late``
    are the keys that don't, derived from all their rows: their stored versions are read
    and brought in line with these.  A merge that was lost on its way is repeated whole.
    """
    schema = stored_schema(spark, path)
    follows = derived if late is None else derived.filter(~F.col("_late"))
    sides = [follows] if late is None else [follows, late]
    versions = [state.continued(side, columns, spec, now) for side in sides]
    if schema is None:
        layout = layout or Layout()
        write_history(reduce(DataFrame.unionByName, versions), path, spec, layout)
        counts = _loaded(spark, path, spec)
    else:
        layout = layout_of(spark, path, layout)
        table = _read_parts(spark, path, schema)
        changes = layout.place(versions[0], spec).withColumn("_was", F.lit(None).cast("boolean"))
        if state.has_past(follows):
            ended = layout.place(state.closing(follows, spec), spec).withColumns({
                spec.current: F.lit(False), spec.stamp: F.current_timestamp() if now is None else now, "_was": F.lit(True),
            })
            changes = changes.unionByName(ended, allowMissingColumns=True)
        if late is not None:
            keys = late.select(spec.key).distinct()
            used = keys.select(bucket_of(spec.key, layout.buckets).alias(BUCKET)).distinct().collect()
            theirs = table.filter(F.col(BUCKET).isin(*[r[0] for r in used])).join(keys, spec.key, "left_semi")
            redone = _changes(theirs, layout.place(versions[1], spec), keys, spec, now, complete=True)
            # Read twice; without late keys that is a projection of what is written already.
            changes = written(changes.unionByName(redone), "changes")
        counts = _rewrite(path, table, changes, spec)
    return reduce(DataFrame.unionByName, [state.next_state(side, stored, spec) for side, stored in zip(sides, versions)]), counts


def _changes(
    stored: DataFrame, new: DataFrame, closers: DataFrame, spec: HistorySpec, now, seeded: bool = False, complete: bool = False
) -> DataFrame:
    """Versions to insert, and stored ones whose current flag moves (``_was`` is the old flag).

    With ``seeded`` or ``complete`` also stored ones whose number moves; with ``complete``
    a stored version that is not derived again gets the number 0.

    A version that is derived again is not closed on top of that.  Everything meets
    on the version id, so the derived versions are computed and shuffled once.
    """
    place = [spec.version_id, spec.current, spec.sequence, BUCKET, PERIOD]
    closing = closing_ids(stored, closers, spec)
    have = stored.select(*[F.col(c).alias(f"_old_{c}") for c in place], spec.deleted)
    have = have.withColumnsRenamed({f"_old_{spec.version_id}": spec.version_id, spec.deleted: "_old_deleted"})
    have = have.join(closing, spec.version_id, "left")
    both = new.withColumn("_new", F.lit(True)).join(have, spec.version_id, "full_outer")
    was, number = F.col(f"_old_{spec.current}"), F.col(f"_old_{spec.sequence}")
    flag = F.when(F.col("_new"), F.col(spec.current)).otherwise(F.lit(False) if complete else was & F.col("_close").isNull())
    if complete:
        position = F.when(F.col("_new"), F.col(spec.sequence)).otherwise(F.lit(0))
    elif seeded:
        position = F.coalesce(F.col(spec.sequence), number)
    else:
        # A version that was taken back and is derived again comes back with its number.
        position = F.when(number > 0, number).otherwise(F.coalesce(F.col(spec.sequence), number))
    out = {c: F.coalesce(F.col(c), F.col(f"_old_{c}")) for c in (BUCKET, PERIOD)}
    out |= {
        spec.sequence: position.cast(new.schema[spec.sequence].dataType),
        spec.current: flag,
        spec.stamp: F.current_timestamp() if now is None else now,
        spec.deleted: F.coalesce(F.col(spec.deleted), F.col("_old_deleted")),
        "_was": was,
        "_moved": F.coalesce(position != number, F.lit(False)),
    }
    return (
        both.withColumns(out)
        .filter(F.col("_was").isNull() | (F.col("_was") != F.col(spec.current)) | F.col("_moved"))
        .select(*new.columns, "_was")
    )


def _first_load(path, staged, spec, run_id, layout, cuts, now) -> dict[str, int]:
    spark = staged.sparkSession
    _keep_layout(spark, path, spec, layout)
    _replace(layout.place(scd2_build(staged, spec, cuts, now=now), spec), path, run_id)
    return _loaded(spark, path, spec)


def _loaded(spark: SparkSession, path: str, spec: HistorySpec) -> dict[str, int]:
    """The counts of a first load."""
    counts = read_history(spark, path).agg(
        F.count_if(~F.col(spec.deleted)).alias("records_created"),
        F.lit(0).cast("bigint").alias("records_updated"),
        F.count_if(F.col(spec.deleted)).alias("records_deleted"),
    )
    return counts.first().asDict()


def compact(
    spark: SparkSession, path: str, spec: HistorySpec, older_than, target_bytes: int = 128 << 20
) -> int:
    """Rewrite cold directories that have more files than they need; returns how many.

    Cold means no row was stamped at or after ``older_than``.
    """
    recover(spark, path)
    table = _read_parts(spark, path)
    files = (
        table.select(BUCKET, PERIOD, spec.stamp, "_metadata.file_path", "_metadata.file_size")
        .groupBy(BUCKET, PERIOD, "file_path", "file_size")
        .agg(F.max(spec.stamp).alias("stamped"))
        .groupBy(BUCKET, PERIOD)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("size"), F.max("stamped").alias("stamped"))
    )
    want = F.greatest(F.ceil(F.col("size") / target_bytes), F.lit(1))
    cold = files.filter(F.col("stamped") < F.lit(older_than).cast(table.schema[spec.stamp].dataType))
    # One row per directory; the same bound as the file listing.
    parts = cold.filter(F.col("n") > want).select(BUCKET, PERIOD, want.cast("int").alias("_files")).collect()
    if not parts:
        return 0
    wanted = small_table(spark, parts, f"{BUCKET} int, {PERIOD} int, _files int")
    slot = F.pmod(F.xxhash64(spec.version_id), F.col("_files"))
    rows = _only(table, parts).join(F.broadcast(wanted), [BUCKET, PERIOD]).withColumn("_slot", slot)
    total = sum(p["_files"] for p in parts)
    spread = rows.repartition(total, BUCKET, PERIOD, "_slot").drop("_slot", "_files")
    run_id, staged = f"compact-{uuid.uuid4().hex}", _pending(path)
    spread.write.partitionBy(BUCKET, PERIOD).parquet(staged)
    runs.record(spark, _log(path), MERGE, run_id, "staged", path=staged)
    _apply(spark, path, run_id, staged)
    return len(parts)

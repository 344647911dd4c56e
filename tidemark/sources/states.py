"""Histories that are gone on with, batch by batch, from the states of their keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import state
from tidemark.operators.keyed import find_cuts
from tidemark.session import written
from tidemark.sources.tables import COUNTS, Layout, merge_derived
from tidemark.spec import HistorySpec

BATCH = "_batch"
#: Every so many batches all states are stored again, so that reading them stays cheap.
FOLD = 16


def go_on(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    past: Callable[[DataFrame | None], DataFrame],
    batch_id: int,
    spec: HistorySpec,
    layout: Layout | None = None,
    segments: int | None = None,
    now: Column | None = None,
) -> dict[str, int]:
    """Merge a batch's stored rows into the history at ``path``; returns the merge's counts.

    Keys whose rows all come later than their state go on from it.  Keys with a late row are
    derived from all rows they ever had, which ``past`` gives for a table of keys; for None
    it gives all rows, for a history whose states of the batch before are not known.
    Batches are numbered from 0; a batch that is repeated gives what it gave before.
    """
    states = path.rstrip("/") + "_states"
    known = read_states(spark, states, batch_id, spec)
    cuts = find_cuts(rows, spec.key, spec.order(rows.columns), segments)
    derived = written(state.advance(rows, spec, known, cuts), "derived")
    total, behind = derived.agg(F.count(F.lit(1)), F.count_if("_late")).first()
    if not total and known is None:
        return dict.fromkeys(COUNTS, 0)
    late = None
    # Without states every key is derived anew, once; the next batch can go on.
    if behind or (known is None and batch_id > 0):
        keys = None if known is None else derived.filter("_late").select(spec.key).distinct()
        whole = past(keys)
        cuts = find_cuts(whole, spec.key, spec.order(whole.columns), segments)
        late = written(state.advance(whole, spec, None, cuts), "late")
        derived = derived.withColumn("_late", F.lit(True)) if keys is None else derived
    changed, counts = merge_derived(spark, path, derived, rows.columns, spec, layout, late, now)
    keep_states(changed, states, batch_id, spec)
    return counts


def keep_states(changed: DataFrame, store: str, batch_id: int, spec: HistorySpec) -> None:
    """Store the states that a batch changed; every ``FOLD``-th batch stores all of them."""
    if batch_id % FOLD == FOLD - 1:
        before = read_states(changed.sparkSession, store, batch_id, spec)
        if before is not None:
            changed = changed.unionByName(before.join(changed.select(spec.key), spec.key, "left_anti"))
    changed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{store}/{BATCH}={batch_id}")


def read_states(spark: SparkSession, store: str, batch_id: int, spec: HistorySpec) -> DataFrame | None:
    """Each key's state before a batch: the last one stored, from the batches since all were; None if that of the batch before is missing."""
    try:
        spark.read.parquet(f"{store}/{BATCH}={batch_id - 1}")
        rows = spark.read.parquet(store)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    rows = rows.filter((F.col(BATCH) < batch_id) & (F.col(BATCH) >= batch_id // FOLD * FOLD - 1))
    last = rows.groupBy(spec.key).agg(F.max_by(F.struct(*state.STATE), BATCH).alias("_state"))
    return last.select(spec.key, "_state.*")

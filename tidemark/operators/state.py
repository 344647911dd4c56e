"""What a key's past comes down to: enough to go on from without reading it again.

A key's state is the time of its last row, the tracked values on it, how many versions it
has opened, the time of the last one, and the stored versions that are current.  Rows that
all come later than that continue the history from the state alone, and give the versions
and the state that a build of all rows would give.  A key with a row that is not later has
to be derived from all its rows; the same scan does that, with no state to start from.

State: (key, _upto, _tail, _versions, _latest, _open), one row a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clean import default_false
from tidemark.operators.history import NEEDED, detect_changes, dimension_rows, required_and_valid, watched
from tidemark.operators.keyed import Cuts, match, ordered
from tidemark.spec import HistorySpec

STATE = ("_upto", "_tail", "_versions", "_latest", "_open")
PAST = ("_versions", "_latest", "_open")


def advance(
    rows: DataFrame, spec: HistorySpec, state: DataFrame | None = None, cuts: Cuts | None = None, track_deletes: bool = False
) -> DataFrame:
    """The version-opening rows of each key of ``rows``, with what its state becomes.

    One shuffle on the key over rows and states, which are the batch's and one row a key.
    A row for each version, numbered by ``_n`` from 1 within the batch; a key without a new
    version has one row without.  ``_late`` marks keys whose rows do not all follow the
    state: what is derived for these is of no use.  Write the result before using it.
    """
    look, order = watched(spec, track_deletes), spec.order(rows.columns)
    line = rows.filter(F.col(spec.key).isNotNull()).withColumn("_seed", F.lit(False))
    past = F.lit(False)  # no past: a placeholder that is no struct
    if state is not None:
        seeds = state.select(
            spec.key, F.col("_upto").alias(spec.ts), *[F.col("_tail")[c].alias(c) for c in look], F.lit(True).alias("_seed"), F.struct(*PAST).alias("_past")
        )
        line = line.unionByName(seeds, allowMissingColumns=True)
        past = F.max_by("_past", "_seed")
    found = detect_changes(line, spec, cuts, track_deletes)
    mine, opens, at = ~F.col("_seed"), F.col(NEEDED) & ~F.col("_seed"), F.col(spec.ts)
    per_key = found.groupBy(spec.key).agg(
        past.alias("_past"), F.count_if(mine).alias("_rows"),
        F.min(F.when(mine, at)).alias("_first"), F.count_if(mine & at.isNull()).alias("_untimed"), F.max(F.when(~mine, at)).alias("_had"),
        F.max(at).alias("_upto"), F.max_by(F.struct(*look), F.struct(*order)).alias("_tail"),
        F.count_if(opens).cast("int").alias("_new"), F.max(F.when(opens, at)).alias("_newest"), F.bool_or("_seed").alias("_known"),
    ).filter(F.col("_rows") > 0)
    follows = F.coalesce((F.col("_untimed") == 0) & (F.col("_first") > F.col("_had")), F.lit(False))
    per_key = per_key.withColumn("_late", F.col("_known") & ~follows).drop("_rows", "_first", "_untimed", "_had")
    versions = ordered(found.filter(opens).select(*rows.columns), spec.key, order, number="_n", cuts=cuts)
    if cuts is None:
        return per_key.join(versions, spec.key, "left")
    return match(versions, per_key, spec.key, "inner", cuts).unionByName(per_key.filter(F.col("_new") == 0), allowMissingColumns=True)


def continued(derived: DataFrame, columns: list[str], spec: HistorySpec, now: Column | None = None) -> DataFrame:
    """The dimension rows of the versions in ``derived``; ``columns`` are those of the staged rows."""
    base = F.coalesce(F.col("_past._versions"), F.lit(0)) if has_past(derived) else F.lit(0)
    rows = derived.filter(F.col("_n").isNotNull()).withColumns({
        spec.deleted: default_false(spec.deleted), spec.sequence: (base + F.col("_n")).cast("int"), "_latest": F.col("_newest"),
    })
    return required_and_valid(dimension_rows(rows, columns, spec, now), spec)


def closing(derived: DataFrame, spec: HistorySpec) -> DataFrame:
    """(key, version id, time, sequence, delete marker) of stored versions that a newer one ends."""
    first = derived.filter(F.col("_n") == 1)
    return first.select(spec.key, F.explode("_past._open").alias("_v")).select(spec.key, "_v.*")


def next_state(derived: DataFrame, stored: DataFrame, spec: HistorySpec) -> DataFrame:
    """The state of each key after the batch; ``stored`` are the versions that it stores."""
    kept = [spec.version_id, spec.ts, spec.sequence, spec.deleted]
    # Versions of one key and time only: a handful.
    current = stored.filter(F.col(spec.current)).groupBy(spec.key).agg(F.collect_list(F.struct(*kept)).alias("_now"))
    one = derived.filter(F.col("_n").isNull() | (F.col("_n") == 1)).join(current, spec.key, "left")
    if not has_past(derived):
        return one.select(spec.key, "_upto", "_tail", F.col("_new").alias("_versions"), F.col("_newest").alias("_latest"), F.coalesce("_now", F.array()).alias("_open"))
    was = {c: F.col(f"_past.{c}") for c in PAST}
    return one.select(
        spec.key, "_upto", "_tail", (F.coalesce(was["_versions"], F.lit(0)) + F.col("_new")).alias("_versions"),
        F.coalesce("_newest", was["_latest"]).alias("_latest"),
        F.when(F.col("_new") > 0, F.coalesce("_now", F.array())).otherwise(F.coalesce(was["_open"], F.array())).alias("_open"),
    )


def has_past(derived: DataFrame) -> bool:
    """Whether ``derived`` goes on from states, rather than being a build of all rows."""
    return derived.schema["_past"].dataType.typeName() == "struct"


def key_state(rows: DataFrame, spec: HistorySpec, cuts: Cuts | None = None, track_deletes: bool = False) -> DataFrame:
    """The state of every key from all its rows."""
    derived = advance(rows, spec, None, cuts, track_deletes)
    return next_state(derived, continued(derived, rows.columns, spec), spec)

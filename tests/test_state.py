"""States of keys: going on from them equals building everything."""

import os
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark import USERS
from tidemark.operators import history, state
from tidemark.operators.keyed import find_cuts
from tidemark.session import written
from tidemark.sources import states, tables
from tidemark.streaming import history as streams
from users import BEGIN, build, rows, same, shape

VALUES = ["North", "South", "Overseas", None, "North"]
changes = st.lists(st.tuples(st.sampled_from("AAABC"), st.integers(0, 12), st.sampled_from(VALUES), st.booleans()), min_size=1, max_size=25)


def by_key(states):
    return sorted((tuple(r) for r in states.select(USERS.key, *state.STATE).collect()), key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes, st.integers(0, 12), st.sampled_from([None, 3, 12]))
def test_going_on_equals_building(spark, data, split, segments):
    """Keys that follow get the versions and the state of a build; all others are marked."""
    full = rows(spark, *data)
    cuts = find_cuts(full, USERS.key, USERS.order(full.columns), segments) if segments else None
    old, new = (full.filter(F.datediff("update_date", F.lit(BEGIN)) < split), full.filter(F.datediff("update_date", F.lit(BEGIN)) >= split))
    before = written(state.key_state(old, USERS, cuts), "before")
    derived = written(state.advance(new, USERS, before, cuts), "derived")
    late = {r[0] for r in derived.filter("_late").select(USERS.key).collect()}
    assert late == set()  # the split is by time
    versions = state.continued(derived, new.columns, USERS, F.lit(BEGIN).cast("timestamp_ntz"))
    whole, first = build(full), build(old)
    keys = [k for k, *_ in data if k]
    grown = versions.unionByName(
        first.join(state.closing(derived, USERS).select(USERS.version_id, F.lit(True).alias("_ends")), USERS.version_id, "left")
        .withColumn(USERS.current, F.col(USERS.current) & F.col("_ends").isNull()).drop("_ends")
    )
    assert shape(grown) == shape(whole)
    after = state.next_state(derived, versions, USERS)
    known = {r[0]: r for r in by_key(before)} | {r[0]: r for r in by_key(after)}
    assert sorted(known.values(), key=repr) == by_key(state.key_state(full, USERS)) and set(known) == set(keys)


def test_late_and_untimed_rows_are_told(spark):
    past = rows(spark, ("A", 5, "North", False), ("B", 5, "North", False), ("C", 5, "North", False), ("D", 5, "North", False))
    known = written(state.key_state(past, USERS), "known")
    more = rows(spark, ("A", 6, "South", False), ("B", 5, "South", False), ("C", 4, "South", False), ("D", 7, "South", False), ("E", 1, "South", False))
    untimed = more.filter("user_id = 'D'").withColumn("update_date", F.lit(None).cast("timestamp_ntz"))
    derived = state.advance(more.unionByName(untimed), USERS, known)
    assert {r["user_id"]: r["_late"] for r in derived.collect()} == {"A": False, "B": True, "C": True, "D": True, "E": False}


def stream(spark, path, name, batches, segments=None, buckets=4):
    """Runs the batches as files of a stream, each to its end."""
    source, target, checkpoint = (str(path / f"{name}-{x}") for x in ("source", "target", "checkpoint"))
    for batch in batches:
        batch.write.mode("append").parquet(source)
        read = streams.stream_table(spark, source, batch.schema)
        streams.stream_scd2(read, USERS, target, checkpoint, layout=tables.Layout(buckets, 10), segments=segments).awaitTermination()
        yield target


@pytest.mark.parametrize("segments", [10])
def test_batches_in_any_order_equal_one_build(spark, tmp_path, segments, monkeypatch):
    monkeypatch.setattr(states, "FOLD", 3)
    rnd = random.Random(3)
    data = [(rnd.choice("AAAABCDEF"), rnd.randrange(40), rnd.choice(VALUES), rnd.random() < 0.2) for _ in range(120)]
    seen = []
    parts = [data[i::5] for i in range(5)]
    for part, target in zip(parts, stream(spark, tmp_path, "mixed", [rows(spark, *p) for p in parts], segments)):
        seen += part
        assert shape(tables.read_history(spark, target)) == shape(build(rows(spark, *seen)))


def test_batches_in_order_read_nothing_that_was_staged(spark, tmp_path):
    """The rows of earlier batches are spoilt; only a late row makes anyone look at them."""
    data = [("ABCDEFGH"[i % 8], i // 2, VALUES[i % 5], i % 7 == 0) for i in range(96)]
    parts = [rows(spark, *data[at : at + 32]) for at in (0, 32, 64)] + [rows(spark, ("A", 3, "West", False))]
    run = stream(spark, tmp_path, "ordered", parts)
    for turn in range(3):
        target = next(run)
        for folder, _, names in os.walk(f"{target}_staged"):
            for n in names:
                with open(f"{folder}/{n}", "wb") as f:
                    f.write(b"spoilt")
        assert shape(tables.read_history(spark, target)) == shape(build(rows(spark, *data[: 32 * (turn + 1)])))
    with pytest.raises(Exception, match="(?i)parquet|spoilt|FAILED_READ_FILE"):
        next(run)


@pytest.mark.parametrize("at", ["before the states", "before the table"])
def test_a_lost_batch_is_replayed(spark, tmp_path, monkeypatch, at):
    """The driver is lost after the merge and before the states are stored, or when half of the directories are replaced."""
    batches = [rows(spark, ("A", 1, "North", False), ("B", 1, "North", False)), rows(spark, ("A", 4, "South", False)), rows(spark, ("A", 6, "North", False), ("B", 9, "East", False))]
    run, keep = stream(spark, tmp_path, "lost", batches), states.keep_states
    target = next(run)

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    def half(rows, path, dynamic):
        write(rows.filter(F.col(tables.BUCKET) == rows.agg(F.min(tables.BUCKET)).first()[0]), path, dynamic)
        raise RuntimeError("driver lost")

    write = tables._write_parts
    if at == "before the states":
        monkeypatch.setattr(states, "keep_states", lost)
    else:
        monkeypatch.setattr(tables, "_write_parts", half)
    with pytest.raises(Exception, match="driver lost"):
        next(run)
    monkeypatch.setattr(states, "keep_states", keep)
    monkeypatch.setattr(tables, "_write_parts", write)
    again = streams.stream_table(spark, target.replace("-target", "-source"), batches[0].schema)
    batches[2].write.mode("append").parquet(target.replace("-target", "-source"))
    streams.stream_scd2(again, USERS, target, target.replace("-target", "-checkpoint"), layout=tables.Layout(4, 10)).awaitTermination()
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert shape(tables.read_history(spark, target)) == shape(build(whole))


def test_a_history_without_states_is_gone_on_with(spark, tmp_path):
    import shutil

    batches = [rows(spark, ("A", 1, "North", False), ("B", 1, "North", False)), rows(spark, ("A", 4, "South", False))]
    batches.append(rows(spark, ("A", 6, "West", False), ("B", 7, "South", False)))
    run = stream(spark, tmp_path, "old", batches)
    target = next(run)
    shutil.rmtree(f"{target}_states")
    for _ in range(2):
        next(run)
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert shape(tables.read_history(spark, target)) == shape(build(whole))
    assert same(tables.read_history(spark, target), history.scd2_build(whole, USERS), but=["_dbt_updated_at"])

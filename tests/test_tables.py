import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import USERS
from tidemark.operators import checks, history, metrics, report, staging
from tidemark.plans import catalog, feeds, lifecycle
from tidemark.sources import kept, landing, runs, states, tables
from tidemark.streaming.history import stream_scd2, stream_table
from tidemark.streaming.windows import merge_partials, read_windows, stream_windows, window_partials
from users import BEGIN, at, build, rows, same, shape



def now():
    return F.lit(BEGIN).cast("timestamp_ntz")

LAYOUT = tables.Layout(buckets=4, period_days=10)


def files(path):
    """Data files of a table by directory."""
    out = {}
    for root, _, names in os.walk(path):
        found = sorted(n for n in names if n.endswith(".parquet"))
        if found:
            out[os.path.relpath(root, path)] = found
    return out


@pytest.fixture
def stored(spark, tmp_path):
    first = rows(spark, *[(f"K{i}", t, d, False) for i in range(8) for t, d in ((1, "North"), (15, "South"))])
    path = str(tmp_path / "history")
    tables.write_history(build(first), path, USERS, LAYOUT)
    return first, path


def test_merge_rewrites_only_what_changed(spark, stored):
    first, path = stored
    before = files(path)
    later = first.unionByName(rows(spark, ("K3", 40, "East", False)))
    counts = tables.merge_into(spark, path, later, USERS, run_id="r1", layout=LAYOUT, now=now())
    assert counts == {"records_created": 1, "records_updated": 1, "records_deleted": 0}
    after = files(path)
    touched = {d for d in after if before.get(d) != after[d]}
    # The closed version's directory and the new version's; the rest is untouched.
    assert len(touched) == 2 and len(after) == len(before) + 1
    assert shape(tables.read_history(spark, path)) == shape(build(later))


def test_replayed_run_is_skipped(spark, stored):
    _, path = stored
    batch = rows(spark, ("K1", 30, "West", False))
    first = tables.merge_into(spark, path, batch, USERS, run_id="r", layout=LAYOUT, seeded=True, now=now())
    state = files(path)
    again = tables.merge_into(spark, path, batch, USERS, run_id="r", layout=LAYOUT, seeded=True, now=now())
    assert first["records_created"] == 1 and again["records_created"] == 0
    assert files(path) == state
    other = tables.merge_into(spark, path, batch, USERS, run_id="s", layout=LAYOUT, seeded=True, now=now())
    assert not any(other.values()) and files(path) == state


def test_lost_driver_between_staging_and_applying(spark, stored, monkeypatch):
    first, path = stored
    later = first.unionByName(rows(spark, ("K5", 41, "East", False)))

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    apply = tables._apply
    monkeypatch.setattr(tables, "_apply", lost)
    with pytest.raises(RuntimeError):
        tables.merge_into(spark, path, later, USERS, run_id="r", layout=LAYOUT, now=now())
    assert shape(tables.read_history(spark, path)) == shape(build(first))
    monkeypatch.setattr(tables, "_apply", apply)
    tables.recover(spark, path)
    assert shape(tables.read_history(spark, path)) == shape(build(later))
    assert not any(tables.merge_into(spark, path, later, USERS, run_id="r", layout=LAYOUT, now=now()).values())


def test_compact(spark, tmp_path):
    dim, path = build(rows(spark, *[(t, d, False) for t, d in enumerate(["North", "South"] * 6)])), str(tmp_path / "h")
    placed = tables.Layout(buckets=1, period_days=100).place(dim, USERS)
    placed.repartition(6).write.partitionBy(tables.BUCKET, tables.PERIOD).parquet(path)
    assert max(len(v) for v in files(path).values()) > 1
    assert tables.compact(spark, path, USERS, "2023-12-31 00:00:00") == 0
    assert tables.compact(spark, path, USERS, "2024-06-01 00:00:00") >= 1
    assert max(len(v) for v in files(path).values()) == 1
    assert same(tables.read_history(spark, path), dim)
    assert tables.compact(spark, path, USERS, "2024-06-01 00:00:00") == 0


def test_raw_sinks(spark, tmp_path):
    path = str(tmp_path / "raw")
    a = landing.stamp_extraction(spark.createDataFrame([(1,), (2,)], "id int"), "r1")
    b = landing.stamp_extraction(spark.createDataFrame([(3, "x")], "id int, more string"), "r2")
    assert tables.append_raw(a, path) == 2 and tables.append_raw(b, path) == 1
    back = tables.read_raw(spark, path)
    assert {r["id"]: r["more"] for r in back.collect()} == {1: None, 2: None, 3: "x"}
    assert dict(back.dtypes)["_extracted_date"] == "string"
    other = str(tmp_path / "replaced")
    tables.create_or_replace(a, other)
    tables.create_or_replace(b, other)
    assert spark.read.parquet(other).columns == b.columns


def test_landed_json_and_bookmark(spark, tmp_path):
    path, log = str(tmp_path / "landing"), str(tmp_path / "log")
    os.mkdir(path)
    records = [
        {"attributes": {"type": "User"}, "Id": "1", "Name": "Ann", "IsActive": True, "LastModifiedDate": "2024-01-05T10:00:00Z"},
        {"attributes": {"type": "User"}, "Id": "2", "Name": "Bob", "IsActive": False, "LastModifiedDate": "no time"},
        {"Id": "3", "Name": "Cy", "IsActive": None, "LastModifiedDate": "2024-01-03T10:00:00Z"},
    ]
    with open(f"{path}/a.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in records))
    raw = landing.type_times(landing.strip_envelope(landing.read_records(spark, path, landing.user_record_schema())))
    got = landing.lower_names(raw)
    assert "attributes" not in got.columns and got.filter("lastmodifieddate is null").count() == 1
    assert runs.last_mark(spark, log, "ingest") is None
    runs.record(spark, log, "ingest", "r1", "succeeded", "2024-01-03 10:00:00")
    runs.record(spark, log, "ingest", "r2", "failed", "2024-01-09 10:00:00")
    mark = runs.last_mark(spark, log, "ingest")
    assert mark == "2024-01-03 10:00:00"
    new = landing.read_incremental(got, "lastmodifieddate", mark, ordered=True)
    assert [r["id"] for r in new.collect()] == ["1"]
    none = landing.read_incremental(got, "lastmodifieddate", "2025-01-01")
    assert none.isEmpty() and none.schema == got.schema


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([(i, at(i), "x") for i in range(20)], "id int, t timestamp_ntz, wide string")
    tables.append_raw(landing.stamp_extraction(df, "r", F.col("t")), path)
    raw = tables.read_raw(spark, path)
    plan = landing.read_incremental(raw, "t", at(10), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(t," in plan and "wide" not in plan.split("ReadSchema")[1]
    plan = landing.lookback(raw, at(19))._jdf.queryExecution().executedPlan().toString()
    assert "_extracted_date" in plan.split("PartitionFilters")[1].split("]")[0]


def test_quarantine_report_and_view(spark, tmp_path):
    df = spark.createDataFrame([(None, "a", at(1)), ("1", " ", at(1)), ("2", "b", None), ("3", "c", at(1))],
                               "id string, name string, lastmodifieddate timestamp_ntz")
    good, bad = checks.quarantine(df, lifecycle.raw_rules())
    assert [r["id"] for r in good.collect()] == ["3"]
    path = str(tmp_path / "q")
    tables.write_quarantine(bad, path)
    assert {r["reject_reason"] for r in spark.read.parquet(path).collect()} == {
        "missing_id", "missing_name", "missing_lastmodifieddate"
    }
    tables.publish_view(good, "good_rows")
    assert spark.table("good_rows").count() == 1
    out = str(tmp_path / "report")
    tables.write_report(report.scd_report(report.scd_suite(build(rows(spark, (1, "North", False))), USERS)), out)
    assert spark.read.json(out).count() == 5


def test_analyze(spark, tmp_path):
    path = str(tmp_path / "t")
    build(rows(spark, (1, "North", False))).write.parquet(path)
    spark.sql(f"create table analyzed using parquet location '{path}'")
    try:
        tables.analyze(spark, "analyzed")
        found = spark.sql("describe extended analyzed division").collect()
        assert {r["info_name"]: r["info_value"] for r in found}["distinct_count"] == "1"
    finally:
        spark.sql("drop table analyzed")


def _event_files(spark, small, path, parts):
    """Events cut by time into files that arrive one after the other."""
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartitionByRange(parts, "ts").sortWithinPartitions("ts").write.parquet(path)
    for i, name in enumerate(sorted(n for n in os.listdir(path) if n.endswith(".parquet"))):
        os.utime(f"{path}/{name}", (1_700_000_000 + 100 * i,) * 2)
    return events


def test_stream_equals_batch(spark, small, tmp_path):
    source, target, cp = (str(tmp_path / n) for n in ("events", "target", "cp"))
    events = _event_files(spark, small, source, 2)

    def prepare(batch):
        rows = staging.to_history_names(staging.stage_users(feeds.raw_from(batch)))
        return staging.in_lists(rows, USERS.valid)

    stream = stream_table(spark, source, events.schema, max_files=1)
    stream_scd2(stream, USERS, target, cp, prepare, LAYOUT).awaitTermination()
    whole = catalog.Feed(spark, small).build(prepare(events))
    assert same(tables.read_history(spark, target), whole, but=["_dbt_updated_at"])
    state = files(target)
    # Nothing new: a second start finds nothing to do.
    stream_scd2(stream, USERS, target, cp, prepare, LAYOUT).awaitTermination()
    assert files(target) == state


def test_stream_windows_over_several_batches(spark, small, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("events", "out", "cp"))
    events = _event_files(spark, small, source, 4)
    stream = stream_table(spark, source, events.schema, max_files=1)
    values = stream.select(F.col("event_type").alias("metric"), "ts", "value")
    stream_windows(values, 21_600, out, cp).awaitTermination()
    want = metrics.metric_windows(events.select(F.col("event_type").alias("metric"), "ts", "value"), 21_600, "Sum")
    got = read_windows(spark, out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    rounded = lambda d: d.withColumn("value", F.round("value", 6))
    assert same(rounded(got), rounded(want))


def test_window_partials_take_a_batch_once(spark, tmp_path):
    """A batch that is replayed, whole or after half of its days, changes nothing; late rows reach only their day."""
    path = str(tmp_path / "w")
    value = lambda *r: spark.createDataFrame([(m, d, at(t), v) for m, d, t, v in r], "metric string, d string, ts timestamp_ntz, value double")
    batches = [
        value(("a", "x", 0, 1.0), ("a", "x", 0, 5.0), ("a", None, 0, 2.0), ("b", "x", 3, None)),
        value(("a", "x", 1, 7.0), ("a", "x", 2, 8.0)),
        value(("a", "x", 0, -3.0), ("a", None, 2, 4.0)),
    ]
    merge = lambda i, rows=None: merge_partials(path, window_partials(batches[i] if rows is None else rows, 86_400, ["d"]), i, ["d"])
    merge(0)
    merge(0)
    merge(1, batches[1].filter("value = 7"))  # lost after its first day
    merge(1)
    first = files(path)
    merge(2)
    merge(2)
    touched = {d for d, names in files(path).items() if first.get(d) != names}
    assert len(files(path)) == 3 and len(touched) == 2
    got = lambda s: sorted((r.metric, r.d, (r.window_start - BEGIN).days, r.value) for r in read_windows(spark, path, s, ["d"]).filter("d = 'x'").collect())
    assert got("Sum") == [("a", "x", 0, 3.0), ("a", "x", 1, 7.0), ("a", "x", 2, 8.0)]
    assert got("Average")[0][3] == 1.0 and got("Minimum")[0][3] == -3.0 and got("Maximum")[0][3] == 5.0 and got("SampleCount")[0][3] == 3.0
    none = read_windows(spark, path, "Sum", ["d"]).filter("d is null").orderBy("window_start").collect()
    assert [r.value for r in none] == [2.0, 4.0]


def test_lifecycle_gate_and_bookmark(spark, small, tmp_path):
    source = catalog.Feed(spark, small).raw.drop("_extracted_at", "_extraction_run_id", "_extracted_date")
    with pytest.raises(checks.QualityGateClosed):
        lifecycle.run_once(spark, source, str(tmp_path / "strict"), "r1", max_reject_percent=0.5)
    clean = staging.in_lists(
        staging.stage_users(source.withColumns({"_extracted_at": now(), "_extraction_run_id": F.lit("")})), USERS.valid
    ).drop("_extracted_at", "_extraction_run_id")
    early = clean.filter("lastmodifieddate < timestamp_ntz'2024-01-20'")
    root = str(tmp_path / "run")
    first = lifecycle.run_once(spark, early, root, "r1")
    assert first["pulled"] == early.count() and first["records_created"] > 0
    # The second run reads a day of extracts and continues the stored history.
    second = lifecycle.run_once(spark, clean, root, "r2", lookback_days=1)
    assert second["pulled"] == clean.count() - early.count() and second["records_updated"] > 0
    paths = lifecycle.Paths(root)
    whole = history.scd2_build(staging.to_history_names(
        clean.withColumns({"_extracted_at": now(), "_extraction_run_id": F.lit("")})), USERS)
    stamps = ["_dbt_updated_at", "_extracted_at", "_extraction_run_id"]
    assert same(tables.read_history(spark, paths.history), whole, but=stamps)
    third = lifecycle.run_once(spark, clean, root, "r3")
    assert third == {"run_id": "r3", "pulled": 0}
    latest = clean.agg(F.max("lastmodifieddate")).first()[0]
    assert runs.last_mark(spark, paths.log, lifecycle.JOB) == str(micros_of(latest))


def test_lifecycle_goes_on_after_a_lost_merge(spark, tmp_path, monkeypatch):
    changes = rows(spark, (1, "North", False), (2, "South", False)).withColumnsRenamed(
        {"user_id": "id", "is_active": "isactive", "update_date": "lastmodifieddate", "is_deleted": "isdeleted"}
    )
    source = changes.drop("_extracted_at", "_extraction_run_id").withColumn("createddate", F.col("lastmodifieddate"))
    root, merge = str(tmp_path / "run"), states.merge_derived

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(states, "merge_derived", lost)
    with pytest.raises(RuntimeError):
        lifecycle.run_once(spark, source, root, "r1")
    monkeypatch.setattr(states, "merge_derived", merge)
    again = lifecycle.run_once(spark, source, root, "r1")
    assert again["pulled"] == 0 and again["records_created"] == 2
    assert tables.read_raw(spark, lifecycle.Paths(root).raw).count() == 2


def test_a_late_row_makes_the_history_of_a_full_build(spark, tmp_path):
    """It opens a version, turns its follower into one, and takes another back."""
    path = str(tmp_path / "h")
    first = rows(spark, ("A", 1, "North", False), ("A", 4, "South", False), ("A", 8, "South", False), ("B", 2, "East", False))
    tables.merge_into(spark, path, first, USERS, run_id="r1", layout=LAYOUT, now=now(), complete=True)
    late = first.unionByName(rows(spark, ("A", 2, "South", False), ("A", 6, "Nowhere", False)))
    tables.merge_into(spark, path, late, USERS, run_id="r2", now=now(), complete=True, per_key=False, keys=late.select("user_id").distinct())
    assert shape(tables.read_history(spark, path)) == shape(build(late))
    # What was taken back comes again with the row that made it a version.
    later = late.unionByName(rows(spark, ("A", 3, "North", False)))
    tables.merge_into(spark, path, later, USERS, run_id="r3", now=now(), complete=True, keys=late.select("user_id").distinct())
    assert shape(tables.read_history(spark, path)) == shape(build(later))


def test_another_layout_is_refused(spark, stored):
    first, path = stored
    with pytest.raises(ValueError, match="laid out"):
        tables.merge_into(spark, path, first, USERS, run_id="x", layout=tables.Layout(16, 10), now=now())
    later = first.unionByName(rows(spark, ("K2", 33, "East", False)))
    tables.merge_into(spark, path, later, USERS, run_id="y", now=now())
    assert shape(tables.read_history(spark, path)) == shape(build(later))


def test_first_load_lost_before_it_is_applied(spark, tmp_path, monkeypatch):
    path, batch, apply = str(tmp_path / "h"), rows(spark, (1, "North", False), (2, "South", False)), tables._apply

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_apply", lost)
    with pytest.raises(RuntimeError):
        tables.merge_into(spark, path, batch, USERS, run_id="r", layout=LAYOUT, now=now())
    assert not os.path.exists(path)
    monkeypatch.setattr(tables, "_apply", apply)
    tables.merge_into(spark, path, batch, USERS, run_id="r", layout=LAYOUT, now=now())
    assert shape(tables.read_history(spark, path)) == shape(build(batch))


def test_a_run_lost_before_its_bookmark_is_not_doubled(spark, tmp_path, monkeypatch):
    paths, record = lifecycle.Paths(str(tmp_path)), runs.record
    source = spark.createDataFrame([(str(i), at(i)) for i in range(9)], "id string, lastmodifieddate timestamp_ntz")

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(runs, "record", lost)
    with pytest.raises(RuntimeError):
        lifecycle.ingest(spark, source.filter("id < '5'"), paths, "r1")
    monkeypatch.setattr(runs, "record", record)
    assert lifecycle.ingest(spark, source.filter("id < '7' and id <> '3'"), paths, "r1") == 6
    # The row that reached the source late is found by the overlap, and nothing else again.
    assert lifecycle.ingest(spark, source, paths, "r2", overlap_days=9) == 3
    assert sorted(r.id for r in tables.read_raw(spark, paths.raw).collect()) == [str(i) for i in range(9)]
    assert runs.last_mark(spark, paths.log, lifecycle.JOB) == str(micros_of(at(8)))


def micros_of(t) -> int:
    return (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def test_repeats_and_untimed_rows_are_landed_as_often_as_they_come(spark, tmp_path):
    """A row given three times is three rows, with an overlap or without; rows without a time land in any run, once."""
    timed = [(str(i), at(i)) for i in range(9)]
    source = spark.createDataFrame(timed * 3 + [("x", None), ("x", None)], "id string, lastmodifieddate timestamp_ntz")
    landed = lambda p: sorted(tuple(r) for r in tables.read_raw(spark, p.raw).groupBy("id").count().collect())
    for overlap in (0, 2, 30):
        paths = lifecycle.Paths(str(tmp_path / str(overlap)))
        early = source.filter("id < '5'")
        assert lifecycle.ingest(spark, early, paths, "r1", overlap_days=overlap) == 15
        more = source.unionByName(spark.createDataFrame([("4", at(4)), ("y", None)], source.schema))
        # The fourth copy of a row of the last day is only seen with an overlap.
        late = 1 if overlap else 0
        assert lifecycle.ingest(spark, more, paths, "r2", overlap_days=overlap) == 12 + 3 + late
        want = [(str(i), 3 + late * (i == 4)) for i in range(9)] + [("x", 2), ("y", 1)]
        assert landed(paths) == want
        assert lifecycle.ingest(spark, more, paths, "r3", overlap_days=overlap) == 0 and landed(paths) == want


def test_only_untimed_rows_at_first(spark, tmp_path):
    paths = lifecycle.Paths(str(tmp_path))
    source = spark.createDataFrame([("x", None), ("a", at(1))], "id string, lastmodifieddate timestamp_ntz")
    assert lifecycle.ingest(spark, source.filter("id = 'x'"), paths, "r1") == 1
    assert lifecycle.ingest(spark, source, paths, "r2") == 1
    assert lifecycle.ingest(spark, source, paths, "r3") == 0


def test_untimed_rows_of_a_second_run_reach_quarantine(spark, tmp_path):
    changes = rows(spark, *[(t, "North", False) for t in range(1, 60)]).withColumnsRenamed(
        {"user_id": "id", "is_active": "isactive", "update_date": "lastmodifieddate", "is_deleted": "isdeleted"}
    )
    source = changes.drop("_extracted_at", "_extraction_run_id").withColumn("createddate", F.col("lastmodifieddate"))
    lifecycle.run_once(spark, source.filter("lastmodifieddate < timestamp_ntz'2024-01-20'"), str(tmp_path), "r1")
    untimed = source.limit(1).withColumn("lastmodifieddate", F.lit(None).cast("timestamp_ntz"))
    second = lifecycle.run_once(spark, source.unionByName(untimed), str(tmp_path), "r2", overlap_days=3)
    assert second["pulled"] == 42
    rejected = spark.read.parquet(f"{lifecycle.Paths(str(tmp_path)).quarantine}/r2").collect()
    assert [r.reject_reason for r in rejected] == ["missing_lastmodifieddate"]


def test_kept_counts_follow_a_merge(spark, stored):
    """The suite after a merge is that of the whole history, though only touched buckets are read and replaced."""
    first, path = stored
    assert kept.refresh_counts(spark, path, USERS) is None
    before = files(kept.counts_path(path))
    later = first.unionByName(rows(spark, ("K3", 16, "South", False), ("K3", 17, "East", False), ("new", 2, "West", True)))
    keys = spark.createDataFrame([("K3",), ("new",)], "user_id string")
    tables.merge_into(spark, path, later, USERS, run_id="r1", now=now(), keys=keys, complete=True)
    used = kept.refresh_counts(spark, path, USERS, keys)
    touched = {d for d, names in files(kept.counts_path(path)).items() if before.get(d) != names}
    assert len(used) in (1, 2) and touched == {f"_bucket={b}" for b in used}
    dim = tables.read_history(spark, path)
    assert same(report.suite_of(kept.read_counts(spark, path)), report.scd_suite(dim, USERS))
    score = report.integrity_score(kept.read_counts(spark, path)).first().score
    assert score == checks.quality_scores(first, [], dim, USERS).filter("metric = 'SCDIntegrityScore'").first().score
    # Other buckets' history is not looked at.
    plan = tables.read_history(spark, path, used)._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_scheduled_runs_in_order_late_and_with_a_lookback(spark, tmp_path):
    """Whatever the order of the runs' ways, the history is that of a full build of all landed rows."""
    given = lambda *c: rows(spark, *c).withColumnsRenamed({"user_id": "id", "is_active": "isactive", "update_date": "lastmodifieddate", "is_deleted": "isdeleted"}).drop(
        "_extracted_at", "_extraction_run_id").withColumn("createddate", F.col("lastmodifieddate"))
    parts = [
        [("A", 1, "North", False), ("B", 1, "North", False), ("C", 1, "East", False)],
        [("A", 4, "South", False), ("D", 4, "West", False)],
        [("A", 3, "East", False), ("B", 5, "South", True)],  # one of them late
        [("C", 6, "West", False)],
        [("A", 8, "North", False), ("C", 7, "West", False)],
    ]
    root, landed = str(tmp_path), []
    for i, part in enumerate(parts):
        landed += part
        how = {"lookback_days": 30, "as_of": at(9)} if i == 3 else {"overlap_days": 4}
        got = lifecycle.run_once(spark, given(*landed), root, f"r{i}", now=F.lit(at(i)).cast("timestamp_ntz"), **how)
        assert got["pulled"] == len(part)
        assert shape(tables.read_history(spark, lifecycle.Paths(root).history)) == shape(build(rows(spark, *landed)))

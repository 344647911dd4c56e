from datetime import timedelta

import pytest
from hypothesis import HealthCheck, example, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark import USERS
from tidemark.functions.ids import bucket_of, hash_bigint
from tidemark.operators import checks, metrics, report, serve
from tidemark.operators.keyed import find_cuts
from tidemark.operators.metrics import ALARMS, HEALTH_MEMBERS, AlarmRule
from tidemark.plans import catalog
from tidemark.session import written
from users import at, build, rows, same


def test_checks_do_not_depend_on_cuts(spark, small):
    f = catalog.Feed(spark, small)
    dim = written(f.dim, "dim")
    cuts = find_cuts(f.rows, USERS.key, USERS.order(f.rows.columns), segments=60)
    assert cuts is not None
    for check in (checks.unchanged_versions, checks.history_gaps, report.scd_suite):
        assert same(check(dim, USERS, cuts=cuts), check(dim, USERS)), check.__name__
    from tidemark.operators import history

    assert same(history.with_validity(dim, USERS, cuts), history.with_validity(dim, USERS))
    assert same(history.version_tracking(dim, USERS, cuts), history.version_tracking(dim, USERS))
    assert same(history.ensure_currency(dim, USERS, cuts), history.ensure_currency(dim, USERS))
    assert same(serve.state_at(history.with_validity(dim, USERS, cuts), USERS, catalog.MIDDLE), serve.state_at(dim, USERS, catalog.MIDDLE))


def plain_sweep(data):
    """(key, from, to, reached, problem) by looking at every earlier interval."""
    out = []
    data = sorted(data, key=lambda r: (r[0], r[1], -1 if r[2] is None else r[2]))
    for i, (k, a, b) in enumerate(data):
        before = [e for key, s, e in data[:i] if key == k and (e is None or e > s)]
        reached = None if None in before else max(before, default=None)
        if b is not None and b < a:
            out.append((k, a, b, reached, "inverted"))
        elif (b is None or b > a) and any(e is None or e > a for e in before):
            out.append((k, a, b, reached, "overlap"))
        elif (b is None or b > a) and before and max(before) < a:
            out.append((k, a, b, reached, "gap"))
    return out


intervals = st.lists(st.tuples(st.sampled_from("AAAB"), st.integers(0, 30), st.one_of(st.none(), st.integers(0, 35))), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@example([("A", 1, 20), ("A", 2, 3), ("A", 5, 6)], 4)
@example([("A", 1, 2), ("A", 2, 4), ("A", 6, 7), ("A", 8, None), ("A", 30, 31)], 3)
@given(intervals, st.integers(1, 12))
def test_interval_sweep(spark, data, segments):
    time = lambda x: None if x is None else at(x)
    df = spark.createDataFrame([(k, at(a), time(b)) for k, a, b in data], "user_id string, effective_from timestamp_ntz, effective_to timestamp_ntz")
    want = sorted(((k, at(a), time(b), time(r), p) for k, a, b, r, p in plain_sweep(data)), key=repr)
    for cuts in (None, find_cuts(df, "user_id", ["effective_from", "effective_to"], segments)):
        assert sorted(map(tuple, checks.interval_overlaps(df, USERS, cuts).collect()), key=repr) == want


def test_gate(spark):
    report_ = spark.createDataFrame([("a", True), ("b", False)], "measure string, passed boolean")
    with pytest.raises(checks.QualityGateClosed, match="b"):
        checks.gate(report_)
    checks.gate(report_.filter("passed"))


def test_groups_stop_after_a_failed_critical_group(spark):
    good, bad = spark.range(0), spark.range(3)
    groups = {
        "scd_logic": ("error", {"l1": lambda: bad}),
        "data_quality": ("error", {"d1": lambda: good, "d2": lambda: bad}),
        "scd_continuity": ("error", {"c1": lambda: good}),
    }
    results = report.run_groups(groups)
    assert [(r["test_name"], r["success"], r["violations"]) for r in results] == [
        ("l1", False, 3), ("d1", True, 0), ("d2", False, 3)
    ]
    warned = report.run_groups({**groups, "data_quality": ("warn", groups["data_quality"][1])})
    assert [r["test_name"] for r in warned] == ["l1", "d1", "d2", "c1"]
    summary = report.suite_summary(spark.createDataFrame([(r["success"],) for r in results], "ok boolean"), F.col("ok"))
    assert tuple(summary.first()) == (3, 1, 2, 33.33)
    empty = report.suite_summary(spark.createDataFrame([], "ok boolean"), F.col("ok"))
    assert tuple(empty.first()) == (0, 0, 0, 0.0)


def test_report_requires_success(spark):
    sound = report.scd_report(report.scd_suite(build(rows(spark, (1, "North", False), (2, "South", False))), USERS))
    report.require_success(sound)
    assert {r["test_status"] for r in sound.collect()} == {"PASS"}
    gap = report.scd_report(report.scd_suite(build(rows(spark, (1, "North", False), (9, "South", False))), USERS))
    with pytest.raises(checks.QualityGateClosed, match="scd_history_completeness"):
        report.require_success(gap)


def test_column_checks_on_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (2, "z")], "id int, v string")
    assert {r["column_name"]: r["null_count"] for r in checks.not_null(df, ["id", "v"]).collect()} == {"id": 1, "v": 1}
    assert [tuple(r) for r in checks.unique(df, ["id"]).collect()] == [(1, 2)]
    assert {r["value_field"] for r in checks.accepted_values(df, "v", ["x", "z"]).collect()} == {"y"}
    assert checks.null_rows(df, "id").count() == 1
    flags = spark.createDataFrame([(True,), (None,)], "f boolean")
    assert checks.accepted_values(flags, "f", [True, False]).isEmpty()


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "id string, name string, lastmodifieddate timestamp_ntz")
    assert checks.reject_rate(df, [("a", F.col("id").isNull())]).first()["batch_accepted"]
    got = checks.freshness(df, "lastmodifieddate", at(1)).first()
    assert got["is_stale"] and got["total_records"] == 0
    assert not checks.min_records(df).first()["passed"]


def test_buckets_and_bigint_ids(spark):
    df = rows(spark, *[(f"K{i}", 1, "North", False) for i in range(200)])
    got = df.select(bucket_of("user_id", 8).alias("b"), hash_bigint(df, ["user_id", "update_date"]).alias("h"))
    assert {r["b"] for r in got.collect()} == set(range(8))
    assert got.select("h").distinct().count() == 200


def test_missing_periods_and_consecutive_breaches(spark):
    data = [("DataQualityScore", at(0), 99.0), ("DataQualityScore", at(0.25), 90.0), ("DataQualityScore", at(0.5), 91.0)]
    m = spark.createDataFrame(data, "metric string, ts timestamp_ntz, value double")
    rules = [
        AlarmRule("two", "DataQualityScore", "Average", 21600, "<", 95, 2, "breaching"),
        AlarmRule("quiet", "DataQualityScore", "Average", 21600, "<", 95, 1, "notBreaching"),
        AlarmRule("absent", "Nothing", "Sum", 21600, "<", 100, 1, "breaching"),
    ]
    states = metrics.alarm_states(m, rules, at(0), at(1)).orderBy("alarm", "window_start").collect()
    by = lambda a: [r["in_alarm"] for r in states if r["alarm"] == a]
    assert by("two") == [False, False, True, True]
    assert by("quiet") == [False, True, True, False]
    assert by("absent") == [True, True, True, True]


def test_alarms_of_each_series_in_steps(spark):
    """Any cut into evaluations gives the states of one; a series without data is watched too."""
    rows = [("e", d, at(0) + timedelta(minutes=m), v) for d, m, v in [("x", 1, 9.0), ("x", 11, 9.0), ("x", 21, 9.0), ("y", 1, 9.0), ("y", 15, 1.0), ("y", 22, 9.0), (None, 31, 9.0)]]
    m = spark.createDataFrame(rows, "metric string, d string, ts timestamp_ntz, value double")
    rules = [AlarmRule("high", "e", "Sum", 600, ">", 5, 2), AlarmRule("gone", "e", "Sum", 600, "<", 0, 2, "breaching")]
    series = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "d string")
    end = at(0) + timedelta(minutes=60)
    key = lambda r: (r.alarm, r.d or "", r.window_start)
    whole = sorted(metrics.alarm_states(m, rules, at(0), end, dims=["d"], series=series).collect(), key=key)
    assert len(whole) == 2 * 4 * 6
    alarm = lambda a, d: [r.in_alarm for r in whole if r.alarm == a and r.d == d]
    assert alarm("high", "x") == [False, True, True, False, False, False] and not any(alarm("high", "y"))
    assert alarm("gone", "z") == [False] + [True] * 5 and alarm("gone", None) == [False, True, True, False, False, True]
    for cut in (10, 20, 40):
        middle = at(0) + timedelta(minutes=cut)
        one = metrics.alarm_states(m, rules, at(0), middle, dims=["d"], series=series)
        two = metrics.alarm_states(m, rules, middle, end, dims=["d"], series=series, carried=metrics.streaks(one, ["d"]))
        assert sorted(one.unionByName(two).collect(), key=key) == whole
    # Without a list of series: those that have data.
    assert {r.d for r in metrics.alarm_states(m, rules, at(0), end, dims=["d"]).select("d").distinct().collect()} == {"x", "y", None}


def test_known_alarms():
    assert len(ALARMS) == 8 and len(HEALTH_MEMBERS) == 6
    assert {a.alarm for a in ALARMS} - set(HEALTH_MEMBERS) == {"pipeline-duration", "record-volume"}

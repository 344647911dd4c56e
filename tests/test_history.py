import pytest
from pyspark.sql import functions as F

from tidemark import USERS
from tidemark.operators import checks, history, merge, serve
from tidemark.operators.keyed import find_cuts
from users import at, build, rows, same, shape

CASES = {
    "no version without a change": (
        [(1, "North", False), (2, "North", False)],
        [(1, "North", True, 1, None, False)],
    ),
    "back to the first value": (
        [(1, "North", False), (2, "South", False), (3, "North", False)],
        [(1, "North", False, 1, 2, False), (2, "South", False, 2, 3, False), (3, "North", True, 3, None, False)],
    ),
    "to NULL is no change, from NULL is one": (
        [(1, "North", False), (2, None, False), (3, "North", False)],
        [(1, "North", False, 1, 3, False), (3, "North", True, 2, None, False)],
    ),
    "an invalid latest version leaves no current row": (
        [(1, "North", False), (2, "Overseas", False)],
        [(1, "North", False, 1, None, False)],
    ),
    "a delete without a change is lost": (
        [(1, "North", False), (2, "North", True)],
        [(1, "North", True, 1, None, False)],
    ),
    "a deleted version is never current": (
        [(1, "North", False), (2, "South", True)],
        [(1, "North", False, 1, 2, False), (2, "South", False, 2, None, True)],
    ),
    "ties at the latest time are both current": (
        [(1, "North", False), (2, "South", False), (2, "East", False)],
        [(1, "North", False, 1, 2, False), (2, "East", True, 2, 2, False), (2, "South", True, 3, None, False)],
    ),
    "an invalid version leaves a hole in the sequence": (
        [(1, "North", False), (2, "Overseas", False), (3, "North", False)],
        [(1, "North", False, 1, 3, False), (3, "North", True, 3, None, False)],
    ),
}


@pytest.mark.parametrize("segments", [None, 3, 20, 200])
def test_golden(spark, segments):
    """All cases in one history, a key each."""
    df = rows(spark, *[(case, *g) for case, (given, _) in CASES.items() for g in given])
    cuts = find_cuts(df, "user_id", USERS.order(df.columns), segments) if segments else None
    assert (cuts is not None) == (segments in (20, 200))
    found = shape(build(df, cuts))
    for case, (_, expected) in CASES.items():
        assert [f[1:] for f in found if f[0] == case] == sorted(expected, key=repr), case


def test_unchanged_flags_the_row_after_a_hole(spark):
    dim = build(rows(spark, (1, "North", False), (2, "Overseas", False), (3, "North", False)))
    assert [r["update_date"] for r in checks.unchanged_versions(dim, USERS).collect()] == [at(3)]


def test_options(spark):
    lost = rows(spark, (1, "North", False), (2, "North", True))
    assert shape(build(lost, track_deletes=True)) == [
        ("K", 1, "North", False, 1, 2, False), ("K", 2, "North", False, 2, None, True)
    ]
    invalid = rows(spark, (1, "North", False), (2, "Overseas", False), (3, "North", False))
    assert shape(build(invalid, filter_first=True)) == [("K", 1, "North", True, 1, None, False)]


def test_copies_do_not_matter(spark):
    df = rows(spark, *[(t, d, False) for t, d in [(1, "North"), (2, "South"), (2, "East"), (3, "West")]])
    copies = df.unionByName(df).unionByName(df)
    for segments in (4, 7, 60):
        cuts = find_cuts(copies, "user_id", USERS.order(copies.columns), segments)
        assert shape(build(df)) == shape(build(copies)) == shape(build(copies, cuts))
    assert cuts.copies.count() == 4 and cuts.once(copies, "user_id", USERS.order(copies.columns)).count() == 4


def test_any_key_type_and_bigint_tracked(spark):
    spec = history.HistorySpec(key="k", ts="t", tracked=("v",), deleted="gone")
    df = spark.createDataFrame(
        [(1, at(1), 5, False), (1, at(2), 5, False), (1, at(3), None, False), (1, at(4), 7, False)],
        "k bigint, t timestamp, v int, gone boolean",
    )
    dim = history.scd2_build(df, spec)
    assert [(r["v"], r["is_current"]) for r in dim.orderBy("t").collect()] == [(5, False), (7, True)]


def test_point_in_time(spark):
    dim = build(rows(spark, ("A", 1, "North", False), ("A", 5, "South", False), ("B", 3, "East", False)))
    got = lambda t: sorted((r["user_id"], r["division"]) for r in serve.state_at(dim, USERS, at(t)).collect())
    assert got(0) == []
    assert got(1) == [("A", "North")]
    assert got(5) == [("A", "South"), ("B", "East")]


def test_as_of_skips_facts_before_the_first_version_and_without_key(spark):
    dim = build(rows(spark, ("A", 2, "North", False), ("A", 5, "South", False)))
    facts = spark.createDataFrame(
        [(1, "A", at(1)), (2, "A", at(2)), (3, "A", at(4)), (4, "A", at(9)), (5, "Z", at(9)), (6, None, at(9)), (7, "A", None)],
        "n int, who string, t timestamp_ntz",
    )
    for segments in (1, 4, 30):
        got = serve.as_of(facts, dim, USERS, "who", "t", ["division"], segments)
        assert {r["n"]: r["division"] for r in got.collect()} == {
            1: None, 2: "North", 3: "North", 4: "South", 5: None, 6: None, 7: None
        }


def test_snapshot_and_ids(spark):
    df = rows(spark, (1, "North", False), (1, "South", False), (4, "South", False))
    got = history.snapshot_by_timestamp(df, "user_id", "update_date").orderBy("valid_from").collect()
    assert [(r["valid_from"], r["valid_to"]) for r in got] == [(at(1), at(4)), (at(4), None)]
    dim = build(df)
    assert checks.duplicate_ids(dim, ["_scd_id"]).isEmpty()
    # The row at 4 repeats the later of the two rows at 1, so it is no version.
    assert merge.high_water_mark(dim, "update_date").first()[0] == at(1)


def test_ids_do_not_depend_on_the_session_zone(spark):
    df = rows(spark, (1, "North", False))
    zone = spark.conf.get("spark.sql.session.timeZone")
    ids = set()
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            ids.add(build(df).select("_scd_id").first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(ids) == 1


def test_statistics_of_an_empty_history(spark):
    dim = build(rows(spark, (1, "North", False))).filter(F.lit(False))
    assert serve.scd_statistics(dim, USERS).first()["total_records"] == 0
    got = serve.performance_metrics(dim, USERS).first()
    assert got["total_records"] == 0 and got["valid_division_ratio"] is None
    assert '"total_records":0' in serve.performance_json(dim, USERS).first()["metrics"]


def test_a_key_that_holds_everything_at_one_time(spark):
    """300 000 rows of one key and one time: no segment holds much more than its share, copies or not."""
    wide = spark.range(300_000).selectExpr(
        "'K' as user_id", "concat('name ', id) as name", "element_at(array('North', 'South', 'East'), cast(pmod(hash(id), 3) + 1 as int)) as division",
        "'Phase1' as audit_phase__c", "true as is_active", "timestamp_ntz'2024-01-05 00:00:00' as update_date", "false as is_deleted",
        "timestamp_ntz'2024-01-05 00:00:00' as _extracted_at", "'r' as _extraction_run_id",
    )
    order = USERS.order(wide.columns)
    cuts = find_cuts(wide, "user_id", order, 30)
    sizes = [r["count"] for r in cuts.place(wide, "user_id", order).groupBy("_cell").count().collect()]
    assert len(sizes) > 25 and max(sizes) < 25_000
    assert same(build(wide, cuts), build(wide))
    copies = wide.withColumns({"name": F.lit("one"), "division": F.lit("North")})
    cuts = find_cuts(copies, "user_id", order, 30)
    assert cuts.once(copies, "user_id", order).count() == 1 and same(build(copies, cuts), build(copies))

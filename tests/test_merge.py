from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import USERS
from tidemark.operators import history, merge, staging
from tidemark.operators.keyed import find_cuts
from tidemark.plans import catalog
from tidemark.session import written
from users import BEGIN, SCHEMA, at, build, rows, same, shape



def now():
    return F.lit(BEGIN).cast("timestamp_ntz")



def merged(target, staged, **options):
    return merge.scd2_merge(written(target, "t"), staged, USERS, now=now(), **options)


def test_partial_staging(spark):
    """Only the recent row is staged: the old version is closed, the new one inserted."""
    target = build(rows(spark, (1, "North", False)))
    recent = rows(spark, (2, "South", False))
    assert shape(merged(target, recent)) == [("K", 1, "North", False, 1, 2, False), ("K", 2, "South", True, 1, None, False)]
    assert shape(merged(target, recent, seeded=True)) == [
        ("K", 1, "North", False, 1, 2, False), ("K", 2, "South", True, 2, None, False)
    ]


def test_partial_staging_without_a_change_keeps_the_current_version(spark):
    target = build(rows(spark, (1, "North", False)))
    assert shape(merged(target, rows(spark, (2, "North", False)), seeded=True)) == shape(target)


def test_late_row_of_a_quiet_key(spark):
    """The overall mark overlooks it, the key's own mark does not."""
    target = build(rows(spark, ("A", 1, "North", False), ("B", 9, "East", False)))
    late = rows(spark, ("A", 5, "South", False))
    assert shape(merged(target, late)) == shape(target)
    found = shape(merged(target, late, per_key=True, seeded=True))
    assert ("A", 5, "South", True, 2, None, False) in found and ("A", 1, "North", False, 1, 5, False) in found


def test_late_rows_give_the_same_as_a_full_build(spark):
    old, batch = [(1, "North", False), (8, "East", False)], [(4, "South", False), (9, "East", False)]
    found = merged(build(rows(spark, *old)), rows(spark, *batch), seeded=True, per_key=True)
    # The row at 9 repeats the stored version at 8, which moves from second to third.
    assert shape(found) == shape(build(rows(spark, *old, *batch)))


def test_seeded_merge_without_broadcast_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_late_rows_give_the_same_as_a_full_build(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_target_and_empty_batch(spark):
    full = rows(spark, (1, "North", False), (2, "South", False))
    none = build(full).filter(F.lit(False))
    assert shape(merged(none, full)) == shape(build(full))
    assert shape(merged(build(full), full.filter(F.lit(False)))) == shape(build(full))


@pytest.mark.parametrize("at, split", [("2024-01-04", False), ("2024-01-23 05:00:00", True)])
def test_two_batches_equal_one(spark, small, at, split):
    f = catalog.Feed(spark, small)
    cuts = find_cuts(f.rows, USERS.key, USERS.order(f.rows.columns), segments=50) if split else None
    old = written(f.build(f.before(at)), "old")
    assert same(merge.scd2_merge(old, f.rows, USERS, cuts=cuts, now=catalog.now()), f.dim)


def test_merging_again_changes_only_the_stamp(spark, small):
    f = catalog.Feed(spark, small)
    dim = written(f.dim, "dim")
    changes = merge.scd2_changes(dim, f.rows, USERS)
    again = merge.merge_on_key(dim, changes, ["_scd_id"], merge.merge_update_columns(USERS))
    assert same(again, dim, but=["_dbt_updated_at"])
    assert merge.merge_stats(dim, changes, USERS).first().asDict() == {
        "records_created": 0, "records_updated": 0, "records_deleted": 0
    }


def test_seeded_equals_full_build_on_valid_values(spark):
    values = ["North", "South", "South", "East", "East", "West", "North", "North"]
    full = rows(spark, *[(k, 2 * i + j, v, False) for j, k in enumerate("AB") for i, v in enumerate(values)])
    cut = F.lit(at(7)).cast("timestamp_ntz")
    target = build(full.filter(F.col("update_date") < cut))
    recent = full.filter(F.col("update_date") >= cut)
    cuts = find_cuts(full, "user_id", USERS.order(full.columns), segments=8)
    whole = shape(build(full))
    assert shape(merged(target, recent, seeded=True)) == whole
    assert shape(merged(target, recent, seeded=True, cuts=cuts)) == whole
    # A window that overlaps what is stored derives the same versions again.
    overlap = full.filter(F.col("update_date") >= F.lit(at(3)).cast("timestamp_ntz"))
    assert shape(merged(target, overlap, seeded=True)) == whole


def test_no_false_changes_on_clean_input(spark, small):
    from tidemark.operators import checks

    f = catalog.Feed(spark, small)
    clean = staging.in_lists(f.rows.filter(~F.col("is_deleted")), USERS.valid)
    assert checks.unchanged_versions(history.scd2_build(clean, USERS), USERS).isEmpty()


SECOND = "id string, division string, audit_phase__c string, lastmodifieddate timestamp_ntz"


def second(spark, *data):
    return spark.createDataFrame([(k, d, p, at(t)) for k, t, d, p in data], SECOND)


def brute_force_ends(target, source):
    """First source time that differs, by looking at all pairs."""
    differs = lambda a, b: a is not None and b is not None and a != b
    out = {}
    for i, t in enumerate(target):
        times = [s[1] for s in source if s[0] == t[0] and (differs(t[2], s[2]) or differs(t[3], s[3]))]
        out[i] = min(times, default=None)
    return out


def test_closing_times_without_pairs(spark):
    values = [None, "North", "South", "East"]
    target = [(k, t, d, p) for k, t in (("A", 1), ("B", 1)) for d in values for p in (None, "P1", "P2")]
    source = [("A", 9, "North", "P1"), ("A", 8, None, "P2"), ("A", 7, "North", None), ("A", 11, "East", "P2"),
              ("B", 5, "North", "P1"), ("B", 5, "South", "P1"), ("C", 4, "East", "P1")]
    df = merge.dim_full(second(spark, *target)).withColumn("n", F.monotonically_increasing_id())
    src = second(spark, *source)
    for cuts in (None, find_cuts(df, "id", ["lastmodifieddate", "n"], segments=8)):
        got = merge.changed_active_rows(df, src, "id", ["division", "audit_phase__c"], cuts=cuts).collect()
        found = {(r["id"], r["division"], r["audit_phase__c"]): (r["changed_at"] - BEGIN).days for r in got}
        ends = brute_force_ends(target, source)
        assert found == {(t[0], t[2], t[3]): ends[i] for i, t in enumerate(target) if ends[i] is not None}


def test_second_dimension_equals_the_merge_by_key(spark):
    old = merge.dim_full(second(spark, ("A", 1, "North", "P1"), ("A", 2, "South", "P1"), ("B", 2, "East", "P1")))
    staged = second(spark, ("A", 2, "South", "P1"), ("A", 5, "South", "P1"), ("B", 4, None, "P1"))
    changes = merge.dim_changes(old, staged)
    by_key = merge.merge_on_key(old, changes, ["id", "dwh_start_ts"], ["dwh_end_ts", "dwh_active_flag"])
    assert same(merge.dim_merge(old, staged), by_key)
    ended = by_key.filter(~F.col("dwh_active_flag")).collect()
    assert [(r["id"], r["dwh_start_ts"], r["dwh_end_ts"]) for r in ended] == [("A", at(1), at(5))]


def test_upsert_prefers_the_source_at_equal_times(spark):
    t = rows(spark, ("A", 1, "North", False), ("B", 5, "North", False))
    s = rows(spark, ("A", 1, "South", False), ("B", 4, "South", False), ("C", 1, "East", False))
    got = merge.upsert_latest(t, s, "user_id", "update_date").collect()
    assert {r["user_id"]: r["division"] for r in got} == {"A": "South", "B": "North", "C": "East"}


def test_staging_cases(spark):
    schema = """id string, name string, division string, audit_phase__c string, isactive boolean, isdeleted boolean,
    lastmodifieddate timestamp, createddate timestamp, _extracted_at timestamp, _extraction_run_id string"""
    t = datetime(2024, 1, 1)
    raw = spark.createDataFrame(
        [("1", " Ann ", " north ", " PHASE1 ", None, None, t, t, t, "r"),
         ("2", "Bob", " Overseas ", None, True, True, t, t, t, "r"),
         ("3", "   ", "North", "Phase1", True, False, t, t, t, "r"),
         (None, "Cy", "North", "Phase1", True, False, t, t, t, "r"),
         ("5", "Di", "North", "Phase1", True, False, None, t, t, "r")],
        schema,
    )
    got = {r["id"]: r for r in staging.stage_users(raw).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"]["name"], got["1"]["division"], got["1"]["audit_phase__c"], got["1"]["isactive"]) == ("Ann", "North", "Phase1", False)
    assert got["2"]["division"] == " Overseas " and got["2"]["isdeleted"]


def test_schema_changes(spark):
    old = spark.createDataFrame([(1, "a", 2)], "id int, name string, gone int")
    new = spark.createDataFrame([("1", "a", True)], "id string, name string, more boolean")
    got = {(r["column_name"], r["change"]) for r in staging.schema_changes(old, new).collect()}
    assert got == {("id", "retyped"), ("gone", "removed"), ("more", "added")}
    assert staging.schema_changes(old, old).isEmpty()
    assert SCHEMA


def test_schemas_are_merged_by_type(spark):
    old = spark.createDataFrame(
        [(1, 5, 2.5, ("a", 1), [1, 2], {"k": 1}, "t", 1)], "id int, n int, x float, s struct<p string, q int>, l array<int>, m map<string,int>, t string, gone int"
    )
    new = spark.createDataFrame(
        [(2, 1 << 40, 0.1, (7, "2"), [3, 4], {"k": 1}, 9), (3, 1, 0.2, (8, "x"), [1], None, 9), (4, None, None, None, None, None, None), (5, 1, 1.0, (1, None), [1 << 40], None, 1)],
        "id int, n bigint, x double, s struct<r int, q string>, l array<bigint>, m map<string,int>, t int",
    )
    rows, bad = staging.sync_schemas(old, new)
    assert rows.schema.simpleString() == "struct<id:int,n:bigint,x:double,s:struct<p:string,q:int,r:int>,l:array<bigint>,m:map<string,int>,t:string>"
    got = {r.id: r for r in rows.collect()}
    assert set(got) == {1, 2, 4, 5} and tuple(got[1].s) == ("a", 1, None) and tuple(got[2].s) == (None, 2, 7) and got[4].s is None
    assert got[2].n == 1 << 40 and got[2].t == "9" and got[5].l == [1 << 40] and got[5].s.q is None
    rejected = bad.collect()
    assert [(r.reject_reason, '"x"' in r.row) for r in rejected] == [("does not fit: s", True)]
    # Narrower text where numbers are stored: what is no number does not fit.
    rows, bad = staging.sync_schemas(spark.createDataFrame([(1,)], "n int"), spark.createDataFrame([("7",), ("seven",), (None,)], "n string"))
    assert rows.schema["n"].dataType.simpleString() == "int" and sorted(r.n for r in rows.collect() if r.n is not None) == [1, 7] and bad.count() == 1
    # Types that hold nothing of each other: the old one stays.
    rows, bad = staging.sync_schemas(spark.createDataFrame([([1],)], "n array<int>"), spark.createDataFrame([(5,), (None,)], "n int"))
    assert rows.count() == 2 and bad.count() == 1


def test_equal_decimals_of_another_scale_are_equal(spark):
    target = merge.dim_full(spark.createDataFrame([("A", at(1), Decimal("1.50"))], "id string, lastmodifieddate timestamp_ntz, v decimal(10,2)"))
    source = spark.createDataFrame([("A", at(2), Decimal("1.5000")), ("A", at(3), Decimal("1.5001"))], "id string, lastmodifieddate timestamp_ntz, v decimal(12,4)")
    got = merge.changed_active_rows(target, source, "id", ["v"]).collect()
    assert [r["changed_at"] for r in got] == [at(3)]
    assert merge.changed_active_rows(target, source.filter("v = 1.5"), "id", ["v"]).isEmpty()

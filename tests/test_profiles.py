"""Merged profiles against counting everything."""

import os

from tidemark.operators import profiles

COLUMNS, KEYS = ["a", "b"], {"k": ["k"], "kt": ["k", "t"]}


def frame(spark, *extracts):
    rows = [(e, k, t, a, None if t % 3 == 0 else "x") for e, n, copies in extracts for k in range(n) for t in range(copies) for a in ("y",)]
    return spark.createDataFrame(rows, "e string, k int, t int, a string, b string")


def test_a_new_extract_reads_no_old_one(spark, tmp_path):
    """The profile of three extracts from their own; one that is profiled again is not counted twice."""
    path, whole = str(tmp_path / "p"), frame(spark, ("one", 3000, 1), ("two", 2000, 2), ("three", 10, 30))
    for e in ("one", "two", "two", "three"):
        profiles.keep_profiles(profiles.profile_extracts(whole.filter(f"e = '{e}'"), COLUMNS, KEYS, "e"), path)
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["_extract=one", "_extract=three", "_extract=two"]
    spoilt = whole.filter("1 / (k - k) > 0")  # reading the extracts again would fail
    got = {r.measure: r for r in profiles.merged_profile(profiles.read_profiles(spark, path), spoilt, COLUMNS, KEYS, max_duplicate=0.9).collect()}
    n = whole.count()
    assert got["null_share:a"].value == 0 and got["null_share:b"].value == whole.filter("b is null").count() / n
    assert got["success_rate"].value == whole.filter("b is not null").count() / n and not got["success_rate"].passed
    for name, by in KEYS.items():
        true = 1 - whole.select(*by).distinct().count() / n
        r = got[f"duplicate_share:{name}"]
        assert abs(r.value - true) <= r.error and r.passed


def test_near_the_limit_keys_are_counted(spark):
    whole = frame(spark, ("one", 5000, 1), ("two", 60, 1))
    made = profiles.profile_extracts(whole, COLUMNS, KEYS, "e")
    got = {r.measure: r for r in profiles.merged_profile(made, whole, COLUMNS, KEYS, max_duplicate=0.012).collect()}
    assert got["duplicate_share:k"].value == 60 / 5060 and got["duplicate_share:k"].error == 0 and got["duplicate_share:k"].passed


def test_no_rows(spark):
    none = frame(spark, ("one", 0, 0))
    got = profiles.merged_profile(profiles.profile_extracts(none, COLUMNS, KEYS, "e"), none, COLUMNS, KEYS).collect()
    assert all(r.value is None and r.passed is None for r in got) and len(got) == 5

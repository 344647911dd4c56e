"""Ordered columns against a plain Python loop, with and without cuts."""

from datetime import timedelta
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators.keyed import find_cuts, match, ordered
from users import BEGIN

SCHEMA = "k string, t timestamp_ntz, n int, v string"


def frame(spark, data):
    return spark.createDataFrame([(k, BEGIN + timedelta(minutes=t), n, v) for k, t, n, v in data], SCHEMA)


def expected(data):
    out = []
    for _, group in groupby(sorted(data, key=lambda r: (r[0], r[1], r[2])), key=lambda r: r[0]):
        group, last = list(group), None
        for i, (k, t, n, v) in enumerate(group):
            last = v if v is not None else last
            out.append((
                k, n, group[i - 1][3] if i else None, group[i + 1][3] if i + 1 < len(group) else None,
                last, i + 1, BEGIN + timedelta(minutes=max(r[1] for r in group)),
            ))
    return sorted(out, key=repr)


def computed(df, cuts):
    got = ordered(
        df, "k", ["t", "n"], lag={"before": F.col("v")}, lead={"after": F.col("v")},
        fill={"known": F.col("v")}, number="i", peak={"top": F.col("t")}, cuts=cuts,
    )
    assert got.columns[:4] == ["k", "t", "n", "v"]
    return sorted([(r.k, r.n, r.before, r.after, r.known, r.i, r.top) for r in got.collect()], key=repr)


skewed = st.lists(
    st.tuples(st.sampled_from("AAAAABC"), st.integers(0, 30), st.sampled_from([None, "x", "y"])),
    min_size=1, max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(skewed, st.integers(2, 60))
def test_cuts_change_nothing(spark, data, segments):
    data = [(k, t, i, v) for i, (k, t, v) in enumerate(data)]
    df = frame(spark, data)
    assert computed(df, None) == expected(data)
    cuts = find_cuts(df, "k", ["t", "n"], segments)
    if cuts is not None:
        assert computed(df, cuts) == expected(data)


def sizes(cuts, df):
    placed = cuts.place(df, "k", ["t", "n"])
    return {r["_cell"]: r["count"] for r in placed.filter("_cell >= 0").groupBy("_cell").count().collect()}


@pytest.mark.parametrize("time", [lambda i: i % 997, lambda i: 5, lambda i: -20_000_000 if i == 0 else i % 61], ids=["spread", "one time", "a burst after a stray date"])
def test_one_key_holds_most_rows(spark, time):
    data = [("hot", time(i), i, None if i % 7 else str(i)) for i in range(4000)]
    data += [(f"k{i % 50}", i, i, "z") for i in range(500)]
    df = frame(spark, data)
    cuts = find_cuts(df, "k", ["t", "n"], 45)
    assert [r["_key"] for r in cuts.at.collect()] == ["hot"]
    found = sizes(cuts, df)
    assert len(found) > 35 and max(found.values()) < 250 and sum(found.values()) == 4000
    assert computed(df, cuts) == expected(data)


def test_any_number_of_keys_is_cut(spark):
    """Every key that fills segments, however many there are, and no key that does not."""
    data = [(f"k{i % 1500:04}", i, i, "x") for i in range(9000)] + [(f"s{i:04}", i, i, "x") for i in range(3000)]
    df = frame(spark, data)
    cuts = find_cuts(df, "k", ["t", "n"], 6000)
    keys = {r["_key"] for r in cuts.at.collect()}
    assert len(keys) > 1400 and all(k.startswith("k") for k in keys)
    assert computed(df, cuts) == expected(data)


def test_no_key_fills_a_segment(spark):
    assert find_cuts(frame(spark, [(f"k{i}", i, i, "x") for i in range(200)]), "k", ["t", "n"], 8) is None
    assert find_cuts(frame(spark, []), "k", ["t", "n"], 8) is None


def test_orders_that_agree_in_part(spark):
    """Cuts by (time, n) also serve an order by time alone or one that goes on differently."""
    data = [("A", i // 3, i % 3, str(i)) for i in range(60)]
    df = frame(spark, data)
    cuts = find_cuts(df, "k", ["t", "n"], 10)
    for order in (["t"], ["t", "v", "n"]):
        assert {r["_cell"] for r in cuts.place(df, "k", order).collect()} > {0}
        got = ordered(df.dropDuplicates(["t"]), "k", order, lag={"b": F.col("t")}, number="i", cuts=cuts).orderBy("t").collect()
        assert [r.i for r in got] == list(range(1, 21)) and [r.b for r in got[1:]] == [r.t for r in got[:-1]]
    with pytest.raises(ValueError, match="do not fit"):
        cuts.place(df, "k", ["v"])


def test_null_times_and_ties_come_first(spark):
    data = [("A", None, i, "x") for i in range(50)] + [("A", 3, i, "y") for i in range(50)]
    rows = spark.createDataFrame([(k, None if t is None else BEGIN + timedelta(minutes=t), n, v) for k, t, n, v in data], SCHEMA)
    cuts = find_cuts(rows, "k", ["t", "n"], 20)
    got = ordered(rows, "k", ["t", "n"], lag={"before": F.col("n")}, number="i", cuts=cuts).orderBy("i").collect()
    assert [r.i for r in got] == list(range(1, 101)) and [r.n for r in got] == [*range(50), *range(50)]
    assert [r.before for r in got] == [None, *[r.n for r in got[:-1]]]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_match(spark, how):
    left = frame(spark, [("hot", i, i, "x") for i in range(30)] + [("a", 1, 1, "x"), ("b", 1, 1, "x")])
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("c", 3)], "k string, w int")
    cuts = find_cuts(left, "k", ["t", "n"], 8)
    assert cuts is not None
    plain = sorted(left.join(right, "k", how).collect(), key=repr)
    assert sorted(match(left, right, "k", how, cuts).collect(), key=repr) == plain

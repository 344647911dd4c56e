import math

import duckdb
import numpy as np
import pytest

from tidemark.llm import hard_negatives, queries


def brute(rows, anchor=lambda i: i % 100 == 0):
    """rows: (vec_id, label, vector); the contract in Python's integers."""
    part = {
        (i, label, tuple(math.floor(256 * x) for x in v)) for i, label, v in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    part = {r for r in part if sum(x * x for x in r[2]) < 1 << 62}
    out = []
    for i, label, a in part:
        if not anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j, other == label) for j, other, b in part if j != i and len(a) == len(b)]
        for p, j, _ in sorted(s for s in scored if s[2])[:5]:
            near = sorted(s for s in scored if not s[2] and -30 * p <= -100 * s[0] <= -90 * p)[:10]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(near, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_whole_tables(spark, small):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, list(r.embedding)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert got(queries.op13_hard_negatives(spark, small)) == brute(rows)
    where = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{where}/embeddings.parquet'")
    columns = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    want = con.sql(f"select {columns} from ({queries.EXPECTED['op13_hard_negatives']})").fetchall()
    assert got(queries.op13_hard_negatives(spark, where)) == sorted(want)


@pytest.mark.parametrize("width, skew", [(2, 1.0), (8, 0.6), (24, 0.7)])
def test_no_row_is_pruned_wrongly(width, skew):
    """Every row of any window is a candidate, and on skewed vectors most others are not."""
    rng = np.random.default_rng(width)
    rows = np.floor(rng.normal(size=(900, width)) * skew ** np.arange(width) * rng.lognormal(0, 1, (900, 1)) * 100).astype(np.int64)
    rows[:5] = 0
    rows = rows[np.argsort((rows * rows).sum(axis=1))]
    left = 0
    for at in range(0, 900, 150):
        part = rows[at : at + 150]
        block = hard_negatives.Block(part, np.arange(150), np.zeros(150, int), hard_negatives.sorted_lists(part))
        for a in [*rng.integers(0, 900, 40), 0]:
            true = part @ rows[a]
            top = int(true.max())
            for low, high in ((top * 9 // 10, top), (0, 0), (-50, 50), (top // 3, top // 2), (int(true.min()), int(true.min())), (1, 10**9)):
                found = block.candidates(rows[a], low, high)
                assert len(set(found.tolist())) == len(found)
                assert set(np.flatnonzero((true >= low) & (true <= high))) <= set(found.tolist())
                if (low, high) == (top * 9 // 10, top):
                    left += len(found)
    assert left < 0.7 * 6 * 41 * 150


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for high in (100, 1 << 20, 1 << 29):
        rows = rng.integers(-high, high, (20, 3))
        want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in rows] for a in rows]
        assert hard_negatives.scores(hard_negatives.smallest(rows), rows).tolist() == want


@pytest.mark.parametrize("block", [8192, 16])
def test_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(size=6) * rng.lognormal(0, 1)]) for i in range(1, 150)]
    rows += [(1000 + i, i % 2, rows[4][2]) for i in range(120)]  # one vector over and over
    rows += [(200, 1, [0.0] * 6), (300, 1, [0.001] * 6), (301, 2, [0.0] * 6), (302, 0, [-0.0] * 6), (400, 0, [-5.0] * 6), (500, 1, [1e3, -1e3, 3e4, 0.0, 1.0, 2.0])]
    rows += [(2000, None, [1.0] * 6), (2100, 1, None), (2200, 1, []), (2300, 1, [math.nan] * 6), (2400, 1, [None] * 6), (2500, 1, [1e300] * 6), (None, 1, [1.0] * 6)]
    rows += [(600, 1, rows[0][2]), (600, 1, rows[0][2]), (601, 1, rows[0][2][:4]), (700, 2, rows[1][2][:4]), (602, 2, rows[2][2][:4]), (603, 2, rows[3][2][:4]), (701, 0, rows[1][2][:4])]
    rows += [(800, 1, rows[9][2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "'x' as width", "1 as block", "2 as a", "3 as h", "4 as vector", "5 as bucket")
    want = brute(rows)
    assert len(want) > 200 and got(hard_negatives.mine(df.repartition(3))) == want
    assert got(hard_negatives.mine(df.limit(0))) == [] and got(hard_negatives.mine(df.where("vec_id % 100 <> 0"))) == []
    long = [(i * 50, i % 2, [float(x) for x in rng.normal(size=300)]) for i in range(40)]
    assert got(hard_negatives.mine(spark.createDataFrame(long, "vec_id long, label int, embedding array<double>"))) == brute(long)

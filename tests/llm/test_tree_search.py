import math

import numpy as np

from tidemark.llm import queries, tree_search


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, asked, k=10):
    """{(query_id, vector): [(vec_id, score)]} by comparing everything with everything of its length."""
    rows = {(i, tuple(v)) for i, v in rows if i is not None and good(v)}
    out = {}
    for q, a in {(i, tuple(v)) for i, v in asked if i is not None and good(v)}:
        near = sorted((math.sqrt(math.fsum((x - y) * (x - y) for x, y in zip(a, b))), i) for i, b in rows if i != q and len(b) == len(a))
        out[(q, a)] = near[:k]
    return out


def test_recall_on_whole_table(spark, small):
    for where in (small, "/root/testdata/sf0.1"):
        rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{where}/embeddings.parquet").collect()]
        want = {q: near for (q, _), near in brute(rows, [r for r in rows if r[0] % 100 == 0]).items()}
        got = {}
        for r in queries.op11_tree_search(spark, where).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.score, r.vec_id))
            assert r.rank == len(got[r.query_id])
        assert set(got) == set(want) and all(len(got[q]) == 10 and got[q] == sorted(got[q]) for q in got)
        hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
        assert hits >= 0.9 * 10 * len(want)
        vectors = dict(rows)
        for q, near in got.items():
            for score, i in near:
                assert math.isclose(score, math.dist(vectors[q], vectors[i]), rel_tol=1e-14)


def test_fewer_leaves_than_the_table_has(spark):
    """On clustered vectors a tree of many leaves visits few of them and still finds the neighbours."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 4
    rows = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=16)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    idx = tree_search.index(df, leaf=50)
    (tree,) = idx.trees.values()
    held = np.bincount(tree.pack, weights=idx.sizes[16])
    assert len(tree.pack) > 40 and len(held) < len(tree.pack) and idx.sizes[16].sum() == 4000
    asked = df.where("vec_id % 50 = 0")
    wide = tree_search.calibrate(idx, asked.selectExpr("*", "16 as width", "pmod(xxhash64(vec_id), 1 << 30) as h"), 10, 0.95)
    assert 1 <= wide[16] < len(tree.pack) / 4
    got = {}
    for r in tree_search.search(df, asked, leaf=50).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = {q: {i for _, i in near} for (q, _), near in brute(rows, [r for r in rows if r[0] % 50 == 0]).items()}
    assert sum(len(got[q] & want[q]) for q in want) >= 0.9 * 10 * len(want)


def test_best_first_yields_every_leaf_once():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(2000, 6))
    tree = tree_search.grow(points, 1.0, 20)
    leaves = tree.leaves(points)
    assert set(leaves) <= set(range(len(tree.pack)))
    for p, own in zip(points[:20], leaves):
        order = list(tree.best_first(p))
        assert sorted(order) == list(range(len(tree.pack))) and order.index(own) < 20


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(130)]
    rows += [(200, None), (300, []), (400, [0.0] * 8), (500, [float("nan")] * 8), (600, [None] + [1.0] * 7), (700, [float("inf")] + [0.0] * 7)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [(100, rows[100][1]), (None, rows[5][1]), (800, [1.0, 2.0]), (801, [1.0, 2.5])]
    rows += [(900, rows[7][1]), (900, rows[8][1]), (2000, [1e200] * 8), (2100, [-1e200] * 8), (2200, [1.0] * 3), (2300, [-0.0, 1.0]), (2301, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as leaf", "2 as width", "3 as h", "4 as ids", "'x' as block").repartition(3)
    want = brute(rows, [r for r in rows if r[0] is not None and r[0] % 100 == 0])
    got = {}
    for r in tree_search.search(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert 2200 not in got and {100, 800, 900, 1000, 2000, 2300} <= set(got) and not {200, 300, 400, 500, 600, 700} & set(got)
    for q in set(got) - {900}:
        ((near),) = [w for (i, _), w in want.items() if i == q]
        assert [i for _, i in got[q]] == [i for _, i in near] and np.allclose([s for s, _ in got[q]], [s for s, _ in near], rtol=1e-12)
    # Rows of one id with different vectors are queries of their own, and not each other's neighbours.
    both = sorted(x for (i, _), w in want.items() if i == 900 for x in w)
    assert sorted(i for _, i in got[900]) == sorted(i for _, i in both)
    assert len(got[1000]) == 10 and got[1000][0] == (0.0, 0) and got[1000][1] == (0.0, 1001)
    assert tree_search.search(df.limit(0), df.limit(0)).collect() == [] and tree_search.search(df, df.limit(0)).collect() == []


def test_near_copies_in_small_packs(spark, monkeypatch):
    """A leaf that nothing divides is dealt over packs; a third of the rows equal to a hair."""
    monkeypatch.setattr(tree_search, "BLOCK", 16)
    monkeypatch.setattr(tree_search, "QUERIES", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0 + (i * 1e-9 if i % 3 == 0 else float(rng.normal()))]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in tree_search.search(df, df.where("vec_id % 100 = 0"), recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {q: [i for _, i in near] for (q, _), near in brute(rows, [r for r in rows if r[0] % 100 == 0]).items()}
    assert got == want

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import mixing, queries


def optimum(n, p, target, rounds=20_000):
    """Plain projected gradient in memory, for long; and the objective it makes small."""
    weight = 1 / ((p * p) * n[:, None]).sum(axis=0)
    length = 1 / np.linalg.norm((p * np.sqrt(weight * n[:, None])), 2) ** 2
    rate = np.ones(len(n))
    for _ in range(rounds):
        rate = np.maximum(0, rate - p @ (length * weight * ((rate * n) @ p - target)))
    return rate, lambda r: float((weight * ((r * n) @ p - target) ** 2).sum())


def members(spark, n, p):
    return spark.createDataFrame([(i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p))], "doc_id long, n_words long, p array<double>")


@pytest.mark.parametrize("shares, total, met", [((0.9, 0.05, 0.05), 1.15, True), ((0.2, 0.5, 0.3), 1.0, True), ((0.94, 0.03, 0.03), 1.5, True), ((0.5, 0.5, 0.0), 1.8, False)])
def test_solver(spark, shares, total, met):
    rng = np.random.default_rng(3)
    n, p = rng.integers(0, 500, 300), rng.dirichlet([0.3, 0.1, 0.1], 300)
    df = members(spark, n, p)
    got = mixing.solve(df, shares, total, rounds=60)
    assert got.target == pytest.approx(total * np.array(shares) * n.sum())
    rate = np.array([r.rate for r in got.rated.orderBy("doc_id").collect()])
    assert (rate >= 0).all() and rate == pytest.approx(mixing.folded(p, got.steps), abs=1e-9) and got.reached == pytest.approx((rate * n) @ p, rel=1e-5)
    best, far = optimum(n, p, got.target)
    assert far(rate) <= far(best) + (1e-6 if met else 0.01) * far(np.ones(300))
    assert len(got.steps) > 3
    assert (got.missed <= mixing.CLOSE) == met


def test_the_order_of_tasks_changes_nothing(spark):
    rng = np.random.default_rng(8)
    df = members(spark, rng.integers(0, 900, 500), rng.dirichlet([0.3, 0.1, 0.1], 500))
    runs = [mixing.solve(df.repartition(parts), (0.94, 0.03, 0.03), 1.3) for parts in (1, 7, 13)]
    assert all(r.steps == runs[0].steps and (r.reached == runs[0].reached).all() for r in runs)


def test_query_on_whole_tables(spark, small):
    """The rates are those of a plain projected gradient in memory, and meet the targets where these can be met."""
    for where, met in ((small, False), ("/root/testdata/sf0.1", True)):
        docs = {r.doc_id: r for r in spark.read.parquet(f"{where}/documents.parquet").collect()}
        got = queries.op4_mixing(spark, where).orderBy("doc_id").collect()
        assert [r.doc_id for r in got] == sorted(docs)
        assert all(r.n_words == len((docs[r.doc_id].text or "").encode().split()) for r in got)
        n, p = np.array([r.n_words for r in got]), np.array([[r.p_good, r.p_bad, r.p_toxic] for r in got])
        assert np.allclose(p.sum(axis=1), 1)
        target = np.array(mixing.SHARES) * mixing.TOTAL * n.sum()
        rate = np.array([r.rate for r in got])
        best, far = optimum(n, p, target, 3000)
        assert (rate >= 0).all() and far(rate) <= far(best) + 0.01 * far(np.ones(len(n)))
        assert not met or np.abs((rate * n) @ p - target).sum() <= 2e-6 * target.sum()
        assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in got)


def test_held_out_accuracy(spark):
    where = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    # Copies of a training document elsewhere would make the test easy: leave exact ones out.
    seen = docs.join(train, "doc_id").select("text").distinct()
    rows = docs.join(seen, "text", "left_anti")
    got = mixing.posteriors(rows, mixing.fit(docs, train, 600)).join(test, "doc_id").collect()
    want = [2 if r.toxic else 1 if r.quality == 0 else 0 for r in got]
    right = [int(np.argmax(r.p)) == w for r, w in zip(got, want)]
    assert len(right) > 800 and np.mean(right) > 0.92
    assert np.mean([r for r, w in zip(right, want) if w == 0]) > 0.95


def test_rows_taken(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    want = {r.doc_id: r.copies for r in mixing.rates(docs, labels).collect()}
    out = mixing.mixed(docs, labels)
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert out.schema == docs.schema and {i: c for i, c in want.items() if c} == got


def test_clean_documents_are_taken(spark):
    """Of the trusted documents the pipeline's stage leaves out none, and the mixture of all documents next to none."""
    where = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    trusted = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    want = {r.doc_id: r.copies for r in mixing.rates(docs, labels).collect()}
    assert sum(want[i] >= 1 for i in trusted) >= 0.99 * len(trusted)
    left = corpus_pipeline.simhash_near_dedup(spark, corpus_pipeline.quality_rules(spark, docs, where), where)
    ids = {r.doc_id for r in left.select("doc_id").collect()}
    out = {r.doc_id for r in corpus_pipeline.mixing_to_targets(spark, left, where).select("doc_id").collect()}
    assert (trusted & ids) <= out and len(trusted & ids) > 500


def test_odd_rows(odd, odd_rows, odd_labels, none):
    got = mixing.rates(odd, odd_labels).collect()
    assert len(got) == len(odd_rows) and all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-9 for r in got)
    out = mixing.mixed(odd, odd_labels)
    named = lambda df: [(f.name, f.dataType) for f in df.schema]
    assert named(out) == named(odd) and out.count() == sum(r.copies for r in got)
    even = mixing.rates(odd, odd_labels.limit(0)).collect()
    assert all(r.p == pytest.approx([1 / 3] * 3) for r in even)
    assert mixing.rates(none, odd_labels).count() == 0 and mixing.mixed(none, odd_labels).count() == 0

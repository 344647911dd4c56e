import math

import numpy as np

from tidemark.llm import embed_dedup, queries


def brute(rows, threshold=0.9):
    """rows: (vec_id, vector or None); links and components by id, straight from the contract."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(near[i]), None if key is None else least, key is not None and key == least))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def test_whole_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    assert got(queries.op2_embedding_near_dedup(spark, small)) == brute(rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=8)
    rows = [(i, [float(x) for x in (centre + rng.normal(size=8) * 0.35).astype(np.float32)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [None] + [1.0] * 7), (205, [float("inf")] + [0.0] * 7)]
    rows += [(300 + i, rows[0][1]) for i in range(40)] + [(400, [x * 1e-30 for x in rows[0][1]]), (401, rows[0][1][:5]), (402, rows[0][1][:5])]
    rows += [(None, rows[3][1]), (7, rows[7][1]), (7, [-x for x in rows[7][1]]), (500, [-0.0, 1.0]), (501, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "2 as strip", "3 as width", "4 as component_id")
    assert got(embed_dedup.links(df)) == brute(rows)
    assert got(embed_dedup.links(df.limit(0))) == []


def test_threshold_between_neighbours(spark):
    """Angles in steps around the threshold: the bound may not lose those just above it."""
    rows = [(i, [math.cos(a), math.sin(a)]) for i, a in enumerate(np.linspace(0, 3, 400))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(embed_dedup.links(df)) == brute(rows)


def test_error_bound_holds():
    rng = np.random.default_rng(2)
    u = embed_dedup.unit(rng.normal(size=(300, 48)) ** 3)
    q, scale, error = embed_dedup.quantised(u)
    near = embed_dedup.products(q, q) * scale[:, None] * scale
    length = np.sqrt((q.astype(float) ** 2).sum(axis=1)) * scale
    assert (np.abs(u @ u.T - near) <= error[None] + error[:, None] * length[None] + 1e-12).all()
    wide = rng.integers(-127, 128, (5, 3000)).astype(np.int8)
    assert (embed_dedup.products(wide, wide) == wide.astype(int) @ wide.astype(int).T).all()


def test_a_tile_returns_a_row_for_each_vector_at_most():
    u = embed_dedup.unit(np.ones((500, 16)) + np.random.default_rng(3).normal(size=(500, 16)) * 0.01)
    q, scale, error = embed_dedup.quantised(u)
    side = {"node": np.arange(500), "copies": np.ones(500, int), "q": q, "scale": scale, "error": error}
    links, more, labels, unsure, also = embed_dedup.tile(side, side, True, 0.9)
    assert (links + more == 499).all() and (labels == 0).all() and not unsure.any() and not also.any()


def test_sure_and_recomputed_links_are_all_links():
    """On similarities spread around the threshold: neither part claims a false link, together they miss none."""
    rng = np.random.default_rng(9)
    u = embed_dedup.unit(np.ones((300, 24)) + rng.normal(size=(300, 24)) * rng.uniform(0.1, 0.6, (300, 1)))
    side = embed_dedup._side(np.arange(300), np.ones(300, int), u)
    sure, rest = (embed_dedup.tile(side, side, True, 0.9, exact) for exact in (False, True))
    true = (np.einsum("ik,jk->ij", u, u) >= 0.9) & ~np.eye(300, dtype=bool)
    assert (sure[0] + sure[1] + rest[0] + rest[1] == true.sum(axis=1)).all()
    assert (sure[0] + sure[1] <= true.sum(axis=1)).all()
    unsure = sure[3] | sure[4]
    assert unsure.any() and ((rest[0] + rest[1] > 0) <= unsure).all()

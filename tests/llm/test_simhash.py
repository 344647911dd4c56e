import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import queries, simhash
from tidemark.llm.components import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints):
    """Smallest key reachable over two bits or fewer, by trying all pairs."""
    keys = list(prints)
    up = {k: k for k in keys}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {k: top(k) for k in keys}


def test_query_against_all_pairs(spark, small):
    texts = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = groups(prints)
    got = queries.op10_simhash_near_dedup(spark, small).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((i, f"{prints[i]:016x}", want[i]) for i in texts)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bucket", [1, 4, 64])
@pytest.mark.parametrize("distance", [1, 2])
def test_links_hold_together_what_is_near(spark, bucket, distance):
    """Large buckets go another way, and find the same groups; every edge is a true one."""
    rnd = random.Random(bucket + distance)
    prints = {0, (1 << 64) - 1, 1 << 63, 3}
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(25):
            x = base
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    prints = sorted(signed(p) for p in prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), distance, bucket).collect()
    apart = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    assert all(0 < apart(e.a, e.b) <= distance for e in edges)

    def parts(pairs):
        up = {p: p for p in prints}
        def top(k):
            while up[k] != k:
                k = up[k]
            return k
        for a, b in pairs:
            x, y = sorted((top(a), top(b)))
            up[y] = x
        return {p: top(p) for p in prints}

    near = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if apart(a, b) <= distance]
    assert parts([(e.a, e.b) for e in edges]) == parts(near)
    if bucket == 64:
        assert {tuple(sorted((e.a, e.b))) for e in edges} == {tuple(sorted(p)) for p in near}


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    ring = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    pairs = chain + star + ring + [(5, 5), (None, 3), (4, None), (-9, -8), (-9, -8), (-8, -9)]
    random.Random(1).shuffle(pairs)
    got = dict(components(spark.createDataFrame(pairs, "a long, b long"), "test").collect())
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)} | {2000 + i: 2000 for i in range(50)} | {-9: -9, -8: -9}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_components_without_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_components_of_chains_stars_and_rings(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_odd_rows(odd, odd_rows, none):
    got = {r.doc_id: r for r in simhash.near_duplicates(odd).where("doc_id is not null").collect()}
    prints = {r[0]: plain_fingerprint(r[1]) for r in odd_rows if r[0] is not None}
    want = groups(prints)
    assert {i: (r.fp & ((1 << 64) - 1), r.component_id) for i, r in got.items()} == {i: (prints[i], want[i]) for i in prints}
    assert got[2].component_id == 1 and got[8].component_id == 7  # blanks are alike, and so are copies
    stays = simhash.one_of_each(odd)
    assert stays.schema == odd.schema
    ids = [r.doc_id for r in stays.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({want[i] for i in prints}) and ids.count(None) == 1  # the blank one has a near copy
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


def test_no_text_is_lost(spark):
    """Equal ids with other texts, equal rows, and rows without an id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(300)) for x in "abc")
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "x"), (2, a, "x"), (3, c, "x"), (3, c, "x"), (3, c, "y"), (None, b, "x"), (None, a, "z")]
    rows += [(None, " ".join(f"d{i}" for i in range(300)), "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [sorted(map(tuple, simhash.one_of_each(df.repartition(n)).collect()), key=repr) for n in (1, 5)]
    assert got[0] == got[1]
    assert sorted(r[1] for r in got[0]) == sorted({r[1] for r in rows})
    assert (1, a, "x") in got[0] and (1, b, "x") in got[0] and len([r for r in got[0] if r[0] == 3]) == 1


def test_signatures_meet_for_all_near_pairs(spark):
    pairs = [(7, 7 ^ (1 << a) ^ (1 << b)) for a in range(64) for b in range(a)]
    rows = spark.createDataFrame([(signed(x),) for p in pairs for x in p], "fp long").distinct()
    keys = simhash.signatures(rows).groupBy("fp").agg(F.collect_set("key").alias("k")).collect()
    keys = {r.fp: set(r.k) for r in keys}
    assert all(keys[signed(a)] & keys[signed(b)] for a, b in pairs) and all(len(k) == 64 for k in keys.values())

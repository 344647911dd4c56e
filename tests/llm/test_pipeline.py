import base64

import public_tokenizers
import tiktoken

import corpus_pipeline
from tidemark.llm import mixing, quality, secrets, simhash
from test_simhash import groups, plain_fingerprint

FIXED = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "secret scans", "mixing to target weights", "byte-level BPE"]
    assert corpus_pipeline.ORACLE_SQL is None


def library():
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_run_against_a_stage_by_stage_brute_force(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    verdict = {r.doc_id: r.kept for r in quality.score(docs, *quality.fit(docs, labels)).collect()}
    texts = {i: t for i, t in texts.items() if verdict[i]}
    group = groups({i: plain_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if group[i] == i}
    left = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secrets.find(left, secrets.fit(left)).collect()}
    for i, found in spans.items():
        for start, end in sorted(found, reverse=True):
            texts[i] = texts[i][:start] + secrets.MARK + texts[i][end:]
    left = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    targets = {"domains": corpus_pipeline.DOMAINS, "shares": corpus_pipeline.SHARES, "total": corpus_pipeline.TOTAL}
    copies = {r.doc_id: r.copies for r in mixing.rates(left, labels, **targets).collect()}
    encode = library().encode_ordinary
    want = sorted((i, encode(t)) for i, t in texts.items() for _ in range(copies[i]))
    got = corpus_pipeline.run(spark, small).collect()
    assert all(r.exact and r.n_tokens == len(r.ids) for r in got)
    assert sorted((r.doc_id, r.ids) for r in got) == want and len(want) > 100


def test_stages_keep_the_columns_and_take_odd_rows(spark, small, odd_rows):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    odd = spark.createDataFrame(odd_rows, schema)
    for rows in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, small)
            assert name == "byte-level BPE" or (out.columns == FIXED and [f.dataType for f in out.schema] == [f.dataType for f in schema])
            out.collect()


def test_clean_documents_stay(spark):
    """Of the labelled good documents, each group of copies keeps one to the end."""
    where = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    base = {r.doc_id for r in quality.score(docs, *quality.fit(docs, labels)).where("not base_failed").collect()}
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    left = {group[r.doc_id] for r in corpus_pipeline.run(spark, where).select("doc_id").distinct().collect()}
    assert {group[i] for i in good & base} <= left

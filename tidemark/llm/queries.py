"""The queries of this package's operators, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe, chat, embed_dedup, hard_negatives, mixing, quality, secrets, sharding, simhash, token_orc, tree_search, url_graph, whitening,
)
from tidemark.llm.common import table
from tidemark.session import scratch, written

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs, secrets.fit(docs))
    digest = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, secrets.KINDS), F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.links(table(spark, sf_dir, "embeddings"))


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-orc")
    token_orc.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_orc.checksums(token_orc.read(spark, path))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.select("doc_id", "n_words", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)], "rate", "copies")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string").coalesce(1)
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    turns = written(chat.format_turns(rows.unionByName(more)), "chat-turns")
    back = chat.conversations(turns).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", F.array_join(chat.loss_texts(F.col("segments")), ""))
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(plain, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.col("allowed").alias("turns_allowed"), F.col("accepted").alias("accepted"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, *quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.verdicts(table(spark, sf_dir, "pages"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    back = byte_bpe.encoded(table(spark, sf_dir, "documents"), *vocabulary, decode=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op9_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return tree_search.search(vectors, vectors.where("vec_id % 100 = 0"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_embedding_near_dedup, op3_token_orc, op4_mixing, op5_chat_format,
        op6_quality_rules, op7_url_filter, op8_byte_bpe, op9_bounded_ring, op10_simhash_near_dedup,
        op11_tree_search, op12_whitening, op13_hard_negatives,
    )
}

EXPECTED: dict[str, str] = {
    "op13_hard_negatives": """
        with part as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                [floor(256 * cast(x as double)) for x in embedding] as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
        ), scored as (
            select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
            from part a join part b on a.vec_id <> b.vec_id
            where a.vec_id % 100 = 0
        ), positive as (
            select anchor_id, other_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
        )
        select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as rank,
            other_id as negative_id, positive_score, score as negative_score
        from positive join scored using (anchor_id)
        where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
        qualify rank <= 10
    """,
}

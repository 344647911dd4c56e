"""The corpus pipeline: raw documents in, token ids of a clean mixture out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next stage's documents. All but the last return the columns of
``documents``. No stage can be said in SQL as a whole, so ``ORACLE_SQL`` is None; the tests
hold ``run`` against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, mixing, quality, secrets, simhash
from tidemark.llm.common import table
from tidemark.session import written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: What the mixture is to hold. The quality stage has left no domain of bad documents; clean
#: words are wanted more often than all words there are, so that no clean document falls out.
DOMAINS = {"clean": "quality is not null or toxic = 0", "toxic": "toxic = 1"}
SHARES, TOTAL = (0.94, 0.06), 1.1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the score reject go."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs, shingle=3, max_distance=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redacted(docs, secrets.fit(docs))
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is taken as often as its rate says."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), domains=DOMAINS, shares=SHARES, total=TOTAL)


def byte_bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): the ids, and whether they decode to the text's bytes again."""
    return byte_bpe.encoded_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scan),
    ("mixing to target weights", mixing_to_targets),
    ("byte-level BPE", byte_bpe_encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs

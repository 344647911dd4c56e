"""Token ids in ORC files: written in ascending order of documents, read back by stripe.

Documents are dealt by ranges of their ids and sorted, so every file holds a range and the
files follow each other. Ids are integers, which ORC stores in run-length encoded streams;
row indexes hold the least and largest ``doc_id`` of every ``ROW_GROUP`` rows and a Bloom
filter of them. A look-up by document thus skips files, stripes and row groups, and a full
read is split by stripe. Each row holds its place among the ids of its own part; the parts'
totals, one number for each task that wrote, turn that into a place among all ids.

Texts are encoded by the tokenizers library. Its normalisation and pre-tokenisation never
look across white space, nor its merges across pre-tokens, so that a worker encodes each
different part of a text once and remembers it. A text that holds a special token's string
goes to the library whole, which gives it that token's id.

Null and empty texts have only the end id. A null ``doc_id`` comes first. Rows that share
a ``doc_id`` follow each other by text. An empty table gives no rows. Other columns are
not looked at.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Codes, in_arrow, runs

END = 1
STRIPE_BYTES, ROW_GROUP, FALSE_POSITIVES = 16 << 20, 1_000, 0.01
#: Parts of texts that a worker remembers before it starts afresh.
REMEMBERED = 600_000
SCHEMA = "doc_id long, part int, at long, n_tokens long, ids array<int>"
#: A run of letters, one digit, or a run of signs, in lower-case text up to U+00FF.
LATIN = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe\t-\r \x85\xa0]+").findall


class Encoder:
    """Remembers the ids of parts of texts between which the tokeniser always cuts.

    With ``special`` the strings of added tokens in a text become these tokens, as the library
    has it unless told otherwise; without, they are ordinary text.
    """

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {i: spell(chr(i))[0][0] for i in range(256)}
        self.forget()

    def forget(self) -> None:
        self.parts = Codes()
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _ids(self, part: str) -> list[int]:
        """Pre-tokens in normal form need only the library's merges."""
        if part[0] == " ":
            return self.tokenizer.encode(part, add_special_tokens=False).ids
        return [t.id for t in self.tokenizer.model.tokenize(part.translate(self.spelling))]

    def _learn(self) -> None:
        made = list(map(self._ids, self.parts.taken()))
        sizes = np.fromiter(map(len, made), np.int32, len(made))
        self.starts = np.concatenate([self.starts, (len(self.flat) + np.cumsum(sizes) - sizes).astype(np.int32)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(made), np.int32, int(sizes.sum()))])
        self.sizes = np.concatenate([self.sizes, sizes])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the end ids included, and how many each text has."""
        marked = [i for i, t in enumerate(texts) if any(m in t for m in self.markers)]
        if not marked:
            return self._by_parts(texts)
        rest = list(texts)
        for i in marked:
            rest[i] = ""
        ids, counts = self._by_parts(rest)
        lists = np.split(ids, np.cumsum(counts)[:-1])
        for i in marked:
            lists[i] = np.array([*self.tokenizer.encode(texts[i], add_special_tokens=False).ids, END], np.int32)
        return np.concatenate(lists), np.fromiter(map(len, lists), np.int64)

    def _by_parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > REMEMBERED:
            self.forget()
        number = self.parts.__getitem__
        numbers = [np.fromiter(map(number, parts_of(t)), np.int32) for t in texts]
        self._learn()
        parts, lengths = np.concatenate([np.zeros(0, np.int32), *numbers]), np.fromiter(map(len, numbers), np.int64)
        sizes = self.sizes[parts].astype(np.int64)
        before = np.cumsum(sizes) - sizes
        words = self.flat[np.arange(int(sizes.sum())) + np.repeat(self.starts[parts] - before, sizes)]
        counts = np.bincount(np.repeat(np.arange(len(texts)), lengths), weights=sizes, minlength=len(texts)).astype(np.int64) + 1
        out = np.full(int(counts.sum()), END, np.int32)
        own = np.ones(len(out), bool)
        own[np.cumsum(counts) - 1] = False
        out[own] = words
        return out, counts


def parts_of(text: str) -> list[str]:
    """Pre-tokens in normal form where that is plain to see, else what ASCII white space parts, behind a blank.

    Up to U+00FF no two characters compose and each has one small form, so that lower case
    may come first. An apostrophe starts pre-tokens of its own kind.
    """
    if "'" not in text:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            return LATIN(text.lower())
    return [" " + w.decode() for w in text.encode().split()]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path, special=True)


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Writes the ids of all documents as ORC files under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                ids, counts = own.encode(texts)
                ends = np.cumsum(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                columns = [piece.column("doc_id"), pa.array([part] * len(texts), pa.int32()), pa.array(at + ends - counts), pa.array(counts), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "at", "n_tokens", "ids"])
                at += int(ends[-1])

    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    in_arrow(ordered.drop("tie"), run, SCHEMA).write.options(**{
        "compression": "zstd", "orc.stripe.size": STRIPE_BYTES, "orc.create.index": "true", "orc.row.index.stride": ROW_GROUP,
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_POSITIVES,
    }).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all documents before."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = sorted(rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row for each task that wrote
    before = accumulate((n for _, n in totals), initial=0)
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, before)], "part int, before long").coalesce(1)
    joined = rows.join(F.broadcast(offsets), "part")
    return joined.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")


def find(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents; the filter reaches the files' indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids").fill_null([])
            flat, ends = column.flatten().to_numpy().astype("<u4"), np.cumsum(pc.list_value_length(column).to_numpy())
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip([0, *ends], ends)]
            names = ["doc_id", "start", "n_tokens"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(crcs, pa.int64())], [*names, "ids_crc32"])

    return in_arrow(rows.select("doc_id", "start", "n_tokens", "ids"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")

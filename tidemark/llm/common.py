"""What the operators of this package share: reading tables and walking Arrow batches."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

#: Words that a worker remembers before it starts afresh.
REMEMBERED = 300_000
#: Texts are worked on in runs of so many rows and bytes, whatever size Spark's batches have.
RUN_ROWS, RUN_BYTES = 512, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def runs(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Pieces of a batch with their texts; a null text is empty."""
    at, n = 0, batch.num_rows
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    while at < n:
        end, size = at, 0
        while end < n and (end == at or (end - at < RUN_ROWS and size + lengths[end] <= RUN_BYTES)):
            size += lengths[end]
            end += 1
        piece = batch.slice(at, end - at)
        yield piece, [t or "" for t in piece.column(column).to_pylist()]
        at = end


class Codes(dict):
    """Numbers words in the order in which they first come; ``new`` holds those of the last round."""

    def __missing__(self, word):
        code = self[word] = len(self)
        self.new.append(word)
        return code

    def __init__(self):
        super().__init__()
        self.new: list = []

    def taken(self) -> list:
        new, self.new = self.new, []
        return new


class Words:
    """Numbers the words of texts and hashes each different word once."""

    def __init__(self):
        self.codes, self.hashes = Codes(), np.zeros(0, np.uint64)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code and hash of every word, and how many each text has."""
        if len(self.codes) > REMEMBERED:
            self.__init__()
        split = [t.encode().split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        number = self.codes.__getitem__
        codes = np.fromiter((number(w) for words in split for w in words), np.int64, int(sizes.sum()))
        fresh = self.codes.taken()
        if fresh:
            hashes = np.fromiter(map(zlib.crc32, fresh), np.uint64, len(fresh))
            self.hashes = np.concatenate([self.hashes, hashes * np.uint64(0x9E3779B97F4A7C15)])
        return codes, self.hashes[codes], sizes


def find_package(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver did.

    On a cluster ship the package as any other (``--py-files``); this only serves
    sessions that were started from another folder on the same machines.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def by_group(df: DataFrame, keys: list[str], run: Callable, schema) -> DataFrame:
    find_package(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(run, schema)


#: SQL: whether the array is there and holds finite numbers only.
FINITE = "coalesce(size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')), false)"


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """Rows of a list column as a matrix; all must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), kind)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def by_width(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch, apart by the lengths of their vectors."""
    widths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        yield int(width), batch.take(pa.array(np.flatnonzero(widths == width)))

"""Byte-level BPE by backtracking over longest matches, and its inverse.

A text is cut by the vocabulary's pattern and each piece is encoded by itself. The piece's
bytes are read as Latin-1 characters, so that an Aho-Corasick automaton over all tokens
gives the longest token at every position in one pass. The encoder walks these from left
to right. Two tokens may stand side by side if merging by rank would leave the cut
between them; where the next token does not fit, shorter prefixes of it are tried, and if
none fits the last token is taken back. A position that failed once is never entered
again, so the work is linear in the length of the piece. What fits is remembered.

A token that merging by rank cannot build is only used for a piece that equals it.

Null and empty texts have no ids and decode to no bytes. Rows, repeated ones too, stay as
they are; a null ``doc_id`` is carried along. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, runs

#: Pieces and token pairs that a worker remembers, in each of two generations.
PIECES, PAIRS = 150_000, 300_000
NONE = 1 << 62


class Pieces(dict):
    """The ids of pieces; what was not used for a generation is forgotten."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> tuple:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece.encode())
        if len(piece) <= 64:
            if len(self) >= PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Pairs(dict):
    """Whether two tokens may be neighbours."""

    def __init__(self, apart):
        super().__init__()
        self.apart = apart

    def __missing__(self, pair: int) -> bool:
        if len(self) >= PAIRS:
            self.clear()
        good = self[pair] = self.apart(pair >> 32, pair & 0xFFFFFFFF)
        return good


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.cut = regex.compile(pattern).findall
        self.left, self.right, self.merged, self.fits = {}, {}, {}, Pairs(self._apart)
        for token, i in sorted(self.ranks.items(), key=lambda x: x[1]):
            self._split(token, i)
        self.shorter = {i: self._prefix(self.bytes_of[i]) for i in self.left}
        self.length = {i: len(self.bytes_of[i]) for i in self.left}
        self.automaton = ahocorasick.Automaton()
        for i in self.left:
            self.automaton.add_word(self.bytes_of[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pieces = Pieces(self.encode_piece)

    def _split(self, token: bytes, i: int) -> None:
        """How merging by rank builds a token from two earlier ones."""
        if len(token) == 1:
            self.left[i] = self.right[i] = i
            return
        for at in range(1, len(token)):
            a, b = self.ranks.get(token[:at], NONE), self.ranks.get(token[at:], NONE)
            if a < i and b < i and a in self.left and b in self.left and self._apart(a, b):
                self.left[i], self.right[i], self.merged[a, b] = a, b, i
                return

    def _prefix(self, token: bytes) -> int:
        for size in range(len(token) - 1, 0, -1):
            i = self.ranks.get(token[:size], -1)
            if i in self.left:
                return i
        return -1

    def _apart(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the cut between two neighbouring tokens.

        Takes the later of their merges back, again and again: at each step the two parts
        that touch the cut must not have a merge that comes before those undone so far.
        """
        before = NONE
        while True:
            if self.merged.get((a, b), NONE) < before:
                return False
            # The right part's merge counts as the later one of two equal ranks, since equal
            # merges go from left to right.
            if a > b:
                before, part = a, self.right[a]
                if part != a:
                    a = part
                    continue
                before, part = b + 1, self.left[b]
                if part == b:
                    return True
                b = part
            else:
                before, part = b + 1, self.left[b]
                if part != b:
                    b = part
                    continue
                before, part = a, self.right[a]
                if part == a:
                    return True
                a = part

    def encode_piece(self, piece: bytes) -> tuple:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        latin, fits = piece.decode("latin-1"), self.fits
        # Often nothing has to be taken back: then the longest matches in a row are the answer.
        ids = [i for _, i in self.automaton.iter_long(latin)]
        for a, b in zip(ids, ids[1:]):
            if not fits[a << 32 | b]:
                return self._backtrack(latin)
        return tuple(ids)

    def _backtrack(self, latin: str) -> tuple:
        n, at, ids, fits, length, shorter = len(latin), 0, [], self.fits, self.length, self.shorter
        longest = [0] * n
        for end, i in self.automaton.iter(latin):
            longest[end + 1 - length[i]] = i
        failed, token = set(), longest[0]
        while at < n:
            end = at + length[token]
            if end not in failed and (not ids or fits[ids[-1] << 32 | token]):
                ids.append(token)
                at = end
                if at < n:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                failed.add(at)
                token = ids.pop()
                at -= length[token]
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.cut(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One per worker process: building it takes a second."""
    return Codec(path, pattern)


def _lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``rows(doc_id, ids)`` with ``data``, the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            column = batch.column("ids").fill_null([])
            flat, ends = column.flatten().to_numpy().tolist(), np.cumsum(pc.list_value_length(column).to_numpy()).tolist()
            data = [own.decode(flat[a:b]) for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    return in_arrow(rows.select(F.col("doc_id").cast("long"), "ids"), run, "doc_id long, ids array<int>, data binary")


def encoded_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): the ids of each text, and whether they decode to its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                ids = [own.encode(t) for t in texts]
                exact = [own.decode(i) == t.encode() for i, t in zip(ids, texts)]
                columns = [piece.column("doc_id"), pa.array(list(map(len, ids)), pa.int64()), _lists(ids), pa.array(exact, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "exact"])

    schema = "doc_id long, n_tokens long, ids array<int>, exact boolean"
    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def encoded(docs: DataFrame, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """(doc_id, ids): the token ids of each whole text; with ``decode`` also ``data``, what they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for piece, texts in runs(batch, "text"):
                ids = [own.encode(t) for t in texts]
                more = [pa.array(list(map(own.decode, ids)), pa.binary())] if decode else []
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), _lists(ids), *more], ["doc_id", "ids", "data"][: 2 + decode])

    schema = "doc_id long, ids array<int>" + ", data binary" * decode
    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)

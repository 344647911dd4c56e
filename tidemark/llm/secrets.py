"""Secrets found by patterns and by a linear-chain conditional random field.

Three patterns give the base spans. Beyond them, a CRF tags tokens as begin, inside or
outside of a secret. A token's scores come from its own shape, from the tokens next to it
and from the document (its size, lines and quotation marks); Viterbi gives the
best tags. Base spans always stay as they are; what a tagged run has outside of them becomes
a span of kind ``crf``, so that the rest of a secret which a pattern cuts short is found too.

The CRF is fitted on at most ``sample`` documents with base spans, those with the smallest
hash of their id among all, and as many without, chosen alike. Each task screens its texts and
keeps the ids with the smallest hashes; only the texts of those chosen over all are read again
and featurised. Of rows of one kind that share an id, the least text stands for all. The
values of the base spans are the labels. So that it does not just learn the patterns back,
each labelled value is shown ``COPIES`` more times with its alphabet, case, length, prefix,
name and sign of assignment drawn anew, and documents without base spans are shown around
their oddest tokens. ``kinds`` withholds kinds of base spans from the training, with all
documents that hold one, to measure what it finds of them.

Decoding is exact but cheap: a run of tags other than outside can only be best if the sum
of its tokens' best gains over outside, with the best transitions, is positive. One pass
over prefix sums finds the tokens that lie in any such run, and Viterbi visits only these.

Null and empty texts have no spans. Rows, repeated ones too, stay as they are, and a null
``doc_id`` is carried along. If no document has a base span, the CRF finds nothing.
Offsets count code points, ends are exclusive. ``redacted`` passes other columns through.
"""

from __future__ import annotations

import heapq
import math
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Codes, in_arrow, runs
from tidemark.session import written

#: The kinds in the order in which ties are listed, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
#: Any text with a base span matches this; RE2 reads a whole batch without making strings.
LIKELY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""

#: Bound of the sample on which the CRF is fitted: documents with base spans, and as many without.
SAMPLE = 500
#: A document of the sample gives windows of so many tokens around its spans, at most so many.
WINDOW, WINDOWS = 24, 4
#: Altered copies of a labelled value, and what they are made of.
COPIES = 2
NAMES = (
    "password", "passphrase", "pwd", "pass", "credential", "credentials", "auth", "access key", "private key", "bearer", "client secret", "login",
    "the key", "signing key", "master key", "pin", "secret", "token", "api key", "",
)
JOINS = (": ", " = ", "=", " is ", " \"", " -> ", " ", ":", ", ")
SMALL, LARGE, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (SMALL + LARGE + DIGITS, LARGE + DIGITS, SMALL + DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", SMALL + LARGE + DIGITS + "+/", SMALL + LARGE + DIGITS + "-_")
PREFIXES = ("", "", "", "sk_live_", "ghp_", "pk-", "xoxb-", "AKIA", "v2.")
FEATURES, ROUNDS, RATE, DECAY = 1 << 12, 60, 0.3, 1e-5
#: From the first letter or digit to the last.
ALNUM = re.compile(r"[^\W_](?:.*[^\W_])?", re.DOTALL)
TOKEN = re.compile(r"[A-Za-z0-9+/_.-]+|[^\sA-Za-z0-9+/_.-]+")
MARK = "[SECRET]"
OUT, BEGIN, INSIDE = 0, 1, 2
#: Words that a worker remembers before it starts afresh.
REMEMBERED = 250_000


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def values(text: str, kinds: tuple[str, ...] = KINDS) -> list[tuple[int, int]]:
    """Where the values of the base spans are: what follows the name of an assignment."""
    named = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS and "assign" in kinds]
    return named + [(a, b) for a, b, kind in base_spans(text) if kind != "assign" and kind in kinds]


def altered(text: str, kinds: tuple[str, ...] = KINDS) -> Iterator[tuple[str, tuple[int, int]]]:
    """Copies of a text with one secret named and spelt anew, and where that is; the same for the same text."""
    rng = random.Random(zlib.crc32(text.encode()))
    for a, b, kind in base_spans(text)[:WINDOWS]:
        for _ in range(COPIES if kind in kinds else 0):
            alphabet, size = rng.choice(ALPHABETS), rng.randint(12, 44)
            value = rng.choice(PREFIXES) + "".join(rng.choice(alphabet) for _ in range(size))
            name = rng.choice(NAMES) + rng.choice(JOINS)
            yield text[:a] + name + value + text[b:], (a + len(name), a + len(name) + len(value))


def odd(token: str) -> int:
    """How much a token of a text without secrets looks like one: its length, counted twice where it holds digits or mixed case."""
    mixed = any(c.isdigit() for c in token) or not (token.islower() or token.isupper() or token.istitle())
    return len(token) * (1 + mixed)


def _number(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


class _Shapes(dict):
    """Character classes: x and X for small and large letters, 9 for digits; other signs stay."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "9" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        return self[code]


_SHAPES, _SAME = _Shapes(), re.compile(r"(.)\1+")
HEX_DIGITS = "0123456789abcdefABCDEF"


def shape_of(token: str) -> tuple:
    """All that a token's own features see: its shape, size, different characters, and whether it is hexadecimal."""
    plain = token.isalpha() and ("x" if token.islower() else "Xx" if len(token) > 1 and token.istitle() else "")
    squeezed = plain or _SAME.sub(r"\1", token.translate(_SHAPES))
    return squeezed[:12], min(len(token) // 4, 10), min(len(set(token)) // 2, 10), not token.strip(HEX_DIGITS)


def own_features(token: str) -> list[int]:
    return shape_features(shape_of(token))


def shape_features(key: tuple) -> list[int]:
    shape, size, different, hexadecimal = key
    kinds = "".join(k for k in "9Xx" if k in shape) + "?" * bool(shape.strip("9Xx"))
    return [
        _number("bias"), _number(f"shape {shape}"), _number(f"size {size}"), _number(f"kinds {kinds}"), _number(f"different {different}"),
        _number(f"numbers {min(shape.count('9'), 6)}"), _number(f"size kinds {size} {kinds}"), _number(f"hex {hexadecimal} {size}"),
    ]


def near_hashes(token: str) -> tuple[int, int]:
    """What its neighbours see of a token: a short plain word, and how it begins."""
    if token.isalpha():
        return (zlib.crc32(token.lower().encode()) if len(token) <= 12 and token.isascii() else 1), 2
    return 1, 2 if token[0].isalnum() else zlib.crc32(token[:2].encode())


def near_numbers(hashes: np.ndarray, side: str) -> np.ndarray:
    """Feature numbers, of one kind for each column of the hashes."""
    salt = np.array([0x9E3779B1, 0x85EBCA77] if side == "before" else [0xC2B2AE3D, 0x27D4EB2F], np.uint64)
    return ((hashes.astype(np.uint64) + salt) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % FEATURES


def near_features(token: str, side: str) -> list[int]:
    return near_numbers(np.array([near_hashes(token)]), side)[0].tolist()


def file_features(text: str) -> list[int]:
    size = min(int(math.log2(len(text) + 1)), 20)
    marks = min(text.count("=") + text.count('"'), 8)
    return [_number(f"file size {size}"), _number(f"file marks {marks}"), _number(f"file lines {min(text.count(chr(10)), 8)}")]


@dataclass
class Crf:
    """Weights by feature and tag, and by tag and next tag."""

    emit: np.ndarray
    move: np.ndarray

    def own(self, token: str) -> np.ndarray:
        return self.emit[own_features(token)].sum(axis=0)

    def near(self, token: str, side: str) -> np.ndarray:
        return self.emit[near_features(token, side)].sum(axis=0)

    def file(self, text: str) -> np.ndarray:
        return self.emit[file_features(text)].sum(axis=0)


def tokens_of(text: str) -> list[re.Match]:
    return list(TOKEN.finditer(text))


def examples(text: str, kinds: tuple[str, ...] = KINDS) -> list[tuple[list[list[int]], list[int]]]:
    """What a document of the sample teaches: its own windows, and those around its altered secrets."""
    out = windows(text, sorted(values(text, kinds)))
    for copy, span in altered(text, kinds):
        out += windows(copy, [span])
    return out


def windows(text: str, marked: list[tuple[int, int]] | None = None) -> list[tuple[list[list[int]], list[int]]]:
    """Feature numbers and tags of stretches around the marked spans, or around the oddest tokens where there are none."""
    marked = sorted(values(text)) if marked is None else marked
    found = tokens_of(text)
    if not found:
        return []
    tags, before = [], None
    for m in found:
        inside = next((s for s in marked if s[0] < m.end() and m.start() < s[1]), None)
        tags.append(OUT if inside is None else INSIDE if inside == before else BEGIN)
        before = inside
    starts = [i for i, t in enumerate(tags) if t == BEGIN][:WINDOWS]
    starts = starts or sorted(heapq.nlargest(WINDOWS - 1, range(len(found)), key=lambda i: (odd(found[i][0]), -i)))
    of_file, out = file_features(text), []
    for at in starts:
        low, high = max(0, at - WINDOW // 2), min(len(found), at + WINDOW // 2)
        rows = []
        for i in range(low, high):
            row = own_features(found[i][0]) + of_file
            row += near_features(found[i - 1][0], "before") if i else []
            row += near_features(found[i + 1][0], "after") if i + 1 < len(found) else []
            rows.append(row)
        out.append((rows, tags[low:high]))
    return [w for w in out if w[0]]


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(shown: list[tuple[list[list[int]], list[int]]]) -> Crf:
    """Penalised maximum likelihood by full gradients (forward-backward) with AdaGrad steps."""
    emit, move = np.zeros((FEATURES + 1, 3)), np.zeros((3, 3))
    if not any(BEGIN in tags for _, tags in shown):
        return Crf(emit, move)
    n, long, wide = len(shown), max(len(t) for _, t in shown), max(len(r) for rows, _ in shown for r in rows)
    ids, gold, live = np.full((n, long, wide), FEATURES), np.zeros((n, long), int), np.zeros((n, long), bool)
    for k, (rows, tags) in enumerate(shown):
        for i, row in enumerate(rows):
            ids[k, i, : len(row)] = row
        gold[k, : len(tags)], live[k, : len(tags)] = tags, True
    both = live[:, 1:] & live[:, :-1]
    want_emit = np.stack([np.bincount(ids[live & (gold == y)].ravel(), minlength=FEATURES + 1) for y in range(3)], axis=1)
    want_move = np.zeros((3, 3))
    np.add.at(want_move, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    seen_emit, seen_move = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    for _ in range(ROUNDS):
        emit[FEATURES] = 0
        score = emit[ids].sum(axis=2)
        ahead, back = np.zeros((n, long, 3)), np.zeros((n, long, 3))
        ahead[:, 0] = score[:, 0]
        for t in range(1, long):
            step = _sum_exp(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
            ahead[:, t] = np.where(live[:, t, None], step, ahead[:, t - 1])
        for t in range(long - 2, -1, -1):
            step = _sum_exp(move + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(live[:, t + 1, None], step, 0)
        total = _sum_exp(ahead[:, -1], 1)
        share = np.exp(ahead + back - total[:, None, None]) * live[..., None]
        got_emit = np.stack([np.bincount(ids.ravel(), np.repeat(share[..., y].ravel(), wide), FEATURES + 1) for y in range(3)], axis=1)
        pair = ahead[:, :-1, :, None] + move + (score + back)[:, 1:, None, :] - total[:, None, None, None]
        got_move = (np.exp(pair) * both[..., None, None]).sum(axis=(0, 1))
        for weights, seen, slope in ((emit, seen_emit, want_emit - got_emit - DECAY * n * emit), (move, seen_move, want_move - got_move - DECAY * n * move)):
            seen += slope**2
            weights += RATE * slope / np.sqrt(seen)
    emit[FEATURES] = 0
    return Crf(emit, move)


class _Least:
    """The ids with the smallest (hash, id), at most ``size`` different ones."""

    def __init__(self, size: int):
        self.size, self.kept, self.heap = size, set(), []

    def wants(self, h: int, key: int) -> bool:
        if (h, key) in self.kept or not self.size:
            return False
        return len(self.heap) < self.size or (h, key) < (-self.heap[0][0], -self.heap[0][1])

    def add(self, h: int, key: int) -> None:
        self.kept.add((h, key))
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, (-h, -key))
        else:
            gone = heapq.heappushpop(self.heap, (-h, -key))
            self.kept.remove((-gone[0], -gone[1]))


def sampled(docs: DataFrame, sample: int = SAMPLE, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """(secret, h, doc_id, text) of the documents on which the CRF is fitted."""

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {True: _Least(sample), False: _Least(sample)}
        for batch in batches:
            text = batch.column("text")
            hits = pc.fill_null(pc.match_substring_regex(text, LIKELY), False).to_pylist()
            for i, (key, h, hit) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist(), hits)):
                if key is None or not (hit and least[True].wants(h, key) or least[False].wants(h, key)):
                    continue
                found = text[i].as_py() or ""
                secret = hit and len(values(found)) > 0
                if secret and len(values(found)) > len(values(found, kinds)):
                    continue  # holds what is withheld
                if TOKEN.search(found) and least[secret].wants(h, key):
                    least[secret].add(h, key)
        rows = [(k, h, key) for k in least for h, key in sorted(least[k].kept)]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.bool_(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["secret", "h", "known_id"])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            fits = [bool(TOKEN.search(t)) and (len(values(t)) > 0) == k for t, k in zip(texts, batch.column("secret").to_pylist())]
            yield batch.filter(pa.array(fits, pa.bool_()))

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    least = in_arrow(rows.withColumn("h", F.xxhash64("doc_id")), screen, "secret boolean, h long, known_id long")
    least = written(least, "secrets-least")
    first = [least.where(kind).distinct().orderBy("h", "known_id").limit(sample) for kind in ("secret", "not secret")]
    known = written(first[0].unionByName(first[1]), "secrets-known")
    again = rows.join(F.broadcast(known), F.col("doc_id") == F.col("known_id")).select("secret", "h", "doc_id", "text")
    return in_arrow(again, chosen, "secret boolean, h long, doc_id long, text string").groupBy("secret", "h", "doc_id").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, sample: int = SAMPLE, kinds: tuple[str, ...] = KINDS) -> Crf:
    """Fits the CRF on the driver; only the windows' feature numbers of the sample get there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [examples(t, kinds) for t in batch.column("text").to_pylist()]
            flat = [[x for x, _ in g] for g in got], [[y for _, y in g] for g in got]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("secret", "h", "doc_id")),
                 pa.array(flat[0], pa.list_(pa.list_(pa.list_(pa.int32())))), pa.array(flat[1], pa.list_(pa.list_(pa.int32())))],
                ["secret", "h", "doc_id", "rows", "tags"],
            )

    schema = "secret boolean, h long, doc_id long, rows array<array<array<int>>>, tags array<array<int>>"
    made = in_arrow(sampled(docs, sample, kinds), run, schema).collect()  # bounded by sample
    made.sort(key=lambda r: (not r.secret, r.h, r.doc_id))
    return train([(x, y) for r in made for x, y in zip(r.rows, r.tags)])


class Tagger:
    """Finds the best tags of many texts, with what each different word adds kept by worker."""

    def __init__(self, crf: Crf):
        self.crf = crf
        m = crf.move
        inner = m[1:, 1:] - m[OUT, OUT]
        #: The most a token adds by its transition, and what entering and leaving adds on top.
        self.step = max(0.0, float(inner.max()))
        self.ends = float((m[OUT, 1:] - m[OUT, OUT]).max() + m[1:, OUT].max())
        self.forget()

    def forget(self) -> None:
        self.words, self.parts, self.tokens, self.shapes = Codes(), [], Codes(), {}
        self.gains = np.zeros((0, 3, 2))

    def _learn(self) -> None:
        number = self.tokens.__getitem__
        self.parts += [tuple(map(number, TOKEN.findall(w))) for w in self.words.taken()]
        fresh = self.tokens.taken()
        if fresh:
            keys = list(map(shape_of, fresh))
            for k in set(keys).difference(self.shapes):
                self.shapes[k] = self.crf.emit[shape_features(k)].sum(axis=0)
            hashes = np.array(list(map(near_hashes, fresh)))
            near = [self.crf.emit[near_numbers(hashes, side)].sum(axis=1) for side in ("before", "after")]
            scores = np.stack([np.array([self.shapes[k] for k in keys]), *near], axis=1)
            self.gains = np.concatenate([self.gains, scores[..., 1:] - scores[..., :1]])

    def tag(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """For each text the (first, last) token numbers of its runs."""
        if len(self.words) > REMEMBERED:
            self.forget()
        number = self.words.__getitem__
        split = [list(map(number, t.split())) for t in texts]
        self._learn()
        codes = [list(chain.from_iterable(map(self.parts.__getitem__, s))) for s in split]
        sizes = np.array(list(map(len, codes)))
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not sizes.sum():
            return out
        at = np.fromiter(chain.from_iterable(codes), np.int64, int(sizes.sum()))
        files = np.array([self.crf.file(t) for t in texts])
        gain = self.gains[at, 0] + np.repeat(files[:, 1:] - files[:, :1], sizes, axis=0)
        doc = np.repeat(np.arange(len(texts)), sizes)
        same = (doc[1:] == doc[:-1])[:, None]
        gain[1:] += self.gains[at[:-1], 1] * same
        gain[:-1] += self.gains[at[1:], 2] * same
        first = np.concatenate([[0], np.cumsum(sizes)])
        for low, high in self._live(gain.max(axis=1) + self.step, doc):
            for a, b in self._best(gain[low:high], low > first[doc[low]], high < first[doc[low] + 1]):
                out[doc[low]].append((int(low + a - first[doc[low]]), int(low + b - first[doc[low]])))
        return out

    def _live(self, most: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of tokens that lie in a run, within one document, that could beat outside."""
        if not (most > min(0.0, -self.ends)).any():
            return []
        # A wall between documents that no run can pay for.
        wall = np.abs(most).sum() + abs(self.ends) + 1
        spaced = most.copy()
        at = np.arange(len(most)) + doc - doc[0]
        spaced = np.full(at[-1] + 1, -wall)
        spaced[at] = most
        total = np.concatenate([[0], np.cumsum(spaced)])
        # The best sum of a run that ends, or starts, at each place.
        ending = total[1:] - np.minimum.accumulate(total)[:-1]
        starting = np.maximum.accumulate(total[::-1])[::-1][1:] - total[:-1]
        through = (ending + starting - spaced)[at]
        live = through + self.ends > -1e-6
        edges = np.flatnonzero(np.diff(np.concatenate([[False], live, [False]]).astype(np.int8)))
        pieces = []
        for low, high in edges.reshape(-1, 2):
            cuts = np.flatnonzero(doc[low + 1 : high] != doc[low : high - 1]) + low + 1
            pieces += list(zip([low, *cuts], [*cuts, high]))
        return pieces

    def _best(self, gain: np.ndarray, before: bool, after: bool) -> list[tuple[int, int]]:
        """Viterbi over one stretch; its neighbours, where it has any, are outside. Ties go to outside."""
        move, n = self.crf.move, len(gain)
        score = np.concatenate([np.zeros((n, 1)), gain], axis=1)
        best = score[0] + (move[OUT] if before else 0)
        came = np.zeros((n, 3), np.int8)
        for t in range(1, n):
            options = best[:, None] + move
            came[t] = options.argmax(axis=0)
            best = options.max(axis=0) + score[t]
        tag = int((best + (move[:, OUT] if after else 0)).argmax())
        tags = [tag]
        for t in range(n - 1, 0, -1):
            tag = int(came[t][tag])
            tags.append(tag)
        tags.reverse()
        found: list[tuple[int, int]] = []
        for i, tag in enumerate(tags):
            if tag == BEGIN or tag == INSIDE and (not i or tags[i - 1] == OUT):
                found.append((i, i))
            elif tag == INSIDE:
                found[-1] = (found[-1][0], i)
        return found


def outside(text: str, run: tuple[int, int, str], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The parts of a run that no base span covers, without the signs at their ends."""
    parts, at = [], run[0]
    for start, end, _ in [b for b in base if b[0] < run[1] and run[0] < b[1]] + [(run[1], run[1], "")]:
        if start > at:
            held = ALNUM.search(text, at, start)
            if held:
                parts.append((held.start(), held.end(), run[2]))
        at = max(at, end)
    return parts


def spans_of(texts: list[str], likely: list[bool], tagger: Tagger) -> list[tuple[list, list]]:
    """For each text its base spans, and all spans with those of the CRF."""
    out = []
    for text, hit, runs_found in zip(texts, likely, tagger.tag(texts)):
        base = base_spans(text) if hit else []
        more = []
        if runs_found:
            places = tokens_of(text)
            more = [(places[a].start(), places[b].end(), "crf") for a, b in runs_found]
            more = [s for run in more for s in outside(text, run, base)]
        out.append((base, sorted(base + more, key=lambda s: (s[0], (*KINDS, "crf").index(s[2]), s[1]))))
    return out


def _walk(batch: pa.RecordBatch, tagger: Tagger):
    for piece, texts in runs(batch, "text"):
        likely = pc.fill_null(pc.match_substring_regex(piece.column("text"), LIKELY), False).to_pylist()
        yield piece, texts, spans_of(texts, likely, tagger)


SPANS = "array<struct<kind: string, start: long, end: long>>"


def find(docs: DataFrame, crf: Crf) -> DataFrame:
    """(doc_id, base, spans): the base spans, and all spans, of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        tagger = Tagger(crf)
        for batch in batches:
            for piece, _, found in _walk(batch, tagger):
                columns = [pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in f[i]] for f in found], kind) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, f"doc_id long, base {SPANS}, spans {SPANS}")


def redacted(docs: DataFrame, crf: Crf, mark: str = MARK) -> DataFrame:
    """All rows and columns, with each secret in ``text`` replaced by a mark; spans that meet become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(crf)
        for batch in batches:
            for piece, texts, found in _walk(batch, tagger):
                at = piece.schema.get_field_index("text")
                fresh = [_cover(t, f[1], mark) if f[1] else t for t, f in zip(texts, found)]
                fresh = pa.array(fresh, piece.column(at).type, mask=piece.column(at).is_null().to_numpy(zero_copy_only=False))
                yield piece.set_column(at, piece.schema.field(at), fresh)

    return in_arrow(docs, run, docs.schema)


def _cover(text: str, spans: list, mark: str) -> str:
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
from tokenizers import Tokenizer

from tidemark.llm import queries, token_orc

PATH = public_tokenizers.path(queries.WORD_BPE)


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def want(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library_ids(text) + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def library_ids(text, known={}):  # noqa: B006
    if not known:
        known["t"] = library()
    return known["t"].encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library():
    signs = ["a", "B", " ", "é", "ü", "中", "\n", "1", "#", "́", "😀", "th", "ing", "'s", "A", "-", "\x0b", "\x1c", "\x85", "\xa0", "İ", "ß", "Σ", "ſ", "K", ".", "<|endoftext|>", "H̱", "ŉ", "ﬁ", "ª", "²", "½", "×", "\xad", "µ", "'"]
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 30))) for _ in range(6000)] + ["", " ", "x" * 3000, "#" * 3000]
    ids, counts = token_orc.Encoder(PATH).encode(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == library_ids(text) + [1], text


def test_query_on_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op3_token_orc(spark, small).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want(rows)


def test_files(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    path = str(tmp_path / "out")
    token_orc.write(docs, path, PATH)
    last = -1
    for name in sorted(glob.glob(f"{path}/part-*.orc")):
        ids = pyarrow.orc.ORCFile(name).read(["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last
    some = token_orc.find(spark, path, [3, 77, 10**9])
    assert sorted(r.doc_id for r in some.collect()) == [3, 77]
    assert "doc_id" in some._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1].split("]")[0]


def test_odd_rows(spark, odd, odd_rows, none, tmp_path):
    token_orc.write(odd, str(tmp_path / "odd"), PATH)
    got = token_orc.checksums(token_orc.read(spark, str(tmp_path / "odd"))).collect()
    assert len(got) == len(odd_rows)
    got = sorted((tuple(r) for r in got), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([r[0] for r in odd_rows], key=lambda x: (x is not None, x or 0))
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and got[0][1] == 0
    ids = {r[0]: len(library_ids(r[1])) + 1 for r in odd_rows}
    assert all(r[2] == ids[r[0]] for r in got if r[0] is not None)
    token_orc.write(none, str(tmp_path / "none"), PATH)
    assert token_orc.checksums(token_orc.read(spark, str(tmp_path / "none"))).count() == 0


def test_special_tokens_in_texts_are_the_library_s(spark, tmp_path):
    """The contract is the library as it comes, with add_special_tokens=False and no flag set."""
    plain = Tokenizer.from_file(PATH)
    signs = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "a", "É", "é", "\u0338", "中", "'s", "\n", "<"]
    rnd = random.Random(9)
    texts = ["a <|endoftext|> b", "no marker", ""] + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    ids = [plain.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert ids[0] == [320, 49407, 321, 1]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    token_orc.write(docs, str(tmp_path / "out"), PATH)
    got = token_orc.read(spark, str(tmp_path / "out")).orderBy("doc_id").collect()
    assert [list(r.ids) for r in got] == ids
    assert [r.start for r in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_bpe, queries


@pytest.fixture(scope="module", params=[queries.BYTE_BPE, "byte_bpe_50k.tiktoken"])
def both(request):
    path = public_tokenizers.path(request.param)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = byte_bpe.codec(path, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(both):
    own, library = both

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(max_size=80), st.text(alphabet="abcdeinorst ' \n1é", max_size=120)))
    def check(text):
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()

    check()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 5000, "#" * 5000, "=-" * 3000, " " * 4000, "é" * 4000, "x" + "\n" * 3000, "thththe" * 2000])
def test_long_pieces(both, text):
    assert both[0].encode(text) == both[1].encode_ordinary(text)


def test_small_vocabulary_with_a_token_that_merging_cannot_build(tmp_path):
    """"abc" is a token, but neither "ab" nor "bc" is: it is only used for a whole piece."""
    words = [bytes([i]) for i in range(256)] + [b"abc", b"xy", b"yz", b"xyz", b"xyzx"]
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(w) + b" " + str(i).encode() for i, w in enumerate(words)))
    own = byte_bpe.Codec(str(path), r"\S+|\s+")
    library = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks={w: i for i, w in enumerate(words)}, special_tokens={})
    import itertools

    for size in range(1, 8):
        for letters in itertools.product("abcxyz" if size < 5 else "xyz", repeat=size):
            assert own.encode("".join(letters)) == library.encode_ordinary("".join(letters))


def test_query_on_whole_table(spark, small):
    texts = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    path = public_tokenizers.path(queries.BYTE_BPE)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = queries.op8_byte_bpe(spark, small).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_odd_rows(spark, odd, odd_rows, none):
    where = public_tokenizers.path(queries.BYTE_BPE), public_tokenizers.PATTERN
    back = byte_bpe.decoded(byte_bpe.encoded(odd, *where), *where).collect()
    assert sorted((repr(r.doc_id), bytes(r.data)) for r in back) == sorted((repr(r[0]), (r[1] or "").encode()) for r in odd_rows)
    assert byte_bpe.decoded(byte_bpe.encoded(none, *where), *where).count() == 0
    out = byte_bpe.encoded_documents(odd, *where).collect()
    assert len(out) == len(odd_rows) and all(r.exact and r.n_tokens == len(r.ids) for r in out)

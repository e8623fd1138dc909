"""Encoding, decoding, token files and token counts against the libraries, and their defined cases."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from brute import docs_rows, docs_table  # noqa: F401  (fixtures)
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starfold.llm import bpe, token_counts, token_planes
from starfold.llm.chunks import ChunkCoder, Recent, cut
from starfold.session import fresh_path

RANKS, JSON, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "a  b", "tab\there", "x \n y", "don't 's 'll", "1,000.5 a.b... ,x ,,", "日本語 😀😀 x", "é ́e", "<|endoftext|> a <|startoftext|>", "a\x00b\x1cc", " nbsp", "Ünï Ⅷ İ ΣΑΣ ﬁ", "aaaaaaa abababab " * 3, "a._.b", "end. ", ".start"]
TEXT = st.text(st.one_of(st.sampled_from(list("abcABC .,\n'1é<|> \t")), st.characters(exclude_categories=["Cs"])), max_size=60)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ranks_encode_like_tiktoken(text):
    enc = test_ranks_encode_like_tiktoken.enc = getattr(test_ranks_encode_like_tiktoken, "enc", None) or tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})
    raw = bpe.coder(RANKS, P.PATTERN).encode([text])[0]
    assert ids_of(raw) == enc.encode_ordinary(text)
    assert bpe.decode_ids(raw, bpe.token_bytes(RANKS, P.PATTERN)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_chunks_encode_like_whole_texts(text):
    whole = bpe.tokenizer(JSON, None).encode(text, add_special_tokens=False).ids
    assert ids_of(bpe.coder(JSON, None).encode([text])[0]) == whole


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_many_texts_encode_like_each_alone(texts):
    """New chunks are encoded in runs; a fresh dictionary each time, so that all are new."""
    for path, pattern in ((JSON, None), (RANKS, P.PATTERN)):
        kept = bpe.coder(path, pattern)
        fresh = ChunkCoder(kept.encode_many, kept.special, at_once=5, sizes=kept.sizes)
        library = bpe.tokenizer(path, pattern)
        assert [ids_of(x) for x in fresh.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_runs_fall_back_where_an_id_crosses_a_chunk():
    """A library that makes one id of two chunks: the run is refused and each chunk is encoded alone."""
    calls = []

    def many(texts):
        calls.append(list(texts))
        return [bpe.as_bytes([1] * (len(t) // 4)) for t in texts]

    coded = ChunkCoder(many, sizes=np.array([0, 4], np.int64))
    assert [ids_of(x) for x in coded.in_runs([" abc", " ab", " abcd"])] == [[1], [], [1]]
    assert calls == [[" abc ab abcd"], [" abc", " ab", " abcd"]]


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_counts_are_those_of_the_library(text):
    counted = token_counts.counts(WORDS)
    assert counted.texts([text]) == [len(counted.library.encode(text, add_special_tokens=False).ids)]


def test_odd_texts(tik):
    assert [ids_of(x) for x in bpe.coder(RANKS, P.PATTERN).encode(ODD)] == [tik.encode_ordinary(t) for t in ODD]
    counted = token_counts.counts(WORDS)
    assert counted.texts(ODD) == [len(counted.library.encode(t, add_special_tokens=False).ids) for t in ODD]
    assert all("".join(cut(t)) == t for t in ODD if "\x00" not in t)


def test_a_full_dictionary_changes_nothing():
    calls = []
    known = Recent(lambda new: calls.append(len(new)) or [k.upper() for k in new], most=3)
    for keys in ({"a", "b"}, {"c", "d"}, {"a", "e"}, {"f"}, {"a", "b", "c"}):
        held = known.filled(keys)
        assert all(held[k] == k.upper() for k in keys)
        assert len(known.young) + len(known.old) <= 3 + 3 + 5


def test_spans_cover_the_text():
    table = bpe.token_bytes(RANKS, P.PATTERN)
    for text in ODD:
        raw = bpe.coder(RANKS, P.PATTERN).encode([text])[0]
        at = 0
        for (first, end), i in zip(bpe.spans(raw, table), ids_of(raw), strict=True):
            assert first <= at <= end <= len(text) and (table[i] in text[first:end].encode())
            at = end
        assert at == len(text)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_encode_and_decode_frames(spark, docs_table, tik):
    docs = docs_table.union(spark.createDataFrame([(-1, None, "x", None, 0), (-2, "", None, "s", 0)], docs_table.schema)).withColumns({"ids": F.lit("own"), "_x": F.lit(1)})
    coded = bpe.encode(docs, RANKS, P.PATTERN, offsets=True)
    rows = bpe.decode(coded, RANKS, P.PATTERN).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = tik.encode_ordinary(r["text"] or "")
        assert ids_of(bytes(r["ids"])) == want and r["n_tokens"] == len(want) == len(r["spans"])
        assert bytes(r["decoded"]) == (r["text"] or "").encode() and r["_x"] == 1
    assert bpe.encode(docs.limit(0), RANKS, P.PATTERN).collect() == []


def test_counts_frame(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "word " * 5000), (None, "Hello, world")]
    docs = frame(spark, rows).withColumns({"n_tokens": F.lit("x"), "n_bytes": F.lit(None).cast("string"), "own": F.lit(7)})
    library = token_counts.counts(WORDS).library
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"], r["own"]) for r in token_counts.count_tokens(docs, WORDS).collect()))
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert got == sorted((i or 0, len((t or "").encode()), k, k > 2048, 7) for (i, t), k in zip(rows, n, strict=True))
    assert token_counts.count_tokens(docs.limit(0), WORDS).collect() == []


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 5000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    planes = token_planes.to_planes(ids, 1024, bits)
    assert len(planes) == (32 if bits else 4)
    assert (token_planes.from_planes(planes, n, 1024) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_files_round_trip(spark, docs_rows, bits):
    rows = [*docs_rows, (-5, None), (-4, ""), (None, "first"), (7, "again"), (7, "again"), (9_999, "word, " * 20_000)]
    path = fresh_path(spark, "test-planes")
    token_planes.write_tokens(frame(spark, rows).withColumns({"chunk": F.lit(1), "ids": F.lit(2)}), path, JSON, end_id=2, chunk=3000, bits=bits)
    got = sorted(token_planes.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    library = bpe.tokenizer(JSON, None)
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    want = sorted((str(i), zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for i, t in rows)
    assert sorted((str(r["doc_id"]), zlib.crc32(bytes(r["ids"]))) for r in got) == want
    index = token_planes.chunk_index(spark, path).orderBy("start").collect()
    assert index[0]["start"] == 0 and all(a["start"] + a["n_ids"] == b["start"] for a, b in zip(index, index[1:], strict=False))


def test_files_of_nothing(spark):
    path = fresh_path(spark, "test-planes")
    token_planes.write_tokens(frame(spark, []), path, JSON)
    assert token_planes.read_tokens(spark, path).collect() == []

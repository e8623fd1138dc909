"""Encoding by a trie of words against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starfold.llm import trie_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = "aAbeth ésß’'.,1290\t\n\x1c\x85İΣςﬁ 漢字🙂é ​\x00$"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(4)
    yield from ["", " ", "a" * 30_000, "<|endoftext|>", "x<|startoftext|> y<|endoftext|><|endoftext|>z", "<|endof text|>", "it's we'll 'sss", "".join(rng.choice("aab") for _ in range(5_000)), "word " * 50_000]
    for _ in range(1_500):
        yield "".join(rng.choice(ODD) for _ in range(rng.randrange(60)))
    for _ in range(3_000):
        yield "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 25)))


def test_equals_library(spark, library):
    bodies = list(texts())
    rows = [(i, t) for i, t in enumerate(bodies)] + [(-1, None), (0, ""), (3, bodies[3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = trie_bpe.decode(trie_bpe.encode(frame, PATH), PATH).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in out) == sorted((i, t or "") for i, t in rows)
    for r in out:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_every_token_of_the_vocabulary(library):
    coder = trie_bpe.TrieCoder(PATH)
    words = [t.removesuffix("</w>") for t in library.get_vocab(with_added_tokens=False)]
    found = coder.merges.encode([w for w in words if w])
    for word, ids in found.items():
        assert ids == [t.id for t in library.model.tokenize(word)], word


def test_neighbours_are_told_without_merging(library):
    """``fits`` against merging the two tokens' letters anew."""
    merges, rng = trie_bpe.Merges(PATH), random.Random(9)
    tokens = list(merges.inner.items())
    for _ in range(20_000):
        (a, i), (b, j) = rng.choice(tokens[:3_000]), rng.choice(tokens[:3_000])
        if merges.fits(i, j):
            again = trie_bpe.trie([a + b + "!"])
            own = merges.walk(again)[a + b + "!"]
            assert own == [t.id for t in library.model.tokenize(a + b + "!")]


def test_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "Hello there", [5], "kept")], "doc_id long, text string, IDS array<int>, Decoded string")
    out = trie_bpe.decode(trie_bpe.encode(frame, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    assert out.first()["text"] == "Hello there"
    assert trie_bpe.encode(frame, PATH, keep=["doc_id"]).columns == ["doc_id", "ids", "n_tokens"]
    assert trie_bpe.decode(trie_bpe.encode(frame.limit(0), PATH), PATH).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([0, 99_999_999, -1, 2],)], "ids array<int>")
    assert [r["decoded"] for r in trie_bpe.decode(odd, PATH).collect()] == ["", "", "! #"]


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"model": {"type": "WordPiece", "vocab": {}, "merges": []}}')
    with pytest.raises(ValueError):
        trie_bpe.Merges(str(path))

"""Token counts with a whole-token shortcut.

Offline, each string of the vocabulary is put through the tokenizer's own steps; those that come back as one
pre-token and one token are proven. In a text, a pre-token that is proven counts as one without any merge, and only
the rest is merged by the library's model. Words repeat, so the counts of words between blanks are kept in a dictionary.

The steps of such a tokenizer (normal form, blanks to one space, lower case, a pattern that never matches a blank)
work alike on each word between blanks, so a text's count is the sum over its words. Texts with controls that Python
and the library see differently (\\x1c-\\x1f), or with a string of a special token, go to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.bpe import byte_table, tokenizer
from starfold.llm.chunks import Recent
from starfold.llm.text import portions, put, strings, whole

ODD = re.compile("[\x00\x1c-\x1f᠎​-‏⁠-⁤﻿]")


@lru_cache(maxsize=2)
def proven(path: str) -> frozenset[str]:
    """Spellings of pre-tokens that are proven to be one token each."""
    library = tokenizer(path, None)
    back = {c: b for b, c in enumerate(byte_table())}
    suffix = library.model.end_of_word_suffix or ""
    words = {}
    for token in library.get_vocab(with_added_tokens=False):
        spelled = token.removesuffix(suffix)
        try:
            words[spelled] = bytes(back[c] for c in spelled).decode()
        except (KeyError, UnicodeDecodeError):  # a part of a character is no whole text
            continue
    out = set()
    coded = library.encode_batch_fast(list(words.values()), add_special_tokens=False)
    for (spelled, word), e in zip(words.items(), coded, strict=True):
        if len(e.ids) == 1 and word and [p for p, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(word))] == [spelled]:
            out.add(spelled)
    return frozenset(out)


class Counts:
    """Tokens of texts."""

    def __init__(self, path: str):
        self.library, self.whole = tokenizer(path, None), proven(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known = Recent(lambda new: list(map(self.word, new)), most=300_000)

    def word(self, word: str) -> int:
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return sum(1 if p in self.whole else len(self.library.model.tokenize(p)) for p, _ in pieces)

    def texts(self, texts: list[str]) -> list[int]:
        parts = [None if ODD.search(t) or any(s in t for s in self.special) else t.split() for t in texts]
        get = self.known.filled(set().union(*filter(None, parts))).__getitem__
        return [len(self.library.encode(t, add_special_tokens=False).ids) if p is None else sum(map(get, p)) for t, p in zip(texts, parts, strict=True)]


@lru_cache(maxsize=2)
def counts(path: str) -> Counts:
    """One for each Python worker."""
    return Counts(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """The documents with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Defined cases: a null or empty text has 0 bytes and 0 tokens; whole texts of any length are counted; repeated rows
    repeat; columns named like the new ones are replaced.
    """
    src = docs.select(F.struct("*").alias("row")).select(*put(docs, "row", _text=whole(F.col("row")[text])))
    rest = [f for f in src.schema.fields if f.name not in ("_text", "n_bytes", "n_tokens", "over_limit")]
    src = src.select("_text", *(F.col(f"`{f.name}`") for f in rest), F.octet_length("_text").cast("long").alias("n_bytes"))
    kept = [*rest, T.StructField("n_bytes", T.LongType())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = counts(path)
        for batch in portions(batches, "_text"):
            n = pa.array(counted.texts(strings(batch.column("_text"))), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), n], names=[*(f.name for f in kept), "n_tokens"])

    out = src.mapInArrow(run, T.StructType([*kept, T.StructField("n_tokens", T.LongType())]))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

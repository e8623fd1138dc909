"""BPE encoding by a trie of distinct words, and decoding.

A word's encoding is found from the encodings of its prefixes. Two tokens may stand side by side if the merges that build
them are all done before any merge across their border could be (``Merges.fits``); a run of tokens is the encoding of its text
exactly if all neighbours fit. So a prefix has one last token: the token that ends there and fits the last token of
what is before it. A text's distinct new words go into a trie, and one walk, depth first, gives each node the last
token of its prefix from those of its ancestors; prefixes that words share are computed once, and a word's tokens are read
off backwards from its leaf. The last letter of a word is a symbol of its own kind (the suffix that ends words), a leaf.

Normal form and the cut into words are the library's own steps, taken for each distinct run between blanks. They work
alike on each such run: normal form and lower case don't reach over a blank, and no match of the pattern holds one.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.bpe import U4, byte_table, tokenizer
from starfold.llm.carry import map_column, slices
from starfold.llm.chunks import Recent

#: Whether an array of unsigned ints is stored as the ids are.
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Controls that Python takes for blanks and the tokenizer's pattern doesn't.
ODD = re.compile("[\x1c-\x1f]")
RUN = re.compile("[^\x09-\x0d \x85\xa0  -     　]+")
#: Entries of a worker's dictionaries: neighbours, steps of the walk, runs and words with their ids.
NEIGHBOURS, STEPS, RUNS, WORDS = 600_000, 150_000, 220_000, 120_000


class Merges:
    """The merges of a BPE model whose every token is made by one merge of earlier tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        names, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path}: not a plain byte-level BPE model")
        self.inner: dict[str, int] = {}  # tokens within words, by their letters
        self.final: dict[str, int] = {}  # tokens that end words, by their letters without the suffix
        self.rank, self.left, self.right = [[-1] * (max(names.values()) + 1) for _ in range(3)]
        self.pair: dict[int, int] = {}
        self.width = len(self.rank)
        ends: dict[int, tuple[str, bool]] = {}
        for c in byte_table():
            for last in {False, bool(suffix)}:
                symbol = names[c + suffix if last else c]
                ends[symbol] = c, last
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, made = names[a], names[b], names[a + b]
            if made in ends or left not in ends or right not in ends:
                raise ValueError(f"{path}: merge {rank} makes a token again or joins tokens that no merge before it makes")
            ends[made] = ends[left][0] + ends[right][0], ends[right][1]
            self.rank[made], self.left[made], self.right[made] = rank, left, right
            self.pair[left * self.width + right] = rank
            if ends[left][1]:
                raise ValueError(f"{path}: merge {rank} goes on after the end of a word")
        for token, (letters, last) in ends.items():
            (self.final if last or not suffix else self.inner)[letters] = token
            if not suffix:
                self.inner[letters] = token
        self.heads = {letters[:i] for letters, _ in ends.values() for i in range(1, len(letters) + 1)}
        self.known: dict[int, bool] = {}
        self.steps: dict[str, tuple] = {}
        self.stops: dict[str, list] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether b can follow a. The merges that made them are undone, the later one first, so that all pairs that
        ever met at the border come by; ``before`` is the time at which the present pair ceased to be."""
        before = len(self.pair) + 1
        while True:
            across = self.pair.get(a * self.width + b)
            if across is not None and across < before:
                return False
            if self.rank[a] > self.rank[b]:
                before, a = self.rank[a], self.right[a]
            elif self.rank[b] >= 0:  # of equal merges the left one goes first, so one across comes before b's own
                before, b = self.rank[b] + 1, self.left[b]
            else:
                return True

    def ending(self, tokens: dict[str, int], letters: str) -> list[tuple[int, int]]:
        """(length, token) of the tokens that end the letters, the longest first."""
        found = ((n, tokens.get(letters[-n:])) for n in range(len(letters), 0, -1))
        return [(n, token) for n, token in found if token is not None]

    def step(self, tail: str) -> tuple[str, list[tuple[int, int]]]:
        """What of the path can begin a token that goes on below: the longest such end of ``tail``; and the tokens that end here."""
        out = next((tail[i:] for i in range(len(tail)) if tail[i:] in self.heads), ""), self.ending(self.inner, tail)
        self.steps[tail] = out
        return out

    def stop(self, tail: str) -> list[tuple[int, int]]:
        """The tokens that end a word here."""
        out = self.stops[tail] = self.ending(self.final, tail)
        return out

    def encode(self, words: Sequence[str]) -> dict[str, list[int]]:
        """The tokens of each distinct word (not empty, spelled by the byte table)."""
        for memory, most in ((self.known, NEIGHBOURS), (self.steps, STEPS), (self.stops, STEPS)):
            if len(memory) > most:
                memory.clear()
        return self.walk(trie(words))

    def walk(self, root: dict) -> dict[str, list[int]]:
        """Depth first: ``last`` and ``size`` hold, for each depth of the path, the token that ends there and its length."""
        out: dict[str, list[int]] = {}
        last, size = [0], [0]
        width, known, fits, steps, stops = self.width, self.known, self.fits, self.steps, self.stops
        todo = [(child, 1, c[0]) for c, child in root.items()]
        while todo:
            node, depth, tail = todo.pop()
            leaf = isinstance(node, str)
            if leaf:
                tokens = stops.get(tail)
                if tokens is None:
                    tokens = self.stop(tail)
            else:
                found = steps.get(tail)
                tail, tokens = self.step(tail) if found is None else found
            for length, token in tokens:
                if length == depth:
                    break
                before = last[depth - length]
                key = before * width + token
                fit = known.get(key)
                if fit is None:
                    fit = known[key] = fits(before, token)
                if fit:
                    break
            else:
                raise ValueError(f"no token ends {tail!r}")
            if depth == len(last):
                last.append(token)
                size.append(length)
            else:
                last[depth], size[depth] = token, length
            if leaf:
                ids = []
                while depth:
                    ids.append(last[depth])
                    depth -= size[depth]
                ids.reverse()
                out[node] = ids
            else:
                depth += 1
                todo += [(child, depth, tail + c[0]) for c, child in node.items()]
        return out


def trie(words: Sequence[str]) -> dict:
    """Nodes by letter; the last letter of a word, marked, leads to a leaf, which is the word."""
    root: dict = {}
    for word in words:
        node = root
        for c in word[:-1]:
            node = node.setdefault(c, {})
        node[word[-1] + "$"] = word
    return root


class TrieCoder:
    """encode_many: the ids of texts, as the library gives them without added special tokens."""

    def __init__(self, path: str):
        self.library, self.merges = tokenizer(path, None), Merges(path)
        added = self.library.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"{path}: added tokens that take in what is around them")
        self.special = {t.content: np.array([i], U4).tobytes() for i, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.runs, self.words = Recent(self.new_runs, most=RUNS), Recent(self.new_words, most=WORDS)

    def words_of(self, runs: list[str]) -> list[list[str]]:
        """The words of each run, from one normal form and one cut of all runs with a blank between."""
        normal = self.library.normalizer.normalize_str(" ".join(runs))
        ends = np.cumsum([len(x) + 1 for x in normal.split(" ")])
        cut = self.library.pre_tokenizer.pre_tokenize_str(normal)
        bounds = np.searchsorted([start for _, (start, _) in cut], ends).tolist()
        pieces = [piece for piece, _ in cut]
        return [pieces[a:b] for a, b in zip([0, *bounds], bounds)]  # the last bound ends the last run

    def new_words(self, words: list[str]) -> list[bytes]:
        """The ids of words, all through one trie."""
        ids = self.merges.encode(words)
        return [array("I", ids[w]).tobytes() for w in words] if LITTLE else [np.array(ids[w], U4).tobytes() for w in words]

    def new_runs(self, runs: list[str]) -> list[bytes]:
        """The ids of runs between blanks."""
        words = [w for i in range(0, len(runs), 1_000) for w in self.words_of(runs[i : i + 1_000])]
        get = self.words.filled(set(chain.from_iterable(words))).__getitem__
        return [b"".join(map(get, own)) for own in words]

    def parts(self, text: str) -> list[str]:
        """Runs between blanks and strings of special tokens, in order."""
        split = RUN.findall if ODD.search(text) else str.split
        if not self.cut or not any(s in text for s in self.special):
            return split(text)
        pieces = self.cut.split(text)
        return [x for i, piece in enumerate(pieces) for x in ([piece] if i % 2 else split(piece))]

    def encode_many(self, texts: Sequence[str]) -> list[bytes]:
        parts = list(map(self.parts, texts))
        known = self.runs.filled(set().union(*parts).difference(self.special))
        get = {**self.special, **known}.__getitem__ if any(s in known or s in t for s in self.special for t in texts) else known.__getitem__
        return [b"".join(map(get, own)) for own in parts]


@lru_cache(maxsize=2)
def coder(path: str) -> TrieCoder:
    """One for each Python worker."""
    return TrieCoder(path)


@lru_cache(maxsize=2)
def spellings(path: str) -> pa.Array:
    """The string of each id, null where there is none."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    if file.get("decoder") is not None:
        raise ValueError(f"{path}: has a decoder of its own")
    names = {i: token for token, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file.get("added_tokens", [])}
    out = [names.get(i) for i in range(max(names, default=-1) + 1)]
    return pa.array(out, pa.string())


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The documents with ``ids`` (array of int) and ``n_tokens``, as the library's encode without added special tokens gives
    them; strings of special tokens inside a text become those tokens. ``path``: a file of the tokenizers library
    with a BPE model. ``keep``: the columns that come along (None: all).

    Defined cases: a null or empty text has no ids; texts of any length are encoded whole; each row is encoded on its own,
    so repeated rows repeat; an empty table gives an empty one; columns named like the new ones, in any case, are replaced.
    """

    def work(own: pa.Array) -> list[pa.Array]:
        ids = coder(path).encode_many([t or "" for t in own.to_pylist()])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = pa.array(np.frombuffer(b"".join(ids), U4).astype(np.int32))
        return [pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(sizes)]

    new = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    return map_column(docs, text, T.StringType(), new, work, keep)


def joined(ids: pa.Array, table: pa.Array) -> pa.Array:
    """The strings of each row's ids with one space between."""
    flat = ids.flatten()
    flat = pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table))), flat, pa.scalar(None, flat.type))
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), table.take(flat))
    if tokens.flatten().null_count:
        return pa.array([" ".join(x for x in row if x is not None) for row in tokens.to_pylist()], pa.string())
    return pc.binary_join(tokens, " ")


def decode(coded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the strings of the ids joined by one space, as the library decodes for a file that names no decoder
    and special tokens aren't skipped. Null or no ids give the empty string; ids without a token give nothing, as in the library.
    A column of that name, in any case, is replaced."""
    rows = T.StructType([f for f in coded.schema.fields if f.name.lower() != "decoded"])
    schema = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(rows)), T.StructField("new", T.StringType())])
    at = rows.names.index(ids)

    def run(batches):
        table = spellings(path)
        for whole in batches:
            for start, length in slices(whole.column(at), 200_000):
                batch = whole.slice(start, length)
                yield pa.RecordBatch.from_arrays([*batch.columns, joined(batch.column(at), table)], names=schema.names)

    out = coded.select(*(F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rows))).mapInArrow(run, schema)
    return out.select(*(F.col(f"c{i}").alias(f.name) for i, f in enumerate(rows)), F.col("new").alias("decoded"))

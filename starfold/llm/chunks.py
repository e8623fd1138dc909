"""Encoding through a cache of chunks.

A chunk is a run of spaces and line feeds with the other characters after it, up to a sign that follows an ASCII
letter or digit. The tokenizers' patterns never match from a non-space into a space, nor from a letter or digit into a
sign, so a text's tokens are those of its chunks, one after another. Words repeat, so most chunks come out of a
dictionary, and the library sees only the new ones. Where the proof doesn't hold - other kinds of white space, the strings
of special tokens - the library gets the whole text. Chunks are cut, told apart and put together as Arrow and numpy arrays.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

#: Controls, white space beyond space and line feed, and invisible formats: such texts go to the library as they are.
ODD = re.compile("[\x00-\x09\x0b-\x1f\x7f-\xa0 ᠎ -‏ -  -⁤　﻿]")
U4 = np.dtype("<u4")
#: By byte: ASCII signs but the apostrophe, which patterns join with letters on both sides.
SIGN = np.isin(np.arange(256), [b for b in b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"])


def cuts(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
    """The chunks of texts in which ODD finds nothing, one text after another, and how many each text has."""
    whole = pa.array(texts, pa.large_string())
    at = np.frombuffer(whole.buffers()[1], np.int64)[: len(texts) + 1]
    raw = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[: at[-1]]
    begins = np.zeros(len(raw) + 1, bool)
    blank = (raw == 0x20) | (raw == 0x0A)
    lower = raw | 0x20
    begins[1:-1] = blank[1:] & ~blank[:-1]
    word = ((lower >= 0x61) & (lower <= 0x7A)) | ((raw >= 0x30) & (raw <= 0x39))
    begins[1:-1] |= SIGN[raw[1:]] & word[:-1]
    begins[at] = True
    ends = np.flatnonzero(begins)  # the end of the last text too
    chunks = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), whole.buffers()[2] or pa.py_buffer(b""))
    return chunks, np.diff(np.searchsorted(ends, at))


def cut(text: str) -> list[str]:
    """The chunks of a text in which ODD finds nothing."""
    return cuts([text])[0].to_pylist()


class Recent:
    """A bounded dictionary in two generations. When the young one is full it becomes the old one; what is asked for again moves
    to the young one, so frequent entries stay and rare ones go, whatever the order of the texts."""

    def __init__(self, make_many: Callable[[list[str]], Sequence], most: int = 250_000):
        self.make_many, self.most = make_many, most
        self.young: dict = {}
        self.old: dict = {}

    def filled(self, keys: set[str]) -> dict:
        """A dictionary that holds all the keys."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old, new = self.young, self.old, []
        for key in keys.difference(young):
            value = old.get(key)
            if value is None:
                new.append(key)
            else:
                young[key] = value
        young.update(zip(new, self.make_many(new), strict=True))
        return young


class ChunkCoder:
    """encode_many: bytes of ids for each string. special: strings that the library looks for in whole texts. sizes: the bytes of
    text that each id stands for, of a library that keeps all bytes; then new chunks are encoded in runs (``in_runs``)."""

    def __init__(self, encode_many: Callable[[Sequence[str]], list[bytes]], special: Sequence[str] = (), at_once: int = 4_000, sizes: np.ndarray | None = None):
        def in_portions(new: list[str]) -> list[bytes]:  # the library's results are far larger than the ids
            return [x for i in range(0, len(new), at_once) for x in (encode_many if sizes is None else self.in_runs)(new[i : i + at_once])]

        self.encode_many, self.special, self.sizes, self.known = encode_many, tuple(special), sizes, Recent(in_portions, most=400_000)

    def in_runs(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk. Those from white space to other characters may follow one another as they do in a text, so they
        are encoded as one string, and its ids are cut where the bytes of a chunk end. If an id crosses such an end, each
        chunk is encoded alone."""
        runs = [i for i, c in enumerate(chunks) if c[:1] in (" ", "\n") and c[-1] not in " \n"]
        joined = "".join([chunks[i] for i in runs])
        if any(s in joined for s in self.special):
            return self.encode_many(chunks)
        ids = self.encode_many([joined])[0]
        reached = np.cumsum(self.sizes[np.frombuffer(ids, U4)])
        ends = np.cumsum(np.fromiter((len(chunks[i].encode()) for i in runs), np.int64, len(runs)))
        last = np.searchsorted(reached, ends)
        if len(ends) and (last[-1] != len(reached) - 1 or (reached[last] != ends).any()):
            return self.encode_many(chunks)
        out: list = [None] * len(chunks)
        begin = 0
        for i, end in zip(runs, (4 * (last + 1)).tolist(), strict=True):
            out[i], begin = ids[begin:end], end
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.encode_many([chunks[i] for i in rest]), strict=True):
            out[i] = x
        return out

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        odd = [bool(ODD.search(t)) or any(s in t for s in self.special) for t in texts]
        plain = iter(self.plain([t for t, o in zip(texts, odd, strict=True) if not o]))
        return [self.encode_many([t])[0] if o else next(plain) for t, o in zip(texts, odd, strict=True)]

    def plain(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of texts of chunks."""
        chunks, counts = cuts(texts)
        coded = chunks.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # far faster than to_pylist
        own = list(map(self.known.filled(set(names)).__getitem__, names))
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        begin = np.cumsum(size) - size
        each = coded.indices.to_numpy()
        width = size[each]
        ends = np.cumsum(width)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.frombuffer(b"".join(own), U4)[np.repeat(begin[each] - (ends - width), width) + np.arange(total)]
        raw = ids.tobytes()
        stops = (4 * np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        return [raw[a:b] for a, b in zip(stops, stops[1:])]

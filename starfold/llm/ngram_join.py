"""N-gram Jaccard join by a MinHash LSH forest, verified exactly.

1. Each text becomes its set of word shingles; equal sets are one class with one representative.
2. Each class gets a signature of minima under random hash functions, cut into trees. A tree is a prefix trie of the
   signatures: two classes match at depth d if their first d minima agree, with probability s ** d at similarity s. Rows with
   equal prefixes are a bucket of the trie, named by a hash, so no trie is sorted. Matching begins at the longest prefix at which the
   trees together reach the target recall at the threshold (``depth_for``): deeper buckets lie within those.
   Texts without a true link there go on level by level with shorter prefixes (steps 3 and 4 again, for pairs with such a text), down
   to the depth of a higher recall.
3. Each bucket hangs on its smallest member (as many rows as members, never pairs), and the components of that graph hold
   all candidates.
4. Components are verified exactly: the texts of one component go to one task, those of a large one to a task for each pair
   of its blocks, where products of the shingle incidence matrix give all intersections. Only sums leave the task: the number of
   links of each text and what hangs together.
5. The components of the true links are the result's classes.

No pairs are emitted, and no group is gathered beyond two blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.components import components
from starfold.llm.tables import loose, stored
from starfold.llm.text import portions, put, strings, whole

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
TREES, DEPTH = 20, 8
#: Texts and shingles in a block of a large component.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 300_000


def depth_for(threshold: float, recall: float, trees: int = TREES, deepest: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in one of the trees with the target probability."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of all words if there are fewer; none without words.
    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z lower-cased."""
    found = WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, len(found))
    run = min(size, len(w))
    h = np.full(len(w) - run + 1, run, np.uint64)
    for i in range(run):
        h = mix(h + w[i : len(w) - run + 1 + i])
    return np.unique(h)


@lru_cache(maxsize=2)
def multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def buckets(hashes: np.ndarray, trees: int, depth: int, shortest: int = DEPTH) -> list[int]:
    """The names of the text's buckets in each tree: hashes of the tree and the first ``depth`` minima, then of one fewer, and
    so on to ``shortest`` (only of ``depth`` if that isn't less)."""
    by = multipliers(trees * depth)
    least = np.full(len(by), 2**64 - 1, np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(least, mix_top(hashes[i : i + 512, None] * by[None, :]).min(axis=0), out=least)
    names = np.arange(1, trees + 1, dtype=np.uint64)
    levels = []
    for level, column in enumerate(least.reshape(trees, depth).T, 1):
        names = mix(names + column)
        if level >= min(shortest, depth):
            levels.insert(0, names)
    return np.concatenate(levels).view(np.int64).tolist()


def mix_top(products: np.ndarray) -> np.ndarray:
    """The upper half of a product depends on all bits of the factor."""
    return products >> np.uint64(32)


def signatures(docs: DataFrame, text: str, doc_id: str, size: int, trees: int, depth: int, shortest: int) -> DataFrame:
    """(doc_id, f1, f2, n, names): 128 bits that name the set of shingles, their number, the buckets in each tree by level."""
    kind = docs.schema[doc_id]
    src = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")).where(F.col("doc_id").isNotNull())
    schema = T.StructType([T.StructField("doc_id", kind.dataType), *(T.StructField(c, T.LongType()) for c in ("f1", "f2", "n")), T.StructField("names", T.ArrayType(T.LongType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in portions(batches, "text"):
            f1, f2, n, names = [], [], [], []
            for body in strings(batch.column("text")):
                s = shingles(body, size)
                a, b = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist()
                f1.append(a)
                f2.append(b)
                n.append(len(s))
                names.append(buckets(s, trees, depth, shortest) if len(s) else [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(n, pa.int64()), pa.array(names, pa.list_(pa.int64()))], names=schema.names)

    return src.mapInArrow(run, schema)


def candidates(reps: DataFrame) -> DataFrame:
    """(u, v): each member of a bucket with a lone text and the bucket's smallest member, by bucket. reps: (rep, names, lone)."""
    members = reps.select("rep", "lone", F.explode("names").alias("name"))
    heads = members.groupBy("name").agg(F.min("rep").alias("head"), F.max("rep").alias("last"), F.max("lone").alias("lone")).where((F.col("head") != F.col("last")) & F.col("lone")).drop("last", "lone")
    members = members.drop("lone")
    return members.join(loose(heads), "name").where(F.col("rep") != F.col("head")).select(F.col("rep").alias("u"), F.col("head").alias("v"))


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets numbered in ``left`` with those in ``right``."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, cell, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[cell] > 1
    owner, cell = owner[shared], np.unique(cell[shared], return_inverse=True)[1]
    out = np.zeros((len(left), len(right)), np.int64)
    order = np.argsort(cell, kind="stable")
    owner, cell = owner[order], cell[order]
    width = 8192
    for first in range(0, int(cell[-1]) + 1 if len(cell) else 0, width):
        a, b = np.searchsorted(cell, [first, first + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[a:b], cell[a:b] - first] = 1
        out += (m[left] @ m[right].T).astype(np.int64)  # counts of up to 8192 are exact
    return out


def verify(texts: list[str], blocks: list[int], nodes: list, copies: list[int], lone: list[bool], size: int, threshold: Fraction) -> list[tuple]:
    """(node, links, root) for the texts with links: how many documents they are linked to, and a text with which they
    hang together. Only pairs with a lone text count: others were compared before. Of two blocks, only pairs across them count here."""
    sets = [shingles(t, size) for t in texts]
    side = np.array(blocks)
    left = np.flatnonzero(side == side.min())
    right = np.flatnonzero(side == side.max())
    n = np.array([len(s) for s in sets], np.int64)
    met = common(sets, left, right)
    # |A & B| / |A | B| >= p / q in whole numbers
    linked = met * (threshold.numerator + threshold.denominator) >= threshold.numerator * (n[left][:, None] + n[right][None, :])
    linked &= met > 0
    alone = np.array(lone, bool)
    linked &= alone[left][:, None] | alone[right][None, :]
    if side.min() == side.max():
        np.fill_diagonal(linked, False)
    weight = np.array(copies, np.int64)
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, left, linked @ weight[right])
    if side.min() != side.max():
        np.add.at(links, right, linked.T @ weight[left])
    root = list(range(len(nodes)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    todo = set(range(len(nodes)))
    at_left, at_right = {x: i for i, x in enumerate(left.tolist())}, {x: i for i, x in enumerate(right.tolist())}
    while todo:  # each text is visited once, and its row of links read once
        stack = [todo.pop()]
        head = stack[0]
        while stack:
            i = stack.pop()
            near = set(right[linked[at_left[i]]].tolist()) if i in at_left else set()
            near |= set(left[linked[:, at_right[i]]].tolist()) if i in at_right else set()
            for j in near & todo:
                todo.discard(j)
                root[j] = head
                stack.append(j)
    return [(node, k, nodes[top(i)]) for i, (node, k) in enumerate(zip(nodes, links.tolist(), strict=True)) if k]


def true_links(docs: DataFrame, members: DataFrame, text: str, doc_id: str, size: int, threshold: Fraction) -> DataFrame:
    """(node, links, root) from members (node, component, block, blocks, copies, lone)."""
    kind = docs.schema[doc_id].dataType
    # by merging at any size: with a broadcast below some size, cost would jump where the members outgrow it
    src = docs.select(F.col(doc_id).alias("node"), whole(text).alias("text")).join(members.hint("merge"), "node")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    src = src.withColumn("other", other).select("node", "text", "block", "copies", "lone", "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    src = src.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "block", "node")
    schema = T.StructType([T.StructField("node", kind), T.StructField("links", T.LongType()), T.StructField("root", kind)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in portions(batches, "text") for r in zip(*(batch.column(c).to_pylist() for c in ("component", "low", "high", "block", "node", "copies", "text", "lone")), strict=True))
        done: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r[:3]):
            own = list({(r[4], r[6]): r for r in group}.values())  # a repeated row is one document
            if own[0][1] != own[0][2] and len({r[3] for r in own}) < 2:
                continue  # a pair of blocks one of which is empty
            if not any(r[7] for r in own):
                continue
            done += verify([r[6] for r in own], [r[3] for r in own], [r[4] for r in own], [r[5] for r in own], [r[7] for r in own], size, threshold)
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=schema.names)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=schema.names)

    return src.mapInArrow(run, schema)


def links_at(docs: DataFrame, reps: DataFrame, nodes: DataFrame, text: str, doc_id: str, size: int, threshold: Fraction) -> DataFrame:
    """(node, links, root), stored: the true links of lone texts by the buckets of one level. reps: (rep, names, lone); nodes:
    (node, copies, n, lone)."""
    held = stored(components(candidates(reps)).join(nodes, "node"), "ngram-nodes")
    sizes = held.groupBy("component").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_TEXTS)).cast("long").alias("blocks"))
    members = held.join(loose(sizes), "component").select("node", "component", "copies", "lone", "blocks", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).alias("block"))
    return stored(true_links(docs, members, text, doc_id, size, threshold), "ngram-links")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, threshold: float = 0.8, recall: float = 0.999, trees: int = TREES, sure: float = 0.9999) -> DataFrame:
    """(doc_id, class_id, rep_id, n_copies, n_links): for each document the smallest doc_id that it hangs together with by
    links of a Jaccard similarity of at least ``threshold``; the smallest doc_id with the same shingles; how many documents have
    the same shingles; and the number of documents that it is linked to, copies included. Texts that find no link at the
    depth for ``recall`` go on with shorter prefixes, down to the depth for ``sure``.

    Defined cases: a text of fewer than ``size`` words is one shingle; a null, empty or wordless text has none, is
    linked to nothing and a class of its own; rows that repeat a doc_id are one document (in one class, the links of its texts
    added); rows without doc_id are left out; a text of any length is taken whole.
    """
    exact = Fraction(threshold).limit_denominator(1000)
    depth = depth_for(threshold, recall, trees)
    shortest = min(depth, depth_for(threshold, sure, trees))
    signed = stored(signatures(docs, text, doc_id, size, trees, depth, shortest), "ngram-signatures")
    full = signed.where(F.col("n") > 0)
    # equal sets have equal names
    same = stored(full.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("n"), F.first("names").alias("names")), "ngram-classes")
    reps = same.select("rep", "names")
    nodes = same.groupBy("rep").agg(F.sum("copies").alias("copies"), F.sum("n").alias("n")).withColumnRenamed("rep", "node")
    links = None
    for level in range(depth, shortest - 1, -1):
        own = reps.withColumn("names", F.slice("names", 1 + trees * (depth - level), trees))
        if links is None:
            links = links_at(docs, own.withColumn("lone", F.lit(True)), nodes.withColumn("lone", F.lit(True)), text, doc_id, size, exact)
            continue
        near = links.select(F.col("node").alias("near")).distinct()
        own = own.join(near, F.col("rep") == F.col("near"), "left").withColumn("lone", F.col("near").isNull())
        here = nodes.join(near, F.col("node") == F.col("near"), "left").select("node", "copies", "n", F.col("near").isNull().alias("lone"))
        links = links.unionByName(links_at(docs, own, here, text, doc_id, size, exact))
    class_of = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = same.select("f1", "f2", "rep", "copies").join(counted, F.col("rep") == counted["node"], "left").drop("node")
    known = known.join(class_of, F.col("rep") == F.col("node"), "left").select("f1", "f2", "rep", "copies", "links", F.coalesce("component", "rep").alias("class_id"))
    out = signed.select("doc_id", "f1", "f2", "n").join(known, ["f1", "f2"], "left")
    alone = F.col("n") == 0
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("rep_id"),
                      F.when(alone, 1).otherwise(F.col("copies")).cast("long").alias("n_copies"), F.when(alone, 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents with the smallest doc_id of their class, with all their columns; rows without doc_id stay."""
    gone = classes(docs, text, doc_id, size, threshold).where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("gone")).distinct()
    src = docs.select(F.struct("*").alias("row"))
    return src.join(gone.hint("merge"), F.col("row")[doc_id] == F.col("gone"), "left_anti").select(*put(docs, "row"))

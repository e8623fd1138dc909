"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

The kernel is the gap-weighted subsequence kernel: two strings are alike as far as they share subsequences of three
characters, each weighted by LAMBDA to the power of the stretch it takes (REACH characters at most). An insult with gaps or
inserted characters keeps most of its subsequences at a smaller weight, and words of one stem share those of the stem.
The stretch is bounded, so the kernel has an explicit, finite feature map (a triple of character classes), which numpy
makes for many words at once.

Training: sentences inherit the label of their document. The witnesses of toxic sentences are the words that
hardly any clean sentence holds, and that too often for chance (likelihood ratio against the number of words tried); with words of clean sentences
they make the training set. Landmarks are drawn from both; the Nyström map turns kernel values against them into
vectors on which a linear support vector machine (squared hinge) is trained. The machine is linear in the features, so
it is stored as one weight for each triple. A text's margin is that of its most toxic word, whole or spelled out with
blanks; a logistic curve fitted to training documents turns it into the score.

What is learned comes from at most ``most_docs`` labelled documents (a documented bound); each text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.chunks import Recent
from starfold.llm.text import portions, put, strings, whole

LAMBDA, REACH = 0.6, 5
#: Pairs of offsets of the second and third character.
OFFSETS = [(i, j) for j in range(2, REACH + 1) for i in range(1, j)]
CLASSES = 64
#: Beginnings of words are tried as witnesses too: few documents show each form of a word, more its stem.
STEM = 5
SENTENCE = re.compile(r"[.!?\n]+(?:\s|$)")
#: The share of a witness's contexts that may be clean.
EXCEPTIONS = 0.05
#: Landmarks, and the bounds of what the driver gets to train on.
LANDMARKS, WITNESSES, CLEAN_WORDS, HARD_WORDS = 256, 2_000, 6_000, 2_000
EDGE = ".,;:!?\"'()[]{}|<>*#$%&-_/\\"
#: Single characters with blanks between them, at least four.
SPACED = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point below 65,536: a-z 1 to 26, the word's edge 27, others by remainder into 28 to 63."""
    table = np.arange(65536) % (CLASSES - 28) + 28
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[ord("^")] = 27
    table[0] = 0
    return table.astype(np.int64)


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature, weight) of all subsequences of three characters within REACH; words begin and end with an edge."""
    pad = "\x00" * REACH
    codes = np.frombuffer(("".join(f"^{w}^{pad}" for w in words)).encode("utf-32-le", "replace"), "<u4")
    c = classes()[np.minimum(codes, 65535)]
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 + REACH for w in words])
    found = []
    for i, j in OFFSETS:
        a, b, d = c[: -REACH], c[i : len(c) - REACH + i], c[j : len(c) - REACH + j]
        at = np.flatnonzero((a > 0) & (b > 0) & (d > 0))  # the padding is as long as the reach: never two words
        found.append((owner[at], (a[at] * CLASSES + b[at]) * CLASSES + d[at], np.full(len(at), LAMBDA ** (j + 1), np.float32)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def norms(words: int, owner: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A norm of each word by its subsequences (any positive function of a word keeps a kernel a kernel)."""
    return np.sqrt(np.maximum(np.bincount(owner, weight.astype(np.float64) ** 2, minlength=words), 1e-9))


def margins(words: list[str], weights: np.ndarray, bias: float) -> list[float]:
    """The machine's value for each word."""
    if not words:
        return []
    owner, feature, weight = triples(words)
    return (np.bincount(owner, weight * weights[feature], minlength=len(words)) / norms(len(words), owner, weight) + bias).tolist()


def spelled(text: str) -> list[str]:
    """The lower-cased words between blanks without signs at their edges, and what is spelled out with blanks."""
    low = text.lower()
    out = [w.strip(EDGE) if w[-1] in EDGE or w[0] in EDGE else w for w in low.split()]
    if SPACED.search(low):
        out += [m.replace(" ", "") for m in SPACED.findall(low)]
    return out


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Values between words, in portions of the dense feature vectors of ``right``."""
    width = CLASSES**3
    o, f, w = triples(right)
    dense = np.zeros((len(right), width), np.float32)
    np.add.at(dense, (o, f), w)
    dense /= norms(len(right), o, w)[:, None].astype(np.float32)
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(left), 256):
        part = left[at : at + 256]
        o, f, w = triples(part)
        used, f = np.unique(f, return_inverse=True)
        rows = np.zeros((len(part), len(used)), np.float32)
        np.add.at(rows, (o, f), w)
        out[at : at + 256] = rows @ dense[:, used].T / norms(len(part), o, w)[:, None]
    return out


def train_machine(toxic: list[str], clean: list[str], rounds: int = 300, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weight of each triple, bias) of a linear machine on the Nyström vectors of the words."""
    half = min(len(toxic), LANDMARKS // 2)
    marks = toxic[:half] + clean[: LANDMARKS - half]
    k = kernel(marks, marks).astype(np.float64)
    value, vector = np.linalg.eigh((k + k.T) / 2)
    good = value > 1e-4 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    x = kernel(toxic + clean, marks) @ root
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    share = np.where(y > 0, 0.5 / len(toxic), 0.5 / len(clean))
    # squared hinge by Newton steps: each is a weighted least-squares fit of the words inside the margin
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(rounds):
        near = y * (x @ w) < 1
        own = x[near] * share[near][:, None]
        new = np.linalg.solve(own.T @ x[near] + ridge, own.T @ y[near])
        if np.abs(new - w).max() < 1e-7:
            break
        w = 0.5 * (w + new) if _ > 20 else new
    beta = root @ w[:-1]
    o, f, v = triples(marks)
    weights = np.zeros(CLASSES**3)
    np.add.at(weights, f, v * (beta / norms(len(marks), o, v))[o])
    return weights, float(w[-1])


def curve(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the logistic curve through the margins, by Newton steps with smoothed targets."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (target - p) - 1e-6 * w)
        w = w + np.clip(step, -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


class Model:
    """weights, bias: the machine; slope, offset: the curve; floor: the margin of a text without words."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0, floor: float = -1.0):
        self.weights, self.bias, self.slope, self.offset, self.floor = weights, bias, slope, offset, floor


#: One for each Python worker and model: margins of words seen lately.
_RECENT: dict[bytes, Recent] = {}


def recent(weights: np.ndarray, bias: float) -> Recent:
    key = hash((weights.tobytes(), bias)).to_bytes(8, "little", signed=True)
    if key not in _RECENT:
        _RECENT.clear()
        _RECENT[key] = Recent(lambda new: margins(new, weights, bias))
    return _RECENT[key]


def text_margins(texts: list[str], known: Recent, floor: float) -> list[float]:
    """The margin of the most toxic word of each text."""
    parts = [set(spelled(t)) for t in texts]
    get = known.filled(set().union(*parts)).__getitem__ if parts else None
    return [max(map(get, p), default=floor) for p in parts]


def margin_frame(docs: DataFrame, model: Model, single: bool = False) -> DataFrame:
    """docs has _text and other columns: the others, and margin. single: each text is taken as one word."""
    rest = [f for f in docs.schema.fields if f.name != "_text"]
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.floor))  # a megabyte

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, floor = held.value
        known = recent(weights, bias)
        for batch in portions(batches, "_text"):
            texts = strings(batch.column("_text"))
            out = pa.array(margins(texts, weights, bias) if single else text_margins(texts, known, floor), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), out], names=[*(f.name for f in rest), "margin"])

    return docs.mapInArrow(run, T.StructType([*rest, T.StructField("margin", T.DoubleType())]))


def contexts(train: DataFrame) -> DataFrame:
    """(word, beside, toxic): each word of the labelled sentences in each context, a hash of the words before and after, once;
    one that a clean sentence holds as well is clean. So what copies and near copies repeat doesn't count again.
    train: (text, toxic)."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("beside", T.LongType()), T.StructField("toxic", T.IntegerType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in portions(batches, "text"):
            found: dict[tuple[str, str, str], int] = {}
            for text, toxic in zip(strings(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                for sentence in SENTENCE.split(text):
                    words = ["", *spelled(sentence), ""]
                    for unit in zip(words[1:-1], words, words[2:], strict=False):
                        found[unit] = min(found.get(unit, 1), toxic)
            found = {u: t for u, t in found.items() if u[0]}
            beside = [xxhash.xxh3_64_intdigest(f"{a} {b}") - 2**63 for _, a, b in found]
            yield pa.RecordBatch.from_arrays([pa.array([u[0] for u in found], pa.string()), pa.array(beside, pa.int64()), pa.array(list(found.values()), pa.int32())], names=schema.names)

    return train.mapInArrow(run, schema).groupBy("word", "beside").agg(F.min("toxic").alias("toxic"))


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, n1, n0): toxic and clean contexts of each word, and of the words of each beginning of STEM characters."""
    own = labelled.groupBy("word").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
    stems = own.where(F.char_length("word") > STEM).select(F.substring("word", 1, STEM).alias("word"), "n1", "n0")
    return own.union(stems).groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def hardest(clean: DataFrame, weights: np.ndarray, bias: float) -> list[str]:
    """The clean words that the machine takes for the most toxic."""
    ranked = margin_frame(clean.select(F.col("word").alias("_text"), "word"), Model(weights, bias), single=True)
    return [r["word"] for r in ranked.orderBy(F.desc("margin"), "word").limit(HARD_WORDS).collect()]


def fit(labelled: DataFrame, most_docs: int = 12_000) -> Model:
    """labelled: (doc_id, text, toxic). About ``most_docs`` documents are taken, hardly ever more: all of them, or
    beyond the bound those whose hash of doc_id falls below the share that the bound is of their number. Without both labels, or
    without any word that tells them apart, all texts get the same score: the smoothed share of toxic documents."""
    known = labelled.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    n = known.count()
    share = 1.0 if n <= most_docs else (most_docs - 4 * most_docs**0.5) / n
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    train = drawn.select(whole("text").alias("text"), F.col("toxic").cast("int").alias("toxic")).persist()
    totals = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    share = (n1 + 1) / (n1 + n0 + 2)
    none = Model(np.zeros(CLASSES**3), 0.0, 1.0, log(share / (1 - share)), 0.0)
    if not n1 or not n0:
        train.unpersist()
        return none
    counts = word_counts(contexts(train)).coalesce(8).persist()  # words of most_docs documents; each task sends its best to the driver
    totals = counts.where(F.char_length("word") != STEM).agg(F.count("*").alias("words"), F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    tried = max(1, totals["words"])
    prior = min(0.9, max(0.01, (totals["n1"] or 0) / max(1, (totals["n1"] or 0) + (totals["n0"] or 0))))
    n = F.col("n1") + F.col("n0")
    gain = F.col("n1") * F.log(F.col("n1") / (n * prior)) + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (n * (1 - prior)))).otherwise(0.0)
    toxic = counts.where((F.col("n1") > 0) & (F.col("n0") <= EXCEPTIONS * n)).withColumn("gain", gain).where(F.col("gain") > log(tried / 0.05)).orderBy(F.desc("gain"), "word").limit(WITNESSES).collect()
    clean_words = counts.where(F.col("n0") > 0).where(F.col("n1") <= 2 * n * prior)
    part = min(1.0, CLEAN_WORDS / max(1, clean_words.count()))
    drawn = clean_words.select("word", F.xxhash64("word").alias("h")).where(F.pmod("h", F.lit(1 << 40)) < int(part * (1 << 40))).collect()
    clean = [r["word"] for r in sorted(drawn, key=lambda r: r["h"])]  # about CLEAN_WORDS
    if not toxic or not clean:
        counts.unpersist()
        train.unpersist()
        return none
    toxic = [r["word"] for r in toxic]
    hard = hardest(clean_words, *train_machine(toxic, clean))
    model = Model(*train_machine(toxic, clean + [w for w in hard if w not in set(clean)]))
    counts.unpersist()
    rows = margin_frame(train.select(F.col("text").alias("_text"), "toxic"), model).select("margin", "toxic").collect()  # most_docs pairs of numbers
    train.unpersist()
    margin, label = np.array([r["margin"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    model.slope, model.offset = curve(margin, label)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with score (0 to 1, higher: likelier toxic) and predicted (1 if score >= 0.5, else 0).

    Only the text is read. Defined cases: a null or empty text, or one without words, gets the score of the margin ``floor``;
    texts are scored whole; repeated rows get the same score; columns named like the new ones are replaced.
    """
    src = docs.select(F.struct("*").alias("row")).select(*put(docs, "row", _text=whole(F.col("row")[text])))
    src = src.drop("margin", "score", "predicted")
    value = 1 / (1 + F.exp(-(F.col("margin") * model.slope + model.offset)))
    return margin_frame(src, model).withColumn("score", value).drop("margin").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

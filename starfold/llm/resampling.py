"""Target-distribution importance resampling, ranked by parallel sorting by regular sampling.

1. The features of a text are its words and its pairs of neighbouring words, hashed into buckets. The buckets' counts in the corpus
   and in the target texts give each bucket a gain (a log ratio in thousandths), an array of fixed length.
2. A text's weight is the mean gain of its features; with a Gumbel number drawn from its id it is a score, and the texts with
   the highest scores are a draw without replacement in proportion to the weights.
3. The scores are sorted in parallel: every task sorts its rows into a run and stores it. Rows at regular positions of each run
   are the sample; its regular places are the splitters. The counts of each segment between splitters, added up, tell which segments hold
   drawn rows at all, and only these are exchanged: all rows of a segment meet, are merged in order, and a row's rank
   is the number of rows in the segments before plus its place in its own.

Rows that tie on score and id are told apart by their place in the stored runs, so no segment grows with ties.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.carry import map_column, slices
from starfold.llm.tables import stored

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BUCKETS = 10_000
#: Rows of the sample that reach the driver, at most (24 bytes each).
SAMPLE = 1_000_000


def feature_codes(text: bytes | None) -> tuple[int, list[int]]:
    """The number of words, and the crc32 of each word and of each two neighbouring words with one space between."""
    words = WORD.findall(text.lower()) if text else []
    codes = list(map(crc32, words))
    return len(words), codes + list(map(crc32, [b" " + w for w in words[1:]], codes))


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any. A task sends one row for each of its buckets."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for start, length in slices(batch.column(0), 1_000_000):
                codes: list[int] = []
                for body in batch.column(0).slice(start, length).to_pylist():
                    codes += feature_codes(body)[1]
                total += np.bincount(np.array(codes, np.uint32) % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=schema.names)

    src = docs.select(F.col(f"`{text}`").cast("binary").alias("text")).where(F.octet_length("text") > 0)
    return src.mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) for each bucket; an array of ``buckets`` numbers."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for into, frame, column in ((s, docs, text), (t, target, target_text)):
        for row in bucket_counts(frame, column, buckets).collect():  # at most ``buckets`` rows
            into[row["bucket"]] = row["n"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The documents with n_words, n_features and weight, the floored mean gain of their features (0 without any)."""

    def work(own: pa.Array) -> list[pa.Array]:
        n_words, n, weight = [], [], []
        for body in own.to_pylist():
            k, codes = feature_codes(body)
            n_words.append(k)
            n.append(len(codes))
            weight.append(int(gain[np.array(codes, np.uint32) % np.uint32(len(gain))].sum()) // len(codes) if codes else 0)
        return [pa.array(x, pa.int64()) for x in (n_words, n, weight)]

    return map_column(docs, text, T.BinaryType(), [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")], work, keep)


def noise(doc_id: Column, seed: int) -> Column:
    """A Gumbel number in thousandths, drawn from the id by the seed; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def sorted_runs(scored: DataFrame, doc_id: str) -> DataFrame:
    """``scored`` (with score and ``able``) stored as one sorted run for each task, rows that can be drawn first, with ``run`` and ``place``."""
    runs = scored.sortWithinPartitions(F.col("able").desc(), F.col("score").desc(), F.col(f"`{doc_id}`").asc_nulls_last())
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stored(runs.withColumn("run", F.spark_partition_id()).withColumn("place", place), "resampling-runs")


#: The order of the draw; the last key puts a splitter before the row that it was.
KEYS = [("score", "descending"), ("doc_id", "ascending"), ("run", "ascending"), ("place", "ascending"), ("row", "ascending")]


def splitters(able: DataFrame, most: int = SAMPLE) -> tuple[pa.Table, int]:
    """The first row (score, doc_id, run, place) of each segment but the first, and the number of rows. able: those columns.

    Of r runs each gives up to p regular rows, and p - 1 of these r p rows are splitters, so a segment holds no more than
    about two p-th parts of all rows. p is r as long as r p is within ``most``.
    """
    sizes = able.groupBy("run").agg(F.count("*").alias("size"))
    n, r = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    p = max(1, min(r, most // max(r, 1)))
    step = F.ceil(F.col("size") / p).cast("long")
    sample = able.join(F.broadcast(sizes), "run").where(F.col("place") % step == 0)  # sizes: a row for each run
    sample = sample.select("score", "doc_id", "run", "place", step.alias("stands")).toArrow()
    sample = sample.take(pc.sort_indices(sample, sort_keys=KEYS[:-1], null_placement="at_end"))
    before = np.concatenate([[0], np.cumsum(sample["stands"].to_numpy())])[:-1]
    chosen = sorted({int(x) for x in np.searchsorted(before, [n * j / p for j in range(1, p)])} - {0, len(before)})
    return sample.select(["score", "doc_id", "run", "place"]).take(pa.array(chosen, pa.int64())), n


def segments(able: DataFrame, cuts: pa.Table) -> DataFrame:
    """The rows with ``segment``: how many splitters come before them."""
    schema = T.StructType([*able.schema.fields, T.StructField("segment", T.IntegerType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.table([*(batch.column(c).cast(cuts.schema.field(c).type) for c in cuts.column_names), pa.array(np.ones(batch.num_rows, np.int8))], names=[*cuts.column_names, "row"])
            both = pa.concat_tables([cuts.append_column("row", pa.array(np.zeros(len(cuts), np.int8))), own])
            by = pc.sort_indices(both, sort_keys=KEYS, null_placement="at_end").to_numpy()
            segment = np.empty(len(by), np.int32)
            segment[by] = np.cumsum(by < len(cuts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment[len(cuts) :])], names=schema.names)

    return able.mapInArrow(run, schema)


def ranked(scored: DataFrame, share: int, doc_id: str = "doc_id", most: int = SAMPLE) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the floor(share n / 100) highest scores of its n rows with ``able``, null for all others."""
    columns = [c for c in scored.columns if c.lower() != "rank"]
    runs = sorted_runs(scored.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("carried"), F.col(f"`{doc_id}`").alias("doc_id"), "score", "able"), "doc_id")
    cuts, n = splitters(runs.where("able").select("score", "doc_id", "run", "place"), most)
    drawn = n * share // 100
    placed = stored(segments(runs.where("able"), cuts), "resampling-segments")
    sizes = sorted((r["segment"], r["n"]) for r in placed.groupBy("segment").agg(F.count("*").alias("n")).collect())  # a row for each segment
    starts = dict(zip([k for k, _ in sizes], np.cumsum([0, *(m for _, m in sizes)]).tolist()))
    met = scored.sparkSession.createDataFrame([(k, b) for k, b in starts.items() if b < drawn], "segment int, start long")
    ahead = Window.partitionBy("segment").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "run", "place")
    rank = F.col("start") + F.row_number().over(ahead)
    exchanged = placed.join(F.broadcast(met), "segment").select("carried", rank.alias("rank"))
    out = exchanged.select("carried", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank"))
    none = F.lit(None).cast("long").alias("rank")
    out = out.unionAll(placed.join(F.broadcast(met), "segment", "left_anti").select("carried", none)).unionAll(runs.where(~F.col("able")).select("carried", none))
    return out.select(*(F.col("carried")[c].alias(c) for c in columns), "rank")


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", share: int = 25,
             least_words: int = 20, seed: int = 7, buckets: int = BUCKETS, keep: list[str] | None = None) -> DataFrame:
    """The documents with n_words, n_features, weight, score and rank: of the n documents with at least ``least_words`` words, the
    floor(share n / 100) highest scores are drawn and have ranks; the others' rank is null.

    Defined cases: a null or empty text has no words, no features and weight 0, and is never drawn unless ``least_words`` is 0;
    a null id counts as an empty string for the noise and comes last in ties; rows that repeat an id are documents of their
    own with the same noise, their order in a tie by their place in the stored runs; empty tables (either) are counts of 0;
    columns named like the new ones, in any case, are replaced, but the id and the text. ``keep``: the columns that come along.
    """
    weighed = weigh(docs, gains(docs, target, text, target_text, buckets), text, keep)
    score = (F.col("weight") + noise(F.col(f"`{doc_id}`"), seed)).alias("score")
    own = [F.col(f"`{c}`") for c in weighed.columns if c.lower() not in ("score", "able", "rank")]
    out = ranked(weighed.select(*own, score, (F.col("n_words") >= least_words).alias("able")), share, doc_id)
    return out.drop("able")

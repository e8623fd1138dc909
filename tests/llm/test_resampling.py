"""Importance resampling against plain Python over whole tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from starfold.llm import resampling
from starfold.llm.queries import op12_importance_resampling

SF001 = "/root/testdata/sf0.001"


def codes(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return words, [zlib.crc32(x) % 10_000 for x in words + [a + b" " + b for a, b in zip(words, words[1:])]]


def brute(docs, target, share=25, least=20):
    s, t = Counter(), Counter()
    for counter, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            counter.update(codes(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        words, own = codes(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: len(able) * share // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def tuples(frame, columns=("doc_id", "n_features", "weight", "score", "rank")):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=key)


def test_query_on_whole_table(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("text").collect()]
    assert tuples(op12_importance_resampling(spark, SF001)) == sorted(brute(docs, target), key=key)


def test_odd_rows(spark):
    words = "alpha beta gamma Über delta".split()
    docs = [(i, " ".join(words[(i * j) % 5] for j in range(1, i % 40))) for i in range(300)]
    docs += [(None, "one two three " * 9), (7, None), (8, ""), (9, "x"), (10, "long words " * 40_000)]
    frame = spark.createDataFrame([(a, b, "kept", 5) for a, b in docs], "doc_id long, text string, RANK string, weight long").repartition(5)
    target = spark.createDataFrame([("alpha beta",), (None,)], "text string")
    out = resampling.resample(frame, target)
    assert tuples(out) == sorted(brute(docs, ["alpha beta", None]), key=key)
    assert [c for c in out.columns if c.lower() in ("rank", "weight")] == ["weight", "rank"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 30), (2, "b " * 30), (3, "c " * 30), (4, "d " * 30)], none.schema)
    assert resampling.resample(none, none).count() == 0
    assert tuples(resampling.resample(some, none)) == sorted(brute([tuple(r) for r in some.collect()], []), key=key)


def test_ranks_with_ties_and_repeated_rows(spark):
    """Most rows tie on score and id: segments stay even, ranks stay whole."""
    frame = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit(50)).otherwise(F.col("id") % 97).cast("long").alias("score"), (F.col("id") % 7 > 0).alias("able")).repartition(16)
    out = resampling.ranked(frame, 60).collect()
    able = sorted((-r["score"], r["doc_id"]) for r in out if r["able"])
    drawn = sorted((r["rank"], -r["score"], r["doc_id"]) for r in out if r["rank"] is not None)
    assert len(out) == 20_000 and [d[0] for d in drawn] == list(range(1, len(able) * 60 // 100 + 1))
    assert [d[1:] for d in drawn] == able[: len(drawn)]
    runs = resampling.sorted_runs(frame, "doc_id").where("able").select("score", "doc_id", "run", "place")
    cuts, n = resampling.splitters(runs)
    sizes = [r["count"] for r in resampling.segments(runs, cuts).groupBy("segment").count().collect()]
    assert sum(sizes) == n and len(sizes) >= 14 and max(sizes) <= 2.2 * n / 16
    few, _ = resampling.splitters(runs, most=64)
    assert 1 <= len(few) <= 3

"""Benchmark decontamination by a distributed positional inverted index.

1. The windows of the test items (``size`` words; a shorter item is one window) and their vocabulary.
2. How often each of those terms stands in the training texts; so each window knows its rarest terms.
3. The index: the postings (term, text, position) of the windows' two rarest terms, stored in the shared folder. Postings
   of other terms would never be read.
4. Lists are intersected with their offsets adjusted, the rarest term first: a posting of it proposes where the window
   would begin, and the second rarest has to stand at its own offset from there, exactly or, for proximity, up to ``slop`` words
   away. Few proposals are left.
5. The words of the text at the proposed place are compared with the window, each at its place or, for proximity, near it.

Texts are named by 128 bits of hash, so equal texts share their postings and no copy is worked on twice. Small tables
(vocabulary, windows) are written first and read back, so Spark knows their size and broadcasts them only below its own
limit (``spark.sql.autoBroadcastJoinThreshold``); beyond it the same joins shuffle. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.tables import loose, stored
from starfold.llm.text import hash_pair, put, whole, words


def windows_of(items: DataFrame, text: str = "text", item_id: str = "item_id", size: int = 10) -> DataFrame:
    """(wid, win, item_id): the windows of each item, their words, and a name for equal windows."""
    own = items.select(F.col(item_id).alias("item_id"), words(text).alias("w")).where(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1))))
    wins = own.select("item_id", "w", at.alias("i")).select("item_id", F.slice("w", F.col("i"), size).alias("win"))
    return wins.select(F.struct(*(h.alias(n) for h, n in zip(hash_pair(F.col("win")), ("a", "b"), strict=True))).alias("wid"), "win", "item_id").distinct()


def text_key() -> list:
    """k1, k2: what names a text in the index."""
    return [h.alias(n) for h, n in zip(hash_pair(F.col("t")), ("k1", "k2"), strict=True)]


def term_counts(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): occurrences in the texts of the terms of the vocabulary that occur at all."""
    return texts.select(F.explode(words("t")).alias("word")).select(F.xxhash64("word").alias("term")).join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("n"))


def with_rarest(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """The windows all of whose terms occur, with (a, a_at) and (b, b_at): the two rarest terms and their offsets;
    b is null in a window of one word."""
    terms = wins.select("wid", "win", F.posexplode("win").alias("at", "word")).select("wid", "win", "at", F.xxhash64("word").alias("term"))
    found = terms.join(counts, "term").groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("n", "term", "at"))).alias("by"), F.first("win").alias("win"))
    found = found.where(F.size("by") == F.size("win"))
    a, b = F.get("by", F.lit(0)), F.get("by", F.lit(1))
    return found.select("wid", "win", a["term"].alias("a"), a["at"].alias("a_at"), b["term"].alias("b"), b["at"].alias("b_at"))


def postings(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: (term, k1, k2, pos) for the given terms, equal texts once."""
    own = texts.select(*text_key(), F.posexplode(words("t")).alias("pos", "word")).select("k1", "k2", "pos", F.xxhash64("word").alias("term"))
    return own.join(terms, "term").select("term", "k1", "k2", "pos").distinct()


def intersect(index: DataFrame, wins: DataFrame, slop: int = 0) -> DataFrame:
    """(k1, k2, start, wid, win): places where the two rarest terms of a window stand as in the window; the second
    up to ``slop`` words off."""
    first = index.join(wins, index["term"] == wins["a"]).select("k1", "k2", (F.col("pos") - F.col("a_at")).alias("start"), "wid", "win", "b", "b_at")
    single = first.where(F.col("b").isNull()).select("k1", "k2", "start", "wid", "win")
    due = F.col("start") + F.col("b_at")
    more = first.where(F.col("b").isNotNull())
    more = more.withColumn("pos", F.explode(F.sequence(due - slop, due + slop)) if slop else due)
    both = more.join(index.withColumnRenamed("term", "b"), ["k1", "k2", "b", "pos"]).select("k1", "k2", "start", "wid", "win")
    found = both.unionByName(single)
    return found.distinct() if slop else found.where(F.col("start") >= 0)


class Index:
    """The stored index of training texts for the windows of test items."""

    def __init__(self, docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", size: int = 10):
        self.texts = docs.select(whole(text).alias("t"))
        self.held = stored(windows_of(items, item_text, item_id, size), "decontam-items")
        wins = self.held.groupBy("wid").agg(F.first("win").alias("win"))
        vocabulary = stored(wins.select(F.explode("win").alias("word")).select(F.xxhash64("word").alias("term")).distinct(), "decontam-terms")
        self.windows = stored(with_rarest(wins, term_counts(self.texts, vocabulary)), "decontam-windows")
        terms = self.windows.select(F.explode(F.array("a", "b")).alias("term")).where(F.col("term").isNotNull()).distinct()
        self.index = stored(postings(self.texts, stored(terms, "decontam-rarest")), "decontam-postings")

    def near(self, slop: int) -> DataFrame:
        """Proximity matches (k1, k2, start, wid): places of the rarest term of a window (``start``, where the window would begin)
        with each other word of the window up to ``slop`` words off its own place. The two rarest terms propose, and all words
        are compared with the text."""
        proposed = stored(intersect(self.index, self.windows, slop).join(self.windows.select("wid", "a_at"), "wid"), "decontam-near")
        by_text = proposed.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "wid", "win", "a_at")).alias("places"))
        texts = self.texts.select(*text_key(), "t").join(loose(by_text), ["k1", "k2"]).select("k1", "k2", words("t").alias("w"), "places")

        def stands(p):
            def word_near(word, i):
                due, off = p["start"] + i, F.when(i == p["a_at"], 0).otherwise(slop)
                first = F.greatest(due - off, F.lit(0))
                return F.array_contains(F.slice(F.col("w"), first + 1, F.greatest(due + off + 1 - first, F.lit(0))), word)

            return F.forall(F.transform(p["win"], word_near), lambda x: x)

        kept = stored(texts.select("k1", "k2", F.filter("places", stands).alias("places")), "decontam-near-true")
        return kept.select("k1", "k2", F.explode("places").alias("p")).select("k1", "k2", "p.start", "p.wid").distinct()

    def phrases(self) -> DataFrame:
        """Exact matches by text: (k1, k2, n_hit, items): words inside any window, and the items with such windows."""
        proposed = stored(intersect(self.index, self.windows), "decontam-proposed")
        by_text = proposed.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "wid", "win")).alias("places"))
        texts = self.texts.select(*text_key(), "t").join(loose(by_text), ["k1", "k2"])
        texts = texts.select("k1", "k2", words("t").alias("w"), "places").select("k1", "k2", "w", "places", F.size("w").alias("n"))
        ok = F.filter("places", lambda p: F.slice(F.col("w"), p["start"] + 1, F.size(p["win"])) == p["win"])
        true = texts.select("k1", "k2", ok.alias("places"))
        inside = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["start"], p["start"] + F.size(p["win"]) - 1))))
        # equal texts give equal rows
        true = true.select("k1", "k2", F.size(inside).cast("long").alias("n_hit"), F.array_distinct("places.wid").alias("wids")).groupBy("k1", "k2").agg(F.max("n_hit").alias("n_hit"), F.first("wids").alias("wids"))
        true = stored(true, "decontam-true").where(F.col("n_hit") > 0)  # a filter above would split the text anew for each place
        named = true.select("k1", "k2", F.explode("wids").alias("wid")).join(self.held.select("wid", "item_id"), "wid").groupBy("k1", "k2").agg(F.collect_set("item_id").alias("items"))
        return true.select("k1", "k2", "n_hit").join(named, ["k1", "k2"], "left")


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", size: int = 10) -> DataFrame:
    """The documents with n_words, n_hit (words inside an occurrence of a window), items (ids of the items with occurring
    windows, an array), n_items and contaminated (n_hit > 0).

    A-Z are lower-cased, words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+, a window is ``size`` consecutive words of an item, all
    of them if it has fewer. Defined cases: a null text has no words; an item without words has no window; rows that
    repeat an item_id are one item; an item without id marks hits, but isn't listed or counted; an empty table on
    either side marks nothing; repeated documents are marked alike; columns named like the new ones are replaced.
    """
    hits = Index(docs, items, text, item_text, item_id, size).phrases()
    src = docs.select(F.struct("*").alias("row")).select("row", whole(F.col("row")[text]).alias("t")).select("row", *text_key(), F.size(words("t")).cast("long").alias("n"))
    out = src.join(loose(hits), ["k1", "k2"], "left")
    none = F.array().cast(f"array<{items.schema[item_id].dataType.simpleString()}>")
    n_hit, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", none)
    return out.select(*put(docs, "row", n_words=F.col("n"), n_hit=n_hit, items=ids, n_items=F.size(ids).cast("long"), contaminated=n_hit > 0))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", size: int = 10) -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    hits = Index(docs, items, text, item_text, item_id, size).phrases().select("k1", "k2")
    src = docs.select(F.struct("*").alias("row")).select("row", *hash_pair(whole(F.col("row")[text])))
    src = src.toDF("row", "left_1", "left_2")
    return src.join(hits, (F.col("left_1") == F.col("k1")) & (F.col("left_2") == F.col("k2")), "left_anti").select(*put(docs, "row"))

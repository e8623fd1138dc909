"""Line dedup: lines that many documents hold are dropped from all but one of them.

The lines of each text are exploded with their positions, normalised and hashed; distinct documents are counted
per hash; the lines over the threshold go, and the text is reassembled by position.

Plan: the counts are two partial aggregates (hash and document, then hash), so a line that a third of all
documents hold never meets in one task. Its occurrences are found by a join with the few hashes over the threshold,
salted by the document and split further by adaptive execution where a hash is hot.
Only positions travel to the documents, no line text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.tables import loose
from starfold.llm.text import BLANKS, ascii_lower, hash_pair, put, whole

#: Places in which the documents of one line are joined.
SALTS = 16


def dropped_positions(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(d, k, drop): by doc_id and hash of the text, the positions of the lines to drop."""
    body = whole(text)
    lines = docs.select(F.col(doc_id).alias("d"), F.xxhash64(body).alias("k"), F.posexplode(F.split(body, "\n")).alias("pos", "line"))
    bare = F.btrim(F.col("line"), F.lit(BLANKS))
    h1, h2 = hash_pair(ascii_lower(F.col("bare")))
    keyed = lines.select("d", "k", "pos", bare.alias("bare")).where(F.char_length("bare") >= min_chars).select("d", "k", "pos", h1.alias("h1"), h2.alias("h2"))
    held = keyed.where(F.col("d").isNotNull()).select("h1", "h2", "d").distinct()
    common = held.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("d").alias("keeper")).where(F.col("n") >= min_docs)
    # a line that a third of all documents hold is joined in SALTS places
    common = common.select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keyed = keyed.withColumn("salt", F.pmod("k", F.lit(SALTS)).cast("int"))
    hits = keyed.join(common, ["h1", "h2", "salt"]).where(F.col("d").isNull() | (F.col("d") != F.col("keeper")))
    return hits.groupBy("d", "k").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with ``text`` reduced to the lines that stay, and n_lines (before) and n_dropped.

    A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends with A-Z lower-cased. A key of at least
    ``min_chars`` code points in at least ``min_docs`` documents loses all its lines except in the document with the
    largest id that holds it.

    Defined cases: a null or empty text is one empty line (the result is the empty string); a text that loses all
    lines becomes empty; rows that repeat a doc_id are one document for the count, and each is reassembled on its
    own; a row without doc_id isn't counted and never the one that keeps a line. An empty table gives an empty one.
    Input columns named n_lines or n_dropped are replaced.
    """
    drops = dropped_positions(docs, text, doc_id, min_chars, min_docs)
    src = docs.select(F.struct("*").alias("row"))
    src = src.select("row", F.col("row")[doc_id].alias("left_d"), F.xxhash64(whole(F.col("row")[text])).alias("left_k"))
    found = src.join(loose(drops), F.col("left_d").eqNullSafe(F.col("d")) & (F.col("left_k") == F.col("k")), "left")
    found = found.select("row", "drop", F.split(whole(F.col("row")[text]), "\n").alias("lines")).select("row", "drop", "lines", F.size("lines").alias("n"))
    rest = F.array_except(F.sequence(F.lit(0), F.col("n") - 1), F.col("drop"))
    kept = F.when(F.col("drop").isNull(), whole(F.col("row")[text])).otherwise(F.array_join(F.transform(rest, lambda i: F.col("lines")[i]), "\n"))
    return found.select(*put(docs, "row", **{text: kept, "n_lines": F.col("n").cast("long"), "n_dropped": F.coalesce(F.size("drop"), F.lit(0)).cast("long")}))

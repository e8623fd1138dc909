"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. ``run`` does that for the documents of a folder.

1. quality_rules: what the rules reject goes.
2. line_dedup: lines in at least five documents stay only in the one with the largest id; n_chars follows the text.
3. ngram_join: of each class of near copies (five words, Jaccard 0.8) the document with the smallest id stays.
4. decontamination: documents with a window of a benchmark item go.
5. byte_bpe: the texts as token ids, decoded again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import bpe
from starfold.llm.decontam import drop_contaminated
from starfold.llm.line_dedup import dedup_lines
from starfold.llm.ngram_join import drop_near_duplicates
from starfold.llm.quality import quality_filter
from starfold.llm.tables import stored
from starfold.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, size=5, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit integers) and the digest of the decoded text."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs, *vocabulary).select("doc_id", "lang", "source", "n_tokens", "ids")
    out = bpe.decode(coded, *vocabulary)
    return out.withColumn("decoded_sha256", F.sha2(F.col("decoded"), 256)).drop("decoded")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_join", ngram_join), ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

#: Expectation-maximisation and byte-pair merges have no SQL; tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The operators' queries over the given tables: thin, each takes its rows from its operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import bpe, quality, token_planes, toxicity, trie_bpe
from starfold.llm.conversation_repair import audits, digests, repaired
from starfold.llm.decontam import contamination
from starfold.llm.html_extract import extract
from starfold.llm.line_dedup import dedup_lines
from starfold.llm.ngram_join import classes
from starfold.llm.resampling import resample
from starfold.llm.sharding import shard_documents
from starfold.llm.tables import stored
from starfold.llm.token_counts import count_tokens
from starfold.session import fresh_path
from starfold.sources.tables import read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup over documents: counts and the digest of what stays."""
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids in files of byte planes, read back from the files."""
    path = fresh_path(spark, "token-planes")
    token_planes.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_planes.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near copies (five words, similarity 0.8) and its number of links."""
    return classes(documents(spark, sf_dir), size=5, threshold=0.8)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of benchmark items, and the items found."""
    out = contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, learned from the labels outside the held-out fifth."""
    docs = documents(spark, sf_dir)
    out_of = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")
    labels = read_table(spark, sf_dir, "labels").where(~out_of).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs.join(labels, "doc_id")))
    return scored.select("doc_id", F.coalesce(out_of, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules' numbers and verdict on each document."""
    path = fresh_path(spark, "quality-features")
    numbers = quality.features(documents(spark, sf_dir))
    numbers.select(F.struct(F.col("row.doc_id").alias("doc_id")).alias("row"), *numbers.columns[1:]).write.parquet(path)  # so texts are read once
    scored = spark.read.parquet(path)
    out = quality.judge(scored, quality.fit(scored))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("row.doc_id", *base, "base_failed", "kept", "quality")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids and back: digests of the ids and of the decoded bytes."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(documents(spark, sf_dir), *vocabulary).drop("text")
    out = bpe.decode(coded, *vocabulary)
    return out.select("doc_id", "n_tokens", F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document, and whether it exceeds 2,048 tokens."""
    out = count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shards of nearly equal bytes, equal texts together."""
    docs = documents(spark, sf_dir).withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit(""))))
    out = shard_documents(docs, shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with one row in four damaged, by a number drawn from conversation and turn: 0 drops the row, 1 empties its text,
    2 removes its full stops, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    role = F.when(kind == 4, "user").otherwise(filled("role"))
    times = F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faults of each damaged conversation, its cheapest repair, and a digest of what that gives."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    broken = damaged(rows)
    audited = stored(audits(broken), "conversation-audits")
    digest = digests(repaired(broken, audited)).withColumnRenamed("conv_id", "whose")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    out = every.join(audited, F.col("conv").eqNullSafe(F.col("conv_id")), "left").join(digest, F.col("conv").eqNullSafe(F.col("whose")), "left")
    none = F.sha2(F.lit(""), 256)
    return out.select(F.col("conv").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", none).alias("repaired_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn to be like the benchmark texts."""
    out = resample(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"), share=25, least_words=20, seed=7, keep=["doc_id"])
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids by a trie of their words, and decoded: digests of both."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    out = trie_bpe.decode(trie_bpe.encode(documents(spark, sf_dir), vocabulary, keep=["doc_id"]), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_planes": op2_token_planes,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality_rules": op7_quality_rules,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_token_counts": op9_token_counts,
    "op10_sharding": op10_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_trie_bpe": op13_trie_bpe,
}

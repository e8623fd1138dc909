"""The pipeline against plain Python, stage by stage, and its defined cases."""

import sys
from pathlib import Path

import brute
import public_tokenizers as P
import tiktoken
from brute import SMALL, docs_rows, docs_table  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from starfold.llm.bpe import ranks  # noqa: E402


def test_run_is_the_plain_pipeline(spark, docs_rows):
    docs = [d for d, kept in zip(docs_rows, brute.quality(docs_rows), strict=True) if kept]
    docs = [(i, t) for i, t, _, _ in brute.line_dedup(docs)]
    classes = brute.classes(docs)
    docs = [(i, t) for i, t in docs if classes[i][0] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [d for d, (_, _, hit, _) in zip(docs, brute.contamination(docs, items), strict=True) if not hit]
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    import numpy as np

    want = {i: (np.array(enc.encode_ordinary(t), "<u4").tobytes(), brute.sha(t)) for i, t in docs}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"]: (bytes(r["ids"]), r["decoded_sha256"]) for r in rows} == want
    assert len(rows) == len(want) < len(docs_rows)


def test_stages_keep_the_columns_and_take_anything(spark, docs_table):
    good = "This is a plain text of the kind that the rules keep, and it is long enough for them. " * 6
    rows = [(1, good + "one", None, "s", 5), (1, good + "one", None, "s", 5), (2, None, "en", None, None), (None, good + "of its own, which is other", "en", "s", 1), (3, "", "en", "s", 0), (4, good + "one", "en", "s", 3)]
    odd = spark.createDataFrame(rows, docs_table.schema).withColumns({"row": F.lit(1), "kept": F.lit("k"), "n_lines": F.lit(2), "ids": F.lit("i"), "class_id": F.lit(0)})
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "decontamination", "byte_bpe"]

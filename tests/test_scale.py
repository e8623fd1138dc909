"""Steps whose data moved must grow with the input: no shuffle of rows by file, no sort of all rows for one row per file,
no bitmap of every block in every task, one narrow shuffle to compare two drops."""

import os
import re

from pyspark.sql import functions as F

from conftest import HEADER, write_csv
from starfold.functions.cleaning import annotate
from starfold.operators import key_index
from starfold.operators.verdict import accepted_rows, file_verdicts
from starfold.plans.rows_only import compared
from starfold.session import size_partitions
from starfold.sources.csv_drop import _headers, file_checks, records, scan_drop, scan_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw(spark, n=40):
    rows = [(f"{i}-1", "2024-01-02", "N", f"e{i}", "ASIA", "c", "x" if i % 10 == 7 else "3", "p", "t", "1", "2.5", "0", "2.5", f"raw/f{i % 4}.csv", i) for i in range(n)]
    return spark.createDataFrame(rows, HEADER.replace(",", " string, ") + " string, source_file string, _arrival long")


def test_roundtrip_is_one_narrow_shuffle(spark):
    a = spark.createDataFrame([("x", "1"), ("x", "1"), ("y", None), ("a", "b:c"), (None, "y")], "p string, q string")
    b = spark.createDataFrame([("x", "1"), ("y", None), ("y", None), ("a:b", "c"), (None, "y")], "p string, q string")
    got = compared(a, b)
    assert tuple(got.first()) == (5, 5, a.exceptAll(b).count(), b.exceptAll(a).count()) == (5, 5, 2, 2)
    assert tuple(compared(a.limit(0), b.limit(0)).first()) == (0, 0, 0, 0)
    exchanges = [line for line in plan(got).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "_row" in exchanges[0]


def test_rows_of_good_files_are_not_shuffled_by_file(spark):
    ann = annotate(raw(spark))
    verdicts = file_verdicts(ann).checkpoint()
    assert {r["source_file"]: (r["status"], r["n_records"], r["error"]) for r in verdicts.collect()} == {
        "raw/f0.csv": ("success", 10, None), "raw/f1.csv": ("error", 10, "product_id is not a number"),
        "raw/f2.csv": ("success", 10, None), "raw/f3.csv": ("error", 10, "product_id is not a number")}
    good = accepted_rows(ann, verdicts)
    assert good.count() == 20 and "hashpartitioning(source_file" not in plan(good)


def test_verdict_sorts_only_rows_with_an_error(spark):
    text = plan(file_verdicts(annotate(raw(spark))))
    assert re.search(r"HashAggregate\(keys=\[source_file#\d+\], functions=\[(merge_|partial_)?max\(", text)
    sorts = [line for line in text.splitlines() if "SortAggregate" in line]
    assert sorts and all("min_by" in line and "max(" not in line for line in sorts)


def test_csv_lines_are_neither_sorted_nor_shuffled(spark, tmp_path):
    line = lambda i, d="2024-01-02": f"O{i},{d},N,e,ASIA,c,3,p,t,1,2.5,0,2.5"
    write_csv(str(tmp_path), "raw/a.csv", "\n" + HEADER + "\n" + line(1, "NA") + "\n" + line(2, "03/02/2024") + "\n" + line(3) + "\n")
    write_csv(str(tmp_path), "raw/b.csv", HEADER + "\n" + line(4) + "\n" + HEADER + "\n" + line(5) + ",\n")
    write_csv(str(tmp_path), "raw/c.csv", HEADER + "\n")
    lines, drop, checks = scan_drop(spark, str(tmp_path))
    got = {r["source_file"]: (r["header"], r["n_records"], r["status"], r["ragged"], r["date_format"]) for r in checks.collect()}
    assert got == {"raw/a.csv": (HEADER, 3, "valid", False, "MM/dd/yyyy"), "raw/b.csv": (HEADER, 3, "invalid", True, "yyyy-MM-dd"),
                   "raw/c.csv": (HEADER, 0, "invalid", False, "yyyy-MM-dd")}
    assert [r["order_id"] for r in drop.orderBy("_arrival").collect()] == ["O1", "O2", "O3"]
    scanned = scan_lines(spark, str(tmp_path))
    for df in (_headers(scanned), records(scanned, checks, 13)):
        assert not [x for x in plan(df).splitlines() if "value" in x and ("SortAggregate" in x or "hashpartitioning(source_file" in x)]
    assert "hashpartitioning(source_file" not in plan(records(scanned, checks, 13))
    assert "min_by" not in plan(_headers(scanned)) and file_checks(scanned, width=13).count() == 3
    lines.unpersist()


def test_key_filter_is_built_where_its_blocks_are(spark):
    text = plan(key_index.filter_of(spark.range(1000).select(F.col("id").cast("string").alias("k")), "k", 1000))
    # the plan is printed from the result down: nothing aggregates below the exchange
    assert "bitmap" not in text[text.index("Exchange hashpartitioning(block"):]


def test_partitions_follow_the_input(spark, tmp_path):
    keys = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        os.makedirs(tmp_path / "t.parquet")
        with open(tmp_path / "t.parquet" / "part-0", "wb") as f:
            f.truncate(90 << 20)
        spark.conf.set(keys[1], "16m")
        size_partitions(spark, str(tmp_path / "t.parquet"))
        assert spark.conf.get(keys[0]) == "23" and spark.conf.get(keys[1]) == "16m"
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

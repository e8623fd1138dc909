"""What stays on disk: no copy of a drop's lines, no shuffles of a job that has ended, text written in slices."""

import os
import re
import time

from pyspark.sql import functions as F

from conftest import HEADER, write_csv
from starfold.plans.commits import CommitLog
from starfold.plans.context import Run
from starfold.plans.rows_only import validate_ragged
from starfold.plans.warehouse import Warehouse, folders_of, monthly_rollup
from starfold.session import apply_runtime_conf, fresh_path
from starfold.sources import csv_drop
from starfold.sources.sales_drop import REQUIRED_COLUMNS
from starfold.streaming import file_stream
from test_durable import file_of, row


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {m.group(1) for i in range(files.size()) if (m := re.match(r"shuffle_(\d+)_", files.apply(i).getName()))}


def kept(spark):
    return len(spark.sparkContext._jsc.getPersistentRDDs())


def sales(spark, n=60):
    rows = [(f"{i}-1", f"2024-{i % 12 + 1:02d}-02", "N", "" if i % 7 == 0 else None if i % 7 == 1 else f"e,{i}", " ASIA", "c", "3", 'p"q', "t", "1", "2.5", "0", "2.5",
             f"raw/sales_2024_{i % 12 + 1:02d}.csv", i, i % 3 + 1) for i in range(n)]
    df = spark.createDataFrame(rows, HEADER.replace(",", " string, ") + " string, source_file string, i int, n int")
    return df.repartition(3).withColumn("_arrival", F.struct("source_file", "i", F.col("n").alias("linenumber"))).drop("i", "n")


def contents(root):
    found = {}
    for folder, _, files in os.walk(f"{root}/raw"):
        for f in (f for f in files if f.endswith(".csv")):
            with open(os.path.join(folder, f), encoding="utf-8") as h:
                header, *lines = h.read().splitlines()
            found.setdefault((os.path.relpath(folder, root), header), []).extend(lines)
    return {k: sorted(v) for k, v in found.items()}


def test_a_drop_written_in_slices_is_the_same(spark):
    for write in (csv_drop.write_drop, csv_drop.write_messy_drop):
        one, three = fresh_path(spark, "one"), fresh_path(spark, "three")
        write(sales(spark), one)
        write(sales(spark), three, slices=3)
        one, three = contents(one.removeprefix("file:")), contents(three.removeprefix("file:"))
        assert one == three and sum(map(len, one.values())) == 60


def test_each_slice_shuffles_its_own_months_only(spark):
    parts = [{r["part"] for r in s.select("part").collect()} for s in csv_drop._sliced(csv_drop._month_part(sales(spark)), 3)]
    assert sum(map(len, parts)) == len(set().union(*parts)) == 12 and all(len(p) < 12 for p in parts)


def test_reading_a_drop_keeps_no_copy_of_its_lines(spark, tmp_path):
    line = "O{},2024-01-02,N,e,ASIA,c,3,p,t,1,2.5,0,2.5"
    for i in range(5):
        write_csv(str(tmp_path), f"raw/f{i}.csv", HEADER + "\n" + "\n".join(line.format(f"{i}{j}") for j in range(20)) + ("\n" + line.format(i) + ",x" if i == 3 else "") + "\n")
    before = kept(spark)
    drop, checks = csv_drop.read_drop(spark, str(tmp_path))
    assert {r["source_file"]: (r["ragged"], r["n_records"]) for r in checks.collect()} == {f"raw/f{i}.csv": (i == 3, 20 + (i == 3)) for i in range(5)}
    assert {r["order_id"] for r in drop.collect()} == {f"O{i}{j}" for i in range(5) if i != 3 for j in range(20)}
    assert kept(spark) == before and not drop.storageLevel.useDisk


def test_ragged_stores_its_text_alone(spark, tmp_path, monkeypatch):
    """The messy drop is written from the derived rows: no stored copy of them, no lines kept, no shuffle files left."""
    apply_runtime_conf(spark)
    r = Run(spark, str(tmp_path))
    monkeypatch.setattr("starfold.plans.context.derive_drop", lambda spark, sf_dir: sales(spark))
    before, files = kept(spark), shuffle_files(spark)
    got = {x["folder"]: x["ragged"] for x in validate_ragged(r).collect()}
    assert got == {**{f"raw/part=2024_{m:02d}": m == 7 for m in range(1, 13)}, "raw/empty": False}
    assert "drop" not in r._memo and kept(spark) == before and shuffle_files(spark) <= files
    assert list(REQUIRED_COLUMNS) == HEADER.split(",")


def test_a_stream_keeps_the_folders_of_its_last_commits(spark, tmp_path):
    """Folders that only earlier commits name go after each micro-batch; those that no commit names yet stay."""
    apply_runtime_conf(spark)
    drop, root = str(tmp_path / "drop"), str(tmp_path / "wh")
    for i in range(3):
        write_csv(drop, f"raw/f{i}.csv", file_of(*[row(f"O{i}{j}", f"2024-0{i + 1}-05", mail=f"e{j}@x.io") for j in range(20)], row("O00", mail="z@x.io")))
    files, before = shuffle_files(spark), kept(spark)
    os.makedirs(f"{root}/dim_customers/v=under-way-1")
    wh = Warehouse.create(spark, root=root)
    epochs = file_stream.ingest(spark, drop, f"{drop}/raw/*.csv", wh, checkpoint=str(tmp_path / "ckpt"), max_files_per_trigger=1, keep_commits=1)
    for _ in range(50):
        left = shuffle_files(spark) - files
        if len(left) < 6:
            break
        time.sleep(0.2)
    assert len(left) < 6 and kept(spark) <= before  # of a hundred
    assert epochs == [0, 1, 2] and wh.commits == 3
    folders = {f"{t}/{f}" for t in os.listdir(root) if t != "_log" for f in os.listdir(f"{root}/{t}")}
    assert folders == {f for f in folders_of(wh.parts, wh.cells) if f} | {"dim_customers/v=under-way-1"}
    again = Warehouse.open(spark, root)
    assert sorted(r["order_id"] for r in again.table("fact_sales").collect()) == sorted(f"O{i}{j}" if j or i else "O00" for i in range(3) for j in range(20))
    assert again.table("dim_customers").count() == 21
    stored, full = again.table("mv_monthly_sales"), monthly_rollup(again.table("fact_sales"), again.table("dim_products"))
    assert stored.exceptAll(full).count() == full.exceptAll(stored).count() == 0 < stored.count()


def test_superseded_folders_are_found_over_many_commits(spark, tmp_path):
    log, state = CommitLog(spark, str(tmp_path)), {"parts": {}, "cells": {}}
    for n in range(1, 36):
        after = {"parts": {"f": state["parts"].get("f", []) + [{"path": f"f/{n}", "filter": f"k/{n}"}]}, "cells": {"d": {"0": f"d/v{n}/_cell=0"}}}
        assert log.put(n, state, after)
        state = after
    everything = {f for i in range(1, 35) for f in (f"f/{i}", f"k/{i}", f"d/v{i}")}
    assert set().union(*(folders_of(*x) for x in log.brought(35))) == everything
    log.forget(34)
    assert set().union(*(folders_of(*x) for x in log.brought(35))) >= {"f/1", "d/v32", "d/v33", "d/v34"}

"""What a batch reads and writes as the warehouse grows: new files, touched buckets, folders that may hold a key, months
behind the cube; and commits of two writers."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, write_csv
from starfold.operators import key_index
from starfold.operators.upsert import insert_ignore
from starfold.plans import reports
from starfold.plans.batch import run_csv_batch
from starfold.plans.commits import CommitLog, Files, changed, changes
from starfold.plans.warehouse import Warehouse, monthly_rollup
from starfold.session import fresh_path
from starfold.sources.csv_drop import scan_drop, scan_lines
from starfold.sources.listing import list_files
from starfold.streaming import file_stream
from test_durable import file_of, keys, row


def order(i, date="2024-01-05", mail=None, product=1, category="Electronics"):
    return row(i, date, mail=mail).replace(",1,Laptop Pro 15,Electronics,", f",{product},P{product},{category},")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plan(df):
    return df._jdf.queryExecution().toString()


def rollup_is_full(wh):
    stored = wh.table("mv_monthly_sales")
    return same(stored, monthly_rollup(wh.table("fact_sales"), wh.table("dim_products")))


# -- new files ---------------------------------------------------------------


def test_only_new_files_are_scanned(spark, tmp_path):
    drop = str(tmp_path)
    for i in range(60):
        write_csv(drop, f"raw/old_{i:03d}.csv", file_of(row(f"O{i}")))
    wh = Warehouse.create(spark)
    run_csv_batch(wh, drop)
    assert wh.table("fact_sales").count() == 60
    write_csv(drop, "raw/new [1] {a}.csv", file_of(row("N1"), row("O5")))
    write_csv(drop, "raw/old_007.csv", file_of(row("O7"), row("C7")))
    batch = run_csv_batch(wh, drop)
    assert sorted(tuple(r) for r in batch.files.where("state != 'known'").select("source_file", "state").collect()) == [("raw/new [1] {a}.csv", "new"), ("raw/old_007.csv", "changed")]
    assert [r["source_file"] for r in batch.checks.collect()] == ["raw/new [1] {a}.csv"]  # nothing else was scanned
    assert wh.table("fact_sales").count() == 61
    assert run_csv_batch(wh, drop).report is None
    again = run_csv_batch(wh, drop, reload_changed=True)
    assert [r["source_file"] for r in again.checks.collect()] == ["raw/old_007.csv"]
    assert wh.table("fact_sales").where("order_id = 'C7'").count() == 1
    assert run_csv_batch(wh, drop).files.where("state = 'changed'").count() == 0


def test_listing_opens_no_file(spark, tmp_path):
    write_csv(str(tmp_path), "raw/a.csv", file_of(row("O1")))
    write_csv(str(tmp_path), "raw/b.txt", "x")
    found = list_files(spark, str(tmp_path))
    assert "content" not in [line for line in plan(found).splitlines() if "ReadSchema" in line or "binaryFile" in line][-1]
    r = found.collect()
    assert [(x["source_file"], x["length"]) for x in r] == [("raw/a.csv", os.path.getsize(tmp_path / "raw/a.csv"))]
    one = scan_lines(spark, str(tmp_path), paths=[r[0]["path"]])
    assert plan(one).count("raw/a.csv") >= 1 and one.count() == 2
    assert scan_lines(spark, str(tmp_path), paths=[]).count() == 0


# -- buckets -----------------------------------------------------------------


def test_small_batch_rewrites_few_buckets(spark, tmp_path):
    drop = str(tmp_path)
    write_csv(drop, "raw/a.csv", file_of(*[row(f"O{i}") for i in range(400)]))
    wh = Warehouse.create(spark, buckets=64)
    run_csv_batch(wh, drop)
    before, ids = dict(wh.cells["dim_customers"]), {r["email"]: r["customer_id"] for r in wh.table("dim_customers").collect()}
    write_csv(drop, "raw/b.csv", file_of(*[row(f"N{i}", name="Bob", mail=f"O{i}@x.io") for i in range(4)], row("N9")))
    run_csv_batch(wh, drop)
    after = wh.cells["dim_customers"]
    moved = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(moved) <= 5 and len(after) >= 60
    now = {r["email"]: (r["customer_id"], r["customer_name"]) for r in wh.table("dim_customers").collect()}
    assert {e: now[e][0] for e in ids} == ids and len(now) == 401 and len({v[0] for v in now.values()}) == 401
    assert {e for e, v in now.items() if v[1] == "Bob"} == {f"O{i}@x.io" for i in range(4)}
    part = wh._part("dim_customers", sorted(moved))
    assert all(f"_cell={b}" in f for f in part.inputFiles() for b in [f.split("_cell=")[1].split("/")[0]] if b in moved)
    assert {f.split("_cell=")[1].split("/")[0] for f in part.inputFiles()} == moved


# -- key index ---------------------------------------------------------------


def test_filter_never_denies_a_key(spark):
    held = spark.range(0, 30_000).select(F.concat(F.lit("k"), "id").alias("order_id"))
    path = fresh_path(spark, "filter")
    key_index.filter_of(held, "order_id", 30_000).write.parquet(path)
    assert spark.read.parquet(path).count() <= 1 << key_index.level_for(30_000)
    level = key_index.level_for(30_000)
    for i in (0, 17, 29_999):
        assert key_index.folders_with(spark, held.where(F.col("order_id") == f"k{i}"), "order_id", [(level, path)]) == {path}
    other = spark.range(0, 200).select(F.concat(F.lit("x"), "id").alias("order_id"))
    assert key_index.folders_with(spark, other, "order_id", [(level, path)]) == set()
    assert key_index.folders_with(spark, other.limit(0), "order_id", [(level, path)]) == set()


def test_only_folders_with_a_key_are_read(spark, tmp_path):
    wh = Warehouse.create(spark)
    for i in range(2):
        drop = str(tmp_path / str(i))
        write_csv(drop, f"raw/{i}.csv", file_of(*[row(f"A{j}") for j in range(i, 60, 2)]))  # ranges overlap
        run_csv_batch(wh, drop)
    folders = [p["path"] for p in wh.parts["fact_sales"]]
    batch = spark.createDataFrame([("A5",), ("A31",), ("A30x",), ("B1",)], "order_id string")
    assert wh.folders_with(batch, "A30x", "B1") == [folders[1]]
    assert wh.folders_with(batch, "X", "Z") == []
    left = wh.unknown_orders(batch, "A30x", "B1")
    assert {f.split("/batch=")[1].split("/")[0] for f in left.inputFiles()} == {folders[1].split("batch=")[1]}
    plain = insert_ignore(wh.table("fact_sales").select("order_id"), batch.withColumn("_arrival", F.lit(1)), ["order_id"])
    assert same(left, plain.select("order_id")) and left.count() == 2


# -- rollup ------------------------------------------------------------------


def test_changed_category_touches_its_months_only(spark, tmp_path):
    wh = Warehouse.create(spark)
    write_csv(str(tmp_path / "a"), "raw/a.csv", file_of(order("1", "2024-01-05", product=21), order("2", "2024-02-05", product=22), order("3", "2024-03-05", product=21), order("4", "2024-04-05", product=23)))
    run_csv_batch(wh, str(tmp_path / "a"))
    before = dict(wh.cells["mv_monthly_sales"])
    cube = dict(wh.cells["sales_cube"])
    write_csv(str(tmp_path / "b"), "raw/b.csv", file_of(order("5", "2024-04-09", product=21, category="Toys")))
    report = run_csv_batch(wh, str(tmp_path / "b")).report
    assert report.touched_months == ["2024-01-01", "2024-03-01", "2024-04-01"]
    after = wh.cells["mv_monthly_sales"]
    assert after["2024-02-01"] == before["2024-02-01"] and after["2024-01-01"] != before["2024-01-01"]
    assert {m for m in cube if wh.cells["sales_cube"][m] != cube[m]} == {"2024-04-01"}  # the cube knows no categories
    assert rollup_is_full(wh)
    assert {r["category"] for r in wh.table("mv_monthly_sales").where("month = '2024-01-01'").collect()} == {"Toys"}


def test_months_stay_pending_until_refreshed(spark, tmp_path):
    wh = Warehouse.create(spark)
    for i, refresh in enumerate(["incremental", "none"]):
        write_csv(str(tmp_path / str(i)), "raw/a%d.csv" % i, file_of(order(f"{i}", f"2024-0{i + 1}-05"), order(f"{i}b", "2024-01-09")))
        run_csv_batch(wh, str(tmp_path / str(i)), refresh=refresh)
    assert not rollup_is_full(wh) and wh.pending == ["2024-01-01", "2024-02-01"]
    again = Warehouse.open(spark, wh.root)
    again.refresh()
    assert rollup_is_full(again) and again.pending == []
    assert rollup_is_full(Warehouse.open(spark, wh.root))
    again.refresh(full=True)
    assert rollup_is_full(again)


# -- commits -----------------------------------------------------------------


def test_two_writers_both_land(spark, tmp_path):
    root = str(tmp_path / "wh")
    for name, ids in (("start", ["O1"]), ("a", ["O2", "O3"]), ("b", ["O3", "O4"])):
        write_csv(str(tmp_path / name), f"raw/{name}.csv", file_of(*[row(i) for i in ids]))
    run_csv_batch(Warehouse.create(spark, root=root), str(tmp_path / "start"))
    one, two = Warehouse.open(spark, root), Warehouse.open(spark, root)
    run_csv_batch(one, str(tmp_path / "a"))
    run_csv_batch(two, str(tmp_path / "b"))  # starts from the same commit, finds it taken
    got = keys(Warehouse.open(spark, root))
    assert [k[0] for k in got] == ["O1", "O2", "O3", "O4"] and len({k[1] for k in got}) == 4 and two.commits == 3
    assert keys(two) == got and len(keys(one)) == 3 and len(keys(two.as_of(1))) == 1
    runs = Warehouse.open(spark, root).table("pipeline_runs").collect()
    assert sorted((r["run_id"], r["source_file"], r["rows_loaded"]) for r in runs) == [(1, "raw/start.csv", 1), (2, "raw/a.csv", 2), (3, "raw/b.csv", 1)]


def test_log_of_many_commits_is_bounded(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    empty = {"parts": {}, "cells": {}}
    before, sizes = empty, []
    for n in range(1, 201):
        parts = (before["parts"].get("f", []) + [{"path": f"f/{n}"}])[-8:]
        after = {"parts": {"f": parts}, "cells": {"d": {**before["cells"].get("d", {}), str(n % 5): f"v{n}"}}, "pending": [n]}
        assert changed(before, changes(before, after)) == after
        assert log.put(n, before, after) and not log.put(n, before, empty)
        sizes.append(len(log.files.read(f"{log.folder}/{n:020d}.json")))
        before = after
    assert log.state() == (200, before) and log.state(150)[1]["pending"] == [150] and log.state(201) is None
    assert max(sizes[20:]) < 300
    log.forget(190)
    assert log.state()[1] == before and log.state(195)[1]["pending"] == [195] and log.state(100) is None
    assert len(os.listdir(f"{tmp_path}/_log")) < 120


def test_put_if_absent_by_rename(spark, tmp_path):
    """The way of file systems without links, on this one."""
    files = Files(spark, str(tmp_path))
    files.local = False
    assert files.put_if_absent(f"{tmp_path}/x/1.json", "a") and not files.put_if_absent(f"{tmp_path}/x/1.json", "b")
    assert files.read(f"{tmp_path}/x/1.json") == "a" and [n for n, _ in files.entries(f"{tmp_path}/x")] == ["1.json"]


def test_parts_are_merged_and_vacuumed(spark, tmp_path):
    wh = Warehouse.create(spark, root=str(tmp_path / "wh"), most_parts=1)
    for i in range(3):
        write_csv(str(tmp_path / str(i)), f"raw/{i}.csv", file_of(row(f"O{i}"), row("O0")))
        run_csv_batch(wh, str(tmp_path / str(i)))
    assert len(wh.parts["fact_sales"]) <= 2 and [k[0] for k in keys(wh)] == ["O0", "O1", "O2"]
    assert wh.folders_with(spark.createDataFrame([("O2",)], "order_id string"), "O2", "O2")
    assert wh.vacuum(keep=1) == []  # all are young
    gone = wh.vacuum(keep=1, older_than=0)
    assert len(gone) > 6
    again = Warehouse.open(spark, wh.root)
    assert [k[0] for k in keys(again)] == ["O0", "O1", "O2"] and rollup_is_full(again)
    assert again.table("pipeline_runs").count() == 3 and again.table("dim_customers").count() == 3


# -- archive -----------------------------------------------------------------


def test_archive_survives_a_stop_after_the_load(spark, tmp_path, monkeypatch):
    drop, root, archive = str(tmp_path / "drop"), str(tmp_path / "wh"), str(tmp_path / "archive")
    texts = {"a": "note," + HEADER + "\r\n\r\n" + "x," + row("A1") + "\r\n", "b": file_of(row("B1", name='"Ünd ""x"""'), "", row("B2")), "bad": HEADER + "\n"}
    for name, text in texts.items():
        path = write_csv(drop, f"raw/{name}.csv", "")
        with open(path, "wb") as f:
            f.write(text.encode())
    monkeypatch.setattr(Warehouse, "finish_archives", lambda self: (_ for _ in ()).throw(RuntimeError("stopped")) if self.parts["archive"] else 0)
    with pytest.raises(RuntimeError, match="stopped"):
        run_csv_batch(Warehouse.create(spark, root=root), drop, archive_root=archive)
    monkeypatch.undo()
    assert not os.path.exists(archive)
    wh = Warehouse.open(spark, root)
    assert wh.table("fact_sales").count() == 3
    run_csv_batch(wh, drop, archive_root=archive)  # only the empty file is left; the open archive is finished first
    assert wh.parts["archive"] == [] == Warehouse.open(spark, root).parts["archive"]
    found = {}
    for folder, _, files in sorted(os.walk(archive)):
        for f in sorted(x for x in files if x.startswith("part-")):
            key = folder.rpartition("archive_key=")[2]
            with open(os.path.join(folder, f), "rb") as h:
                found[key] = found.get(key, b"") + h.read()
    assert found == {f"archive%2F{n}.csv": texts[n].encode() for n in ("a", "b")}
    assert wh.finish_archives() == 0


# -- stream ------------------------------------------------------------------


def test_a_replayed_epoch_is_skipped(spark, tmp_path, monkeypatch):
    drop, root, ckpt = str(tmp_path / "drop"), str(tmp_path / "wh"), str(tmp_path / "ckpt")
    write_csv(drop, "raw/a.csv", file_of(row("A1"), row("A2")))
    real = Warehouse.load

    def stopped(self, *args, **kw):
        real(self, *args, **kw)
        raise RuntimeError("stopped after the commit")

    monkeypatch.setattr(Warehouse, "load", stopped)
    with pytest.raises(Exception, match="stopped after the commit"):
        file_stream.ingest(spark, drop, f"{drop}/raw/*.csv", Warehouse.create(spark, root=root), checkpoint=ckpt)
    monkeypatch.undo()
    wh = Warehouse.open(spark, root)
    assert [k[0] for k in keys(wh)] == ["A1", "A2"]
    assert file_stream.ingest(spark, drop, f"{drop}/raw/*.csv", wh, checkpoint=ckpt) == [0]  # the epoch runs again
    assert wh.commits == 1 and Warehouse.open(spark, root).table("pipeline_runs").count() == 1
    write_csv(drop, "raw/b.csv", file_of(row("B1")))
    run_csv_batch(wh, drop)  # a batch takes the file before the stream does
    file_stream.ingest(spark, drop, f"{drop}/raw/*.csv", wh, checkpoint=ckpt)
    assert sorted(r["source_file"] for r in wh.table("pipeline_runs").collect()) == ["raw/a.csv", "raw/b.csv"]


# -- records over several lines -------------------------------------------------


def test_many_quoted_records_in_many_tasks(spark, tmp_path):
    n = 100_000
    path = write_csv(str(tmp_path), "raw/big.csv", HEADER + "\n" + "".join(row(f"O{i}", name=f'"Ann ""{i}""\n\nSmith, {i}"' if i % 3 else f"Ann {i}") + ("\r\n" if i % 2 else "\n") for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(path) // 5))
    try:
        lines, rows, checks = scan_drop(spark, str(tmp_path), multi_line=True)
        assert lines.where(F.col("_row") > 0).select(F.col("_block")).distinct().count() >= 4
        assert checks.first()["n_records"] == n and checks.first()["status"] == "valid"
        want = spark.range(n).select(F.concat(F.lit("O"), "id").alias("order_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('Ann "'), "id", F.lit('"\n\nSmith, '), "id")).otherwise(F.concat(F.lit("Ann "), "id")).alias("customer_name"))
        assert same(rows.select("order_id", "customer_name"), want)
        in_order = [r["order_id"] for r in rows.orderBy("_arrival").select("order_id").limit(50).collect()]
        assert in_order == [f"O{i}" for i in range(50)]
        lines.unpersist()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# -- distinct customers ------------------------------------------------------

def test_distinct_customers_come_from_stored_bitmaps(spark, tmp_path):
    """Customers of several batches, months and regions count once; reports read no fact; months without new facts keep their folder."""
    wh = Warehouse.create(spark, root=str(tmp_path / "wh"))

    def counted(by):
        return wh.table("fact_sales").groupBy(*by).agg(F.countDistinct("customer_id").alias("n"))

    def report_is_exact():
        regional = reports.v_regional_performance(wh)
        assert same(regional.select("region", F.col("unique_customers").alias("n")), counted(["region"]))
        assert reports.dash_kpis(wh).first()["total_customers"] == counted([]).first()["n"]
        monthly = reports.dash_region_monthly_customers(wh)
        assert same(monthly.select("month", "region", F.col("customers").alias("n")), counted([F.col("sale_month").alias("month"), "region"]))
        for df in (regional, reports.dash_kpis(wh), monthly):
            assert "fact_sales" not in plan(df)

    write_csv(str(tmp_path / "a"), "raw/a.csv", file_of(*(order(i, f"2024-0{1 + i % 3}-05", mail=f"c{i % 7}@x.org") for i in range(60))))
    run_csv_batch(wh, str(tmp_path / "a"))
    report_is_exact()
    before = dict(wh.cells["month_customers"])
    write_csv(str(tmp_path / "b"), "raw/b.csv", file_of(*(order(100 + i, "2024-02-07", mail=f"c{i}@x.org") for i in range(12))))
    run_csv_batch(wh, str(tmp_path / "b"), refresh="none")
    report_is_exact()
    changed_months = {m for m, p in wh.cells["month_customers"].items() if before.get(m) != p}
    assert changed_months == {"2024-02-01"}
    held = wh.table("month_customers").withColumn("c", F.bitmap_count("bits")).drop("bits")
    rows = held.collect()
    wh.refresh(full=True)  # the bitmaps made anew from all facts are those that the batches added up to
    assert sorted(rows) == sorted(wh.table("month_customers").withColumn("c", F.bitmap_count("bits")).drop("bits").collect())


def test_reports_of_an_empty_warehouse(spark, tmp_path):
    wh = Warehouse.create(spark, root=str(tmp_path / "wh"))
    assert reports.v_regional_performance(wh).count() == 0
    assert tuple(reports.dash_kpis(wh).first()) == (None, 0, 0)
    assert reports.dash_region_channel_pivot(wh).count() == 0 and reports.dash_error_files(wh).count() == 0

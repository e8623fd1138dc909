"""A warehouse that outlives its process, and files that other readers lose."""

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, write_csv
from starfold.plans.batch import run_csv_batch
from starfold.plans.warehouse import Warehouse
from starfold.sources.csv_drop import read_drop, scan_drop
from starfold.streaming import file_stream

ROW = "{id},{date},{name},{mail},North,Online,1,Laptop Pro 15,Electronics,2,10.00,5,19.00"


def file_of(*rows, header=HEADER):
    return header + "\n" + "\n".join(rows) + "\n"


def row(i, date="2024-01-05", name="Ann", mail=None):
    return ROW.format(id=i, date=date, name=name, mail=mail or f"{i}@x.io")


def keys(wh):
    return sorted((r["order_id"], r["sale_id"], r["customer_id"]) for r in wh.table("fact_sales").collect())


def test_reopen_continues(spark, tmp_path):
    root, drop = str(tmp_path / "wh"), str(tmp_path / "drop")
    write_csv(drop, "raw/a.csv", file_of(row("O1"), row("O2")))
    run_csv_batch(Warehouse.create(spark, root=root), drop)
    again = Warehouse.open(spark, root)
    assert [k[0] for k in keys(again)] == ["O1", "O2"]
    assert run_csv_batch(again, drop).report is None            # the ledger is there
    write_csv(drop, "raw/b.csv", file_of(row("O2"), row("O3", mail="O1@x.io")))
    run_csv_batch(Warehouse.open(spark, root), drop)
    last = Warehouse.open(spark, root)
    got = keys(last)
    assert [k[0] for k in got] == ["O1", "O2", "O3"] and len({k[1] for k in got}) == 3
    assert got[2][2] == got[0][2]                                 # the customer kept its id
    assert last.table("dim_customers").count() == 2
    last.compact()
    assert keys(Warehouse.open(spark, root)) == got and len(last.parts["fact_sales"]) == 1


def test_a_failed_batch_leaves_nothing(spark, tmp_path, monkeypatch):
    root, drop = str(tmp_path / "wh"), str(tmp_path / "drop")
    write_csv(drop, "raw/a.csv", file_of(row("O1")))
    wh = Warehouse.create(spark, root=root)
    run_csv_batch(wh, drop)
    before = keys(wh)
    write_csv(drop, "raw/b.csv", file_of(row("O2")))
    real = Warehouse._append

    def broken(self, name, *args, **kw):
        if name == "pipeline_runs":
            raise RuntimeError("lost")
        return real(self, name, *args, **kw)

    monkeypatch.setattr(Warehouse, "_append", broken)
    with pytest.raises(RuntimeError, match="lost"):
        run_csv_batch(wh, drop)
    monkeypatch.undo()
    for seen in (wh, Warehouse.open(spark, root)):
        assert keys(seen) == before and seen.table("dim_customers").count() == 1
    run_csv_batch(wh, drop)
    assert [k[0] for k in keys(Warehouse.open(spark, root))] == ["O1", "O2"]


def test_staged_batches_are_released(spark, tmp_path):
    wh = Warehouse.create(spark)
    held = []
    for i in range(3):
        write_csv(str(tmp_path), f"raw/f{i}.csv", file_of(row(f"O{i}")))
        run_csv_batch(wh, str(tmp_path))
        held.append(len(spark.sparkContext._jsc.getPersistentRDDs()))
    assert held[2] <= held[1] <= held[0]


def test_dates_by_file_and_blank_lines(spark, tmp_path):
    drop = str(tmp_path)
    write_csv(drop, "raw/a.csv", "\n" + file_of(row("A1", "01/25/2024"), "", row("A2", "2024-01-05"), row("A3", "12/31/2023")))
    write_csv(drop, "raw/b.csv", file_of(row("B1", "2024-03-01 10:00:00"), row("B2", "2024-03-02 00:00:01")))
    write_csv(drop, "raw/c.csv", file_of(row("C1", ""), row("C2", "2024-05-06"), row("C3", "05/06/2024")))
    write_csv(drop, "raw/d.csv", HEADER + "\n\n\n")
    wh = Warehouse.create(spark)
    checks = {r["source_file"]: r["reason"] for r in run_csv_batch(wh, drop).checks.collect()}
    assert checks == {"raw/a.csv": None, "raw/b.csv": None, "raw/c.csv": None, "raw/d.csv": "file is empty"}
    got = {r["order_id"]: r["sale_date"].isoformat() for r in wh.table("fact_sales").collect()}
    assert got == {"A1": "2024-01-25", "A3": "2023-12-31", "B1": "2024-03-01", "B2": "2024-03-02", "C2": "2024-05-06"}


def test_header_positions_and_surplus_fields(spark, tmp_path):
    drop = str(tmp_path)
    write_csv(drop, "raw/a.csv", file_of("," + row("A1"), header="," + HEADER))
    write_csv(drop, "raw/b.csv", file_of(row("B1") + ","))
    write_csv(drop, "raw/c.csv", file_of(row("C1", name='"Ann, the ""first"""')))
    drop_rows, checks = read_drop(spark, drop)
    assert {r["source_file"]: r["reason"] for r in checks.collect()} == {"raw/a.csv": None, "raw/b.csv": "record wider than header", "raw/c.csv": None}
    assert {r["order_id"]: r["customer_name"] for r in drop_rows.collect()} == {"A1": "Ann", "C1": 'Ann, the "first"'}


def test_line_breaks_inside_quotes(spark, tmp_path):
    drop = str(tmp_path)
    write_csv(drop, "raw/a.csv", file_of(row("A1", name='"Ann\nSmith"'), row("A2")))
    lines, rows, _ = scan_drop(spark, drop, multi_line=True)
    assert {r["order_id"]: r["customer_name"] for r in rows.collect()} == {"A1": "Ann\nSmith", "A2": "Ann"}
    lines.unpersist()


def test_stream_reads_like_the_batch(spark, tmp_path):
    drop = str(tmp_path / "drop")
    swapped = HEADER.replace("quantity,unit_price,discount_pct", "discount_pct,unit_price,quantity")
    write_csv(drop, "raw/a.csv", file_of(row("A1"), row("A2", mail="A1@x.io")))
    write_csv(drop, "raw/b.csv", file_of(row("B1"), header=swapped))
    write_csv(drop, "raw/c.csv", file_of(row("C1"), header=HEADER.replace(",channel", "").replace("order_id", "order")))
    write_csv(drop, "raw/d.csv", file_of(row("D1") + ",surplus"))
    write_csv(drop, "raw/e.csv", HEADER + "\n")
    batch, stream = Warehouse.create(spark), Warehouse.create(spark)
    run_csv_batch(batch, drop)
    file_stream.ingest(spark, drop, f"{drop}/raw/*.csv", stream, checkpoint=str(tmp_path / "ckpt"))
    columns = [c for c in batch.table("fact_sales").columns if c not in ("sale_id", "customer_id", "processed_at")]
    of = lambda wh: sorted(map(tuple, wh.table("fact_sales").select(columns).collect()))
    assert of(batch) == of(stream) and len(of(batch)) == 3
    runs = lambda wh: sorted(map(tuple, wh.table("pipeline_runs").select("source_file", "status", "rows_loaded", "error_message").collect()), key=str)
    assert runs(batch) == runs(stream)
    b1 = stream.table("fact_sales").filter(F.col("order_id") == "B1").first()
    assert (b1["quantity"], float(b1["discount"])) == (5, 2.0)

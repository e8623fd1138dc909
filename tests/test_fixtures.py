"""Golden micro-fixtures: the dirty-record cases of the load, end to end
(CSV files on disk -> structural checks -> load -> warehouse tables)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, write_csv
from starfold.plans import reports
from starfold.plans.batch import run_csv_batch
from starfold.plans.warehouse import Warehouse

GOOD = HEADER + "\n" + "\n".join([
    # case 7 (padded region), case 4 (2.7 -> 2), first O1
    "O1,2024-01-05,Ann,ann@x.io,  North ,Online,1,Laptop Pro 15,Electronics,2.7,10.00,5,19.00",
    "O2,not-a-date,Zed,zed@x.io,North,Online,1,Laptop Pro 15,Electronics,1,10.00,0,10.00",   # case 2
    ",2024-01-05,Zed,zed@x.io,North,Online,1,Laptop Pro 15,Electronics,1,10.00,0,10.00",       # case 1
    "NA,2024-01-05,Zed,zed@x.io,North,Online,1,Laptop Pro 15,Electronics,1,10.00,0,10.00",     # case 1
    "O3,2024-01-06,Bob,,NA,\tIn-Store,2,Wireless Mouse,Electronics,abc,x,,0",                 # 3, 6, 8, 10
    "O4,2024-01-07,Cy,,   ,null,3,USB-C Hub,Electronics,-2.7,5.00,10,-9.00",                   # 4, 9, 10
    "O1,2024-01-08,Ann Two,ann@x.io,East,Online,1,Laptop Pro 15,Electronics,1,11.00,0,11.00",  # case 13
    "O5,01/05/2024,Zed,zed@x.io,North,Online,1,Laptop Pro 15,Electronics,1,10.00,0,10.00",     # case 2
    "O6,9999-12-31,Zed,zed@x.io,North,Online,1,Laptop Pro 15,Electronics,1,10.00,0,10.00",     # case 2
    "O7,2024-01-09,Dee,dee@x.io,West,Partner,4,Mechanical Keyboard,Electronics,1e2,1.00,0,999", # 4, 21
    "O8,2024-01-09,Dee,dee@x.io,West,Partner,4,Mechanical Keyboard,Electronics,3d,1.00,0,1.00", # case 5
]) + "\n"

BAD_PID = HEADER + "\n" + "\n".join([
    "O9,2024-01-10,Eve,eve@x.io,South,Online,5,4K Monitor,Electronics,1,10.00,0,10.00",
    "O10,2024-01-10,Eve,eve@x.io,South,Online,abc,4K Monitor,Electronics,1,10.00,0,10.00",    # case 11
]) + "\n"
BAD_PRICE = HEADER + "\n" + (
    "O11,2024-01-10,Fay,fay@x.io,South,Online,6,Office Chair,Furniture,1,1e9,0,1\n")         # case 12
NO_CHANNEL = ("order_id,sale_date,customer_name,customer_email,region,product_id,product_name,"
              "category,quantity,unit_price,discount_pct,total_amount\n"
              "O12,2024-01-10,Gus,gus@x.io,South,6,Office Chair,Furniture,1,1.00,0,1.00\n")    # case 17
UPPER = HEADER.replace("order_id", "Order_ID") + "\n" + (
    "O13,2024-01-10,Gus,gus@x.io,South,Online,6,Office Chair,Furniture,1,1.00,0,1.00\n")    # case 17
EMPTY = HEADER + "\n"                                                                        # case 18
RAGGED = HEADER + "\n" + (
    "O14,2024-01-10,Gus,gus@x.io,South,Online,6,Office Chair,Furniture,1,1.00,0,1.00,extra\n")  # 19
REORDERED = ("note,total_amount,discount_pct,unit_price,quantity,category,product_name,product_id,"
             "channel,region,customer_email,customer_name,sale_date,order_id\n"
             "hello,2.00,0,2.00,1,Furniture,Bookshelf,8,Online,South,hal@x.io,Hal,2024-01-11,O15\n")  # 20
NO_REGION = HEADER + "\n" + (
    "O16,2024-01-12,Ida,ida@x.io,,Online,9,Notebook Set,Stationery,1,1.00,0,1.00\n"
    "O17,2024-01-12,Ida,ida@x.io,,Online,9,Notebook Set,Stationery,1,1.00,0,1.00\n")          # 24

LATER = HEADER + "\n" + "\n".join([
    "O1,2024-02-01,Ann Three,ann@x.io,South,Online,1,Laptop Pro 15,Electronics,9,12.00,0,108.00",  # 14, 16
    "O9,2024-02-01,Eve,eve@x.io,South,Online,5,4K Monitor,Electronics,1,10.00,0,10.00",            # 15
]) + "\n"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("drop"))
    for name, text in [("raw/a1.csv", GOOD), ("raw/a2.csv", BAD_PID), ("raw/a3.csv", BAD_PRICE),
                       ("raw/a4.csv", NO_CHANNEL), ("raw/a5.csv", UPPER), ("raw/a6.csv", EMPTY),
                       ("raw/a7.csv", RAGGED), ("raw/a8.csv", REORDERED), ("raw/a9.csv", NO_REGION)]:
        write_csv(root, name, text)
    wh = Warehouse.create(spark)
    archive = str(tmp_path_factory.mktemp("archive"))
    first = run_csv_batch(wh, root, archive_root=archive)
    wh.fixture_archive = archive
    state1 = {t: wh.table(t).collect() for t in ("fact_sales", "dim_customers", "dim_products")}
    write_csv(root, "raw/b1.csv", LATER)
    second = run_csv_batch(wh, root)
    wh.fixture_root = root
    return wh, first, second, state1


def _facts(wh):
    return {r["order_id"]: r for r in wh.table("fact_sales").collect()}


def test_structural_checks(loaded):
    _, first, _, _ = loaded
    st = {r["source_file"]: (r["status"], r["reason"]) for r in first.checks.collect()}
    assert st["raw/a4.csv"] == ("invalid", "missing columns: channel")
    assert st["raw/a5.csv"][0] == "invalid" and "order_id" in st["raw/a5.csv"][1]
    assert st["raw/a6.csv"] == ("invalid", "file is empty")
    assert st["raw/a7.csv"] == ("invalid", "record wider than header")
    assert st["raw/a8.csv"] == ("valid", None)
    assert st["raw/a1.csv"] == ("valid", None)


def test_file_verdicts(loaded):
    _, first, _, _ = loaded
    v = {r["source_file"]: r["status"] for r in first.report.verdicts.collect()}
    assert v == {"raw/a1.csv": "success", "raw/a2.csv": "error", "raw/a3.csv": "error",
                 "raw/a8.csv": "success", "raw/a9.csv": "error"}
    runs = {r["source_file"]: r["rows_loaded"] for r in first.report.runs.collect()}
    assert runs["raw/a1.csv"] == 5 and runs["raw/a2.csv"] == 0 and runs["raw/a8.csv"] == 1


def test_cleaning_rules(loaded):
    wh, _, _, state1 = loaded
    f = {r["order_id"]: r for r in state1["fact_sales"]}
    assert set(f) == {"O1", "O3", "O4", "O7", "O8", "O15"}           # cases 1, 2, 11, 12, 24
    assert f["O1"]["quantity"] == 2 and f["O1"]["region"] == "North"  # cases 4, 7
    assert f["O3"]["quantity"] == 1 and f["O3"]["unit_price"] == Decimal("0.00")  # cases 3, 6
    assert f["O3"]["discount"] == Decimal("0.00") and f["O3"]["region"] == "Unknown"  # 6, 8
    assert f["O3"]["channel"] == "In-Store"                           # case 7 (tab)
    assert f["O4"]["quantity"] == -2 and f["O4"]["region"] == ""     # cases 4, 9
    assert f["O4"]["channel"] == "Unknown"
    assert f["O7"]["quantity"] == 100 and f["O8"]["quantity"] == 1   # cases 4, 5
    assert f["O1"]["total_amount"] == Decimal("19.00")                # 2 * 10.00 * 0.95
    assert f["O7"]["total_amount"] == Decimal("100.00")               # case 21: CSV said 999


def test_missing_email_collapses(loaded):
    _, _, _, state1 = loaded
    nan = [r for r in state1["dim_customers"] if r["email"] == "NaN"]
    assert len(nan) == 1 and nan[0]["customer_name"] == "Cy"          # case 10 (last wins)


def test_failed_file_changes_nothing(loaded):
    _, _, _, state1 = loaded
    emails = {r["email"] for r in state1["dim_customers"]}
    assert "eve@x.io" not in emails and "fay@x.io" not in emails      # case 11, 12
    prods = {r["product_id"]: r for r in state1["dim_products"]}
    assert prods[5]["product_name"] == "4K Monitor" and prods[5]["unit_price"] == Decimal("399.99")


def test_duplicate_in_file_updates_dims(loaded):
    _, _, _, state1 = loaded
    ann = [r for r in state1["dim_customers"] if r["email"] == "ann@x.io"][0]
    assert ann["customer_name"] == "Ann Two" and ann["region"] == "East"   # case 13
    prod1 = [r for r in state1["dim_products"] if r["product_id"] == 1][0]
    assert prod1["unit_price"] == Decimal("11.00")


def test_second_batch(loaded):
    wh, _, second, state1 = loaded
    f = _facts(wh)
    assert f["O1"]["sale_date"].isoformat() == "2024-01-05"           # case 14: later copy ignored
    assert "O9" in f                                                   # case 15
    ann1 = [r for r in state1["dim_customers"] if r["email"] == "ann@x.io"][0]
    ann2 = [r for r in wh.table("dim_customers").collect() if r["email"] == "ann@x.io"]
    assert len(ann2) == 1 and ann2[0]["customer_id"] == ann1["customer_id"]   # case 16
    assert ann2[0]["customer_name"] == "Ann Three" and ann2[0]["region"] == "South"
    assert ann2[0]["created_at"] == ann1["created_at"]
    runs = {r["source_file"]: (r["status"], r["rows_loaded"]) for r in second.report.runs.collect()}
    # the ledger skips a1/a8 (loaded); failed files are retried
    assert runs == {"raw/b1.csv": ("success", 1), "raw/a2.csv": ("error", 0),
                    "raw/a3.csv": ("error", 0), "raw/a9.csv": ("error", 0),
                    **{f"raw/a{i}.csv": ("invalid", 0) for i in (4, 5, 6, 7)}}


def test_unsold_product_in_report(loaded):
    wh, _, _, _ = loaded
    v = {r["product_id"]: r for r in reports.v_product_performance(wh).collect()}
    assert v[14]["total_orders"] == 0 and v[14]["total_revenue"] is None     # case 22
    top = reports.bi_top10_products(wh).collect()
    assert top[0]["total_revenue"] is None                                   # NULLS FIRST parity
    sold = reports.bi_top10_products(wh, sold_only=True).collect()
    assert all(r["total_revenue"] is not None for r in sold)


def test_replay_is_noop(loaded, spark):
    wh, _, _, _ = loaded
    from starfold.sources.csv_drop import read_drop
    before = wh.table("fact_sales").count()
    recs, _ = read_drop(spark, wh.fixture_root)
    rep = wh.load(recs.filter(F.col("source_file") == "raw/a1.csv"))
    assert [r["rows_loaded"] for r in rep.runs.collect()] == [0]               # case 23
    assert wh.table("fact_sales").count() == before


def test_archive_holds_successful_files_only(loaded, spark):
    wh, _, _, _ = loaded
    arch = spark.read.option("header", True).csv(wh.fixture_archive)
    keys = {r["archive_key"]: r["n"] for r in arch.groupBy("archive_key").agg(F.count("*").alias("n")).collect()}
    assert keys == {"archive/a1.csv": 11, "archive/a8.csv": 1}      # every raw record, raw/ -> archive/

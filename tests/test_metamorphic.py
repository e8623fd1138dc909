"""Metamorphic properties on the derived drop (sf0.001): two runs equal one,
incremental rollup equals full, replay changes nothing, stream equals batch."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starfold.plans.context import run_for
from starfold.plans.warehouse import monthly_rollup


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_runs_equal_one(spark):
    r = run_for(spark, SF_SMALL)
    one, _ = r.one
    two, _ = r.two
    cols = ["order_id", "sale_date", "product_id", "quantity", "unit_price", "discount", "total_amount",
            "region", "channel", "source_file"]
    assert _same(one.table("fact_sales").select(cols), two.table("fact_sales").select(cols))
    assert _same(one.table("dim_customers").select("email", "customer_name", "region"),
                 two.table("dim_customers").select("email", "customer_name", "region"))
    assert _same(one.table("dim_products").drop("created_at"), two.table("dim_products").drop("created_at"))


def test_incremental_rollup_equals_full(spark):
    two, reps = run_for(spark, SF_SMALL).two
    assert reps[1].touched_months  # the second run touched some months
    full = monthly_rollup(two.table("fact_sales"), two.table("dim_products"))
    assert _same(two.table("mv_monthly_sales"), full)


def test_replay_changes_nothing(spark):
    r = run_for(spark, SF_SMALL)
    two, _ = r.two
    before = two.table("fact_sales").count()
    rep = r.replay
    assert rep.runs.agg(F.sum("rows_loaded")).first()[0] == 0
    assert two.table("fact_sales").count() == before


def test_stream_equals_batch(spark):
    """The same CSV files as a stream and as a batch load the same orders, from the same files."""
    from starfold.plans.batch import run_csv_batch
    from starfold.plans.rows_only import _clean_root, stream_ingest
    from starfold.plans.warehouse import Warehouse
    r = run_for(spark, SF_SMALL)
    streamed = stream_ingest(r).select("order_id")
    wh = Warehouse.create(spark)
    run_csv_batch(wh, _clean_root(r))
    assert streamed.count() > 0
    assert _same(streamed, wh.table("fact_sales").select("order_id"))
    verdicts = lambda w: w.table("pipeline_runs").select("source_file", "status")
    assert _same(verdicts(r._stream_wh), verdicts(wh))


def test_csv_roundtrip_is_exact(spark):
    from starfold.plans.rows_only import csv_roundtrip
    row = csv_roundtrip(run_for(spark, SF_SMALL)).first()
    assert row["written"] == row["read"] > 0
    assert row["only_written"] == 0 and row["only_read"] == 0


def test_messy_drop_file_checks(spark):
    from starfold.plans.rows_only import _messy
    _, checks = _messy(run_for(spark, SF_SMALL))
    rows = checks.collect()
    by_reason = {}
    for r in rows:
        by_reason.setdefault(r["reason"], []).append(r["source_file"])
    assert any("part=" in f and "_07" in f for f in by_reason["record wider than header"])
    assert all("_01" in f or "_06" in f or "_11" in f for f in by_reason["missing columns: channel"])
    assert by_reason["file is empty"] and all(f.startswith("raw/empty/") for f in by_reason["file is empty"])


def test_replay_takes_the_whole_drop(spark):
    """Every file of the drop is replayed and shown."""
    from starfold.plans.registry import _replay_idempotence
    r = run_for(spark, SF_SMALL)
    files = r.drop.select("source_file").distinct()
    assert _same(_replay_idempotence(r).select("source_file"), files)

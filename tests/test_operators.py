"""Unit tests of the keyed-write operators, cleaning and their plans."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starfold.functions.cleaning import annotate
from starfold.operators.dedup import first_wins, last_wins
from starfold.operators.surrogate import assign_ids
from starfold.operators.upsert import insert_ignore, upsert


def _hot(spark, n=3000):
    # a third of all rows share one key
    rows = [("hot" if i % 3 == 0 else f"k{i}", i, f"v{i}") for i in range(n)]
    return spark.createDataFrame(rows, "key string, _arrival long, val string")


def test_first_and_last_wins_hot_key(spark):
    df = _hot(spark)
    first = {r["key"]: r["val"] for r in first_wins(df, ["key"]).collect()}
    last = {r["key"]: r["val"] for r in last_wins(df, ["key"]).collect()}
    assert first["hot"] == "v0" and last["hot"] == "v2997"
    assert len(first) == 2001 and first["k1"] == last["k1"] == "v1"


def test_dedup_aggregates_before_the_shuffle(spark):
    plan = first_wins(_hot(spark), ["key"])._jdf.queryExecution().executedPlan().toString()
    # partial (map-side) aggregate precedes the exchange: a hot key collapses
    # to one row per input partition before it is shuffled
    assert "partial_min_by" in plan or "partial_" in plan
    assert "Window" not in plan


def test_assign_ids_dense(spark):
    df = spark.range(0, 1000, 1, 7).withColumnRenamed("id", "k")
    out = assign_ids(df, "sid", base=41).collect()
    ids = sorted(r["sid"] for r in out)
    assert ids == list(range(42, 1042))


def test_upsert_policies(spark):
    now = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    cur = spark.createDataFrame(
        [(1, "a@x", "Ann", "N", dt.datetime(2020, 1, 1)), (2, "b@x", "Bob", "S", dt.datetime(2020, 1, 1))],
        "customer_id long, email string, customer_name string, region string, created_at timestamp")
    inc = spark.createDataFrame(
        [("b@x", "Bobby", "E", 1), ("c@x", "Cy", "W", 2), ("b@x", "Robert", "W", 3)],
        "email string, customer_name string, region string, _arrival long")
    out = {r["email"]: r for r in upsert(cur, inc, ["email"], ["customer_name", "region"],
                                         id_col="customer_id", now=now).collect()}
    assert out["a@x"]["customer_name"] == "Ann"
    assert out["b@x"]["customer_id"] == 2 and out["b@x"]["customer_name"] == "Robert"
    assert out["b@x"]["created_at"] == dt.datetime(2020, 1, 1)
    assert out["c@x"]["customer_id"] == 3


def test_insert_ignore(spark):
    cur = spark.createDataFrame([("o1",)], "order_id string")
    inc = spark.createDataFrame([("o1", 1, "x"), ("o2", 3, "late"), ("o2", 2, "early")],
                                "order_id string, _arrival long, v string")
    out = {r["order_id"]: r["v"] for r in insert_ignore(cur, inc, ["order_id"]).collect()}
    assert out == {"o2": "early"}


def test_unicode_trim_and_numbers(spark):
    cols = ["order_id", "sale_date", "customer_name", "customer_email", "region", "channel",
            "product_id", "product_name", "category", "quantity", "unit_price", "discount_pct",
            "total_amount"]
    rows = [("o1", "2024-01-01", "n", "e", " North ", "\x1cWest\x1f", "1.7", "p", "c",
             " 12 ", "1.005", "7.5", "1"),
            ("o2", "2024-01-01", None, None, "", "NA", "2", None, None, "inf", "1", "1", "1")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    df = df.withColumn("source_file", F.lit("f")).withColumn("_arrival", F.monotonically_increasing_id())
    out = {r["order_id"]: r for r in annotate(df).collect()}
    assert out["o1"]["region"] == "North" and out["o1"]["channel"] == "West"
    assert out["o1"]["product_id"] == 1 and out["o1"]["quantity"] == 12
    assert out["o1"]["unit_price"] == Decimal("1.01") and out["o1"]["discount"] == Decimal("7.50")
    assert out["o2"]["customer_name"] == "NaN" and out["o2"]["product_name"] == "NaN"
    assert out["o2"]["region"] == "Unknown" and out["o2"]["channel"] == "Unknown"
    assert out["o2"]["_err"] == "quantity is not finite"

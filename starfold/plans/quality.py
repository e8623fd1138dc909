"""Data-quality checks, each a small aggregate DataFrame, and their summary.

Checks are grouped aggregates or anti joins over the warehouse tables or
the staged batch; none collects rows to the driver.  ``dq_summary`` fans the
one-row checks into one table ``(check_name, observed, passed)``; raising on
a failed check is left to the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import NA_TOKENS
from ..sources.sales_drop import REQUIRED_COLUMNS, SPLIT_FILE
from .warehouse import Warehouse

# Domains of the sales model built on the driver tables
# (TPC-H region names and order priorities) plus the fill value.
REGION_DOMAIN = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown")
CHANNEL_DOMAIN = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "Unknown")
DATE_WINDOW = ("1990-01-01", "2029-12-31")
ORDER_ID_PATTERN = r"^[0-9]+-[0-9]+$"
REQUIRED_TABLES = ("fact_sales", "dim_products", "dim_customers", "pipeline_runs")
REQUIRED_VIEWS = ("mv_monthly_sales", "v_product_performance", "v_regional_performance")
MIN_SEEDED_PRODUCTS = 14


def _count_if(cond) -> F.Column:
    return F.count_if(cond).cast("long")


def _n(df: DataFrame):
    """Row count of ``df`` as a scalar subquery column."""
    return df.agg(F.count(F.lit(1))).scalar()


def dq_table_counts(wh: Warehouse) -> DataFrame:
    return wh.table("fact_sales").agg(F.count(F.lit(1)).alias("fact_sales")).select(
        "fact_sales",
        _n(wh.table("dim_customers")).alias("dim_customers"),
        _n(wh.table("dim_products")).alias("dim_products"),
        _n(wh.table("pipeline_runs").filter(F.col("status") == "success")).alias("success_runs"),
        _n(wh.table("mv_monthly_sales")).alias("mv_monthly_sales"))


def dq_null_order_ids(wh: Warehouse) -> DataFrame:
    return wh.table("fact_sales").agg(_count_if(F.col("order_id").isNull()).alias("null_order_ids"))


def dq_negative_amounts(wh: Warehouse) -> DataFrame:
    return wh.table("fact_sales").agg(_count_if(F.col("total_amount") < 0).alias("negative_amounts"))


def dq_orphan_customers(wh: Warehouse) -> DataFrame:
    orphans = wh.table("fact_sales").join(wh.table("dim_customers"), "customer_id", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_customers"))


def dq_orphan_products(wh: Warehouse) -> DataFrame:
    orphans = wh.table("fact_sales").join(wh.table("dim_products"), "product_id", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_products"))


def dq_duplicate_order_ids(wh: Warehouse) -> DataFrame:
    dup = wh.table("fact_sales").groupBy("order_id").count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicate_order_ids"))


def dq_null_counts(wh: Warehouse) -> DataFrame:
    f = wh.table("fact_sales")
    return f.agg(*[_count_if(F.col(c).isNull()).alias(f"null_{c}") for c in f.columns])


def dq_order_id_format(wh: Warehouse, pattern: str = ORDER_ID_PATTERN) -> DataFrame:
    ok = F.col("order_id").rlike(pattern)
    return wh.table("fact_sales").agg(_count_if(ok).alias("well_formed"), _count_if(~ok).alias("malformed"))


def dq_domain_violations(wh: Warehouse) -> DataFrame:
    f = wh.table("fact_sales")
    return f.agg(_count_if(~F.col("region").isin(*REGION_DOMAIN)).alias("bad_region"),
                 _count_if(~F.col("channel").isin(*CHANNEL_DOMAIN)).alias("bad_channel"))


def dq_range_violations(wh: Warehouse) -> DataFrame:
    f = wh.table("fact_sales")
    lo, hi = (F.lit(d).cast("date") for d in DATE_WINDOW)
    return f.agg(
        _count_if(F.col("quantity") <= 0).alias("nonpositive_quantity"),
        _count_if(F.col("unit_price") <= 0).alias("nonpositive_price"),
        _count_if(~F.col("discount").between(0, 100)).alias("discount_out_of_range"),
        _count_if(~F.col("sale_date").between(lo, hi)).alias("date_out_of_window"))


def dq_catalogue(wh: Warehouse) -> DataFrame:
    p = wh.table("dim_products")
    dup = p.groupBy("product_id").count().filter(F.col("count") > 1)
    return p.agg(F.count(F.lit(1)).alias("products"),
                 _count_if(F.col("unit_price") <= 0).alias("nonpositive_price"),
                 _count_if(F.col("category").isNull() | (F.col("category") == "NaN")).alias("missing_category")
                 ).select("*", _n(dup).alias("duplicate_ids"))


def dq_total_mismatch(accepted: DataFrame) -> DataFrame:
    """Records whose CSV total disagrees with the computed total by > 0.01."""
    bad = accepted.filter(F.abs(F.col("claimed_total") - F.col("total_amount")) > F.lit(0.01))
    return bad.select("order_id", "source_file",
                      F.col("claimed_total").cast("double").alias("claimed_total"),
                      F.col("total_amount").cast("double").alias("total_amount"))


def dq_cross_batch_overlap(accepted: DataFrame, split_file: str = SPLIT_FILE) -> DataFrame:
    """Order ids present in both the earlier and the later batch."""
    early = accepted.filter(F.col("source_file") < split_file).select("order_id")
    late = accepted.filter(F.col("source_file") >= split_file).select("order_id")
    return early.intersect(late)


def dq_summary(wh: Warehouse) -> DataFrame:
    """Every check as one row ``(check_name, observed, passed)``; the count
    checks are one-row aggregates in a single union, so the summary is one
    plan and nothing but the catalog listing runs on the driver.  Tables count
    when a commit names them, views when the catalog lists them."""
    spark = wh.spark
    present_tables = sum(1 for t in REQUIRED_TABLES if wh.exists(t))
    views = {t.name for t in spark.catalog.listTables()}
    present_views = sum(1 for v in REQUIRED_VIEWS if v in views)
    catalog = spark.createDataFrame(
        [("required_tables", present_tables, present_tables == len(REQUIRED_TABLES)),
         ("views_present", present_views, present_views == len(REQUIRED_VIEWS))],
        "check_name string, observed long, passed boolean")

    def check(name, df, ok):
        n = F.count(F.lit(1))
        return df.agg(F.lit(name).alias("check_name"), n.alias("observed"), ok(n).alias("passed"))

    checks = [
        catalog,
        check("products_seeded", wh.table("dim_products"), lambda n: n >= MIN_SEEDED_PRODUCTS),
        check("fact_rows", wh.table("fact_sales"), lambda n: n > 0),
        check("success_runs", wh.table("pipeline_runs").filter(F.col("status") == "success"), lambda n: n > 0),
        check("rollup_rows", wh.table("mv_monthly_sales"), lambda n: n > 0),
    ]
    zero_checks = [dq_null_order_ids(wh), dq_negative_amounts(wh), dq_orphan_customers(wh),
                   dq_orphan_products(wh), dq_duplicate_order_ids(wh)]
    for df in zero_checks:
        name = df.columns[0]
        checks.append(df.select(F.lit(name).alias("check_name"), F.col(name).cast("long").alias("observed"),
                                (F.col(name) == 0).alias("passed")))
    return reduce(DataFrame.unionByName, checks)


# ---- checks over the raw / typed drop --------------------------------------

def clean_na_tokens(raw: DataFrame) -> DataFrame:
    """How many values of each required column read as missing."""
    return raw.agg(*[_count_if(F.col(c).isNull() | F.col(c).isin(*NA_TOKENS)).alias(f"na_{c}")
                     for c in REQUIRED_COLUMNS])


def clean_drop_null_keys(annotated: DataFrame) -> DataFrame:
    return annotated.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_records"), _count_if("_c4").alias("n_kept"),
        _count_if(~F.col("_c4")).alias("n_dropped"))


def clean_bad_dates(annotated: DataFrame) -> DataFrame:
    return annotated.groupBy("source_file").agg(
        _count_if(F.col("_c4") & ~F.col("_c5")).alias("n_bad_dates"))


def clean_numeric_coercion(annotated: DataFrame) -> DataFrame:
    return annotated.filter("_c5").select(
        "source_file", "order_id", "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount").cast("double").alias("discount"))


def clean_trim_fill(annotated: DataFrame) -> DataFrame:
    return annotated.filter("_c5").groupBy("region", "channel").agg(F.count(F.lit(1)).alias("n"))


def clean_missing_email(accepted: DataFrame, wh: Warehouse, missing: str = "NaN") -> DataFrame:
    cust = wh.table("dim_customers").filter(F.col("email") == missing)
    return cust.select(
        _n(accepted.filter(F.col("email") == missing)).alias("missing_email_rows"),
        F.col("customer_name").alias("merged_customer_name"),
        F.col("region").alias("merged_customer_region"))

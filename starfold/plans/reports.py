"""Analytical views, the five saved BI questions and the dashboard panels.

Money sums are exact decimal sums exposed as DOUBLE; averages are exposed as
DOUBLE(sum) / count, so any engine computing the same multiset gets the
same bits.  Reports read the warehouse tables, so Catalyst prunes columns
and pushes month filters into the partitioned fact scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import CHANNEL_DOMAIN
from .warehouse import Warehouse, merged_customers


def money(c: Column | str) -> Column:
    return F.col(c).cast("double") if isinstance(c, str) else c.cast("double")


def avg_of(sum_col: Column, count_col: Column) -> Column:
    """AVG as DOUBLE(sum)/count; NULL for an empty group."""
    return F.when(count_col > 0, sum_col.cast("double") / count_col)


# ---- views ---------------------------------------------------------------

def v_product_performance(wh: Warehouse) -> DataFrame:
    """Every product, sold or not.  The fact is pre-aggregated per product
    (partial aggregate, one row per product) and the dimension is the
    preserved side of the outer join, so no raw fact row meets the join."""
    per_product = wh.table("fact_sales").groupBy("product_id").agg(
        F.count("sale_id").alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("total_amount").alias("_rev"),
        F.sum("unit_price").alias("_price_sum"), F.count("unit_price").alias("_price_n"),
        F.sum("discount").alias("_disc_sum"), F.count("discount").alias("_disc_n"))
    joined = wh.table("dim_products").join(per_product, "product_id", "left")
    return joined.select(
        "product_id", "product_name", "category",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.col("total_units_sold").cast("long").alias("total_units_sold"),
        money("_rev").alias("total_revenue"),
        avg_of(F.col("_price_sum"), F.col("_price_n")).alias("avg_selling_price"),
        avg_of(F.col("_disc_sum"), F.col("_disc_n")).alias("avg_discount_pct"))


def _customers_and_sums(wh: Warehouse, *keys: str) -> DataFrame:
    """(keys, unique_customers, total_orders, _rev, _n_amount) from the stored cube
    and bitmaps of customers, which every batch brings up to date; no fact is
    read.  Both sides are reduced and then united, so a null key needs no join."""
    none = F.lit(0).cast("long")
    people = merged_customers(wh.table("month_customers"), *keys).groupBy(*keys).agg(
        F.sum(F.bitmap_count("bits")).alias("unique_customers"))
    sums = wh.table("sales_cube").groupBy(*keys).agg(
        F.sum("n").alias("total_orders"), F.sum("revenue").alias("_rev"), F.sum("n_amount").alias("_n_amount"))
    both = people.select(*keys, "unique_customers", none.alias("total_orders"), F.lit(None).alias("_rev"), none.alias("_n_amount")).unionByName(
        sums.select(*keys, none.alias("unique_customers"), "total_orders", "_rev", "_n_amount"))
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("unique_customers", "total_orders", "_rev", "_n_amount")])


def v_regional_performance(wh: Warehouse) -> DataFrame:
    return _customers_and_sums(wh, "region").select(
        "region", "unique_customers", "total_orders", money("_rev").alias("total_revenue"),
        avg_of(F.col("_rev"), F.col("_n_amount")).alias("avg_order_value"))


def mv_monthly_sales(wh: Warehouse) -> DataFrame:
    return wh.table("mv_monthly_sales").select(
        "month", "region", "channel", "category", "total_orders", "total_units",
        money("total_revenue").alias("total_revenue"),
        avg_of(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"))


def register_views(wh: Warehouse) -> None:
    """Live views (recomputed on every read) next to the stored rollup."""
    spark = wh.spark
    for name in ("fact_sales", "dim_products", "dim_customers", "pipeline_runs", "mv_monthly_sales"):
        wh.table(name).createOrReplaceTempView(name)
    v_product_performance(wh).drop("product_id").createOrReplaceTempView("v_product_performance")
    v_regional_performance(wh).createOrReplaceTempView("v_regional_performance")
    spark.catalog.listTables()  # resolve now so a missing table fails early


# ---- saved BI questions ------------------------------------------------------

def bi_monthly_revenue_trend(wh: Warehouse) -> DataFrame:
    return (wh.table("mv_monthly_sales").groupBy("month")
            .agg(money(F.sum("total_revenue")).alias("revenue"))
            .orderBy(F.col("month").asc_nulls_last()))


def bi_revenue_by_region(wh: Warehouse) -> DataFrame:
    return (v_regional_performance(wh).select("region", "total_revenue", "unique_customers")
            .orderBy(F.col("total_revenue").desc_nulls_first()))


def bi_top10_products(wh: Warehouse, sold_only: bool = False) -> DataFrame:
    """Top 10 by revenue; unsold products (NULL revenue) sort first, as a
    DESC sort does in the original database.  ``sold_only`` drops them."""
    v = v_product_performance(wh)
    if sold_only:
        v = v.filter(F.col("total_revenue").isNotNull())
    return (v.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc())
            .limit(10).select("product_name", "category", "total_revenue", "total_units_sold"))


def bi_sales_channel_breakdown(wh: Warehouse) -> DataFrame:
    return (wh.table("fact_sales").groupBy("channel")
            .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("total_amount")).alias("revenue"))
            .orderBy(F.col("revenue").desc_nulls_first()))


def bi_category_revenue_by_month(wh: Warehouse) -> DataFrame:
    return (wh.table("mv_monthly_sales").groupBy("month", "category")
            .agg(money(F.sum("total_revenue")).alias("revenue"))
            .orderBy(F.col("month").asc_nulls_last(), F.col("revenue").desc_nulls_first()))


# ---- dashboard panels ------------------------------------------------------

def _orders_revenue(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("orders"),
                                 money(F.sum("total_amount")).alias("revenue"))


def dash_kpis(wh: Warehouse) -> DataFrame:
    return _customers_and_sums(wh).select(
        money("_rev").alias("total_revenue"), F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("unique_customers", F.lit(0)).alias("total_customers"))


def dash_region_monthly_customers(wh: Warehouse) -> DataFrame:
    """Customers of each month and region, and how many of a region's customers that is."""
    bitmaps = wh.table("month_customers")
    monthly = bitmaps.groupBy("month", "region").agg(F.sum(F.bitmap_count("bits")).alias("customers"))
    total = merged_customers(bitmaps, "region").groupBy("region").agg(F.sum(F.bitmap_count("bits")).alias("region_customers"))
    joined = monthly.join(total, monthly["region"].eqNullSafe(total["region"])).select("month", monthly["region"], "customers", "region_customers")
    return joined.orderBy("month", "region")


def dash_order_volume(wh: Warehouse) -> DataFrame:
    return (wh.table("fact_sales").groupBy(F.col("sale_month").alias("month"))
            .agg(F.count(F.lit(1)).alias("orders")).orderBy("month"))


def dash_quarterly(wh: Warehouse) -> DataFrame:
    f = wh.table("fact_sales").withColumn("quarter", F.trunc("sale_month", "quarter"))
    return _orders_revenue(f, "quarter").orderBy("quarter")


def dash_category_breakdown(wh: Warehouse) -> DataFrame:
    per_product = _orders_revenue_units(wh.table("fact_sales"), "product_id")
    j = per_product.join(wh.table("dim_products").select("product_id", "category"), "product_id")
    return (j.groupBy("category").agg(F.sum("orders").alias("orders"), F.sum("units").alias("units"),
                                      money(F.sum("_rev")).alias("revenue"))
            .orderBy(F.col("revenue").desc_nulls_first()))


def _orders_revenue_units(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("orders"),
                                 F.sum("quantity").cast("long").alias("units"),
                                 F.sum("total_amount").alias("_rev"))


def dash_discount_impact(wh: Warehouse) -> DataFrame:
    return (wh.table("fact_sales").groupBy(money("discount").alias("discount"))
            .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("total_amount")).alias("revenue"),
                 avg_of(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"))
            .orderBy("discount"))


def dash_region_channel(wh: Warehouse) -> DataFrame:
    return _orders_revenue(wh.table("fact_sales"), "region", "channel").orderBy("region", "channel")


def dash_region_channel_pivot(wh: Warehouse) -> DataFrame:
    """Revenue with a row for each region and a column for each channel of the model; others together."""
    in_domain = F.coalesce(F.col("channel").isin(*CHANNEL_DOMAIN), F.lit(False))
    cells = [money(F.sum(F.when(F.col("channel") == c, F.col("revenue")))).alias(f"channel_{i}") for i, c in enumerate(CHANNEL_DOMAIN, 1)]
    return (wh.table("sales_cube").groupBy("region")
            .agg(*cells, money(F.sum(F.when(~in_domain, F.col("revenue")))).alias("channel_other")).orderBy("region"))


def dash_region_monthly(wh: Warehouse) -> DataFrame:
    f = wh.table("fact_sales").withColumnRenamed("sale_month", "month")
    return _orders_revenue(f, "month", "region").orderBy("month", "region")


def dash_region_quarterly(wh: Warehouse) -> DataFrame:
    f = wh.table("fact_sales").withColumn("quarter", F.trunc("sale_month", "quarter"))
    return _orders_revenue(f, "quarter", "region").orderBy("quarter", "region")


def dash_freshness(wh: Warehouse) -> DataFrame:
    latest_month = wh.table("mv_monthly_sales").agg(F.max("month")).scalar()
    return wh.table("fact_sales").agg(F.max("sale_date").alias("latest_sale_date")).select(
        "latest_sale_date", latest_month.alias("latest_rollup_month"))


def dash_error_monitor(wh: Warehouse) -> DataFrame:
    return (wh.table("pipeline_runs").groupBy("status")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("rows_loaded").cast("long").alias("rows_loaded")))


def dash_error_files(wh: Warehouse) -> DataFrame:
    """Files that weren't loaded, each with the message of its last run."""
    failed = wh.table("pipeline_runs").where(F.col("status") != "success")
    return (failed.groupBy("source_file").agg(F.max_by("error_message", "run_id").alias("error_message"), F.max_by("status", "run_id").alias("status"))
            .select("source_file", "status", "error_message"))


def dash_run_history(wh: Warehouse) -> DataFrame:
    return wh.table("pipeline_runs").orderBy(F.col("run_date").desc(), F.col("run_id").desc())


def rows_loaded_per_file(wh: Warehouse) -> DataFrame:
    return (wh.table("pipeline_runs").groupBy("source_file")
            .agg(F.sum("rows_loaded").cast("long").alias("rows_loaded")))


def sales_core(wh: Warehouse) -> DataFrame:
    """The wide star model: fact + both dimensions (natural keys only)."""
    c = wh.table("dim_customers").select("customer_id", "customer_name", "email",
                                         F.col("region").alias("customer_region"))
    p = wh.table("dim_products").select("product_id", "product_name", "category")
    f = wh.table("fact_sales")
    return (f.join(c, "customer_id").join(p, "product_id")
            .select("order_id", "sale_date", "customer_name", "email", "customer_region",
                    "product_name", "category", "quantity", money("total_amount").alias("total_amount"),
                    "region", "channel"))

"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver tables through the derived sales drop, so its
work grows with the data.  Output columns are named exactly like the SQL
oracle's (``starfold.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ledger, quality, reports
from .context import Run, run_for
from .warehouse import monthly_rollup, seed_frame

Query = Callable[[SparkSession, str], DataFrame]


def _on(fn: Callable[[Run], DataFrame]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(run_for(spark, sf_dir))
    q.__name__ = getattr(fn, "__name__", "query")
    q.__doc__ = fn.__doc__
    return q


def _wh(fn) -> Query:
    return _on(lambda r: fn(r.wh))


def _money(c: str):
    return F.col(c).cast("double").alias(c)


# ---- queries over the two-run warehouse (current + incoming) --------------

def _insert_ignore_fact_sales(r: Run) -> DataFrame:
    wh, _ = r.two
    return wh.table("fact_sales").select(
        "order_id", "sale_date", "product_id", "quantity", _money("unit_price"), _money("discount"),
        _money("total_amount"), "region", "channel", "source_file")


def _upsert_dim_customers(r: Run) -> DataFrame:
    wh, _ = r.two
    return wh.table("dim_customers").select("email", "customer_name", "region")


def _upsert_dim_products(r: Run) -> DataFrame:
    wh, _ = r.two
    return wh.table("dim_products").select("product_id", "product_name", "category", _money("unit_price"))


def _mv_refresh_incremental(r: Run) -> DataFrame:
    wh, _ = r.two
    return reports.mv_monthly_sales(wh)


def _mv_refresh_full(r: Run) -> DataFrame:
    wh, _ = r.two
    mv = monthly_rollup(wh.table("fact_sales"), wh.table("dim_products"))
    return mv.select("month", "region", "channel", "category", "total_orders", "total_units",
                     _money("total_revenue"),
                     reports.avg_of(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"))


def _replay_idempotence(r: Run) -> DataFrame:
    return r.replay.runs.select("source_file", "status", "rows_loaded")


# ---- queries over the one-run warehouse ----------------------------------

def _seed_products(r: Run) -> DataFrame:
    seed = seed_frame(r.spark).select(
        "product_id", F.col("product_name").alias("seed_name"), F.col("category").alias("seed_category"),
        F.col("unit_price").cast("double").alias("seed_price"))
    cur = r.wh.table("dim_products").select(
        "product_id", F.col("product_name").alias("current_name"),
        F.col("category").alias("current_category"), F.col("unit_price").cast("double").alias("current_price"))
    j = seed.join(cur, "product_id", "left")
    return j.withColumn("overwritten", ~(F.col("current_name").eqNullSafe(F.col("seed_name"))
                                         & F.col("current_category").eqNullSafe(F.col("seed_category"))
                                         & F.col("current_price").eqNullSafe(F.col("seed_price"))))


def _resolve_customer_id(r: Run) -> DataFrame:
    c = r.wh.table("dim_customers").select("customer_id", "email", "customer_name")
    return r.wh.table("fact_sales").join(c, "customer_id").select("order_id", "email", "customer_name")


def _source_file_lineage(r: Run) -> DataFrame:
    return r.wh.table("fact_sales").groupBy("source_file", "sale_month").agg(F.count(F.lit(1)).alias("facts"))


def _generated_total_amount(r: Run) -> DataFrame:
    return r.wh.table("fact_sales").select("order_id", "quantity", _money("unit_price"), _money("discount"),
                                           _money("total_amount"))


def _fact_projection(r: Run) -> DataFrame:
    return r.report.accepted.select("order_id", "email", _money("discount"), "source_file")


def _file_atomic_load(r: Run) -> DataFrame:
    return r.report.verdicts.select("source_file", "status", "n_records", "n_candidates")


def _unprocessed_files(r: Run) -> DataFrame:
    return ledger.unprocessed_files(r.drop, r.wh)


QUERIES: dict[str, Query] = {
    # rollup and reports
    "mv_monthly_sales": _wh(reports.mv_monthly_sales),
    "mv_refresh_full": _on(_mv_refresh_full),
    "mv_refresh_incremental": _on(_mv_refresh_incremental),
    "v_product_performance": _wh(lambda wh: reports.v_product_performance(wh).drop("product_id")),
    "v_regional_performance": _wh(reports.v_regional_performance),
    "bi_monthly_revenue_trend": _wh(reports.bi_monthly_revenue_trend),
    "bi_revenue_by_region": _wh(reports.bi_revenue_by_region),
    "bi_top10_products": _wh(reports.bi_top10_products),
    "bi_top10_products_sold": _wh(lambda wh: reports.bi_top10_products(wh, sold_only=True)),
    "bi_sales_channel_breakdown": _wh(reports.bi_sales_channel_breakdown),
    "bi_category_revenue_by_month": _wh(reports.bi_category_revenue_by_month),
    "dash_kpis": _wh(reports.dash_kpis),
    "dash_order_volume": _wh(reports.dash_order_volume),
    "dash_quarterly": _wh(reports.dash_quarterly),
    "dash_category_breakdown": _wh(reports.dash_category_breakdown),
    "dash_discount_impact": _wh(reports.dash_discount_impact),
    "dash_region_channel": _wh(reports.dash_region_channel),
    "dash_region_channel_pivot": _wh(reports.dash_region_channel_pivot),
    "dash_region_monthly_customers": _wh(reports.dash_region_monthly_customers),
    "dash_error_files": _wh(reports.dash_error_files),
    "dash_region_monthly": _wh(reports.dash_region_monthly),
    "dash_region_quarterly": _wh(reports.dash_region_quarterly),
    "dash_freshness": _wh(reports.dash_freshness),
    "dash_error_monitor": _wh(reports.dash_error_monitor),
    "sales_core": _wh(reports.sales_core),
    "rows_loaded_per_file": _wh(reports.rows_loaded_per_file),
    # load semantics
    "insert_ignore_fact_sales": _on(_insert_ignore_fact_sales),
    "upsert_dim_customers": _on(_upsert_dim_customers),
    "upsert_dim_products": _on(_upsert_dim_products),
    "replay_idempotence": _on(_replay_idempotence),
    "seed_products": _on(_seed_products),
    "resolve_customer_id": _on(_resolve_customer_id),
    "surrogate_keys": _wh(ledger.surrogate_keys),
    "source_file_lineage": _on(_source_file_lineage),
    "generated_total_amount": _on(_generated_total_amount),
    "fact_projection": _on(_fact_projection),
    "file_atomic_load": _on(_file_atomic_load),
    "pipeline_runs_log": _wh(ledger.pipeline_runs_log),
    "runs_success_count": _wh(ledger.runs_success_count),
    "refresh_needed": _on(lambda r: ledger.refresh_needed(r.wh.table("pipeline_runs"))),
    "archive_plan": _on(lambda r: ledger.archive_plan(r.report.verdicts)),
    "unprocessed_files": _on(_unprocessed_files),
    # cleaning
    "clean_na_tokens": _on(lambda r: quality.clean_na_tokens(r.drop)),
    "clean_drop_null_keys": _on(lambda r: quality.clean_drop_null_keys(r.report.annotated)),
    "clean_bad_dates": _on(lambda r: quality.clean_bad_dates(r.report.annotated)),
    "clean_numeric_coercion": _on(lambda r: quality.clean_numeric_coercion(r.report.annotated)),
    "clean_trim_fill": _on(lambda r: quality.clean_trim_fill(r.report.annotated)),
    "clean_missing_email": _on(lambda r: quality.clean_missing_email(r.report.accepted, r.wh)),
    # data quality
    "dq_table_counts": _wh(quality.dq_table_counts),
    "dq_null_order_ids": _wh(quality.dq_null_order_ids),
    "dq_negative_amounts": _wh(quality.dq_negative_amounts),
    "dq_orphan_customers": _wh(quality.dq_orphan_customers),
    "dq_orphan_products": _wh(quality.dq_orphan_products),
    "dq_duplicate_order_ids": _wh(quality.dq_duplicate_order_ids),
    "dq_null_counts": _wh(quality.dq_null_counts),
    "dq_order_id_format": _wh(quality.dq_order_id_format),
    "dq_domain_violations": _wh(quality.dq_domain_violations),
    "dq_range_violations": _wh(quality.dq_range_violations),
    "dq_catalogue": _wh(quality.dq_catalogue),
    "dq_total_mismatch": _on(lambda r: quality.dq_total_mismatch(r.report.accepted)),
    "dq_cross_batch_overlap": _on(lambda r: quality.dq_cross_batch_overlap(r.report.accepted)),
    "dq_summary": _wh(quality.dq_summary),
}

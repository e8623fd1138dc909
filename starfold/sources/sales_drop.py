"""The raw sales drop, derived from the driver tables.

A drop is what arrives as CSV text: the 13 required columns, all strings,
plus ``source_file`` and an ``_arrival`` struct that orders records the way
a file listing followed by a record-by-record read would.  Here each
lineitem row is one sales record and each ship month one file.

A deterministic share of the values is dirtied so that the cleaning rules
are exercised on every run; the independent SQL oracle applies the same rule
table.  Every row is kept - dirt changes values, it never filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

REQUIRED_COLUMNS = (
    "order_id", "sale_date", "customer_name", "customer_email", "region",
    "channel", "product_id", "product_name", "category", "quantity",
    "unit_price", "discount_pct", "total_amount",
)

# Fixed dirt rules, keyed on the order key k (and line number n); the first
# matching rule of a column wins.  The oracle SQL states the same table.
#   order_id      k % 101 = 7                 -> 'None'        (row dropped)
#   sale_date     k % 89 = 3                  -> 'not-a-date'  (row dropped)
#                 k % 97 = 5                  -> ''            (row dropped)
#   customer_email k % 83 = 11                -> ''            ('NaN' customer)
#   region        k % 79 = 13                 -> 'NA'          ('Unknown')
#                 k % 5 = 0                   -> '  <region> ' (trimmed)
#   channel       k % 73 = 17                 -> 'null'        ('Unknown')
#   product_id    k % 12007 = 1 and n = 7     -> 'abc'         (whole file fails)
#   quantity      k % 17 = 0                  -> 'abc'         (1)
#                 k % 19 = 0                  -> ''            (1)
#                 k % 23 = 0                  -> '<q>.7'       (q)
#   unit_price    k % 41 = 0                  -> 'x'           (0)
#   discount_pct  k % 43 = 0                  -> ''            (0)
#   total_amount  k % 61 = 0                  -> true total + 1 (mismatch)


def _rule(*cases, default: Column) -> Column:
    out = None
    for cond, val in cases:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default)


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region name.  nation (25 rows) and region (5 rows) are
    fixed-size by the TPC-H specification, so broadcasting them is bounded."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")


def derive_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lineitem rows as raw sales records (strings) with lineage."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Equi-joins on the TPC-H keys; AQE turns any side that proves small at
    # runtime into a broadcast and keeps sort-merge joins otherwise.  Customers meet
    # the orders, of which there are fewer, and the line items are dealt by order and by part only.  Parts come last of
    # the two: the rows of a part then lie together, and its texts are told once.
    buyers = orders.join(cust, F.col("o_custkey") == cust.c_custkey).select("o_orderkey", "o_orderpriority", "c_name")
    rows = (li.join(buyers, li.l_orderkey == F.col("o_orderkey"))
              .join(part, li.l_partkey == part.p_partkey)
              .join(supplier, li.l_suppkey == F.col("s_suppkey"))
              .join(F.broadcast(nation_regions(spark, sf_dir)), F.col("s_nationkey") == F.col("n_nationkey")))

    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int")
    q_dec = qty.cast("decimal(10,0)")
    p_dec = F.col("l_extendedprice").cast("decimal(10,2)")
    d_dec = F.round(F.col("l_discount") * 100).cast("decimal(5,2)")
    true_total = (q_dec * p_dec * (F.lit(100) - d_dec) * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(12,2)")
    region = F.col("r_name")
    source_file = F.concat(F.lit("raw/sales_"), F.date_format("l_shipdate", "yyyy_MM"), F.lit(".csv"))

    return rows.select(
        _rule((k % 101 == 7, F.lit("None")),
              default=F.concat_ws("-", k.cast("string"), n.cast("string"))).alias("order_id"),
        _rule((k % 89 == 3, F.lit("not-a-date")), (k % 97 == 5, F.lit("")),
              default=F.col("l_shipdate").cast("date").cast("string")).alias("sale_date"),
        F.col("c_name").alias("customer_name"),
        _rule((k % 83 == 11, F.lit("")),
              default=F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("customer_email"),
        _rule((k % 79 == 13, F.lit("NA")), (k % 5 == 0, F.concat(F.lit("  "), region, F.lit(" "))),
              default=region).alias("region"),
        _rule((k % 73 == 17, F.lit("null")), default=F.col("o_orderpriority")).alias("channel"),
        _rule(((k % 12007 == 1) & (n == 7), F.lit("abc")),
              default=F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        _rule((k % 17 == 0, F.lit("abc")), (k % 19 == 0, F.lit("")),
              (k % 23 == 0, F.concat(qty.cast("string"), F.lit(".7"))),
              default=qty.cast("string")).alias("quantity"),
        _rule((k % 41 == 0, F.lit("x")), default=p_dec.cast("string")).alias("unit_price"),
        _rule((k % 43 == 0, F.lit("")), default=d_dec.cast("int").cast("string")).alias("discount_pct"),
        _rule((k % 61 == 0, (true_total + F.lit(1)).cast("decimal(12,2)").cast("string")),
              default=true_total.cast("string")).alias("total_amount"),
        source_file.alias("source_file"),
        F.struct(source_file.alias("file"), F.col("l_shipdate").alias("shipdate"),
                 k.alias("orderkey"), n.alias("linenumber"),
                 F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey")
                 ).alias("_arrival"),
    )


# Files listed before this name are "already loaded" in the two-run checks.
SPLIT_FILE = "raw/sales_1998_07.csv"


def split_drop(drop: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(earlier files, later files) of a drop, by listing order."""
    return (drop.filter(F.col("source_file") < SPLIT_FILE),
            drop.filter(F.col("source_file") >= SPLIT_FILE))

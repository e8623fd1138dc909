"""A hot key holding a third of all rows, and the number parser's language."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starfold.functions.cleaning import NUMBER_PATTERN, to_number
from starfold.plans.warehouse import Warehouse
from starfold.sources.sales_drop import derive_drop


def test_hot_email_third_of_rows(spark):
    drop = derive_drop(spark, SF_SMALL)
    # one third of all records lose their e-mail -> one hot customer key
    hot = drop.withColumn("customer_email",
                          F.when(F.col("_arrival.orderkey") % 3 == 0, F.lit("")).otherwise(F.col("customer_email")))
    wh = Warehouse.create(spark)
    rep = wh.load(hot, refresh="full")
    cust = wh.table("dim_customers")
    assert cust.filter(F.col("email") == "NaN").count() == 1
    n_hot = rep.accepted.filter(F.col("email") == "NaN").count()
    assert n_hot > rep.accepted.count() / 4
    facts = wh.table("fact_sales")
    # every fact resolved to a customer, none duplicated
    assert facts.filter(F.col("customer_id").isNull()).count() == 0
    assert facts.count() == facts.select("order_id").distinct().count()
    nan_id = cust.filter(F.col("email") == "NaN").first()["customer_id"]
    assert facts.filter(F.col("customer_id") == nan_id).count() > 0


TEXTS = st.one_of(
    st.from_regex(r"\A[ ]?[+-]?[0-9]{0,4}(\.[0-9]{0,3})?([eE][+-]?[0-9]{1,2})?[ ]?\Z"),
    st.sampled_from(["inf", "-Infinity", "INF", "1d", "1f", "0x1p3", "1_0", "abc", "", " ", ".", "e5",
                     "+-1", "1e", "NAN", "3d", "2.7", "-2.7", "1e2", "12 3"]),
)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=30))
def test_to_number_language(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["n"] for r in df.select(to_number(F.col("s")).alias("n")).collect()]
    for t, n in zip(texts, got):
        if re.match(NUMBER_PATTERN, t):
            assert n is not None and n == float(t.strip()), (t, n)
        else:
            assert n is None, (t, n)

"""Row-level cleaning as built-in column expressions (whole-stage codegen).

``annotate`` turns a raw drop (string columns) into typed columns plus the
flags that later decide, per file, whether the file is accepted:

* ``_c4``   the record survives the null-key drop (order_id, sale_date,
            product_id present after NA-token mapping);
* ``_c5``   it also has a parseable sale_date, so it would be loaded;
* ``_err``  the first load error of the record (NULL when clean).  Any
            error in a file rejects the whole file.

No Python UDF is involved; every rule below is a JVM expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------
# Text read as missing (the default NA-token set of a pandas CSV read).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Text stored for a missing name / e-mail / product name / category.
MISSING_TEXT = "NaN"
# Fill for a missing region or channel.
UNKNOWN = "Unknown"
# Defaults for unparseable numbers.
DEFAULT_QUANTITY = 1
# Dates representable by the reference's timestamp type.
MIN_DATE, MAX_DATE = "1677-09-22", "2262-04-11"
# Column length limits of the warehouse (VARCHAR(n)).
TEXT_LIMITS = (
    ("order_id", 50), ("customer_name", 255), ("email", 255), ("region", 100),
    ("channel", 50), ("product_name", 255), ("category", 100), ("source_file", 255),
)
INT32_MIN, INT32_MAX = -(2 ** 31), 2 ** 31 - 1
# A number as a CSV reader recognises it: decimal or exponent form, or infinity.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
# Characters str.strip() removes: ASCII blanks, the four separator
# controls, and the Unicode space characters.
STRIP_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
               "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
# -------------------------------------------------------------------------


def na(c: Column) -> Column:
    """NA tokens -> NULL (exact match, no trimming, as on read)."""
    return F.when(~c.isin(*NA_TOKENS), c)


def strip_text(c: Column) -> Column:
    return F.trim(c, F.lit(STRIP_CHARS))


PLAIN_NUMBER = r"\A[0-9.+eE-]*+\z"
INFINITY_WORDS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def to_number(c: Column) -> Column:
    """double, or NULL when the text is not a number (the same language as
    ``NUMBER_PATTERN``).  Spark's cast also takes forms a CSV reader does not
    (``1d``, ``1f``, hex), so the cast result is kept only for text made of
    number characters, or for an infinity word."""
    return stripped_number(strip_text(c))


def stripped_number(t: Column) -> Column:
    """``to_number`` of text that is stripped already."""
    plain = t.rlike(PLAIN_NUMBER)
    return F.when(plain | F.lower(t).isin(*INFINITY_WORDS), t.try_cast("double"))


def to_fixed(c: Column, precision: int, scale: int) -> tuple[Column, Column]:
    """(value, overflow flag) of a numeric text as DECIMAL(p,s); unparseable
    or missing text gives 0, a number that does not fit flags overflow."""
    num = to_number(c)
    dec = strip_text(c).try_cast(f"decimal({precision},{scale})")
    value = F.when(num.isNull(), F.lit(0).cast(f"decimal({precision},{scale})")).otherwise(dec)
    return value, num.isNotNull() & dec.isNull()


def is_infinite(c: Column) -> Column:
    return F.coalesce(F.abs(c) == F.lit(float("inf")), F.lit(False))


def total_amount(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """quantity * unit_price * (1 - discount/100) in exact decimal arithmetic,
    rounded half-up once to DECIMAL(12,2); NULL on overflow."""
    exact = (quantity.cast("decimal(10,0)") * unit_price
             * (F.lit(100) - discount) * F.lit(0.01).cast("decimal(2,2)"))
    return exact.try_cast("decimal(12,2)")


def representable(d: Column) -> Column:
    """The date, or NULL outside the reference's timestamp type.  Reads its date more than once: a column, not a parse."""
    return F.when(d.between(F.lit(MIN_DATE).cast("date"), F.lit(MAX_DATE).cast("date")), d)


# Forms of a date that a file may use; the file's first date decides, the
# earlier form first where several fit.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "yyyyMMdd",
                "MM/dd/yyyy", "dd/MM/yyyy", "MM-dd-yyyy", "dd.MM.yyyy", "d MMM yyyy", "MMM d, yyyy")


def date_format_of(first: Column) -> Column:
    """The form of DATE_FORMATS that a file's first date has; ISO if none fits."""
    out = F.lit(DATE_FORMATS[0])
    for fmt in reversed(DATE_FORMATS):
        out = F.when(F.try_to_timestamp(first, F.lit(fmt)).isNotNull(), F.lit(fmt)).otherwise(out)
    return out


def parse_by_format(c: Column, fmt: Column) -> Column:
    """Dates of files with different forms: each row by the form of its file."""
    out = F.lit(None).cast("date")
    for known in reversed(DATE_FORMATS):
        out = F.when(fmt == known, F.try_to_date(c, known)).otherwise(out)
    return out


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    out = None
    for cond, msg in checks:
        out = F.when(cond, F.lit(msg)) if out is None else out.when(cond, F.lit(msg))
    return out


def annotate(raw: DataFrame, date_format: str = "yyyy-MM-dd",
             missing_text: str | None = MISSING_TEXT) -> DataFrame:
    """Typed record + drop flags + error code, one output row per input row.

    Built as a few stacked projections so that every costly value (NA
    mapping, number parse, date parse) is computed once per row and later
    steps refer to it by name; Catalyst does not inline a non-trivial
    expression into several consumers, so the stages stay separate and each
    stays small enough for whole-stage codegen.  A drop with a
    ``_date_format`` column (one form per file) is read by it, else all dates
    by ``date_format``.
    """
    text_cols = ("order_id", "sale_date", "customer_name", "customer_email", "region",
                 "channel", "product_id", "product_name", "category", "quantity",
                 "unit_price", "discount_pct", "total_amount")
    by_file = "_date_format" in raw.columns
    fill = (lambda c: F.coalesce(c, F.lit(missing_text))) if missing_text is not None else (lambda c: c)
    col = F.col

    # 1. NA tokens -> NULL, once per column
    st = raw.select(*[na(col(c)).alias(f"{c}_s") for c in text_cols], "source_file", "_arrival",
                    *(["_date_format"] if by_file else []))

    # 2. parses, once per column
    numeric = ("quantity", "product_id", "unit_price", "discount_pct", "total_amount", "region", "channel")
    st = st.select("*", *[strip_text(col(f"{c}_s")).alias(f"{c}_t") for c in numeric])
    st = st.select(
        "*",
        *[stripped_number(col(f"{c}_t")).alias(f"{c}_n") for c in numeric],
        col("unit_price_t").try_cast("decimal(10,2)").alias("_price_dec"),
        col("discount_pct_t").try_cast("decimal(5,2)").alias("_disc_dec"),
        col("total_amount_t").try_cast("decimal(12,2)").alias("_total_dec"),
        (parse_by_format(col("sale_date_s"), col("_date_format")) if by_file
         else F.try_to_date(col("sale_date_s"), date_format)).alias("sale_date"),
    ).withColumn("sale_date", representable(col("sale_date")))

    # 3. typed values and row flags
    qty_long = F.coalesce(col("quantity_n"), F.lit(float(DEFAULT_QUANTITY))).try_cast("long")
    pid_long = col("product_id_n").try_cast("long")
    zero = lambda p, sc: F.lit(0).cast(f"decimal({p},{sc})")
    st = st.select(
        col("order_id_s").alias("order_id"), "sale_date",
        fill(col("customer_name_s")).alias("customer_name"),
        fill(col("customer_email_s")).alias("email"),
        F.coalesce(col("region_t"), F.lit(UNKNOWN)).alias("region"),
        F.coalesce(col("channel_t"), F.lit(UNKNOWN)).alias("channel"),
        pid_long.alias("_pid_long"),
        fill(col("product_name_s")).alias("product_name"),
        fill(col("category_s")).alias("category"),
        qty_long.alias("_qty_long"),
        F.when(col("unit_price_n").isNull(), zero(10, 2)).otherwise(col("_price_dec")).alias("unit_price"),
        F.when(col("discount_pct_n").isNull(), zero(5, 2)).otherwise(col("_disc_dec")).alias("discount"),
        F.when(col("total_amount_s").isNull(), F.lit(None).cast("decimal(12,2)"))
         .when(col("total_amount_n").isNull(), zero(12, 2))
         .otherwise(col("_total_dec")).alias("claimed_total"),
        "source_file", "_arrival",
        (col("order_id_s").isNotNull() & col("sale_date_s").isNotNull()
         & col("product_id_s").isNotNull()).alias("_c4"),
        is_infinite(col("quantity_n")).alias("_qty_inf"),
        (col("product_id_s").isNotNull() & col("product_id_n").isNull()).alias("_pid_text"),
        (col("product_id_n").isNotNull()
         & ~col("product_id_t").rlike(r"\A[0-9+-]*+\z")
         ).alias("_pid_fraction"),
        (col("unit_price_n").isNotNull() & col("_price_dec").isNull()).alias("_price_over"),
        (col("discount_pct_n").isNotNull() & col("_disc_dec").isNull()).alias("_disc_over"),
        (col("region_s").isNull() | col("region_n").isNotNull()).alias("_region_untyped"),
        (col("channel_s").isNull() | col("channel_n").isNotNull()).alias("_channel_untyped"),
    )
    in_int = lambda c: F.coalesce(c.between(INT32_MIN, INT32_MAX), F.lit(False))
    st = st.select(
        "*",
        F.when(in_int(col("_pid_long")), col("_pid_long").cast("int")).alias("product_id"),
        F.when(in_int(col("_qty_long")), col("_qty_long").cast("int")).alias("quantity"),
        (~in_int(col("_qty_long"))).alias("_qty_bad"),
        (~in_int(col("_pid_long"))).alias("_pid_bad"),
        (col("_c4") & col("sale_date").isNotNull()).alias("_c5"),
    ).drop("_pid_long", "_qty_long")

    # 4. the computed total, then the first load error
    st = st.withColumn("total_amount", total_amount(col("quantity"), col("unit_price"), col("discount")))
    load_checks = [
        (col("_pid_text"), "product_id is not a number"),
        (col("_pid_bad"), "product_id out of integer range"),
        (col("_qty_bad"), "quantity out of integer range"),
        (col("_price_over"), "unit_price overflows numeric(10,2)"),
        (col("_disc_over"), "discount overflows numeric(5,2)"),
        (col("total_amount").isNull(), "total_amount overflows numeric(12,2)"),
    ] + [(F.length(col(c)) > n, f"{c} longer than {n}") for c, n in TEXT_LIMITS]
    err = (F.when(col("_c4") & col("_qty_inf"), F.lit("quantity is not finite"))
           .when(col("_c5"), _first_error(load_checks)))
    return st.withColumn("_err", err)


CLEAN_COLUMNS = (
    "order_id", "sale_date", "customer_name", "email", "region", "channel",
    "product_id", "product_name", "category", "quantity", "unit_price",
    "discount", "total_amount", "claimed_total", "source_file", "_arrival",
)

"""Cleaning of raw extracts: repeated rows, missing prices, derived amounts, stray blanks, and a log of it all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.grouping import fits_broadcast
from shelfwise.schema import MONEY, SCHEMAS, TABLES
from shelfwise.session import shared_folder
from shelfwise.sources.star import Star, with_month

NUMERIC_KEYS = ("units_sold_qty", "product_key", "location_key", "date_key")


def natural_columns(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c != key]


def dedupe_natural(df: DataFrame, key: str = "sales_key") -> DataFrame:
    """One row per combination of all columns but ``key``: the one with the smallest key. Adds ``copies``.

    A grouped aggregation (NULLs compare equal) rather than a window: copies are folded before the shuffle,
    so a row repeated a billion times costs one row per task.
    """
    natural = natural_columns(df, key)
    return df.groupBy(*natural).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("copies"))


def impute_from_dim(df: DataFrame, dim: DataFrame, on: str, column: str) -> DataFrame:
    """Fill NULLs of ``column`` from the column of the same name in ``dim``."""
    side = dim.select(on, F.col(column).alias("_from_dim"))
    return df.join(side, on, "left").withColumn(column, F.coalesce(column, "_from_dim")).drop("_from_dim")


def recompute_measures(df: DataFrame) -> DataFrame:
    """Rebuild the four amounts from quantity, price, cost and discount (missing discount counts as 0)."""
    zero = F.lit(0).cast(MONEY)
    return (
        df.withColumn("gross_sales_amount", (F.col("units_sold_qty") * F.col("unit_price")).cast(MONEY))
        .withColumn("net_sales_amount", (F.col("gross_sales_amount") - F.coalesce("discount_amount", zero)).cast(MONEY))
        .withColumn("cogs_amount", (F.col("units_sold_qty") * F.col("unit_cost")).cast(MONEY))
        .withColumn("gross_margin_amount", (F.col("net_sales_amount") - F.col("cogs_amount")).cast(MONEY))
    )


def _number(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if dict(df.dtypes)[column] == "string":
        value = F.trim(value).try_cast("decimal(38,6)")
    return value.try_cast(SCHEMAS["fact_sales"][column].dataType)


def coerce_numeric(df: DataFrame, columns=NUMERIC_KEYS) -> DataFrame:
    """To integer; what is not a number becomes NULL."""
    return df.withColumns({c: _number(df, c) for c in columns if c in df.columns})


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every text column; NULL stays NULL, and the text ``None`` stays text."""
    return df.select(*[
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def clean_sales(sales: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned sales and a one-row log."""
    # raw rows are compared as they came: two unreadable numbers are two rows
    once = dedupe_natural(sales).withColumn("_missing", F.col("unit_price").isNull())
    cleaned = recompute_measures(impute_from_dim(coerce_numeric(once), products, "product_key", "unit_price"))
    log = cleaned.agg(
        F.lit("fact_sales").alias("table_name"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if("_missing").alias("missing_price_before"),
        F.count_if(F.col("unit_price").isNull()).alias("missing_price_after"),
        F.count(F.lit(1)).alias("rows_out"),
    )
    fields = [f.name for f in SCHEMAS["fact_sales"].fields]
    return with_month(cleaned.select(*fields), "fact_sales"), log


def clean_all(star: Star) -> tuple[Star, DataFrame]:
    """Clean the sales fact, trim the other eleven tables; returns the cleaned star and the log per table."""
    sales, log = clean_sales(star.sales, star.product)
    tables = {"fact_sales": sales}
    logs = [log]
    for name in TABLES:
        if name != "fact_sales":
            tables[name] = trim_strings(star.table(name))
            logs.append(
                star.table(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows_in"),
                                     F.count(F.lit(1)).alias("rows_out"))
            )
    return star.replaced(**tables), reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def duplicate_flags(df: DataFrame, key: str = "sales_key", rows_per_slot: int = 1 << 17) -> DataFrame:
    """Every row with two marks: does another row equal it in all columns but ``key``, and does it miss a price.

    Counts come from a grouped aggregation, and only repeated combinations are joined back. A combination is copied to as many slots as hold
    ``rows_per_slot`` of its rows each, so one holding a large part of all rows is spread over tasks in proportion, and the many small ones
    are not copied at all.
    """
    shared_folder(df.sparkSession)
    natural = natural_columns(df, key)
    digest = F.xxhash64(*natural)
    repeated = df.groupBy(*natural).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        *[F.col(c).alias(f"_{c}") for c in natural], digest.alias("_digest"), F.expr(f"(_n - 1) div {rows_per_slot} + 1").alias("_slots")
    ).checkpoint()
    spread = repeated.withColumn("_slot", F.explode(F.sequence(F.lit(1).cast("bigint"), "_slots")))
    # at most one in rows_per_slot rows; where digests meet, the wider spread holds for both
    wide = repeated.filter("_slots > 1").groupBy(F.col("_digest").alias("_row_digest")).agg(F.max("_slots").alias("_row_slots"))
    if wide.isEmpty():
        slotted = df.withColumn("_row_digest", digest).withColumn("_row_slot", F.lit(1).cast("bigint"))
    else:
        spread = repeated.join(wide, F.col("_digest") == F.col("_row_digest"), "left").withColumn(
            "_slot", F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("_row_slots", F.lit(1).cast("bigint"))))).drop("_row_digest", "_row_slots")
        known = df.withColumn("_row_digest", digest).join(F.broadcast(wide) if fits_broadcast(wide) else wide, "_row_digest", "left")
        slotted = known.withColumn("_row_slot", F.pmod(F.xxhash64(key), F.coalesce("_row_slots", F.lit(1).cast("bigint"))) + 1)
    match = (F.col("_row_digest") == F.col("_digest")) & (F.col("_row_slot") == F.col("_slot"))
    for c in natural:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return slotted.join(spread, match, "left").select(
        *df.columns, F.col("_digest").isNotNull().alias("is_duplicate"),
        F.col("unit_price").isNull().alias("is_price_missing"),
    )

"""The star: twelve typed tables, read lazily from CSV, Parquet, or any other provider."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import month_of_key
from shelfwise.schema import PARTITION_COLUMN, SCHEMAS, TABLES, stored_schema


class Star:
    """Lazy access to the tables; ``provider(name)`` is asked once per table."""

    def __init__(self, spark: SparkSession, provider: Callable[[str], DataFrame]):
        self.spark = spark
        self._provider = provider
        self._known: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        if name not in self._known:
            self._known[name] = self._provider(name)
        return self._known[name]

    def replaced(self, **tables: DataFrame) -> Star:
        """The same star with some tables exchanged."""
        return Star(self.spark, lambda name: tables[name] if name in tables else self.table(name))

    dates = property(lambda self: self.table("dim_date"))
    product = property(lambda self: self.table("dim_product"))
    supplier = property(lambda self: self.table("dim_supplier"))
    location = property(lambda self: self.table("dim_location"))
    customer = property(lambda self: self.table("dim_customer"))
    employee = property(lambda self: self.table("dim_employee"))
    promotion = property(lambda self: self.table("dim_promotion"))
    sales = property(lambda self: self.table("fact_sales"))
    snapshot = property(lambda self: self.table("fact_inventory_snapshot"))
    orders = property(lambda self: self.table("fact_purchase_order"))
    returns = property(lambda self: self.table("fact_returns"))
    transfers = property(lambda self: self.table("fact_stock_transfer"))


def with_month(df: DataFrame, table: str) -> DataFrame:
    """Add the month partition column the two big facts carry."""
    if table in PARTITION_COLUMN:
        month, key = PARTITION_COLUMN[table]
        df = df.withColumn(month, month_of_key(key))
    return df


def conform(df: DataFrame, table: str) -> DataFrame:
    """Bring text or loosely typed columns to the contract: picked by name, absent ones NULL, bad values NULL.

    Integers may be spelled ``18931.0``. Text is left alone, so the loyalty tier ``None`` stays a value.
    """
    present = set(df.columns)
    kinds = dict(df.dtypes)

    def cast(field: T.StructField):
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.LongType)) and kinds[field.name] == "string":
            value = value.try_cast("decimal(38,6)")
        return value.try_cast(field.dataType).alias(field.name)

    return with_month(df.select(*[cast(f) for f in SCHEMAS[table].fields]), table)


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One CSV extract, columns matched by header name; only the empty cell is NULL."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("nullValue", "").csv(path)
    return conform(raw, table)


def from_csv(spark: SparkSession, folder: str, suffix: str = ".csv") -> Star:
    return Star(spark, lambda name: read_csv_table(spark, f"{folder}/{name}{suffix}", name))


def from_parquet(spark: SparkSession, folder: str, partitioned: bool = True) -> Star:
    """Stored star; ``partitioned=False`` reads tables that lack the month folders.

    Where versions have been published (``sources.versions``) it is the newest one, and stays that one.
    """
    from shelfwise.sources.versions import is_published, read_star

    if partitioned and is_published(spark, folder):
        return read_star(spark, folder)

    def read(name: str) -> DataFrame:
        if partitioned:
            return spark.read.schema(stored_schema(name)).parquet(f"{folder}/{name}")
        return with_month(spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}"), name)

    return Star(spark, read)

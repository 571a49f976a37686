"""Writers: month-partitioned layout, clustering, samples, retention, incremental refresh, statistics."""

from __future__ import annotations

import threading
from collections.abc import Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import from_date_key, to_date_key
from shelfwise.schema import PARTITION_COLUMN, PRIMARY_KEY, SCHEMAS
from shelfwise.sources.star import Star, with_month


#: Month files a task keeps open at once when its rows are not sorted by month; rows of further months are sorted first.
OPEN_MONTHS = 40
_open_guard = threading.Lock()
_open_scopes: list[str] = []


@contextmanager
def months_side_by_side(spark: SparkSession, wanted: bool = True) -> Iterator[None]:
    """While it holds, writers by month keep several files open instead of sorting the rows of a task; the last scope to end restores the setting."""
    if not wanted:
        yield
        return
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    with _open_guard:
        _open_scopes.append(_open_scopes[0] if _open_scopes else spark.conf.get(setting))
        spark.conf.set(setting, str(OPEN_MONTHS))
    try:
        yield
    finally:
        with _open_guard:
            before = _open_scopes.pop()
            if not _open_scopes:
                spark.conf.set(setting, before)


def sink_table(df: DataFrame, folder: str, table: str, fmt: str = "parquet", in_order: bool = False,
               compression: str | None = None, by_month: bool = False) -> str:
    """Write one table. The two big facts go into month folders; rows of a month are split or merged by size first.

    With ``in_order`` the rows of a task already come month by month and are written as they are. With ``by_month`` they come straight from month
    folders, so a task meets the months of its files only: no row is shuffled or sorted, and there are no more files than were read. Parquet is compressed with zstd and CSV is
    plain, unless ``compression`` names a codec.
    """
    path = f"{folder}/{table}"
    if fmt == "csv":
        columns = [f.name for f in SCHEMAS[table].fields if f.name in df.columns]
        df.select(*columns).write.mode("overwrite").option("header", True).option("compression", compression or "none").csv(f"{path}.csv")
        return f"{path}.csv"
    codec = compression or "zstd"
    if table in PARTITION_COLUMN:
        month, key = PARTITION_COLUMN[table]
        if month not in df.columns:
            df = with_month(df, table)
        if not (in_order or by_month):
            df = df.hint("rebalance", month).sortWithinPartitions(month, key)
        with months_side_by_side(df.sparkSession, by_month):
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(month).parquet(path, compression=codec)
    else:
        df.write.mode("overwrite").parquet(path, compression=codec)
    return path


def sink_star(star: Star, folder: str, tables: list[str] | None = None, fmt: str = "parquet", threads: int = 4,
              compression: str | None = None, by_month: Collection[str] = ()) -> None:
    """Write tables, a few at a time, so that small ones do not wait for the big facts. ``by_month`` names facts that come from month folders."""
    frames = {table: star.table(table) for table in tables or SCHEMAS}
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(lambda table: sink_table(
            frames[table], folder, table, fmt, compression=compression, by_month=table in by_month), frames))


def sample_rows(df: DataFrame, table: str, n: int = 500, key: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in key order: a heap per task, not a full sort."""
    return df.orderBy(*(key or PRIMARY_KEY[table])).limit(n)


def cluster_write(df: DataFrame, path: str, keys: list[str]) -> None:
    """Range-partition and sort by ``keys`` so that file and row-group minima and maxima prune."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def curve_value(df: DataFrame, keys: list[str], bits: int = 6) -> tuple[DataFrame, str]:
    """``df`` with a place on a curve that fills the space of ``keys``: the bits of their ranks, interleaved.

    A rank is the number of quantiles below the value, of which there are ``2 ** bits - 1`` a key whatever its number of values, so ranks are
    evenly filled under skew as well. Returns the frame and the name of the added column.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    # one row of bounded size
    cuts = df.agg(*[F.struct(F.percentile_approx(k, shares, 1_000).alias("at"), F.max(k).alias("top")).alias(k) for k in keys]).first()

    def spread(rank: int, at: int) -> int:
        """The bits of a rank at their places, one of each key in turn from the highest down."""
        return sum((rank >> bit & 1) << (bit * len(keys) + len(keys) - 1 - at) for bit in range(bits))

    ranks, places = {}, []
    for at, k in enumerate(keys):
        edges = sorted(set(cuts[k].at or ()) - {cuts[k].top})
        # few values are stretched over all ranks; null comes last
        spots = F.array(*[F.lit(spread((rank << bits) // (len(edges) + 1), at)).cast("bigint") for rank in range(len(edges) + 1)])
        ranks[f"_rank_{at}"] = (F.col(k), F.array(*[F.lit(e) for e in edges]) if edges else None, len(edges))
        places.append(F.coalesce(F.get(spots, F.col(f"_rank_{at}")), F.lit(spread((len(edges) << bits) // (len(edges) + 1), at)).cast("bigint")))
    # a binary search for all keys at once: every round is a projection over the one before, so its code is a few comparisons
    found = df.withColumns({name: F.when(value.isNotNull(), F.lit(0)) for name, (value, _, _) in ranks.items()})
    for step in (1 << bit for bit in reversed(range(bits))):
        found = found.withColumns({
            name: F.col(name) + F.when(value > F.get(edges, F.col(name) + F.lit(step - 1)), step).otherwise(0)
            for name, (value, edges, size) in ranks.items() if size >= step})
    return found.withColumn("_place", reduce(lambda a, b: a + b, places)).drop(*ranks), "_place"


def curve_write(df: DataFrame, path: str, keys: list[str], files: int | None = None, bits: int = 6) -> None:
    """Lay rows out along a space-filling curve of ``keys``, so that files have narrow bounds in each of them and not only in the first."""
    placed, column = curve_value(df, keys, bits)
    order = [column, *keys]
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).drop(column).write.mode("overwrite").parquet(path)


def files_met(spark: SparkSession, path: str, schema, **wanted: tuple[object, object]) -> DataFrame:
    """Per column, how many of the stored files have bounds that meet a range, and how many there are: what a filter on it would open."""
    names = list(wanted)
    rows = spark.read.schema(schema).parquet(path).select("_metadata.file_path", *names)
    bounds = rows.groupBy("file_path").agg(*[f(c).alias(f"{n}_{c}") for c in names for n, f in (("low", F.min), ("high", F.max))])
    met = [F.count_if((F.col(f"low_{c}") <= F.lit(high)) & (F.col(f"high_{c}") >= F.lit(low))).alias(c) for c, (low, high) in wanted.items()]
    counts = bounds.agg(F.count(F.lit(1)).alias("files"), *met)
    return counts.select("files", F.explode(F.array(*[F.struct(F.lit(c).alias("path"), F.col(c).alias("met")) for c in names])).alias("m")).select(
        "m.path", "m.met", "files")


def retention_compact(snap: DataFrame, daily_months: int = 18) -> DataFrame:
    """Keep daily rows of the last ``daily_months`` months (cutoff included) and month-end rows before.

    Month end is the last day present in its month; the overall last day always stays.
    """
    # bounded by the number of calendar days
    days = snap.select("snapshot_month", "snapshot_date_key").distinct()
    in_month = Window.partitionBy("snapshot_month")
    last = F.max("snapshot_date_key").over(Window.partitionBy(F.lit(1)))
    kept = (
        days.withColumn("_month_end", F.max("snapshot_date_key").over(in_month))
        .withColumn("_cutoff", to_date_key(F.add_months(from_date_key(last), -daily_months)))
        .filter((F.col("snapshot_date_key") >= F.col("_cutoff")) | (F.col("snapshot_date_key") == F.col("_month_end")))
        .select("snapshot_month", "snapshot_date_key")
    )
    return snap.join(F.broadcast(kept), ["snapshot_month", "snapshot_date_key"], "left_semi")


def incremental_refresh(df: DataFrame, folder: str, table: str, from_month: int, by_month: bool = False) -> None:
    """Replace only the month folders from ``from_month`` on; older ones are left untouched. ``by_month`` is that of ``sink_table``."""
    month, key = PARTITION_COLUMN[table]
    if month not in df.columns:
        df = with_month(df, table)
    recent = df.filter(F.col(month) >= from_month)
    if not by_month:
        recent = recent.hint("rebalance", month).sortWithinPartitions(month, key)
    with months_side_by_side(df.sparkSession, by_month):
        (
            recent.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(month)
            .parquet(f"{folder}/{table}", compression="zstd")
        )


def register_tables(spark: SparkSession, folder: str, tables: list[str], database: str) -> None:
    """Make stored tables known to the catalog as external tables of ``database``; existing entries are kept."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}/_catalog'")
    for table in tables:
        name = f"{database}.{table}"
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=f"{folder}/{table}", source="parquet")
            if table in PARTITION_COLUMN:
                spark.catalog.recoverPartitions(name)


#: Settings under which collected statistics choose the order of joins.
COST_BASED = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true", "spark.sql.cbo.planStats.enabled": "true"}


def refresh_stats(spark: SparkSession, tables: list[str], database: str, histograms: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Collect table and column statistics for the optimiser after a load.

    ``histograms`` names columns that get an equi-height one as well. Those are for filters on unevenly filled columns, not for join keys: sizes of
    joins estimated from histograms of both keys overlook what filters on other columns take away. Returns one row per table with the row
    count the catalog now knows. Joins are put in order by all this in a session with ``COST_BASED``.
    """
    found = []
    setting = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(setting)
    try:
        for table in tables:
            spark.conf.set(setting, "false")
            spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS FOR ALL COLUMNS")
            if names := (histograms or {}).get(table):
                spark.conf.set(setting, "true")
                spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS FOR COLUMNS {', '.join(names)}")
    finally:
        spark.conf.set(setting, before)
    for table in tables:
        found.append(
            spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table}")
            .filter(F.col("col_name") == "Statistics")
            .select(
                F.lit(table).alias("table_name"),
                F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def column_stats(spark: SparkSession, columns: dict[str, list[str]], database: str) -> DataFrame:
    """What the catalog knows of columns: table_name, column_name, low, high (as text), nulls, distinct (an estimate), bins of the histogram."""
    found = []
    for table, names in columns.items():
        for c in names:
            told = spark.sql(f"DESCRIBE EXTENDED {database}.{table} {c}")
            value = {k: F.max(F.when(F.col("info_name") == k, F.nullif(F.col("info_value"), F.lit("NULL"))))
                     for k in ("min", "max", "num_nulls", "distinct_count", "histogram")}
            found.append(told.agg(
                F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), value["min"].alias("low"), value["max"].alias("high"),
                value["num_nulls"].cast("bigint").alias("nulls"), value["distinct_count"].cast("bigint").alias("distinct"),
                F.regexp_extract(value["histogram"], r"num_of_bins: (\d+)", 1).try_cast("int").alias("bins")))
    return reduce(DataFrame.unionByName, found)

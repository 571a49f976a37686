"""Loads that touch only what changed: atomic refresh, a ledger that goes on from its state, a summary kept up to date month by month."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import double, from_date_key, month_of_key, stale
from shelfwise.operators.clean import dedupe_natural
from shelfwise.operators.ledger import late_keys, ledger_rollforward, ledger_state, resume_ledger
from shelfwise.schema import SCHEMAS, stored_schema
from shelfwise.sources.star import with_month
from shelfwise.sources.versions import Table, Version, changed_months, publish, read_table, read_version

LEDGER, STATE, LEDGER_MONTH = "ledger", "ledger_state", "ledger_month"


def load_ledger(spark: SparkSession, folder: str, receipts: DataFrame, demand: DataFrame, opening: DataFrame | None, keys: list[str],
                date_col: str) -> Version:
    """Add movements to the ledger published in ``folder`` and publish it with its state.

    The first load rolls from the opening stock, a later one from the state; keys that are new then start from ``opening``. Months without new
    or reopened days keep their files.
    """
    version = read_version(spark, folder)
    months = {LEDGER: LEDGER_MONTH}
    with_month = lambda df: df.withColumn(LEDGER_MONTH, month_of_key(date_col))
    if LEDGER not in version.tables:
        ledger = with_month(ledger_rollforward(receipts, demand, opening, keys, date_col)).checkpoint()
        return publish(spark, folder, {LEDGER: ledger, STATE: ledger_state(ledger, opening, keys, date_col)}, months, version)
    stored, state = read_table(spark, folder, version, LEDGER), read_table(spark, folder, version, STATE)
    if opening is not None:
        state = state.unionByName(opening.join(state, keys, "left_anti").select(
            *keys, F.col("opening_qty").cast("bigint").alias("on_hand"), F.lit(None).cast(state.schema["last_day"].dataType).alias("last_day")))
    late = late_keys(state, receipts, demand, keys, date_col).checkpoint()
    # one number; without late rows no stored month is opened
    first = late.agg(F.min("from_day").alias("day")).first().day
    recent = stored.filter(F.lit(False)) if first is None else stored.filter(F.col(LEDGER_MONTH) >= first // 100)
    rows = with_month(resume_ledger(recent, state, late, receipts, demand, keys, date_col)).checkpoint()
    # at most as many as there are months
    touched = [str(r[0]) for r in rows.select(LEDGER_MONTH).distinct().toLocalIterator()]
    held = [m for m in touched if m in version.tables[LEDGER].months]
    same = read_table(spark, folder, version, LEDGER, held)
    replaced = F.col(date_col) >= F.col("from_day")
    kept = same.join(late, keys, "left").filter(~F.coalesce(replaced, F.lit(False))).drop("from_day")
    last = ledger_state(rows, None, keys, date_col)
    then = last.unionByName(state.join(last, keys, "left_anti"))
    return publish(spark, folder, {LEDGER: kept.unionByName(rows), STATE: then}, months, version, whole=False)


# -- repeats of rows that earlier extracts brought -----------------------------------------------------------------------

DIGESTS = "fact_sales_digests"


def load_new_sales(spark: SparkSession, folder: str, extract: DataFrame) -> Version:
    """Add to the published sales the rows of an extract that are new: equal in all columns but the surrogate key to none before, once each.

    Equal rows are of one month, and every month has a table of row digests beside it. A digest that isn't known proves a row new; of
    the others the stored rows of their months alone are read and compared column by column. Months without new rows keep their files.
    """
    version = read_version(spark, folder)
    natural = [f.name for f in SCHEMAS["fact_sales"].fields if f.name != "sales_key"]
    columns, digest = [f.name for f in stored_schema("fact_sales").fields], F.xxhash64(*natural).alias("digest")
    once = with_month(dedupe_natural(extract.select("sales_key", *natural)), "fact_sales").select(*columns, digest).checkpoint()
    months = {DIGESTS: "sale_month"}
    if "fact_sales" not in version.tables:
        return publish(spark, folder, {"fact_sales": once.drop("digest"), DIGESTS: once.select("digest", "sale_month")}, months, version)
    held = version.tables[DIGESTS].months

    def among(df: DataFrame) -> list[str]:
        # at most as many as there are months
        return [str(r[0]) for r in df.select("sale_month").distinct().toLocalIterator() if str(r[0]) in held]

    known = read_table(spark, folder, version, DIGESTS, among(once)).distinct()
    keys = ["sale_month", "digest"]
    hits = once.join(known, keys, "left_semi").checkpoint()
    stored = read_table(spark, folder, version, "fact_sales", among(hits)).select(
        *[F.col(c).alias(f"_{c}") for c in natural], F.col("sale_month").alias("_month"), digest.alias("_digest"))
    same = (F.col("digest") == F.col("_digest")) & (F.col("sale_month") == F.col("_month"))
    for c in natural:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    new = once.join(known, keys, "left_anti").select(*columns, "digest").unionByName(
        hits.join(stored, same, "left_anti").select(*columns, "digest")).checkpoint()
    touched = among(new)
    before = read_table(spark, folder, version, "fact_sales", touched)
    marks = read_table(spark, folder, version, DIGESTS, touched)
    return publish(spark, folder, {"fact_sales": before.unionByName(new.drop("digest")), DIGESTS: marks.unionByName(new.select("digest", "sale_month"))},
                   months, version, whole=False)


# -- the executive summary from monthly parts --------------------------------------------------------------------------


def _sales_part(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sale_month").agg(F.sum("net_sales_amount").alias("revenue"), F.sum("gross_margin_amount").alias("margin"))


def _last_sale_part(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sale_month", "product_key").agg(F.max("date_key").alias("last_key"))


def _closing_part(snap: DataFrame) -> DataFrame:
    """Each month's last day by product: stock held, its value, positions without stock."""
    held = F.col("on_hand_qty") > 0
    # one row per month
    ends = snap.groupBy("snapshot_month").agg(F.max("snapshot_date_key").alias("snapshot_date_key"))
    closing = snap.join(F.broadcast(ends), ["snapshot_month", "snapshot_date_key"])
    return closing.groupBy("snapshot_month", "snapshot_date_key", "product_key").agg(
        F.count_if(held).alias("held"), F.sum("on_hand_value").alias("value"), F.count_if("is_stockout_flag").alias("out"))


#: Part of the summary: the fact it is made from, its month column, how.
PARTS: dict[str, tuple[str, str, Callable[[DataFrame], DataFrame]]] = {
    "kpi_sales": ("fact_sales", "sale_month", _sales_part), "kpi_last_sale": ("fact_sales", "sale_month", _last_sale_part),
    "kpi_closing": ("fact_inventory_snapshot", "snapshot_month", _closing_part),
}


def refresh_kpis(spark: SparkSession, warehouse: str, folder: str) -> dict[str, list[str]]:
    """Bring the parts in ``folder`` up to the newest version of ``warehouse``; the months made anew, by part.

    Every part remembers which load each month came from. Only months whose load differs are read; months that are gone are taken away. Parts
    become visible together.
    """
    source, parts = read_version(spark, warehouse), read_version(spark, folder)
    made_from = Version(0, {t: Table(m, "", None) for t, m in json.loads(parts.notes.get("made_from", "{}")).items()})
    frames, gone, anew = {}, {}, {}
    for name, (fact, _, make) in PARTS.items():
        anew[name], gone[name] = changed_months(made_from, source, fact)
        if anew[name] or gone[name] or name not in parts.tables:
            frames[name] = make(read_table(spark, warehouse, source, fact, anew[name]))
    if frames:
        notes = {"made_from": json.dumps({fact: source.tables[fact].months for fact, _, _ in PARTS.values()})}
        publish(spark, folder, frames, {n: month for n, (_, month, _) in PARTS.items()}, parts, whole=False, drop=gone, notes=notes)
    return anew


def kpis_from_parts(spark: SparkSession, folder: str, dates: DataFrame, products: DataFrame, days: int = 180) -> DataFrame:
    """The row of ``mv_executive_kpis`` from the parts and two dimensions; no fact is read, of the closings only the last month."""
    version = read_version(spark, folder)
    closings = version.tables["kpi_closing"].months
    now = read_table(spark, folder, version, "kpi_closing", [max(closings, key=int)] if closings else [])
    sold = read_table(spark, folder, version, "kpi_last_sale").groupBy("product_key").agg(from_date_key(F.max("last_key")).alias("last_sold_date"))
    last = now.agg(F.max("snapshot_date_key")).scalar()
    anchor = dates.filter(F.col("date_key") <= last).agg(F.max("full_date")).scalar()
    dead = now.filter("held > 0").join(sold, "product_key", "left").filter(stale("last_sold_date", anchor, days)).join(
        products.select("product_key"), "product_key").agg(F.count(F.lit(1)).alias("dead_stock_skus"))
    totals = read_table(spark, folder, version, "kpi_sales").agg(F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"))
    closing = now.agg(F.sum("value").alias("value"), F.coalesce(F.sum("out"), F.lit(0)).alias("out"))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (totals, closing, dead))
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns]).select(
        double("revenue").alias("total_revenue"), double("margin").alias("total_gross_margin"), double("value").alias("current_inventory_value"),
        F.col("out").alias("current_stockouts"), "dead_stock_skus")

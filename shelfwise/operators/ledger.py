"""Stock ledger, purchase-order lifecycle and snapshot construction as windows over daily movements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import from_date_key
from shelfwise.schema import STOCK_VALUE


def ledger_rollforward(receipts: DataFrame, demand: DataFrame, opening: DataFrame | Column | None, keys: list[str],
                       date_col: str) -> DataFrame:
    """Roll stock forward per ``keys``, sales capped at what is on hand.

    ``receipts`` and ``demand`` carry keys, ``date_col`` and ``qty``; ``opening`` carries keys and ``opening_qty``
    (missing means 0), or is an expression of the keys (NULL means 0), which needs no join. With X the uncapped balance
    and M its running minimum below zero, stock is X - M and unmet demand is how far M fell, so no day-by-day loop is needed. Movements are first summed per day: a key's window
    holds at most one row per calendar day however many movements it had.
    """
    zero = F.lit(0).cast("bigint")
    qty = F.col("qty").cast("bigint")
    moves = receipts.select(*keys, date_col, qty.alias("receipts"), zero.alias("demand")).unionByName(
        demand.select(*keys, date_col, zero.alias("receipts"), qty.alias("demand"))
    )
    daily = moves.groupBy(*keys, date_col).agg(F.sum("receipts").alias("receipts"), F.sum("demand").alias("demand"))
    if isinstance(opening, DataFrame):
        daily, opening = daily.join(opening, keys, "left"), F.col("opening_qty")
    else:  # dealt to the windows here: what is worked out below would be shuffled as columns of its own
        daily = daily.repartition(*keys)
    by_day = Window.partitionBy(*keys).orderBy(date_col)
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    floor = F.least(zero, F.min("_x").over(so_far))
    return (
        daily.withColumn("opening_qty", zero if opening is None else F.coalesce(opening, zero))
        .withColumn("_x", F.col("opening_qty") + F.sum(F.col("receipts") - F.col("demand")).over(so_far))
        .withColumn("_m", floor)
        .withColumn("_m_before", F.coalesce(F.lag("_m").over(by_day), zero))
        .select(
            *keys, date_col, "receipts", "demand",
            (F.col("_x") - F.col("_m")).alias("on_hand"),
            (F.col("demand") - (F.col("_m_before") - F.col("_m"))).alias("sold"),
            (F.col("_m_before") - F.col("_m")).alias("unmet"),
        )
    )


def ledger_state(ledger: DataFrame, opening: DataFrame | None, keys: list[str], date_col: str) -> DataFrame:
    """Where every key stands: ``on_hand`` and ``last_day`` (NULL for keys that have an opening stock and no movement yet).

    Stock at hand is all a later day needs: with X the uncapped balance and M its running minimum below zero, rolling on from X - M with a new
    minimum of zero gives the same stock as going on with X and M.
    """
    last = ledger.groupBy(*keys).agg(F.max_by("on_hand", date_col).alias("on_hand"), F.max(date_col).alias("last_day"))
    if opening is None:
        return last
    return opening.join(last, keys, "full_outer").select(
        *keys, F.coalesce("on_hand", F.col("opening_qty").cast("bigint"), F.lit(0)).alias("on_hand"), "last_day")


def late_keys(state: DataFrame, receipts: DataFrame, demand: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Keys with a movement on or before the last day they were rolled to, and the first such day as ``from_day``."""
    first = receipts.select(*keys, date_col).unionByName(demand.select(*keys, date_col)).groupBy(*keys).agg(F.min(date_col).alias("from_day"))
    return first.join(state, keys).filter(F.col("from_day") <= F.col("last_day")).select(*keys, "from_day")


def resume_ledger(stored: DataFrame, state: DataFrame, late: DataFrame, receipts: DataFrame, demand: DataFrame, keys: list[str],
                  date_col: str) -> DataFrame:
    """Ledger rows that new movements add, or put in the place of stored ones, rolled on from ``state``.

    Keys in ``late`` are opened again at their first late day: stock before it follows from the stored row there, and stored movements
    from it on are rolled once more with the new ones. No other key's history is read. ``stored`` needs to hold the days from the earliest
    ``from_day`` on only.
    """
    again = stored.join(late, keys).filter(F.col(date_col) >= F.col("from_day"))
    before = again.groupBy(*keys).agg(F.min_by(F.col("on_hand") - F.col("receipts") + F.col("sold"), date_col).alias("opening_qty"))
    opening = before.unionByName(state.join(late, keys, "left_anti").select(*keys, F.col("on_hand").alias("opening_qty")))
    columns = [*keys, date_col, "qty"]
    return ledger_rollforward(
        receipts.select(*columns).unionByName(again.select(*keys, date_col, F.col("receipts").alias("qty"))),
        demand.select(*columns).unionByName(again.select(*keys, date_col, F.col("demand").alias("qty"))), opening, keys, date_col)


def _day_slots(dates: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every calendar day with the number of wanted dates before it (``_slot``) and in all (``_slots``), and itself as ``_wanted`` if it is one."""
    day = Window.orderBy("date_key")
    # calendar and dates are bounded by the number of days
    marked = calendar.select("date_key").join(
        F.broadcast(dates.select(F.col(dates.columns[0]).alias("_wanted"))), F.col("date_key") == F.col("_wanted"), "left"
    )
    return marked.select(
        "date_key", "_wanted",
        F.coalesce(
            F.count("_wanted").over(day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_slot"),
        F.count("_wanted").over(Window.partitionBy(F.lit(1))).alias("_slots"),
    )


def as_of_fill(rows: DataFrame, keys: list[str], date_col: str, dates: DataFrame, calendar: DataFrame,
               values: list[str]) -> DataFrame:
    """For every key and every date in ``dates``: the values of the last row at or before that date.

    Keys appear from their first row on. ``calendar`` holds every day as ``date_key``. Each row is assigned the first
    wanted date not before it; only the last row per (key, wanted date) survives, and it is repeated up to the next
    one. Linear in rows plus output, with no range join.
    """
    slots = _day_slots(dates, calendar)
    slot_of_day = slots.filter("_slot < _slots").select(F.col("date_key").alias(date_col), "_slot", "_slots")
    wanted = slots.filter(F.col("_wanted").isNotNull()).select("_slot", F.col("_wanted").alias("as_of_key"))
    last = (
        rows.join(F.broadcast(slot_of_day), date_col)
        .groupBy(*keys, "_slot")
        .agg(F.max_by(F.struct(*values), date_col).alias("_v"), F.max("_slots").alias("_slots"))
    )
    following = F.lead("_slot").over(Window.partitionBy(*keys).orderBy("_slot"))
    return (
        last.withColumn("_until", F.coalesce(following, F.col("_slots")) - 1)
        .withColumn("_slot", F.explode(F.sequence("_slot", "_until")))
        .join(F.broadcast(wanted), "_slot")
        .select(*keys, "as_of_key", *[F.col(f"_v.{v}").alias(v) for v in values])
    )


def _order_moves(po: DataFrame) -> DataFrame:
    """Each order line as two signed movements: ``qty`` on order from the order date on, and off again when received."""
    keys = ["product_key", "location_key"]
    lines = po.select(
        "product_key", F.col("dest_location_key").alias("location_key"), "ordered_qty", "order_date_key",
        F.greatest("received_date_key", "order_date_key").alias("_closed"),
        "received_date_key",
    )
    opened = lines.select(*keys, F.col("order_date_key").alias("date_key"), F.col("ordered_qty").alias("qty"))
    closed = lines.filter(F.col("received_date_key").isNotNull()).select(
        *keys, F.col("_closed").alias("date_key"), (-F.col("ordered_qty")).alias("qty")
    )
    return opened.unionByName(closed)


def open_orders(po: DataFrame, dates: DataFrame, calendar: DataFrame) -> DataFrame:
    """Units on order per (product, location) at each date: ordered on or before it, received after it or never.

    Each line is two signed movements, so nothing is joined on a range.
    """
    keys = ["product_key", "location_key"]
    daily = _order_moves(po).groupBy(*keys, "date_key").agg(F.sum("qty").alias("qty"))
    so_far = Window.partitionBy(*keys).orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)
    running = daily.withColumn("on_order_qty", F.sum("qty").over(so_far))
    return as_of_fill(running, keys, "date_key", dates, calendar, ["on_order_qty"]).filter("on_order_qty <> 0")


def stock_runs(ledger: DataFrame, po: DataFrame, dates: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stock at hand and on order at every date, as stretches of dates over which neither changes; and the dates that go with them.

    The first frame has product_key, location_key, on_hand, on_order_qty, ``_slot`` and ``_until`` (first and last number of its dates) and
    ``_month`` and ``_until_month`` (their months, counted from year 0). The second has ``_at`` (number of a date), ``date_key`` and ``_month``. Joined
    they are ``as_of_fill`` of the ledger with ``open_orders``, but only changes are shuffled, and once: a product's rows come together in one task,
    at most one per place and date of each kind.
    """
    keys = ["product_key", "location_key"]
    slots = _day_slots(dates, calendar)
    month = F.expr("_wanted div 100 div 100 * 12 + _wanted div 100 % 100 - 1").cast("int")
    days = slots.filter(F.col("_wanted").isNotNull()).select(
        F.col("_slot").alias("_at"), F.col("_wanted").alias("date_key"), month.alias("_month"))
    # bounded by the number of days
    ends = F.broadcast(slots.filter("_slot < _slots").select(F.col("date_key").alias("_day"), "_slot"))
    at = days.select(F.col("_at").alias("_slot"), "_month", F.lag("_month").over(Window.orderBy("_at")).alias("_month_before"))
    stock = ledger.join(ends, F.col("date_key") == F.col("_day")).select(
        *keys, "_slot", F.col("date_key").alias("_on"), F.struct("on_hand").alias("_hand"), F.lit(None).cast("bigint").alias("qty"))
    # orders without a date count from the position's first order with one on; those without a place meet no stock
    first = F.lit(-1).cast("bigint")
    moved = _order_moves(po).filter(F.col("location_key").isNotNull()).join(ends, F.col("date_key") == F.col("_day"), "left").filter(
        F.col("_slot").isNotNull() | F.col("date_key").isNull()).groupBy(*keys, F.coalesce("_slot", first).alias("_slot")).agg(
        F.sum("qty").alias("qty")).withColumn("_dated", F.col("_slot") >= 0)
    changes = stock.unionByName(moved, allowMissingColumns=True)
    by_slot = Window.partitionBy(*keys).orderBy("_slot")
    so_far = by_slot.rowsBetween(Window.unboundedPreceding, 0)
    known = (
        changes.repartition("product_key").groupBy(*keys, "_slot")
        .agg(F.max_by("_hand", "_on").alias("_hand"), F.sum("qty").alias("_moved"), F.max("_dated").alias("_dated"))
        .withColumns({"_stock": F.last("_hand", True).over(so_far), "_next": F.lead("_slot").over(by_slot),
                      "on_order_qty": F.coalesce(F.when(F.max("_dated").over(so_far), F.sum("_moved").over(so_far)), F.lit(0))})
        # a position has stock from its first ledger row on, be the quantity known or not
        .filter(F.col("_stock").isNotNull())
    )
    last = days.agg(F.max(F.struct("_at", "_month"))).scalar()
    runs = (
        known.join(F.broadcast(at.drop("_month_before")), "_slot")
        .join(F.broadcast(at.select(F.col("_slot").alias("_next"), F.col("_month_before").alias("_until_month"))), "_next", "left")
        .select(*keys, F.col("_stock.on_hand").alias("on_hand"), "on_order_qty", "_slot", F.coalesce(F.col("_next") - 1, last["_at"]).alias("_until"),
                "_month", F.coalesce("_until_month", last["_month"]).alias("_until_month"))
    )
    return runs, days


def month_blocks(days: DataFrame, size: int) -> DataFrame:
    """Months of the dates ``stock_runs`` gives, each with its block: a block is up to ``size`` months that follow each other, fewer where months
    have many dates, so that blocks hold about as many dates each. (``_month``, ``_block_of_month``)"""
    return days.groupBy("_month").agg(F.floor(F.min("_at") / size).cast("int").alias("_block_of_month"))


def cut_at_blocks(runs: DataFrame, blocks: DataFrame) -> DataFrame:
    """``runs`` of ``stock_runs`` once for every block they reach into, as ``_block_of_month``; ``_month`` and ``_until_month`` are cut to the block."""
    last = blocks.select(F.col("_month").alias("_until_month"), F.col("_block_of_month").alias("_until_block"))
    ends = blocks.groupBy("_block_of_month").agg(F.min("_month").alias("_opens"), F.max("_month").alias("_closes"))
    # bounded by the number of months
    return (
        runs.join(F.broadcast(blocks), "_month").join(F.broadcast(last), "_until_month")
        .withColumn("_block_of_month", F.explode(F.sequence("_block_of_month", "_until_block")))
        .join(F.broadcast(ends), "_block_of_month")
        .withColumns({"_month": F.greatest("_month", "_opens"), "_until_month": F.least("_until_month", "_closes")})
        .drop("_until_block", "_opens", "_closes")
    )


def po_lifecycle(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    """Resolve purchase-order lines against their receipts and derive the delivery flags.

    ``orders``: po_line_key, order_date_key, expected_date_key, ordered_qty and anything else;
    ``receipts``: po_line_key, received_date_key, received_qty. A line without receipt has received 0,
    is neither late nor complete, and therefore not on-time-in-full.
    """
    joined = orders.join(receipts, "po_line_key", "left")
    return delivery_flags(joined)


def delivery_flags(lines: DataFrame) -> DataFrame:
    return (
        lines.withColumn(
            "received_qty", F.when(F.col("received_date_key").isNull(), 0).otherwise(F.col("received_qty")).cast("int")
        )
        .withColumn(
            "lead_time_days", F.datediff(from_date_key("received_date_key"), from_date_key("order_date_key"))
        )
        .withColumn("is_late_flag", F.coalesce(F.col("received_date_key") > F.col("expected_date_key"), F.lit(False)))
        .withColumn("is_complete_flag", F.col("received_qty") >= F.col("ordered_qty"))
        .withColumn("is_otif_flag", ~F.col("is_late_flag") & F.col("is_complete_flag"))
    )


def snapshot_flags(rows: DataFrame) -> DataFrame:
    """Value and the two alarm flags from on_hand_qty, unit_cost and reorder_point."""
    return (
        rows.withColumn("on_hand_value", (F.col("on_hand_qty") * F.col("unit_cost")).cast(STOCK_VALUE))
        .withColumn("is_below_reorder_flag", F.col("on_hand_qty") <= F.col("reorder_point"))
        .withColumn("is_stockout_flag", F.col("on_hand_qty") == 0)
    )

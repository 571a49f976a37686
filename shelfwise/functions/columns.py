"""Column expressions shared by all operators. Everything here stays inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and bounds the results must carry.
SUPPLY_LABELS = {
    "none": "No recent demand",
    "critical": "Critical (<7d)",
    "watch": "Watch (<21d)",
    "healthy": "Healthy",
}
AGE_LABELS = ("1. 0-30d", "2. 31-60d", "3. 61-90d", "4. 91-180d", "5. 180+ / never")
QUADRANT_LABELS = {
    (True, True): "Star (high sales, high margin)",
    (True, False): "Traffic driver (high sales, low margin)",
    (False, True): "Niche (low sales, high margin)",
    (False, False): "Review (low sales, low margin)",
}
HEALTH_LABELS = {"critical": "🔴 Critical", "watch": "🟠 Watch", "healthy": "🟢 Healthy"}


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def double(value: str | Column) -> Column:
    return col(value).cast("double")


def total(value: str | Column) -> Column:
    """Exact sum, reported as a double."""
    return F.sum(col(value)).cast("double")


def mean(value: str | Column) -> Column:
    """Exact sum over non-null count: independent of the order rows arrive in."""
    value = col(value)
    return safe_ratio(F.sum(value), F.count(value))


def safe_ratio(num: str | Column, den: str | Column, scale: float = 1.0, digits: int | None = None) -> Column:
    """``scale * num / den`` in double precision; NULL when the denominator is zero or NULL."""
    top = double(num) if scale == 1.0 else F.lit(float(scale)) * double(num)
    ratio = top / F.nullif(double(den), F.lit(0.0))
    return ratio if digits is None else F.round(ratio, digits)


def percent(num: str | Column, den: str | Column, digits: int | None = None) -> Column:
    return safe_ratio(num, den, 100.0, digits)


def rounded(value: str | Column, digits: int = 0) -> Column:
    """Round (exactly for decimals), then report as a double."""
    return F.round(col(value), digits).cast("double")


def to_date_key(day: str | Column) -> Column:
    day = col(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def from_date_key(key: str | Column) -> Column:
    key = col(key)
    return F.make_date(_div(key, 10000), _div(key, 100) % 100, key % 100)


def month_of_key(key: str | Column) -> Column:
    """YYYYMM of a YYYYMMDD key: the value the big facts are partitioned by."""
    return _div(col(key), 100)


def _div(value: Column, by: int) -> Column:
    return ((value - value % by) / by).cast("int")


def month_number_line(year: str | Column, month: str | Column) -> Column:
    """Months counted on one line, so that calendar distance is plain subtraction."""
    return col(year) * 12 + col(month) - 1


def supply_band(days: str | Column, has_demand: Column, critical: float = 7, watch: float = 21) -> Column:
    days = col(days)
    return (
        F.when(~has_demand, SUPPLY_LABELS["none"])
        .when(days < critical, SUPPLY_LABELS["critical"])
        .when(days < watch, SUPPLY_LABELS["watch"])
        .otherwise(SUPPLY_LABELS["healthy"])
    )


def age_band(last_sold: str | Column, anchor: Column, edges: tuple[int, ...] = (30, 60, 90, 180)) -> Column:
    last_sold = col(last_sold)
    band = F.when(last_sold.isNull(), AGE_LABELS[-1])
    for days, label in zip(edges, AGE_LABELS):
        band = band.when(last_sold >= F.date_sub(anchor, days), label)
    return band.otherwise(AGE_LABELS[-1])


def health_status(rate: str | Column, critical: float = 0.05, watch: float = 0.02) -> Column:
    rate = col(rate)
    return (
        F.when(rate > critical, HEALTH_LABELS["critical"])
        .when(rate > watch, HEALTH_LABELS["watch"])
        .otherwise(HEALTH_LABELS["healthy"])
    )


def stale(last_sold: str | Column, anchor: Column, days: int = 180) -> Column:
    """Never sold, or last sold strictly before ``anchor - days``."""
    last_sold = col(last_sold)
    return last_sold.isNull() | (last_sold < F.date_sub(anchor, days))

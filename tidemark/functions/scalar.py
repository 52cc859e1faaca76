"""Column functions shared by all operators. Everything here is a native Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,9)"
_ADDEND = "decimal(37,9)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Fixed-point money: sums do not depend on the order in which tasks finish."""
    return _col(c).cast(MONEY)


def add_money(a: Column, b: Column) -> Column:
    """a + b with all nine digits: Spark would give up one to make room for a carry."""
    return (a.cast(_ADDEND) + b.cast(_ADDEND)).cast(MONEY)


def less_money(a: Column, b: Column) -> Column:
    """a - b with all nine digits."""
    return (a.cast(_ADDEND) - b.cast(_ADDEND)).cast(MONEY)


def sum_money(c: Column | str) -> Column:
    """Exact sum of a double amount, returned as double."""
    return F.sum(money(c)).cast("double")


def mean_of(c: Column | str) -> Column:
    """Mean of a double amount from its exact sum; NULLs do not count."""
    return F.try_divide(sum_money(c), F.count(_col(c)).cast("double"))


def order_measures(total: str, number: str, key: str | None = None) -> tuple[Column, ...]:
    """Sum, number and mean of the amounts of a group of orders; with `key`, orders without one are not counted."""
    counted = F.lit(1) if key is None else F.col(key)
    return sum_money("amount").alias(total), F.count(counted).alias(number), mean_of("amount").alias("avg_order_value")


def safe_divide(num: Column | str, den: Column | str, digits: int = 4) -> Column:
    """num / den rounded; 0 for a zero or NULL denominator, NULL for a NULL numerator."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(F.round(F.try_divide(n, d), digits))


def share_pct(part: Column | str, whole: Column | str) -> Column:
    """Percentage with one decimal digit."""
    return F.round(F.try_divide(_col(part).cast("double"), _col(whole).cast("double")) * 100, 1)


def month_start(ts: Column | str) -> Column:
    """First instant of the month. `date_trunc` returns an instant; NTZ input stays NTZ."""
    return F.date_trunc("month", _col(ts)).cast("timestamp_ntz")


def local_date(ts: Column | str, tz: str = "Asia/Kolkata") -> Column:
    """Calendar date of a UTC timestamp in the business's own time zone."""
    return F.to_date(F.from_utc_timestamp(_col(ts).cast("timestamp"), tz))


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 over the columns' text, each with its length in front, so that different rows never join to one text.

    NULL is a '-' without length and so differs from the empty text.
    """
    texts = [_col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(*parts))

"""Column-level helpers: all built on ``pyspark.sql.functions``, no Python UDFs."""

from __future__ import annotations

from decimal import Decimal
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
CENT = Decimal("0.01")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def optional_column(df: DataFrame, name: str, default=0) -> Column:
    """The column if ``df`` has it (NULLs filled with ``default``), else a constant."""
    if name in df.columns:
        return F.coalesce(F.col(name), F.lit(default))
    return F.lit(default)


def remap(c: str | Column, mapping: Mapping, default=None, *, keep_others: bool = True) -> Column:
    """Simultaneous value map: every row is looked up once, so ``{3: 4, 4: 3}`` swaps.

    Values not in ``mapping`` keep their value (``keep_others``) or become
    ``default``.
    """
    c = col_of(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    fallback = c if keep_others and default is None else F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def money(c: str | Column) -> Column:
    """Amount already in yuan, NULL counted as 0."""
    return F.coalesce(col_of(c).cast(MONEY), F.lit(Decimal("0.00")))


def day_of(c: str | Column) -> Column:
    """Calendar day of a timestamp / timestamp_ntz / date column (``DATE_FORMAT(x, '%Y-%m-%d')``)."""
    return F.to_date(col_of(c))


def day_or(c: str | Column, default=None) -> Column:
    """The day, or ``default`` (today, if none is given) where it is missing (SCL-12)."""
    return F.coalesce(day_of(c), F.current_date() if default is None else F.to_date(F.lit(str(default))))


def epoch_seconds_day(c: str | Column, tz: str = "UTC") -> Column:
    """Day of epoch seconds as seen in time zone ``tz`` (``FROM_UNIXTIME(sec, '%Y-%m-%d')``).

    Built on timestamp_ntz arithmetic, so the result does not depend on the
    session time zone; ``tz`` is explicit (H15).
    """
    wall_utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=col_of(c).cast("decimal(18,6)"))
    if tz.upper() in ("UTC", "Z", "+00:00"):
        return F.to_date(wall_utc)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), wall_utc))


def day_string(c: str | Column) -> Column:
    """Output format of every day key: ``yyyy-MM-dd``."""
    return F.date_format(col_of(c), "yyyy-MM-dd")


# Money inside aggregations is an exact integer count of units of 1/10000
# yuan (bigint): integer sums are fixed-width and codegen-friendly, while
# decimal sums wider than 18 digits fall back to BigDecimal arithmetic.
UNITS_PER_YUAN = 10000


def cents_to_units(c: str | Column) -> Column:
    """Integer cents (NULL as 0) to units."""
    return F.coalesce(col_of(c).cast("bigint"), F.lit(0).cast("bigint")) * F.lit(100)


def money_units(c: str | Column) -> Column:
    """Yuan amount with up to 4 decimals (NULL as 0) to units."""
    return F.coalesce((col_of(c).cast("decimal(20,4)") * F.lit(UNITS_PER_YUAN)).cast("bigint"),
                      F.lit(0).cast("bigint"))


def units_to_money(c: str | Column) -> Column:
    """Units back to an exact decimal yuan amount."""
    return col_of(c).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))


def ratio_income(cost_units: str | Column, ratio: str | Column) -> Column:
    """``cost / (1 + ratio)`` per row, rounded to 4 decimals (as units) so that sums
    do not depend on their order.  A ratio of -1 gives NULL: the row has no income."""
    cost = col_of(cost_units).cast("double") / F.lit(float(UNITS_PER_YUAN))
    q = F.try_divide(cost, F.lit(1.0) + F.coalesce(col_of(ratio).cast("double"), F.lit(0.0)))
    return (q.cast("decimal(18,4)") * F.lit(UNITS_PER_YUAN)).cast("bigint")

"""Daily calendars: key x day spines, period expansion, apportionment.

Everything is ``explode(sequence(...))`` on one row per key or per period, so
no cartesian product is planned and each output day is made by the task that
holds its key.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.columns import col_of


def one_day() -> Column:
    return F.expr("INTERVAL 1 DAY")


def spread(df: DataFrame) -> DataFrame:
    """Spread a small frame over all shuffle partitions before it is exploded
    into days.  The aggregate or dimension feeding an explode is tiny, so AQE
    would coalesce it into a task or two, while the explode multiplies it by
    the number of days.  A round-robin repartition with an explicit count is
    neither coalesced nor merged with a hash exchange below it (and Spark
    sorts before it, so a retried task gets the same rows)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _as_date(v) -> Column:
    if v is None:
        return F.current_date()
    if isinstance(v, Column):
        return F.to_date(v)
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.strftime("%Y-%m-%d")
    return F.to_date(F.lit(v))


#: Days that one row is exploded into at once.
CHUNK_DAYS = 256


def expand_days(df: DataFrame, lo: Column, hi: Column, *, name: str, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """One row per day of ``[lo, hi]``, in two levels: the period is cut into chunks of at most ``chunk_days``,
    the chunks are dealt over all shuffle partitions, and only there become days.

    The rows to expand are few and small, so AQE leaves them in a task or two,
    and one key's period can be longer than all others together. Dealt by
    chunk, a task gets its share of the days whatever key they are of. The deal
    is by a hash of the row and the chunk's first day (no sort, and a retried
    task gets the same rows) with an explicit count, which AQE doesn't merge.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    periods = df.withColumns({"_lo": lo, "_hi": hi})
    chunks = periods.withColumn("_skip", F.explode(F.sequence(F.lit(0), F.datediff("_hi", "_lo"), F.lit(chunk_days))))
    chunks = chunks.withColumn("_lo", F.date_add("_lo", F.col("_skip"))).withColumn(
        "_hi", F.least("_hi", F.date_add("_lo", chunk_days - 1))).drop("_skip")
    dealt = chunks.repartition(n, F.xxhash64(*[F.col(f"`{c}`") for c in chunks.columns if c != "_hi"]))
    return dealt.withColumn(name, F.explode(F.sequence("_lo", "_hi", one_day()))).drop("_lo", "_hi")


def date_spine(keys: DataFrame, start, as_of=None, *, name: str = "stat_date") -> DataFrame:
    """Every row of ``keys`` times every day in ``[start, as_of]`` (both included).

    ``as_of`` defaults to today (SCL-12).  ``keys`` should be distinct.
    """
    days = F.sequence(_as_date(start), _as_date(as_of), one_day())
    return spread(keys).select("*", F.explode(days).alias(name))


def fill_grid(spine: DataFrame, facts: list[DataFrame], on: list[str], *, fill=0) -> DataFrame:
    """Left-join many facts onto a spine in one pass and fill the gaps.

    The facts (each unique per ``on``) are stacked with ``unionByName``,
    summed per key (one shuffle) and joined to the spine once, instead of one
    left join per fact.
    """
    cols: list[str] = []
    for f in facts:
        cols += [c for c in f.columns if c not in on and c not in cols]
    stacked = facts[0]
    for f in facts[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    wide = stacked.groupBy(*on).agg(*[F.sum(c).alias(c) for c in cols])
    return spine.join(wide, on, "left").fillna(fill, subset=cols)


def period_bounds(begin: str | Column, end: str | Column) -> tuple[Column, Column]:
    """First and last day of a period.

    Reversed bounds span both dates, a NULL bound gives the other one only,
    and both NULL give no day at all (H14).
    """
    b, e = F.to_date(col_of(begin)), F.to_date(col_of(end))
    return F.least(b, e), F.greatest(b, e)


def expand_period(df: DataFrame, begin: str | Column, end: str | Column, *,
                  name: str = "stat_date", drop: bool = True) -> DataFrame:
    """One row per day of each row's period ``[begin, end]``."""
    lo, hi = period_bounds(begin, end)
    out = expand_days(df.where(lo.isNotNull()), lo, hi, name=name)
    if drop:
        out = out.drop(*[c for c in (begin, end) if isinstance(c, str) and c != name])
    return out


# a first day, a last day and an amount as one number in their order: 7 + 7 + 21 digits
_ZERO_DAY, _ZERO_AMOUNT, _AMOUNT_SPAN = 1_000_000, 5 * 10**20, 10**21


def _whole(value: int) -> Column:
    return F.lit(Decimal(value)).cast(f"decimal({len(str(value))},0)")


def _packed(lo: Column, hi: Column, amount: Column) -> Column:
    day = [(F.unix_date(d) + _ZERO_DAY).cast("decimal(7,0)") for d in (lo, hi)]
    units = (amount * F.lit(Decimal(10000))).cast("decimal(21,0)") + _whole(_ZERO_AMOUNT)
    return ((day[0] * _whole(10**7) + day[1]).cast("decimal(15,0)") * _whole(_AMOUNT_SPAN)).cast("decimal(38,0)") + units


def _unpacked(packed: Column, kind: DecimalType) -> Column:
    units = (packed % _whole(_AMOUNT_SPAN)).cast("decimal(22,0)") - _whole(_ZERO_AMOUNT)
    return (units * F.lit(Decimal("0.0001"))).cast(kind)


def apportion_daily(df: DataFrame, keys: list[str], begin: str, end: str, amount: str, *,
                    name: str = "stat_date", out: str | None = None) -> DataFrame:
    """Spread an amount evenly over the days of a key's period (TS-5, WIN-1..3).

    Per key: the days run from the earliest to the latest bound of all its
    rows; the amount spread is the one of the row that starts first (H17;
    ties go to the shorter period, then the smaller amount), divided by the
    number of days.  One aggregate (partial aggregation collapses a hot key
    map-side; where days and a decimal amount pack into one wide number it is a
    hash aggregate), then ``expand_days``: a key of a century is dealt over many
    tasks like many keys of a year.
    """
    out = out or amount
    lo, hi = period_bounds(begin, end)
    kind = df.schema[amount].dataType
    packs = isinstance(kind, DecimalType) and kind.scale <= 4 and kind.precision - kind.scale <= 16
    if packs:
        first = _unpacked(F.min(_packed(lo, hi, F.col(amount))), kind)
    else:
        first = F.min_by(F.col(amount), F.struct(lo, hi, F.col(amount)))
    per_key = (df.groupBy(*keys)
               .agg(F.min(lo).alias("_lo"), F.max(hi).alias("_hi"), first.alias("_amt"))
               .filter(F.col("_lo").isNotNull()))
    n_days = (F.datediff("_hi", "_lo") + F.lit(1)).cast("double")
    share = per_key.select(*keys, F.col("_lo").alias("_first"), F.col("_hi").alias("_last"),
                           (F.col("_amt").cast("double") / n_days).alias(out))
    days = expand_days(share, F.col("_first"), F.col("_last"), name=name)
    return days.select(*keys, name, out)

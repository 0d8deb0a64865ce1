"""Joining day-grained facts to validity periods.

A fact day matches every period (of the same key) that covers it. Periods are
put into the months they touch, one row a month, and joined to the facts of
that key and month; the days decide in the join's condition. So a period of a
year costs 12 rows and not 365, an equi-join (with AQE's splitting of skewed
keys) carries all the work, and the only fan-out beyond the real overlap (H4)
is between a month's facts and the periods that touch the same month of the
same key without covering the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calendar import period_bounds


def interval_join(facts: DataFrame, periods: DataFrame, on: list[str], *, day: str,
                  begin: str, end: str, how: str = "left", bin: str = "month") -> DataFrame:
    """Facts joined to the periods covering ``facts[day]`` (``begin <= day <= end``; reversed bounds span both
    days, a missing one gives the other day only, H14).

    ``bin`` is the calendar unit that periods are cut into (``week``, ``month``, ``quarter`` or ``year``).
    """
    if how not in ("left", "inner"):
        raise ValueError("facts are kept (left) or only those with a period (inner)")
    lo, hi = period_bounds(begin, end)
    rest = [c for c in periods.columns if c not in (*on, begin, end, day)]
    step = {"week": "7 DAY", "month": "1 MONTH", "quarter": "3 MONTH", "year": "1 YEAR"}[bin]
    bins = F.sequence(F.trunc("_lo", bin), F.trunc("_hi", bin), F.expr(f"INTERVAL {step}"))
    cut = periods.select(*(F.col(f"`{c}`").alias(f"_p_{c}") for c in on), lo.alias("_lo"), hi.alias("_hi"),
                         *(F.col(f"`{c}`") for c in rest)).where("_lo IS NOT NULL").withColumn("_p_bin", F.explode(bins))
    dated = facts.withColumn("_bin", F.trunc(F.col(f"`{day}`"), bin))
    match = F.col("_bin") == F.col("_p_bin")
    for c in on:
        match = match & (dated[c] == F.col(f"_p_{c}"))
    match = match & F.to_date(dated[day]).between(F.col("_lo"), F.col("_hi"))
    own = [c for c in facts.columns if c not in (*on, day)]
    return dated.join(cut, match, how).select(*on, day, *own, *rest)

"""Earlier forms of two operators, kept as comparisons for the tests."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspend.operators.calendar import expand_period


def interval_join_by_days(facts, periods, on, *, day, begin, end, how="left"):
    """Every period expanded to its days, joined on key and day."""
    return facts.join(expand_period(periods, begin, end, name=day), [*on, day], how)


def forward_fill_by_months(df: DataFrame, keys: list[str], order: str, cols: list[str], *,
                 chunk: Column | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` by the last non-NULL value before them, per key.

    Hot keys are split: rows are filled inside (key, chunk) windows (chunk =
    calendar month of ``order`` by default), the last value of every chunk is
    carried into the following chunks through a small per-chunk table, and
    the two are combined.  No window ever spans a whole key.
    """
    chunk = chunk if chunk is not None else F.date_trunc("month", F.col(order))
    base = df.withColumn("_chunk", chunk)
    inner = (Window.partitionBy(*keys, "_chunk").orderBy(order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = base.select("*", *[F.last(c, ignorenulls=True).over(inner).alias(f"_ff_{c}") for c in cols])

    # last non-NULL value of each chunk, then carried over earlier chunks
    lasts = base.groupBy(*keys, "_chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in cols])
    across = (Window.partitionBy(*keys).orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = lasts.select(*keys, "_chunk",
                         *[F.last(f"_last_{c}", ignorenulls=True).over(across).alias(f"_carry_{c}") for c in cols])
    out = filled.join(carry, [*keys, "_chunk"], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"_ff_{c}"), F.col(f"_carry_{c}")))
    return out.drop("_chunk", *[f"_ff_{c}" for c in cols], *[f"_carry_{c}" for c in cols])

"""Per-group picks and group statistics, written as aggregates.

The reference uses pandas per-group operations (``nth(0)``, ``idxmin``,
``transform('mean')``).  A window over a whole group would put a hot group
into one task; these are aggregates instead, so partial aggregation collapses
every group map-side, and the result is joined back where rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``; remaining ties broken by the
    other columns in their order, so the pick is deterministic (WIN-2, WIN-5)."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                          *[F.col(c).alias(f"_v{i}") for i, c in enumerate(rest)])).alias("_p")
    g = df.groupBy(*keys).agg(pick)
    return g.select(*keys, *[F.col(f"_p._v{i}").alias(c) for i, c in enumerate(rest)]).select(*df.columns)


def _join_back(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    cond = [df[k].eqNullSafe(stats[f"_g_{k}"]) for k in keys]
    return df.join(stats, cond, "left").drop(*[f"_g_{k}" for k in keys])


def group_mean_back(df: DataFrame, keys: list[str], value: str, *, name: str | None = None) -> DataFrame:
    """Every row gets the mean of ``value`` over its group (``transform('mean')``)."""
    name = name or value
    stats = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(F.avg(value).alias("_mean"))
    out = _join_back(df, stats, keys)
    if name in df.columns:
        out = out.drop(name)
    return out.withColumnRenamed("_mean", name)


def earliest_row_flag(df: DataFrame, keys: list[str], order: list[str], *, flag: str = "is_first") -> DataFrame:
    """Flag the first row of every group by ``order`` (``idxmin``); all other
    rows get ``False``.  Ties are broken by the remaining columns; of rows equal
    in every column one is flagged."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    stats = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(F.min(row).alias("_first"))
    out = _join_back(df, stats, keys)
    out = out.withColumn(flag, F.coalesce(row == F.col("_first"), F.lit(False))).drop("_first")
    # only copies of a group's first row meet in a window, never a whole group
    copies = Window.partitionBy(*keys).orderBy(*order)
    first = out.where(F.col(flag)).withColumn(flag, F.row_number().over(copies) == 1)
    return out.where(~F.col(flag)).unionByName(first)


def keep_on_first(df: DataFrame, flag: str, value: str, *, other=0) -> DataFrame:
    """Keep ``value`` on flagged rows and set ``other`` elsewhere (WIN-3)."""
    return df.withColumn(value, F.when(F.col(flag), F.col(value)).otherwise(F.lit(other)))

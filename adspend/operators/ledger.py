"""Ledger facts rolled up to customer (and entity) per day.

One generic operator covers every ledger query of the reference: they differ
only in table, filter, unit, grain and name.  Each fact row carries the
measures it counts for (conditional amounts, one scan for many measures),
the rows of many tables are stacked with ``unionByName`` and joined to
the unified bridge (account or project -> entity, customer, platform), and
the result is summed per (customer[, entity], day, by..., metric).

The bridge has one row per account.  Its number of rows is known beforehand
(``Sources.sizes``):

* within the bound it is broadcast and the join runs map-side, inside the
  scan tasks; the facts never move, only the partial sums per customer and
  day do (a customer with a third of all rows is collapsed in every task);
* beyond the bound each key space is joined by itself, by one shuffle of
  narrow fact rows (key, day, a mask of measures, an amount or two); AQE splits
  skewed partitions, so a hot account is shared by many tasks.

Money is summed as exact integer units (``functions.columns``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import MAX_BROADCAST_BYTES, broadcast_if_small, fits

AMOUNT = "bigint"   # money as integer units of 1/10000 yuan (functions.columns)


@dataclass(frozen=True)
class Measure:
    """One summed measure: ``SUM(amount) WHERE where``, for accounts of ``platform``.
    ``amount`` is in integer units (``cents_to_units`` / ``money_units``)."""

    name: str
    amount: Column
    where: Column | None = None
    platform: int | None = None


def measure_columns(fact: DataFrame, *, key: str, day: Column, measures: list[Measure],
                    by: tuple[str, ...] = (), tag: str | None = None) -> DataFrame:
    """``(_src, _k, stat_date, by..., <measure>...)`` straight from the fact
    rows: one column per measure holding the row's amount where the row
    counts for that measure, else NULL.  Tables with different measures stack
    with ``unionByName(allowMissingColumns=True)`` (other tables' measures are
    NULL).  Rows counting for no measure are dropped at the scan."""
    conds = [m.where for m in measures]
    rows = fact
    if all(c is not None for c in conds):
        rows = rows.filter(reduce(lambda a, b: a | b, conds))
    cols = []
    for m in measures:
        amount = F.coalesce(m.amount.cast(AMOUNT), F.lit(0).cast(AMOUNT))
        cols.append((F.when(m.where, amount) if m.where is not None else amount).alias(m.name))
    return rows.select(F.lit(tag or key).alias("_src"), F.col(key).alias("_k"), day.alias("stat_date"),
                       *by, *cols)


def sum_columns(rows: DataFrame, bridge: DataFrame, measures: list[Measure], *,
                keep: tuple[str, ...], by: tuple[str, ...]) -> DataFrame:
    """Join ``measure_columns`` rows to the bridge and sum every measure per
    (keep..., stat_date, by...) in one aggregate (conditional on the account's
    platform where the measure asks for one); long form out, one row per
    group and measure that had rows."""
    need = list(dict.fromkeys([*keep, "platform_id"]))
    j = rows.join(bridge.select("_src", "_k", *need), ["_src", "_k"])
    aggs = []
    for i, m in enumerate(measures):
        v = F.col(m.name)
        if m.platform is not None:
            v = F.when(F.col("platform_id") == F.lit(m.platform), v)
        aggs += [F.sum(v).alias(f"_s{i}"), F.count(v).alias(f"_n{i}")]
    g = j.groupBy(*keep, "stat_date", *by).agg(*aggs)
    entries = [F.struct(F.lit(m.name).alias("metric"),
                        F.coalesce(F.col(f"_s{i}"), F.lit(0).cast(AMOUNT)).alias("amount"),
                        (F.col(f"_n{i}") > 0).alias("_ok"))
               for i, m in enumerate(measures)]
    return (g.select(*keep, "stat_date", *by, F.inline(F.array(*entries)))
            .filter("_ok").drop("_ok"))


def _slots(measures: list[Measure]) -> list[Column]:
    """The different amounts of a table's measures (measures that share an amount share the object)."""
    return list({id(m.amount): m.amount for m in measures}.values())


def packed_rows(fact: DataFrame, *, key: str, day: Column, measures: list[Measure], bits: dict[str, int],
                width: int, by: tuple[str, ...] = ()) -> DataFrame:
    """``(_k, stat_date, by..., _m, _a0, ...)`` straight from the fact rows: every
    different amount once, and the measures the row counts for as bits of one
    number (``bits``: a measure's bit; ``width``: amount columns).  That is what
    a shuffled row consists of: a key, a day, a mask and an amount or two.
    Rows counting for no measure are dropped at the scan."""
    conds = [m.where for m in measures]
    rows = fact
    if all(c is not None for c in conds):
        rows = rows.filter(reduce(lambda a, b: a | b, conds))
    zero = F.lit(0).cast("bigint")
    mask = reduce(lambda a, b: a + b, [F.lit(1 << bits[m.name]).cast("bigint") if m.where is None else
                                       F.when(m.where, F.lit(1 << bits[m.name]).cast("bigint")).otherwise(zero)
                                       for m in measures])
    amounts = [F.coalesce(a.cast(AMOUNT), F.lit(0).cast(AMOUNT)) for a in _slots(measures)]
    amounts += [F.lit(None).cast(AMOUNT)] * (width - len(amounts))
    return rows.select(F.col(key).alias("_k"), day.alias("stat_date"), *by, mask.alias("_m"),
                       *[a.alias(f"_a{i}") for i, a in enumerate(amounts)])


def sum_packed(sources, bridge: DataFrame, *, keep: tuple[str, ...], by: tuple[str, ...]) -> DataFrame:
    """The tables of one key space, ``[(fact, key, day, measures)]``, stacked as
    ``packed_rows``, joined once to its bridge on ``_k`` and summed per
    (keep..., stat_date, by...); long form out, one row per group and measure
    that had rows."""
    measures = {m.name: m for *_, ms in sources for m in ms}
    bits = {name: i for i, name in enumerate(measures)}
    width = max(len(_slots(ms)) for *_, ms in sources)
    where: dict[str, set[int]] = {}
    for *_, ms in sources:
        slots = [id(a) for a in _slots(ms)]
        for m in ms:
            where.setdefault(m.name, set()).add(slots.index(id(m.amount)))
    if len(measures) > 62 or any(len(s) > 1 for s in where.values()):
        raise ValueError("at most 62 measures a key space, each with its amount in one column")
    rows = reduce(lambda a, b: a.unionByName(b), [packed_rows(fact, key=key, day=day, measures=ms, bits=bits, width=width, by=by)
                                                  for fact, key, day, ms in sources])
    need = list(dict.fromkeys([*keep, "platform_id"]))
    j = rows.join(bridge.drop(*(c for c in bridge.columns if c not in ("_k", *need))), "_k")
    aggs = []
    for i, m in enumerate(measures.values()):
        counts = F.col("_m").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0
        if m.platform is not None:
            counts = counts & (F.col("platform_id") == F.lit(m.platform))
        (slot,) = where[m.name]
        aggs += [F.sum(F.when(counts, F.col(f"_a{slot}"))).alias(f"_s{i}"), F.count_if(counts).alias(f"_n{i}")]
    g = j.groupBy(*keep, "stat_date", *by).agg(*aggs)
    entries = [F.struct(F.lit(name).alias("metric"), F.coalesce(F.col(f"_s{i}"), F.lit(0).cast(AMOUNT)).alias("amount"),
                        (F.col(f"_n{i}") > 0).alias("_ok")) for i, name in enumerate(measures)]
    return g.select(*keep, "stat_date", *by, F.inline(F.array(*entries))).filter("_ok").drop("_ok")


def sum_by(long: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """``SUM(amount)`` per ``grain`` and metric: a group exists only where rows
    passed the measure's filter, and an all-NULL amount sums to 0."""
    return long.groupBy(*grain, "metric").agg(
        F.coalesce(F.sum("amount"), F.lit(0).cast(AMOUNT)).cast(AMOUNT).alias("amount"))


def ledger_long_many(sources, bridge: DataFrame, *, keep: tuple[str, ...] = ("customer_id",),
                     by: tuple[str, ...] = (), bridge_rows: int | None = None,
                     max_broadcast_bytes: int = MAX_BROADCAST_BYTES, settle=None) -> DataFrame:
    """Long form of many fact tables ``[(fact, key, day, measures, tag)]``
    joined once to a unified bridge keyed ``(_src, _k)``.

    The plan depends on ``bridge_rows``, an upper bound of the bridge's rows
    (None: unknown, taken as large).  Building it starts no job.  Within
    ``max_broadcast_bytes`` the bridge is
    broadcast and joined to the stacked rows of all tables map-side (one
    conditional sum per measure, measures of other tables are NULL), and only
    the partial sums per customer and day shuffle.  Beyond the bound the
    tables of each key space are stacked as narrow rows and joined to their
    part of the bridge, so a fact row is shuffled once, and only the sums per
    customer and day after that.  ``settle(part, tag)``, if given, takes each
    key space's sums there (``operators.parts``).
    """
    if fits(bridge_rows, max_broadcast_bytes):
        measures = list({m.name: m for _, _, _, ms, _ in sources for m in ms}.values())
        parts = [measure_columns(fact, key=key, day=day, measures=ms, by=by, tag=tag)
                 for fact, key, day, ms, tag in sources]
        rows = reduce(lambda a, c: a.unionByName(c, allowMissingColumns=True), parts)
        return sum_columns(rows, F.broadcast(bridge), measures, keep=keep, by=by)
    spaces: dict[str, list] = {}
    for fact, key, day, ms, tag in sources:
        spaces.setdefault(tag, []).append((fact, key, day, ms))
    bridge = broadcast_if_small(bridge, bridge_rows, max_broadcast_bytes)
    parts = [sum_packed(tables, bridge.where(F.col("_src") == tag), keep=keep, by=by) for tag, tables in spaces.items()]
    parts = [part if settle is None else settle(part, tag) for part, tag in zip(parts, spaces, strict=True)]
    long = reduce(lambda a, b: a.unionByName(b), parts)
    names = [{m.name for *_, ms in tables for m in ms} for tables in spaces.values()]
    if sum(map(len, names)) == len(set().union(*names)):  # each measure in one key space: already summed
        return long
    return sum_by(long, (*keep, "stat_date", *by))


def sum_long(long: DataFrame, names: list[str], *, grain: tuple[str, ...]) -> DataFrame:
    """Pivot a long frame to one column per metric, one row per ``grain``.

    A single aggregate with a conditional sum per metric (one shuffle,
    partial aggregation map-side).
    """
    m = F.col("metric")
    aggs = [F.sum(F.when(m == F.lit(n), F.col("amount"))).alias(n) for n in names]
    return long.groupBy(*grain).agg(*aggs)

"""The customer-day snapshot: one row per customer and day with every
deposit, refund, spend, cost basis, invoice, receipt and income figure.

Plan: every ledger table is scanned once and summed per customer and day;
all measures are stacked in long form and pivoted with one aggregate on
(customer, day); the result is left-joined once to the customer x day spine.
The only fan-out is the spine itself (customers x days, made by
``explode(sequence)`` per customer).
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.calendar import date_spine
from ..operators.ledger import sum_long
from ..sources.tables import Sources
from .contracts import net_income
from ..functions.columns import optional_column, units_to_money
from .facts import INCOME_BASE, Params, facts_long, invoice_units, part, receipt_units, spend_by_entity, to_date

JOINED = ["deposit_yxt_cash", "deposit_yxt_gift", "deposit_all_gdt", "deposit_all_tt",
          "deposit_all_wechat", "refund_all_gdt", "refund_all_tt", "refund_all_wechat",
          "refund_yxt_gift", "refund_yxt_cash", "invoice_amount", "arrive_amount",
          "total_cost_gdt", "cb_tt", "total_cost_tt", "total_cost_wechat", "total_cost_yxt",
          "cb_gdt", "cb_yxt"]
INCOMES = ["incoming_gdt", "incoming_tt", "incoming_wechat", "incoming_yxt"]
DERIVED = {
    "refund_all_yxt": ["refund_yxt_gift", "refund_yxt_cash"],
    "refund_all": ["refund_all_yxt", "refund_all_wechat", "refund_all_gdt", "refund_all_tt"],
    "deposit_all_yxt": ["deposit_yxt_cash", "deposit_yxt_gift"],
    "deposit_all": ["deposit_all_yxt", "deposit_all_wechat", "deposit_all_gdt", "deposit_all_tt"],
    "total_cost_all": ["total_cost_yxt", "total_cost_wechat", "total_cost_gdt", "total_cost_tt"],
    # WeChat has no cost basis (cb_wechat counts as 0, H11)
    "cb_all": ["cb_yxt", "cb_wechat", "cb_gdt", "cb_tt"],
}
BALANCES = {
    "invoice_without_arrival": ("invoice_amount", "arrive_amount"),
    "consume_without_arrival": ("incoming_all", "arrive_amount"),
    "consume_without_invoice": ("incoming_all", "invoice_amount"),
}
COLUMNS = ["customer_id", "stat_date", *JOINED, *DERIVED, *INCOMES, "incoming_all", *BALANCES]


def _long(df: DataFrame, value: str) -> DataFrame:
    return df.select("customer_id", "stat_date", F.lit(value).alias("metric"),
                     F.col(value).alias("amount"))


def snapshot_long(src: Sources, p: Params | None = None) -> DataFrame:
    """All joined measures and incomes as ``(customer_id, stat_date, metric,
    amount)``, amounts in integer units.

    The ledger tables are read once: the customer-level measures and the
    entity-level spend behind net income come out of the same pass.  Beyond the
    broadcast bound each part is settled by itself, so that the shuffle files
    of all ledgers never lie on the disk together.
    """
    ledger_names = [m for m in JOINED if m not in ("invoice_amount", "arrive_amount")]
    ledger = facts_long(src, ledger_names + list(INCOME_BASE), p=p, keep=("customer_id", "entity_id"), apart=True)
    window = (p or Params()).window
    parts = [ledger.filter(~F.col("metric").isin(*INCOME_BASE))
             .select("customer_id", "stat_date", "metric", "amount"),
             part(_long(invoice_units(src, window=window), "invoice_amount"), "invoices", src, p),
             part(_long(receipt_units(src, window=window), "arrive_amount"), "receipts", src, p),
             part(net_income(src, p, spend=spend_by_entity(src, p, long=ledger, units=True), units=True), "income", src, p)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def last_day(spark, as_of=None):
    """The run's last day, settled once: ``as_of``, or today in the session's zone."""
    if isinstance(as_of, Column):
        raise TypeError("as_of must be a plain day")
    return to_date(as_of) if as_of is not None else spark.sql("SELECT current_date() AS d").first()["d"]


def customer_day_snapshot(src: Sources, *, start, as_of=None, p: Params | None = None) -> DataFrame:
    """One row per customer and day of ``[start, as_of]`` (Q-29), 35 columns.

    Only facts of those days are read: the day window is pushed to every
    fact scan, so a run over the last few days reads the last few days.
    """
    as_of, start = last_day(src.customers.sparkSession, as_of), last_day(src.customers.sparkSession, start)
    p = replace(p or Params(), window=(start, as_of))
    wide = sum_long(snapshot_long(src, p), JOINED + INCOMES, grain=("customer_id", "stat_date"))
    customers = src.customers.select(F.col("id").alias("customer_id")).distinct()
    spine = date_spine(customers, start, as_of)
    snap = spine.join(wide, ["customer_id", "stat_date"], "left")
    zero = F.lit(0).cast("bigint")
    cols = {c: F.coalesce(F.col(c), zero) for c in JOINED + INCOMES}
    cols["cb_wechat"] = optional_column(wide, "cb_wechat").cast("bigint")
    for name, parts in DERIVED.items():
        cols[name] = reduce(lambda a, b: a + b, [cols[c] for c in parts])
    cols["incoming_all"] = reduce(lambda a, b: a + b, [cols[c] for c in INCOMES])
    for name, (a, b) in BALANCES.items():
        cols[name] = cols[a] - cols[b]
    return snap.select("customer_id", "stat_date",
                       *[units_to_money(cols[c]).alias(c) for c in COLUMNS if c not in ("customer_id", "stat_date")])


__all__ = ["customer_day_snapshot", "snapshot_long", "COLUMNS", "INCOME_BASE"]

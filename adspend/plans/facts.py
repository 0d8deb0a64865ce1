"""The ledger measures of the customer-day report (deposits, spend, refunds,
cost basis, spend by entity, invoices, receipts) and one function per measure.

Each source table is described once (key, bridge, day, measures); a query
asks for some measures, and the measures of one table are computed in a
single scan and a single aggregate.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (cents_to_units, day_of, epoch_seconds_day, money_units, remap,
                                 units_to_money)
from ..operators.bridge import project_bridge, unified_bridge
from ..operators.ledger import Measure, ledger_long_many, sum_long
from ..operators.parts import settled
from ..operators.sizing import MAX_BROADCAST_BYTES, fits
from ..sources.tables import Sources

# ---- fixed values (as the reference states them) -------------------------
FUND_TYPES_ALL = ("FUND_TYPE_CASH", "FUND_TYPE_GIFT", "FUND_TYPE_CREDIT_ROLL",
                  "FUND_TYPE_COMPENSATE_VIRTUAL")
FUND_TYPES_INCOME = ("FUND_TYPE_CASH", "FUND_TYPE_GIFT", "FUND_TYPE_CREDIT_ROLL")
FUND_TYPES_COST_BASIS = ("FUND_TYPE_CASH", "FUND_TYPE_CREDIT_ROLL")
GDT_CHARGE, GDT_PAY, GDT_TRANSFER_BACK = "CHARGE", "PAY", "TRANSFER_BACK"
TT_TRANSFER = "TRANSFER"
WECHAT_DEPOSIT = "AGENCY_TRANSFER_TO_ADVERTISER"
WECHAT_REFUND = "AGENCY_REFUND_FROM_ADVERTISER"
INVOICE_RESULT, INVOICE_STATUS = "agree", "COMPLETED"
MEDIA_COST_SINCE = "2019-03-01 00:00:00"
# platform ids: 1 own platform, 2 GDT, 3 TT, 4 WeChat
OWN, GDT, TT, WECHAT = 1, 2, 3, 4
# ---------------------------------------------------------------------------

# spend measures that feed net income, and the contract platform they use
INCOME_BASE = {"income_base_gdt": GDT, "income_base_tt": TT,
               "income_base_wechat": WECHAT, "income_base_yxt": OWN}


@dataclass
class Params:
    """Run parameters.  ``agents``: the agent's own TT account ids (deposits are
    transfers from them, refunds transfers to them); ``tz``: zone of the WeChat
    epoch timestamps; ``media_cost_since``: lower bound of the media cost;
    ``window``: first and last day to read (None: all); ``max_broadcast_bytes``:
    largest join side that is broadcast."""

    agents: tuple = ()
    tz: str = "UTC"
    media_cost_since: str = MEDIA_COST_SINCE
    window: tuple | None = None   # (first day, last day): read only facts of these days
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES


@dataclass
class FactSource:
    fact: DataFrame
    key: str
    tag: str            # key space: which bridge maps the key (gdt, tt, wechat, project)
    day: Column
    measures: list[Measure] = field(default_factory=list)
    ts: str | None = None       # raw time column, for pushing a day window to the scan
    epoch: bool = False         # ts holds epoch seconds


def day_window(ts: str, day: Column, window, *, epoch: bool = False) -> Column:
    """Rows whose day falls in ``window = (first, last)`` (dates, inclusive),
    as a range on the raw time column, so Parquet row-group statistics and
    date partitions prune the scan.

    For a date or timestamp column ``first <= ts < last + 1 day`` is exactly
    the day test.  Epoch seconds are read in a time zone, so their range gets
    one day of margin and the exact day test follows.
    """
    first, last = (to_date(d) for d in window)
    after = last + dt.timedelta(days=1)
    if not epoch:
        return (F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(after))
    lo = (first - dt.date(1970, 1, 1)).days * 86400 - 86400
    hi = (after - dt.date(1970, 1, 1)).days * 86400 + 86400
    return (F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(hi)) & day.between(F.lit(first), F.lit(last))


def to_date(d) -> dt.date:
    """A plain day; a run's last day is settled before (``snapshot.last_day``), so None is not one."""
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d)[:10])


def bridges(src: Sources, tags=("gdt", "tt", "wechat", "project"), *, small: bool = True) -> DataFrame:
    """The unified bridge of the key spaces ``tags``, built once per plan; unless ``small``, accounts and
    projects are joined by a shuffle whatever the projects' size."""
    pb = project_bridge(src.projects, src.entities, src.customers)
    accounts = {"gdt": lambda: src.gdt_accounts, "tt": lambda: src.tt_accounts,
                "wechat": lambda: src.wechat_accounts}
    parts = {}
    for t in tags:
        if t == "project":
            parts[t] = pb
        else:
            side = pb if small else pb.hint("merge")
            parts[t] = accounts[t]().select("account_id", "project_id").join(side, "project_id").select(
                "account_id", *pb.columns)
    return unified_bridge(parts)


def bridge_rows(src: Sources, tags) -> int:
    """At most so many rows has the unified bridge of ``tags``."""
    sizes = src.sizes()
    return sum(sizes["projects" if t == "project" else f"{t}_accounts"] for t in tags)


def part(df: DataFrame, name: str, src: Sources, p: Params | None) -> DataFrame:
    """``df`` as a part of a job over several ledgers: settled by itself where the accounts are beyond the bound."""
    rows = bridge_rows(src, ("gdt", "tt", "wechat", "project"))
    return df if fits(rows, (p or Params()).max_broadcast_bytes) else settled(df, name)


def _gdt(src: Sources, p: Params) -> FactSource:
    tt, at = F.col("trade_type"), F.col("account_type")
    amt = cents_to_units("amount")
    return FactSource(src.gdt_cash_flow, "account_id", "gdt", day_of("trade_time"), ts="trade_time", measures=[
        Measure("deposit_all_gdt", amt, (tt == GDT_CHARGE) & at.isin(*FUND_TYPES_ALL), GDT),
        Measure("refund_all_gdt", amt, tt == GDT_TRANSFER_BACK, GDT),
        Measure("total_cost_gdt", amt, (tt == GDT_PAY) & at.isin(*FUND_TYPES_ALL)),
        Measure("cb_gdt", amt, (tt == GDT_PAY) & at.isin(*FUND_TYPES_COST_BASIS)),
        Measure("income_base_gdt", amt, (tt == GDT_PAY) & at.isin(*FUND_TYPES_INCOME)),
    ])


def _tt_transfers(src: Sources, p: Params) -> FactSource:
    xt = F.col("transaction_type") == TT_TRANSFER
    agents, amt = list(p.agents) or [None], money_units("amount")
    return FactSource(src.tt_transfers, "account_id", "tt", day_of("create_time"), ts="create_time", measures=[
        Measure("deposit_all_tt", amt, xt & F.col("remitter").isin(*agents), TT),
        Measure("refund_all_tt", amt, xt & F.col("payee").isin(*agents), TT),
    ])


def _wechat_statements(src: Sources, p: Params) -> FactSource:
    wt, amt = F.col("trade_type"), cents_to_units("amount")
    return FactSource(src.wechat_statements, "account_id", "wechat", epoch_seconds_day("wechat_time", p.tz),
                      ts="wechat_time", epoch=True, measures=[
        Measure("deposit_all_wechat", amt, wt == WECHAT_DEPOSIT, WECHAT),
        Measure("refund_all_wechat", amt, wt == WECHAT_REFUND, WECHAT),
    ])


def _wechat_daily(src: Sources, p: Params) -> FactSource:
    cost = cents_to_units("cost")
    return FactSource(src.wechat_daily, "account_id", "wechat", day_of("date"), ts="date", measures=[
        Measure("total_cost_wechat", cost),
        Measure("income_base_wechat", cost),
    ])


def _tt_daily(src: Sources, p: Params) -> FactSource:
    spend = money_units("cash_cost") + money_units("reward_cost")
    return FactSource(src.tt_daily, "account_id", "tt", day_of("date"), ts="date", measures=[
        Measure("cb_tt", money_units("cash_cost")),
        Measure("total_cost_tt", spend),
        Measure("income_base_tt", spend),
    ])


def _project_log(table: str, ts: str, name: str, amount: str, *, ts_required: bool = False):
    def build(src: Sources, p: Params) -> FactSource:
        where = F.col(ts).isNotNull() if ts_required else None
        return FactSource(getattr(src, table), "project_id", "project", day_of(ts),
                          [Measure(name, money_units(amount), where)], ts=ts)
    return build


def _consume(src: Sources, p: Params) -> FactSource:
    own_spend = money_units("pay_consume_amount") + money_units("present_consume_amount")
    return FactSource(src.consume_log, "project_id", "project", day_of("consume_time"), [
        Measure("total_cost_yxt", own_spend), Measure("income_base_yxt", own_spend)], ts="consume_time")


def _media(src: Sources, p: Params) -> FactSource:
    since = F.col("stat_date") >= F.lit(p.media_cost_since).cast("timestamp_ntz")
    return FactSource(src.media_cost, "project_id", "project", day_of("stat_date"),
                      [Measure("cb_yxt", money_units("dsp_cost"), since)], ts="stat_date")


# source table -> (builder, measures it yields)
SOURCES = {
    "gdt_cash_flow": (_gdt, ("deposit_all_gdt", "refund_all_gdt", "total_cost_gdt", "cb_gdt",
                             "income_base_gdt")),
    "tt_transfers": (_tt_transfers, ("deposit_all_tt", "refund_all_tt")),
    "wechat_statements": (_wechat_statements, ("deposit_all_wechat", "refund_all_wechat")),
    "wechat_daily": (_wechat_daily, ("total_cost_wechat", "income_base_wechat")),
    "tt_daily": (_tt_daily, ("cb_tt", "total_cost_tt", "income_base_tt")),
    "deposit_log": (_project_log("deposit_log", "deposit_time", "deposit_yxt_cash", "deposit_amount",
                                 ts_required=True), ("deposit_yxt_cash",)),
    "present_log": (_project_log("present_log", "present_time", "deposit_yxt_gift", "present_amount",
                                 ts_required=True), ("deposit_yxt_gift",)),
    "refund_log": (_project_log("refund_log", "refund_time", "refund_yxt_cash", "refund_amount"),
                   ("refund_yxt_cash",)),
    "gift_refund_log": (_project_log("gift_refund_log", "gift_refund_time", "refund_yxt_gift",
                                     "gift_refund_amount"), ("refund_yxt_gift",)),
    "consume_log": (_consume, ("total_cost_yxt", "income_base_yxt")),
    "media_cost": (_media, ("cb_yxt",)),
}


def fact_sources(src: Sources, p: Params | None = None, names=None) -> dict[str, FactSource]:
    """The ledger tables that hold any of ``names`` (all when None), with their measures."""
    p = p or Params()
    return {t: build(src, p) for t, (build, ms) in SOURCES.items()
            if names is None or any(m in names for m in ms)}


def facts_long(src: Sources, names: list[str] | None = None, *, p: Params | None = None,
               keep: tuple[str, ...] = ("customer_id",), by: tuple[str, ...] = (), apart: bool = False) -> DataFrame:
    """Long rows ``(keep..., stat_date, by..., metric, amount)`` of the named
    measures (all when ``names`` is None).

    One scan per source table; the tables are stacked, joined to the unified
    bridge and summed per group (see ``operators.ledger``).  ``apart``: beyond the
    broadcast bound the key spaces are settled one after the other (``operators.parts``).
    """
    sources, tags = [], []
    window = (p or Params()).window
    for s in fact_sources(src, p, names).values():
        ms = [m for m in s.measures if names is None or m.name in names]
        fact = s.fact if window is None else s.fact.filter(day_window(s.ts, s.day, window, epoch=s.epoch))
        sources.append((fact, s.key, s.day, ms, s.tag))
        if s.tag not in tags:
            tags.append(s.tag)
    if not sources:
        raise KeyError(f"unknown measures {names}")
    rows, bound = bridge_rows(src, tags), (p or Params()).max_broadcast_bytes
    return ledger_long_many(sources, bridges(src, tags, small=fits(rows, bound)), keep=keep, by=by, bridge_rows=rows,
                            max_broadcast_bytes=bound,
                            settle=(lambda df, tag: settled(df, f"ledger-{tag}")) if apart else None)


def fact_daily(src: Sources, names: list[str], *, p: Params | None = None,
               keep: tuple[str, ...] = ("customer_id",), by: tuple[str, ...] = ()) -> DataFrame:
    """Wide ``(keep..., stat_date, by..., <names>...)``."""
    long = facts_long(src, names, p=p, keep=keep, by=by)
    wide = sum_long(long, names, grain=(*keep, "stat_date", *by))
    return wide.select(*keep, "stat_date", *by, *[units_to_money(n).alias(n) for n in names])


# ---- one function per query of the reference ------------------------------

def own_cash_deposit(src, p=None):            # deposits on the own platform
    return fact_daily(src, ["deposit_yxt_cash"], p=p)


def own_gift_deposit(src, p=None):
    return fact_daily(src, ["deposit_yxt_gift"], p=p)


def gdt_deposit(src, p=None):
    return fact_daily(src, ["deposit_all_gdt"], p=p)


def tt_deposit(src, p=None):
    return fact_daily(src, ["deposit_all_tt"], p=p)


def wechat_deposit(src, p=None):
    return fact_daily(src, ["deposit_all_wechat"], p=p)


def gdt_spend_by_fund_type(src, p=None):
    """GDT spend per customer, fund type and day (all four fund types)."""
    long = facts_long(src, ["total_cost_gdt"], p=p, by=("account_type",))
    wide = sum_long(long, ["total_cost_gdt"], grain=("customer_id", "stat_date", "account_type"))
    return wide.select("customer_id", "stat_date", "account_type", units_to_money("total_cost_gdt").alias("cost"))


def gdt_spend(src, p=None):
    return fact_daily(src, ["total_cost_gdt"], p=p)


def gdt_cost_basis(src, p=None):
    return fact_daily(src, ["cb_gdt"], p=p)


def wechat_spend(src, p=None):
    return fact_daily(src, ["total_cost_wechat"], p=p)


def tt_spend(src, p=None):
    """Cash spend (cost basis) and total spend of TT."""
    return fact_daily(src, ["cb_tt", "total_cost_tt"], p=p)


def own_spend(src, p=None):
    return fact_daily(src, ["total_cost_yxt"], p=p)


def wechat_refund(src, p=None):
    return fact_daily(src, ["refund_all_wechat"], p=p)


def tt_refund(src, p=None):
    return fact_daily(src, ["refund_all_tt"], p=p)


def gdt_refund(src, p=None):
    return fact_daily(src, ["refund_all_gdt"], p=p)


def own_cash_refund(src, p=None):
    return fact_daily(src, ["refund_yxt_cash"], p=p)


def own_gift_refund(src, p=None):
    return fact_daily(src, ["refund_yxt_gift"], p=p)


def own_cost_basis(src, p=None):
    """Media cost of own-platform projects since ``media_cost_since``."""
    return fact_daily(src, ["cb_yxt"], p=p)


def spend_by_entity(src, p=None, *, long: DataFrame | None = None, units: bool = False):
    """Spend per customer, legal entity, day and platform: the base of net income.
    ``platform_id`` says which contracts apply (1 own, 2 GDT, 3 TT, 4 WeChat).
    ``long``: entity-grain long rows (one per customer, entity, day and metric,
    as ``facts_long`` gives them) that already hold the income-base measures;
    ``units``: keep ``cost`` in integer units."""
    if long is None:
        long = facts_long(src, list(INCOME_BASE), p=p, keep=("customer_id", "entity_id"), apart=True)
    # one row per (customer, entity, day, metric) and one platform per metric: a projection
    platform = remap("metric", INCOME_BASE, default=None, keep_others=False)
    out = long.filter(F.col("metric").isin(*INCOME_BASE)).select(
        "customer_id", "entity_id", platform.alias("platform_id"), "stat_date", F.col("amount").alias("cost"))
    return out if units else out.withColumn("cost", units_to_money("cost"))


def invoice_units(src: Sources, *, result: str = INVOICE_RESULT, status: str = INVOICE_STATUS,
                  window=None) -> DataFrame:
    """``(customer_id, stat_date, invoice_amount)`` in integer units.

    Each invoice counts once per matching process code (the reference left-joins
    the code table without using it, H12): the codes are counted per value
    first, so the join is one-to-one and a repeated code never fans out rows.
    """
    codes = src.process_codes.groupBy(F.col("process_instance_code").alias("_code")).agg(
        F.count(F.lit(1)).alias("_times"))
    inv = src.invoices.filter((F.col("result") == result) & (F.col("status") == status)
                              & F.col("customer_id").isNotNull())
    if window is not None:
        inv = inv.filter(day_window("instance_finish_time", day_of("instance_finish_time"), window))
    codes = codes.hint("merge")  # a row an invoice: never through the driver
    j = inv.join(codes, inv["process_instance_id"] == codes["_code"], "left")
    amount = money_units("invoice_balance") * F.coalesce(F.col("_times"), F.lit(1))
    return j.groupBy("customer_id", day_of("instance_finish_time").alias("stat_date")).agg(
        F.sum(amount).alias("invoice_amount"))


def invoices_daily(src: Sources, **kw) -> DataFrame:
    """Invoiced amount per customer and day of the finished process (agreed
    and completed invoices only)."""
    return invoice_units(src, **kw).withColumn("invoice_amount", units_to_money("invoice_amount"))


def receipt_units(src: Sources, *, window=None) -> DataFrame:
    """``(customer_id, stat_date, arrive_amount)`` in integer units.  An order
    counts only if its entity is its customer's: that is settled on the orders,
    so a line is shuffled once, with its order's key, its day and its amount."""
    lines = src.receipt_lines.filter(F.col("is_delete") == 0)
    if window is not None:
        lines = lines.filter(day_window("receipt_date", day_of("receipt_date"), window))
    lines = lines.select(F.col("arrival_money_order_id").alias("_order"), day_of("receipt_date").alias("stat_date"),
                         money_units("receipt_money").alias("_amt"))
    ents = src.entities.select(F.col("id").alias("customer_entity_id"), "customer_id")
    heads = src.receipt_heads.select(F.col("id").alias("_order"), "customer_id", "customer_entity_id").join(
        ents, ["customer_entity_id", "customer_id"]).select("_order", "customer_id")
    j = lines.join(heads.hint("merge"), "_order")
    return j.groupBy("customer_id", "stat_date").agg(F.sum("_amt").alias("arrive_amount"))


def receipts_daily(src: Sources) -> DataFrame:
    """Received money per customer and day; lines marked deleted do not count,
    and the order's entity must belong to the order's customer."""
    return receipt_units(src).withColumn("arrive_amount", units_to_money("arrive_amount"))


def customer_list(src: Sources) -> DataFrame:
    """All customer ids, ascending."""
    return src.customers.select(F.col("id").alias("customer_id")).orderBy("customer_id")

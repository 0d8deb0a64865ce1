"""The registered test queries: stand-in inputs -> library job -> presented result.

``present`` only changes the presentation of a finished result (days as
``yyyy-MM-dd`` text, exact decimals as doubles) so that it compares with the
DuckDB oracle column by column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from ..operators.calendar import date_spine, fill_grid
from ..plans import contracts as C
from ..plans import facts as Fa
from ..plans.snapshot import customer_day_snapshot
from . import oracle as O
from .standins import (TEST_AGENTS, TEST_AS_OF, TEST_MEDIA_COST_SINCE, TEST_START, TestTables,
                       build_sources)

PARAMS = Fa.Params(agents=TEST_AGENTS, tz="UTC", media_cost_since=TEST_MEDIA_COST_SINCE)


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _src(spark: SparkSession, sf_dir: str):
    return build_sources(TestTables(spark, sf_dir))


def _fact(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: present(fn(_src(spark, sf), PARAMS))


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return present(customer_day_snapshot(_src(spark, sf), start=TEST_START, as_of=TEST_AS_OF, p=PARAMS))


def _spine(spark, sf):
    src = _src(spark, sf)
    return present(date_spine(src.customers.select(F.col("id").alias("customer_id")), TEST_START, TEST_AS_OF))


def _fill_grid(spark, sf):
    src = _src(spark, sf)
    spine = date_spine(src.customers.select(F.col("id").alias("customer_id")), TEST_START, TEST_AS_OF)
    facts = [Fa.fact_daily(src, [m], p=PARAMS) for m in O.FILL_GRID_MEASURES]
    return present(fill_grid(spine, facts, ["customer_id", "stat_date"]))


def _net_income(expanded: bool):
    return lambda spark, sf: present(C.net_income(_src(spark, sf), PARAMS, expanded=expanded))


#: Plans made from ``Sources`` alone (a test builds them and counts the jobs that starts).
QUERIES_BUILT_FROM_SOURCES = [
    lambda src: customer_day_snapshot(src, start=TEST_START, as_of=TEST_AS_OF, p=PARAMS),
    lambda src: C.net_income(src, PARAMS),
    lambda src: Fa.gdt_deposit(src, PARAMS),
    lambda src: C.settlement_adjustments(src),
]

LEDGER_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "deposit_own_cash": _fact(Fa.own_cash_deposit),
    "deposit_own_gift": _fact(Fa.own_gift_deposit),
    "deposit_gdt": _fact(Fa.gdt_deposit),
    "deposit_tt": _fact(Fa.tt_deposit),
    "deposit_wechat_epoch": _fact(Fa.wechat_deposit),
    "spend_gdt_by_fund_type": _fact(Fa.gdt_spend_by_fund_type),
    "spend_gdt": _fact(Fa.gdt_spend),
    "cost_basis_gdt": _fact(Fa.gdt_cost_basis),
    "spend_wechat": _fact(Fa.wechat_spend),
    "spend_tt_two_measures": _fact(Fa.tt_spend),
    "spend_own": _fact(Fa.own_spend),
    "refund_wechat": _fact(Fa.wechat_refund),
    "refund_tt": _fact(Fa.tt_refund),
    "refund_gdt": _fact(Fa.gdt_refund),
    "refund_own_cash": _fact(Fa.own_cash_refund),
    "refund_own_gift": _fact(Fa.own_gift_refund),
    "cost_basis_own": _fact(Fa.own_cost_basis),
    "spend_by_entity": _fact(Fa.spend_by_entity),
    "invoices_daily": lambda spark, sf: present(Fa.invoices_daily(_src(spark, sf))),
    "receipts_daily": lambda spark, sf: present(Fa.receipts_daily(_src(spark, sf))),
    "customer_list": lambda spark, sf: present(Fa.customer_list(_src(spark, sf))),
    "contract_terms": lambda spark, sf: present(C.contract_terms(_src(spark, sf))),
    "contract_daily_rates": lambda spark, sf: present(C.daily_rates(C.contract_terms(_src(spark, sf)))),
    "net_income_expanded": _net_income(True),
    "net_income_interval": _net_income(False),
    "date_spine": _spine,
    "fill_grid": _fill_grid,
    "customer_day_snapshot": snapshot,
}

LEDGER_ORACLE: dict[str, str] = {
    "deposit_own_cash": O.fact_query(["deposit_yxt_cash"]),
    "deposit_own_gift": O.fact_query(["deposit_yxt_gift"]),
    "deposit_gdt": O.fact_query(["deposit_all_gdt"]),
    "deposit_tt": O.fact_query(["deposit_all_tt"]),
    "deposit_wechat_epoch": O.fact_query(["deposit_all_wechat"]),
    "spend_gdt_by_fund_type": O.spend_by_fund_type(),
    "spend_gdt": O.fact_query(["total_cost_gdt"]),
    "cost_basis_gdt": O.fact_query(["cb_gdt"]),
    "spend_wechat": O.fact_query(["total_cost_wechat"]),
    "spend_tt_two_measures": O.fact_query(["cb_tt", "total_cost_tt"]),
    "spend_own": O.fact_query(["total_cost_yxt"]),
    "refund_wechat": O.fact_query(["refund_all_wechat"]),
    "refund_tt": O.fact_query(["refund_all_tt"]),
    "refund_gdt": O.fact_query(["refund_all_gdt"]),
    "refund_own_cash": O.fact_query(["refund_yxt_cash"]),
    "refund_own_gift": O.fact_query(["refund_yxt_gift"]),
    "cost_basis_own": O.cost_basis_own(),
    "spend_by_entity": O.spend_by_entity(),
    "invoices_daily": O.invoices_daily(),
    "receipts_daily": O.receipts_daily(),
    "customer_list": O.customer_list(),
    "contract_terms": O.contract_terms(),
    "contract_daily_rates": O.contract_daily_rates(),
    "net_income_expanded": O.net_income(),
    "net_income_interval": O.net_income(),
    "date_spine": O.date_spine(),
    "fill_grid": O.fill_grid(),
    "customer_day_snapshot": O.customer_day_snapshot(),
}

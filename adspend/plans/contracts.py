"""Contract terms as daily rebate rates, net income, and settlement detail."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_string, money, ratio_income, remap, units_to_money
from ..operators.calendar import apportion_daily, expand_period, period_bounds
from ..operators.groups import first_per_group
from ..operators.intervals import interval_join
from ..operators.sizing import broadcast_if_small
from ..sources.tables import Sources
from .facts import Params, spend_by_entity, to_date

# ---- fixed values (as the reference states them) -------------------------
CONTRACT_MEDIA = (1, 2, 3, 4)
CONTRACT_MEDIA_TO_PLATFORM = {3: 4, 4: 3}
CONTRACT_TEST_REMARK = "测试"
REBATE_SETTLE_TYPE = 2
BASIS_POINT = Decimal("0.0001")
PLATFORM_BY_NAME = {"今日头条": 3, "广点通": 2, "亿信推": 1, "微信": 4}
SETTLEMENT_MONEY = ("cash_consumed", "cash_deposit", "gift_consumed", "gift_deposit",
                    "credit_consumed", "credit_deposit", "coupon_consumed", "coupon_deposit")
SETTLEMENT_RESULT, SETTLEMENT_STATUS = "agree", "COMPLETED"
# ---------------------------------------------------------------------------

# name of the income measure of each platform
INCOME_NAME = {2: "incoming_gdt", 3: "incoming_tt", 4: "incoming_wechat", 1: "incoming_yxt"}


def contract_terms(src: Sources, *, media=CONTRACT_MEDIA, media_map=CONTRACT_MEDIA_TO_PLATFORM,
                   exclude_remark: str = CONTRACT_TEST_REMARK) -> DataFrame:
    """One row per contract line: entity, platform, rebate ratio and period.

    Lines whose remark contains ``exclude_remark`` are test lines and dropped;
    so is a line without remark (``NOT LIKE`` on NULL).  The ratio is the
    rebate in basis points for settle type 2, else 0.  Media ids are mapped to
    platform ids by ``media_map`` (by default 3 and 4 are swapped).
    """
    lines = src.contract_lines.filter(F.col("media_id").isin(*media)
                                      & ~F.col("remark").contains(exclude_remark))
    heads = src.contracts.select(F.col("id").alias("contract_id"), "customer_entity_id", "settle_type")
    ratio = (F.when(F.col("settle_type") == REBATE_SETTLE_TYPE,
                    F.coalesce(F.col("contract_rebate"), F.lit(0)) * F.lit(BASIS_POINT))
             .otherwise(F.lit(BASIS_POINT) * 0))
    return lines.join(heads, "contract_id").select(
        "customer_entity_id",
        F.col("id").alias("contract_content_id"),
        remap("media_id", media_map).alias("platform_id"),
        ratio.alias("gift_ratio"),
        "contract_begin_date", "contract_end_date")


def clip_periods(terms: DataFrame, window: tuple | None) -> DataFrame:
    """Contract periods cut to the days of ``window`` (None: as they are); lines
    without a day in it go, so a run over a few days expands a few days."""
    if window is None:
        return terms
    first, last = (F.lit(to_date(d)) for d in window)
    lo, hi = period_bounds("contract_begin_date", "contract_end_date")
    return terms.where((lo <= last) & (hi >= first)).withColumns({
        "contract_begin_date": F.greatest(lo, first), "contract_end_date": F.least(hi, last)})


def daily_rates(terms: DataFrame, window: tuple | None = None) -> DataFrame:
    """Each contract line's ratio on every day of its period (TS-2, TS-3), or
    of the part of it in ``window``.

    Reversed periods span both dates, a missing end gives the begin day only
    (H14).  A line that appears twice keeps the larger ratio per day.
    """
    days = expand_period(clip_periods(terms, window), "contract_begin_date", "contract_end_date")
    return days.groupBy("customer_entity_id", "platform_id", "contract_content_id", "stat_date").agg(
        F.max("gift_ratio").alias("gift_ratio"))


def net_income(src: Sources, p: Params | None = None, *, expanded: bool = True,
               spend: DataFrame | None = None, units: bool = False, **terms_kw) -> DataFrame:
    """Income per customer and day and platform: spend divided by ``1 + ratio``
    of every contract line covering the day (a day covered by two lines counts
    twice, one with none counts at ratio 0; H4), summed.  Long form
    ``(customer_id, stat_date, metric, amount)``.

    ``expanded=True`` joins the daily rates table; ``False`` joins the contract
    periods directly with ``interval_join``.  Both give the same rows.  The
    periods are cut to the run's window first, and the rates are broadcast only
    if their days, known from the source's sizes, fit.
    ``spend``: spend by entity in units, if already computed; ``units``: keep
    ``amount`` in integer units.
    """
    spend = (spend if spend is not None else spend_by_entity(src, p, units=True)).withColumnRenamed(
        "entity_id", "customer_entity_id")
    terms, window = contract_terms(src, **terms_kw), (p or Params()).window
    if expanded:
        sizes, days = src.sizes(), None
        if window is not None:
            days = (to_date(window[1]) - to_date(window[0])).days + 1
        rows = sizes["contract_days"] if days is None else min(sizes["contract_days"], days * sizes["contract_lines"])
        rates = broadcast_if_small(daily_rates(terms, window), rows, (p or Params()).max_broadcast_bytes)
        j = spend.join(rates, ["customer_entity_id", "platform_id", "stat_date"], "left")
    else:
        j = interval_join(spend, clip_periods(terms, window), ["customer_entity_id", "platform_id"], day="stat_date",
                          begin="contract_begin_date", end="contract_end_date")
    income = ratio_income("cost", "gift_ratio")
    name = remap("platform_id", INCOME_NAME, default=None, keep_others=False)
    out = j.groupBy("customer_id", "stat_date", name.alias("metric")).agg(
        F.coalesce(F.sum(income), F.lit(0).cast("bigint")).alias("amount"))
    return out if units else out.withColumn("amount", units_to_money("amount"))


def settlement_detail(src: Sources, *, platform_by_name=PLATFORM_BY_NAME) -> DataFrame:
    """Settlement lines with their head and the contract lines of the same
    platform (lines of other platforms map to 0 and match nothing)."""
    lines = src.settlement_lines.select(
        remap("platform_name", platform_by_name, default=0, keep_others=False).alias("pig_platform_id"),
        "process_instance_id", "account_id_platform", "business_id",
        *[money(c).alias(c) for c in SETTLEMENT_MONEY])
    heads = src.settlement_heads.select("process_instance_id", "business_id", "kpi_start_date",
                                        "kpi_end_date", "result", "status", "billed_type",
                                        F.col("contract_info").alias("contract_id"))
    contracts = src.contracts.select(F.col("id").alias("contract_id"), "customer_entity_id")
    contents = src.contract_lines.select(
        "contract_id", F.col("media_id").alias("pig_platform_id"),
        day_string("contract_begin_date").alias("contract_begin_date"),
        day_string("contract_end_date").alias("contract_end_date"))
    j = (lines.join(heads, ["process_instance_id", "business_id"])
         .join(contracts, "contract_id")
         .join(contents, ["contract_id", "pig_platform_id"]))
    return j.select("kpi_start_date", "kpi_end_date", "contract_begin_date", "contract_end_date",
                    "pig_platform_id", "customer_entity_id", "result", "status", "billed_type",
                    "account_id_platform", *SETTLEMENT_MONEY, "process_instance_id", "business_id")


def settlement_first(detail: DataFrame) -> DataFrame:
    """First detail row per settlement, business, platform and platform account
    (ordered by contract period, then by the remaining columns)."""
    return first_per_group(detail, ["process_instance_id", "business_id", "pig_platform_id",
                                    "account_id_platform"],
                           ["contract_begin_date", "contract_end_date", "customer_entity_id"])


def settlement_adjustments(src: Sources, *, result: str = SETTLEMENT_RESULT,
                           status: str = SETTLEMENT_STATUS) -> DataFrame:
    """Agreed, completed, non-zero settlement adjustments spread evenly over
    the days of their KPI period, per customer and business (Q-35)."""
    heads = src.settlement_heads.filter(
        F.col("customer_id").isNotNull() & (F.col("kpi_end_date") >= F.col("kpi_start_date"))
        & (F.col("result") == result) & (F.col("status") == status)
        & (F.col("adjust_amount") != 0))
    heads = heads.select("customer_id", "business_id", "kpi_start_date", "kpi_end_date",
                         money("adjust_amount").alias("adjust_amount"))
    return apportion_daily(heads, ["customer_id", "business_id"], "kpi_start_date", "kpi_end_date",
                           "adjust_amount", name="kpi_date")

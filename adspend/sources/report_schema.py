"""Schemas of the advertiser reports, and the column lists that follow from them.

A report row counts an advertiser's steps (views, registrations, orders ...)
in one or more kinds of measure, so a column's name is the step and the kind:
``download`` with ``count rate cost`` gives ``download_count``,
``download_rate`` and ``download_cost``. Types follow from the name as well:
rates, returns and rewards are decimals, all else are whole numbers (held as
64 bits, so that a page is never refused for a large number).

Everything else is derived: the fields that a request asks for, the columns
that go into the agent's roll-up, and which of these are summed or averaged.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql.types import DataType, DateType, DecimalType, IntegerType, LongType, StructField, StructType

# ---- fixed values (names as the report API has them) ----------------------
PLAIN = """view_count thousand_display_price valid_click_count ctr cpc cost click_activated_rate key_page_uv
    web_reg_rate own_page_navigation_count own_page_navi_cost web_cart_amount platform_coupon_click_count
    app_activated_checkout_rate web_activated_checkout_rate inte_phone_count external_form_reservation_count
    game_create_role_count game_authorize_count game_tutorial_finish_count arppu_cost arpu_cost
    landing_page_click_count scan_follow_count phone_consult_count tool_consult_count overall_leads_purchase_count
    valid_leads_uv valid_phone_uv wechat_app_register_uv add_wishlist_count no_interest_count
    view_commodity_page_uv potential_customer_phone_uv"""
STEPS = {
    "download": "count rate cost", "activated": "count rate cost", "key_page_view": "count cost",
    "platform_page_view": "count rate", "web_commodity_page_view": "count rate cost",
    "app_commodity_page_view": "count rate cost", "web_register": "count cost uv", "app_register": "count rate cost",
    "page_consult": "count rate cost", "page_phone_call_direct": "count rate cost",
    "page_phone_call_back": "count rate cost", "platform_page_navigation": "count cost",
    "platform_shop_navigation": "count cost", "web_application": "count cost", "app_application": "count cost",
    "page_reservation": "count rate cost", "add_to_cart": "price amount", "app_add_to_cart": "count cost",
    "own_page_coupon_get": "count cost", "platform_coupon_get": "count rate cost",
    "web_order": "count rate cost amount", "app_order": "count rate cost amount",
    "web_checkout": "count rate cost amount", "app_checkout": "count rate cost amount",
    "order": "amount unit_price roi", "deliver": "count rate cost", "sign_in": "count cost",
    "install": "count rate cost", "retention": "count rate cost", "follow": "count cost", "forward": "count cost",
    "read": "count cost", "praise": "count cost", "comment": "count cost", "phone_call": "count uv",
    "ad_pur_val": "web app", "effective": "leads_count cost reserve_count consult_count phone_count",
    "potential": "reserve_count consult_count phone_count",
    "cheout": "fd td ow tw om fd_reward td_reward ow_reward tw_reward om_reward total_reward",
    "first_pay": "count rate cost", "pre_cre": "web app web_val app_val", "cre": "web app web_val app_val",
    "withdr_dep": "web app web_val app_val", "lottery_leads": "count cost", "conversions": "count rate cost",
    "deep_conversions": "count rate cost", "first_memcard_web": "count rate cost",
    "first_memcard_app": "count rate cost", "memcard": "web_count app_count", "valuable_click": "count rate cost",
    "leads_purchase": "count rate cost uv", "web": "apply_uv credit_uv",
    "app": "apply_uv pre_credit_uv credit_uv withdraw_uv", "first_day_order": "count amount",
    "video": "outer_play_count inner_play_count play_count",
    "click": "detail_count head_count image_count nick_count poi_count", "cpn_click_button": "count uv",
    "special_page_exp": "cost uv",
}
DAILY_STEPS = {"web_add_to_cart": "count cost"}  # in the daily report only
DECIMAL_ENDINGS = ("rate", "roi", "reward", "ctr")
AVERAGED = ("thousand_display_price", "cpc")  # in the agent's roll-up; all other whole numbers are summed
# ---------------------------------------------------------------------------

RATE = DecimalType(20, 4)


def measure_type(name: str) -> DataType:
    return RATE if name.rsplit("_", 1)[-1] in DECIMAL_ENDINGS else LongType()


def measures(plain: str, *steps: dict[str, str]) -> tuple[str, ...]:
    """Plain names, then every step with its kinds."""
    return (*plain.split(), *(f"{step}_{kind}" for part in steps for step, kinds in part.items() for kind in kinds.split()))


@dataclass(frozen=True)
class ReportSchema:
    """Columns of one report table: its keys, then its measures."""

    name: str
    measures: tuple[str, ...]
    hourly: bool = False
    averaged: tuple[str, ...] = AVERAGED
    #: what a request names besides the columns of the table; not landed
    also_asked: tuple[str, ...] = field(default=())

    @property
    def keys(self) -> tuple[str, ...]:
        """One row each: landed rows must be unique in these."""
        return ("stat_date", "account_id", *(("hour",) if self.hourly else ()))

    @property
    def struct(self) -> StructType:
        """The landed table."""
        kinds = {"stat_date": DateType(), "account_id": LongType(), "hour": IntegerType()}
        return StructType([StructField(c, kinds[c]) for c in self.keys]
                          + [StructField(c, measure_type(c)) for c in self.measures])

    @property
    def request_fields(self) -> tuple[str, ...]:
        """Fields a report request asks for: all columns that the request itself doesn't give."""
        return (*self.also_asked, *self.keys[2:], *self.measures)

    def row(self, fields: Iterable[str] | None = None) -> StructType:
        """Schema of a page's rows, of the asked ``fields`` only: what is not asked for isn't parsed."""
        asked = set(self.request_fields if fields is None else fields)
        unknown = asked - set(self.request_fields)
        if unknown:
            raise ValueError(f"no fields of the {self.name} report: {sorted(unknown)}")
        return StructType([f for f in self.struct.fields if f.name in asked])

    @property
    def whole(self) -> tuple[str, ...]:
        """Measures that are whole numbers: those that are rolled up."""
        return tuple(c for c in self.measures if isinstance(measure_type(c), LongType))

    @property
    def rollup_columns(self) -> tuple[str, ...]:
        """The whitelist of the roll-up: the day, and every whole-number measure."""
        return ("stat_date", *self.whole)

    @property
    def summed(self) -> tuple[str, ...]:
        return tuple(c for c in self.whole if c not in self.averaged)


DAILY = ReportSchema("daily", measures(PLAIN, STEPS, DAILY_STEPS), also_asked=("date",))
HOURLY = ReportSchema("hourly", measures(PLAIN, STEPS), hourly=True)
REPORTS = {s.name: s for s in (DAILY, HOURLY)}

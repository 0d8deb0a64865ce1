"""Registered queries for advertiser reports, landed JSON, merges and
settlements, with their DuckDB oracles.

The JSON stand-ins turn ``events`` rows into landed responses (one item per
event, pages of at most 100 events by ``event_id`` block, some pages refused
by the API); the jobs then parse, filter and flatten them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.calendar import date_spine
from ..functions.columns import day_or, optional_column
from ..operators.groups import earliest_row_flag, group_mean_back, keep_on_first
from ..operators.prefix_fill import forward_fill
from ..operators.merge import duplicate_keys, last_per_key, replace_slice, upsert, write_snapshot, write_unique
from ..operators.table_writes import read_table
from ..operators.versioned import VersionedTable
from ..plans import contracts as C
from ..plans import facts as Fa
from ..plans import reports as R
from ..session import scratch_path
from ..sources import report_schema as S
from ..sources.pages import (parse_account_pages, parse_channel_report, parse_report_pages, read_pages_by_day,
                             report_page_rejects, to_json_rows, write_pages_by_day)
from ..sources.tables import SOURCE_SCHEMAS, empty_like
from .oracle import _SPINE, fact_select
from . import wide_reports as W
from .queries import PARAMS, present
from .standins import (STANDIN_SQL, TEST_AGENT_ID, TEST_AS_OF, TEST_START, TestTables, build_sources,
                       report_events)

CHANNEL_ID, CHANNEL_TYPE = 7, 2
PAGE_ROW = StructType([StructField("hour", IntegerType()), StructField("view_count", LongType()),
                       StructField("valid_click_count", LongType()), StructField("cost", LongType()),
                       StructField("date", StringType())])
REFUSED_ACCOUNT_EVERY = W.REFUSED_ACCOUNT_EVERY
FIRST_PULL_UNTIL, SECOND_PULL_FROM = "2024-01-16", "2024-01-10"
DAY_REPULL_FROM = "2024-01-20"
FIRST_PULL = f"ts < TIMESTAMP_NTZ '{FIRST_PULL_UNTIL} 00:00:00'"
SECOND_PULL = f"ts >= TIMESTAMP_NTZ '{SECOND_PULL_FROM} 00:00:00'"
ROLLUP_DAY = "2024-01-12"


# ---- stand-ins -------------------------------------------------------------

def report_page_lines(t: TestTables, where: str = "TRUE") -> DataFrame:
    ev = t.events.where(where)
    item = F.struct(F.hour("ts").alias("hour"),
                    (F.col("event_type") == "view").cast("long").alias("view_count"),
                    (F.col("event_type") == "click").cast("long").alias("valid_click_count"),
                    F.round(F.col("value") * 100).cast("long").alias("cost"),
                    F.date_format("ts", "yyyy-MM-dd").alias("date"))
    pages = ev.groupBy(F.col("user_id").alias("account_id"), F.to_date("ts").alias("stat_date"),
                       F.floor(F.col("event_id") / 100).cast("int").alias("page")
                       ).agg(F.collect_list(item).alias("list"))
    code = F.when(F.col("account_id") % REFUSED_ACCOUNT_EVERY == 0, 40001).otherwise(0)

    def envelope(lst, page):
        return F.struct("account_id", "stat_date", page.alias("page"),
                        F.struct(code.alias("code"), F.lit("").alias("message"),
                                 F.struct(lst.alias("list"),
                                          F.struct(F.lit(1).alias("total_page")).alias("page_info")
                                          ).alias("data")).alias("response"))
    full = pages.select(F.to_json(envelope(F.col("list"), F.col("page") + 1)).alias("value"))
    empty = pages.select(F.to_json(envelope(F.filter("list", lambda x: F.lit(False)),
                                            -F.col("page"))).alias("value"))
    return full.unionByName(empty)


def account_page_lines(t: TestTables, where: str = "TRUE") -> DataFrame:
    item = F.struct(F.col("user_id").alias("account_id"),
                    F.concat(F.lit("corp "), F.col("user_id").cast("string")).alias("corporation_name"),
                    F.lit("ACTIVE").alias("system_status"))
    g = t.events.where(where).groupBy(F.floor(F.col("event_id") / 100).alias("blk")).agg(F.collect_list(item).alias("list"))
    code = F.when(F.col("blk") % 7 == 3, 11000).otherwise(0)
    return g.select(F.to_json(F.struct(code.alias("code"), F.lit("").alias("message"),
                                       F.struct("list").alias("data"))).alias("value"))


def channel_lines(t: TestTables, *, since: str | None = None, until: str | None = None) -> DataFrame:
    ev = t.events
    if since:
        ev = ev.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until:
        ev = ev.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    k = F.get_json_object("props", "$.k").cast("long")
    item = F.struct(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("time"),
                    k.alias("bids"), (k % 7).alias("bids_win"), F.col("user_id").alias("display"),
                    (F.col("user_id") % 10).alias("uniq_display"),
                    (F.col("event_type") == "click").cast("long").alias("click"),
                    F.lit(0).cast("long").alias("uniq_click"), F.col("value").alias("fee"))
    g = ev.groupBy(F.floor(F.col("event_id") / 10).alias("seq")).agg(
        F.array_sort(F.collect_list(item)).alias("data"))
    ec = F.when(F.col("seq") % 13 == 0, 500).otherwise(200)
    return g.select(F.to_json(F.struct(ec.alias("ec"), "data")).alias("value"), "seq")


# ---- queries ---------------------------------------------------------------

def _ev(spark, sf):
    return report_events(TestTables(spark, sf))


def _hourly(spark, sf):
    return present(R.hourly_report(_ev(spark, sf)))


def _daily(spark, sf):
    return present(R.daily_report(_ev(spark, sf)))


def _active(spark, sf):
    return present(R.active_accounts(R.hourly_report(_ev(spark, sf))))


def _known_union(spark, sf):
    t = TestTables(spark, sf)
    earlier = R.known_accounts(parse_account_pages(account_page_lines(t, FIRST_PULL)))
    return present(R.known_accounts(parse_account_pages(account_page_lines(t, SECOND_PULL)), earlier))


def _active_earlier(spark, sf):
    ev = _ev(spark, sf)
    earlier = R.active_accounts(R.hourly_report(ev.where(FIRST_PULL)))
    return present(R.active_accounts(R.hourly_report(ev.where(f"{SECOND_PULL} AND event_type = 'purchase'")),
                                     dates=[ROLLUP_DAY], earlier=earlier))


def _landing(spark, sf, schema: S.ReportSchema, active_only: bool):
    """Two pulls of report pages, all fields of the request: rows of the second replace the account-days they carry."""
    t = TestTables(spark, sf)
    old = parse_report_pages(W.page_lines(t, schema, FIRST_PULL), schema.row())
    new = parse_report_pages(W.page_lines(t, schema, f"{SECOND_PULL} AND event_type <> 'error'"), schema.row())
    if active_only:
        new = R.only_active(new, R.active_accounts(R.hourly_report(report_events(t).where("event_type = 'purchase'"))))
    path = scratch_path(spark, "second-pull")
    new.write.parquet(path)  # its rows and its slices are both read: it is parsed once
    new = spark.read.schema(new.schema).parquet(path)
    return present(replace_slice(old, new, ["account_id", "stat_date"]))


def _daily_table(spark, sf, where: str = "TRUE") -> DataFrame:
    """Daily report rows of full width, landed in a table with one folder a day."""
    path = scratch_path(spark, "daily-report")
    rows = parse_report_pages(W.page_lines(TestTables(spark, sf), S.DAILY, where), S.DAILY.row())
    rows.write.partitionBy("stat_date").parquet(path)
    return spark.read.schema(S.DAILY.struct).parquet(path)


def _rollup_day(spark, sf):
    """The agent's days from the first pull, one of them made anew from that day's folder: 171 measures."""
    old = R.agent_rollup(_daily_table(spark, sf, FIRST_PULL), agent_id=TEST_AGENT_ID, schema=S.DAILY)
    new = R.agent_rollup(_daily_table(spark, sf), agent_id=TEST_AGENT_ID, schema=S.DAILY, dates=[ROLLUP_DAY])
    return present(replace_slice(old, new, ["stat_date"]))


DAY_FIELDS = ("hour", "cost", "view_count", "order_roi")


def _pages_by_day(spark, sf):
    """Landed pages in folders by day: a range of days and a few fields are read, the rest stays on disk."""
    path = scratch_path(spark, "landed-pages")
    write_pages_by_day(W.page_lines(TestTables(spark, sf), S.HOURLY), path)
    return present(read_pages_by_day(spark, path, S.HOURLY.row(), fields=DAY_FIELDS, dates=(DAY_REPULL_FROM, "2024-01-22")))


def _rejects(spark, sf):
    r = report_page_rejects(report_page_lines(TestTables(spark, sf)), PAGE_ROW)
    return present(r.groupBy("account_id", "stat_date", "reason").agg(F.count(F.lit(1)).alias("lines")))


def _pages_dates(spark, sf):
    return present(parse_report_pages(report_page_lines(TestTables(spark, sf)), PAGE_ROW, fields=["hour", "cost"],
                                      dates=(DAY_REPULL_FROM, "2024-01-22")))


def _min_bids(spark, sf):
    return present(parse_channel_report(channel_lines(TestTables(spark, sf)), channel_id=CHANNEL_ID,
                                        type_id=CHANNEL_TYPE, seq="seq", min_bids=50))


def _ordered(spark, sf):
    return present(R.ordered_report(R.hourly_report(_ev(spark, sf))))


def _json_rows(spark, sf):
    return to_json_rows(_src(spark, sf).projects)


def _optional(spark, sf):
    p = _src(spark, sf).projects
    return p.select("project_id", optional_column(p, "entity_id", -1).alias("entity_id"),
                    optional_column(p, "discount", 0).alias("discount"))


def _typed_empty(spark, sf):
    """A source that gave nothing stacks with one that gave rows."""
    return empty_like(spark, SOURCE_SCHEMAS["entities"]).unionByName(_src(spark, sf).entities)


def _keep_first(spark, sf):
    h = _src(spark, sf).settlement_heads.select(
        "customer_id", "business_id", "kpi_start_date", (F.col("adjust_amount") * 100).cast("bigint").alias("cents"))
    flagged = earliest_row_flag(h, ["customer_id", "business_id"], ["kpi_start_date"])
    return present(keep_on_first(flagged, "is_first", "cents").groupBy("customer_id", "business_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")))


def _daily_active(spark, sf):
    return present(R.daily_report_of_active(_ev(spark, sf)))


def _both(spark, sf):
    return present(R.both_reports(_ev(spark, sf)))


def _daily_active_joined(spark, sf):
    ev = _ev(spark, sf)
    return present(R.only_active(R.daily_report(ev), R.active_accounts(R.hourly_report(ev))))


def _first_row(spark, sf):
    return present(R.first_row(_hourly(spark, sf), ["account_id", "stat_date", "hour"]))


def _append_twice(spark, sf):
    """A snapshot appended by two runs holds every row twice (H7)."""
    path = scratch_path(spark, "snapshot")
    daily = R.daily_report(_ev(spark, sf))
    for _ in range(2):
        write_snapshot(daily, path)
    return present(spark.read.schema(daily.schema).parquet(path))


def _replaced_versions(spark, sf):
    """Account-days replaced in a versioned table: the first pull, then the second one's slices."""
    ev = _ev(spark, sf)
    old, new = R.hourly_report(ev.where(FIRST_PULL)), R.hourly_report(ev.where(SECOND_PULL))
    t = VersionedTable(spark, scratch_path(spark, "versioned"), old.schema, keys=["account_id", "stat_date", "hour"])
    t.append(old)
    t.replace_slices(new)
    return present(t.read())


def _unique_written(spark, sf):
    """Page rows of unique keys; the rows of repeated keys are in the quarantine folder, counted by day."""
    rows = parse_report_pages(report_page_lines(TestTables(spark, sf)), PAGE_ROW)
    path = scratch_path(spark, "unique")
    write_unique(rows, f"{path}/rows", ["account_id", "stat_date", "hour"], quarantine=f"{path}/repeated")
    kept = read_table(spark, f"{path}/rows", rows.schema).groupBy("stat_date").agg(F.count(F.lit(1)).alias("rows"))
    held = read_table(spark, f"{path}/repeated", rows.schema).groupBy("stat_date").agg(F.count(F.lit(1)).alias("held"))
    return present(kept.join(held, "stat_date", "full_outer").fillna(0, ["rows", "held"]))


def _day_or(spark, sf):
    heads = _src(spark, sf).settlement_heads
    end = F.when(F.col("customer_id") % 3 != 0, F.col("kpi_end_date"))
    return present(heads.select("process_instance_id", day_or(end, TEST_AS_OF).alias("kpi_end_date")))


def _rollup(spark, sf):
    return present(R.agent_rollup(R.daily_report(_ev(spark, sf)), agent_id=TEST_AGENT_ID))


def _rollup_long(spark, sf):
    return present(R.agent_rollup_long(R.daily_report(_ev(spark, sf)), agent_id=TEST_AGENT_ID))


def _replace_account_day(spark, sf):
    ev = _ev(spark, sf)
    old = R.hourly_report(ev)
    new = R.hourly_report(ev.filter(F.col("event_type") != "error"))
    return present(replace_slice(old, new, ["account_id", "stat_date"]))


def _replace_day(spark, sf):
    ev = _ev(spark, sf)
    old = R.daily_report(ev)
    new = R.daily_report(ev.filter((F.col("event_type") != "error")
                                   & (F.col("ts") >= F.lit(DAY_REPULL_FROM).cast("timestamp_ntz"))))
    return present(replace_slice(old, new, ["stat_date"]))


def _pages(spark, sf):
    return present(parse_report_pages(report_page_lines(TestTables(spark, sf)), PAGE_ROW))


def _dup_keys(spark, sf):
    rows = parse_report_pages(report_page_lines(TestTables(spark, sf)), PAGE_ROW)
    return present(duplicate_keys(rows, ["account_id", "stat_date", "hour"]))


def _channel(spark, sf):
    return present(parse_channel_report(channel_lines(TestTables(spark, sf)), channel_id=CHANNEL_ID,
                                        type_id=CHANNEL_TYPE, seq="seq"))


def _channel_upsert(spark, sf):
    t = TestTables(spark, sf)
    keys, order = ["stat_day", "channel_id", "type"], ["batch_seq", "batch_pos"]
    first = parse_channel_report(channel_lines(t, until=FIRST_PULL_UNTIL), channel_id=CHANNEL_ID,
                                 type_id=CHANNEL_TYPE, seq="seq")
    second = parse_channel_report(channel_lines(t, since=SECOND_PULL_FROM), channel_id=CHANNEL_ID,
                                  type_id=CHANNEL_TYPE, seq="seq")
    return present(upsert(last_per_key(first, keys, order), second, keys, order_by=order))


def _src(spark, sf):
    return build_sources(TestTables(spark, sf))


def _settlement_detail(spark, sf):
    return present(C.settlement_detail(_src(spark, sf)))


def _settlement_first(spark, sf):
    return present(C.settlement_first(C.settlement_detail(_src(spark, sf))))


def _apportion(spark, sf):
    return present(C.settlement_adjustments(_src(spark, sf)))


def _earliest(spark, sf):
    h = _src(spark, sf).settlement_heads.select("customer_id", "business_id", "kpi_start_date",
                                                "process_instance_id")
    return present(earliest_row_flag(h, ["customer_id", "business_id"], ["kpi_start_date"]))


def _group_mean(spark, sf):
    h = _src(spark, sf).settlement_heads.select(
        "process_instance_id", "customer_id", (F.col("adjust_amount") * 100).cast("bigint").alias("adjust_cents"))
    return present(group_mean_back(h, ["customer_id"], "adjust_cents"))


def _ffill(spark, sf):
    src = _src(spark, sf)
    spine = date_spine(src.customers.select(F.col("id").alias("customer_id")), TEST_START, TEST_AS_OF)
    dep = Fa.fact_daily(src, ["deposit_all_gdt"], p=PARAMS)
    grid = spine.join(dep, ["customer_id", "stat_date"], "left")
    return present(forward_fill(grid, ["customer_id"], "stat_date", ["deposit_all_gdt"]))


REPORT_QUERIES = {
    "hourly_report": _hourly,
    "daily_report": _daily,
    "active_accounts": _active,
    "known_accounts_union": _known_union,
    "active_accounts_earlier": _active_earlier,
    "hourly_landing": lambda spark, sf: _landing(spark, sf, S.HOURLY, active_only=False),
    "daily_landing_active": lambda spark, sf: _landing(spark, sf, S.DAILY, active_only=True),
    "pages_by_day": _pages_by_day,
    "agent_rollup_day": _rollup_day,
    "report_page_rejects": _rejects,
    "pages_date_range": _pages_dates,
    "channel_min_bids": _min_bids,
    "hourly_report_ordered": _ordered,
    "json_rows": _json_rows,
    "optional_column": _optional,
    "typed_empty_source": _typed_empty,
    "keep_on_first": _keep_first,
    "daily_report_active": _daily_active,
    "daily_report_active_joined": _daily_active_joined,
    "both_reports": _both,
    "first_report_row": _first_row,
    "append_snapshot": _append_twice,
    "replace_slices_versioned": _replaced_versions,
    "unique_keys_written": _unique_written,
    "day_or_default": _day_or,
    "agent_rollup": _rollup,
    "agent_rollup_long": _rollup_long,
    "replace_account_day": _replace_account_day,
    "replace_day": _replace_day,
    "report_pages_json": _pages,
    "duplicate_keys": _dup_keys,
    "channel_report_json": _channel,
    "channel_upsert": _channel_upsert,
    "settlement_detail": _settlement_detail,
    "settlement_first_per_group": _settlement_first,
    "settlement_apportion_daily": _apportion,
    "earliest_row_flag": _earliest,
    "group_mean_back": _group_mean,
    "forward_fill": _ffill,
}


# ---- oracle ----------------------------------------------------------------

def _w(sql: str, names: list[str]) -> str:
    ctes = ",\n".join(f"{n} AS ({STANDIN_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{sql}" if names else sql


def _report_sql(where: str = "TRUE", hourly: bool = True) -> str:
    hour = ", CAST(hour(ts) AS INTEGER)" if hourly else ""
    hour_sel = "CAST(hour(ts) AS INTEGER) AS hour, " if hourly else ""
    return f"""SELECT account_id, CAST(ts AS DATE) AS stat_date, {hour_sel}
        COUNT(*) FILTER (WHERE event_type = 'view') AS view_count,
        COUNT(*) FILTER (WHERE event_type = 'click') AS valid_click_count,
        COUNT(*) FILTER (WHERE event_type = 'signup') AS web_register_count,
        COUNT(*) FILTER (WHERE event_type = 'purchase') AS web_order_count,
        CAST(COALESCE(SUM(cost), 0) AS BIGINT) AS cost,
        CAST(SUM(cost) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS web_order_amount
      FROM report_events WHERE {where} GROUP BY account_id, CAST(ts AS DATE){hour}"""


def _with_rates(inner: str) -> str:
    return f"""SELECT *,
        CASE WHEN view_count = 0 THEN NULL ELSE CAST(valid_click_count AS DOUBLE) / view_count END AS ctr,
        CASE WHEN valid_click_count = 0 THEN NULL ELSE CAST(ROUND(CAST(cost AS DOUBLE) / valid_click_count) AS BIGINT) END AS cpc,
        CASE WHEN view_count = 0 THEN NULL ELSE CAST(ROUND(CAST(cost * 1000 AS DOUBLE) / view_count) AS BIGINT) END AS thousand_display_price
      FROM ({inner}) g"""


def _show(inner: str, day: str = "stat_date") -> str:
    return f"SELECT * REPLACE (strftime({day}, '%Y-%m-%d') AS {day}) FROM ({inner}) q"


_NOT_ERROR = "event_type <> 'error'"
_REPULL = f"{_NOT_ERROR} AND ts >= TIMESTAMP '{DAY_REPULL_FROM}'"
HOURLY = _with_rates(_report_sql())
DAILY = _with_rates(_report_sql(hourly=False))
ACTIVE = f"SELECT DISTINCT account_id FROM ({HOURLY}) h WHERE cost > 0"
SUMS = ["view_count", "valid_click_count", "web_register_count", "web_order_count", "cost", "web_order_amount"]
MEANS = ["cpc", "thousand_display_price"]
ROLLUP = ("SELECT stat_date, " + ", ".join(f"CAST(COALESCE(SUM({c}), 0) AS BIGINT) AS {c}" for c in SUMS)
          + ", " + ", ".join(f"AVG({c}) AS {c}" for c in MEANS)
          + f", {TEST_AGENT_ID} AS agent_id FROM ({DAILY}) d GROUP BY stat_date")
ROLLUP_LONG = " UNION ALL ".join(
    f"SELECT stat_date, {TEST_AGENT_ID} AS agent_id, '{c}' AS metric, "
    + (f"AVG({c})" if c in MEANS else f"CAST(COALESCE(SUM({c}), 0) AS DOUBLE)")
    + f" AS value FROM ({DAILY}) d GROUP BY stat_date" for c in SUMS + MEANS)
REPLACE_ACCOUNT_DAY = (
    f"WITH o AS ({HOURLY}), n AS ({_with_rates(_report_sql(_NOT_ERROR))}) "
    "SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.account_id = o.account_id "
    "AND n.stat_date = o.stat_date) UNION ALL SELECT * FROM n")
REPLACE_DAY = (
    f"WITH o AS ({DAILY}), n AS ({_with_rates(_report_sql(_REPULL, hourly=False))}) "
    "SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.stat_date = o.stat_date) "
    "UNION ALL SELECT * FROM n")

_EV = ["report_events"]
_NOT_REFUSED = f"user_id % {REFUSED_ACCOUNT_EVERY} <> 0"
PAGES = f"""SELECT user_id AS account_id, CAST(ts AS DATE) AS stat_date, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(event_type = 'view' AS BIGINT) AS view_count, CAST(event_type = 'click' AS BIGINT) AS valid_click_count,
    CAST(ROUND(value * 100) AS BIGINT) AS cost FROM events WHERE {_NOT_REFUSED}"""


def _channel_sql(where: str = "TRUE") -> str:
    return f"""SELECT CAST(ts AS DATE) AS stat_day, {CHANNEL_ID} AS channel_id, {CHANNEL_TYPE} AS type,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS adx_bid,
    CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS adx_winbid,
    user_id AS adx_impression, user_id % 10 AS adx_valid_impression,
    CAST(event_type = 'click' AS BIGINT) AS adx_click, CAST(0 AS BIGINT) AS adx_valid_click, value AS adx_cost,
    event_id // 10 AS batch_seq,
    CAST(ROW_NUMBER() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS INTEGER) AS batch_pos,
    event_id
  FROM events WHERE ({where}) AND (event_id // 10) % 13 <> 0"""


_CH_COLS = ["adx_bid", "adx_winbid", "adx_impression", "adx_valid_impression", "adx_click",
            "adx_valid_click", "adx_cost"]


def _pull(where: str) -> str:
    """Rows of one pull, the last per day (a pull's responses hold its own events only)."""
    return f"""SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY stat_day ORDER BY event_id DESC) AS rn
        FROM ({_channel_sql(where)}) c) x WHERE rn = 1"""


CHANNEL_UPSERT = (
    "SELECT COALESCE(s.stat_day, f.stat_day) AS stat_day, COALESCE(s.channel_id, f.channel_id) AS channel_id, "
    "COALESCE(s.type, f.type) AS type, "
    + ", ".join(f"CASE WHEN s.stat_day IS NOT NULL THEN s.{c} ELSE f.{c} END AS {c}" for c in _CH_COLS)
    + f" FROM ({_pull(f'ts < TIMESTAMP {chr(39)}{FIRST_PULL_UNTIL}{chr(39)}')}) f FULL OUTER JOIN "
    f"({_pull(f'ts >= TIMESTAMP {chr(39)}{SECOND_PULL_FROM}{chr(39)}')}) s ON f.stat_day = s.stat_day")

_MONEY = ["cash_consumed", "cash_deposit", "gift_consumed", "gift_deposit", "credit_consumed",
          "credit_deposit", "coupon_consumed", "coupon_deposit"]
_HEAD = ["kpi_start_date", "kpi_end_date", "result", "status", "billed_type"]
# every settlement head meets its contract's lines, then the settlement lines of the same platform
DETAIL = f"""SELECT {', '.join(_HEAD)}, term.* EXCLUDE (contract_info), spent.account_id_platform,
    {', '.join(f'ifnull(spent.{m}, 0) AS {m}' for m in _MONEY)}, process_instance_id, business_id
  FROM settlement_heads
  JOIN (SELECT contract_id AS contract_info, media_id AS pig_platform_id,
               (SELECT any_value(customer_entity_id) FROM contracts WHERE contracts.id = contract_id) AS customer_entity_id,
               strftime(contract_begin_date, '%Y-%m-%d') AS contract_begin_date,
               strftime(contract_end_date, '%Y-%m-%d') AS contract_end_date
        FROM contract_lines WHERE contract_id IN (SELECT id FROM contracts)) AS term USING (contract_info)
  JOIN (SELECT map {{'今日头条': 3, '广点通': 2, '亿信推': 1, '微信': 4}}[platform_name] AS pig_platform_id,
               * EXCLUDE (platform_name) FROM settlement_lines) AS spent
    USING (process_instance_id, business_id, pig_platform_id)"""
_DETAIL_COLS = ["kpi_start_date", "kpi_end_date", "contract_begin_date", "contract_end_date", "pig_platform_id",
                "customer_entity_id", "result", "status", "billed_type", "account_id_platform", *_MONEY,
                "process_instance_id", "business_id"]
_FIRST_KEYS = ["process_instance_id", "business_id", "pig_platform_id", "account_id_platform"]
_FIRST_ORDER = ["contract_begin_date", "contract_end_date", "customer_entity_id"] + [
    c for c in _DETAIL_COLS if c not in _FIRST_KEYS]
FIRST = f"""SELECT {', '.join(_DETAIL_COLS)} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(_FIRST_KEYS)}
                                 ORDER BY {', '.join(c + ' NULLS FIRST' for c in _FIRST_ORDER)}) AS rn
    FROM ({DETAIL}) d) x WHERE rn = 1"""


def _money_out(inner: str) -> str:
    casts = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _MONEY)
    return (f"SELECT * REPLACE ({casts}, strftime(kpi_start_date, '%Y-%m-%d') AS kpi_start_date, "
            f"strftime(kpi_end_date, '%Y-%m-%d') AS kpi_end_date) FROM ({inner}) z")


APPORTION = """SELECT s.customer_id, s.business_id, strftime(CAST(g.d AS DATE), '%Y-%m-%d') AS kpi_date,
         CAST(f.amt AS DOUBLE) / CAST(datediff('day', s.lo, s.hi) + 1 AS DOUBLE) AS adjust_amount
  FROM (SELECT customer_id, business_id, MIN(lo) AS lo, MAX(hi) AS hi FROM adj GROUP BY ALL) s
  JOIN (SELECT customer_id, business_id, amt FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, business_id ORDER BY lo, hi, amt) AS rn
          FROM adj) x WHERE rn = 1) f
    ON f.customer_id = s.customer_id AND f.business_id = s.business_id,
       generate_series(CAST(s.lo AS TIMESTAMP), CAST(s.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)"""
ADJ = """SELECT customer_id, business_id, LEAST(kpi_start_date, kpi_end_date) AS lo,
           GREATEST(kpi_start_date, kpi_end_date) AS hi, COALESCE(adjust_amount, 0) AS amt
    FROM settlement_heads
    WHERE customer_id IS NOT NULL AND kpi_end_date >= kpi_start_date AND result = 'agree'
      AND status = 'COMPLETED' AND adjust_amount <> 0"""

EARLIEST = """SELECT customer_id, business_id, strftime(kpi_start_date, '%Y-%m-%d') AS kpi_start_date,
    process_instance_id,
    ROW_NUMBER() OVER (PARTITION BY customer_id, business_id
                       ORDER BY kpi_start_date NULLS FIRST, process_instance_id NULLS FIRST) = 1 AS is_first
  FROM settlement_heads"""
GROUP_MEAN = """SELECT process_instance_id, customer_id,
    AVG(CAST(adjust_amount * 100 AS BIGINT)) OVER (PARTITION BY customer_id) AS adjust_cents
  FROM settlement_heads"""
FFILL = f"""SELECT s.customer_id, strftime(s.stat_date, '%Y-%m-%d') AS stat_date,
    CAST(LAST_VALUE(f.deposit_all_gdt IGNORE NULLS) OVER (PARTITION BY s.customer_id ORDER BY s.stat_date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS deposit_all_gdt
  FROM ({_SPINE}) s LEFT JOIN ({fact_select('deposit_all_gdt')}) f
    ON f.customer_id = s.customer_id AND f.stat_date = s.stat_date"""

def _AT(day: str) -> str:
    return f"TIMESTAMP '{day} 00:00:00'"


def _landed(schema: S.ReportSchema, accounts: str) -> str:
    """Pages of the first pull, where the second pull has no row of the account's day, and all of the second."""
    first = W.rows_sql(schema, f"ts < {_AT(FIRST_PULL_UNTIL)}")
    second = W.rows_sql(schema, f"ts >= {_AT(SECOND_PULL_FROM)} AND event_type <> 'error' AND {accounts}")
    return (f"SELECT * FROM ({first}) a WHERE NOT EXISTS (SELECT 1 FROM ({second}) b WHERE b.account_id = a.account_id "
            f"AND b.stat_date = a.stat_date) UNION ALL SELECT * FROM ({second}) c")


_SETTLE = ["settlement_lines", "settlement_heads", "contracts", "contract_lines"]
REPORT_ORACLE = {
    "hourly_report": _w(_show(HOURLY), _EV),
    "daily_report": _w(_show(DAILY), _EV),
    "active_accounts": _w(ACTIVE, _EV),
    "known_accounts_union": f"SELECT user_id AS account_id FROM events WHERE (event_id // 100) % 7 <> 3 AND "
                            f"(ts < {_AT(FIRST_PULL_UNTIL)} OR ts >= {_AT(SECOND_PULL_FROM)}) GROUP BY 1",
    "active_accounts_earlier": _w(f"""SELECT account_id FROM ({_with_rates(_report_sql(f"ts < {_AT(FIRST_PULL_UNTIL)}"))})
        WHERE cost > 0 UNION SELECT account_id FROM report_events WHERE event_type = 'purchase' AND
        ts >= {_AT(SECOND_PULL_FROM)} AND CAST(ts AS DATE) = DATE '{ROLLUP_DAY}' GROUP BY account_id, hour(ts)
        HAVING SUM(cost) > 0""", _EV),
    "hourly_landing": _show(_landed(S.HOURLY, "TRUE")),
    "daily_landing_active": _show(_landed(S.DAILY,
        "user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE), hour(ts) "
        "HAVING SUM(ROUND(value * 100)) > 0)")),
    "pages_by_day": _show(f"SELECT * FROM ({W.rows_sql(S.HOURLY, fields=DAY_FIELDS)}) p WHERE stat_date BETWEEN "
                          f"DATE '{DAY_REPULL_FROM}' AND DATE '2024-01-22'"),
    "agent_rollup_day": _show(
        f"SELECT * FROM ({W.rollup_sql(S.DAILY, TEST_AGENT_ID, f'ts < {_AT(FIRST_PULL_UNTIL)}')}) WHERE stat_date <> "
        f"DATE '{ROLLUP_DAY}' UNION ALL SELECT * FROM ({W.rollup_sql(S.DAILY, TEST_AGENT_ID)}) "
        f"WHERE stat_date = DATE '{ROLLUP_DAY}'"),
    "report_page_rejects": _show(f"""SELECT account_id, stat_date, reason, SUM(n)::BIGINT AS lines
        FROM (SELECT DISTINCT user_id AS account_id, CAST(ts AS DATE) AS stat_date, event_id // 100 AS page,
                     CASE WHEN {_NOT_REFUSED} THEN 'empty' ELSE 'refused' END AS reason,
                     CASE WHEN {_NOT_REFUSED} THEN 1 ELSE 2 END AS n FROM events) p GROUP BY 1, 2, 3"""),
    "pages_date_range": _show(f"SELECT account_id, stat_date, hour, cost FROM ({PAGES}) p "
                              f"WHERE stat_date BETWEEN DATE '{DAY_REPULL_FROM}' AND DATE '2024-01-22'"),
    "channel_min_bids": _show(f"SELECT * EXCLUDE (event_id) FROM ({_channel_sql()}) c WHERE adx_bid >= 50", "stat_day"),
    "hourly_report_ordered": _w(_show(HOURLY) + " ORDER BY account_id, stat_date, hour", _EV),
    "json_rows": _w("SELECT '{\"project_id\":' || project_id || ',\"entity_id\":' || entity_id || "
                    "',\"platform_id\":' || platform_id || '}' AS value FROM projects", ["projects"]),
    "optional_column": _w("SELECT project_id, ifnull(entity_id, -1) AS entity_id, 0 AS discount FROM projects",
                          ["projects"]),
    "typed_empty_source": _w("SELECT id, customer_id FROM entities", ["entities"]),
    "keep_on_first": _w("""SELECT customer_id, business_id, COUNT(*) AS n,
          SUM(CASE WHEN k = 1 THEN cents ELSE 0 END)::BIGINT AS cents
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, business_id
                                           ORDER BY kpi_start_date NULLS FIRST, cents NULLS FIRST) AS k
              FROM (SELECT *, CAST(adjust_amount * 100 AS BIGINT) AS cents FROM settlement_heads) c) h GROUP BY 1, 2""", ["settlement_heads"]),
    "daily_report_active": _w(_show(f"SELECT * FROM ({DAILY}) d WHERE account_id IN ({ACTIVE})"), _EV),
    "daily_report_active_joined": _w(_show(f"SELECT * FROM ({DAILY}) d WHERE account_id IN ({ACTIVE})"), _EV),
    "both_reports": _w(_show(f"SELECT *, 'hourly' AS grain FROM ({HOURLY}) h UNION ALL BY NAME "
                             f"SELECT *, 'daily' AS grain FROM ({DAILY}) d"), _EV),
    "first_report_row": _w(_show(HOURLY) + " ORDER BY account_id, stat_date, hour LIMIT 1", _EV),
    "append_snapshot": _w(_show(f"SELECT * FROM ({DAILY}) a UNION ALL SELECT * FROM ({DAILY}) b"), _EV),
    "replace_slices_versioned": _w(_show(
        f"SELECT * FROM ({_with_rates(_report_sql(f'ts < {_AT(FIRST_PULL_UNTIL)}'))}) o WHERE NOT EXISTS (SELECT 1 FROM "
        f"report_events n WHERE n.account_id = o.account_id AND CAST(n.ts AS DATE) = o.stat_date AND "
        f"n.ts >= {_AT(SECOND_PULL_FROM)}) UNION ALL "
        f"SELECT * FROM ({_with_rates(_report_sql(f'ts >= {_AT(SECOND_PULL_FROM)}'))}) s"), _EV),
    "unique_keys_written": _show(f"""SELECT stat_date, CAST(SUM(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS rows,
        CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS held
        FROM (SELECT account_id, stat_date, hour, COUNT(*) AS n FROM ({PAGES}) p GROUP BY ALL) k GROUP BY 1"""),
    "day_or_default": _w(f"""SELECT process_instance_id, strftime(CASE WHEN customer_id % 3 <> 0 THEN
        coalesce(kpi_end_date, DATE '{TEST_AS_OF}') ELSE DATE '{TEST_AS_OF}' END, '%Y-%m-%d') AS kpi_end_date
        FROM settlement_heads""", ["settlement_heads"]),
    "agent_rollup": _w(_show(ROLLUP), _EV),
    "agent_rollup_long": _w(_show(ROLLUP_LONG), _EV),
    "replace_account_day": _w(_show(REPLACE_ACCOUNT_DAY), _EV),
    "replace_day": _w(_show(REPLACE_DAY), _EV),
    "report_pages_json": _show(PAGES),
    "duplicate_keys": _show(f"SELECT account_id, stat_date, hour, COUNT(*) AS count FROM ({PAGES}) p "
                            "GROUP BY ALL HAVING COUNT(*) > 1"),
    "channel_report_json": _show(f"SELECT * EXCLUDE (event_id) FROM ({_channel_sql()}) c", "stat_day"),
    "channel_upsert": _show(CHANNEL_UPSERT, "stat_day"),
    "settlement_detail": _w(_money_out(f"SELECT {', '.join(_DETAIL_COLS)} FROM ({DETAIL}) d"), _SETTLE),
    "settlement_first_per_group": _w(_money_out(FIRST), _SETTLE),
    "settlement_apportion_daily": _w(APPORTION, ["settlement_heads"]).replace(
        "\nSELECT s.customer_id", f",\nadj AS ({ADJ})\nSELECT s.customer_id", 1),
    "earliest_row_flag": _w(EARLIEST, ["settlement_heads"]),
    "group_mean_back": _w(GROUP_MEAN, ["settlement_heads"]),
    "forward_fill": _w(FFILL, ["customers", "entities", "projects", "gdt_cash_flow", "gdt_accounts"]),
}

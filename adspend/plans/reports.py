"""Advertiser reports: hourly and daily per account, active accounts, agent
roll-up.

The reference pulls these reports per account from a remote API; here they
are aggregated from activity rows ``(account_id, ts, event_type, cost)``
(cost in cents).  Grouping keys always include the day (and hour), so even an
account with a third of all rows spreads over many groups, and partial
aggregation collapses it map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from ..sources.report_schema import AVERAGED, ReportSchema

# event kind -> report column it counts
EVENT_COUNTS = {"view": "view_count", "click": "valid_click_count",
                "signup": "web_register_count", "purchase": "web_order_count"}
ORDER_EVENT = "purchase"
MEAN_COLUMNS = AVERAGED  # in the agent roll-up; all other whole numbers are summed
REPORT_KEYS = ("stat_date", "account_id", "hour")


def _metrics(kind: str, cost: str) -> list:
    k, c = F.col(kind), F.col(cost)
    aggs = [F.count(F.when(k == F.lit(e), F.lit(1))).alias(name) for e, name in EVENT_COUNTS.items()]
    aggs.append(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias("cost"))
    aggs.append(F.sum(F.when(k == F.lit(ORDER_EVENT), c)).cast("bigint").alias("web_order_amount"))
    return aggs


def _rates(df: DataFrame) -> DataFrame:
    """ctr = clicks / views, cpc = cost / clicks, cost per thousand views;
    NULL where the divisor is 0."""
    views, clicks, cost = F.col("view_count"), F.col("valid_click_count"), F.col("cost")
    return df.select(
        "*",
        F.try_divide(clicks.cast("double"), views.cast("double")).alias("ctr"),
        F.round(F.try_divide(cost.cast("double"), clicks.cast("double"))).cast("bigint").alias("cpc"),
        F.round(F.try_divide((cost * 1000).cast("double"), views.cast("double"))).cast("bigint")
         .alias("thousand_display_price"))


def hourly_report(events: DataFrame, *, account: str = "account_id", ts: str = "ts",
                  kind: str = "event_type", cost: str = "cost") -> DataFrame:
    """One row per account, day and hour (AGG-13)."""
    g = events.groupBy(F.col(account).alias("account_id"), F.to_date(ts).alias("stat_date"),
                       F.hour(ts).alias("hour")).agg(*_metrics(kind, cost))
    return _rates(g)


def daily_report(events: DataFrame, *, account: str = "account_id", ts: str = "ts",
                 kind: str = "event_type", cost: str = "cost") -> DataFrame:
    """One row per account and day (AGG-14)."""
    g = events.groupBy(F.col(account).alias("account_id"), F.to_date(ts).alias("stat_date")
                       ).agg(*_metrics(kind, cost))
    return _rates(g)


def both_reports(events: DataFrame, *, account: str = "account_id", ts: str = "ts",
                 kind: str = "event_type", cost: str = "cost") -> DataFrame:
    """The hourly and the daily report from one scan and one shuffle (GROUPING SETS): daily rows have no ``hour``
    and ``grain`` says which report a row belongs to; the rates are taken after both sums."""
    rows = events.select(F.col(account).alias("account_id"), F.to_date(ts).alias("stat_date"), F.hour(ts).alias("hour"),
                         F.col(kind).alias("_kind"), F.col(cost).alias("_cost"))
    keys = [F.col(c) for c in ("account_id", "stat_date", "hour")]
    g = rows.groupingSets([keys, keys[:2]], *keys).agg(
        F.when(F.grouping("hour") == 1, "daily").otherwise("hourly").alias("grain"), *_metrics("_kind", "_cost"))
    return _rates(g)


def daily_report_of_active(events: DataFrame, **columns) -> DataFrame:
    """Daily rows of the accounts with cost in some hour (Q-31, Q-32), from one scan of the events.

    The mark of an account is a window over its rows after the aggregate: at
    most 25 a day, however many events an account has.
    """
    both = both_reports(events, **columns)
    hot = F.max((F.col("grain") == "hourly") & (F.col("cost") > 0)).over(Window.partitionBy("account_id"))
    rows = both.withColumn("_active", hot).where((F.col("grain") == "daily") & F.col("_active"))
    return rows.drop("grain", "hour", "_active")


def first_row(df: DataFrame, order: list[str]) -> DataFrame:
    """The first row by ``order``, to look at (LIM-1): each task keeps one row, no whole sort."""
    return df.orderBy(*order).limit(1)


def _with_earlier(accounts: DataFrame, earlier: DataFrame | None) -> DataFrame:
    out = accounts.select("account_id")
    return (out if earlier is None else out.unionByName(earlier.select("account_id"))).distinct()


def known_accounts(listed: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """The accounts listed by a pull and those known before (SET-2): whose hourly
    reports are asked for.  Says nothing about cost."""
    return _with_earlier(listed, earlier)


def active_accounts(report: DataFrame, *, dates=None, earlier: DataFrame | None = None) -> DataFrame:
    """Accounts with cost > 0 (on ``dates`` if given) and those that were active
    before: the only ones whose day report is asked for; ``account_id``, distinct.
    A set apart from ``known_accounts``: an account without cost is not in it."""
    r = report.filter(F.col("cost") > 0)
    if dates is not None:
        r = r.filter(F.col("stat_date").isin(*[F.to_date(F.lit(d)) for d in dates]))
    return _with_earlier(r, earlier)


def ordered_report(report: DataFrame) -> DataFrame:
    """A report in the order it is shown in: account, day, hour (SRT-2)."""
    return report.orderBy(*[c for c in ("account_id", "stat_date", "hour") if c in report.columns])


def only_active(report: DataFrame, active: DataFrame) -> DataFrame:
    """Report rows of active accounts only (a left semi join, JOIN-7)."""
    return report.join(active.select("account_id"), "account_id", "left_semi")


def _integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (ByteType, ShortType, IntegerType, LongType))


def rollup_columns(daily: DataFrame, *, keys=REPORT_KEYS, mean_cols=MEAN_COLUMNS) -> tuple[list, list]:
    """Summed and averaged columns: every integer measure of the report (the
    rate columns are not rolled up), the ``mean_cols`` averaged."""
    measures = [c for c in daily.columns if c not in keys and _integral(daily, c)]
    return [c for c in measures if c not in mean_cols], [c for c in measures if c in mean_cols]


def agent_rollup(daily: DataFrame, *, agent_id, dates=None, sum_cols=None, mean_cols=MEAN_COLUMNS,
                 schema: ReportSchema | None = None) -> DataFrame:
    """Account reports of a day rolled up to the agent (AGG-11): sums (0 when
    all NULL, H6) and means (NULL when all NULL), plus the constant
    ``agent_id``.  ``dates`` restricts the days (a date slice; pruned at the
    scan when the report is partitioned by ``stat_date``).  With a report
    ``schema`` the whitelist and the summed and averaged columns are those it
    derives (PRJ-2); a column it lists must be there."""
    if schema is not None:
        daily = daily.select(*schema.rollup_columns)
        sum_cols, mean_cols = schema.summed, schema.averaged
    if dates is not None:
        daily = daily.filter(F.col("stat_date").isin(*[F.to_date(F.lit(d)) for d in dates]))
    sums, means = rollup_columns(daily, mean_cols=mean_cols)
    if sum_cols is not None:
        sums = list(sum_cols)
    aggs = ([F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in sums]
            + [F.avg(c).alias(c) for c in means])
    return daily.groupBy("stat_date").agg(*aggs).withColumn("agent_id", F.lit(agent_id))


def agent_rollup_long(daily: DataFrame, *, agent_id, dates=None, mean_cols=MEAN_COLUMNS) -> DataFrame:
    """The same roll-up in long form ``(stat_date, agent_id, metric, value)``:
    one aggregate over (day, metric) whatever the number of measures."""
    if dates is not None:
        daily = daily.filter(F.col("stat_date").isin(*[F.to_date(F.lit(d)) for d in dates]))
    sums, means = rollup_columns(daily, mean_cols=mean_cols)
    measures = sums + means
    long = daily.select("stat_date", *[F.col(c).cast("bigint").alias(c) for c in measures]).unpivot(
        "stat_date", measures, "metric", "v")
    is_mean = F.col("metric").isin(*means) if means else F.lit(False)
    g = long.groupBy("stat_date", "metric").agg(F.sum("v").alias("_s"), F.avg("v").alias("_m"))
    value = F.when(is_mean, F.col("_m")).otherwise(F.coalesce(F.col("_s"), F.lit(0)).cast("double"))
    return g.select("stat_date", F.lit(agent_id).alias("agent_id"), "metric", value.alias("value"))

"""Report pages at their full width: every field that a request asks for.

A page's rows are made from ``events``; each measure has a rule of its own,
written once as SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.report_schema import RATE, ReportSchema, measure_type
from .standins import TestTables

REFUSED_ACCOUNT_EVERY = 9      # stand-in: the API refuses pages of every 9th account
_OWN = {"view_count": "CAST(event_type = 'view' AS BIGINT)", "valid_click_count": "CAST(event_type = 'click' AS BIGINT)",
        "cost": "CAST(ROUND(value * 100) AS BIGINT)", "hour": "CAST(hour(ts) AS INTEGER)"}


def field_sql(schema: ReportSchema, name: str) -> str:
    if name in _OWN:
        return _OWN[name]
    k = schema.measures.index(name) + 1
    value = (f"CAST((event_id * {k}) % 100000 AS DECIMAL(20,4)) * 0.0001" if measure_type(name) == RATE
             else f"(event_id * {2 * k + 3} + user_id) % {1000 + k}")
    return f"CASE WHEN (event_id + {k}) % 11 = 0 THEN NULL ELSE {value} END"


def page_lines(t: TestTables, schema: ReportSchema, where: str = "TRUE") -> DataFrame:
    """Landed lines: an account's day in pages by block of events, each of them whole.

    Events are brought together as they are and get their fields there; the number of partitions is said, as
    AQE would judge it by the few bytes that move and not by the pages they become.
    """
    date = F.date_format("ts", "yyyy-MM-dd").alias("date")
    item = F.struct(*[date if c == "date" else F.expr(field_sql(schema, c)).alias(c) for c in schema.request_fields])
    keys = {"account_id": F.col("user_id"), "stat_date": F.to_date("ts"),
            "page": F.floor(F.col("event_id") / 100).cast("int")}
    events = t.events.where(where).drop("props").withColumns(keys).repartition(
        int(t.spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    pages = events.groupBy(*keys).agg(F.collect_list(item).alias("list"))
    code = F.when(F.col("account_id") % REFUSED_ACCOUNT_EVERY == 0, 40001).otherwise(0)
    data = F.struct("list", F.struct(F.lit(1).alias("total_page")).alias("page_info"))
    response = F.struct(code.alias("code"), F.lit("").alias("message"), data.alias("data"))
    return pages.select(F.to_json(F.struct("account_id", "stat_date", (F.col("page") + 1).alias("page"),
                                           response.alias("response"))).alias("value"))


def rows_sql(schema: ReportSchema, where: str = "TRUE", fields: tuple[str, ...] | None = None) -> str:
    """DuckDB: the rows that the accepted pages hold, decimals as doubles."""
    asked = [c for c in schema.request_fields if c != "date" and (fields is None or c in fields)]
    shown = [f"CAST({field_sql(schema, c)} AS DOUBLE) AS {c}" if measure_type(c) == RATE else f"{field_sql(schema, c)} AS {c}"
             for c in asked]
    return (f"SELECT user_id AS account_id, CAST(ts AS DATE) AS stat_date, {', '.join(shown)} FROM events "
            f"WHERE user_id % {REFUSED_ACCOUNT_EVERY} <> 0 AND ({where})")


def rollup_sql(schema: ReportSchema, agent_id: int, where: str = "TRUE") -> str:
    sums = [f"CAST(COALESCE(SUM({c}), 0) AS BIGINT) AS {c}" for c in schema.summed]
    means = [f"AVG({c}) AS {c}" for c in schema.whole if c in schema.averaged]
    return (f"SELECT stat_date, {', '.join(sums + means)}, {agent_id} AS agent_id FROM ({rows_sql(schema, where)}) d "
            "GROUP BY stat_date")

"""Report schemas and what is derived from them; pages in folders by day."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType

from adspend.plans import reports as R
from adspend.sources import report_schema as S
from adspend.sources.pages import parse_report_pages, read_pages_by_day, report_page_rejects, write_pages_by_day

D = dt.date(2024, 1, 1)


def line(account, day, items, page=1, total=1, code=0):
    return json.dumps({"account_id": account, "stat_date": day, "page": page, "response": {
        "code": code, "data": {"list": items, "page_info": {"total_page": total}}}})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_widths():
    assert (len(S.DAILY.struct), len(S.HOURLY.struct)) == (210, 209)
    assert (len(S.DAILY.request_fields), len(S.HOURLY.request_fields)) == (209, 207)
    assert (len(S.DAILY.rollup_columns), len(S.DAILY.summed), len(S.DAILY.averaged)) == (172, 169, 2)
    for s in S.REPORTS.values():
        kinds = [f.dataType for f in s.struct]
        assert sum(k == S.RATE for k in kinds) == 37 and all(
            k == S.RATE or isinstance(k, (LongType, IntegerType, DateType)) for k in kinds)
        assert len(set(s.struct.names)) == len(s.struct) and set(s.keys) <= set(s.struct.names)
    assert set(S.DAILY.measures) - set(S.HOURLY.measures) == {"web_add_to_cart_count", "web_add_to_cart_cost"}
    assert "date" in S.DAILY.request_fields and "hour" in S.HOURLY.request_fields
    assert set(S.DAILY.whole) == set(S.DAILY.summed) | {"cpc", "thousand_display_price"}


def test_row_of_some_fields():
    assert S.HOURLY.row(["cost", "hour"]).names == ["hour", "cost"]
    assert "date" not in S.DAILY.row().names
    with pytest.raises(ValueError, match="nonsense"):
        S.DAILY.row(["cost", "nonsense"])


def test_only_asked_fields_are_parsed(spark):
    lines = spark.createDataFrame([(line(1, "2024-01-01", [{"hour": 3, "cost": 5, "ctr": 0.25, "view_count": "no number"}]),)],
                                  "value string")
    rows = parse_report_pages(lines, S.HOURLY.row(), fields=("hour", "cost", "ctr"))
    text = plan(rows)
    assert "ctr" in text and "order_roi" not in text and "view_count" not in text
    assert [tuple(map(str, r)) for r in rows.select("hour", "cost", "ctr").collect()] == [("3", "5", "0.2500")]
    # asked for, the bad value makes the line unreadable
    assert [r.reason for r in report_page_rejects(lines, S.HOURLY.row(["view_count"])).collect()] == ["unreadable"]


def test_full_width_row_and_rollup(spark):
    items = [{c: k + j for j, c in enumerate(S.DAILY.measures)} | {"date": "2024-01-01"} for k in (0, 1)]
    lines = spark.createDataFrame([(line(k + 1, "2024-01-01", [item]),) for k, item in enumerate(items)], "value string")
    daily = parse_report_pages(lines, S.DAILY.row())
    assert sorted(daily.columns) == sorted(S.DAILY.struct.names)
    got = R.agent_rollup(daily, agent_id=7, schema=S.DAILY).first().asDict()
    assert len(got) == 173 and got.pop("agent_id") == 7 and got.pop("stat_date") == D
    for c, v in got.items():
        j = S.DAILY.measures.index(c)
        assert v == (j + 0.5 if c in S.AVERAGED else 2 * j + 1), c
    with pytest.raises(Exception, match="cost"):
        R.agent_rollup(daily.drop("cost"), agent_id=7, schema=S.DAILY)


def test_days_outside_the_range_are_not_read(spark, tmp_dir):
    path = f"{tmp_dir}/pages"
    write_pages_by_day(spark.createDataFrame(
        [(line(a, f"2024-01-{d:02}", [{"hour": a, "cost": d}]),) for a in (1, 2) for d in range(1, 6)] + [("junk",)],
        "value string"), path)
    for day in (1, 5):  # files of other days can't even be opened
        with open(os.path.join(path, f"stat_date=2024-01-{day:02}", "broken.txt.gz"), "wb") as f:
            f.write(b"no gzip")
    rows = read_pages_by_day(spark, path, S.HOURLY.row(), fields=("hour", "cost"), dates=("2024-01-02", "2024-01-04"))
    text = plan(rows)
    assert "PartitionFilters: [isnotnull(stat_date" in text and "2024-01-02" in text
    assert sorted((r.account_id, str(r.stat_date), r.hour, r.cost) for r in rows.collect()) == [
        (a, f"2024-01-{d:02}", a, d) for a in (1, 2) for d in (2, 3, 4)]
    unread = spark.read.text(path).where("stat_date IS NULL")  # a line that says no day stays to be told of
    assert [r.reason for r in report_page_rejects(unread.select("value"), S.HOURLY.row()).collect()] == ["unreadable"]


def test_rollup_of_a_day_reads_its_folder_and_its_columns(spark, tmp_dir):
    path = f"{tmp_dir}/daily"
    spark.range(6).select(F.date_add(F.lit(D), (F.col("id") % 3).cast("int")).alias("stat_date"), F.col("id").alias("account_id"),
                          *[F.lit(1).cast(f.dataType).alias(f.name) for f in S.DAILY.struct.fields[2:]]
                          ).write.partitionBy("stat_date").parquet(path)
    out = R.agent_rollup(spark.read.schema(S.DAILY.struct).parquet(path), agent_id=1, schema=S.DAILY, dates=["2024-01-02"])
    text = plan(out)
    assert "PartitionFilters: [isnotnull(stat_date" in text and "order_roi" not in text
    assert [(str(r.stat_date), r.cost, r.cpc) for r in out.collect()] == [("2024-01-02", 2, 1.0)]

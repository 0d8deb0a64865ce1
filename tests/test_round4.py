"""Landed pages at scale: what is parsed, what moves, what is written; joins beyond the broadcast bound."""

from dataclasses import replace

from adspend.plans import facts as Fa
from adspend.sources import report_schema as S
from adspend.sources.pages import parse_report_pages, read_pages_by_day, write_pages_by_day
from adspend.testkit import wide_reports as W
from adspend.testkit.queries import PARAMS
from adspend.testkit.standins import TestTables, build_sources

SF = "/root/testdata/sf0.001"


def test_a_line_is_parsed_once(spark):
    lines = W.page_lines(TestTables(spark, SF), S.HOURLY)
    plan = parse_report_pages(lines, S.HOURLY.row())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_pages_are_built_from_events_as_they_are(spark):
    lines = W.page_lines(TestTables(spark, SF), S.HOURLY)
    plan = lines._jdf.queryExecution().executedPlan().toString().split("Exchange")
    assert len(plan) == 2  # one shuffle, and no field of a report is made below it
    assert "collect_list" in plan[0] and "collect_list" not in plan[1]


def test_landed_pages_are_compressed(spark, tmp_dir):
    lines = W.page_lines(TestTables(spark, SF), S.HOURLY).cache()
    write_pages_by_day(lines, f"{tmp_dir}/pages")
    lines.write.text(f"{tmp_dir}/plain")

    def size(path):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()

    assert size(f"{tmp_dir}/pages") < size(f"{tmp_dir}/plain") / 3
    got = read_pages_by_day(spark, f"{tmp_dir}/pages", S.HOURLY.row())
    assert sorted(map(str, got.collect())) == sorted(map(str, parse_report_pages(lines, S.HOURLY.row()).collect()))
    lines.unpersist()


def test_beyond_the_bound_no_table_that_grows_is_broadcast(spark):
    src = build_sources(TestTables(spark, SF))
    big = Fa.facts_long(src, ["total_cost_gdt"], p=replace(PARAMS, max_broadcast_bytes=0))
    for df in (big, Fa.invoice_units(src), Fa.receipt_units(src)):
        df.collect()  # AQE's last plan
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        for line in plan.splitlines():
            if "BroadcastHashJoin" in line:  # only the entities and the customers, of a size that doesn't follow the ledgers
                assert "entity_id" in line or "customer_id" in line, line

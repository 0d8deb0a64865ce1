"""Plan properties that matter at scale."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

from adspend.operators import sizing
from adspend.plans import facts as Fa
from adspend.sources.tables import SOURCE_SCHEMAS, Sources, sources_from_rows
from adspend.testkit.queries import PARAMS
from adspend.testkit.standins import TestTables, build_sources

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_big_bridge_plan_equals_broadcast_plan(spark):
    src = build_sources(TestTables(spark, SF))
    small = Fa.facts_long(src, None, p=PARAMS, keep=("customer_id", "entity_id"))
    small_plan = small._jdf.queryExecution().executedPlan().toString()
    big = Fa.facts_long(src, None, p=replace(PARAMS, max_broadcast_bytes=0), keep=("customer_id", "entity_id"))
    big_plan = big._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small_plan
    assert "partial_sum" in big_plan
    assert _rows(small) == _rows(big)


def test_broadcast_only_within_bound(spark):
    df = spark.range(10)
    for rows, limit, hinted in ((10, 10_000, True), (10, 1_000, False), (None, 10_000, False)):
        plan = str(sizing.broadcast_if_small(df, rows, limit)._jdf.queryExecution().logical()).lower()
        assert ("broadcast" in plan) is hinted


def test_building_plans_starts_one_small_job_per_sources(spark):
    from adspend.testkit.queries import QUERIES_BUILT_FROM_SOURCES as built
    tracker = spark.sparkContext.statusTracker()
    src = build_sources(TestTables(spark, SF))
    for name in SOURCE_SCHEMAS:
        getattr(src, name)
    src.sizes()
    spark.sparkContext.setJobGroup("plans-only", "building plans")
    for make in built:
        plan = make(src)._jdf.queryExecution().executedPlan().toString()
        assert "CollectLimit" not in plan and not ("SinglePartition" in plan and "LocalLimit" in plan)
    assert list(tracker.getJobIdsForGroup("plans-only")) == []
    src._sizes = None
    src.sizes()
    assert len(tracker.getJobIdsForGroup("plans-only")) <= 2  # the shuffle and the result of one collect, as AQE's query stages
    spark.sparkContext.setJobGroup("", "")


def test_filters_and_columns_reach_the_parquet_scan(spark, tmp_dir):
    flow = [(1000, "CHARGE", "FUND_TYPE_CASH", dt.datetime(2020, 1, 1), 100),
            (1000, "PAY", "FUND_TYPE_CASH", dt.datetime(2020, 1, 1), 100)]
    spark.createDataFrame(flow, SOURCE_SCHEMAS["gdt_cash_flow"]).write.parquet(f"{tmp_dir}/gdt")
    base = sources_from_rows(spark, customers=[(1,)], entities=[(10, 1)], projects=[(100, 10, 2)],
                             gdt_accounts=[(1000, 100)])
    tables = {n: getattr(base, n) for n in SOURCE_SCHEMAS}
    tables["gdt_cash_flow"] = spark.read.parquet(f"{tmp_dir}/gdt")
    src = Sources(**tables)
    df = Fa.gdt_deposit(src)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "PushedFilters: [" in scan and "trade_type" in scan.split("PushedFilters")[1]
    assert "EqualTo(trade_type,CHARGE)" in scan
    assert "ReadSchema: struct<account_id:bigint,trade_type:string,account_type:string" in scan
    assert _rows(df) == [(1, dt.date(2020, 1, 1), D("1.0000"))]


def test_snapshot_window_equals_full_run_and_reaches_the_scan(spark, tmp_dir):
    from pyspark.sql import functions as F

    from adspend.plans.snapshot import customer_day_snapshot
    src = build_sources(TestTables(spark, SF))
    full = customer_day_snapshot(src, start="1995-01-01", as_of="2001-12-31", p=PARAMS)
    part = customer_day_snapshot(src, start="1997-03-01", as_of="1997-03-10", p=PARAMS)
    want = full.filter(F.col("stat_date").between(F.lit(dt.date(1997, 3, 1)), F.lit(dt.date(1997, 3, 10))))
    assert part.count() == 50 and _rows(part) == _rows(want)

    flow = [(1000, "PAY", "FUND_TYPE_CASH", dt.datetime(2020, 1, d), 100) for d in (1, 2, 3)]
    spark.createDataFrame(flow, SOURCE_SCHEMAS["gdt_cash_flow"]).write.parquet(f"{tmp_dir}/gdt")
    base = sources_from_rows(spark, customers=[(1,)], entities=[(10, 1)], projects=[(100, 10, 2)],
                             gdt_accounts=[(1000, 100)])
    tables = {n: getattr(base, n) for n in SOURCE_SCHEMAS}
    tables["gdt_cash_flow"] = spark.read.parquet(f"{tmp_dir}/gdt")
    snap = customer_day_snapshot(Sources(**tables), start="2020-01-02", as_of="2020-01-02")
    plan = snap._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "GreaterThanOrEqual(trade_time" in scan and "LessThan(trade_time" in scan
    assert snap.first()["total_cost_gdt"] == D("1.0000")

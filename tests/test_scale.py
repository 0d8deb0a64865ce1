"""Shapes that matter at scale: a hot key, a wide report."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from adspend.plans import facts as Fa
from adspend.plans import reports as R
from adspend.sources.tables import sources_from_rows


def _hot_sources(spark):
    flow = []
    for i in range(3000):  # account 1000 holds most rows
        flow.append((1000, "PAY", "FUND_TYPE_CASH", dt.datetime(2020, 1, 1 + i % 5, i % 24), 100 + i))
    for a in range(1001, 1010):
        for i in range(100):
            flow.append((a, "PAY", "FUND_TYPE_GIFT", dt.datetime(2020, 1, 1 + i % 5), 7))
    accounts = [(a, 100 + a % 3) for a in range(1000, 1010)]
    projects = [(100, 10, 2), (101, 10, 2), (102, 11, 3)]
    return sources_from_rows(spark, customers=[(1,), (2,)], entities=[(10, 1), (11, 2)], projects=projects,
                             gdt_accounts=accounts, gdt_cash_flow=flow)


def _expected():
    out = {}
    for i in range(3000):
        cust = 1 if (1000 % 3) in (0, 1) else 2
        k = (cust, dt.date(2020, 1, 1 + i % 5))
        out[k] = out.get(k, 0) + 100 + i
    for a in range(1001, 1010):
        cust = 1 if a % 3 in (0, 1) else 2
        for i in range(100):
            k = (cust, dt.date(2020, 1, 1 + i % 5))
            out[k] = out.get(k, 0) + 7
    return {k: D(v) / 100 for k, v in out.items()}


def test_hot_account_same_in_both_plans(spark):
    got_small = {(r[0], r[1]): r[2] for r in Fa.gdt_spend(_hot_sources(spark)).collect()}
    shuffled = Fa.Params(max_broadcast_bytes=0)
    got_big = {(r[0], r[1]): r[2] for r in Fa.gdt_spend(_hot_sources(spark), shuffled).collect()}
    assert got_small == got_big == _expected()


def test_wide_rollup_171_measures(spark):
    n = 171
    cols = [((F.col("id") * (k + 1)) % 97).cast("bigint").alias(f"m{k}") for k in range(n - 2)]
    daily = spark.range(2000).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 3).cast("int")).alias("stat_date"),
        F.col("id").alias("account_id"), *cols,
        (F.col("id") % 11).cast("bigint").alias("cpc"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 13).cast("bigint").alias("thousand_display_price"))
    wide = R.agent_rollup(daily, agent_id=1)
    assert len(wide.columns) == 1 + n + 1
    long = {(r["stat_date"], r["metric"]): r["value"] for r in R.agent_rollup_long(daily, agent_id=1).collect()}
    for r in wide.collect():
        for c in wide.columns:
            if c not in ("stat_date", "agent_id"):
                assert abs(float(r[c]) - long[(r["stat_date"], c)]) < 1e-9

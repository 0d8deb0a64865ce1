"""Ledgers beyond the broadcast bound: a fact row is shuffled once, and parts leave no shuffle files behind."""

import os
import re
from dataclasses import replace

from pyspark.sql import functions as F

from adspend.operators.parts import settled
from adspend.plans import facts as Fa
from adspend.plans.snapshot import JOINED, customer_day_snapshot, snapshot_long
from adspend.session import CLEAN_UP
from adspend.testkit.queries import PARAMS
from adspend.testkit.standins import TEST_AS_OF, TEST_START, TestTables, build_sources

SF = "/root/testdata/sf0.001"
BIG = replace(PARAMS, max_broadcast_bytes=0)


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in dirs for _, _, names in os.walk(top.getPath()) for f in names if re.match(r"shuffle_.*\.data$", f)}


def test_snapshot_is_the_same_beyond_the_bound(spark):
    src = build_sources(TestTables(spark, SF))
    small, big = (customer_day_snapshot(src, start=TEST_START, as_of=TEST_AS_OF, p=p) for p in (PARAMS, BIG))
    assert sorted(map(str, big.collect())) == sorted(map(str, small.collect()))


def test_all_measures_are_the_same_beyond_the_bound(spark):
    src = build_sources(TestTables(spark, SF))
    names = [m for m in JOINED if m not in ("invoice_amount", "arrive_amount")] + list(Fa.INCOME_BASE)
    small, big = (Fa.facts_long(src, names, p=p, keep=("customer_id", "entity_id")) for p in (PARAMS, BIG))
    assert sorted(map(str, big.collect())) == sorted(map(str, small.collect()))
    by = [Fa.gdt_spend_by_fund_type(src, p).collect() for p in (PARAMS, BIG)]
    assert sorted(map(str, by[0])) == sorted(map(str, by[1]))


def test_beyond_the_bound_a_fact_row_is_shuffled_once(spark):
    src = build_sources(TestTables(spark, SF))
    for df, fact in ((Fa.facts_long(src, ["total_cost_tt", "deposit_all_tt"], p=BIG), "l_shipdate"),
                     (Fa.receipt_units(src), "l_shipdate")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        depth = [(len(re.match(r"[ :|+-]*", x)[0]), x) for x in plan.splitlines()]
        for k, (at, line) in enumerate(depth):
            if "Scan parquet" in line and fact in line:
                above, moves = at, 0
                for d, x in reversed(depth[:k]):
                    if d < above:
                        above, moves = d, moves + ("Exchange" in x)
                assert moves == 2, plan  # the row itself, and the sums per customer and day


def test_a_settled_part_leaves_no_shuffle_files(spark):
    df = spark.range(2000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    want, before = sorted(map(tuple, df.collect())), shuffle_files(spark)
    part = settled(df.where("n >= 0"), "part")
    assert shuffle_files(spark) <= before and spark.conf.get(CLEAN_UP) == "false"
    assert part.columns == df.columns and sorted(map(tuple, part.collect())) == want


def test_the_parts_of_a_large_snapshot_are_settled(spark):
    src = build_sources(TestTables(spark, SF))
    src.sizes()
    before = shuffle_files(spark)
    long = snapshot_long(src, replace(BIG, window=(Fa.to_date(TEST_START), Fa.to_date(TEST_AS_OF))))
    assert shuffle_files(spark) <= before  # every ledger was read and joined, and its shuffle files have gone
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()
    assert long.where("metric = 'cb_tt'").count() > 0

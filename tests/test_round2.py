"""Plans without jobs, guarded ratios, single first rows, column maps, one last day."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from adspend.functions.columns import ratio_income
from adspend.operators.groups import earliest_row_flag, keep_on_first
from adspend.plans import contracts as C
from adspend.plans.facts import Params
from adspend.plans.snapshot import last_day
from adspend.sources.tables import LEDGER_TABLES, jdbc_options, jdbc_sources, read_sources, sources_from_rows


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_one_flag_for_identical_first_rows(spark):
    rows = [("a", 1, 10), ("a", 1, 10), ("a", 1, 10), ("a", 2, 5), ("b", 3, 7), (None, 1, 2), (None, 1, 2)]
    df = spark.createDataFrame(rows, "k string, o int, amount int").repartition(3)
    flagged = earliest_row_flag(df, ["k"], ["o"])
    assert _rows(flagged.select("k", "o", "amount")) == sorted(rows, key=repr)
    assert _rows(flagged.where("is_first").select("k", "o", "amount")) == sorted(
        [("a", 1, 10), ("b", 3, 7), (None, 1, 2)], key=repr)
    kept = keep_on_first(flagged, "is_first", "amount").groupBy("k").agg(F.sum("amount").alias("s"))
    assert _rows(kept) == sorted([("a", 10), ("b", 7), (None, 2)], key=repr)


def test_ratio_of_minus_one_gives_no_income(spark):
    df = spark.createDataFrame([(10000, D("-1.0000")), (10000, D("0.2500")), (10000, None)], "c bigint, r decimal(8,4)")
    assert [r[0] for r in df.select(ratio_income("c", "r")).collect()] == [None, 8000, 10000]


def _sources(spark, lines):
    flow = [(1000, "PAY", "FUND_TYPE_CASH", dt.datetime(2020, 1, d), 10000) for d in (1, 2, 3, 4)]
    return sources_from_rows(spark, customers=[(1,)], entities=[(10, 1)], projects=[(100, 10, 2)], gdt_accounts=[(1000, 100)],
                             gdt_cash_flow=flow, contracts=[(5, 10, 2)], contract_lines=lines)


def test_rates_are_cut_to_the_window_before_they_are_expanded(spark):
    line = (1, 5, 2, 2500, dt.date(2000, 1, 1), dt.date(2040, 1, 1), "ok")
    reversed_line = (2, 5, 2, 0, dt.date(2020, 1, 3), dt.date(2020, 1, 2), "ok")
    bad = (3, 5, 2, -10000, dt.date(2020, 1, 4), dt.date(2020, 1, 4), "ok")
    src = _sources(spark, [line, reversed_line, bad])
    window = (dt.date(2020, 1, 2), dt.date(2020, 1, 4))
    assert C.daily_rates(C.contract_terms(src), window).count() == 3 + 2 + 1
    for p in (Params(window=window), Params(window=window, max_broadcast_bytes=0)):
        for expanded in (True, False):
            got = {r.stat_date.day: r.amount for r in C.net_income(src, p, expanded=expanded).collect()}
            # 100 a day, divided by 1.25; twice on the days of the reversed line; nothing more from a ratio of -1
            assert got == {2: D("180.0000"), 3: D("180.0000"), 4: D("80.0000")}


def test_sizes_are_counted_once(spark):
    src = _sources(spark, [(1, 5, 2, 0, dt.date(2020, 1, 1), dt.date(2020, 1, 10), "ok"),
                           (2, 5, 2, 0, dt.date(2020, 1, 1), None, "ok")])
    assert src.sizes() == {"projects": 1, "gdt_accounts": 1, "tt_accounts": 0, "wechat_accounts": 0, "contract_lines": 2,
                           "contract_days": 11}
    assert src.sizes() is src.sizes()


def test_last_day_is_settled_once(spark):
    assert last_day(spark, "2020-01-02") == dt.date(2020, 1, 2)
    assert last_day(spark) == spark.sql("SELECT current_date() AS d").first()["d"]
    with pytest.raises(TypeError):
        last_day(spark, F.lit("2020-01-02"))


def test_sources_under_other_names(spark, tmp_dir):
    spark.createDataFrame([(7, 100, "x")], "advertiser_id bigint, pig_advertiser_id bigint, other string").write.parquet(
        f"{tmp_dir}/tt_advertiser")
    src = read_sources(spark, tmp_dir, tables={"tt_accounts": "tt_advertiser"}, columns={"tt_accounts": {
        "account_id": "advertiser_id", "project_id": "pig_advertiser_id"}})
    assert src.tt_accounts.columns == ["account_id", "project_id"] and _rows(src.tt_accounts) == [(7, 100)]
    for wrong in ({"account_id": "absent"}, {"no_such": "advertiser_id"}):
        with pytest.raises(ValueError):
            read_sources(spark, tmp_dir, tables={"tt_accounts": "tt_advertiser"}, columns={"tt_accounts": wrong}).tt_accounts


def test_jdbc_ledgers_need_partitioning(spark):
    with pytest.raises(ValueError, match="media_cost"):
        jdbc_sources(spark, "jdbc:x", {}, properties={}, partitioning={t: {} for t in LEDGER_TABLES if t != "media_cost"})
    assert jdbc_options("jdbc:x", "t", {"user": "u"}, {"numPartitions": 8, "lowerBound": 1}) == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "numPartitions": "8", "lowerBound": "1"}


def _standins(spark):
    from adspend.testkit.standins import TestTables, build_sources
    return build_sources(TestTables(spark, "/root/testdata/sf0.001"))


def test_standins_show_swapped_key_spaces_and_outer_joins(spark):
    """Facts joined to another platform's accounts, or with unknown keys kept, give other results."""
    from adspend.plans import facts as Fa
    from adspend.sources.tables import SOURCE_COLUMNS, Sources
    from adspend.testkit.queries import PARAMS
    src = _standins(spark)
    tables = {n: getattr(src, n) for n in SOURCE_COLUMNS}
    for a, b, job in (("tt_accounts", "gdt_accounts", Fa.tt_spend), ("gdt_accounts", "wechat_accounts", Fa.gdt_spend),
                      ("wechat_accounts", "tt_accounts", Fa.wechat_spend)):
        swapped = Sources(**(tables | {a: tables[b], b: tables[a]}))
        assert _rows(job(src, PARAMS)) != _rows(job(swapped, PARAMS))
    # keys without a match exist at every step: fact -> account -> project -> entity -> customer
    for left, key, right, other in ((src.gdt_cash_flow, "account_id", src.gdt_accounts, "account_id"),
                                    (src.projects, "entity_id", src.entities, "id"),
                                    (src.entities, "customer_id", src.customers, "id")):
        assert left.join(right, left[key] == right[other], "left_anti").count() > 0
    ids = {r[0] for r in Fa.gdt_spend(src, PARAMS).select("customer_id").distinct().collect()}
    assert ids <= {r[0] for r in src.customers.collect()}

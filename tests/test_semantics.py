"""One small fixture per semantics rule (FIXTURES.md part C), values worked out by hand."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from adspend.functions.columns import epoch_seconds_day, optional_column, remap
from adspend.operators.calendar import apportion_daily, expand_period
from adspend.operators.merge import replace_slice, upsert, write_snapshot
from adspend.plans import contracts as C
from adspend.plans import facts as Fa
from adspend.plans import reports as R
from adspend.plans.snapshot import customer_day_snapshot
from adspend.sources.pages import parse_channel_report, parse_report_pages, PAGE_OK
from adspend.sources.tables import sources_from_rows

D1 = dt.date(2020, 1, 1)
T = dt.datetime


def dims(**kw):
    """customer 1 <- entity 10 <- project 100 (platform kw['platform']) <- account 1000."""
    platform = kw.pop("platform", 2)
    base = dict(customers=[(1,)], entities=[(10, 1)], projects=[(100, 10, platform)],
                gdt_accounts=[(1000, 100)], tt_accounts=[(1000, 100)], wechat_accounts=[(1000, 100)])
    base.update(kw)
    return base


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_h1_cost_basis_matches_date_spine(spark):
    src = sources_from_rows(spark, **dims(media_cost=[(100, T(2020, 1, 1), D("5.00"))]))
    snap = customer_day_snapshot(src, start="2020-01-01", as_of="2020-01-01")
    assert snap.select("cb_yxt").first()[0] == D("5.0000")


def test_h2_sub_day_times_give_one_row_per_day(spark):
    flow = [(1000, "CHARGE", "FUND_TYPE_CASH", T(2020, 1, 1, 9), 100),
            (1000, "CHARGE", "FUND_TYPE_CASH", T(2020, 1, 1, 10), 200)]
    src = sources_from_rows(spark, **dims(gdt_cash_flow=flow))
    assert rows(Fa.gdt_deposit(src)) == [(1, D1, D("3.0000"))]


def test_h3_group_by_day_of_spend(spark):
    log = [(100, T(2020, 1, 1, 1), D("1.00"), None), (100, T(2020, 1, 1, 23), D("2.00"), None)]
    src = sources_from_rows(spark, **dims(consume_log=log))
    assert rows(Fa.own_spend(src)) == [(1, D1, D("3.0000"))]


def _income(spark, lines):
    flow = [(1000, "PAY", "FUND_TYPE_CASH", T(2020, 1, 1, 9), 11000)]
    contracts = [(7, 10, 2)]
    src = sources_from_rows(spark, **dims(gdt_cash_flow=flow, contracts=contracts, contract_lines=lines))
    out = C.net_income(src)
    return {r["metric"]: r["amount"] for r in out.collect()}


def test_h4_overlapping_contract_lines_multiply(spark):
    line = lambda i: (i, 7, 2, 1000, D1, dt.date(2020, 1, 31), "ok")
    assert _income(spark, [line(1), line(2)])["incoming_gdt"] == D("200.0000")
    assert _income(spark, [line(1)])["incoming_gdt"] == D("100.0000")
    assert _income(spark, [])["incoming_gdt"] == D("110.0000")


def test_h5_media_3_and_4_swap(spark):
    lines = [(i, 7, i, 0, D1, D1, "ok") for i in (1, 2, 3, 4)]
    src = sources_from_rows(spark, contracts=[(7, 10, 1)], contract_lines=lines)
    got = {r["contract_content_id"]: r["platform_id"] for r in C.contract_terms(src).collect()}
    assert got == {1: 1, 2: 2, 3: 4, 4: 3}


def test_h5_remap_is_simultaneous(spark):
    df = spark.createDataFrame([(3,), (4,), (5,)], "x int")
    assert [r[0] for r in df.select(remap("x", {3: 4, 4: 3})).collect()] == [4, 3, 5]


def test_h6_all_null_sum_is_zero_mean_is_null(spark):
    daily = spark.createDataFrame([(D1, 1, None, None), (D1, 2, None, None)],
                                  "stat_date date, account_id bigint, cost bigint, cpc bigint")
    r = R.agent_rollup(daily, agent_id=9).first()
    assert r["cost"] == 0 and r["cpc"] is None and r["agent_id"] == 9


def test_h7_append_doubles_replace_by_day_does_not(spark, tmp_dir):
    src = sources_from_rows(spark, **dims())
    snap = customer_day_snapshot(src, start="2020-01-01", as_of="2020-01-02")
    app, rep = f"{tmp_dir}/append", f"{tmp_dir}/replace"
    for _ in range(2):
        write_snapshot(snap, app, mode="append")
        write_snapshot(snap, rep, mode="replace")
    assert spark.read.parquet(app).count() == 4
    assert spark.read.parquet(rep).count() == 2


def test_h8_spine_bounds_inclusive(spark):
    dep = [(100, T(2019, 12, 31, 5), D("9.00"))]
    src = sources_from_rows(spark, **dims(customers=[(1,), (2,)], deposit_log=dep))
    snap = customer_day_snapshot(src, start="2020-01-01", as_of="2020-01-03")
    assert snap.count() == 6
    assert snap.agg(F.sum("deposit_all")).first()[0] == 0


def test_h9_bids_filter_off_by_default(spark):
    js = '{"ec": 200, "data": [{"time": "2020-01-01", "bids": 0}, {"time": "2020-01-02", "bids": 5}]}'
    lines = spark.createDataFrame([(js,)], "value string")
    assert parse_channel_report(lines, channel_id=1, type_id=2).count() == 2
    assert parse_channel_report(lines, channel_id=1, type_id=2, min_bids=1).count() == 1


def test_h10_fund_type_lists(spark):
    flow = [(1000, "PAY", f, T(2020, 1, 1), 100) for f in Fa.FUND_TYPES_ALL]
    src = sources_from_rows(spark, **dims(gdt_cash_flow=flow))
    assert rows(Fa.gdt_spend(src))[0][2] == D("4.0000")
    assert rows(Fa.gdt_cost_basis(src))[0][2] == D("2.0000")
    base = Fa.spend_by_entity(src).filter("platform_id = 2").first()["cost"]
    assert base == D("3.0000")


def test_h11_wechat_has_no_cost_basis(spark):
    src = sources_from_rows(spark, **dims(
        gdt_cash_flow=[(1000, "PAY", "FUND_TYPE_CASH", T(2020, 1, 1), 100)],
        tt_daily=[(1000, T(2020, 1, 1), D("1.00"), None)],
        media_cost=[(100, T(2020, 1, 1), D("1.00"))]))
    snap = customer_day_snapshot(src, start="2020-01-01", as_of="2020-01-01")
    assert snap.first()["cb_all"] == D("3.0000")
    df = spark.createDataFrame([(1,)], "a int")
    assert df.select(optional_column(df, "cb_wechat")).first()[0] == 0


def test_h12_repeated_process_code_doubles_invoice(spark):
    inv = [("P1", 1, D("7.00"), T(2020, 1, 1), "agree", "COMPLETED")]
    src = sources_from_rows(spark, invoices=inv, process_codes=[("P1",), ("P1",)])
    assert rows(Fa.invoices_daily(src)) == [(1, D1, D("14.0000"))]


def _settle(spark, heads):
    src = sources_from_rows(spark, settlement_heads=[
        (f"P{i}", "b", None, 1, s, e, "agree", "COMPLETED", "t", a) for i, (s, e, a) in enumerate(heads)])
    return sorted((r["kpi_date"], r["adjust_amount"]) for r in C.settlement_adjustments(src).collect())


def test_h13_one_day_period(spark):
    assert _settle(spark, [(D1, D1, D("9.00"))]) == [(D1, 9.0)]


def test_ts5_even_apportionment(spark):
    got = _settle(spark, [(D1, dt.date(2020, 1, 3), D("9.00"))])
    assert [a for _, a in got] == [3.0, 3.0, 3.0]


def test_h17_only_earliest_row_spread(spark):
    got = _settle(spark, [(D1, dt.date(2020, 1, 3), D("1.00")),
                          (dt.date(2020, 1, 4), dt.date(2020, 1, 5), D("9.00"))])
    assert len(got) == 5 and all(abs(a - 0.2) < 1e-12 for _, a in got)


def test_h14_contract_period_edges(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 3), D1), (2, D1, None), (3, None, None)],
                               "id int, b date, e date")
    counts = {r[0]: r[1] for r in expand_period(df, "b", "e").groupBy("id").count().collect()}
    assert counts == {1: 3, 2: 1}


def test_h15_epoch_day_in_time_zone(spark):
    df = spark.createDataFrame([(0,), (57600,)], "s bigint")
    utc = [r[0] for r in df.select(epoch_seconds_day("s", "UTC")).collect()]
    sh = [r[0] for r in df.select(epoch_seconds_day("s", "Asia/Shanghai")).collect()]
    assert utc == [dt.date(1970, 1, 1), dt.date(1970, 1, 1)]
    assert sh == [dt.date(1970, 1, 1), dt.date(1970, 1, 2)]


def test_h16_active_accounts(spark):
    rep = spark.createDataFrame([(1, D1, 0), (2, D1, 5)], "account_id bigint, stat_date date, cost bigint")
    assert rows(R.active_accounts(rep)) == [(2,)]


def test_h18_text_compare_is_case_sensitive(spark):
    inv = [("P1", 1, D("7.00"), T(2020, 1, 1), "Agree", "COMPLETED")]
    src = sources_from_rows(spark, invoices=inv)
    assert Fa.invoices_daily(src).count() == 0


def test_h19_and_src2_pages(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    row = StructType([StructField("cost", LongType()), StructField("date", StringType())])
    page = lambda code, items: ('{"account_id": 1, "stat_date": "2020-01-01", "page": 1, "response": '  # noqa: E731
                                f'{{"code": {code}, "data": {{"list": {items}}}}}}}')
    lines = spark.createDataFrame([(page(PAGE_OK, '[{"cost": 1, "date": "x"}, {"cost": 2}]'),),
                                   (page(PAGE_OK, "[]"),), (page(5, '[{"cost": 9}]'),)], "value string")
    out = parse_report_pages(lines, row)
    assert out.columns == ["account_id", "stat_date", "cost"]
    assert sorted(r["cost"] for r in out.collect()) == [1, 2]


def test_flt5_remark_not_like_drops_null(spark):
    lines = [(1, 7, 1, 0, D1, D1, None), (2, 7, 1, 0, D1, D1, "x"), (3, 7, 1, 0, D1, D1, "a 测试 b")]
    src = sources_from_rows(spark, contracts=[(7, 10, 1)], contract_lines=lines)
    assert [r["contract_content_id"] for r in C.contract_terms(src).collect()] == [2]


def test_snk2_replace_slice_idempotent(spark):
    target = spark.createDataFrame([("a", "d1", 1), ("a", "d2", 2)], "acc string, day string, v int")
    new = spark.createDataFrame([("a", "d1", 5)], "acc string, day string, v int")
    once = replace_slice(target, new, ["acc", "day"])
    assert rows(once) == [("a", "d1", 5), ("a", "d2", 2)]
    assert rows(replace_slice(once, new, ["acc", "day"])) == rows(once)


def test_h24_empty_pull_keeps_slice(spark):
    target = spark.createDataFrame([("a", "d1", 1)], "acc string, day string, v int")
    new = spark.createDataFrame([], "acc string, day string, v int")
    assert rows(replace_slice(target, new, ["acc", "day"])) == [("a", "d1", 1)]


def test_snk4_upsert_idempotent(spark):
    target = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    upd = spark.createDataFrame([("k2", 9), ("k3", 3)], "k string, v int")
    once = upsert(target, upd, ["k"])
    assert rows(once) == [("k1", 1), ("k2", 9), ("k3", 3)]
    assert rows(upsert(once, upd, ["k"])) == rows(once)


def test_h23_last_update_wins_and_null_overwrites(spark):
    target = spark.createDataFrame([("k1", 1)], "k string, v int")
    upd = spark.createDataFrame([("k1", 5, 1), ("k1", None, 2)], "k string, v int, seq int")
    assert rows(upsert(target, upd, ["k"], order_by=["seq"])) == [("k1", None)]


def test_h25_rollup_reads_whole_day(spark):
    daily = spark.createDataFrame([(D1, 1, 3), (D1, 2, 4)], "stat_date date, account_id bigint, cost bigint")
    assert R.agent_rollup(daily, agent_id=1).first()["cost"] == 7


def test_h26_date_with_time_grouped_by_day(spark):
    wx = [(1000, T(2020, 1, 1, 0), 100), (1000, T(2020, 1, 1, 12), 100)]
    src = sources_from_rows(spark, **dims(wechat_daily=wx))
    assert rows(Fa.wechat_spend(src)) == [(1, D1, D("2.0000"))]


def test_apportion_sum_invariant(spark):
    df = spark.createDataFrame([("c", D1, dt.date(2020, 1, 7), 7.0)], "k string, b date, e date, a double")
    out = apportion_daily(df, ["k"], "b", "e", "a")
    assert out.count() == 7 and abs(out.agg(F.sum("a")).first()[0] - 7.0) < 1e-9


def test_src6_src7_request_keys_and_date_range(spark):
    from pyspark.sql.types import LongType, StructField, StructType
    row = StructType([StructField("cost", LongType())])
    lines = spark.createDataFrame([('{"page": 1, "response": {"code": 0, "data": {"list": [{"cost": 3}]}}}',),
                                   ('{"stat_date": "2020-02-01", "response": {"code": 0, "data": {"list": [{"cost": 4}]}}}',)],
                                  "value string")
    out = parse_report_pages(lines, row, account_id=8, stat_date="2020-01-05", dates=("2020-01-01", "2020-01-31"))
    assert rows(out) == [(8, dt.date(2020, 1, 5), 3)]


def test_snk5_rows_as_json(spark):
    from adspend.sources.pages import to_json_rows
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert to_json_rows(df).first()[0] == '{"k":1,"v":"a"}'


def test_src8_empty_sources_give_zero_grid(spark):
    from adspend.sources.tables import SOURCE_SCHEMAS, empty_like
    src = sources_from_rows(spark, customers=[(1,), (2,)])
    snap = customer_day_snapshot(src, start="2020-01-01", as_of="2020-01-02")
    assert snap.count() == 4
    assert snap.agg(F.sum("deposit_all"), F.sum("incoming_all")).first() == (0, 0)
    assert empty_like(spark, SOURCE_SCHEMAS["invoices"]).count() == 0

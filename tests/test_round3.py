"""Two-level expansion, binned interval join, prefix-scan fill, one scan for both reports, keys on write, orders."""

import datetime as dt
import random

import pytest
from plain_forms import forward_fill_by_months, interval_join_by_days
from pyspark.sql import functions as F

from adspend.functions.columns import day_or
from adspend.operators.calendar import apportion_daily, expand_days
from adspend.operators.intervals import interval_join
from adspend.operators.merge import DuplicateKeys, write_unique
from adspend.operators.prefix_fill import forward_fill
from adspend.plans import reports as R

D0 = dt.date(2020, 1, 1)


def day(k):
    return D0 + dt.timedelta(days=k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def tasks_with_rows(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().count()


def test_one_key_of_a_century_over_many_tasks(spark):
    long = spark.createDataFrame([(1, D0, day(36_524), 36_525.0), (2, D0, D0, 1.0)], "k int, b date, e date, a double")
    out = apportion_daily(long, ["k"], "b", "e", "a")
    assert tasks_with_rows(out) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = out.groupBy("k").agg(F.count("*"), F.sum("a"), F.countDistinct("stat_date"))
    assert rows(got) == [(1, 36_525, 36_525.0, 36_525), (2, 1, 1.0, 1)]


@pytest.mark.parametrize("chunk", [1, 2, 7, 400])
def test_chunks_of_any_size_give_each_day_once(spark, chunk):
    spans = [(k, day(k % 5), day(k % 5 + k)) for k in range(40)] + [(3, day(0), day(9))]
    df = spark.createDataFrame(spans, "k int, lo date, hi date")
    got = rows(expand_days(df, F.col("lo"), F.col("hi"), name="d", chunk_days=chunk).select("k", "lo", "d"))
    assert got == sorted([(k, lo, lo + dt.timedelta(days=i)) for k, lo, hi in spans for i in range((hi - lo).days + 1)], key=repr)


def random_periods(seed):
    rng = random.Random(seed)
    facts = [(rng.randrange(4), rng.randrange(3), day(rng.randrange(500)), i) for i in range(300)]
    facts += [(None, 1, day(3), 900), (1, 1, None, 901)]
    periods = []
    for i in range(60):
        b, e = day(rng.randrange(500)), day(rng.randrange(500))
        periods.append((rng.randrange(4), rng.randrange(3), *rng.choice([(b, e), (b, None), (None, e), (b, b), (None, None)]), i / 7))
    return facts, periods


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("unit", ["week", "month", "quarter", "year"])
def test_binned_join_equals_expanded_join(spark, how, unit):
    facts, periods = random_periods(7)
    f = spark.createDataFrame(facts, "entity int, platform int, stat_date date, n int")
    p = spark.createDataFrame(periods, "entity int, platform int, b date, e date, ratio double")
    kw = dict(day="stat_date", begin="b", end="e", how=how)
    got = interval_join(f, p, ["entity", "platform"], bin=unit, **kw)
    want = interval_join_by_days(f, p, ["entity", "platform"], **kw)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert got.where("ratio IS NOT NULL").groupBy("n").count().where("count > 1").count() > 0  # overlaps multiply (H4)


def test_binned_join_makes_no_row_a_day(spark):
    f = spark.createDataFrame([(1, day(40), 1)], "k int, stat_date date, n int")
    p = spark.createDataFrame([(1, day(0), day(3649), 0.5)], "k int, b date, e date, ratio double")
    out = interval_join(f, p, ["k"], day="stat_date", begin="b", end="e")
    text = plan(out)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "1 days" not in text
    assert rows(out) == [(1, day(40), 1, 0.5)]
    for odd in ("right", "full"):
        with pytest.raises(ValueError):
            interval_join(f, p, ["k"], day="stat_date", begin="b", end="e", how=odd)


def series(n, keys, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.choice(keys)
        out.append((k, i, *(rng.choice([None, None, None, rng.randrange(99)]) for _ in range(2)), f"r{i}"))
    return out


def plain_fill(data):
    last, out = {}, []
    for k, i, a, b, r in sorted(data, key=lambda x: x[1]):
        held = last.setdefault(k, [None, None])
        for j, v in enumerate((a, b)):
            held[j] = v if v is not None else held[j]
        out.append((k, i, *held, r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keys", [["a", "b", "c", None], ["hot"], list("abcdefghijkl")])
def test_fill_equals_a_plain_one_and_the_windowed_one(spark, keys):
    data = series(700, keys, 3)
    df = spark.createDataFrame(data, "k string, t int, a int, b int, r string").repartition(3)
    got = forward_fill(df, ["k"], "t", ["a", "b"])
    assert got.columns == df.columns and rows(got) == plain_fill(data)
    months = df.withColumn("t", F.date_add(F.lit(D0), F.col("t")))
    if None not in keys:
        assert rows(forward_fill(months, ["k"], "t", ["a", "b"])) == rows(forward_fill_by_months(months, ["k"], "t", ["a", "b"]))


def test_fill_of_empty_and_sparse_tables(spark):
    schema = "k string, t int, a decimal(10,2), b int, r string"
    assert forward_fill(spark.createDataFrame([], schema), ["k"], "t", ["a"]).collect() == []
    from decimal import Decimal
    data = [("x", i, Decimal("1.50") if i == 0 else None, None, "r") for i in range(400)]
    got = forward_fill(spark.createDataFrame(data, schema).repartition(4), ["k"], "t", ["a", "b"])
    assert {(r.a, r.b) for r in got.collect()} == {(Decimal("1.50"), None)}


def test_a_key_with_all_rows_in_one_month_is_dealt_over_tasks(spark, tmp_dir, monkeypatch):
    from adspend.operators import prefix_fill
    monkeypatch.setattr(prefix_fill, "scratch_path", lambda *a: f"{tmp_dir}/filled")
    big = spark.range(200_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(1_700_000_000 + F.col("id")).alias("t"),
                                      F.when(F.col("id") % 50_000 == 7, F.col("id")).alias("v"))
    out = forward_fill(big, ["k"], "t", ["v"])
    assert plan(out).count("FileScan") == 2  # the rows, and their keys and places once more for a row a partition
    got = out.groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {None: 7, 7: 50_000, 50_007: 50_000, 100_007: 50_000, 150_007: 49_993}
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_dir}/filled").groupBy("_part").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * min(sizes)


def events(spark):
    data = [(1, "2024-01-01 03:00", "view", 5), (1, "2024-01-01 03:10", "click", -9), (1, "2024-01-01 07:00", "purchase", 2),
            (2, "2024-01-01 03:00", "view", 0), (2, "2024-01-02 03:00", "view", None), (3, "2024-01-03 01:00", "purchase", 4)]
    return spark.createDataFrame(data, "account_id int, ts string, event_type string, cost long").withColumn(
        "ts", F.to_timestamp("ts"))


def test_both_reports_in_one_scan(spark, tmp_dir):
    events(spark).write.parquet(f"{tmp_dir}/events")
    ev = spark.read.parquet(f"{tmp_dir}/events")
    both = R.both_reports(ev)
    assert rows(both.where("grain = 'hourly'").select(R.hourly_report(ev).columns)) == rows(R.hourly_report(ev))
    assert rows(both.where("grain = 'daily'").select(R.daily_report(ev).columns)) == rows(R.daily_report(ev))
    active = R.daily_report_of_active(ev)
    joined = R.only_active(R.daily_report(ev), R.active_accounts(R.hourly_report(ev)))
    assert plan(active).count("FileScan") == 1 and plan(joined).count("FileScan") == 2
    assert rows(active.select(joined.columns)) == rows(joined) and {r.account_id for r in active.collect()} == {1, 3}


def test_reports_and_lists_come_in_their_order(spark):
    from adspend.plans import facts as Fa
    from adspend.testkit.standins import TestTables, build_sources, report_events
    t = TestTables(spark, "/root/testdata/sf0.001")
    hourly = [(r.account_id, r.stat_date, r.hour) for r in R.ordered_report(R.hourly_report(report_events(t))).collect()]
    assert hourly == sorted(hourly) and len(set(hourly)) == len(hourly) > 100
    customers = [r[0] for r in Fa.customer_list(build_sources(t)).collect()]
    assert customers == sorted(customers) and len(customers) > 3
    first = R.first_row(R.hourly_report(report_events(t)), ["account_id", "stat_date", "hour"])
    assert "TakeOrderedAndProject" in plan(first) and (first.first().account_id, first.first().stat_date, first.first().hour) == hourly[0]


def test_repeated_keys_are_refused_or_held_back(spark, tmp_dir):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, 5, 3), (2, 5, 4), (2, 5, 4)], "a int, b int, v int")
    with pytest.raises(DuplicateKeys):
        write_unique(df, f"{tmp_dir}/t", ["a", "b"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{tmp_dir}/t")
    assert write_unique(df, f"{tmp_dir}/t", ["a", "b"], quarantine=f"{tmp_dir}/q") == 4
    assert rows(spark.read.parquet(f"{tmp_dir}/t")) == [(1, 5, 3)]
    assert len(rows(spark.read.parquet(f"{tmp_dir}/q"))) == 4
    assert write_unique(df.where("a = 2").limit(1), f"{tmp_dir}/t", ["a", "b"], quarantine=f"{tmp_dir}/q") == 0
    assert len(rows(spark.read.parquet(f"{tmp_dir}/t"))) == 2


def test_missing_day_takes_the_default(spark):
    df = spark.createDataFrame([(D0,), (None,)], "d date")
    assert rows(df.select(day_or("d", "2021-02-03"))) == [(D0,), (dt.date(2021, 2, 3),)]
    today = df.select(day_or("d").alias("x"), F.current_date().alias("t")).where("d IS NULL").first()
    assert today.x == today.t

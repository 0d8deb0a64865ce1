"""Landing stream: a second pull replaces exactly the account-day slices it carries."""

import os

from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from adspend.streaming.landing import land_report_pages

ROW = StructType([StructField("hour", IntegerType()), StructField("cost", LongType())])


def _page(account, day, items, code=0):
    return ('{"account_id": %d, "stat_date": "%s", "page": 1, "response": {"code": %d, "data": {"list": [%s]}}}'
            % (account, day, code, ", ".join('{"hour": %d, "cost": %d}' % it for it in items)))


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_replaces_account_day_slices(spark, tmp_dir):
    src, target, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _write(src, "a.json", [_page(1, "2020-01-01", [(0, 10), (1, 20)]),
                           _page(2, "2020-01-01", [(0, 5)]),
                           _page(1, "2020-01-02", [(3, 7)])])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    first = sorted(tuple(r) for r in spark.read.parquet(target).select("account_id", "stat_date", "hour", "cost").collect())
    assert len(first) == 4
    # second pull: account 1 on 2020-01-01 again (one hour now); a refused page changes nothing
    _write(src, "b.json", [_page(1, "2020-01-01", [(5, 99)]), _page(2, "2020-01-01", [(0, 1)], code=7)])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    got = sorted((r[0], str(r[1]), r[2], r[3]) for r in
                 spark.read.parquet(target).select("account_id", "stat_date", "hour", "cost").collect())
    assert got == [(1, "2020-01-01", 5, 99), (1, "2020-01-02", 3, 7), (2, "2020-01-01", 0, 5)]


def test_upsert_into_table_touches_only_its_days(spark, tmp_dir):
    import datetime as dt

    from adspend.operators.table_writes import upsert_into_table
    target = f"{tmp_dir}/channel"
    schema = "stat_day date, channel_id int, adx_cost double, seq int"
    d1, d2, d3 = dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 3)
    first = spark.createDataFrame([(d1, 7, 1.0, 1), (d2, 7, 2.0, 1)], schema)
    upsert_into_table(first, target, keys=["stat_day", "channel_id"], partition_by=["stat_day"], order_by=["seq"])
    upd = spark.createDataFrame([(d2, 7, 5.0, 1), (d2, 7, 6.0, 2), (d3, 7, 3.0, 1)], schema)
    for _ in range(2):  # idempotent
        upsert_into_table(upd, target, keys=["stat_day", "channel_id"], partition_by=["stat_day"], order_by=["seq"])
    got = sorted((str(r["stat_day"]), r["channel_id"], r["adx_cost"]) for r in spark.read.parquet(target).collect())
    assert got == [("2020-01-01", 7, 1.0), ("2020-01-02", 7, 6.0), ("2020-01-03", 7, 3.0)]

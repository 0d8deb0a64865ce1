"""Landing loses nothing: rejects, incomplete slices, empty batches, failures between write and switch."""

import os

import pytest
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from adspend.operators import table_writes as W
from adspend.sources.pages import parse_report_pages, report_page_rejects
from adspend.streaming.landing import land_report_pages

ROW = StructType([StructField("hour", IntegerType()), StructField("cost", LongType())])


def page(account, day, items, *, n=1, total=1, code=0):
    rows = ", ".join('{"hour": %d, "cost": %d}' % it for it in items)
    return ('{"account_id": %d, "stat_date": "%s", "page": %d, "response": {"code": %d, "data": {"list": [%s], '
            '"page_info": {"total_page": %d}}}}' % (account, day, n, code, rows, total))


def land(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def table(spark, target):
    return sorted((r.account_id, str(r.stat_date), r.hour, r.cost) for r in spark.read.parquet(target).collect())


LINES = [page(1, "2020-01-01", [(0, 1)], n=1, total=2), page(1, "2020-01-01", [(1, 2)], n=2, total=2)[:-40],
         page(2, "2020-01-01", [(0, 3)], n=1, total=2), page(3, "2020-01-01", [(0, 4)]), page(4, "2020-01-01", [], code=7),
         page(5, "2020-01-01", []), "not json", "", page(6, "2020-01-01", [(0, 5)], n=2, total=2),
         page(6, "2020-01-01", [(1, 6)], n=1, total=2)]


def test_every_line_gives_rows_or_a_reason(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    for complete, accounts, reasons in (
            (False, [1, 2, 3, 6, 6], {"unreadable": 3, "refused": 1, "empty": 1}),
            (True, [3, 6, 6], {"unreadable": 3, "refused": 1, "empty": 1, "incomplete": 2})):
        rows = parse_report_pages(lines, ROW, complete=complete)
        assert sorted(r.account_id for r in rows.collect()) == accounts
        got = {}
        for r in report_page_rejects(lines, ROW, complete=complete).collect():
            got[r.reason] = got.get(r.reason, 0) + 1
        assert got == reasons


def test_first_batch_without_rows_then_rows(spark, tmp_dir):
    src, target, ckpt, rejects = (f"{tmp_dir}/{x}" for x in ("in", "table", "ckpt", "rejects"))
    land(src, "a.json", [page(1, "2020-01-01", [(0, 1)], code=7)])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt, rejects=rejects).awaitTermination()
    land(src, "b.json", [page(1, "2020-01-01", [(0, 10)])])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt, rejects=rejects).awaitTermination()
    assert table(spark, target) == [(1, "2020-01-01", 0, 10)]
    # a slice that lost a page, and one with a truncated page, keep what they had
    land(src, "c.json", [page(1, "2020-01-01", [(5, 99)], n=1, total=2), page(2, "2020-01-01", [(0, 7)])])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt, rejects=rejects).awaitTermination()
    land(src, "d.json", [page(2, "2020-01-01", [(0, 8)], n=1), page(2, "2020-01-01", [(1, 9)], n=2)[:-30]])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt, rejects=rejects).awaitTermination()
    assert table(spark, target) == [(1, "2020-01-01", 0, 10), (2, "2020-01-01", 0, 7)]
    reasons = sorted(r.reason for r in spark.read.parquet(rejects).collect())
    assert reasons == ["incomplete", "incomplete", "refused", "unreadable"]


def test_pages_of_a_slice_over_two_batches(spark, tmp_dir):
    src, target, ckpt = (f"{tmp_dir}/{x}" for x in ("in", "table", "ckpt"))
    no_number = page(4, "2020-01-01", [(0, 4)]).replace('"page": 1, ', "")
    for name, lines in (("a.json", [page(1, "2020-01-01", [(0, 1)], n=1, total=2), page(2, "2020-01-01", [(0, 2)], n=1, total=2),
                                    no_number]),
                        ("b.json", [page(1, "2020-01-01", [(1, 10)], n=2, total=2), page(2, "2020-01-01", [(0, 3)], n=1, total=2)]),
                        ("c.json", [page(2, "2020-01-01", [(1, 20)], n=2, total=2)])):
        land(src, name, lines)
        land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    assert table(spark, target) == [(1, "2020-01-01", 0, 1), (1, "2020-01-01", 1, 10), (2, "2020-01-01", 0, 3),
                                    (2, "2020-01-01", 1, 20), (4, "2020-01-01", 0, 4)]
    assert [r.reason for r in spark.read.parquet(f"{ckpt}-rejects").collect()] == ["incomplete"] * 3


BATCH = "account_id bigint, stat_date date, hour int, cost bigint"


def batch(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(a, dt.date.fromisoformat(d), h, c) for a, d, h, c in rows], BATCH)


@pytest.mark.parametrize("step", ["write", "switch", "delete"])
def test_a_failure_between_write_and_switch_loses_no_row(spark, tmp_dir, monkeypatch, step):
    target = f"{tmp_dir}/table"
    old = [(1, "2020-01-01", 0, 1), (2, "2020-01-01", 0, 2), (1, "2020-01-02", 0, 3)]
    new = [(1, "2020-01-01", 5, 9)]
    W.replace_slices_in_table(batch(spark, old), target)
    with monkeypatch.context() as m:
        if step == "write":      # the merged partitions are only partly written
            def broken(merged, target, parts):
                merged.write.mode("overwrite").parquet(f"{target}/{W.PENDING}")
                os.remove(f"{target}/{W.PENDING}/_SUCCESS")
                raise RuntimeError("lost")
            m.setattr(W, "_replace", broken)
        elif step == "switch":   # the old files of a touched partition are gone, the new ones not there
            def broken(df, path, partition_by):
                import shutil
                shutil.rmtree(f"{path}/stat_date=2020-01-01")
                raise RuntimeError("lost")
            m.setattr(W, "write_replacing", broken)
        else:                    # switched, but not cleaned up
            real = W.write_replacing

            def broken(df, path, partition_by):
                real(df, path, partition_by=partition_by)
                raise RuntimeError("lost")
            m.setattr(W, "write_replacing", broken)
        with pytest.raises(RuntimeError):
            W.replace_slices_in_table(batch(spark, new), target)
    W.replace_slices_in_table(batch(spark, new), target)
    assert table(spark, target) == [(1, "2020-01-01", 5, 9), (1, "2020-01-02", 0, 3), (2, "2020-01-01", 0, 2)]
    assert not os.path.exists(f"{target}/_pending")


def test_a_batch_is_evaluated_once(spark, tmp_dir):
    target, seen = f"{tmp_dir}/table", spark.sparkContext.accumulator(0)
    W.replace_slices_in_table(batch(spark, [(1, "2020-01-01", 0, 1)]), target)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = batch(spark, [(1, "2020-01-01", 1, 2), (2, "2020-01-02", 1, 3)])
    W.replace_slices_in_table(rows.mapInArrow(count, BATCH), target)
    assert seen.value == 2 and len(table(spark, target)) == 2


def test_a_cluster_needs_a_shared_folder():
    from adspend.session import shared_dir

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def folders(path):
    return {d for d in os.listdir(path) if d.startswith("stat_date=")}


def test_a_batch_touches_only_its_own_days_of_held_pages(spark, tmp_dir):
    from adspend.streaming.landing import HeldPages
    src, target, ckpt = (f"{tmp_dir}/{x}" for x in ("in", "table", "ckpt"))
    land(src, "a.json", [page(a, f"2020-01-0{d}", [(0, d)], n=1, total=2) for a in (1, 2) for d in (1, 2, 3)])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    held = HeldPages(spark, f"{ckpt}-held")
    before = set(held.table.folders())
    assert held.table.read().count() == 6 and {f.split("/")[0] for f in before} == {f"stat_date=2020-01-0{d}" for d in (1, 2, 3)}
    land(src, "b.json", [page(1, "2020-01-02", [(1, 20)], n=2, total=2)])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    after = set(held.table.folders())
    assert {f.split("/")[0] for f in before ^ after} == {"stat_date=2020-01-02"}  # the other days' folders are as they were
    assert sorted((r.account_id, r.stat_date.day) for r in held.table.read().collect()) == [(1, 1), (1, 3), (2, 1), (2, 2), (2, 3)]
    assert table(spark, target) == [(1, "2020-01-02", 0, 2), (1, "2020-01-02", 1, 20)]
    text = held.read(held.table.version(), [__import__("datetime").date(2020, 1, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [stat_date" in text or "PartitionFilters: [isnotnull(stat_date" in text


def test_a_replayed_batch_finds_the_held_pages_it_began_with(spark, tmp_dir, monkeypatch):
    from adspend.streaming import landing
    src, target, ckpt = (f"{tmp_dir}/{x}" for x in ("in", "table", "ckpt"))
    land(src, "a.json", [page(1, "2020-01-01", [(0, 1)], n=1, total=2)])
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    land(src, "b.json", [page(1, "2020-01-01", [(1, 2)], n=2, total=2)])
    real = landing.HeldPages.replace

    def dies(self, slices, lines):
        real(self, slices, lines)
        raise RuntimeError("lost after all was done")

    with monkeypatch.context() as m:
        m.setattr(landing.HeldPages, "replace", dies)
        with pytest.raises(Exception, match="lost"):
            land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    assert len(table(spark, target)) == 2
    land_report_pages(spark, src, target, ROW, checkpoint=ckpt).awaitTermination()
    assert table(spark, target) == [(1, "2020-01-01", 0, 1), (1, "2020-01-01", 1, 2)]
    assert landing.HeldPages(spark, f"{ckpt}-held").table.read().count() == 0
    assert spark.read.parquet(f"{ckpt}-rejects").count() == 1  # the first page, while it was alone


def test_landing_into_a_versioned_table(spark, tmp_dir):
    from adspend.operators.versioned import VersionedTable
    src, target, ckpt = (f"{tmp_dir}/{x}" for x in ("in", "table", "ckpt"))
    schema = spark.createDataFrame([], "account_id bigint, stat_date date, cost bigint").schema
    for name, cost in (("a.json", 1), ("b.json", 2)):
        land(src, name, [page(1, "2020-01-01", [(0, cost), (1, cost)])])
        land_report_pages(spark, src, target, ROW, checkpoint=ckpt, versioned=True, fields=["cost"]).awaitTermination()
    t = VersionedTable(spark, target, schema)
    assert [r.cost for r in t.read().collect()] == [2, 2] and [r.cost for r in t.read(1).collect()] == [1, 1]

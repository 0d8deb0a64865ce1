"""Slices replaced in one step: readers during a switch, two writers, deaths in between, keys."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from adspend.operators import versioned as V

SCHEMA = "account_id long, cost long, stat_date date"


def day(k):
    return dt.date(2024, 1, k)


@pytest.fixture()
def make(spark, tmp_dir):
    kinds = spark.createDataFrame([], SCHEMA).schema

    def table(**kw):
        return V.VersionedTable(spark, f"{tmp_dir}/table", kinds, **kw)
    table.rows = lambda *rows: spark.createDataFrame([(a, c, day(d)) for a, c, d in rows], SCHEMA)
    return table


def shown(df):
    return sorted((r.account_id, r.cost, r.stat_date.day) for r in df.collect())


def test_replace_append_upsert_and_old_versions(make):
    t = make()
    assert shown(t.read()) == [] and t.version() == 0
    assert t.append(make.rows((1, 10, 1), (2, 20, 1), (1, 11, 2))) == 1
    assert t.replace_slices(make.rows((1, 12, 1), (1, 13, 1))) == 2
    assert shown(t.read()) == [(1, 11, 2), (1, 12, 1), (1, 13, 1), (2, 20, 1)]
    assert t.upsert(make.rows((2, 99, 1), (5, 50, 3)), ["account_id", "stat_date"]) == 3
    assert shown(t.read()) == [(1, 11, 2), (1, 12, 1), (1, 13, 1), (2, 99, 1), (5, 50, 3)]
    assert shown(t.read(1)) == [(1, 10, 1), (1, 11, 2), (2, 20, 1)]
    assert t.replace_slices(make.rows()) == 3  # an empty batch leaves all as it is
    assert shown(make().read()) == shown(t.read())


def test_partitions_are_pruned(make):
    t = make()
    t.append(make.rows(*[(a, 1, d) for a in (1, 2) for d in range(1, 6)]))
    got = t.read().where(F.col("stat_date") == F.lit(day(3)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stat_date" in plan and len(got.collect()) == 2


def test_a_reader_keeps_its_version_through_a_switch(make):
    t = make()
    t.append(make.rows(*[(a, 1, d) for a in range(20) for d in (1, 2)]))
    before = t.read()
    t.replace_slices(make.rows(*[(a, 2, d) for a in range(20) for d in (1, 2)]))
    assert before.agg(F.sum("cost")).first()[0] == 40
    assert t.read().agg(F.sum("cost")).first()[0] == 80
    seen, stop = set(), threading.Event()

    def read():
        other = make()
        while not stop.is_set():
            seen.add(other.read().agg(F.sum("cost")).first()[0])

    reader = threading.Thread(target=read)
    reader.start()
    for cost in (3, 4, 5):
        t.replace_slices(make.rows(*[(a, cost, d) for a in range(20) for d in (1, 2)]))
    stop.set()
    reader.join()
    assert seen <= {40 * c for c in (2, 3, 4, 5)}


def test_death_before_the_switch_changes_nothing(make, monkeypatch):
    t = make()
    t.append(make.rows((1, 1, 1)))
    with monkeypatch.context() as m:
        m.setattr(V.VersionedTable, "_switch", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            t.replace_slices(make.rows((1, 2, 1), (3, 3, 2)))
    assert shown(t.read()) == [(1, 1, 1)]
    t.replace_slices(make.rows((1, 2, 1), (3, 3, 2)))
    assert shown(t.read()) == [(1, 2, 1), (3, 3, 2)]
    assert t.vacuum() == 3 and shown(t.read()) == [(1, 2, 1), (3, 3, 2)]


@pytest.mark.parametrize("same_day", [True, False])
def test_two_writers(make, monkeypatch, same_day):
    """A second writer commits between the first one's write and its switch."""
    t = make()
    t.append(make.rows((1, 1, 1), (2, 1, 1), (9, 9, 2)))
    real, writes, state = V.VersionedTable._switch, [], {"met": False}
    write = V.VersionedTable._write

    def switch(self, version, folders):
        if not state["met"]:
            state["met"] = True
            make().replace_slices(make.rows((2, 7, 1) if same_day else (9, 7, 2)))
        return real(self, version, folders)

    monkeypatch.setattr(V.VersionedTable, "_switch", switch)
    monkeypatch.setattr(V.VersionedTable, "_write", lambda self, rows: writes.append(1) or write(self, rows))
    assert t.replace_slices(make.rows((1, 5, 1))) == 3
    assert shown(t.read()) == ([(1, 5, 1), (2, 7, 1), (9, 9, 2)] if same_day else [(1, 5, 1), (2, 1, 1), (9, 7, 2)])
    assert len(writes) == (3 if same_day else 2)  # computed again only where the other one touched the same day


def test_many_writers_at_once_lose_nothing(make):
    make().append(make.rows((0, 0, 1)))
    errors = []

    def work(k):
        try:
            make(attempts=50).replace_slices(make.rows((k, k, 1), (k, k, 2)))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(1, 5)]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    assert not errors
    assert shown(make().read()) == sorted([(0, 0, 1), *[(k, k, d) for k in range(1, 5) for d in (1, 2)]])
    assert make().version() == 5


def test_writer_gives_up_after_its_attempts(make, monkeypatch):
    t = make(attempts=3)
    monkeypatch.setattr(V.VersionedTable, "_switch", lambda *a: False)
    with pytest.raises(V.Conflict):
        t.append(make.rows((1, 1, 1)))


def test_repeated_keys_are_refused_whole(make):
    t = make(keys=["account_id", "stat_date"])
    t.append(make.rows((1, 1, 1)))
    with pytest.raises(V.DuplicateKeys, match="account_id"):
        t.append(make.rows((1, 2, 1), (2, 2, 2)))
    assert shown(t.read()) == [(1, 1, 1)] and t.version() == 1


def test_a_taken_number_and_a_lock_left_behind(make, monkeypatch):
    t = make(attempts=2)
    t.append(make.rows((1, 1, 1)))
    folders = t.folders()
    with monkeypatch.context() as m:
        m.setattr(V.VersionedTable, "_locked", lambda *a: True)
        assert t._switch(1, []) is False  # the rename itself doesn't overwrite
    assert t.version() == 1 and t.folders() == folders
    assert t._locked(2)  # a writer dies here
    with pytest.raises(V.Conflict):
        t.append(make.rows((2, 2, 2)))
    monkeypatch.setattr(V, "LOCK_MS", -1)
    assert t.append(make.rows((2, 2, 2))) == 2

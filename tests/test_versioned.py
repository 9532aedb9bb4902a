"""Tables that are switched from version to version."""

import pytest
from pyspark.sql import functions as F

from skylag.operators import weather as wx
from skylag.session import new_path
from skylag.sources.files import names_in, remove
from skylag.sources.versioned import VersionedTable, adding, replacing
from skylag.streaming import streams as st
from tests.test_streams import SCHEMA, report

KEYS = "k long, v long"


def table_of(spark, path=None):
    return VersionedTable(spark, path or new_path(spark, "versioned"), KEYS, (F.col("k") % 3).cast("string"))


def rows(df):
    return sorted((r.k if r.k is not None else -1, r.v) for r in df.collect())


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), KEYS)


def test_replace_add_and_repeat(spark):
    table = table_of(spark)
    assert table.read().count() == 0 and table.versions() == []
    assert table.apply(batch(spark, (1, 10), (2, 20), (None, 5)), replacing(["k"]), "s", 0)
    before = table.entry()["part"]
    assert table.apply(batch(spark, (1, 11), (4, 40), (None, 6)), replacing(["k"]), "s", 1)
    assert rows(table.read()) == [(-1, 6), (1, 11), (2, 20), (4, 40)]
    after = table.entry()["part"]
    assert after["2"] == before["2"] and after["1"] != before["1"]  # only parts with new rows are written
    assert not table.apply(batch(spark, (1, 99)), replacing(["k"]), "s", 1) and rows(table.read())[1] == (1, 11)
    assert table.apply(batch(spark, (1, 1), (2, 2)), adding(["k"], ["v"]), "other", 0)
    assert rows(table.read()) == [(-1, 6), (1, 12), (2, 22), (4, 40)]
    assert rows(table.read(0)) == [(-1, 5), (1, 10), (2, 20)]
    assert table.apply(batch(spark), adding(["k"], ["v"]), "s", 2) and rows(table.read())[1] == (1, 12)
    table.put(batch(spark, (7, 7)))
    assert rows(table.read()) == [(7, 7)]


def test_a_crash_leaves_the_last_version(spark, monkeypatch):
    table = table_of(spark)
    table.apply(batch(spark, (1, 1)), replacing(["k"]), "s", 0)
    monkeypatch.setattr(table, "commit", lambda entry: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.apply(batch(spark, (1, 2)), replacing(["k"]), "s", 1)
    monkeypatch.undo()
    assert rows(table.read()) == [(1, 1)]
    # a ledger entry without its end mark is not a version
    batch(spark, (0, 0)).write.parquet(f"{table.path}/ledger/1")
    remove(spark, f"{table.path}/ledger/1/_SUCCESS")
    again = table_of(spark, table.path)
    assert again.versions() == [0] and rows(again.read()) == [(1, 1)]
    assert again.apply(batch(spark, (1, 2)), replacing(["k"]), "s", 1) and rows(again.read()) == [(1, 2)]


def test_vacuum_keeps_what_is_read(spark):
    table = table_of(spark)
    for i in range(4):
        table.apply(batch(spark, (i, i), (0, i)), replacing(["k"]), "s", i)
    want = rows(table.read()), rows(table.read(2))
    assert table.vacuum(keep=2) > 0 and table.versions() == [2, 3]
    assert (rows(table.read()), rows(table.read(2))) == want
    assert len(names_in(spark, f"{table.path}/data")) < 4 + 1


def test_late_reports_wait_and_are_reconciled(spark):
    source, path = new_path(spark, "reports"), new_path(spark, "hours")
    table = st.hours_table(spark, path)
    drops = [[report(10), report(70), report(60 * 9)], [report(20, 300), report(60 * 9 + 5, 200)]]
    for drop in drops:
        spark.createDataFrame(drop, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = st.read_stream(spark, source, spark.read.parquet(source).schema)
        assert st.drain(st.write_hours(stream, table, path + "-c", delay="2 hours"))
    hours = lambda: {(r.time.hour, round(r.avg_temp_f, 3)) for r in st.read_hours(spark, path).collect()}
    assert hours() == {(0, 50.0), (1, 50.0), (9, 59.0)}
    assert [(r.time.hour, r.temp_f) for r in st.late_reports(table).collect()] == [(0, 86.0)]
    assert st.reconcile_late(table) and not st.reconcile_late(table)
    assert hours() == {(0, 68.0), (1, 50.0), (9, 59.0)} and st.late_reports(table).count() == 0
    batch_hours = wx.hourly_weather(spark.read.parquet(source))
    assert batch_hours.exceptAll(st.read_hours(spark, path)).count() == 0

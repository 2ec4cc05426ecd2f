"""Versioned publishing and run logs: atomic, repeatable, readable while a publish fails."""
import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark import shared
from ledgerspark.operators import warehouse as WH

DAY = dt.date(2026, 3, 1)


@pytest.fixture()
def gold(spark):
    a = spark.createDataFrame([(DAY, "North", Decimal("10.50"), 3, True, float("nan"), None)],
                              "month date, segment string, revenue decimal(18,2), entries int, ok boolean, pct double, note double")
    b = spark.createDataFrame([("k1", dt.datetime(2026, 1, 2, 3, 4, 5)), ("k2", None)], "key string, at timestamp")
    return {"marts": a, "keys": b}


def test_a_publish_is_read_back_in_published_types(spark, tmpdir_path, gold):
    w = WH.Warehouse(spark, tmpdir_path)
    assert w.publish(gold, "r1") == {"marts": 1, "keys": 2}
    back = w.read("marts")
    assert dict(back.dtypes) == {"month": "date", "segment": "string", "revenue": "double", "entries": "bigint", "ok": "boolean",
                                 "pct": "double", "note": "string"}     # a column without values is a string
    assert tuple(back.first()) == (DAY, "North", 10.5, 3, True, None, None)
    assert dict(w.read("keys").dtypes) == {"key": "string", "at": "timestamp"} and w.read("keys").count() == 2


def test_a_failing_publish_changes_nothing(spark, tmpdir_path, gold):
    w = WH.Warehouse(spark, tmpdir_path)
    w.publish(gold, "r1")
    broken = {"marts": gold["marts"].withColumn("segment", F.lit("South")),
              "keys": gold["keys"].withColumn("key", F.when(F.col("key") == "k2", F.raise_error(F.lit("executor lost"))).otherwise("x"))}
    with pytest.raises(Exception, match="executor lost"):
        w.publish(broken, "r2")
    assert w.versions() == [1] and w.read("marts").first().segment == "North"
    assert w.sync_log().count() == 1
    # the tables of the failed run are gone, and the same run can be tried again
    assert len(shared.names(spark, f"{tmpdir_path}/tables/marts")) == 1
    assert w.publish({**broken, "keys": gold["keys"]}, "r2") == {"marts": 1, "keys": 2}
    assert w.versions() == [1, 2] and w.read("marts").first().segment == "South" and w.read("marts", 1).first().segment == "North"


def test_a_publish_that_dies_before_its_commit_is_not_seen(spark, tmpdir_path, gold, monkeypatch):
    w = WH.Warehouse(spark, tmpdir_path)
    w.publish(gold, "r1")

    def dies(*a):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(WH.Warehouse, "_commit", dies)
        m.setattr(shared, "remove", lambda *a: None)       # the process is gone: nothing is tidied up
        with pytest.raises(KeyboardInterrupt):
            w.publish({**gold, "marts": gold["marts"].withColumn("segment", F.lit("South"))}, "r2")
    assert w.read("marts").first().segment == "North" and w.read("marts").count() == 1


def test_a_commit_file_cut_off_counts_as_none(spark, tmpdir_path, gold):
    w = WH.Warehouse(spark, tmpdir_path)
    w.publish(gold, "r1")
    text = open(os.path.join(tmpdir_path, "commits", "000000000001.json")).read()
    shared.write_once(spark, f"{tmpdir_path}/commits/000000000002.json", text[:len(text) // 2])
    assert w.versions() == [1] and w.read("marts").count() == 1
    w.publish(gold, "r3")
    assert w.versions() == [1, 3]


def test_repeating_a_run_writes_nothing(spark, tmpdir_path, gold):
    w = WH.Warehouse(spark, tmpdir_path)
    first = w.publish(gold, "r1", "2026-01-01 00:00:00")
    files = [sorted(os.listdir(os.path.join(tmpdir_path, "tables", t))) for t in gold]
    assert w.publish({n: df.limit(0) for n, df in gold.items()}, "r1") == first
    assert [sorted(os.listdir(os.path.join(tmpdir_path, "tables", t))) for t in gold] == files
    assert [tuple(r) for r in w.sync_log().collect()] == [("r1", dt.datetime(2026, 1, 1), 3)]


def test_two_publishers_get_two_versions(spark, tmpdir_path, gold, monkeypatch):
    w = WH.Warehouse(spark, tmpdir_path)
    w.publish(gold, "r1")
    # both have listed the commits before either writes its own
    monkeypatch.setattr(shared, "names", lambda *a: [])
    w._commit("r2", {"marts": {"path": "x", "rows": 7, "columns": []}}, "2026-01-01 00:00:00")
    monkeypatch.undo()
    assert w.versions() == [1, 2]
    assert json.loads(open(os.path.join(tmpdir_path, "commits", "000000000002.json")).read())["total_rows_synced"] == 7


def test_latest_rows_and_expiry(spark, tmpdir_path, gold):
    w = WH.Warehouse(spark, tmpdir_path)
    for i in (1, 2, 3):
        w.publish({**gold, "marts": gold["marts"].withColumn("entries", F.lit(i))}, f"r{i}", f"2026-01-0{i} 00:00:00")
    assert tuple(WH.rows_synced_latest(w.sync_log()).first()) == (3, dt.datetime(2026, 1, 3))
    assert w.expire(keep=2) == [1]
    assert w.read("marts").first().entries == 3 and w.read("marts", 2).first().entries == 2
    assert len(shared.names(spark, f"{tmpdir_path}/tables/marts")) == 2
    assert w.sync_log().count() == 3       # the log keeps its rows


def test_empty_tables_and_unknown_names(spark, tmpdir_path, gold):
    w = WH.Warehouse(spark, tmpdir_path)
    with pytest.raises(LookupError):
        w.read("marts")
    assert w.sync_log().count() == 0 and w.versions() == []
    w.publish({"marts": gold["marts"].limit(0)}, "r1")
    assert w.read("marts").count() == 0 and set(dict(w.read("marts").dtypes).values()) == {"string"}
    with pytest.raises(LookupError):
        w.read("marts", 9)


def test_rows_that_were_not_written_are_noticed(spark, tmpdir_path, gold, monkeypatch):
    w = WH.Warehouse(spark, tmpdir_path)
    real = type(gold["keys"]).count
    monkeypatch.setattr(type(gold["keys"]), "count", lambda self: real(self) - (1 if self.inputFiles() else 0))
    with pytest.raises(WH.PublishError):
        w.publish(gold, "r1")


# ---------------------------------------------------------------- run logs
def test_run_log_appends_each_run_once(spark, tmpdir_path):
    log = WH.RunLog(spark, tmpdir_path)
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "card string, words int")
    assert log.append(rows, "007", "2026-01-01 00:00:00") and not log.append(rows.limit(1), "007", "2026-02-01 00:00:00")
    assert log.append(rows.where("card = 'b'"), "2026-01", "2026-01-02 00:00:00")
    got = log.read().collect()
    assert sorted((r.run_id, r.card, r.words, str(r.run_at)) for r in got if r.card == "a") == [("007", "a", 1, "2026-01-01 00:00:00")] * 2
    assert len(got) == 4 and len({r.id for r in got}) == 4
    last = WH.latest_per(log.read(), "card", "run_at").collect()
    assert sorted((r.card, r.run_id) for r in last) == [("a", "007"), ("a", "007"), ("b", "2026-01")]


def test_half_written_run_is_replaced(spark, tmpdir_path, monkeypatch):
    log = WH.RunLog(spark, tmpdir_path)
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "card string, words int")
    log.append(rows, "one", "2026-01-01 00:00:00")

    def dies(*a):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(shared, "write_once", dies)
        with pytest.raises(KeyboardInterrupt):
            log.append(rows.withColumn("card", F.lit("half")), "two", "2026-01-02 00:00:00")
    assert {r.run_id for r in log.read().collect()} == {"one"}
    log.append(rows, "two", "2026-01-02 00:00:00")
    ids = {r.id for r in log.read().where("run_id = 'two'").collect()}
    assert {r.card for r in log.read().where("run_id = 'two'").collect()} == {"a", "b"} and log.read().count() == 4
    # the same rows have the same ids in any attempt
    other = WH.RunLog(spark, tmpdir_path + "-b")
    other.append(rows.repartition(3), "two", "2026-05-05 00:00:00")
    assert {r.id for r in other.read().collect()} == ids


def test_run_ids_are_names(spark, tmpdir_path):
    for bad in ("", "a/b", "x=1", "a b"):
        with pytest.raises(ValueError):
            WH.RunLog(spark, tmpdir_path).append(spark.range(1), bad)
    with pytest.raises(LookupError):
        WH.RunLog(spark, tmpdir_path).read()

"""Logs and state under several appends, writers at once, and writers that break off."""

import threading

import pytest
from pyspark.sql import functions as F

from winnow.sources import commits
from winnow.sources import readers as R
from winnow.sources import sinks as K

RECORD = "k STRING, v BIGINT"


def records(spark, *rows):
    return spark.createDataFrame(list(rows), RECORD)


def replayed(spark, path, **more):
    return [(r.key, r.data.v) for r in R.replay_wal(spark, path, RECORD, **more).orderBy("append", "seq").collect()]


def test_the_first_append_of_a_key_wins(spark, tmp_path):
    path = str(tmp_path / "log")
    assert replayed(spark, path) == []
    for v in range(1, 7):
        K.append_wal(records(spark, ("a", v), (f"b{v}", v), ("c", -v)).repartition(3), "k", path, F.desc("k"))
    want = [("c", -1), ("b1", 1), ("a", 1), *((f"b{v}", v) for v in range(2, 7))]
    assert replayed(spark, path) == want
    assert replayed(spark, path, limit=4) == want[:4]
    at = commits.snapshot(spark, path)
    assert at.version == 6 and len(at.parts[commits.ROWS]) == 6
    K.compact_wal(R.replay_wal(spark, path, RECORD, at=at), path, at.version)
    assert replayed(spark, path) == want and len(commits.snapshot(spark, path).parts[commits.ROWS]) == 1
    K.append_wal(records(spark, ("c", 9), ("z", 9)), "k", path)
    assert replayed(spark, path) == [*want, ("z", 9)]
    # what was appended since the replay is not compacted away
    with pytest.raises(commits.Conflict):
        K.compact_wal(R.replay_wal(spark, path, RECORD, at=at), path, at.version)
    K.truncate_wal(spark, path)
    assert replayed(spark, path) == []


def test_an_append_that_breaks_off_leaves_no_trace(spark, tmp_path):
    path = str(tmp_path / "log")
    K.append_wal(records(spark, ("a", 1)), "k", path)
    broken = records(spark, ("a", 2), ("b", 2), ("c", 0)).repartition(3).withColumn("v", F.when(F.col("k") == "c", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        K.append_wal(broken, "k", path)
    commits.write_rows(records(spark, ("d", 3)).select(F.col("k").alias("key"), F.struct("k", "v").alias("data")), path, "json")  # written, never committed
    assert replayed(spark, path) == [("a", 1)]
    assert len(commits.vacuum(spark, path)) >= 1
    K.append_wal(records(spark, ("b", 4)), "k", path)
    assert replayed(spark, path) == [("a", 1), ("b", 4)]


def test_corrupt_lines_are_skipped(spark, tmp_path):
    path = str(tmp_path / "log")
    K.append_wal(records(spark, ("a", 1)), "k", path)
    name = commits.snapshot(spark, path).parts[commits.ROWS][0]
    (tmp_path / "log" / name / "part-broken.json").write_text('{"key": "b", "data": {"k": \nnonsense\n{"key": null, "data": {"k": "x", "v": 1}, "seq": 0}\n{"key": "e", "data": {"k": "e", "v": 5}, "seq": 1}\n')
    assert sorted(replayed(spark, path)) == [("a", 1), ("e", 5)]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    log, state, root = (str(tmp_path / x) for x in ("log", "state", "registry"))
    failed = []

    def work(i):
        try:
            K.append_wal(records(spark, (f"k{i}", i)), "k", log)
            K.write_state(spark.createDataFrame([(f"c{i}", "key")], "crawler string, key string"), state)
            K.save_registry(spark.createDataFrame([(f"Name {i}",), ("Both",)], "canonical string"), spark.createDataFrame([(f"d{i}.com", f"Name {i}")], "domain string, canonical string"), root)
        except Exception as e:  # a thread's failure must reach the test
            failed.append(e)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert sorted(replayed(spark, log)) == [(f"k{i}", i) for i in range(6)]
    assert sorted(r.crawler for r in K.read_state(spark, state, "crawler string, key string").collect()) == [f"c{i}" for i in range(6)]
    names, domains = K.load_registry(spark, root, spark.createDataFrame([], "canonical string"))
    assert sorted(r.canonical for r in names.collect()) == ["Both", *(f"Name {i}" for i in range(6))]
    assert domains.count() == 6
    assert [commits.snapshot(spark, p).version for p in (log, state, root)] == [6, 6, 6]


def test_a_reader_keeps_its_version(spark, tmp_path):
    path, ddl = str(tmp_path / "state"), "crawler string, key string"
    put = lambda *rows: K.write_state(spark.createDataFrame(rows, ddl), path)
    put(("jobs", "1"), ("news", "2"), (None, "3"))
    before = K.read_state(spark, path, ddl)
    put(("jobs", "4"), ("jobs", "5"))
    assert sorted(map(tuple, before.collect())) == [("jobs", "1"), ("news", "2")]
    assert sorted(map(tuple, K.read_state(spark, path, ddl).collect())) == [("jobs", "4"), ("jobs", "5"), ("news", "2")]


def test_a_registry_may_be_saved_from_what_it_holds(spark, tmp_path):
    root, none = str(tmp_path / "registry"), spark.createDataFrame([], "canonical string")
    K.save_registry(spark.createDataFrame([("A",)], "canonical string"), spark.createDataFrame([("a.com", "A"), ("b.com", "A")], "domain string, canonical string"), root)
    for _ in range(2):
        K.save_registry(*K.load_registry(spark, root, none), root)
    K.save_registry(none, spark.createDataFrame([("b.com", "B")], "domain string, canonical string"), root)
    names, domains = K.load_registry(spark, root, none)
    assert [r.canonical for r in names.collect()] == ["A"]
    assert sorted(map(tuple, domains.collect())) == [("a.com", "A"), ("b.com", "B")]

"""Choices, admission, reports, saved state and rotation: input to expected facts."""

import pytest
from pyspark.sql import functions as F

from winnow.functions import choice as N
from winnow.operators import report as RP
from winnow.operators import shaping as P
from winnow.sources import sinks as K
from winnow.streaming import stateful as ST


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_news_texts(spark):
    d = spark.createDataFrame(
        [(1, "<p>A body that is long enough to count</p>", "Title", False), (2, "<p>short</p>", "Title", True), (3, None, "Title", False), (4, "", None, None)],
        "id int, html string, title string, forum boolean",
    )
    full = d.withColumn("f", N.full_text(F.col("html"), F.col("title"), F.col("forum")))
    assert rows(full.select("id", "f.*")) == [(1, "A body that is long enough to count", True), (2, "Title", False), (3, "", False), (4, "", False)]
    short = lambda enriched: N.summary(F.lit(enriched), F.lit("<b>snippet</b>"), F.col("f.text"), F.col("title"), F.col("forum"))
    assert rows(full.select("id", short("An enriched summary, long enough").alias("s")).select("id", "s.*")) == [
        (1, "An enriched summary, long enough", True), (2, "An enriched summary, long enough", True), (3, "snippet", False), (4, "snippet", False),
    ]
    assert rows(full.select("id", short(None).alias("s")).select("id", "s.summary")) == [(1, "snippet"), (2, "Title"), (3, "snippet"), (4, "snippet")]
    assert rows(d.select("id", N.news_text(F.lit(""), F.lit(None).cast("string"), F.col("title")))) == [(1, "Title"), (2, "Title"), (3, "Title"), (4, None)]


def test_answers_and_tiers(spark):
    d = spark.createDataFrame([(1, 20.0, 10.0, 3.0, "fine"), (2, 0.0, 0.0, 3.0, "x"), (3, 31.0, 1.0, 1.0, "x"), (4, 5.0, 5.0, 5.0, " \t"), (5, None, 5.0, 5.0, "x"), (6, 0.0, 1.0, 0.0, "x")], "id int, u double, q double, d double, n string")
    valid = N.answer_valid(F.col("u"), F.col("q"), F.col("d"), F.col("n"))
    assert rows(d.select("id", valid)) == [(1, True), (2, False), (3, False), (4, False), (5, False), (6, True)]
    tier = N.first_tier([("a", F.lit("A"), F.col("u") > 10), ("b", F.lit("B"), F.col("q") > 4)], ("rules", F.lit("R")))
    assert rows(d.select("id", tier.alias("t")).select("id", "t.tier")) == [(1, "a"), (2, "rules"), (3, "a"), (4, "b"), (5, "b"), (6, "rules")]


def test_deterministic_extract(spark):
    d = spark.createDataFrame([("\n\n  Head line \nshort.\n",), ("",), (None,), ("One sentence of length. Two sentences of length. Remote job for a machine learning engineer.",)], "t string")
    e = N.deterministic(F.col("t"))
    got = [tuple(r) for r in d.select(e["title"], e["summary"], e["is_remote"]).collect()]
    assert got[0] == ("Head line", "Head line \nshort.", False) and got[1] == got[2] == ("Untitled", "Untitled", False)
    assert got[3][1].startswith("One sentence") and got[3][2]


def test_admission(spark):
    d = spark.createDataFrame(
        [("registry", "n", "a/b", "REJECTED"), ("registry", "n", "", None), ("registry", " ", None, None), ("directory", "n", "a/b", "PENDING"), ("directory", "n", None, "PENDING"), ("directory", "n", "a/b", "VERIFIED"), ("repository", "n", "a/b", "PENDING")],
        "shard string, name string, repo string, status string",
    )
    got = [r[0] for r in d.select(N.admission(*map(F.col, d.columns))).collect()]
    assert got == ["REJECTED", "VERIFIED", "PENDING", "REJECTED", "PENDING", "VERIFIED", "PENDING"]


def test_eta(spark):
    d = spark.createDataFrame([(50, 100, 5.0), (0, 100, 5.0), (120, 100, 5.0), (10, 100, 0.0)], "c int, t int, m double")
    assert [r[0] for r in d.select(N.eta_minutes(F.col("c"), F.col("t"), F.col("m"))).collect()] == [5.0, None, 0.0, None]


def test_run_report_and_gates(spark, tmp_path):
    tables = {"a": spark.range(100), "b": spark.range(90), "c": spark.range(0)}
    health = spark.createDataFrame([("x", True), ("y", False)], "source string, stale boolean")
    report = RP.run_report(RP.collected(tables), "r", "completed", 100, 0.0421, stale=health)
    r = RP.report_failures(report, ["a", "b", "c", "d"]).collect()[0]
    assert r.status == "shortfall" and r.collected == {"a": 100, "b": 90, "c": 0} and r.stale_sources == ["x"] and r.duration_seconds == 0.042
    assert r.failures == ["status shortfall", "b 90", "c 0", "d 0"] and not r.passed
    good = RP.run_report(RP.collected({"a": spark.range(100)}), "r", "completed", 100, 5.0)
    assert RP.report_failures(good, ["a"]).collect()[0].passed
    assert RP.report_failures(RP.run_report(RP.collected(tables), "r", "interrupted", 0, 1.0, upload="failed"), ["a"]).collect()[0].failures == ["status interrupted", "a 100", "upload"]
    K.write_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).collect()[0].status == "shortfall"
    assert rows(RP.gate(spark.range(10), "g", F.col("id") < 9, 0.9)) == [("g", 10, 9, True)]
    assert rows(RP.gate(spark.range(0), "g", F.col("id") < 9)) == [("g", 0, 0, True)]
    assert rows(RP.at_least(spark.range(10), "g", 5, F.col("id") < 4)) == [("g", 10, 4, False)]


def test_headers_and_ranked_cells(spark):
    rec = spark.sql("SELECT '1.0' schemaVersion, 'JOB' recordType, named_struct('name', 's', 'url', 'u') source, named_struct('company', 'c', 'title', 't', 'date', 'd', 'date_inferred', true, 'is_remote', false, 'role_family', 'r') content, 'x' collectedAt")
    assert RP.header_ok(P.job_rows(rec), "jobs") and not RP.header_ok(P.job_rows(rec).drop("collectedAt"), "jobs")
    log = spark.sql("SELECT 'r' rawName, 'c' canonicalName, 'STARTUP' entityType, 'NORMALIZATION_EXACT' matchMethod, 1.0 confidenceScore, 'u' sourceUrl, 't' timestamp")
    assert RP.header_ok(P.log_rows(log), "logs")
    d = spark.createDataFrame([("", None, None, ["a", "b"], "2024-01-01T00:00:00Z"), ("Data", "MIT", 3, None, None)], "category string, license string, github_stars int, key_capabilities array<string>, github_pushed_at string")
    got = sorted((r.category, r.license, r.github_stars, r.key_capabilities_str, r.github_pushed_at) for r in P.ranked_rows(d).collect())
    assert got == [("Data", "MIT", 3, "", ""), ("Developer Tools", "MIT", 0, "a, b", "2024-01-01")]


def test_state_and_registry(spark, tmp_path):
    path, schema = str(tmp_path / "state"), "key string, crawler string"
    assert K.read_state(spark, path, schema).count() == 0
    K.write_state(spark.createDataFrame([("k1", "news"), ("k2", "jobs")], schema), path)
    K.reset_state(spark, path, "news")
    assert rows(K.read_state(spark, path, schema)) == [("k2", "jobs")]
    K.reset_state(spark, path)
    assert K.read_state(spark, path, schema).count() == 0
    root, seeds = str(tmp_path / "registry"), spark.createDataFrame([("Seed",)], "canonical string")
    assert [d.count() for d in K.load_registry(spark, root, seeds)] == [1, 0]
    K.save_registry(spark.createDataFrame([("B",), ("A",), ("A",), (None,)], "canonical string"), spark.createDataFrame([("a.com", "A")], "domain string, canonical string"), root)
    entities, domains = K.load_registry(spark, root, seeds)
    assert rows(entities) == [("A",), ("B",), ("Seed",)] and rows(domains) == [("a.com", "A")]


def test_append_new(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "key string, v int"
    for batch in ([("a", 1), ("a", 1), ("b", 2)], [("b", 9), ("c", 3)], [("c", 8)]):
        K.append_new(spark.createDataFrame(batch, schema), path, "key", schema)
    assert rows(spark.read.schema(schema).json(path)) == [("a", 1), ("b", 2), ("c", 3)]


@pytest.mark.parametrize(
    "calls, want",
    [
        ([(0, 0), (1, 0), (2, 0), (3, 0)], [0, 1, 2, 0]),
        ([(0, 10), (1, 0), (2, 0), (3, 0), (11, 0)], [0, 1, 2, 1, 2]),
        ([(0, 9), (0, 5), (0, 7), (1, 0), (6, 0)], [0, 1, 2, 1, 1]),
    ],
)
def test_rotation(calls, want):
    assert ST.taken(ST.Rotation(3), calls) == want

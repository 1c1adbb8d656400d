"""The two whole runs on small landed rows."""

import datetime as dt

from pyspark.sql import functions as F

from winnow import engine
from winnow.operators import shaping as P

NOW = "2024-06-01 12:00:00"


def dims(spark):
    return (
        spark.createDataFrame([("OpenAI",), ("Anthropic",)], "canonical string"),
        spark.createDataFrame([("open ai", "OpenAI")], "alias string, canonical string"),
        spark.createDataFrame([("anthropic.com", "Anthropic")], "domain string, canonical string"),
    )


def landed(spark):
    page = "<p>" + "A body that is long enough to be the text of a story. " * 2 + "</p>"
    rows = {
        "startups": [("l", "https://www.anthropic.com/x", "Claude Makers", 5, 1), ("l", None, "Open AI", None, 2), ("l", None, "openai", None, 3), ("l", None, " ", 1, 4), ("l", None, None, 1, 5)],
        "products": [("l", "https://x.example", "Chat", "open ai", "free forever", 1), ("l", None, "chat ", None, None, 2), ("l", None, None, None, None, 3)],
        "papers": [("https://p/1", "A title", ["A", "B"], "code at https://github.com/Own/Repo.", "2024-05-01", 1), ("https://p/2", "Other", [], None, "2024-05-01", 2), ("https://p/3", "ab", None, None, "2024-05-01", 3), ("https://p/4", "No date", None, None, None, 4)],
        "jobs": [("b", "https://j/1", "Open AI", "Machine Learning Engineer", "2024-06-01T08:00:00Z", "Remote", None, 2), ("b", "https://j/1", "Open AI", "Machine Learning Engineer", "2024-05-01", None, None, 1), ("b", "https://j/2", "X", "Cook", "2024-06-01", None, None, 3)],
        "news": [("n", "https://n/1?utm_source=a", "OpenAI ships a very new model today", "2024-06-01T11:00:00Z", page, "<b>snip</b>", 1), ("n", "https://n/2", "OpenAI ships a very new model today!", "2024-06-01T11:00:00Z", None, None, 2),
                 ("m", "https://n/3", "Chips are scarce again", "2024-06-01T11:00:00Z", None, None, 3), ("n", "https://n/4", "Old story of last year", "2023-06-01", page, None, 4)],
    }
    return {k: spark.createDataFrame(v, engine.LANDED[k]) for k, v in rows.items()}


def test_signals(spark):
    stars = spark.createDataFrame([("own/repo", 7)], "repo string, stars int")
    out = engine.signals(spark, landed(spark), *dims(spark), F.lit(NOW).cast("timestamp"), stars=stars)
    for name in P.TABLES:
        assert out[name].columns == P.TABLES[name]
    col = lambda t, c: sorted(str(r[0]) for r in out[t].select(f"`{c}`").collect())
    assert col("startups", "content.entityName") == ["Anthropic", "OpenAI"]
    assert col("startups", "content.data.employeeCount") == ["5", "N/A"]
    assert col("products", "content.productName") == ["Chat"] and col("products", "content.startupName") == ["OpenAI"]
    assert col("papers", "content.github_stars") == ["", "7"] and col("papers", "content.authors") == ["A, B", "AI Researcher"]
    assert col("jobs", "content.company") == ["OpenAI"] and col("jobs", "content.is_remote") == ["true"]
    assert col("news", "source.url") == ["https://n/1?utm_source=a", "https://n/3"] and col("news", "content.summary") == ["Chips are scarce again", "snip"]
    edges = {(r.src, r.dst, r.relationship) for r in out["edges"].collect()}
    assert edges == {
        ("Startup:OpenAI", "Product:Chat", "SHIPPED"), ("Paper:https://p/1", "Repository:Own/Repo", "IMPLEMENTED_IN"), ("Startup:OpenAI", "Job:https://j/1", "HIRED_VIA"),
        ("Startup:OpenAI", "News:https://n/1?utm_source=a", "MENTIONED_IN"), ("Publisher:m", "News:https://n/3", "PUBLISHED"),
    }
    ids = {r.id for r in out["nodes"].collect()}
    assert {x for a, b, _ in edges for x in (a, b)} <= ids


def test_run_without_rows_writes_headers_and_a_shortfall(spark, tmp_path):
    report = engine.run(spark, {}, *dims(spark), F.lit(NOW).cast("timestamp"), str(tmp_path), "r0", 1)
    r = report.collect()[0]
    assert r.status == "shortfall" and set(r.collected.values()) == {0}
    assert (tmp_path / "jobs").exists() and (tmp_path / "report").exists()


def test_curation(spark):
    recent = dt.datetime(2024, 5, 25)
    names = [("Best", "o/best"), ("Same", "o/same"), ("Weak", "o/weak"), ("Gone", "o/gone"), ("Unscored", "o/unscored")]
    c = spark.createDataFrame([(n, "SERVER", "GitHub Topic Search", "", None, r, "docs", i) for i, (n, r) in enumerate(names + [("Best again", "O/Best")])], "name string, kind string, source string, description string, url string, repo string, docs_url string, seq long")
    p = spark.createDataFrame([(r, 404 if r == "o/gone" else 200, False, 3000, recent) for _, r in names], "repo string, code int, archived boolean, stars int, pushed_at timestamp")
    e = spark.createDataFrame([("gh:o/best", 30, 25, 5, "n"), ("gh:o/same", 30, 20, 5, "n"), ("gh:o/weak", 1, 1, 0, "n"), ("gh:o/unscored", 30, 25, 5, " ")], "key string, usefulness int, quality int, differentiation int, notes string")
    got = {r.key: (r.status, r.score, r.rank) for r in engine.curate(c, p, e, F.lit(NOW).cast("timestamp")).collect()}
    assert got == {
        "gh:o/best": ("VERIFIED", 95.0, 1), "gh:o/same": ("VERIFIED", 90.0, 2), "gh:o/weak": ("VERIFIED", 37.0, None),
        "gh:o/gone": ("REJECTED", 31.0, None), "gh:o/unscored": ("VERIFIED", 35.0, None),
    }
    assert engine.curate(c.limit(0), p.limit(0), e.limit(0), F.lit(NOW).cast("timestamp")).count() == 0


def test_command_line(spark, tmp_path, capsys):
    from winnow import cli

    for name, rows in landed(spark).items():
        if name != "papers":
            rows.write.json(f"{tmp_path}/landed/{name}")
    book = f"file://{tmp_path}/out.xlsx"
    args = [f"file://{tmp_path}/landed", "--output", f"file://{tmp_path}/out", "--now", NOW, "--target", "1", "--run", "1", "--workbook", book]
    assert cli.main(args, spark) == 1  # the papers did not land
    said = capsys.readouterr()
    assert "papers: not read" in said.err and "shortfall" in said.out
    assert cli.main([*args[:3], "--phase", "2", "--now", NOW, "--run", "2"], spark) == 0
    from winnow.sources import workbook as WB

    sheets = {r.sheet for r in WB.read_workbook(spark, book).collect()}
    assert {"jobs", "news", "products"} <= sheets and "papers" not in sheets


def test_bulk_rows_of_an_interrupted_run_come_back(spark, tmp_path):
    rows = landed(spark)
    root, now = f"file://{tmp_path}", F.lit(NOW).cast("timestamp")
    cut = {"startups": rows["startups"].where("seq = 1")}
    engine.run(spark, cut, *dims(spark), now, root, "r1", 5, phase="1")  # short of its target, so its log stays
    report = engine.run(spark, {"startups": rows["startups"].where("seq = 2")}, *dims(spark), now, root, "r2", 5, phase="1").first()
    assert report.collected["startups"] == 2 and report.status == "shortfall"
    report = engine.run(spark, {}, *dims(spark), now, root, "r3", 5, phase="1", fresh=True).first()
    assert report.collected["startups"] == 0


def test_an_interrupt_leaves_a_report(spark, tmp_path, monkeypatch):
    import pytest

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(engine, "signals", stop)
    with pytest.raises(KeyboardInterrupt):
        engine.run(spark, {}, *dims(spark), F.lit(NOW).cast("timestamp"), f"file://{tmp_path}", "r1", 5)
    assert spark.read.json(f"file://{tmp_path}/report").first().status == "interrupted"


def test_a_null_kind_or_group_loses_no_row(spark):
    from winnow.operators import dedup as D
    from winnow.operators import history as H

    d = spark.createDataFrame([("g", None, 1), ("g", "CLIENT", 2), (None, None, 3), ("g", "SERVER", 4)], "grp string, kind string, i int")
    assert D.cap_per_group(d, "grp", 2, F.col("i"), exempt=F.col("kind") == "CLIENT").count() == 4
    assert H.novel(d, d.limit(0).select("grp"), "grp", F.col("kind") == "CLIENT").count() == 4


def test_a_stale_posting_is_read_once(spark):
    """Names are gathered in one pass over the landed rows, and rows without a date leave before keys are compared."""
    read = spark.sparkContext.accumulator(0)
    told = F.udf(lambda i: read.add(1) or f"https://j/{i}")
    rows = spark.range(50).coalesce(1)
    jobs = rows.select(F.lit("b").alias("source"), told("id").alias("url"), F.lit("Open AI").alias("company"), F.lit("Machine Learning Engineer").alias("title"),
                       F.lit("1700000000000").alias("posted"), F.lit(None).cast("string").alias("location"), F.lit(None).cast("array<string>").alias("tags"), F.col("id").alias("seq"))
    seen = spark.createDataFrame([("jobs", "https://j/1")], engine.SEEN)
    out = engine.signals(spark, {"jobs": jobs}, *dims(spark), F.lit(NOW).cast("timestamp"), seen=seen)
    assert out["jobs"].count() == 0 and out["resolved"].count() == 1
    assert read.value == 50

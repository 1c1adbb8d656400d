"""The two whole runs over landed rows made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import engine
from ..operators import report as RP
from ..sources import readers as R
from ..sources import sinks as K
from ..store import scratch, stored
from .registry import query, table


_LANDED_SQL = """n AS (SELECT max(o_orderdate) AS now FROM orders),
o AS (SELECT o_orderkey, o_orderdate, c_mktsegment || ' Corp' AS company FROM orders JOIN customer ON o_custkey = c_custkey),
jobs AS (SELECT company, o_orderkey, 'https://j.example/' || o_orderkey AS url, CASE WHEN o_orderkey % 5 = 0 THEN now ELSE o_orderdate END AS date, o_orderkey % 5 = 0 AS inferred
 FROM o, n WHERE o_orderkey % 5 = 0 OR o_orderdate BETWEEN now - INTERVAL 24 HOUR AND now),
news AS (SELECT r_regionkey, r_name, 'https://n.example/' || r_regionkey AS url FROM region WHERE r_regionkey <> 3)"""


def _landed(spark, sf):
    """Five streams: every fifth job and two of the news are undated, one article is stale."""
    o, text = table(spark, sf, "orders"), F.coalesce("text", F.lit(""))
    joined, i = o.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")), F.col("o_orderkey")
    none, r = F.lit(None).cast("string"), F.col("r_regionkey")
    now = engine.fixed(spark, o.agg(F.max("o_orderdate").cast("timestamp")).scalar())
    posted = F.when(r == 3, F.lit("2001-01-01")).when(r < 3, F.unix_millis(now).cast("string"))
    landed = {
        "startups": table(spark, sf, "supplier").select(F.lit("list").alias("source"), none.alias("url"), F.col("s_name").alias("name"), F.lit(1).alias("employees"), F.col("s_suppkey").alias("seq")),
        "products": table(spark, sf, "part").select(F.lit("list").alias("source"), none.alias("url"), F.col("p_name").alias("name"), F.concat(F.lit("Maker "), "p_brand").alias("startup"), F.col("p_type").alias("description"), F.col("p_partkey").alias("seq")),
        "papers": table(spark, sf, "documents").select(F.concat(F.lit("https://p.example/"), "doc_id").alias("url"), F.substring_index(text, "\n", 1).alias("title"), F.array("source").alias("authors"), "text", F.lit("2024-01-02").alias("published"), F.col("doc_id").alias("seq")),
        "jobs": joined.select(F.lit("board").alias("source"), F.concat(F.lit("https://j.example/"), i).alias("url"), F.concat("c_mktsegment", F.lit(" Corp")).alias("company"), F.lit("AI Engineer").alias("title"),
                              F.when(i % 5 > 0, F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")).alias("posted"), none.alias("location"), F.lit(None).cast("array<string>").alias("tags"), i.alias("seq")),
        "news": table(spark, sf, "region").select(F.concat(F.lit("feed"), r % 2).alias("source"), F.concat(F.lit("https://n.example/"), r).alias("url"), F.concat("r_name", F.lit(" opens "), F.repeat(F.col("r_name"), 3)).alias("title"),
                                                  posted.alias("posted"), none.alias("html"), F.concat(F.lit("<b>About the opening of "), "r_name", F.lit("</b>")).alias("snippet"), r.cast("long").alias("seq")),
    }
    registry = spark.createDataFrame([("OpenAI",)], "canonical string")
    aliases = spark.createDataFrame([("mistralai", "Mistral AI")], "alias string, canonical string")
    domains = spark.createDataFrame([("openai.com", "OpenAI")], "domain string, canonical string")
    return landed, registry, aliases, domains, now


@query(f"""WITH {_LANDED_SQL},
products AS (SELECT p_name, 'Maker ' || min_by(p_brand, p_partkey) AS startup FROM part GROUP BY 1),
papers AS (SELECT doc_id FROM documents WHERE length(split_part(coalesce(text, ''), chr(10), 1)) >= 3),
names AS (SELECT s_name AS x FROM supplier UNION SELECT startup FROM products UNION SELECT company FROM jobs),
raws AS (SELECT s_name AS x FROM supplier UNION SELECT 'Maker ' || p_brand FROM part UNION SELECT company FROM o)
SELECT 'startups' AS name, count(*) AS n FROM supplier UNION ALL SELECT 'products', count(*) FROM products UNION ALL SELECT 'papers', count(*) FROM papers
UNION ALL SELECT 'jobs', count(*) FROM jobs UNION ALL SELECT 'news', count(*) FROM news UNION ALL SELECT 'logs', count(*) FROM raws
UNION ALL SELECT 'nodes', (SELECT count(*) FROM names) + (SELECT count(*) FROM products) + (SELECT count(*) FROM papers) + (SELECT count(*) FROM jobs) + (SELECT count(*) FROM news) + (SELECT count(DISTINCT r_regionkey % 2) FROM news)
UNION ALL SELECT 'edges', (SELECT count(*) FROM products) + (SELECT count(*) FROM jobs) + (SELECT count(*) FROM news)""")
def e6_signals_counts(spark, sf):
    out = engine.signals(spark, *_landed(spark, sf))
    return RP.collected({n: out[n] for n in ("startups", "products", "papers", "jobs", "news", "logs", "nodes", "edges")})


@query(f"""WITH {_LANDED_SQL}
SELECT 'JOB' AS kind, url, company AS title, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, CAST(inferred AS VARCHAR) AS inferred, 'Engineering' AS detail FROM jobs
UNION ALL SELECT 'NEWS', url, r_name || ' opens ' || repeat(r_name, 3), strftime(now, '%Y-%m-%d %H:%M:%S'), CAST(r_regionkey = 4 AS VARCHAR), 'About the opening of ' || r_name FROM news, n""")
def f6_w3_signals_rows(spark, sf):
    """The rows of the day's two streams: stated and undated ones, stale ones gone."""
    out = engine.signals(spark, *_landed(spark, sf))
    col = lambda c: F.col(f"`{c}`")
    jobs = out["jobs"].select("recordType", "`source.url`", "`content.company`", "`content.date`", "`content.date_inferred`", "`content.role_family`")
    news = out["news"].select("recordType", "`source.url`", "`content.title`", "`content.published_date`", "`content.date_inferred`", "`content.summary`")
    rows = jobs.toDF("kind", "url", "title", "date", "inferred", "detail").unionByName(news.toDF("kind", "url", "title", "date", "inferred", "detail"))
    return rows.withColumn("date", F.substring("date", 1, 19))


@query(f"""WITH {_LANDED_SQL}
SELECT 1 AS run, 'jobs' AS what, count(*) AS n FROM jobs UNION ALL SELECT 1, 'news', count(*) FROM news UNION ALL SELECT 2, 'jobs', count(*) FROM jobs WHERE NOT inferred UNION ALL SELECT 2, 'news', count(*) FROM news WHERE r_regionkey < 3
UNION ALL SELECT 3, 'jobs', count(*) FROM jobs UNION ALL SELECT 3, 'news', count(*) FROM news UNION ALL SELECT 0, 'registry', 1 + (SELECT count(DISTINCT company) FROM jobs) + (SELECT count(*) FROM (SELECT DISTINCT company FROM o WHERE company NOT IN (SELECT company FROM jobs)))
UNION ALL SELECT 0, 'seen', (SELECT count(*) FROM jobs WHERE inferred) + (SELECT count(*) FROM news WHERE r_regionkey > 3) UNION ALL SELECT 0, 'history', 3""")
def j6_t5_e5_e13_stateful_runs(spark, sf):
    """Three runs over one folder: in the second no undated row is new, the third forgets the state first."""
    landed, registry, aliases, domains, now = _landed(spark, sf)
    landed["jobs"] = stored(landed["jobs"])  # each run reads them several times
    root = scratch(spark)
    parts = []
    for k, fresh in ((1, False), (2, False), (3, True)):
        report = engine.run(spark, landed, registry, aliases, domains, now, root, f"r{k}", 1, phase="2", run=k, fresh=fresh)
        parts.append(report.select(F.lit(k).alias("run"), F.explode(F.col("collected")).alias("what", "n")).where(F.col("what").isin("jobs", "news")))
        parts[-1] = stored(parts[-1])
    state = {"registry": K.load_registry(spark, f"{root}/registry", registry)[0], "seen": K.read_state(spark, f"{root}/state/seen", engine.SEEN), "history": K.read_state(spark, f"{root}/state/runs", engine.RUNS)}
    for name, rows in state.items():
        parts.append(rows.agg(F.count("*").alias("n")).select(F.lit(0).alias("run"), F.lit(name).alias("what"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SCORED = """WITH s AS (SELECT 'gh:o/r' || p_partkey AS key, p_partkey, p_name, p_type = 'ECONOMY' AS client, least(15 + CASE WHEN p_partkey >= 2000 THEN 10 WHEN p_partkey >= 500 THEN 8 WHEN p_partkey >= 100 THEN 6 WHEN p_partkey >= 10 THEN 4 WHEN p_partkey >= 1 THEN 2 ELSE 0 END
 + 3 + CASE WHEN p_size % 6 = 0 THEN 1 ELSE 5 END + p_size % 31 + 20, 100) AS score, p_size % 6 = 0 AS gone, p_size % 31 > 0 OR TRUE AS scored FROM part)"""


def _deliverables(spark, sf):
    p, i, size = table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    repo, none, now = F.concat(F.lit("O/r"), i), F.lit(None).cast("string"), F.lit("2024-06-01").cast("timestamp")
    cands = p.select(F.col("p_name").alias("name"), F.when(F.col("p_type") == "ECONOMY", "CLIENT").otherwise("SERVER").alias("kind"), F.lit("GitHub Topic Search").alias("source"), none.alias("description"), none.alias("url"), repo.alias("repo"), none.alias("docs_url"), i.alias("seq"))
    probes = p.select(repo.alias("repo"), F.when(size % 6 == 0, 404).otherwise(200).alias("code"), F.lit(False).alias("archived"), i.alias("stars"), now.alias("pushed_at"))
    evals = p.select(F.concat(F.lit("gh:o/r"), i).alias("key"), (size % 31).alias("usefulness"), F.lit(20).alias("quality"), F.lit(0).alias("differentiation"), F.lit("fit").alias("notes"))
    return engine.deliverables(engine.curate(cands, probes, evals, now))


@query(f"""{_SCORED}
SELECT CASE WHEN gone THEN 'rejected' WHEN client AND score >= 40 THEN 'clients' WHEN NOT client AND score >= 65 THEN 'servers' ELSE 'rejected' END AS tab, p_name AS name,
 CASE WHEN gone THEN 'REPO_GONE' WHEN score >= CASE WHEN client THEN 40 ELSE 65 END THEN '' ELSE 'SUB_THRESHOLD_SCORE: ' || printf('%.1f', CAST(score AS DOUBLE)) END AS reason FROM s""")
def k15_j8_deliverables(spark, sf):
    """Servers, clients and the rejected log of a run in which every verified row is scored."""
    parts = [d.select(F.lit(tab).alias("tab"), "name", (F.col("rejection_reason") if tab == "rejected" else F.lit("")).alias("reason")) for tab, d in _deliverables(spark, sf).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""{_SCORED}
SELECT row_number() OVER (ORDER BY score DESC, p_partkey DESC) AS "Rank", p_name AS "MCP Name", CASE WHEN p_partkey > 0 THEN CAST(p_partkey AS VARCHAR) END AS "GitHub Stars", 'https://github.com/O/r' || p_partkey AS "GitHub URL", 'MIT' AS "License"
FROM s WHERE NOT gone AND NOT client AND score >= 65""")
def k15_p5_p6_deliverable_files(spark, sf):
    """The servers' CSV read back: fixed headers and defaults, a zero as an empty cell."""
    root = scratch(spark)
    engine.write_deliverables(_deliverables(spark, sf), root)
    d = R.read_csv(spark, f"{root}/servers")
    return d.select(F.col("Rank").cast("int").alias("Rank"), "`MCP Name`", "`GitHub Stars`", "`GitHub URL`", "License")


@query("""SELECT 'gh:o/r' || p_partkey AS key, CASE WHEN p_partkey % 4 = 0 OR p_partkey IN (SELECT p_partkey FROM part ORDER BY p_partkey DESC LIMIT 0) THEN 'VERIFIED' ELSE 'PENDING' END AS status,
 p_partkey % 4 = 0 AND row_number() OVER (PARTITION BY p_partkey % 4 = 0 ORDER BY p_partkey DESC) <= 10 AS scored FROM part""")
def j7_j8_l6_resume(spark, sf):
    """Keys verified in an earlier run need no probe; at most ten verified rows, the most stars first, take an evaluation."""
    p, i = table(spark, sf, "part"), F.col("p_partkey")
    repo, none, now = F.concat(F.lit("O/r"), i), F.lit(None).cast("string"), F.lit("2024-06-01").cast("timestamp")
    cands = p.select(F.col("p_name").alias("name"), F.lit("SERVER").alias("kind"), F.lit("GitHub Topic Search").alias("source"), none.alias("description"), none.alias("url"), repo.alias("repo"), none.alias("docs_url"), i.alias("stars"), i.alias("seq"))
    probes = spark.createDataFrame([], "repo string, code int, archived boolean, stars int, pushed_at timestamp")
    evals = p.select(F.concat(F.lit("gh:o/r"), i).alias("key"), F.lit(9).alias("usefulness"), F.lit(9).alias("quality"), F.lit(0).alias("differentiation"), F.lit("fit").alias("notes"))
    verified = p.where(i % 4 == 0).select(F.concat(F.lit("gh:o/r"), i).alias("key"))
    return engine.curate(cands, probes, evals, now, verified=verified, max_pending=10).select("key", "status", "scored")


@query("""WITH c AS (SELECT p_partkey, 'gh:o/r' || p_partkey AS key, CASE WHEN p_type = 'ECONOMY' THEN 'CLIENT' ELSE 'SERVER' END AS kind, p_size, p_partkey AS stars,
 CASE WHEN p_size IN (7, 8) THEN 'REJECTED' WHEN p_size = 39 THEN 'PENDING' WHEN p_size <> 9 THEN 'VERIFIED' WHEN p_type = 'SMALL' THEN 'VERIFIED' ELSE 'REJECTED' END AS status,
 p_size % 4 = 0 AS clustered, p_size % 31 AS u, p_size % 26 AS q, p_size % 6 AS d, p_retailprice > 950 AS documented FROM part),
s AS (SELECT *, least(CASE WHEN p_size = 8 THEN 0 WHEN p_size <= 3 THEN 15 WHEN p_size <= 9 THEN 10 WHEN p_size <= 18 THEN 5 ELSE 0 END
 + CASE WHEN stars >= 2000 THEN 10 WHEN stars >= 500 THEN 8 WHEN stars >= 100 THEN 6 WHEN stars >= 10 THEN 4 WHEN stars >= 1 THEN 2 ELSE 0 END
 + CASE WHEN documented THEN 5 ELSE 3 END + CASE WHEN status = 'VERIFIED' THEN 5 ELSE 1 END + CASE WHEN u = 0 AND q = 0 THEN 0 ELSE u + q + d END, 100) AS score FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY clustered AND kind <> 'CLIENT' ORDER BY score DESC, stars DESC, key) AS rn FROM s WHERE status = 'VERIFIED'),
f AS (SELECT key, row_number() OVER (PARTITION BY kind ORDER BY score DESC, stars DESC, key) AS rank FROM k
 WHERE (rn <= 4 OR NOT clustered OR kind = 'CLIENT') AND NOT (u = 0 AND q = 0) AND score >= CASE kind WHEN 'CLIENT' THEN 40 ELSE 65 END)
SELECT key, status, CAST(score AS DOUBLE) AS score, rank FROM s LEFT JOIN f USING (key)""")
def e9_f13_curation_run(spark, sf):
    p, size = table(spark, sf, "part"), F.col("p_size")
    repo = F.concat(F.lit("O/r"), "p_partkey")
    now = F.lit("2024-06-01").cast("timestamp")
    # code 429 at sizes 9 and 39: the shard decides
    source = F.when(F.col("p_type") == "SMALL", "Official Registry").otherwise("Glama.ai")
    cands = p.select(
        F.col("p_name").alias("name"), F.when(F.col("p_type") == "ECONOMY", "CLIENT").otherwise("SERVER").alias("kind"), F.when(size == 39, "GitHub Topic Search").otherwise(source).alias("source"),
        F.when(size % 4 == 0, "postgres tool").alias("description"), F.lit(None).cast("string").alias("url"), repo.alias("repo"), F.when(F.col("p_retailprice") > 950, "d").alias("docs_url"), F.col("p_partkey").alias("seq"),
    )
    code = F.when(size == 7, 404).when(size.isin(9, 39), 429).otherwise(200)
    probes = p.select(repo.alias("repo"), code.alias("code"), (size == 8).alias("archived"), F.col("p_partkey").alias("stars"), F.timestamp_seconds(F.unix_timestamp(now) - size * 864_000).alias("pushed_at"))
    evals = p.select(F.concat(F.lit("gh:o/r"), "p_partkey").alias("key"), (size % 31).alias("usefulness"), (size % 26).alias("quality"), (size % 6).alias("differentiation"), F.lit("fit").alias("notes"))
    return engine.curate(cands, probes, evals, now).select("key", "status", "score", "rank")

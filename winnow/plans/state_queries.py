"""Predicates, dates, choices, state machines and reports that the other modules leave, over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import engine
from ..functions import choice as N
from ..functions import classify as C
from ..functions import temporal as T
from ..functions import text as X
from ..functions import urls as U
from ..functions.tokens import token_budget
from ..operators import dedup as D
from ..operators import report as RP
from ..operators import resolve as RS
from ..operators import shaping as P
from ..sources import readers as R
from ..sources import sinks as K
from ..store import scratch
from ..streaming import stateful as ST
from .registry import dealt, query, table
from .text_queries import SQL_CRC, sql_any, sql_name_key

_NOW = "2024-03-01 12:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp")


def _plain(c):
    return c.cast("timestamp_ntz")


# --- predicates ---------------------------------------------------------------


@query(r"""SELECT p_partkey, p_size % 5 = 0 OR p_size % 5 = 1 OR p_size % 5 = 4 AS topic FROM part""")
def f1_on_topic(spark, sf):
    k, name = F.col("p_size") % 5, F.col("p_name")
    title = F.when(k == 0, F.concat(F.lit("AI "), name)).when(k == 1, F.concat(name, F.lit(" Machine Learning"))).when(k == 2, F.concat(F.lit("Maid "), name)).when(k == 3, F.concat(F.lit("HTML "), name)).otherwise(F.concat(name, F.lit(" llm")))
    return table(spark, sf, "part").select("p_partkey", C.on_topic(title).alias("topic"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'blank' WHEN o_orderkey % 7 = 1 THEN 'forum' WHEN o_orderkey % 3 = 0 AND o_orderdate < max(o_orderdate) OVER () - INTERVAL 24 HOUR THEN 'stale' END AS why FROM orders""")
def f5_early_reject(spark, sf):
    o, i = table(spark, sf, "orders"), F.col("o_orderkey")
    now = engine.fixed(spark, o.agg(F.max("o_orderdate").cast("timestamp")).scalar())
    link = F.when(i % 7 == 1, "https://news.ycombinator.com/item").otherwise("https://a.org")
    posted = F.when(i % 3 == 0, F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"))
    return dealt(o, "o_orderkey").select("o_orderkey", N.early_reject(F.when(i % 7 == 0, " ").otherwise("t"), link, posted, now).alias("why"))


@query(f"""WITH o AS (SELECT o_orderkey, o_orderkey % 6 AS k, o_orderdate, max(o_orderdate) OVER () AS now FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN CASE WHEN o_orderdate >= now - INTERVAL 24 HOUR THEN o_orderdate END WHEN 1 THEN now - INTERVAL 3 HOUR WHEN 2 THEN now WHEN 3 THEN now - INTERVAL 24 HOUR WHEN 4 THEN now END AS date,
 k IN (1, 2, 3, 4) AS inferred FROM o""")
def f6_x16_job_date(spark, sf):
    """Stated, told by the title in three ways, new since the last run, and seen before."""
    o = table(spark, sf, "orders").withColumn("k", F.col("o_orderkey") % 6)
    now = engine.fixed(spark, o.agg(F.max("o_orderdate").cast("timestamp")).scalar())
    k = F.col("k")
    title = F.when(k == 1, "Engineer, posted 3 hours ago").when(k == 2, "Just announced: engineer").when(k == 3, "Yesterday's engineer").otherwise("Engineer")
    posted = F.when(k == 0, F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"))
    got = T.job_date(posted, title, k == 4, now)
    return dealt(o, "o_orderkey").select("o_orderkey", got.alias("g")).select("o_orderkey", _plain(F.col("g.date")).alias("date"), F.col("g.inferred").alias("inferred"))


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN TIMESTAMP '2024-03-01 06:00:00' WHEN 2 THEN TIMESTAMP '2024-03-01 07:00:00' WHEN 3 THEN TIMESTAMP '2024-03-01 10:00:00' WHEN 4 THEN TIMESTAMP '2024-03-01 12:00:00' END AS date, p_size % 6 IN (2, 3, 4) AS inferred FROM part""")
def x17_news_date(spark, sf):
    """Feed date, stale feed date, page date, text, new key, and a stale page date that novelty must not override."""
    k = F.col("p_size") % 6
    posted = F.when(k == 0, "2024-03-01T06:00:00Z").when(k == 1, "2024-02-01T06:00:00Z")
    html = F.when(k == 2, '<meta name="pubdate" content="2024-03-01T07:00:00Z">').when(k == 5, '<meta name="date" content="2023-01-01">').otherwise("<p>x</p>")
    text = F.when(k == 3, "updated 2 hours ago by staff").otherwise("a story")
    got = T.news_date(posted, html, F.lit("https://a.org/x"), text, k.isin(1, 4, 5), _now())
    return dealt(table(spark, sf, "part"), "p_partkey").select("p_partkey", got.alias("g")).select("p_partkey", _plain(F.col("g.date")).alias("date"), F.col("g.inferred").alias("inferred"))


@query(f"""WITH s AS (SELECT s_suppkey, s_suppkey % 4 AS k, {sql_name_key("s_name")} AS key FROM supplier)
SELECT s_suppkey, CASE k WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE ELSE TRUE END AS official FROM s""")
def f8_official_domain(spark, sf):
    k, key = F.col("s_suppkey") % 4, X.name_key(F.col("s_name"))
    first = F.substring_index(key, " ", 1)
    domain = F.when(k == 0, F.concat(first, F.lit(".org"))).when(k == 1, "github.com").when(k == 2, "zzz.org").otherwise(F.concat(F.lower(key), F.lit("hq.com")))
    return table(spark, sf, "supplier").select("s_suppkey", U.official_domain(domain, key).alias("official"))


_MESSAGES = ["HTTP 429 Too Many", "403 API Rate Limit", "403 forbidden", "quota gone", "Request too large: 413", "maximum context length", "socket timeout", "RESOURCE_EXHAUSTED"]
_MESSAGE_SQL = "[" + ", ".join(f"'{m}'" for m in _MESSAGES) + "][1 + o_orderkey % 8]"


@query(f"""WITH m AS (SELECT o_orderkey, lower({_MESSAGE_SQL}) AS m FROM orders)
SELECT o_orderkey, contains(m, '429') OR (contains(m, '403') AND (contains(m, 'rate limit') OR contains(m, 'quota'))) AS quota,
 CASE WHEN {sql_any("m", C.TOO_LARGE)} THEN 'payload' WHEN {sql_any("m", C.USED_UP)} THEN 'rate_limit' ELSE 'transient' END AS kind FROM m""")
def f9_f10_errors(spark, sf):
    m = F.get(F.array(*[F.lit(x) for x in _MESSAGES]), (F.col("o_orderkey") % 8).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", C.quota_error(m).alias("quota"), C.provider_error(m).alias("kind"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'REJECTED' WHEN o_orderkey % 4 = 0 AND o_orderstatus = 'F' THEN 'REJECTED' ELSE 'VERIFIED' END AS status,
 CASE WHEN o_orderkey % 3 = 0 THEN 'ARCHIVED' WHEN o_orderkey % 4 = 0 AND o_orderstatus = 'F' THEN 'ZERO_ACTIVITY_STUB' ELSE '' END AS reason FROM orders""")
def f12_verification(spark, sf):
    i = F.col("o_orderkey")
    got = C.verification(i % 3 == 0, F.when(i % 8 > 0, i % 4), F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")))
    return table(spark, sf, "orders").select("o_orderkey", got.alias("g")).select("o_orderkey", "g.status", "g.reason")


_CODES = [200, 204, 301, 403, 404, 429, 500, 503]


@query("""WITH c AS (SELECT o_orderkey, [200, 204, 301, 403, 404, 429, 500, 503][1 + o_orderkey % 8] AS code FROM orders)
SELECT o_orderkey, CASE WHEN code = 403 THEN 'blocked' WHEN code IN (429, 500, 503) THEN 'transient' WHEN code = 404 THEN 'fatal' END AS error, code < 400 OR o_orderkey % 5 = 0 AS alive FROM c""")
def s3_f18_status(spark, sf):
    i = F.col("o_orderkey")
    code = F.get(F.array(*[F.lit(c) for c in _CODES]), (i % 8).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", C.status_error(code).alias("error"), C.site_alive(code, F.when(i % 5 == 0, 200)).alias("alive"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN 'Own' || p_partkey END AS owner, p_size % 4 IN (0, 2) AS excluded FROM part""")
def f14_f7_urls(spark, sf):
    i, size = F.col("p_partkey"), F.col("p_size")
    url = F.when(size % 3 == 0, "https://github.com/topics/agents").when(size % 3 == 1, F.concat(F.lit("https://github.com/Own"), i, F.lit("/x"))).otherwise("https://a.org/b/c")
    picture = F.when(size % 4 == 0, "https://a.org/logo.svg").when(size % 4 == 2, "https://awesome.re/badge").otherwise("https://a.org/svg")
    return table(spark, sf, "part").select("p_partkey", U.repo_owner(url).alias("owner"), U.product_url_excluded(picture).alias("excluded"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'repository' WHEN p_size % 4 = 1 THEN 'registry' WHEN p_size % 4 = 2 THEN 'directory' END AS shard FROM part""")
def j14_shards(spark, sf):
    k = F.col("p_size") % 4
    source = F.when(k == 0, "Glama.ai, GitHub Topic Search, Official Registry").when(k == 1, "Official Registry, Smithery.ai").when(k == 2, "Smithery.ai").otherwise("elsewhere")
    return table(spark, sf, "part").select("p_partkey", C.shard(source).alias("shard"))


# --- dates and texts --------------------------------------------------------------


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN TIMESTAMP '2024-01-02' WHEN 1 THEN TIMESTAMP '2024-01-03' WHEN 2 THEN TIMESTAMP '2024-01-04' WHEN 3 THEN TIMESTAMP '2024-01-05' END AS date FROM part""")
def x12_x15_page_dates(spark, sf):
    """Meta tag, second item of a second script, second time element, path; an empty page has no date even if its path has."""
    k = F.col("p_size") % 5
    script = '<script type="application/ld+json">{"@type": "BreadcrumbList"}</script><script type="application/ld+json">[{"name": "x"}, {"uploadDate": "2024-01-03", "author": {"name": "y"}}]</script>'
    html = (
        F.when(k == 0, '<meta content="2024-01-02" property="article:published_time"><time datetime="2020-01-01">x</time>').when(k == 1, script + "<time>2020-01-01</time>")
        .when(k == 2, '<time datetime="soon">soon</time><time>2024-01-04</time>').when(k == 3, "<p>x</p>").otherwise("")
    )
    url = F.when(k >= 3, "https://a.org/2024-1-5/x").otherwise("https://a.org/x")
    return dealt(table(spark, sf, "part"), "p_partkey").select("p_partkey", _plain(T.date_from_html(html, url, _now())).alias("date"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN 90.0 WHEN 2 THEN 0.0 END AS wait FROM part""")
def x10_retry_after(spark, sf):
    k = F.col("p_size") % 4
    value = F.when(k == 0, F.col("p_size").cast("string")).when(k == 1, "Fri, 01 Mar 2024 12:01:30 GMT").when(k == 2, "Fri, 01 Mar 2024 11:00:00 GMT").otherwise("soon")
    return dealt(table(spark, sf, "part"), "p_partkey").select("p_partkey", T.retry_after(value, _now()).alias("wait"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Acme Labs' WHEN 1 THEN 'Tool' WHEN 2 THEN 'own' || p_partkey ELSE 'Site' END AS maker,
 CASE WHEN p_size % 3 = 0 THEN 'own/repo' || p_partkey END AS repo, CASE WHEN p_size % 3 = 1 THEN 'https://ext.org/' || p_partkey END AS link,
 CASE WHEN p_size % 2 = 0 THEN '{"a": 1}' ELSE 'plain' END AS json FROM part""")
def x23_x24_x25_x32_extracts(spark, sf):
    p, i, size = table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    k = size % 4
    name = F.when(k >= 2, "this name reads like a whole sentence.").otherwise("Tool")
    url = F.when(k == 2, F.concat(F.lit("https://github.com/own"), i, F.lit("/r"))).otherwise("https://www.site.io/x")
    about = F.when(k == 0, "A thing by Acme Labs is here").otherwise("nothing told")
    text = F.when(size % 3 == 0, F.concat(F.lit("See (https://github.com/own/repo"), i, F.lit(".git), ok"))).otherwise("none")
    html = F.concat(F.lit('<a href="https://forum.org/item">x</a>'), F.when(size % 3 == 1, F.concat(F.lit('<A HREF="https://ext.org/'), i, F.lit('">y</A>'))).otherwise(""))
    fenced = F.when(size % 2 == 0, '```json\n{"a": 1}\n```').otherwise(" plain ")
    return p.select("p_partkey", C.maker(name, about, url).alias("maker"), X.repo_path(text).alias("repo"), U.external_link(html, "forum.org").alias("link"), X.unfenced(fenced).alias("json"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'a a a a a' ELSE 'a a a' END AS cut FROM customer""")
def x27_token_budget(spark, sf):
    """Five tokens at most of a vocabulary in which `a` and ` a` are one token each."""
    import public_tokenizers as vocabulary

    text = F.when(F.col("c_custkey") % 2 == 0, F.repeat(F.lit("a "), 9)).otherwise("a a a")
    cut = token_budget(text, 5, str(vocabulary.path("byte_bpe_50k.tiktoken")), vocabulary.PATTERN)
    return table(spark, sf, "customer").select("c_custkey", cut.alias("cut"))


# --- rows and tables ----------------------------------------------------------------


def _record(kind, content):
    return [F.lit("1.0").alias("schemaVersion"), F.lit(kind).alias("recordType"), F.struct(F.lit("n").alias("name"), F.lit("u").alias("url")).alias("source"), content.alias("content"), F.lit("c").alias("collectedAt")]


@query("""SELECT p_name AS "content.productName", coalesce(CASE WHEN p_size > 5 THEN 'https://p/' || p_partkey END, 'N/A') AS "content.productUrl", CASE WHEN p_size % 2 = 0 THEN 'FREE' ELSE '' END AS "content.pricingModel" FROM part""")
def p2_p7_product_rows(spark, sf):
    p, size = table(spark, sf, "part"), F.col("p_size")
    price = P.enum_text(F.when(size % 2 == 0, "FREE"))
    content = F.struct(F.col("p_name").alias("productName"), F.lit("s").alias("startupName"), price.alias("pricingModel"), F.when(size > 5, F.concat(F.lit("https://p/"), "p_partkey")).alias("productUrl"))
    return P.product_rows(p.select(*_record("PRODUCT", content))).select("`content.productName`", "`content.productUrl`", "`content.pricingModel`")


@query("""SELECT s_name AS "content.title", s_name || ', B' AS "content.authors", CASE WHEN s_suppkey % 3 > 0 THEN 'https://github.com/o/' || s_suppkey ELSE '' END AS "content.github_url",
 CASE s_suppkey % 3 WHEN 1 THEN CAST(s_suppkey AS VARCHAR) WHEN 2 THEN 'N/A' ELSE '' END AS "content.github_stars" FROM supplier""")
def p3_paper_rows(spark, sf):
    s, i = table(spark, sf, "supplier"), F.col("s_suppkey")
    content = F.struct(
        F.col("s_name").alias("title"), F.array("s_name", F.lit("B")).alias("authors"), F.lit("u").alias("paper_url"), F.when(i % 3 > 0, F.concat(F.lit("https://github.com/o/"), i)).alias("github_url"),
        F.when(i % 3 == 1, i).alias("github_stars"), F.lit("d").alias("published_date"),
    )
    return P.paper_rows(s.select(*_record("RESEARCH_PAPER", content))).select("`content.title`", "`content.authors`", "`content.github_url`", "`content.github_stars`")


@query("""SELECT c_name AS "content.company", CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS "content.is_remote", c_mktsegment AS "content.role_family", CAST(c_custkey AS VARCHAR) AS "confidenceScore", 'NEW_ENTITY' AS "matchMethod" FROM customer""")
def p4_job_and_log_rows(spark, sf):
    c, i = table(spark, sf, "customer"), F.col("c_custkey")
    content = F.struct(F.col("c_name").alias("company"), F.lit("t").alias("title"), F.lit("d").alias("date"), F.lit(False).alias("date_inferred"), (i % 2 == 0).alias("is_remote"), F.col("c_mktsegment").alias("role_family"))
    jobs = P.job_rows(c.select(*_record("JOB", content))).select("`content.company`", "`content.is_remote`", "`content.role_family`")
    logs = P.log_rows(c.select(F.col("c_name").alias("rawName"), F.lit("x").alias("canonicalName"), F.lit("STARTUP").alias("entityType"), F.lit("NEW_ENTITY").alias("matchMethod"), i.alias("confidenceScore"), F.lit("u").alias("sourceUrl"), F.lit("t").alias("timestamp")))
    return jobs.join(logs, F.col("`content.company`") == F.col("rawName")).select("`content.company`", "`content.is_remote`", "`content.role_family`", "confidenceScore", "matchMethod")


@query("""SELECT p_partkey, p_size >= 1 AND p_size <> 7 AS startup, length(p_name) >= 20 AS paper, p_size <> 7 AND p_size <= 20 AS log FROM part""")
def f15_constraints(spark, sf):
    p, size = table(spark, sf, "part"), F.col("p_size")
    blank_at_7 = F.when(size == 7, " ").otherwise(F.col("p_name"))
    one = p.select("p_partkey", F.struct(blank_at_7.alias("entityName"), F.struct(F.when(size > 2, size).alias("employeeCount")).alias("data")).alias("content")).withColumn("startup", P.constraints("startups"))
    paper = F.struct(F.when(F.length("p_name") >= 20, F.col("p_name")).otherwise("ab").alias("title"), F.array(F.lit("a")).alias("authors"), F.lit("d").alias("published_date"), F.lit(None).cast("int").alias("github_stars"))
    two = p.select("p_partkey", paper.alias("content")).withColumn("paper", P.constraints("papers"))
    three = p.select("p_partkey", blank_at_7.alias("rawName"), F.lit("c").alias("canonicalName"), (size / 20.0).alias("confidenceScore")).withColumn("log", P.constraints("logs"))
    return one.select("p_partkey", "startup").join(two.select("p_partkey", "paper"), "p_partkey").join(three.select("p_partkey", "log"), "p_partkey")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS k, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1 AND o_custkey % 4 > 0 ORDER BY o_orderkey LIMIT 30""")
def l2_batch_limit(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("k"), "o_orderkey")
    seen = table(spark, sf, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").cast("string").alias("k"))
    return D.batch_limit(o, seen, "k", 30, F.col("o_orderkey"))


@query("""SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank, substr(c_name, 1, 12) AS c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20""")
def l7_preview(spark, sf):
    return P.preview(table(spark, sf, "customer"), {"c_name": 12, "c_acctbal": 0}, F.desc("c_acctbal"), F.col("c_custkey")).select("rank", "c_name", "c_acctbal")


@query("""SELECT o_custkey FROM (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY 1) ORDER BY first LIMIT 35""")
def l8_distinct_prefix(spark, sf):
    return D.distinct_prefix(table(spark, sf, "orders"), "o_custkey", 35, F.col("o_orderkey"))


@query("""SELECT c_custkey FROM customer ORDER BY md5('7:' || c_custkey), c_custkey LIMIT 5""")
def l9_sample(spark, sf):
    return D.sample_rows(table(spark, sf, "customer"), 5, "c_custkey", seed=7).select("c_custkey")


@query("""WITH p AS (SELECT 'https://u/' || (o_custkey % 400) AS url, o_orderkey AS seq FROM orders), s AS (SELECT url FROM p GROUP BY url ORDER BY min(seq) LIMIT 100)
SELECT 'live' AS gate, count(*) AS total, CAST(count(*) FILTER (CAST(substr(url, 11) AS INT) % 50 > 0) AS BIGINT) AS good,
 count(*) FILTER (CAST(substr(url, 11) AS INT) % 50 > 0) >= 0.95 * count(*) OR count(*) FILTER (CAST(substr(url, 11) AS INT) % 50 = 0) <= 3 AS passed FROM s""")
def e11_liveness(spark, sf):
    urls = table(spark, sf, "orders").select(F.concat(F.lit("https://u/"), F.col("o_custkey") % 400).alias("url"), F.col("o_orderkey").alias("seq"))
    probes = urls.select("url").distinct().withColumn("code", F.when(F.substring("url", 11, 9).cast("int") % 50 > 0, 200).otherwise(404))
    return RP.liveness(urls, probes, 100)


@query("SELECT name, name <> 'jobs' AS ok, (SELECT count(*) FROM supplier) AS n FROM (VALUES ('startups'), ('products'), ('papers'), ('jobs'), ('news'), ('logs')) v(name)")
def e10_headers(spark, sf):
    """Tables of suppliers written under the fixed headers of each kind and read again; one lacks its last column."""
    s, out = table(spark, sf, "supplier"), []
    for name, columns in P.TABLES.items():
        path = scratch(spark)
        K.write_csv(s.select(*[F.col("s_name").alias(c) for c in (columns[:-1] if name == "jobs" else columns)]), path)
        rows = R.read_csv(spark, path)
        out.append(rows.agg(F.lit(name).alias("name"), F.lit(RP.header_ok(rows, name)).alias("ok"), F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, out)


# --- resolver -------------------------------------------------------------------------


@query("""WITH n AS (SELECT 'Customer ' || c_custkey // 3 || CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' Inc' ELSE ' Labs' END AS raw, c_custkey // 3 AS k, (c_custkey * 7919) % 10007 AS seq FROM customer),
f AS (SELECT *, first_value(raw) OVER (PARTITION BY k ORDER BY seq, raw) AS canonical FROM n)
SELECT raw, canonical, CASE WHEN raw = canonical THEN 'NEW_ENTITY' ELSE 'NORMALIZATION_EXACT' END AS method FROM f""")
def x7_learning_in_order(spark, sf):
    """Three spellings of each name arrive out of order: the first becomes the entity, the others are found by its key."""
    c, i = table(spark, sf, "customer"), F.col("c_custkey")
    raw = F.concat(F.lit("Customer "), F.floor(i / 3), F.when(i % 3 == 0, "").when(i % 3 == 1, " Inc").otherwise(" Labs"))
    names = c.select(raw.alias("raw"), F.lit(None).cast("string").alias("domain"), (i * 7919 % 10007).alias("seq"))
    pairs = spark.createDataFrame([], "alias string, canonical string")
    got, _, _ = RS.learn_in_order(names, pairs.select("canonical"), pairs, pairs.withColumnRenamed("alias", "domain"), accept=100.0)
    return got.select("raw", "canonical", "method")


@query("""SELECT canonical, domain FROM (SELECT s_name AS canonical, CASE WHEN s_suppkey % 2 = 0 THEN 'supplier#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '.com' END AS domain FROM supplier UNION ALL VALUES ('Known', 'known.org'))""")
def x7_learning(spark, sf):
    s = table(spark, sf, "supplier")
    domain = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lower("s_name"), F.lit(".com"))).otherwise("github.com")
    none = spark.createDataFrame([], "alias string, canonical string")
    registry, known = spark.createDataFrame([("Known",)], "canonical string"), spark.createDataFrame([("known.org", "Known")], "domain string, canonical string")
    # names that differ in digits only are alike, so nothing but an equal name is accepted
    names = s.select(F.col("s_name").alias("raw"), domain.alias("domain"))
    got = RS.resolve(names, registry, none, known, accept=100.0)
    grounded = got.withColumn("domain", F.regexp_replace("domain", r"^([^.]*)", "$1"))
    learned = RS.learn(got, registry)
    domains = RS.learn_domains(grounded.withColumn("raw", F.regexp_replace("raw", "#", "")).withColumn("domain", F.regexp_replace("domain", "#", "")), known)
    domains = domains.withColumn("domain", F.regexp_replace("domain", "^supplier", "supplier#"))
    return learned.join(domains, "canonical", "left").select("canonical", "domain")


@query("""SELECT s_name AS raw, CASE WHEN s_suppkey = 1 THEN 'NORMALIZATION_EXACT' WHEN row_number() OVER (ORDER BY s_suppkey = 1, s_name) <= 5 THEN 'LLM_DISAMBIGUATION' ELSE 'NEW_ENTITY' END AS method FROM supplier""")
def x8_tie_break(spark, sf):
    """Scores in the band go to the injected choice, the five first names only; the rest are new."""
    none = spark.createDataFrame([], "alias string, canonical string"), spark.createDataFrame([], "domain string, canonical string")
    names = table(spark, sf, "supplier").select(F.col("s_name").alias("raw"), F.lit(None).cast("string").alias("domain"))
    registry = spark.createDataFrame([("Supplier#000000001",)], "canonical string")
    return RS.resolve(names, registry, *none, accept=99.0, tie_break=F.lit("chosen"), budget=5).select("raw", "method")


# --- state machines --------------------------------------------------------------------


@query("""WITH a AS (SELECT o_custkey AS request, o_orderkey % 5 AS round, o_orderkey % 3 AS key, o_orderkey % 4 AS model, o_orderstatus = 'F' AS valid FROM orders),
b AS (SELECT request, min((round * 3 + key) * 4 + model) FILTER (valid AND round < 4) AS p, count(*) FILTER (round < 4) AS tried FROM a GROUP BY 1)
SELECT request, CAST(p // 12 AS BIGINT) AS round, CAST((p // 4) % 3 AS BIGINT) AS key, CAST(p % 4 AS BIGINT) AS model, CASE WHEN p IS NULL THEN 'UNSCORED' ELSE 'SCORED' END AS outcome, CAST(tried AS BIGINT) AS tried FROM b""")
def t11_ladder(spark, sf):
    i = F.col("o_orderkey")
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("request"), (i % 5).alias("round"), (i % 3).alias("key"), (i % 4).alias("model"), (F.col("o_orderstatus") == "F").alias("valid"))
    return N.ladder(a)


_EVENTS = "SELECT event_id AS seq, user_id AS k, epoch_us(ts) / 1e6 AS t, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events"


@query(f"""WITH RECURSIVE e AS MATERIALIZED (SELECT *, event_type = 'view' AS token FROM ({_EVENTS})),
s AS (SELECT seq, k, t, rn, 'go' AS state, CASE WHEN token THEN 0 ELSE 1 END AS used, CAST(0 AS DOUBLE) AS until FROM e WHERE rn = 1
 UNION ALL SELECT e.seq, e.k, e.t, e.rn, CASE WHEN e.t < s.until THEN 'paused' WHEN e.token OR s.used < 3 THEN 'go' ELSE 'spent' END,
  CASE WHEN e.t >= s.until AND NOT e.token AND s.used < 3 THEN s.used + 1 ELSE s.used END,
  CASE WHEN e.t >= s.until AND NOT e.token AND s.used >= 3 THEN e.t + 432000 ELSE s.until END
 FROM s JOIN e ON e.k = s.k AND e.rn = s.rn + 1)
SELECT seq, k AS pool, state FROM s""")
def t12_quota_backoff(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ST.backed_off(e.select(F.col("user_id").alias("pool"), F.col("event_id").alias("seq"), (F.unix_micros("ts") / 1e6).alias("t"), (F.col("event_type") == "view").alias("token")), 3, 432_000.0)


_HELD = "list_append(list_filter(s.blocks, lambda h: e.t - h <= 864000), e.t)"


@query(f"""WITH RECURSIVE e AS MATERIALIZED (SELECT *, event_type IN ('error', 'click') AS b, event_type = 'click' AS a FROM ({_EVENTS})),
z AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rn) AS bn FROM e WHERE b),
s AS (SELECT seq, k, t, bn, CASE WHEN a THEN 'escalated' ELSE 'failed' END AS outcome, CAST(0 AS DOUBLE) AS until, CASE WHEN a THEN CAST([] AS DOUBLE[]) ELSE [t] END AS blocks FROM z WHERE bn = 1
 UNION ALL SELECT e.seq, e.k, e.t, e.bn, CASE WHEN e.t < s.until THEN 'open' WHEN len({_HELD}) >= 2 THEN 'trip' WHEN e.a THEN 'escalated' ELSE 'failed' END,
  CASE WHEN e.t >= s.until AND len({_HELD}) >= 2 THEN e.t + 432000 ELSE s.until END,
  CASE WHEN e.t < s.until THEN s.blocks WHEN e.a OR len({_HELD}) >= 2 THEN CAST([] AS DOUBLE[]) ELSE {_HELD} END
 FROM s JOIN z e ON e.k = s.k AND e.bn = s.bn + 1)
SELECT seq, k AS host, outcome FROM s UNION ALL SELECT seq, k, 'ok' FROM e WHERE NOT b""")
def t4_escalation(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    requests = e.select(F.col("user_id").alias("host"), F.col("event_id").alias("seq"), (F.unix_micros("ts") / 1e6).alias("t"), F.col("event_type").isin("error", "click").alias("blocked"), (F.col("event_type") == "click").alias("answers"))
    return ST.escalated(requests, 2, 864_000.0, 432_000.0)


@query(f"""WITH RECURSIVE e AS MATERIALIZED (SELECT c_custkey AS seq, c_nationkey AS provider, {SQL_CRC} % 3 AS start, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer),
s AS (SELECT seq, provider, rn, start AS key, [start] AS used FROM e WHERE rn = 1
 UNION ALL SELECT e.seq, e.provider, e.rn, list_filter(list_transform(range(3), lambda i: (e.start + i) % 3), lambda k: NOT list_contains(s.used, k))[1],
  list_append(s.used, list_filter(list_transform(range(3), lambda i: (e.start + i) % 3), lambda k: NOT list_contains(s.used, k))[1])
 FROM s JOIN e ON e.provider = s.provider AND e.rn = s.rn + 1)
SELECT seq, CAST(provider AS VARCHAR) AS provider, key FROM s""")
def t2_key_walk(spark, sf):
    """One grant a key: the walk from a request's own start meets used keys until none is left."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("provider"), F.col("c_custkey").alias("seq"), F.lit(0.0).alias("t"), F.col("c_name").alias("name"))
    return ST.first_free_key(c, 3, 1, 1e9).select("seq", "provider", "key")


# --- curation -------------------------------------------------------------------------


@query("""WITH t AS (SELECT 0 AS tier, s_suppkey AS seq, lower('https://g/' || (s_suppkey % 30)) AS key, s_name AS name FROM supplier UNION ALL SELECT 1, c_custkey, lower('https://g/' || (c_custkey % 60)), c_name FROM customer)
SELECT key, tier, seq, name FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY tier, seq) AS rn FROM t) WHERE rn = 1 AND CAST(substr(key, 11) AS INT) % 7 > 0""")
def k15_j13_rejected_log(spark, sf):
    link = lambda c, n: F.concat(F.lit("https://G/"), F.col(c) % n)
    none = F.lit(None).cast("string")
    one = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("seq"), P.rejected_key(link("s_suppkey", 30), none, none).alias("key"), F.col("s_name").alias("name"))
    two = table(spark, sf, "customer").select(F.col("c_custkey").alias("seq"), P.rejected_key(F.lit(""), link("c_custkey", 60), F.lit("x")).alias("key"), F.col("c_name").alias("name"))
    curated = spark.range(9).select(F.concat(F.lit("https://g/"), F.col("id") * 7).alias("key"))
    return P.rejected_rows([one, two], curated).select("key", "tier", "seq", "name")


@query("""WITH c AS (SELECT 'gh:o/r' || (p_partkey // 4) AS key, p_partkey, p_size, p_name, row_number() OVER (PARTITION BY p_partkey // 4 ORDER BY p_size DESC, p_partkey) AS rn,
 CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS about FROM part)
SELECT key, max(p_name) FILTER (rn = 1) AS name, CAST(max(p_size) AS INT) AS stars, coalesce(max_by(about, -rn) FILTER (about <> ''), NULL) AS description, CASE WHEN count(DISTINCT p_partkey % 2) = 2 THEN 'even, odd' WHEN max(p_partkey % 2) = 1 THEN 'odd' ELSE 'even' END AS source FROM c GROUP BY key""")
def g5_merged_candidates(spark, sf):
    p, i = table(spark, sf, "part"), F.col("p_partkey")
    none = F.lit(None).cast("string")
    rows = p.select(
        F.col("p_name").alias("name"), F.lit("SERVER").alias("kind"), F.when(i % 2 == 0, "even").otherwise("odd").alias("source"), F.when(i % 3 == 0, "").otherwise(F.col("p_type")).alias("description"), none.alias("url"),
        F.concat(F.lit("O/r"), F.floor(i / 4)).alias("repo"), none.alias("docs_url"), F.col("p_size").alias("stars"), i.alias("seq"),
    )
    return engine.merged(rows).select("key", "name", "stars", "description", "source")

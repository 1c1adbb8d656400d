"""Readers over payloads and files made from the driver's tables.

Payloads are built row by row, so that the SQL twin can state what a reader must find.
Files are written to the shared folder first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import text as X
from ..operators import dedup as D
from ..operators import history as H
from ..operators import shaping as P
from ..sources import commits
from ..sources import readers as R
from ..sources import sinks as K
from ..sources import workbook as WB
from ..store import scratch
from .registry import dealt, query, table


def _text_files(lines: DataFrame) -> str:
    """Path of text files that hold the frame's only column."""
    path = scratch(lines.sparkSession)
    lines.write.text(path)
    return path


def _feed(rows: DataFrame, *items) -> str:
    """Path of one RSS file with an item a row, of (tag, column) pairs."""
    item = F.concat(F.lit("<item>"), *[x for tag, c in items for x in (F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))], F.lit("</item>"))
    return _text_files(rows.agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>"))))


@query("""SELECT n_name AS title, 'https://n.example/' || n_nationkey AS link FROM nation WHERE n_regionkey <> 1""")
def s4_s17_e14_feeds(spark, sf):
    n = table(spark, sf, "nation")
    link = F.concat(F.lit("https://n.example/"), "n_nationkey")
    feeds = {f"r{i}": _feed(n.where(F.col("n_regionkey") == i), ("title", F.col("n_name")), ("link", link)) for i in (0, 2, 3, 4)}
    feeds["gone"] = scratch(spark)  # nothing is there; the others go on
    return R.read_each(spark, feeds, R.read_feed).select("title", "link")


@query("""SELECT 'Paper of ' || s_name AS title, s_name || ' Jr., ' || s_name || ' Sr.' AS authors, 'https://p.example/' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN '.pdf' ELSE '' END AS paper_url,
 CASE WHEN s_suppkey % 3 = 0 THEN 'own/repo' || s_suppkey END AS repo FROM supplier""")
def s6_x45_atom_papers(spark, sf):
    i = F.col("s_suppkey")
    link = lambda end, kind: F.struct(F.concat(F.lit("https://p.example/"), i, F.lit(end)).alias("_href"), F.lit(kind).alias("_type"))
    person = lambda end: F.struct(F.concat("s_name", F.lit(end)).alias("name"))
    entries = table(spark, sf, "supplier").select(
        F.concat(F.lit(" Paper  of\n"), "s_name").alias("title"), F.lit("2024-01-02T00:00:00Z").alias("published"), F.array(person(" Jr."), person(" Sr.")).alias("author"),
        F.when(i % 3 == 0, F.concat(F.lit("Code: https://github.com/own/repo"), i, F.lit(".git)."))).otherwise("none").alias("summary"),
        F.when(i % 2 == 0, F.array(link("", "text/html"), link(".pdf", "application/pdf"))).otherwise(F.array(link("", "text/html"))).alias("link"),
    )
    return R.atom_papers(entries).select("title", F.array_join("authors", ", ").alias("authors"), "paper_url", "repo")


@query("""SELECT o_orderkey AS id FROM orders ORDER BY o_orderdate DESC, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') LIMIT 40 OFFSET 25""")
def s7_paper_page(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("published"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("paper_url"))
    return R.paper_page(o, 25, 40).select("id")


@query("""WITH f AS (SELECT n_regionkey AS o, n_nationkey, 'https://n.example/' || (n_nationkey % 7) AS link, CASE WHEN n_nationkey % 4 = 0 THEN 'old' ELSE 'new' END AS posted FROM nation)
SELECT link, CAST(o AS BIGINT) AS ordinal, CAST(n_nationkey AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY o, n_nationkey) AS rn FROM f WHERE posted = 'new') WHERE rn = 1""")
def s8_s21_w3_feeds_cross_dedup(spark, sf):
    """One scan a category; a link counts once over all of them, and only rows that pass the gate take it."""
    n = table(spark, sf, "nation")
    link = F.concat(F.lit("https://n.example/"), F.col("n_nationkey") % 7)
    read = lambda i: (lambda s: n.where(F.col("n_regionkey") == i).select(link.alias("link"), F.col("n_nationkey").alias("n"), F.when(F.col("n_nationkey") % 4 == 0, "old").otherwise("new").alias("posted")))
    rows, _ = R.read_sources(spark, [R.Source(f"cat{i}", read(i)) for i in range(5)], "link string, n long, posted string")
    return D.first_wins(rows.where("posted = 'new'"), F.col("link"), F.col("ordinal"), F.col("n")).select("link", F.col("ordinal").cast("long").alias("ordinal"), "n")


@query("""SELECT p_name AS title, 'https://arxiv.org/abs/' || p_partkey AS paper_url, CASE WHEN p_size < 10 THEN 'o/r' || p_size END AS repo FROM part WHERE p_size % 5 > 0 AND p_type <> 'PROMO'""")
def s9_daily_papers(spark, sf):
    p, size = table(spark, sf, "part"), F.col("p_size")
    paper = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.when(size % 5 > 0, F.col("p_name")).otherwise(" ").alias("title"), F.when(F.col("p_type") != "PROMO", F.lit("2024-01-02T03:04:05Z")).alias("publishedAt"),
        F.when(size < 10, F.concat(F.lit("https://github.com/o/r"), size)).alias("githubRepo"), F.array(F.struct(F.lit("A").alias("name"))).alias("authors"),
    )
    payload = p.select(F.to_json(F.array(F.struct(paper.alias("paper")))).alias("j"))
    return R.daily_papers(payload, "j").select("title", "paper_url", "repo")


@query("""SELECT s_name AS title, coalesce(CASE WHEN s_suppkey % 3 > 0 THEN 'https://l/' || s_suppkey END, 'https://doi/' || s_suppkey) AS paper_url, s_name || '|B' AS authors FROM supplier WHERE s_suppkey % 4 > 0""")
def s10_works(spark, sf):
    i = F.col("s_suppkey")
    author = lambda c: F.struct(F.struct(c.alias("display_name")).alias("author"))
    work = F.struct(
        F.when(i % 4 > 0, F.col("s_name")).alias("title"), F.concat(F.lit("https://doi/"), i).alias("doi"), F.lit("2024-01-02").alias("publication_date"),
        F.struct(F.when(i % 3 > 0, F.concat(F.lit("https://l/"), i)).alias("landing_page_url")).alias("primary_location"), F.array(author(F.col("s_name")), author(F.lit("B")), author(F.lit(None).cast("string"))).alias("authorships"),
    )
    payload = table(spark, sf, "supplier").select(F.to_json(F.struct(F.array(work).alias("results"))).alias("j"))
    return R.works(payload, "j").select("title", "paper_url", F.array_join("authors", "|").alias("authors"))


@query("""SELECT c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'https://w/' || c_custkey WHEN 1 THEN 'https://u/' || c_custkey ELSE 'https://base/s' || c_custkey END AS url, CASE WHEN c_nationkey > 0 THEN c_nationkey END AS employees FROM customer""")
def s11_paged_companies(spark, sf):
    i = F.col("c_custkey")
    one = F.struct(
        F.col("c_name").alias("name"), F.when(i % 3 == 0, F.concat(F.lit("https://w/"), i)).alias("website"), F.when(i % 3 == 1, F.concat(F.lit("https://u/"), i)).otherwise("").alias("url"),
        F.concat(F.lit("s"), i).alias("slug"), F.col("c_nationkey").alias("teamSize"),
    )
    pages = table(spark, sf, "customer").select((1 + F.floor((i - 1) / 100)).alias("page"), F.to_json(F.struct(F.array(one).alias("companies"))).alias("j"))
    return R.paged_companies(pages, "j", "https://base/")


@query("""SELECT DISTINCT lower(c_mktsegment) AS org FROM customer WHERE c_custkey % 2 = 0""")
def s12_model_orgs(spark, sf):
    i = F.col("c_custkey")
    return R.model_orgs(table(spark, sf, "customer").select(F.when(i % 2 == 0, F.concat_ws("/", F.lower("c_mktsegment"), "c_name")).otherwise(F.col("c_name")).alias("id")), "id")


@query("""SELECT CAST(n_regionkey AS VARCHAR) AS query, CAST(n_nationkey AS BIGINT) AS page, 'org' || n_nationkey AS name, '' AS url FROM nation n
WHERE n_nationkey < coalesce((SELECT min(m.n_nationkey) FROM nation m WHERE m.n_regionkey = n.n_regionkey AND m.n_nationkey % 6 = 5), 1000)""")
def s13_search_orgs(spark, sf):
    i = F.col("n_nationkey")
    items = F.when(i % 6 == 5, F.array().cast("array<struct<login:string>>")).otherwise(F.array(F.struct(F.concat(F.lit("org"), i).alias("login"))))
    pages = table(spark, sf, "nation").select(F.col("n_regionkey").cast("string").alias("query"), i.cast("long").alias("page"), F.to_json(F.struct(items.alias("items"))).alias("j"))
    return R.search_orgs(pages, "j")


_SEED_ROWS = ", ".join(f"('{n}', '{u}', {i})" for i, (n, u) in enumerate(R.SEEDS))


@query(f"SELECT * FROM (VALUES {_SEED_ROWS}) v(name, url, seq)")
def s14_seeds(spark, sf):
    return R.seed_companies(spark).select("name", "url", F.col("seq").cast("int").alias("seq"))


@query("""SELECT p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN 'https://site.example/' ELSE 'https://x.example/' END || p_partkey AS url,
 CASE WHEN p_partkey % 3 = 0 THEN repeat('ab', 100) ELSE 'a ' || p_type || ' thing' END AS description FROM part WHERE p_partkey % 7 <> 6""")
def s15_f7_markdown_sections(spark, sf):
    i = F.col("p_partkey")
    end = F.when(i % 7 == 6, ".png").otherwise("")  # pictures are no products
    site = F.when(i % 2 == 0, F.concat(F.lit("- [Website](https://site.example/"), i, end, F.lit(")\n"))).otherwise("")
    about = F.when(i % 3 == 0, F.lit("### Description\n" + "ab" * 150 + "\n### More\nx")).otherwise("")
    md = F.concat(F.lit("# list\n\n## ["), "p_name", F.lit("](https://x.example/"), i, end, F.lit(")\na "), "p_type", F.lit(" thing\n"), site, about)
    return R.markdown_sections(table(spark, sf, "part").select(md.alias("md")), "md")


@query("""SELECT n_name AS company, 'Engineer ' || n_nationkey AS title FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'legal', 'kept: not the first' FROM nation WHERE n_nationkey % 2 = 1""")
def s18_notice(spark, sf):
    i = F.col("n_nationkey")
    job = F.to_json(F.struct(F.col("n_name").alias("company"), F.concat(F.lit("Engineer "), i).alias("title")))
    later = F.lit('{"company": "legal", "title": "kept: not the first"}')
    text = F.when(i % 2 == 0, F.concat(F.lit('["legal notice", '), job, F.lit("]"))).otherwise(F.concat(F.lit('["legal terms", '), later, F.lit("]")))
    items = R.jobs_after_notice(table(spark, sf, "nation").select(text.alias("j")), "j")
    return items.select(F.get_json_object("item", "$.company").alias("company"), F.get_json_object("item", "$.title").alias("title"))


@query("""SELECT c_name AS title, c_mktsegment AS company_name, 'https://a/' || c_custkey AS url FROM customer""")
def p9_e2_mapped_boards(spark, sf):
    """Two boards of different shape, each brought to the common columns by its own mapper."""
    c, i = table(spark, sf, "customer"), F.col("c_custkey")
    url = F.concat(F.lit("https://a/"), i)
    row = F.struct(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("companyName"), F.when(i % 4 == 0, url).alias("applicationLink"), url.alias("guid"), F.lit(0).alias("pubDate"))
    one = R.jobs_of_list(c.where(i % 2 == 0).select(F.to_json(F.struct(F.array(row).alias("jobs"))).alias("j")), "j")
    row = F.struct(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("company_name"), url.alias("url"), F.lit(0).alias("created_at"))
    two = R.jobs_of_data(c.where(i % 2 == 1).select(F.to_json(F.struct(F.array(row).alias("data"))).alias("j")), "j", "nowhere")
    names = {x: F.col(x) for x in ("title", "company_name", "url")}
    return P.projected({"list": (one, names), "data": (two, names)}).select(*names)


@query("""SELECT n_name AS company, 'Role ' || n_nationkey AS title, n_nationkey % 3 > 0 AS remote FROM nation""")
def s23_feed_jobs(spark, sf):
    i = F.col("n_nationkey")
    path = _feed(table(spark, sf, "nation"), ("title", F.concat("n_name", F.lit(": Role "), i)), ("link", F.lit("l")), ("description", F.when(i % 3 > 0, "Remote").otherwise("Berlin")))
    rows = R.read_feed(spark, path).withColumn("h", C.company_title(F.col("title"), F.lit(None).cast("string"), True))
    return rows.select("h.company", "h.title", C.is_remote(F.col("description"), F.lit(None).cast("array<string>"), F.col("h.title")).alias("remote"))


@query("""SELECT CASE WHEN c_custkey % 3 = 2 THEN 'author ' || c_custkey ELSE c_name END AS company,
 CASE c_custkey % 3 WHEN 0 THEN 'Machine Learning Engineer' WHEN 1 THEN c_name || ' is the home of machine learning' ELSE 'We do machine learning' END AS title,
 CASE WHEN c_custkey % 3 = 0 THEN 'Remote' ELSE '' END AS location, 'https://apply.example/' || c_custkey AS url FROM customer WHERE c_custkey % 5 > 0 AND c_custkey % 7 > 0""")
def s22_hiring_posts(spark, sf):
    """Posts off topic (a fifth) and of last week (a seventh) are left out."""
    c, i = table(spark, sf, "customer"), F.col("c_custkey")
    line = F.when(i % 3 == 0, F.concat("c_name", F.lit(" | Machine Learning Engineer | Remote"))).when(i % 3 == 1, F.concat("c_name", F.lit(" is the home of machine learning"))).otherwise("We do machine learning")
    text = F.concat(F.lit("<p>"), F.when(i % 5 > 0, line).otherwise("Acme | Gardener | Here"), F.lit('\n</p>See https://news.ycombinator.com/x and <a href="https://apply.example/'), i, F.lit('">form</a>'))
    posts = c.select(text.alias("description"), F.concat(F.lit("author "), i).alias("author"), F.when(i % 7 > 0, "2 hours ago").otherwise("1 week ago").alias("published"), F.lit("https://news.ycombinator.com/own").alias("link"))
    return R.hiring_posts(posts, F.lit("2026-01-02 03:04:05").cast("timestamp"), "forum").select("company", "title", "location", "url")


@query("""WITH a AS (SELECT lower(c_mktsegment) AS key, c_custkey AS id, c_custkey % 3 AS append FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT o_orderpriority, o_orderkey, o_orderkey % 2 + 1 FROM orders)
 SELECT key, arg_min(id, (append, id)) AS id FROM a GROUP BY key""")
def s24_k7_k8_t6_wal(spark, sf):
    """Two appends to one log replayed (the first of a key wins), compacted to what was recovered, replayed again."""
    c, o, path = table(spark, sf, "customer"), table(spark, sf, "orders"), scratch(spark)
    rows = c.where("c_custkey % 3 > 0").select(F.lower("c_mktsegment").alias("key"), F.col("c_custkey").alias("id"), (F.col("c_custkey") % 3).alias("append"))
    rows = rows.unionAll(o.select("o_orderpriority", "o_orderkey", F.col("o_orderkey") % 2 + 1))
    for append in (1, 2):
        K.append_wal(rows.where(F.col("append") == append).drop("append"), "key", path, F.col("id"))
    log = commits.snapshot(spark, path)
    K.compact_wal(R.replay_wal(spark, path, "key STRING, id BIGINT", at=log), path, log.version)
    return R.replay_wal(spark, path, "key STRING, id BIGINT").select("data.key", "data.id")


@query("""SELECT canonical, domain FROM (SELECT n_name AS canonical, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) || '.org' END AS domain FROM nation UNION ALL VALUES ('Seed', NULL))""")
def s25_k11_registry(spark, sf):
    n, root = table(spark, sf, "nation"), scratch(spark)
    domains = n.where("n_nationkey % 2 = 0").select(F.concat(F.lower("n_name"), F.lit(".org")).alias("domain"), F.col("n_name").alias("canonical"))
    K.save_registry(n.select(F.col("n_name").alias("canonical")).union(n.select("n_name")), domains, root)
    known, grounded = K.load_registry(spark, root, spark.createDataFrame([("Seed",)], "canonical string"))
    return known.join(grounded, "canonical", "left").select("canonical", "domain")


@query("""SELECT o_orderpriority AS crawler, o_orderkey % 1000 AS key, CAST(1 AS BIGINT) AS round FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
 UNION SELECT o_orderpriority, o_orderkey % 100, 2 FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT 'absent', 0, 0""")
def s26_k9_k10_state(spark, sf):
    """State of one crawler replaced, those of others kept, one forgotten; an absent table is empty."""
    path, ddl = scratch(spark), "crawler string, key bigint, round bigint"
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("crawler"), "o_orderkey")
    seen = lambda n, i: rows.select("crawler", (F.col("o_orderkey") % n).alias("key"), F.lit(i).cast("long").alias("round")).distinct()
    K.write_state(seen(1000, 1), path)
    K.write_state(seen(100, 2).where("crawler = '1-URGENT'"), path)
    K.reset_state(spark, path, "5-LOW")
    absent = K.read_state(spark, scratch(spark), ddl).agg(F.lit("absent").alias("crawler"), F.count("*").alias("key"), F.count("*").alias("round"))
    return K.read_state(spark, path, ddl).unionByName(absent)


@query("""SELECT p_name AS name, CAST(p_size AS DOUBLE) AS usefulness_score FROM part WHERE p_size <= 30 AND p_type <> 'PROMO'""")
def s27_f15_candidate_lines(spark, sf):
    """Lines outside the constraints, corrupt ones among them, are skipped."""
    p, path = table(spark, sf, "part"), scratch(spark)
    row = F.to_json(F.struct(F.col("p_name").alias("name"), F.lit("SERVER").alias("mcp_type"), F.col("p_size").cast("double").alias("usefulness_score")))
    p.select(F.when(F.col("p_type") == "PROMO", F.concat(F.lit("{broken "), row)).otherwise(row).alias("value")).write.text(path)
    ddl = "name STRING, mcp_type STRING, usefulness_score DOUBLE"
    return R.read_jsonl(spark, path, ddl, P.entry_constraints(["name", "mcp_type", "usefulness_score"])).select("name", "usefulness_score")


@query("""SELECT 'server ' || s_suppkey AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'http' ELSE 'stdio' END AS transport, CASE WHEN s_suppkey % 3 = 0 THEN 'own/repo' || s_suppkey END AS github_owner_repo FROM supplier WHERE s_suppkey <= 7""")
def s28_registry_walk(spark, sf):
    """A walk along cursors 1, 2, .. up to the page without one; later pages are not reached."""
    i = F.col("s_suppkey")
    server = F.struct(
        F.concat(F.lit("server "), i).alias("name"), F.lit("d").alias("description"), F.struct(F.when(i % 3 == 0, F.concat(F.lit("https://github.com/Own/Repo"), i, F.lit(".git"))).alias("url")).alias("repository"),
        F.when(i % 2 == 0, F.array(F.struct(F.lit("u").alias("url")))).alias("remotes"),
    )
    body = F.to_json(F.struct(F.array(F.struct(server.alias("server"))).alias("servers"), F.struct(F.when(i != 7, i.cast("string")).alias("nextCursor")).alias("metadata")))
    pages = table(spark, sf, "supplier").select(F.when(i > 1, (i - 1).cast("string")).alias("cursor"), body.alias("j"))
    return R.registry_servers(R.registry_pages(pages, "j"), "j").select("name", "transport", "github_owner_repo")


@query("""SELECT p_name AS name, CASE WHEN p_size % 3 = 0 THEN 'CLIENT' ELSE 'SERVER' END AS mcp_type, CASE WHEN p_size % 2 = 0 THEN 'https://home/' ELSE 'https://github.com/O/' END || p_partkey AS official_url,
 'o/' || p_partkey AS github_owner_repo, coalesce(CASE WHEN p_size > 5 THEN p_size END, 0) AS github_stars, CASE WHEN p_size > 40 THEN 'MIT' END AS license FROM part""")
def s29_topic_repos(spark, sf):
    p, i, size = table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    repo = F.struct(
        F.col("p_name").alias("name"), F.concat(F.lit("O/"), i).alias("full_name"), F.when(size > 5, size).alias("stargazers_count"), F.when(size % 3 == 0, "An MCP Client").otherwise("x").alias("description"),
        F.concat(F.lit("https://github.com/O/"), i).alias("html_url"), F.when(size % 2 == 0, F.concat(F.lit("https://home/"), i)).otherwise("").alias("homepage"), F.struct(F.when(size > 40, "MIT").alias("spdx_id")).alias("license"),
    )
    pages = p.select(F.to_json(F.struct(F.array(repo).alias("items"))).alias("j"))
    return R.topic_repos(pages, "j").select("name", "mcp_type", "official_url", "github_owner_repo", "github_stars", "license")


@query("""SELECT s_name AS name, 'https://dir.example/mcp/servers/Own/Repo' || s_suppkey AS listing_url, 'own/repo' || s_suppkey AS github_owner_repo FROM supplier""")
def s30_directory_entries(spark, sf):
    i = F.col("s_suppkey")
    link = lambda text: F.concat(F.lit('<a class="x" href="/mcp/servers/Own/Repo'), i, F.lit('"> <b>'), text, F.lit("</b></a>"))
    html = F.concat(F.lit('<a href="/about">About</a><a href="/mcp/servers/short">s</a>'), link(F.col("s_name")), link(F.lit("again")))
    return R.directory_entries(table(spark, sf, "supplier").select(html.alias("html")), "html", "Glama.ai", "https://dir.example", ["/mcp/servers/"]).select("name", "listing_url", "github_owner_repo")


@query("""SELECT p_partkey, p_name AS name, CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'lead of ' || p_name END AS description, 'cat ' || p_size AS category, CASE p_size % 3 WHEN 0 THEN 'Paid' WHEN 1 THEN 'Freemium' ELSE 'Free' END AS pricing,
 p_size AS stars, 'Own' || p_size || '/repo' AS repo, 'https://site.example/' || p_partkey AS official_url FROM part""")
def s31_x46_detail_page(spark, sf):
    p, i, size = table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    price = F.when(size % 3 == 0, "paid").when(size % 3 == 1, "Freemium").otherwise("")
    html = F.concat(
        F.when(size % 2 == 0, F.concat(F.lit("<h1 class='t'>"), "p_name", F.lit('</h1><meta name="description" content="'), "p_type", F.lit('">'))).otherwise(F.concat(F.lit("<title>"), "p_name", F.lit(" | Dir</title>"))),
        F.lit("<p>lead of "), F.col("p_name"), F.lit('</p><a href="/mcp/categories/c.1">cat '), size, F.lit("</a><span> "), price, F.lit(" </span><i>"), size, F.lit(" Stars</i>"),
        F.lit('<a href="https://github.com/x/.github">a</a><a href="https://github.com/same/same">b</a><a href="https://github.com/Own'), size, F.lit('/repo.git">c</a>'),
        F.lit('<a href="https://dir.example/z">d</a><a href="https://x.com/y">e</a><a href="https://site.example/'), i, F.lit('">f</a>'),
    )
    fields = R.detail_page(html, "dir.example")
    return dealt(p, "p_partkey").select("p_partkey", *[c.alias(n) for n, c in fields.items()])


@query("""SELECT CAST(nullif(c_custkey, 0) AS VARCHAR) AS id, c_name || ', "q"' || chr(10) || 'x' AS text, CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS n FROM customer""")
def s32_k1_p6_csv(spark, sf):
    """Quotes, commas and line ends come back from CSV; with the ranked tables' rule a zero is an empty cell."""
    path = scratch(spark)
    K.write_csv(table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(', "q"\nx')).alias("text"), F.col("c_nationkey").alias("n")), path, blank_falsy=True)
    return R.read_csv(spark, path)


@query("""SELECT 'Nations' AS sheet, CAST(n_nationkey AS VARCHAR) AS id, n_name || ' <&> é' AS name FROM nation UNION ALL SELECT 'Regions', CAST(r_regionkey AS VARCHAR), r_name FROM region WHERE r_regionkey > 0""")
def s33_k4_workbook(spark, sf):
    """Two tabs written, one replaced, an emptied one left with its header, a third kept; then read back."""
    path = f"{scratch(spark)}.xlsx"
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.concat("n_name", F.lit(" <&> é")).alias("name"))
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    WB.write_workbook({"Nations": n, "Regions": r.where("id > 0"), "Stale": r}, path)
    WB.write_workbook({"Nations": n, "Stale": r.limit(0)}, path)
    book = WB.read_workbook(spark, path)
    return book.select("sheet", F.try_element_at("cells", F.lit("id")).alias("id"), F.try_element_at("cells", F.lit("name")).alias("name"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'own ' || n_name ELSE 'default' END AS name FROM nation""")
def s34_e4_source_list(spark, sf):
    from ..functions.choice import source_list

    i = F.col("n_nationkey")
    own = F.to_json(F.array(F.struct(F.concat(F.lit("own "), "n_name").alias("name"), F.lit("https://u").alias("url"))))
    setting = F.when(i % 3 == 0, own).when(i % 3 == 1, F.lit('[{"name": "no url"}]')).otherwise("not json")
    default = F.array(F.struct(F.lit("default").alias("name"), F.lit("https://d").alias("url")))
    return table(spark, sf, "nation").select("n_nationkey", F.get(source_list(setting, default), F.lit(0))["name"].alias("name"))


@query("""SELECT 'startups' AS name, count(*) AS n FROM supplier UNION ALL SELECT 'logs', count(*) FROM nation UNION ALL SELECT 'entity_mapping_log', count(*) FROM nation""")
def k2_tables(spark, sf):
    """Only tables with rows are written, the log under two names."""
    root = scratch(spark)
    tables = {"startups": table(spark, sf, "supplier"), "jobs": table(spark, sf, "part").limit(0), "logs": table(spark, sf, "nation")}
    done = K.write_tables(tables, root)
    counts = [R.read_csv(spark, f"{root}/{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in done]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("""SELECT doc_id, substr(text, 1, 200) AS text, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 50 AS BIGINT) AS batch FROM documents""")
def k6_k16_x44_sheet_batches(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return K.sheet_batches(d, "doc_id", size=50, chars=200)


@query("""SELECT source, count(*) AS total, CAST(count(*) FILTER (length(text) >= 200) AS BIGINT) AS full_text, CAST(count(*) FILTER (lang = 'en') AS BIGINT) AS english FROM documents GROUP BY source""")
def k13_g4_telemetry(spark, sf):
    path = scratch(spark)
    K.write_telemetry(table(spark, sf, "documents"), path, "source", {"full_text": F.length("text") >= 200, "english": F.col("lang") == "en"})
    return spark.read.schema("source string, total long, full_text long, english long").json(path)


@query("""WITH a AS (SELECT c_nationkey AS k, min(c_custkey) AS id FROM customer WHERE c_custkey % 2 = 0 AND c_nationkey < 12 GROUP BY 1)
SELECT k, id FROM a UNION ALL SELECT c_nationkey, min(c_custkey) FROM customer WHERE c_nationkey NOT IN (SELECT k FROM a) GROUP BY 1""")
def k14_j8_append_new(spark, sf):
    """A log of JSON lines that takes each key once over two batches."""
    path, ddl = scratch(spark), "k long, id long"
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("k"), F.col("c_custkey").alias("id"))
    one = lambda d: d.groupBy("k").agg(F.min("id").alias("id"))
    K.append_new(one(c.where("k < 12 and id % 2 = 0")), path, "k", ddl)
    K.append_new(one(c), path, "k", ddl)
    return spark.read.schema(ddl).json(path)


@query("""SELECT c_mktsegment AS source, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1 UNION ALL SELECT 'SILENT', 0""")
def j15_sources_with_results(spark, sf):
    """Sources beside their results, those without any kept with 0."""
    c = table(spark, sf, "customer")
    sources = c.select(F.col("c_mktsegment").alias("source")).union(spark.createDataFrame([("SILENT",)], "source string")).distinct()
    return H.counts_with_zero(c.where("c_acctbal > 0").select(F.col("c_mktsegment").alias("source")), sources, "source")


@query("""SELECT o_orderkey, 'o/r' || o_orderkey AS repo FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'F'""")
def j10_to_enrich(spark, sf):
    i = F.col("o_orderkey")
    url = F.when(i % 3 == 0, F.concat(F.lit("https://github.com/o/r"), i, F.lit("/"))).when(i % 3 == 1, F.concat(F.lit("https://github.com/only"), i)).otherwise("https://other.org/a/b")
    papers = table(spark, sf, "orders").select("o_orderkey", url.alias("github_url"), F.when(F.col("o_orderstatus") == "F", 1).alias("github_stars"))
    return R.to_enrich(papers).select("o_orderkey", "repo")


@query("""SELECT doc_id, length(text) AS chars, CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 END AS third FROM documents WHERE text IS NOT NULL""")
def e3_injected_extraction(spark, sf):
    """An injected function over batches of texts; a text that it gives no answer for gets null."""
    d = table(spark, sf, "documents").where("text is not null").withColumn("t", F.concat_ws("|", "doc_id", "text"))

    def answers(texts: list[str]) -> list[dict | None]:
        ids = [int(t.split("|", 1)[0]) for t in texts]
        return [{"chars": len(t.split("|", 1)[1]), "third": i % 3} if i % 3 else None for i, t in zip(ids, texts, strict=True)]

    out = R.extracted(d, "t", "chars long, third long", answers)
    return out.select("doc_id", F.coalesce("answer.chars", F.length(X.blank(F.col("text"))).cast("long")).alias("chars"), F.col("answer.third").alias("third"))

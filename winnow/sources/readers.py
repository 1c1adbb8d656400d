"""Readers of landed data: feeds, job boards, directories, JSON lines and CSV.

Network access is no part of the engine; every reader starts from files or from
columns that hold a payload. Malformed rows never fail a scan.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import candidate_kind, first_line_parts, is_remote, on_topic, role
from ..functions.temporal import is_fresh, once, parse_date
from ..functions.text import blank, html_text, repo_path, stripped
from ..functions.urls import product_url_excluded
from ..operators.dedup import quota
from ..store import stored
from . import commits

FEED_ITEM = "title STRING, link STRING, pubDate STRING, description STRING"
JOBS_DATA = "data ARRAY<STRUCT<slug STRING, company_name STRING, title STRING, remote BOOLEAN, url STRING, tags ARRAY<STRING>, location STRING, created_at BIGINT>>"
JOBS_LIST = "jobs ARRAY<STRUCT<title STRING, companyName STRING, locationRestrictions ARRAY<STRING>, description STRING, pubDate BIGINT, applicationLink STRING, guid STRING>>"
WORKS = "results ARRAY<STRUCT<title STRING, doi STRING, publication_date STRING, primary_location STRUCT<landing_page_url STRING>, authorships ARRAY<STRUCT<author STRUCT<display_name STRING>>>>>"
ATOM_ENTRY = "title STRING, published STRING, summary STRING, author ARRAY<STRUCT<name STRING>>, link ARRAY<STRUCT<_href STRING, _type STRING>>"


def read_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """RSS files: one row for each item."""
    return spark.read.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE").schema(FEED_ITEM).load(path if isinstance(path, str) else ",".join(path))


def atom_papers(entries: DataFrame, joined_authors: bool = False) -> DataFrame:
    """Papers of Atom ``entries``: title on one line, authors, PDF link first, repository named in the abstract.

    ``joined_authors`` makes one string of several names, as a feed parser that flattens
    them does; the default keeps them apart.
    """
    pdf = F.get(F.filter("link", lambda x: x["_type"] == "application/pdf"), F.lit(0))["_href"]
    names = F.filter(F.transform(F.coalesce("author", F.array()), lambda a: F.trim(a["name"])), lambda n: blank(n) != "")
    if joined_authors:
        names = F.when(F.size(names) > 0, F.array(F.array_join(names, " "))).otherwise(names)
    return entries.select(
        F.regexp_replace(F.trim("title"), r"\s+", " ").alias("title"),
        F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("AI Researcher"))).alias("authors"),
        F.coalesce(pdf, F.get("link", F.lit(0))["_href"]).alias("paper_url"), F.to_timestamp("published").alias("published"), "summary", repo_path(F.col("summary")).alias("repo"),
    )


def read_atom(spark: SparkSession, path: str, joined_authors: bool = False) -> DataFrame:
    """Atom files as papers (:func:`atom_papers`)."""
    return atom_papers(spark.read.format("xml").option("rowTag", "entry").schema(ATOM_ENTRY).load(path), joined_authors)


def paper_page(papers: DataFrame, start: int, limit: int) -> DataFrame:
    """One page of papers, the newest first; ties by link."""
    return papers.orderBy(F.desc("published"), "paper_url").offset(start).limit(limit)


def daily_papers(payload: DataFrame, column: str) -> DataFrame:
    """Papers of a daily list; one without title, id or date is dropped."""
    schema = "ARRAY<STRUCT<paper: STRUCT<id: STRING, title: STRING, publishedAt: STRING, githubRepo: STRING, authors: ARRAY<STRUCT<name: STRING>>>>>"
    p = payload.select(F.explode(F.from_json(column, schema)).alias("x")).select("x.paper.*")
    names = F.filter(F.transform(F.coalesce("authors", F.array()), lambda a: a["name"]), lambda n: blank(n) != "")
    out = p.select(F.trim("title").alias("title"), names.alias("authors"), F.concat(F.lit("https://arxiv.org/abs/"), "id").alias("paper_url"), F.try_to_timestamp("publishedAt").alias("published"), repo_path(F.col("githubRepo")).alias("repo"), "id")
    return out.where((blank(F.col("title")) != "") & (blank(F.col("id")) != "") & F.col("published").isNotNull()).drop("id")


def to_enrich(papers: DataFrame) -> DataFrame:
    """Recovered papers that name a repository and have no stars yet, with its path."""
    path = F.rtrim(F.regexp_extract(blank(F.col("github_url")), r"^https://github\.com/(.*)$", 1))
    path = F.regexp_replace(path, "/+$", "")
    return papers.where(F.col("github_stars").isNull()).withColumn("repo", path).where(F.col("repo").contains("/"))


def until_empty(pages: DataFrame, query: str, page: str, size: Column) -> DataFrame:
    """Pages of each query before its first empty one, as a scan that stops there reads them."""
    ends = pages.groupBy(F.col(query).alias("_q")).agg(F.min(F.when(F.coalesce(size, F.lit(0)) == 0, F.col(page))).alias("_end"))
    return pages.join(ends, F.col(query) == F.col("_q")).where(F.col("_end").isNull() | (F.col(page) < F.col("_end"))).drop("_q", "_end")


def search_orgs(pages: DataFrame, column: str) -> DataFrame:
    """Organizations of ``pages(query, page, ..)`` of a search, each query up to its first empty page."""
    items = F.from_json(column, "items ARRAY<STRUCT<login STRING, html_url STRING>>").items
    kept = until_empty(pages.withColumn("_items", items), "query", "page", F.size("_items"))
    return kept.select("query", "page", F.explode("_items").alias("x")).select("query", "page", F.col("x.login").alias("name"), blank(F.col("x.html_url")).alias("url"))


REPO_ITEM = "name: STRING, full_name: STRING, stargazers_count: INT, pushed_at: STRING, archived: BOOLEAN, description: STRING, html_url: STRING, homepage: STRING, license: STRUCT<spdx_id: STRING, name: STRING>"


def topic_repos(pages: DataFrame, column: str) -> DataFrame:
    """Candidates of a repository search by topic."""
    r = pages.select(F.explode(F.from_json(column, f"STRUCT<items: ARRAY<STRUCT<{REPO_ITEM}>>>").items).alias("r")).select("r.*")
    filled = lambda c: F.nullif(blank(F.col(c)), F.lit(""))
    return r.select(
        F.coalesce(filled("name"), F.lit("Unnamed")).alias("name"), candidate_kind(F.col("name"), F.col("description")).alias("mcp_type"), F.col("html_url").alias("listing_url"),
        F.coalesce(filled("homepage"), F.col("html_url")).alias("official_url"), F.col("html_url").alias("github_url"), F.lower(blank(F.col("full_name"))).alias("github_owner_repo"),
        F.coalesce("stargazers_count", F.lit(0)).alias("github_stars"), F.col("pushed_at").alias("github_pushed_at"), F.coalesce("archived", F.lit(False)).alias("github_archived"),
        F.coalesce("license.spdx_id", "license.name").alias("license"), blank(F.col("description")).alias("description"), F.lit("GitHub Topic Search").alias("discovery_source"),
    )


class Source:
    """Where rows come from: ``read(spark)`` gives a frame, ``columns`` its expressions for the common columns."""

    def __init__(self, name: str, read: Callable[[SparkSession], DataFrame], columns: dict[str, Column] | None = None):
        self.name, self.read, self.columns = name, read, columns


def read_sources(spark: SparkSession, sources: list[Source], schema: str) -> tuple[DataFrame, dict[str, str]]:
    """(rows with source and ordinal, failures by name) of the sources, each read on its own; a ``source`` column of their own is kept.

    Every source is written to the shared folder before the next, so one that fails, even in
    the midst of its rows, costs the others nothing. Interrupts are passed on.
    """
    empty = spark.createDataFrame([], schema)
    parts, failed = [], {}
    for i, source in enumerate(sources):
        try:
            d = source.read(spark)
            if source.columns:
                d = d.select(*[c.alias(n) for n, c in source.columns.items()])
            typed = d.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in empty.schema])
            named = stored(typed) if "source" in empty.columns else stored(typed).withColumn("source", F.lit(source.name))
            parts.append(named.withColumn("ordinal", F.lit(i)))
        except (PySparkException, Py4JError, OSError, ValueError) as e:
            failed[source.name] = f"{type(e).__name__}: {e}".split("\n")[0]
    start = (empty if "source" in empty.columns else empty.withColumn("source", F.lit(""))).withColumn("ordinal", F.lit(0))
    return reduce(DataFrame.unionByName, parts, start), failed


def read_each(spark: SparkSession, paths: dict[str, str], read, schema: str = FEED_ITEM) -> DataFrame:
    """Union of the sources at ``paths`` with their name and ordinal; a source that cannot be read is left out."""
    return read_sources(spark, [Source(n, lambda s, p=p: read(s, p)) for n, p in paths.items()], schema)[0]


def jobs_of_data(payload: DataFrame, column: str, skip_host: str) -> DataFrame:
    """Postings of a ``data[]`` payload without those of one host."""
    rows = payload.select(F.explode(F.from_json(column, JOBS_DATA).data).alias("j")).select("j.*")
    return rows.where(~blank(F.col("url")).contains(skip_host)).withColumn("posted", F.timestamp_seconds("created_at"))


def jobs_of_list(payload: DataFrame, column: str) -> DataFrame:
    rows = payload.select(F.explode(F.from_json(column, JOBS_LIST).jobs).alias("j")).select("j.*")
    return rows.select("title", F.col("companyName").alias("company_name"), F.coalesce("applicationLink", "guid").alias("url"), F.timestamp_seconds("pubDate").alias("posted"))


def jobs_after_notice(payload: DataFrame, column: str) -> DataFrame:
    """Elements of a JSON array whose first element is a legal notice, if it is."""
    items = payload.select(F.posexplode(F.from_json(column, "ARRAY<STRING>")).alias("pos", "item"))
    return items.where(~((F.col("pos") == 0) & F.col("item").contains("legal"))).select("item")


def works(payload: DataFrame, column: str) -> DataFrame:
    """Scholarly works: landing page else DOI, author names; rows without a title or link are dropped."""
    rows = payload.select(F.explode(F.from_json(column, WORKS).results).alias("w")).select("w.*")
    url = F.coalesce("primary_location.landing_page_url", "doi")
    out = rows.select("title", url.alias("paper_url"), F.to_date("publication_date").alias("published"), F.filter(F.transform("authorships", lambda a: a.author.display_name), lambda n: n.isNotNull()).alias("authors"))
    return out.where("title is not null and paper_url is not null")


COMPANY = "companies ARRAY<STRUCT<name STRING, website STRING, url STRING, slug STRING, teamSize INT>>"


def companies(payload: DataFrame, column: str, base: str) -> DataFrame:
    """Companies of a list with their site, else their page; a team size below 1 is unknown."""
    rows = payload.select(F.explode(F.from_json(column, COMPANY).companies).alias("c")).select("c.*")
    filled = lambda c: F.nullif(blank(F.col(c)), F.lit(""))
    return rows.select("name", F.coalesce(filled("website"), filled("url"), F.concat(F.lit(base), blank(F.col("slug")))).alias("url"), F.when(F.col("teamSize") >= 1, F.col("teamSize")).alias("employees"))


def paged_companies(pages: DataFrame, column: str, base: str) -> DataFrame:
    """Companies of ``pages(page, ..)``; if page 1 holds none the other pages are not read."""
    size = F.size(F.from_json(column, COMPANY).companies)
    first = pages.where(F.col("page") == 1).agg(F.coalesce(F.max(size), F.lit(0)) > 0).scalar()
    return companies(pages.where(first), column, base)


def model_orgs(rows: DataFrame, column: str) -> DataFrame:
    """Owners of ``owner/model`` ids."""
    return rows.where(F.col(column).contains("/")).select(F.substring_index(column, "/", 1).alias("org")).distinct()


SERVER = "name STRING, title STRING, description STRING, websiteUrl STRING, repository STRUCT<url STRING>, remotes ARRAY<STRUCT<url STRING>>"


def registry_pages(pages: DataFrame, column: str, most: int = 15) -> DataFrame:
    """Payloads of ``pages(cursor, ..)`` that a walk along their cursors reads: from the page without a cursor, ``most`` at most, until no cursor or no server follows."""
    p = pages.withColumn("_next", F.get_json_object(column, "$.metadata.nextCursor")).withColumn("_n", F.coalesce(F.size(F.from_json(column, f"servers ARRAY<STRUCT<server STRUCT<{SERVER}>>>").servers), F.lit(0)))
    p = stored(p)
    walk = p.where("cursor is null").withColumn("step", F.lit(0))
    out = walk
    for step in range(1, most):  # a walk is a chain by nature; each step is one look-up
        walk = stored(p.join(walk.where("_n > 0 and _next is not null").select(F.col("_next").alias("_c")), F.col("cursor") == F.col("_c")).drop("_c").withColumn("step", F.lit(step)))
        if walk.isEmpty():
            break
        out = out.unionByName(walk)
    return out.drop("_next", "_n")


def registry_servers(payload: DataFrame, column: str) -> DataFrame:
    """Candidates of registry pages; transport is http where remotes are given."""
    s = payload.select(F.explode(F.from_json(column, f"servers ARRAY<STRUCT<server STRUCT<{SERVER}>>>").servers).alias("s")).select("s.server.*")
    filled = lambda c: F.nullif(blank(F.col(c)), F.lit(""))
    repo = F.when(F.col("repository.url").contains("github.com"), F.col("repository.url"))
    return s.select(
        F.coalesce(filled("title"), filled("name"), F.lit("Unnamed")).alias("name"), F.lit("SERVER").alias("mcp_type"),
        F.coalesce(filled("websiteUrl"), filled("repository.url"), F.concat(F.lit("https://registry.modelcontextprotocol.io/server/"), blank(F.col("name")))).alias("listing_url"),
        F.col("websiteUrl").alias("official_url"), repo.alias("github_url"), F.nullif(F.lower(F.regexp_extract(blank(repo), r"github\.com/([^/]+/[^/]+?)(?:\.git|/)?$", 1)), F.lit("")).alias("github_owner_repo"),
        blank(F.col("description")).alias("description"), F.when(F.size(F.coalesce("remotes", F.array())) > 0, "http").otherwise("stdio").alias("transport"), F.lit("Official Registry").alias("discovery_source"),
    )


def markdown_bullets(docs: DataFrame, text: str) -> DataFrame:
    """(name, url, description) of ``- [name](url) - description`` lines."""
    # a fixed value: the form of a line
    p = r"(?m)^[*-]\s+\[([^\]]+)\]\((https?://[^)#]+)\)[ \t]*(?:-[ \t]*(.*))?"
    part = lambda i: F.regexp_extract_all(text, F.lit(p), F.lit(i))
    rows = docs.select(F.explode(F.arrays_zip(part(1).alias("name"), part(2).alias("url"), part(3).alias("description"))).alias("x")).select("x.*")
    return rows.select(F.trim("name").alias("name"), F.trim("url").alias("url"), F.trim("description").alias("description")).where(~product_url_excluded(F.col("url")))


def markdown_sections(docs: DataFrame, text: str) -> DataFrame:
    """(name, url, description) of ``## [name](url)`` sections; a website link in the section wins, descriptions have at most 200 characters."""
    s = docs.select(F.explode(F.slice(F.split(text, r"\n##\s+\["), 2, 1 << 30)).alias("s"))
    # fixed values: the forms of a section's head, website line and description
    head = r"(?s)^([^\]]+)\]\((https?://[^)#]+)\)(.*)$"
    rest = stripped(F.regexp_extract("s", head, 3))
    site = F.regexp_extract(rest, r"-\s+\[(?:Web|Website|Home)\]\((https?://[^)#]+)\)", 1)
    about = F.regexp_extract(rest, r"(?s)###\s+Description\s*\n(.*?)(?=\n###|\n</details>|$)", 1)
    out = s.where(F.col("s").rlike(head)).select(
        F.trim(F.regexp_extract("s", head, 1)).alias("name"), F.trim(F.when(site != "", site).otherwise(F.regexp_extract("s", head, 2))).alias("url"),
        F.substring(F.when(about != "", F.trim(about)).otherwise(F.substring_index(rest, "\n", 1)), 1, 200).alias("description"),
    )
    return out.where(~product_url_excluded(F.col("url")))


def hrefs(html: Column) -> Column:
    """Distinct link targets of a page, in order."""
    return F.array_distinct(F.regexp_extract_all(blank(html), F.lit("""(?i)<a\\b[^>]*\\bhref=["']([^"']*)["']"""), F.lit(1)))


def directory_entries(pages: DataFrame, html: str, source: str, base: str, marks: list[str]) -> DataFrame:
    """Servers that a directory page links to: the distinct ``owner/repo`` slugs behind one of ``marks`` in a link, named by the first link's text."""
    anchor = """(?is)<a\\b[^>]*\\bhref=["']([^"']*)["'][^>]*>(.*?)</a>"""
    both = F.arrays_zip(F.regexp_extract_all(blank(F.col(html)), F.lit(anchor), F.lit(1)).alias("href"), F.regexp_extract_all(blank(F.col(html)), F.lit(anchor), F.lit(2)).alias("inner"))
    links = pages.select(F.monotonically_increasing_id().alias("_page"), F.posexplode(both).alias("_at", "x")).select("_page", "_at", "x.*")
    slug = F.coalesce(*[F.when(F.col("href").contains(m), F.regexp_replace(F.substring_index("href", m, -1), "^/+|/+$", "")) for m in marks])
    parts = F.split("slug", "/")
    found = links.withColumn("slug", slug).where(F.size(parts) >= 2)
    first = found.groupBy("slug").agg(F.min_by(F.struct("href", "inner"), F.struct("_page", "_at")).alias("f"))
    repo = F.lower(F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))
    return first.select(
        F.coalesce(F.nullif(html_text(F.col("f.inner")), F.lit("")), F.get(parts, F.lit(1))).alias("name"), F.lit("SERVER").alias("mcp_type"), F.concat(F.lit(base), "f.href").alias("listing_url"),
        F.concat(F.lit("https://github.com/"), repo).alias("github_url"), repo.alias("github_owner_repo"), F.lit(source).alias("discovery_source"), "slug",
    )


# Owners and names that are no project, and hosts that are no official site.
NO_PROJECT = [".github", "profile"]
NO_SITE = ["github.com", "twitter.com", "x.com", "linkedin.com", "youtube.com"]


def detail_page(html: Column, own_host: str) -> dict[str, Column]:
    """Fields of a directory's detail page as expressions."""
    h = blank(html)
    text = F.regexp_replace(h, r"(?s)<[^>]+>", " ")
    grab = lambda p, i=1: F.nullif(F.trim(F.regexp_extract(h, p, i)), F.lit(""))
    inner = lambda p: F.nullif(html_text(F.regexp_extract(h, p, 1)), F.lit(""))
    repo = r"github\.com/([a-zA-Z0-9_.-]+)/([a-zA-Z0-9_.-]+)"

    def parts(x: Column) -> Column:
        return F.struct(x.alias("link"), F.regexp_extract(x, repo, 1).alias("owner"), F.regexp_extract(x, repo, 2).alias("full"), F.regexp_replace(F.regexp_extract(x, repo, 2), r"\.git$", "").alias("name"))

    def chosen(links: Column) -> Column:
        path = lambda xs, name: once(F.get(xs, F.lit(0)), lambda x: F.when(x.isNotNull(), F.concat_ws("/", x["owner"], x[name])))
        good = F.filter(links, lambda x: (x["owner"] != "") & ~F.lower(x["name"]).isin(NO_PROJECT) & (F.lower(x["owner"]) != F.lower(x["name"])))
        some = F.filter(links, lambda x: (x["owner"] != "") & (F.lower(x["full"]) != ".github"))
        outer = F.filter(links, lambda x: x["link"].startswith("http") & ~F.exists(F.array(*[F.lit(d) for d in [own_host, *NO_SITE]]), lambda d: F.contains(x["link"], d)))
        return F.struct(F.coalesce(path(good, "name"), path(some, "full")).alias("repo"), F.get(outer, F.lit(0))["link"].alias("official_url"))

    links = once(F.transform(hrefs(html), lambda x: parts(F.trim(x))), chosen)
    return {
        "name": F.coalesce(inner(r"(?is)<h1[^>]*>(.*?)</h1>"), F.nullif(F.trim(F.substring_index(F.regexp_extract(h, r"(?is)<title[^>]*>([^<]*)</title>", 1), "|", 1)), F.lit(""))),
        "description": F.coalesce(grab(r"""(?is)<meta[^>]*name=["']description["'][^>]*content=["']([^"']*)["']"""), inner(r"(?is)<p\b[^>]*>(.*?)</p>")),
        "category": inner(r"""(?is)<a\b[^>]*href=["'][^"']*/mcp/categories/[a-zA-Z0-9_.-]+[^"']*["'][^>]*>(.*?)</a>"""),
        "pricing": F.coalesce(F.nullif(F.initcap(F.regexp_extract(text, r"(?i) (Freemium|Free|Paid) ", 1)), F.lit("")), F.lit("Free")),
        "stars": F.regexp_extract(text, r"(?i)(\d+)\s*Stars", 1).try_cast("int"),
        "repo": links["repo"],
        "official_url": links["official_url"],
    }


# Hosts of the forum itself, whose links are no application form.
FORUM_HOSTS = ["ycombinator.com", "hnrss.org", "w3.org"]


def hiring_posts(posts: DataFrame, now: Column, source: str) -> DataFrame:
    """(company, title, location, url, remote, role, posted, source) of forum ``posts(description, author, published, link)``.

    The first line of the text tells company, title and place; without a company it is the
    author's. Posts off topic or not fresh are left out. The first link that leads away from the forum is where to apply, else the post's own.
    """
    d = posts.withColumn("_text", stripped(F.regexp_replace(blank(F.col("description")), "<[^>]+>", "")))
    line = F.trim(F.substring_index("_text", "\n", 1))
    d = d.withColumn("_p", first_line_parts(line)).withColumn("posted", parse_date(F.col("published"), now))
    links = F.regexp_extract_all(blank(F.col("description")), F.lit(r"""(https?://[^\s<>"')]+)"""), F.lit(1))
    away = F.get(F.filter(links, lambda u: ~reduce(Column.__or__, [u.contains(h) for h in FORUM_HOSTS])), F.lit(0))
    none = F.lit(None).cast("array<string>")
    named = F.coalesce(F.col("_p.company"), F.when(blank(F.col("author")) != "", F.col("author")), F.lit("AI Startup"))
    return d.where(on_topic(F.col("_p.title")) & is_fresh(F.col("posted"), now)).select(
        named.alias("company"), F.col("_p.title").alias("title"), F.col("_p.location").alias("location"), F.coalesce(away, F.col("link")).alias("url"),
        is_remote(F.col("_p.location"), none, F.col("_p.title")).alias("remote"), role(F.col("_p.title")).alias("role"), "posted", F.lit(source).alias("source"),
    )


def read_jsonl(spark: SparkSession, path: str, schema: str, ok: Column | None = None) -> DataFrame:
    """JSON lines; corrupt and invalid lines are skipped."""
    d = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return d if ok is None else d.where(F.coalesce(ok, F.lit(False)))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def replay_wal(spark: SparkSession, path: str, record: str, limit: int | None = None, at: commits.Snapshot | None = None) -> DataFrame:
    """(key, data, append, seq): the first record of each key in the log, by append and place in it.

    Corrupt lines and those without a key or data are skipped. With ``limit`` the first so
    many keys in the order of the log. An absent log is empty.
    """
    rows = commits.read(spark, path, f"key STRING, data STRUCT<{record}>, seq BIGINT", at=at, kind="json", order="append")
    first = F.min_by(F.struct("data", "append", "seq"), F.struct("append", "seq"))
    found = rows.where("key is not null and data is not null").groupBy("key").agg(first.alias("r")).select("key", "r.*")
    return found if limit is None else quota(found, limit, F.col("append"), F.col("seq"))


# Companies that every registry starts from, with their sites.
SEEDS = [
    ("OpenAI, Inc.", "https://openai.com"), ("Anthropic PBC", "https://anthropic.com"), ("Mistral AI SAS", "https://mistral.ai"), ("Stability AI Ltd", "https://stability.ai"),
    ("Hugging Face, Inc.", "https://huggingface.co"), ("Perplexity AI", "https://perplexity.ai"), ("eleven labs", "https://elevenlabs.io"), ("wandb", "https://wandb.ai"),
    ("pika", "https://pika.art"), ("Scale AI", "https://scale.com"), ("Cohere", "https://cohere.com"),
]


def seed_companies(spark: SparkSession) -> DataFrame:
    """The fixed seed rows in order."""
    return spark.createDataFrame([(n, u, i) for i, (n, u) in enumerate(SEEDS)], "name string, url string, seq long")


def extracted(df: DataFrame, text: str, schema: str, extract: Callable[[list[str]], list[dict | None]], name: str = "answer") -> DataFrame:
    """``df`` with the struct ``name`` that the injected ``extract`` makes of a batch of texts; null where it gives None.

    ``schema`` is the struct's DDL; a field that an answer lacks is null, one it has beyond is dropped.
    """
    fields = [f.name for f in df.sparkSession.createDataFrame([], schema).schema]

    @F.pandas_udf(f"found boolean, {schema}")
    def column(texts: pd.Series) -> pd.DataFrame:
        answers = extract([t or "" for t in texts])
        return pd.DataFrame({"found": [a is not None for a in answers]} | {f: pd.Series([(a or {}).get(f) for a in answers], dtype=object) for f in fields})

    out = df.withColumn("_x", column(text))
    return out.withColumn(name, F.when(F.col("_x.found"), F.struct(*[F.col(f"_x.{f}").alias(f) for f in fields]))).drop("_x")

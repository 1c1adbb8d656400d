"""The two whole runs: signals (five record streams to tables, log, graph and report) and curation (candidates to ranked tables).

Both start from landed rows and take every clock as ``now``. Steps are lazy frames;
what is read several times is written once to the shared folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import choice as N
from .functions import classify as C
from .functions import temporal as T
from .functions.text import blank, repo_path, title_key
from .functions.urls import canonical_key, normalize_url, registrable_domain
from .operators import dedup as D
from .operators import graph as G
from .operators import history as H
from .operators import report as RP
from .operators import resolve as RS
from .operators import scoring as S
from .operators import shaping as P
from .sources import commits
from .sources import readers as R
from .sources import sinks as K
from .sources import workbook as WB
from .sources.sinks import write_report
from .store import stored

#: the landed columns of each stream; ``seq`` is the order in which rows were collected
LANDED = {
    "startups": "source STRING, url STRING, name STRING, employees INT, seq BIGINT",
    "products": "source STRING, url STRING, name STRING, startup STRING, description STRING, seq BIGINT",
    "papers": "url STRING, title STRING, authors ARRAY<STRING>, text STRING, published STRING, seq BIGINT",
    "jobs": "source STRING, url STRING, company STRING, title STRING, posted STRING, location STRING, tags ARRAY<STRING>, seq BIGINT",
    "news": "source STRING, url STRING, title STRING, posted STRING, html STRING, snippet STRING, seq BIGINT",
}


def landed_or_empty(spark: SparkSession, landed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The streams with their fixed columns; one that did not land is empty, so the others go on."""
    fixed = {}
    for name, ddl in LANDED.items():
        empty = spark.createDataFrame([], ddl)
        fixed[name] = landed[name].select(*empty.columns) if name in landed else empty
    return fixed


def _record(kind: str, source: Column, url: Column, content: Column, now: Column) -> list[Column]:
    return [F.lit("1.0").alias("schemaVersion"), F.lit(kind).alias("recordType"), F.struct(source.alias("name"), url.alias("url")).alias("source"), content.alias("content"), now.alias("collectedAt")]


def fixed(spark: SparkSession, now: Column) -> Column:
    """The clock as a constant, so that it may be used in any expression and is worked out once."""
    return F.timestamp_micros(F.lit(spark.range(1).select(F.unix_micros(now.cast("timestamp"))).first()[0]))


def _quota(df: DataFrame, target: int | None) -> DataFrame:
    return df if target is None else D.quota(df, target, F.col("seq"))


#: streams of the two phases: bulk collection up to a target, and the signals of a day
PHASES = {"1": ["startups", "products", "papers"], "2": ["jobs", "news"]}
PHASES["all"] = [*PHASES["1"], *PHASES["2"]]

SEEN = "crawler STRING, key STRING"
RUNS = "crawler STRING, source STRING, run BIGINT, n BIGINT"


def signals(
    spark: SparkSession, landed: dict[str, DataFrame], registry: DataFrame, aliases: DataFrame, domains: DataFrame, now: Column,
    stars: DataFrame | None = None, target: int | None = None, hours: int = 24, seen: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Output frames ``startups products papers jobs news logs nodes edges``, flat with fixed headers.

    Rows without a name, title or link are rejected, and records outside their table's
    constraints (:func:`shaping.constraints`). First rows by ``seq`` win a key. Jobs
    must be on topic and, as news, fresh; the gates run before the dedup, so a stale row
    reserves no key. A job or an article without a date is dated by its text, else it counts
    as new unless ``seen(crawler, key)`` has its link from an earlier run. Company names are
    resolved against the registry (:func:`resolve.resolve`). ``stars(repo, stars)`` enriches
    papers. Beside the tables: ``resolved`` (every raw name), ``novelty`` (crawler, key of
    the undated rows that were kept) and ``fresh`` (crawler, source, n of every source that landed).
    """
    src = landed_or_empty(spark, landed)
    now = fixed(spark, now)
    seen = spark.createDataFrame([], SEEN) if seen is None else seen
    name_ok = lambda c: N.stripped(F.col(c)) != ""

    # every raw company name is resolved once
    raw = [
        src["startups"].where(name_ok("name")).select(F.col("name").alias("raw"), registrable_domain(F.col("url")).alias("domain"), F.col("url").alias("at")),
        src["products"].where(name_ok("name")).select(F.coalesce("startup", C.maker(F.col("name"), F.col("description"), F.col("url"))).alias("raw"), F.lit(None).cast("string"), "url"),
        src["jobs"].where(name_ok("company")).select("company", F.lit(None).cast("string"), "url"),
    ]
    named = stored(raw[0].union(raw[1]).union(raw[2]).groupBy("raw").agg(F.min("domain").alias("domain"), F.min("at").alias("at")))
    resolved = stored(RS.resolve(named, registry, aliases, domains))
    canon = resolved.select(F.col("raw").alias("_raw"), "canonical")

    def with_company(df: DataFrame, column: Column) -> DataFrame:
        return df.withColumn("_name", column).join(canon, F.col("_name") == F.col("_raw"), "left").withColumn("company_name", F.coalesce("canonical", "_name")).drop("_raw", "_name", "canonical")

    def with_novel(df: DataFrame, crawler: str, key: str) -> DataFrame:
        """Adds ``novel``: the key is not blank and was not seen in an earlier run."""
        old = seen.where(F.col("crawler") == crawler).select(F.col("key").alias("_key")).distinct().withColumn("_old", F.lit(True))
        return df.join(old, F.col(key) == F.col("_key"), "left").withColumn("novel", (F.trim(blank(F.col(key))) != "") & F.col("_old").isNull()).drop("_key", "_old")

    first = lambda df, key: stored(_quota(D.first_wins(df, key, F.col("seq")), target))
    startups = first(with_company(src["startups"].where(name_ok("name")), F.col("name")), F.col("company_name"))
    made = F.coalesce("startup", C.maker(F.col("name"), F.col("description"), F.col("url")))
    products = first(with_company(src["products"].where(name_ok("name")), made).withColumn("pricing", C.pricing(F.col("name"), F.col("url"), F.col("description"))), F.col("name"))

    papers = src["papers"].where((F.length("title") >= 3) & name_ok("url")).withColumn("repo", repo_path(F.col("text"))).withColumn("at", T.parse_date(F.col("published"), now))
    papers = first(papers.where(F.col("at").isNotNull()), F.col("url"))
    if stars is not None:
        papers = papers.join(stars.groupBy(F.lower("repo").alias("_r")).agg(F.max("stars").alias("stars")), F.lower("repo") == F.col("_r"), "left")
    else:
        papers = papers.withColumn("stars", F.lit(None).cast("int"))

    def dated(df: DataFrame, at: Column) -> DataFrame:
        d = df.withColumn("_at", at).withColumns({"at": F.col("_at.date"), "inferred": F.col("_at.inferred")}).drop("_at")
        return d.where(F.col("at").isNotNull())

    posting = lambda novel: T.job_date(F.col("posted"), F.col("title"), novel, now, hours)
    # a row that has no date even if its key is new leaves before keys are compared
    jobs = src["jobs"].where(C.on_topic(F.col("title"))).where(posting(F.lit(True))["date"].isNotNull())
    jobs = dated(with_novel(jobs, "jobs", "url"), posting(F.col("novel")))
    jobs = stored(D.first_wins(with_company(jobs, F.col("company")), F.col("url"), F.col("seq")))

    news = src["news"].where((F.length("title") >= 5) & N.early_reject(F.col("title"), F.col("url"), F.col("posted"), now).isNull()).withColumn("link", normalize_url(F.col("url")))
    body = N.full_text(F.col("html"), F.col("title"), F.lit(False))
    news = dated(with_novel(news, "news", "link"), T.news_date(F.col("posted"), F.col("html"), F.col("url"), body["text"], F.col("novel"), now, hours))
    news = stored(D.first_wins(news, F.col("link"), F.col("seq")).withColumn("key", title_key(F.col("title"))))
    news = stored(D.fuzzy_first_wins(news, "seq", "key"))
    short = N.summary(F.lit(None).cast("string"), F.col("snippet"), F.col("body.text"), F.col("title"), F.lit(False))
    news = news.withColumn("body", body).withColumn("summary", short["summary"])

    s, u = F.col("source"), F.col("url")
    valid = lambda table, df: df.where(P.constraints(table))
    out = {
        "startups": P.startup_rows(valid("startups", startups.select(*_record("STARTUP", s, u, F.struct(F.col("company_name").alias("entityName"), F.struct(F.col("employees").alias("employeeCount")).alias("data")), now)))),
        "products": P.product_rows(valid("products", products.select(*_record("PRODUCT", s, u, F.struct(F.col("name").alias("productName"), F.col("company_name").alias("startupName"), F.col("pricing").alias("pricingModel"), u.alias("productUrl")), now)))),
        "papers": P.paper_rows(valid("papers", papers.select(F.lit("1.0").alias("schemaVersion"), F.lit("RESEARCH_PAPER").alias("recordType"), F.struct(
            "title", F.when(F.size("authors") > 0, F.col("authors")).otherwise(F.array(F.lit("AI Researcher"))).alias("authors"), u.alias("paper_url"),
            F.concat(F.lit("https://github.com/"), "repo").alias("github_url"), F.col("stars").alias("github_stars"), F.col("at").alias("published_date")).alias("content")))),
        "jobs": P.job_rows(valid("jobs", jobs.select(*_record("JOB", s, u, F.struct(F.col("company_name").alias("company"), "title", F.col("at").alias("date"), F.col("inferred").alias("date_inferred"), C.is_remote(F.col("location"), F.col("tags"), F.col("title")).alias("is_remote"), C.role(F.col("title")).alias("role_family")), now)))),
        "news": P.news_rows(valid("news", news.select(*_record("NEWS", s, u, F.struct("title", F.col("at").alias("published_date"), F.col("inferred").alias("date_inferred"), "summary", N.news_text(F.col("body.text"), F.col("summary"), F.col("title")).alias("full_text")), now)))),
        "logs": P.log_rows(valid("logs", resolved.select(F.col("raw").alias("rawName"), F.col("canonical").alias("canonicalName"), F.lit("STARTUP").alias("entityType"), F.col("method").alias("matchMethod"), F.col("confidence").alias("confidenceScore"), F.col("at").alias("sourceUrl"), now.alias("timestamp")))),
    }

    company = startups.select(F.col("company_name").alias("n"), "seq").unionByName(products.select(F.col("company_name").alias("n"), "seq")).unionByName(jobs.select(F.col("company_name").alias("n"), "seq"))
    repos = papers.where("repo is not null")
    told = RS.mentions(news.select(u.alias("id"), "title"), startups.select(F.col("company_name").alias("name")))
    told = told.join(news.select(u.alias("id"), "seq"), "id").select(F.col("name").alias("src"), F.col("id").alias("dst"), "seq")
    untold = news.join(told.select(F.col("dst").alias("_id")).distinct(), u == F.col("_id"), "left_anti")
    out["nodes"] = G.nodes([
        (company, "n", "n", "Startup", False), (products, "name", "name", "Product", True), (papers, "url", "title", "Paper", True), (repos, "repo", "repo", "Repository", True),
        (jobs, "url", "title", "Job", True), (news, "url", "title", "News", True), (untold, "source", "source", "Publisher", False),
    ])
    link = lambda df, a, b: df.select(F.col(a).alias("src"), F.col(b).alias("dst"), "seq")
    out["edges"] = G.edges([
        (link(products, "company_name", "name"), "Startup", "Product", "SHIPPED"), (link(repos, "url", "repo"), "Paper", "Repository", "IMPLEMENTED_IN"),
        (link(jobs, "company_name", "url"), "Startup", "Job", "HIRED_VIA"), (told, "Startup", "News", "MENTIONED_IN"), (link(untold, "source", "url"), "Publisher", "News", "PUBLISHED"),
    ])
    out["resolved"] = resolved
    new = lambda df, crawler, key: df.where("inferred and novel").select(F.lit(crawler).alias("crawler"), F.col(key).alias("key"))
    out["novelty"] = new(jobs, "jobs", "url").unionByName(new(news, "news", "link"))
    count = lambda df, crawler: H.counts_with_zero(df, src[crawler].select("source").distinct(), "source").select(F.lit(crawler).alias("crawler"), "source", "n")
    out["fresh"] = count(jobs, "jobs").unionByName(count(news, "news"))
    return out


def run(
    spark: SparkSession, landed: dict[str, DataFrame], registry: DataFrame, aliases: DataFrame, domains: DataFrame, now: Column, root: str, run_id: str, target: int,
    seconds: float = 0.0, phase: str = "all", run: int = 0, fresh: bool = False, stars: DataFrame | None = None, workbook: str | None = None,
) -> DataFrame:
    """``signals`` of a phase written under ``root`` with its report, which is returned. Tables are CSV, nodes and edges among them.

    State lives under ``root``: keys seen in earlier runs, the counts of each source's last
    five runs, the registry with what was learned, and a log of the bulk rows that landed.
    An interrupted run leaves its log, and the next one goes on from it; one that reaches its
    target empties it. ``fresh`` forgets seen keys, counts and logs first. ``run`` is this
    run's number in the history.
    """
    streams = PHASES[phase]
    state, wal = f"{root}/state", f"{root}/wal"
    if fresh:
        K.reset_state(spark, f"{state}/seen")
        K.reset_state(spark, f"{state}/runs")
        for name in PHASES["1"]:
            K.truncate_wal(spark, f"{wal}/{name}")
    known, grounded = K.load_registry(spark, f"{root}/registry", registry)
    grounded = grounded.unionByName(domains.select("domain", "canonical").join(grounded.select("domain"), "domain", "left_anti"))
    seen, runs = stored(K.read_state(spark, f"{state}/seen", SEEN)), stored(K.read_state(spark, f"{state}/runs", RUNS))
    rows = {}
    for name in streams:
        rows[name] = landed[name] if name in landed else spark.createDataFrame([], LANDED[name])
        if name in PHASES["1"]:
            rows[name] = _recovered(spark, rows[name], name, f"{wal}/{name}")
    counts = spark.createDataFrame([(n, 0) for n in PHASES["all"]], "name string, n long")
    try:
        out = signals(spark, rows, stored(known), aliases, stored(grounded), now, stars=stars, target=target, seen=seen)
        tables = {n: out[n] for n in [*PHASES["all"], "logs", "nodes", "edges"]}
        K.write_tables(tables, root, skip_empty=False)
        if workbook:
            WB.write_workbook({n: out[n] for n in [*PHASES["all"], "logs"]}, workbook)
        counts = stored(RP.collected({n: out[n] for n in PHASES["all"]}))
        # what was learned and seen is saved once the tables are whole
        K.save_registry(stored(RS.learn(out["resolved"], known)), stored(RS.learn_domains(out["resolved"], grounded)), f"{root}/registry")
        K.write_state(seen.unionByName(out["novelty"]).distinct(), f"{state}/seen")
        mine = [c for c in ("jobs", "news") if c in streams]
        for c in mine:
            runs = runs.where(F.col("crawler") != c).unionByName(H.with_run(runs, c, run, out["fresh"].where(F.col("crawler") == c).select("source", "n")))
        runs = stored(runs)
        K.write_state(runs, f"{state}/runs")
        status, short = "completed", counts.where(F.col("name").isin(PHASES["1"]))
        for name in PHASES["1"]:
            if name in streams and not short.where((F.col("name") == name) & (F.col("n") >= target)).isEmpty():
                K.truncate_wal(spark, f"{wal}/{name}")
    except KeyboardInterrupt:
        K.save_registry(known, grounded, f"{root}/registry")
        write_report(RP.run_report(counts, run_id, "interrupted", target, seconds), f"{root}/report")
        raise
    health = H.source_health(runs.select(F.concat_ws(":", "crawler", "source").alias("source"), "run", "n"))
    report = RP.run_report(counts, run_id, status, target, seconds, stale=health, bulk=PHASES["1"] if "1" == phase or phase == "all" else [])
    write_report(report, f"{root}/report")
    return report


def _recovered(spark: SparkSession, rows: DataFrame, name: str, path: str) -> DataFrame:
    """The rows of an interrupted run's log and those that landed now; the log then holds both."""
    key = "url" if name == "papers" else "name"
    fixed = rows.select(*spark.createDataFrame([], LANDED[name]).columns)
    held = commits.snapshot(spark, path)
    log = stored(R.replay_wal(spark, path, LANDED[name], at=held))
    if not log.isEmpty() and len(held.parts[commits.ROWS]) > 1:
        K.compact_wal(log, path, held.version)  # a log that is interrupted again and again stays as long as its keys are many
    old = log.select("data.*")
    # rows of the log come first; those that landed again are the log's
    again = log.select(F.lower(F.trim("key")).alias("_k")).distinct()
    new = stored(fixed.join(again, F.lower(F.trim(F.col(key))) == F.col("_k"), "left_anti"))
    K.append_wal(new, key, path, F.col("seq"))
    return old.unionByName(new)


CANDIDATE = "name STRING, kind STRING, source STRING, description STRING, url STRING, repo STRING, docs_url STRING, stars INT, score DOUBLE, seq BIGINT"


def merged(candidates: DataFrame) -> DataFrame:
    """One candidate for each canonical key: the best by score, then stars, then order, its blanks filled from the next best, sources as a set."""
    c = candidates.where(N.stripped(F.col("name")) != "").withColumn("key", canonical_key(F.col("repo"), F.col("url"), F.col("name")))
    for name, kind in (("score", "double"), ("stars", "int")):
        if name not in c.columns:
            c = c.withColumn(name, F.lit(None).cast(kind))
    return D.canonical_merge(c, "key", "score", "stars", "seq", ["description", "url", "docs_url"], "source")


def curate(candidates: DataFrame, probes: DataFrame, evaluations: DataFrame, now: Column, cap: int = 4, verified: DataFrame | None = None, max_pending: int | None = None) -> DataFrame:
    """Candidates with key, status, scores and, where selected, their rank among their kind.

    ``candidates(name, kind, source, description, url, repo, docs_url, seq)``, with stars and
    score where they are known; ``probes(repo, code, archived, stars, pushed_at)``;
    ``evaluations(key, usefulness, quality, differentiation, notes)``. Rows are merged by
    canonical key (:func:`merged`), admitted by their shard, scored by rules and a valid
    evaluation, capped at ``cap`` a cluster, and selected by the floors of their kind.
    Keys of ``verified(key)`` are verified already and need no probe. At most ``max_pending``
    verified rows, the most stars first, take an evaluation; a row without a valid one keeps
    its rule score and is never selected.
    """
    c = merged(candidates).withColumnRenamed("stars", "_listed").drop("score")
    # of several probes of a repository the latest push counts, then the most stars
    told = F.struct("code", "archived", "stars", "pushed_at")
    p = probes.groupBy(F.lower("repo").alias("_repo")).agg(F.max_by(told, F.struct("pushed_at", "stars", "code", "archived")).alias("p")).select("_repo", "p.*")
    d = c.join(p, F.lower("repo") == F.col("_repo"), "left").drop("_repo").withColumn("stars", F.coalesce("stars", "_listed")).drop("_listed")
    probe = C.repo_status(F.col("code"), F.col("archived"))
    d = d.withColumn("reason", F.when(blank(F.col("repo")) != "", probe["reason"]))
    d = d.withColumn("status", N.admission(C.shard(F.col("source")), F.col("name"), F.col("repo"), probe["status"]))
    if verified is not None:
        known = verified.select(F.col("key").alias("_key")).distinct()
        d = d.join(known, F.col("key") == F.col("_key"), "left").withColumn("status", F.when(F.col("_key").isNotNull(), F.lit("VERIFIED")).otherwise(F.col("status"))).drop("_key")
    days = S.days_since(F.col("pushed_at"), now)
    rules = [S.activity(days, F.col("archived")), S.adoption(F.col("stars")), S.docs(F.col("docs_url"), blank(F.col("repo")) != ""), S.reliability(F.col("status") == "VERIFIED", F.lit(False))]
    e = evaluations.withColumn("valid", N.answer_valid(F.col("usefulness"), F.col("quality"), F.col("differentiation"), F.col("notes"))).where("valid")
    e = e.select(F.col("key").alias("_key"), "usefulness", "quality", "differentiation").groupBy("_key").agg(*[F.max(x).alias(x) for x in ("usefulness", "quality", "differentiation")])
    if max_pending is not None:
        queue = stored(d.where("status = 'VERIFIED'").select("key", "stars", S.total(*rules).alias("rule")))
        queue = D.quota(queue, max_pending, F.desc(F.coalesce("stars", F.lit(0))), F.desc("rule"), F.col("key"))
        e = e.join(queue.select(F.col("key").alias("_key")), "_key", "left_semi")
    d = d.join(e, F.col("key") == F.col("_key"), "left").withColumn("scored", F.col("_key").isNotNull()).drop("_key")
    d = d.withColumn("score", S.total(*rules, F.col("usefulness"), F.col("quality"), F.col("differentiation")))
    d = stored(d.withColumn("cluster", C.cluster(F.col("name"), F.col("description"), F.lit(""))))
    best = [F.desc("score"), F.desc(F.coalesce("stars", F.lit(0))), F.col("key")]
    pool = D.cap_per_group(d.where("status = 'VERIFIED'"), "cluster", cap, *best, exempt=F.col("kind") == "CLIENT")
    pool = pool.where(F.col("scored") & S.selected(F.col("kind"), F.col("score")))
    rank = D.ranked_wide(pool, "kind", "rank", *best).select(F.col("key").alias("_key"), F.col("rank").cast("long").alias("rank"))
    return d.join(rank, F.col("key") == F.col("_key"), "left").drop("_key")


def deliverables(curated: DataFrame, earlier: DataFrame | None = None) -> dict[str, DataFrame]:
    """``servers``, ``clients`` and ``rejected`` of a curation run.

    The rejected log holds, in this order and once a key, the ``earlier`` rejected rows, those
    that the probes rejected, and scored rows below their floor; curated keys are left out.
    """
    d = curated.withColumn("key", P.rejected_key(F.when(blank(F.col("repo")) != "", F.concat(F.lit("https://github.com/"), "repo")), F.col("url"), F.col("name")))
    names = ["key", "name", "kind", "repo", "url", "source", "rejection_reason", "seq"]
    chosen = d.where(F.col("rank").isNotNull())
    gone = d.where("status = 'REJECTED'").withColumn("rejection_reason", F.col("reason")).select(*names)
    low = d.where("status <> 'REJECTED' and scored and rank is null").withColumn("rejection_reason", F.concat(F.lit("SUB_THRESHOLD_SCORE: "), F.format_string("%.1f", "score"))).select(*names)
    tiers = [gone, low] if earlier is None else [earlier.select(*names), gone, low]
    return {"servers": chosen.where("kind <> 'CLIENT'"), "clients": chosen.where("kind = 'CLIENT'"), "rejected": P.rejected_rows(tiers, chosen)}


#: names of the curation columns in the ranked tables
RANKED_NAMES = {
    "kind": "mcp_type", "score": "overall_score", "usefulness": "usefulness_score", "quality": "quality_score", "differentiation": "differentiation_score", "stars": "github_stars",
    "pushed_at": "github_pushed_at", "url": "official_url", "source": "discovery_source",
}


def write_deliverables(tabs: dict[str, DataFrame], root: str, workbook: str | None = None) -> None:
    """The tabs of :func:`deliverables` under their headers, as CSV in which zeros are empty cells, and as one workbook."""
    out = {}
    for name, df in tabs.items():
        d = df.withColumnsRenamed(RANKED_NAMES).withColumn("github_url", F.when(blank(F.col("repo")) != "", F.concat(F.lit("https://github.com/"), "repo")).otherwise(""))
        unknown = [c for _, c in P.RANKED if c not in d.columns and not c.endswith("_str")]
        d = d.withColumns({c: F.lit(None).cast("string") for c in unknown}) if name != "rejected" else d
        out[name] = P.headed(d if name == "rejected" else P.ranked_rows(d).orderBy("rank"), P.REJECTED if name == "rejected" else P.RANKED)
        K.write_csv(out[name], f"{root}/{name}", blank_falsy=True)
    if workbook:
        WB.write_workbook({n: d.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in d.columns]) for n, d in out.items()}, workbook)

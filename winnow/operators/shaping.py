"""Record flattening to the fixed output columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank

# Output tables and their headers.
TABLES = {
    "startups": ["schemaVersion", "recordType", "source.name", "source.url", "content.entityName", "content.data.employeeCount", "collectedAt"],
    "products": ["schemaVersion", "recordType", "source.name", "source.url", "content.productName", "content.startupName", "content.pricingModel", "content.productUrl", "collectedAt"],
    "papers": ["schemaVersion", "recordType", "content.title", "content.authors", "content.paper_url", "content.github_url", "content.github_stars", "content.published_date"],
    "jobs": ["schemaVersion", "recordType", "source.name", "source.url", "content.company", "content.title", "content.date", "content.date_inferred", "content.is_remote", "content.role_family", "collectedAt"],
    "news": ["schemaVersion", "recordType", "source.name", "source.url", "content.title", "content.published_date", "content.date_inferred", "content.summary", "collectedAt"],
    "logs": ["rawName", "canonicalName", "entityType", "matchMethod", "confidenceScore", "sourceUrl", "resolvedAt"],
}

# What an unknown cell of a ranked table reads, the columns that stay blank, and those cut to the day.
RANKED_DEFAULTS = {"category": "Developer Tools", "transport": "stdio", "pricing": "Free", "pricing_type": "Open Source", "license": "MIT"}
RANKED_BLANK = ["subcategory", "company_creator", "description", "official_url", "github_url", "docs_url", "curation_notes", "rejection_reason"]
RANKED_DATES = ["github_pushed_at", "last_verified_date"]


def or_na(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("N/A"))


def looked_up(rows: DataFrame, dim: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the ``value`` of ``dim`` whose ``key`` equals theirs, case and outer spaces ignored; null without one.

    A key that the dimension holds several times counts once, with its smallest value.
    """
    fold = lambda c: F.lower(F.trim(c))
    known = dim.groupBy(fold(F.col(key)).alias("_key")).agg(F.min(value).alias(name))
    return rows.join(known, fold(F.col(key)) == F.col("_key"), "left").drop("_key")


def overridden(rows: DataFrame, fresh: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows`` in which the ``columns`` of ``fresh`` win over their own where they are not null; ``fresh`` has one row a key."""
    new = fresh.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(new, F.col(key) == F.col("_key"), "left")
    return out.withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).select(*rows.columns)


def flatten(df: DataFrame, table: str, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Nested records to the table's columns, named by their dotted paths."""
    d = defaults or {}
    return df.select(*[d.get(c, F.col(c)).cast("string").alias(c) for c in TABLES[table]])


def startup_rows(df: DataFrame) -> DataFrame:
    return flatten(df, "startups", {"content.data.employeeCount": or_na(F.col("content.data.employeeCount"))})


def product_rows(df: DataFrame) -> DataFrame:
    return flatten(df, "products", {"content.productUrl": or_na(F.col("content.productUrl"))})


def paper_rows(df: DataFrame) -> DataFrame:
    """Authors joined; repository cells empty without a repository, ``N/A`` stars where they are unknown."""
    has = blank(F.col("content.github_url")) != ""
    stars = F.when(has, or_na(F.col("content.github_stars"))).otherwise("")
    return flatten(df, "papers", {"content.authors": F.array_join("content.authors", ", "), "content.github_url": blank(F.col("content.github_url")), "content.github_stars": stars})


def news_rows(df: DataFrame) -> DataFrame:
    """A missing summary is the first 200 characters of the text with an ellipsis."""
    short = F.when(blank(F.col("content.summary")) != "", F.col("content.summary")).otherwise(F.concat(F.substring(blank(F.col("content.full_text")), 1, 200), F.lit("...")))
    return flatten(df, "news", {"content.summary": short})


def job_rows(df: DataFrame) -> DataFrame:
    return flatten(df, "jobs")


def log_rows(df: DataFrame) -> DataFrame:
    return flatten(df, "logs", {"resolvedAt": F.col("timestamp")})


def ranked_rows(df: DataFrame) -> DataFrame:
    """Curation entries with the defaults of the ranked table, for whichever of its columns are there; lists are joined, dates cut to the day."""
    out = {c: F.when(blank(F.col(c)) != "", F.col(c)).otherwise(d) for c, d in RANKED_DEFAULTS.items()}
    out |= {c: blank(F.col(c)) for c in RANKED_BLANK}
    out |= {c: F.substring(blank(F.col(c)), 1, 10) for c in RANKED_DATES}
    out["github_stars"] = F.coalesce("github_stars", F.lit(0))
    lists = {f"{c}_str": F.array_join(F.coalesce(c, F.array().cast("array<string>")), ", ") for c in ("key_capabilities", "supported_ai_clients") if c in df.columns}
    return df.withColumns({k: v for k, v in out.items() if k in df.columns} | lists).drop(*[c.removesuffix("_str") for c in lists])


def csv_blank(c: Column) -> Column:
    """CSV cell in which zero and false are empty."""
    s = c.cast("string")
    return F.when(s.isin("0", "0.0", "false"), "").otherwise(blank(s))


def enum_text(c: Column) -> Column:
    """An enumeration's value as text; null is empty."""
    return blank(c.cast("string"))


def cell(c: Column, chars: int = 20_000) -> Column:
    return F.substring(c.cast("string"), 1, chars)


def column_widths(df: DataFrame) -> DataFrame:
    """Sheet width of each column: longest cell or header plus 3, from 12 to 50."""
    widths = [F.least(F.lit(50), F.greatest(F.lit(12), F.greatest(F.coalesce(F.max(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0)), F.lit(len(c))) + 3)).cast("long").alias(c) for c in df.columns]
    one = df.agg(*widths)
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("width")) for c in df.columns])).alias("x")).select("x.*")


def valid_split(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the constraints, and the rest; a null verdict is a failure."""
    v = F.coalesce(ok, F.lit(False))
    return df.where(v), df.where(~v)


# Headers of the ranked and of the rejected table, each with its column.
RANKED = [
    ("Rank", "rank"), ("MCP Name", "name"), ("Type", "mcp_type"), ("Overall Score", "overall_score"), ("Usefulness (30)", "usefulness_score"), ("Quality (25)", "quality_score"),
    ("Activity (15)", "activity_score"), ("Adoption (10)", "adoption_score"), ("Docs (5)", "docs_score"), ("Recency (5)", "recency_score"), ("Reliability (5)", "reliability_score"),
    ("Diff (5)", "differentiation_score"), ("Category", "category"), ("Subcategory", "subcategory"), ("Company / Creator", "company_creator"), ("Description", "description"),
    ("Key Capabilities", "key_capabilities_str"), ("Supported AI Clients", "supported_ai_clients_str"), ("Transport", "transport"), ("Pricing", "pricing"), ("Pricing Type", "pricing_type"),
    ("License", "license"), ("GitHub Stars", "github_stars"), ("Last Commit", "github_pushed_at"), ("Official URL", "official_url"), ("GitHub URL", "github_url"), ("Docs URL", "docs_url"),
    ("Listing URL", "listing_url"), ("Discovery Source", "discovery_source"), ("Last Verified Date", "last_verified_date"), ("Notes / Reason for Inclusion", "notes"),
]
REJECTED = [
    ("MCP Name", "name"), ("Type", "mcp_type"), ("Rejection Reason", "rejection_reason"), ("GitHub URL", "github_url"), ("Official URL", "official_url"), ("Listing URL", "listing_url"),
    ("Discovery Source", "discovery_source"), ("Last Verified Date", "last_verified_date"),
]


def headed(df: DataFrame, headers: list[tuple[str, str]]) -> DataFrame:
    """The columns under their headers, in order; a column that the frame lacks is null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(h) for h, c in headers])


def rejected_key(github_url: Column, listing_url: Column, name: Column) -> Column:
    """The first of the links and the name that is not blank, lower case."""
    filled = [F.nullif(blank(c), F.lit("")) for c in (github_url, listing_url, name)]
    return F.lower(F.trim(F.coalesce(*filled, F.lit(""))))


def rejected_rows(tiers: list[DataFrame], curated: DataFrame) -> DataFrame:
    """The rejected log: rows of the tiers in their order, the first of a key, less the curated keys.

    Every frame has ``key``; the tiers also ``seq`` and the same other columns.
    """
    parts = [t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)]
    every = reduce(DataFrame.unionByName, parts)
    names = [c for c in every.columns if c not in ("key", "tier", "seq")]
    first = every.groupBy("key").agg(*[F.min_by(F.struct("tier", "seq", *names), F.struct("tier", "seq")).alias("r")]).select("key", "r.*")
    return first.join(curated.select("key").distinct(), "key", "left_anti")


def projected(sources: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Sources brought to common columns, each by its own expressions, with their name and ordinal."""
    parts = [df.select(*[c.alias(n) for n, c in columns.items()], F.lit(name).alias("source"), F.lit(i).alias("ordinal")) for i, (name, (df, columns)) in enumerate(sources.items())]
    return reduce(DataFrame.unionByName, parts)


def preview(df: DataFrame, widths: dict[str, int], *order: Column, n: int = 20) -> DataFrame:
    """The first ``n`` rows by ``order`` with their rank; a text column is cut to its width (0 leaves it)."""
    top = df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long"))  # n rows at most
    return top.select("rank", *[F.substring(blank(F.col(c)), 1, w).alias(c) if w else F.col(c) for c, w in widths.items()])


def constraints(table: str) -> Column:
    """What a record of a table must meet: names not blank, titles long enough, numbers in range."""
    filled = lambda c: F.trim(F.col(c)) != ""
    least = lambda c, n: F.length(F.trim(F.col(c))) >= n
    none_or = lambda c, ok: F.col(c).isNull() | ok
    rules = {
        "startups": filled("content.entityName") & none_or("content.data.employeeCount", F.col("content.data.employeeCount") >= 1),
        "products": filled("content.startupName") & filled("content.productName") & F.col("content.pricingModel").isin("FREE", "FREEMIUM", "PAID", "ENTERPRISE"),
        "papers": least("content.title", 3) & (F.size("content.authors") >= 1) & F.col("content.published_date").isNotNull() & none_or("content.github_stars", F.col("content.github_stars") >= 0),
        "jobs": filled("content.company") & filled("content.title") & F.col("content.date").isNotNull(),
        "news": least("content.title", 5) & least("content.full_text", 20) & F.col("content.published_date").isNotNull(),
        "logs": filled("rawName") & filled("canonicalName") & F.col("confidenceScore").between(0.0, 1.0),
    }
    return F.coalesce(rules[table], F.lit(False))


def entry_constraints(columns: list[str]) -> Column:
    """What a candidate must meet, for those of its columns that are there: its kind, status and the range of each score."""
    tops = {"usefulness_score": 30, "quality_score": 25, "activity_score": 15, "adoption_score": 10, "docs_score": 5, "recency_score": 5, "reliability_score": 5, "differentiation_score": 5, "overall_score": 100}
    ok = F.col("name").isNotNull() & F.col("mcp_type").isin("SERVER", "CLIENT")
    if "verification_status" in columns:
        ok = ok & F.coalesce(F.col("verification_status").isin("PENDING", "VERIFIED", "REJECTED"), F.lit(True))
    for c, top in tops.items():
        if c in columns:
            ok = ok & F.coalesce(F.col(c).between(0, top), F.lit(True))
    return F.coalesce(ok, F.lit(False))

"""Ordered keyword and pattern classifiers, compiled from rule tables into one expression each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank
from .urls import registrable_domain, repo_owner

# Pricing tiers in order, hosts whose projects are free.
PRICING_TIERS = [
    ("ENTERPRISE", ["ENTERPRISE", "CONTACT SALES", "REQUEST DEMO", "CUSTOM PRICING"]),
    ("PAID", ["$", "/MO", "/MONTH", "SUBSCRIPTION", "PER TOKEN", "PAY-AS-YOU-GO", "PAY AS YOU GO"]),
    ("FREE", ["OPEN SOURCE", "OPEN-SOURCE", "100% FREE", "FREE TOOL", "COMPLETELY FREE", "MIT LICENSE", "APACHE 2"]),
    ("FREEMIUM", ["FREEMIUM", "FREE TIER", "FREE TRIAL", "FREE PLAN", "FREE VERSION"]),
    ("PAID", ["API", "INFRASTRUCTURE", "HOSTED PLATFORM", "CLOUD SERVICE"]),
]
FREE_HOSTS = ["github.com", "huggingface.co"]

# Role patterns in order.
ROLES = [
    ("Research", r"research|scientist|phd|postdoc"),
    ("Engineering", r"engineer|developer|architect|programmer|mlops|backend"),
    ("Product", r"product|pm\b"),
    ("Design", r"design|ui|ux"),
    ("Sales", r"sales|bdr|sdr|account exec"),
    ("Marketing", r"marketing|growth"),
    ("Operations", r"operations|ops|chief of staff"),
]

# Remote and on-site words, the topic pattern, challenge-page markers.
REMOTE = ["remote", "worldwide", "anywhere", "work from home", "telecommute"]
ONSITE = ["onsite", "on-site", "in-person"]
TOPIC = r"\bai\b|machine learning|\bml\b|\bllm\b|data scien|deep learning"
CHALLENGE = [
    "captcha", "cf-challenge", "cf-chl-", "challenge-platform", "verify you are human", "unusual traffic", "attention required",
    "are you a robot", "recaptcha", "hcaptcha", "turnstile", "ddos-guard",
]

# Functional clusters in order.
CLUSTERS = [
    ("postgresql", r"\bpostgres\b|\bpostgresql\b|\bpg_"),
    ("sqlite", r"\bsqlite\b|\bsqlite3\b"),
    ("mysql", r"\bmysql\b|\bmariadb\b"),
    ("mongodb", r"\bmongo\b|\bmongodb\b"),
    ("redis", r"\bredis\b"),
    ("docker", r"\bdocker\b|\bcontainer\b"),
    ("kubernetes", r"\bkubernetes\b|\bk8s\b"),
    ("github", r"\bgithub\b"),
    ("gitlab", r"\bgitlab\b"),
    ("slack", r"\bslack\b"),
    ("discord", r"\bdiscord\b"),
    ("notion", r"\bnotion\b"),
    ("jira", r"\bjira\b"),
    ("linear", r"\blinear\b"),
    ("filesystem", r"\bfilesystem\b|\bfile-system\b|\blocalfolder\b"),
    ("weather", r"\bweather\b|\bmeteorology\b"),
    ("brave_search", r"\bbrave\b.*search|\bbrave-search\b"),
    ("google_drive", r"\bgoogle\b.*drive|\bgdrive\b"),
    ("browser_playwright", r"\bplaywright\b"),
    ("browser_puppeteer", r"\bpuppeteer\b"),
]


def holds_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def ordered(rules: list[tuple[Column, str]], default: str | None) -> Column:
    """First rule that holds names the class."""
    out = None
    for test, label in rules:
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(F.lit(default))


def pricing(name: Column, url: Column, description: Column) -> Column:
    text = F.upper(F.concat_ws(" ", blank(name), blank(description)))
    rules = [(holds_any(text, words), label) for label, words in PRICING_TIERS]
    return ordered([*rules, (holds_any(F.lower(blank(url)), FREE_HOSTS), "FREE")], "FREEMIUM")


def pricing_choice(known: Column, enriched: Column, name: Column, url: Column, description: Column) -> Column:
    """Known price, else the enrichment's for descriptions of at least 15 characters, else the rules."""
    return F.coalesce(known, F.when(F.length(blank(description)) >= 15, enriched), pricing(name, url, description))


def role(text: Column) -> Column:
    return ordered([(blank(text).rlike(f"(?i){p}"), label) for label, p in ROLES], "Other")


def is_remote(location: Column, tags: Column, title: Column) -> Column:
    loc, t, tag = F.trim(F.lower(blank(location))), F.lower(blank(title)), F.lower(F.array_join(F.coalesce(tags, F.array().cast("array<string>")), " "))
    signal = holds_any(loc, REMOTE) | holds_any(tag, REMOTE) | holds_any(t, REMOTE)
    return signal | ((loc == "") & ~holds_any(t, ONSITE))


def on_topic(title: Column) -> Column:
    return blank(title).rlike(f"(?i){TOPIC}")


def is_challenge(page: Column) -> Column:
    """A short page with a marker of a bot check."""
    return F.coalesce(F.length(page).between(1, 5000) & holds_any(F.lower(page), CHALLENGE), F.lit(False))


def cluster(name: Column, description: Column, subcategory: Column) -> Column:
    text = F.lower(F.concat_ws(" ", blank(name), blank(description), blank(subcategory)))
    return ordered([(text.rlike(p), label) for label, p in CLUSTERS], None)


def company_title(title: Column, author: Column, split_colon: bool) -> Column:
    """(company, title) of a feed headline."""
    t, who = blank(title), F.when(blank(author) != "", author).otherwise("AI Startup")
    colon = F.struct(F.trim(F.substring_index(t, ":", 1)).alias("company"), F.trim(F.regexp_extract(t, "(?s)^[^:]*:(.*)$", 1)).alias("title"))
    hiring = F.struct(F.trim(F.substring_index(t, "is hiring", 1)).alias("company"), t.alias("title"))
    plain = F.struct(who.alias("company"), t.alias("title"))
    out = F.when(t.contains("is hiring"), hiring).otherwise(plain)
    return F.when(t.contains(":"), colon).otherwise(out) if split_colon else out


def first_line_parts(line: Column) -> Column:
    """(company, title, location) of a hiring post's first line; company is null in the plain form."""
    p = F.transform(F.split(line, r"\|"), lambda x: F.trim(x))
    piped = F.struct(F.get(p, F.lit(0)).alias("company"), F.coalesce(F.get(p, F.lit(1)), line).alias("title"), F.coalesce(F.get(p, F.lit(2)), F.lit("")).alias("location"))
    head = F.substring(line, 1, 100)
    isthe = F.struct(F.trim(F.substring_index(line, "is the", 1)).alias("company"), head.alias("title"), F.lit("").alias("location"))
    plain = F.struct(F.lit(None).cast("string").alias("company"), head.alias("title"), F.lit("").alias("location"))
    return F.when(line.contains("|"), piped).when(line.contains("is the"), isthe).otherwise(plain)


# Who a description says made the product.
MAKER = r"\b(?:by|from)\s+([A-Z][A-Za-z0-9\s&.-]{1,30}?)(?:\s+(?:is|has|was|provides|\.|\,)|$)"


def maker(name: Column, description: Column, url: Column) -> Column:
    """Who made a product: named after by or from, else, if that reads like a sentence, the repository's owner or the domain."""
    m = F.trim(F.regexp_extract(blank(description), MAKER, 1))
    raw = F.when(m != "", m).otherwise(name)
    odd = (F.size(F.split(F.trim(raw), r"\s+")) > 5) | raw.rlike(r"[.!?]$") | F.lower(raw).isin("github", "github.com")
    domain = registrable_domain(url)
    stem = F.initcap(F.substring_index(domain, ".", 1))
    return F.when(~odd, raw).otherwise(F.coalesce(repo_owner(url), F.when((domain != "") & (domain != "github.com"), stem), name))


# What a provider's message says when a request is too large or a quota is used up.
TOO_LARGE = ["413", "payload too large", "request too large", "content too large", "maximum context length"]
USED_UP = ["429", "quota", "rate_limit", "resource_exhausted"]


def provider_error(message: Column) -> Column:
    """Kind of a provider's failure: too large (no retry helps), rate limited, or transient."""
    t = F.lower(blank(message))
    return ordered([(holds_any(t, TOO_LARGE), "payload"), (holds_any(t, USED_UP), "rate_limit")], "transient")


def quota_error(message: Column) -> Column:
    t = F.lower(blank(message))
    return t.contains("429") | (t.contains("403") & holds_any(t, ["rate limit", "quota"]))


def repo_status(code: Column, archived: Column) -> Column:
    """(status, reason) of a repository probe; a null code is a request that failed."""
    s = lambda a, b: F.struct(F.lit(a).alias("status"), (F.lit(b) if isinstance(b, str) else b).alias("reason"))
    return (
        F.when(code.isin(404, 410), s("REJECTED", "REPO_GONE"))
        .when((code == 200) & F.coalesce(archived, F.lit(False)), s("REJECTED", "ARCHIVED"))
        .when(code == 200, s("VERIFIED", ""))
        .when(code.isin(403, 429), s("PENDING", "GH_RATE_LIMITED"))
        .otherwise(s("PENDING", F.coalesce(F.concat(F.lit("GH_"), code.cast("string")), F.lit("GH_ERR"))))
    )


def verification(archived: Column, stars: Column, pushed_at: Column) -> Column:
    """(status, reason) of a candidate whose repository facts came with its listing."""
    s = lambda a, b: F.struct(F.lit(a).alias("status"), F.lit(b).alias("reason"))
    stub = (F.coalesce(stars, F.lit(0)) == 0) & (blank(pushed_at.cast("string")) == "")
    return F.when(F.coalesce(archived, F.lit(False)), s("REJECTED", "ARCHIVED")).when(stub, s("REJECTED", "ZERO_ACTIVITY_STUB")).otherwise(s("VERIFIED", ""))


def status_error(code: Column) -> Column:
    """Kind of failure of a response: blocked, transient or fatal; null for a success."""
    return F.when(code == 403, "blocked").when(code.isin(429, 500, 502, 503, 504), "transient").when(code >= 400, "fatal")


def site_alive(head: Column, get: Column) -> Column:
    """A site answers if its HEAD or, failing that, its GET gave a status below 400."""
    return F.coalesce(head < 400, F.lit(False)) | F.coalesce(get < 400, F.lit(False))


# Words in a candidate's sources that route it to a shard, in order.
SHARDS = [("repository", ["GitHub Topic Search"]), ("registry", ["Official Registry"]), ("directory", ["Glama.ai", "Smithery.ai"])]


def shard(source: Column) -> Column:
    """Exclusive routing of a candidate by its sources; null for one that no shard takes."""
    return ordered([(holds_any(blank(source), words), name) for name, words in SHARDS], None)


def candidate_kind(name: Column, description: Column) -> Column:
    """CLIENT if name or description speak of a client."""
    return F.when(F.lower(blank(name)).contains("client") | F.lower(blank(description)).contains("client"), "CLIENT").otherwise("SERVER")

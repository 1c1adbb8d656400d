"""Scalar functions and classifiers over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import text as X
from ..functions import urls as U
from ..sources import readers as R
from .registry import query, table

_NAME_DROP = ", ".join(f"'{w}'" for w in [*X.CORPORATE_SUFFIXES, *X.TECH_NOISE])


def _sql_tokens(c: str) -> str:
    return rf"list_filter(regexp_split_to_array(regexp_replace({c}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'), lambda t: t <> '')"


def _sql_plain(c: str) -> str:
    return f"strip_accents(lower({c}))"


def sql_any(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def sql_name_key(c: str) -> str:
    return f"array_to_string(list_filter({_sql_tokens(_sql_plain(f'trim({c})'))}, lambda t: t NOT IN ({_NAME_DROP})), ' ')"


# names and their keys, written out
_NAMES = {"Škoda Inc.": "skoda", "Ő Labs": "o", "ﬁnd Ａpp": "find app", "Việt Ltd": "viet", "½ ㎏ ①": "1 2 kg 1", "Ångström GmbH": "angstrom", "Ǆ": "dz", "e\u0301x": "ex"}


@query(f"""SELECT s_suppkey, CASE s_suppkey % {len(_NAMES)} {" ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_NAMES.values()))} END || ' ' || replace(lower(s_name), '#', ' ') AS name_key FROM supplier""")
def x1_name_key(spark, sf):
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("s_suppkey") % len(_NAMES) + 1).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", X.name_key(F.concat(name, F.lit(" "), "s_name", F.lit(" Labs, Inc."))).alias("name_key"))


_TITLE = rf"regexp_replace(split_part(coalesce(text, ''), chr(10), 1) || ' - TechCrunch', '\s*([-|–—]|\()\s*({X.PUBLISHERS})\s*\)?\s*$', '', 'i')"


@query(f"""SELECT doc_id, array_to_string({_sql_tokens(_sql_plain("trim(" + _TITLE + ")"))}, ' ') AS title_key FROM documents""")
def x4_title_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.title_key(F.concat(X.first_line(F.col("text")), F.lit(" - TechCrunch"))).alias("title_key"))


_URL = r"regexp_extract(trim(coalesce(url, '')), '(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?'"
_TRACK = ", ".join(f"'{w}'" for w in U.TRACKING)


@query(f"""
WITH p AS (SELECT page_id, lower({_URL}, 1)) AS scheme, lower({_URL}, 2)) AS loc, regexp_replace({_URL}, 3), '/+$', '') AS path, {_URL}, 4) AS q FROM pages),
k AS (SELECT *, array_to_string(list_transform(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT starts_with(lower(split_part(x, '=', 1)), 'utm_')
  AND lower(split_part(x, '=', 1)) NOT IN ({_TRACK})), lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END), '&') AS kept FROM p)
SELECT page_id, CASE WHEN scheme = '' THEN '' ELSE scheme || '://' || loc || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS url,
  array_to_string(string_split(loc, '.')[-2:], '.') AS domain, loc AS host, scheme IN ('http', 'https') AND loc <> '' AND loc <> 'localhost' AS safe FROM k""")
def x2_x3_x41_f3_url_parts(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", U.normalize_url(u).alias("url"), U.registrable_domain(u).alias("domain"), U.host_port(u).alias("host"), U.safe_url(u).alias("safe"))


@query(r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'gh:org/repo' || (page_id % 7) WHEN page_id % 3 = 1
  THEN 'url:' || regexp_replace(regexp_replace(lower(trim(url)), '/+$', ''), '^https?://(www\.)?', '') ELSE 'name:page' || page_id END AS key FROM pages""")
def x33_x34_canonical_key(spark, sf):
    i = F.col("page_id")
    repo = F.when(i % 3 == 0, U.owner_repo(F.concat(F.lit("https://github.com/Org/Repo"), i % 7)))
    url = F.when(i % 3 == 1, F.col("url"))
    return table(spark, sf, "pages").select("page_id", U.canonical_key(repo, url, F.concat(F.lit("Page "), i)).alias("key"))


_UP = "upper(coalesce(text, ''))"


def sql_pricing(upper: str) -> str:
    tiers = " ".join(f"WHEN {sql_any(upper, ws)} THEN '{label}'" for label, ws in C.PRICING_TIERS)
    return f"CASE {tiers} ELSE 'FREEMIUM' END"


@query(f"SELECT doc_id, {sql_pricing("u")} AS pricing FROM (SELECT doc_id, ' ' || {_UP} AS u FROM documents)")
def x18_x49_pricing(spark, sf):
    none = F.lit(None).cast("string")
    return table(spark, sf, "documents").select("doc_id", C.pricing_choice(none, none, F.lit(""), F.lit(""), F.col("text")).alias("pricing"))


def sql_role(text: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '(?i){p}') THEN '{label}'" for label, p in C.ROLES) + " ELSE 'Other' END"


@query(f"SELECT conv_id, turn, {sql_role("t")} AS role_family FROM (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations)")
def x19_role(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", C.role(F.col("text")).alias("role_family"))


@query(f"""SELECT doc_id, {sql_any("lower(coalesce(text, ''))", C.REMOTE)} OR (doc_id % 2 = 0 AND NOT {sql_any("lower(coalesce(text, ''))", C.ONSITE)}) AS remote FROM documents""")
def x20_remote(spark, sf):
    loc = F.when(F.col("doc_id") % 2 == 0, F.lit(" ")).otherwise("Berlin")
    return table(spark, sf, "documents").select("doc_id", C.is_remote(loc, F.lit(None).cast("array<string>"), F.col("text")).alias("remote"))


_CLUSTER = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{label}'" for label, p in C.CLUSTERS)


@query(f"SELECT p_partkey, CASE {_CLUSTER} END AS cluster FROM (SELECT p_partkey, lower(p_name || CASE p_size % 4 WHEN 0 THEN ' postgres' WHEN 1 THEN ' redis docker' ELSE '' END) AS t FROM part)")
def x35_cluster(spark, sf):
    tag = F.when(F.col("p_size") % 4 == 0, " postgres").when(F.col("p_size") % 4 == 1, " redis docker").otherwise("")
    return table(spark, sf, "part").select("p_partkey", C.cluster(F.col("p_name"), tag, F.lit("")).alias("cluster"))


@query(r"""SELECT page_id, list_distinct_ordered AS links, len(list_distinct_ordered) AS n_links FROM (
  SELECT page_id, coalesce((SELECT string_agg(h, ' ' ORDER BY i) FROM (SELECT h, min(i) AS i FROM (SELECT unnest(hs) AS h, unnest(range(len(hs))) AS i) GROUP BY h)), '') AS list_distinct_ordered
  FROM (SELECT page_id, regexp_extract_all(coalesce(html, ''), '(?i)<a\b[^>]*\bhref=["'']([^"'']*)["'']', 1) AS hs FROM pages))""".replace("len(list_distinct_ordered)", "length(list_distinct_ordered)"))
def s30_links(spark, sf):
    joined = F.array_join(R.hrefs(F.col("html")), " ")
    return table(spark, sf, "pages").select("page_id", joined.alias("links"), F.length(joined).cast("long").alias("n_links"))


SQL_HTML_TEXT = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
 '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'), '(?is)<nav\b[^>]*>.*?</nav\s*>', ' ', 'g'), '(?is)<footer\b[^>]*>.*?</footer\s*>', ' ', 'g'),
 '(?is)<header\b[^>]*>.*?</header\s*>', ' ', 'g'), '(?is)<noscript\b[^>]*>.*?</noscript\s*>', ' ', 'g'), '(?is)<svg\b[^>]*>.*?</svg\s*>', ' ', 'g'), '(?is)<form\b[^>]*>.*?</form\s*>', ' ', 'g'),
 '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"""


@query(f"SELECT page_id, {SQL_HTML_TEXT} AS body FROM pages")
def x26_html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.html_text(F.col("html")).alias("body"))


_GONE = "coalesce(html, '')"
for _tag in (*X.HIDDEN_TAGS, *X.MARGIN_TAGS):
    _GONE = rf"regexp_replace({_GONE}, '(?is)<{_tag}\b[^>]*>.*?</{_tag}\s*>', chr(1), 'g')"


@query(rf"""WITH a AS (SELECT page_id, html, regexp_replace(regexp_replace(regexp_replace({_GONE}, '(?s)<!--.*?-->', chr(1), 'g'), '(?i)<a\b[^>]*>', chr(2), 'g'), '(?i)</a\s*>', chr(3), 'g') AS t FROM pages),
b AS (SELECT page_id, html, string_split(regexp_replace(regexp_replace(regexp_replace(t, '(?i)<h[1-6]\b[^>]*>', chr(1) || chr(4), 'g'), '(?i)</?({X.BLOCK_TAGS})\b[^>]*>', chr(1), 'g'), '(?s)<[^>]+>', '', 'g'), chr(1)) AS bs FROM a),
c AS (SELECT page_id, html, b, i, trim(regexp_replace(translate(b, chr(2) || chr(3) || chr(4), ''), '\s+', ' ', 'g')) AS text FROM (SELECT page_id, html, unnest(bs) AS b, unnest(range(len(bs))) AS i FROM b)),
d AS (SELECT *, len(string_split(text, ' ')) AS words, length(regexp_replace(array_to_string(regexp_extract_all(b, chr(2) || '([^' || chr(3) || ']*)' || chr(3), 1), ''), '\s+', '', 'g')) / greatest(length(replace(text, ' ', '')), 1) AS share,
 row_number() OVER (PARTITION BY page_id ORDER BY i) AS n FROM c WHERE text <> ''),
e AS (SELECT page_id, min(n) AS lo, max(n) AS hi FROM d WHERE words >= {X.BLOCK_WORDS} AND share <= {X.LINK_SHARE} GROUP BY 1),
f AS (SELECT page_id, lo - CAST(EXISTS (SELECT 1 FROM d WHERE d.page_id = e.page_id AND d.n = e.lo - 1 AND contains(d.b, chr(4))) AS BIGINT) AS lo, hi FROM e),
g AS (SELECT page_id, string_agg(text, chr(10) ORDER BY n) AS main FROM d JOIN f USING (page_id) WHERE n BETWEEN lo AND hi AND share <= {X.LINK_SHARE} GROUP BY 1)
SELECT page_id, coalesce(main, {SQL_HTML_TEXT}) AS main FROM pages LEFT JOIN g USING (page_id)""")
def x26_main_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.main_text(F.col("html")).alias("main"))


@query(r"""SELECT doc_id, array_to_string(regexp_split_to_array(trim(coalesce(text, '')), '\s+')[1:40], ' ') AS budget, substr(coalesce(text, ''), 1, 20000) AS cell FROM documents""")
def x27_x44_word_budget(spark, sf):
    t = X.blank(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", X.word_budget(t, 40).alias("budget"), F.substring(t, 1, 20_000).alias("cell"))


@query(r"""SELECT doc_id, substr(array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
  lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: length(s) > 15)[1:3], ' '), 1, 500) AS lead FROM documents""")
def x28_lead_summary(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.lead_summary(F.col("text")).alias("lead"))


@query(f"SELECT doc_id, regexp_replace(text, '{X.CREDENTIAL.replace(chr(39), chr(39) * 2)}', '[REDACTED_CREDENTIAL]', 'g') AS redacted FROM documents")
def x30_k17_redact(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.redact(F.col("text")).alias("redacted"))


# the CRC of a text in DuckDB: eight shifts a byte
SQL_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c_name, ''), lambda c: ord(c)::BIGINT)), lambda v, b: list_reduce(list_prepend(xor(v, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"


@query(f"SELECT c_custkey, {SQL_CRC} % 7 AS pick FROM customer")
def x31_hash_pick(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.hash_pick(F.col("c_name"), 7).alias("pick"))


@query(r"""SELECT item_id, text LIKE '%captcha%' AS challenge, list_aggregate(list_distinct(list_filter(list_transform(string_split(coalesce(text, ''), ','), lambda x: trim(x)), lambda x: x <> '')), 'count') AS n_items FROM benchmark""")
def f4_x50_challenge_and_lists(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", C.is_challenge(F.col("text")).alias("challenge"), F.size(X.setting_list(F.col("text"))).cast("long").alias("n_items"))

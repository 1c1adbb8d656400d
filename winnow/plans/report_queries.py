"""Choices, admission, dates, flattening, parsing of landed payloads, run report and audit over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import choice as N
from ..functions import classify as C
from ..functions import temporal as T
from ..functions import text as X
from ..operators import report as RP
from ..operators import shaping as P
from ..sources import readers as R
from ..streaming import stateful as ST
from .registry import dealt, query, table
from .text_queries import SQL_HTML_TEXT, sql_any, sql_pricing, sql_role


@query(f"""WITH p AS (SELECT page_id, contains(coalesce(url, ''), 'example.net') AS forum, coalesce(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>([^<]*)</title>', 1), '') AS title, {SQL_HTML_TEXT} AS body FROM pages),
t AS (SELECT *, length(body) >= 20 AS is_full, CASE WHEN length(body) >= 20 THEN body WHEN forum THEN title ELSE '' END AS text FROM p)
SELECT page_id, is_full, substr(CASE WHEN text <> '' AND length(trim(title)) >= 20 THEN trim(title) WHEN NOT forum AND title <> '' THEN trim(title) WHEN text <> '' THEN substr(text, 1, 300) ELSE title END, 1, 500) AS summary,
 length(CASE WHEN text <> '' THEN text ELSE title END) AS chars FROM t""")
def x47_x48_news_choice(spark, sf):
    d = table(spark, sf, "pages").withColumn("title", F.regexp_extract(X.blank(F.col("html")), r"(?is)<title[^>]*>([^<]*)</title>", 1)).withColumn("forum", X.blank(F.col("url")).contains("example.net"))
    d = d.withColumn("full", N.full_text(F.col("html"), F.col("title"), F.col("forum")))
    d = d.withColumn("short", N.summary(F.col("title"), F.col("title"), F.col("full.text"), F.col("title"), F.col("forum")))
    return d.select("page_id", F.col("full.is_full").alias("is_full"), F.col("short.summary").alias("summary"), F.length(N.news_text(F.col("full.text"), F.col("short.summary"), F.col("title"))).cast("long").alias("chars"))


_LINES = r"list_filter(list_transform(regexp_split_to_array(t, '\r\n|[\n\x0b\x0c\r\x{85}\x{2028}\x{2029}]'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"


@query(f"""SELECT doc_id, substr(coalesce({_LINES}[1], 'Untitled'), 1, 200) AS title, {sql_any("lower(t)", C.REMOTE)} AS is_remote, {sql_role("t")} AS role_family, {sql_pricing("' ' || upper(t)")} AS pricing
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def x29_deterministic_extract(spark, sf):
    e = N.deterministic(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", *[e[c].alias(c) for c in ("title", "is_remote", "role_family", "pricing")])


@query("""SELECT p_partkey, coalesce(u BETWEEN 0 AND 30 AND q BETWEEN 0 AND 25 AND d BETWEEN 0 AND 5 AND NOT (u = 0 AND q = 0) AND trim(notes) <> '', FALSE) AS valid
FROM (SELECT p_partkey, p_size - 10 AS u, CASE WHEN p_type LIKE 'PROMO%' THEN NULL ELSE p_partkey % 30 END AS q, p_partkey % 7 AS d, CASE WHEN p_size = 7 THEN ' ' ELSE p_name END AS notes FROM part)""")
def f11_answer_valid(spark, sf):
    i = F.col("p_partkey")
    q = F.when(~F.col("p_type").startswith("PROMO"), i % 30)
    notes = F.when(F.col("p_size") == 7, " ").otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", N.answer_valid(F.col("p_size") - 10, q, i % 7, notes).alias("valid"))


@query("""WITH c AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_totalprice < 100000 THEN 404 WHEN o_totalprice < 200000 THEN 200 WHEN o_totalprice < 300000 THEN 429 END AS code, o_orderpriority LIKE '1%' AS archived FROM orders),
s AS (SELECT *, CASE WHEN code = 404 OR (code = 200 AND archived) THEN 'REJECTED' WHEN code = 200 THEN 'VERIFIED' ELSE 'PENDING' END AS st,
 CASE WHEN code = 404 THEN 'REPO_GONE' WHEN code = 200 AND archived THEN 'ARCHIVED' WHEN code = 200 THEN '' WHEN code IS NULL THEN 'GH_ERR' WHEN code = 429 THEN 'GH_RATE_LIMITED' ELSE 'GH_' || code END AS reason FROM c)
SELECT o_orderkey, reason, CASE WHEN st = 'VERIFIED' THEN st WHEN o_orderstatus = 'F' THEN CASE WHEN st = 'REJECTED' THEN st ELSE 'VERIFIED' END WHEN o_orderstatus = 'O' THEN 'REJECTED' ELSE st END AS status FROM s""")
def f16_f17_admission(spark, sf):
    p = F.col("o_totalprice")
    code = F.when(p < 100_000, 404).when(p < 200_000, 200).when(p < 300_000, 429)
    d = table(spark, sf, "orders").withColumn("probe", C.repo_status(code, F.col("o_orderpriority").startswith("1")))
    shard = F.when(F.col("o_orderstatus") == "F", "registry").when(F.col("o_orderstatus") == "O", "directory").otherwise("repository")
    return d.select("o_orderkey", F.col("probe.reason").alias("reason"), N.admission(shard, F.col("o_orderpriority"), F.lit("a/b"), F.col("probe.status")).alias("status"))


@query("""SELECT tier, count(*) AS n FROM (SELECT CASE WHEN lang IS NOT NULL AND length(coalesce(text, '')) > 2000 THEN 'first' WHEN coalesce(text, '') LIKE '%.%' THEN 'second' ELSE 'deterministic' END AS tier FROM documents) GROUP BY 1""")
def t10_g11_tier_fallback(spark, sf):
    t = F.col("text")
    got = N.first_tier([("first", F.col("lang"), F.col("lang").isNotNull() & (F.length(t) > 2000)), ("second", X.lead_summary(t), t.contains("."))], ("deterministic", F.lit("")))
    return table(spark, sf, "documents").select(got.alias("x")).groupBy(F.col("x.tier").alias("tier")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderdate WHEN 'O' THEN date_trunc('second', o_orderdate) ELSE date_trunc('day', o_orderdate) END AS parsed, CAST(o_orderdate AS DATE) AS url_date FROM orders""")
def x9_x11_dates(spark, sf):
    d = F.col("o_orderdate").cast("timestamp")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.unix_millis(d).cast("string"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "'Mon, 'dd MMM yyyy HH:mm:ss '+0000'"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    url = F.concat(F.lit("https://example.org/"), F.date_format(d, "yyyy/MM/dd"), F.lit("/story"))
    return dealt(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", T.parse_date(text, F.lit(None).cast("timestamp")).cast("timestamp_ntz").alias("parsed"), T.date_from_url(url).cast("date").alias("url_date"))


@query("""SELECT c_custkey, c_mktsegment AS company, 'Role ' || c_name AS title, c_name AS post_title, c_mktsegment AS post_company, CAST(c_nationkey AS VARCHAR) AS location FROM customer""")
def x21_x22_headline_parts(spark, sf):
    head = C.company_title(F.concat("c_mktsegment", F.lit(": Role "), "c_name"), F.lit(None).cast("string"), True)
    post = C.first_line_parts(F.concat_ws(" | ", "c_mktsegment", "c_name", F.col("c_nationkey").cast("string"), F.lit("full time")))
    d = table(spark, sf, "customer").select("c_custkey", head.alias("h"), post.alias("p"))
    return d.select("c_custkey", "h.company", "h.title", F.col("p.title").alias("post_title"), F.col("p.company").alias("post_company"), F.col("p.location").alias("location"))


@query("""SELECT p_partkey, round(greatest(50 - p_size, 0) / CASE WHEN p_size > 0 AND p_partkey % 9 > 0 THEN p_size / (p_partkey % 9) END) AS eta,
 CASE WHEN p_size * 10 >= 60 THEN '~' || CAST(round(p_size * 10 / 60.0) AS INT) || ' min' ELSE printf('%.1fs', CAST(p_size * 10 AS DOUBLE)) END AS took FROM part""")
def x42_x43_progress(spark, sf):
    s = F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", N.eta_minutes(s, F.lit(50), F.col("p_partkey") % 9).alias("eta"), X.duration((s * 10).cast("double")).alias("took"))


@query("""SELECT 'NEWS' AS "recordType", CAST(doc_id AS VARCHAR) AS "source.url", CASE WHEN lang = 'en' THEN source ELSE substr(coalesce(text, ''), 1, 200) || '...' END AS "content.summary" FROM documents""")
def p4_news_rows(spark, sf):
    d = table(spark, sf, "documents")
    content = F.struct(F.lit("t").alias("title"), F.lit("d").alias("published_date"), F.lit(False).alias("date_inferred"), F.when(F.col("lang") == "en", F.col("source")).alias("summary"), F.col("text").alias("full_text"))
    rec = d.select(F.lit("1.0").alias("schemaVersion"), F.lit("NEWS").alias("recordType"), F.struct(F.lit("n").alias("name"), F.col("doc_id").cast("string").alias("url")).alias("source"), content.alias("content"), F.lit("c").alias("collectedAt"))
    return P.news_rows(rec).select("recordType", "`source.url`", "`content.summary`")


@query("""SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank, CASE WHEN p_size = 1 THEN 'Developer Tools' ELSE p_type END AS category,
 coalesce(CASE WHEN p_size > 5 THEN p_size END, 0) AS github_stars, p_name || ', ' || p_brand AS key_capabilities_str, substr('2024-01-0' || p_size, 1, 10) AS last_verified_date FROM part""")
def p5_k15_ranked_rows(spark, sf):
    from ..operators.dedup import ranked

    p = ranked(table(spark, sf, "part"), "p_brand", "rank", F.desc("p_retailprice"), F.col("p_partkey")).select(
        "p_partkey", F.col("rank").cast("long").alias("rank"), F.when(F.col("p_size") != 1, F.col("p_type")).alias("category"), F.when(F.col("p_size") > 5, F.col("p_size")).alias("github_stars"),
        F.array("p_name", "p_brand").alias("key_capabilities"), F.concat(F.lit("2024-01-0"), "p_size").alias("last_verified_date"),
    )
    return P.ranked_rows(p)


_NAMES = ["customer", "orders", "part", "supplier"]


@query(f"""WITH c AS ({" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in _NAMES)})
SELECT 'r1' AS run_id, CASE WHEN bool_or(n < 1000) THEN 'shortfall' ELSE 'completed' END AS status, string_agg(name || '=' || n, ',' ORDER BY name) AS counts,
 CAST(max(CASE WHEN n < 1000 THEN 1 ELSE 0 END) + count(*) FILTER (n < 950) AS BIGINT) AS n_failures, bool_and(n >= 1000) AS passed FROM c""")
def k12_g10_e8_run_report(spark, sf):
    counts = RP.collected({n: table(spark, sf, n) for n in _NAMES})
    r = RP.report_failures(RP.run_report(counts, "r1", "completed", 1000, 61.0), _NAMES)
    pairs = F.transform(F.map_entries("collected"), lambda e: F.concat(e.key, F.lit("="), e.value.cast("string")))
    return r.select("run_id", "status", F.array_join(pairs, ",").alias("counts"), F.size("failures").cast("long").alias("n_failures"), "passed")


@query("""WITH n AS (SELECT max(ts) AS now FROM events)
SELECT 'customers' AS gate, count(*) AS total, count(*) AS good, count(*) >= 1000 AS passed FROM customer
UNION ALL SELECT 'fresh events', count(*), CAST(count(*) FILTER (ts BETWEEN now - INTERVAL 24 HOUR AND now + INTERVAL 6 MINUTE) AS BIGINT), bool_and(ts BETWEEN now - INTERVAL 24 HOUR AND now + INTERVAL 6 MINUTE) FROM events, n
UNION ALL SELECT 'priced parts', count(*), CAST(count(*) FILTER (p_retailprice > 0) AS BIGINT), count(*) FILTER (p_retailprice > 0) >= 0.95 * count(*) FROM part""")
def e9_g13_g15_audit(spark, sf):
    e = table(spark, sf, "events")
    e = e.select("ts", e.agg(F.max("ts")).scalar().alias("now"))
    gates = [RP.at_least(table(spark, sf, "customer"), "customers", 1000), RP.fresh_gate(e, "fresh events", "ts", "now"), RP.gate(table(spark, sf, "part"), "priced parts", F.col("p_retailprice") > 0, 0.95)]
    return gates[0].unionByName(gates[1]).unionByName(gates[2])


@query("""SELECT c_custkey, c_name AS slug, c_mktsegment AS company FROM customer WHERE NOT contains('https://' || lower(c_mktsegment) || '.example', 'building')""")
def s2_s19_job_board(spark, sf):
    c = table(spark, sf, "customer")
    job = F.struct(F.col("c_name").alias("slug"), F.col("c_mktsegment").alias("company_name"), F.col("c_name").alias("title"), F.lit("d").alias("description"), F.lit(True).alias("remote"),
                   F.concat(F.lit("https://"), F.lower("c_mktsegment"), F.lit(".example")).alias("url"), F.array(F.lit("t")).alias("tags"), F.array(F.lit("j")).alias("job_types"), F.lit("l").alias("location"), F.col("c_custkey").alias("created_at"))
    payload = c.select(F.to_json(F.struct(F.array(job).alias("data"))).alias("j"))
    jobs = R.jobs_of_data(payload, "j", "building")
    return jobs.select(F.col("created_at").cast("long").alias("c_custkey"), "slug", F.col("company_name").alias("company"))


@query("""SELECT p_name AS name, 'https://x.example/' || p_partkey AS url FROM part""")
def s16_markdown_bullets(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.lit("# list\n\n- ["), "p_name", F.lit("](https://x.example/"), "p_partkey", F.lit(") - a thing\n")).alias("md"))
    return R.markdown_bullets(p, "md").select("name", "url")


@query("""WITH RECURSIVE e AS MATERIALIZED (SELECT event_id AS seq, user_id AS k, epoch_us(ts) / 1e6 AS t, CASE WHEN event_type = 'error' THEN 864000.0 ELSE 0.0 END AS cool, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
s AS (SELECT seq, k, t, rn, CAST(0 AS BIGINT) AS token, CAST(1 AS BIGINT) AS next, [CASE WHEN cool > 0 THEN t + cool ELSE CAST(-1e18 AS DOUBLE) END, CAST(-1e18 AS DOUBLE), CAST(-1e18 AS DOUBLE)] AS until FROM e WHERE rn = 1
 UNION ALL SELECT seq, k, t, rn, coalesce(ready, lowest), CASE WHEN ready IS NULL THEN next ELSE (ready + 1) % 3 END,
  list_transform(range(3), lambda j: CASE WHEN j = coalesce(ready, lowest) AND cool > 0 THEN t + greatest(cool, 1.0) ELSE until[j + 1] END)
 FROM (SELECT e.seq, e.k, e.t, e.rn, CAST(e.cool AS DOUBLE) AS cool, s.next, s.until, list_filter(list_transform(range(3), lambda i: (s.next + i) % 3), lambda q: s.until[q + 1] <= e.t)[1] AS ready,
   CAST(list_position(s.until, list_min(s.until)) - 1 AS BIGINT) AS lowest FROM s JOIN e ON e.k = s.k AND e.rn = s.rn + 1))
SELECT seq, k AS pool, token FROM s""")
def t8_token_rotation(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ST.rotated(e.select(F.col("user_id").alias("pool"), F.col("event_id").alias("seq"), (F.unix_micros("ts") / 1e6).alias("t"), F.when(F.col("event_type") == "error", 864_000.0).otherwise(0.0).alias("cooldown")), 3)

"""Dedup, resolution, scoring, graph, history and report queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import temporal as T
from ..functions.fuzzy import indel_ratio, token_sorted
from ..functions.text import blank
from ..operators import dedup as D
from ..operators import graph as G
from ..operators import history as H
from ..operators import resolve as RS
from ..operators import scoring as S
from ..operators import shaping as P
from ..streaming import stateful as ST
from .registry import query, table
from .text_queries import sql_name_key


def _sql_sorted(c: str) -> str:
    return rf"array_to_string(list_sort(list_filter(regexp_split_to_array({c}, '\s+'), lambda t: t <> '')), ' ')"


def _sql_ratio(a: str, b: str) -> str:
    """Token-sort ratio of two sorted texts of at most 61 characters in DuckDB: a table row in the bits of a long."""
    full = f"((1::BIGINT << length({b})) - 1)"
    bits = f"list_sum(list_transform(range(length({b})), lambda j: CASE WHEN substr({b}, j + 1, 1) = c THEN 1::BIGINT << j ELSE 0 END))::BIGINT"
    masks = f"list_transform(string_split({a}, ''), lambda c: {bits})"
    row = f"list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v & xor(m, {full}))) & {full})"
    return f"200.0 * (length({b}) - bit_count({row})) / (length({a}) + length({b}))"


def _now(events):
    """The latest event time as a scalar subquery: a fixed clock for the gates."""
    return events.agg(F.max("ts")).scalar()


@query("""WITH n AS (SELECT max(ts) AS now FROM events)
SELECT event_id, event_type, user_id FROM events, n WHERE ts BETWEEN now - INTERVAL 24 HOUR AND now + INTERVAL 10 MINUTE""")
def f2_t7_freshness_gate(spark, sf):
    e = table(spark, sf, "events")
    return e.where(T.is_fresh(F.col("ts"), _now(e))).select("event_id", "event_type", "user_id")


@query("""WITH n AS (SELECT max(ts) AS now FROM events)
SELECT event_type, count(*) AS total, CAST(count(*) FILTER (ts >= now - INTERVAL 24 HOUR) AS BIGINT) AS fresh,
 round(avg(CASE WHEN ts >= now - INTERVAL 24 HOUR THEN 1.0 ELSE 0.0 END), 6) AS share FROM events, n GROUP BY event_type""")
def g13_g4_freshness_compliance(spark, sf):
    e = table(spark, sf, "events")
    d = e.withColumn("f", T.is_fresh(F.col("ts"), _now(e)))
    return d.groupBy("event_type").agg(F.count("*").alias("total"), F.count_if("f").alias("fresh"), F.round(F.avg(F.col("f").cast("double")), 6).alias("share"))


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(user_id || ':' || event_type)) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def w1_first_wins(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.concat_ws(":", "user_id", "event_type"))
    return D.first_wins(e, F.col("k"), F.col("ts"), F.col("event_id")).select("event_id", "user_id", "event_type")


@query("""SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1
ORDER BY o_orderdate, o_orderkey LIMIT 50""")
def l1_quota(spark, sf):
    o = table(spark, sf, "orders")
    first = D.first_wins(o, F.col("o_custkey").cast("string"), F.col("o_orderdate"), F.col("o_orderkey"))
    return D.quota(first, 50, F.col("o_orderdate"), F.col("o_orderkey")).select("o_orderkey", "o_totalprice")


@query("""WITH u AS (SELECT 0 AS tier, o_orderkey AS k, o_orderkey AS pos FROM orders WHERE o_orderstatus = 'F'
 UNION ALL SELECT 1, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END, l_orderkey * 10 + l_linenumber FROM lineitem),
r AS (SELECT k, min(tier * 1000000000000 + pos) AS best FROM u WHERE k IS NOT NULL GROUP BY k)
SELECT k, best % 1000000000000 AS pos, CAST(best // 1000000000000 AS INT) AS tier FROM r UNION ALL SELECT k, pos, tier FROM u WHERE k IS NULL""")
def u1_u2_priority_union(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").alias("pos"))
    li = table(spark, sf, "lineitem").select(F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    # rows of one (key, position) are equal, so ties do not show
    return D.priority_union([o, li], "k", "pos").select("k", "pos", "tier")


@query("SELECT s_suppkey AS k FROM supplier")
def u3_s20_failover_union(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal > 1e12").select(F.col("c_custkey").alias("k"))
    return D.failover_union(c, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")))


_DAYS = "SELECT event_type AS source, CAST(ts AS DATE) AS run, count(*) FILTER (value > 480) AS n FROM events GROUP BY ALL"


@query(f"""WITH r AS ({_DAYS}), k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY run DESC) AS age FROM r QUALIFY age <= 5)
SELECT source, string_agg(CAST(n AS VARCHAR), ',' ORDER BY run) AS history, max_by(n, run) AS latest,
 coalesce(min(CASE WHEN n <> 0 THEN age END) - 1, count(*)) AS trailing_zeros, coalesce(min(CASE WHEN n <> 0 THEN age END) - 1, count(*)) >= 2 AS stale FROM k GROUP BY source""")
def w4_w5_w6_source_health(spark, sf):
    runs = table(spark, sf, "events").groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("run")).agg(F.count_if(F.col("value") > 480).alias("n"))
    return H.source_health(runs)


@query("""SELECT n_name AS source, coalesce(n, 0) AS n FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 9500 GROUP BY 1) ON n_nationkey = c_nationkey""")
def g3_counts_with_zero(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("source"))
    rows = table(spark, sf, "customer").where("c_acctbal > 9500").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("source")
    return H.counts_with_zero(rows, n.select("source"), "source")


@query("""WITH old AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-05')
SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND (event_type <> 'view' OR user_id NOT IN (SELECT user_id FROM old))""")
def j6_j7_j8_t5_novelty(spark, sf):
    e = table(spark, sf, "events")
    cut = F.lit("2024-01-05").cast("timestamp_ntz")
    return H.novel(e.where(F.col("ts") >= cut), e.where(F.col("ts") < cut), "user_id", F.col("event_type") == "view").select("event_id", "user_id")


@query("SELECT DISTINCT user_id FROM events WHERE event_type IN ('purchase', 'error')")
def u4_key_union(spark, sf):
    e = table(spark, sf, "events")
    return H.key_union(e.where("event_type = 'purchase'"), e.where("event_type = 'error'"), key="user_id")


@query("""SELECT p_brand, p_name, p_retailprice, p_type, sources FROM (
 SELECT p_brand, max_by(p_name, (p_retailprice, p_size, -p_partkey)) AS p_name, max(p_retailprice) AS p_retailprice,
  max_by(p_type, (p_retailprice, p_size, -p_partkey)) FILTER (p_size % 3 <> 0) AS p_type,
  (SELECT string_agg(DISTINCT q.p_type, ', ' ORDER BY q.p_type) FROM part q WHERE q.p_brand = part.p_brand) AS sources FROM part GROUP BY p_brand)""")
def g5_canonical_merge(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_name", "p_retailprice", "p_size", "p_partkey", F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("p_type"), F.col("p_type").alias("sources"))
    return D.canonical_merge(p, "p_brand", "p_retailprice", "p_size", "p_partkey", ["p_type"], "sources").select("p_brand", "p_name", "p_retailprice", "p_type", "sources")


@query("""SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_size DESC, p_partkey) AS rnk FROM part
QUALIFY rnk <= 4 OR p_type LIKE 'PROMO%'""")
def w8_l5_rank(spark, sf):
    o = [F.desc("p_retailprice"), F.desc("p_size"), F.col("p_partkey")]
    p = D.ranked(table(spark, sf, "part"), "p_brand", "rnk", *o)
    promo = F.col("p_type").startswith("PROMO")
    return p.where((F.col("rnk") <= 4) | promo).select("p_partkey", "p_brand", F.col("rnk").cast("long").alias("rnk"))


@query("""SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part WHERE p_type NOT LIKE 'PROMO%') WHERE rn <= 4
UNION ALL SELECT p_partkey, p_brand FROM part WHERE p_type LIKE 'PROMO%'""")
def w7_saturation_cap(spark, sf):
    return D.cap_per_group(table(spark, sf, "part"), "p_brand", 4, F.desc("p_retailprice"), F.col("p_partkey"), exempt=F.col("p_type").startswith("PROMO")).select("p_partkey", "p_brand")


@query(f"""WITH n AS (SELECT DISTINCT p_name, {_sql_sorted("p_name")} AS s, {_sql_sorted("'goldenrod lavender'")} AS t FROM part)
SELECT p_name, round({_sql_ratio("s", "t")}, 6) AS score FROM n WHERE {_sql_ratio("s", "t")} >= 30""")
def x5_l4_token_sort(spark, sf):
    names = table(spark, sf, "part").select("p_name").distinct()
    target = F.lit("goldenrod lavender")
    d = names.withColumn("score", F.round(indel_ratio(token_sorted(F.col("p_name")), token_sorted(target)), 6))
    return d.where(F.col("score") >= 30).select("p_name", "score")


@query(f"""WITH p AS (SELECT p_name AS raw, canonical, {_sql_ratio("s", "t")} AS score
 FROM (SELECT DISTINCT p_name, {_sql_sorted("p_name")} AS s FROM part), (SELECT DISTINCT lower(n_name) AS canonical, {_sql_sorted("lower(n_name)")} AS t FROM nation))
SELECT raw, canonical, round(score, 6) AS score, row_number() OVER (PARTITION BY raw ORDER BY score DESC, canonical) AS rank FROM p QUALIFY rank <= 3""")
def j4_w9_fuzzy_top3(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_name").alias("raw")).distinct()
    reg = table(spark, sf, "nation").select(F.lower("n_name").alias("canonical"))
    return RS.fuzzy_candidates(names, reg, 3).select("raw", "canonical", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


_SUPPLIER_NAMES = """SELECT s_name AS raw, CASE WHEN s_suppkey % 5 = 0 THEN 'd' || s_suppkey || '.com' END AS domain FROM supplier
 UNION ALL VALUES ('OpenAI, Inc.', NULL), ('mistralai', NULL), ('Anthropik', NULL), (' ', NULL), ('Zeta Robotics', NULL)"""


@query(f"""WITH n AS ({_SUPPLIER_NAMES}),
reg AS (SELECT * FROM (VALUES ('OpenAI'), ('Mistral AI'), ('Anthropic'), ('Supplier#000000001')) v(canonical)),
al AS (SELECT * FROM (VALUES ('mistralai', 'Mistral AI'), ('openai inc', 'OpenAI')) v(alias, canonical)),
keyed AS (SELECT raw, domain, lower(trim(raw)) AS a, {sql_name_key("raw")} AS k, {_sql_sorted("trim(raw)")} AS s FROM n),
rk AS (SELECT {sql_name_key("canonical")} AS k, min(canonical) AS canonical FROM reg GROUP BY 1),
f AS (SELECT s, max(score) AS score, min_by(canonical, (-score, canonical)) AS canonical FROM
 (SELECT s, canonical, CASE WHEN s = '' THEN 0 ELSE {_sql_ratio("s", "t")} END AS score FROM (SELECT DISTINCT s FROM keyed), (SELECT canonical, {_sql_sorted("canonical")} AS t FROM reg)) GROUP BY s)
SELECT raw, CASE WHEN trim(raw) = '' THEN 'Unknown' WHEN domain = 'd5.com' THEN 'OpenAI' WHEN al.canonical IS NOT NULL THEN al.canonical
  WHEN rk.canonical IS NOT NULL THEN rk.canonical WHEN f.score >= 90 THEN f.canonical ELSE trim(raw) END AS canonical,
 CASE WHEN trim(raw) = '' THEN 'MANUAL_OVERRIDE' WHEN domain = 'd5.com' THEN 'NORMALIZATION_EXACT' WHEN al.canonical IS NOT NULL THEN 'ALIAS_MATCH'
  WHEN rk.canonical IS NOT NULL THEN 'NORMALIZATION_EXACT' WHEN f.score >= 90 THEN 'FUZZY_TOKEN_SORT' ELSE 'NEW_ENTITY' END AS method,
 CAST(CASE WHEN trim(raw) = '' THEN 0.0 WHEN domain = 'd5.com' OR al.canonical IS NOT NULL OR rk.canonical IS NOT NULL THEN 1.0 WHEN f.score >= 90 THEN round(f.score / 100, 2) ELSE 0.5 END AS DOUBLE) AS confidence
FROM keyed LEFT JOIN al ON alias = a LEFT JOIN rk ON rk.k = keyed.k AND rk.k <> '' LEFT JOIN f ON f.s = keyed.s""")
def x6_j1_j2_j3_resolve(spark, sf):
    names = table(spark, sf, "supplier").select(F.col("s_name").alias("raw"), F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("d"), "s_suppkey", F.lit(".com"))).alias("domain"))
    names = names.unionByName(spark.createDataFrame([("OpenAI, Inc.", None), ("mistralai", None), ("Anthropik", None), (" ", None), ("Zeta Robotics", None)], "raw string, domain string"))
    registry = spark.createDataFrame([("OpenAI",), ("Mistral AI",), ("Anthropic",), ("Supplier#000000001",)], "canonical string")
    aliases = spark.createDataFrame([("mistralai", "Mistral AI"), ("openai inc", "OpenAI")], "alias string, canonical string")
    domains = spark.createDataFrame([("d5.com", "OpenAI")], "domain string, canonical string")
    return RS.resolve(names, registry, aliases, domains).select("raw", "canonical", "method", "confidence")


@query(f"""WITH RECURSIVE t AS (SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type) AS title, {_sql_sorted("concat_ws(' ', p_name, p_brand, p_type)")} AS s FROM part),
o AS MATERIALIZED (SELECT s, id, row_number() OVER (ORDER BY id) AS rn FROM (SELECT s, min(p_partkey) AS id FROM t GROUP BY s)),
c AS MATERIALIZED (SELECT a.rn AS ra, b.rn AS rb, a.s AS s, b.s AS t FROM o a JOIN o b ON a.rn < b.rn AND 10 * levenshtein(a.s, b.s) <= length(a.s) + length(b.s)),
p AS MATERIALIZED (SELECT rb AS rn, list(ra) AS near FROM c WHERE {_sql_ratio("s", "t")} >= 90 GROUP BY 1),
k AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS kept
 UNION ALL SELECT o.rn, CASE WHEN list_has_any(coalesce(near, CAST([] AS BIGINT[])), kept) THEN kept ELSE list_append(kept, o.rn) END FROM k JOIN o ON o.rn = k.rn + 1 LEFT JOIN p ON p.rn = o.rn)
SELECT p_partkey, title FROM t WHERE p_partkey IN (SELECT id FROM o WHERE rn IN (SELECT unnest(kept) FROM k WHERE rn = (SELECT max(rn) FROM o)))""")
def w2_fuzzy_first_wins(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("title"))
    return D.fuzzy_first_wins(t, "p_partkey", "title", 90.0).select("p_partkey", "title")


@query("""WITH n AS (SELECT max(o_orderdate) AS now FROM orders), c AS (
 SELECT o_custkey, date_diff('second', max(o_orderdate), any_value(now)) / 86400.0 AS days, count(*) AS stars FROM orders, n GROUP BY 1),
f AS (SELECT o_custkey, CASE WHEN days <= 30 THEN 15.0 WHEN days <= 90 THEN 10.0 WHEN days <= 180 THEN 5.0 ELSE 0.0 END AS activity,
 CASE WHEN stars >= 2000 THEN 10.0 WHEN stars >= 500 THEN 8.0 WHEN stars >= 100 THEN 6.0 WHEN stars >= 10 THEN 4.0 WHEN stars >= 1 THEN 2.0 ELSE 0.0 END AS adoption,
 CASE WHEN days <= 30 THEN 5.0 WHEN days <= 90 THEN 4.0 WHEN days <= 180 THEN 3.0 WHEN days <= 365 THEN 2.0 ELSE 0.0 END AS recency FROM c)
SELECT o_custkey, CAST(activity AS DOUBLE) AS activity, CAST(adoption AS DOUBLE) AS adoption, CAST(recency AS DOUBLE) AS recency,
 CAST(activity + adoption + recency + 10.0 AS DOUBLE) AS total FROM f""")
def x36_x40_scores(spark, sf):
    o = table(spark, sf, "orders")
    c = o.groupBy("o_custkey").agg(F.max("o_orderdate").cast("timestamp").alias("last"), F.count("*").alias("stars"))
    days = S.days_since(F.col("last"), o.agg(F.max("o_orderdate").cast("timestamp")).scalar())
    c = c.select("o_custkey", S.activity(days, F.lit(False)).alias("activity"), S.adoption(F.col("stars")).alias("adoption"), S.recency(days).alias("recency"))
    fixed = S.docs(F.lit("u"), F.lit(True)) + S.reliability(F.lit(True), F.lit(False))
    return c.withColumn("total", S.total(F.col("activity"), F.col("adoption"), F.col("recency"), fixed))


@query("""SELECT CASE WHEN s >= 90 THEN '90-100' WHEN s >= 80 THEN '80-89' WHEN s >= 70 THEN '70-79' ELSE '<70' END AS bracket, count(*) AS n,
 round(count(*) / sum(count(*)) OVER (), 6) AS share, CAST(count(*) FILTER (s >= 65) AS BIGINT) AS selected FROM (SELECT (c_acctbal + 1000) / 110 AS s FROM customer) GROUP BY 1""")
def g8_g6_f13_brackets(spark, sf):
    from pyspark.sql import Window

    d = table(spark, sf, "customer").withColumn("s", (F.col("c_acctbal") + 1000) / 110)
    g = d.groupBy(S.bracket(F.col("s")).alias("bracket")).agg(F.count("*").alias("n"), F.count_if(S.selected(F.lit("SERVER"), F.col("s"))).alias("selected"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 6))  # four rows


_NODES = """SELECT 'Startup:' || s_name AS id, 'Startup' AS node_type FROM supplier UNION SELECT 'Product:' || p_name, 'Product' FROM part"""
_EDGES = """SELECT DISTINCT 'Startup:' || s_name AS src, 'Product:' || p_name AS dst, 'SHIPPED' AS relationship FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""


def _graph(spark, sf):
    s, p, li = table(spark, sf, "supplier"), table(spark, sf, "part"), table(spark, sf, "lineitem")
    n = G.nodes([(s.withColumn("seq", F.col("s_suppkey")), "s_name", "s_name", "Startup", False), (p.withColumn("seq", F.col("p_partkey")), "p_name", "p_name", "Product", True)])
    pairs = li.select("l_suppkey", "l_partkey", "l_orderkey").join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    e = G.edges([(pairs.select(F.col("s_name").alias("src"), F.col("p_name").alias("dst"), F.col("l_orderkey").alias("seq")), "Startup", "Product", "SHIPPED")])
    return n, e


@query(_EDGES)
def e6_u6_graph_edges(spark, sf):
    return _graph(spark, sf)[1]


@query(f"""WITH n AS ({_NODES}), e AS ({_EDGES}), d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id)
SELECT n.id, node_type, coalesce(degree, 0) AS degree FROM n LEFT JOIN d USING (id)""")
def e7_g2_degree(spark, sf):
    return G.degree(*_graph(spark, sf))


@query(f"SELECT node_type, count(*) AS n FROM ({_NODES}) GROUP BY 1")
def g1_nodes_by_type(spark, sf):
    return _graph(spark, sf)[0].groupBy("node_type").agg(F.count("*").alias("n"))


@query(f"""WITH e AS ({_EDGES}), d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id)
SELECT id, degree FROM d ORDER BY degree DESC, id LIMIT 5""")
def l3_top_hubs(spark, sf):
    n, e = _graph(spark, sf)
    return G.degree(n, e).orderBy(F.desc("degree"), "id").limit(5).select("id", "degree")


_WORDS = "SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part WHERE length(split_part(p_name, ' ', 1)) >= 3"


@query(f"""WITH w AS ({_WORDS}), m AS (SELECT conv_id * 1000 + turn AS id, name FROM conversations JOIN w ON contains(lower(text), lower(name)))
SELECT id, name, 'MENTIONED_IN' AS relationship FROM m UNION ALL
SELECT conv_id * 1000 + turn, role, 'PUBLISHED' FROM conversations WHERE conv_id * 1000 + turn NOT IN (SELECT id FROM m)""")
def j11_j12_mentions(spark, sf):
    c = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("title"), "role")
    m = RS.mentions(c.select("id", "title"), table(spark, sf, "part").select(F.substring_index("p_name", " ", 1).alias("name")).distinct())
    rest = c.join(m.select("id").distinct(), "id", "left_anti").select("id", F.col("role").alias("name"), F.lit("PUBLISHED").alias("relationship"))
    return m.withColumn("relationship", F.lit("MENTIONED_IN")).unionByName(rest)


@query("""SELECT o_orderkey, coalesce(c_mktsegment, 'N/A') AS segment, CASE WHEN c_acctbal > 9000 THEN c_acctbal ELSE o_totalprice END AS price
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment <> 'BUILDING'""")
def j5_j9_j16_enrich(spark, sf):
    """Segments looked up by name, prices that a better source overrides."""
    c = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("who"), "c_mktsegment")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("who"), F.col("o_totalprice").alias("price"))
    fresh = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") > 9000, F.col("c_acctbal")).alias("price"))
    d = P.overridden(P.looked_up(o, c, "who", "c_mktsegment", "segment"), fresh, "o_custkey", ["price"])
    return d.select("o_orderkey", P.or_na(F.col("segment")).alias("segment"), "price")


@query("""WITH u AS (SELECT 0 AS pri, s_nationkey AS k, s_suppkey AS id FROM supplier UNION ALL SELECT 1, c_nationkey, c_custkey FROM customer)
SELECT k, pri, id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pri, id) AS rn FROM u) WHERE rn = 1 AND k NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def j13_u5_rejected_log(spark, sf):
    a = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("id"))
    b = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("id"))
    curated = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("k"))
    return D.priority_union([a, b], "k", "id").join(curated, "k", "left_anti").select("k", F.col("tier").alias("pri"), "id")


@query("""SELECT kind, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT count(*) FROM customer), 6) AS share FROM
 (SELECT unnest(['BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE', 'NONE']) AS kind) LEFT JOIN (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) ON kind = c_mktsegment""")
def g7_enum_distribution(spark, sf):
    kinds = ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE", "NONE"]
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("kind"))
    return H.distribution(c, "kind", kinds).select("kind", "n", F.round("share", 6).alias("share"))


@query("""SELECT count(*) AS rows_n, bool_or(n < 10) AS shortfall, CAST(count(*) FILTER (n = 0) AS BIGINT) AS zero_rows, count(*) FILTER (n >= 10) / count(*) >= 0.95 AS passes
FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)""")
def g10_g14_e8_run_gate(spark, sf):
    n = table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))
    return n.agg(F.count("*").alias("rows_n"), F.bool_or(F.col("n") < 10).alias("shortfall"), F.count_if(F.col("n") == 0).alias("zero_rows"), (F.count_if(F.col("n") >= 10) / F.count("*") >= 0.95).alias("passes"))


@query("""SELECT source, count(*) AS n, CAST(count(*) FILTER (length(coalesce(text, '')) >= 200) AS BIGINT) AS full_text FROM documents GROUP BY source""")
def g12_g11_g15_by_source(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.length(blank(F.col("text"))) >= 200).alias("full_text"))


@query("""SELECT token, seq, max(ts - i * 2.5) OVER (PARTITION BY token ORDER BY seq ROWS UNBOUNDED PRECEDING) + i * 2.5 AS slot FROM (
 SELECT user_id AS token, event_id AS seq, CAST(value AS DOUBLE) AS ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events)""")
def w10_pacing(spark, sf):
    c = table(spark, sf, "events").select(F.col("user_id").alias("token"), F.col("event_id").alias("seq"), F.col("value").alias("ts"))
    return H.pacing_slots(c, 2.5).select("token", "seq", "slot")


_EVENT_RUN = "SELECT event_id AS seq, user_id AS key, epoch_us(ts) / 1e6 AS t, event_type = 'error' AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events"


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({_EVENT_RUN}),
s AS (SELECT seq, key, t, rn, TRUE AS granted, [t] AS held FROM e WHERE rn = 1
 UNION ALL SELECT e.seq, e.key, e.t, e.rn, len(list_filter(s.held, lambda h: e.t - h < 86400)) < 3,
  CASE WHEN len(list_filter(s.held, lambda h: e.t - h < 86400)) < 3 THEN list_append(list_filter(s.held, lambda h: e.t - h < 86400), e.t) ELSE list_filter(s.held, lambda h: e.t - h < 86400) END
 FROM s JOIN e ON e.key = s.key AND e.rn = s.rn + 1)
SELECT seq, key, granted FROM s""")
def t1_t9_limiter(spark, sf):
    return ST.limited(table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "event_id", 3, 86_400)


_BLOCKS = "list_append(list_filter(s.blocks, lambda h: e.t - h <= 432000), e.t)"


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({_EVENT_RUN}),
s AS (SELECT seq, key, t, rn, 'pass' AS state, CAST(0 AS DOUBLE) AS until, CASE WHEN b THEN [t] ELSE CAST([] AS DOUBLE[]) END AS blocks FROM e WHERE rn = 1
 UNION ALL SELECT e.seq, e.key, e.t, e.rn,
  CASE WHEN e.t < s.until THEN 'open' WHEN e.b AND len({_BLOCKS}) >= 2 THEN 'trip' ELSE 'pass' END,
  CASE WHEN e.t >= s.until AND e.b AND len({_BLOCKS}) >= 2 THEN e.t + 172800 ELSE s.until END,
  CASE WHEN e.t < s.until THEN s.blocks WHEN NOT e.b OR len({_BLOCKS}) >= 2 THEN CAST([] AS DOUBLE[]) ELSE {_BLOCKS} END
 FROM s JOIN e ON e.key = s.key AND e.rn = s.rn + 1)
SELECT seq, key, state FROM s""")
def t3_t4_breaker(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("b", F.col("event_type") == "error")
    return ST.broken(e, "user_id", "ts", "event_id", "b", 2, 5 * 86_400, 2 * 86_400)


@query("""SELECT 'c_custkey' AS "column", 12 AS width UNION ALL SELECT 'c_name', least(50, greatest(12, greatest(max(length(c_name)), 6) + 3)) FROM customer
UNION ALL SELECT 'c_mktsegment', least(50, greatest(12, greatest(max(length(c_mktsegment)), 12) + 3)) FROM customer""")
def k5_column_widths(spark, sf):
    return P.column_widths(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@query("""SELECT '1.0' AS "schemaVersion", 'STARTUP' AS "recordType", s_name AS "content.entityName", coalesce(CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END, 'N/A') AS "content.data.employeeCount" FROM supplier""")
def p1_p8_k3_flatten(spark, sf):
    s = table(spark, sf, "supplier")
    data = F.struct(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey").cast("int")).alias("employeeCount"))
    rec = s.select(
        F.lit("1.0").alias("schemaVersion"), F.lit("STARTUP").alias("recordType"), F.struct(F.lit("x").alias("name"), F.lit("u").alias("url")).alias("source"),
        F.struct(F.col("s_name").alias("entityName"), data.alias("data")).alias("content"), F.lit("2024-01-01").alias("collectedAt"),
    )
    return P.startup_rows(rec).select("schemaVersion", "recordType", "`content.entityName`", "`content.data.employeeCount`")

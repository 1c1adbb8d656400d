"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import annulus, decontam, langid, lexical, line_dedup, packing, quality_rules, simhash, suffix_dedup, token_counts, url_filter, vector_tree, warc

BPE_FILE = "byte_bpe_50k.json"


def tokenizer_path(name: str = BPE_FILE) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    kept = line_dedup.with_kept_text(docs, line_dedup.line_bitmaps(docs, min_chars=40, min_docs=5))
    t = F.coalesce("text", F.lit(""))
    n_lines = (F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"))) + 1).cast("long")
    return kept.select("doc_id", n_lines.alias("n_lines"), "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path(), 512).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_rules.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = suffix_dedup.without_repeats(docs, length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(packing.token_sizes(_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path()))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.url_verdicts(pages, url_filter.feed_list(pages)).select("page_id", "host", "path", "rule", "verdict")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annulus.cluster(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=8, rounds=10, seed=3)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tree.nearest(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "item_id", "text"), k=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_line_dedup, op2_token_counts, op3_quality_rules, op4_suffix_dedup, op5_simhash, op6_language_id, op7_packing, op8_warc,
        op9_decontamination, op10_url_filter, op11_centroid_clustering, op12_nearest_neighbours, op13_ranked_search,
    )
    return {f.__name__: f for f in found}


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1_SQL = f"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), x AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM l
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UP}', '{_LOW}') AS key FROM x
), g AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), d AS (
  SELECT k.doc_id, k.pos, k.line, g.key IS NOT NULL AND k.doc_id <> g.keeper AS gone FROM k LEFT JOIN g USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

_STOP = ", ".join(f"'{w}'" for w in sorted({w for words in quality_rules.STOP_WORDS for w in words.split()}))
_RULES = " AND ".join(
    f"coalesce({' AND '.join(([f'{m} >= {lo}'] if lo is not None else []) + ([f'{m} <= {hi}'] if hi is not None else []))}, true)"
    for _, m, lo, hi in quality_rules.THRESHOLDS
)

OP3_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), w AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS win,
         unnest(range(1, len(ws) - 1)) AS i
  FROM t
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
         CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(ws, lambda w: regexp_replace(lower(w), '[^\p{{L}}]+$', '') IN ({_STOP}))) AS n_stop,
         (length(text) - length(replace(text, '!!', ''))) // 2 AS n_bang
  FROM t LEFT JOIN c USING (doc_id)
), q AS (
  SELECT *, word_chars / nullif(n_words, 0) AS mean_word_chars, n_symbols / nullif(word_chars, 0) AS symbol_ratio,
         n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio, n_stop / nullif(n_words, 0) AS stop_word_ratio,
         n_bang / nullif(n_words, 0) AS bang_ratio, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_RULES} AS kept
FROM q
"""

OP8_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS n, max(page_id) OVER (PARTITION BY body) AS leader,
         array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  CAST(((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS digest
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = leader THEN NULL ELSE leader END AS refers_to
FROM d
"""

OP9_SQL = rf"""
WITH i AS (
  SELECT DISTINCT item_id, ws, least(13, len(ws)) AS w FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark) WHERE len(ws) > 0
), iw AS (
  SELECT DISTINCT item_id, w, ws[j:j + w - 1] AS win FROM (SELECT *, unnest(range(1, len(ws) - w + 2)) AS j FROM i)
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), dw AS (
  SELECT doc_id, p, w, ws[p:p + w - 1] AS win
  FROM (SELECT doc_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS p FROM d, (SELECT DISTINCT w FROM i))
), hit AS (
  SELECT doc_id, p, w, item_id FROM dw JOIN iw USING (w, win)
), a AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + w)) AS q FROM hit) GROUP BY doc_id
), b AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)
"""

OP10_SQL = rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UP}', '{_LOW}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '')
                 || regexp_replace(regexp_replace(path, '/+$', ''), '\.html$', '') END AS canonical
  FROM p
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM c
), l AS (
  SELECT DISTINCT canonical FROM c WHERE contains(url, 'utm_source=feed') AND canonical IS NOT NULL
)
SELECT page_id, host, path, rule, CASE rule
  WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block'
  ELSE CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END END AS verdict
FROM r LEFT JOIN l USING (canonical)
"""


_DIMS, _ROUNDS = 64, 10


def _assign(centroids: str) -> str:
    return f"""SELECT vec_id, k, dist FROM (
    SELECT vec_id, k, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS dist FROM x JOIN {centroids} c USING (d) GROUP BY vec_id, k
  ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, k) = 1"""


OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS vs FROM embeddings
  WHERE len(embedding) = {_DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {_DIMS}
), x AS MATERIALIZED (
  SELECT vec_id, unnest(vs) AS v, unnest(range({_DIMS})) AS d FROM kept
), s AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS k FROM kept
), c0 AS MATERIALIZED (
  SELECT k, d, v FROM s JOIN x USING (vec_id) WHERE k < 8
), """ + ", ".join(f"""a{i} AS MATERIALIZED (
  {_assign(f"c{i}")}
), m{i} AS (
  SELECT k, d, sum(v) AS t, count(*) AS n FROM a{i} JOIN x USING (vec_id) GROUP BY k, d
), c{i + 1} AS MATERIALIZED (
  SELECT k, d, CASE WHEN n IS NULL THEN v ELSE CAST((t - ((t % n) + n) % n) // n AS BIGINT) END AS v FROM c{i} LEFT JOIN m{i} USING (k, d)
)""" for i in range(_ROUNDS)) + f""", f AS MATERIALIZED (
  {_assign(f"c{_ROUNDS}")}
), h AS (
  SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS h FROM c{_ROUNDS} GROUP BY k
)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM f JOIN h USING (k)
"""

OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents
), dn AS (
  SELECT r, doc_id, len(ws) AS n FROM d WHERE len(ws) > 0
), s AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM dn
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY r, term
), i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), it AS (
  SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(ws) AS term FROM i) GROUP BY q, item_id, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, docs
), sc AS (
  SELECT q, item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM it JOIN tf USING (term) JOIN w USING (term) JOIN dn USING (r), s GROUP BY q, item_id, doc_id, r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0
) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1_SQL,
        "op3_quality_rules": OP3_SQL,
        "op8_warc": OP8_SQL,
        "op9_decontamination": OP9_SQL,
        "op10_url_filter": OP10_SQL,
        "op11_centroid_clustering": OP11_SQL,
        "op13_ranked_search": OP13_SQL,
    }

"""URL verdicts: host and path rules first, then a list of canonical URLs.

The list may be large. A blocked Bloom filter over it (512-bit blocks, one block
a URL) is built by a distributed aggregate and sent out with a fixed bound on its
size; URLs that it passes go to an exact hash join, which removes its false
positives. A fuller list only makes the filter pass more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, body, set_aside, stored

# Fixed values: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: at most so many 512-bit blocks (64 bytes of bits each, 4 MB in all); a list beyond about 40 URLs a block only adds false positives
MAX_BLOCKS = 1 << 16
PROBES = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(body(url), "(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(body(url), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_url(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, and the path without trailing slashes and ``.html``; null without a host."""
    bare = F.regexp_replace(host, "^(www|m)\\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(F.regexp_replace(path, "/+$", ""), "\\.html$", "")))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The fitting rule that is longest, as (rule, verdict); null if none fits. Ties keep the order of the table."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _slot(url: Column, blocks: int) -> tuple[Column, Column]:
    """The URL's block, and its bits in that block as eight 64-bit words: one bit in each word."""
    h, g = F.xxhash64(url), F.xxhash64(F.lit(7), url)
    words = F.array(*[F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(g, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)])
    return F.pmod(h, F.lit(blocks)), words


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): the filter, one row for each block that is not empty; at most ``blocks`` rows."""
    block, words = _slot(F.col("canonical"), blocks)
    rows = listed.select(block.alias("block"), words.alias("w"))
    return rows.groupBy("block").agg(*[F.bit_or(F.col("w")[i]).alias(f"b{i}") for i in range(PROBES)]).select(
        "block", F.array(*[f"b{i}" for i in range(PROBES)]).alias("bits")
    )


def url_verdicts(pages: DataFrame, listed: DataFrame, rules=RULES, max_blocks: int = MAX_BLOCKS, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``listed(canonical)`` holds blocked canonical URLs. A rule's verdict wins;
    without one, a listed URL is blocked and any other allowed. A null url, or one
    without ``://``, has empty host and path, fits no rule and is allowed. Rows are
    judged one by one; repeated rows get equal verdicts.
    """
    names = stored(listed.where(F.col("canonical").isNotNull()).select("canonical").distinct())
    blocks, listed_rows = 64, names.count()
    while blocks < max_blocks and blocks * 40 < listed_rows:
        blocks *= 2
    pages, restored = set_aside(pages, (url,))
    d = pages.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    d = d.withColumn("_hit", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("_c", canonical_url(F.col("host"), F.col("path")))
    block, words = _slot(F.col("_c"), blocks)
    d = d.withColumn("_block", block).withColumn("_w", words)
    bloom = F.broadcast(bloom_blocks(names, blocks).select(F.col("block").alias("_b"), F.col("bits").alias("_bits")))
    # the filter has at most max_blocks rows of 72 bytes, so this broadcast has a fixed bound
    d = d.join(bloom, (F.col("_block") == F.col("_b")) & F.col("_hit").isNull(), "left")
    passes = F.coalesce(
        F.forall(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: F.get("_bits", i).bitwiseAND(F.get("_w", i)) == F.get("_w", i)), F.lit(False)
    )
    d = d.withColumn("_maybe", passes).drop("_b", "_bits", "_block", "_w")
    sure = d.where(~F.col("_maybe")).withColumn("_listed", F.lit(False))
    exact = names.select(F.col("canonical").alias("_n"))
    maybe = d.where("_maybe").join(exact, F.col("_c") == F.col("_n"), "left").withColumn("_listed", F.col("_n").isNotNull()).drop("_n")
    out = sure.unionByName(maybe)
    own = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    out = out.withColumn("rule", F.col("_hit.rule")).withColumn("verdict", F.coalesce("_hit.verdict", own))
    return restored(out, ["host", "path", "rule", "verdict"])


def feed_list(pages: DataFrame) -> DataFrame:
    """A list for the production query: canonical URLs that some page carries with a ``utm_source=feed`` tag, i.e. syndicated copies."""
    u = body(F.col("url"))
    return pages.where(u.contains("utm_source=feed")).select(canonical_url(url_host(F.col("url")), url_path(F.col("url"))).alias("canonical"))

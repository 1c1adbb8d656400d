"""Document quality rules as one native Spark projection.

A table of thresholds is compiled into column expressions; no user function
runs. Words are ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, set_aside, space_words

SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the four languages that the corpus is written in.
STOP_WORDS = (
    "the of and to in a is that it on for was with as be by at this are from",
    "der die das und in zu den von mit ist des im dem nicht ein eine als auch auf für",
    "le la les de des et un une en que est pour dans qui par sur pas au avec ce",
    "el la los las de que y en un una se del por con no su para es al lo",
)

# Fixed values: (rule, metric, lowest allowed or null, highest allowed or null).
THRESHOLDS = (
    ("word_length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbol_ratio", None, 0.25),
    ("dup_lines", "dup_line_ratio", None, 0.5),
    ("stop_words", "stop_word_ratio", 0.02, None),
    ("shouting", "bang_ratio", None, 0.5),
)

METRICS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars", "symbol_ratio", "dup_line_ratio",
    "stop_word_ratio", "bang_ratio",
]

_POS = 0xFFFFFF  # the low 24 bits of a packed window hold its position


def _windows(words: Column) -> Column:
    """Hash of each window of three consecutive words."""
    return F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def _high(x: Column) -> Column:
    return F.shiftright(x, 24)


def _packed(h: Column) -> Column:
    """Sorted longs: 40 bits of the window's hash over 24 bits of its position. Primitive, so the sort is fast."""
    return F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~_POS)).bitwiseOR(i.cast("long"))))


def _clash(p: Column, h: Column) -> Column:
    """Whether two different windows share the 40 bits, or positions need more than 24 bits."""

    def differ(x: Column, i: Column) -> Column:
        y = F.get(p, i - 1)
        at = lambda v: F.get(h, v.bitwiseAND(F.lit(_POS)).cast("int"))
        return F.coalesce((_high(x) == _high(y)) & (at(x) != at(y)), F.lit(False))

    return (F.size(h) > _POS) | F.exists(F.transform(p, differ), lambda b: b)


def _fast_positions(p: Column) -> Column:
    """Sorted positions of windows found twice or more, from packed windows without clash."""
    again = F.filter(
        p,
        lambda x, i: F.coalesce(_high(x) == _high(F.get(p, i - 1)), F.lit(False))
        | F.coalesce(_high(x) == _high(F.get(p, i + 1)), F.lit(False)),
    )
    return F.sort_array(F.transform(again, lambda x: x.bitwiseAND(F.lit(_POS)).cast("int")))


def _plain_positions(h: Column) -> Column:
    """The same from (hash, position) structs: slower, for any document."""
    s = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.sort_array(
        F.transform(
            F.filter(
                F.transform(s, lambda x, i: F.struct(x.i.alias("i"), F.get(s, i - 1).h.alias("b"), x.h.alias("h"), F.get(s, i + 1).h.alias("a"))),
                lambda x: F.coalesce(x.h == x.b, F.lit(False)) | F.coalesce(x.h == x.a, F.lit(False)),
            ),
            lambda x: x.i,
        )
    )


def _covered(pos: Column) -> Column:
    """Words covered by windows of three that start at the sorted positions."""
    step = F.transform(pos, lambda p, i: F.coalesce(F.least(F.lit(3), p - F.get(pos, i - 1)), F.lit(3)))
    return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)


def base_metrics(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the ratios of the rules.

    Windows are compared by 64-bit hash within one document. Null text has no
    words; every count is then 0 and every ratio null.
    """
    docs, restored = set_aside(docs, ("text",))
    stop = sorted({w for words in STOP_WORDS for w in words.split()})
    d = docs.withColumn("_text", body()).withColumn("_words", space_words(F.col("_text")))
    d = d.withColumn("_h", _windows(F.col("_words"))).withColumn("_p", _packed(F.col("_h")))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    d = d.withColumn("_lines", lines)
    d = d.withColumn(
        "_pos", F.when(_clash(F.col("_p"), F.col("_h")), _plain_positions(F.col("_h"))).otherwise(_fast_positions(F.col("_p")))
    )
    long = lambda c: c.cast("long")
    d = (
        d.withColumn("n_words", long(F.size("_words")))
        .withColumn("word_chars", long(F.char_length(F.array_join("_words", ""))))
        .withColumn("n_symbols", long(F.regexp_count("_text", F.lit(SYMBOLS))))
        .withColumn("_n_lines", F.size("_lines"))
        .withColumn("n_dup_lines", long(F.col("_n_lines") - F.size(F.array_distinct("_lines"))))
        .withColumn("n_repeat_words", _covered(F.col("_pos")))
        .withColumn("_stop", F.size(F.filter("_words", lambda w: F.regexp_replace(F.lower(w), "[^\\p{L}]+$", "").isin(stop))))
        .withColumn("_bang", F.regexp_count("_text", F.lit("!!")))
    )
    ratio = lambda n, of: F.try_divide(F.col(n), F.col(of))
    d = (
        d.withColumn("mean_word_chars", ratio("word_chars", "n_words"))
        .withColumn("symbol_ratio", ratio("n_symbols", "word_chars"))
        .withColumn("dup_line_ratio", ratio("n_dup_lines", "_n_lines"))
        .withColumn("stop_word_ratio", ratio("_stop", "n_words"))
        .withColumn("bang_ratio", ratio("_bang", "n_words"))
    )
    # a generator of one row: the optimizer would else copy these expressions into every filter on a verdict
    one = F.explode(F.array(F.struct(*METRICS))).alias("_m")
    d = d.select("text", *[c for c in d.columns if c == "_others"], one).select("*", "_m.*")
    return restored(d, METRICS)


def compiled(thresholds=THRESHOLDS) -> Column:
    """One boolean over the metric columns: every rule holds. A null metric fails no rule."""

    def holds(metric: str, low: float | None, high: float | None) -> Column:
        m = F.col(metric)
        ok = F.lit(True)
        if low is not None:
            ok = ok & (m >= low)
        if high is not None:
            ok = ok & (m <= high)
        return F.coalesce(ok, F.lit(True))

    return reduce(lambda a, b: a & b, (holds(m, lo, hi) for _, m, lo, hi in thresholds), F.lit(True))


def quality(docs: DataFrame, thresholds=THRESHOLDS, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """``docs`` with the metrics, base_failed and kept.

    base_failed: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` per cent of the words in repeated windows. kept: not
    base_failed and every threshold holds. Empty and null texts fail the base.
    Rows are judged one by one, so repeated rows get equal verdicts.
    """
    d = base_metrics(docs)
    d = d.withColumn(
        "base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    )
    return d.withColumn("kept", ~F.col("base_failed") & compiled(thresholds))

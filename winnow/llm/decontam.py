"""Benchmark decontamination over a distributed positional inverted index.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased. A window of 13 item words is searched from its two rarest terms, by
occurrences in the whole corpus. The index stores a posting (document, term,
position) for each occurrence of such a term, and one past the end of each document,
which gives its length. The lists of the two are intersected after their offsets in
the item are subtracted. Documents with an alignment left get postings of all
benchmark terms, and the lists of the windows' other terms are intersected with
these. Native functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, body, fingerprint_of, set_aside, stored

#: A side with at most so many rows (terms, anchors, document keys: each well under 200 bytes) is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 100_000
#: keys that one word becomes where words are shuffled
SALTS = 64


def item_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast hint where the stored table is counted and within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _spread(docs: DataFrame) -> DataFrame:
    """(doc_id, th, pos, term): one row for each word of each document, and one with the empty term at its end."""
    words = F.concat(item_words(body()), F.array(F.lit("")))
    return docs.select("doc_id", fingerprint_of().alias("th"), F.posexplode(words).alias("pos", "term"))


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, ih): the distinct items that have words, those without an id too."""
    return (
        benchmark.select("item_id", item_words(body()).alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .withColumn("ih", F.xxhash64("words"))
    )


def item_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms, vocabulary): (item_id, ih, size, q, t) of each item word, and (term, t) with a number for each distinct term; -1 is the end."""
    spread = stored(items.select("item_id", "ih", F.size("words").alias("size"), F.posexplode("words").alias("q", "term")))
    numbers = spread.select("term").distinct().withColumn("t", F.monotonically_increasing_id())
    vocabulary = stored(numbers.unionAll(spread.sparkSession.createDataFrame([("", -1)], "term string, t long")))
    return stored(spread.join(vocabulary, "term").select("item_id", "ih", "size", "q", "t")), vocabulary


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, th, t, pos) of each occurrence of ``vocabulary(term, t)`` in the corpus; repeated rows are posted each.

    A vocabulary beyond ``BROADCAST_ROWS`` is joined by term and salt, so a frequent word is many keys.
    """
    if vocabulary.count() <= BROADCAST_ROWS:
        return _spread(docs).join(F.broadcast(vocabulary), "term").select("doc_id", "th", "t", "pos")
    salted = vocabulary.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("th", "pos"), F.lit(SALTS)).cast("int")
    return _spread(docs).withColumn("salt", salt).join(salted, ["term", "salt"]).select("doc_id", "th", "t", "pos")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(t, n): occurrences of each term in all documents; a term that occurs nowhere is absent.

    With a vocabulary beyond ``BROADCAST_ROWS`` each task counts its words before they are shuffled.
    """
    words = _spread(docs).select("term")
    if vocabulary.count() <= BROADCAST_ROWS:
        return stored(words.join(F.broadcast(vocabulary), "term").groupBy("t").agg(F.count("*").alias("n")))
    return stored(words.groupBy("term").agg(F.count("*").alias("n")).join(vocabulary, "term").select("t", "n"))


def anchors(terms: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(item_id, ih, size, q1, t1, q2, t2): the rarest and second rarest word of each window that can occur at all.

    Position q2 equals q1 in windows of one word.
    """
    ranked = (
        terms.join(counts, "t", "left")
        .groupBy("item_id", "ih", "size")
        .agg(F.sort_array(F.collect_list(F.struct("q", F.coalesce("n", F.lit(0)).alias("n"), "t"))).alias("ws"))
    )
    width = F.least(F.lit(window), F.size("ws"))
    starts = F.sequence(F.lit(0), F.size("ws") - width)
    rare = F.transform(
        starts,
        lambda j: F.slice(
            F.sort_array(F.transform(F.slice("ws", j + 1, width), lambda x: F.struct(x.n.alias("n"), x.q.alias("q"), x.t.alias("t")))),
            1,
            2,
        ),
    )
    return (
        ranked.select("item_id", "ih", "size", F.explode(F.array_distinct(rare)).alias("r"))
        .select("item_id", "ih", "size", F.col("r")[0].alias("a"), F.coalesce(F.get("r", F.lit(1)), F.col("r")[0]).alias("b"))
        .where("a.n > 0 AND b.n > 0")
        .select("item_id", "ih", "size", F.col("a.q").alias("q1"), F.col("a.t").alias("t1"), F.col("b.q").alias("q2"), F.col("b.t").alias("t2"))
        .distinct()
    )


DOC = ["doc_id", "th"]
ITEM = ["item_id", "ih", "size"]


def _aligned(index: DataFrame, anchored: DataFrame) -> DataFrame:
    """Occurrences of either anchor word with the item's offset subtracted; ``side`` is 1 for the rarest, 2 for the other."""
    ends = _small(
        stored(
            anchored.select(*ITEM, "q1", "q2", F.lit(1).alias("side"), F.col("t1").alias("t"), F.col("q1").alias("q")).unionAll(
                anchored.select(*ITEM, "q1", "q2", F.lit(2), "t2", "q2")
            )
        )
    )
    return index.join(ends, "t").select(*DOC, *ITEM, "q1", "q2", "side", (F.col("pos") - F.col("q")).alias("shift"))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, slop: int = 0) -> DataFrame:
    """(doc_id, th, item_id, kind, start, length): where windows of items occur.

    kind ``phrase``: the words ``start .. start + length - 1`` (from 0) of the
    document are words of the item in a row, ``window`` or more of them. With ``slop``
    above 0 also kind ``near``: both anchor words of a window occur with offsets that
    differ by at most 2 * slop + 1 words. An item with fewer words than ``window`` is
    one window. Rows with equal doc_id and text count once.
    """
    return search(docs, benchmark, window, slop)[1]


def search(docs: DataFrame, benchmark: DataFrame, window: int, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """(the stored index, :func:`phrase_matches`); term -1 of the index is the end of each document."""
    terms, vocabulary = item_terms(stored(items_of(benchmark)))
    anchored = stored(anchors(terms, term_counts(docs, vocabulary.where("t >= 0")), window))
    rare = anchored.select(F.col("t1").alias("t")).unionAll(anchored.select("t2")).distinct()
    posted = stored(vocabulary.join(rare, "t", "left_semi").unionByName(vocabulary.where("t < 0")))
    index = stored(postings(docs, posted))
    both = F.bit_or("side") == 3
    aligned = _aligned(index.where("t >= 0").distinct(), anchored)
    # an alignment that both anchors of a window share; the other terms of the windows with both decide
    met = aligned.groupBy(*DOC, *ITEM, "q1", "q2", "shift").agg(both.alias("both")).where("both")
    low, high = F.greatest("q1", "q2") - (window - 1), F.least("q1", "q2") + (window - 1)
    candidates = stored(met.select(*DOC, *ITEM, "shift", low.alias("low"), high.alias("high")))
    # items of equal words have equal terms, so these are looked up by the hash of the words and the id stays with the candidate
    words = _small(stored(terms.select(F.col("ih").alias("_ih"), "q", "t").distinct()))
    wanted = candidates.join(words, F.col("ih") == F.col("_ih")).where("q between low and high").drop("_ih")
    wanted = wanted.withColumn("pos", F.col("shift") + F.col("q")).where("pos >= 0").drop("low", "high").distinct()
    keys = _small(stored(candidates.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()))
    found = docs.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (fingerprint_of() == F.col("_th")), "left_semi")
    lists = postings(found.select("doc_id", "text"), vocabulary.where("t >= 0")).distinct()
    lists = lists.select(F.col("doc_id").alias("_d"), F.col("th").alias("_h"), F.col("t").alias("_t"), F.col("pos").alias("_p"))
    # the two sides meet by document and position, so a document that repeats an item is spread over its positions
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_h")) & (F.col("t") == F.col("_t")) & (F.col("pos") == F.col("_p"))
    hit = wanted.join(lists, same).select(*DOC, *ITEM, "shift", "q")
    # words in a row keep the distance between their place in the item and their rank
    rank = F.row_number().over(Window.partitionBy(*DOC, *ITEM, "shift").orderBy("q"))
    runs = hit.withColumn("_run", F.col("q") - rank).groupBy(*DOC, *ITEM, "shift", "_run").agg(F.min("q").alias("a"), F.count("*").cast("int").alias("length"))
    exact = runs.where(F.col("length") >= F.least(F.lit(window), F.col("size")))
    columns = ["doc_id", "th", "item_id", "kind", "start", "length"]
    out = exact.select(*DOC, "item_id", F.lit("phrase").alias("kind"), (F.col("shift") + F.col("a")).cast("int").alias("start"), "length").distinct()
    if slop:
        near = aligned.withColumn("bin", F.floor(F.col("shift") / (slop + 1)))
        near = near.where("side = 1").unionAll(
            near.where("side = 2").withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
        )
        near = near.groupBy(*DOC, *ITEM, "q1", "q2", "bin").agg(both.alias("both"), F.min("shift").alias("shift")).where("both")
        out = out.unionByName(
            near.select(*DOC, "item_id", F.lit("near").alias("kind"), (F.col("shift") + F.col("q1")).cast("int").alias("start"), F.lit(1).alias("length")).distinct()
        )
    return index, out.select(*columns)


def _covered(spans: Column) -> Column:
    """Words covered by sorted (start, length) spans."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a.n + F.greatest(F.lit(0).cast("long"), s.start + s.length - F.greatest(a.end, s.start.cast("long")))).alias("n"),
            F.greatest(a.end, (s.start + s.length).cast("long")).alias("end"),
        ),
        lambda a: a.n,
    )


def document_hits(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5) -> tuple[DataFrame, DataFrame]:
    """(lengths, hits): (_d, _h, n_words) of every document, and of those with a hit also (n_hit, items, contaminated).

    Documents are told by doc_id and the hash of their text.
    """
    index, found = search(docs, benchmark, window)
    lengths = index.where("t < 0").select(F.col("doc_id").alias("_d"), F.col("th").alias("_h"), F.col("pos").cast("long").alias("n_words")).distinct()
    m = found.groupBy(*DOC)
    hits = m.agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    hits = stored(hits.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), _covered(F.col("spans")).alias("n_hit"), "items"))
    known = hits.join(lengths, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_h"))).drop("_id", "_th")
    dirty = (F.col("n_hit") > 0) & (F.col("n_hit") * F.lit(100) >= F.lit(percent) * F.col("n_words"))
    return lengths, stored(known.withColumn("contaminated", dirty))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5) -> DataFrame:
    """The rows of ``docs`` that are not contaminated (see :func:`decontaminate`), as they are."""
    _, hits = document_hits(docs.select("doc_id", "text"), benchmark, window, percent)
    dirty = _small(stored(hits.where("contaminated").select("_d", "_h")))
    return docs.join(dirty, F.col("doc_id").eqNullSafe(F.col("_d")) & (fingerprint_of() == F.col("_h")), "left_anti")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    n_hit counts document words inside any occurrence of a window. A document is
    contaminated if n_hit > 0 and the hit words are at least ``percent`` per cent
    of its words. Null and empty texts have no words and are never contaminated. Repeated rows
    are judged each alike. An item without an id hits words like any other; n_items and
    items_sha256, which tell ids, leave it out. Equal rows of an item count once.
    """
    docs, restored = set_aside(docs, ("doc_id", "text"))
    lengths, hits = document_hits(docs, benchmark, window, percent)
    both = lengths.join(hits.select(F.col("_d").alias("_id"), F.col("_h").alias("_th"), "n_hit", "items", "contaminated"), F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left")
    # the hash is a column of its own, so that the join need not carry the text where it is not asked for
    d = docs.withColumn("_fp", fingerprint_of()).join(both, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_fp") == F.col("_h")))
    none = F.array().cast("array<string>")
    d = d.withColumns({
        "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "n_items": F.size(F.coalesce("items", none)).cast("long"),
        "items_sha256": F.sha2(F.array_join(F.coalesce("items", none), ","), 256), "contaminated": F.coalesce("contaminated", F.lit(False)),
    })
    return restored(d, ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

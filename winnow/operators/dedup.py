"""Exact, priority and fuzzy dedup; canonical merge; caps and ranks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import indel_scores, token_sorted
from ..functions.text import blank
from ..store import stored
from .name_index import alike, first_come


def first_wins(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """One row for each key, lower-cased and trimmed: the first by ``order``. Rows with a blank key are dropped."""
    k = F.lower(F.trim(key))
    # keys with a long prefix in common sort far faster behind their hash
    ranked = df.where(blank(k) != "").withColumn("_rn", F.row_number().over(Window.partitionBy(F.xxhash64(k), k).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def quota(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows by ``order``: a top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def batch_limit(rows: DataFrame, seen: DataFrame, key: str, n: int | None, *order: Column) -> DataFrame:
    """The first ``n`` rows by ``order`` (all if None) whose key is not among those seen; repeated keys count once, blank ones not at all."""
    fresh = first_wins(rows, F.col(key), *order).join(seen.select(F.lower(F.trim(key)).alias("_k")).distinct(), F.lower(F.trim(F.col(key))) == F.col("_k"), "left_anti")
    return fresh if n is None else quota(fresh, n, *order)


def distinct_prefix(rows: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    """The first ``n`` distinct values of ``key`` in order of their first row; all if ``n`` is 0."""
    names = [f"_o{i}" for i in range(len(order))]
    first = rows.groupBy(key).agg(F.min(F.struct(*[o.alias(x) for o, x in zip(order, names, strict=True)])).alias("_first"))
    return (first.orderBy("_first").limit(n) if n else first).select(key)


def sample_rows(rows: DataFrame, n: int, *key: str, seed: int = 0) -> DataFrame:
    """``n`` rows chosen by a hash of their key and the seed: a sample that a rerun repeats."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *key)), *key).limit(n)


def priority_union(tiers: list[DataFrame], key: str, *order: str) -> DataFrame:
    """Union in which the first tier wins a key; rows with a null key all stay."""
    parts = [t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ranked = out.where(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy("tier", *order)))
    return ranked.where("_rn = 1").drop("_rn").unionByName(out.where(F.col(key).isNull()))


def failover_union(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary's rows, or the fallback's if the primary has none."""
    empty = primary.limit(1).agg(F.count("*") == 0).scalar()
    return primary.unionByName(fallback.where(empty))


def canonical_merge(df: DataFrame, key: str, score: str, stars: str, order: str, fill: list[str], source: str) -> DataFrame:
    """One row for each key: the best by score, then stars, then order; its blank ``fill`` columns come from the next best.

    Sources are joined as a sorted set. Only map-side combinable aggregates are
    used, so a key with many rows needs no single big task.
    """
    rank = [F.coalesce(F.col(score), F.lit(0.0)), F.coalesce(F.col(stars), F.lit(0)), -F.col(order)]
    best = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)])
    aggs = [F.max_by(c, best).alias(c) for c in df.columns if c not in (key, source, *fill)]
    aggs += [F.max_by(c, F.when(blank(F.col(c)) != "", best)).alias(c) for c in fill]
    return df.groupBy(key).agg(*aggs, F.array_join(F.sort_array(F.collect_set(source)), ", ").alias(source))


def cap_per_group(df: DataFrame, group: str, n: int, *order: Column, exempt: Column | None = None) -> DataFrame:
    """At most ``n`` rows of each group by ``order``; rows without a group and exempt rows stay. A null exemption is none."""
    free = F.col(group).isNull() if exempt is None else F.col(group).isNull() | F.coalesce(exempt, F.lit(False))
    capped = df.where(~free).withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return capped.where(F.col("_rn") <= n).drop("_rn").unionByName(df.where(free))


def ranked(df: DataFrame, group: str, name: str, *order: Column) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def ranked_wide(df: DataFrame, group: str, name: str, *order: Column) -> DataFrame:
    """:func:`ranked` for few groups of any size: rows are numbered by sorted ranges over all groups, less where their group starts."""
    rows = numbered(df, "_at", F.col(group), *order)
    starts = rows.groupBy(F.col(group).alias("_group")).agg(F.min("_at").alias("_start"))
    return rows.join(starts, F.col(group).eqNullSafe(F.col("_group"))).withColumn(name, F.col("_at") - F.col("_start") + 1).drop("_at", "_group", "_start")


def fuzzy_pairs(rows: DataFrame, key: str, text: str, ratio: float = 90.0, others: DataFrame | None = None) -> DataFrame:
    """(a, b, score) of all rows a < b whose token-sort ratio is at least ``ratio``; with ``others`` of all a of the rows and b of the others.

    Candidates share a bigram among the rarest of either text. Within the ratio a
    text of length m loses at most ``2 * d`` of its bigrams to the ``d`` edits that
    the ratio allows, so that many plus one of its rarest bigrams must hold a
    common one: the filter loses no pair and there is no all-pairs join. Pairs that
    share too few bigrams in all are dropped before the comparison.
    """

    def grams(s: Column) -> Column:
        padded = F.concat(F.lit("\u0001"), s, F.lit("\u0001"))
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) + 1), lambda i: F.substring(padded, i, F.lit(2))))

    side = lambda d, i: d.select(F.col(key).alias("id"), token_sorted(blank(F.col(text))).alias("s"), F.lit(i).alias("side")).where("s <> ''")
    t = side(rows, 0) if others is None else side(rows, 0).unionByName(side(others, 1))
    t = stored(t.withColumn("gs", grams(F.col("s"))))
    each = t.select("id", "side", F.length("s").alias("m"), F.explode("gs").alias("g"))
    share = (100.0 - ratio) / 100.0
    edits = share * (1 + (1 + share) / (1 - share))  # of the text's length, for the longest partner
    df = each.groupBy("g").agg(F.count("*").alias("n"))
    order = Window.partitionBy("id", "side").orderBy("n", "g")
    prefix = each.join(df, "g").withColumn("k", F.row_number().over(order)).where(F.col("k") <= F.floor(2 * edits * F.col("m")) + 3)
    first, second = (prefix, prefix) if others is None else (prefix.where("side = 0"), prefix.where("side = 1"))
    a, b = first.select(F.col("id").alias("a"), "g", F.col("m").alias("ma")), second.select(F.col("id").alias("b"), "g", F.col("m").alias("mb"))
    near = 200.0 * F.least("ma", "mb") >= ratio * (F.col("ma") + F.col("mb"))
    met = a.join(b, "g").where(near)
    pairs = (met.where("a < b") if others is None else met).select("a", "b").distinct()
    left, right = (t, t) if others is None else (t.where("side = 0"), t.where("side = 1"))
    pairs = pairs.join(left.select(F.col("id").alias("a"), F.col("s").alias("sa"), F.col("gs").alias("ga")), "a")
    pairs = pairs.join(right.select(F.col("id").alias("b"), F.col("s").alias("sb"), F.col("gs").alias("gb")), "b")
    shared = F.size(F.array_intersect("ga", "gb")) >= F.greatest(F.size("ga"), F.size("gb")) - 2 * share * (F.length("sa") + F.length("sb"))
    return pairs.where(shared).select("a", "b", indel_scores("sa", "sb").alias("score")).where(F.col("score") >= ratio)


#: pairs that one task settles in one pass; more are settled in rounds
SMALL_PAIRS = 1_000_000


def _gone(batches):
    """Of pairs sorted by (b, a): each b of which some a stays. All that decides an a lies before it."""
    gone: set[int] = set()
    for pdf in batches:
        before = len(gone)
        new = []
        for a, b in zip(pdf.a.tolist(), pdf.b.tolist(), strict=True):
            if a not in gone and b not in gone:
                gone.add(b)
                new.append(b)
        if len(gone) > before:
            yield pd.DataFrame({"id": new})


def greedy_kept(rows: DataFrame, pairs: DataFrame, key: str, small: int = SMALL_PAIRS) -> DataFrame:
    """Rows that a first-come pass keeps: a row goes if an earlier kept row is alike.

    Up to ``small`` pairs are settled by one task in one pass over their order, chains of any length too. More are
    solved in rounds of set operations: a row with no undecided or kept earlier
    neighbour is kept, then its later neighbours go. Every round settles at least the
    first undecided row, so the loop ends; each round is a table in the shared folder.
    """
    left = stored(pairs.select("a", "b"))
    if left.count() <= small:
        every = stored(left.repartition(1).sortWithinPartitions("b", "a").mapInPandas(_gone, "id long"))
        return rows.join(every.select(F.col("id").alias("_gone")), F.col(key) == F.col("_gone"), "left_anti")
    gone = []
    while not left.isEmpty():
        safe = left.select(F.col("a").alias("id")).join(left.select(F.col("b").alias("id")), "id", "left_anti").distinct()
        out = stored(left.join(safe, F.col("a") == F.col("id"), "left_semi").select(F.col("b").alias("id")).distinct())
        gone.append(out)
        left = stored(left.join(out, F.col("a") == F.col("id"), "left_anti").join(out, F.col("b") == F.col("id"), "left_anti"))
    every = gone[0]
    for g in gone[1:]:
        every = every.unionByName(g)
    return rows.join(every.select(F.col("id").alias("_gone")), F.col(key) == F.col("_gone"), "left_anti")


#: texts that the first block of a fuzzy dedup holds, which one task settles
FIRST_BLOCK = 8_192
#: pairs of texts whose bags are compared in blocks; beyond, texts meet on their rarest bigrams
BAG_PAIRS = 4_000_000_000


def _alike_pairs(left: DataFrame, right: DataFrame | None, counts: tuple[int, int], ratio: float) -> DataFrame:
    """(a, b, score) of all alike pairs of (id, s), with ``right`` None of a < b within ``left``; both ways give the same rows."""
    if counts[0] * counts[1] <= BAG_PAIRS:
        return alike(left, left if right is None else right, counts, ratio, right is None)
    return fuzzy_pairs(left, "id", "s", ratio, right)


def fuzzy_first_wins(rows: DataFrame, key: str, text: str, ratio: float = 90.0, block: int = FIRST_BLOCK) -> DataFrame:
    """Rows in order of ``key`` (a long) less those alike to an earlier kept row; rows without a token all stay.

    Rows of one token-sorted text are settled first, by an aggregate: only the first of
    each such group enters the search, so a large group of copies makes no pairs. The first
    block of texts is settled by one task, text by text. The others go in blocks of doubling size: those
    alike to a text kept before leave first, and only the rest of a block is compared within itself.
    """
    sorted_text = token_sorted(blank(F.col(text)))
    first = rows.where(sorted_text != "").groupBy(sorted_text.alias("s")).agg(F.min(key).cast("long").alias("id"))
    first = stored(numbered(first, "_n", "id"))
    total, low, kept = first.count(), 0, None
    while low < total:  # as many turns as doublings
        now = first.where((F.col("_n") >= low) & (F.col("_n") < low + block)).select("id", "s")
        if kept is None:
            kept = stored(now.join(stored(first_come(now, ratio)), "id", "left_semi"))
        else:
            gone = stored(_alike_pairs(now, kept, (block, kept.count()), ratio).select(F.col("a").alias("_gone")).distinct())
            now = stored(now.join(gone, F.col("id") == F.col("_gone"), "left_anti"))
            n = now.count()
            kept = kept.unionByName(stored(greedy_kept(now, _alike_pairs(now, None, (n, n), ratio), "id")))
        low, block = low + block, 2 * block
    if kept is None:
        return rows
    of = kept.select(F.col("id").alias("_k"))
    return rows.where(sorted_text != "").join(of, F.col(key) == F.col("_k"), "left_semi").unionByName(rows.where(sorted_text == ""))


def numbered(df: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """Rows with their place (from 0) in the order as column ``name``.

    Rows are numbered by sorted ranges: each range counts its own, and the counts of the
    ranges before it are added, so no task sees more than its range.
    """
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # one row a partition, so the window and the broadcast are bounded by their number
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    return rows.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + at).drop("_part", "_before", "_id")

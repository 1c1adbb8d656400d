"""Per-source run history, novelty state and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import stored


def last_runs(runs: DataFrame, keep: int = 5) -> DataFrame:
    """``runs(source, run, n)``: the last ``keep`` runs of each source."""
    w = Window.partitionBy("source").orderBy(F.desc("run"))
    return runs.withColumn("age", F.row_number().over(w)).where(F.col("age") <= keep)


def source_health(runs: DataFrame, keep: int = 5, stale_after: int = 2) -> DataFrame:
    """(source, history, latest, trailing_zeros, stale) over the last ``keep`` runs."""
    kept = last_runs(runs, keep)
    nearest = F.min(F.when(F.col("n") != 0, F.col("age")))
    return (
        kept.groupBy("source")
        .agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("run", "n"))), lambda x: x.n.cast("string")), ",").alias("history"),
            F.max_by("n", "run").alias("latest"),
            F.coalesce(nearest - 1, F.count("*")).cast("long").alias("trailing_zeros"),
        )
        .withColumn("stale", F.col("trailing_zeros") >= stale_after)
    )


def counts_with_zero(rows: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    """Rows of each source of the dimension, sources without rows kept."""
    n = rows.groupBy(source).agg(F.count("*").alias("n"))
    return sources.join(n, source, "left").select(source, F.coalesce("n", F.lit(0)).alias("n"))


def distribution(rows: DataFrame, column: str, kinds: list[str]) -> DataFrame:
    """(column, n, share): rows of each of the ``kinds``, those without rows kept, and their share of all rows; 0 of no rows."""
    dim = rows.sparkSession.createDataFrame([(k,) for k in kinds], f"`{column}` string")
    total = rows.count()
    return counts_with_zero(rows, dim, column).withColumn("share", F.col("n") / total if total else F.lit(0.0))


def key_union(*parts: DataFrame, key: str) -> DataFrame:
    """The distinct keys of all parts."""
    out = parts[0].select(key)
    for p in parts[1:]:
        out = out.unionByName(p.select(key))
    return out.distinct()


def novel(rows: DataFrame, seen: DataFrame, key: str, only: Column) -> DataFrame:
    """Rows whose key was not seen before; rows outside ``only`` (null counts as outside) are not tested."""
    old = seen.select(F.col(key).alias("_k")).distinct()
    only = F.coalesce(only, F.lit(False))
    return rows.where(~only).unionByName(rows.where(only).join(old, F.col(key) == F.col("_k"), "left_anti"))


#: calls of one range of the pacing scan, about
RANGE_ROWS = 1_000_000


def pacing_slots(calls: DataFrame, interval: float, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``calls(token, seq, ts)`` with the start of each call's slot: no two of a token closer than ``interval``.

    ``slot = max(ts, previous slot + interval)`` is associative: with i the call's place among
    its token's, it is the running maximum of ``ts - i * interval``, plus ``i * interval``. So calls are
    cut into ranges of (token, seq), each range is scanned on its own, and a second pass adds what the
    ranges before it carry: how many calls of the token they hold, and their maximum. A
    token with very many calls fills many ranges. Calls of one token and seq count in any order; a
    null token is a token, and a null ts takes its slot from the calls before it.
    """
    names = calls.columns
    ranges = max(1, -(-calls.count() // range_rows))
    cut = calls.repartitionByRange(ranges, "token", "seq") if ranges > 1 else calls
    rows = stored(cut.withColumn("_range", F.spark_partition_id() if ranges > 1 else F.lit(0)))
    key = ["_range", "token"]
    # one row for each token of a range: a token meets as many as it has ranges
    before = Window.partitionBy("token").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = rows.groupBy(*key).agg(F.count("*").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = Window.partitionBy(*key).orderBy("seq")
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    same = (F.col("_range") == F.col("_r")) & F.col("token").eqNullSafe(F.col("_t"))
    named = lambda d, c: d.select(F.col("_range").alias("_r"), F.col("token").alias("_t"), c)
    placed = rows.withColumn("_i", F.row_number().over(within) - 1).join(named(held, "_first"), same).drop("_r", "_t")
    placed = placed.withColumn("_i", F.col("_i") + F.col("_first")).withColumn("_b", F.col("ts") - F.col("_i") * interval)
    if ranges == 1:
        most = F.max("_b").over(so_far)
    else:
        placed = stored(placed)
        carried = placed.groupBy(*key).agg(F.max("_b").alias("_m")).withColumn("_carry", F.max("_m").over(before))
        placed = placed.withColumn("_most", F.max("_b").over(so_far)).join(named(carried, "_carry"), same)
        most = F.greatest("_most", "_carry")
    return placed.withColumn("slot", most + F.col("_i") * interval).select(*names, "slot")


def with_run(runs: DataFrame, crawler: str, run: int, counts: DataFrame, keep: int = 5) -> DataFrame:
    """``runs(crawler, source, run, n)`` of one crawler with this run's ``counts(source, n)`` added, the last ``keep`` runs of a source."""
    own = runs.where(F.col("crawler") == crawler).select("source", "run", "n")
    added = own.unionByName(counts.select("source", F.lit(run).cast("long").alias("run"), "n"))
    return last_runs(added, keep).select(F.lit(crawler).alias("crawler"), "source", "run", "n")

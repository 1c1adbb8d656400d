"""Run report, its verdict, and the audit gates, each as a small aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import is_fresh
from .dedup import distinct_prefix
from .shaping import TABLES


def collected(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of each table, empty ones included."""
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()])


def run_report(counts: DataFrame, run_id: str, status: str, target: int, seconds: float, upload: str = "not_requested", stale: DataFrame | None = None, bulk: list[str] | None = None) -> DataFrame:
    """One row: run, status, target, duration, counts by name and the stale sources.

    A completed run with a count below the target is a shortfall; only the tables of
    ``bulk`` have a target (all if None).
    """
    aimed = F.lit(True) if bulk is None else F.col("name").isin(bulk)
    rows = counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "n")))).alias("collected"), F.coalesce(F.bool_or(aimed & (F.col("n") < target)), F.lit(False)).alias("_short"))
    gone = stale.where("stale").agg(F.sort_array(F.collect_list("source"))).scalar() if stale is not None else F.array().cast("array<string>")
    final = F.when(F.col("_short") & F.lit(status == "completed"), "shortfall").otherwise(status)
    took = max(0.0, seconds)
    return rows.select(
        F.lit(run_id).alias("run_id"), final.alias("status"), F.lit(target).cast("long").alias("target_count"), F.lit(round(took, 1 if took >= 0.1 else 3)).alias("duration_seconds"),
        "collected", F.lit(upload).alias("sheets_upload"), gone.alias("stale_sources"),
    )


def report_failures(report: DataFrame, names: list[str], least: float = 0.95) -> DataFrame:
    """The report with ``failures``: a run that did not complete, tables below their share of the target, a failed upload."""
    checks = [F.when(F.col("status") != "completed", F.concat(F.lit("status "), "status"))]
    for n in names:
        got = F.coalesce(F.try_element_at("collected", F.lit(n)), F.lit(0))
        checks.append(F.when((F.col("target_count") <= 0) | (got < least * F.col("target_count")), F.concat(F.lit(f"{n} "), got.cast("string"))))
    checks.append(F.when(F.col("sheets_upload") == "failed", F.lit("upload")))
    failures = F.array_compact(F.array(*checks))
    return report.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0)


def gate(df: DataFrame, name: str, ok: Column, least: float = 1.0) -> DataFrame:
    """(gate, total, good, passed): rows that meet ``ok``, and whether their share reaches ``least``. No rows pass."""
    got = df.agg(F.count("*").alias("total"), F.count_if(F.coalesce(ok, F.lit(False))).alias("good"))
    return got.select(F.lit(name).alias("gate"), "total", "good", (F.col("good") >= least * F.col("total")).alias("passed"))


def at_least(df: DataFrame, name: str, n: int, ok: Column | None = None) -> DataFrame:
    """A gate on a number of rows."""
    good = F.count("*") if ok is None else F.count_if(F.coalesce(ok, F.lit(False)))
    return df.agg(F.count("*").alias("total"), good.alias("good")).select(F.lit(name).alias("gate"), "total", "good", (F.col("good") >= n).alias("passed"))


def fresh_gate(df: DataFrame, name: str, published: str, seen: str) -> DataFrame:
    """Rows published within 24 hours before they were collected."""
    return gate(df, name, is_fresh(F.col(published), F.col(seen), ahead_minutes=6))


def header_ok(df: DataFrame, table: str) -> bool:
    """Whether the columns are those of the output table, in order."""
    return df.columns == TABLES[table]


def liveness(urls: DataFrame, probes: DataFrame, sample: int = 0, least: float = 0.95, spare: int = 3) -> DataFrame:
    """(gate, total, good, passed) over landed ``probes(url, code)`` of the first ``sample`` distinct ``urls(url, seq)`` (all if 0).

    Passed if ``least`` of them answered 200 or at most ``spare`` did not; an URL without a probe did not.
    """
    chosen = distinct_prefix(urls.where(F.coalesce("url", F.lit("")) != ""), "url", sample, F.col("seq"))
    d = chosen.join(probes.groupBy("url").agg(F.min("code").alias("code")), "url", "left")
    got = d.agg(F.count("*").alias("total"), F.count_if(F.coalesce(F.col("code") == 200, F.lit(False))).alias("good"))
    return got.select(F.lit("live").alias("gate"), "total", "good", ((F.col("good") >= least * F.col("total")) | (F.col("total") - F.col("good") <= spare)).alias("passed"))

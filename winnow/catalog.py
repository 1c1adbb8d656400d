"""All queries over the engine's own operators, and the flagship query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.temporal import is_fresh
from .operators.dedup import first_wins
from .operators.history import counts_with_zero
from .plans import curation_queries, report_queries, run_queries, source_queries, state_queries, text_queries  # noqa: F401  they register themselves
from .plans.registry import QUERIES, SQL, table


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh events (against the latest time), first of each user and type, counted per source with zeros and a stale flag."""
    e = table(spark, sf_dir, "events")
    fresh = e.where(is_fresh(F.col("ts"), e.agg(F.max("ts")).scalar()))
    first = first_wins(fresh, F.concat_ws(":", "user_id", "event_type"), F.col("ts"), F.col("event_id"))
    return counts_with_zero(first, e.select("event_type").distinct(), "event_type").withColumn("stale", F.col("n") == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

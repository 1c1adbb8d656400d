"""The 100-point rubric as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _steps(value: Column, steps: list[tuple[float, float]], default: float) -> Column:
    """Points of the first step whose bound the value does not exceed; null gets the default."""
    out = F.lit(default)
    for bound, points in reversed(steps):
        out = F.when(value <= bound, F.lit(points)).otherwise(out)
    return out


def days_since(ts: Column, now: Column) -> Column:
    return (F.unix_timestamp(now) - F.unix_timestamp(ts)) / 86400.0


def activity(days: Column, archived: Column) -> Column:
    """15, 10, 5 or 0 at 30, 90 and 180 days; 0 if archived."""
    return F.when(F.coalesce(archived, F.lit(False)), F.lit(0.0)).otherwise(_steps(days, [(30, 15.0), (90, 10.0), (180, 5.0)], 0.0))


def adoption(stars: Column) -> Column:
    """0, 2, 4, 6, 8 or 10 from 1, 10, 100, 500 and 2000 stars."""
    s = F.coalesce(stars, F.lit(0))
    out = F.lit(0.0)
    for bound, points in ((1, 2.0), (10, 4.0), (100, 6.0), (500, 8.0), (2000, 10.0)):
        out = F.when(s >= bound, F.lit(points)).otherwise(out)
    return out


def docs(docs_url: Column, readme: Column) -> Column:
    return F.when(F.coalesce(docs_url, F.lit("")) != "", 5.0).when(F.coalesce(readme, F.lit(False)), 3.0).otherwise(0.0)


def reliability(alive: Column, fork: Column) -> Column:
    return F.when(~F.coalesce(alive, F.lit(False)), 1.0).when(F.coalesce(fork, F.lit(False)), 2.5).otherwise(5.0)


def recency(days: Column) -> Column:
    return _steps(days, [(30, 5.0), (90, 4.0), (180, 3.0), (365, 2.0)], 0.0)


def total(*factors: Column, top: float = 100.0) -> Column:
    out = F.lit(0.0)
    for f in factors:
        out = out + F.coalesce(f, F.lit(0.0))
    return F.round(F.least(out, F.lit(top)), 1)


def bracket(score: Column) -> Column:
    """Tier of a final score; null counts as 0."""
    s = F.coalesce(score, F.lit(0.0))
    return F.when(s >= 90, "90-100").when(s >= 80, "80-89").when(s >= 70, "70-79").otherwise("<70")


def selected(kind: Column, score: Column, server_floor: float = 65.0, client_floor: float = 40.0) -> Column:
    """Clients and servers above their own floors."""
    return F.when(kind == "CLIENT", score >= client_floor).otherwise(score >= server_floor)

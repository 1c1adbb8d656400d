"""Typed property graph as two tables, and its degree report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nodes(parts: list[tuple[DataFrame, str, str, str, bool]]) -> DataFrame:
    """Nodes of (frame, id column, label column, type, last wins) parts; a frame's ``seq`` column gives the order.

    Start-ups and publishers keep their first attributes, other types their last.
    """
    rows = [
        f.select(F.concat(F.lit(f"{kind}:"), F.col(i)).alias("id"), F.col(lab).cast("string").alias("label"), F.lit(kind).alias("node_type"), (F.col("seq") if last else -F.col("seq")).alias("o"))
        for f, i, lab, kind, last in parts
    ]
    every = reduce(DataFrame.unionByName, rows)
    return every.groupBy("id").agg(F.max_by("label", "o").alias("label"), F.max_by("node_type", "o").alias("node_type"))


def edges(parts: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Edges of (frame with src, dst, seq; source type; target type; relationship); the last relationship of a pair wins."""
    rows = [f.select(F.concat(F.lit(f"{a}:"), "src").alias("src"), F.concat(F.lit(f"{b}:"), "dst").alias("dst"), F.lit(rel).alias("relationship"), "seq") for f, a, b, rel in parts]
    return reduce(DataFrame.unionByName, rows).groupBy("src", "dst").agg(F.max_by("relationship", "seq").alias("relationship"))


def degree(n: DataFrame, e: DataFrame) -> DataFrame:
    """In plus out degree of every node, isolated ones included."""
    ends = e.select(F.col("src").alias("id")).unionAll(e.select("dst"))
    d = ends.groupBy("id").agg(F.count("*").alias("degree"))
    return n.join(d, "id", "left").select("id", "node_type", F.coalesce("degree", F.lit(0)).alias("degree"))

"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import discard, scratch, stored  # noqa: F401  the operators import them from here

# The six ASCII white-space characters [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t-\\r]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII takes the fast path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def set_aside(docs: DataFrame, needed: tuple[str, ...]):
    """(frame of the needed columns, function that puts the others back beside the outputs).

    An operator then meets no foreign column name. An input column with the name of an
    output is replaced by the output.
    """
    others = [c for c in docs.columns if c not in needed]
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_others")] if others else []
    inner = docs.select(*needed, *rest)

    def restored(out: DataFrame, outputs: list[str]) -> DataFrame:
        left = [c for c in docs.columns if c not in outputs]
        return out.select(*[F.col("_others").getField(c).alias(c) if c in others else F.col(c) for c in left], *outputs)

    return inner, restored


def body(text: str | Column = "text") -> Column:
    """The text with null read as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text as an array."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def fingerprint_of(text: str = "text") -> Column:
    """64-bit text hash that tells apart rows which share a doc_id."""
    return F.xxhash64(F.col(text))


#: a graph of at most so many edges (16 bytes each) is settled by one task in one pass
SMALL_GRAPH = 1_000_000


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Smallest reachable node of each node of one small graph, by union and find."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for b in batches:
        for x, y in zip(b.a.tolist(), b.b.tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    nodes = list(root)
    for at in range(0, len(nodes), 100_000):
        part = nodes[at : at + 100_000]
        yield pd.DataFrame({"node": part, "root": [find(x) for x in part]})


def connected_components(edges: DataFrame, max_rounds: int = 60, small: int = SMALL_GRAPH) -> DataFrame:
    """Smallest reachable node for each node of ``edges(src, dst)`` (longs).

    A graph of at most ``small`` distinct edges goes through one task. A larger one is
    settled by alternating large-star and small-star contraction: every round maps each
    edge to the smallest neighbour, so path lengths shrink geometrically. Only
    per-node minima are aggregated; no neighbour list is built. Returns
    ``node, root``; nodes without an edge are absent.
    """
    e = stored(
        edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).where("a <> b").distinct()
    )
    if e.count() <= small:
        return stored(e.repartition(1).mapInPandas(_settle, "node long, root long"))
    before = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small_star = (
            large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        )
        e = stored(small_star.where("a <> b").distinct())
    raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")

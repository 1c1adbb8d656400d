"""All names that texts contain: one automaton over many patterns, so a text is read once a block of names."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: letters of the names of one automaton, about (under 300 bytes each in a worker); each block of names reads the texts once
BLOCK_LETTERS = 300_000


class Automaton:
    """Aho-Corasick over lower-cased patterns: a trie whose nodes know where to go on after a mismatch.

    ``next`` holds the children of each node, ``fail`` the node of the longest suffix that
    is a prefix of some pattern, and ``ends`` the nearest node on that way, itself included, at which a pattern ends.
    """

    def __init__(self, patterns: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.own: dict[int, list[int]] = {}
        for number, p in enumerate(patterns):
            node = 0
            for c in p:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                node = self.next[node][c]
            self.own.setdefault(node, []).append(number)
        self.fail, self.ends = [0] * len(self.next), [0] * len(self.next)
        line = list(self.next[0].values())
        for node in line:
            self.ends[node] = node if node in self.own else 0
        for node in line:  # grows while it is walked: by depth
            for c, child in self.next[node].items():
                back = self.fail[node]
                while back and c not in self.next[back]:
                    back = self.fail[back]
                self.fail[child] = self.next[back].get(c, 0)
                self.ends[child] = child if child in self.own else self.ends[self.fail[child]]
                line.append(child)

    def found(self, text: str) -> set[int]:
        """Numbers of the patterns that occur in the text, nested and overlapping ones too."""
        node, nodes = 0, set()
        for c in text:
            while node and c not in self.next[node]:
                node = self.fail[node]
            node = self.next[node].get(c, 0)
            end = self.ends[node]
            while end and end not in nodes:
                nodes.add(end)
                end = self.ends[self.fail[end]]
        return {n for node in nodes for n in self.own[node]}


def contained(texts: DataFrame, names: DataFrame, least: int = 3) -> DataFrame:
    """(id, name) of each of ``texts(id, title)`` that holds one of ``names(name)`` of at least ``least`` characters, case ignored.

    A name counts once a text. Names are dealt by hash into blocks of about ``BLOCK_LETTERS`` letters;
    a block travels to the tasks, which build its automaton once and stream their texts through it.
    """
    dim = names.where(F.length("name") >= least).select("name", F.lower("name").alias("low")).distinct()
    letters = dim.agg(F.sum(F.length("low"))).first()[0] or 0
    blocks = max(1, -(-letters // BLOCK_LETTERS))
    low = texts.select("id", F.lower("title").alias("low")).where("low is not null")
    schema = T.StructType([low.schema["id"], T.StructField("name", T.StringType())])

    def part(block: int) -> DataFrame:
        rows = dim.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == block).collect()
        held = texts.sparkSession.sparkContext.broadcast([(r.low, r.name) for r in rows])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = Automaton([p for p, _ in held.value])
            own = [n for _, n in held.value]
            for b in batches:
                at, found = [], []
                for i, text in enumerate(b.column("low").to_pylist()):
                    for n in automaton.found(text):
                        at.append(i)
                        found.append(own[n])
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at, pa.int64())), pa.array(found, pa.string())], ["id", "name"])

        return low.mapInArrow(search, schema)

    out = part(0)
    for block in range(1, blocks):
        out = out.unionByName(part(block))
    return out

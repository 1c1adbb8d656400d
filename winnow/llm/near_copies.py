"""Near copies by the exact Jaccard similarity of word shingles, searched by fingerprints first.

64-bit fingerprints alone cannot find them: at a similarity of 0.8 about ten bits are
expected to differ, which leaves no selective chains. So links come from three searches,
and every link is decided by the sizes of the two sets' intersection and union:

1. Fingerprints that the pigeonring search of :mod:`simhash` links.
2. Stars. Two sets of similarity ``t`` or more share a member of their prefixes, the
   first ``n - ceil(t n) + 1`` members in any order common to all sets. The sets of a
   prefix shingle and like size are compared with one of them, so that a large group of
   near copies is not compared pair by pair. Rounds go on, each shingle with a member of
   its own choice, until few pairs are open or a round closes few of them.
3. All pairs that share a prefix shingle, are not connected yet and pass the bounds of
   size and of presence bits. Large groups are searched inside tasks and give out the
   pairs that pass only. This search is exact for whatever the others left open.

A candidate pair is tested on presence bits first: each shingle sets one of 8 to 16 bits a
shingle, so two sets differ in as many members as bits at least, and a similarity of 0.8
allows a ninth of their sizes to differ. Pairs beyond that budget go; no similar pair
does. Only the texts of the others are fetched. They travel as texts, since a set of
64-bit hashes takes more room than the text it is made of.

The order puts shingles that are frequent in a sample last; the sample sets the order
only, every order finds every pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, connected_components, discard, stored
from .shingles import majority, shingle_hashes
from .simhash import DENSE, fingerprint_links

WIDTH = 5
#: least similarity as a fraction, so that no bound is rounded
NUM, DEN = 4, 5
#: star rounds end when the open pairs are at most so many for each row of a shared prefix
OPEN_PAIRS = 0.5
#: sets of a prefix shingle that are paired by a join at most; a larger group is searched inside a task, so many sets at once
BIG_GROUP, BLOCK = 48, 8_192
#: most presence bits of a set; beyond, a bit stands for more shingles and the test only passes more
MAX_BITS = 1 << 16
#: one text in so many makes the order of the shingles, but this many texts at least; how many frequent shingles are told apart at most
SAMPLE_SHARE, SAMPLE_TEXTS, MAX_FREQUENT = 64, 2_000, 200_000
#: base of the size classes: sets of similar texts lie in one class or in neighbouring ones
CLASS_BASE = 1.2501


def shingle_sets(texts: Sequence[str], width: int = WIDTH) -> list[np.ndarray]:
    """Distinct hashes of each text's word shingles, sorted; a text of fewer words is one shingle."""
    return [np.unique(h.view(np.int64)) for h in shingle_hashes(texts, width)]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of NUM / DEN or more; empty sets are equal."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared * (NUM + DEN) >= (len(a) + len(b)) * NUM


def presence(g: np.ndarray) -> bytes:
    """Bits of a set: its members' low bits, in a power of two of 8 to 16 bits a member."""
    size = min(MAX_BITS, 1 << max(9, (8 * len(g)).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[(g.view(np.uint64) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two sets' presence differs, the longer one folded to the length of the other."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _within_budget(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Those of the rows (src, dst, n1, n2, a, b) whose presence bits allow the similarity."""
    for batch in batches:
        keep = [differing(a, b) * (DEN + NUM) <= (m + n) * (DEN - NUM) for a, b, m, n in zip(batch.a, batch.b, batch.n1, batch.n2, strict=True)]
        yield batch.loc[keep, ["src", "dst"]]


def _grams(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 200):
                yield pd.DataFrame({"token": np.concatenate(shingle_sets(b.text.iloc[i : i + 200], width))})

    return run


def frequent_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, how often each) that a sample of the distinct texts holds twice or more, the most frequent ones at most."""
    every = max(1, min(SAMPLE_SHARE, texts.count() // SAMPLE_TEXTS))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).select("text").distinct()
    counts = sample.mapInPandas(_grams(width), "token long").groupBy("token").count()
    top = counts.where("count > 1").orderBy(F.desc("count"), "token").limit(MAX_FREQUENT).toPandas().sort_values("token")
    return top.token.to_numpy(np.int64), top["count"].to_numpy(np.int64)


def _rows(width: int, frequent: np.ndarray, weight: np.ndarray):
    """Each text's set as (sid, n, prefix, bits), and its fingerprint."""

    def prefix(g: np.ndarray) -> np.ndarray:
        n = len(g)
        if not n:
            return g
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, g), len(frequent) - 1)
            g = g[np.argsort(np.where(frequent[at] == g, weight[at], 0), kind="stable")]
        return g[: n - -(-NUM * n // DEN) + 1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.iloc[i : i + 500]
                fp, sid, n, heads, bits = [], [], [], [], []
                for h in shingle_hashes(part.text, width):
                    g = np.unique(h.view(np.int64))
                    fp.append(majority(h))
                    sid.append(xxhash.xxh3_128_digest(g.tobytes()))
                    n.append(len(g))
                    heads.append(prefix(g))
                    bits.append(presence(g))
                yield pd.DataFrame({"rid": part.rid, "doc_id": part.doc_id, "t": part.t, "fp": np.array(fp, np.uint64).view(np.int64), "sid": sid, "n": n, "prefix": heads, "bits": bits})

    return run


def _verify(width: int):
    """Those of the rows (src, dst, a, b), b the same over neighbouring rows, whose texts are alike."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 500):
                part = batch.iloc[i : i + 500]
                new = (part.b != part.b.shift()).to_numpy()
                hearts = shingle_sets(part.b[new], width)
                keep = [similar(a, hearts[k]) for a, k in zip(shingle_sets(part.a, width), np.cumsum(new) - 1, strict=True)]
                yield part.loc[keep, ["src", "dst"]]

    return run


def _like(n1: str, n2: str) -> str:
    """Sizes that allow the similarity."""
    return f"least({n1}, {n2}) * {DEN} >= greatest({n1}, {n2}) * {NUM}"


def similar_links(each: DataFrame, text_of, width: int = WIDTH, dense: int = DENSE, open_pairs: float = OPEN_PAIRS) -> DataFrame:
    """Links (src, dst) that connect all similar sets of ``each(node, n, fp, prefix, bits)``; ``text_of(nodes)`` gives (node, text)."""
    filed = each.select("node", "n", F.floor(F.log(CLASS_BASE, "n")).cast("int").alias("size"), F.explode("prefix").alias("token"))
    # counted and joined back, so that the rows of a frequent shingle need not lie in one task
    several = filed.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    shared = stored(filed.join(several, "token"))
    met = stored(shared.select("node").distinct())
    texts = stored(text_of(met))
    bits = stored(each.join(met, "node", "left_semi").select("node", "n", "bits"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs(src, dst)`` that are similar."""
        pairs = stored(pairs)  # its true size decides how the other columns are joined
        a, b = (bits.select(F.col("node").alias(i), F.col("n").alias(n), F.col("bits").alias(x)) for i, n, x in (("src", "n1", "a"), ("dst", "n2", "b")))
        pairs = stored(pairs.join(a, "src").join(b, "dst").select("src", "dst", "n1", "n2", "a", "b").mapInPandas(_within_budget, "src long, dst long"))
        a, b = (texts.select(F.col("node").alias(i), F.col("text").alias(x)) for i, x in (("src", "a"), ("dst", "b")))
        both = pairs.join(a, "src").join(b, "dst").select("src", "dst", "a", "b").sortWithinPartitions("dst")
        return stored(both.mapInPandas(_verify(width), "src long, dst long"))

    def rooted(links: DataFrame) -> DataFrame:
        roots = connected_components(links).withColumnRenamed("node", "_node")
        return stored(shared.join(roots, F.col("node") == F.col("_node"), "left").select("token", "size", "node", "n", F.coalesce("root", "node").alias("root")))

    # fingerprints: the first set of each, and the other sets of one fingerprint with that
    prints = each.join(met, "node", "left_semi").select("node", "fp")
    first = stored(prints.groupBy("fp").agg(F.min("node").alias("first")))
    near = fingerprint_links(first.select("fp"), dense)
    near = near.join(first.select(F.col("fp").alias("src"), F.col("first").alias("a")), "src").join(first.select(F.col("fp").alias("dst"), F.col("first").alias("b")), "dst")
    near = near.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).unionByName(prints.join(first, "fp").where("node <> first").select(F.col("node").alias("src"), F.col("first").alias("dst")))
    links = confirmed(near.distinct())

    rows, before = shared.count(), float("inf")
    now, k = rooted(links), 0
    while True:
        # one heart for all shingles at first, so that a group is compared with few sets; then one for each shingle
        order = F.xxhash64("node", F.lit(k)) if k == 0 else F.xxhash64("node", "token", F.lit(k))
        heart = now.groupBy("token", "size").agg(F.min_by(F.struct("node", "n", "root"), order).alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        heart = heart.where("lo < hi").select("token", "size", "c")
        pairs = now.join(heart, ["token", "size"]).where("root <> c.root").where(_like("n", "c.n"))
        found = confirmed(pairs.select(F.col("node").alias("src"), F.col("c.node").alias("dst")).distinct())
        if found.isEmpty():
            break
        links, k = links.unionByName(found), k + 1
        now = rooted(links)
        group = now.groupBy("token", "size", "root").agg(F.count("*").cast("double").alias("c")).groupBy("token", "size")
        left = group.agg((F.pow(F.sum("c"), F.lit(2)) - F.sum(F.col("c") * F.col("c"))).alias("p")).agg(F.coalesce(F.sum("p"), F.lit(0.0))).first()[0]
        if left / 2 <= open_pairs * rows or left > 0.9 * before:
            break
        before = left

    open_ = now.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("g")).where("lo < hi").select("token", "g")
    now = stored(now.join(open_, "token"))
    many, few = now.where(F.col("g") > BIG_GROUP), now.where(F.col("g") <= BIG_GROUP)
    # each pair meets in the size class of its larger set; ``big`` counts a set's shingles of large groups, which do not meet here
    big = many.groupBy("node").agg(F.count("*").alias("big"))
    few = few.join(big, "node", "left").withColumn("big", F.coalesce("big", F.lit(0)))
    own = ("size", "node", "n", "root", "big")
    a = few.select("token", F.explode(F.array("size", F.col("size") + 1)).alias("at"), *[F.col(c).alias(f"{c}1") for c in own])
    b = few.select("token", F.col("size").alias("at"), *[F.col(c).alias(f"{c}2") for c in own])
    pairs = a.join(b, ["token", "at"]).where("root1 <> root2 and (size1 < size2 or node1 < node2)").where(_like("n1", "n2"))
    # beyond what the prefixes share, a pair shares at most what lies behind the prefix that ends first
    behind = f"greatest((n1 * {NUM} + {DEN - 1}) div {DEN} - 1, (n2 * {NUM} + {DEN - 1}) div {DEN} - 1)"
    pairs = pairs.groupBy("node1", "node2", "n1", "n2", "big1", "big2").agg(F.count("*").alias("o"))
    pairs = pairs.where(f"(o + least(big1, big2) + {behind}) * {NUM + DEN} >= (n1 + n2) * {NUM}").select(F.col("node1").alias("src"), F.col("node2").alias("dst"))
    return links.unionByName(confirmed(pairs.unionByName(_in_large_groups(many, bits)).distinct()))


def _in_large_groups(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs (src, dst) of unconnected sets of like size that share a token and whose presence bits allow the similarity.

    A group is searched inside a task, its presence bits side by side, and only pairs within
    the budget come out. A group beyond ``BLOCK`` sets is cut into blocks, and each two
    blocks meet in a task of their own.
    """
    filed = rows.select("token", "node", "n", "root", "size", F.explode(F.array("size", F.col("size") + 1)).alias("at"))
    held = filed.groupBy("token", "at").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    filed = filed.join(held, ["token", "at"]).withColumn("own", own)
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("one"), F.greatest("own", j).alias("two")))
    filed = filed.withColumn("x", F.explode(both)).select("token", "at", "x.one", "x.two", "own", "node", "n", "root", "size").join(bits.select("node", "bits"), "node")
    key = ["token", "at", "one", "two"]
    dealt = filed.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInPandas(_search, "src long, dst long").distinct()


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams rows sorted by group; yields the pairs of each group that pass."""
    key, held = ["token", "at", "one", "two"], None
    for b in batches:
        if not len(b):
            continue
        b = b if held is None else pd.concat([held, b], ignore_index=True)
        new = np.flatnonzero((b[key] != b[key].shift()).any(axis=1).to_numpy())
        for x, y in zip(new[:-1], new[1:], strict=True):
            yield from _group_pairs(b.iloc[x:y])
        held = b.iloc[new[-1] :]
    if held is not None:
        yield from _group_pairs(held)


def _group_pairs(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
    if len(g) < 2 or g.root.nunique() < 2:
        return
    least = min(map(len, g.bits))
    folded = np.zeros((len(g), least // 8), np.uint64)
    for i, x in enumerate(g.bits):
        for part in np.frombuffer(x, np.uint64).reshape(-1, least // 8):  # halving again and again is the union of all parts
            folded[i] |= part
    n, root, own, node = (g[c].to_numpy() for c in ("n", "root", "own", "node"))
    at, across = int(g["at"].iloc[0]), bool(g.one.iloc[0] != g.two.iloc[0])
    here = g["size"].to_numpy() == at
    src, dst = [], []
    for i in range(len(g) - 1):
        j = np.flatnonzero((root[i + 1 :] != root[i]) & (here[i] | here[i + 1 :])) + i + 1
        if across:
            j = j[own[j] != own[i]]
        j = j[(np.minimum(n[j], n[i]) * DEN >= np.maximum(n[j], n[i]) * NUM)]
        if len(j):
            differ = np.bitwise_count(folded[j] ^ folded[i]).sum(1, dtype=np.int64)
            j = j[differ * (DEN + NUM) <= (n[j] + n[i]) * (DEN - NUM)]
            src += [max(node[i], x) for x in node[j].tolist()]
            dst += [min(node[i], x) for x in node[j].tolist()]
        if len(src) > 100_000:
            yield pd.DataFrame({"src": src, "dst": dst})
            src, dst = [], []
    if src:
        yield pd.DataFrame({"src": src, "dst": dst})


def _row_key(doc_id: str, hash_: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), hash_.cast("string"))


def near_copies(docs: DataFrame, width: int = WIDTH, dense: int = DENSE) -> DataFrame:
    """(doc_id, fingerprint, component_id, component, text_hash) for each row.

    component_id is the smallest doc_id reachable over pairs of texts whose sets of
    ``width``-word shingles have a Jaccard similarity of 0.8 or more. Null and empty
    texts are copies of each other. Rows of equal doc_id share what any of them
    reaches through its own text only. A null doc_id never names a component unless
    all of its members are null; ``component`` tells such components apart.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", body().alias("text"))
    texts = texts.withColumn("t", F.xxhash64("text"))
    made = _rows(width, *frequent_shingles(texts, width))
    whole = stored(texts.mapInPandas(made, "rid long, doc_id long, t long, fp long, sid binary, n long, prefix array<long>, bits binary"))
    rows = stored(whole.select("doc_id", "t", "fp", "sid"))
    # the first row of each set stands for it and names its text
    own = F.min(F.struct("rid", "doc_id", "t")).alias("own")
    each = whole.groupBy("sid").agg(F.min("doc_id").alias("low"), own, F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    each = stored(each.select(F.col("own.rid").alias("node"), "sid", "low", F.col("own.doc_id").alias("own"), F.col("own.t").alias("t"), "n", "fp", "prefix", "bits"))
    discard(whole)  # its prefixes and bits are held by ``each`` now

    def text_of(nodes: DataFrame) -> DataFrame:
        of = each.join(nodes, "node", "left_semi").select("node", _row_key("own", F.col("t")).alias("k"))
        found = docs.select("doc_id", body().alias("text")).select(_row_key("doc_id", F.xxhash64("text")).alias("k"), "text").join(of, "k")
        return found.groupBy("k").agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text")

    roots = connected_components(similar_links(each.select("node", "n", "fp", "prefix", "bits"), text_of, width, dense))
    named = each.select("node", "sid", "low").join(roots, "node", "left").select("sid", "low", F.coalesce("root", "node").alias("component"))
    linked = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = stored(named.join(linked, "component").select("sid", "component", "component_id"))
    print_ = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.select("doc_id", "fp", "sid", F.col("t").alias("text_hash")).join(named, "sid").select("doc_id", print_, "component_id", "component", "text_hash")

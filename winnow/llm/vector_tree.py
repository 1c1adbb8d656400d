"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is then put into a leaf. A query goes
down the tree with a priority queue: the open node whose centre has the largest inner
product is taken next, its children enter the queue, and a leaf is visited. How many
leaves a query visits is widened until a set of calibration queries, held against all
vectors, reaches the wanted recall.

Equal vectors are one entry of the index with the k + 1 smallest ids among them: as they
are equally near to any query, no other copy can be among its k nearest. Equal queries
are searched once. A leaf's entries are dealt into blocks of bounded size, and so are the
queries that visit it; blocks meet in groups of Spark.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .vectors import finite, matrix, stacked

#: vectors of a leaf that are aimed at, and leaves at most; beyond LEAF_ROWS * MAX_LEAVES vectors, leaves hold more
LEAF_ROWS, MIN_LEAVES, MAX_LEAVES = 1024, 16, 4096
#: vectors of the sample for each leaf of the tree, and at least
SAMPLE_EACH, SAMPLE_LEAST = 16, 2048
BRANCHES, STEPS = 16, 8
CALIBRATION_QUERIES, RECALL = 128, 0.95
#: vectors, and queries, of one group
ROW_BLOCK, QUERY_BLOCK = 4096, 4096
KEY = ["h1", "h2"]


class Tree:
    """Node centres with their children; nodes without children are the leaves, numbered in node order."""

    def __init__(self, centres: np.ndarray, children: list[list[int]]):
        self.centres, self.children = centres, children
        self.leaves = [i for i, c in enumerate(children) if not c]
        self.leaf_number = {node: i for i, node in enumerate(self.leaves)}

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: from the root to the nearest child (Euclid) at each node."""
        out = np.zeros(len(x), np.int32)
        open_ = [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf_number[node]
                continue
            c = self.centres[kids]
            nearest = ((c * c).sum(1)[None, :] - 2 * (x[rows] @ c.T)).argmin(1)
            open_ += [(kid, rows[nearest == i]) for i, kid in enumerate(kids) if (nearest == i).any()]
        return out

    def visits(self, queries: np.ndarray, count: int) -> np.ndarray:
        """The first ``count`` leaves of each query, best bin first."""
        count = min(count, len(self.leaves))
        out = np.zeros((len(queries), count), np.int32)
        for at in range(0, len(queries), 1024):
            near = queries[at : at + 1024] @ self.centres.T
            for i, row in enumerate(near.tolist()):
                queue, found = [(-row[0], 0)], 0
                while found < count:
                    _, node = heapq.heappop(queue)
                    if kids := self.children[node]:
                        for kid in kids:
                            heapq.heappush(queue, (-row[kid], kid))
                    else:
                        out[at + i, found] = self.leaf_number[node]
                        found += 1
        return out


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(STEPS):
        own = ((centres * centres).sum(1)[None, :] - 2 * (x @ centres.T)).argmin(1)
        filled, own = np.unique(own, return_inverse=True)
        centres = np.zeros((len(filled), x.shape[1]))
        np.add.at(centres, own, x)
        centres /= np.bincount(own)[:, None]
    return centres, ((centres * centres).sum(1)[None, :] - 2 * (x @ centres.T)).argmin(1)


def grow(sample: np.ndarray, leaves: int) -> Tree:
    """A tree of about ``leaves`` leaves: each node with more than its share of the sample is split by k-means."""
    share, rng = max(1, -(-len(sample) // max(1, leaves))), np.random.default_rng(0)
    centres, children = [sample.mean(0) if len(sample) else np.zeros(sample.shape[1])], [[]]
    open_ = [(0, np.arange(len(sample)))]
    while open_:
        node, rows = open_.pop()
        k = min(BRANCHES, -(-len(rows) // share))
        if k < 2:
            continue
        middle, own = _k_means(sample[rows], k, rng)
        if len(middle) < 2:  # the sampled vectors are one point
            continue
        for i, m in enumerate(middle):
            centres.append(m)
            children.append([])
            children[node].append(len(centres) - 1)
            open_.append((len(centres) - 1, rows[own == i]))
    return Tree(np.array(centres), children)


def _taking_part(rows: DataFrame) -> DataFrame:
    kept = rows.where(finite("embedding") & F.exists("embedding", lambda x: x != 0))
    return kept.withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})


def _entries(rows: DataFrame, ids: int) -> DataFrame:
    """(h1, h2, embedding, ids): each distinct vector once, with its smallest ids, nulls last."""
    last = F.col("vec_id").asc_nulls_last()
    first = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*KEY).orderBy(last))).where(F.col("_rn") <= ids)
    held = F.sort_array(F.collect_list(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")))
    return first.groupBy(*KEY).agg(F.first("embedding").alias("embedding"), F.transform(held, lambda s: s.vec_id).alias("ids"))


def fit(rows: DataFrame, dims: int, leaves: int) -> Tree:
    """A tree of a sample of the distinct vectors: those whose hash lies below a threshold, SAMPLE_EACH a leaf."""
    want = max(SAMPLE_LEAST, SAMPLE_EACH * leaves)
    share = min(1.0, want / max(1, rows.count()))
    picked = rows.where(F.pmod("h1", F.lit(1 << 32)) < int(share * (1 << 32))).dropDuplicates(KEY)
    picked = picked.orderBy(*KEY).limit(2 * want).select("embedding").toArrow()
    return grow(matrix(picked.column("embedding").combine_chunks(), dims) if picked.num_rows else np.zeros((0, dims)), leaves)


def _with_leaf(entries: DataFrame, tree: Tree, dims: int) -> DataFrame:
    shared = entries.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = shared.value.leaf_of(matrix(b.column("embedding"), dims)) if len(b) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], [*b.schema.names, "leaf"])

    return entries.mapInArrow(place, T.StructType([*entries.schema.fields, T.StructField("leaf", T.IntegerType())]))


def leaves_to_visit(entries: DataFrame, queries: DataFrame, tree: Tree, dims: int, k: int, recall: float) -> int:
    """The least number of leaves that finds ``recall`` of the k nearest of the calibration queries.

    The true neighbours come from a scan of all entries, in which each task keeps
    k of each calibration query. A query's own vector does not count.
    """
    asked = queries.orderBy(*KEY).limit(CALIBRATION_QUERIES).toArrow()
    if not asked.num_rows:
        return 1
    q, own = matrix(asked.column("embedding").combine_chunks(), dims), list(zip(asked.column("h1").to_pylist(), asked.column("h2").to_pylist(), strict=True))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in own]
        for b in batches:
            if not len(b):
                continue
            near = q @ matrix(b.column("embedding"), dims).T
            keys, leaf = list(zip(b.column("h1").to_pylist(), b.column("h2").to_pylist(), strict=True)), b.column("leaf").to_pylist()
            for i, row in enumerate(near):
                top = np.argpartition(-row, k)[: k + 1] if len(row) > k + 1 else np.arange(len(row))
                best[i] = heapq.nlargest(k, [*best[i], *((float(row[j]), leaf[j]) for j in top.tolist() if keys[j] != own[i])])
        rows = [(i, s, at) for i, found in enumerate(best) for s, at in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int32())], ["query", "score", "leaf"]
        )

    parts = entries.select("embedding", *KEY, "leaf").mapInArrow(nearest, "query int, score double, leaf int")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "leaf")
    truth = parts.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= k).select("query", "leaf").collect()
    place = [{leaf: n for n, leaf in enumerate(row)} for row in tree.visits(q, len(tree.leaves)).tolist()]
    needed = np.array([place[r.query][r.leaf] for r in truth])
    count = 1
    while count < len(tree.leaves) and len(needed) and (needed < count).mean() < recall:
        count += 1
    return count


def _visiting(queries: DataFrame, tree: Tree, dims: int, first: int, last: int) -> DataFrame:
    """``queries`` with a row for each of their leaves ``first`` to ``last`` in the order of the search."""
    shared = queries.sparkSession.sparkContext.broadcast(tree)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = shared.value.visits(matrix(b.column("embedding"), dims), last)[:, first:] if len(b) else np.zeros((0, 0), np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf.tolist(), pa.list_(pa.int32()))], [*b.schema.names, "leaf"])

    return queries.mapInArrow(walk, T.StructType([*queries.schema.fields, T.StructField("leaf", T.ArrayType(T.IntegerType()))])).withColumn("leaf", F.explode("leaf"))


def _sequential(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, summed from the first component to the last."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * x[:, d]
    return out


def _block_search(dims: int, ids: int):
    def search(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = ["h1", "h2", "score", "vec_id", "same"]
        if not len(entries) or not len(asked):
            return pd.DataFrame({n: [] for n in names})
        x, q = stacked(entries.embedding, dims), stacked(asked.embedding, dims)
        floor = asked.floor.to_numpy(np.float64)
        slack = 1e-12 * np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1).max())
        out = []
        for at in range(0, len(q), 512):
            near = q[at : at + 512] @ x.T
            if near.shape[1] > ids:
                least = np.maximum(floor[at : at + 512], np.partition(near, -ids, axis=1)[:, -ids])
            else:
                least = floor[at : at + 512]
            i, j = np.nonzero(near >= (least - slack[at : at + 512])[:, None])
            i += at
            score = _sequential(q[i], x[j])
            use = score >= floor[i]
            out.append((i[use], j[use], score[use]))
        i, j, score = (np.concatenate(c) for c in zip(*out, strict=True))
        e1, e2, q1, q2 = entries.h1.to_numpy(), entries.h2.to_numpy(), asked.h1.to_numpy(), asked.h2.to_numpy()
        held = entries.ids.to_numpy()
        found = pd.DataFrame({"h1": q1[i], "h2": q2[i], "score": score, "vec_id": [held[n] for n in j.tolist()], "same": (e1[j] == q1[i]) & (e2[j] == q2[i]), "i": i})
        found = found.explode("vec_id")
        found["vec_id"] = found.vec_id.astype("Int64")
        found = found.sort_values(["i", "score", "vec_id"], ascending=[True, False, True], kind="stable", na_position="last")
        return found.groupby("i").head(ids)[names]

    return search


def _best(found: DataFrame, ids: int) -> DataFrame:
    order = Window.partitionBy(*KEY).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), F.desc("same"))
    return found.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= ids)


def _searched(entries: DataFrame, asked: DataFrame, sizes: dict[int, int], dims: int, ids: int) -> DataFrame:
    """The best ``ids`` of each query in the leaves of ``asked(h1, h2, embedding, floor, leaf)``.

    sizes: entries of each leaf. A leaf has entries / ROW_BLOCK blocks of vectors and visits / QUERY_BLOCK of queries.
    """
    visits = {r.leaf: r["count"] for r in asked.groupBy("leaf").count().collect()}
    blocks = {leaf: (max(1, -(-sizes.get(leaf, 0) // ROW_BLOCK)), max(1, -(-visits.get(leaf, 0) // QUERY_BLOCK))) for leaf in {*sizes, *visits}}
    of = entries.sparkSession.createDataFrame([(leaf, a, b) for leaf, (a, b) in blocks.items()], "leaf int, row_blocks int, query_blocks int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = entries.join(F.broadcast(of), "leaf").withColumn("row_block", F.pmod("h2", "row_blocks").cast("int")).withColumn("query_block", every("query_blocks"))
    asked = asked.join(F.broadcast(of), "leaf").withColumn("query_block", F.pmod("h2", "query_blocks").cast("int")).withColumn("row_block", every("row_blocks"))
    by = ["leaf", "row_block", "query_block"]
    pairs = rows.select(*by, *KEY, "embedding", "ids").groupBy(*by).cogroup(asked.select(*by, *KEY, "embedding", "floor").groupBy(*by))
    return pairs.applyInPandas(_block_search(dims, ids), "h1 long, h2 long, score double, vec_id long, same boolean")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by inner product found for each row of ``vectors(vec_id, embedding)`` that ``is_query``.

    Score is the double inner product of the vectors as they are, summed in order; ties go to
    the smaller vec_id, nulls last. Only the row itself is left out: a repeated row finds its twin. Rows whose vector is
    null, empty, zero or holds a null, NaN or infinite component take no part. Shorter vectors
    count as filled up with zeros. Queries need an id. An empty table gives no rows. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    rows = _taking_part(vectors.select("vec_id", "embedding", is_query.alias("asks")))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    if not size.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ids, dims = k + 1, size.dims
    leaves = int(min(MAX_LEAVES, max(MIN_LEAVES, size.n // leaf_rows)))
    tree = fit(rows, dims, leaves)
    entries = stored(_with_leaf(_entries(rows, ids), tree, dims))
    asking = rows.where(F.col("asks") & F.col("vec_id").isNotNull())
    queries = stored(asking.groupBy(*KEY).agg(F.first("embedding").alias("embedding")))
    sizes = {r.leaf: r["count"] for r in entries.groupBy("leaf").count().collect()}
    count = leaves_to_visit(entries, queries, tree, dims, k, recall)

    # the first leaves give each query a score that later finds must reach
    early = max(1, count // 8)
    found = stored(_best(_searched(entries, _visiting(queries.withColumn("floor", F.lit(float("-inf"))), tree, dims, 0, early), sizes, dims, ids), ids))
    if early < count:
        floors = found.where(F.col("_rn") == ids).select(*KEY, F.col("score").alias("floor"))
        again = queries.join(floors, KEY, "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        found = found.drop("_rn").unionByName(_searched(entries, _visiting(again, tree, dims, early, count), sizes, dims, ids))
    top = _best(found, ids).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("_rn", "vec_id", "score", "same"))).alias("top"))
    out = asking.select("vec_id", *KEY).join(top, KEY)
    own = F.array_position(F.transform("top", lambda t: F.coalesce(t.same & (t.vec_id == F.col("vec_id")), F.lit(False))), F.lit(True))
    out = out.withColumn("own", own)
    left = F.slice(F.filter("top", lambda t, i: i + 1 != F.col("own")), 1, k)
    out = out.select(F.col("vec_id").alias("query_id"), F.posexplode(left).alias("pos", "t"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))

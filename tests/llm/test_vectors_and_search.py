"""Clustering, nearest neighbours and ranked search against brute force, with awkward rows."""

import collections
import hashlib
import math
import re

import duckdb
import numpy as np
import pytest

pytest.importorskip("winnow.llm")

from pyspark.sql import functions as F  # noqa: E402

from winnow.llm import annulus, lexical, queries, vector_tree  # noqa: E402

VECTORS = "vec_id long, embedding array<double>, cluster string, ids int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "own", 7) for i, v in rows], VECTORS)


def floats(rng, n, dims):
    return [[float(x) for x in row] for row in rng.normal(size=(n, dims))]


# --- clustering ---------------------------------------------------------------


def brute_clusters(rows, k, rounds, seed, dims):
    kept = [(i, [math.floor(1024 * x) if abs(x) < 1e300 else int(x) * 1024 for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    points = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda v: min((far(v, p), j) for j, p in enumerate(points))
    for _ in range(rounds):
        mine = collections.defaultdict(list)
        for _, v in kept:
            mine[place(v)[1]].append(v)
        points = [[sum(c) // len(mine[j]) for c in zip(*mine[j])] if j in mine else p for j, p in enumerate(points)]
    sums = collections.Counter()
    for _, v in kept:
        sums[place(v)[1]] += place(v)[0]
    cut = lambda d: d if d < 2**63 else None
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    out = [(i, place(v)[1], cut(place(v)[0]), cut(sums[place(v)[1]]), cut(sum(sums.values())), sha[place(v)[1]]) for i, v in kept]
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", [1, 0.01, 1e4, 1e30])
def test_clusters_equal_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(i, [x * scale for x in v]) for i, v in enumerate(floats(rng, 150, 4))]
    rows += [(7, rows[3][1]), (3, rows[3][1]), (None, rows[9][1]), (500, [0.0] * 4), (501, [0.0] * 4), (502, [-0.0] * 4)]
    rows += [(600, None), (601, []), (602, [1.0] * 3), (603, [1.0, None, 1.0, 1.0]), (604, [float("nan")] * 4), (605, [float("inf"), 0.0, 0.0, 0.0])]
    got = annulus.cluster(vectors(spark, rows).repartition(5), k=6, rounds=5, seed=3, dims=4)
    assert got.columns == ["vec_id", "ids", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert {r.ids for r in got.collect()} == {7}
    assert sorted((tuple(r) for r in got.drop("ids").collect()), key=str) == brute_clusters(rows, 6, 5, 3, 4)


def test_clusters_of_ties_and_huge_doubles(spark):
    rows = [(i, [float(i % 2 * 2 - 1), 0.0]) for i in range(40)] + [(100, [0.0, 0.0]), (101, [1.7e308, -1.7e308])]
    got = annulus.cluster(vectors(spark, rows), k=4, rounds=3, seed=3, dims=2).drop("ids")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows, 4, 3, 3, 2)


def test_annulus_leaves_out_far_centroids():
    points = [[j * 1000, 0] for j in range(1, 50)]
    x = np.array([[25_100.0, 0.0], [999.0, 1.0]])
    number, far = annulus.Centroids(points).nearest(x)
    assert number.tolist() == [24, 0] and far.tolist() == [10_000, 2]


def test_clusters_of_few_and_no_rows(spark):
    assert annulus.cluster(vectors(spark, [])).collect() == []
    assert annulus.cluster(vectors(spark, [(None, [1.0, 2.0])]), dims=2).collect() == []
    two = annulus.cluster(vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 4.0])]), dims=2).orderBy("vec_id").collect()
    assert {r.distance for r in two} == {0} and len({r.cluster for r in two}) == 2


# --- nearest neighbours -------------------------------------------------------


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]


def dot(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += x * y
    return s


def brute_nearest(rows, k, every):
    rows, out = usable(rows), []
    for n, (i, q) in enumerate(rows):
        if i is not None and i % every == 0:
            near = sorted((-dot(q, v), j is None, j or 0) for m, (j, v) in enumerate(rows) if m != n)[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(near)]
    return sorted(out, key=str)


def test_all_leaves_give_the_exact_neighbours(spark):
    rng = np.random.default_rng(1)
    rows = list(enumerate(floats(rng, 400, 6)))
    rows += [(1000 + i, rows[5][1]) for i in range(60)] + [(40, rows[40][1]), (None, rows[8][1]), (2000, [-x for x in rows[5][1]])]
    rows += [(3000, None), (3020, []), (3040, [0.0] * 6), (3060, [1.0, None]), (3080, [float("nan")] * 6), (3100, [float("inf")] * 6), (3120, [2.0, 1.0])]
    got = vector_tree.nearest(vectors(spark, rows).repartition(7), F.col("vec_id") % 20 == 0, k=5, recall=1.1, leaf_rows=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_nearest(rows, 5, 20)


def test_blocks_of_a_leaf_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(vector_tree, "ROW_BLOCK", 16)
    monkeypatch.setattr(vector_tree, "QUERY_BLOCK", 4)
    rows = list(enumerate(floats(np.random.default_rng(2), 300, 5)))
    got = vector_tree.nearest(vectors(spark, rows), F.col("vec_id") % 5 == 0, k=4, recall=1.1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_nearest(rows, 4, 5)


def test_few_and_no_vectors(spark):
    asks = F.col("vec_id") % 20 == 0
    assert vector_tree.nearest(vectors(spark, []), asks).collect() == []
    assert vector_tree.nearest(vectors(spark, [(0, [1.0])]), asks).collect() == []
    assert vector_tree.nearest(vectors(spark, [(1, [1.0])]), asks).collect() == []
    got = vector_tree.nearest(vectors(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0]), (3, [0.0])]), asks).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, -1.0)]


def test_calibrated_recall(spark):
    """On random vectors, which no tree separates, and on clusters, of which few leaves are read."""
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(60, 24)) * 4
    for x, most in ((rng.normal(size=(6000, 24)), 1.0), (middle[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 24)), 0.4)):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        found = collections.defaultdict(set)
        for r in vector_tree.nearest(rows, F.col("vec_id") % 20 == 0, k=20, leaf_rows=128).collect():
            found[r.query_id].add(r.vec_id)
        near = x[::20] @ x.T
        near[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
        hits = sum(len(found[20 * i] & set(np.argsort(-row)[:20].tolist())) for i, row in enumerate(near))
        assert hits / (300 * 20) >= 0.9
        tree = vector_tree.grow(x[:2048], 46)
        assert len({*tree.leaf_of(x).tolist()}) > 20
    hits = tree.visits(x[::20], int(len(tree.leaves) * most))
    leaf = tree.leaf_of(x)
    inside = [np.isin(leaf[np.argsort(-row)[:20]], hits[i]).mean() for i, row in enumerate(near)]
    assert np.mean(inside) >= 0.9


def test_query_recall_on_the_given_table(spark, sf_dir):
    found = collections.defaultdict(set)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    for r in queries.op12_nearest_neighbours(spark, sf_dir).collect():
        found[r.query_id].add(r.vec_id)
    truth = collections.defaultdict(set)
    for i, _, j, _ in brute_nearest([(r.vec_id, r.embedding) for r in rows], 20, 20):
        truth[i].add(j)
    assert found.keys() == truth.keys()
    assert sum(len(found[i] & t) for i, t in truth.items()) >= 0.9 * sum(map(len, truth.values()))


# --- ranked search ------------------------------------------------------------


def brute_ranked(docs, items, k):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))
    held = [(i, collections.Counter(split(t))) for i, t in docs if split(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in split(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


DOCS = [None, "", "...", "The cat; the CAT[the]cat", "the cat", "the cat", "été ÉTÉ Ünder_score x" + chr(0x85) + "y", "a " * 3000 + "cat", "dog", "the " * 50, "cat dog the " * 9, "0x1F a1b2", "é" * 900]
ITEMS = [(1, "the cat the"), (1, "the cat the"), (1, "dog"), (2, None), (3, "..."), (4, "nowhere"), (None, "été x 0x1f"), (5, "CAT dog cat a1b2 É"), (6, "the " * 400)]


@pytest.mark.parametrize("block_terms", [200_000, 3])
def test_ranks_equal_brute_force(spark, monkeypatch, block_terms):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 4)
    rng = np.random.default_rng(0)
    docs = [(i if i % 7 else None, t) for i, t in enumerate(DOCS * 3)] + [(100 + i, " ".join(f"w{x}" for x in rng.zipf(1.5, 30))) for i in range(60)]
    items = [*ITEMS, (9, "w1 w2 w2 w5 w40"), (10, "w1 w1")]
    frame = spark.createDataFrame([(i, t, "own", 1) for i, t in docs], "doc_id long, text string, terms string, n int").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, size int")
    got = lexical.ranked(frame, asked, k=4, block_terms=block_terms)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_ranked(docs, items, 4)


def test_ranks_without_rows(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert lexical.ranked(docs, items).collect() == []
    assert lexical.ranked(spark.createDataFrame([(1, "cat")], "doc_id long, text string"), items.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op13_ranked_search"])
def test_search_queries_equal_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = queries.queries()[name](spark, sf_dir)
    want = con.execute(queries.oracle_sql()[name]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)

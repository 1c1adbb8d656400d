"""Language identification by a string kernel.

Blended-spectrum presence kernel: two texts are as alike as the share of
distinct character n-grams (n from 1 to 4, over lower-cased text) that both hold,
``|A and B| / sqrt(|A| |B|)``. Kernel ridge regression, one language against the
rest, in the Nystroem space of ``landmarks`` training texts. N-grams are hashed
to ``DIM`` cells.

Scoring needs ``k(x, landmarks) @ weights``. As k is linear in the presence vector
up to its length, ``presence(landmarks).T @ weights`` is formed once and a block
of texts is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import set_aside, stored

DIM = 1 << 15
ORDERS = (1, 2, 3, 4)
#: bounds of the training sample: rows in all, shared by the languages, and rows that each language has at least if it has them
TRAIN_ROWS, MIN_EACH = 1600, 16
#: landmarks in all, and of each language at least
LANDMARKS, MIN_MARKS = 256, 4
#: picked ids that are broadcast at most; more are joined by a shuffle
BROADCAST_IDS = 100_000
RIDGE = 1e-2
UNKNOWN = "und"
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))


def cells(text: str) -> np.ndarray:
    """Sorted cells of the text's distinct n-grams."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(DIM, bool)
    step = 1 << 18
    for at in range(0, len(c), step):  # blocks overlap, so no n-gram is lost
        part = c[at : at + step + max(ORDERS) - 1]
        h = np.zeros(len(part), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(part) < n:
                break
            h = (h[: len(part) - n + 1] ^ (part[n - 1 :] + np.uint32(n))) * _MIX[n - 1]
            h ^= h >> np.uint32(15)
            if n in ORDERS:
                seen[(h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 15)] = True
    return np.flatnonzero(seen).astype(np.int32)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _cells_column(s: pd.Series) -> pd.Series:
    return pd.Series([cells(t) for t in s], dtype=object)


class Model:
    """Presence-space weights of each language; small and of fixed size."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, langs: list[str]):
        self.weights, self.bias, self.langs = weights, bias, langs

    def predict(self, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(found), DIM), np.float32)
        for i, f in enumerate(found):
            if len(f):
                x[i, f] = 1 / np.sqrt(len(f))
        y = x @ self.weights + self.bias
        best = y.argmax(1)
        e = np.exp(4 * (y - y.max(1, keepdims=True)))
        return best, e[np.arange(len(e)), best] / e.sum(1)


def fit(found: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Ridge regression of +1/-1 targets in the Nystroem space of evenly taken landmarks."""
    langs = sorted(set(labels))
    if not langs:
        return Model(np.zeros((DIM, 1), np.float32), np.zeros(1, np.float32), [UNKNOWN])
    p = np.zeros((len(found), DIM), np.float32)
    for i, f in enumerate(found):
        if len(f):
            p[i, f] = 1 / np.sqrt(len(f))
    by_lang = [[i for i, x in enumerate(labels) if x == lang] for lang in langs]
    each = max(MIN_MARKS, landmarks // len(langs))
    marks = p[[i for rows in by_lang for i in rows[:each]]]
    kmm = (marks @ marks.T).astype(np.float64)
    value, vector = np.linalg.eigh(kmm)
    use = value > 1e-6 * value.max() if value.max() > 0 else value > -1
    root = vector[:, use] / np.sqrt(np.maximum(value[use], 1e-12))
    z = (p @ marks.T).astype(np.float64) @ root
    target = np.where(np.array(labels)[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    mean, bias = z.mean(0), target.mean(0)
    gram = (z - mean).T @ (z - mean) + ridge * len(z) * np.eye(z.shape[1]) / max(1, z.shape[1])
    beta = np.linalg.solve(gram, (z - mean).T @ (target - bias))
    return Model((marks.T.astype(np.float64) @ (root @ beta)).astype(np.float32), (bias - mean @ beta).astype(np.float32), langs)


def training_rows(docs: DataFrame, rows: int = TRAIN_ROWS, least: int = MIN_EACH) -> DataFrame:
    """(lang, doc_id, cells): ``rows`` labelled rows, as many for each language, the first by a hash of doc_id.

    Every language is learned. Where they are so many that a share would be less than
    ``least`` rows, each has ``least``, and the sample grows with their number: the model that the driver
    fits has ``DIM`` numbers a language and ``least`` rows at least. Rows without a language, a text or a doc_id never train.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    langs = labelled.agg(F.count_distinct("lang")).first()[0]
    each = max(least, rows // max(1, langs))
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id")
    ids = labelled.select("doc_id", "lang", F.row_number().over(order).alias("rn")).where(F.col("rn") <= each).drop("rn")
    ids = stored(ids.distinct())
    picked = labelled.join(F.broadcast(ids) if each * langs <= BROADCAST_IDS else ids, ["doc_id", "lang"])
    return picked.select("lang", "doc_id", _cells_column("text").alias("cells"))


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    found = sorted((r.lang, r.doc_id, r.cells) for r in training_rows(docs, rows).collect())
    order = np.random.default_rng(0).permutation(len(found)).tolist()
    return fit([np.array(found[i][2], np.int32) for i in order], [found[i][0] for i in order])


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model, block: int = 64) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1). ``und`` with score 0 for null texts and texts without a letter."""
    docs, restored = set_aside(docs, ("text",))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in batches:
            names, scores = [], []
            for at in range(0, len(s), block):
                part = s.iloc[at : at + block]
                best, score = m.predict([cells(t) if t is not None else np.zeros(0, np.int32) for t in part])
                for t, b, p in zip(part, best.tolist(), score.tolist(), strict=True):
                    known = t is not None and any(map(str.isalpha, t))
                    names.append(m.langs[b] if known else UNKNOWN)
                    scores.append(float(p) if known else 0.0)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    out = docs.withColumn("_p", predict("text")).withColumns({"lang_pred": F.col("_p.lang_pred"), "score": F.col("_p.score")})
    return restored(out, ["lang_pred", "score"])

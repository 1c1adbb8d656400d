"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``. Null texts count as empty; repeated rows stay together until the
near-dedup stage, which keeps one row of each group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import decontam, line_dedup, packing, quality_rules, simhash
from winnow.llm.common import scratch, stored
from winnow.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality(docs).where("kept").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that at least five documents hold; n_chars follows the text."""
    kept = line_dedup.with_kept_text(docs, line_dedup.line_bitmaps(docs), "_kept")
    changed = {"text": F.when(F.col("n_dropped") > 0, F.col("_kept")).otherwise(F.col("text"))}
    out = kept.withColumns(changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (5-word Jaccard of 0.8 or more): that with the smallest doc_id, then text hash.

    A null doc_id is kept only where all of a group are null.
    """
    groups = simhash.near_duplicates(docs.select("doc_id", "text"), width=5, similarity=0.8)
    rows = groups.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    kept = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "copies")).alias("k"))
    kept = stored(kept.select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash"), F.col("k.copies").alias("_copies")))
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    of = lambda k: docs.join(k, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_hash == F.col("_hash")), "left_semi")
    repeated = kept.where("_copies > 1")
    if repeated.isEmpty():
        return of(kept)
    once = of(repeated).withColumn("_hash", text_hash).dropDuplicates(["doc_id", "_hash"]).drop("_hash")
    return of(kept.where("_copies = 1")).unionByName(once)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontam.clean(docs, benchmark)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.best_fit(packing.token_sizes(docs, tokenizer_path()))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: Fingerprints and packing have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result but the last is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

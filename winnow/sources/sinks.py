"""Writers. Logs, state and the registry are tables of :mod:`commits`: they change as a whole, and no writer undoes another's work."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import numbered
from ..operators.shaping import cell, csv_blank
from ..store import stored
from . import commits


def write_csv(df: DataFrame, path: str, blank_falsy: bool = False) -> None:
    """One CSV directory with a header; with ``blank_falsy`` zero and false are empty cells, as the ranked tables have them."""
    text = csv_blank if blank_falsy else (lambda c: c.cast("string"))
    df.select(*[text(F.col(f"`{c}`")).alias(c) for c in df.columns]).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


# Tables that are written under a second name as well.
SECOND_NAMES = {"logs": "entity_mapping_log"}


def write_tables(tables: dict[str, DataFrame], root: str, skip_empty: bool = True) -> list[str]:
    """One CSV directory for each table; an empty table is skipped, or written with its header as a workbook's tab is."""
    done = []
    for name, df in tables.items():
        if not (skip_empty and df.isEmpty()):
            for place in [name, *([SECOND_NAMES[name]] if name in SECOND_NAMES else [])]:
                write_csv(df, f"{root}/{place}")
                done.append(place)
    return done


def append_wal(rows: DataFrame, key: str, path: str, *order: Column) -> int:
    """``rows`` after all that the log holds, among themselves by ``order``. An append that breaks off leaves nothing in the log."""
    data = F.struct(*rows.columns)
    rows = rows.orderBy(*order) if order else rows
    lines = rows.select(F.col(key).cast("string").alias("key"), data.alias("data"), F.monotonically_increasing_id().alias("seq"))
    return commits.append(lines, path, kind="json")


def compact_wal(rows: DataFrame, path: str, version: int | None = None) -> int:
    """The log replaced by the (key, data) rows that were recovered from it, in order of their append and place.

    With the ``version`` that they were read at, rows which were appended since are never lost: a Conflict is raised.
    """
    order = [c for c in ("append", "seq") if c in rows.columns]
    lines = rows.orderBy(*order).select("key", "data", F.monotonically_increasing_id().alias("seq"))
    return commits.replace(rows.sparkSession, path, {commits.ROWS: lines}, expected=version, kind="json")


def truncate_wal(spark: SparkSession, path: str) -> int:
    """The log of a run that reached its target, emptied so that the next run starts afresh."""
    return commits.commit(spark, path, lambda parts: {})


def write_state(rows: DataFrame, path: str, crawler: str = "crawler") -> int:
    """State of the crawlers in ``rows`` replaced in one commit; that of others is kept, rows of a null crawler are not."""
    rows = stored(rows)
    names = [r[0] for r in rows.select(crawler).where(F.col(crawler).isNotNull()).distinct().collect()]
    return commits.replace(rows.sparkSession, path, {str(n): rows.where(F.col(crawler) == n) for n in names})


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """State of all crawlers as of the newest commit; an absent table is an empty one."""
    return commits.read(spark, path, schema, part=None)


def reset_state(spark: SparkSession, path: str, crawler: str | None = None) -> int:
    """The history of one crawler, or of all, forgotten."""
    return commits.commit(spark, path, lambda parts: {k: v for k, v in parts.items() if crawler is not None and k != crawler})


ENTITIES, DOMAINS = "canonical string", "domain string, canonical string"


def save_registry(entities: DataFrame, domains: DataFrame, root: str) -> int:
    """Both dimensions of the resolver in one commit, each in order, with what other writers saved meanwhile.

    Names are added to those that are there; a domain that is there already takes the given entity.
    """
    spark = entities.sparkSession
    entities = stored(entities.select("canonical").where(F.col("canonical").isNotNull()).distinct())
    domains = stored(domains.groupBy("domain").agg(F.min("canonical").alias("canonical")))

    def merged(now: commits.Snapshot) -> dict[str, DataFrame]:
        names = commits.read(spark, root, ENTITIES, "entities", now).unionByName(entities).distinct()
        kept = commits.read(spark, root, DOMAINS, "domains", now).join(domains.select("domain"), "domain", "left_anti")
        return {"entities": names.orderBy("canonical"), "domains": kept.unionByName(domains).orderBy("domain")}

    return commits.update(spark, root, merged)


def load_registry(spark: SparkSession, root: str, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, domains) of one version of a saved registry with the seeds added; seeds alone where none was saved."""
    now = commits.snapshot(spark, root)
    known = commits.read(spark, root, ENTITIES, "entities", now).unionByName(seeds.select("canonical")).distinct()
    return known, commits.read(spark, root, DOMAINS, "domains", now)


def append_new(rows: DataFrame, path: str, key: str, schema: str) -> None:
    """JSON lines of rows whose key the log at ``path`` does not hold yet, first of each key in the batch."""
    old = rows.sparkSession.read.schema(schema).json(path).select(F.col(key).alias("_k")) if _exists(rows.sparkSession, path, schema) else None
    fresh = rows if old is None else rows.join(stored(old.distinct()), F.col(key) == F.col("_k"), "left_anti")
    fresh.dropDuplicates([key]).write.mode("append").json(path)


def _exists(spark: SparkSession, path: str, schema: str) -> bool:
    try:
        spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def write_report(report: DataFrame, path: str) -> None:
    """The one-row run report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def sheet_batches(df: DataFrame, *order: str, size: int = 500, chars: int = 20_000) -> DataFrame:
    """Rows with capped cells and the number of their upload batch, dense from 0 in the order."""
    capped = df.select(*[cell(F.col(c), chars).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
    return numbered(capped, "_n", *order).withColumn("batch", F.floor(F.col("_n") / size)).drop("_n")


def write_telemetry(rows: DataFrame, path: str, by: str, flags: dict[str, Column]) -> DataFrame:
    """Counts of each ``by``: all rows and those of each flag, as JSON; returned as well."""
    counts = stored(rows.groupBy(by).agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()]))
    counts.coalesce(1).write.mode("overwrite").json(path)
    return counts

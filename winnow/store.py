"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: shuffle files of a finished statement are of no use to a table that is read from its files
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``, deleted when the application ends.

    Only on one machine (a local master, as in tests) an unset directory is replaced by
    a temporary one; on a cluster it is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = getattr(shared_folder, "_own", None) or "file://" + tempfile.mkdtemp(prefix="winnow-")
        shared_folder._own = base
    folder = f"{base.rstrip('/')}/winnow-{sc.applicationId}"
    made = getattr(shared_folder, "_made", set())
    if folder not in made:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        shared_folder._made = made | {folder}
    return folder


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    Cuts the lineage so that a lost executor costs no more than the stage at
    hand, and gives the planner a true size for what follows. The statement's shuffle
    files are removed when it is done.
    """
    spark = df.sparkSession
    path = scratch(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that :func:`stored` made, once all that is made of it is stored itself."""
    files = df.inputFiles()
    if files:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs in one process (tests) a local folder is set; a cluster without a shared
    folder is an error, as executors would write where nobody reads.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="veriflume-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


#: Rows that a Python worker gets at once while a table is written.
BATCH_ROWS = 1000


def _scratch(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/veriflume/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)  # rows are whole texts
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables that operators of this application wrote to the shared folder. Results that have not been read
    to their end by then can't be read any more, so only the session's owner knows when."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as decimal text, modulo ``n``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(n)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table of ids that is sent to every task; larger ones are joined by a shuffle.
SENT_ROWS = 1_000_000


def sendable(ids: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """``ids`` (a table of a few short values a row, as written), marked for broadcast if it has few enough rows."""
    return F.broadcast(ids) if ids.count() <= most else ids

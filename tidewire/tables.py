"""Tables written once to the folder that driver and executors share: lineage is cut, and later reads
work whichever executors are lost."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows and stored (compressed) bytes of a table that a join may broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where a local session has none, as in tests, one of our own is made."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidewire-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete all tables this application wrote; call it when its results are written elsewhere."""
    of = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    of.getFileSystem(spark._jsc.hadoopConfiguration()).delete(of, True)


def written(df: DataFrame, *by: str) -> DataFrame:
    """df as a written table, in folders by the columns of by; its row count is taken on the way."""
    spark = df.sparkSession
    path, seen = f"{_own(spark)}/{uuid.uuid4().hex}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._rows_written, table._path = seen.get["rows"], path
    return table


def tidied(df: DataFrame, *by: str) -> DataFrame:
    """written(df, *by), whose shuffles' files go as soon as it is written."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return written(df, *by)
    finally:
        conf.set(name, before)


def drop(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for path, spark in ((getattr(t, "_path", None), t.sparkSession) for t in tables):
        if path is not None:
            of = spark._jvm.org.apache.hadoop.fs.Path(path)
            of.getFileSystem(spark._jsc.hadoopConfiguration()).delete(of, True)


def bytes_of(df: DataFrame) -> int:
    """What a written table takes in its folder; 0 for others, whose rows alone are known."""
    path = getattr(df, "_path", None)
    if path is None:
        return 0
    of = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    return of.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(of).getLength()


def rows_of(df: DataFrame) -> int:
    known = getattr(df, "_rows_written", None)
    return df.count() if known is None else known


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, hinted for broadcast only if it holds at most `rows` rows and `size` bytes."""
    return F.broadcast(df) if rows_of(df) <= rows and bytes_of(df) <= size else df

"""What every operator of this subpackage needs from the session: written tables in the shared
folder, joins whose broadcast is checked by size, and bounded Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..tables import BROADCAST_BYTES, BROADCAST_ROWS, bytes_of, rows_of, shared_dir, small, written  # noqa: F401

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Send this package to Python workers, once a session, and keep Arrow batches small: whole texts can be long."""
    context = spark.sparkContext
    if getattr(context, "_tidewire_sent", None) is None:
        context._tidewire_sent = tempfile.mkdtemp(prefix="tidewire-code-")  # the driver serves it
        archive = os.path.join(context._tidewire_sent, "tidewire.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(os.path.join(_ROOT, "tidewire")):
                for name in names:
                    if name.endswith(".py"):
                        z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), _ROOT))
        context.addPyFile(archive)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def trim() -> None:
    """Give freed memory back: workers live on between tasks, and allocators keep what they once held."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def frugal(function):
    """A function of Arrow batches, which trims memory now and then and when its task ends."""

    def run(batches):
        for i, out in enumerate(function(batches)):
            yield out
            if i % 16 == 15:
                trim()
        trim()

    return run


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def is_empty(df: DataFrame) -> bool:
    return not rows_of(df) if hasattr(df, "_rows_written") else not df.take(1)


def drop(table: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    of = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._path)
    of.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(of, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

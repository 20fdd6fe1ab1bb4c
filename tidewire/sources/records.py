"""Reading and writing stage records: JSON lines, JSON documents, tables of captures, reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines by an explicit schema; a missing path is empty, a bad line fails."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def write_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_text(spark: SparkSession, body: str, path: str) -> None:
    """A small file, in whatever store the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(body.encode()))
    out.close()


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row as one pretty JSON file."""
    rows = report.toJSON().take(1)
    write_text(report.sparkSession, json.dumps(json.loads(rows[0]) if rows else {}, ensure_ascii=False, indent=2), path)


def write_health(stats: DataFrame, path: str) -> None:
    """Source health as tab-separated rows."""
    stats.select("source_id", "status", "fetched_items", F.substring(F.regexp_replace(F.coalesce("error", F.lit("")), r"[\t\n]", " "), 1, 120).alias("error")).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def config_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The arrays of a configuration document (companies, sources, ...) as tables, by name."""
    document = read_document(spark, path)
    return {f.name: document.select(F.posexplode(f.name).alias("ord", "x")).select("ord", "x.*") for f in document.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)}


def enabled(sources: DataFrame) -> DataFrame:
    return sources.filter(F.coalesce("enabled", F.lit(True))) if "enabled" in sources.columns else sources


def query_rows(queries: DataFrame, column: str = "query") -> DataFrame:
    """Query rows that are text, or JSON objects with q and more: q and extra."""
    parsed = F.from_json(F.when(F.startswith(F.trim(F.col(column)), F.lit("{")), F.col(column)), "map<string,string>")
    q = F.trim(F.coalesce(F.try_element_at(parsed, F.lit("q")), F.when(parsed.isNull(), F.col(column)), F.lit("")))
    return queries.withColumns({"q": q, "extra": F.coalesce(F.map_filter(parsed, lambda k, v: k != "q"), F.create_map().cast("map<string,string>"))})

"""State across runs as plain tables: seen articles with retention, the summary cache with its time to live."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as tx

RETENTION_DAYS, CACHE_DAYS = 14, 7


def seen_key(url: Column | str, fingerprint: Column | str) -> Column:
    return F.coalesce(F.nullif(tx.text(url), F.lit("")), F.nullif(tx.text(fingerprint), F.lit("")))


def retained(seen: DataFrame, run_date: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows last seen within the days before run_date (not before the wall clock, so backfills agree)."""
    return seen.filter(F.col("last_seen_date").try_cast("date") >= F.date_sub(F.lit(run_date).cast("date"), days))


def upserted(seen: DataFrame, items: DataFrame, run_date: str) -> DataFrame:
    """seen after items (resolved_url, fingerprint): found ones get run_date as last seen, new ones are
    added; one row a key, the earliest first-seen date wins."""
    old = seen.select("resolved_url", "fingerprint", "first_seen_date", "last_seen_date")
    new = items.select("resolved_url", "fingerprint", F.lit(run_date).alias("first_seen_date"), F.lit(run_date).alias("last_seen_date"))
    keyed = old.unionByName(new).withColumn("key", seen_key("resolved_url", "fingerprint")).filter(F.col("key").isNotNull())
    return keyed.groupBy("key").agg(
        F.min_by("resolved_url", F.struct("first_seen_date", "resolved_url")).alias("resolved_url"), F.max(F.coalesce("fingerprint", F.lit(""))).alias("fingerprint"),
        F.min("first_seen_date").alias("first_seen_date"), F.max("last_seen_date").alias("last_seen_date"),
    ).drop("key")


def cache_is_valid(updated_at: Column | str, as_of: Column, days: int = CACHE_DAYS) -> Column:
    stamp = F.try_to_timestamp(F.regexp_replace(tx.strip(updated_at), "Z$", "+00:00"))
    return F.coalesce(stamp >= as_of - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))


def pruned(cache: DataFrame, as_of: Column, days: int = CACHE_DAYS) -> DataFrame:
    return cache.filter(cache_is_valid("updated_at", as_of, days))


def with_cached(items: DataFrame, cache: DataFrame, as_of: Column, days: int = CACHE_DAYS) -> DataFrame:
    """items with their valid cache entry as a struct `cached` (null without one)."""
    fresh = pruned(cache, as_of, days).withColumn("_n", F.row_number().over(W.partitionBy("fingerprint").orderBy(F.desc("updated_at")))).filter("_n = 1").drop("_n")
    entry = fresh.select("fingerprint", F.struct(*[c for c in fresh.columns if c != "fingerprint"]).alias("cached"))
    return items.join(entry, "fingerprint", "left")


def cache_after(cache: DataFrame, briefs: DataFrame, as_of_text: str) -> DataFrame:
    """The cache with briefs' entries, their time set anew (so a hit lives on)."""
    fresh = briefs.withColumn("updated_at", F.lit(as_of_text)).select(*cache.columns)
    return cache.join(fresh.select("fingerprint"), "fingerprint", "left_anti").select(*cache.columns).unionByName(fresh)


def _store(spark, path: str):
    jvm = spark.sparkContext._jvm
    target, fresh, old = (jvm.org.apache.hadoop.fs.Path(path + x) for x in ("", ".new", ".old"))
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, fresh, old


def recovered(spark, path: str) -> bool:
    """Whether state lies at path, after a swap that broke off is undone: the state before it is never deleted
    while there is no other."""
    fs, target, _, old = _store(spark, path)
    if not fs.exists(target) and fs.exists(old):
        fs.rename(old, target)
    return fs.exists(target)


def swap_in(table: DataFrame, path: str) -> None:
    """Write state to a new place beside path, then move it there: readers never see a half-written table, and
    at any time the old or the new one is whole."""
    spark = table.sparkSession
    fs, target, fresh, old = _store(spark, path)
    had = recovered(spark, path)
    table.write.mode("overwrite").parquet(path + ".new")
    fs.delete(old, True)
    if had:
        fs.rename(target, old)
    if not fs.rename(fresh, target):
        raise OSError(f"{path}.new can't be moved")
    fs.delete(old, True)

"""Streaming forms of the day window and of the seen history: extensions of the batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def first_seen(items: DataFrame, ts: str = "published_at", days: int = 14) -> DataFrame:
    """Each canonical link once within `days`; state older than the watermark goes."""
    keyed = items.withColumn("link_key", tx.normalize_url("link"))
    return keyed.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark(["link_key"])


def daily_counts(items: DataFrame, ts: str = "published_at", key: str = "source_id", late: str = "1 hour") -> DataFrame:
    """Counts by natural day in UTC+8 (whose midnight is 16:00 UTC)."""
    return items.withWatermark(ts, late).groupBy(F.window(ts, "1 day", startTime="16 hours"), key).agg(F.count("*").alias("n"))

"""Order-sensitive exact deduplication and history.

"First" is by published time, latest first, then by seq, the position at which a source gave the row.
Keys that repeat a lot are safe: ranking keeps a group's first rows while it shuffles (window group limit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

LATEST = ("published_at_utc desc nulls last", "seq asc")


def _order(by) -> list[Column]:
    return [F.expr(x.rsplit(" ", 3)[0]).desc_nulls_last() if "desc" in x else F.expr(x.split(" ")[0]).asc() for x in by]


def first_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group of keys; rows with a null or empty key are all kept."""
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    ranked = rows.filter(keyed).withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")
    return ranked.unionByName(rows.filter(~keyed))


def dedup_link(rows: DataFrame, link: str = "link", order: list[Column] | None = None) -> DataFrame:
    return first_of(rows, [link], order or _order(LATEST))


def dedup_title(rows: DataFrame, title_key: str, order: list[Column] | None = None) -> DataFrame:
    return first_of(rows, [title_key], order or _order(LATEST))


def unseen(rows: DataFrame, seen: DataFrame, discovery: Column, link: str = "link", fingerprint: str = "fingerprint") -> DataFrame:
    """rows without those discovery rows whose link or fingerprint was seen: two anti joins, no OR join."""
    urls = seen.select(F.col("resolved_url").alias("_url")).filter(F.coalesce("_url", F.lit("")) != "").distinct()
    prints = seen.select(F.col("fingerprint").alias("_print")).filter(F.coalesce("_print", F.lit("")) != "").distinct()
    found = F.coalesce(discovery, F.lit(False))
    fresh = rows.filter(found).join(urls, F.col(link) == F.col("_url"), "left_anti").join(prints, F.col(fingerprint) == F.col("_print"), "left_anti")
    return fresh.unionByName(rows.filter(~found))

"""Checks of tables of companies and sources as violations: (table, id, rule, value) rows. See rules for a whole
configuration's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import text as tx

SOURCE_TYPES = ("rss", "query_rss", "search_api", "search_result", "official_api", "structured_web")
REGIONS = ("domestic", "foreign")
EXTRACTORS = ("css_selector", "json_ld", "sitemap")
_OUT = ["table", "id", "rule", "value"]


def is_http_url(c: Column | str) -> Column:
    return F.lower(tx.url_part(c, 1)).isin("http", "https") & (tx.url_part(c, 2) != "")


def _broken(rows: DataFrame, table: str, rule: str, bad: Column, value: Column | str, key: str = "id") -> DataFrame:
    return rows.filter(F.coalesce(bad, F.lit(True))).select(F.lit(table).alias("table"), F.col(key).cast("string").alias("id"), F.lit(rule).alias("rule"), tx.col(value).cast("string").alias("value"))


def duplicates(rows: DataFrame, table: str, key: str = "id") -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit(table).alias("table"), F.col(key).cast("string").alias("id"), F.lit("unique_id").alias("rule"), F.col("n").cast("string").alias("value"))


def dangling(rows: DataFrame, table: str, column: str, parents: DataFrame, parent_key: str = "id") -> DataFrame:
    """Rows whose non-empty column has no parent: an anti join."""
    asked = rows.filter(tx.strip(column) != "")
    lost = asked.join(parents.select(F.col(parent_key).alias("_parent")).distinct(), F.col(column) == F.col("_parent"), "left_anti")
    return lost.select(F.lit(table).alias("table"), F.col("id").cast("string").alias("id"), F.lit(f"unknown_{column}").alias("rule"), F.col(column).alias("value"))


def violations(companies: DataFrame, sources: DataFrame, providers: DataFrame | None = None, query_sets: DataFrame | None = None) -> DataFrame:
    """companies: id, name. sources: id, name, region, source_type, and, where needed, source_company_id,
    provider, query_set, entry_urls, extractor."""
    has = set(sources.columns)
    kind = F.lower(tx.strip("source_type"))
    found = [
        _broken(companies, "companies", "empty_name", tx.strip("name") == "", "name"), duplicates(companies, "companies"), duplicates(sources, "sources"),
        _broken(sources, "sources", "empty_name", tx.strip("name") == "", "name"), _broken(sources, "sources", "region", ~F.lower(tx.strip("region")).isin(*REGIONS), "region"),
        _broken(sources, "sources", "source_type", ~kind.isin(*SOURCE_TYPES), "source_type"),
    ]
    if "source_profile" in has:
        found.append(_broken(sources, "sources", "source_profile", (tx.strip("source_profile") != "") & ~F.lower(tx.strip("source_profile")).isin(*V.SOURCE_PROFILES), "source_profile"))
    if "source_company_id" in has:
        found.append(dangling(sources, "sources", "source_company_id", companies))
    if "provider" in has and providers is not None:
        found.append(dangling(sources, "sources", "provider", providers))
    if "query_set" in has and query_sets is not None:
        found.append(dangling(sources, "sources", "query_set", query_sets))
    if "entry_urls" in has:
        urls = F.coalesce("entry_urls", F.array().cast("array<string>"))
        found.append(_broken(sources, "sources", "entry_urls", kind.isin("structured_web", "rss") & (F.size(urls) == 0), F.lit("")))
        found.append(_broken(sources, "sources", "url_syntax", F.exists(urls, lambda u: ~is_http_url(u)), F.array_join(urls, " ")))
    if "extractor" in has:
        found.append(_broken(sources, "sources", "extractor", (tx.strip("extractor") != "") & ~F.lower(tx.strip("extractor")).isin(*EXTRACTORS), "extractor"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.select(*_OUT)


def counts(companies: DataFrame, sources: DataFrame) -> DataFrame:
    return companies.agg(F.count("*").alias("companies")).join(F.broadcast(sources.agg(F.count("*").alias("sources"))))

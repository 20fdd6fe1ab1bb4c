"""From a configuration to raw records: which URLs a source asks for, and how its answers are read.

The plan of requests is a small table made on the driver (one row a URL); bodies come from FetchSource
(captures or the network) and are parsed by type as DataFrames. A failed request is a row with an error.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from urllib.parse import urlencode

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import summaries as sm
from ..functions import text as tx
from ..tables import small, written
from . import feeds, fetching, wrappers

#: Endpoints, default parameters and limits of each provider.
NEWS_RSS = "https://news.google.com/rss/search"
RESULT_PAGES = {"bing_news": "https://www.bing.com/news/search", "toutiao_news": "https://so.toutiao.com/search"}
REGISTER = "https://www.federalregister.gov/api/v1/documents.json"
SEARCH_API = {"endpoint": "https://serpapi.com/search.json", "engine": "google_news", "api_key_env": "SERPAPI_API_KEY"}
MOST = {"query_rss": 30, "search_result": 20, "search_api": 10, "official_api": 10, "structured_web": 8}
RECENCY = "when:1d"
#: Cards of a result page that are read; the cap of a query is configured.
CARDS = 1000
_REQUEST = "source_id string, source_name string, source_type string, provider string, query string, query_group string, most int, url string, error string, request int"


def _queries(source: dict, config: dict) -> list[dict] | None:
    rows = config.get("query_sets", {}).get(str(source.get("query_set", "")).strip(), [])
    if not isinstance(rows, list):
        return None
    each = [{"q": r.strip()} if isinstance(r, str) else {**r, "q": str(r.get("q", "")).strip()} for r in rows if isinstance(r, (str, dict))]
    return [r for r in each if r["q"]]


def _pick(names: dict[str, str], *tables: dict) -> dict[str, str]:
    return {k: str(next((t[k] for t in tables if t.get(k) not in (None, "")), v)) for k, v in names.items()}


def requests_of(source: dict, config: dict) -> list[tuple]:
    """The rows of _REQUEST for one source; a row with an error and no URL where it can't be asked."""
    kind = str(source.get("source_type", "rss")).strip().lower() or "rss"
    provider, name = str(source.get("provider", "")).strip().lower(), str(source.get("name", ""))
    own = source.get({"rss": "max_items", "structured_web": "max_items_per_run"}.get(kind, "max_results_per_query"))
    most = int(own) if isinstance(own, int) and own > 0 else int(own or MOST.get(kind, 0)) or None
    row = lambda url, query="", group="", error="": (str(source.get("id", "")), name, kind, provider, query, group, most, url, error)
    fail = lambda error: [row("", error=error)]
    if kind == "rss":
        return [row(u) for u in source.get("rss_urls", [])]
    if kind == "structured_web":
        return [row(u) for u in source.get("entry_urls", [])] or fail("structured_web source missing entry_urls")
    if kind == "official_api":
        if provider != "federalregister":
            return fail("invalid official_api provider")
        return [row(fetching.official_url(source.get("endpoint", REGISTER), most, source.get("agency_slug", ""), source.get("query", "")))]
    if kind not in ("query_rss", "search_result", "search_api"):
        return fail(f"unsupported source_type={kind}")
    queries = _queries(source, config)
    if queries is None:
        return fail("invalid query set")
    if kind == "query_rss":
        if (provider or "google_news") != "google_news":
            return fail("invalid query_rss provider")
        token = str(config.get("defaults", {}).get("discovery_query_recency", RECENCY)).strip()
        out = []
        for r in queries:
            q = r["q"] if not token or token.lower() in r["q"].lower() else f"{r['q']} {token}"
            out.append(row(f"{NEWS_RSS}?{urlencode({'q': q} | _pick({'hl': 'en', 'gl': 'us', 'ceid': 'US:en'}, r, source))}", q, str(r.get("group", "")).strip().lower()))
        return out
    if kind == "search_result":
        if provider not in RESULT_PAGES:
            return fail("invalid search_result provider")
        extra = {"setlang": "en", "mkt": "en-US"} if provider == "bing_news" else {"page_num": "0", "source": "pagination", "action_type": "search_subtab_switch", "pd": "news", "dvpf": "pc"}
        return [row(f"{RESULT_PAGES[provider]}?{urlencode({('q' if provider == 'bing_news' else 'keyword'): r['q']} | _pick(extra, r, source))}", r["q"]) for r in queries]
    settings = SEARCH_API | config.get("search_providers", {}).get(provider, {})
    if not settings.get("enabled", True):
        return []
    key = os.environ.get(settings["api_key_env"], "").strip()
    if not key:
        return fail("search_api_missing_key")
    return [row(f"{settings['endpoint']}?{urlencode({'engine': settings['engine'], 'q': r['q'], 'api_key': key, 'num': most} | {k: r[k] for k in ('hl', 'gl', 'ceid', 'location') if r.get(k)})}", r["q"]) for r in queries]


def _with_headers(requests: DataFrame, config: dict) -> DataFrame:
    """requests with the headers that their source configures."""
    rows = [(str(s.get("id", "")), {str(k): str(v) for k, v in s["headers"].items()}) for s in config.get("sources", []) if isinstance(s.get("headers"), dict)]
    known = requests.sparkSession.createDataFrame(rows, "source_id string, headers map<string,string>").dropDuplicates(["source_id"])
    return requests.join(F.broadcast(known), "source_id", "left").withColumn("headers", F.coalesce("headers", F.create_map().cast("map<string,string>")))


def planned(spark: SparkSession, config: dict) -> DataFrame:
    """The requests of all enabled sources."""
    rows = [(*r, i) for s in config.get("sources", []) if s.get("enabled", True) for i, r in enumerate(requests_of(s, config))]
    return _with_headers(spark.createDataFrame(rows, _REQUEST), config)


def fetched(requests: DataFrame, transport: str = "capture", path: str = "", policy: fetching.Policy = fetching.Policy()) -> DataFrame:
    """requests (any table of url and error) with status, body (text), modified and error."""
    got = fetching.answered(requests, transport, path, policy)
    said = F.coalesce(F.nullif("error", F.lit("")), "failed", F.lit(""))
    return got.withColumns({"body": F.when(F.col("status").isNotNull(), markup.decode_udf()("body")), "error": said}).drop("failed", "final_url")


def _extraction(spark: SparkSession, config: dict) -> DataFrame:
    """source_id, extractor and selectors (a map) of each structured source: configuration."""
    rows = [(str(s.get("id", "")), str(s.get("extractor", "css_selector")).strip().lower(), {str(k): str(v) for k, v in (s.get("selectors") if isinstance(s.get("selectors"), dict) else {}).items()}) for s in config.get("sources", [])]
    return spark.createDataFrame(rows, "source_id string, extractor string, selectors map<string,string>").dropDuplicates(["source_id"])


def article_requests(answers: DataFrame, config: dict, year: int) -> DataFrame:
    """The article pages that structured sources' entry pages and sitemaps list, as requests: each link once, a source's
    first `most`; request is a page's place."""
    ways = _extraction(answers.sparkSession, config)
    entries = answers.filter("error = '' and source_type = 'structured_web'").join(F.broadcast(ways), "source_id")
    selector = F.coalesce(F.try_element_at("selectors", F.lit("article_link")), F.lit("a"))
    pages = entries.filter("extractor <> 'sitemap'")
    listed = feeds.article_links(pages, selector).unionByName(feeds.parse_sitemaps(entries.filter("extractor = 'sitemap'")), allowMissingColumns=True)
    placed = feeds.site_links(listed, year)
    first = placed.groupBy("source_id", "link").agg(F.min("pos").alias("pos"), F.max("most").alias("most"))
    kept = feeds.capped_items(first, F.col("most")).withColumnRenamed("pos", "request")
    names = answers.select("source_id", "source_name").distinct()
    named = kept.join(F.broadcast(names), "source_id").select("source_id", "source_name", F.lit("structured_web").alias("source_type"), F.lit("").alias("provider"), F.lit("").alias("query"), F.lit("").alias("query_group"), "most", F.col("link").alias("url"), F.lit("").alias("error"), F.col("request").cast("int").alias("request"))
    return _with_headers(named, config)


def article_rows(article_pages: DataFrame, config: dict, as_of: Column | None = None) -> DataFrame:
    """Items of fetched article pages (source_id, url, body and request), by each source's own selectors."""
    ways = _extraction(article_pages.sparkSession, config)
    given = article_pages.filter(F.col("body").isNotNull()).join(F.broadcast(ways), "source_id")
    found = given.withColumn("x", markup.article_columns("url", "body", F.col("selectors"), F.col("extractor") == "json_ld", as_of))
    place = F.col("request") if "request" in article_pages.columns else F.lit(0)
    rows = found.select("source_id", place.alias("request"), F.lit(0).alias("pos"), "x.title", "x.summary", "x.content", "x.link", "x.published", "x.attachment_link")
    return rows.filter((F.col("title") != "") & (F.col("link") != "") & ~feeds.invalid_record("source_id", "title", "link"))


_FIELDS = ("title", "summary", "content", "link", "published", "source_name", "attachment_link", "search_provider", "search_query", "search_display_time", "search_rank", "feed_published", "discovery_query", "discovery_query_group")


def raw_records(answers: DataFrame, fetched_at: str, config: dict, article_pages: DataFrame | None = None, ask: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Raw records (schemas.RAW and seq) of all types' answers, in the order of sources, requests and positions, within
    each connector's cap. article_pages (source_id, url, body, request) holds structured sources' pages; ask fetches
    what wrapped links need (see wrappers.resolved)."""
    ok = answers.filter("error = ''").withColumn("capped_by", F.when(F.col("source_type") == "rss", -1).otherwise(F.col("request")))
    kind = lambda k: ok.filter(F.col("source_type") == k)
    discovered = {"feed_published": F.col("published"), "discovery_query": F.col("query"), "discovery_query_group": F.col("query_group")}
    parts = [
        feeds.parse_feeds(kind("rss")), feeds.parse_feeds(kind("query_rss")).withColumns(discovered), feeds.parse_search_api(kind("search_api")), feeds.parse_official_api(kind("official_api")),
        *[feeds.parse_result_pages(kind("search_result").filter(F.col("provider") == p), p, CARDS).withColumn("pos", F.col("search_rank") - 1) for p in RESULT_PAGES],
    ]
    if article_pages is not None:
        parts.append(article_rows(article_pages, config))
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    whole = feeds.capped_items(whole.withColumn("capped_by", F.coalesce("capped_by", F.lit(-1))), F.col("most"), ("request", "pos"), ("source_id", "capped_by"))
    have = [c for c in _FIELDS if c in whole.columns]
    payload = F.map_filter(F.create_map(*[x for c in have for x in (F.lit(c), F.col(c).cast("string"))]), lambda k, v: v.isNotNull())
    dimension = answers.sparkSession.createDataFrame(
        [(str(s.get("id", "")), str(s.get("name", "")), str(s.get("source_type", "rss")).lower(), str(s.get("region", "foreign")).lower(), str(s.get("source_company_id", "")), i) for i, s in enumerate(config.get("sources", []))],
        "source_id string, name string, source_type string, region string, company_hint string, ord int",
    )
    rows = whole.select("source_id", "request", "pos", F.col("link").alias("url"), payload.alias("payload")).join(F.broadcast(dimension), "source_id")
    wrapped = F.col("source_type") == "query_rss"
    links = written(wrappers.resolved(rows.filter(wrapped).select("url").distinct(), "url", ask))
    resolved = rows.join(small(links), "url", "left")
    more = F.create_map(F.lit("resolved_url"), "resolved_url", F.lit("resolved_ok"), F.col("resolved_ok").cast("string"), F.lit("resolver_method"), "resolver_method", F.lit("resolver_token_decode_ok"), F.col("token_decoded").cast("string"), F.lit("google_news_link"), "url")
    payload = F.when(wrapped, F.map_concat(F.map_filter("payload", lambda k, v: k != "link"), more, F.create_map(F.lit("link"), F.when(F.col("resolved_ok"), F.col("resolved_url")).otherwise(F.col("url"))))).otherwise(F.col("payload"))
    return resolved.select(
        "source_id", F.col("name").alias("source_name"), "source_type", "region", "company_hint", F.lit(fetched_at).alias("fetched_at"), "url", payload.alias("payload"),
        (F.shiftleft(F.col("ord").cast("long"), 42) + F.shiftleft(F.coalesce("request", F.lit(0)).cast("long"), 24) + F.col("pos")).alias("seq"),
    )


def source_stats(answers: DataFrame, raw: DataFrame) -> DataFrame:
    """Status and classified error of each source: ok, partial (some items and an error) or fail."""
    errors = answers.groupBy("source_id", "source_name", "source_type").agg(F.array_join(F.filter(F.collect_list("error"), lambda e: e != ""), "; ").alias("error"))
    items = raw.groupBy("source_id").agg(F.count("*").cast("int").alias("fetched_items"))
    rows = errors.join(items, "source_id", "left").withColumn("fetched_items", F.coalesce("fetched_items", F.lit(0)))
    found = sm.classify_error("error")
    status = F.when(F.col("error") == "", "ok").when(F.col("fetched_items") > 0, "partial").otherwise("fail")
    return rows.select("source_id", "source_name", "source_type", status.alias("status"), F.substring("error", 1, 500).alias("error"), found["code"].alias("error_reason_code"), found["label"].alias("error_reason_zh"), F.substring(tx.text("error"), 1, 500).alias("error_raw"), "fetched_items")

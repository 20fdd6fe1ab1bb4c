"""Each rule of a configuration has a row that breaks it, and what is right breaks none."""

import copy

import pytest

from tidewire.operators import rules

GOOD = {
    "companies": [{"id": "w", "name": "Waymo"}], "search_providers": {"serp": {}}, "query_sets": {"q": ["a", {"q": "b", "group": "g"}]},
    "defaults": {
        "relevance_mode": " Balanced ", "core_keywords_foreign": ["a"], "fast_pass_enabled": True, "summary_style": "x", "window_days": "1_0", "top_n": 2.5, "window_mode": "prev_natural_day", "keyword_pair_rules": {"require_level_with_autonomous_context": False},
        "relevance_thresholds": {"newsroom": " 5 ", "else": "x"},
    },
    "sources": [
        {"id": "r", "region": "Domestic", "rss_urls": ["https://a.b/c"], "source_company_id": "w", "source_profile": "newsroom", "include_keywords": []}, {"id": "a", "region": "foreign", "source_type": "search_api", "provider": "serp", "query_set": "q"},
        {"id": "g", "region": "foreign", "source_type": "query_rss", "provider": "Google_News", "query_set": "q", "max_results_per_query": 5, "max_age_hours": True}, {"id": "b", "region": "foreign", "source_type": "search_result", "provider": "bing_news", "query_set": "q"},
        {"id": "o", "region": "foreign", "source_type": "official_api", "provider": "federalregister", "agency_slug": "x", "endpoint": ""}, {"id": "s", "region": "foreign", "source_type": "structured_web", "entry_urls": ["http://a"], "selectors": {}},
        {"id": "m", "region": "foreign", "source_type": "structured_web", "entry_urls": ["http://a"], "extractor": "sitemap", "selectors": []},
    ],
}


def _set(config: dict, path: str, value) -> None:
    *parts, last = path.split("/")
    for p in parts:
        config = config[int(p) if isinstance(config, list) else p]
    last = int(last) if isinstance(config, list) else last
    if value is ...:
        del config[last]
    else:
        config[last] = value


BAD = [
    ("defaults/relevance_mode", "fast", "relevance_mode:one_of"), ("defaults/core_keywords_foreign", ["a", 1], "core_keywords_foreign:strings"), ("defaults/summary_ban_phrases", "x", "summary_ban_phrases:strings"),
    ("defaults/fast_pass_enabled", 1, "fast_pass_enabled:bool"), ("defaults/drop_if_published_missing", "true", "drop_if_published_missing:bool"), ("defaults/summary_style", 3, "summary_style:string"), ("defaults/window_timezone", None, "window_timezone:string"),
    ("defaults/discovery_query_recency", [], "discovery_query_recency:string"), ("defaults/keyword_pair_rules", [], "keyword_pair_rules:object"), ("defaults/keyword_pair_rules/require_truck_with_autonomous_context", "x", "keyword_pair_rules.require_truck_with_autonomous_context:bool"),
    ("defaults/relevance_thresholds", 1, "relevance_thresholds:object"), ("defaults/relevance_thresholds/newsroom", "5.0", "relevance_thresholds.newsroom:int"), ("defaults/top_n", "many", "top_n:int"), ("defaults/window_days", None, "window_days:int"),
    ("defaults/discovery_max_results_per_query", [], "discovery_max_results_per_query:int"), ("defaults/window_mode", "week", "window_mode:one_of"), ("defaults", [], "defaults:object"), ("sources", {}, "sources:list"), ("companies", ..., "companies:list"),
    ("search_providers", [], "search_providers:object"), ("query_sets", [], "query_sets:object"), ("query_sets/q", "x", "rows:list"), ("query_sets/q/0", "  ", "q:filled"), ("query_sets/q/0", 3, "row:query"), ("query_sets/q/1/q", ..., "q:filled"),
    ("sources/0", "x", "row:object"), ("sources/0/id", " ", "id:filled"), ("sources/1/id", "r", "id:unique"), ("sources/0/region", "moon", "region:one_of"), ("sources/0/region", ..., "region:one_of"), ("sources/0/source_type", "browser_structured", "source_type:one_of"),
    ("sources/0/source_company_id", "nobody", "source_company_id:known_or_empty"), ("sources/0/rss_urls", [], "rss_urls:links"), ("sources/0/rss_urls", "https://a", "rss_urls:links"), ("sources/0/rss_urls/0", "ftp://a", "rss_urls:links"), ("sources/1/provider", "x", "provider:known"),
    ("sources/1/query_set", ..., "query_set:known"), ("sources/2/provider", "bing_news", "provider:one_of"), ("sources/2/query_set", "x", "query_set:known"), ("sources/2/max_results_per_query", "1.5", "max_results_per_query:int"), ("sources/2/max_age_hours", None, "max_age_hours:int"),
    ("sources/3/provider", "google_news", "provider:one_of"), ("sources/3/query_set", "x", "query_set:known"), ("sources/3/max_results_per_query", "x", "max_results_per_query:int"), ("sources/4/provider", "x", "provider:one_of"), ("sources/4/endpoint", "no", "endpoint:link_or_empty"),
    ("sources/4/agency_slug", ..., "agency_slug:filled"), ("sources/4/max_results_per_query", {}, "max_results_per_query:int"), ("sources/5/entry_urls", ..., "entry_urls:links"), ("sources/5/entry_urls/0", "a", "entry_urls:links"), ("sources/5/extractor", "css", "extractor:one_of"),
    ("sources/5/selectors", [], "selectors:object"), ("sources/0/source_profile", "blog", "source_profile:one_of"), ("sources/0/url_block_patterns", [1], "url_block_patterns:strings"), ("sources/0/external_link_allow_domains", "x", "external_link_allow_domains:strings"),
]


def test_each_rule(spark):
    """All configurations are told apart by a number before the id and checked together."""
    from pyspark.sql import functions as F

    assert rules.broken(rules.config_rows(spark, GOOD)).collect() == []
    for path, value, rule in BAD[::9]:  # apart, through the file's own form
        config = copy.deepcopy(GOOD)
        _set(config, path, value)
        assert rule in {r.rule for r in rules.broken(rules.config_rows(spark, config)).collect()}
    every = None
    for i, (path, value, _) in enumerate(BAD):
        config = copy.deepcopy(GOOD)
        _set(config, path, value)
        rows = rules.config_rows(spark, config).filter(~F.col("table").isin("companies", "search_providers", "query_sets") | (F.lit(i) < 0) | (F.col("table") == "query_sets"))
        rows = rows.withColumn("id", F.when(F.col("table").isin("sources", "config", "defaults", "query_rows"), F.concat_ws("/", F.lit(str(i)), "id")).otherwise(F.col("id")))
        every = rows if every is None else every.unionByName(rows)
    names = rules.config_rows(spark, GOOD).filter(F.col("table").isin("companies", "search_providers"))
    got = {}
    for r in rules.broken(every.unionByName(names)).collect():
        got.setdefault(r.id.split("/")[0], set()).add(r.rule)
    for i, (path, _, rule) in enumerate(BAD):
        expected = got.get("q", set()) if rule == "rows:list" else got.get(str(i), set())
        assert rule in expected, (path, rule, expected)


@pytest.mark.parametrize("table", sorted({r.table for r in rules.RULES}))
def test_every_rule_is_tried(table):
    known = {f"{r.field}:{r.check}" for r in rules.RULES if r.table == table}
    tried = {rule for _, _, rule in BAD}
    alike = {f"{f}:{c}" for f in (*rules._LISTS, *rules._BOOLS, *rules._TEXTS, *rules._WHOLE, "include_keywords", "exclude_keywords", "url_allow_patterns") for c in ("strings", "bool", "string", "int")}
    assert known <= tried | alike

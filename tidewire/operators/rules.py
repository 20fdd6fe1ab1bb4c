"""A configuration's rules as a table, checked against all of its rows in one pass.

A configuration row is (table, id, kind, fields): fields maps a name to what stands there, its JSON type, its text and,
of a list, its elements. Each row meets the rules of its table and kind; a rule names a field, a check and its arguments.
Rules that ask whether another row exists are joined to the names there are; ids are counted for repeats. The result
says all that is wrong, not only the first: (table, id, rule, value).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import text as tx
from ..tables import small, written
from .validate import is_http_url

CELL = "struct<kind:string,text:string,items:array<struct<kind:string,text:string>>>"
SCHEMA = f"table string, id string, kind string, fields map<string,{CELL}>"


class Rule(NamedTuple):
    """kinds: of rows (none: all). needed: a field that isn't there breaks the rule; else it is read as default."""

    table: str
    field: str
    check: str
    kinds: tuple[str, ...] = ()
    words: tuple[str, ...] = ()
    needed: bool = False
    default: str = ""


#: What each field may hold.
KINDS = ("rss", "search_api", "structured_web", "query_rss", "official_api", "search_result")
_LISTS = ("domestic_keywords", "foreign_keywords", "core_keywords_domestic", "core_keywords_foreign", "context_keywords_domestic", "context_keywords_foreign", "brand_keywords_domestic", "brand_keywords_foreign", "exclude_keywords_domestic", "exclude_keywords_foreign", "allow_missing_published_profiles", "fast_pass_title_keywords_zh", "fast_pass_title_keywords_en", "discovery_query_groups", "impact_target_taxonomy", "summary_ban_phrases")
_BOOLS = ("fast_pass_enabled", "fast_pass_require_company_or_context", "enable_general_media_source_cap", "strict_today_mode", "summary_require_so_what", "drop_if_published_missing", "drop_if_published_unparseable", "keyword_pair_rules.require_level_with_autonomous_context", "keyword_pair_rules.require_truck_with_autonomous_context")
_TEXTS = ("summary_style", "strict_today_timezone", "window_timezone", "discovery_query_recency")
_WHOLE = ("window_days", "top_n", "max_general_media_items_per_source", "fast_pass_window_hours", "summary_sentence_min", "summary_sentence_max", "discovery_max_results_per_query", *[f"relevance_thresholds.{k}" for k in ("general_media", "industry_media", "newsroom", "regulator", "research", "search_api")])
_ASKED = ("query_rss", "search_result", "search_api")

RULES: tuple[Rule, ...] = (
    *[Rule("config", f, "list", needed=True) for f in ("sources", "companies")],
    *[Rule("config", f, "object") for f in ("defaults", "search_providers", "query_sets")],
    *[Rule("defaults", f, "strings") for f in _LISTS], *[Rule("defaults", f, "bool") for f in _BOOLS], *[Rule("defaults", f, "string") for f in _TEXTS],
    *[Rule("defaults", f, "int") for f in _WHOLE], *[Rule("defaults", f, "object") for f in ("keyword_pair_rules", "relevance_thresholds")],
    Rule("defaults", "relevance_mode", "one_of", words=("high_precision", "balanced", "high_recall"), default="high_precision"), Rule("defaults", "window_mode", "one_of", words=("prev_natural_day",), default="prev_natural_day"),
    Rule("query_sets", "rows", "list", needed=True), Rule("query_rows", "row", "query", needed=True), Rule("query_rows", "q", "filled", needed=True),
    Rule("sources", "row", "object", needed=True), Rule("sources", "id", "filled", needed=True), Rule("sources", "region", "one_of", words=("domestic", "foreign"), needed=True), Rule("sources", "source_type", "one_of", words=("", *KINDS)),
    Rule("sources", "source_company_id", "known_or_empty", words=("companies",)), Rule("sources", "source_profile", "one_of", words=("", *V.SOURCE_PROFILES)),
    Rule("sources", "rss_urls", "links", ("rss",), needed=True), Rule("sources", "entry_urls", "links", ("structured_web",), needed=True),
    Rule("sources", "provider", "known", ("search_api",), ("search_providers",), needed=True), Rule("sources", "query_set", "known", _ASKED, ("query_sets",), needed=True),
    Rule("sources", "provider", "one_of", ("query_rss",), ("google_news",), needed=True), Rule("sources", "provider", "one_of", ("search_result",), ("bing_news", "toutiao_news"), needed=True), Rule("sources", "provider", "one_of", ("official_api",), ("federalregister",), needed=True),
    *[Rule("sources", f, "int", k) for f, k in (("max_results_per_query", ("query_rss", "search_result", "official_api")), ("max_age_hours", ("query_rss",)))],
    Rule("sources", "endpoint", "link_or_empty", ("official_api",)), Rule("sources", "agency_slug", "filled", ("official_api:federalregister",), needed=True),
    Rule("sources", "extractor", "one_of", ("structured_web",), ("css_selector", "json_ld", "sitemap"), default="css_selector"), Rule("sources", "selectors", "object", ("structured_web:css_selector", "structured_web:json_ld")),
    *[Rule("sources", f, "strings") for f in ("include_keywords", "exclude_keywords", "url_allow_patterns", "url_block_patterns", "external_link_allow_domains")],
)


def _json(value) -> str:
    return next((n for t, n in ((bool, "bool"), ((int, float), "number"), (str, "string"), (list, "list"), (dict, "object")) if isinstance(value, t)), "null")


def cell(value) -> tuple:
    """A JSON value as a field: lists keep their elements."""
    return _json(value), str(value) if not isinstance(value, (list, dict)) else "", [(_json(x), str(x)) for x in value] if isinstance(value, list) else None


def _flat(row: dict) -> dict:
    return {k: cell(v) for k, v in row.items()} | {f"{k}.{n}": cell(x) for k, v in row.items() if isinstance(v, dict) for n, x in v.items()}


def config_rows(spark: SparkSession, config: dict) -> DataFrame:
    """The rows of a configuration file."""
    lists = lambda k: config[k] if isinstance(config.get(k), list) else []
    objects = lambda k: config[k] if isinstance(config.get(k), dict) else {}
    low = lambda row, k, default="": str(row.get(k, default)).strip().lower()
    rows = [("config", "", "", {k: cell(v) for k, v in config.items()}), ("defaults", "", "", _flat(objects("defaults")))]
    rows += [("search_providers", str(k), "", {"row": cell(v)}) for k, v in objects("search_providers").items()]
    for name, asked in objects("query_sets").items():
        rows.append(("query_sets", str(name), "", {"rows": cell(asked)}))
        for i, r in enumerate(asked if isinstance(asked, list) else ()):
            said = {"q": cell(r)} if isinstance(r, str) else {k: cell(v) for k, v in r.items()} if isinstance(r, dict) else {"q": cell("-")}
            rows.append(("query_rows", f"{name}[{i}]", "", said | {"row": cell(r)}))
    rows += [("companies", str(c.get("id", "")).strip(), "", {}) for c in lists("companies") if isinstance(c, dict)]
    for i, s in enumerate(lists("sources")):
        own = s if isinstance(s, dict) else {}
        kind = low(own, "source_type", "rss") or "rss"
        part = low(own, "provider") if kind == "official_api" else low(own, "extractor", "css_selector")
        rows.append(("sources", str(own.get("id", "")).strip() or f"[{i}]", f"{kind}:{part}", _flat(own) | {"row": cell(s)}))
    return spark.createDataFrame(rows, SCHEMA)


def _broken(rule: Column, c: Column) -> Column:
    """Whether a field breaks a rule; known and known_or_empty are left to a join."""
    there, kind, check = c.isNotNull(), c["kind"], rule["check"]
    said = F.lower(tx.strip(F.when(there, c["text"]).otherwise(rule["default"])))
    items = F.coalesce(c["items"], F.array().cast("array<struct<kind:string,text:string>>"))
    whole = kind.isin("number", "bool") | ((kind == "string") & tx.strip(c["text"]).rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"))
    tests = {
        "list": kind != "list", "object": kind != "object", "bool": kind != "bool", "string": kind != "string", "int": ~whole, "query": ~kind.isin("string", "object"),
        "strings": (kind != "list") | F.exists(items, lambda x: x["kind"] != "string"), "filled": tx.strip(c["text"]) == "",
        "links": (kind != "list") | (F.size(items) == 0) | F.exists(items, lambda x: ~F.coalesce(is_http_url(x["text"]), F.lit(False))),
        "one_of": ~F.array_contains(rule["words"], said), "link_or_empty": (tx.strip(c["text"]) != "") & ~F.coalesce(is_http_url(tx.strip(c["text"])), F.lit(False)),
    }
    out = F.lit(False)
    for name, test in tests.items():
        out = F.when(check == name, test).otherwise(out)
    return F.when(there | ((check == "one_of") & ~rule["needed"]), F.coalesce(out, F.lit(True))).otherwise(rule["needed"])


def broken(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """table, id, rule, value: every rule that a row of SCHEMA breaks."""
    listed = F.array(*[F.struct(*[(F.array(*[F.lit(w) for w in v]).cast("array<string>") if isinstance(v, tuple) else F.lit(v)).alias(k) for k, v in r._asdict().items()]) for r in rules])
    kind = F.split_part("kind", F.lit(":"), F.lit(1))
    mine = lambda r: (r["table"] == F.col("table")) & ((F.size(r["kinds"]) == 0) | F.array_contains(r["kinds"], kind) | F.array_contains(r["kinds"], F.col("kind")))
    met = rows.select("table", "id", "fields", F.explode(F.filter(listed, mine)).alias("rule")).withColumn("c", F.try_element_at("fields", "rule.field"))
    plain, asks = ~F.startswith("rule.check", F.lit("known")), F.startswith("rule.check", F.lit("known"))
    name = tx.strip("c.text")
    shown = F.when(F.col("c").isNull(), "").when(F.col("c.items").isNotNull(), F.array_join("c.items.text", " ")).otherwise(F.col("c.text"))
    code = F.concat_ws(":", "rule.field", "rule.check")
    found = met.filter(plain & _broken(F.col("rule"), F.col("c"))).select("table", "id", code.alias("rule"), shown.alias("value"))
    names = written(rows.select(F.col("table").alias("_table"), F.col("id").alias("_name")).filter(F.col("_table").isin("companies", "search_providers", "query_sets")).distinct())
    asking = met.filter(asks).withColumns({"_table": F.element_at("rule.words", 1), "_name": name}).filter((F.col("rule.check") == "known") | (F.col("_name") != ""))
    lost = asking.join(small(names), ["_table", "_name"], "left_anti").select("table", "id", code.alias("rule"), shown.alias("value"))
    twice = rows.filter("table = 'sources'").groupBy("table", "id").agg(F.count("*").alias("n")).filter("n > 1").select("table", "id", F.lit("id:unique").alias("rule"), F.col("n").cast("string").alias("value"))
    return found.unionByName(lost).unionByName(twice)

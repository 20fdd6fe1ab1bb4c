"""Which records stay: the ladder of hard constraints, keyword signals, the additive score, fast pass,
the candidate gate, thresholds and the per-source cap. All columns; no Python runs on the rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import vocabulary as V
from ..functions import dates, text as tx

COMPONENTS = ("core", "title", "context", "brand", "company", "semantic", "profile", "search_api", "negative", "pair_penalty", "strategic_shift_bonus", "safety_milestone_bonus")


@dataclass(frozen=True)
class Settings:
    """Keyword lists by region and switches; lists are normalised on use."""

    mode: str = "high_precision"
    zone: str = "Asia/Shanghai"
    thresholds: dict[str, int] = field(default_factory=dict)
    core: dict[str, tuple] = field(default_factory=dict)
    context: dict[str, tuple] = field(default_factory=dict)
    brand: dict[str, tuple] = field(default_factory=dict)
    exclude: dict[str, tuple] = field(default_factory=dict)
    blocked_publishers: dict[str, tuple] = field(default_factory=dict)
    company_aliases: tuple = V.KNOWN_COMPANY_ALIASES
    semantic: tuple = V.SEMANTIC_TERMS
    fast_pass: bool = True
    fast_pass_titles: tuple = V.FAST_PASS_TITLE_ZH + V.FAST_PASS_TITLE_EN
    fast_pass_needs_signal: bool = True
    company_signal_for_general_media: bool = True
    source_cap: int = 2
    source_cap_on: bool = False
    pair_level: bool = True
    pair_truck: bool = True
    drop_missing: bool = True
    drop_unparseable: bool = True

    def threshold(self, key: Column) -> Column:
        table = V.THRESHOLDS[self.mode if self.mode in V.THRESHOLDS else "high_precision"] | self.thresholds
        out = F.lit(V.UNKNOWN_PROFILE_THRESHOLD)
        for name, value in table.items():
            out = F.when(key == name, value).otherwise(out)
        return out


def with_sources(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Items with their source's configuration (prefixed s_); unknown ones count as media by RSS. The
    table of sources is configuration: one small row a source, the last of a repeated id."""
    given = sources if "ord" in sources.columns else sources.withColumn("ord", F.monotonically_increasing_id())
    last = given.groupBy("source_id").agg(F.max_by(F.struct(*[c for c in sources.columns if c not in ("source_id", "ord")]), "ord").alias("s"))
    one = last.select("source_id", *[F.col(f"s.{c}").alias(f"s_{c}") for c in sources.columns if c not in ("source_id", "ord")], F.lit(True).alias("s_known"))
    joined = items.join(F.broadcast(one), "source_id", "left")
    lists = ("entry_urls", "external_link_allow_domains", "url_allow_patterns", "url_block_patterns", "include_keywords", "exclude_keywords")
    known = F.coalesce("s_known", F.lit(False))
    return joined.withColumns({f"s_{c}": F.coalesce(f"s_{c}", F.array().cast("array<string>")) for c in lists} | {
        "s_source_type": F.when(known, F.lower(F.coalesce(F.trim("s_source_type"), F.lit("")))).otherwise(F.lit("rss")),
        "s_category": F.when(known, F.coalesce("s_category", F.lit(""))).otherwise(F.lit("media")),
        "s_source_profile": F.lower(F.trim(F.coalesce("s_source_profile", F.lit("")))),
    }).drop("s_known")


def profile(explicit: Column, category: Column) -> Column:
    category = F.lower(F.trim(category))
    return (
        F.when(explicit.isin(*V.SOURCE_PROFILES), explicit).when(category == "media", F.lit("general_media"))
        .when(category.isin("newsroom", "regulator", "research"), category).otherwise(F.lit("industry_media"))
    )


def normalize_method(source_type: Column | str) -> Column:
    low = F.lower(tx.strip(source_type))
    return F.when(low.isin(*V.METHODS), low).when(low == "browser_structured", F.lit("structured_web")).otherwise(F.lit(""))


def _within(host: Column, domains: Column) -> Column:
    return F.exists(domains, lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)))


def _in_region(items: Column, lists: dict[str, tuple], use) -> Column:
    return F.when(items == "domestic", use(tx.words_of(lists.get("domestic", ())))).otherwise(use(tx.words_of(lists.get("foreign", ()))))


def drop_reason(settings: Settings, run_date: str, as_of: Column) -> Column:
    """The first of the hard constraints that a row from with_sources() breaks; null if none."""
    url = tx.normalize_url("link")
    path, host = F.lower(tx.url_part(url, 3)), F.lower(tx.url_part(url, 2))
    lowered = lambda c: F.filter(F.transform(c, lambda x: F.lower(F.trim(x))), lambda x: x != "")
    entries = F.filter(F.transform("s_entry_urls", lambda x: F.lower(tx.url_part(x, 2))), lambda x: x != "")
    external = (F.size(entries) > 0) & ~_within(host, entries)
    allowed = external & _within(host, lowered("s_external_link_allow_domains"))
    allow, block = lowered("s_url_allow_patterns"), lowered("s_url_block_patterns")
    inside = lambda patterns: F.exists(patterns, lambda p: F.contains(path, p))
    kind, status = F.when(F.col("s_source_type") == "", F.lit("")).otherwise(F.col("s_source_type")), F.lower(tx.strip("published_parse_status"))
    ts = dates.parse_datetime("published_at_utc", as_of)["ts"]
    missing = F.coalesce("published_missing", F.lit(False)) | (tx.strip("published_at_utc") == "")
    unsure = missing | (F.lit(settings.drop_unparseable) & F.startswith(status, F.lit("unparseable"))) | (F.lit(settings.drop_missing) & (status == "missing"))
    publisher = F.lower(tx.strip("source_name"))
    blocked = _in_region(F.lower(tx.strip("region")), settings.blocked_publishers, lambda words: _within(publisher, F.array(*[F.lit(w) for w in words])) if words else F.lit(False))
    return F.coalesce(
        F.when(url == "", F.lit("url_invalid")),
        F.when(path.isin("", "/"), F.lit("url_homepage")),
        F.when(external & ~allowed, F.lit("url_external_domain_not_allowed")),
        F.when(~allowed & inside(block), F.lit("url_blocked_pattern")),
        F.when(~allowed & (F.size(allow) > 0) & ~inside(allow), F.lit("url_not_in_allow_patterns")),
        F.when((kind == "query_rss") & ~F.coalesce("resolved_ok", F.lit(True)), F.lit("query_rss_unresolved_url")),
        F.when((kind == "query_rss") & (status == "query_rss_unverified"), F.lit("query_rss_unverified_published")),
        F.when((kind == "search_result") & (status == "search_result_unverified"), F.lit("search_result_unverified_published")),
        F.when(unsure, F.lit("published_missing_or_unparseable")),
        F.when(~F.coalesce(dates.in_window(ts, run_date, settings.zone), F.lit(False)), F.lit("outside_window")),
        F.when((kind == "query_rss") & (publisher != "") & blocked, F.lit("blocked_publisher")),
    )


def _once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """rows with the columns, computed once: later filters and uses aren't folded into them."""
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def with_signals(rows: DataFrame, settings: Settings) -> DataFrame:
    """Adds the arrays of hits. Scores and bonuses are functions of these."""
    title, whole = F.lower(tx.strip("title")), F.lower(F.concat_ws(" ", tx.strip("title"), tx.strip("content"), tx.strip("source_name")))
    body = F.lower(F.concat_ws(" ", tx.strip("title"), tx.strip("content")))
    rows = _once(rows, {"_title": title, "_all": whole, "_body": body, "_region": F.lower(F.coalesce(F.nullif(tx.strip("region"), F.lit("")), F.lit("foreign")))})
    listed = lambda c: F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    by_region = lambda lists: _in_region(F.col("_region"), lists, lambda ws: F.array(*[F.lit(w) for w in ws]) if ws else F.array().cast("array<string>"))
    core = F.array_sort(F.array_union(by_region(settings.core), listed("s_include_keywords")))
    exclude = F.array_sort(F.array_union(by_region(settings.exclude), listed("s_exclude_keywords")))
    found = {
        "core_hits": tx.hits("_all", core), "core_title_hits": tx.hits("_title", core), "context_hits": tx.hits("_all", by_region(settings.context)),
        "brand_hits": tx.hits("_all", by_region(settings.brand)), "company_hits": tx.hits("_all", tx.words_of(settings.company_aliases)),
        "semantic_hits": tx.hits("_all", settings.semantic), "negative_hits": tx.hits("_all", exclude), "autonomy_hits": tx.hits("_all", V.AUTONOMY_CONTEXT),
        "level_hits": tx.hits("_all", V.LEVEL_TERMS), "truck_hits": tx.hits("_all", V.TRUCK_TERMS), "fast_pass_hits": tx.hits("_title", tx.words_of(settings.fast_pass_titles)),
    }
    return _once(rows, found)


def score_parts(settings: Settings) -> dict[str, Column]:
    """The components by name, over the columns of with_signals()."""
    n = lambda c: F.size(c)
    stepped = lambda c, base, most, each: F.when(n(c) > 0, base + F.least(F.lit(most), n(c) * each)).otherwise(0)
    named = (n("company_hits") + n("brand_hits")) > 0
    points = F.lit(0)
    for name, value in V.PROFILE_POINTS.items():
        points = F.when(F.col("profile") == name, value).otherwise(points)
    alone = n("autonomy_hits") == 0
    pair = F.when(F.lit(settings.pair_level) & (n("level_hits") > 0) & alone, -14).otherwise(0) + F.when(F.lit(settings.pair_truck) & (n("truck_hits") > 0) & alone, -18).otherwise(0)
    shift = F.when((named | tx.any_hit("_body", V.STRATEGIC_COMPANIES)) & tx.any_hit("_body", V.STRATEGIC_AUTONOMY) & tx.any_hit("_body", V.STRATEGY_SIGNALS), 18).otherwise(0)
    shift = shift + F.when(tx.any_hit("_title", V.STRATEGIC_COMPANIES) & tx.any_hit("_title", V.STRATEGIC_TITLE_AUTONOMY), 8).otherwise(0)
    safety = F.when((named | tx.any_hit("_body", V.SAFETY_ENTITIES)) & tx.any_hit("_body", V.SAFETY_AUTONOMY) & tx.any_hit("_body", V.SAFETY_MILESTONES), 12).otherwise(0)
    safety = safety + F.when(tx.any_hit("_title", V.SAFETY_TITLE), 6).otherwise(0)
    return {
        "core": stepped("core_hits", 20, 25, 8), "title": stepped("core_title_hits", 10, 15, 6), "context": F.least(F.lit(12), n("context_hits") * 3),
        "brand": F.least(F.lit(16), n("brand_hits") * 4), "company": stepped("company_hits", 8, 18, 5), "semantic": F.least(F.lit(12), n("semantic_hits") * 4),
        "profile": points, "search_api": F.when(F.col("s_source_type") == "search_api", 4).otherwise(0), "negative": -F.least(F.lit(36), n("negative_hits") * 12),
        "pair_penalty": pair, "strategic_shift_bonus": F.least(F.lit(22), shift), "safety_milestone_bonus": F.least(F.lit(16), safety),
    }


def judged(items: DataFrame, sources: DataFrame, settings: Settings, run_date: str, as_of: Column) -> DataFrame:
    """items with relevance_stage, relevance_reason ("kept", "fast_pass" or the drop reason), its label,
    relevance_score, the score's breakdown and the matched words. Rows that break a hard constraint take
    no part in scoring: each later column is guarded, so their signals aren't evaluated."""
    rows = with_sources(items, sources)
    rows = _once(rows, {"profile": profile(F.col("s_source_profile"), F.col("s_category")), "_hard": drop_reason(settings, run_date, as_of)})
    rows = with_signals(rows, settings)
    ok = F.col("_hard").isNull()
    rows = _once(rows, {f"p_{k}": v for k, v in score_parts(settings).items()})
    total = F.greatest(F.lit(0), F.least(F.lit(100), sum((F.col(f"p_{k}") for k in COMPONENTS[1:]), F.col("p_core"))))
    signal = F.size("company_hits") + F.size("brand_hits") + F.size("context_hits")
    fast = F.lit(settings.fast_pass) & (F.size("fast_pass_hits") > 0) & ((signal > 0) | F.lit(not settings.fast_pass_needs_signal))
    gate = (signal + F.size("semantic_hits")) > 0
    pair_broken = (F.col("p_pair_penalty") < 0) & (F.size("core_hits") + F.size("company_hits") + F.size("autonomy_hits") == 0)
    general = F.lit(settings.company_signal_for_general_media) & (F.col("profile") == "general_media") & (F.size("core_hits") + F.size("company_hits") == 0)
    threshold = settings.threshold(F.when(F.col("s_source_type") == "search_api", F.lit("search_api")).otherwise(F.col("profile")))
    reason = (
        F.when(~ok, F.col("_hard")).when(fast, F.lit("fast_pass")).when(~gate, F.lit("candidate_gate_miss")).when(pair_broken, F.lit("pair_rule_mismatch"))
        .when(general, F.lit("general_no_core_or_company")).when(total < threshold, F.lit("score_below_threshold")).otherwise(F.lit("kept"))
    )
    rows = _once(rows, {"relevance_reason": reason})
    reason = F.col("relevance_reason")
    scored = reason.isin("pair_rule_mismatch", "general_no_core_or_company", "score_below_threshold", "kept")
    rows = rows.withColumns({
        "relevance_stage": F.when(~ok, F.lit("hard")).when(reason == "fast_pass", F.lit("fast_pass")).otherwise(F.lit("stage2")),
        "relevance_score": F.when(reason == "fast_pass", 100).when(scored, total).otherwise(0),
        "relevance_score_breakdown": F.when(scored, F.struct(*[F.col(f"p_{k}").cast("int").alias(k) for k in COMPONENTS])),
        "method": normalize_method("s_source_type"),
    })
    if settings.source_cap_on:
        rows = capped(rows, settings.source_cap)
    rows = rows.withColumns({"relevance_keep": F.col("relevance_reason").isin("kept", "fast_pass"), "relevance_reason_zh": reason_label("relevance_reason")})
    matched = {"core_hits": "matched_core_keywords", "context_hits": "matched_context_keywords", "brand_hits": "matched_brand_keywords", "company_hits": "matched_company_aliases", "fast_pass_hits": "matched_fast_pass_title_keywords"}
    gone = [c for c in rows.columns if c.startswith(("_", "s_", "p_"))] + ["core_title_hits", "semantic_hits", "negative_hits", "autonomy_hits", "level_hits", "truck_hits"]
    return rows.withColumnsRenamed(matched).drop(*gone)


def capped(rows: DataFrame, most: int) -> DataFrame:
    """General media keep their latest `most` kept rows of a source; others get general_source_cap."""
    kept = F.col("relevance_reason").isin("kept", "fast_pass") & (F.col("profile") == "general_media")
    place = F.row_number().over(W.partitionBy("source_id", kept).orderBy(F.desc("published_at_utc"), "seq"))
    return rows.withColumn("relevance_reason", F.when(kept & (place > most), F.lit("general_source_cap")).otherwise(F.col("relevance_reason")))


def reason_label(c: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for kv in V.REASON_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, tx.col(c)), tx.col(c))


def routed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped with drop_reason and drop_reason_zh) of judged rows, which should be written once first."""
    return rows.filter("relevance_keep"), rows.filter(~F.col("relevance_keep")).withColumns({"drop_reason": F.col("relevance_reason"), "drop_reason_zh": F.col("relevance_reason_zh")})

"""The daily run as plans: raw to canonical to judged to briefs to a digest. Stages are DataFrames; write
them where a later one reads them twice."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import dates, markup, summaries as sm, text as tx
from ..operators import dedup, relevance, reports, state

DISCOVERY = ("query_rss", "search_result")
#: What a failed page says of a date's verification (fixed values).
VERIFY_CODES = {"access_forbidden": "fetch_forbidden", "timeout": "fetch_timeout", "ssl_error": "fetch_ssl_error"}


def canonical(raw: DataFrame, as_of: Column, pages: DataFrame | None = None, marked: bool = False) -> DataFrame:
    """Canonical records of raw rows (with seq, their position) that have a title and a link; marked, all rows, with
    usable false where one of both is missing. Discovery
    rows' dates are verified in pages (link, html, last_modified, error), if given; a search result's own
    time is trusted."""
    of = lambda k: F.coalesce(F.try_element_at("payload", F.lit(k)), F.lit(""))
    content = F.coalesce(F.nullif(tx.clean_text(of("content")), F.lit("")), tx.clean_text(of("summary")))
    link = tx.normalize_url(F.coalesce(F.nullif(of("link"), F.lit("")), F.col("url")))
    kind = F.lower(tx.strip("source_type"))
    rows = raw.withColumns({
        "title": tx.clean_text(of("title")), "content": F.substring(content, 1, 8000), "link": link, "source_type": kind, "_raw": tx.strip(of("published")),
        "source_name": tx.strip(F.coalesce(F.nullif(of("source_name"), F.lit("")), F.col("source_name"))), "region": F.lower(tx.strip(F.coalesce("region", F.lit("foreign")))),
        "discovery_query_group": F.lower(tx.strip(of("discovery_query_group"))), "_resolved": F.lower(of("resolved_ok")) == "true", "_url": tx.strip(of("resolved_url")),
    }).withColumn("usable", (F.col("title") != "") & (F.col("link") != ""))
    rows = rows if marked else rows.filter("usable").drop("usable")
    rows = rows.withColumn("_feed", dates.parse_datetime("_raw", as_of))
    discovery = F.col("source_type").isin(*DISCOVERY)
    trusted = (F.col("source_type") == "search_result") & (F.col("_feed.status") == "ok")
    resolved = F.when(F.col("source_type") == "search_result", F.col("link") != "").when(F.col("source_type") == "query_rss", F.col("_resolved")).otherwise(F.lit(True))
    if pages is None:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("_html", "_modified", "_failed")})
    else:
        failed = F.col("error") if "error" in pages.columns else F.lit("")
        rows = rows.join(pages.select("link", F.when(failed == "", F.col("html")).alias("_html"), F.col("last_modified").alias("_modified"), failed.alias("_failed")), "link", "left")
    needed = discovery & ~trusted & resolved & F.col("_html").isNotNull()
    rows = rows.withColumn("_found", F.when(needed, markup.article_date_udf()("_html", "link")))
    rows = rows.withColumns({"_page": dates.parse_in_region("_found.raw", "region", as_of), "_head": dates.parse_datetime("_modified", as_of), "_fetched": dates.parse_datetime("fetched_at", as_of)})
    near = F.abs(F.unix_timestamp("_fetched.ts") - F.unix_timestamp("_head.ts")) <= 48 * 3600
    by_page, by_head = F.col("_page.status") == "ok", (F.col("_head.status") == "ok") & near
    plain = ~discovery | trusted
    ts = F.when(plain, F.when(F.col("_feed.status") == "ok", F.col("_feed.ts"))).otherwise(F.when(needed & by_page, F.col("_page.ts")).when(needed & by_head, F.col("_head.ts")))
    unverified = F.when(F.col("source_type") == "query_rss", "query_rss_unverified").otherwise("search_result_unverified")
    source = F.when(trusted, "search_result_display_time").when(plain, "feed").when(ts.isNull(), "unresolved").when(by_page, F.col("_found.source")).otherwise("last_modified")
    why = sm.classify_error(F.coalesce("_failed", F.lit("")))
    kinds = F.create_map(*[F.lit(x) for pair in VERIFY_CODES.items() for x in pair])
    code = F.when(plain | ts.isNotNull(), "").when(~resolved, "resolver_failed").when(F.col("_html").isNull(), F.coalesce(F.try_element_at(kinds, why["code"]), F.lit("fetch_other"))).otherwise("published_not_found")
    rows = rows.withColumns({"published_at": ts, "published_at_utc": F.coalesce(dates.utc_iso(ts), F.lit("")), "published_missing": ts.isNull()})
    rows = rows.withColumns({
        "published_parse_status": F.when(plain, F.col("_feed.status")).when(ts.isNotNull(), "ok").otherwise(unverified), "published_source": source,
        "query_rss_verify_error_code": code, "resolved_ok": resolved, "resolved_url": F.when(F.col("source_type") == "search_result", F.col("link")).otherwise(F.col("_url")),
        "id": F.sha1(F.concat_ws("|", "link", "published_at_utc", "title")), "fingerprint": tx.fingerprint("title"), "language": tx.detect_language(F.concat_ws(" ", "title", "content")),
        "query_rss_verify_error_zh": F.when(code == "", "").when(F.startswith(code, F.lit("fetch_")), F.coalesce(F.nullif(why["label"], F.lit("")), F.lit(V.UNKNOWN_ERROR[1]))).otherwise(F.lit(V.REASON_LABELS["query_rss_unverified_published"])),
    })
    return rows.drop(*[c for c in rows.columns if c.startswith("_")], "payload")


def to_verify(raw: DataFrame, as_of: Column) -> DataFrame:
    """link: the pages in which canonical() would look for the dates of discovery rows."""
    rows = canonical(raw, as_of).filter(F.col("source_type").isin(*DISCOVERY) & F.col("published_missing") & F.col("resolved_ok"))
    return rows.select("link").distinct()


def _title_key() -> Column:
    return F.coalesce(F.nullif(tx.normalize_title("title"), F.lit("")), F.lower(tx.strip("title")))


def deduplicated(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """By link, then against history, then by title."""
    titled = dedup.dedup_link(rows).withColumn("title_key", _title_key())
    fresh = dedup.unseen(titled, seen, F.col("source_type").isin(*DISCOVERY))
    return dedup.dedup_title(fresh, "title_key").drop("title_key")


def pre_candidate_drops(marked: DataFrame, seen: DataFrame) -> DataFrame:
    """method, reason, n: what records lost before they were candidates. marked are canonical()'s rows and, with usable
    false, those it leaves out. deduplicated()'s steps are followed in one pass: a link's records are counted by
    method and combined to the first of them, firsts are marked by history and combined again by title, and
    every row carries what it stands for. Counts are combined before they move, so a frequent link or title is a
    few rows a task."""
    no_title, dup_link, old, dup_title = (F.lit(r) for r in V.PRE_CANDIDATE_REASONS.values())
    place = F.struct("published_at_utc", (-F.col("seq")).alias("minus"))  # the greatest is the first; a null time is the last
    key = lambda c: F.coalesce(F.nullif(tx.text(c), F.lit("")), F.concat(F.lit("\0"), tx.text("seq")))  # noqa: E731  an empty key has no equal
    method, found = relevance.normalize_method("source_type"), F.coalesce(F.col("source_type").isin(*DISCOVERY), F.lit(False))
    rows = marked.select("usable", method.alias("method"), F.when(F.col("usable"), key("link")).alias("link_key"), F.struct("link", "fingerprint", found.alias("found"), _title_key().alias("title"), method.alias("method"), F.col("seq")).alias("x"), place.alias("place"))
    by_method = rows.groupBy("usable", "link_key", "method").agg(F.count("*").alias("n"), F.max_by("x", "place").alias("x"), F.max("place").alias("place"))
    by_link = by_method.groupBy("usable", "link_key").agg(F.collect_list(F.struct("method", "n")).alias("counts"), F.max_by("x", "place").alias("x"), F.max("place").alias("place"))
    urls = seen.select(F.col("resolved_url").alias("_url")).filter(tx.text("_url") != "").distinct()
    prints = seen.select(F.col("fingerprint").alias("_print")).filter(tx.text("_print") != "").distinct()
    known = by_link.join(urls, F.col("usable") & (F.col("x.link") == F.col("_url")), "left").join(prints, F.col("usable") & (F.col("x.fingerprint") == F.col("_print")), "left")
    seen_before = F.col("x.found") & (F.col("_url").isNotNull() | F.col("_print").isNotNull())
    lost = F.transform("counts", lambda c: F.struct(F.lit(False).alias("live"), c["method"].alias("method"), F.when(F.col("usable"), dup_link).otherwise(no_title).alias("reason"), (c["n"] - (F.col("usable") & (c["method"] == F.col("x.method"))).cast("long")).alias("n")))
    first = F.array(F.struct((~seen_before).alias("live"), F.col("x.method").alias("method"), F.when(seen_before, old).otherwise(dup_title).alias("reason"), F.lit(1).cast("long").alias("n")))
    each = known.select("x", "place", F.explode(F.when(F.col("usable"), F.concat(lost, first)).otherwise(lost)).alias("y"))
    titled = each.select("y.*", "place", F.when(F.col("y.live"), F.coalesce(F.nullif("x.title", F.lit("")), F.concat(F.lit("\0"), tx.text("x.seq")))).alias("title_key"))
    counted = titled.groupBy("live", "title_key", "method", "reason").agg(F.sum("n").alias("n"), F.max("place").alias("place"))
    by_title = counted.groupBy("live", "title_key").agg(F.collect_list(F.struct("method", "reason", "n")).alias("counts"), F.max_by("method", "place").alias("first"))
    left = by_title.select("live", "first", F.explode("counts").alias("c")).select("c.method", "c.reason", (F.col("c.n") - (F.col("live") & (F.col("c.method") == F.col("first"))).cast("long")).alias("n"))
    return left.filter("method <> ''").groupBy("method", "reason").agg(F.sum("n").alias("n")).filter("n > 0")


def enriched(rows: DataFrame, pages: DataFrame, least: int = 500) -> DataFrame:
    """Short contents replaced by the page's article text where that is longer; pages: link, html."""
    short = rows.filter((F.char_length("content") < least) & (F.col("link") != "")).select("link").distinct()
    bodies = pages.join(short, "link", "left_semi").select("link", markup.body_udf()("html").alias("_body"))
    both = rows.join(bodies, "link", "left")
    better = (F.char_length("content") < least) & (F.char_length(F.coalesce("_body", F.lit(""))) > F.char_length("content"))
    return both.withColumns({"enriched": F.coalesce(better, F.lit(False)), "content": F.when(better, F.col("_body")).otherwise(F.col("content"))}).drop("_body")


def judged_summaries(rows: DataFrame, cache: DataFrame, as_of: Column, provider=None) -> DataFrame:
    """rows with s, the summary that is shown, and how it came about: cached_status, first_status, second_status and
    fallback_status, each "ok", "failed" or a broken rule, null where there was no such try. A valid cache entry comes first, then the
    provider (a function from rows with wanted to rows with a struct `summary`, null where it fails, as
    operators.provider.summarized), then fixed sentences, and other ones if they break a rule."""
    rule = lambda c: sm.validation(f"{c}.what", f"{c}.why", f"{c}.so_what", f"{c}.impact_targets")
    held = state.with_cached(rows, cache, as_of)
    held = held.withColumn("_c", F.when(F.col("cached").isNotNull(), sm.from_cache(F.col("cached"), "title", "content")))
    held = held.withColumn("cached_status", F.when(F.col("_c").isNotNull(), rule("_c")))
    held = held.withColumn("wanted", F.coalesce(F.col("cached_status") != "ok", F.lit(True)))
    if provider is not None:
        held = provider(held)
    none = {"summary": F.lit(None).cast("struct<title_zh:string,what:string,why:string,so_what:string,impact_targets:array<string>,tags:array<string>,confidence:double,importance:int>"), "first_status": F.lit(None).cast("string"), "second_status": F.lit(None).cast("string")}
    held = held.withColumns({k: v for k, v in none.items() if k not in held.columns})
    held = held.withColumns({"_m": F.when(F.col("wanted") & F.col("summary").isNotNull() & (rule("summary") == "ok"), sm.normalized(F.col("summary"), "title", "content")), "_f": sm.fallback("title", "content")})
    alone = F.col("wanted") & F.col("_m").isNull()
    held = held.withColumn("fallback_status", F.when(alone, rule("_f")))
    shown = F.when(~F.col("wanted"), F.col("_c")).when(~alone, F.col("_m")).when(F.col("fallback_status") == "ok", F.col("_f")).otherwise(sm.last_resort("title", "content"))
    return held.withColumn("s", shown).drop("_c", "_m", "_f", "wanted", "cached", "summary")


def briefs(rows: DataFrame, cache: DataFrame, as_of: Column, provider=None) -> DataFrame:
    """Briefs of judged_summaries()."""
    return shown(judged_summaries(rows, cache, as_of, provider))


def shown(held: DataFrame) -> DataFrame:
    """judged_summaries' rows as briefs."""
    company = F.coalesce(F.nullif(tx.strip("company_hint"), F.lit("")), F.lit("other"))
    return held.select(
        "id", "source_id", "source_name", "region", company.alias("company_id"), F.col("s.title_zh").alias("title_zh"), sm.compose("s.what", "s.why", "s.so_what").alias("summary_zh"),
        F.col("s.what").alias("summary_what"), F.col("s.why").alias("summary_why"), F.col("s.so_what").alias("summary_so_what"), "s.impact_targets", "s.tags",
        F.lit(V.SUMMARY_VERSION).alias("summary_format_version"), "link", "published_at_utc", "s.confidence", "s.importance", "fingerprint", "seq",
    )


@dataclass
class Run:
    canonical: DataFrame
    judged: DataFrame
    kept: DataFrame
    dropped: DataFrame
    funnel: DataFrame
    reasons: DataFrame


def run(raw: DataFrame, sources: DataFrame, seen: DataFrame, settings: relevance.Settings, run_date: str, as_of: Column, pages: DataFrame | None = None) -> Run:
    rows = deduplicated(canonical(raw, as_of, pages), seen)
    judged = relevance.judged(rows, sources, settings, run_date, as_of).persist()
    kept, dropped = relevance.routed(judged)
    staged = judged.select("method", F.lit(False).alias("fetched"), F.lit(True).alias("candidate"), (~F.col("relevance_keep")).alias("filtered"), F.col("relevance_keep").alias("kept"))
    fetched = raw.select(relevance.normalize_method("source_type").alias("method"), F.lit(True).alias("fetched"), *[F.lit(False).alias(s) for s in V.STAGES[1:]])
    return Run(rows, judged, kept, dropped, reports.funnel(staged.unionByName(fetched)), reports.top_reasons(reports.drop_counts(judged)))

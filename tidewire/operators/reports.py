"""Counts that a run reports, as DataFrames: funnels, drop reasons, source health, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import vocabulary as V
from ..functions import summaries as sm
from ..functions import text as tx


def method_dimension(spark) -> DataFrame:
    return spark.createDataFrame([(m, V.METHOD_LABELS[m], i) for i, m in enumerate(V.METHODS)], "method string, label string, method_order int")


def drop_counts(judged: DataFrame) -> DataFrame:
    """reason, reason_zh, n of dropped rows."""
    return judged.filter(~F.col("relevance_keep")).groupBy(F.col("relevance_reason").alias("reason"), F.col("relevance_reason_zh").alias("reason_zh")).agg(F.count("*").alias("n"))


def top_reasons(counts: DataFrame, most: int = 3) -> DataFrame:
    """The most frequent labels with their share in percent of all."""
    by_label = counts.groupBy("reason_zh").agg(F.sum("n").alias("n"))
    total = by_label.agg(F.sum("n").alias("total"))
    return by_label.orderBy(F.desc("n"), "reason_zh").limit(most).join(F.broadcast(total)).select("reason_zh", "n", F.round(F.col("n") / F.col("total") * 100.0, 4).alias("share"))


def kept_by_source(judged: DataFrame) -> DataFrame:
    return judged.filter("relevance_keep").groupBy("source_id").agg(F.count("*").alias("n"))


def funnel(staged: DataFrame) -> DataFrame:
    """method and a count for each stage, with zeros; staged has method and the boolean of each stage."""
    counts = staged.filter(F.col("method") != "").groupBy("method").agg(*[F.count_if(F.col(s)).alias(s) for s in V.STAGES])
    methods = method_dimension(staged.sparkSession).select("method", "method_order")
    return F.broadcast(methods).join(counts, "method", "left").select("method", *[F.coalesce(s, F.lit(0)).cast("long").alias(s) for s in V.STAGES])


def merged_funnel(old: DataFrame, new: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """old with the given stages' counts from new; other stages keep theirs."""
    fresh = new.select(F.col("method"), *[F.col(s).alias(f"new_{s}") for s in stages])
    both = old.join(fresh, "method", "full_outer")
    return both.select("method", *[F.coalesce(*([f"new_{s}"] if s in stages else []), s, F.lit(0)).cast("long").alias(s) for s in V.STAGES])


def rebuilt_funnel(funnel_counts: DataFrame, stats: DataFrame) -> DataFrame:
    """The funnel, or if all is zero one of fetched counts by source type."""
    empty = funnel_counts.agg(F.sum(sum((F.col(s) for s in V.STAGES[1:]), F.col(V.STAGES[0]))).alias("total"))
    fetched = stats.groupBy(F.lower(tx.strip("source_type")).alias("method")).agg(F.sum("fetched_items").alias("again"))
    both = funnel_counts.join(F.broadcast(fetched), "method", "left").join(F.broadcast(empty))
    return both.select("method", F.when(F.col("total") == 0, F.coalesce("again", F.lit(0))).otherwise(F.col("fetched")).cast("long").alias("fetched"), *V.STAGES[1:])


def reason_pivot(judged: DataFrame) -> DataFrame:
    """A row for each reason: its total and a count for each method, of dropped rows with a method."""
    dropped = judged.filter(~F.col("relevance_keep") & (F.col("method") != ""))
    wide = dropped.groupBy(F.col("relevance_reason_zh").alias("reason")).pivot("method", list(V.METHODS)).agg(F.count(F.lit(1)))
    filled = wide.select("reason", *[F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in V.METHODS])
    return filled.withColumn("total", sum((F.col(m) for m in V.METHODS[1:]), F.col(V.METHODS[0])))


def active_methods(funnel_counts: DataFrame, breakdown: DataFrame) -> DataFrame:
    """Methods with any count in the funnel or the breakdown (method, n); if none, all but search_api."""
    busy = funnel_counts.filter(sum((F.col(s) for s in V.STAGES[1:]), F.col(V.STAGES[0])) > 0).select("method").union(breakdown.filter("n > 0").select("method")).distinct()
    known = method_dimension(funnel_counts.sparkSession).select("method", "method_order")
    marked = known.join(busy.withColumn("busy", F.lit(True)), "method", "left").withColumn("any", F.max(F.coalesce("busy", F.lit(False))).over(W.partitionBy(F.lit(1))))
    return marked.filter(F.when(F.col("any"), F.coalesce("busy", F.lit(False))).otherwise(F.col("method") != "search_api")).select("method", "method_order")


def pass_rate(judged: DataFrame) -> DataFrame:
    return judged.agg(F.count("*").alias("total"), F.count_if(F.col("relevance_keep")).alias("kept")).select("total", "kept", F.coalesce(F.round(F.try_divide(F.col("kept") * 100.0, F.col("total")), 2), F.lit(0.0)).alias("pass_rate"))


def source_stats(fetched: DataFrame) -> DataFrame:
    """A row for each source: items, status and classified error; fetched has source_id, items, error."""
    rows = fetched.groupBy("source_id").agg(F.sum("items").cast("long").alias("fetched_items"), F.max(F.coalesce("error", F.lit(""))).alias("error"))
    found = sm.classify_error("error")
    status = F.when(F.col("error") == "", "ok").when(F.col("fetched_items") > 0, "partial").otherwise("fail")
    return rows.select("source_id", "fetched_items", status.alias("status"), F.substring("error", 1, 500).alias("error"), found["code"].alias("error_reason_code"), found["label"].alias("error_reason_zh"))


def failed_sources(stats: DataFrame) -> DataFrame:
    name = F.coalesce(F.nullif(tx.strip("source_name"), F.lit("")), tx.strip("source_id"))
    reason = F.coalesce(F.nullif(tx.strip("error_reason_zh"), F.lit("")), F.nullif(tx.strip("error"), F.lit("")), F.lit(V.UNKNOWN_ERROR[1]))
    return stats.filter(F.coalesce("status", F.lit("")) != "ok").select(name.alias("name"), reason.alias("reason"), F.substring(tx.strip("error_raw"), 1, 500).alias("detail"))


def exploded_counts(rows: DataFrame, array: str, name: str) -> DataFrame:
    return rows.select(F.explode(array).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def canonical_metrics(rows: DataFrame, run_date: str, zone: str = "Asia/Shanghai") -> DataFrame:
    """One row of conditional counts over canonical records with published_at (timestamp)."""
    from ..functions import dates

    return rows.agg(
        F.count("*").alias("canonical"), F.count_if(F.col("published_missing")).alias("published_missing"), F.count_if(F.startswith(F.col("published_parse_status"), F.lit("unparseable"))).alias("unparseable"),
        F.count_if(dates.same_day("published_at", run_date, zone)).alias("today"), F.count_if(~F.coalesce("resolved_ok", F.lit(True))).alias("unresolved"),
        F.count_if(F.col("region") == "domestic").alias("domestic"), F.count_if(F.col("region") != "domestic").alias("foreign"), F.countDistinct(F.when(~F.col("company_hint").isin("", "other"), F.col("company_hint"))).alias("companies"),
    )


def counts_by(rows: DataFrame, *columns: str) -> DataFrame:
    """How many rows each value of the columns has."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))


def breakdown(counts: DataFrame, name: str = "reason") -> DataFrame:
    """method, reason, n with every known method, unknown ones left out, blank reasons and counts below one dropped."""
    clean = counts.withColumn(name, tx.strip(name)).filter((F.col(name) != "") & (F.col("n") > 0))
    known = method_dimension(counts.sparkSession).select("method")
    return known.join(clean.groupBy("method", name).agg(F.sum("n").cast("long").alias("n")), "method", "left")


def discovery_metrics(rows: DataFrame) -> DataFrame:
    """One row of counts over canonical discovery records: verified or not and why, by kind of source."""
    search, query = F.col("source_type") == "search_result", F.col("source_type") == "query_rss"
    ok, code = F.col("published_parse_status") == "ok", F.col("query_rss_verify_error_code")
    counts = {"discovery_items_canonical_count": search | query, "search_result_fetch_success_count": search & ok, "search_result_fetch_fail_count": search & ~ok, "search_result_verified_count": search & ok}
    counts |= {f"query_rss_{c}_count": (search | query) & (code == c) for c in ("fetch_forbidden", "fetch_timeout", "fetch_ssl_error", "fetch_other", "published_not_found")}
    return rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items()])


def resolver_metrics(raw: DataFrame) -> DataFrame:
    """One row of counts over raw query_rss records: resolved or not, and which way failed."""
    of = lambda k: F.coalesce(F.try_element_at("payload", F.lit(k)), F.lit(""))
    ok, method = of("resolved_ok") == "true", of("resolver_method")
    counts = {
        "query_rss_resolved_count": ok, "query_rss_resolve_fail_count": ~ok, "query_rss_resolve_failed_token_decode_count": (of("resolver_token_decode_ok") != "true") & (method != "not_google_news"),
        "query_rss_resolve_failed_html_extract_count": method == "failed_html_extract", "query_rss_resolve_failed_google_link_left_count": method == "failed_google_link_left",
    }
    return raw.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def filter_metrics(judged: DataFrame) -> DataFrame:
    """One row of counts over judged rows."""
    reason, keep = F.col("relevance_reason"), F.col("relevance_keep")
    dropped = {"published_missing_drop_count": "published_missing_or_unparseable", "query_rss_unresolved_drop_count": "query_rss_unresolved_url", "query_rss_unverified_drop_count": "query_rss_unverified_published", "search_result_unverified_drop_count": "search_result_unverified_published", "not_today_drop_count": "outside_window", "candidate_gate_drop_count": "candidate_gate_miss"}
    counts = {"relevance_total_in": F.lit(True), "relevance_kept": keep, "relevance_dropped": ~keep} | {n: ~keep & (reason == r) for n, r in dropped.items()}
    return judged.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items()])

"""python -m tidewire.cli STAGE --config FILE --date YYYY-MM-DD --root DIR [--captures DIR]

Stages: validate, fetch, parse, filter, enrich, summarize, render, notify, all. Each reads the stage before
from ROOT/<stage>/run_date=<date> and writes its own; state lies in ROOT/state, the run's report in
ROOT/reports/<date>. Network is used only with --transport http. With --once a date that was run to its end
is not run again. With --provider model summaries come from the model whose key is in DEEPSEEK_API_KEY. notify posts to --webhook (signed with the secret in DIGEST_WEBHOOK_SECRET, if set) and is
skipped without one. With --channel group the message and the payload are the group channel's, without a signature.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .operators import digest, provider, relevance, reports, rules, state, versions
from .plans import daily
from .sources import connectors, fetching, records
from .tables import clear, written

STAGES = ("validate", "fetch", "parse", "filter", "enrich", "summarize", "render", "notify")


def settings_of(config: dict) -> relevance.Settings:
    d = config.get("defaults", {})
    lists = lambda name, *others: {r: tuple(next((d[k] for k in (f"{name}_{r}", *[f"{r}_{o}" for o in others]) if k in d), ())) for r in ("domestic", "foreign")}
    pairs = d.get("keyword_pair_rules", {})
    aliases = tuple(a for c in config.get("companies", []) for a in (c.get("name", ""), *c.get("aliases", [])))
    more = {k: d[o] for k, o in {"mode": "relevance_mode", "zone": "window_timezone", "thresholds": "relevance_thresholds", "source_cap": "max_general_media_items_per_source", "source_cap_on": "enable_general_media_source_cap", "fast_pass": "fast_pass_enabled"}.items() if o in d}
    return relevance.Settings(
        core=lists("core_keywords", "keywords"), context=lists("context_keywords"), brand=lists("brand_keywords"), exclude=lists("exclude_keywords"), blocked_publishers=lists("blocked_publishers"),
        company_aliases=relevance.V.KNOWN_COMPANY_ALIASES + aliases, pair_level=pairs.get("require_level_with_autonomous_context", True), pair_truck=pairs.get("require_truck_with_autonomous_context", True), **more,
    )


def companies_of(spark: SparkSession, config: dict) -> DataFrame:
    return spark.createDataFrame([(str(c.get("id", "")), str(c.get("name", ""))) for c in config.get("companies", [])], "id string, name string")


class Report:
    """The run's report: one JSON file, to which each stage adds its keys. Tables are aggregates: a row for each
    source, method, reason or status."""

    def __init__(self, spark: SparkSession, path: str, date: str):
        self.spark, self.path = spark, path
        self.held = json.loads("\n".join(r.value for r in spark.read.text(path).collect())) if records._exists(spark, path) else {"run_date": date, "stage_status": dict.fromkeys(STAGES, "pending")}

    def patch(self, **values) -> None:
        self.held |= values
        records.write_text(self.spark, json.dumps(self.held, ensure_ascii=False, indent=2, default=str), self.path)

    def add(self, **tables) -> None:
        self.patch(**{k: [r.asDict() for r in v.collect()] if isinstance(v, DataFrame) else v for k, v in tables.items()})

    def stage(self, name: str, status: str = "success") -> None:
        self.held["stage_status"][name] = status
        self.patch()


def notified(text: str, webhook: str, date: str, url: str, channel: str = "app") -> dict:
    """Posts the message; what became of it."""
    if not webhook:
        return {"status": "skipped", "error": "no webhook"}
    if channel == "group":
        payload, keys = digest.group_payload(text), ("errcode", "code")
    else:
        payload, keys = {"msg_type": "text", "content": {"text": text}, "uuid": digest.message_id(f"{date}|{text}|{url}")}, ("code", "StatusCode", "errcode")
    if channel != "group" and (secret := os.environ.get("DIGEST_WEBHOOK_SECRET", "").strip()):
        stamp = str(int(time.time()))
        payload |= {"timestamp": stamp, "sign": digest.webhook_sign(secret, stamp)}
    try:
        code = digest.response_code(fetching.post_webhook(webhook, payload), keys)
    except (OSError, ValueError) as e:
        return {"status": "notify_failed", "error": str(e)[:500]}
    return {"status": "success", "error": ""} if code == 0 else {"status": "notify_failed", "error": f"code {code}"}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("stage", choices=(*STAGES, "all"))
    for name in ("config", "date", "root"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--captures", default="")
    p.add_argument("--transport", choices=("capture", "http"), default="capture")
    p.add_argument("--provider", choices=("fallback", "model"), default="fallback")
    p.add_argument("--top-n", type=int, default=12)
    p.add_argument("--webhook", default="")
    p.add_argument("--channel", choices=("app", "group"), default="app")
    p.add_argument("--html-url", default="")
    p.add_argument("--once", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tidewire").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    with open(a.config, encoding="utf-8") as f:
        config = json.load(f)
    as_of = F.lit(f"{a.date} 00:00:00").cast("timestamp")
    at = lambda stage: f"{a.root}/{stage}/run_date={a.date}"
    read = lambda stage: spark.read.parquet(at(stage))
    write = lambda rows, stage: rows.write.mode("overwrite").parquet(at(stage))
    seen_path, gate = f"{a.root}/state/seen", f"{a.root}/state/run_to_end_{a.date}"
    if a.once and records._exists(spark, gate):
        return 0
    seen = versions.table(spark, seen_path, schemas.SEEN)
    report = Report(spark, f"{a.root}/reports/{a.date}/run_report.json", a.date)

    def pages(links) -> DataFrame:
        """Fetched pages of links (link): link, html, last_modified, error."""
        asked = links.select(*[F.lit("").alias(c) for c in ("source_id", "source_name", "source_type", "error")], F.col("link").alias("url"))
        got = connectors.fetched(asked, a.transport, a.captures)
        return written(got.select(F.col("url").alias("link"), F.col("body").alias("html"), F.col("modified").alias("last_modified"), "error"))

    def texts(requests) -> DataFrame:
        """link, body: what wrapped links ask for, with one try a page."""
        got = connectors.fetched(requests.withColumn("error", F.lit("")), a.transport, a.captures, fetching.Policy(timeout=15, tries=1))
        return got.select("link", "body")

    for stage in STAGES if a.stage == "all" else (a.stage,):
        if stage == "validate":
            found = rules.broken(rules.config_rows(spark, config)).orderBy("table", "id", "rule").collect()  # of the configuration
            for r in found:
                print(f"{r.table} {r.id}: {r.rule} {r.value}", file=sys.stderr)
            if found:
                report.stage(stage, "failed")
                return 1
        elif stage == "fetch":
            answers = written(connectors.fetched(connectors.planned(spark, config), a.transport, a.captures))
            articles = written(connectors.fetched(connectors.article_requests(answers, config, int(a.date[:4])), a.transport, a.captures))
            raw = written(connectors.raw_records(answers, f"{a.date}T00:00:00Z", config, articles.filter("error = ''"), texts))
            write(raw, "raw")
            stats = written(connectors.source_stats(answers.select("source_id", "source_name", "source_type", "error").unionByName(articles.select("source_id", "source_name", "source_type", "error")), raw))
            write(stats, "source_stats")
            records.write_health(stats, f"{a.root}/health/run_date={a.date}")
            report.add(source_stats=stats, total_items_raw=raw.count(), raw_by_method=reports.counts_by(raw.withColumn("method", relevance.normalize_method("source_type")), "method"))
            report.patch(**reports.resolver_metrics(raw.filter("source_type = 'query_rss'")).first().asDict())
        elif stage == "parse":
            raw, known = read("raw"), state.retained(seen, a.date)
            marked = written(daily.canonical(raw, as_of, pages(daily.to_verify(raw, as_of)), marked=True))
            rows = marked.filter("usable").drop("usable")
            write(daily.deduplicated(rows, known), "canonical")
            left = read("canonical")
            report.add(pre_candidate_drop_breakdown=reports.breakdown(daily.pre_candidate_drops(marked, known)), canonical_by_source=reports.counts_by(left, "source_id"), published_parse_status_dist=reports.counts_by(left, "published_parse_status"))
            report.patch(**reports.discovery_metrics(rows).first().asDict(), **reports.canonical_metrics(left, a.date).first().asDict())
        elif stage == "filter":
            rows = [(str(s.get("id", "")), str(s.get("source_type", "rss")), str(s.get("source_profile", "")), str(s.get("category", "")), *[[str(x) for x in s.get(k, [])] for k in ("entry_urls", "external_link_allow_domains", "url_allow_patterns", "url_block_patterns", "include_keywords", "exclude_keywords")]) for s in config.get("sources", [])]
            write(relevance.judged(read("canonical"), spark.createDataFrame(rows, schemas.SOURCE), settings_of(config), a.date, as_of), "judged")
            judged = read("judged")
            report.add(candidate_filter_breakdown=reports.breakdown(reports.counts_by(judged.filter(~F.col("relevance_keep")), "method", "relevance_reason_zh"), "relevance_reason_zh"), relevance_kept_by_source=reports.kept_by_source(judged))
            report.patch(**reports.filter_metrics(judged).first().asDict(), **reports.pass_rate(judged).first().asDict())
        elif stage == "enrich":
            kept = relevance.routed(read("judged"))[0]
            short = kept.filter((F.char_length("content") < 500) & (F.col("link") != "")).select("link").distinct()
            write(daily.enriched(kept, pages(short).filter("error = ''").select("link", "html")), "enriched")
            report.patch(enriched_count=read("enriched").filter("enriched").count())
        elif stage == "summarize":
            cache_path = f"{a.root}/state/cache"
            cache = versions.table(spark, cache_path, schemas.CACHE)
            model = provider.model_of(dict(os.environ)) if a.provider == "model" else None
            ask = (lambda rows: provider.summarized(rows, model[0], provider.over_http(model[1]))) if model else None
            told = written(daily.judged_summaries(read("enriched"), cache, as_of, ask))
            report.patch(**provider.metrics(told).first().asDict())
            brief = written(daily.shown(told))
            write(brief, "brief")
            stamp, key = f"{a.date}T00:00:00+00:00", state.seen_key("resolved_url", "fingerprint")
            versions.retried(lambda: versions.changed(brief, cache_path, F.col("fingerprint"), lambda old, new: state.cache_after(state.pruned(old, as_of), new, stamp), schemas.CACHE))
            report.patch(brief_count=brief.count())
            links = brief.select(F.col("link").alias("resolved_url"), "fingerprint")
            versions.retried(lambda: versions.changed(links, seen_path, key, lambda old, new: state.upserted(state.retained(old, a.date), new, a.date), schemas.SEEN))
            for path in (cache_path, seen_path):
                versions.forget(spark, path)
        elif stage == "render":
            named = digest.company_names(digest.digest_rows(read("brief"), a.top_n), companies_of(spark, config))
            judged, rows = read("judged"), [r.asDict() for r in named.orderBy("place").collect()]  # 2 * top_n rows
            staged = judged.select("method", F.lit(False).alias("fetched"), F.lit(True).alias("candidate"), (~F.col("relevance_keep")).alias("filtered"), F.col("relevance_keep").alias("kept"))
            raw = read("raw").select(relevance.normalize_method("source_type").alias("method"), F.lit(True).alias("fetched"), *[F.lit(False).alias(x) for x in ("candidate", "filtered", "kept")])
            funnel = written(reports.funnel(staged.unionByName(raw)))
            reasons = reports.top_reasons(reports.drop_counts(judged)).collect()
            failed = reports.failed_sources(read("source_stats")).orderBy("name").limit(20).collect()
            body = digest.page(rows, [tuple(r) for r in funnel.collect()], [tuple(r) for r in reasons], a.date, [tuple(r) for r in failed])
            records.write_text(spark, body, f"{a.root}/digest/{a.date}.html")
            report.add(stage_funnel=funnel)
        else:
            brief = read("brief")
            top = [r.asDict() for r in digest.top_important(brief, int(config.get("defaults", {}).get("notify_top_n", 5 if a.channel == "group" else 8))).collect()]
            kept = brief.count()
            text = digest.group_message(top, a.date, a.html_url) if a.channel == "group" else digest.message(top, a.date, a.html_url, read("judged").count(), kept)
            report.patch(push_status=notified(text, a.webhook, a.date, a.html_url, a.channel))
        report.stage(stage)
    clear(spark)
    if a.once and a.stage == "all":
        records.write_text(spark, a.date, gate)
    return 0


if __name__ == "__main__":
    sys.exit(main())

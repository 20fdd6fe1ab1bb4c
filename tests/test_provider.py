"""A model that fails for some rows: answers, second asks, fallbacks and their counts."""

import json

from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.operators import provider
from tidewire.plans import daily
from tidewire.sources.fetching import Answer, Policy

GOOD = {"title_zh": "标题", "what": "公司扩大了车队", "why": "监管放宽了限制", "so_what": "竞争将会加剧", "impact_targets": ["监管"], "tags": ["运营"], "confidence": "0.9", "importance": "4"}


def _fake():
    """Made here, so that workers get it whole."""

    def fake(url, method, data, headers, timeout):
        """By the title in the question."""
        from pathlib import Path

        asked = json.loads(data)
        text, folder = asked["messages"][0]["content"], Path(url.removeprefix("http://model"))
        title = text.partition("标题：")[2].partition("\n")[0]
        with open(folder / "asked", "a") as f:
            f.write(json.dumps([title, asked["temperature"], headers.get("Authorization")]) + "\n")
        if title == "down":
            return Answer(500, error="HTTP Error 500: x", url=url)
        said = {"good": json.dumps(GOOD), "talk": "no object here", "late": json.dumps(GOOD | ({"so_what": ""} if asked["temperature"] > 0 else {})), "never": json.dumps(GOOD | {"why": ""})}[title]
        return Answer(200, json.dumps({"choices": [{"message": {"content": f"好的：{said}。"}}]}).encode(), url=url)

    return fake


def test_model_and_its_failures(spark, tmp_path):
    titles = ["good", "down", "talk", "late", "never", "good", "cached", "stale"]
    prints = {t: f"f-{t}" for t in titles}
    rows = spark.createDataFrame(
        [(str(i), "s", "S", "foreign", "", t, f"{t} robotaxi content", f"https://a.b/{i}", "2024-01-14T00:00:00+00:00", prints[t] if t != "stale" else "f-good", i) for i, t in enumerate(titles)],
        "id string, source_id string, source_name string, region string, company_hint string, title string, content string, link string, published_at_utc string, fingerprint string, seq long",
    )
    cache = spark.createDataFrame([("f-cached", "标题", "", "甲公司扩大车队。", "监管放宽。", "竞争加剧。", ["监管"], ["运营"], 0.8, 5, "2024-01-14T00:00:00+00:00"), ("f-late", "标题", "", "只有一句。", "", "", ["监管"], [], 0.8, 5, "2024-01-14T00:00:00+00:00")], schemas.CACHE)
    model = provider.Model(f"http://model{tmp_path}", "m")
    ask = provider.over_http("SECRET", _fake(), Policy(tries=2, backoff=0.01, tasks=2))
    told = daily.judged_summaries(rows, cache, F.lit("2024-01-15 00:00:00").cast("timestamp"), lambda r: provider.summarized(r, model, ask)).cache()
    got = {r.id: r for r in told.collect()}
    by = {t: got[str(i)] for i, t in enumerate(titles)}
    assert by["good"].first_status == "ok" and by["good"].s.what.startswith("公司扩大了车队") and (by["good"].s.confidence, by["good"].s.importance) == (0.9, 4)
    assert by["stale"].s.what == by["good"].s.what  # shares its fingerprint: asked once
    assert by["down"].first_status == "failed" and by["down"].model_error == "HTTP Error 500: x" and by["down"].fallback_status is not None
    assert by["talk"].first_status == "failed" and by["talk"].model_error == "no object in the answer"
    assert (by["late"].first_status, by["late"].second_status, by["late"].fallback_status) == ("missing_so_what", "ok", None) and by["late"].cached_status != "ok"
    assert (by["never"].first_status, by["never"].second_status) == ("missing_why", "missing_why") and by["never"].s.confidence in (0.5, 0.55)
    assert by["cached"].first_status is None and by["cached"].s.importance == 5
    asked = [json.loads(line) for line in (tmp_path / "asked").read_text().splitlines()]
    assert {a[2] for a in asked} == {"Bearer SECRET"}
    assert sorted((t, x) for t, x, _ in asked) == sorted([("good", 0.2), ("down", 0.2), ("down", 0.2), ("talk", 0.2), ("late", 0.2), ("late", 0.0), ("never", 0.2), ("never", 0.0)])
    counts = provider.metrics(told).first().asDict()
    failing = sum(r.fallback_status is not None and r.fallback_status != "ok" for r in got.values())
    assert counts == {"summary_structured_count": 8, "summary_structured_valid_count": 8, "summary_structured_invalid_count": 4 + failing, "summary_retry_count": 4, "summarize_fail_count": 3}
    assert daily.shown(told).count() == 8 and "SECRET" not in told._jdf.queryExecution().toString()
    assert {r.first_status for r in daily.judged_summaries(rows, cache, F.lit("2024-01-15 00:00:00").cast("timestamp")).collect()} == {None}


def test_last_resort(spark):
    """A row whose fallback breaks a rule still shows whole sentences."""
    rows = spark.createDataFrame([("", "")], "title string, content string")
    from tidewire.functions import summaries as sm

    s = rows.select(sm.last_resort("title", "content").alias("s")).first().s
    assert (s.confidence, s.importance) == (0.5, 2) and s.what.startswith("该资讯已发布") and s.tags and s.impact_targets

"""Summaries by a model that is asked over HTTP, as tables of requests and answers.

A row that has no valid cached summary asks once for each fingerprint, however many rows share it. Answers are read and
checked as columns; those that break a rule are asked again, at temperature 0, in a second table of requests. Requests go
through fetching's queues, so concurrency, backoff and tries are bounded there, and a failed request is a row with its
error, never a failed job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import summaries as sm
from ..functions import text as tx
from ..sources import fetching
from ..tables import small, written

SUMMARY = "struct<title_zh:string,what:string,why:string,so_what:string,impact_targets:array<string>,tags:array<string>,confidence:double,importance:int>"
#: As a model says it: numbers may come as text.
_SAID = "title_zh string, what string, why string, so_what string, impact_targets array<string>, tags array<string>, confidence string, importance string"
_REPLY = "choices array<struct<message:struct<content:string>>>"
TEMPERATURES = (0.2, 0.0)
POLICY = fetching.Policy(timeout=30, tries=3, backoff=1.2, threads=8, lanes=8)


@dataclass(frozen=True)
class Model:
    endpoint: str
    name: str
    chars: int = 1400
    tokens: int = 400


def prompt(title: Column | str, content: Column | str, model: Model) -> Column:
    """What a row asks: the fields, their bounds, then the text."""
    rules = (
        '把下面的新闻写成中文简报，只返回一个 JSON 对象：{"title_zh": "", "what": "", "why": "", "so_what": "", "impact_targets": [], "tags": [], "confidence": 0.0, "importance": 3}。'
        f"what、why、so_what 各写一句中文。impact_targets 取 1 至 3 个：{'、'.join(V.IMPACT_TARGETS)}。tags 取 1 至 3 个：{'、'.join(V.ALLOWED_TAGS)}。"
        f"confidence 在 0 与 1 之间，importance 为 1（边缘）至 5（重大）的整数。不得出现：{'、'.join(V.BAN_PHRASES)}。"
    )
    return F.concat(F.lit(rules), F.lit("\n标题："), tx.text(title), F.lit("\n内容："), F.substring(tx.text(content), 1, model.chars))


def _requests(rows: DataFrame, model: Model, temperature: float) -> DataFrame:
    message = F.array(F.struct(F.lit("user").alias("role"), prompt("title", "content", model).alias("content")))
    body = F.to_json(F.struct(F.lit(model.name).alias("model"), F.lit(temperature).alias("temperature"), F.lit(model.tokens).alias("max_tokens"), message.alias("messages")))
    kind = F.create_map(F.lit("Content-Type"), F.lit("application/json"))
    return rows.select("fingerprint", F.lit(model.endpoint).alias("url"), F.lit("POST").alias("method"), body.alias("data"), kind.alias("headers"))


def over_http(key: str, first: Callable = fetching.direct, policy: fetching.Policy = POLICY) -> Callable[[DataFrame], DataFrame]:
    """Answers requests (fingerprint, url, method, data, headers) with body (text) and failed. The key travels with the function
    alone: in no table and in no plan."""

    def ask(url, method, data, headers, timeout):
        return first(url, method, data, headers | {"Authorization": f"Bearer {key}"}, timeout)

    def send(requests: DataFrame) -> DataFrame:
        got = fetching.answered(requests, "http", policy=policy, first=ask, second=lambda url, *_: fetching.Answer(0, error="no second transport", url=url))
        return got.select("fingerprint", F.col("body").cast("string").alias("body"), "failed")

    return send


def _asked(rows: DataFrame, model: Model, temperature: float, ask: Callable) -> DataFrame:
    """fingerprint, title, content, summary (normalised), status ("ok", the broken rule, or "failed"), error."""
    answers = ask(_requests(rows, model, temperature)).select("fingerprint", "body", "failed")
    text = F.from_json("body", _REPLY)["choices"][0]["message"]["content"]
    found = rows.join(answers, "fingerprint", "left").withColumn("_said", sm.json_object(text, _SAID))
    shaped = found.withColumn("summary", F.when(F.col("_said").isNotNull(), sm.normalized(F.col("_said"), "title", "content")))
    rule = sm.validation("summary.what", "summary.why", "summary.so_what", "summary.impact_targets")
    status = F.when(F.col("summary").isNull(), "failed").otherwise(rule)
    error = F.when(F.coalesce("failed", F.lit("")) != "", F.col("failed")).when(F.col("summary").isNull(), "no object in the answer").otherwise("")
    return written(shaped.select("fingerprint", "title", "content", "summary", status.alias("status"), error.alias("error")))


def summarized(rows: DataFrame, model: Model, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows (title, content, fingerprint; wanted: false for those that need none, if there is such a column) with summary
    (null where the model gave no valid one), first_status, second_status (null where not asked) and model_error."""
    wanted = rows.filter("wanted") if "wanted" in rows.columns else rows
    asking = wanted.filter("fingerprint is not null").groupBy("fingerprint").agg(F.min(F.struct(tx.text("title").alias("title"), tx.text("content").alias("content"))).alias("x"))
    first = _asked(written(asking.select("fingerprint", "x.*")), model, TEMPERATURES[0], ask)
    again = first.filter("status not in ('ok', 'failed')").select("fingerprint", "title", "content")
    second = _asked(written(again), model, TEMPERATURES[1], ask)
    both = first.select("fingerprint", F.col("summary").alias("_s1"), F.col("status").alias("first_status"), F.col("error").alias("_e1")).join(
        second.select("fingerprint", F.col("summary").alias("_s2"), F.col("status").alias("second_status"), F.col("error").alias("_e2")), "fingerprint", "left"
    )
    good = F.when(F.col("first_status") == "ok", F.col("_s1")).when(F.col("second_status") == "ok", F.col("_s2"))
    known = written(both.select("fingerprint", good.alias("summary"), "first_status", "second_status", F.coalesce(F.nullif("_e1", F.lit("")), "_e2", F.lit("")).alias("model_error")))
    held = rows.join(small(known), "fingerprint", "left")
    if "wanted" not in rows.columns:
        return held
    asked = F.col("wanted")
    return held.withColumns({c: F.when(asked, F.col(c)) for c in ("summary", "first_status", "second_status", "model_error")})


def metrics(rows: DataFrame) -> DataFrame:
    """One row of counts over daily.judged_summaries' rows: all, valid and invalid ones, retries, and fallbacks."""
    one, two, cached, last = (F.coalesce(c, F.lit("")) for c in ("first_status", "second_status", "cached_status", "fallback_status"))
    bad = lambda c: (~c.isin("", "ok", "failed")).cast("int")
    retried = F.when(one == "failed", 1).otherwise(bad(one)) + (two == "failed").cast("int")
    return rows.agg(
        F.count("*").alias("summary_structured_count"), F.count("*").alias("summary_structured_valid_count"), F.coalesce(F.sum(bad(cached) + bad(one) + bad(two) + bad(last)), F.lit(0)).alias("summary_structured_invalid_count"),
        F.coalesce(F.sum(retried), F.lit(0)).cast("long").alias("summary_retry_count"), F.count_if(last != "").alias("summarize_fail_count"),
    )


def model_of(environment: dict[str, str], endpoint: str = "https://api.deepseek.com", name: str = "deepseek-chat") -> tuple[Model, str] | None:
    """(the model, its key) as the environment names them; None without a key."""
    key = environment.get("DEEPSEEK_API_KEY", "").strip()
    base = environment.get("DEEPSEEK_BASE_URL", endpoint).rstrip("/")
    return (Model(f"{base}/chat/completions", environment.get("DEEPSEEK_MODEL", name)), key) if key else None

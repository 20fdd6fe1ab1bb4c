"""Links that wrap an article's own address, resolved in rounds of requests.

A wrapper's token may hold the address itself. Where it doesn't, its page gives a signature with which the
search engine is asked for the address, and the page's own links are the last resort. Each request needs
an earlier answer, so links are a state table: in every round each open link asks what its step asks for,
the answers move it on, and links that are settled leave. A link is asked for once, however many items
carry it, and rounds follow the steps, not the links.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import text as tx
from ..tables import rows_of, written

#: The engine's addresses and hosts, which no resolved link may have, and the names of outcomes.
SITE = "https://news.google.com"
EXECUTE = f"{SITE}/_/DotsSplashUi/data/batchexecute"
OWN_DOMAINS = ("google.com", "gstatic.com", "googleapis.com", "googleusercontent.com", "googlesyndication.com", "google-analytics.com", "googletagmanager.com", "doubleclick.net")
METHODS = ("not_google_news", "token_decode", "html_extract", "failed_html_extract", "failed_google_link_left", "failed")
#: The steps of an open link: its page, the engine's answer, the feed's page.
PAGE, SIGNED, FEED = 1, 2, 3
_REFRESH = re.compile("(?i)url=(.+)")
_FORM = "application/x-www-form-urlencoded;charset=UTF-8"
_PAGE = "struct<signature:string,stamp:string,link:string>"


def own_domain(url: Column | str) -> Column:
    host = tx.host(url)
    return F.exists(F.array(*[F.lit(d) for d in OWN_DOMAINS]), lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)))


def valid(url: Column | str) -> Column:
    """Whether a link can be an article's: http, a dotted host, none of the engine's own."""
    return F.coalesce(F.lower(tx.url_part(url, 1)).isin("http", "https") & F.contains(tx.host(url), F.lit(".")) & ~own_domain(url), F.lit(False))


def page_parts(html: str) -> tuple[str, str, str]:
    """(signature, time stamp, the first link that leads on) of a wrapper's page; empty where it has none."""
    root = markup.parse(html)
    holder = markup.select_one(root, "c-wiz > div[jscontroller]") or markup.select_one(root, "c-wiz > div")
    signed = (holder.get("data-n-a-sg"), holder.get("data-n-a-ts")) if holder is not None else ("", "")
    web = lambda x: x.startswith(("http://", "https://"))
    for node in root.walk():
        if node.tag == "a" and web(node.get("href")):
            return *signed, node.get("href")
    for node in root.walk():
        if node.tag == "meta" and node.get("http-equiv") == "refresh" and (found := _REFRESH.search(node.get("content"))):
            return *signed, found[1].strip()
    return *signed, next((node.get("data-href") for node in root.walk() if web(node.get("data-href"))), "")


def question(token: str, stamp: str, signature: str) -> str:
    """The body that asks the engine for a token's address (a fixed form)."""
    shape = ["garturlreq", [["X", "X", ["X", "X"], None, None, 1, 1, "US:en", None, 1, None, None, None, None, None, 0, 1], "X", "X", 1, [1, 1, 1], 1, 1, None, 0, 0, None, 0], token]
    inner = f'{json.dumps(shape, separators=(",", ":"))[:-1]},{stamp},"{signature}"]'
    return f"f.req={quote(json.dumps([[['Fbv4je', inner]]]))}"


def answer_link(body: str) -> str:
    """The address in the engine's answer; empty where it has none."""
    try:
        found = json.loads(json.loads(body.partition("\n\n")[2])[0][2])
        link = found[1] if isinstance(found, list) else ""
    except (ValueError, LookupError, TypeError):
        return ""
    return link if isinstance(link, str) and link.startswith(("http://", "https://")) else ""


def _each(function: Callable, kind: str):
    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: function(v or ""))

    return run


def _page_udf():
    @F.pandas_udf(_PAGE)
    def run(html: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_parts(h or "") for h in html], columns=["signature", "stamp", "link"])

    return run


def _question_udf():
    @F.pandas_udf("string")
    def run(token: pd.Series, stamp: pd.Series, signature: pd.Series) -> pd.Series:
        return pd.Series([question(t or "", s or "", g or "") for t, s, g in zip(token, stamp, signature, strict=True)], dtype=object)

    return run


def _requests(state: DataFrame) -> DataFrame:
    """link, url, method, data, headers: what each open link asks for."""
    step, token = F.col("step"), F.col("token")
    url = F.when(step == PAGE, F.concat(F.lit(f"{SITE}/articles/"), token)).when(step == SIGNED, F.lit(EXECUTE)).otherwise(F.concat(F.lit(f"{SITE}/rss/articles/"), token))
    signed = step == SIGNED
    data = F.when(signed, _question_udf()("token", "stamp", "signature"))
    headers = F.when(signed, F.create_map(F.lit("Content-Type"), F.lit(_FORM))).otherwise(F.create_map().cast("map<string,string>"))
    return state.select("link", url.alias("url"), F.when(signed, "POST").otherwise("GET").alias("method"), data.alias("data"), headers.alias("headers"))


def _moved(state: DataFrame, answers: DataFrame) -> DataFrame:
    """state after one round's answers (link, body as text)."""
    rows = state.join(answers.select("link", F.coalesce("body", F.lit("")).alias("_body")), "link", "left")
    rows = rows.withColumns({"_page": F.when(F.col("step") != SIGNED, _page_udf()("_body")), "_said": F.when(F.col("step") == SIGNED, _each(answer_link, "string")("_body"))})
    step, own = F.col("step"), lambda c: F.coalesce(F.col(c), F.lit(""))
    signature, stamp = (F.when(step == PAGE, own(f"_page.{c}")).otherwise(F.col(c)) for c in ("signature", "stamp"))
    # the engine's word counts if it leads elsewhere; else the feed's page, else the page's own link
    elsewhere = (own("_said") != "") & ~own_domain("_said")
    last = F.coalesce(F.nullif(own("_page.link"), F.lit("")), "page_link", F.lit(""))
    target = F.when(step == SIGNED, F.when(elsewhere, F.col("_said"))).when(step == FEED, last)
    after = F.when(step == PAGE, F.when((own("_page.signature") != "") & (own("_page.stamp") != ""), SIGNED).otherwise(FEED)).when((step == SIGNED) & ~elsewhere, FEED)
    kept = {"page_link": F.when(step == PAGE, own("_page.link")).otherwise(F.col("page_link")), "signature": signature, "stamp": stamp, "target": target, "step": after}
    return rows.select("link", "token", *[c.alias(n) for n, c in kept.items()])


def resolved(items: DataFrame, link: str = "link", ask: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """items with resolved_url, resolved_ok, resolver_method and token_decoded. ask answers requests (link, url, method, data,
    headers) with a body each as text; without it, only what tokens hold is resolved."""
    tokens = _each(lambda u: markup.news_token(u) or "", "string")
    named = items.withColumn("_token", tokens(F.col(link)))
    found = written(named.filter("_token <> ''").select(F.col(link).alias("link"), F.col("_token").alias("token")).distinct())
    found = written(found.withColumn("decoded", _each(lambda t: markup.decode_token(t) or "", "string")("token")))
    settled = found.filter(valid("decoded")).select("link", F.col("decoded").alias("target"), F.lit(True).alias("by_token"))
    blank = F.lit("")
    state = written(found.filter(~valid("decoded")).select("link", "token", blank.alias("page_link"), blank.alias("signature"), blank.alias("stamp"), F.lit(None).cast("string").alias("target"), F.lit(PAGE).alias("step")))
    while ask is not None and rows_of(state):
        moved = written(_moved(state, ask(_requests(state))))
        settled = settled.unionByName(moved.filter("step is null").select("link", "target", F.lit(False).alias("by_token")))
        state = written(moved.filter("step is not null"))
    rows = named.join(settled.withColumnsRenamed({"link": "_link", "target": "_target", "by_token": "_by"}), F.col(link) == F.col("_link"), "left")
    wrapped, good, left = F.col("_token") != "", valid("_target"), F.coalesce(own_domain("_target"), F.lit(False)) & (F.coalesce("_target", F.lit("")) != "")
    method = F.when(F.coalesce(~wrapped, F.lit(True)), F.when(valid(link), "not_google_news").otherwise("failed")).when(good, F.when(F.col("_by"), "token_decode").otherwise("html_extract")).when(left, "failed_google_link_left").otherwise("failed_html_extract")
    rows = rows.withColumn("resolver_method", method)
    ok = ~F.startswith("resolver_method", F.lit("failed"))
    url = F.when(F.col("resolver_method") == "not_google_news", F.col(link)).when(ok, F.col("_target")).otherwise("")
    rows = rows.withColumns({"resolved_url": url, "resolved_ok": ok, "token_decoded": F.col("resolver_method") == "token_decode"})
    return rows.drop("_token", "_link", "_target", "_by")

"""Choosing and showing a day's digest: companies, ranking, pools, topics, messages, HTML."""

from __future__ import annotations

import hashlib
import hmac
import html
from base64 import b64encode
from string import Template

from datetime import datetime, timedelta
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import vocabulary as V
from ..functions import summaries as sm
from ..functions import text as tx
from . import similarity


def company_aliases(companies: DataFrame) -> DataFrame:
    """alias, company_id, place: ids, names and aliases, longest first; companies has id, name, aliases and ord."""
    each = companies.select("id", "ord", F.posexplode(F.concat(F.array("id", "name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("pos", "alias"))
    named = each.select(F.lower(F.trim("alias")).alias("alias"), "id", "ord", "pos").filter(F.char_length("alias") >= 2)
    last = named.groupBy("alias").agg(F.max_by("id", F.struct("ord", "pos")).alias("company_id"), F.min(F.struct("ord", "pos")).alias("first"))
    return last.select("alias", "company_id", F.row_number().over(W.orderBy(F.desc(F.char_length("alias")), "first")).alias("place"))


def infer_company(current: Column | str, title: Column | str, aliases: list[tuple[str, str]]) -> Column:
    """The company of a row, by aliases in order (alias, id): a valid id stays, else an alias within it or
    around it, else the first alias in the title, else other. aliases is configuration, so a list."""
    given, low = tx.strip(current), F.lower(tx.strip(current))
    ids = sorted({i for _, i in aliases})
    listed = F.array(*[F.struct(F.lit(a).alias("alias"), F.lit(i).alias("id")) for a, i in aliases])
    first = lambda fits: F.try_element_at(F.filter(listed, fits), F.lit(1))["id"]
    by_id = F.when((given != "") & (given != "other"), F.coalesce(first(lambda x: x["alias"] == low), first(lambda x: F.contains(low, x["alias"]) | F.contains(x["alias"], low))))
    return F.when(given.isin(*ids), given).otherwise(F.coalesce(by_id, first(lambda x: F.contains(F.lower(tx.text(title)), x["alias"])), F.lit("other")))


def ranked_pool(brief: DataFrame, top_n: int = 12) -> DataFrame:
    """The latest 3 * top_n rows: the pool that deduplication works on."""
    return brief.orderBy(F.col("published_at_utc").desc_nulls_last(), "seq").limit(3 * top_n)


def digest_rows(brief: DataFrame, top_n: int = 12, threshold: float = 0.45) -> DataFrame:
    """At most 2 * top_n rows of the pool, by importance, then time, without titles like an earlier one's."""
    order = W.orderBy(F.desc("importance"), F.col("published_at_utc").desc_nulls_last(), "seq")
    pool = ranked_pool(brief, top_n).withColumn("place", F.row_number().over(order)).withColumn("tokens", F.array_distinct(tx.tokenize("title_zh")))
    pairs = similarity.jaccard_pairs(pool.filter(F.size("tokens") > 0), "id", threshold)
    kept = similarity.greedy_keep(pool, pairs, "id", "place")
    return kept.orderBy("place").limit(2 * top_n).withColumn("topic", sm.topic("tags")).drop("tokens")


def top_important(brief: DataFrame, top_n: int = 8) -> DataFrame:
    return brief.orderBy(F.desc("importance"), "seq").limit(top_n)


def message(rows: list, date_text: str, url: str, total: int, kept: int) -> str:
    """A text of the top rows, each with its so-what or the summary up to the first full stop."""
    lines = [f"{date_text} digest: {kept} of {total}"]
    for i, r in enumerate(rows, 1):
        lines += [f"{i}. {r['title_zh']}", f"   {(r['summary_so_what'] or '').strip() or (r['summary_zh'] or '').split('。')[0]}", f"   {r['link']}"]
    return "\n".join([*lines, url])


#: Fixed texts of the group channel's message.
GROUP_TITLE, GROUP_WINDOW, GROUP_SO_WHAT, GROUP_TARGETS, GROUP_NO_TARGETS, GROUP_PAGE = "行业简报（统计日）", "统计窗口（北京时间）：", "So what：", "影响对象：", "未标注", "完整网页："


def group_message(rows: list, date_text: str, url: str, start: str = "", end: str = "", title: str = GROUP_TITLE) -> str:
    """The group channel's text: five lines at most a row, blank ones left out, null fields counting as empty. The window's
    first day, if known, is the day that is reported on."""
    start, end, url = (x.strip() for x in (start, end, url))
    parts = [title + (start.split(" ")[0] or date_text)]
    if start and end:
        parts.append(f"{GROUP_WINDOW}{start} ~ {end}")
    for i, r in enumerate(rows, 1):
        said = {k: (r[k] or "").strip() for k in ("title_zh", "summary_so_what", "summary_zh", "link")}
        legacy = said["summary_zh"].split("。")[0].strip()
        so_what = said["summary_so_what"] or (legacy and legacy + "。")
        targets = " / ".join(x.strip() for x in r["impact_targets"] or [] if x and x.strip())
        lines = [f"{i}. {said['title_zh']}", so_what and GROUP_SO_WHAT + so_what, GROUP_TARGETS + (targets or GROUP_NO_TARGETS), said["link"]]
        parts.append("\n".join(x for x in lines if x))
    return "\n\n".join([*parts, *([GROUP_PAGE + url] if url else [])])


def group_payload(text: str) -> dict:
    return {"msgtype": "text", "text": {"content": text}}


def webhook_sign(secret: str, timestamp: str) -> str:
    return b64encode(hmac.new(f"{timestamp}\n{secret}".encode(), b"", hashlib.sha256).digest()).decode()


def message_id(seed: str) -> str:
    return hashlib.sha1(seed.encode()).hexdigest()


def response_code(body: dict, keys: tuple[str, ...] = ("code", "StatusCode", "errcode")) -> int:
    for k in keys:
        if k in body:
            try:
                return int(body[k])
            except (TypeError, ValueError):
                return -1
    return -1


_PAGE = Template("""<!doctype html><html lang="zh"><head><meta charset="utf-8"><title>$date</title></head><body>
<h1>$date</h1><p>$kpis</p><nav>$chips</nav>$sections<h2>Funnel</h2><table>$funnel</table><h2>Drop reasons</h2><table>$reasons</table><h2>Failed sources</h2><ul>$failed</ul>
<script>document.querySelectorAll('[data-pick]').forEach(b => b.onclick = () => {
  document.querySelectorAll('article').forEach(a => a.hidden = b.dataset.pick && a.dataset.company !== b.dataset.pick);
  document.querySelectorAll('section').forEach(s => s.hidden = ![...s.querySelectorAll('article')].some(a => !a.hidden));
});</script></body></html>""")


def company_names(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """rows with company_name: the name configured for company_id, else the id; companies (id, name) is configuration."""
    named = companies.groupBy(F.col("id").alias("company_id")).agg(F.min("name").alias("_name"))
    return rows.join(F.broadcast(named), "company_id", "left").withColumn("company_name", F.coalesce(F.nullif(F.trim("_name"), F.lit("")), "company_id")).drop("_name")


def shanghai(utc: str) -> str:
    """A UTC time as cards show it."""
    try:
        return (datetime.fromisoformat(utc) + timedelta(hours=8)).strftime("%Y-%m-%d %H:%M")
    except (TypeError, ValueError):
        return utc or ""


def page(rows: list, funnel: list, reasons: list, date_text: str, failed: list = ()) -> str:
    """HTML of the digest's rows (bounded: at most 2 * top_n), the report's tables and the first 20 failed sources."""
    e = lambda x: html.escape(str(x if x is not None else ""))

    def card(r) -> str:
        mark = "★ " if r["importance"] >= 4 else ""
        return f"<article data-company='{e(r['company_id'])}'><h3>{mark}<a href='{e(r['link'])}'>{e(r['title_zh'])}</a></h3><small>{e({'domestic': '国内', 'foreign': '海外'}.get(r['region'], r['region']))} {e(shanghai(r['published_at_utc']))}</small><p>{e(r['summary_zh'])}</p></article>"

    sections = "".join(f"<section><h2>{e(t)}</h2>{''.join(map(card, own))}</section>" for t, _ in V.TOPICS if (own := [r for r in rows if r["topic"] == t]))
    companies = sorted({r["company_id"] for r in rows} - {"other", "", None})
    names = {r["company_id"]: r.get("company_name") or r["company_id"] for r in rows}
    chips = "<button data-pick=''>all</button>" + "".join(f"<button data-pick='{e(c)}'>{e(names.get(c, c))}</button>" for c in companies)
    names_of_failed = "".join(f"<li>{e(name)}: {e(reason)}</li>" for name, reason, *_ in list(failed)[:20]) or "<li>暂无数据</li>"
    table = lambda some: "".join("<tr>" + "".join(f"<td>{e(v)}</td>" for v in r) + "</tr>" for r in some) or "<tr><td>暂无数据</td></tr>"
    kpis = f"{len(rows)} / {sum(r['importance'] >= 4 for r in rows)} / {len(companies)}"
    return _PAGE.substitute(date=e(date_text), kpis=e(kpis), chips=chips, sections=sections, funnel=table(funnel), reasons=table(reasons), failed=names_of_failed)

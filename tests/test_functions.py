"""Columns against plain Python on rows with every edge."""

import re
from datetime import datetime, timedelta, timezone
from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire.functions import dates, markup, summaries as sm, text as tx


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).select(column).collect()]


TEXTS = [None, "", "  a　b \x1c c ", "<b>Hi</b>  you", "中文 (删) Title! L4", "A(B)C - 2024", "x" * 5000]


def test_clean_text(spark):
    want = [re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", t or "")).strip() for t in TEXTS]
    assert values(spark, tx.clean_text("x"), TEXTS) == want


def test_normalize_title(spark):
    def plain(t):
        s = re.sub(r"\(.*?\)", "", (t or "").lower().strip())
        return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9一-鿿]+", " ", s)).strip()

    assert values(spark, tx.normalize_title("x"), TEXTS) == [plain(t) for t in TEXTS]


URLS = [
    None, "", "ftp://a/b", "HTTP://Host.com/P?b=2&a=1&utm_source=x&a=0#f", "https://a.b:80/x y;p?q=%20z&c&d=", "https://a.b", "http://a.b/?x=~*&x=%E4%B8%AD", "https://a/b?utm_medium=1", "https://a.b/路?k=中 文",
]


def test_normalize_url(spark):
    def plain(u):
        p = urlparse((u or "").strip())
        if p.scheme not in {"http", "https"}:
            return ""
        q = sorted((k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if not k.startswith("utm_"))
        return urlunparse(p._replace(fragment="", query=urlencode(q)))

    assert values(spark, tx.normalize_url("x"), URLS) == [plain(u) for u in URLS]


def test_tokenize_language_hits(spark):
    assert values(spark, tx.tokenize("x"), ["L4 无人a b2", None]) == [["l4", "无", "人", "a", "b2"], []]
    assert values(spark, tx.detect_language("x"), ["abc", "a中", None]) == ["en", "zh", "en"]
    assert values(spark, tx.hits("x", ("b", "a", "zz")), ["cab", ""]) == [["a", "b"], []]
    assert values(spark, tx.inject_recency("x"), ["q", "q WHEN:1D", ""]) == ["q when:1d", "q WHEN:1D", ""]


NOW = datetime(2024, 2, 5, 12, tzinfo=timezone.utc)
DATES = {
    "Mon, 05 Feb 2024 10:20:30 +0800": "2024-02-05T02:20:30", "Mon, 05 Feb 2024   10:20:30 GMT": "2024-02-05T10:20:30", "2024-02-05T10:20:30Z": "2024-02-05T10:20:30",
    "2024-02-05T10:20:30+08:00": "2024-02-05T02:20:30", "2024-02-05 10:20:30 +0800": "2024-02-05T02:20:30", "2024-02-05 10:20 +0800": "2024-02-05T02:20:00", "2024-02-05 10:20:30": "2024-02-05T10:20:30",
    "2024-02-05 10:20": "2024-02-05T10:20:00", "2024/02/05 10:20:30": "2024-02-05T10:20:30", "2024/2/5 10:20": "2024-02-05T10:20:00", "2024/02/05": "2024-02-05T00:00:00", "2024年2月5日 10:20:30": "2024-02-05T10:20:30",
    "2024年2月5日 10:20": "2024-02-05T10:20:00", "2024-02-05": "2024-02-05T00:00:00", "2024年02月05日": "2024-02-05T00:00:00", "5 Feb 2024 10:20:30 EST": "2024-02-05T15:20:30",
    "2024-02-05T10:20:30.5+00:00": "2024-02-05T10:20:30", "20240205": "2024-02-05T00:00:00", "2024-W06-1": "2024-02-05T00:00:00", "2 hours ago": "2024-02-05T10:00:00", "30 min ago": "2024-02-05T11:30:00",
    "3天前": "2024-02-02T12:00:00", "5分钟前": "2024-02-05T11:55:00", "yesterday": "2024-02-04T12:00:00", "昨天 10:00": "2024-02-04T12:00:00", "刚刚": "2024-02-05T12:00:00",
}
BAD = {"": "missing", None: "missing", "5 mins ago": "unparseable_relative", "February 5, 2024": "unparseable_other", "2024.02.05": "unparseable_other", "5h": "unparseable_other", "2024-13-40": "unparseable_other"}


def test_dates(spark):
    as_of = F.lit("2024-02-05 12:00:00").cast("timestamp")
    got = values(spark, dates.parse_datetime("x", as_of), [*DATES, *BAD])
    assert {k: (r["ts"].isoformat()[:19], r["status"]) for k, r in zip(DATES, got)} == {k: (v, "ok") for k, v in DATES.items()}
    assert {k: r["status"] for k, r in zip(BAD, got[len(DATES) :])} == BAD


def test_region_and_windows(spark):
    as_of = F.lit("2024-02-05 12:00:00").cast("timestamp")
    got = values(spark, dates.parse_in_region("x", "r", as_of), [("2024-02-05 10:00", "domestic"), ("2024-02-05 10:00", "foreign"), ("2024-02-05T10:00:00Z", "domestic")], "x string, r string")
    assert [r["ts"].hour for r in got] == [2, 10, 10]
    edges = ["2024-01-13 15:59:59", "2024-01-13 16:00:00", "2024-01-14 15:59:59", "2024-01-14 16:00:00"]
    assert values(spark, dates.in_window(F.col("x").cast("timestamp"), "2024-01-15"), edges) == [False, True, True, False]
    assert NOW - timedelta(days=1) < NOW


def test_summaries(spark):
    assert values(spark, sm.infer_tags("x"), ["CPUC permit, funding and launch and safety", "none", None]) == [["监管", "融资", "扩张"], ["运营"], ["运营"]]
    assert values(spark, sm.infer_impact_targets("x"), ["fleet 芯片 ipo oem", "-"]) == [["运营方", "车企", "供应链"], ["运营方"]]
    assert values(spark, sm.topic(F.array("x")), ["安全", "合作", "?"]) == ["安全事件", "融资与资本", "商业运营"]
    assert values(spark, sm.ensure_sentence("x"), ["What: go,", "好！", " "]) == ["go。", "好！", ""]
    rows = [("a", "b", "c", "监管"), ("", "b", "c", "监管"), ("a", "", "c", "监管"), ("a", "b", "", "监管"), ("a。x。y", "b", "c", "监管"), ("详见原文", "b", "c", "监管"), ("a", "b", "c", "no")]
    got = values(spark, sm.validation("a", "b", "c", F.array("t")), rows, "a string, b string, c string, t string")
    assert got == ["ok", "missing_what", "missing_why", "missing_so_what", "sentence_count_out_of_range", "contains_ban_phrase", "invalid_impact_targets"]
    assert values(spark, sm.classify_error("x")["code"], ["", "HTTP 403", "timed out", "http/2 stream 1 was not closed cleanly", "boom", None]) == ["", "access_forbidden", "timeout", "upstream_h2_reset", "unknown_error", ""]
    assert values(spark, sm.fallback("x", F.lit("Body text"))["confidence"], ["Title"]) == [0.55]


HTML = """<html><head><title>Big &amp; news</title><meta property="article:published_time" content="2024-01-02T03:04:05Z"></head><body>
<article><h1>Head <b>line</b></h1><p>One.</p><p>Two.</p><script>x</script></article><a href="/a b.pdf">p</a><a href="javascript:1">j</a><a href="/a b.pdf">again</a>
<script type="application/ld+json">[{"@type":"Thing"},{"@graph":[{"@type":"NewsArticle","headline":"H","articleBody":"Body","datePublished":"2024-05-06"}]}]</script></body></html>"""


def test_markup():
    got = markup.article("http://h/x", HTML)
    assert (got["title"], got["content"], got["dates"][0], got["attachment_link"]) == ("Head line", "One. Two.", "2024-01-02T03:04:05Z", "http://h/a b.pdf")
    assert markup.article_jsonld("http://h/x", HTML)["title"] == "H"
    assert markup.links("http://h/x", HTML) == ["http://h/a%20b.pdf"]
    assert markup.article_date(HTML, "http://h/x") == ("2024-05-06", "jsonld")
    assert markup.article_date("<body><time datetime='2024-01-01'></time>", "") == ("2024-01-01", "time_datetime")
    assert markup.article_date("", "") == ("", "unresolved")


def test_cards_and_tokens():
    page = '<div class="news-card newsitem cardcommon" data-url="http://a" data-title="T" data-author="Au"><div class="snippet">S</div><div class="source"><span>Site</span><span aria-label="5h">5h</span></div></div>' * 2
    (card,) = markup.cards(page, "bing_news", "src", "q")
    assert (card["link"], card["source_name"], card["published"], card["search_rank"]) == ("http://a", "Site", "5h", 1)
    import base64

    url = b"https://example.com/x"
    token = base64.urlsafe_b64encode(b"\x08\x13\x22" + bytes([len(url)]) + url).decode().rstrip("=")
    assert markup.decode_token(markup.news_token(f"https://news.google.com/rss/articles/{token}")) == url.decode()
    assert markup.decode_token("!!") is None and markup.news_token("https://x/y") is None
    assert markup.unwrap_jump("https://sou.toutiao.com/search/jump?url=https%3A%2F%2Fa.b%2Fc") == "https://a.b/c"
    assert markup.decode_xml('<?xml version="1.0" encoding="gb2312"?><a>中</a>'.encode("gb18030")).endswith("<a>中</a>")


def test_selector_errors():
    with pytest.raises(ValueError):
        markup.select(markup.parse("<a>"), "a:hover(")


def test_nested_jump_links():
    from urllib.parse import quote

    jump = lambda u: f"https://sou.toutiao.com/search/jump?gid=1&url={quote(u, safe='')}&x=2"
    assert markup.unwrap_jump(jump(jump("https://a.b/c?d=e"))) == "https://a.b/c?d=e"
    assert markup.unwrap_jump(" https://a.b ") == "https://a.b" and markup.unwrap_jump(None) == ""


def test_article_dates_are_dates(spark):
    pages = ['<h1>t</h1><time datetime="Mon, 15 Jan 2024 08:00:00 GMT">x</time>', '<h1>t</h1><time datetime="2024-13-45">x</time><p>2024-01-15</p>', "<h1>t</h1><p>none</p>", None]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, html string")
    got = {r.i: r.x for r in rows.select("i", markup.article_columns(F.lit("http://h/"), "html").alias("x")).collect()}
    assert [got[i].published for i in range(4)] == ["Mon, 15 Jan 2024 08:00:00 GMT", "2024-01-15", "", ""]
    bad = rows.select(markup.article_columns(F.lit("http://h/"), "html", {"title": "h1:first-child>b"}).alias("x")).collect()
    assert all("selector" in r.x.error for r in bad) and rows.select(markup.links_udf("a:not(b)")(F.lit("http://h/"), "html").alias("x")).first().x == []


def test_page_titles_end_in_cut_references(spark, tmp_path):
    """A title cut within a reference; whole references, by name and number, and a bare ampersand."""
    from tidewire.plans import contract

    titles = ["A &amp;&amp; b &amp", "x &lt; y &#x27;z&#x27;&lt", "plain & simple", "&quot;q&quot; &amp;amp", ""]
    pages = [(i, "http://h/", f"<html><head><title>{t}</title></head><body><p>&ampx</p></body></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.title for r in contract.page_titles(spark, str(tmp_path)).collect()}
    want = dict(duckdb.sql(contract.oracle_sql()["page_titles"].replace("from pages", f"from '{tmp_path}/pages.parquet/*.parquet'")).fetchall())
    assert got == want and got[0] == "A && b &amp"
    assert markup.article("", pages[0][2], {"title": "title"})["title"] == "A && b &"  # what the operator does by itself

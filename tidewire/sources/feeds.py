"""Parsing what sources return: RSS and Atom, sitemaps, search and official APIs, result pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import markup
from ..functions import text as tx

_RSS = "channel struct<item: array<struct<title: string, link: string, description: string, encoded: string, pubDate: string, date: string, source: string>>>"
_ATOM_LINK = "array<struct<_VALUE: string, _href: string, _rel: string>>"
_ATOM = f"entry array<struct<title: string, summary: string, content: string, link: {_ATOM_LINK}, published: string, updated: string>>"
_ILLEGAL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]"


def _own(captures: DataFrame) -> list[str]:
    """A request's columns that its items keep."""
    return [c for c in ("request", "most", "capped_by", "query", "query_group") if c in captures.columns]


def sanitize_xml(xml: Column | str) -> Column:
    """Without characters that XML 1.0 doesn't allow, doctypes and namespace prefixes of elements."""
    bare = F.regexp_replace(F.regexp_replace(tx.text(xml), _ILLEGAL, ""), r"(?is)^\s*(?:<\?xml[^>]*\?>)?\s*(?:<!DOCTYPE[^>]*>)?", "")
    return F.regexp_replace(bare, r"<(/?)(?:content|dc|media):(encoded|date)\b", "<$1$2")


def parse_feeds(captures: DataFrame, body: str = "body") -> DataFrame:
    """captures (source_id, source_name, body as text) to items with pos. Rows need a title and a link."""
    xml = sanitize_xml(body)
    rss = F.from_xml(xml, _RSS, {"rowTag": "rss"})
    atom = F.from_xml(xml, _ATOM, {"rowTag": "feed"})
    rss_items = F.transform(F.coalesce(rss["channel"]["item"], F.array()), lambda x: F.struct(x["title"].alias("title"), F.coalesce(F.nullif(F.trim(x["description"]), F.lit("")), x["encoded"]).alias("content"), x["link"].alias("link"), F.coalesce(x["pubDate"], x["date"]).alias("published"), x["source"].alias("source")))
    good = lambda links: F.try_element_at(F.filter(links, lambda y: F.coalesce(y["_rel"], F.lit("")).isin("", "alternate") & y["_href"].isNotNull()), F.lit(1))["_href"]
    atom_items = F.transform(F.coalesce(atom["entry"], F.array()), lambda x: F.struct(x["title"].alias("title"), F.coalesce(F.nullif(F.trim(x["summary"]), F.lit("")), x["content"]).alias("content"), good(x["link"]).alias("link"), F.coalesce(x["published"], x["updated"]).alias("published"), F.lit(None).cast("string").alias("source")))
    is_atom = tx.text(body).rlike(r"(?is)<feed[\s>]")
    each = captures.select("source_id", "source_name", *_own(captures), F.posexplode(F.when(is_atom, atom_items).otherwise(rss_items)).alias("pos", "x"))
    content = tx.clean_text("x.content")
    rows = each.select(
        "source_id", "pos", *_own(captures), tx.clean_text("x.title").alias("title"), content.alias("content"), content.alias("summary"), tx.strip("x.link").alias("link"),
        tx.strip("x.published").alias("published"), F.coalesce(F.nullif(tx.strip("x.source"), F.lit("")), F.col("source_name")).alias("source_name"),
    )
    return rows.filter((F.col("title") != "") & (F.col("link") != ""))


def capped_items(items: DataFrame, most: Column | int, order: tuple[str, ...] = ("pos",), by: tuple[str, ...] = ("source_id",)) -> DataFrame:
    """Each source's first `most` items by position: a bound of the connector, as configured; null is none."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    most = F.lit(most) if isinstance(most, int) else most
    return items.withColumn("_n", place).filter(most.isNull() | (F.col("_n") <= most)).drop("_n")


def parse_sitemaps(captures: DataFrame, body: str = "body") -> DataFrame:
    """source_id, pos, link of every loc, with or without a namespace prefix; malformed XML gives none."""
    found = F.regexp_extract_all(tx.text(body), F.lit(r"(?is)<(?:\w+:)?loc\s*>\s*(.*?)\s*</(?:\w+:)?loc\s*>"), F.lit(1))
    whole = tx.text(body).rlike(r"(?is)</(?:\w+:)?(urlset|sitemapindex)\s*>\s*$")
    unescaped = lambda x: F.replace(F.regexp_replace(x, r"^<!\[CDATA\[|\]\]>$", ""), F.lit("&amp;"), F.lit("&"))
    return captures.filter(whole).select("source_id", F.posexplode(found).alias("pos", "link")).withColumn("link", tx.strip(unescaped(F.col("link")))).filter("link <> ''")


def parse_search_api(captures: DataFrame, body: str = "body") -> DataFrame:
    """News results of a search API's JSON."""
    parsed = F.from_json(body, "news_results array<struct<title:string, snippet:string, link:string, date:string, source:string>>")
    each = captures.select("source_id", "source_name", *_own(captures), F.posexplode(parsed["news_results"]).alias("pos", "x"))
    rows = each.select("source_id", "pos", *_own(captures), tx.clean_text("x.title").alias("title"), tx.clean_text("x.snippet").alias("content"), tx.clean_text("x.snippet").alias("summary"), tx.strip("x.link").alias("link"), tx.strip("x.date").alias("published"), F.coalesce(F.nullif(tx.strip("x.source"), F.lit("")), F.col("source_name")).alias("source_name"))
    return rows.filter((F.col("title") != "") & (F.col("link") != ""))


def parse_official_api(captures: DataFrame, body: str = "body") -> DataFrame:
    """Documents of an official register's JSON."""
    parsed = F.from_json(body, "results array<struct<title:string, html_url:string, abstract:string, excerpt:string, summary:string, publication_date:string, pdf_url:string>>")
    each = captures.select("source_id", "source_name", *_own(captures), F.posexplode(parsed["results"]).alias("pos", "x"))
    content = tx.clean_text(F.coalesce(*[F.nullif(F.col(f"x.{c}"), F.lit("")) for c in ("abstract", "excerpt", "summary")]))
    rows = each.select("source_id", "pos", *_own(captures), tx.clean_text("x.title").alias("title"), F.substring(content, 1, 4000).alias("content"), F.substring(content, 1, 320).alias("summary"), tx.strip("x.html_url").alias("link"), tx.strip("x.publication_date").alias("published"), tx.strip("x.pdf_url").alias("attachment_link"), "source_name")
    return rows.filter((F.col("title") != "") & (F.col("link") != ""))


def parse_result_pages(captures: DataFrame, provider: str, most: int = 20) -> DataFrame:
    """Cards of result pages: captures has source_id, source_name, query, body."""
    found = captures.withColumn("x", F.explode(markup.cards_udf(provider, most)("body", "source_name", "query")))
    return found.select("source_id", *[c for c in _own(captures) if not c.startswith("query")], "x.*")


def article_links(captures: DataFrame, selector: str | Column = "a") -> DataFrame:
    """source_id, pos, link: a page's links in order, each once. selector may be a column."""
    found = markup.links_udf(selector)("url", "body") if isinstance(selector, str) else markup.links_udf(None)("url", "body", selector)
    return captures.select("source_id", *_own(captures), F.posexplode(found).alias("pos", "link"))


def site_links(links: DataFrame, year: int, source_id: str = "singapore_lta_news_structured") -> DataFrame:
    """One site's links by their year and month, latest first, not older than the year before; others as they are. pos
    is a link's place in its source then."""
    pattern = r"/en/newsroom/(\d{4})/(\d{1,2})/(?:news-release|news-releases|media-replies)/"
    y, m = (F.regexp_extract("link", pattern, i).try_cast("int") for i in (1, 2))
    dated = links.withColumns({"_y": F.when(F.col("source_id") == source_id, y), "_m": F.when(F.col("source_id") == source_id, m)})
    return dated.filter((F.col("source_id") != source_id) | (F.col("_y") >= year - 1)).withColumn("pos", F.row_number().over(W.partitionBy("source_id").orderBy(F.desc_nulls_last("_y"), F.desc_nulls_last("_m"), *[c for c in ("request",) if c in links.columns], "pos")) - 1).drop("_y", "_m")


def invalid_record(source_id: Column | str, title: Column | str, link: Column | str) -> Column:
    """Records that four sites give for pages that aren't articles (fixed values)."""
    sid, low, name = tx.col(source_id), F.lower(tx.strip(link)), tx.clean_text(title)
    has = lambda *parts: tx.any_hit(low, parts)
    return (
        ((sid == "apollo_go_baidu_structured") & has("/news/apollo-self-driving"))
        | ((sid == "california_dmv_news_structured") & ((F.regexp_replace(low, "/+$", "") == "https://www.dmv.ca.gov/portal/news-and-media/news-releases") | has("/portal/news-and-media/news-releases/")))
        | ((sid == "waymo_blog_structured") & ((F.lower(name) == "latest news") | has("/blog/search", "?t=")))
        | ((sid == "singapore_lta_news_structured") & ((F.upper(name) == "LTA.GOV.SG") | has("/2020/", "/2019/", "/2018/")))
    )

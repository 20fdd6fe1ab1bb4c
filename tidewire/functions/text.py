"""Text and URL columns: cleaning, canonical titles and URLs, tokens, language, keyword hits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, with the four separators that Java's class leaves out.
SPACE = r"(?U)[\s\x1c-\x1f]"
CJK = "一-鿿"
_URL = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """The column as a string, null as empty."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def squeeze(c: Column | str) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(text(c), SPACE + "+", " "))


def strip(c: Column | str) -> Column:
    return F.regexp_replace(text(c), f"^{SPACE}+|{SPACE}+$", "")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_text(c: Column | str) -> Column:
    """Tags to blanks, then squeezed."""
    return squeeze(F.regexp_replace(text(c), "<[^>]+>", " "))


def normalize_title(c: Column | str) -> Column:
    """Lower case, bracketed parts dropped, anything but a-z, 0-9 and CJK to one blank."""
    bare = F.regexp_replace(strip(F.lower(text(c))), r"\([^\n]*?\)", "")
    return F.trim(F.regexp_replace(bare, f"[^a-z0-9{CJK}]+", " "))


def url_part(c: Column | str, group: int) -> Column:
    """Group 1 to 4 of a URL: scheme, authority, path, query."""
    return F.regexp_extract(strip(c), _URL, group)


def host(c: Column | str) -> Column:
    return F.lower(url_part(c, 2))


def normalize_url(c: Column | str) -> Column:
    """http(s) URLs without fragment and utm_ parameters, the others sorted and re-encoded; else empty."""

    def decoded(x: Column) -> Column:
        return F.coalesce(F.try_url_decode(x), x)

    def encoded(x: Column) -> Column:
        return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    scheme, path, query = F.lower(url_part(c, 1)), url_part(c, 3), url_part(c, 4)
    pieces = F.filter(F.split(query, "&", -1), lambda x: x != "")
    pairs = F.transform(pieces, lambda x: F.struct(decoded(F.substring_index(x, "=", 1)).alias("k"), decoded(F.regexp_replace(x, "(?s)^[^=]*=?", "")).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.startswith(p["k"], F.lit("utm_"))))
    tail = F.array_join(F.transform(kept, lambda p: F.concat(encoded(p["k"]), F.lit("="), encoded(p["v"]))), "&")
    rooted = F.when((path != "") & ~F.startswith(path, F.lit("/")), F.concat(F.lit("/"), path)).otherwise(path)
    whole = F.concat(scheme, F.lit("://"), url_part(c, 2), rooted, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(F.lit("")))
    return F.when(scheme.isin("http", "https"), whole).otherwise(F.lit(""))


def fingerprint(title: Column | str) -> Column:
    """SHA-1 of the canonical title, or of the lower-case one if nothing is left of it."""
    canonical = normalize_title(title)
    return F.sha1(F.when(canonical != "", canonical).otherwise(F.lower(text(title))))


def detect_language(c: Column | str) -> Column:
    return F.when(text(c).rlike(f"[{CJK}]"), F.lit("zh")).otherwise(F.lit("en"))


def tokenize(c: Column | str) -> Column:
    """Runs of a-z and 0-9, and single CJK characters, of the lower-case text."""
    return F.regexp_extract_all(F.lower(text(c)), F.lit(f"[a-z0-9]+|[{CJK}]"), F.lit(0))


def words_of(words: Iterable[str]) -> list[str]:
    """Keywords stripped, lower-case, distinct and sorted."""
    return sorted({w.strip().lower() for w in words if w and w.strip()})


def hits(c: Column | str, words: Iterable[str] | Column) -> Column:
    """Those words (a list, or an array column) that occur in the text, distinct and sorted."""
    if isinstance(words, Column):
        listed = words
    else:
        known = sorted({w for w in words if w})
        listed = F.array(*[F.lit(w) for w in known]) if known else F.array().cast("array<string>")
    return F.filter(listed, lambda w: F.contains(col(c), w))


def any_hit(c: Column | str, words: Iterable[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(col(c), F.lit(w))
    return found


def inject_recency(query: Column | str, token: str = "when:1d") -> Column:
    """The query with the recency token, unless it holds it in any case."""
    q = strip(query)
    return F.when((q == "") | F.contains(F.lower(q), F.lit(token.lower())), q).otherwise(F.concat_ws(" ", q, F.lit(token)))

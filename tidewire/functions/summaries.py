"""Columns over summaries: tags, impact targets, clauses and sentences, validation, fallbacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V
from . import text as tx

_ENDS = "。！？!?"
_TRIM = r" \t\n\r,，;；"


def _labels(low: Column, table: dict[str, Sequence[str]], order: Sequence[str], default: str, most: int) -> Column:
    """The labels, in order, of which a word occurs in the text; at most `most`; else the default."""
    each = lambda text: F.array(*[F.when(tx.any_hit(text, table.get(label, ())), F.lit(label)) for label in order])
    found = F.filter(tx.let(low, each), lambda x: x.isNotNull())
    return tx.let(found, lambda x: F.slice(F.when(F.size(x) > 0, x).otherwise(F.array(F.lit(default))), 1, most))


def infer_tags(text: Column | str) -> Column:
    return _labels(F.lower(tx.text(text)), V.TAG_WORDS, V.ALLOWED_TAGS, V.DEFAULT_TAG, 3)


def infer_impact_targets(text: Column | str, taxonomy: Sequence[str] = V.IMPACT_TARGETS) -> Column:
    return _labels(F.lower(tx.text(text)), V.IMPACT_WORDS, taxonomy, taxonomy[0], 3)


def topic(tags: Column | str) -> Column:
    """The topic of the first tag."""

    def named(first: Column) -> Column:
        out = F.lit(V.DEFAULT_TOPIC)
        for name, members in V.TOPICS:
            out = F.when(first.isin(*members), F.lit(name)).otherwise(out)
        return out

    return tx.let(F.trim(F.coalesce(F.try_element_at(tx.col(tags), F.lit(1)), F.lit(""))), named)


def event_region(region: Column | str, title: Column | str) -> Column:
    low = F.lower(F.coalesce(tx.col(region), F.lit("foreign")))
    return F.when((low == "domestic") & tx.any_hit(tx.text(title), V.FOREIGN_PLACES), F.lit("foreign")).otherwise(low)


def clean_clause(c: Column | str) -> Column:
    bare = F.regexp_replace(tx.squeeze(c), r"(?i)^(what|why|so\s*what)\s*[:：]\s*", "")
    return F.regexp_replace(bare, f"^[{_TRIM}]+|[{_TRIM}]+$", "")


def ensure_sentence(c: Column | str) -> Column:
    clause = clean_clause(c)
    return F.when((clause == "") | clause.rlike(f"[{_ENDS}]$"), clause).otherwise(F.concat(clause, F.lit("。")))


def sentences(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(tx.text(c), f"[{_ENDS}]+", -1), tx.strip), lambda x: x != "")


def contains_phrase(c: Column | str, phrases: Sequence[str]) -> Column:
    return tx.any_hit(F.lower(tx.text(c)), [p.strip().lower() for p in phrases if p.strip()])


def known_targets(targets: Column | str, taxonomy: Sequence[str] = V.IMPACT_TARGETS) -> Column:
    given = F.coalesce(tx.col(targets), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(given, tx.strip), lambda x: x.isin(*taxonomy)))


def compose(what: Column | str, why: Column | str, so_what: Column | str) -> Column:
    part = lambda label, c: F.when(tx.text(c) != "", F.concat(F.lit(label + "："), tx.col(c)))
    return F.concat_ws(" ", part("What", what), part("Why", why), part("So what", so_what))


def validation(what, why, so_what, targets, *, least: int = 2, most: int = 3, need_so_what: bool = True, banned: Sequence[str] = V.BAN_PHRASES, taxonomy: Sequence[str] = V.IMPACT_TARGETS) -> Column:
    """"ok" or the first failure."""
    parts = [clean_clause(c) for c in (what, why, so_what)]
    whole = F.trim(F.concat_ws(" ", *[ensure_sentence(p) for p in parts]))
    n = F.size(sentences(whole))
    return (
        F.when(parts[0] == "", "missing_what").when(parts[1] == "", "missing_why").when(F.lit(need_so_what) & (parts[2] == ""), "missing_so_what")
        .when((n < least) | (n > most), "sentence_count_out_of_range").when(contains_phrase(whole, banned), "contains_ban_phrase")
        .when(F.size(known_targets(targets, taxonomy)) == 0, "invalid_impact_targets").otherwise("ok")
    )


def json_object(c: Column | str, schema: str) -> Column:
    """The struct in the text from the first { to the last }; null if there is none."""
    return F.from_json(F.nullif(F.regexp_extract(tx.text(c), r"(?s)\{.*\}", 0), F.lit("")), schema)


def clamp(c: Column, low: float, high: float, default: float, kind: str) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(tx.col(c).try_cast(kind), F.lit(default)))).cast(kind)


def normalized(raw: Column, title: Column | str, content: Column | str) -> Column:
    """A model's struct (title_zh, what, why, so_what, impact_targets, tags, confidence, importance) in bounds."""
    what, why, so_what = (ensure_sentence(raw[c]) for c in ("what", "why", "so_what"))
    tags = F.array_distinct(F.filter(F.transform(F.coalesce(raw["tags"], F.array().cast("array<string>")), tx.strip), lambda x: x.isin(*V.ALLOWED_TAGS)))
    inferred = infer_tags(F.concat_ws(" ", tx.text(title), tx.text(content), what, why, so_what))
    return F.struct(
        F.coalesce(F.nullif(tx.strip(raw["title_zh"]), F.lit("")), tx.text(title)).alias("title_zh"), what.alias("what"), why.alias("why"), so_what.alias("so_what"),
        known_targets(raw["impact_targets"]).alias("impact_targets"), F.slice(F.when(F.size(tags) > 0, tags).otherwise(inferred), 1, 3).alias("tags"),
        clamp(raw["confidence"], 0.0, 1.0, 0.72, "double").alias("confidence"), clamp(raw["importance"], 1, 5, 3, "int").alias("importance"),
    )


def fallback(title: Column | str, content: Column | str) -> Column:
    """A summary from fixed sentences, by the language of the text."""
    head, body = tx.text(title), tx.squeeze(content)
    whole = F.concat_ws(" ", head, body)
    english = tx.detect_language(whole) == "en"
    first = F.coalesce(F.try_element_at(sentences(body), F.lit(1)), F.lit(V.FALLBACK_ZH_WHY))
    opening, why, so_what = V.FALLBACK_EN
    pick = lambda en, zh: ensure_sentence(F.when(english, en).otherwise(zh))
    return F.struct(
        head.alias("title_zh"), pick(F.concat(head, F.lit(opening.replace("{title}", ""))), head).alias("what"), pick(F.lit(why), F.substring(first, 1, 80)).alias("why"),
        pick(F.lit(so_what), F.lit(V.FALLBACK_ZH_SO_WHAT)).alias("so_what"), infer_impact_targets(whole).alias("impact_targets"), infer_tags(whole).alias("tags"),
        F.lit(0.55).alias("confidence"), F.lit(3).alias("importance"),
    )


def last_resort(title: Column | str, content: Column | str) -> Column:
    """What is shown where even the fallback breaks a rule."""
    what, why, so_what = V.LAST_RESORT
    whole = F.concat_ws(" ", tx.text(title), tx.text(content))
    return F.struct(
        tx.text(title).alias("title_zh"), ensure_sentence(F.coalesce(F.nullif(tx.text(title), F.lit("")), F.lit(what))).alias("what"), ensure_sentence(F.lit(why)).alias("why"), ensure_sentence(F.lit(so_what)).alias("so_what"),
        infer_impact_targets(whole).alias("impact_targets"), infer_tags(whole).alias("tags"), F.lit(0.5).alias("confidence"), F.lit(2).alias("importance"),
    )


def from_cache(entry: Column, title: Column | str, content: Column | str) -> Column:
    """A cached summary, normalised; an old entry with one text is split into its sentences."""
    legacy = sentences(entry["summary_zh"])
    field = lambda c: F.nullif(tx.strip(entry[c]), F.lit(""))
    nth = lambda i: F.try_element_at(legacy, F.lit(i))
    old = F.size(legacy) > 0
    raw = F.struct(
        entry["title_zh"].alias("title_zh"), F.coalesce(field("summary_what"), nth(1)).alias("what"),
        F.coalesce(field("summary_why"), nth(2), F.when(old, F.lit(V.CACHE_WHY))).alias("why"),
        F.coalesce(field("summary_so_what"), nth(3), F.when(old, F.lit(V.CACHE_SO_WHAT))).alias("so_what"), entry["impact_targets"].alias("impact_targets"),
        entry["tags"].alias("tags"), F.coalesce(entry["confidence"], F.lit(0.8)).alias("confidence"), entry["importance"].alias("importance"),
    )
    out = normalized(raw, title, content)
    targets = F.when(F.size(out["impact_targets"]) > 0, out["impact_targets"]).otherwise(infer_impact_targets(F.concat_ws(" ", tx.text(title), tx.text(content))))
    return out.withField("impact_targets", targets)


def classify_error(message: Column | str) -> Column:
    """struct(code, label) of the first rule that fits; empty for an empty message."""
    low = F.lower(tx.text(message))
    code, label = F.lit(V.UNKNOWN_ERROR[0]), F.lit(V.UNKNOWN_ERROR[1])
    for name, said, groups in reversed(V.ERROR_RULES):
        fits = F.lit(False)
        for group in groups:
            every = F.lit(True)
            for word in group:
                every = every & F.contains(low, F.lit(word))
            fits = fits | every
        code, label = F.when(fits, F.lit(name)).otherwise(code), F.when(fits, F.lit(said)).otherwise(label)
    return F.struct(F.when(low == "", "").otherwise(code).alias("code"), F.when(low == "", "").otherwise(label).alias("label"))

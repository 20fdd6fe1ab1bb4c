"""Personal data in documents by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are the spans that four fixed patterns find and checks confirm (e-mail, IPv4 address, card number by
Luhn, phone number). Looser shapes (runs of digits and separators between no letters, anything around an @, addresses with
[at] and [dot]) are candidates. A candidate's lexical patterns are its last shape characters with the word
before it, and with the word after it. Patterns and instances form a graph with a row for each
distinct pair: a pattern's confidence in a kind is the mean score of its instances, an instance's score
one minus the product of its patterns' doubts; seeds are fixed. Rounds go on until no score rises by
SETTLED or more (scores only rise, so they end). Then instances that aren't seeds and score CONFIDENCE or more
become spans; a pattern counts once SUPPORT of its instances are seeds or score that much. Nothing that a
fixed pattern matched and a check refused is ever added, nor a number of more than 19 digits.

Whole texts are scanned where they lie, in chunks of about CHUNK code points cut where no pattern can match
across (a line's end, a comma, a space after a letter), so that a long text costs as much for its length as
a short one; a chunk without such a place is as long as it must be. A pattern starts where its run of
characters does, so a run is read once. Shuffled are candidates. Frequent patterns are pre-aggregated.

Defined results: null text counts as empty; rows equal in doc_id and text have equal spans; repeated rows
stay; an empty table gives no rows; other columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import runtime

KINDS = ("email", "ip", "card", "phone")
#: Each as in the contract, but it starts only at its run's start or where the match before ended, and quantifiers are
#: possessive where that can't change a match. Of card, only runs of 14 to 19 digits.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE = {
    "number": (r"[0-9]", r"(?<![\p{L}0-9])[+(]?[0-9][0-9\x20().-]{4,}[0-9](?![\p{L}0-9])"),
    "at": (r"@", r"(?:(?<![^\s@|,;<>])|\G)[^\s@|,;<>]++@[^\s@|,;<>]++"),
    "spelled": (r"[\[(]at[\])]", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)++"),
}
CONFIDENCE, SUPPORT, SETTLED, CONTEXT, SHAPE, CHUNK, BLOCK = 0.9, 5, 0.005, 40, 8, 4096, 256
#: A chunk ends after a character that no pattern holds, or a space that none can hold where it stands.
_CHUNK = r"(?s).{%d}.*?(?:[\t-\r,;|<>]|(?<=[\p{L}:!?])\x20(?![\[(]))|.+" % CHUNK
_SPAN = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, body) -> Column:
    """body(value), where value is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def before_each(numbers: Column) -> Column:
    """Of an array of numbers: the sum of those before each, block by block."""

    def inside(block: Column, base: Column) -> Column:
        start = F.struct(base.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, start, lambda acc, x: F.struct((acc["at"] + x).cast("int").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def whole(given: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(given) / BLOCK).cast("int") - 1)), lambda b: F.slice(given, b * BLOCK + 1, F.lit(BLOCK)))
        return let(blocks, lambda x: F.flatten(F.zip_with(x, inside(F.transform(x, lambda y: F.aggregate(y, F.lit(0), lambda s, n: s + n)), F.lit(0)), inside)))

    return let(numbers, whole)


def places(text: Column, needs: str, pattern: str) -> Column:
    """Array of (start, end, value) of the leftmost matches: a match begins after the matches before it and what
    stands between them."""

    def placed(x: Column) -> Column:
        steps = F.zip_with(x["found"], F.slice(x["rest"], F.lit(1), F.size(x["found"])), lambda m, gap: F.struct(F.char_length(gap).alias("gap"), F.char_length(m).alias("size"), m.alias("value")))
        return let(steps, lambda y: F.zip_with(y, before_each(F.transform(y, lambda z: z["gap"] + z["size"])), lambda z, at: F.struct((at + z["gap"]).alias("start"), (at + z["gap"] + z["size"]).alias("end"), z["value"].alias("value"))))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("rest"))
    return F.when(text.rlike(needs), let(found, placed)).otherwise(F.array().cast(_SPAN))


def holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, "\\."), lambda x: (F.char_length(F.regexp_replace(x, "^0+", "")) <= 3) & (F.concat(F.lit("0"), F.substring(F.regexp_replace(x, "^0+", ""), 1, 3)).cast("int") <= 255))
    if kind == "card":
        return F.char_length(digits).between(14, 19) & F.when(F.char_length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(digits).between(10, 15)
    return F.lit(True)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, digest, and the arrays spans (start, end, kind) and loose (start, end, value, before, after, kind of a
    span it overlaps, whether it overlaps a refused one)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("digest"), F.regexp_extract_all("text", F.lit(_CHUNK), F.lit(0)).alias("chunks"))
    n = F.size("chunks")
    zipped = F.arrays_zip(
        F.col("chunks").alias("text"), before_each(F.transform("chunks", F.char_length)).alias("at"),
        F.slice(F.concat(F.array(F.lit("")), F.transform("chunks", lambda c: F.right(c, F.lit(CONTEXT)))), F.lit(1), n).alias("before"),
        F.slice(F.concat(F.transform("chunks", lambda c: F.left(c, F.lit(CONTEXT))), F.array(F.lit(""))), F.lit(2), n).alias("after"),
    )
    rows = rows.select("doc_id", "digest", zipped.alias("chunks"))

    def matches(c: Column) -> Column:
        own = [places(c["text"], NEEDS[k], PATTERNS[k]).alias(f"m_{k}") for k in KINDS]
        loose = F.concat(*[places(c["text"], needs, pattern) for needs, pattern in LOOSE.values()])
        return F.struct(*[c[x].alias(x) for x in ("text", "at", "before", "after")], *own, loose.alias("loose"))

    def kept(c: Column, kind: str, good: bool) -> Column:
        chosen = F.filter(c[f"m_{kind}"], lambda x: holds(kind, x["value"]) if good else ~holds(kind, x["value"]))
        return F.transform(chosen, lambda x: F.struct((x["start"] + c["at"]).alias("start"), (x["end"] + c["at"]).alias("end"), F.lit(KINDS.index(kind)).alias("kind")))

    def sorted_out(c: Column) -> Column:
        spans, refused = F.concat(*[kept(c, k, True) for k in KINDS]), F.concat(*[kept(c, k, False) for k in ("ip", "phone", "card")])
        return F.struct(*[c[x].alias(x) for x in ("text", "at", "before", "after", "loose")], spans.alias("spans"), refused.alias("refused"))

    def context(c: Column, x: Column) -> Column:
        before = F.right(F.concat(c["before"], F.left(c["text"], x["start"])), F.lit(CONTEXT))
        after = F.left(F.concat(F.substring(c["text"], x["end"] + 1, F.lit(CONTEXT)), c["after"]), F.lit(CONTEXT))
        start, end = x["start"] + c["at"], x["end"] + c["at"]
        over = F.filter(c["spans"], lambda s: (s["start"] < end) & (start < s["end"]))
        digits = F.char_length(F.regexp_replace(x["value"], "[^0-9]", ""))
        return F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value"),
            F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1)).alias("before"), F.lower(F.regexp_extract(after, r"^[^\p{L}]*(\p{L}+)", 1)).alias("after"),
            F.get(over, F.lit(0))["kind"].alias("kind"), (F.exists(c["refused"], lambda s: (s["start"] < end) & (start < s["end"])) | (digits > 19)).alias("refused"),
        )

    rows = rows.select("doc_id", "digest", F.transform(F.transform("chunks", matches), sorted_out).alias("chunks"))
    return rows.select("doc_id", "digest", F.array_sort(F.flatten(F.transform("chunks", lambda c: c["spans"]))).alias("spans"), F.flatten(F.transform("chunks", lambda c: F.transform(c["loose"], lambda x: context(c, x)))).alias("loose"))


def learned(found: DataFrame) -> DataFrame:
    """doc_id, digest, start, end, kind of the spans that high-confidence patterns add."""
    each = found.select("doc_id", "digest", F.explode("loose").alias("x"))
    shape = F.regexp_replace(F.translate(F.col("x.value"), "0123456789", "9999999999"), "[A-Za-z]+", "a")
    tail = F.substring(shape, -SHAPE, SHAPE)
    each = each.select(
        "doc_id", "digest", "x.start", "x.end", "x.value", "x.kind", "x.refused",
        F.array(
            F.when(F.col("x.before") != "", F.concat_ws("\t", F.lit("before"), F.col("x.before"), tail)),
            F.when(F.col("x.after") != "", F.concat_ws("\t", F.lit("after"), tail, F.col("x.after"))),
        ).alias("patterns"),
    )
    each = runtime.written(each)
    edges = each.select("value", "kind", F.explode("patterns").alias("pattern")).filter(F.col("pattern").isNotNull())
    edges = runtime.written(edges.groupBy("value", "pattern").agg(F.min("kind").alias("seed")))
    kinds = range(len(KINDS))
    scores = [f"s{k}" for k in kinds]
    best = F.greatest(*scores)
    doubts = None
    while True:
        given = edges if doubts is None else edges.join(runtime.small(doubts), "value", "left")
        own = [F.when(F.col("seed") == k, 1.0).when(F.col("seed").isNull() & F.lit(doubts is not None), F.coalesce(F.col(f"s{k}") if doubts is not None else F.lit(0.0), F.lit(0.0))).otherwise(0.0).alias(f"s{k}") for k in kinds]
        scored = given.select("pattern", *own)
        confidence = scored.groupBy("pattern").agg(F.count(F.when(best >= CONFIDENCE, 1)).alias("support"), *[(F.sum(x) / (F.count("*") + 1)).alias(f"c{x[1:]}") for x in scores])
        confidence = runtime.written(confidence.filter(F.col("support") >= SUPPORT))
        after = edges.filter("seed is null").join(runtime.small(confidence), "pattern").groupBy("value").agg(*[(1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col(f"c{k}")))))).alias(f"s{k}") for k in kinds])
        after = runtime.written(after)
        before, doubts = doubts, after
        if before is not None:
            had = before.toDF("value", *[f"had_{x}" for x in scores])
            had._rows_written, had._path = before._rows_written, before._path
            risen = after.join(runtime.small(had), "value", "left").filter(F.greatest(*[F.col(x) - F.coalesce(f"had_{x}", F.lit(0.0)) for x in scores]) >= SETTLED)
            if runtime.is_empty(risen):
                break
        elif runtime.is_empty(after):
            break
    kind = F.coalesce(*[F.when(F.col(x) == best, F.lit(k)) for k, x in enumerate(scores)])
    sure = runtime.written(doubts.filter(best >= CONFIDENCE).select("value", kind.alias("learned")))
    new = each.filter("kind is null and not refused").join(runtime.small(sure), "value")
    return new.select("doc_id", "digest", "start", "end", F.col("learned").alias("kind")).distinct()


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans: arrays of (start, end, kind number), sorted by start, then kind."""
    runtime.prepare(docs.sparkSession)
    found = runtime.written(scanned(docs))
    added = runtime.written(learned(found).groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "end", "kind")).alias("added"))).toDF("_id", "_digest", "added")
    both = found.join(runtime.small(added), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    order = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return both.select("doc_id", order(F.col("spans")).alias("base"), order(F.concat("spans", F.coalesce("added", F.array().cast("array<struct<start:int,end:int,kind:int>>")))).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    def number(k: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    found = personal_data(runtime.documents(spark, sf_dir))
    counts = [number(k) for k in range(len(KINDS))]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), F.size("spans").cast("long").alias("n_found"))

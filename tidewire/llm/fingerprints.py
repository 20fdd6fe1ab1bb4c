"""Canonical exact fingerprints of documents, by DataFrame functions only.

The canonical text is NFKC, full case folding, NFKC again, white space runs to one blank, no blank at
the ends. The fingerprint is two independent lanes of xxhash64 over it (128 bits, hex), computed once for each
text and each edited text. Texts whose hashes meet, edited ones too, are compared byte by byte: within a
bucket that holds different canonical texts, the second and later ones (in order) get a numbered suffix.
That comparison reads every text of a bucket of two or more again, and pre-aggregates text before it is
shuffled, so a bucket may hold any share of the rows.

Likeness is what an exact digest can tell: 1 for equal fingerprints, else 0.

Defined results: null text counts as empty; rows of one doc_id are ordered by a hash of their text, then the
text; a null doc_id comes first; repeated rows stay; a lone row is its own next document; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import runtime

#: Rows of a range of doc_id on average, and ranges at most.
RANGE_ROWS, RANGES = 2000, 20_000
_COARSE = 64


def canonical(text: Column) -> Column:
    def icu(kind: str, method: str, x: Column) -> Column:
        return F.reflect(F.lit(f"com.ibm.icu.{kind}"), F.lit(method), x, F.lit(True))

    def nfkc(x: Column) -> Column:
        return icu("text.Normalizer", "compose", x)

    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(nfkc(icu("lang.UCharacter", "foldCase", nfkc(text))))
    return F.regexp_replace(F.regexp_replace(folded, "(?U)\\s+", " "), "^ | $", "")


def lanes(canon: Column) -> list[Column]:
    """Two lanes with their own seeds."""
    return [F.xxhash64(F.lit(lane), canon) for lane in (11, 23)]


def digest(h1: Column, h2: Column, variant: Column) -> Column:
    def wide(h: Column) -> Column:
        return F.lpad(F.lower(F.hex(h)), 16, "0")

    return F.concat(wide(h1), wide(h2), F.when(F.coalesce(variant, F.lit(0)) > 0, F.concat(F.lit("-"), variant.cast("string"))).otherwise(F.lit("")))


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds canon, h1 and h2."""
    with_canon = docs.withColumn("canon", canonical(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return with_canon.withColumns(dict(zip(("h1", "h2"), lanes(F.col("canon")), strict=True)))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds next_<column>: its value in the next row by (doc_id, raw, text), after the last the first. docs has
    doc_id, raw (a hash of text) and text. Rows go by ranges of doc_id, each with a copy of the row that
    follows it; a doc_id with many rows has ranges of its own, by raw."""
    keyed = docs.withColumn("k", F.coalesce("doc_id", F.lit(-(1 << 63))))
    ids = keyed.select("k", "raw")
    rows = ids.count()
    if not rows:
        return docs.select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns])
    ranges = max(1, min(RANGES, rows // RANGE_ROWS))
    coarse = min(_COARSE, ranges)
    cuts = {int(x) for x in ids.approxQuantile("k", [i / coarse for i in range(1, coarse)], 0.2 / coarse)} if coarse > 1 else set()
    low, high = ids.agg(F.min("k"), F.max("k")).first()
    often = {r.k: r["count"] for r in ids.groupBy("k").count().filter(F.col("count") > max(RANGE_ROWS, rows // (16 * _COARSE))).collect()}  # so many at most
    top = (1 << 63) - 1
    edges = sorted({low, min(high + 1, top), *(c for c in cuts if low < c <= high), *often, *(k + 1 for k in often if k < high)})
    edges = edges if len(edges) > 1 else [low, low]
    fine = [-(-often[e] // RANGE_ROWS) if e in often else -(-ranges // coarse) for e in edges[:-1]]
    first = [sum(fine[:i]) for i in range(len(fine))]
    at = F.greatest(F.lit(1), F.least(F.lit(len(edges) - 1), F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in edges]), lambda e: e <= F.col("k")))))
    starts, ends = (F.array(*[F.lit(float(e)) for e in x]) for x in (edges[:-1], edges[1:]))
    among = F.element_at(F.array(*[F.lit(e in often) for e in edges[:-1]]), at)
    width, base = (F.element_at(F.array(*[F.lit(x) for x in xs]), at) for xs in (fine, first))
    share = (F.col("k").cast("double") - F.element_at(starts, at)) / F.greatest(F.lit(1.0), F.element_at(ends, at) - F.element_at(starts, at))
    share = F.when(among, F.col("raw").cast("double") / 2.0**64 + 0.5).otherwise(share)
    bucket = (base + F.least(width - 1, F.floor(share * width))).cast("int")
    least = ids.withColumn("b", bucket).groupBy("b").agg(F.min(F.struct("k", "raw")).alias("first")).collect()  # a row for each range
    firsts = sorted((r.b, r.first.k, r.first.raw) for r in least)
    follow = docs.sparkSession.createDataFrame([(*firsts[(i + 1) % len(firsts)][1:], b) for i, (b, *_) in enumerate(firsts)], "k long, raw long, before int")
    follow = follow.groupBy("k", "raw").agg(F.collect_list("before").alias("before"))
    ranged = keyed.withColumn("b", bucket).join(F.broadcast(follow), ["k", "raw"], "left")
    own = F.array(F.struct(F.col("b").alias("b"), F.lit(0).alias("copy")))
    also = F.transform("before", lambda b: F.struct(b.alias("b"), F.lit(1).alias("copy")))
    spread = ranged.withColumn("to", F.explode(F.when(F.col("before").isNull(), own).otherwise(F.concat(own, also))))
    order = W.partitionBy("to.b").orderBy("to.copy", "k", "raw", "text")
    led = spread.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return led.filter("to.copy = 0").drop("k", "b", "before", "to")


def edited_text() -> Column:
    half = F.floor(F.char_length("text") / 2).cast("int")
    return F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half))


def _variants(base: DataFrame, prints: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The variants of texts (doc_id, raw, v) and edited texts (doc_id, raw, next_id, next_raw, v) in buckets that hold
    different canonical texts; None if there is no such bucket. prints is a written table."""
    both = prints.select("h1", "h2").unionAll(prints.select(F.col("e1").alias("h1"), F.col("e2").alias("h2")))
    shared = runtime.written(both.groupBy("h1", "h2").count().filter("count > 1").drop("count"))
    if runtime.is_empty(shared):
        return None
    keys = runtime.small(shared)
    own = runtime.written(prints.join(keys, ["h1", "h2"], "left_semi").select("doc_id", "raw").distinct())
    edits = runtime.written(prints.join(keys, (F.col("e1") == shared["h1"]) & (F.col("e2") == shared["h2"]), "left_semi").select("doc_id", "raw", "next_id", "next_raw").distinct())
    wanted = runtime.written(own.union(edits.select("doc_id", "raw")).union(edits.select("next_id", "next_raw")).distinct().toDF("of", "of_raw"))
    known = base.join(runtime.small(wanted), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("raw") == F.col("of_raw")), "left_semi").dropDuplicates(["doc_id", "raw"])
    known = runtime.written(known.select("doc_id", "raw", "text"))
    following = known.select(F.col("doc_id").alias("next_of"), F.col("raw").alias("next_of_raw"), F.col("text").alias("next_text"))
    of = edits.withColumnsRenamed({"doc_id": "of", "raw": "of_raw"})
    changed = known.join(of, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("raw") == F.col("of_raw"))).join(following, F.col("next_id").eqNullSafe(F.col("next_of")) & (F.col("next_raw") == F.col("next_of_raw")))
    texts = hashed(known.join(own.toDF("of", "of_raw"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("raw") == F.col("of_raw")), "left_semi"))
    edited = hashed(changed.select("doc_id", "raw", "next_id", "next_raw", edited_text().alias("text")))
    compared = texts.select("h1", "h2", "canon").unionAll(edited.select("h1", "h2", "canon")).groupBy("h1", "h2", "canon").agg(F.lit(1).alias("one")).drop("one")
    clashes = runtime.written(compared.groupBy("h1", "h2").count().filter("count > 1").drop("count"))
    if runtime.is_empty(clashes):
        return None
    at = W.partitionBy("h1", "h2").orderBy("canon")
    numbered = runtime.written(compared.join(runtime.small(clashes), ["h1", "h2"], "left_semi").withColumn("v", F.row_number().over(at) - 1))
    return tuple(runtime.written(x.join(numbered, ["h1", "h2", "canon"]).select(*names, "v")) for x, names in ((texts, ["doc_id", "raw"]), (edited, ["doc_id", "raw", "next_id", "next_raw"])))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("raw", F.xxhash64("text"))
    led = with_next(hashed(base).drop("canon"), ["doc_id", "raw", "text", "h1", "h2"]).withColumnRenamed("next_doc_id", "next_id")
    led = led.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", edited_text()).withColumnsRenamed({"h1": "own1", "h2": "own2"}).drop("text", "next_text")
    prints = hashed(led, "edited").withColumn("edited_sha256", F.sha2("edited", 256)).drop("canon", "edited")
    prints = runtime.written(prints.withColumnsRenamed({"h1": "e1", "h2": "e2"}).withColumnsRenamed({"own1": "h1", "own2": "h2"}))
    found = _variants(base, prints)
    if found is None:
        rows = prints.withColumns({c: F.lit(0) for c in ("v", "v_edited", "v_next")})
    else:
        texts, edits = found
        rows = prints
        for name, table, pairs in (
            ("v", texts, [("doc_id", "doc_id"), ("raw", "raw")]), ("v_next", texts, [("next_id", "doc_id"), ("next_raw", "raw")]),
            ("v_edited", edits, [(c, c) for c in ("doc_id", "raw", "next_id", "next_raw")]),
        ):
            other = table.withColumnsRenamed({c: f"of_{c}" for c in table.columns})
            same = [F.col(a).eqNullSafe(F.col(f"of_{b}")) for a, b in pairs]
            rows = rows.join(other, same, "left").withColumn(name, F.col("of_v")).drop(*other.columns)
    rows = rows.withColumn("fingerprint", digest(F.col("h1"), F.col("h2"), F.col("v"))).withColumn("edited_fingerprint", digest(F.col("e1"), F.col("e2"), F.col("v_edited"))).withColumn("next_fingerprint", digest(F.col("next_h1"), F.col("next_h2"), F.col("v_next")))

    def like(a: str, b: str) -> Column:
        return F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.lit(0.0))

    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        like("fingerprint", "edited_fingerprint").alias("near_edited"), like("fingerprint", "next_fingerprint").alias("near_next"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprints(runtime.documents(spark, sf_dir))

"""Ranked lexical search: the documents that match an item's terms best, by whole-number scores.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII, with A-Z folded. The
postings of the terms that items ask for are a DataFrame bucketed by term: a term's postings lie together,
sorted, and one that many documents hold is dealt over several buckets by its count. The items' terms are
joined, every match scored in whole numbers, scores are summed by item and document, and a window's
row_number gives each item's best.

A posting matches many items, so postings change hands by blocks of documents before matches are formed:
sums need no second shuffle, and a task hands on at most k rows an item. Terms that no item asks for only
count towards lengths; they are left out where texts are read (a semi join below the shuffle). Asked terms
are looked up in workers while their table is small, and by a shuffled join beyond that.

Defined results: null text has no terms; documents without a term don't count; rows that share a doc_id are
documents of their own; a null doc_id comes last among equal scores; items that share an item_id (null is
one) are one item; terms that no document holds, or all do, score nothing; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import runtime, textscan

#: Rows of one term in one bucket; documents of a block; postings of a bucket's task; matches of a block's task.
TERM_ROWS, BLOCK_DOCS, BUCKET_ROWS, TASK_MATCHES = 10_000, 500, 1_000_000, 5_000_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_COUNTED = "row long, doc_id long, n int, tid long, tf int"


def terms_of(text: Column | str) -> Column:
    """All terms of a text in order, with repeats; none for null."""
    text = F.coalesce(F.col(text).cast("string") if isinstance(text, str) else text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(text, upper, upper.lower()), F.lit(TERM), F.lit(0))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: each term of an item once."""
    return items.select("item_id", F.explode(terms_of("text")).alias("term")).distinct()


def _found(raw: np.ndarray, s: np.ndarray, e: np.ndarray, hashes: np.ndarray, known: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(which words are known terms, their place in known): by hash, then byte by byte."""
    names, at_bytes, data = known
    at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
    hit = np.flatnonzero((names[at] == hashes) & (np.diff(at_bytes)[at] == e - s))
    at = at[hit]
    same, length = np.zeros(len(hit), bool), (e - s)[hit]
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        for i in range(0, len(rows), max(1, (1 << 20) // n)):
            some = rows[i : i + max(1, (1 << 20) // n)]
            said = raw[s[hit[some]][:, None] + np.arange(n)]
            said = np.where((said >= 65) & (said <= 90), said | 32, said)
            same[some] = (said == data[at_bytes[at[some]][:, None] + np.arange(n)]).all(1)
    return hit[same], at[same]


def _looked_up(docs: DataFrame, asked: DataFrame) -> DataFrame | None:
    """_COUNTED by workers that hold asked; None if two of its terms share a hash."""
    rows = asked.toArrow()
    column = rows.column("term").combine_chunks()
    hashes, bounds = textscan.word_parts(column, True, (), True)
    if not len(column) or len(hashes[0]) != len(column) or len(np.unique(hashes[0])) != len(column):
        return None
    order = np.argsort(hashes[0])
    data, edges = textscan.text_bytes(column.take(pa.array(order)))
    held = docs.sparkSession.sparkContext.broadcast((np.ascontiguousarray(hashes[0][order]), edges, data, rows.column("tid").to_numpy()[order]))

    def count(batches):
        *known, tids = held.value
        for batch in batches:
            raw, offsets = textscan.text_bytes(batch.column(2))
            n, keys = np.zeros(len(batch), np.int64), []
            for (h,), s, e in textscan.word_slices(raw, offsets, True, (), True):
                owner = np.searchsorted(offsets, s, "right") - 1
                n += np.bincount(owner, minlength=len(batch))
                hit, at = _found(raw, s, e, h, known)
                keys.append(owner[hit] * len(tids) + at)
            pairs, tf = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_counts=True)
            owner = np.concatenate([np.arange(len(batch)), pairs // len(tids)])
            tid, tf = np.concatenate([np.full(len(batch), -1), tids[pairs % len(tids)]]), np.concatenate([np.zeros(len(batch), np.int64), tf])
            for i in range(0, len(owner), 100_000):
                of = pa.array(owner[i : i + 100_000])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(n.astype(np.int32)).take(of), pa.array(tid[i : i + 100_000]), pa.array(tf[i : i + 100_000].astype(np.int32))], names=["row", "doc_id", "n", "tid", "tf"])

    return docs.mapInArrow(runtime.frugal(count), _COUNTED)


def _joined(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """_COUNTED by a join of every document's terms, for any number of asked terms."""
    split = docs.select("row", "doc_id", terms_of("text").alias("terms"))
    each = split.select("row", "doc_id", F.size("terms").alias("n"), F.explode(F.array_append("terms", F.lit(""))).alias("term"))  # "" is no term: the row of the length
    counted = each.groupBy("row", "doc_id", "n", "term").agg(F.count("*").cast("int").alias("tf"))
    named = counted.filter("term <> ''").join(asked, "term").select("row", "doc_id", "n", "tid", "tf")
    return named.unionByName(counted.filter("term = ''").select("row", "doc_id", "n", F.lit(-1).cast("long").alias("tid"), F.lit(0).alias("tf")))


def counted(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """row, doc_id, n (the document's terms), tid, tf for each document and asked term (term, tid) it holds, and a row of
    tid -1 for each document. Written: rows have no other name."""
    runtime.prepare(docs.sparkSession, 500)
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fits = runtime.rows_of(asked) <= runtime.BROADCAST_ROWS and runtime.bytes_of(asked) <= runtime.BROADCAST_BYTES
    found = _looked_up(given, asked) if fits else None
    return runtime.written(_joined(runtime.written(given), asked) if found is None else found)


def postings(occurrences: DataFrame, held: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """bucket, tid, row, doc_id, impact: the postings bucketed by term, each bucket sorted. impact is the match's part of
    a score before its term's weight. held (tid, df) says over how many buckets a term is dealt."""
    m = 50 + F.expr(f"(50L * n * {n_docs}L) div {n_terms}L")
    impact = F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)").cast("int")
    rows = occurrences.filter("tid >= 0").withColumn("m", m).join(runtime.small(held), "tid")
    deal = F.pmod(F.xxhash64("row"), F.ceil(F.col("df") / TERM_ROWS))
    spark, wanted = occurrences.sparkSession, -(-runtime.rows_of(occurrences) // BUCKET_ROWS)
    buckets = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select(F.pmod(F.xxhash64("tid", deal), F.lit(16 * buckets)).cast("int").alias("bucket"), "tid", "row", "doc_id", impact.alias("impact"))
    return runtime.written(dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "tid", "row"))


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], items.select("item_id").schema).selectExpr("item_id", "cast(null as int) rank", "cast(null as long) doc_id", "cast(null as long) score")
    pairs = runtime.written(item_terms(items.select("item_id", "text")))
    asked = runtime.written(pairs.select("term").distinct().select("term", F.monotonically_increasing_id().alias("tid")))
    if runtime.is_empty(asked):
        return empty
    occurrences = counted(docs, asked)
    held = runtime.written(occurrences.groupBy("tid").agg(F.count("*").alias("df"), F.count_if(F.col("n") > 0).alias("docs"), F.sum(F.col("n").cast("long")).alias("terms")))
    whole = held.filter("tid = -1").first()
    if whole is None or not whole.terms:
        return empty
    held = runtime.written(held.filter("tid >= 0").select("tid", "df"))
    buckets = postings(occurrences, held, whole.docs, whole.terms)
    weight = F.floor(1000 * F.log(F.lit(2.0 * whole.docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weights = runtime.written(pairs.join(runtime.small(asked), "term").join(runtime.small(held), "tid").select("tid", "item_id", "df", weight.alias("w")).filter("w > 0"))
    matches = weights.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    blocks, tasks = -(-whole.docs // BLOCK_DOCS), max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-matches // TASK_MATCHES))
    placed = buckets.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "row", "doc_id", "tid", "impact").repartition(tasks, "block")
    each = placed.join(runtime.small(weights).select("tid", "item_id", "w"), "tid")
    scored = each.groupBy("block", "item_id", "row", "doc_id").agg(F.sum(F.col("w") * F.col("impact")).alias("score")).filter("score > 0")
    best = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(runtime.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = f"""
with d as (select doc_id, {_TERMS} ts from documents), s as (select count(*) filter (len(ts) > 0) n, sum(len(ts))::bigint l from d),
c as (select doc_id, len(ts) n, unnest(ts) term from d), p as (select doc_id, n, term, count(*) tf from c group by all),
h as (select term, count(*) df from p group by 1), i as (select distinct item_id, unnest({_TERMS}) term from benchmark),
w as (select item_id, term, cast(floor(1000 * ln((2.0::double * s.n + 2) / (2.0::double * df + 1))) as bigint) w from i join h using (term), s),
m as (select item_id, doc_id, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * p.n * s.n) // s.l))) score from p join w using (term), s),
t as (select item_id, doc_id, cast(sum(score) as bigint) score from m group by 1, 2 having sum(score) > 0),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) rank from t)
select item_id, cast(rank as integer) rank, doc_id, score from r where rank <= 50
"""

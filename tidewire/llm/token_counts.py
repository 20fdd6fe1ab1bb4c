"""Token counts of whole texts by a two-tier lookup, without shuffling pre-tokens.

A byte-level BPE is a function of each pre-token, so a text's count is the sum over its pre-tokens.
First every task counts the pre-tokens of its texts and hands on its frequent ones; their totals
choose a table of fixed size whose token counts are broadcast. Then each text is split where it lies:
frequent pre-tokens are looked up in the table, others in the worker's cache, and only what neither
holds is encoded. The table decides speed, never results.

Defined results: null counts as empty (0 tokens); repeated rows stay; an empty table gives no rows;
extra columns are ignored. A text with characters whose class the splitter and the library may see
differently, or with the opening of a special string, is encoded whole by the library.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime, tokens

#: Pre-tokens a task hands on, and the table's size.
TASK_FREQUENT, TABLE = 20_000, 50_000
#: Entries at which a task's counter drops its rare half, and a worker's cache starts anew.
COUNTER_ENTRIES, CACHE_ENTRIES = 400_000, 400_000

#: The vocabulary's public splitting pattern, for characters tokens._ODD lets through, without U+001C-1F and the superscript and vulgar-fraction digits, which Python's classes see otherwise.
_SPLIT = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:_|[^\s\w])+|\s+(?!\S)|\s+")
_OTHER = re.compile("[²³¹¼-¾]")
_caches: dict[str, dict] = {}


def _plain(text: str) -> bool:
    return not tokens._ODD.search(text) and (text.isascii() or not _OTHER.search(text))


def frequent_pretokens(docs: DataFrame, table: int = TABLE) -> DataFrame:
    """piece, n: the most frequent pre-tokens, at most `table` rows."""
    runtime.prepare(docs.sparkSession)

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                if (x := text.as_py()) and _plain(x):
                    seen.update(_SPLIT.findall(x))
                    if len(seen) > COUNTER_ENTRIES:
                        seen = Counter(dict(seen.most_common(COUNTER_ENTRIES // 2)))
        top = seen.most_common(TASK_FREQUENT)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(runtime.frugal(count), "piece string, n long")
    return counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(table)


def token_counts(docs: DataFrame, limit: int = 1024, table: int = TABLE, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text."""
    spark = docs.sparkSession
    frequent = [r.piece for r in frequent_pretokens(docs, table).select("piece").collect()]
    encode = tokens.encoder(vocabulary, None)
    held = spark.sparkContext.broadcast(dict(zip(frequent, map(encode.count, frequent), strict=True)))

    def look_up(batches):
        encode, known = tokens.encoder(vocabulary, None), held.value
        cache = _caches.setdefault(vocabulary, {})

        class Misses(dict):
            def __missing__(self, piece: str) -> int:
                n = cache.get(piece)
                if n is None:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    n = cache[piece] = encode.count(piece)
                return n

        lookup = Misses(known)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [(sum(map(lookup.__getitem__, _SPLIT.findall(x))) if _plain(x) else encode.count(x)) if x else 0 for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(runtime.frugal(look_up), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(runtime.documents(spark, sf_dir))

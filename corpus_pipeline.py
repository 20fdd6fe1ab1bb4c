"""A corpus from raw documents in five stages, each by one operator of tidewire.llm.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's docs. All but the last return the columns of
documents. run() applies them to the table.

1. toxicity: documents that the classifier rejects (score at or above the threshold of their language) go.
2. line dedup: lines that repeat, up to two edits from 40 code points on, stay once; documents of which
   nothing is left but blanks go, unless nothing was there before.
3. near dedup: of each class of near copies the document with the least doc_id stays (the least text
   among rows that share it).
4. mixing: each source's documents are repeated or left out so that its words come near its target. A
   document's rows are its taken words over its size; the fraction is rounded up with that probability
   by a hash of the document. Documents without words can't be taken.
5. packing: the mix's tokens in sequences of 2048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import line_dedup, mixing, near_dedup, packing, runtime, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = docs.select(*COLUMNS)
    return toxicity.score(docs, toxicity.fit(docs, labels)).filter(~F.col("toxic")).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.deduplicated(docs.select(*COLUMNS), exact_chars=1)
    return left.filter((F.size("lines_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return near_dedup.deduplicated(docs).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return mixing.repeated(docs).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier, the edit join and the packing aren't expressible in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runtime.documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = runtime.written(docs)
    return docs

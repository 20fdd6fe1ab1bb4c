"""Which words of a table occur in texts: for vocabularies too large for one test a word and row.

A table within the checked bounds goes to workers as an automaton (Aho-Corasick), which reads each text once
whatever the number of words. Beyond them, or where that library is missing, words and texts meet in a join:
each word has an anchor, the gram of it that fewest words share, texts give their distinct grams, and what
meets is tested by containment. Both give the same hits.
"""

from __future__ import annotations

import importlib.util

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..tables import BROADCAST_BYTES, BROADCAST_ROWS, bytes_of, rows_of, small, written

#: Characters of a gram; of shorter words, all.
GRAM = 3
_HITS = "array<struct<place:bigint,word:string>>"
_built: dict = {}


def _automaton(held):
    """The automaton of a broadcast table, built once a worker."""
    if held.id not in _built:
        import ahocorasick

        found = ahocorasick.Automaton()
        for word, place in held.value:
            found.add_word(word, (place, word))
        found.make_automaton()
        _built.clear()
        _built[held.id] = found
    return _built[held.id]


class _Held:
    """A broadcast value with a name by which workers keep what they built of it."""

    def __init__(self, broadcast, name: str):
        self.broadcast, self.id = broadcast, name

    @property
    def value(self):
        return self.broadcast.value


def _by_automaton(texts: DataFrame, words: DataFrame) -> DataFrame:
    rows = words.toArrow().to_pylist()  # within the bounds of a broadcast
    held = _Held(texts.sparkSession.sparkContext.broadcast([(r["word"], r["place"]) for r in rows]), words._path)

    def find(batches):
        automaton = _automaton(held) if held.value else None  # an automaton of no words can't be asked
        for batch in batches:
            found = [sorted({value for _, value in automaton.iter(text)}) if text and automaton else [] for text in batch.column(1).to_pylist()]
            hits = pa.array([[{"place": p, "word": w} for p, w in each] for each in found], pa.list_(pa.struct([("place", pa.int64()), ("word", pa.string())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), hits], names=["id", "hits"])

    return texts.mapInArrow(find, f"id long, hits {_HITS}")


def _grams(text: Column, size: Column | int) -> Column:
    """All runs of so many characters, in one pass over the text."""
    return F.regexp_extract_all(text, F.concat(F.lit("(?s)(?=(.{"), F.lit(size).cast("string") if isinstance(size, int) else size.cast("string"), F.lit("}))")), F.lit(1))


def _by_grams(texts: DataFrame, words: DataFrame) -> DataFrame:
    size = F.least(F.char_length("word"), F.lit(GRAM))
    each = words.select("word", "place", F.explode(F.array_distinct(_grams(F.col("word"), size))).alias("gram"))
    shared = each.groupBy("gram").agg(F.count("*").alias("n"))
    anchors = written(each.join(shared, "gram").groupBy("word", "place").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram")))
    sizes = [r.n for r in anchors.select(F.char_length("gram").alias("n")).distinct().collect()]  # GRAM at most
    grams = F.array_distinct(F.flatten(F.array(*[_grams(F.col("text"), n) for n in sizes]))) if sizes else F.array().cast("array<string>")
    met = texts.select("id", F.explode(grams).alias("gram")).join(small(anchors), "gram").select("id", F.struct("place", "word").alias("hit"))
    tried = met.groupBy("id").agg(F.collect_list("hit").alias("tried"))
    both = texts.join(tried, "id", "left")
    hits = F.array_sort(F.filter(F.coalesce("tried", F.array().cast(_HITS)), lambda h: F.contains("text", h["word"])))
    return both.select("id", hits.alias("hits"))


def table_hits(rows: DataFrame, text: Column | str, words: DataFrame, name: str = "hits", automaton: bool | None = None) -> DataFrame:
    """rows with the words (word, place) that occur in the text, as an array of (place, word) by place; null text has none. Empty
    words are none; of a repeated word the least place counts. automaton: None decides by the table's size."""
    known = written(words.filter(tx.text("word") != "").groupBy("word").agg(F.min("place").cast("long").alias("place")))
    if automaton is None:
        automaton = rows_of(known) <= BROADCAST_ROWS and bytes_of(known) <= BROADCAST_BYTES and importlib.util.find_spec("ahocorasick") is not None
    held = written(rows.withColumns({"_id": F.monotonically_increasing_id(), "_text": tx.text(text)}))
    found = (_by_automaton if automaton else _by_grams)(held.select(F.col("_id").alias("id"), F.col("_text").alias("text")), known)
    return held.drop("_text").join(found.select(F.col("id").alias("_id"), F.col("hits").alias(name)), "_id").drop("_id")


def company_by_table(rows: DataFrame, current: Column | str, title: Column | str, aliases: DataFrame, name: str = "company_id") -> DataFrame:
    """digest.infer_company with aliases (alias, company_id, place) as a table of any size: a valid id stays, else the first alias that
    is it, holds it or lies in it, else the first alias in the title, else other."""
    given = tx.strip(current)
    held = written(rows.withColumns({"_given": given, "_low": F.lower(given), "_title": F.lower(tx.text(title))}))
    ids = written(aliases.select(F.col("company_id").alias("_given")).distinct().withColumn("_valid", F.lit(True)))
    asked = F.when((F.col("_given") != "") & (F.col("_given") != "other"), F.col("_low"))
    lows = written(held.select(asked.alias("low")).filter("low is not null").distinct())
    words = aliases.select(F.col("alias").alias("word"), "place")
    same = lows.join(aliases.select(F.col("alias").alias("low"), F.col("place").alias("same")), "low", "left").groupBy("low").agg(F.min("same").alias("same"))
    within = table_hits(lows, "low", words).select("low", F.try_element_at("hits", F.lit(1))["place"].alias("within"))
    # aliases that a given name lies in: names as words, aliases as texts
    numbered = written(lows.select(F.col("low").alias("word"), F.monotonically_increasing_id().alias("place")))
    around = table_hits(aliases.select("alias", F.col("place").alias("at")), "alias", numbered).select("at", F.explode("hits.word").alias("low")).groupBy("low").agg(F.min("at").alias("around"))
    by_low = written(same.join(within, "low").join(around, "low", "left").select(F.col("low").alias("_low"), F.coalesce("same", F.least("within", "around")).alias("_by_name")))
    titled = table_hits(held, "_title", words, "_hits").withColumn("_by_title", F.try_element_at("_hits", F.lit(1))["place"])
    both = titled.join(small(by_low), "_low", "left").join(small(ids), "_given", "left")
    place = F.coalesce(F.when((F.col("_given") != "") & (F.col("_given") != "other"), F.col("_by_name")), F.col("_by_title"))
    companies = written(aliases.select(F.col("place").alias("_place"), F.col("company_id").alias("_company")))
    chosen = both.withColumn("_place", place).join(small(companies), "_place", "left")
    kept = [c for c in rows.columns if c != name]
    return chosen.select(*kept, F.when(F.coalesce("_valid", F.lit(False)), F.col("_given")).otherwise(F.coalesce("_company", F.lit("other"))).alias(name))

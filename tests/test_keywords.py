"""Hits of word tables by automaton and by join, against containment; companies by an alias table."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators import digest, keywords


def _words(r: random.Random, n: int) -> list[str]:
    return sorted({"".join(r.choice("abcdeé日") for _ in range(r.choice((1, 2, 3, 5, 9)))) for _ in range(n)} | {"a.b", "(", "\\d"})


@pytest.mark.parametrize("automaton", [True, False])
def test_table_hits(spark, automaton):
    r = random.Random(5)
    words = _words(r, 300)
    texts = ["".join(r.choice("abcdeé日 .(\n") for _ in range(r.choice((0, 3, 40, 400)))) for _ in range(60)] + [None, "", "a.b", "axb", "\\d", "a" * 5000]
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)] + [(words[0], 10_000), ("", 1), (None, 2)], "word string, place long")
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, hits string").drop("hits")
    got = {x.id: [(h.place, h.word) for h in x.hits] for x in keywords.table_hits(rows, "text", table, automaton=automaton).collect()}
    assert got == {i: [(k, w) for k, w in enumerate(words) if w in (t or "")] for i, t in enumerate(texts)}
    assert all(not x.hits for x in keywords.table_hits(rows, "text", table.limit(0), automaton=automaton).collect())
    assert keywords.table_hits(rows.limit(0), "text", table, automaton=automaton).collect() == []


def test_twenty_thousand_words(spark):
    """As many as the plan with one test a word can't hold; the bound on the automaton's table is checked."""
    words = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string"), F.lit("z")).alias("word"), F.col("id").alias("place"))
    rows = spark.range(300).select("id", F.concat_ws(" ", *[F.concat(F.lit("k"), (F.col("id") * m % 25_000).cast("string"), F.lit("z")) for m in (1, 77, 83)]).alias("text"))
    got = {x.id: [h.place for h in x.hits] for x in keywords.table_hits(rows, "text", words).collect()}
    assert got == {i: sorted({i * m % 25_000 for m in (1, 77, 83)} - set(range(20_000, 25_000))) for i in range(300)}


def test_bounds_choose_the_way(spark, monkeypatch):
    used = []
    for way in ("_by_automaton", "_by_grams"):
        monkeypatch.setattr(keywords, way, lambda *a, way=way, f=getattr(keywords, way): used.append(way) or f(*a))
    rows, words = spark.createDataFrame([(1, "xabx")], "id long, text string"), spark.createDataFrame([("ab", 0), ("q", 1)], "word string, place long")
    for most in (2, 1):
        monkeypatch.setattr(keywords, "BROADCAST_ROWS", most)
        assert [h.word for h in keywords.table_hits(rows, "text", words).first().hits] == ["ab"]
    assert used == ["_by_automaton", "_by_grams"]


def test_company_by_table_is_company_by_list(spark):
    companies = spark.createDataFrame([("waymo", "Waymo", ["wm one", "alphabet car"], 0), ("pony", "Pony.ai", ["pony"], 1), ("zoox", "Zoox", None, 2)], "id string, name string, aliases array<string>, ord int")
    aliases = digest.company_aliases(companies)
    listed = [(x.alias, x.company_id) for x in aliases.orderBy("place").collect()]
    values = ["waymo", "Waymo", " WAYMO ", "pony.ai inc", "lphabet", "other", "", None, "unknown", "zo"]
    titles = ["Waymo and Pony", "alphabet cars", "PONY goes", "nothing", "", None]
    rows = spark.createDataFrame([(v, t) for v in values for t in titles] * 2, "current string, title string")
    want = rows.withColumn("company_id", digest.infer_company("current", "title", listed)).collect()
    got = keywords.company_by_table(rows, "current", "title", aliases).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len({x.company_id for x in got}) == 4

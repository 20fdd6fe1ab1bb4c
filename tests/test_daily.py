"""Drops before candidates in one pass, against the steps themselves."""

import random
from collections import Counter

from pyspark.sql import functions as F

from tidewire import vocabulary as V
from tidewire.operators import dedup, relevance
from tidewire.plans import daily

SCHEMA = "source_type string, title string, link string, published_at_utc string, fingerprint string, seq long"


def _rows(r: random.Random, n: int) -> list[tuple]:
    kinds = ["rss", "query_rss", "search_result", "structured_web", "browser_structured", "odd", None]
    return [(r.choice(kinds), r.choice(["", "One (x)", "one", "Two", "three", f"t{i}"]), r.choice(["", "hot", "hot", f"l{r.randrange(n // 3)}"]), r.choice([None, "2024-01-01", "2024-01-02"]), f"f{r.randrange(n // 4)}", i) for i in range(n)]


def test_drops_in_one_pass(spark, tmp_path):
    r = random.Random(9)
    spark.createDataFrame(_rows(r, 400), SCHEMA).repartition(3).write.parquet(str(tmp_path / "raw"))
    spark.createDataFrame([(f"l{i}", "") for i in range(0, 130, 3)] + [("", f"f{i}") for i in range(0, 100, 7)] + [("", ""), (None, None)], "resolved_url string, fingerprint string").write.parquet(str(tmp_path / "seen"))
    raw, seen = (spark.read.parquet(str(tmp_path / x)) for x in ("raw", "seen"))
    marked = raw.withColumn("usable", F.col("title") != "")
    got = daily.pre_candidate_drops(marked, seen)
    counted = {(x.method, x.reason): x.n for x in got.collect()}
    linked = dedup.dedup_link(raw.filter("title <> ''")).withColumn("k", daily._title_key())
    fresh = dedup.unseen(linked, seen, F.col("source_type").isin(*daily.DISCOVERY))
    steps = [Counter(x[0] for x in s.select(relevance.normalize_method("source_type")).collect()) for s in (raw, raw.filter("title <> ''"), linked, fresh, dedup.dedup_title(fresh, "k"))]
    want = {(m, reason): steps[i][m] - steps[i + 1][m] for i, reason in enumerate(V.PRE_CANDIDATE_REASONS.values()) for m in steps[0] if m and steps[i][m] > steps[i + 1][m]}
    assert counted == want and {k[1] for k in want} == set(V.PRE_CANDIDATE_REASONS.values())
    assert sum(steps[0].values()) - sum(steps[-1].values()) >= sum(want.values())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "published_at_utc" in line for line in plan.splitlines()) == 1  # raw is read once
    assert "Window" not in plan
    assert daily.pre_candidate_drops(marked.limit(0), seen).collect() == []

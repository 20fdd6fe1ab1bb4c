"""Streams with timers end as the batch tables do."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators import state
from tidewire.streaming import keyed


@pytest.fixture
def rocksdb(spark):
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)


def _run(changes, tmp_path):
    """Every change with its batch."""
    to = str(tmp_path / "out")
    query = changes.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).foreachBatch(lambda rows, i: rows.withColumn("batch", F.lit(i)).write.mode("append").parquet(to)).start()
    query.awaitTermination(300)
    assert not query.isActive and query.exception() is None
    return to


def test_seen_history_is_the_batch_table(spark, tmp_path, rocksdb):
    r = random.Random(3)
    start = datetime(2024, 1, 1, 12)
    days = []
    for i, day in enumerate((0, 1, 16, 17, 40)):
        rows = [(r.choice(["", None, *(f"u{k}" for k in range(6))]), r.choice(["", None, *(f"f{k}" for k in range(4))]), start + timedelta(days=day)) for _ in range(12)]
        days.append(rows)
        spark.createDataFrame(rows, "resolved_url string, fingerprint string, published_at timestamp").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        for f in (tmp_path / f"in/{i}").glob("part-*"):
            (tmp_path / "files").mkdir(exist_ok=True)
            f.rename(tmp_path / f"files/{i}.parquet")
    before = spark.createDataFrame([("u1", "f9", "2023-12-25", "2023-12-30"), ("old", "", "2023-12-01", "2023-12-02")], "resolved_url string, fingerprint string, first_seen_date string, last_seen_date string")
    items = spark.readStream.schema("resolved_url string, fingerprint string, published_at timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "files"))
    to = _run(keyed.seen_history(items, before=before), tmp_path)
    got = keyed.table_of(spark.read.parquet(to), "key", "batch").drop("key")
    table = before
    for rows in days:
        day = rows[0][2].date().isoformat()
        table = state.upserted(state.retained(table, day), spark.createDataFrame(rows, "resolved_url string, fingerprint string, published_at timestamp"), day)
    last = days[-1][0][2].date().isoformat()
    want = state.retained(table, last).select(*got.columns)
    text = lambda rows: sorted(tuple(x or "" for x in row) for row in rows.collect())
    assert text(got) == text(want) and len(text(want)) > 3
    assert spark.read.parquet(to).filter("expired").count() > 0


def test_sliding_cache(spark, tmp_path, rocksdb):
    start = datetime(2024, 1, 1)
    uses = [[("a", "A", 0), ("b", "B", 0)], [("a", None, 5), ("c", "C", 5)], [("d", "D", 8)], [("a", None, 11), ("e", "E", 11)], [("z", "Z", 13), ("b", None, 13), ("q", None, 13)]]
    (tmp_path / "files").mkdir()
    for i, rows in enumerate(uses):
        spark.createDataFrame([(f, e, start + timedelta(days=d)) for f, e, d in rows], "fingerprint string, entry string, updated_at timestamp").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        next((tmp_path / f"in/{i}").glob("part-*")).rename(tmp_path / f"files/{i}.parquet")
    stream = spark.readStream.schema("fingerprint string, entry string, updated_at timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "files"))
    to = _run(keyed.sliding_cache(stream), tmp_path)
    got = {(x.fingerprint, x.entry, x.updated_at) for x in keyed.table_of(spark.read.parquet(to), "fingerprint", "batch").collect()}
    at = lambda d: start + timedelta(days=d)
    # b and c weren't used for 7 days; a was, by hits alone
    assert got == {("a", "A", at(11)), ("d", "D", at(8)), ("e", "E", at(11)), ("z", "Z", at(13))}

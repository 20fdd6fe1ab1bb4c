"""Connected classes of items whose buckets make them candidates and whose payloads decide.

Items that share a bucket are candidates. A bucket of two gives its pair. A larger one is first tied to
a leader, the member that shares most with others in all large buckets. Where the links so far leave a
bucket in one class, no other pair of it can matter. Buckets still mixed are settled exactly:

- With features (an item is a multiset of them, alike items overlap in a share of their sizes), those that
  few items of the mixed buckets hold give their pairs outright. A pair without such a feature overlaps
  in frequent ones alone, so an item's frequent weight bounds the size of any partner. Pairs within
  both bounds are tried; those beyond either can't be alike.
- With vectors (alike items' vectors differ by so much in sum at most), pairs nearer than that are tried.

A pair is tried in one bucket, the least that both share. So classes are those that all candidate pairs
would give, while a bucket of copies of one text costs a row an item. No window or list holds a bucket.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime

#: Items that hold a feature at most for it to be rare.
RARE = 8
#: Pairs that are compared with one copy of their leader's payload.
BLOCK_PAIRS = 64


def min_labels(links: DataFrame) -> DataFrame:
    """id, label: the least id of each connected component, for the ids in links (a, b)."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")), F.struct(F.col("a").alias("u"), F.col("a").alias("v")), F.struct(F.col("b").alias("u"), F.col("b").alias("v")))).alias("e"))
    edges = runtime.written(ends.select("e.u", "e.v").distinct())
    labels = runtime.written(edges.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "id"))
    while True:
        known = runtime.small(labels)
        at_u, at_v = known.select(F.col("id").alias("u"), F.col("label").alias("label_u")), known.select(F.col("id").alias("v"), F.col("label").alias("label_v"))
        both = edges.join(at_u, "u").join(at_v, "v")
        if runtime.is_empty(both.filter("label_u <> label_v")):
            return labels
        low = runtime.written(edges.join(at_u, "u").groupBy("v").agg(F.min("label_u").alias("label")).withColumnRenamed("v", "id"))
        far = runtime.small(low).select(F.col("id").alias("label"), F.col("label").alias("far"))
        labels = runtime.written(low.join(far, "label").select("id", F.col("far").alias("label")))


def verified(pairs: DataFrame, held: DataFrame, load: Callable, alike: Callable) -> DataFrame:
    """Those of pairs (a, b) whose payloads are alike. held has (id, payload); load(payload array) makes a
    list of values; alike([values], [values]) gives a boolean for each pair. A leader's payload is sent
    once for each block of its pairs."""
    runtime.prepare(pairs.sparkSession, 300)
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK_PAIRS).cast("int").alias("n"))
    leads = blocks.select("a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"), F.col("a").alias("id"), F.lit(0).alias("role"))
    rest = pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("block"), F.col("b").alias("id"), F.lit(1).alias("role"))
    wanted = runtime.written(leads.unionByName(rest))
    rows = held.join(runtime.small(wanted), "id").repartition("a", "block").sortWithinPartitions("a", "block", "role").select("a", "block", "role", "id", "payload")

    def compare(batches):
        at, lead = None, None
        for batch in batches:
            values = load(batch.column(4))
            a, block, role, ids = (batch.column(i).to_pylist() for i in range(4))
            leads, at_rows, start, n = [], [], 0, len(a)
            while start < n:
                key, end = (a[start], block[start]), start + 1
                while end < n and (a[end], block[end]) == key:
                    end += 1
                first = start
                while first < end and role[first] == 0:
                    at, lead = key, values[first]
                    first += 1
                if at == key:
                    at_rows += range(first, end)
                    leads += [lead] * (end - first)
                start = end
            found = [i for i, ok in zip(at_rows, alike(leads, [values[i] for i in at_rows]), strict=True) if ok]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in found], pa.int64()) for x in (a, ids)], names=["a", "b"])

    return rows.mapInArrow(runtime.frugal(compare), "a long, b long")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with more than one class, with their label."""
    named = members.join(runtime.small(labels), "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
    return runtime.written(named.join(runtime.small(runtime.written(mixed)), "key", "left_semi"))


def _across(some: DataFrame, members: DataFrame, fits) -> DataFrame:
    """Pairs (a, b) of different labels from some and members, each in the least bucket they share."""
    lead = some.select(*[F.col(c).alias(f"{c}_a") for c in some.columns])
    apart = (F.col("label_a") != F.col("label")) & fits
    # only pairs that pass the rest are worth the intersection, wherever the optimizer evaluates it
    once = F.when(apart, F.array_min(F.array_intersect("keys_a", "keys")) == F.col("key")).otherwise(F.lit(False))
    pairs = lead.join(members, (F.col("key_a") == F.col("key")) & apart)
    return pairs.filter(once).select(F.least("id_a", "id").alias("a"), F.greatest("id_a", "id").alias("b")).distinct()


def classes(
    buckets: DataFrame, payload: Callable[[DataFrame], DataFrame], load: Callable, alike: Callable,
    features: Callable[[DataFrame], DataFrame] | None = None, share: float = 0.5,
    vectors: Callable[[DataFrame], DataFrame] | None = None, most_apart: int = 0,
) -> DataFrame:
    """id, label: the least id of its class, for the items with links. buckets has key and id, both long;
    payload(ids) gives (id, payload) for a table of ids, load and alike as for verified().
    features(payloads) gives (id, feature, n); a pair can only be alike if it overlaps in
    share * (size + size) or more. vectors(payloads) gives id and whole numbers."""
    counted = runtime.written(buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high"))
    larger = runtime.written(counted.filter("n > 2").select("key", "n"))
    members = runtime.written(buckets.join(runtime.small(larger), "key").groupBy("key", "id").agg(F.min("n").alias("n")))
    by_id = runtime.written(members.groupBy("id").agg(F.sum("n").alias("shared"), F.collect_set("key").alias("keys")))
    weighted = members.join(by_id.select("id", "shared"), "id")
    leaders = runtime.written(weighted.groupBy("key").agg(F.max(F.struct(F.col("shared"), (-F.col("id")).alias("minus"))).alias("best")).select("key", (-F.col("best.minus")).alias("lead")))
    tied = members.join(runtime.small(leaders), "key").filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b"))
    pairs = runtime.written(counted.filter("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b")).union(tied).distinct())
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    held = runtime.written(payload(runtime.written(ids)))
    links = runtime.written(verified(pairs, held, load, alike))
    labels = min_labels(links)
    named = _mixed(members, labels)
    if runtime.is_empty(named):
        return labels

    def more(tried: DataFrame) -> None:
        nonlocal links, labels
        found = runtime.written(verified(runtime.written(tried), held, load, alike))
        if not runtime.is_empty(found):
            links = runtime.written(links.union(found).distinct())
            labels = min_labels(links)

    some = held.join(runtime.small(runtime.written(named.select("id").distinct())), "id", "left_semi")
    keyed, fits = by_id.select("id", "keys"), F.lit(True)
    named = named.select("key", "id")
    if features is not None:
        known = runtime.written(features(some))
        often = runtime.written(known.groupBy("feature").agg(F.count("*").alias("items")).filter(F.col("items") > RARE).select("feature", F.lit(1).alias("often")))
        known = known.join(runtime.small(often), "feature", "left")
        reach = known.groupBy("id").agg(F.sum("n").alias("size"), F.coalesce(F.sum(F.when(F.col("often") == 1, F.col("n"))), F.lit(0)).alias("b"))
        reach = runtime.written(reach.select("id", "size", (F.col("b") / share - F.col("size") + 1e-6).alias("most")))
        rare = runtime.written(known.filter("often is null").select("feature", "id"))
        twice = rare.select("feature", F.col("id").alias("a")).join(rare.select("feature", F.col("id").alias("b")), "feature").filter("a < b").select("a", "b").distinct()
        at = runtime.small(labels)
        apart = twice.join(at.select(F.col("id").alias("a"), F.col("label").alias("x")), "a", "left").join(at.select(F.col("id").alias("b"), F.col("label").alias("y")), "b", "left")
        more(apart.filter(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b"))
        named = runtime.written(named.join(runtime.small(reach), "id"))
        least = runtime.written(named.groupBy("key").agg(F.min("size").alias("least")))
        named = named.join(runtime.small(least), "key").filter("most >= least").select("key", "id", "size", "most")
        fits = (F.col("size") <= F.col("most_a")) & (F.col("size_a") <= F.col("most"))
    if vectors is not None:
        points = runtime.written(vectors(some))
        keyed = keyed.join(points, "id")
        fits = fits & (sum(F.abs(F.col(f"{c}_a") - F.col(c)) for c in points.columns if c != "id") <= most_apart)
    full = runtime.written(_mixed(named, labels).join(keyed, "id"))
    if not runtime.is_empty(full):
        more(_across(full, full, fits))
    return labels

"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by hash and laid end to end; the line of words is cut into blocks
of equal length. Slot i of the schedule has the point frac(i * golden ratio), exact in 64 bits, which
the cumulative shares map to a source. Slots are ranked per source; rank r takes block r mod n of
that source's n blocks, in the pass r div n. A document's taken words are its overlaps with the taken
blocks, so no pass takes a word twice and at most MAX_PASSES passes are made.

Shuffled are one small row a document, one a block that a document touches, and one a slot; never text.
Ranks and offsets are prefix sums in two levels (in chunks or hash buckets, then over their totals), so
no source's rows meet in one task. Sources are a table like any other, of any length.

Defined results: null text has size 0; a null source is a source of its own, last in order; texts
without words take 0; repeated rows are rows of their own; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import runtime

WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
#: Words of a block at most, slots of a source at least (fewer if it has fewer words), slots of a chunk.
BLOCK_WORDS, SOURCE_SLOTS, CHUNK = 4096, 1024, 1 << 16
_GOLDEN = 0x9E3779B97F4A7C15  # 2**64 / golden ratio
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sizes: list[int], weights: list[float], cap: float = MAX_PASSES) -> list[float]:
    """Shares of sum(sizes) by weight, none above cap times its size; excess goes to the others by weight.
    (The rule of source_table, for a list.)"""
    targets, left, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while left:
        total = sum(weights[i] for i in left)
        full = [i for i in left if rest * weights[i] / total > cap * sizes[i]]
        if not full:
            for i in left:
                targets[i] = rest * weights[i] / total
            break
        for i in full:
            targets[i] = float(cap * sizes[i])
        rest -= sum(targets[i] for i in full)
        left -= set(full)
    return targets


def running(rows: DataFrame, value: str, before: str) -> DataFrame:
    """rows, a written table with place (from monotonically_increasing_id(), so ordered within each partition),
    with the sum of value over all rows of lesser place: over partitions' totals, and within each."""
    part = F.shiftright("place", 33)
    totals = rows.groupBy(part.alias("part")).agg(F.sum(value).alias("n"))
    bases = totals.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # a row a partition
    inside = W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    within = rows.withColumn("part", part).withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return within.join(F.broadcast(bases), "part").withColumn(before, F.col("base") + F.col("inside")).drop("part", "base", "inside")


def source_table(sized: DataFrame, weights=WEIGHTS) -> DataFrame:
    """s (number by code point, null last), name, source_size, target, block_words, blocks, slots, first_slots (slots of
    earlier sources): a written table with a row for each source, however many there are."""
    by_name = sized.groupBy(F.col("source").alias("name")).agg(F.sum("size").alias("source_size")).orderBy(F.asc_nulls_last("name"))
    listed = runtime.written(by_name.withColumn("place", F.monotonically_increasing_id()).withColumn("one", F.lit(1)))
    numbered = running(listed, "one", "s").withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") % len(weights) + 1).cast("int")))
    numbered = runtime.written(numbered.select("s", "place", "name", "source_size", "weight"))
    level, most = 0.0, F.lit(float(MAX_PASSES)) * F.col("source_size")
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    while True:  # the words a unit of weight gets; it only rises, as sources reach their caps
        full = F.lit(level) * F.col("weight") > most
        taken, left = numbered.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        after = max(0.0, total - (taken or 0.0)) / left if left else level
        if after <= level * (1 + 1e-12):
            break
        level = after
    target = F.least(most, F.lit(level) * F.col("weight"))
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(target / SOURCE_SLOTS))).cast("long")
    planned = numbered.withColumn("target", target).withColumn("block_words", block)
    planned = planned.withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words"))).withColumn("slots", F.round(F.col("target") / F.col("block_words")).cast("long"))
    return runtime.written(running(runtime.written(planned.drop("weight")), "slots", "first_slots").drop("place"))


def schedule(spark, table: DataFrame) -> DataFrame:
    """slot, s, rank: the source of every slot and the slot's rank among that source's. table has s, slots and
    first_slots. A slot's point is met with the first points of the sources' shares in a range of points, so a
    range's task holds neither all slots nor all sources."""
    total = int(table.agg(F.sum("slots")).first()[0] or 0)
    if not total:
        return spark.createDataFrame([], "slot long, s long, rank long")
    runtime.prepare(spark)
    chunks = -(-total // CHUNK)
    bits = min(20, max(4, chunks.bit_length()))  # of a point, that choose its range

    def points(batches):
        for batch in batches:
            for c in batch.column(0).to_pylist():
                slots = np.arange(c * CHUNK, min(total, (c + 1) * CHUNK), dtype=np.uint64)
                with np.errstate(over="ignore"):
                    point = slots * np.uint64(_GOLDEN)
                yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array((point ^ np.uint64(1 << 63)).view(np.int64))], names=["slot", "point"])

    drawn = spark.range(0, chunks, 1, min(chunks, 1024)).mapInArrow(runtime.frugal(points), "slot long, point long")
    # a share begins at first_slots / total of all points, shifted to signed ones
    whole = F.floor(F.col("first_slots").cast("decimal(18,0)") * F.lit(Decimal(1 << 64)) / F.lit(total).cast("decimal(18,0)"))
    edges = table.filter("slots > 0").select("s", (whole.cast("decimal(20,0)") - F.lit(Decimal(1 << 63))).cast("long").alias("point"))
    zone = F.shiftright(F.col("point"), 64 - bits)
    edges = runtime.written(edges.withColumn("zone", zone))
    last = edges.groupBy("zone").agg(F.max(F.struct("point", "s")).alias("last"))  # a row a range at most
    zones = spark.range(-(1 << (bits - 1)), 1 << (bits - 1)).withColumnRenamed("id", "zone").join(F.broadcast(last), "zone", "left")
    opening = zones.select("zone", F.last("last.s", ignorenulls=True).over(W.orderBy("zone").rowsBetween(W.unboundedPreceding, -1)).alias("opening"))
    marks = edges.select("zone", "point", F.lit(-1).cast("long").alias("slot"), "s").unionByName(drawn.select(zone.alias("zone"), "point", "slot", F.lit(None).cast("long").alias("s")))
    at = W.partitionBy("zone").orderBy("point", "slot").rowsBetween(W.unboundedPreceding, 0)
    met = marks.withColumn("met", F.last("s", ignorenulls=True).over(at)).filter("slot >= 0").join(F.broadcast(opening), "zone")
    found = runtime.written(met.select("slot", F.coalesce("met", "opening").alias("s"), F.floor(F.col("slot") / CHUNK).alias("chunk")))
    earlier = W.partitionBy("s").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    bases = found.groupBy("s", "chunk").agg(F.count("*").alias("n")).select("s", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = found.withColumn("inside", F.row_number().over(W.partitionBy("s", "chunk").orderBy("slot")) - 1)
    return inside.join(bases, ["s", "chunk"]).select("slot", "s", (F.col("base") + F.col("inside")).alias("rank"))


def offsets(sized: DataFrame, rows: int) -> DataFrame:
    """Adds start: the words that precede each row in its source's shuffled line; rows of size > 0. Rows are dealt to
    buckets by doc_id and text; rows equal in both are dealt by the partition they were written in, too."""
    buckets = max(64, rows // 100_000)
    some = sized.filter("size > 0")
    again = runtime.written(some.groupBy("doc_id", "digest").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest")))
    copies = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))
    h = some.join(runtime.small(again), copies, "left").withColumn("salt", F.when(F.col("of_digest").isNotNull(), F.shiftright("row", 33)).otherwise(0)).drop("of", "of_digest")
    h = h.withColumn("h", F.xxhash64(F.lit(7), "doc_id", "digest", "salt")).withColumn("k", F.pmod("h", F.lit(buckets)))
    before = W.partitionBy("s").orderBy("k").rowsBetween(W.unboundedPreceding, -1)
    base = h.groupBy("s", "k").agg(F.sum("size").alias("n")).select("s", "k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("s", "k").orderBy("h", "doc_id", "digest", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = h.withColumn("inner_start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(base, ["s", "k"]).withColumn("start", F.col("base") + F.col("inner_start")).drop("h", "k", "salt", "base", "inner_start")


def mixed(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """doc_id, source, size, digest (of the text), source_size, target, taken: a row for each document."""
    spark = docs.sparkSession
    sized = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), F.xxhash64(F.col("text").cast("string")).alias("digest"))
    sized = runtime.written(sized.withColumn("row", F.monotonically_increasing_id()))
    table = source_table(sized, weights)
    known = table.drop("slots", "first_slots")
    known._rows_written = runtime.rows_of(table)
    rows = sized.join(runtime.small(known), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    passes = known.select("s", "blocks")
    passes._rows_written = runtime.rows_of(table)
    took = (
        schedule(spark, table).join(runtime.small(passes), "s")
        .filter(F.col("rank") < MAX_PASSES * F.col("blocks"))
        .groupBy("s", (F.col("rank") % F.col("blocks")).alias("block")).agg(F.count("*").alias("passes"))
    )
    placed = offsets(rows, runtime.rows_of(sized))
    touched = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / F.col("block_words")), F.floor((F.col("start") + F.col("size") - 1) / F.col("block_words")))))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("block_words")) - F.greatest(F.col("start"), F.col("block") * F.col("block_words"))
    keys = ["doc_id", "source", "size", "digest", "source_size", "target"]
    some = touched.join(took, ["s", "block"], "left").groupBy("row", *keys).agg(F.sum(overlap * F.coalesce("passes", F.lit(0))).alias("taken"))
    none = rows.filter("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return some.select(*keys, F.col("taken").cast("long").alias("taken")).unionByName(none)


def repeated(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """docs as the mix takes them: each row as often as its taken words over its size, the fraction rounded
    up with that probability by a hash of the row. Rows equal in doc_id, source and text share alike."""
    takes = mixed(docs, weights).filter("size > 0").groupBy("doc_id", "source", "digest").agg((F.sum("taken") / F.sum("size")).alias("rate"))
    chance = F.pmod(F.xxhash64(F.lit("round"), "doc_id", "digest"), F.lit(1 << 30)) / float(1 << 30)
    of, source, digest, times, time = runtime.unused(docs, "take_id", "take_source", "take_digest", "take_times", "take_time")
    takes = takes.select(F.col("doc_id").alias(of), F.col("source").alias(source), F.col("digest").alias(digest), F.floor(F.col("rate") + chance).cast("int").alias(times))
    takes = runtime.written(takes.filter(F.col(times) > 0))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & F.col("source").cast("string").eqNullSafe(F.col(source)) & (F.xxhash64(F.col("text").cast("string")) == F.col(digest))
    rows = docs.join(runtime.small(takes), same)
    return rows.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(of, source, digest, times, time)


def query(spark, sf_dir: str) -> DataFrame:
    return mixed(runtime.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")

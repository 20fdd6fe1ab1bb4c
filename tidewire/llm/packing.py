"""Best-fit packing of tokenised documents into sequences of bounded length.

Each document's ids, with an end id, are one piece unless longer than a sequence; then they are cut
into full pieces, of which only the first may be shorter. All pieces are packed together, best fit
decreasing: a segment tree over the remaining capacities finds the tightest open sequence for a piece in
logarithmic time. Pieces of one length are alike, so the plan is made from the counts of lengths alone (a row
for each length up to a sequence's): open sequences of one history are a class, and a run of pieces goes to a
class at once, several to a sequence while they fit, just as one by one. A length's run can split two classes,
so the plan has a bounded size too, whatever the number of pieces. A piece's rank among its length's then
says its place. Only lengths are shuffled, never text.

Defined results: null text counts as empty (one end id); repeated rows are packed each, also under one
doc_id, null doc_ids too; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import runtime, tokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str = tokens.VOCABULARY, ranks: str | None = tokens.RANKS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every whole text."""
    runtime.prepare(docs.sparkSession)

    def cut(batches):
        encode = tokens.encoder(vocabulary, ranks).ids
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                rows += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(runtime.frugal(cut), PIECES)


class OpenBins:
    """Open bins by remaining capacity. The tree's node counts the entries below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, entry) -> None:
        self.bins[room].append(entry)
        self._add(room, 1)

    def _add(self, room: int, d: int) -> None:
        k = room + self.size
        while k:
            self.count[k] += d
            k >>= 1

    def take(self, least: int) -> tuple | None:
        """(room, entry) with the least room of at least `least`."""
        k = least + self.size
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.size:
                k = 2 * k + (not self.count[2 * k])
        room = k - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """(rows of length, first rank, first bin, pieces a bin, offset of the first; the number of bins) by best fit
    decreasing over counts of lengths."""
    runs, made, tree = [], 0, OpenBins(capacity)  # entries: (first bin, bins) of one history
    for n in sorted(counts, reverse=True):
        rank, left = 0, counts[n]
        while left:
            room, (first, bins) = tree.take(n) or (capacity, (made, -(-left // (capacity // n))))
            if first == made:
                made += bins
            each = room // n  # the tightest bin stays the tightest until n doesn't fit it
            full = min(bins, left // each)
            if full:
                runs.append((n, rank, first, each, capacity - room))
                if room - each * n:
                    tree.put(room - each * n, (first, full))
                rank, left = rank + full * each, left - full * each
            if full < bins and left:  # the last one of the run, in part
                runs.append((n, rank, first + full, left, capacity - room))
                tree.put(room - left * n, (first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            if full < bins:
                tree.put(room, (first + full, bins - full))
    return np.array(runs, np.int64).reshape(-1, 5), made


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, none above capacity; bins count from 0."""
    found, n = np.unique(lengths, return_counts=True)
    runs, _ = plan(dict(zip(found.tolist(), n.tolist(), strict=True)), capacity)
    rank, order = np.empty(len(lengths), np.int64), np.argsort(lengths, kind="stable")
    rank[order] = np.arange(len(lengths)) - np.repeat(np.cumsum(n) - n, n)
    return places(lengths, rank, runs)


def places(lengths: np.ndarray, ranks: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of pieces by length and rank among their length's."""
    keys = (runs[:, 0] << 46) + runs[:, 1]
    order = np.argsort(keys)
    run = runs[order[np.searchsorted(keys[order], (lengths << 46) + ranks, side="right") - 1]] if len(lengths) else runs[:0]
    step, at = np.divmod(ranks - run[:, 1], run[:, 3])
    return run[:, 2] + step, run[:, 4] + at * lengths


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to pieces(); cut is a written table, with row from
    monotonically_increasing_id()."""
    spark = cut.sparkSession
    part = F.shiftright("row", 33)
    counted = runtime.written(cut.groupBy("length", part.alias("part")).agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs = spark.sparkContext.broadcast(plan(counts, capacity)[0])
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = runtime.written(counted.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")))
    inside = F.row_number().over(W.partitionBy("length", "part").orderBy("row")) - 1  # of the pieces one task cut
    ranked = cut.withColumn("part", part).withColumn("inside", inside).join(runtime.small(bases), ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("inside")).alias("rank"))

    def put(batches):
        for batch in batches:
            bins, offsets = places(batch.column(3).to_numpy(), batch.column(5).to_numpy(), runs.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(bins), pa.array(offsets)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(runtime.frugal(put), PIECES + ", sequence_id long, offset long")


def packed(docs: DataFrame, capacity: int = 2048, **kwargs) -> DataFrame:
    return pack(runtime.written(pieces(docs, capacity, **kwargs).withColumn("row", F.monotonically_increasing_id())), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    return packed(runtime.documents(spark, sf_dir))

"""Exact top-k by integer inner product with a three-phase uniform threshold.

A vector's components are cut into LISTS ranges; each gives a list of partial scores, and a score is the
sum over the lists. Partial scores are counted from their list's least value, so that none is negative.
They come from 32-bit float products (64-bit ones where components are so large that the former could
overflow) whose error has a proven bound, which every comparison allows for; only scores themselves are
computed in whole numbers, of any size where 64 bits might not do.

1. Every task gathers for each query the entries that lead one of its lists, with their whole
   scores. The k-th best of these is a safe cutoff: no answer is below it.
2. The cutoffs are broadcast (a number a query). An entry whose partial scores all lie below the
   uniform threshold (cutoff less the lists' least values, over the number of lists) can't reach
   the cutoff; the others are collected.
3. Of those, entries whose bound (the sum of their partial scores) reaches the cutoff are resolved exactly,
   where they lie. A task hands on the k best it holds for each query, whatever their number of ties.

Queries go in blocks of about BLOCK_QUERIES rows, dealt by row whatever their ids, each broadcast to all candidates;
answers leave a task as rows of (query, vector, score), at most k a query.

Defined results: vectors that are null or hold null or non-finite components take no part; only vectors
of one length are compared; a null vec_id takes no part; rows that repeat a vec_id are each candidates, and
each queries, whose answers share the k places of their id; an answer's score that 64 bits can't hold raises an
error, as does a component whose floor they can't; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import runtime

LISTS, BLOCK_QUERIES, SCALE = 4, 4096, 256
#: Rows of an Arrow batch; scores of (query, candidate) that a task holds at a time.
CHUNK, CELLS = 2048, 1 << 19
_ANSWERS = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component, for vectors that take part."""
    v = F.transform(F.col("embedding"), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long"), "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(whole).select("vec_id", v.alias("v"))


def _matrices(batch: pa.RecordBatch, queries: dict):
    """(length, ids, matrix) for each length of vectors that queries have, some rows at a time."""
    lists = batch.column(1)
    lengths, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
    edges, ids = np.concatenate([[0], np.cumsum(lengths)]), batch.column(0).to_numpy()
    for n in set(np.unique(lengths).tolist()) & set(queries):
        rows, step = np.flatnonzero(lengths == n), max(64, CELLS // len(queries[n][0]))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield int(n), ids[some], flat[edges[some][:, None] + np.arange(n)]


def _partials(queries: np.ndarray, vectors: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """(lists, queries, vectors) partial scores as floats, and how far off each list's may be."""
    width = queries.shape[1]
    cuts = [width * i // lists for i in range(lists + 1)]
    kind, unit = (np.float32, 2.0**-24) if _narrow(queries, vectors) else (np.float64, 2.0**-53)
    q, v = queries.astype(kind), vectors.astype(kind)
    out = np.stack([q[:, a:b] @ v[:, a:b].T for a, b in zip(cuts, cuts[1:], strict=False)])
    # rounding of both factors, of their products and of the sums, to first order; doubled
    off = [2.0 * (b - a + 3) * unit * (b - a) * _most(queries[:, a:b]) * _most(vectors[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return out, np.array(off)


def _most(x: np.ndarray) -> float:
    return max(float(x.max(initial=0)), -float(x.min(initial=0)))


def _narrow(queries: np.ndarray, vectors: np.ndarray) -> bool:
    """Whether 64 bits hold every score of these rows."""
    most = _most(queries), _most(vectors)
    if max(most) >= 2.0**63:  # where floor() ends
        raise OverflowError("components beyond 64 bits")
    return most[0] * most[1] * max(1, queries.shape[1]) < 2.0**63


def _exact(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores of pairs of rows, some at a time; 1 or -1 where one is above or below 64 bits and stands at their end, else 0)."""
    out, over, step = np.empty(len(q), np.int64), np.zeros(len(q), np.int8), max(1, CELLS // max(1, queries.shape[1]))
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        out[part] = np.einsum("ij,ij->i", queries[q[part]], vectors[v[part]])
    if not _narrow(queries, vectors):
        large, other = (np.abs(x.astype(float)).max(1, initial=0) for x in (queries, vectors))
        for i in np.flatnonzero(large[q] * other[v] * max(1, queries.shape[1]) >= 2.0**63):
            score = sum(x * y for x, y in zip(queries[q[i]].tolist(), vectors[v[i]].tolist(), strict=True))
            over[i] = (score >= 2**63) - (score < -(2**63))
            out[i] = min(max(score, -(2**63)), 2**63 - 1)
    return out, over


class _Best:
    """The k best (score, then least id) of each query so far."""

    def __init__(self, k: int):
        self.k, self.q, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q, ids, scores = (np.concatenate(x) for x in ((self.q, q), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, q))
        order = order[np.arange(len(order)) - np.searchsorted(q[order], q[order]) < self.k]
        self.q, self.ids, self.scores = q[order], ids[order], scores[order]


def _block(candidates: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int, lists: int) -> DataFrame:
    spark = candidates.sparkSession
    held = spark.sparkContext.broadcast(queries)

    def scored(batches):
        for batch in batches:
            for n, ids, vectors in _matrices(batch, held.value):
                names, matrix = held.value[n]
                yield n, names, matrix, ids, vectors, *_partials(matrix, vectors, lists)

    def lead(batches):
        least: dict[int, np.ndarray] = {}
        best: dict[int, _Best] = {}
        for n, names, matrix, ids, vectors, partial, off in scored(batches):
            low = partial.min(2) - off[:, None]
            least[n] = np.minimum(least[n], low) if n in least else low
            picks = np.zeros(partial.shape[1:], bool)
            for part in partial:  # k, and the query's own entry
                np.put_along_axis(picks, np.argpartition(part, max(0, part.shape[1] - k - 1), axis=1)[:, -k - 1 :], True, 1)
            q, v = np.nonzero(picks & (names[:, None] != ids[None, :]))
            if n not in best:
                best[n] = _Best(k)
            score, over = _exact(matrix, vectors, q, v)
            best[n].add(q[over >= 0], ids[v][over >= 0], score[over >= 0])  # one below 64 bits makes no cutoff
        for n, found in best.items():
            names = held.value[n][0]
            sums = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(names) + 1) * lists, lists, dtype=np.int32)), pa.array(least[n].T.ravel().astype(float)))
            yield pa.RecordBatch.from_arrays([pa.array(names[found.q]), pa.array(found.ids), pa.array(found.scores), sums.take(pa.array(found.q))], names=["query_id", "vec_id", "score", "least"])

    leading = runtime.written(candidates.mapInArrow(runtime.frugal(lead), _ANSWERS + ", least array<double>"))
    ranked = leading.withColumn("r", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score")))).filter(F.col("r") <= k)
    lows = leading.groupBy("query_id").agg(*[F.min(F.element_at("least", i + 1)).alias(f"m{i}") for i in range(lists)])
    cut = ranked.groupBy("query_id").agg(F.min("score").alias("cutoff"), F.count("*").alias("n")).join(lows, "query_id")
    known = {r.query_id: r for r in cut.collect()}  # a row for each query of the block
    # without k entries in all there is no cutoff
    cutoffs = spark.sparkContext.broadcast({n: (np.array([float(known[q].cutoff) if q in known and known[q].n >= k else -np.inf for q in names.tolist()]), np.array([[known[q][f"m{i}"] if q in known else 0.0 for i in range(lists)] for q in names.tolist()]).reshape(-1, lists)) for n, (names, _) in queries.items()})

    def resolve(batches):
        best: dict[int, _Best] = {}
        for n, names, matrix, ids, vectors, partial, off in scored(batches):
            cutoff, least = cutoffs.value[n]
            threshold = np.where(np.isinf(cutoff), -np.inf, (cutoff - least.sum(1)) / lists)
            slack = off.sum() + 1e-9 * np.where(np.isinf(cutoff), 0, np.abs(cutoff)) + 1
            collected = np.zeros(partial.shape[1:], bool)
            for i in range(lists):
                collected |= partial[i] >= (threshold + least[:, i] - slack)[:, None].astype(partial.dtype)
            total = partial.sum(0)
            slack = slack + 2.0**-22 * lists * np.abs(partial).max(initial=0)  # the sum's own rounding
            collected &= total >= (cutoff - slack)[:, None]
            q, v = np.nonzero(collected & (names[:, None] != ids[None, :]))
            score, over = _exact(matrix, vectors, q, v)
            if np.any((over > 0) | ((over < 0) & np.isinf(cutoff[q]))):
                raise OverflowError("an answer's score is beyond 64 bits")
            good = (over == 0) & (score >= cutoff[q] - 1e-9 * np.abs(np.where(np.isinf(cutoff[q]), 0, cutoff[q])))
            if n not in best:
                best[n] = _Best(k)
            best[n].add(q[good], ids[v[good]], score[good])
        for n, found in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(held.value[n][0][found.q]), pa.array(found.ids), pa.array(found.scores)], names=["query_id", "vec_id", "score"])

    return candidates.mapInArrow(runtime.frugal(resolve), _ANSWERS)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = LISTS, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of vectors for each query, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    runtime.prepare(spark, CHUNK)
    candidates, asked = quantised(vectors, scale), runtime.written(quantised(queries, scale).withColumn("row", F.monotonically_increasing_id()))
    number, found = -(-asked.count() // BLOCK_QUERIES), None
    for i in range(number):
        rows = asked.filter(F.pmod(F.xxhash64("row"), F.lit(number)) == i).toArrow() if number > 1 else asked.toArrow()
        by_length: dict[int, tuple[list, list]] = {}
        for name, v in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            names, vs = by_length.setdefault(len(v), ([], []))
            names.append(name)
            vs.append(v)
        block = {n: (np.array(a, np.int64), np.array(b, np.int64).reshape(len(a), n)) for n, (a, b) in by_length.items()}
        answers = _block(candidates, block, k, lists) if block else None
        if answers is not None:
            answers = runtime.written(answers) if number > 1 else answers
            found = answers if found is None else found.union(answers)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


ORACLE_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 50 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, cast(rank as integer) rank, vec_id, score from r where rank <= 5
"""

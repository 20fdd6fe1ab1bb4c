"""Near-duplicate documents by BagMinHash.

A document is the multiset of its runs of five words (A-Z folded; a shorter text is one run of all its
words). Its signature is that of weighted Jaccard: for every distinct run and every dyadic range of
weights (0,1], (1,2], (2,4], ... a Poisson process gives points in time, each with a component
of the signature and a place in the range; points above the run's weight are thinned out, and each
component keeps its earliest point. Processes stop at a horizon at which all components are usually
covered; documents with an uncovered one go on with a later horizon, so signatures are exact, and the
probability that two agree in a component is their weighted Jaccard similarity. BANDS bands of ROWS
components make buckets (at similarity 0.8 a pair shares one but for a chance of 3e-6); candidates are
verified by the exact overlap of their multisets.

Copies of one word sequence are collapsed first, to the least doc_id, so groups of any size cost a row
a document; see linking for large groups of near copies.

Defined results: null text counts as empty; texts without words are copies of each other; rows that
share a doc_id are documents of their own, told apart by text; null doc_ids stay and come last; repeated
rows stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linking, runtime, textscan

WORDS, THRESHOLD, BANDS, ROWS = 5, 0.8, 32, 5
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SALTS = textscan.mix(np.arange(1, 200, dtype=np.uint64) * _GOLD)


def shingles(column: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the runs of k words, bounds by text, two-lane digest of each text's word sequence)."""
    words, bounds = textscan.word_hashes(column)
    n = np.diff(bounds)
    runs = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    edges = np.concatenate([[0], np.cumsum(runs)])
    with np.errstate(over="ignore"):
        padded = np.concatenate([words, np.zeros(k, np.uint64)])
        at = np.arange(edges[-1]) - np.repeat(edges[:-1], runs) + np.repeat(bounds[:-1], runs)
        out = np.zeros(len(at), np.uint64)
        for j in range(k):
            out += padded[at + j] * _SALTS[j]
        for i in np.flatnonzero((n > 0) & (n < k)):
            out[edges[i]] = (words[bounds[i] : bounds[i + 1]] * _SALTS[: n[i]]).sum() + np.uint64(n[i])
        place = np.arange(len(words)) - np.repeat(bounds[:-1], n)
        lanes = np.zeros((2, len(n)), np.uint64)
        for lane in (0, 1):
            each = np.concatenate([[np.uint64(0)], np.cumsum(textscan.mix(words + textscan.mix(place.astype(np.uint64) * _GOLD + _SALTS[20 + lane])))])
            lanes[lane] = textscan.mix(each[bounds[1:]] - each[bounds[:-1]] + n.astype(np.uint64))
    return textscan.mix(out), edges, lanes


def counted(runs: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct runs, their counts, their text), text by text in order."""
    runs = runs.copy()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        runs[a:b].sort()
    new = np.ones(len(runs), bool)
    new[1:] = runs[1:] != runs[:-1]
    new[edges[:-1][np.diff(edges) > 0]] = True
    first = np.flatnonzero(new)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    return runs[first], np.diff(np.append(first, len(runs))), owner[first]


def bag_minhash(runs: np.ndarray, counts: np.ndarray, owner: np.ndarray, texts: int, m: int) -> np.ndarray:
    """Signatures (texts x m, uint64); a text without runs has zeros."""
    weight = np.bincount(owner, counts, texts)
    horizon = (np.log(m) + 4) / np.maximum(weight, 1)
    result, todo = np.zeros((texts, m), np.uint64), weight > 0
    with np.errstate(over="ignore"):
        while todo.any():
            mine = todo[owner]
            e, c, d = runs[mine], counts[mine], owner[mine]
            parts, level, low = [], 0, 0
            while len(e):
                width = max(low, 1)
                parts.append((textscan.mix(e + _SALTS[30 + level]), np.full(len(e), low, float), np.full(len(e), width, float), c, d))
                low, level = low + width, level + 1
                more = c > low
                e, c, d = e[more], c[more], d[more]
            key, low_, width_, c, d = (np.concatenate(x) for x in zip(*parts, strict=True))
            t, step = np.zeros(len(key)), np.uint64(0)
            best, named = np.full(texts * m, np.inf), np.zeros(texts * m, np.uint64)
            while len(key):
                step += np.uint64(1)
                r = textscan.mix(key + step * _GOLD)
                t = t - np.log(((r >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / (m * width_)
                keep = t <= horizon[d]
                key, low_, width_, c, d, t, r = (x[keep] for x in (key, low_, width_, c, d, t, r))
                r = textscan.mix(r ^ _SALTS[25])
                slot = d * m + (((r >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
                inside = low_ + width_ * ((r & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32) < c
                slot, when, r = slot[inside], t[inside], r[inside]
                np.minimum.at(best, slot, when)
                won = best[slot] == when
                named[slot[won]] = r[won]
            done = todo & np.isfinite(best.reshape(texts, m)).all(1)
            result[done] = named.reshape(texts, m)[done]
            todo &= ~done
            horizon[todo] *= 2
    return result


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        grouped = (signatures.reshape(len(signatures), bands, rows) * _SALTS[:rows]).sum(2, dtype=np.uint64)
        return textscan.mix(grouped + _SALTS[60 : 60 + bands]).view(np.int64)


def signed(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest (of the text), f1, f2 (of the word sequence), bands (keys; none without words)."""
    runtime.prepare(docs.sparkSession, 300)

    def sign(batches):
        for batch in batches:
            runs, edges, lanes = shingles(batch.column(1), words)
            signatures = bag_minhash(*counted(runs, edges), len(batch), bands * rows)
            keys = band_keys(signatures, bands, rows)
            some = np.diff(edges) > 0
            ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lanes[0].view(np.int64)), pa.array(lanes[1].view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].ravel()))], names=["doc_id", "digest", "f1", "f2", "bands"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("digest")).mapInArrow(runtime.frugal(sign), "doc_id long, digest long, f1 long, f2 long, bands array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two sorted multisets; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    (x, n), (y, k) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    both = np.minimum(n[at], k)[x[at] == y].sum()
    return both / (len(a) + len(b) - both)


def near_classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest, class_id (the least doc_id of the class), label (a number of the class)."""
    runtime.prepare(docs.sparkSession, 300)
    sketches = runtime.written(signed(docs, words, bands, rows))
    texts = sketches.groupBy("f1", "f2").agg(F.min("doc_id").alias("text_doc_id"))
    texts = runtime.written(texts.select("f1", "f2", "text_doc_id", F.monotonically_increasing_id().alias("id")))
    keyed = sketches.filter(F.size("bands") > 0).join(texts, ["f1", "f2"]).filter(F.col("doc_id").eqNullSafe(F.col("text_doc_id")))
    buckets = keyed.select("id", F.explode("bands").alias("key")).select("key", "id")

    def payload(ids: DataFrame) -> DataFrame:
        wanted = runtime.written(texts.join(ids, "id", "left_semi"))

        def fingerprint(batches):
            for batch in batches:
                _, _, lanes = shingles(batch.column(1), words)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x.view(np.int64)) for x in lanes]], names=["doc_id", "payload", "f1", "f2"])

        of = wanted.select(F.col("text_doc_id").alias("doc_id")).distinct()
        given, of = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), runtime.written(of)
        near = given.join(runtime.small(of), "doc_id", "left_semi")
        if not runtime.is_empty(of.filter("doc_id is null")):  # not by a join, which would deal all of them to one task
            near = near.unionByName(given.filter("doc_id is null"))
        with_digest = near.mapInArrow(runtime.frugal(fingerprint), "doc_id long, payload string, f1 long, f2 long")
        return with_digest.join(runtime.small(wanted), ["f1", "f2"]).filter(F.col("doc_id").eqNullSafe(F.col("text_doc_id"))).select("id", "payload").dropDuplicates(["id"])

    def load(column: pa.Array) -> list[np.ndarray]:
        runs, edges, _ = shingles(column, words)
        return [np.sort(runs[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def alike(some: list[np.ndarray], others: list[np.ndarray]) -> list[bool]:
        return [min(len(x), len(y)) >= threshold * max(len(x), len(y)) and similarity(x, y) >= threshold for x, y in zip(some, others, strict=True)]

    def features(payloads: DataFrame) -> DataFrame:
        def spread(batches):
            for batch in batches:
                of, n, owner = counted(*shingles(batch.column(1), words)[:2])
                for at in range(0, len(of), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[part])), pa.array(of[part].view(np.int64)), pa.array(n[part])], names=["id", "feature", "n"])

        return payloads.select("id", "payload").mapInArrow(runtime.frugal(spread), "id long, feature long, n long")

    labels = linking.classes(buckets, payload, load, alike, features, threshold / (1 + threshold))
    named = texts.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = named.groupBy("label").agg(F.min("text_doc_id").alias("class_id"))
    known = runtime.written(named.join(least, "label").select("f1", "f2", "class_id", "label"))
    return sketches.select("doc_id", "digest", "f1", "f2").join(runtime.small(known), ["f1", "f2"]).select("doc_id", "digest", "class_id", "label")


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: the least doc_id (nulls last), the least text digest of it, and
    one of rows that are equal in both."""
    found = near_classes(docs)
    place = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id"), F.col("digest"))
    of, digest = runtime.unused(docs, "first_id", "first_digest")
    first = runtime.written(found.groupBy("label").agg(F.min(place).alias("p")).select(F.col("p.doc_id").alias(of), F.col("p.digest").alias(digest)))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.xxhash64(F.col("text").cast("string")) == F.col(digest))
    kept = docs.join(runtime.small(first), same)
    if not runtime.is_empty(found.groupBy("doc_id", "digest").count().filter("count > 1")):
        kept = kept.dropDuplicates([of, digest])
    return kept.drop(of, digest)


def query(spark, sf_dir: str) -> DataFrame:
    """One row a document: its class and whether it is the one of the class that stays."""
    found = runtime.written(near_classes(runtime.documents(spark, sf_dir)).withColumn("row", F.monotonically_increasing_id()))
    least = F.col("doc_id").eqNullSafe(F.col("class_id"))
    # rows that share the least doc_id, or have none: the first by digest stays
    shared = found.filter(least).groupBy("label").agg(F.count("*").alias("n"), F.min(F.struct("digest", "row")).alias("first"))
    shared = runtime.written(shared.filter("n > 1").select("label", F.col("first.row").alias("first_row")))
    kept = least & F.coalesce(F.col("row") == F.col("first_row"), F.lit(True))
    return found.join(runtime.small(shared), "label", "left").select("doc_id", "class_id", kept.alias("kept"))

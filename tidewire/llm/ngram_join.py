"""Documents linked by the Jaccard similarity of their sets of four-word runs, and what the links connect.

Documents with equal sets are one entry. Entries meet by their least runs: with any fixed order of runs, two
entries alike share one of the first n - ceil(T * n) + 1 of both. The order puts runs first that a sample
of documents doesn't show to be frequent, so passages that many documents share rarely bring any together;
the sample decides which entries meet, never which are linked.

A run with several entries makes tiles by bands of size: entries alike lie in one band or two neighbours, so
a tile holds a band and the next. An entry carries a hashed bitmap of its set, each bit the parity of the
runs that fall on it, as wide as its size asks for. Bits that differ come from runs that one set has alone,
so their count bounds the overlap from above; pairs within the bound are decided by the exact
intersection of both sorted arrays of runs.

First every tile is tied to one leader, and those whose entries are then in different components to another, which
links groups of copies at a row an entry. Tiles still mixed are compared in whole, in cells of two blocks
of entries, and only pairs of different components that pass the bound leave a cell. Where they are more than the cell's entries, those of a
forest of its components leave it, the nearest first; tiles that are then still mixed are settled by the sets themselves, and
the links that leave a cell are a forest again. So components are those of all links, rows that leave a cell are no more than those in
it, and neither a list nor a task holds a tile.

Runs are known by 64-bit hashes of their words. Defined results: null text counts as empty; texts without
words have no runs and are linked with nothing; texts of fewer than four words have one run of them all; rows
that share a doc_id are documents of their own; a null doc_id is passed over where a component's least is
taken, and stays null where there is no other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linking, near_dedup, runtime, textscan

WORDS, PERCENT = 4, 85
#: One document in SAMPLE is read for frequent runs: those that SEEN of these hold, FREQUENT of them at most.
SAMPLE, SEEN, FREQUENT = 16, 3, 200_000
#: Entries of a block of a tile, and runs where their sets are compared; bits of a bitmap at least and at most.
BLOCK, BLOCK_RUNS, LEAST_BITS, MOST_BITS = 512, 1 << 20, 512, 1 << 17
_SALT = textscan.mix(np.arange(1, 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def bands(percent: int = PERCENT, most: int = 1 << 40) -> np.ndarray:
    """Where each band of sizes begins: a size and any that is alike lie in one band or in two neighbours."""
    starts = [1]
    while starts[-1] < most:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts, np.int64)


def sets_of(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(distinct runs in order, bounds by text)."""
    runs, edges, _ = near_dedup.shingles(column, words)
    distinct, _, owner = near_dedup.counted(runs, edges)
    return distinct, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(column)))]).astype(np.int64)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return total[edges[1:]] - total[edges[:-1]]


def digests(runs: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each set."""
    with np.errstate(over="ignore"):
        return [textscan.mix(_sums(textscan.mix(runs ^ salt), edges) + np.diff(edges).astype(np.uint64)) for salt in _SALT[:2]]


def bitmap(runs: np.ndarray) -> bytes:
    """The parities of a set's runs by hash; the width is a power of two."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(2 * len(runs) - 1).bit_length()))
    at = (textscan.mix(runs ^ _SALT[2]) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(maps: list[bytes], width: int | None = None) -> np.ndarray:
    """Bitmaps as rows of one width, the least: a parity folded in two is the parity of half as many bits."""
    width = width or min(len(m) for m in maps)
    out = np.zeros((len(maps), width // 8), np.uint64)
    for i, m in enumerate(maps):
        words = np.frombuffer(m, np.uint64)
        while len(words) > width // 8:
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        out[i] = words
    return out


def may_link(differing: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether pairs with so many differing bits, of sizes that sum to so many, can be alike."""
    most = (sizes - differing) // 2  # of the overlap
    return (100 + percent) * most >= percent * sizes


def frequent(docs: DataFrame, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, the rank of each by count) of runs that the sample shows to be frequent: FREQUENT at most."""

    def count(batches):
        for batch in batches:
            runs, _ = sets_of(batch.column(0), words)
            of, n = np.unique(runs, return_counts=True)
            for at in range(0, len(of), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(of[at : at + 100_000].view(np.int64)), pa.array(n[at : at + 100_000])], names=["run", "n"])

    text = F.col("text").cast("string")
    some = docs.select(text.alias("text")).filter(F.pmod(F.xxhash64(text), F.lit(SAMPLE)) == 0)
    counted = some.mapInArrow(runtime.frugal(count), "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).filter(F.col("n") >= SEEN)
    rows = counted.orderBy(F.desc("n"), "run").limit(FREQUENT).toArrow()
    runs = rows.column("run").to_numpy().view(np.uint64)
    order = np.argsort(runs)
    return runs[order], (len(runs) - order).astype(np.int64)


def sketched(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """row, doc_id, size, d1, d2, band, keys (the runs by which the set meets others), map. Written: rows have no other name."""
    runtime.prepare(docs.sparkSession, 300)
    starts = bands(percent)
    held = docs.sparkSession.sparkContext.broadcast(frequent(docs, words))

    def sketch(batches):
        known, rank = held.value
        for batch in batches:
            runs, edges = sets_of(batch.column(2), words)
            size, owner = np.diff(edges), np.repeat(np.arange(len(batch)), np.diff(edges))
            place = np.zeros(len(runs), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
                place = np.where(known[at] == runs, rank[at], 0)
            order = np.lexsort((runs, place, owner))
            heads = np.where(size > 0, size + (-percent * size // 100) + 1, 0)
            kept = runs[order][np.arange(len(runs)) - np.repeat(edges[:-1], size) < np.repeat(heads, size)]
            ends = np.concatenate([[0], np.cumsum(heads)]).astype(np.int32)
            maps = [bitmap(runs[a:b]) if b > a else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(size), *[pa.array(d.view(np.int64)) for d in digests(runs, edges)], pa.array((np.searchsorted(starts, size, "right") - 1).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(kept.view(np.int64))), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "size", "d1", "d2", "band", "keys", "map"])

    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return runtime.written(given.mapInArrow(runtime.frugal(sketch), "row long, doc_id long, size long, d1 long, d2 long, band int, keys array<long>, map binary"))


def _bounded(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose sizes and bitmaps let them be alike."""

    def test(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            some, others = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            differing = np.zeros(len(batch), np.int64)
            widths = np.array([min(len(x), len(y)) for x, y in zip(some, others, strict=True)], np.int64)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                differing[at] = np.bitwise_count(folded([some[i] for i in at], int(width)) ^ folded([others[i] for i in at], int(width))).sum(1)
            good = pa.array(may_link(differing, sizes, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    at = runtime.small(maps)
    a, b = (at.select(F.col("id").alias(x), F.col("size").alias(f"size_{x}"), F.col("map").alias(f"map_{x}")) for x in "ab")
    sized = pairs.join(a, "a").join(b, "b").filter(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    return sized.select("a", "b", "size_a", "size_b", "map_a", "map_b").mapInArrow(runtime.frugal(test), "a long, b long")


def _near(side: np.ndarray, labels: np.ndarray, size: np.ndarray, own: np.ndarray, maps: np.ndarray, percent: int):
    """For each entry of a cell: its place, those of entries of other labels that the bounds let be alike, and the differing bits.
    Labels may be changed meanwhile."""
    two = bool(side.any()) and not bool(side.all())
    for i in np.flatnonzero(side == 0) if two else range(len(side)):
        far = np.flatnonzero(side == 1) if two else np.arange(i + 1, len(side))
        far = far[(labels[far] != labels[i]) & (own[far] | own[i]) & (100 * np.minimum(size[far], size[i]) >= percent * np.maximum(size[far], size[i]))]
        bits = np.bitwise_count(maps[far] ^ maps[i]).sum(1).astype(np.int64)
        good = may_link(bits, size[far] + size[i], percent)
        if good.any():
            yield i, far[good], bits[good]


def _forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Of pairs (a, b) in the order of their worth, the places of those that join labels not joined before."""
    _, label = np.unique(labels, return_inverse=True)
    top, taken = list(range(len(labels))), []

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for k, (x, y) in enumerate(zip(label[a].tolist(), label[b].tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            top[x] = y
            taken.append(k)
    return np.array(taken, np.int64)


def _compared(cells: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels in cells (key, lo, hi, side, id, label, size, own, map) that the bounds let be alike.
    A cell of more pairs than entries gives those of a forest of its labels, the nearest first, and a row with its key for the rest."""

    def pairs(key: int, rows: list[tuple]):
        side, ids, labels, size, own = (np.array(x) for x in list(zip(*rows, strict=True))[:5])
        found = [(np.full(len(far), i), far, bits) for i, far, bits in _near(side, labels, size, own, folded([r[5] for r in rows]), percent)]
        if not found:
            return []
        a, b, bits = (np.concatenate(x) for x in zip(*found, strict=True))
        if more := len(a) > len(ids):
            order = np.argsort(bits / (size[a] + size[b]), kind="stable")
            some = order[_forest(a[order], b[order], labels)]
            a, b = a[some], b[some]
        out = [(np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), [None] * len(a))]
        return [*out, ([None], [None], [key])] if more else out

    return _by_cell(cells, "a long, b long, key long", pairs)


def _linked(cells: DataFrame, load, alike, percent: int) -> DataFrame:
    """Links (a, b) that join the labels of cells (as for _compared, and payload) as all their links do; a forest in each."""

    def pairs(key: int, rows: list[tuple]):
        side, ids, labels, size, own = (np.array(x) for x in list(zip(*rows, strict=True))[:5])
        sets, found = [r[6] for r in rows], []
        for i, far, bits in _near(side, labels, size, own, folded([r[5] for r in rows]), percent):
            for j in far[np.argsort(bits, kind="stable")]:
                if labels[i] != labels[j] and alike([sets[i]], [sets[j]])[0]:
                    labels[labels == labels[j]] = labels[i]
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return [tuple(zip(*found, strict=True))] if found else []

    return _by_cell(cells, "a long, b long", pairs, load)


def _by_cell(cells: DataFrame, schema: str, pairs, load=None) -> DataFrame:
    """What pairs(key, rows of side, id, label, size, own, map and what load makes of payload) gives for each cell."""
    names = [x.split()[0] for x in schema.split(", ")]

    def compare(batches):
        at, held, found = None, [], []

        def out():
            whole = [[x.item() if isinstance(x, np.generic) else x for part in parts for x in part] for parts in zip(*found, strict=True)]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in whole], names=names)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:9]]
            if load:
                columns.append(load(batch.column(9)))
            for key, lo, hi, *row in zip(*columns, strict=True):
                if (key, lo, hi) != at:
                    found += pairs(at[0], held) if len(held) > 1 else ()
                    at, held = (key, lo, hi), []
                held.append((row[0] if lo != hi else 0, *row[1:]))
            if found:
                yield out()
        found += pairs(at[0], held) if len(held) > 1 else ()
        if found:
            yield out()

    dealt = cells.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.select("key", "lo", "hi", "side", "id", "label", "size", "own", "map", *(["payload"] if load else [])).mapInArrow(runtime.frugal(compare), schema)


def _cells(mixed: DataFrame, sizes: DataFrame) -> DataFrame:
    """mixed (key, id, label, own) in cells of two blocks, by sizes (key, blocks)."""
    block = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    dealt = mixed.join(runtime.small(sizes), "key").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "label", "own")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (id, label) after more links (a, b); what they add is a row for each pair of labels."""
    if runtime.is_empty(links):
        return labels
    at = runtime.small(labels)
    a, b = (at.select(F.col("id").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
    ends = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    tops = linking.min_labels(runtime.written(ends.filter("a <> b").distinct()))
    known = labels.select("id", "label").union(tops.select("id", F.col("id").alias("label"))).distinct()
    top = runtime.small(tops).select(F.col("id").alias("label"), F.col("label").alias("top"))
    return runtime.written(known.join(top, "label", "left").select("id", F.coalesce("top", "label").alias("label")))


def components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs."""
    sets = sketched(docs, words, percent)
    entries = runtime.written(sets.filter("size > 0").groupBy("d1", "d2").agg(F.min("row").alias("id"), F.min("doc_id").alias("least")))
    first = sets.join(runtime.small(entries.select(F.col("id").alias("row"))), "row", "left_semi")
    keyed = first.select(F.explode("keys").alias("key"), F.col("row").alias("id"), "band")
    often = runtime.written(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"))
    members = keyed.join(runtime.small(often), "key")
    # a tile of a run: the entries of a band (own) and of the next
    tiled = members.select("key", F.explode(F.array(F.struct("band", F.lit(True).alias("own")), F.struct((F.col("band") - 1).alias("band"), F.lit(False).alias("own")))).alias("t"), "id")
    tiled = runtime.written(tiled.select(F.xxhash64("key", "t.band").alias("key"), "id", "t.own"))
    place = F.struct(F.xxhash64("id").alias("h"), F.col("id"))
    tiles = runtime.written(tiled.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("own"), place))["id"].alias("lead")).filter("n > 1 and lead is not null"))
    tied = tiled.join(runtime.small(tiles), "key").filter("id <> lead").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
    maps = runtime.written(first.join(runtime.small(runtime.written(tiled.select(F.col("id").alias("row")).distinct())), "row", "left_semi").select(F.col("row").alias("id"), "size", "map"))
    of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def payload(pairs: DataFrame) -> DataFrame:
        """id, payload: the texts of pairs."""

        def name(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(d.view(np.int64)) for d in digests(*sets_of(batch.column(1), words))]], names=["doc_id", "payload", "d1", "d2"])

        asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        wanted = runtime.written(first.select(F.col("row").alias("id"), "doc_id", "d1", "d2").join(asked, "id", "left_semi"))
        near = of.join(runtime.small(runtime.written(wanted.filter("doc_id is not null").select("doc_id").distinct())), "doc_id", "left_semi")
        if not runtime.is_empty(wanted.filter("doc_id is null")):  # not by a join, which would deal all of them to one task
            near = near.unionByName(of.filter("doc_id is null"))
        texts = near.mapInArrow(runtime.frugal(name), "doc_id long, payload string, d1 long, d2 long")
        return runtime.written(texts.join(runtime.small(wanted.select("id", "d1", "d2")), ["d1", "d2"]).select("id", "payload").dropDuplicates(["id"]))

    def load(column: pa.Array) -> list[np.ndarray]:
        runs, edges = sets_of(column, words)
        return [runs[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def alike(some: list[np.ndarray], others: list[np.ndarray]) -> list[bool]:
        out = []
        for x, y in zip(some, others, strict=True):
            both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return out

    def linked(pairs: DataFrame) -> DataFrame:
        return runtime.written(linking.verified(pairs, payload(pairs), load, alike))

    def unsettled(labels: DataFrame) -> DataFrame:
        return linking._mixed(tiled.join(runtime.small(tiles.select("key")), "key", "left_semi"), labels)

    labels = linking.min_labels(linked(runtime.written(_bounded(runtime.written(tied), maps, percent))))
    mixed = unsettled(labels)
    if not runtime.is_empty(mixed):  # once more, each run's tile by a leader of its own
        place = F.struct(F.xxhash64("id", "key").alias("h"), F.col("id"), F.col("label"))
        leads = runtime.written(mixed.groupBy("key").agg(F.min(F.when(F.col("own"), place)).alias("lead")).select("key", F.col("lead.id").alias("lead"), F.col("lead.label").alias("led")))
        tied = mixed.join(runtime.small(leads), "key").filter("label <> led").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
        labels = _merged(labels, linked(runtime.written(_bounded(runtime.written(tied), maps, percent))))
        mixed = unsettled(labels)
    if not runtime.is_empty(mixed):
        sizes = runtime.written(mixed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
        found = runtime.written(_compared(_cells(mixed, sizes).join(runtime.small(maps), "id"), percent))
        labels = _merged(labels, linked(runtime.written(found.filter("key is null").select("a", "b").distinct())))
        more = runtime.written(found.filter("key is not null").select("key").distinct())
        mixed = linking._mixed(tiled.join(runtime.small(more), "key", "left_semi"), labels)
    if not runtime.is_empty(mixed):  # tiles with more pairs than these, by the sets themselves
        entry = mixed.join(runtime.small(maps), "id")
        sizes = runtime.written(entry.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_RUNS)).cast("int").alias("blocks")))
        texts = payload(runtime.written(mixed.select(F.col("id").alias("a"), F.col("id").alias("b")).distinct()))
        cells = _cells(mixed, sizes).join(runtime.small(maps), "id").join(texts, "id")
        labels = _merged(labels, runtime.written(_linked(cells, load, alike, percent).distinct()))
    named = entries.join(runtime.small(labels), "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = runtime.written(named.groupBy("label").agg(F.min("least").alias("component_id")))
    known = runtime.written(named.join(runtime.small(least), "label").select("d1", "d2", "component_id"))
    every = sets.select("doc_id", F.col("size").alias("n_shingles"), "d1", "d2")
    some = every.filter("n_shingles > 0").join(runtime.small(known), ["d1", "d2"]).select("doc_id", "n_shingles", "component_id")
    return some.unionByName(every.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return components(runtime.documents(spark, sf_dir))

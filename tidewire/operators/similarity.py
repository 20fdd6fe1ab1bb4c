"""TF-IDF vectors, cosines, and the two greedy near-duplicate filters over a digest's candidates.

Greedy order matters: a row goes only if it is like an earlier row that stayed. Similar pairs come from blocks of
rows that go to all tasks one after the other, and the greedy fold runs over those pairs alone, one small list a
row, in rounds: a row without an unsettled earlier neighbour stays and beats its later ones.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as tx
from ..tables import BROADCAST_ROWS, drop, rows_of, small
from ..tables import tidied as written

#: Rows of a slab, whose inverted lists are met at once; pairs of rows summed at once; rows of a block of equal ones.
LIST_ROWS, CELL_PAIRS, COPY_ROWS = 2000, 1 << 17, 1000
#: Terms of a block of slabs, which tasks hold, about 30 bytes each.
BLOCK_TERMS = 1 << 22
#: Terms whose df tasks look up, 12 bytes each; all other terms of more than one row are joined.
FREQUENT = 1 << 22
#: Steps of df, two each time it doubles; buckets of rows by their norms; the part of a threshold that frequent terms may reach unseen.
STEPS, BUCKETS, SHARE = 66, 4096, 0.97


def term_counts(rows: DataFrame, key: str, text: Column | str) -> DataFrame:
    """key, term, n: how often each token occurs in each row."""
    return rows.select(key, F.explode(tx.tokenize(text)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))


def _of_owner(owner: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32))


def _counted(batches):
    """(k, tokens) to k, terms, ns, total: each row's distinct tokens and their counts."""
    for batch in batches:
        tokens = batch.column(1)
        coded = tokens.flatten().dictionary_encode()
        lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        size = max(1, len(coded.dictionary))
        of, n = np.unique(np.repeat(np.arange(len(batch)), lengths) * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        lists = [pa.ListArray.from_arrays(_of_owner(of // size, len(batch)), x) for x in (coded.dictionary.take(pa.array(of % size)), pa.array(n.astype(np.int32)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(lengths.astype(np.int64))], names=["k", "terms", "ns", "total"])


class _Weighed:
    """Rows of a table by key as lists of terms, with what is known of each term's df. A key of one row (most are) is counted where it
    is read; only those of more, and the null key, are gathered by a shuffle. Terms are known by 64-bit hashes."""

    def __init__(self, rows: DataFrame, key: str, text: Column | str | None = None, tokens: str | None = None, named: bool = False):
        """named: with the terms themselves, which only long() needs."""
        self.spark, self.kind = rows.sparkSession, rows.schema[key].dataType.simpleString()
        given = rows.select(F.col(key).alias("k"), (F.col(tokens) if tokens else tx.tokenize(text)).alias("tokens"))
        ids = written(rows.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n")).filter("n > 1 or k is null"))
        self.rows, again = rows.count(), small(ids.filter("k is not null").select("k")) if rows_of(ids) else None
        single = given if again is None else given.filter("k is not null").join(again, "k", "left_anti")
        lists = single.filter(F.size("tokens") > 0).mapInArrow(_counted, f"k {self.kind}, terms array<string>, ns array<int>, total long")
        lists = lists.withColumn("tids", F.transform("terms", lambda x: F.xxhash64(x)))
        self.lists = written(lists if named else lists.withColumn("terms", F.transform("terms", lambda x: F.lit(None).cast("string"))))
        self.merged = None
        if again is not None:
            several = given.join(small(ids.select(F.col("k").alias("_k"))), F.col("k").eqNullSafe(F.col("_k")), "left_semi")
            self.merged = written(several.select("k", F.explode("tokens").alias("term")).groupBy("k", "term").agg(F.count("*").cast("int").alias("n")).withColumn("tid", F.xxhash64("term")))
        every = self.lists.select(F.explode("tids").alias("tid"))
        every = every if self.merged is None else every.unionByName(self.merged.select("tid"))
        self.held = written(every.groupBy("tid").agg(F.count("*").alias("df")).filter("df > 1"))
        self.whole = rows_of(self.held) <= FREQUENT
        self.made = [ids, self.lists, self.held] + ([] if self.merged is None else [self.merged])
        top = (self.held if self.whole else self.held.orderBy(F.desc("df"), "tid").limit(FREQUENT)).select("tid", F.col("df").cast("int")).toArrow()  # FREQUENT rows at most
        tids, df = (top.column(i).to_numpy() for i in (0, 1))
        order = np.argsort(tids)
        self.known = self.spark.sparkContext.broadcast((tids[order], df[order], 1 if self.whole else 0))

    def _looked(self) -> DataFrame:
        """k, terms, ns, total, tids, dfs (0 where a term's df isn't known here)."""
        known = self.known

        def look(batches):
            tids, df, other = known.value
            for batch in batches:
                of = batch.column(4)
                flat = of.flatten().to_numpy()
                at = np.minimum(np.searchsorted(tids, flat), max(0, len(tids) - 1))
                found = np.where(tids[at] == flat, df[at], np.int32(other)) if len(tids) else np.full(len(flat), other, np.int32)
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(of).to_numpy(zero_copy_only=False))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32)))], names=[*batch.schema.names, "dfs"])

        return self.lists.select("k", "terms", "ns", "total", "tids").mapInArrow(look, f"k {self.kind}, terms array<string>, ns array<int>, total long, tids array<long>, dfs array<int>")

    def _weight(self, n: Column, total: Column, df: Column) -> Column:
        return (n / total) * (F.log((1.0 + self.rows) / (1.0 + df)) + 1.0)

    def _others(self) -> DataFrame | None:
        """k, term, w, df, tid of keys of more than one row."""
        if self.merged is None:
            return None
        mine = self.merged.filter("k is not null")
        total = written(mine.groupBy("k").agg(F.sum("n").alias("total")))
        self.made.append(total)
        rows = mine.join(small(total), "k").join(self.held, "tid", "left").withColumn("df", F.coalesce("df", F.lit(1)))
        return rows.select("k", "term", self._weight(F.col("n"), F.col("total"), F.col("df")).alias("w"), F.col("df").cast("long").alias("df"), "tid")

    def long(self) -> DataFrame:
        """k, term, w, df, tid."""
        each = self._looked().select("k", "total", F.explode(F.arrays_zip("terms", "ns", "tids", "dfs")).alias("x")).select("k", "total", F.col("x.terms").alias("term"), F.col("x.ns").alias("n"), F.col("x.tids").alias("tid"), F.col("x.dfs").cast("long").alias("df"))
        out = lambda rows: rows.select("k", "term", self._weight(F.col("n"), F.col("total"), F.col("df")).alias("w"), "df", "tid")
        if self.whole:
            found = out(each)
        else:
            rare = each.filter("df = 0").drop("df").join(self.held, "tid", "left").withColumn("df", F.coalesce("df", F.lit(1)))
            found = out(each.filter("df > 0")).unionByName(out(rare))
        found, others = found.filter("k is not null"), self._others()
        return found if others is None else found.unionByName(others)

    def arrays(self, plain: bool = False) -> DataFrame:
        """k, tids, dfs, ws: a row's vector; plain: all of its terms weigh 1. Who is done with it may drop _made."""
        if self.whole:
            weights = F.zip_with("ns", "dfs", lambda n, df: self._weight(n, F.col("total"), df))
            out, others = self._looked().filter("k is not null").select("k", "tids", "dfs", weights.alias("ws")), self._others()
            out = out if others is None else out.unionByName(_gathered(others))
        else:
            out = _gathered(self.long())
        out = out.withColumn("ws", F.transform("ws", lambda x: F.lit(1.0))) if plain else out
        out._made, out._known = self.made, self.known
        return out


def _gathered(each: DataFrame) -> DataFrame:
    """k, tids, dfs, ws of rows (k, tid, df, w)."""
    v = each.filter("k is not null").groupBy("k").agg(F.collect_list(F.struct("tid", F.col("df").cast("int").alias("df"), "w")).alias("v"))
    return v.select("k", F.col("v.tid").alias("tids"), F.col("v.df").alias("dfs"), F.col("v.w").alias("ws"))


def tfidf(rows: DataFrame, key: str, text: Column | str) -> DataFrame:
    """key, term, w = n / tokens * (ln((1 + rows) / (1 + rows with the term)) + 1), and df, the rows with the term. Texts are read
    once, and no term travels but those that neither FREQUENT ones nor single rows hold. Rows without a key count, but have no row here."""
    return _Weighed(rows, key, text, named=True).long().select(F.col("k").alias(key), "term", "w", "df")


def vectors(rows: DataFrame, key: str, text: Column | str) -> DataFrame:
    """The same weights as k, tids, dfs, ws: one row of lists a key, which cosine_pairs takes, too."""
    return _Weighed(rows, key, text).arrays()


def first_of_equal(rows: DataFrame, place: str, tokens: str) -> DataFrame:
    """Of rows with equal tokens (an array; none of them empty) the one of the least place, and all rows without any.
    The others are like it, and like whatever it is like, so a greedy filter never keeps them."""
    same = F.array_join(F.array_sort(tokens), " ")
    firsts = rows.filter(F.size(tokens) > 0).groupBy(F.xxhash64(same).alias("_h"), F.md5(same).alias("_m")).agg(F.min(place).alias(place)).select(place)
    return rows.filter(F.size(tokens) > 0).join(firsts, place, "left_semi").unionByName(rows.filter(F.size(tokens) == 0))


def _terms_by_df(dfs: np.ndarray) -> np.ndarray:
    """A term's step in the one order of all terms, two steps each time its df doubles; 0 for a term of one row."""
    return np.ceil(2 * np.log2(dfs)).astype(np.int64)


def _norms(owner: np.ndarray, steps: np.ndarray, ws: np.ndarray, rows: int) -> np.ndarray:
    """rows x STEPS: the norm of each row's terms beyond each step."""
    sums = np.bincount(owner * STEPS + steps, ws * ws, minlength=rows * STEPS).reshape(rows, STEPS)
    out = np.zeros((rows, STEPS))
    out[:, :-1] = np.sqrt(np.cumsum(sums[:, :0:-1], axis=1)[:, ::-1])
    return out


def _unit(arrays: DataFrame, threshold: float, whole: bool, known=None) -> DataFrame:
    """k, digest (equal for equal vectors), bucket (of rows with much or little of their norm in frequent terms), held, and if whole
    size (all terms), tids, dfs and ws (scaled) of the terms that other rows hold, too, frequent ones first; a term
    that tasks know by place goes by that. Rows whose held terms' norm is below threshold pair with none and are left out."""
    kind = arrays.schema["k"].dataType.simpleString()

    def scale(batches):
        for batch in batches:
            size = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            tids, df, w = (batch.column(i).flatten().to_numpy() for i in (1, 2, 3))
            owner = np.repeat(np.arange(len(batch)), size)
            order = np.lexsort((tids, -df, owner))
            tids, df, w = tids[order], df[order], w[order]
            edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            norm, digests = np.zeros(len(batch)), []
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                norm[i] = np.sqrt(w[a:b] @ w[a:b])
                digests.append(hashlib.blake2b(tids[a:b].tobytes() + w[a:b].tobytes(), digest_size=16).digest())
                if norm[i] > 0:
                    w[a:b] /= norm[i]
            norms = _norms(owner, _terms_by_df(np.maximum(df, 1)), w, len(batch))
            bucket = np.minimum((norms**2).sum(axis=1) * (BUCKETS / STEPS), BUCKETS - 1).astype(np.int32)
            mine = df > 1
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(bucket), pa.array(np.bincount(owner[mine], minlength=len(batch)))]
            if whole:
                tids = tids if known is None else _placed(tids, known.value[0])
                ends = _of_owner(owner[mine], len(batch))
                columns += [pa.array(size.astype(np.int32))] + [pa.ListArray.from_arrays(ends, pa.array(x[mine])) for x in (tids, df, w)]
            out = pa.RecordBatch.from_arrays(columns, names=["k", "digest", "bucket", "held", "size", "tids", "dfs", "ws"][: len(columns)])
            yield out.filter(pa.array((norm > 0) & (norms[:, 0] >= threshold - 1e-9)))

    more = ", size int, tids array<long>, dfs array<int>, ws array<double>" if whole else ""
    return arrays.filter("k is not null").mapInArrow(scale, f"k {kind}, digest binary, bucket int, held long{more}")


def _placed(tids: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, tids), max(0, len(known) - 1))
    return np.where(known[at] == tids, at, tids) if len(known) else tids


def _dealt(buckets: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(bucket, first slab, slabs) of (bucket, rows, terms), a slab being LIST_ROWS rows or so of like norms in frequent
    terms; and blocks of slabs (from, to) of BLOCK_TERMS terms or so."""
    placed, blocks, slab, rows, terms = [], [], -1, LIST_ROWS, 0
    held: list[int] = []
    for bucket, n, k in sorted(buckets):
        many = max(math.ceil(n / LIST_ROWS), math.ceil(4 * k / BLOCK_TERMS))
        if many > 1 or rows + n > LIST_ROWS or 4 * (terms + k) > BLOCK_TERMS:
            slab, rows, terms = len(held), 0, 0
            held += [0] * many
        placed.append((bucket, slab, many))
        rows, terms = (rows + n, terms + k) if many == 1 else (LIST_ROWS, 0)
        for i in range(slab, slab + many):
            held[i] += math.ceil(k / many)
    start, sum_ = 0, 0
    for i, k in enumerate(held):
        if i > start and sum_ + k > BLOCK_TERMS:
            blocks.append((start, i - 1))
            start, sum_ = i, 0
        sum_ += k
    return placed, blocks + ([(start, len(held) - 1)] if held else [])


class _Block:
    """Rows of some slabs by their terms, with which tasks compare all rows of these slabs and later ones."""

    def __init__(self, rows: pa.Table, threshold: float, cells: int):
        rows = rows.sort_by([("slab", "ascending"), ("k", "ascending")]).combine_chunks()
        self.cells, self.share = cells, SHARE * threshold
        self.threshold, self.keys, self.size = threshold, rows.column("k").combine_chunks(), rows.column("size").to_numpy()
        lists = rows.column("tids").combine_chunks()
        count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        self.edges = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        self.ids, term = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        self.direct = np.full(min(FREQUENT, int(self.ids.max(initial=-1)) + 1), -1, np.int32)
        few = (self.ids >= 0) & (self.ids < len(self.direct))
        self.direct[self.ids[few]] = np.flatnonzero(few)
        self.term, self.w = term.astype(np.int32), rows.column("ws").combine_chunks().flatten().to_numpy()
        owner, steps = np.repeat(np.arange(len(rows)), count), _terms_by_df(rows.column("dfs").combine_chunks().flatten().to_numpy())
        self.norms = _norms(owner, steps, self.w, len(rows))
        # terms of a row beyond a step are its first ones
        self.beyond = count[:, None] - np.cumsum(np.bincount(owner * STEPS + steps, minlength=len(rows) * STEPS).reshape(len(rows), STEPS), axis=1)
        self.slabs, self.firsts = np.unique(rows.column("slab").to_numpy(), return_index=True)
        self.firsts = np.append(self.firsts, len(rows))
        self.most = np.array([self.norms[a:b].max(axis=0) for a, b in zip(self.firsts[:-1], self.firsts[1:], strict=True)])
        self.lists = []
        for a, b in zip(self.firsts[:-1], self.firsts[1:], strict=True):
            own = slice(self.edges[a], self.edges[b])
            order = np.argsort(self.term[own], kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(self.term[own], minlength=len(self.ids)))]).astype(np.int32)
            self.lists.append((starts, (owner[own][order] - a).astype(np.int32), self.w[own][order]))

    def _found(self, ids: np.ndarray) -> np.ndarray:
        """The place of each id among the block's, -1 for others."""
        few = (ids >= 0) & (ids < len(self.direct))
        if few.all():
            return self.direct[ids]
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return np.where(self.ids[at] == ids, at, -1)

    def pairs(self, batch: pa.RecordBatch):
        """(place in the batch, place in the block, dot product) of pairs at or above the threshold, each pair once. Terms up to a step count
        for all pairs of a slab; what those beyond can add is at most the product of both rows' norms beyond it, which is
        below the threshold at a row's step, so pairs without a common term up to there are none."""
        lists = batch.column(batch.schema.get_field_index("tids"))
        count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        dfs, w = (batch.column(batch.schema.get_field_index(c)).flatten().to_numpy() for c in ("dfs", "ws"))
        owner, term, steps = np.repeat(np.arange(len(batch)), count), self._found(lists.flatten().to_numpy()), _terms_by_df(dfs)
        norms, slab = _norms(owner, steps, w, len(batch)), batch.column(batch.schema.get_field_index("slab")).to_numpy()
        common = np.flatnonzero(term >= 0)
        owner, term, steps, w = owner[common], term[common], steps[common], w[common]
        edges, dense = np.searchsorted(owner, np.arange(len(batch) + 1)), np.zeros(len(self.ids))
        for s, number in enumerate(self.slabs):
            first, n = self.firsts[s], self.firsts[s + 1] - self.firsts[s]
            starts, places, weights = self.lists[s]
            bound = norms * self.most[s]
            step = (bound <= self.share).argmax(axis=1)
            least = self.threshold - 1e-9 - bound[np.arange(len(batch)), step]
            used = np.flatnonzero((steps <= step[owner]) & (slab >= number)[owner])
            begin = starts[term[used]].astype(np.int64)
            length = starts[term[used] + 1] - begin
            used, begin, length = used[length > 0], begin[length > 0], length[length > 0]
            at = np.searchsorted(owner[used], np.arange(len(batch) + 1))
            many = max(1, self.cells // n)
            for lo in range(0, len(batch), many):
                hi = min(len(batch), lo + many)
                if at[lo] == at[hi]:
                    continue
                dots = self._dots(used[at[lo] : at[hi]], begin[at[lo] : at[hi]], length[at[lo] : at[hi]], owner, w, places, weights, lo, hi, n)
                y, x = np.divmod(np.flatnonzero(dots.reshape(hi - lo, n) >= least[lo:hi, None]), n)
                dot = dots[y * n + x]
                y, x = y + lo, x + first
                able = (dot + norms[y, step[y]] * self.norms[x, step[y]] >= self.threshold - 1e-9) & ((slab[y] > number) | pc.greater(batch.column(0).take(pa.array(y)), self.keys.take(pa.array(x))).to_numpy(zero_copy_only=False).astype(bool))
                y, x, dot = y[able], x[able], dot[able]
                if not len(y):
                    continue
                for a, b in zip(*(lambda f: (f, np.append(f[1:], len(y))))(np.flatnonzero(np.diff(y, prepend=-1))), strict=True):
                    own = slice(edges[y[a]], edges[y[a] + 1])
                    dense[term[own]] = w[own]
                    length_x = self.beyond[x[a:b], step[y[a]]]
                    upto = np.cumsum(length_x)
                    entry = np.arange(upto[-1]) + np.repeat(self.edges[x[a:b]] - upto + length_x, length_x)
                    dot[a:b] += np.bincount(np.repeat(np.arange(b - a), length_x), dense[self.term[entry]] * self.w[entry], minlength=b - a)
                    dense[term[own]] = 0.0
                alike = dot >= self.threshold - 1e-12
                yield y[alike], x[alike], dot[alike]

    def _dots(self, used, begin, length, owner, w, places, weights, lo, hi, n) -> np.ndarray:
        out = None
        upto = np.cumsum(length)
        cuts = np.append(np.unique(np.searchsorted(upto, np.arange(0, upto[-1], 4 * self.cells))), len(length))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = length[a:b]
            entry = np.arange(part.sum()) + np.repeat(begin[a:b] - np.cumsum(part) + part, part)
            cell = np.repeat((owner[used[a:b]] - lo) * n, part) + places[entry]
            found = np.bincount(cell, np.repeat(w[used[a:b]], part) * weights[entry], minlength=(hi - lo) * n)
            out = found if out is None else out + found
        return out


_HELD: dict = {}


def _block_at(path: str, threshold: float, cells: int) -> _Block:
    """The block whose rows lie in a folder that all tasks read; a worker holds the last one."""
    if path not in _HELD:
        _HELD.clear()
        files, at = pa.fs.FileSystem.from_uri(path)
        _HELD[path] = _Block(pq.read_table(at, filesystem=files, partitioning=None), threshold, cells)
    return _HELD[path]


def _met(rows: DataFrame, blocks: int, threshold: float, measure=None) -> DataFrame:
    """a, b (a < b), value of the pairs of rows (k, slab, size, tids, dfs, ws: a table written by block) at or above threshold, the dot
    product or what measure makes of it and both sizes, -1 for no pair. Tasks read one block after the other from the shared
    folder and compare it with the rows of its slabs and later ones: no pair is written or changes hands, and pairs are made when
    they are read, so disk doesn't grow with pairs, compared or found."""
    kind, cells = rows.schema["k"].dataType.simpleString(), CELL_PAIRS
    schema = f"x {kind}, y {kind}, value double"

    def of(number: int) -> DataFrame:
        path = f"{rows._path}/block={number}"

        def compare(batches):
            block = None
            for batch in batches:
                block = block or _block_at(path, threshold, cells)
                size = batch.column(batch.schema.get_field_index("size")).to_numpy()
                for y, x, dot in block.pairs(batch):
                    value = dot if measure is None else measure(dot, size[y].astype(np.int64), block.size[x].astype(np.int64))
                    some = np.flatnonzero(value >= 0)
                    yield pa.RecordBatch.from_arrays([block.keys.take(pa.array(x[some])), batch.column(0).take(pa.array(y[some])), pa.array(value[some])], names=["x", "y", "value"])

        return rows.filter(F.col("block") >= number).select("k", "slab", "size", "tids", "dfs", "ws").mapInArrow(compare, schema)

    found = rows.sparkSession.createDataFrame([], schema)
    if blocks:
        found = functools.reduce(DataFrame.unionByName, map(of, range(blocks)))
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "value")


def _expanded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """pairs (a, b, cosine) of classes' first rows as pairs of all their rows, and those within a class. classes: first, k. A class is dealt in
    blocks of rows, so a pair of large ones is many rows and none holds a class."""
    size = written(classes.groupBy("first").agg(F.count("*").alias("n")).filter("n > 1"))
    if not rows_of(size):
        return pairs
    dealt = classes.join(small(size), "first").withColumn("block", F.pmod(F.xxhash64("k"), F.ceil(F.col("n") / COPY_ROWS)))
    blocks = written(dealt.groupBy("first", "block").agg(F.collect_list("k").alias("ks")))
    one, other = (small(blocks).select(F.col("first").alias(c), F.col("ks").alias(f"k{c}")) for c in "ab")
    between = pairs.join(one, "a", "left").join(other, "b", "left").select(F.coalesce("ka", F.array("a")).alias("ka"), F.coalesce("kb", F.array("b")).alias("kb"), "cosine")
    between = between.select("cosine", F.explode("ka").alias("x"), "kb").select("cosine", "x", F.explode("kb").alias("y"))
    some, others = blocks.select("first", "block", F.col("ks").alias("ka")), blocks.select("first", F.col("block").alias("other"), F.col("ks").alias("kb"))
    cells = some.join(others, "first").filter("block <= other").repartition(F.xxhash64("first", "block", "other"))
    within = cells.select("block", "other", F.explode("ka").alias("x"), "kb").select("block", "other", "x", F.explode("kb").alias("y")).filter("block < other or x < y")
    both = between.select("x", "y", "cosine").unionByName(within.select("x", "y", F.lit(1.0).alias("cosine")))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "cosine")


def cosine_pairs(vectors: DataFrame, key: str, threshold: float, only: DataFrame | None = None, expand: bool = True, measure=None) -> DataFrame:
    """a, b (a < b), cosine of the pairs at or above threshold (above 0, 1 at most). vectors has key, term, w (and df), or is a table of
    vectors(), whose tables go when they are read. Rows with equal vectors are one until the end, when their pairs are made, a row
    each; without expand only pairs of each class's least key are. only: the keys (k) that count, if not all. Vectors are scaled
    first and dealt in slabs of rows with like norms in frequent terms; see _Block. measure: see _met. Terms are known by 64-bit hashes."""
    made, known = getattr(vectors, "_made", []), getattr(vectors, "_known", None)
    if "tids" not in vectors.columns:
        df = vectors if "df" in vectors.columns else vectors.join(vectors.groupBy("term").agg(F.count("*").alias("df")), "term")
        vectors = _gathered(df.select(F.col(key).alias("k"), F.xxhash64("term").alias("tid"), "df", "w"))
    named = written(_unit(vectors, threshold, False))
    counted = named if only is None else named.join(only, "k", "left_semi")
    firsts = written(counted.groupBy("digest").agg(F.min("k").alias("first")))
    gone = written(named.join(firsts, "digest", "left").filter("first is null or k <> first").select("k", "first"))
    sizes = named.join(small(gone).select("k"), "k", "left_anti").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("held").alias("terms")).collect()  # BUCKETS rows at most
    placed, blocks = _dealt([tuple(x) for x in sizes])
    spark = named.sparkSession
    slabs = F.broadcast(spark.createDataFrame(placed, "bucket int, first int, slabs int"))
    rows = _unit(vectors, threshold, True, known).join(small(gone).select("k"), "k", "left_anti").join(slabs, "bucket")
    rows = rows.select("k", (F.col("first") + F.pmod(F.xxhash64("k"), F.col("slabs"))).cast("int").alias("slab"), "size", "tids", "dfs", "ws")
    ends = F.broadcast(spark.createDataFrame([(slab, i) for i, (lo, hi) in enumerate(blocks) for slab in range(lo, hi + 1)], "slab int, block int"))
    rows = written(rows.join(ends, "slab"), "block")
    drop(named, firsts, *made)
    found = _met(rows, len(blocks), threshold, measure).withColumnRenamed("value", "cosine")
    if not expand:
        return found
    copies = gone if only is None else gone.join(only, "k", "left_semi")
    return _expanded(found, copies.select("first", "k").unionByName(copies.select("first", F.col("first").alias("k")).distinct()))


def jaccard_pairs(sets: DataFrame, key: str, threshold: float) -> DataFrame:
    """a, b (a < b), jaccard of the pairs of key, tokens (array) at or above threshold. Of sets of m and n tokens with c in common,
    c / (m + n - c) is at or above t only if c / sqrt(mn), their cosine, is at or above 2t / (1 + t)."""

    def measure(dot, m, n):
        c = np.rint(dot * np.sqrt(m * n))
        value = c / (m + n - c)
        return np.where(value >= threshold, value, -1.0)

    vectors = _Weighed(sets.select(key, F.array_distinct("tokens").alias("tokens")), key, tokens="tokens").arrays(plain=True)
    return cosine_pairs(vectors, key, 2 * threshold / (1 + threshold) - 1e-9, measure=measure).withColumnRenamed("cosine", "jaccard")


def greedy_keep(ranked: DataFrame, pairs: DataFrame, key: str, place: str) -> DataFrame:
    """ranked (key, place) without rows that are paired with an earlier row that stays. A chain in which each row
    is like the next settles two links a round, so rounds follow the longest such chain, not the rows."""
    at = ranked.select(F.col(key).alias("k"), F.col(place).alias("place"))
    ends = pairs.select("a", "b").join(at.select(F.col("k").alias("a"), F.col("place").alias("pa")), "a").join(at.select(F.col("k").alias("b"), F.col("place").alias("pb")), "b")
    first = F.col("pa") < F.col("pb")
    edges = written(ends.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("early"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("late")))
    beaten = None
    while rows_of(edges):
        # rows without an open earlier neighbour stay, and beat all their later ones
        stays = edges.select("early").distinct().join(edges.select(F.col("late").alias("early")).distinct(), "early", "left_anti")
        lost = written(edges.join(small(written(stays)), "early", "left_semi").select("late").distinct())
        beaten = lost if beaten is None else beaten.union(lost)
        gone = lost.select(F.col("late").alias("early"))
        gone = F.broadcast(gone) if rows_of(lost) <= BROADCAST_ROWS else gone
        open_late = edges.join(small(lost), "late", "left_anti")
        edges = written(open_late.join(gone, "early", "left_anti"))
    return ranked if beaten is None else ranked.join(beaten.distinct().withColumnRenamed("late", key), key, "left_anti")

"""Removing lines that repeat across documents, up to a few edits.

Lines of MIN_CHARS code points or more (blanks at the ends don't count) are alike if their edit
distance is at most EDITS. By the segment-partition join: a line is split into EDITS + 1 segments, of
which any alike line holds one unedited, within a few places of where it stood; so the segments of a
line (with its length) and the substrings at those places of lines up to EDITS longer (probing with
the shorter length) meet in a bucket. Candidates are verified by a banded bit-parallel edit distance.
Of each class of lines linked so, the first line by (doc_id, digest of the text, line number) stays.
Shorter lines, of EXACT_CHARS code points or more, are alike if they are equal: two edits in so few points,
and segments of so few, would tie lines that have little else in common.

Shuffled are hashes and places, and text only of candidate lines and of documents that lose lines. Copies
of one line are one item, so a line may make up any share of all rows.

Defined results: null text counts as empty and stays null; blank lines always stay; rows equal in
doc_id and text keep the same lines; a document may lose all its lines and then has an empty text;
an empty table gives no rows; columns other than text and n_chars are handed on unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linking, runtime, textscan

MIN_CHARS, EXACT_CHARS, EDITS = 40, 1, 2
#: Groups of letters by whose counts pairs in large buckets are ruled out.
LETTERS = 16
#: Code points of lines that are hashed at a time.
SLICE = 1 << 19
_BLANK = " \t\n\r\x0b\x0c"


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of edits + 1 segments as even as can be, longer ones last."""
    parts = edits + 1
    short, longer = length // parts, length % parts
    sizes = [short] * (parts - longer) + [short + 1] * longer
    return list(zip(np.cumsum([0, *sizes[:-1]]).tolist(), sizes, strict=True))


def probes(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment, start, length of the substring): where a line of this length may hold a
    segment of an alike line that isn't longer. A line's own segments are among them."""
    out = []
    for d in range(edits + 1):
        if length - d < edits + 1:
            break
        for i, (at, size) in enumerate(segments(length - d, edits)):
            low, high = max(at - i, at + d - (edits - i)), min(at + i, at + d + (edits - i))
            out += [(length - d, i, p, size) for p in range(max(0, low), min(high, length - size) + 1)]
    return out


def line_keys(lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the line, bucket key) for all lines' probes, by prefix sums of a polynomial hash. All
    lines of 2 * (edits + 1)**2 points or more have as many probes, at the same offsets from a segment."""
    owners, keys, parts = [], [], edits + 1
    lengths = np.array([len(x) for x in lines], np.int64)
    start = 0
    while start < len(lines):
        end = max(start + 1, start + int(np.searchsorted(np.cumsum(lengths[start:]), SLICE, side="right")))
        n, size = lengths[start:end], int(lengths[start:end].sum())
        points = np.frombuffer("".join(lines[start:end]).encode("utf-32-le", "surrogatepass"), np.uint32)
        up, down = textscan._power_tables(size + 1)
        total = np.zeros(size + 1, np.uint64)
        first = np.cumsum(n) - n
        with np.errstate(over="ignore"):
            np.cumsum((points + np.uint64(1)) * up[:size], out=total[1:])

            def add(mine, of, i, at, width):
                a = first[mine] + at
                keys.append((total[a + width] - total[a]) * down[a] + textscan.mix((of * parts + i).astype(np.uint64) + np.uint64(0x51ED27)))
                owners.append(mine + start)

            even = np.flatnonzero(n >= 2 * parts**2)
            for d in range(parts):
                of = n[even] - d
                short, longer = of // parts, of % parts
                for i in range(parts):
                    at, width = i * short + np.maximum(0, i - (parts - longer)), short + (i >= parts - longer)
                    for p in range(max(-i, d - edits + i), min(i, d + edits - i) + 1):
                        add(even, of, i, at + p, width)
            for k in np.flatnonzero(n < 2 * parts**2):
                for of, i, at, width in probes(int(n[k]), edits):
                    add(np.array([k]), np.array([of]), i, np.array([at]), width)
        start = end
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(owners), textscan.mix(np.concatenate(keys)).view(np.int64)


def within(some: list[str], others: list[str], edits: int) -> np.ndarray:
    """Whether each pair's edit distance is at most edits. Bit d of level e says that with e edits the
    text's first j points reach the pattern's first j + d - edits; all pairs step together."""
    result = np.zeros(len(some), bool)
    todo: list[tuple[int, str, str]] = []
    for i, (p, t) in enumerate(zip(some, others, strict=True)):
        if p == t:
            result[i] = True
        elif abs(len(p) - len(t)) <= edits:
            k, most = 0, min(len(p), len(t))
            step = most
            while step:  # a common start doesn't count: find it by halving steps
                if p[k : k + step] == t[k : k + step] and k + step <= most:
                    k += step
                else:
                    step //= 2
            todo.append((i, p[k:], t[k:]))
    todo.sort(key=lambda x: len(x[2]))
    while todo:
        lanes = max(1, min(len(todo), (1 << 21) // (len(todo[-1][2]) + 1)))
        part, todo = todo[-lanes:], todo[:-lanes]
        ids, patterns, texts = np.array([x[0] for x in part]), [x[1] for x in part], [x[2] for x in part]
        n, m = np.array([len(x) for x in patterns]), np.array([len(x) for x in texts])
        columns = int(m.max())
        pattern, text = np.full((columns + 3 * edits + 1, lanes), 0x7FFFFFF0, np.uint32), np.full((columns + 1, lanes), 0x7FFFFFF1, np.uint32)
        for i in range(lanes):
            pattern[edits : edits + n[i], i] = np.frombuffer(patterns[i].encode("utf-32-le", "surrogatepass"), np.uint32)
            text[: m[i], i] = np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), np.uint32)
        full = np.uint64((1 << (2 * edits + 1)) - 1)
        one, zero = np.uint64(1), np.uint64(edits)
        levels = [np.full(lanes, sum(1 << (edits + d) for d in range(e + 1)), np.uint64) for e in range(edits + 1)]
        goal = (one << (zero + (n - m).astype(np.int64).astype(np.uint64))) if edits else np.full(lanes, 1, np.uint64)
        for j in range(columns + 1):
            ended = m == j
            if ended.any():
                result[ids[ended & ((levels[-1] & goal) != 0)]] = True
            live = (m > j) & (levels[-1] != 0)
            if j % 16 == 0 and not live.all():
                if not live.any():
                    break
                ids, m, goal, pattern, text, levels = ids[live], m[live], goal[live], pattern[:, live], text[:, live], [x[live] for x in levels]
            if j == columns:
                break
            match = np.zeros(len(ids), np.uint64)
            for d in range(2 * edits + 1):
                match |= (pattern[j + d] == text[j]).astype(np.uint64) << np.uint64(d)
            before, above = levels, None
            levels = []
            for e in range(edits + 1):
                now = before[e] & match
                if e:
                    now = (now | before[e - 1] | (before[e - 1] >> one) | (above << one)) & full
                levels.append(now)
                above = now
    return result


def _long_lines(text: str | None, least: int):
    for number, line in enumerate((text or "").split("\n")):
        line = line.strip(_BLANK)
        if len(line) >= least:
            yield number, line


def _sources(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("digest"))


def _hash(line: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, digest, number, h1, h2: every line of min_chars or more, by two hashes."""
    runtime.prepare(docs.sparkSession, 500)

    def lines(batches):
        for batch in batches:
            rows = [(i, number, *_hash(line)) for i, text in enumerate(batch.column(1)) for number, line in _long_lines(text.as_py(), min_chars)]
            at, number, h1, h2 = zip(*rows, strict=True) if rows else ([], [], [], [])
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array(number, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["doc_id", "digest", "number", "h1", "h2"])

    return _sources(docs).mapInArrow(runtime.frugal(lines), "doc_id long, digest long, number int, h1 long, h2 long")


def line_buckets(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS) -> DataFrame:
    """key, id: the buckets of every long line, named by its first hash; once a batch."""
    runtime.prepare(docs.sparkSession, 500)

    def keys(batches):
        for batch in batches:
            distinct = list({line for text in batch.column(1) for _, line in _long_lines(text.as_py(), min_chars)})
            owners, found = line_keys(distinct, edits)
            ids = np.array([_hash(x)[0] for x in distinct], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(ids[owners])], names=["key", "id"])

    return _sources(docs).mapInArrow(runtime.frugal(keys), "key long, id long")


def line_classes(docs: DataFrame, places: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS) -> DataFrame:
    """id, label: the class of each line that has a link. Lines of equal first and unequal second hash
    have none, so that a clash of hashes never joins lines."""
    clashing = places.groupBy("h1").agg(F.min("h2").alias("x"), F.max("h2").alias("y")).filter("x < y").select(F.col("h1").alias("id"))
    clashing = runtime.written(clashing)
    buckets = line_buckets(docs, min_chars, edits)
    if not runtime.is_empty(clashing):
        buckets = buckets.join(runtime.small(clashing), "id", "left_anti").select("key", "id")

    def payload(ids: DataFrame) -> DataFrame:
        wanted = runtime.written(ids)
        near = runtime.small(wanted)
        at = places.join(near, F.col("h1") == F.col("id"), "left_semi").groupBy("h1").agg(F.min("doc_id").alias("doc_id"))
        of = runtime.written(at.select(F.col("doc_id").alias("at")).distinct())

        def lines(batches):
            for batch in batches:
                found = {_hash(line)[0]: line for text in batch.column(1) for _, line in _long_lines(text.as_py(), min_chars)}
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string())], names=["id", "payload"])

        held = _sources(docs).join(runtime.small(of), F.col("doc_id").eqNullSafe(F.col("at")), "left_semi").mapInArrow(runtime.frugal(lines), "id long, payload string")
        return held.join(near, "id", "left_semi").dropDuplicates(["id"])

    def vectors(payloads: DataFrame) -> DataFrame:
        names = ["id", *[f"v{i}" for i in range(LETTERS)]]

        def count(batches):
            for batch in batches:
                rows = [np.bincount(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) % LETTERS, minlength=LETTERS) for x in batch.column(1).to_pylist()]
                table = np.array(rows, np.int32).reshape(-1, LETTERS)
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(table[:, i]) for i in range(LETTERS)]], names=names)

        return payloads.select("id", "payload").mapInArrow(runtime.frugal(count), "id long, " + ", ".join(f"{x} int" for x in names[1:]))

    # an edit takes one letter and brings one at most
    return linking.classes(buckets, payload, lambda column: column.to_pylist(), lambda a, b: within(a, b, edits), vectors=vectors, most_apart=2 * edits)


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS, exact_chars: int = EXACT_CHARS) -> DataFrame:
    """doc_id, digest, removed: the numbers of the lines that go, for documents that lose some."""
    places = runtime.written(occurrences(docs, min(min_chars, exact_chars)))
    labels = line_classes(docs, places, min_chars, edits)
    named = places.join(runtime.small(labels), F.col("h1") == F.col("id"), "left")
    named = named.select("doc_id", "digest", "number", F.coalesce("label", "h1").alias("x"), F.when(F.col("label").isNull(), F.col("h2")).otherwise(0).alias("y"))
    more = runtime.written(named.groupBy("x", "y").count().filter("count > 1").select("x", "y"))
    repeated = runtime.written(named.join(runtime.small(more), ["x", "y"], "left_semi"))
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "digest", "number")
    firsts = runtime.written(repeated.groupBy("x", "y").agg(F.min(place).alias("first")))
    again = repeated.join(runtime.small(firsts), ["x", "y"]).filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest")) & (F.col("number") == F.col("first.number"))))
    return again.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set("number")).alias("removed"))


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS, exact_chars: int = EXACT_CHARS) -> DataFrame:
    """docs with the removed lines gone from text (n_chars follows, if there), and two columns, in place of any of
    these names: lines_before and lines_removed (numbers from 0)."""
    docs = docs.drop("lines_before", "lines_removed")
    gone = runtime.written(removed_lines(docs, min_chars, edits, exact_chars))
    own, of, digest, removed = runtime.unused(docs, "own_digest", "gone_id", "gone_digest", "gone_lines")
    keyed = docs.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    both = keyed.join(runtime.small(gone.toDF(of, digest, removed)), F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.col(own) == F.col(digest)), "left")
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(removed, i)), "\n")
    out = both.withColumn("lines_before", F.coalesce(F.size(lines), F.lit(0))).withColumn("text", F.when(F.col(removed).isNull(), F.col("text").cast("string")).otherwise(left))
    out = out.withColumn("lines_removed", F.coalesce(removed, F.array().cast("array<int>"))).drop(own, of, digest, removed)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def query(spark, sf_dir: str) -> DataFrame:
    """One row a document: its lines, those that go, and the digest of what is left."""
    docs = runtime.documents(spark, sf_dir).select("doc_id", "text")
    return deduplicated(docs).select("doc_id", F.col("lines_before").alias("n_lines"), F.size("lines_removed").alias("n_removed"), F.array_join(F.col("lines_removed").cast("array<string>"), ",").alias("removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("left_sha256"))

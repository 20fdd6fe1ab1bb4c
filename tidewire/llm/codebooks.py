"""Product codes of vectors: a codebook for each of PARTS positions by Lloyd's rounds, with Elkan's bounds.

Components are whole numbers, floor(SCALE * x). Every row carries, from round to round in a written table,
its code, an upper bound on each part's distance to its entry, and one lower bound for each entry. When entries move, upper
bounds grow by the movement of the part's own entry and lower bounds shrink by each entry's. An entry is
passed over only where the triangle inequality shows that it is strictly farther (the upper bound is below
its lower bound, or below half the distance between the two entries); all others are measured in whole
numbers, ties to the lower index. Bounds are rounded outward, so results are those of measuring everything.

A round reads the table once to assign and, of the new one, only codes and components to add up; tasks
hand on sums, and only the codebooks come to the driver, whose size doesn't follow the rows.

Defined results: a vector that is null or holds a null or non-finite component is dropped, and so is one
whose length isn't that of the least vec_id's; part p of a length n are the places from n*p div 8 on; fewer than 16 rows
make so many entries; null vec_ids count as greatest, rows that repeat a vec_id are rows of their own (the
lesser vector first); an empty table gives no rows; components beyond 62 bits and errors beyond 64 raise an
error; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
_CHUNK = 2048


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x: whole components of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = lambda x: x.cast("double") * F.lit(float(scale))
    whole = lambda x: F.when(F.abs(scaled(x)) < 2.0**62, F.floor(scaled(x))).otherwise(F.raise_error(F.lit("a component beyond 62 bits")).cast("long"))
    return vectors.filter(F.col("embedding").isNotNull()).filter(finite).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform("embedding", whole).alias("x"))


def cuts(length: int, parts: int = PARTS) -> list[int]:
    return [length * i // parts for i in range(parts + 1)]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows, in 64 bits where they fit and in unbounded whole numbers else."""
    most = max((max(int(x.max()), -int(x.min())) for x in (a, b) if x.size), default=0)
    if (2 * most) ** 2 * max(1, a.shape[-1]) >= 1 << 63:
        a, b = a.astype(object), b.astype(object)
    d = a - b
    return (d * d).sum(-1) if d.shape[-1] else np.zeros(d.shape[:-1], np.int64)


def _up(x) -> np.ndarray:
    return np.nextafter(np.asarray(x, float) * (1 + 1e-12), np.inf).astype(np.float32) * np.float32(1 + 1e-6)


def _down(x) -> np.ndarray:
    return np.maximum(np.asarray(x, float) * (1 - 1e-12), 0).astype(np.float32) * np.float32(1 - 1e-6)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float))


class Books:
    """The entries of every part, half the distances between them (rounded down), and how far each came."""

    def __init__(self, entries: list[np.ndarray], before: Books | None = None):
        self.entries = entries
        self.half = [_down(_root(squared(e[:, None], e[None])) / 2) for e in entries]
        self.moved = [_up(_root(squared(e, b))) for e, b in zip(entries, before.entries, strict=True)] if before else None

    def text(self) -> str:
        return ",".join(str(int(v)) for part in self.entries for entry in part for v in entry)

    def assign(self, part: int, x: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """Brings code, upper and lower of one part up to date, in place; how many distances that took."""
        entries, half = self.entries[part], self.half[part]
        if self.moved:
            upper[:] = _up(upper + self.moved[part][code].astype(float))
            lower[:] = _down(lower - self.moved[part][None].astype(float))
        near = (upper[:, None] >= lower) & (upper[:, None] >= half[code])
        near[np.arange(len(code)), code] = False
        rows = np.flatnonzero(near.any(1))
        own = code[rows]
        best = squared(x[rows], entries[own])
        upper[rows] = _up(_root(best))
        lower[rows, own] = _down(_root(best))
        near, at, taken = near[rows], own.copy(), len(rows)
        for k in range(len(entries)):
            reach = upper[rows]
            some = np.flatnonzero(near[:, k] & (reach >= lower[rows, k]) & (reach >= half[at, k]))
            if not len(some):
                continue
            found = squared(x[rows[some]], np.broadcast_to(entries[k], (len(some), entries.shape[1])))
            lower[rows[some], k] = _down(_root(found))
            won = (found < best[some]) | ((found == best[some]) & (k < at[some]))
            taken += len(some)
            moved = some[won]
            if best.dtype != found.dtype:
                best = best.astype(object)
            at[moved], best[moved] = k, found[won]
            upper[rows[moved]] = _up(_root(found[won]))
        code[rows] = at
        return taken


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel(), kind))


def assigned(rows: DataFrame, books: Books, length: int) -> DataFrame:
    """rows (vec_id, label, x and, but in the first round, code, upper, lower) with all three brought up to date."""
    at, n, parts = cuts(length, len(books.entries)), len(books.entries[0]), len(books.entries)
    first = "code" not in rows.columns

    def run(batches):
        for batch in batches:
            x, size = _matrix(batch.column(2), length, np.int64), len(batch)
            code = np.zeros((size, parts), np.int8) if first else _matrix(batch.column(3), parts, np.int8)
            upper = np.full((size, parts), np.inf, np.float32) if first else _matrix(batch.column(4), parts, np.float32)
            lower = (np.zeros((size, parts * n), np.float32) if first else _matrix(batch.column(5), parts * n, np.float32)).reshape(size, parts, n)
            for p in range(parts):
                own, low = code[:, p].astype(np.int64), lower[:, p]
                reach = upper[:, p].copy()
                books.assign(p, x[:, at[p] : at[p + 1]], own, reach, low)
                code[:, p], upper[:, p] = own, reach
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _lists(code, pa.int8()), _lists(upper, pa.float32()), _lists(lower.reshape(size, -1), pa.float32())], names=["vec_id", "label", "x", "code", "upper", "lower"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(runtime.frugal(run), f"vec_id long, label {kind}, x array<long>, code array<tinyint>, upper array<float>, lower array<float>")


def moved(rows: DataFrame, books: Books, length: int) -> Books:
    """Each entry replaced by the floor of its parts' mean; unused ones stay."""
    at, parts, n = cuts(length, len(books.entries)), len(books.entries), len(books.entries[0])

    def add(batches):
        totals, counts = np.zeros((n, length), object), np.zeros((parts, n), np.int64)
        for batch in batches:
            code, x = _matrix(batch.column(0), parts, np.int8), _matrix(batch.column(1), length, np.int64)
            wide = bool(x.size) and max(int(x.max()), -int(x.min())) * len(x) >= 1 << 62
            for p in range(parts):
                counts[p] += np.bincount(code[:, p], minlength=n)
                part = x[:, at[p] : at[p + 1]].astype(object) if wide else x[:, at[p] : at[p + 1]]
                for k in np.unique(code[:, p]):
                    totals[k, at[p] : at[p + 1]] += part[code[:, p] == k].sum(0)
        place = [(p, k, i) for p in range(parts) if counts[p].any() for k in np.flatnonzero(counts[p]) for i in range(at[p], at[p + 1])]
        if place:
            yield pa.RecordBatch.from_arrays([pa.array([int(k) for _, k, _ in place], pa.int32()), pa.array([i for _, _, i in place], pa.int32()), pa.array([Decimal(int(totals[k, i])) for _, k, i in place], pa.decimal128(38, 0)), pa.array([int(counts[p, k]) for p, k, _ in place], pa.int64())], names=["entry", "place", "total", "n"])

    sums = rows.select("code", "x").mapInArrow(runtime.frugal(add), "entry int, place int, total decimal(38,0), n long")
    found = {(r.place, r.entry): int(r.total) // r.n for r in sums.groupBy("entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()}  # as many rows as the books have numbers
    after = [np.array([[found.get((i, k), int(e[k, i - at[p]])) for i in range(at[p], at[p + 1])] for k in range(len(e))], np.int64).reshape(e.shape) for p, e in enumerate(books.entries)]
    return Books(after, books)


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Books | None]:
    """(vec_id, label, code (array), error; the codebooks)."""
    spark = vectors.sparkSession
    runtime.prepare(spark, _CHUNK)
    rows = runtime.written(quantised(vectors, scale))
    kind = rows.schema["label"].dataType.simpleString()
    seeds = [r.x for r in rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()]
    if not seeds:
        return spark.createDataFrame([], f"vec_id long, label {kind}, code array<tinyint>, error long"), None
    length = len(seeds[0])
    at, seeds = cuts(length, parts), np.array([s for s in seeds if len(s) == length], np.int64).reshape(-1, length)
    if len(seeds) < entries:  # others among the least have another length
        seeds = np.array([r.x for r in rows.filter(F.size("x") == length).orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()], np.int64).reshape(-1, length)
    books = Books([seeds[:, a:b] for a, b in zip(at, at[1:], strict=False)])
    state = runtime.written(assigned(rows.filter(F.size("x") == length), books, length))
    for _ in range(rounds):
        books = moved(state, books, length)
        after = runtime.written(assigned(state, books, length))
        runtime.drop(state)
        state = after

    def measure(batches):
        for batch in batches:
            x, code = _matrix(batch.column(2), length, np.int64), _matrix(batch.column(3), parts, np.int8)
            error = sum(squared(x[:, at[p] : at[p + 1]], books.entries[p][code[:, p].astype(np.int64)]).astype(object) for p in range(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array([int(e) for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return state.select("vec_id", "label", "x", "code").mapInArrow(runtime.frugal(measure), f"vec_id long, label {kind}, code array<tinyint>, error long"), books


def query(spark, sf_dir: str) -> DataFrame:
    found, books = coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = runtime.written(found)
    total = runtime.written(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    both = rows.join(runtime.small(total), F.col("label").eqNullSafe(F.col("of")))
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")
    return both.select("vec_id", code.alias("code"), "error", "label_error", F.lit(hashlib.sha256(books.text().encode()).hexdigest() if books else "").alias("codebooks_sha256"))


def _oracle() -> str:
    """Every round as a table expression of its own."""
    distance = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    steps = [f"""v as materialized (select vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) x from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    p as materialized (select vec_id, part, x[len(x) * part // {PARTS} + 1 : len(x) * (part + 1) // {PARTS}] x from v, (select unnest(range({PARTS})) part)),
    c0 as materialized (select part, row_number() over (partition by part order by vec_id) - 1 e, x from p qualify e < {ENTRIES})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"a{i} as materialized (select vec_id, part, any_value(p.x) x, min({distance} * {ENTRIES} + e) m from p join c{i} c using (part) group by 1, 2)")
        if i < ROUNDS:
            steps.append(f"""s{i} as (select part, e, i, sum(y)::bigint s, count(*) n from (select part, m % {ENTRIES} e, unnest(x) y, generate_subscripts(x, 1) i from a{i}) group by all),
    c{i + 1} as materialized (select part, e, coalesce(n.x, c.x) x from c{i} c left join (select part, e, list((s - ((s % n) + n) % n) // n order by i) x from s{i} group by 1, 2) n using (part, e))""")
    return f"""with {', '.join(steps)},
    f as (select vec_id, string_agg(printf('%02x', m % {ENTRIES}), '' order by part) code, sum(m // {ENTRIES})::bigint error from a{ROUNDS} group by 1),
    h as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, e)) codebooks_sha256 from c{ROUNDS})
    select vec_id, code, error, sum(error) over (partition by label)::bigint label_error, codebooks_sha256 from f join v using (vec_id), h"""


ORACLE_SQL = _oracle()

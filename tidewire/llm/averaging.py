"""Networks that several tasks have trained from one start, averaged where they lie.

A parameter's mean is weighted by the root of what its squared gradients grew by, so what few trainers met isn't held
back by the others; the squared gradients' sums grow by the mean. A network travels in CHUNKS rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNKS = 16
SCHEMA = "chunk int, trainer long, n long, part binary, grown binary, weight binary"


def rows(trainer: int, flat: np.ndarray, grown: np.ndarray) -> pa.Table:
    """Of one trainer: its parameters, and by how much their squared gradients grew."""
    parts, more = ([x.tobytes() for x in np.array_split(y, CHUNKS)] for y in (flat, grown))
    return pa.table({"chunk": pa.array(np.arange(CHUNKS, dtype=np.int32)), "trainer": pa.repeat(pa.scalar(trainer, pa.int64()), CHUNKS), "n": pa.array(np.ones(CHUNKS, np.int64)), "part": pa.array(parts, pa.binary()), "grown": pa.array(more, pa.binary()), "weight": pa.nulls(CHUNKS, pa.binary())})


def _average(table: pa.Table) -> pa.Table:
    """A trainer's own row holds 32-bit numbers and no weight; a mean's row 64-bit ones, so levels don't matter."""
    total = grown = weight = 0
    for r in sorted(table.to_pylist(), key=lambda r: r["trainer"]):
        kind = np.float32 if r["weight"] is None else np.float64
        part, more = (np.frombuffer(r[k], kind).astype(float) for k in ("part", "grown"))
        own = np.sqrt(np.maximum(more, 0)) + 1e-12 if r["weight"] is None else np.frombuffer(r["weight"])
        if r["weight"] is None:
            part = own * part
        total, grown, weight = total + part, grown + more, weight + own
    sums = {k: pa.array([x.tobytes()], pa.binary()) for k, x in (("part", total), ("grown", grown), ("weight", weight))}
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "trainer": table.column("of").slice(0, 1), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()), **sums})


def mean(found: DataFrame, trainers: int, at_once: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(the mean parameters, what the squared gradients grew by on average) of rows() of so many trainers; None without any.
    A task averages about at_once of them, in as many levels as their number needs."""
    while True:
        trainers = -(-trainers // at_once)
        found = found.withColumn("of", F.pmod(F.xxhash64("trainer"), F.lit(trainers))).groupBy("chunk", "of").applyInArrow(_average, SCHEMA)
        if trainers == 1:
            break
    got = sorted(found.collect(), key=lambda r: r.chunk)  # CHUNKS rows
    if not got:
        return None
    part, grown, weight = (np.concatenate([np.frombuffer(r[k]) for r in got]) for k in ("part", "grown", "weight"))
    return part / weight, grown / got[0].n

"""Toxicity by a convolutional text classifier trained in numpy.

A word (a run of letters and digits, A-Z folded) has hashed embeddings: of itself and of its beginnings
of PREFIXES bytes. Each hashed feature holds one number that starts as its log-odds among toxic and
other documents, and DIMS learned ones that start at random. Filters over 1, 2 and 3 words run along
the whole text; the maximum of each over the text goes to a logistic layer, whose output is scaled
to a probability. Thresholds are calibrated for each language on labelled rows that training didn't see.

Labelled rows are dealt by hash into three parts, and all rows of each are used: document frequencies for the
log-odds come from the first; filters, embeddings and the logistic layer are trained on the second; scale and
thresholds come from the third. Training goes in EPOCHS passes. Trainers of about TRAINER_ROWS rows or TRAINER_CHARS characters (so their
number grows with the labels) start every other pass from one network, learn from their rows and are averaged (averaging.py);
few rows have one trainer. Scale and thresholds are sums that Spark takes over the third part's scores: a language's
threshold is the best of all that lie between two of BINS equal ranges of scores. No rows come to the driver.

Defined results: null and empty texts get the score of a text without words; labels that are null don't
count, the highest of a doc_id's labels does; without labelled documents of both classes the score is 0 and
nothing is rejected; a language without enough labels has DEFAULT_THRESHOLD; repeated rows stay; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import averaging, runtime, textscan

PREFIXES, BITS, DIMS, WIDTHS, FILTERS = (3, 4, 5, 6, 7, 8, 9), 17, 4, (1, 2, 3), 8
TRAINER_ROWS, TRAINER_CHARS, EPOCHS, RATE, LEAST_POSITIVES = 1500, 8_000_000, 6, 0.02, 20
#: Between two averages of several trainers.
PASSES = 2
#: Models that a task averages; ranges of scores between which a threshold can lie.
AVERAGED, BINS = 32, 10_000
DEFAULT_THRESHOLD = 0.3


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words x features bucket numbers, bounds by text); bucket 0 is no feature."""
    parts, bounds = textscan.word_parts(column, prefixes=PREFIXES, letters=True)
    shift = np.uint64(64 - BITS)
    return np.stack([np.where(h == 0, 0, np.maximum(h >> shift, 1)).astype(np.int32) for h in parts], 1), bounds


@dataclass
class Network:
    odds: np.ndarray  # by bucket
    learned: np.ndarray  # bucket x DIMS
    kernels: list[np.ndarray] = field(default_factory=list)  # a width's: width x inputs x FILTERS
    biases: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray = None
    scale: tuple[float, float, float] = (1.0, 0.0, 1.0)  # slope, shift, and 0 where nothing could be learned
    squares: np.ndarray | None = None  # Adagrad's sums, as flat() has the parameters

    @classmethod
    def start(cls, odds: np.ndarray) -> "Network":
        rng = np.random.default_rng(17)
        inputs = 1 + len(PREFIXES) + DIMS
        learned = rng.normal(0, 0.05, (len(odds), DIMS)).astype(np.float32)
        learned[0] = 0
        kernels = [np.abs(rng.normal(0, 0.2, (w, inputs, FILTERS))).astype(np.float32) / w for w in WIDTHS]
        return cls(odds.astype(np.float32), learned, kernels, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.full(len(WIDTHS) * FILTERS + 1, 0.1, np.float32))

    def vectors(self, buckets: np.ndarray) -> np.ndarray:
        rest = self.learned[buckets[:, 0]]
        for i in range(1, buckets.shape[1]):
            rest = rest + self.learned[buckets[:, i]]
        return np.concatenate([self.odds[buckets], rest], 1)

    def pooled(self, buckets: np.ndarray, bounds: np.ndarray, where: bool = False):
        """Maxima by text (texts x filters), and with where the words at which they begin."""
        n = len(bounds) - 1
        best, at = np.zeros((n, len(WIDTHS) * FILTERS), np.float32), np.zeros((n, len(WIDTHS) * FILTERS), np.int64)
        some = np.flatnonzero(np.diff(bounds) > 0)
        if not len(some):
            return best, at
        x = self.vectors(buckets)
        left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(x))
        for k, (w, kernel, bias) in enumerate(zip(WIDTHS, self.kernels, self.biases, strict=True)):
            y = x @ kernel[0] + bias
            for j in range(1, w):
                more = x @ kernel[j]
                more[left <= j - 1] = 0
                y[: len(y) - j] += np.where((left > j)[: len(y) - j, None], more[j:], 0)
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            best[some, part] = np.maximum.reduceat(y, bounds[some], axis=0)
            if where:
                for i in some:
                    at[i, part] = bounds[i] + y[bounds[i] : bounds[i + 1]].argmax(0)
        return best, at

    def logits(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        best, _ = self.pooled(buckets, bounds)
        return np.maximum(best, 0) @ self.out[:-1] + self.out[-1]

    def scores(self, column: pa.Array) -> np.ndarray:
        slope, shift, known = self.scale
        return known / (1 + np.exp(-np.clip(slope * self.logits(*features(column)).astype(float) + shift, -50, 50)))

    def _arrays(self) -> list[np.ndarray]:
        return [self.odds, self.learned, *self.kernels, *self.biases, self.out]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self._arrays()])

    def flat_squares(self) -> np.ndarray:
        """Of no training: what Adagrad's sums start from."""
        if self.squares is not None:
            return self.squares
        return np.concatenate([np.full(x.size, 1e-4 if x is self.odds or x is self.learned else 1e-6, np.float32) for x in self._arrays()])

    def _cut(self, flat: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([x.size for x in self._arrays()])
        return [part.reshape(x.shape) for x, part in zip(self._arrays(), np.split(flat, ends[:-1]), strict=True)]

    def load(self, flat: np.ndarray, squares: np.ndarray) -> "Network":
        odds, learned, *rest, out = [x.astype(np.float32) for x in self._cut(flat)]
        return Network(odds, learned, rest[: len(WIDTHS)], rest[len(WIDTHS) :], out, self.scale, squares.astype(np.float32))

    def train(self, buckets: np.ndarray, bounds: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> None:
        """Stochastic gradients with per-parameter steps (Adagrad), text by text in minibatches."""
        rng, n = np.random.default_rng(seed), len(labels)
        names = ["out", *[("kernels", i) for i in range(len(WIDTHS))], *[("biases", i) for i in range(len(WIDTHS))]]
        value = lambda k: self.out if k == "out" else getattr(self, k[0])[k[1]]
        self.squares = self.flat_squares().copy()
        square_odds, square_learned, *rest = self._cut(self.squares)  # views
        squares = dict(zip([*names[1:], "out"], rest, strict=True))
        for _ in range(epochs):
            order = rng.permutation(n)
            for start in range(0, n, 32):
                grads = {k: np.zeros_like(value(k)) for k in names}
                touched: list[tuple[np.ndarray, np.ndarray]] = []
                for i in order[start : start + 32]:
                    a, b = bounds[i], bounds[i + 1]
                    if a == b:
                        continue
                    best, at = (x[0] for x in self.pooled(buckets[a:b], np.array([0, b - a]), True))
                    hidden = np.maximum(best, 0)
                    error = 1 / (1 + np.exp(-(hidden @ self.out[:-1] + self.out[-1]))) - labels[i]
                    grads["out"][:-1] += error * hidden
                    grads["out"][-1] += error
                    down = error * self.out[:-1] * (best > 0)
                    x = self.vectors(buckets[a:b][np.unique(np.clip(at[:, None] + np.arange(max(WIDTHS)), 0, b - a - 1))])
                    place = {p: k for k, p in enumerate(np.unique(np.clip(at[:, None] + np.arange(max(WIDTHS)), 0, b - a - 1)))}
                    back = np.zeros_like(x)
                    for f in np.flatnonzero(down):
                        k, c = divmod(f, FILTERS)
                        grads[("biases", k)][c] += down[f]
                        for j in range(WIDTHS[k]):
                            if at[f] + j < b - a:
                                p = place[at[f] + j]
                                grads[("kernels", k)][j, :, c] += down[f] * x[p]
                                back[p] += down[f] * self.kernels[k][j, :, c]
                    touched.append((buckets[a:b][list(place)], back))
                for k in names:
                    squares[k] += grads[k] ** 2
                    value(k)[...] -= RATE * grads[k] / np.sqrt(squares[k])
                for rows, back in touched:
                    for i in range(rows.shape[1]):
                        np.add.at(square_odds, rows[:, i], back[:, i] ** 2)
                        np.subtract.at(self.odds, rows[:, i], 0.2 * RATE * back[:, i] / np.sqrt(square_odds[rows[:, i]]))
                        np.add.at(square_learned, rows[:, i], back[:, -DIMS:] ** 2)
                        np.subtract.at(self.learned, rows[:, i], RATE * back[:, -DIMS:] / np.sqrt(square_learned[rows[:, i]]))
                self.odds[0] = self.learned[0] = 0


def calibrated(table: DataFrame) -> tuple[float, float, float]:
    """Slope and shift by logistic regression (Newton's method) over all rows of table (y, logit); each step's sums are Spark's."""
    theta, x, y = np.array([1.0, 0.0]), F.col("logit"), F.col("y")
    for _ in range(40):
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), float(theta[0]) * x + float(theta[1])))
        p = 1 / (1 + F.exp(-z))
        rows = table.select(x.alias("x"), (p - y).alias("d"), (p * (1 - p)).alias("v"))
        g1, g0, h11, h10, h00 = rows.agg(F.sum(F.col("x") * F.col("d")), F.sum("d"), F.sum(F.col("v") * F.col("x") * F.col("x")), F.sum(F.col("v") * F.col("x")), F.sum("v")).first()
        step = np.linalg.solve(np.array([[h11, h10], [h10, h00]]) + 1e-3 * np.eye(2), np.array([g1, g0]) + 1e-3 * (theta - [1, 0]))
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-3), float(theta[1]), 1.0


def best_thresholds(table: DataFrame) -> dict[str, float]:
    """Where each language's F1 is highest over all rows of table (lang, y, score): in the middle of the empty ranges between two
    of BINS ranges of scores. The windows see a row for each range and language."""
    ranges = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int")
    counted = table.filter("lang is not null").groupBy("lang", ranges.alias("bin")).agg(F.sum("y").alias("t"), F.count("*").alias("n"))
    down, whole = Window.partitionBy("lang").orderBy(F.desc("bin")), Window.partitionBy("lang")
    sums = counted.select("lang", "bin", F.lead("bin", 1, -1).over(down).alias("next"), F.sum("t").over(down).alias("hit"), F.sum("n").over(down).alias("over"), F.sum("t").over(whole).alias("positive"), F.sum("n").over(whole).alias("rows"))
    enough = sums.filter((F.col("positive") >= LEAST_POSITIVES) & (F.col("rows") - F.col("positive") >= LEAST_POSITIVES))
    f1 = 2 * F.col("hit") / (F.col("over") + F.col("positive"))
    best = enough.groupBy("lang").agg(F.max(F.struct(f1.alias("f1"), "bin", "next")).alias("best"))
    return {r.lang: min(0.9, max(0.1, (r.best.bin + r.best.next + 1) / (2 * BINS))) for r in best.orderBy("lang").collect()}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    network: Network
    thresholds: dict[str, float]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labels (doc_id, toxic) of docs (doc_id, text, and lang where thresholds go by it)."""
    spark = docs.sparkSession
    runtime.prepare(spark, 300)
    marks = labels.select(F.col("doc_id").cast("long").alias("_id"), (F.col("toxic").cast("int") > 0).cast("int").alias("y")).filter(F.col("y").isNotNull() & F.col("_id").isNotNull()).groupBy("_id").agg(F.max("y").alias("y"))
    marks = runtime.written(marks.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "_id"), F.lit(3)).cast("int")).withColumn("h", F.xxhash64(F.lit("draw"), "_id")))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    sizes = {(r.part, r.y): r["count"] for r in marks.groupBy("part", "y").count().collect()}
    odds = np.zeros(1 << BITS)
    unknown = Network.start(odds)
    unknown.scale = (1.0, 0.0, 0.0)
    if not all(sizes.get((p, y)) for p in range(3) for y in (0, 1)):
        return Model(unknown, {})

    def frequencies(batches):
        count = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            buckets, bounds = features(batch.column(1))
            for i, y in enumerate(batch.column(2).to_pylist()):
                count[int(y > 0)][np.unique(buckets[bounds[i] : bounds[i + 1]])] += 1
        some = np.flatnonzero(count.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[0][some]), pa.array(count[1][some])], names=["bucket", "other", "toxic"])

    first = texts.join(runtime.small(marks.filter("part = 0").select("_id", "y")), "_id").select("_id", "text", "y")
    table = first.mapInArrow(runtime.frugal(frequencies), "bucket int, other long, toxic long").groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()  # 2**BITS rows at most
    n0, n1 = sizes[0, 0], sizes[0, 1]
    t, o = (table.column(c).to_numpy() for c in ("toxic", "other"))
    rate = (t + o) / (n0 + n1)
    prior = 2.0  # pulls rare features to no evidence
    odds[table.column("bucket").to_numpy()] = np.log((t + prior * rate) / (n1 + prior) + 1e-9) - np.log((o + prior * rate) / (n0 + prior) + 1e-9)
    odds = np.clip(odds, -4, 6)
    odds[0] = 0
    network = Network.start(odds)

    def part(p: int) -> DataFrame:
        return texts.join(runtime.small(marks.filter(F.col("part") == p).select("_id", "y", "h")), "_id")

    network = _trained(part(1), network)
    if network is None:  # the labels' documents aren't there
        return Model(unknown, {})
    held = spark.sparkContext.broadcast(network)

    def answered(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in (1, 2)], pa.array(held.value.logits(*features(batch.column(0))).astype(float))], names=["lang", "y", "logit"])

    answers = runtime.written(part(2).select("text", "lang", "y").mapInArrow(runtime.frugal(answered), "lang string, y int, logit double"))
    held.unpersist()
    if answers.select("y").distinct().count() < 2:
        return Model(unknown, {})
    network.scale = calibrated(answers)
    slope, shift, _ = network.scale
    return Model(network, best_thresholds(answers.withColumn("score", 1 / (1 + F.exp(-(slope * F.col("logit") + shift))))))


def _trained(rows: DataFrame, network: Network) -> Network | None:
    """network after EPOCHS passes over all rows (_id, text, y, h); None where a class has no rows."""
    spark = rows.sparkSession
    dealt = runtime.written(rows.select("_id", "text", "y", "h"))
    positive, n, chars = dealt.agg(F.sum("y"), F.count("*"), F.sum(F.length("text"))).first()
    if not positive or positive == n:
        return None
    trainers = max(-(-n // TRAINER_ROWS), -(-(chars or 0) // TRAINER_CHARS))
    dealt_rows = dealt.withColumn("trainer", F.pmod("h", F.lit(trainers))).drop("h")
    passes = PASSES if trainers > 1 else EPOCHS  # one trainer has nothing to average
    for i in range(EPOCHS // passes):
        held = spark.sparkContext.broadcast((network, network.flat_squares()))

        def train(table: pa.Table) -> pa.Table:
            table = table.sort_by([("y", "ascending"), ("_id", "ascending"), ("text", "ascending")]).combine_chunks()
            start, squares = held.value  # noqa: B023
            mine = start.load(start.flat(), squares)
            mine.train(*features(table.column("text").chunk(0)), (table.column("y").to_numpy() > 0).astype(float), passes, 5 + i)  # noqa: B023
            return averaging.rows(table.column("trainer")[0].as_py(), mine.flat(), mine.flat_squares() - squares)

        found = averaging.mean(dealt_rows.repartition(trainers, "trainer").groupBy("trainer").applyInArrow(train, averaging.SCHEMA), trainers, AVERAGED)
        held.unpersist()
        network = network.load(found[0], network.flat_squares() + found[1])
    runtime.drop(dealt)
    network.squares = None  # scoring needs none
    return network


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1), threshold (of the row's lang) and toxic (score >= threshold), in place of
    columns of these names; other columns are handed on."""
    spark, docs = docs.sparkSession, docs.drop("score", "threshold", "toxic")
    runtime.prepare(spark, 300)
    held = spark.sparkContext.broadcast(model.network)
    whole, = runtime.unused(docs, "whole_text")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            text, rest = batch.column(names.index(whole)), [i for i, n in enumerate(names) if n != whole]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in rest], pa.array(held.value.scores(text))], names=[*[names[i] for i in rest], "score"])

    found = docs.withColumn(whole, F.col("text").cast("string")).mapInArrow(runtime.frugal(run), schema)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    threshold = F.lit(DEFAULT_THRESHOLD)
    for name, value in model.thresholds.items():
        threshold = F.when(lang == name, F.lit(value)).otherwise(threshold)
    return found.withColumn("threshold", threshold).withColumn("toxic", F.col("score") >= F.col("threshold"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = runtime.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score(docs.select("doc_id", "text", "lang"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "threshold")

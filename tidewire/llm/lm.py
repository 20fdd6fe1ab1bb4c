"""Scoring documents by a gated recurrent language model, trained in numpy.

Tokens are words (A-Z folded) and an end. Counts of all training documents' tokens make the vocabulary
and the unigram base. The network's symbols are the most frequent words and TAILS tail symbols, by
the last two bytes, for all other words; a tail word's probability is its symbol's times its smoothed share
of the counts below that symbol, so any text has a proper probability. The softmax is factored: classes
of symbols, then symbols in a class. Biases start at the unigram probabilities.

Training: truncated backpropagation over windows, state carried on and reset where a document begins (or
a piece of PIECE_TOKENS of a longer one). All tokens of all training documents are learned from once, dealt
by hash to trainers of about TRAINER_TOKENS, so the trainers' number grows with the input. Several trainers go
in ROUNDS, each round's tokens GROWTH times those of the one before: all start from one network, learn from
their shares of the round, and are averaged. A parameter's mean is weighted by the root of what its squared
gradients grew by, so a word that few trainers met isn't held back by the others; Adagrad's sums grow by the
mean. The last round's outcome is the mean of a trainer's parameters over its second half. Averaging happens
where the models lie, chunk by chunk, in as many levels as their number needs.

Texts are read twice: to count words, and to encode all documents for training and scoring.

Scoring: whole documents side by side, window after window with the state carried, to the end.

Words are known by 64-bit hashes of their bytes (no words are shuffled or kept; among a billion distinct words about
one pair in 40 corpora would share a hash). A frequent word's count is looked up in a broadcast table of fixed
size; others are joined, counted within each document first.

Defined results: null text counts as empty (one end); a null doc_id trains; repeated rows stay and count
each; with no training documents all counts are 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import averaging, runtime, textscan

SYMBOLS, TAILS, CLASSES, EMBED, STATE = 4096, 64, 64, 16, 24
#: Streams side by side at most, steps of a window, updates of a trainer at least (else fewer streams), Adagrad's rate.
LANES, WINDOW, UPDATES, RATE = 256, 16, 400, 0.4
TRAINER_TOKENS, PIECE_TOKENS = 4_000_000, 1 << 16
#: Rounds of several trainers, and how much each is larger than the one before.
ROUNDS, GROWTH = 8, 1.3
#: Models that a task averages.
AVERAGED = 64
#: Words of the broadcast table; entries at which a task's counter is handed on.
FREQUENT, COUNTER_ENTRIES = 131_072, 2_000_000
#: Documents scored side by side, and states of a window.
SIDE_BY_SIDE, WINDOW_STATES = 2000, 1 << 13
END, END_HASH = b"\n", np.uint64(1)  # no word holds it


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def tail_symbols(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of words in raw, by their last two bytes."""
    last, second = raw[ends - 1].astype(np.int64), np.where(ends - starts > 1, raw[np.maximum(ends, 2) - 2], 0).astype(np.int64)
    last, second = (np.where((x >= 65) & (x <= 90), x | 32, x) for x in (last, second))
    return (7 * last + second) % TAILS


def word_counts(docs: DataFrame) -> DataFrame:
    """h, u, c: the hash of each word of all texts, its tail symbol and its count. The end counts as a word."""
    runtime.prepare(docs.sparkSession, 500)

    def merged(parts: list) -> tuple:
        h, u, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        found = np.unique(h)
        at = np.searchsorted(found, h)
        total, tails = np.bincount(at, c, len(found)).astype(np.int64), np.zeros(len(found), np.int32)
        tails[at] = u
        return found, tails, total

    def rows(parts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (lambda h, u, c: (h.view(np.int64), u, c))(*merged(parts))], names=["h", "u", "c"])

    def count(batches):
        parts, entries, texts = [], 0, 0
        for batch in batches:
            raw, offsets = textscan.text_bytes(batch.column(0))
            texts += len(batch)
            for (h,), starts, ends in textscan.word_slices(raw, offsets):
                found, n = np.unique(h, return_counts=True)
                tails = np.zeros(len(found), np.int32)
                tails[np.searchsorted(found, h)] = tail_symbols(raw, starts, ends)
                parts.append((found, tails, n))
                entries += len(found)
                if entries > COUNTER_ENTRIES:
                    parts = [merged(parts)]
                    entries = len(parts[0][0])
                    if 2 * entries > COUNTER_ENTRIES:
                        yield rows(parts)
                        parts, entries = [], 0
        if texts:
            yield rows([*parts, (np.array([END_HASH], np.uint64), np.zeros(1, np.int32), np.array([texts]))])

    return docs.select(F.col("text").cast("string")).mapInArrow(runtime.frugal(count), "h long, u int, c long").groupBy("h").agg(F.min("u").alias("u"), F.sum("c").alias("c"))


class Frequent:
    """The frequent words' ranks, by hash. A word itself can be asked for, too."""

    def __init__(self, hashes: np.ndarray):
        self.rank = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.rank]

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """-1 for words that aren't frequent."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.rank[at], np.int32(-1))

    def __getitem__(self, word: bytes) -> int:
        return int(self.ranks(np.array([END_HASH], np.uint64) if word == END else textscan.word_hashes(pa.array([word]))[0])[0])


@dataclass
class Vocabulary:
    words: Frequent
    symbols: np.ndarray  # of each rank
    base: np.ndarray  # log10 of the base of each
    share: np.ndarray  # log10 of each one's share of its symbol
    counts: np.ndarray  # of each symbol
    tails: np.ndarray  # TAILS x (sum of counts, words)
    total: int
    size: int


def vocabulary(counted: DataFrame) -> Vocabulary:
    """From a written table of word_counts."""
    own = SYMBOLS - TAILS
    total, size = counted.agg(F.sum("c"), F.count("*")).first()
    total, top = total or 0, counted.orderBy(F.desc("c"), "h").limit(FREQUENT).select("h", "u", "c").toArrow()
    h, u, c = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy().astype(np.int64), top.column(2).to_numpy().astype(np.int64)
    at = np.flatnonzero(h == END_HASH)  # the end is a symbol of its own, whatever its count
    ends = c[at].sum() if len(at) else sum(r.c for r in counted.filter(F.col("h") == int(END_HASH)).collect())
    h, u, c = (np.concatenate([[x], np.delete(y, at)]) for x, y in ((END_HASH, h), (0, u), (ends, c)))
    h = h.astype(np.uint64)
    tails = np.zeros((TAILS, 2), np.int64)
    for r in counted.filter(F.col("h") != int(END_HASH)).groupBy("u").agg(F.sum("c").alias("t"), F.count("*").alias("v")).collect():  # TAILS rows
        tails[r.u] = r.t, r.v
    for k, x in enumerate((c[1:own], np.ones(len(c[1:own])))):
        tails[:, k] -= np.bincount(u[1:own], x, TAILS).astype(np.int64)
    symbols = np.where(np.arange(len(h)) < own, np.arange(len(h)) + TAILS, u).astype(np.int32)
    counts = np.zeros(SYMBOLS, np.int64)
    counts[:TAILS] = tails[:, 0]
    counts[symbols[:own]] = c[:own]
    share = np.zeros(len(h))
    below = tails[symbols[own:]]
    share[own:] = np.log10((c[own:] + 0.5) / (below[:, 0] + 0.5 * (below[:, 1] + 1)))
    base = np.log10((c + 0.5) / (total + 0.5 * (size + 1)))
    return Vocabulary(Frequent(h), symbols, base, share, counts, tails, total, size)


class Network:
    """A gated recurrent unit with a class-factored softmax. Symbol s is in class s % CLASSES."""

    def __init__(self, counts: np.ndarray):
        rng = np.random.default_rng(3)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        per = SYMBOLS // CLASSES
        p = (counts.astype(float) + 0.5).reshape(per, CLASSES).T
        self.squares = None  # Adagrad's sums, by parameter
        self.p = {
            "embed": normal(SYMBOLS, EMBED, scale=0.3), "wx": normal(EMBED, 3 * STATE, scale=0.25), "wh": normal(STATE, 3 * STATE, scale=0.2),
            "b": np.zeros(3 * STATE, np.float32), "wc": normal(STATE, CLASSES, scale=0.02), "bc": np.log(p.sum(1) / p.sum()).astype(np.float32),
            "ws": normal(CLASSES, STATE, per, scale=0.02), "bs": np.log(p / p.sum(1, keepdims=True)).astype(np.float32),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()])

    def flat_squares(self) -> np.ndarray:
        return np.concatenate([self.squares[k].ravel() if self.squares else np.full(x.size, 1e-3, x.dtype) for k, x in self.p.items()])

    def _cut(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        ends = np.cumsum([x.size for x in self.p.values()])
        return {k: part.reshape(x.shape).astype(np.float32) for (k, x), part in zip(self.p.items(), np.split(flat, ends[:-1]), strict=True)}

    def load(self, flat: np.ndarray, squares: np.ndarray | None = None) -> "Network":
        if squares is not None:
            self.squares = self._cut(squares)
        self.p = self._cut(flat)
        return self

    def step(self, x: np.ndarray, h: np.ndarray):
        """x: the input's part of the gates (with bias)."""
        u = h @ self.p["wh"]
        zr = x[:, : 2 * STATE] + u[:, : 2 * STATE]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :STATE], zr[:, STATE:]
        n = r * u[:, 2 * STATE :]
        n += x[:, 2 * STATE :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, z, r, n, u

    def _exp(self, y: np.ndarray, weights: str, biases: str) -> tuple[np.ndarray, np.ndarray]:
        """exp(y) in place, and what was taken off each row first. States lie within 1, so weights and biases
        bound y; only where the bound is too high for the kind of number, the row's maximum goes."""
        w = self.p[weights]
        if np.abs(w).sum(-2).max() + np.abs(self.p[biases]).max() < 60:
            return np.exp(y, out=y), np.zeros(1, y.dtype)
        top = y.max(1)
        y -= top[:, None]
        return np.exp(y, out=y), top

    def _by_class(self, h: np.ndarray, of: np.ndarray):
        """(order of the rows by class, edges, classes met, their states, exp of the logits within, what was taken off)."""
        order = np.argsort(of.astype(np.uint8), kind="stable")
        edges = np.searchsorted(of[order], np.arange(CLASSES + 1))
        states, met = h[order], np.flatnonzero(np.diff(edges))
        y = np.empty((len(order), SYMBOLS // CLASSES), h.dtype)
        for c in met:
            a, b = edges[c], edges[c + 1]
            np.dot(states[a:b], self.p["ws"][c], out=y[a:b])
            y[a:b] += self.p["bs"][c]
        return order, edges, met, states, y

    def log_probability(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logs, for states (n x STATE)."""
        logits = h @ self.p["wc"]
        logits += self.p["bc"]
        of, place = targets % CLASSES, targets // CLASSES
        rows = np.arange(len(of))
        out = logits[rows, of]
        y, top = self._exp(logits, "wc", "bc")
        out -= np.log(y.sum(1)) + top
        order, _, _, _, q = self._by_class(h, of)
        within = q[rows, place[order]]
        q, top = self._exp(q, "ws", "bs")
        within -= np.log(q.sum(1)) + top
        out[order] += within
        return out

    def train(self, given: np.ndarray, stream: np.ndarray, starts: np.ndarray, updates: int = UPDATES, every: int = 16) -> None:
        """One pass over a stream of targets, each after its given symbol; starts marks where a state begins. Adagrad;
        the outcome is the mean of the parameters over the second half, taken every so many windows (0: the last ones)."""
        lanes = max(1, min(LANES, len(stream) // (WINDOW * updates)))
        per = -(-len(stream) // lanes)  # lanes overlap a little rather than leave an end out
        if not len(stream):
            return
        at = np.linspace(0, len(stream) - per, lanes).astype(np.int64)
        self.squares = squares = self.squares or {k: np.full_like(x, 1e-3) for k, x in self.p.items()}
        room = {k: np.empty_like(x) for k, x in self.p.items()}
        h, mean, taken = np.zeros((lanes, STATE), np.float32), {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        for t in range(0, per, WINDOW):
            rows = np.arange(t, min(per, t + WINDOW))[:, None] + at[None, :]
            grads, met, h = self._gradients(given[rows], stream[rows], starts[rows], h)
            for k, g in grads.items():
                if k == "embed":  # of the rows that were met alone
                    squared = squares[k][met] + g * g
                    squares[k][met] = squared
                    self.p[k][met] -= RATE * g / np.sqrt(squared)
                    continue
                of, step = squares[k], room[k]
                np.multiply(g, g, out=step)
                of += step
                np.sqrt(of, out=step)
                np.divide(g, step, out=step)
                step *= RATE
                self.p[k] -= step
            if every and t >= per // 2 and t // WINDOW % every == 0:
                taken += 1
                for k, x in self.p.items():
                    mean[k] += x
        if taken:
            self.p = {k: x / np.float32(taken) for k, x in mean.items()}

    def gradients(self, xs, ts, fs, h):
        """Of the mean loss of a window (steps x lanes), and the state after it."""
        g, met, h = self._gradients(xs, ts, fs, h)
        embed = np.zeros_like(self.p["embed"])
        embed[met] = g["embed"]
        return g | {"embed": embed}, h

    def _gradients(self, xs, ts, fs, h):
        """The same, with embed's gradient for the symbols met alone, and these."""
        p, steps, lanes = self.p, len(xs), xs.shape[1]
        kind = p["wh"].dtype
        e = p["embed"][xs]
        gates = e.reshape(-1, EMBED) @ p["wx"]
        gates += p["b"]
        gates = gates.reshape(steps, lanes, 3 * STATE)
        before, z, r, n, hs = (np.empty((steps, lanes, STATE), kind) for _ in range(5))
        un = np.empty((steps, lanes, STATE), kind)
        begins = fs.any(1)
        for t in range(steps):
            if begins[t]:
                h = np.where(fs[t][:, None], kind.type(0), h)
            before[t] = h
            h, z[t], r[t], n[t], u = self.step(gates[t], h)
            un[t] = u[:, 2 * STATE :]
            hs[t] = h
        flat, targets = hs.reshape(-1, STATE), ts.ravel()
        of, place = targets % CLASSES, targets // CLASSES
        rows, scale = np.arange(len(of)), kind.type(1 / len(of))
        y = flat @ p["wc"]
        y += p["bc"]
        y, _ = self._exp(y, "wc", "bc")
        y *= (scale / y.sum(1))[:, None]
        y[rows, of] -= scale
        g = {"wc": flat.T @ y, "bc": y.sum(0)}
        dh = y @ p["wc"].T
        order, edges, met, states, q = self._by_class(flat, of)
        q, _ = self._exp(q, "ws", "bs")
        q *= (scale / q.sum(1))[:, None]
        q[rows, place[order]] -= scale
        g["bs"], g["ws"] = np.zeros_like(p["bs"]), np.empty_like(p["ws"])
        g["bs"][met] = np.add.reduceat(q, edges[met])
        back = np.empty_like(states)
        for c in range(CLASSES):
            a, b = edges[c], edges[c + 1]
            np.dot(states[a:b].T, q[a:b], out=g["ws"][c])
            if a < b:
                np.dot(q[a:b], p["ws"][c].T, out=back[a:b])
        dh[order] += back
        dh = dh.reshape(steps, lanes, STATE)
        to_n, to_z, to_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), un * r * (1 - r)
        du, dx_n, carry = np.empty((steps, lanes, 3 * STATE), kind), np.empty((steps, lanes, STATE), kind), np.zeros((lanes, STATE), kind)
        to_h = p["wh"].T.copy()
        for t in reversed(range(steps)):
            carry += dh[t]
            dn = np.multiply(carry, to_n[t], out=dx_n[t])
            np.multiply(carry, to_z[t], out=du[t, :, :STATE])
            np.multiply(dn, to_r[t], out=du[t, :, STATE : 2 * STATE])
            np.multiply(dn, r[t], out=du[t, :, 2 * STATE :])
            carry *= z[t]
            carry += du[t] @ to_h
            if begins[t]:
                carry[fs[t]] = 0
        flat_du = du.reshape(-1, 3 * STATE)
        g["wh"] = before.reshape(-1, STATE).T @ flat_du
        du[:, :, 2 * STATE :] = dx_n
        g["wx"], g["b"] = e.reshape(-1, EMBED).T @ flat_du, flat_du.sum(0)
        order = np.argsort(xs.ravel().astype(np.uint16), kind="stable")
        at, first = np.unique(xs.ravel()[order], return_index=True)
        g["embed"] = np.add.reduceat((flat_du @ p["wx"].T)[order], first, axis=0)
        return g, at, h

    def score(self, texts: list[np.ndarray], first: int) -> np.ndarray:
        """Log10 probability of each list of targets, side by side, longest first."""
        result, order = np.zeros(len(texts)), sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order])
        gates = self.p["embed"] @ self.p["wx"] + self.p["b"]  # of any symbol
        whole = np.concatenate([*(texts[i] for i in order), np.zeros(0, np.int32)])
        firsts = np.cumsum(lengths) - lengths
        h, at = np.zeros((len(texts), STATE), np.float32), 0
        last = np.full(len(texts), first, np.int32)
        while at < lengths[0] if len(lengths) else False:
            n = int(np.searchsorted(-lengths, -at, side="left"))  # those longer than at
            window = int(min(max(8, WINDOW_STATES // n), lengths[0] - at))
            targets = np.zeros((window, n), np.int32)
            own = np.minimum(lengths[:n] - at, window)
            place = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            from_ = np.repeat(firsts[:n] + at, own) + place
            targets[place, np.repeat(np.arange(n), own)] = whole[from_]
            given = np.concatenate([last[None, :n], targets[:-1]])
            h, states = h[:n], np.empty((window, n, STATE), np.float32)
            for t in range(window):
                live = int(np.searchsorted(-lengths[:n], -(at + t), side="left"))
                states[t, :live] = self.step(gates[given[t, :live]], h[:live] if t == 0 else states[t - 1, :live])[0]
            alive = np.arange(window)[:, None] < own[None, :]
            logs = np.zeros((window, n))
            logs[alive] = self.log_probability(states[alive], targets[alive])
            result[:n] += logs.sum(0)
            h, last, at = states[-1], targets[-1], at + window
        out = np.empty(len(texts))
        out[order] = result / np.log(10)
        return out


def _symbols(words: list[bytes], known: Frequent, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each word and the end, ranks with -1 for words that aren't frequent)."""
    raw, offsets = textscan.text_bytes(pa.array([b" ".join(words)]))
    found = [(known.ranks(h), tail_symbols(raw, starts, ends)) for (h,), starts, ends in textscan.word_slices(raw, offsets)]
    ranks, tails = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    return np.append(np.where(ranks < 0, tails, symbols[ranks]), symbols[known[END]]).astype(np.int32), ranks


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids (symbols, 16 bits each), and what the frequent words alone give: n_known, base,
    share; tail, n, u are the other words, their counts and symbols. Texts are read here once, for
    training and scoring."""
    runtime.prepare(docs.sparkSession, 500)
    held = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        words = held.value
        end, end_known = words.words[END], int(words.total > 0)
        symbols, base, share = (np.append(x, x.dtype.type(0)) for x in (words.symbols.astype(np.int16), words.base, words.share))  # of rank -1: none
        for batch in batches:
            raw, offsets = textscan.text_bytes(batch.column(1))
            n, ids, rest = len(batch), [], [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
            sizes, known, bases, shares = np.zeros(n, np.int64), np.full(n, end_known), np.full(n, base[end]), np.zeros(n)
            for (h,), starts, ends in textscan.word_slices(raw, offsets):
                of, ranks, tails = np.searchsorted(offsets, starts, side="right") - 1, words.words.ranks(h), tail_symbols(raw, starts, ends)
                ids.append(np.where(ranks < 0, tails, symbols[ranks]).astype(np.int16))
                for total, x in ((sizes, None), (known, ranks >= 0), (bases, base[ranks]), (shares, share[ranks])):
                    total += np.bincount(of, x, n).astype(total.dtype)
                at = np.flatnonzero(ranks < 0)
                rest.append((of[at], h[at], tails[at]))
            ends = np.cumsum(sizes)
            line = np.insert(np.concatenate([*ids, np.zeros(0, np.int16)]), ends, symbols[end])  # an end after each text
            ends += np.arange(1, n + 1)
            of, h, u = (np.concatenate(x) for x in zip(*rest, strict=True))
            order = np.lexsort((h, of))
            of, h, u = of[order], h[order], u[order]
            first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (h[1:] != h[:-1]))[: len(of)])
            lists = pa.array(np.searchsorted(of[first], np.arange(n + 1)).astype(np.int32))
            tail = [pa.ListArray.from_arrays(lists, pa.array(x)) for x in (h[first].view(np.int64), np.diff(np.append(first, len(of))).astype(np.int32), u[first].astype(np.int32))]
            tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.append(0, 2 * ends)), pa.py_buffer(line)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in (sizes + 1, known, bases, shares)], tokens, *tail], names=["doc_id", "n_tokens", "n_known", "base", "share", "ids", "tail", "n", "u"])

    schema = "doc_id long, n_tokens long, n_known long, base double, share double, ids binary, tail array<long>, n array<int>, u array<int>"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(runtime.frugal(run), schema)
    return rows.withColumn("row", F.monotonically_increasing_id())


def trained(rows: DataFrame, words: Vocabulary) -> Network:
    """A network trained on all of rows: a written table of encoded(), of the training documents."""
    spark = rows.sparkSession
    network = Network(words.counts)
    if not words.total:
        return network
    trainers = -(-words.total // TRAINER_TOKENS)
    first = int(words.symbols[words.words[END]])

    def cut(batches):
        for batch in batches:
            out: list[tuple] = []
            for row, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, at in enumerate(range(0, len(ids), 2 * PIECE_TOKENS)):
                    before = ids[at - 2 : at] if at else np.int16(first).tobytes()
                    out.append((row, i, before + ids[at : at + 2 * PIECE_TOKENS]))
            row, piece, ids = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(piece, pa.int32()), pa.array(ids, pa.binary())], names=["row", "piece", "ids"])

    runtime.prepare(spark, 500)
    rounds = ROUNDS if trainers > 1 else 1  # one trainer has nothing to average
    shares = np.cumsum(GROWTH ** np.arange(rounds))
    place = F.pmod(F.xxhash64(F.lit("round"), "row", "piece"), F.lit(1 << 30))
    in_round = sum((F.when(place >= int(x * (1 << 30)), 1).otherwise(0) for x in shares[:-1] / shares[-1]), F.lit(0))
    pieces = rows.select("row", "ids").mapInArrow(runtime.frugal(cut), "row long, piece int, ids binary")
    dealt = pieces.withColumn("trainer", F.pmod(F.xxhash64("row", "piece"), F.lit(trainers))).withColumn("round", in_round)
    if rounds > 1:  # sorted, so that a round reads its own pages
        dealt = runtime.written(dealt.sortWithinPartitions("round"))
    for i in range(rounds):
        # as many tasks as trainers, however few bytes a round has
        mine = dealt.filter(F.col("round") == i).drop("round").repartition(trainers, "trainer") if rounds > 1 else dealt.drop("round")
        network = _round(mine, words.counts, network, trainers, UPDATES // rounds, (16 if rounds == 1 else 4) if i == rounds - 1 else 0)
    if rounds > 1:
        runtime.drop(dealt)
    network.squares = None  # scoring needs none
    return network


def _round(dealt: DataFrame, counts: np.ndarray, network: Network, trainers: int, updates: int, every: int) -> Network:
    """What trainers that start from network come to on average. dealt: row, piece, ids, trainer."""
    held = dealt.sparkSession.sparkContext.broadcast((counts, network.flat(), network.flat_squares()))

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row", "ascending"), ("piece", "ascending")])
        lists = [np.frombuffer(x, np.int16) for x in table.column("ids").to_pylist()]
        starts = np.zeros(sum(map(len, lists)) - len(lists), bool)
        starts[np.cumsum([0, *[len(x) - 1 for x in lists[:-1]]])] = True
        counts, flat, squares = held.value
        mine = Network(counts).load(flat, squares)
        mine.train(np.concatenate([x[:-1] for x in lists]), np.concatenate([x[1:] for x in lists]), starts, updates, every)
        return averaging.rows(table.column("trainer")[0].as_py(), mine.flat(), mine.flat_squares() - squares)

    found = averaging.mean(dealt.groupBy("trainer").applyInArrow(train, averaging.SCHEMA), trainers, AVERAGED)
    held.unpersist()
    if found is None:  # no token fell to this round
        return network
    return network.load(found[0], network.flat_squares() + found[1])


def scored_rows(rows: DataFrame, words: Vocabulary, counted: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of rows: a written table of encoded(). Without a network the score is null."""
    spark = rows.sparkSession
    runtime.prepare(spark, SIDE_BY_SIDE)
    held = spark.sparkContext.broadcast((network, int(words.symbols[words.words[END]]))) if network else None

    def run(batches):
        network, first = held.value
        for batch in batches:
            texts = [np.frombuffer(x, np.int16) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network.score(texts, first)), *[batch.column(i) for i in range(2, 7)]], names=["row", "network", "doc_id", "n_tokens", "n_known", "base", "share"])

    given = rows.select("row", "ids", "doc_id", "n_tokens", "n_known", "base", "share")
    if network:
        probable = given.mapInArrow(runtime.frugal(run), "row long, network double, doc_id long, n_tokens long, n_known long, base double, share double")
    else:
        probable = given.drop("ids").withColumn("network", F.lit(None).cast("double"))
    tails = F.array(*[F.struct(F.lit(int(t)).cast("long").alias("t"), F.lit(int(v)).cast("long").alias("v")) for t, v in words.tails])
    each = rows.select("row", F.explode(F.arrays_zip("tail", "n", "u")).alias("x")).select("row", F.col("x.tail").alias("h"), F.col("x.n").alias("n"), F.col("x.u").alias("u"))
    met = each.join(counted.select("h", "c"), "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    below = F.element_at(tails, F.col("u") + 1)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(words.total + 0.5 * (words.size + 1)))).alias("more_base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / (below["t"] + 0.5 * (below["v"] + 1)))).alias("more_share"),
    )
    none = lambda c: F.coalesce(c, F.lit(0))
    return probable.join(sums, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + none("more_known")).alias("n_known"),
        (F.col("base") + none("more_base")).alias("base_score"), (F.col("network") + F.col("share") + none("more_share")).alias("score"),
    )


def scored(docs: DataFrame, words: Vocabulary, counted: DataFrame, network: Network) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every whole text."""
    return scored_rows(runtime.written(encoded(docs, words)), words, counted, network)


def learned_words(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    counted = runtime.written(word_counts(docs))
    return vocabulary(counted), counted


def fit(docs: DataFrame) -> tuple[Vocabulary, DataFrame, Network]:
    words, counted = learned_words(docs)
    return words, counted, trained(runtime.written(encoded(docs, words)), words)


def _rows(spark, sf_dir: str, learned: bool) -> DataFrame:
    docs = runtime.documents(spark, sf_dir).select("doc_id", "text")
    words, counted = learned_words(docs.filter(~held_out(F.col("doc_id"))))
    rows = runtime.written(encoded(docs, words))
    network = trained(rows.filter(~held_out(F.col("doc_id"))), words) if learned else None
    found = scored_rows(rows, words, counted, network)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score")


def base(spark, sf_dir: str) -> DataFrame:
    """The columns of query() that the counts alone give, by the same steps; no network is trained for them."""
    return _rows(spark, sf_dir, False).drop("score")


def query(spark, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, True)

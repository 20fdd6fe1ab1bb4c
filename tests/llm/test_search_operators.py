"""op11 to op13 against brute force, SQL, and on odd tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tidewire.llm import codebooks, lexical, ngram_join, runtime

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(lexical.TERM)
DOCS = "doc_id long, text string, row long, n int, tid long, key string, label int"  # names that the operators use too
POOL = "the Tide of a sea ran Élan élan x1 _ lights-out far".split()


def _texts(seed: int = 3, n: int = 60) -> list:
    r = random.Random(seed)
    texts = [" ".join(r.choice(POOL) for _ in range(r.randint(1, 30))) for _ in range(n)]
    return texts + [None, "", " \n\t", "...", "the " * 3000, texts[0], texts[0], "日本 日本 the"]


def _docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, 7, 7, "k", 1) for i, t in zip(ids, texts, strict=True)], DOCS)


def _best(docs: list[tuple], items: dict, k: int) -> dict:
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = {}
    for item, words in items.items():
        weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) for w in words if df[w]}
        scores = []
        for i, c in counts:
            m = 50 + 50 * c.total() * n // total if total else 0
            s = sum(w * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t, w in weight.items() if c[t])
            scores += [(-s, i is None, i or 0)] if s else []
        out[item] = [(i if not none else None, -s) for s, none, i in sorted(scores)[:k]]
    return out


def test_lexical_search(spark):
    texts = _texts()
    ids = [*range(len(texts) - 3), None, 5, 5]
    items = [(1, "The tide, the sea"), (2, "élan x1 nowhere"), (2, "lights"), (3, None), (None, "far Far"), (4, "..."), (5, "nowhere")]
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(LOWER)))
    docs, given = _docs(spark, texts, ids), spark.createDataFrame(items, "item_id long, text string")
    for k in (3, 1000):
        got = defaultdict(list)
        for r in lexical.search(docs, given, k).orderBy("item_id", "rank").collect():
            got[r.item_id].append((r.doc_id, r.score))
            assert r["rank"] == len(got[r.item_id])
        assert got == {i: v for i, v in _best(list(zip(ids, texts, strict=True)), asked, k).items() if v}


def test_lexical_terms_by_join_and_by_lookup(spark):
    terms = sorted({w.lower() for w in POOL if TERM.fullmatch(w)})
    docs = runtime.written(_docs(spark, _texts(5)).selectExpr("monotonically_increasing_id() row", "doc_id", "text"))
    asked = runtime.written(spark.createDataFrame([(w, i) for i, w in enumerate(terms)], "term string, tid long"))
    runtime.prepare(spark)
    by = [sorted(tuple(r) for r in f(docs, asked).collect()) for f in (lexical._looked_up, lexical._joined)]
    assert by[0] == by[1] and len(by[0]) > 100


def test_lexical_hash_is_checked_by_bytes(monkeypatch):
    """Words of one hash and length that aren't the same bytes don't count."""
    raw = np.frombuffer(b"ab Ab cd", np.uint8)
    s, e, h = np.array([0, 3, 6]), np.array([2, 5, 8]), np.array([9, 9, 9], np.uint64)
    hit, at = lexical._found(raw, s, e, h, (np.array([9], np.uint64), np.array([0, 2]), np.frombuffer(b"ab", np.uint8)))
    assert hit.tolist() == [0, 1] and at.tolist() == [0, 0]


def test_lexical_empty(spark):
    some, none = _docs(spark, _texts(n=3)), spark.createDataFrame([], DOCS)
    item = spark.createDataFrame([(1, "the")], "item_id long, text string")
    for docs, items in ((none, item), (some, item.limit(0)), (_docs(spark, [None, ""]), item)):
        found = lexical.search(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def _codes(vectors: list, rounds: int = 6):
    """Every distance measured, in whole numbers."""
    x = [[math.floor(4096 * float(c)) for c in v] for v in vectors]
    n = len(x[0])
    at = [n * i // 8 for i in range(9)]
    books = [[v[a:b] for v in x[:16]] for a, b in zip(at, at[1:])]
    near = lambda part, v: min((sum((p - q) ** 2 for p, q in zip(v, e)), k) for k, e in enumerate(books[part]))
    for i in range(rounds + 1):
        codes = [[near(p, v[at[p] : at[p + 1]]) for p in range(8)] for v in x]
        for p in range(8) if i < rounds else ():
            for k in range(len(books[p])):
                own = [v[at[p] : at[p + 1]] for v, c in zip(x, codes, strict=True) if c[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    text = ",".join(str(c) for part in books for e in part for c in e)
    return [("".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c)) for c in codes], hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("width, rows, spread", [(16, 300, 1.0), (11, 120, 0.01), (8, 5, 1.0), (3, 40, 1.0), (16, 200, 0.0003), (16, 20, 3e5)])
def test_vector_codes(spark, tmp_path, width, rows, spread):
    """Ties are frequent where the spread is small: components are then a few whole numbers."""
    r = random.Random(rows)
    centers = [[r.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    vectors = [[spread * (c + r.uniform(-0.3, 0.3)) for c in r.choice(centers)] for _ in range(rows)]
    vectors[3] = vectors[1]
    odd = [(900, None, 1), (901, [None] * width, 1), (902, [float("nan")] * width, 1), (903, [float("inf")] * width, 1), (904, [0.5] * (width + 1), 1), (905, [], 1)]
    given = [(i, v, i % 3 if i % 4 else None) for i, v in enumerate(vectors)]
    table = spark.createDataFrame([(i, v, label, "x") for i, v, label in given + odd], "vec_id long, embedding array<double>, label int, code string")
    table.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {x.vec_id: x for x in codebooks.query(spark, str(tmp_path)).collect()}
    want, digest = _codes(vectors)
    assert {i: (x.code, x.error) for i, x in got.items()} == dict(enumerate(want)) and {x.codebooks_sha256 for x in got.values()} == {digest}
    totals = Counter()
    for i, _, label in given:
        totals[label] += want[i][1]
    assert all(got[i].label_error == totals[label] for i, _, label in given)


def test_vector_codes_prune_and_empty(spark, tmp_path):
    """Bounds spare distances, and never change a code."""
    r = np.random.default_rng(1)
    x = (r.normal(size=(2000, 8)) * 300 + r.integers(0, 16, 2000)[:, None] * 900).astype(np.int64)
    books = codebooks.Books([x[:16]])
    code, upper, lower = np.zeros(2000, np.int64), np.full(2000, np.inf, np.float32), np.zeros((2000, 16), np.float32)
    taken = []
    for _ in range(4):
        taken.append(books.assign(0, x, code, upper, lower))
        full = codebooks.squared(x[:, None], books.entries[0][None])
        assert (code == full.argmin(1)).all() and (upper.astype(float) ** 2 >= full.min(1)).all() and (lower.astype(float) ** 2 <= full).all()
        books = codebooks.Books([np.array([x[code == k].sum(0) // max(1, (code == k).sum()) if (code == k).any() else e for k, e in enumerate(books.entries[0])])], books)
    assert taken[-1] < taken[0] / 2
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert codebooks.query(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_vector_codes"])
def test_sql(spark, sf_dir, name):
    from tidewire.llm import queries

    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    want = db.sql(queries.oracle_sql()[name])
    rows = queries.queries()[name](spark, sf_dir).select(*want.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(want.fetchall()) != []


def _shingles(text, k: int = 4) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def _components(rows: list[tuple]) -> list[tuple]:
    sets, parent = [_shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, len(sets[i]), least.get(top(i))) for i, (doc, _) in enumerate(rows)), key=str)


def _near(r: random.Random, words: list, edits: int) -> str:
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def test_ngram_join(spark, monkeypatch):
    r = random.Random(2)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    base = [[r.choice(vocabulary) for _ in range(n)] for n in (20, 80, 90, 300, 1500)]
    texts = [_near(r, b, e) for b in base for e in (0, 0, 1, 1, 2, 2, 3, 4, 6, 9)]
    texts += [" ".join(passage + [r.choice(vocabulary) for _ in range(r.randint(3, 90))]) for _ in range(40)]  # one passage, few alike
    texts += [" ".join(base[3][: 300 - n]) for n in range(0, 80, 5)]  # a chain by length
    texts += [None, "", " \t", "one", "One", "one two three", "one two three four", texts[0], texts[0].upper(), "x " * 5000, "x " * 9]
    ids = [*range(len(texts) - 4), None, 7, 7, None]
    want = _components(list(zip(ids, texts, strict=True)))
    for block in (512, 4):  # one cell a tile, and many
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        got = ngram_join.components(_docs(spark, texts, ids).repartition(3))
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert len({c for _, _, c in want}) < len(texts) - 30


def test_ngram_join_cells_alone(spark, monkeypatch):
    """Without leaders' links: a group of near copies leaves its cells as forests, and components are those of all links."""
    r = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    texts = [" ".join([*base[:60], f"x{i}", *base[60:]]) for i in range(30)] + [_near(r, base, e) for e in (1, 2, 3, 4, 5) for _ in range(12)]
    monkeypatch.setattr(ngram_join, "_bounded", lambda pairs, maps, percent: pairs.limit(0).select("a", "b"))
    want, made, whole = _components(list(enumerate(texts))), [], ngram_join._compared

    def compared(cells, percent):
        found = whole(cells, percent).cache()
        made.extend((found.count(), cells.count()))
        return found

    monkeypatch.setattr(ngram_join, "_compared", compared)
    for block in (512, 8):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        got = ngram_join.components(_docs(spark, texts, range(len(texts))).repartition(3))
        assert sorted(map(tuple, got.collect()), key=str) == want
        assert 0 < made[-2] <= made[-1]


def test_ngram_join_on_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, ngram_join.query(spark, sf_dir).collect()), key=str)
    assert got == _components([(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()])
    assert ngram_join.components(docs.limit(0)).collect() == []


def test_ngram_bounds():
    """Sizes that can be alike are in one band or neighbours; differing bits never exclude a pair that is alike."""
    starts = ngram_join.bands()
    band = lambda n: int(np.searchsorted(starts, n, "right")) - 1
    assert all(band(n * 100 // 85) - band(n) in (0, 1) for n in range(1, 5000))
    r = np.random.default_rng(4)
    for n in (1, 10, 700, 3000):
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        for kept in (n, int(n * 0.95), int(n * 0.93), n // 2):
            b = np.concatenate([a[:kept], r.integers(0, 1 << 63, n - kept, dtype=np.uint64)])
            both = len(np.intersect1d(a, b))
            x = ngram_join.folded([ngram_join.bitmap(np.sort(a)), ngram_join.bitmap(np.sort(b))])
            fits = bool(ngram_join.may_link(np.bitwise_count(x[0] ^ x[1]).sum(keepdims=True).astype(np.int64), np.array([2 * n]))[0])
            assert fits or 100 * both < 85 * (2 * n - both)
            assert not fits or kept > n // 2 or n < 700

"""TF-IDF and cosines over whole texts, against brute force."""

import math
import random
from collections import Counter

import pytest

from tidewire.operators import similarity
from tidewire.plans import contract


def test_whole_texts(spark, tmp_path):
    body = "alpha beta gamma delta epsilon zeta theta iota kappa lambda"
    texts = [f"first\n{body}", f"other\n{body} alpha", "first\nnothing in common with those words", "last\nred green blue", "red\ngreen blue blue", "one\ntwo the the"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = [Counter(t.split()) for t in texts]
    df = Counter(w for c in counts for w in c)
    want = [{w: n / c.total() * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in c.items()} for c in counts]
    got = {(r.doc_id, r.term): r.w for r in contract.tfidf_text(spark, str(tmp_path)).collect()}
    flat = {(i, w): x for i, v in enumerate(want) for w, x in v.items()}
    assert got.keys() == flat.keys() and all(abs(got[k] - x) < 1e-6 for k, x in flat.items())
    norm = [math.sqrt(sum(x * x for x in v.values())) for v in want]
    cosine = {(i, j): sum(x * want[j].get(w, 0) for w, x in want[i].items()) / norm[i] / norm[j] for i in range(6) for j in range(i + 1, 6)}
    pairs = {(r.a, r.b): r.cosine for r in contract.cosine_pairs_text(spark, str(tmp_path)).collect()}
    assert pairs.keys() == {k for k, x in cosine.items() if x >= 0.75} >= {(0, 1)} and all(abs(x - cosine[k]) < 1e-6 for k, x in pairs.items())


@pytest.mark.parametrize("list_rows, cell_pairs, threshold", [(2000, 20_000, 0.75), (2, 1, 0.75), (3, 7, 0.3), (2000, 5, 0.99)])
def test_cosine_pairs_in_blocks(spark, monkeypatch, list_rows, cell_pairs, threshold):
    """Near copies, a term that nearly all rows hold, rows without weight: whatever the blocks, the pairs are brute force's."""
    monkeypatch.setattr(similarity, "LIST_ROWS", list_rows)
    monkeypatch.setattr(similarity, "CELL_PAIRS", cell_pairs)
    r = random.Random(7)
    rows = [{f"t{r.randrange(60)}": r.random() + 0.01 for _ in range(r.randint(1, 12))} | {"the": 0.3} for _ in range(40)]
    for i in range(0, 40, 3):
        rows.append({t: w * r.uniform(0.8, 1.2) for t, w in rows[i].items() if r.random() < 0.9})
    rows += [{"lone": 2.0}, {"the": 0.0}, {}]
    norm = [math.sqrt(sum(w * w for w in v.values())) for v in rows]
    want = {(i, j): sum(w * rows[j].get(t, 0) for t, w in rows[i].items()) / norm[i] / norm[j] for i in range(len(rows)) for j in range(i + 1, len(rows)) if norm[i] and norm[j]}
    want = {k: c for k, c in want.items() if c >= threshold}
    vectors = spark.createDataFrame([(i, t, w) for i, v in enumerate(rows) for t, w in v.items()], "id long, term string, w double")
    got = {(x.a, x.b): x.cosine for x in similarity.cosine_pairs(vectors, "id", threshold).collect()}
    assert got.keys() == want.keys() and all(abs(c - want[k]) < 1e-9 for k, c in got.items())
    assert similarity.cosine_pairs(vectors.limit(0), "id", threshold).collect() == []


@pytest.mark.parametrize("frequent, copy_rows", [(1 << 20, 1000), (3, 2)])
def test_equal_rows_and_repeated_keys(spark, monkeypatch, tmp_path, frequent, copy_rows):
    """Copies (in blocks), keys of several rows and none, df beyond the looked up terms: weights and pairs are brute force's, and copies
    don't meet in lists."""
    monkeypatch.setattr(similarity, "FREQUENT", frequent)
    monkeypatch.setattr(similarity, "COPY_ROWS", copy_rows)
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefgh") * 2 for _ in range(r.randint(1, 9))) for _ in range(9)]
    texts = [(i, base[i % 9] if i % 4 else base[0] + " odd") for i in range(30)] + [(3, "more words"), (None, "aa null words"), (None, "bb"), (90, ""), (91, None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    joined = {}
    for k, t in texts:
        joined[k] = joined.get(k, "") + " " + (t or "")
    counts = {k: Counter(t.split()) for k, t in joined.items()}
    df = Counter(w for c in counts.values() for w in c)
    want = {(k, w): n / c.total() * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for k, c in counts.items() if k is not None for w, n in c.items()}
    got = {(x.doc_id, x.term): x.w for x in similarity.tfidf(frame, "doc_id", "text").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - x) < 1e-9 for k, x in want.items())
    rows = {}
    for (k, w), x in want.items():
        rows.setdefault(k, {})[w] = x
    norm = {k: math.sqrt(sum(x * x for x in v.values())) for k, v in rows.items()}
    cosine = {(a, b): sum(x * rows[b].get(w, 0) for w, x in rows[a].items()) / norm[a] / norm[b] for a in rows for b in rows if a < b}
    met = []
    real = similarity._met
    monkeypatch.setattr(similarity, "_met", lambda *x: met.append(real(*x)) or met[-1])
    pairs = [(x.a, x.b, x.cosine) for x in similarity.cosine_pairs(similarity.vectors(frame, "doc_id", "text"), "doc_id", 0.75).collect()]
    assert len(pairs) == len({x[:2] for x in pairs}) and {x[:2] for x in pairs} == {k for k, x in cosine.items() if x >= 0.75 - 1e-12}
    assert all(abs(x - cosine[a, b]) < 1e-9 for a, b, x in pairs) and met[0].count() < len(pairs)


def test_semantic_dedup_reads_whole_texts(spark, tmp_path):
    """Texts that are alike in their first 500 characters alone stay; those that are alike from there on don't."""
    head = " ".join(f"same{i}" for i in range(80))
    tails = [" ".join(f"{word}{i}" for i in range(900)) for word in ("one", "two")]
    texts = [(i, f"{title}\n{head} {tail}", 1) for i, (title, tail) in enumerate([("first", tails[0]), ("second", tails[1]), ("third", tails[1])])]
    spark.createDataFrame(texts, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert len(head) > 500
    assert sorted(r.doc_id for r in contract.semantic_dedup(spark, str(tmp_path)).collect()) == [0, 1]


def test_pairs_leave_no_candidates_on_disk(spark, monkeypatch):
    """Rows that share terms but no likeness, in many blocks: no table has more rows than tokens; jaccard pairs are brute force's."""
    monkeypatch.setattr(similarity, "LIST_ROWS", 20)
    monkeypatch.setattr(similarity, "BLOCK_TERMS", 900)
    r = random.Random(5)
    rows = [(i, sorted({f"t{r.randrange(200)}" for _ in range(12)} | {f"own{i // 2}", f"most{i % 2}"})) for i in range(160)]
    rows += [(1000 + i, rows[i][1] if i % 3 else rows[i][1][2:]) for i in range(30)]
    frame = spark.createDataFrame(rows, "id long, tokens array<string>")
    made, real = [], similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, *by: made.append(real(df, *by)) or made[-1])
    blocks, met = [], similarity._met
    monkeypatch.setattr(similarity, "_met", lambda table, at, *x: blocks.append(at) or met(table, at, *x))
    got = {(x.a, x.b): x.jaccard for x in similarity.jaccard_pairs(frame, "id", 0.45).collect()}
    want = {}
    for i, (a, x) in enumerate(rows):
        for b, y in rows[i + 1 :]:
            if (c := len(set(x) & set(y))) / (len(x) + len(y) - c) >= 0.45:
                want[a, b] = c / (len(x) + len(y) - c)
    assert got.keys() == want.keys() and all(abs(got[k] - x) < 1e-12 for k, x in want.items())
    assert blocks[0] > 2 and max(x._rows_written for x in made) <= 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

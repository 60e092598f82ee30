import numpy as np

from shiftledger.llm.ann import nearest_neighbours


def brute(rows, every, k):
    good = {}
    for i, v in rows:
        if i is None or v is None or None in v or not np.isfinite(v).all() or not any(v) or len(v) != 8:
            continue
        good[i] = np.array(v, dtype=np.float32).astype(float)
    out = []
    for q in sorted(i for i in good if i % every == 0):
        scored = sorted((-float(sum(a * b for a, b in zip(good[q], v))), i) for i, v in good.items() if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return out


def test_same_as_brute_force_with_copies_and_odd_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(300)]
    rows += [(i, [1.0] * 8) for i in range(300, 400)]
    rows += [(500, None), (501, [None] + [1.0] * 7), (502, [float("nan")] * 8), (503, [0.0] * 8), (504, [1.0]), (None, [2.0] * 8), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for more in ({}, {"chunk_rows": 16, "leaf_sample": 20, "search_rows": 10_000}):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(df, query_every=20, k=20, **more).collect())
        assert got == brute(rows, 20, 20)
    assert nearest_neighbours(df.limit(0)).count() == 0


def test_recall_without_any_structure(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(6000, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in nearest_neighbours(df, query_every=100, k=20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 6000, 100):
        score = x[q].astype(float) @ x.T.astype(float)
        score[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-score)[:20].tolist()))
    assert hits / (60 * 20) >= 0.9

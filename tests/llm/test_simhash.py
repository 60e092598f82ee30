import random

import xxhash
from pyspark.sql import functions as F

from shiftledger.llm.components import connected_components
from shiftledger.llm.simhash import blocks_for, close_links, fingerprint, near_duplicate_classes, one_of_each_class


def classes_of(nodes, linked):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return {n: top(n) for n in nodes}


def test_fingerprint_by_definition():
    for text in ["", " \n", "One", "a b c", "A b\tc  d\ne f", "x x x x x x", "é ß Z q w"]:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if words else 0
        assert fingerprint(text.encode()) == want


def test_links_lose_no_pair(spark):
    draw = random.Random(3)
    fps = {draw.getrandbits(64) for _ in range(60)}
    for base in list(fps)[:20]:
        for _ in range(6):
            fps.add(base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 6))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = classes_of(signed, [(a, b) for a in signed for b in signed if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for grid, blocks in ((4096, 6), (3, 6), (4096, 8), (5, 7)):
        got = {r.node: r.component for r in connected_components(close_links(df, 4, blocks, grid)).collect()}
        assert {f: got.get(f, f) for f in signed} == want


def test_components_of_a_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in connected_components(edges).collect()} == {0}
    assert connected_components(edges.limit(0)).count() == 0


def test_blocks_grow_with_the_table():
    assert [blocks_for(n) for n in (0, 1, 1 << 27, 1 << 28, 1 << 33, 1 << 35)] == [6, 6, 6, 7, 7, 8]
    assert blocks_for(100, 14) == 16 and blocks_for(10, 0) == 2


def test_odd_rows(spark, odd_docs, no_docs):
    rows = near_duplicate_classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = {r.component_id for r in rows if r.fp == 0}
    assert empty == {3}
    kept = one_of_each_class(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:7]) for r in kept.collect()) == [
        (0, "der hun"), (1, "the cat"), (2, "another"), (3, ""), (6, "wort0é "), (7, "1234 !!")
    ]
    assert near_duplicate_classes(no_docs).count() == 0 and one_of_each_class(no_docs).count() == 0


def brute_force(rows):
    """The component of each row's fingerprint: the smallest id over links of four bits, by trying all pairs."""
    fps = {fingerprint((t or "").encode()) for _, t in rows}
    top = classes_of(fps, [(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 4])
    ids = {}
    for d, t in rows:
        if d is not None:
            c = top[fingerprint((t or "").encode())]
            ids[c] = min(ids.get(c, d), d)
    return {f: (top[f], ids.get(top[f])) for f in fps}


def near_copies(seed=5):
    draw = random.Random(seed)
    rows = [(None, "nobody knows this text by a name"), (None, "nobody knows this text by a name"), (None, None), (900, "")]
    for i in range(25):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.randint(60, 300))]
        for _ in range(7):
            changed = list(words)
            for _ in range(draw.randint(0, max(1, len(words) // 40))):
                changed[draw.randrange(len(words))] = f"x{draw.randrange(3000)}"
            text = " ".join(changed)
            rows.append((draw.choice([None, *range(400)]), text.upper() if draw.random() < 0.3 else text.replace(" ", "  ")))
    return rows + rows[10:14]


def test_query_against_brute_force(spark, tmp_path):
    from shiftledger.llm.queries import QUERIES

    rows = near_copies()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    classes = brute_force(rows)
    want = [(d, f"{(f := fingerprint((t or '').encode())):016x}", classes[f][1]) for d, t in rows]
    found = QUERIES["op3_simhash"](spark, str(tmp_path)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_one_of_each_class_against_brute_force(spark):
    rows = near_copies(6)
    classes = brute_force(rows)
    best = {}
    for d, t in rows:
        f = fingerprint((t or "").encode())
        best.setdefault(classes[f][0], []).append((d is None, d or 0))
    found = one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(best)
    least = [min((missing, d) for missing, d, *_ in members) for members in best.values()]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted(least)
    given = {(d, t) for d, t in rows}
    assert all((r.doc_id, r.text) in given for r in found)

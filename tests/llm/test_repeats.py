import hashlib
import random

import numpy as np
import pytest

from shiftledger.llm.repeats import longest_previous_factor, removal_digest, suffix_ranks, without_repeats


def brute(rows, length=100):
    seen, out = set(), []
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                gone[s : s + length] = True
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def drawn(seed):
    draw = random.Random(seed)
    base = ["".join(draw.choice("abé \n") for _ in range(draw.choice([30, 90, 150, 400]))) for _ in range(6)]
    base.append("ab" * 150)
    rows = []
    for i in range(50):
        parts = []
        for _ in range(draw.randrange(4)):
            text = draw.choice(base)
            at = draw.randrange(len(text))
            parts.append(text[at : at + draw.choice([20, 120, 400])])
        rows.append((i, "".join(parts) if i % 13 else None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("settings", [{}, {"hot_rows": 0, "hot_share": 0.0, "sample_of": 1}, {"gram": 50}])
def test_same_as_brute_force(spark, seed, settings):
    rows = drawn(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, removal_digest(df, **settings).collect())) == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = removal_digest(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    # equal rows count as one document, which is the first; the copy under id 2 goes
    assert len({(r.n_removed, r.kept_sha256) for r in rows if r.doc_id == 1}) == 1
    assert max(r.n_removed for r in rows if r.doc_id == 2) == max(r.n_bytes for r in rows if r.doc_id == 2)
    cut = without_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert removal_digest(no_docs).count() == 0 and without_repeats(no_docs).count() == 0


def test_suffix_ranks_order_bytes():
    draw = np.random.default_rng(1)
    data = draw.integers(97, 99, 400).astype(np.uint8)
    at = np.arange(250)
    ranks = suffix_ranks(data, at, 100)
    parts = [data[i : i + 100].tobytes() for i in at]
    places = {p: n for n, p in enumerate(sorted(set(parts)))}
    assert ranks.tolist() == [places[p] for p in parts]


def test_longest_previous_factor():
    text = "abaababaabaab"
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def common(a, b):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    lcp = np.array([0] + [common(a, b) for a, b in zip(order, order[1:])])
    want = [max([common(i, j) for j in range(i)], default=0) for i in range(len(text))]
    assert longest_previous_factor(np.array(order), lcp).tolist() == want

import zlib

import numpy as np
from pyspark.sql import functions as F

from shiftledger.llm import html_crf, langid, toxicity
from shiftledger.llm.labelled_pages import labelled_pages
from shiftledger.llm.sampling import held_out

DATA = "/root/testdata/sf0.1"


def test_held_out_by_definition(spark, odd_docs):
    for r in odd_docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.fit_on(docs, train_docs=1500)
    rows = docs.where(held_out(F.col("doc_id"))).select("lang", langid.language_column(F.col("text"), model).alias("f")).collect()
    assert np.mean([r.lang == r.f.lang for r in rows]) >= 0.98
    assert all(0 <= r.f.score <= 1 for r in rows)


def test_language_backs_off_to_shorter_grams():
    import pandas as pd

    sample = pd.DataFrame({"text": ["thing seeing being going", "liebe triebe siebe diebe"] * 3, "lang": ["en", "de"] * 3})
    model = langid.fit(sample)
    assert model.predict([b"Thing", b"xyzing", b"xyziebe", b"qqq"])[0][:3] == ["en", "en", "de"]


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    for model in (langid.fit_on(odd_docs), None):
        rows = odd_docs.select("text", langid.language_column(F.col("text"), model).alias("f")).collect()
        for r in rows:
            assert (r.f.lang == "und") == (model is None or not any(c.isalpha() for c in r.text or ""))
    assert langid.fit_on(no_docs) is None


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_on(docs, labels)
    rows = (
        docs.where(held_out(F.col("doc_id")) & (F.col("lang") == "en")).join(labels, "doc_id")
        .select("toxic", toxicity.score_column(F.col("text"), model).alias("s")).collect()
    )
    score, toxic = np.array([r.s for r in rows]), np.array([r.toxic for r in rows])
    found = score >= toxicity.CUT
    assert found[toxic == 1].mean() >= 0.75 and found[toxic == 0].mean() <= 0.02


def test_toxicity_learns_from_rows_beyond_the_first_ones(spark, monkeypatch):
    """Every bad word is in two of the first examples at most, too few to learn it from them."""
    monkeypatch.setattr(toxicity, "PART_DOCS", 400)
    filler = "the press ran well after lunch and the belt was cleaned before noon by us".split()
    rows = []
    for i in range(1600):
        words = [filler[(i * 7 + j * j) % len(filler)] for j in range(9)]
        bad = f"zorg{i // 2 % 8}vile" if i % 2 else "calm"
        rows.append((i, " ".join([*words[:4], bad, *words[4:]]), "en", i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit_on(docs.drop("toxic"), docs.select("doc_id", "toxic"), train_docs=16)
    scores = model.scores([f"{' '.join(filler[:6])} zorg{k}vile".encode() for k in range(8)] + [b" ".join(w.encode() for w in filler)])
    assert (scores[:8] >= toxicity.CUT).all() and scores[8] < toxicity.CUT


def test_thresholds_from_counts():
    logits, toxic = np.array([3.0, 2, 1, 0]), np.array([1, 1, 0, 0])
    assert toxicity._best_cut(logits, toxic * 5, np.full(4, 5)) == toxicity._best_cut(logits, toxic) == 1.5
    assert toxicity._best_cut(logits, np.array([1, 0, 9, 0]), np.array([1, 1, 10, 90])) == 0.5


def test_toxicity_of_odd_rows(odd_docs, no_docs, odd_labels):
    for labels in (odd_labels, odd_labels.limit(0)):
        model = toxicity.fit_on(odd_docs, labels)
        rows = odd_docs.select(toxicity.score_column(F.col("text"), model).alias("s")).collect()
        assert all(0 <= r.s <= 1 for r in rows)
    assert toxicity.fit_on(no_docs, odd_labels) is None


def test_field_on_unseen_pages():
    field = html_crf.trained_field()
    wrong = blocks = 0
    for page, labels in labelled_pages(120, seed=77):
        found = html_crf.leaf_blocks(page)
        got = field.decode(field.unary(html_crf.features_of(found))) if found else []
        wrong += sum(a != b for a, b in zip(got, labels))
        blocks += len(labels)
    assert wrong <= 0.01 * blocks


def test_viterbi_and_marginals_against_all_labellings():
    from itertools import product

    draw = np.random.default_rng(1)
    field = html_crf.Field(np.zeros(4), draw.normal(size=(2, 2)), draw.normal(size=2))
    unary = draw.normal(size=5)

    def score(y):
        return field.start[y[0]] + sum(u * b for u, b in zip(unary, y)) + sum(field.moves[a, b] for a, b in zip(y, y[1:]))

    every = list(product((0, 1), repeat=5))
    weights = np.exp([score(y) for y in every])
    assert field.decode(unary) == list(max(every, key=score))
    want = (weights[:, None] * np.array(every)).sum(axis=0) / weights.sum()
    assert np.allclose(field.marginals(unary)[0], want)


def test_pages(spark):
    field = html_crf.trained_field()
    page = (
        "<html><head><title>T</title><script>if (a<b) {'</p>'}</script></head><body><nav><a href=x>Home</a></nav>"
        "<article><h1>Caf&eacute; &amp; bar</h1><p>One  sentence here,\nwith <b>bold</b> words. Another one follows.<p>Left open, it goes on"
        " for a while.<!-- no --></article><div class='comments'><p>I disagree with this. Really.</p></div><footer>&copy; 2020 x</footer>"
    )
    assert html_crf.main_text(page, field) == (
        "Café & bar\n\nOne sentence here, with bold words. Another one follows.\n\nLeft open, it goes on for a while."
    )
    rows = [(1, page), (2, None), (3, ""), (4, "<<<>>>"), (5, "<p>" * 3000), (6, "plain " * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, html string")
    assert df.select(html_crf.main_text_column(F.col("html"))).count() == 6

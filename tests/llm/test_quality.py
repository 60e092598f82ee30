import re
from collections import Counter

from shiftledger.llm.quality import kept_documents, quality_verdicts


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_counts_by_definition(spark, sf_dir, odd_docs, odd_labels):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for df, its in ((docs, labels), (odd_docs, odd_labels)):
        want = sorted(map(repr, ((r.doc_id, *counts(r.text)) for r in df.collect())))
        rows = quality_verdicts(df, its).collect()
        assert sorted(map(repr, (tuple(r)[:6] for r in rows))) == want
        for r in rows:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_junk_goes_and_clean_stays(spark, sf_dir):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality_verdicts(docs, labels).where("NOT base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_odd_rows(odd_docs, no_docs, odd_labels):
    kept = kept_documents(odd_docs, odd_labels)
    assert kept.columns == odd_docs.columns
    assert kept.count() == quality_verdicts(odd_docs, odd_labels).where("kept").count()
    assert quality_verdicts(no_docs, odd_labels).count() == 0
    assert quality_verdicts(odd_docs, odd_labels.limit(0)).where("kept <> (NOT base_failed)").count() == 0

"""Every stage, and the whole run, against plain Python on a small corpus with copies, passages and junk."""

import random
import zlib
from collections import Counter
from math import floor, log

import duckdb
import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shiftledger.llm import packing, quality
from shiftledger.llm.oracle import ORACLE
from shiftledger.llm.simhash import fingerprint

from .test_quality import counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(seed=8):
    """Documents and labels; ids are unique, as they are in the given tables."""
    draw = random.Random(seed)
    good, junk = ([f"{p}{i}é" for i in range(900)] for p in ("w", "z"))
    passage = " ".join(draw.choice(good) for _ in range(60))
    texts = []
    for _ in range(60):
        words = [draw.choice(good) for _ in range(draw.randint(60, 400))]
        texts.append((" ".join(words), 1))
        kind = draw.randrange(5)
        if kind == 0:  # exact copies
            texts += [(" ".join(words), 1)] * draw.randint(1, 4)
        elif kind == 1:  # near copies
            for _ in range(draw.randint(1, 3)):
                changed = list(words)
                changed[draw.randrange(len(words))] = draw.choice(good)
                texts.append(("  ".join(changed).upper(), 1))
        elif kind == 2:  # a passage that others share
            at = draw.randrange(len(words))
            texts.append((" ".join([*words[:at][:80], passage, *words[at:][:80]][::-1]), 1))
        elif kind == 3:  # unlike the trusted ones, too short, or full of repeats
            texts.append((" ".join(draw.choice(junk) for _ in range(100)), 0))
            texts.append((" ".join(words[:10]), 0))
            texts.append((" ".join(words[:12] * 9), 0))
    texts += [(None, 0), ("", 0), (" \n ", 0), (passage, 1)]
    draw.shuffle(texts)
    sources = ["a", "a", "a", "b", "c", None]
    docs = [(i, t, "en", draw.choice(sources), len(t or "")) for i, (t, _) in enumerate(texts)]
    labels = [(i, q, 0) for i, (_, q) in enumerate(texts) if i % 3]
    return docs, labels


def kept_by_quality(docs, labels):
    trusted = {i for i, q, _ in labels if q == 1}
    buckets = {}
    for i, text, *_ in docs:
        words = (text or "").split()
        found = []
        for k in range(len(words)):
            for span in (words[k : k + 1], words[k : k + 2]):
                if len(span) < 2 or k + 1 < len(words):
                    found.append(int(quality.Words([" ".join(span).encode()]).ngrams()[0][-1]))
        # a last word has no pair
        buckets[i] = found[: 2 * len(words) - 1]
    every, some = Counter(), Counter()
    for i, found in buckets.items():
        every.update(found)
        some.update(found if i in trusted else [])
    size, n_every, n_some = quality.BUCKETS, sum(every.values()), sum(some.values())

    def ratio(b):
        return log((some[b] + 1) / (n_some + size)) - log((every[b] + 1) / (n_every + size))

    scores = {i: sum(map(ratio, found)) / len(found) if found else 0.0 for i, found in buckets.items()}
    failed = {}
    for i, text, *_ in docs:
        n_words, _, _, _, n_repeat = counts(text)
        failed[i] = n_words < 20 or 100 * n_repeat > 30 * n_words
    judged = [(floor(scores[i] * 200), q) for i, q, _ in labels if not failed[i]]
    bins = sorted({b for b, _ in judged})
    costs = [sum(10 for b, q in judged if q == 1 and b < cut) + sum(1 for b, q in judged if q != 1 and b >= cut) for cut in [*bins, bins[-1] + 1]]
    best = costs.index(min(costs))
    least = float("-inf") if best == 0 else (bins[best - 1] + 1 + (bins[best] if best < len(bins) else bins[best - 1] + 1)) / 400
    return [d for d in docs if not failed[d[0]] and scores[d[0]] >= least], scores


def kept_by_simhash(docs):
    fps = {d[0]: fingerprint((d[1] or "").encode()) for d in docs}
    up = {i: i for i in fps}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return [d for d in docs if top(d[0]) == d[0]]


def without_passages(docs, length=100):
    seen, out = set(), []
    for d in sorted(docs):
        data = d[1].encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s : s + length] = True
            seen.add(data[s : s + length])
        text = bytes(b for b, g in zip(data, gone) if not g).decode(errors="ignore")
        if text:
            out.append((d[0], text, *d[2:4], len(text)))
    return out


def mixed(docs):
    """As often as the SQL twin of the mix takes them."""
    base = duckdb.connect()
    base.register("given", pd.DataFrame(docs, columns=COLUMNS))
    base.execute("CREATE VIEW documents AS SELECT * FROM given")
    times = {i: taken // size for i, size, taken in base.execute(f"SELECT doc_id, size, taken FROM ({ORACLE['op1_mixing']})").fetchall()}
    return [d for d in docs for _ in range(times[d[0]])]


def pieces_of(docs):
    model = Tokenizer.from_file(packing.tokenizer_path())
    found = Counter()
    for d in docs:
        ids = np.array([*model.encode(d[1], add_special_tokens=False).ids, 2], dtype="<u4")
        for s in range(0, len(ids), 4096):
            part = ids[s : s + 4096]
            found[d[0], s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    return found


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def expected():
    """What each stage keeps of what the one before has kept."""
    docs, labels = corpus()
    judged, _ = kept_by_quality(docs, labels)
    single = kept_by_simhash(judged)
    cut = without_passages(single)
    return {"quality_rules": judged, "near_dedup": single, "suffix_dedup": cut, "mixing": mixed(cut)}


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*COLUMNS).collect())))


def test_stages_against_plain_python(spark, folder, expected):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [docs.count()]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        found = apply(spark, docs, folder)
        assert found.columns == COLUMNS
        assert rows_of(found) == sorted(map(repr, expected[name])), name
        sizes.append(len(expected[name]))
        docs = spark.createDataFrame(expected[name], docs.schema).repartition(3)
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1]
    before = {d[0]: d[1] for d in expected["near_dedup"]}
    assert any(d[1] != before[d[0]] for d in expected["suffix_dedup"])
    name, apply = corpus_pipeline.STAGES[-1]
    assert name == "packing"
    check_packed(apply(spark, docs, folder), expected["mixing"])


def check_packed(df, docs):
    rows = df.collect()
    found = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert found == pieces_of(docs)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r["offset"], r.length))
    for its in windows.values():
        its.sort()
        assert [o for o, _ in its] == [sum(n for _, n in its[:i]) for i in range(len(its))] and its[-1][0] + its[-1][1] <= 4096


def test_whole_run_against_plain_python(spark, folder, expected):
    check_packed(corpus_pipeline.run(spark, folder), expected["mixing"])


def test_quality_scores_against_plain_python(spark, folder):
    docs, labels = corpus()
    kept, scores = kept_by_quality(docs, labels)
    judged = quality.quality_verdicts(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    for r in judged.collect():
        assert r.score == pytest.approx(scores[r.doc_id], abs=1e-9)
        assert r.kept == (r.doc_id in {d[0] for d in kept})
    # the threshold does its work on texts that pass the base rules
    assert judged.where("NOT base_failed AND NOT kept").count() > 3


def test_stages_on_given_documents(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "suffix_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:2]:
        found = apply(spark, docs, sf_dir)
        assert found.columns == docs.columns and found.subtract(docs).count() == 0 < found.count()


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs, sf_dir).count() == 0

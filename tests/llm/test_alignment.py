import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shiftledger.llm.alignment import TOKENIZER_A, TOKENIZER_B, align_documents, byte_of_letter, group_labels
from shiftledger.llm.packing import tokenizer_path

PLAIN = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(tokenizer_path(TOKENIZER_A))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=tokenizer_path(TOKENIZER_B))


def tokens(models, text):
    """Ids and bytes of both tokenizers over the whole text, none if they do not spell it."""
    a, b = models
    letters = byte_of_letter()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], []
    return list(zip(ids_a, bytes_a)), list(zip(ids_b, bytes_b))


def ends(parts):
    return np.cumsum([len(x) for _, x in parts]).tolist()


def aligned(models, docs):
    """Groups by common ends, links and counts, text by text."""
    rows, counts = [], Counter()
    for doc_id, text in docs:
        a, b = tokens(models, text or "")
        ends_a, ends_b = ends(a), ends(b)
        common = sorted(set(ends_a) & set(ends_b))
        groups = [
            ([i for (i, _), e in zip(a, ends_a) if lo < e <= hi], [i for (i, _), e in zip(b, ends_b) if lo < e <= hi])
            for lo, hi in zip([0, *common], common)
        ]
        links = [(x, y) for (x, _), e in zip(a, ends_a) for (y, _), f in zip(b, ends_b) if e == f]
        counts.update(links)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        repr((d, na, nb, ng, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha))
        for d, na, nb, ng, links, sha in rows
    )


def odd_texts():
    rng = random.Random(11)
    parts = [
        " ", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "\r", " \n ", " ", "　", " ", "\u0085", "\x0b", "\x1c", "\x00", "​",
        "the", "The", "quick", "don't", "we'll", "12", "345", "é", "ñandú", "straße", "日本語", "𝄞", "é", "...", "!?", "=>", ");\r", "{",
        "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "Ġ", "Ċ", "x" * 40, "          y",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 3, 8, 30]))) for _ in range(400)]
    return texts + [*parts, "▁", "a ▁b", "", " ", "\n", " \n", "word", "a▁", "the quick don't " * 50]


def test_against_whole_texts(spark, models):
    docs = list(enumerate(odd_texts())) + [(3, None), (None, "the quick"), (None, None), (5, "the quick"), (5, "the quick")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_a", F.lit("x")).withColumn("links", F.lit(1))
    want = aligned(models, docs)
    for pairs in (2_000_000, 3):
        found = align_documents(frame.repartition(3), broadcast_pairs=pairs)
        assert found.columns == list(PLAIN)
        assert sorted(repr(tuple(r)) for r in found.collect()) == want


def test_given_documents(spark, models, sf_dir):
    from shiftledger.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op11_alignment"](spark, sf_dir).select(*PLAIN).collect()
    short = {d for d, t in docs if len(t or "") < 4000}
    # counts are over all documents, but comparing every pair of tokens is for short texts only
    plain = [(d, t) for d, t in docs if d in short]
    want = {eval(r)[0]: eval(r) for r in aligned(models, plain)}
    for r in found:
        if r.doc_id in short:
            assert tuple(r)[:5] == want[r.doc_id][:5] and r.groups_sha256 == want[r.doc_id][-1]
    assert len(found) == len(docs) and len(short) > 100


def test_odd_documents(spark, models, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.where("doc_id IS NULL OR doc_id <> 6").collect()]
    found = align_documents(odd_docs.where("doc_id IS NULL OR doc_id <> 6"))
    assert sorted(repr(tuple(r)) for r in found.collect()) == aligned(models, rows)
    long = align_documents(odd_docs.where("doc_id = 6")).first()
    a, b = tokens(models, odd_docs.where("doc_id = 6").first().text)
    assert (long.n_a, long.n_b, long.n_links) == (len(a), len(b), len(set(ends(a)) & set(ends(b))))
    assert align_documents(no_docs).count() == 0


def test_pointer_jumping_against_components():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 60)
        cuts = [sorted({n, *(rng.randrange(1, n + 1) for _ in range(rng.randrange(0, n + 1)))}) for _ in range(2)]
        a, b = (np.array(c) for c in cuts)
        label_a, label_b = group_labels(a, b)
        common = sorted(set(cuts[0]) & set(cuts[1]))
        for label, its in ((label_a, cuts[0]), (label_b, cuts[1])):
            assert [cuts[0][x] for x in label] == [min(c for c in common if c >= e) for e in its]
    chain = np.arange(2, 20_001, 2)
    label_a, label_b = group_labels(chain, np.append(chain[:-1] - 1, chain[-1]))
    assert set(label_a) == set(label_b) == {len(chain) - 1}

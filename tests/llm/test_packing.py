import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from shiftledger.llm import packing


def test_round_trip(spark, sf_dir, odd_docs, no_docs):
    model = Tokenizer.from_file(packing.tokenizer_path())
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), odd_docs):
        want, pieces = defaultdict(int), defaultdict(int)
        for r in docs.collect():
            ids = np.array([*model.encode(r.text or "", add_special_tokens=False).ids, 2], dtype="<u4")
            for s in range(0, len(ids), 4096):
                want[r.doc_id, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()), len(ids)] += 1
        windows = defaultdict(list)
        for r in packing.pack_documents(docs).collect():
            pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
            windows[r.sequence_id].append((r["offset"], r.length))
        assert pieces == want
        for its in windows.values():
            its.sort()
            assert [o for o, _ in its] == [sum(n for _, n in its[:i]) for i in range(len(its))]
            assert sum(n for _, n in its) <= 4096
        used = sum(n for its in windows.values() for _, n in its)
        assert len(windows) <= 1.05 * used / 4096 + 1
    assert packing.pack_documents(no_docs).count() == 0


def test_small_bins_pack_all(spark, odd_docs):
    assert packing.pack_documents(odd_docs, window=64, bin_pieces=7).agg({"length": "sum"}).first()[0] == (
        packing.pack_documents(odd_docs).agg({"length": "sum"}).first()[0]
    )


def test_best_fit_is_the_tightest_window():
    draw = random.Random(1)
    lengths = sorted((draw.randint(1, 100) for _ in range(400)), reverse=True)
    got, offsets = packing.best_fit(lengths, 100)
    rooms: list[int] = []
    for length, window, offset in zip(lengths, got, offsets):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            assert rooms[window] == min(fitting)
        else:
            assert window == len(rooms)
            rooms.append(100)
        assert offset == 100 - rooms[window]
        rooms[window] -= length


def test_words_are_encoded_alike_with_a_tiny_cache(monkeypatch):
    model = Tokenizer.from_file(packing.tokenizer_path())
    monkeypatch.setattr(packing, "CACHED_WORDS", 16)
    texts = ["Hello, World! it's <|endoftext|> <|ENDOFTEXT|> É. é. ok...", "", "don't. T's. %. x%. 3a. a1. İ. ΑΣ.", "日本語. x　y", "a b c " * 50]
    for text in texts * 2:
        got = packing.token_ids([text.encode()], packing.TOKENIZER)[0]
        assert got.tolist() == model.encode(text, add_special_tokens=False).ids

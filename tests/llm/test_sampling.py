import zlib
from collections import Counter
from math import exp, log

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiftledger.llm import langid, toxicity
from shiftledger.llm.sampling import labelled_sample, water_level


def free(n):
    """Ids that are not held out."""
    return [i for i in range(4 * n) if zlib.crc32(str(i).encode()) % 4 != 2][:n]


def test_water_level():
    assert water_level([], 10) == 1 and water_level([3, 4], 100) == 4
    for counts in ([20_000, 3], [5, 5, 5], [1, 2, 3, 100], [7], [1] * 50):
        for most in (1, 4, 10, 37):
            level = water_level(counts, most)
            assert level == 1 or sum(min(c, level) for c in counts) <= most
            assert sum(counts) <= most or sum(min(c, level + 1) for c in counts) > most


def test_rare_languages_are_learned(spark):
    ids = free(2003)
    rows = [(i, "the ship went out and the men were glad", "en") for i in ids[:2000]]
    rows += [(i, "das schiff fuhr hinaus und die männer waren froh", "de") for i in ids[2000:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_on(docs, train_docs=100)
    assert model.languages == ["de", "en"] and np.allclose(np.exp(model.prior), [3 / 2003, 2000 / 2003])
    assert model.predict([b"und die schiffe", b"the ships"])[0] == ["de", "en"]


def test_long_texts_are_learned(spark):
    ids = free(40)
    rows = [(i, ("the ship went out " if n % 2 else "das schiff fuhr hinaus ") * 4000, "en" if n % 2 else "de") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_on(docs)
    assert model.languages == ["de", "en"] and model.predict([b"schiff", b"ship"])[0] == ["de", "en"]
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    assert toxicity.fit_on(docs, labels) is not None
    few, counts = labelled_sample(docs, docs, 100, 400_000, "lang", group="lang")
    # a group ends with the text that reaches its share
    assert counts == {"de": 20, "en": 20} and few.groupby("lang").text.agg(lambda t: t.str.len().sum()).between(200_000, 400_000).all()
    assert not len(labelled_sample(docs, docs, 100, 1_000, "lang", group="lang")[0])


def test_contradictions_and_repeats(spark):
    a, b, c, d = free(4)
    rows = [(a, "one", "en"), (a, "one more", "en"), (b, "two", "en"), (b, "zwei", "de"), (c, "three", None), (d, "", "en"), (None, "x", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("size", F.lit(1)).withColumn("label", F.lit("z"))
    found, counts = labelled_sample(docs, docs, 10, 1000, "lang", group="lang")
    assert found[["doc_id", "text", "lang"]].values.tolist() == [[a, "one", "en"]] and counts == {"en": 1}


def by_dictionaries(sample, text):
    """Sum of log frequencies by language, word by word, with backing off."""
    letters = [chr(c) for c in range(128) if chr(c).isalpha()]

    def words(t):
        out, now = [], ""
        for ch in t:
            if ch in letters or ord(ch) >= 128:
                now += ch.lower() if ord(ch) < 128 else ch
            elif now:
                out.append(now)
                now = ""
        return out + [now] * bool(now)

    def grams(word, n):
        marked = f"\n{word}\n"
        found = [marked[i : i + n] for i in range(len(marked) - n + 1)]
        return [g for g in found if g != "\n"] if n == 1 else found

    languages = sorted({lang for _, lang in sample})
    counts = [{lang: Counter() for lang in languages} for _ in range(langid.LONGEST_GRAM + 1)]
    for t, lang in sample:
        for w in words(t):
            counts[0][lang][w] += 1
            for n in range(1, langid.LONGEST_GRAM + 1):
                counts[n][lang].update(grams(w, n))

    def log_p(n, lang, key):
        known = len(set().union(*counts[n].values()))
        total = sum(counts[n][lang].values())
        return log((counts[n][lang][key] + langid.SMOOTHING) / (total + langid.SMOOTHING * known))

    sums, useful = dict.fromkeys(languages, 0.0), 0
    for w in words(text):
        for n in range(langid.LONGEST_GRAM + 1):
            length = langid.LONGEST_GRAM + 1 - n if n else 0
            keys = [w] if not length else grams(w, length)
            known = [k for k in keys if any(counts[length][lang][k] for lang in languages)]
            if known:
                useful += 1
                for lang in languages:
                    sums[lang] += sum(log_p(length, lang, k) for k in known) / len(known)
                break
    share = Counter(lang for _, lang in sample)
    tempered = min(1.0, langid.EVIDENCE_WORDS / max(useful, 1))
    total = {lang: sums[lang] * tempered + log(share[lang] / len(sample)) for lang in languages}
    best = max(languages, key=lambda lang: total[lang])
    return best, 1 / sum(exp(total[lang] - total[best]) for lang in languages)


def test_language_scores_against_dictionaries():
    sample = [
        ("The ship went out, and THE men were glad.", "en"), ("A man and a dog", "en"), ("über den Fluß und zurück", "de"),
        ("der Mann und der Hund", "de"), ("el hombre y el perro", "es"),
    ]
    model = langid.fit(pd.DataFrame(sample, columns=["text", "lang"]))
    texts = ["the man", "Hunde", "perros y hombres", "shipping", "zzz", "und und und the", "Fluß " * 40, "xq Qx é", "THE", "Über"]
    langs, scores = model.predict([t.encode() for t in texts])
    for text, lang, score in zip(texts, langs, scores):
        want = by_dictionaries(sample, text)
        assert lang == want[0] and score == pytest.approx(want[1], rel=1e-9), text

"""Language identification: known words by their log frequency, others by ever shorter n-grams.

The model counts words and character n-grams (with the word's ends) by language on at most
``TRAIN_DOCS`` whole documents of known language and ``TRAIN_CHARS`` characters, equally many of each
language that has enough; how frequent a language is, is counted over all documents. It knows the
``KNOWN_WORDS`` most frequent words and as many n-grams of each length. A word of a text scores ``log p(word | language)`` if
the model knows it. If not, its n-grams of the greatest length of which it knows any count, down to
single characters. A text's language has the greatest sum; its score is the posterior of that
language with the evidence of a text tempered to ``EVIDENCE_WORDS`` words at most.

Words are runs of characters other than ASCII signs, digits and white space, with A-Z lower-cased;
beyond that case counts. A null text, or one without a letter, is ``und`` with score zero; so is
everything if there is nothing to learn from. Texts with letters but no word known in any way get
the most frequent language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import labelled_sample
from .texts import LOWER, as_bytes, joined, pair_hashes, prefix_sums, slices, span_hashes, text_of

TRAIN_DOCS = 5_000
#: Characters of all training texts together.
TRAIN_CHARS = 48_000_000
KNOWN_WORDS = 100_000
KNOWN_GRAMS = 100_000
LONGEST_GRAM = 5
SMOOTHING = 0.5
EVIDENCE_WORDS = 20.0
UNKNOWN = "und"

_APART = np.zeros(256, dtype=bool)
_APART[:128] = True
_APART[[*range(65, 91), *range(97, 123)]] = False


@dataclass
class Words:
    """Words of texts on A-Z lower-cased bytes."""

    data: np.ndarray
    begins: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


def cut_words(texts: list[bytes]) -> Words:
    data, begins = joined(texts)
    data = LOWER[data]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = ~_APART[data]
    step = np.diff(inside)
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    hashes = span_hashes(prefix_sums(data), begin, end)
    return Words(data, begins, begin, end, text_of(begins, begin), hashes)


def word_bytes(words: Words, which: np.ndarray) -> list[bytes]:
    raw = words.data.tobytes()
    return [raw[a:b] for a, b in zip(words.begin[which].tolist(), words.end[which].tolist())]


def grams(words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-gram of ``length`` characters, and the number of its word. Ends count as characters."""
    codes = np.frombuffer(
        ("\n" + "\n".join(w.decode(errors="ignore") for w in words) + "\n").encode("utf-32-le"), dtype="<u4"
    )
    breaks = np.flatnonzero(codes == 10)
    sums = prefix_sums(codes)
    begin = np.arange(max(0, len(codes) - length + 1))
    word = np.searchsorted(breaks, begin, side="right") - 1
    whole = (word < len(words)) & (begin + length - 1 <= breaks[np.minimum(word + 1, len(breaks) - 1)])
    if length == 1:
        whole &= codes[begin] != 10
    begin, word = begin[whole], word[whole]
    return span_hashes(sums, begin, begin + length), word


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    #: hash -> row of ``log p`` by language; length 0 holds whole words
    tables: dict[int, tuple[np.ndarray, np.ndarray]]

    def lookup(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is known, and its row."""
        keys, _ = self.tables[length]
        if not len(keys):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return keys[at] == hashes, at

    def by_grams(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``log p`` by language of unknown words, and whether any of their n-grams is known."""
        scores = np.zeros((len(words), len(self.languages)))
        done = np.zeros(len(words), dtype=bool)
        left = np.arange(len(words))
        for length in range(LONGEST_GRAM, 0, -1):
            if not len(left):
                break
            hashes, word = grams([words[i] for i in left.tolist()], length)
            known, at = self.lookup(length, hashes)
            word, at = word[known], at[known]
            n = np.bincount(word, minlength=len(left))
            values = self.tables[length][1][at]
            for k in range(len(self.languages)):
                total = np.bincount(word, weights=values[:, k], minlength=len(left))
                scores[left, k] = total / np.maximum(n, 1)
            done[left] = n > 0
            left = left[n == 0]
        return scores, done

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        words = cut_words(texts)
        known, at = self.lookup(0, words.hash)
        scores = np.zeros((len(words.hash), len(self.languages)), dtype=np.float64)
        scores[known] = self.tables[0][1][at[known]]
        useful = known.copy()
        new = np.flatnonzero(~known)
        if len(new):
            _, first, inverse = np.unique(words.hash[new], return_index=True, return_inverse=True)
            rows, done = self.by_grams(word_bytes(words, new[first]))
            scores[new], useful[new] = rows[inverse], done[inverse]
        total = np.stack(
            [np.bincount(words.row, weights=scores[:, k], minlength=len(texts)) for k in range(len(self.languages))], axis=1
        ).astype(float)
        n = np.bincount(words.row, weights=useful, minlength=len(texts))
        total *= np.minimum(1.0, EVIDENCE_WORDS / np.maximum(n, 1.0))[:, None]
        total += self.prior
        best = total.argmax(axis=1)
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        score = odds.max(axis=1) / odds.sum(axis=1)
        return [self.languages[i] for i in best.tolist()], score


def _table(hashes: np.ndarray, language: np.ndarray, weight: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` most frequent hashes, sorted, and their smoothed log frequency by language."""
    keys, inverse = np.unique(hashes, return_inverse=True)
    counts = np.stack(
        [np.bincount(inverse, weights=weight * (language == k), minlength=len(keys)) for k in range(n)], axis=1
    )
    log_p = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * len(keys)))
    keep = np.sort(np.argsort(-counts.sum(axis=1), kind="stable")[:most])
    return keys[keep], log_p[keep]


def fit(
    sample: pd.DataFrame, counts: dict[str, int] | None = None, known_words: int = KNOWN_WORDS, known_grams: int = KNOWN_GRAMS
) -> Model | None:
    """A model from rows of ``text, lang``; languages are as frequent as ``counts`` says, else as in the rows."""
    if not len(sample):
        return None
    languages = sorted(sample["lang"].unique())
    of = sample["lang"].map({name: k for k, name in enumerate(languages)}).to_numpy()
    n_of = np.array([counts[name] for name in languages]) if counts else np.bincount(of, minlength=len(languages))
    prior = np.log(n_of / n_of.sum())
    texts = [t.encode() for t in sample["text"]]
    keys, hashes, language, count, words = [], [], [], [], []
    for lo, hi in slices(texts):
        cut = cut_words(texts[lo:hi])
        its = of[lo:hi][cut.row]
        key, first, n = np.unique(
            pair_hashes(cut.hash, its.astype(np.uint64)), return_index=True, return_counts=True
        )
        keys.append(key)
        hashes.append(cut.hash[first])
        language.append(its[first])
        count.append(n)
        words += word_bytes(cut, first)
    # each word of a language once, with its count over all texts
    _, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    count = np.bincount(inverse, weights=np.concatenate(count))
    hashes, language = np.concatenate(hashes)[first], np.concatenate(language)[first]
    words = [words[i] for i in first.tolist()]
    n = len(languages)
    tables = {0: _table(hashes, language, count, n, known_words)}
    for length in range(1, LONGEST_GRAM + 1):
        gram, word = grams(words, length)
        tables[length] = _table(gram, language[word], count[word], n, known_grams)
    return Model(languages, prior, tables)


def language_column(text: Column, model: Model | None) -> Column:
    """Struct ``lang, score`` of a text."""

    def identify(texts: pa.Array) -> pa.Array:
        raw = as_bytes(texts)
        langs, scores = [], []
        for lo, hi in slices(raw):
            part = raw[lo:hi]
            if model is None:
                found, score = [UNKNOWN] * len(part), np.zeros(len(part))
            else:
                found, score = model.predict(part)
            for i, text_ in enumerate(part):
                if not any(c.isalpha() for c in text_.decode(errors="ignore")):
                    found[i], score[i] = UNKNOWN, 0.0
            langs += found
            scores += score.tolist()
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
        )

    return F.arrow_udf(identify, "struct<lang:string,score:double>")(text)


def fit_on(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from the rows of ``docs`` that have a language and are not held out."""
    return fit(*labelled_sample(docs, docs, train_docs, train_chars, "lang", group="lang"))

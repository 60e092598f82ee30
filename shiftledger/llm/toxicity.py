"""Toxicity: a convolutional text classifier trained in numpy.

Words (runs of characters other than ASCII signs, digits and white space, A-Z lower-cased) have
hashed embeddings: the sum of the rows of the word itself, of its first 4 and 7 bytes and of its
last 4. Filters over one, two and three neighbouring words are rectified and max-pooled over the
whole text, and a logistic layer gives a probability. Each round of training sees another random part of the
words, so that every telling word is learned, not only the first ones that explain a text. Thresholds are calibrated by language on
examples kept from training; the language is guessed from the words by frequencies of the training
examples. The score is the probability with its log odds moved so that the language's threshold lies at
``CUT``, and a text is predicted toxic from there on.

Training begins with at most ``TRAIN_DOCS`` whole labelled documents with ``TRAIN_CHARS`` characters together,
all of a language that has few and equally many of the others. If these are not all, the weights found only
begin the work: words are counted over all training rows, every one of them is then learned from in parts
whose changes are averaged, and thresholds come from all rows kept from training. Scoring takes whole texts. A null text, or one without words, pools to zero and gets the score of that. If
there is nothing to learn from, or only one label, every score is zero.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import lease, stage
from .langid import Words, cut_words
from .sampling import labelled_sample, learnable_rows
from .texts import as_bytes, prefix_sums, slices, span_hashes

TRAIN_DOCS = 7_000
#: Characters of all training texts together.
TRAIN_CHARS = 48_000_000
ROWS = 1 << 16
WIDTH = 16
FILTERS = 24
SPANS = (1, 2, 3)
#: Examples seen in training, in as many rounds as that takes, at most ``MOST_EPOCHS``.
EXAMPLES_SEEN = 42_000
MOST_EPOCHS = 12
#: Rows of the table that fewer training texts touch stay zero, or they would learn single texts by heart.
LEAST_TEXTS = 4
#: Share of the words of a text that a round of training sees: no word may lean on others beside it.
KEPT_WORDS = 0.3
BATCH = 64
RATE = 0.1
CUT = 0.3
CALIBRATION_SHARE = 0.25
#: Training rows of one part, whose changes of the weights are averaged with those of other parts.
PART_DOCS = 5_000
#: Steps of a log odd that thresholds over all rows are told apart by.
CUT_STEPS = 1_000
#: Fewer toxic examples of a language than this share the threshold of all languages.
LEAST_TOXIC = 12

_PARTS = 4
_GAP = max(SPANS) - 1


def word_rows(words: Words) -> np.ndarray:
    """Rows of the embedding table for each word: ``[n, _PARTS]``, in 16 bits each."""
    sums = prefix_sums(words.data)
    begin, end = words.begin, words.end
    spans = (
        (begin, end),
        (begin, np.minimum(begin + 4, end)),
        (begin, np.minimum(begin + 7, end)),
        (np.maximum(end - 4, begin), end),
    )
    out = np.empty((len(begin), _PARTS), dtype=np.uint16)
    for i, (a, b) in enumerate(spans):
        salted = span_hashes(sums, a, b) * np.uint64(2 * i + 1)
        out[:, i] = salted >> np.uint64(48)
    return out


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    languages: list[str]
    language_rows: np.ndarray
    language_prior: np.ndarray
    cuts: np.ndarray

    def embed(self, rows: np.ndarray) -> np.ndarray:
        x = self.table[rows[:, 0]]
        for i in range(1, _PARTS):
            x = x + self.table[rows[:, i]]
        return x

    def activations(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter outputs before the rectifier at each position of padded words."""
        n = len(x) - _GAP
        out = []
        for w, b in zip(self.filters, self.bias):
            z = x[:n] @ w[0] + b
            for j in range(1, len(w)):
                z += x[j : j + n] @ w[j]
            out.append(z)
        return out

    def logits(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log odds of each text; ``counts`` has its number of words."""
        if not len(counts):
            return np.empty(0)
        x, begins = _padded(self.embed(rows), counts)
        pooled = np.hstack([np.maximum(np.maximum.reduceat(z, begins, axis=0), 0) for z in self.activations(x)])
        pooled[counts == 0] = 0
        return (pooled @ self.out + self.out_bias).astype(np.float64)

    def language_of(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(counts)), counts)
        total = np.stack(
            [np.bincount(row, weights=self.language_rows[rows[:, 0], k], minlength=len(counts)) for k in range(len(self.languages))],
            axis=1,
        )
        return (total + self.language_prior).argmax(axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        words = cut_words(texts)
        counts = np.bincount(words.row, minlength=len(texts))
        rows = word_rows(words)
        cut = self.cuts[self.language_of(rows, counts)]
        return _sigmoid(self.logits(rows, counts) - cut + np.log(CUT / (1 - CUT)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _padded(x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts with zero rows after each text, and where each text begins."""
    sizes = counts + _GAP + 1
    ends = np.cumsum(sizes)
    out = np.zeros((int(ends[-1]) + _GAP, x.shape[1]), dtype=np.float32)
    words_before = np.cumsum(counts) - counts
    out[np.arange(len(x)) + np.repeat(ends - sizes - words_before, counts)] = x
    return out, ends - sizes


def _bare(seed: int) -> tuple[Model, np.random.Generator]:
    """A model before training."""
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
    filters = [draw.normal(0, 1 / np.sqrt(WIDTH * s), (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS]
    bias = [np.zeros(FILTERS, np.float32) for _ in SPANS]
    out = draw.normal(0, 0.3, FILTERS * len(SPANS)).astype(np.float32)
    none = np.empty(0)
    return Model(table, filters, bias, out, -1.0, [], none, none, none), draw


class _Trainer:
    """A model in training, with the squared steps so far by which steps become smaller."""

    def __init__(self, model: Model, rare: np.ndarray):
        self.model, self.rare = model, rare
        self.sums = {"table": np.full(ROWS, 1e-3, np.float32), "out": np.full(model.out.shape, 1e-3, np.float32), "out_bias": 1e-3}
        self.filter_sums = [np.full(w.shape, 1e-3, np.float32) for w in model.filters]
        self.bias_sums = [np.full(b.shape, 1e-3, np.float32) for b in model.bias]

    def see(self, rows: list[np.ndarray], toxic: np.ndarray, draw: np.random.Generator) -> None:
        """All examples once, in random order."""
        order = draw.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            pick = order[lo : lo + BATCH]
            self._step([rows[i][draw.random(len(rows[i])) < KEPT_WORDS] for i in pick], toxic[pick])

    def _step(self, shown: list[np.ndarray], toxic: np.ndarray) -> None:
        model, sums, filter_sums, bias_sums = self.model, self.sums, self.filter_sums, self.bias_sums
        part = np.concatenate(shown)
        counts = np.array([len(its) for its in shown])
        x, begins = _padded(model.embed(part), counts)
        outputs = model.activations(x)
        # where each filter is greatest in each text
        at = [
            np.stack([z[b : b + max(c, 1)].argmax(axis=0) + b for b, c in zip(begins, counts)]) for z in outputs
        ]
        columns = np.arange(FILTERS)
        pooled = [np.maximum(z[a, columns], 0) for z, a in zip(outputs, at)]
        hidden = np.hstack(pooled)
        error = (_sigmoid(hidden @ model.out + model.out_bias) - toxic).astype(np.float32) / len(shown)
        back = error[:, None] * model.out * (hidden > 0)
        g = hidden.T @ error
        sums["out"] += g * g
        model.out -= RATE * g / np.sqrt(sums["out"])
        g = float(error.sum())
        sums["out_bias"] += g * g
        model.out_bias -= RATE * g / np.sqrt(sums["out_bias"])
        # embeddings of the words under the greatest outputs
        word_at = np.full(len(x), -1)
        word_at[np.arange(len(part)) + np.repeat(begins - (np.cumsum(counts) - counts), counts)] = np.arange(len(part))
        to_words, grads = [], []
        for f, a in enumerate(at):
            b = back[:, f * FILTERS : (f + 1) * FILTERS]
            gb = b.sum(axis=0)
            bias_sums[f] += gb * gb
            gw = np.empty_like(model.filters[f])
            for j in range(SPANS[f]):
                gw[j] = np.einsum("tfw,tf->wf", x[a + j], b)
                to_words.append(word_at[a + j].ravel())
                grads.append((b[:, :, None] * model.filters[f][j].T[None]).reshape(-1, WIDTH))
            filter_sums[f] += gw * gw
            model.filters[f] -= RATE * gw / np.sqrt(filter_sums[f])
            model.bias[f] -= RATE * gb / np.sqrt(bias_sums[f])
        word, grad = np.concatenate(to_words), np.concatenate(grads)
        live = (word >= 0) & grad.any(axis=1)
        word, grad = word[live], grad[live]
        touched = part[word]
        unique, inverse = np.unique(touched, return_inverse=True)
        g = np.zeros((len(unique), WIDTH), np.float32)
        np.add.at(g, inverse.reshape(touched.shape), grad[:, None, :])
        g[self.rare[unique]] = 0
        sums["table"][unique] += (g * g).sum(axis=1)
        model.table[unique] -= RATE * g / np.sqrt(sums["table"][unique])[:, None]


def _rounds(n_examples: int) -> int:
    return min(MOST_EPOCHS, -(-EXAMPLES_SEEN // max(1, n_examples)))


def _train(rows: list[np.ndarray], toxic: np.ndarray, seed: int = 7) -> _Trainer:
    model, draw = _bare(seed)
    texts_by_row = np.zeros(ROWS, np.int64)
    for its in rows:
        texts_by_row[np.unique(its)] += 1
    rare = texts_by_row < LEAST_TEXTS
    model.table[rare] = 0
    trainer = _Trainer(model, rare)
    for _ in range(_rounds(len(rows))):
        trainer.see(rows, toxic, draw)
    return trainer


def _best_cut(logits: np.ndarray, toxic: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The log odds with the greatest F1, in the middle of the gap below it.

    With ``counts``, each of the log odds stands for so many texts, ``toxic`` of them toxic.
    """
    order = np.argsort(-logits, kind="stable")
    ranked, hits = logits[order], np.cumsum(toxic[order])
    seen = np.arange(len(order)) + 1 if counts is None else np.cumsum(counts[order])
    f1 = 2 * hits / (seen + toxic.sum())
    best = int(np.argmax(f1))
    below = ranked[best + 1] if best + 1 < len(ranked) else ranked[best] - 1
    return float((ranked[best] + below) / 2)


def _encoded(texts: list[bytes]) -> list[np.ndarray]:
    """Rows of the embedding table for the words of each text."""
    rows: list[np.ndarray] = []
    for lo, hi in slices(texts):
        words = cut_words(texts[lo:hi])
        split = np.cumsum(np.bincount(words.row, minlength=hi - lo))[:-1]
        rows += np.split(word_rows(words), split)
    return rows


def _learn_languages(model: Model, languages: list[str], counts: np.ndarray, texts: np.ndarray) -> None:
    """``counts`` of each first row by language in training, and the number of ``texts`` of each language."""
    model.languages = languages
    model.language_rows = np.log((counts + 0.5) / (counts + 0.5).sum(axis=0))
    model.language_prior = np.log((texts + 1.0) / texts.sum())


def fit(sample: pd.DataFrame) -> Model | None:
    """A model from rows of ``text, toxic, lang``; the language only names groups of thresholds."""
    toxic = (sample["toxic"] == 1).to_numpy().astype(np.float32) if len(sample) else np.empty(0)
    if len(np.unique(toxic)) < 2:
        return None
    rows = _encoded([t.encode() for t in sample["text"]])
    calibrate = np.random.default_rng(3).random(len(rows)) < CALIBRATION_SHARE
    if len(np.unique(toxic[calibrate])) < 2 or len(np.unique(toxic[~calibrate])) < 2:
        calibrate[:] = False
    train = np.flatnonzero(~calibrate)
    model = _train([rows[i] for i in train], toxic[train]).model

    languages = sorted(sample["lang"].unique())
    of = sample["lang"].map({name: k for k, name in enumerate(languages)}).to_numpy()
    counts = np.zeros((ROWS, len(languages)))
    for i in train:
        counts[:, of[i]] += np.bincount(rows[i][:, 0], minlength=ROWS)
    _learn_languages(model, languages, counts, np.bincount(of, minlength=len(languages)))

    held = np.flatnonzero(calibrate) if calibrate.any() else train
    found = []
    for lo in range(0, len(held), BATCH):
        part = [rows[i] for i in held[lo : lo + BATCH]]
        sizes = np.array([len(r) for r in part])
        joint = np.concatenate(part)
        found.append((model.logits(joint, sizes), model.language_of(joint, sizes)))
    logits, guessed = (np.concatenate(x) for x in zip(*found))
    overall = _best_cut(logits, toxic[held])
    cuts = []
    for k in range(len(model.languages)):
        its = guessed == k
        enough = toxic[held][its].sum() >= LEAST_TOXIC
        cuts.append(_best_cut(logits[its], toxic[held][its]) if enough else overall)
    model.cuts = np.array(cuts)
    return model


def _word_counts(train: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the table the number of texts with it, and of words that have it first by language."""
    of = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, words = np.zeros(ROWS, np.int64), np.zeros((len(of), ROWS), np.int64)
        for batch in batches:
            raw, its_of = as_bytes(batch.column("text")), [of[name] for name in batch.column("lang").to_pylist()]
            for lo, hi in slices(raw):
                for k, its in zip(its_of[lo:hi], _encoded(raw[lo:hi])):
                    texts[np.unique(its)] += 1
                    np.add.at(words[k], its[:, 0], 1)
        place = np.flatnonzero(texts)
        columns = [place.astype(np.int32), texts[place], *words[:, place]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = ["place", "texts", *[f"words{k}" for k in range(len(of))]]
    counted = train.select("text", "lang").mapInArrow(count, ", ".join(["place int", *[f"{c} bigint" for c in names[1:]]]))
    found = counted.groupBy("place").agg(*[F.sum(c).alias(c) for c in names[1:]]).toPandas()
    out = np.zeros((ROWS, len(names) - 1))
    out[found["place"].to_numpy()] = found[names[1:]].to_numpy()
    return out[:, 0], out[:, 1:]


def _weights(model: Model) -> np.ndarray:
    """All weights in one matrix as wide as the table, whose rows come first."""
    rest = np.concatenate([*[w.ravel() for w in model.filters], *model.bias, model.out, [np.float32(model.out_bias)]])
    rest = np.pad(rest, (0, -len(rest) % WIDTH)).astype(np.float32)
    return np.vstack([model.table, rest.reshape(-1, WIDTH)])


def _move(model: Model, by: np.ndarray) -> None:
    """Add to the weights a matrix made like theirs."""
    model.table += by[:ROWS]
    rest, at = by[ROWS:].ravel(), 0
    for part in (*model.filters, *model.bias, model.out):
        part += rest[at : at + part.size].reshape(part.shape)
        at += part.size
    model.out_bias += float(rest[at])


def _learn_all(train: DataFrame, trainer: _Trainer, n_rows: int, seed: int) -> None:
    """One pass over all training rows: each part goes on from the weights so far, and their changes are averaged.

    A word's weights are averaged over the parts that changed them, so a word of few parts is learned as fast.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its, draw = copy.deepcopy(trainer), np.random.default_rng(seed)
        before = _weights(its.model)
        for batch in batches:
            raw, toxic = as_bytes(batch.column("text")), batch.column("toxic").to_numpy().astype(np.float32)
            for lo, hi in slices(raw):
                its.see(_encoded(raw[lo:hi]), toxic[lo:hi], draw)
        change = _weights(its.model) - before
        place = np.flatnonzero(change.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), *[pa.array(c) for c in change[place].T.copy()]], names)

    names = ["place", *[f"w{i}" for i in range(WIDTH)]]
    order = F.xxhash64("doc_id")
    parts = train.repartition(-(-n_rows // PART_DOCS), order).sortWithinPartitions(order, "doc_id")
    changes = parts.select("text", "toxic").mapInArrow(learn, ", ".join(["place int", *[f"{c} float" for c in names[1:]]]))
    found = changes.groupBy("place").agg(*[F.avg(c).alias(c) for c in names[1:]]).toPandas()
    by = np.zeros(_weights(trainer.model).shape, np.float32)
    by[found["place"].to_numpy()] = found[names[1:]].to_numpy()
    _move(trainer.model, by)


def _cuts_of_all(held: DataFrame, model: Model) -> np.ndarray:
    """Thresholds by language over all rows kept from training, whose log odds Spark counts in small steps."""

    def judge(texts: pa.Array) -> pa.Array:
        raw, step, guess = as_bytes(texts), [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for lo, hi in slices(raw):
            words = cut_words(raw[lo:hi])
            counts, rows = np.bincount(words.row, minlength=hi - lo), word_rows(words)
            step.append(np.rint(model.logits(rows, counts) * CUT_STEPS).astype(np.int64))
            guess.append(model.language_of(rows, counts).astype(np.int32))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(step)), pa.array(np.concatenate(guess))], ["step", "guess"])

    judged = held.select("toxic", F.arrow_udf(judge, "struct<step:bigint,guess:int>")("text").alias("found"))
    steps = judged.groupBy("found.step", "found.guess").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).toPandas()

    def cut(its: pd.DataFrame) -> float:
        its = its.groupby("step", as_index=False)[["n", "toxic"]].sum()
        return _best_cut(its["step"].to_numpy() / CUT_STEPS, its["toxic"].to_numpy(), its["n"].to_numpy())

    overall, cuts = cut(steps), []
    for k in range(len(model.languages)):
        its = steps[steps["guess"] == k]
        cuts.append(cut(its) if its["toxic"].sum() >= LEAST_TOXIC else overall)
    return np.array(cuts)


def fit_all(examples: DataFrame, first: pd.DataFrame) -> Model | None:
    """A model from all rows of ``doc_id, text, toxic, lang, held``, stored ones, beginning with some of them.

    Rows with ``held`` set give the thresholds and no weights, unless they or the others have one label only.
    """
    examples = examples.withColumn("toxic", (F.col("toxic") == 1).cast("int"))
    facts = examples.groupBy("held", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).toPandas()
    if not 0 < facts["toxic"].sum() < facts["n"].sum():
        return None
    sides = facts.groupby("held")[["n", "toxic"]].sum()
    split = len(sides) == 2 and ((sides["toxic"] > 0) & (sides["toxic"] < sides["n"])).all()
    train, held = (examples.where(F.col("held") == side) if split else examples for side in ("false", "true"))
    if split:
        first = first[first["held"] == "false"]
    trainer = _train(_encoded([t.encode() for t in first["text"]]), (first["toxic"] == 1).to_numpy().astype(np.float32))
    languages = facts.groupby("lang")["n"].sum().sort_index()
    texts, words = _word_counts(train, list(languages.index))
    rare = texts < LEAST_TEXTS
    known_now = trainer.rare & ~rare
    trainer.model.table[known_now] = _bare(7)[0].table[known_now]
    trainer.rare = rare
    _learn_languages(trainer.model, list(languages.index), words, languages.to_numpy())
    n_rows = int(sides["n"]["false"] if split else facts["n"].sum())
    # the first examples were seen in many rounds already; all rows follow once at least
    left = EXAMPLES_SEEN - _rounds(len(first)) * len(first)
    for seed in range(max(1, min(MOST_EPOCHS, -(-left // n_rows)))):
        _learn_all(train, trainer, n_rows, seed)
    trainer.model.cuts = _cuts_of_all(held, trainer.model)
    return trainer.model


def score_column(text: Column, model: Model | None) -> Column:
    """Score from 0 to 1 of a text."""

    def score(texts: pa.Array) -> pa.Array:
        raw = as_bytes(texts)
        if model is None:
            return pa.array(np.zeros(len(raw)))
        parts = [model.scores(raw[lo:hi]) for lo, hi in slices(raw)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return F.arrow_udf(score, "double")(text)


def fit_on(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from all labelled rows that are not held out."""
    usable = labels.where(F.col("toxic").isNotNull()).select("doc_id", "toxic")
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(round(1 / CALIBRATION_SHARE))) == 0
    docs = docs.withColumn("held", dealt.cast("string"))
    keep = ("lang", "held")
    first, counts = labelled_sample(docs, usable, train_docs, train_chars, "toxic", group="lang", keep=keep)
    if len(first) == sum(counts.values()):
        return fit(first)
    with lease(docs.sparkSession):
        return fit_all(stage(learnable_rows(docs, usable, "toxic", keep=keep), "toxic-examples"), first)

"""Quality by naive Bayes support vectors.

A text is the set of its n-grams: single words, and one to three shapes in a row, where a
shape says which kinds of characters a word is made of and whether the word repeats the one
before. Each n-gram's indicator is scaled by the log ratio of its frequencies in the two
classes, and a linear model is fitted to the scaled indicators with the hinge loss.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelmetrics.llm.common import fold, pieces
from reelmetrics.llm.svm import calibrate, fit, logistic
from reelmetrics.llm.toxicity import labelled_sample

#: Labelled rows of each class that are used at most, and n-grams of the model: those in the most of them.
SAMPLE_ROWS = 3000
LEAST_DOCUMENTS, MOST_NGRAMS = 5, 50_000
KEPT_WORDS = 400_000
FOLDS, HELD_OUT = 4, 2
SMOOTH = 1.0

LOWER, UPPER, DIGITS = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")
RUN = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """Kinds of characters in their order: x for small letters, X for capitals, 0 for digits;
    signs stand for themselves, and a run of one kind is one (of signs: twice if longer)."""
    if word.isalpha():
        if word.islower():
            return "x"
        if len(word) > 1 and word.istitle():
            return "Xx"
    return RUN.sub(r"\1\1", DIGITS.sub("0", UPPER.sub("X", LOWER.sub("x", word))))


class Shapes:
    """Small numbers for shapes, and the words they were found for."""

    def __init__(self):
        self.number: dict[str, int] = {"=": 0}
        self.kept: dict[str, int] = {}

    def of(self, words: list[str]) -> list[int]:
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        for w in set(words).difference(self.kept):
            self.kept[w] = self.number.setdefault(shape(w), len(self.number))
        found = list(map(self.kept.__getitem__, words))
        # A word that repeats the one before has the shape of a repeat.
        if any(map(eq, words[1:], words)):
            found = [found[0], *(0 if a == b else s for a, b, s in zip(words, words[1:], found[1:]))]
        return found

    def ngrams(self, text: str) -> tuple[set[str], set[tuple[int, ...]]]:
        words = text.split()
        s = self.of(words) if words else []
        return set(words), {(a,) for a in set(s)} | set(zip(s, s[1:])) | set(zip(s, s[1:], s[2:]))


class Quality:
    """The trained model: a weight for each n-gram by its key, and the curve of the scores."""

    def __init__(self, words: dict[str, float], shapes: dict[tuple[str, ...], float], offset: float, curve: tuple[float, float]):
        self.words, self.shape_weights, self.offset, self.curve = words, shapes, offset, curve
        self.shapes = Shapes()
        self.numbered: dict[tuple[int, ...], float] = {}

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.numbered:
            for key in self.shape_weights:
                for name in key:
                    self.shapes.number.setdefault(name, len(self.shapes.number))
            self.numbered = {tuple(self.shapes.number[n] for n in key): w for key, w in self.shape_weights.items()}
        margins = []
        for text in texts:
            words, shapes = self.shapes.ngrams(text)
            margins.append(self.offset + sum(map(self.words.__getitem__, words & self.words.keys())) + sum(map(self.numbered.__getitem__, shapes & self.numbered.keys())))
        if len(self.shapes.number) > KEPT_WORDS:
            self.shapes, self.numbered = Shapes(), {}
        return logistic(self.curve[0] * np.array(margins) + self.curve[1])


def train(texts: list[str], good: np.ndarray, cost: float = 1.0) -> Quality | None:
    """A model from labelled texts (1: good); None without both classes."""
    if not 0 < good.sum() < len(good):
        return None
    shapes = Shapes()
    own = [shapes.ngrams(t) for t in texts]
    name = {n: s for s, n in shapes.number.items()}
    counts: Counter = Counter()
    for words, grams in own:
        counts.update(words)
        counts.update(grams)
    chosen = sorted(((-n, isinstance(g, str), repr(g), g) for g, n in counts.items() if n >= min(LEAST_DOCUMENTS, len(texts))))[:MOST_NGRAMS]
    column = {g: i for i, (*_, g) in enumerate(chosen)}
    width = len(column)
    index = [np.array(sorted([column[g] for g in words | grams if g in column]), np.int64) for words, grams in own]
    # Log ratios of the classes' frequencies.
    up, down = np.full(width, SMOOTH), np.full(width, SMOOTH)
    for at, y in zip(index, good, strict=True):
        (up if y else down)[at] += 1
    ratio = np.log(up / up.sum()) - np.log(down / down.sum())
    rows = [np.append(at, width) for at in index]
    # Rows of one length, so that long texts don't drown the rest; the intercept stays 1.
    scale = np.array([1 / max(1e-9, np.sqrt((ratio[at] ** 2).sum())) for at in index])
    y = np.where(good > 0, 1.0, -1.0)
    share = len(y) / (2 * np.where(good > 0, good.sum(), len(good) - good.sum()))
    w = fit(rows, [np.append(ratio[at], 1.0) for at in index], y, width + 1, cost * np.minimum(scale, 1) ** 2 * share, epochs=20)
    margins = np.array([w[r] @ np.append(ratio[at], 1.0) for r, at in zip(rows, index)])
    curve = calibrate(margins, good.astype(float))
    weight = ratio * w[:-1]
    return Quality(
        {g: float(weight[i]) for g, i in column.items() if isinstance(g, str) and weight[i]},
        {tuple(name[s] for s in g): float(weight[i]) for g, i in column.items() if not isinstance(g, str) and weight[i]},
        float(w[-1]),
        curve,
    )


def quality_model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> Quality | None:
    """A model from the rows of ``labels`` (doc_id, quality) outside the held-out fold."""
    use = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    return train(*labelled_sample(docs, labels, "quality", use, rows, key, text))


def quality(docs: DataFrame, model: Quality | None, key: str = "doc_id", text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1, higher for better texts; one of that name
    is replaced.

    Null and empty texts have no n-grams and score as the intercept. Without a model, which is
    so if the labels have not both classes, every score is 1: nothing is known against a text.
    Rows are scored one by one, so repeated rows change nothing, and nothing is shuffled.
    """
    if model is None:
        return docs.withColumn(score, F.lit(1.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = pieces(iter([pa.RecordBatch.from_arrays([batch], ["text"])]))
            found = [shared.value.scores(p.column("text").to_pylist()) for p in parts]
            yield pa.array(np.concatenate([np.zeros(0), *found]))

    return docs.withColumn(score, rate(F.coalesce(F.col(f"`{text}`"), F.lit(""))))

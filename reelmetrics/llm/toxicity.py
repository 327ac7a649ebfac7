"""Toxicity by support vectors over a gapped-subsequence string kernel.

Two words are alike as far as they share subsequences of three characters, with a decay for
each character that is jumped over, so that inserted characters lower a match and don't hide
it. The kernel is taken against a fixed set of landmark words (Nyström): a sentence is
described by its nearest word to each landmark, in the coordinates that make landmarks'
products their kernel values, and support vectors are trained on sentences. Only documents
are labelled, so the toxic sentences of a toxic document are found along the way: those that
score so far, and its best one at least. A document's score comes from its worst sentence and
from how many of its sentences are toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelmetrics.llm.common import fold, pieces
from reelmetrics.llm.svm import calibrate_many, fit, logistic

#: Labelled rows of each class that are used at most, the ones with the smallest hash.
SAMPLE_ROWS = 3000
LANDMARKS = 128
#: Lengths of the stems that are tried beside whole words.
STEMS = range(4, 9)
#: The share of toxic documents that a landmark stands in at least, its log odds, and both as
#: evidence: documents times log odds.
LEAST_SHARE, LEAST_ODDS, LEAST_EVIDENCE = 0.01, 2.0, 25.0
#: Decay for a character jumped over, characters from the first of three to the last at most,
#: and the kernel value that counts as none at all.
DECAY, SPAN, LEAST = 0.6, 5, 0.55
KEPT_WORDS = 400_000
#: Training texts that are described at once.
DESCRIBED = 250
FOLDS, HELD_OUT = 5, 0

PATTERNS = tuple((a, b, DECAY ** (b - 2)) for a, b in combinations(range(1, SPAN), 2))
LOOKS = str.maketrans("0134578@$!|", "oieastbasii")
SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+")
# Single letters that follow each other, with white space or signs between them.
SPELLED = re.compile(r"(?<!\w)\w(?:[\W_]{1,3}\w(?!\w)){2,}")
MARKS = re.compile(r"[\W_]+")
SIDES = re.compile(r"^[\W_]+|[\W_]+$")


def plain(word: str) -> str:
    """Letters of a word, signs and digits that look like letters read as such within it; a
    word without any letter has none."""
    if word.isalpha():
        return word.lower()
    low = SIDES.sub("", word.lower())
    return MARKS.sub("", low.translate(LOOKS)) if any(map(str.isalpha, low)) else ""


def marked(word: str) -> str:
    """The word between two marks, as its beginning tells most, and one; a stem, which ends in a
    hyphen, has none behind it."""
    return f"^^{word[:-1]}" if word[-1:] == "-" else f"^^{word}$"


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, code and weight of all subsequences of three of the words between their marks."""
    said = [marked(w) for w in words]
    chars = np.frombuffer("".join(said).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(w) for w in said])
    ends = np.repeat(np.cumsum(size), size)
    owner = np.repeat(np.arange(len(words)), size)
    out = []
    for a, b, weight in PATTERNS:
        at = np.flatnonzero(np.arange(len(chars)) + b < ends)
        code = chars[at] << np.uint64(42) | chars[at + a] << np.uint64(21) | chars[at + b]
        out.append((owner[at], code, np.full(len(at), weight)))
    return tuple(np.concatenate(x) for x in zip(*out))


def self_kernels(words: list[str]) -> np.ndarray:
    """The kernel of each word with itself."""
    owner, code, weight = subsequences(words)
    by = np.lexsort((code, owner))
    owner, code, weight = owner[by], code[by], weight[by]
    first = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (code[1:] != code[:-1])))
    return np.bincount(owner[first], np.add.reduceat(weight, first) ** 2, len(words))


def least_self_kernels(words: list[str]) -> np.ndarray:
    """A lower bound of that, from the lengths alone: as if no subsequence came twice."""
    size = np.array([len(marked(w)) for w in words])
    return sum(np.maximum(size - b, 0) * weight**2 for _, b, weight in PATTERNS)


class Kernel:
    """Kernel values of words against the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        owner, code, weight = subsequences(landmarks)
        self.codes, at = np.unique(code, return_inverse=True)
        self.table = np.zeros((len(self.codes), len(landmarks)), np.float32)
        np.add.at(self.table, (at, owner), weight)
        self.table /= np.sqrt(self_kernels(landmarks))
        self.most = self.table.max(axis=1)
        # Most subsequences are of no landmark: a table of hash bits sorts them out first.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self._slot(self.codes)] = True

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def values(self, words: list[str], least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
        """The words with a kernel value of ``least`` or more, and their values, smaller ones as 0."""
        owner, code, weight = subsequences(words)
        may = self.seen[self._slot(code)]
        owner, code, weight = owner[may], code[may], weight[may]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[at] == code
        owner, at, weight = owner[hit], at[hit], weight[hit]
        # No landmark can give more than the best one for each subsequence.
        bound = np.bincount(owner, weight * self.most[at], len(words))
        open_ = bound >= least * np.sqrt(least_self_kernels(words))
        live = open_[owner]
        owner, at, weight = owner[live], at[live], weight[live]
        rows = np.flatnonzero(open_)
        if not len(rows):
            return rows, np.zeros((0, len(self.landmarks)), np.float32)
        by = np.argsort(owner, kind="stable")
        owner, at, weight = owner[by], at[by], weight[by].astype(np.float32)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sums = np.add.reduceat(self.table[at] * weight[:, None], first, axis=0)
        sums /= np.sqrt(self_kernels([words[i] for i in rows]))[:, None]
        sums[sums < least] = 0
        near = sums.any(axis=1)
        return rows[near], sums[near]


class Scorer:
    """The trained model. It remembers words: those near a landmark with their kernel values."""

    def __init__(self, kernel: Kernel, weights: np.ndarray, offset: float, curve: np.ndarray):
        self.kernel, self.weights, self.offset, self.curve = kernel, weights, offset, curve
        self.near: dict[str, np.ndarray] = {}
        self.known: set[str] = set()

    def learn_words(self, words: set[str]) -> None:
        """Look up the words that haven't been seen."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = sorted(words - self.known, key=len)
        self.known.update(new)
        for lo in range(0, len(new), 20_000):
            part = [(w, p) for w in new[lo : lo + 20_000] if (p := plain(w))]
            if part:
                rows, values = self.kernel.values([p for _, p in part])
                self.near.update((part[i][0], v) for i, v in zip(rows.tolist(), values))

    def describe(self, texts: list[str]) -> list[tuple[int, list[np.ndarray]]]:
        """For each text the number of its words, and of the sentences with a word near a
        landmark their nearest kernel values."""
        parts = [t.split() for t in texts]
        sizes, words = [len(p) for p in parts], [set(p) for p in parts]
        spelled = [SPELLED.findall(t) for t in texts]
        words = [w | {MARKS.sub("", s) for s in more} if more else w for w, more in zip(words, spelled, strict=True)]
        self.learn_words(set().union(*words))
        near, out = self.near, []
        for text, size, own, more in zip(texts, sizes, words, spelled, strict=True):
            found = []
            if not own.isdisjoint(near):
                for sentence in SENTENCES.split(text):
                    parts = sentence.split()
                    if more:
                        parts += [MARKS.sub("", s) for s in SPELLED.findall(sentence)]
                    values = [near[w] for w in parts if w in near]
                    if values:
                        found.append(np.max(values, axis=0))
            out.append((size, found))
        if len(near) > KEPT_WORDS // 10:
            near.clear(), self.known.clear()
        return out

    def summary(self, size: int, found: list[np.ndarray]) -> tuple[float, float, float]:
        """Of a text the largest margin of a sentence, the number of toxic sentences, and their
        share, all on scales of about one."""
        margins = np.stack(found) @ self.weights + self.offset if found else np.zeros(0)
        toxic = int((margins > 0).sum())
        return max([self.offset, *margins.tolist()]), float(np.log1p(toxic)), min(3.0, 50 * toxic / max(size, 20))

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([(*self.summary(*d), 1.0) for d in self.describe(texts)]).reshape(len(texts), 4)
        return logistic(np.clip(x, -3, 3) @ self.curve)


def choose_landmarks(texts: list[str], toxic: np.ndarray, most: int = LANDMARKS) -> list[str]:
    """Words and stems of many toxic documents and of hardly any other, the most telling first.

    Of a word and its stems the one that tells most is taken, of ties the longest. What near
    copies of one document share tells nothing, so nothing counts more often than there are
    different words before it.
    """
    share = max(1, int(toxic.sum())), max(1, len(toxic) - int(toxic.sum()))
    least = max(3.0, LEAST_SHARE * share[0])
    bad, good = ([t for t, y in zip(texts, toxic, strict=True) if bool(y) is kind] for kind in (True, False))
    plains: dict[str, str] = {}

    def plain_words(text: str) -> list[str]:
        return [plains[w] if w in plains else plains.setdefault(w, plain(w)) for w in text.split()]

    # Stems grow by a character only where there are documents enough for the shorter one.
    counts: Counter = Counter()
    live: set[str] | None = None
    for size in STEMS:
        grown: Counter = Counter()
        for text in bad:
            grown.update({p[:size] for p in plain_words(text) if len(p) >= size and (live is None or p[: size - 1] in live)})
        live = {stem for stem, n in grown.items() if n >= least}
        counts.update({f"{stem}-": grown[stem] for stem in live})
    words: Counter = Counter()
    for text in bad:
        words.update({p for p in plain_words(text) if len(p) >= 3})
    counts.update({word: n for word, n in words.items() if n >= least})
    del words

    def forms(p: str) -> list[str]:
        return [f for f in (p, *(f"{p[:n]}-" for n in STEMS if n <= len(p))) if f in counts]

    contexts: dict[str, set[str]] = {}
    for text in bad:
        before = ""
        for p in plain_words(text):
            for form in forms(p):
                contexts.setdefault(form, set()).add(before)
            before = p
    plains.clear()
    clean: Counter = Counter()
    for text in good:
        clean.update({form for w in set(text.split()) for form in forms(plain(w))})
    rated = []
    for form, n in counts.items():
        n = min(n, len(contexts[form]))
        odds = np.log((n + 0.5) / share[0]) - np.log((clean[form] + 0.5) / share[1])
        if n >= least and odds > LEAST_ODDS and n * odds >= LEAST_EVIDENCE:
            rated.append((-round(n * odds, 6), -len(form), form))
    chosen: list[str] = []
    for *_, form in sorted(rated):
        bare = form.rstrip("-")
        if not any(bare.startswith(c.rstrip("-")) or c.startswith(bare) for c in chosen):
            chosen.append(form)
            if len(chosen) == most:
                break
    return chosen


def train(texts: list[str], toxic: np.ndarray, rounds: int = 3, cost: float = 4.0) -> Scorer | None:
    """A model from labelled texts; None without both classes or without telling words."""
    landmarks = choose_landmarks(texts, toxic) if 0 < toxic.sum() < len(toxic) else []
    if not landmarks:
        return None
    kernel = Kernel(landmarks)
    rows, values = kernel.values(landmarks, 0.0)
    among = np.zeros((len(landmarks), len(landmarks)))
    among[rows] = values
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    root = vectors * (1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    scorer = Scorer(kernel, among.max(axis=0), -1.0, np.zeros(4))
    described = []
    for lo in range(0, len(texts), DESCRIBED):
        described += scorer.describe(texts[lo : lo + DESCRIBED])
    owner = np.repeat(np.arange(len(texts)), [len(d) for _, d in described])
    rows = [v for _, d in described for v in d]
    data = np.concatenate([np.stack(rows) @ root, np.ones((len(rows), 1))], axis=1) if rows else np.zeros((0, len(landmarks) + 1))
    # To begin with, what is alike to a landmark is toxic, and the nearest sentence in any case.
    margin = np.array([v.max() for v in rows]) - 0.75
    for _ in range(rounds):
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, margin)
        positive = toxic[owner].astype(bool) & ((margin > 0) | (margin == best[owner]))
        use = np.flatnonzero(positive | ~toxic[owner].astype(bool))
        # Sentences without a near word are one row, which clean documents have.
        x = np.concatenate([data[use], np.eye(1, data.shape[1], data.shape[1] - 1)])
        y = np.append(np.where(positive[use], 1.0, -1.0), -1.0)
        share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
        every = np.arange(x.shape[1])
        w = fit([every] * len(x), list(x), y, x.shape[1], cost * np.minimum(share, 10) * np.append(np.ones(len(y) - 1), 10), epochs=12)
        margin = data @ w
    scorer.weights, scorer.offset = (root @ w[:-1]).astype(np.float32), float(w[-1])
    summaries = np.clip([scorer.summary(*d) for d in described], -3, 3)
    scorer.curve = calibrate_many(summaries, toxic.astype(float))
    scorer.near, scorer.known = {}, set()
    return scorer


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, use: Column, rows: int, key: str, text: str) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``rows`` documents of each class: those among the labelled
    ones for which ``use`` holds that have the smallest hash of their id."""
    known = labels.where(use).groupBy("doc_id").agg(F.max(label).alias("y")).where("y is not null and doc_id is not null")
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    ids = parts[0].unionByName(parts[1]).select(F.col("doc_id").alias("__id"), "y")
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("__doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    # At most 2 * rows ids, by the limits above.
    got = texts.join(F.broadcast(ids), F.col("__doc") == F.col("__id")).groupBy("__doc").agg(F.min("__text").alias("t"), F.first("y").alias("y")).toArrow()
    by = np.argsort(got.column("__doc").to_numpy())
    return got.column("t").take(pa.array(by)).to_pylist(), got.column("y").to_numpy()[by]


def toxicity_model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> Scorer | None:
    """A model from the rows of ``labels`` (doc_id, toxic) outside the held-out fold."""
    use = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    return train(*labelled_sample(docs, labels, "toxic", use, rows, key, text))


def toxicity(docs: DataFrame, model: Scorer | None, key: str = "doc_id", text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` from 0 (clean) to 1 (toxic); one of that name is replaced.

    Null and empty texts score as sentences without any telling word. Without a model, which
    is so if the labels have not both classes, every score is 0. Rows are scored one by one,
    so nulls in other columns and repeated rows change nothing, and nothing is shuffled.
    """
    if model is None:
        return docs.withColumn(score, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = pieces(iter([pa.RecordBatch.from_arrays([batch], ["text"])]))
            found = [shared.value.scores(p.column("text").to_pylist()) for p in parts]
            yield pa.array(np.concatenate([np.zeros(0), *found]))

    return docs.withColumn(score, rate(F.coalesce(F.col(f"`{text}`"), F.lit(""))))

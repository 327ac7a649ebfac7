"""Benchmark decontamination by spaced-seed hashing.

A mask looks at some words of a short stretch and ignores the others. Masks are chosen so that
however the allowed number of words is replaced within a window, one mask at one place sees
none of them. Hashes of masked words of the training texts are joined to those of the test
items, and the texts around the hits are compared word by word, so replaced words count
against an overlap without hiding it.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelmetrics.llm.common import BASE, flat, id_text, key_filter, may_hold, mix, pieces, powers, span_hashes
from reelmetrics.session import shared_folder

WINDOW = 13
SIMILARITY = 0.8
MIN_WORDS = 5
MASKS = 3


#: Code points from here on hold no letters or digits.
CODES = 0x32400
#: Scripts written without spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han.
UNSPACED = (
    (0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3005, 0x3008), (0x3040, 0x3100), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000),
    (0xA9E0, 0xAA00), (0xAA60, 0xAA80), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1AFF0, 0x1B170), (0x20000, CODES),
)
APART, INSIDE, SINGLE, UNSEEN = range(4)


def _characters() -> tuple[bytes, np.ndarray, np.ndarray]:
    """What each code point is to words, packed (it goes with every task), and the capitals with
    their small letters."""
    kind, low = np.zeros(CODES + 1, np.uint8), np.arange(CODES + 1, dtype=np.uint32)
    for c in range(CODES):
        category = unicodedata.category(chr(c))
        if category[0] in "LMN":
            kind[c] = INSIDE
            small = chr(c).lower()
            low[c] = ord(small) if len(small) == 1 else c
        elif category == "Cf" and c != 0x200B:
            kind[c] = UNSEEN
    for begin, end in UNSPACED:
        kind[begin:end][kind[begin:end] == INSIDE] = SINGLE
    capitals = np.flatnonzero(low != np.arange(CODES + 1))
    return zlib.compress(kind.tobytes()), capitals, low[capitals]


KINDS, CAPITALS, SMALL = _characters()


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, CODES for all from there on, and where each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    wide = np.concatenate((data, np.zeros(3, np.uint8)))
    lead = wide[at].astype(np.uint32)
    out = lead.copy()
    for size, (least, mask) in enumerate(((0xC0, 0x1F), (0xE0, 0x0F), (0xF0, 0x07)), 1):
        own = np.flatnonzero(lead >= least)
        code = lead[own] & np.uint32(mask)
        for k in range(1, size + 1):
            code = code << np.uint32(6) | (wide[at[own] + k] & np.uint32(0x3F))
        out[own] = code
    return np.minimum(out, np.uint32(CODES)), at


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the n + 1 offsets of the texts in them.

    Words are runs of Unicode letters, marks and digits; in scripts without spaces between words
    each character is one. Capitals count as small letters, and characters that aren't seen
    (soft hyphens, joiners, direction marks) as nothing.
    """
    data, at = flat(texts)
    codes, begin = code_points(data)
    kinds, small = np.frombuffer(zlib.decompress(KINDS), np.uint8), np.arange(CODES + 1, dtype=np.uint32)
    small[CAPITALS] = SMALL
    seen = np.flatnonzero(kinds[codes] != UNSEEN)
    codes, begin = codes[seen], begin[seen]
    kind, low = kinds[codes], small[codes]
    inside, single = kind != APART, kind == SINGLE
    at = np.searchsorted(begin, at)
    # Where a word can't go on from the character before.
    new = np.ones(len(kind) + 1, bool)
    new[1:-1] = ~(inside[1:] & inside[:-1]) | single[1:] | single[:-1]
    new[at] = True
    starts, ends = np.flatnonzero(inside & new[:-1]), np.flatnonzero(inside & new[1:]) + 1
    return span_hashes(low, starts, ends), np.searchsorted(starts, at)


def mask_family(length: int, errors: int) -> list[tuple[int, ...]]:
    """At most MASKS masks, with as many words each as possible, one of which fits at some
    place in ``length`` words wherever ``errors`` of them are replaced."""
    patterns = [set(p) for p in combinations(range(length), errors)]
    for weight in range(length - errors, 0, -1):
        masks = [(0, *rest) for span in range(weight, length + 1) for rest in combinations(range(1, span), weight - 1) if not rest or rest[-1] == span - 1 or weight == 1]
        masks = [m for m in masks if m[-1] < length]
        sees = {m: frozenset(k for k, p in enumerate(patterns) if any(not p & {o + i for i in m} for o in range(length - m[-1]))) for m in masks}
        open_, chosen = set(range(len(patterns))), []
        while open_ and len(chosen) < MASKS:
            best = max(masks, key=lambda m: (len(sees[m] & open_), [-i for i in m]))
            if not sees[best] & open_:
                break
            chosen.append(best)
            open_ -= sees[best]
        if not open_:
            return chosen
    return [(0,)]


def needed(length: int, window: int, similarity: float) -> tuple[int, int]:
    """Words of the compared window of an item, and how many of them must be equal."""
    words = min(length, window)
    return words, math.ceil(similarity * words - 1e-9)


def seeds(words: np.ndarray, offsets: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The positions where the mask fits into one text, and the hashes there."""
    n = max(0, len(words) - mask[-1])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    h = np.full(n, int.from_bytes(np.array(mask, np.uint8).tobytes()) % (1 << 61), np.uint64)
    for i, factor in zip(mask, powers(BASE, len(mask) + 1)[1:]):
        h += words[i : i + n] * factor
    fits = np.flatnonzero(owner[:n] == owner[mask[-1] :][:n])
    return fits, mix(h[fits])


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, at = text_words(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(words.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["item_id", "item"])

    return id_text(benchmark, key, text).mapInArrow(run, "item_id long, item array<long>")


def _item_seeds(items: DataFrame, families: dict[int, list[int]], masks: list[tuple[int, ...]], window: int) -> DataFrame:
    """h, item_uid and at (the word where the mask begins) of the seeds that an item's length asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("item")
            at = lists.offsets.to_numpy().astype(np.int64)
            words = lists.values.to_numpy()[at[0] : at[-1]].view(np.uint64)
            at -= at[0]
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            length = np.minimum(np.diff(at), window)
            for k, mask in enumerate(masks):
                pos, h = seeds(words, at, mask)
                mine = np.isin(length[owner[pos]], [n for n, own in families.items() if k in own])
                pos, h = pos[mine], h[mine]
                uid = batch.column("item_uid").to_numpy()[owner[pos]]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(uid), pa.array(pos - at[owner[pos]])], ["h", "item_uid", "at"])

    return items.select("item_uid", "item").mapInArrow(run, "h long, item_uid long, at long")


def _whole(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The first place of each item in a text as it stands; for items of a few words."""
    sizes = sorted(r["n"] for r in items.select(F.size("item").alias("n")).distinct().collect())
    masks = [tuple(range(n)) for n in sizes]
    keys = _item_seeds(items, {n: [k] for k, n in enumerate(sizes)}, masks, max(sizes)).select("h", "item_uid")
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(keys.select("h").distinct()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, at = text_words(batch.column("text"))
            for mask in masks:
                p, h = seeds(words, at, mask)
                hit = may_hold(shared.value, h)
                p, h = p[hit], h[hit]
                doc = np.searchsorted(at, p, side="right") - 1
                by = np.lexsort((p, h, doc))
                p, h, doc = p[by], h[by], doc[by]
                first = np.flatnonzero(np.concatenate(([True], (np.diff(doc) != 0) | (h[1:] != h[:-1])))) if len(p) else p
                p, h, doc = p[first], h[first], doc[first]
                index = (p[:, None] + np.arange(len(mask))).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * len(mask)), pa.array(words[index].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), pa.array(p - at[doc]), pa.array(h.view(np.int64)), lists], ["doc_id", "first_word", "h", "words"]
                )

    found = docs.mapInArrow(places, "doc_id long, first_word long, h long, words array<long>")
    size = F.size("item").cast("long")
    same = found.join(keys.join(items, "item_uid"), "h").where(F.col("words") == F.col("item"))
    return same.select("doc_id", "item_id", "first_word", F.lit(0).cast("long").alias("item_word"), size.alias("n_equal"), size.alias("n_words"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    min_words: int = MIN_WORDS,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    short_items: bool = False,
) -> DataFrame:
    """doc_id, item_id, first_word, item_word, n_equal and n_words for every text that overlaps an item.

    They overlap if ``window`` words of the item in a row (n_words: fewer if the item has no
    more) have at least ``similarity`` of them (n_equal) equal to the words at the same places
    of as many words of the text. The overlap with the most equal words is given, of ties the
    first in the text and then in the item; first_word and item_word count from 0.

    Items of fewer than ``min_words`` words overlap with nothing, or, with ``short_items``, with
    the texts that have all their words in a row: one word may then overlap with many texts.
    Items without words overlap with nothing; nor do empty and null texts. Rows with equal ids are one document, or item, and
    null is an id. Other columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    items = _items(benchmark, item_key, item_text).where(F.size("item") >= (1 if short_items else min_words))
    every = items.withColumn("item_uid", F.monotonically_increasing_id()).checkpoint()
    items, short = every.where(F.size("item") >= min_words), every.where(F.size("item") < min_words)
    # At most ``window`` different lengths.
    sizes = sorted(r["n"] for r in items.select(F.least(F.size("item"), F.lit(window)).alias("n")).distinct().collect())
    masks: list[tuple[int, ...]] = []
    families: dict[int, list[int]] = {}
    for n in sizes:
        words, equal = needed(n, window, similarity)
        family = mask_family(words, words - equal)
        masks += [m for m in family if m not in masks]
        families[n] = [masks.index(m) for m in family]
    item_seeds = _item_seeds(items, families, masks, window).distinct().checkpoint()
    shared = spark.sparkContext.broadcast(key_filter(item_seeds.select("h")))

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, at = text_words(batch.column("text"))
            pos, hash_ = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for mask in masks:
                p, h = seeds(words, at, mask)
                hit = may_hold(shared.value, h)
                pos.append(p[hit]), hash_.append(h[hit])
            p, h = np.concatenate(pos), np.concatenate(hash_)
            by = np.argsort(p, kind="stable")
            p, h = p[by], h[by]
            doc = np.searchsorted(at, p, side="right") - 1
            # Hits of one text that are close stand in one stretch, with a window on either side.
            new = np.concatenate(([True], (np.diff(p) > 2 * window) | (np.diff(doc) != 0))) if len(p) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(p)) - 1 if len(p) else first
            lo, hi = np.maximum(p[first] - window, at[doc[first]]), np.minimum(p[last] + 2 * window, at[doc[first] + 1])
            size = hi - lo
            cut = np.concatenate(([0], np.cumsum(size)))
            index = np.repeat(lo - cut[:-1], size) + np.arange(cut[-1])
            own = np.cumsum(new) - 1
            hits = pa.ListArray.from_arrays(
                pa.array(np.append(first, len(p)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(p - lo[own] if len(p) else p)], ["h", "at"]),
            )
            texts = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(words[index].view(np.int64)))
            ids = batch.column("doc_id").take(pa.array(doc[first]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(lo - at[doc[first]]), texts, hits], ["doc_id", "begin", "words", "hits"])

    found = id_text(docs, key, text).mapInArrow(regions, "doc_id long, begin long, words array<long>, hits array<struct<h long, at long>>")
    found = found.withColumn("uid", F.monotonically_increasing_id()).checkpoint()
    hits = found.select("uid", F.explode("hits").alias("hit")).select("uid", "hit.h", F.col("hit.at").alias("place"))
    shifts = hits.join(item_seeds, "h").select("uid", "item_uid", (F.col("place") - F.col("at")).alias("shift")).distinct()
    pairs = shifts.join(found.select("uid", "doc_id", "begin", "words"), "uid").join(items, "item_uid")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            shift = batch.column("shift").to_numpy()
            begin = batch.column("begin").to_numpy()
            left, right = batch.column("words"), batch.column("item")
            for i in range(batch.num_rows):
                a, b, s = left[i].values.to_numpy(), right[i].values.to_numpy(), shift[i]
                lo, hi = max(0, -s), min(len(b), len(a) - s)
                size, least = needed(len(b), window, similarity)
                sums = np.concatenate(([0], np.cumsum(a[lo + s : hi + s] == b[lo:hi])))
                if hi - lo < size:
                    continue
                equal = sums[size:] - sums[:-size]
                at = int(equal.argmax())
                if equal[at] >= least:
                    rows.append((i, int(begin[i] + s + lo + at), lo + at, int(equal[at]), size))
            own, *values = zip(*rows) if rows else [()] * 5
            take = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("item_id").take(take), *(pa.array(v, pa.int64()) for v in values)],
                ["doc_id", "item_id", "first_word", "item_word", "n_equal", "n_words"],
            )

    kept = pairs.select("doc_id", "begin", "words", "item_id", "item", "shift").mapInArrow(
        verify, "doc_id long, item_id long, first_word long, item_word long, n_equal long, n_words long"
    )
    if short_items and not short.isEmpty():
        kept = kept.unionByName(_whole(id_text(docs, key, text), short))
    best = F.min(F.struct((-F.col("n_equal")).alias("few"), "first_word", "item_word", "n_equal", "n_words"))
    return kept.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.first_word", "best.item_word", "best.n_equal", "best.n_words")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows of documents that overlap an item; rows with a null id stay."""
    gone = overlaps(docs, benchmark, key=key, **options).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[f"`{key}`"].cast("long") == gone["__gone"], "left_anti")

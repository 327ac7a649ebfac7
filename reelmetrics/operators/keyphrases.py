"""Top keyphrases per text: 1- and 2-grams ranked by TF-IDF over the corpus.

The embedding ranking of the usual keyphrase libraries needs a model; with phrase and document
vectors at hand ``rerank`` orders the candidates by cosine instead.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from reelmetrics.operators.dedup import top_per_key
from reelmetrics.session import dropped_shuffles, scratch, shared_folder

TOP_PHRASES = 5
# Fixed value: words are runs of two or more word characters.
WORD_PATTERN = r"[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}"


def tokens(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), 0)
    if not stop_words:
        return words
    stops = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(words, lambda w: ~F.array_contains(stops, w))


def phrases(words: Column) -> Column:
    """All single words and pairs of neighbours."""
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(words, pairs)


def exploded(df: DataFrame, items: Column, name: str, keep: list[str]) -> DataFrame:
    """One row per item. The outer form keeps Spark from pushing a ``size(items) > 0`` filter,
    and with it a second tokenisation, below it."""
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def _coded(words: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.StringArray]:
    """Row, code and count of each different phrase of each row, sorted by row and code, and the
    vocabulary: words have the codes below its size, pairs of words those from there on."""
    found = words.flatten().dictionary_encode()
    ids, size = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
    row = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    pair = np.flatnonzero(row[1:] == row[:-1])
    codes = np.concatenate((ids, size + ids[pair] * size + ids[pair + 1]))
    return *_tally(np.concatenate((row, row[pair])), codes, (size * (size + 1)).bit_length()), found.dictionary


def _tally(rows: np.ndarray, codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows and codes, sorted, and how often each occurs; codes have ``bits`` bits."""
    if int(rows.max(initial=0)).bit_length() + bits < 63:  # in one number, which sorts faster
        keys = np.sort(rows << bits | codes)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
        n, keys = np.diff(np.append(first, len(keys))), keys[first]
        return keys >> bits, keys & (1 << bits) - 1, n
    by = np.lexsort((codes, rows))
    rows, codes = rows[by], codes[by]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(rows)), bool), (np.diff(rows) != 0) | (np.diff(codes) != 0))))
    return rows[first], codes[first], np.diff(np.append(first, len(rows)))


def _said(codes: np.ndarray, vocabulary: pa.StringArray) -> pa.StringArray:
    size = max(1, len(vocabulary))
    two = codes >= size
    left = vocabulary.take(pa.array(np.where(two, (codes - size) // size, codes)))
    right = vocabulary.take(pa.array(np.where(two, (codes - size) % size, codes)))
    return pc.if_else(pa.array(two), pc.binary_join_element_wise(left, right, " "), left)


BATCH_TEXTS = 2000  # texts counted together
BAG_WORDS = 1 << 20  # words of the texts packed together
# Words a task counts, if there are tasks for all cores: a phrase leaves a task once, so that few tasks send few rows.
TASK_WORDS = 1 << 23
SHARED_PARTS = 64
# Words, and then phrases, whose frequencies every task gets.
FREQUENT, FREQUENT_PHRASES = 1 << 17, 1 << 19
# Bits of a bitmap of phrases: about one for each word of the texts, between these powers of two.
LEAST_BITS, MOST_BITS = 20, 28


def term_counts(texts: DataFrame, group: str) -> DataFrame:
    """(group, term, tf) from (group, _w), summed over some texts at a time; groups of null are kept."""
    kind = dict(texts.dtypes)[group]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, BATCH_TEXTS) for b in batches for i in range(0, b.num_rows, BATCH_TEXTS)):
            rows, codes, tf, vocabulary = _coded(batch.column("_w"))
            if not len(rows):
                continue
            groups = batch.column(group).dictionary_encode("encode")
            at = groups.indices.to_numpy().astype(np.int64)[rows]
            by = np.lexsort((codes, at))
            at, codes = at[by], codes[by]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(codes) != 0))))
            n = np.add.reduceat(tf[by], first)
            yield pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(at[first])), _said(codes[first], vocabulary), pa.array(n, pa.int64())], [group, "term", "tf"])

    return texts.mapInArrow(count, f"{group} {kind}, term string, tf bigint")


def _few_splits(texts: DataFrame, by: str) -> DataFrame:
    """Texts of fewer input splits than there are cores, dealt out first; so few splits are little data."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    # What a shuffle deals out needs no other; and to ask for its partitions would run it.
    if re.search(r"\bExchange (hash|range|RoundRobin)", texts._jdf.queryExecution().executedPlan().toString()):
        return texts
    return texts.repartition(cores, by) if texts.rdd.getNumPartitions() < cores else texts


def phrase_counts(texts: DataFrame, id_column: str, total: int, top: int) -> DataFrame:
    """(bag, n) from (id, _w), the words of ``total`` texts, one row an id; in one pass.

    A bag is what is counted in some texts, about ``BAG_WORDS`` words together: their ids, their words
    as numbers into a vocabulary, most frequent first, and in how many of the texts each word occurs.
    It is compressed, and a fraction of the texts. ``n`` is the number of its words.

    ``can`` marks the words that can still be in one of the best ``top`` phrases of their text; exact.
    Weights lie between 1 and the largest idf of ``total`` texts, so a phrase whose count times that
    is below the count of the text's ``top``-th most frequent word is beaten by at least ``top``
    others, and a phrase is no more frequent than its words.
    """
    most = float(np.log((1 + total) / 2) + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words in (x for b in batches for x in _parts(b.column(id_column), b.column("_w"))):
            found = words.flatten().dictionary_encode()
            code, size = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
            if not size:
                continue
            order = np.argsort(-np.bincount(code, minlength=size), kind="stable")
            place = np.empty(size, np.int64)
            place[order] = np.arange(size)
            code, lengths = place[code], _lengths(words)
            row = np.repeat(np.arange(len(ids)), lengths)
            rows, codes, tf = _tally(row, code, size.bit_length())
            least = _bar(tf, np.searchsorted(rows, np.arange(len(ids) + 1)), rows, top)
            kept = tf * most >= least[rows]
            keys = rows * size + codes
            can = kept[np.searchsorted(keys, row * size + code)]
            # In bytes of their own, the high ones of which are mostly 0, numbers take half the room.
            planes = [(code >> shift & 255).astype(np.uint8) for shift in (0, 8, 16, 24)]
            columns = [ids, lengths.astype(np.int32), *planes, can, found.dictionary.take(pa.array(order)), np.bincount(codes, minlength=size)]
            bag = pa.RecordBatch.from_arrays([_listed(c) for c in columns], BAG)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, bag.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write(bag)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([len(code)], pa.int64())], ["bag", "n"])

    return texts.select(id_column, "_w").mapInArrow(pack, "bag binary, n bigint")


BAG = ["ids", "lengths", "b0", "b1", "b2", "b3", "can", "words", "n"]


def _listed(values: np.ndarray | pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def _lengths(words: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _parts(ids: pa.Array, words: pa.ListArray) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """The texts in parts of about ``BAG_WORDS`` words; a longer text is one part."""
    part = np.cumsum(_lengths(words)) // BAG_WORDS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(words)]
    for i, j in zip(cuts, cuts[1:]):
        yield ids.slice(i, j - i), words.slice(i, j - i)


class _Bag:
    """One bag, unpacked: ``row`` and ``code`` of each word, and ``pair``, the words that have a next one in their text.

    Phrases are numbers, too: the first word's in the high bits, below it 0 or 1 more than the second word's.
    """

    def __init__(self, packed: bytes):
        b = pa.ipc.open_stream(packed).read_next_batch()
        self.ids, lengths, *planes, can, self.words, n = (b.column(c).flatten() for c in BAG)
        self.n, self.can = n.to_numpy(), can.to_numpy(zero_copy_only=False)
        self.size, self.row = len(self.words), np.repeat(np.arange(len(self.ids)), lengths.to_numpy())
        self.bits = self.size.bit_length()
        self.code = sum(p.to_numpy().astype(np.int64) << shift for p, shift in zip(planes, (0, 8, 16, 24)))
        self.pair = np.flatnonzero(self.row[1:] == self.row[:-1])

    def halves(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first word, and 0 or 1 more than the second."""
        return phrases >> self.bits, phrases & (1 << self.bits) - 1

    def pairs(self, at: np.ndarray) -> np.ndarray:
        return self.code[at] << self.bits | self.code[at + 1] + 1

    def tally(self, rows: np.ndarray, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _tally(rows, phrases, 2 * self.bits)

    def said(self, phrases: np.ndarray) -> pa.StringArray:
        left, right = self.halves(phrases)
        first = self.words.take(pa.array(left))
        return pc.if_else(pa.array(right > 0), pc.binary_join_element_wise(first, self.words.take(pa.array(np.maximum(right, 1) - 1)), " "), first)

    def slots(self, phrases: np.ndarray, bits: int) -> np.ndarray:
        """Places of phrases in a bitmap."""
        left, right = self.halves(phrases)
        hashes, powers = self.hashes
        return _slots(hashes[left + 1] + np.where(right > 0, powers[left + 1] * (np.uint64(ord(" ") + 1) + hashes[right]), np.uint64(0)), bits)

    @cached_property
    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of no word and each word: the hash, and the power of what follows it."""
        hashes, powers = _hashes(self.words)
        return np.append(np.uint64(0), hashes), np.append(np.uint64(0), powers)


def _over(bags: DataFrame, rows_of: Callable[[_Bag], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``rows_of`` gives for each bag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (rows_of(_Bag(x.as_py())) for x in batch.column("bag"))

    return bags.select("bag").mapInArrow(run, schema)


def word_counts(bags: DataFrame) -> DataFrame:
    """(phrase, df): in how many texts words occur."""
    each = _over(bags, lambda b: pa.RecordBatch.from_arrays([b.words, pa.array(b.n, pa.int64())], ["phrase", "df"]), "phrase string, df bigint")
    return each.groupBy("phrase").agg(F.sum("df").alias("df"))


def _hashes(said: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of words or phrases, none of them empty, that depend on their bytes alone; and the power of the next byte."""
    if not len(said):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    ends = np.frombuffer(said.buffers()[1], np.int32)[said.offset : said.offset + len(said) + 1].astype(np.int64)
    data, lengths = np.frombuffer(said.buffers()[2], np.uint8)[ends[0] : ends[-1]], np.diff(ends)
    powers = np.cumprod(np.full(lengths.max() + 1, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], lengths)
    return np.add.reduceat((data + np.uint64(1)) * powers[place], ends[:-1] - ends[0]), powers[lengths]


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((h ^ h >> np.uint64(32)) >> np.uint64(64 - bits)).astype(np.int64)


def placed(phrases: DataFrame, bits: int) -> DataFrame:
    """(phrase, df, slot): the places of phrases in a bitmap of 2 ** ``bits`` bits."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = _slots(_hashes(batch.column("phrase"))[0], bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slots, pa.int64())], ["phrase", "df", "slot"])

    return phrases.select("phrase", "df").mapInArrow(place, "phrase string, df bigint, slot bigint")


def bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """The places in column ``slot`` as a bitmap of 2 ** ``bits`` bits; its size is fixed, whatever the number of rows.

    Phrases may share a place: it tells what is surely not there, and lets some more through.
    """
    at = F.col("slot").cast("bigint") + 1  # buckets of places above 0 have equal sizes
    buckets = slots.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m"))
    out = np.zeros(1 << bits - 3, np.uint8)
    for r in buckets.collect():
        m = np.frombuffer(r["m"], np.uint8)
        out[(r["b"] - 1) * len(m) : r["b"] * len(m)] = m
    return out


def _holds(marks: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (marks[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def marked_counts(bags: DataFrame, marks: np.ndarray, bits: int) -> DataFrame:
    """(phrase, df) of the phrases that a bitmap lets through, not summed yet: one row a bag."""
    shared = bags.sparkSession.sparkContext.broadcast(marks)

    def count(b: _Bag) -> pa.RecordBatch:
        single, pairs = np.arange(b.size) << b.bits, b.pairs(b.pair)
        there, marked = (_holds(shared.value, b.slots(x, bits)) for x in (single, pairs))
        _, found, _ = b.tally(b.row[b.pair[marked]], pairs[marked])
        found, n = np.unique(found, return_counts=True)
        return pa.RecordBatch.from_arrays([b.said(np.concatenate((single[there], found))), pa.array(np.concatenate((b.n[there], n)), pa.int64())], ["phrase", "df"])

    return _over(bags, count, "phrase string, df bigint")


def _bar(value: np.ndarray, start: np.ndarray, rows: np.ndarray, top: int) -> np.ndarray:
    """What the ``top``-th largest value of each row allows to drop below; 0 for rows of fewer values."""
    bar, enough = np.zeros(len(start) - 1), np.flatnonzero(np.diff(start) >= top)
    if len(value) > 100 * len(bar):
        bar[enough] = [np.partition(value[start[i] : start[i + 1]], -top)[-top] - 1e-6 for i in enough]
    else:
        bar[enough] = value[np.lexsort((-value, rows))][start[:-1][enough] + top - 1] - 1e-6
    return bar


def shared_counts(texts: DataFrame, id_column: str) -> DataFrame:
    """(id, phrase, tf) for ids of several rows: the counts of an id's rows are summed, and it is one text."""
    terms = exploded(texts, phrases(F.col("_w")), "phrase", [id_column])
    return terms.groupBy(F.col(id_column).alias("id"), "phrase").agg(F.count("*").alias("tf"))


def shared_lists(tf: DataFrame) -> DataFrame:
    """(id, said, n) of these. Phrases of an id are listed in several rows, so that none grows with the rows of the id."""
    part = F.pmod(F.xxhash64("phrase"), F.lit(SHARED_PARTS))
    pairs = F.collect_list(F.struct("phrase", "tf")).alias("p")
    return tf.groupBy("id", part.alias("part")).agg(pairs).select("id", F.col("p.phrase").alias("said"), F.col("p.tf").alias("n"))


def frequent(spread: DataFrame, most: int) -> tuple[pa.StringArray, np.ndarray, int]:
    """The most frequent phrases, ``most`` at maximum, with their df, and the largest df of all others.

    Steps of the logarithm of df are counted first; whole steps are taken.
    """
    step = F.floor(F.log2("df") * 16).alias("step")
    steps = spread.groupBy(step).agg(F.count("*").alias("n"), F.max("df").alias("df")).collect()  # 16 rows for each doubling
    taken, least, rest = 0, None, 1
    for r in sorted(steps, key=lambda r: -r["step"]):
        taken += r["n"]
        if taken > most:
            rest = r["df"]
            break
        least = r["step"]
    if least is None:
        return pa.array([], pa.string()), np.empty(0, np.int64), rest
    found = spread.where(step >= least).select("phrase", F.col("df").cast("bigint")).toArrow().combine_chunks()
    names, df = (found.column(c).combine_chunks() for c in ("phrase", "df"))
    return names.cast(pa.string()), df.to_numpy(), rest


def contenders(listed: DataFrame, known: tuple[pa.StringArray, np.ndarray, int], total: int, top: int) -> DataFrame:
    """(id, phrase, tf, df) of the phrases that can be among the best ``top`` of their text; exact.

    The df of frequent phrases is ``known``; that of another word lies between 1 and the largest of
    the others, and that of another pair is at most those of its words. A phrase is dropped if at its
    largest weight it is behind ``top`` others at their smallest.
    """
    kind = dict(listed.dtypes)["id"]
    shared = listed.sparkSession.sparkContext.broadcast(known)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, df, rest = shared.value
        df = np.append(df, 0)

        def place(said: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
            at = pc.fill_null(pc.index_in(said, value_set=names), len(names)).to_numpy(zero_copy_only=False)
            return at < len(names), df[at]

        for batch in batches:
            said = batch.column("said").flatten()
            if not len(said):
                continue
            start = np.append(0, np.cumsum(pc.list_value_length(batch.column("said")).to_numpy(zero_copy_only=False).astype(np.int64)))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(start))
            tf = batch.column("n").flatten().to_numpy()
            found, there = place(said)
            words = pc.split_pattern(said, " ", max_splits=1)
            ends = words.offsets.to_numpy()
            halves = [np.where(f, n, rest) for f, n in (place(words.values.take(pa.array(i))) for i in (ends[:-1], ends[1:] - 1))]

            def score(unknown: np.ndarray | int) -> np.ndarray:
                return tf * (np.log((1 + total) / (1 + np.where(found, there, unknown))) + 1)

            kept = score(1) >= _bar(score(np.minimum(*halves)), start, rows, top)[rows]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows[kept])), said.filter(pa.array(kept)), pa.array(tf[kept]), pa.array(there[kept], mask=~found[kept])], ["id", "phrase", "tf", "df"])

    return listed.select("id", "said", "n").mapInArrow(choose, f"id {kind}, phrase string, tf bigint, df bigint")


def _contending(b: _Bag, words: tuple[tuple[pa.StringArray, np.ndarray, int], np.ndarray, int], total: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, code, count, df (0: not known) and the largest possible df of the phrases of a bag that can be among the best ``top`` of their text; exact.

    ``words`` gives the df of frequent words, and a bitmap of those in several texts with the bits of its places; all others
    are in one. A phrase is in no more texts than its words are.
    """
    known, several, bits = words
    at, upper = _known(b.words, known)
    upper[~at & ~_holds(several, b.slots(np.arange(b.size) << b.bits, bits))] = 1
    pair = b.pair[b.can[b.pair] & b.can[b.pair + 1]]
    rows, phrases, tf = b.tally(np.concatenate((b.row[b.can], b.row[pair])), np.concatenate((b.code[b.can] << b.bits, b.pairs(pair))))
    left, right = b.halves(phrases)
    limit = np.minimum(upper[left], np.append(upper.max(initial=1), upper)[right])
    df = np.where((right == 0) & at[left] | (limit == 1), limit, 0)
    kept = _winning(b, rows, tf, df, limit, total, top)
    return rows[kept], phrases[kept], tf[kept], df[kept], limit[kept]


def _known(said: pa.StringArray, known: tuple[pa.StringArray, np.ndarray, int]) -> tuple[np.ndarray, np.ndarray]:
    """Whether the df of phrases is known, and it or else the largest of the others."""
    names, df, rest = known
    at = pc.fill_null(pc.index_in(said, value_set=names), len(names)).to_numpy(zero_copy_only=False)
    return at < len(names), np.append(df, rest)[at]


def _winning(b: _Bag, rows: np.ndarray, tf: np.ndarray, df: np.ndarray, limit: np.ndarray, total: int, top: int, fewest: np.ndarray | int = 1) -> np.ndarray:
    """Whether a phrase is not behind ``top`` others of its text; a df of 0 may be ``fewest`` to ``limit``."""

    least = tf * (np.log((1 + total) / (1 + np.where(df > 0, df, limit))) + 1)
    most = np.where(df > 0, least, tf * (np.log((1 + total) / (1 + fewest)) + 1))
    return most >= _bar(least, np.searchsorted(rows, np.arange(len(b.ids) + 1)), rows, top)[rows]


def _first_alike(b: _Bag, rows: np.ndarray, phrases: np.ndarray, tf: np.ndarray, df: np.ndarray, top: int) -> np.ndarray:
    """Whether a phrase is among the first ``top`` by name of those of its text with its count and a df of 1.

    Their weights are equal, so that names decide.
    """
    rank = np.zeros(b.size + 1, np.int64)  # a word comes before the pairs that begin with it, as words have no character below the space
    rank[1 + pc.sort_indices(b.words).to_numpy().astype(np.int64)] = np.arange(1, b.size + 1)
    alike = np.flatnonzero(df == 1)
    left, right = b.halves(phrases[alike])
    alike = alike[np.lexsort((rank[right], rank[left + 1], tf[alike], rows[alike]))]
    place = np.arange(len(alike))
    new = np.append(0, np.flatnonzero((np.diff(rows[alike]) != 0) | (np.diff(tf[alike]) != 0)) + 1)
    place -= new[np.searchsorted(new, place, side="right") - 1]
    kept = np.ones(len(rows), bool)
    kept[alike[place >= top]] = False
    return kept


def contending_slots(bags: DataFrame, words: tuple[tuple[pa.StringArray, np.ndarray, int], np.ndarray, int], total: int, top: int, bits: int) -> DataFrame:
    """(slot) of the phrases that can be among the best, as far as the df of ``words`` tells, and whose df it doesn't tell."""
    shared = bags.sparkSession.sparkContext.broadcast(words)

    def place(b: _Bag) -> pa.RecordBatch:
        _, phrases, _, df, _ = _contending(b, shared.value, total, top)
        return pa.RecordBatch.from_arrays([pa.array(np.unique(b.slots(phrases[df == 0], bits)), pa.int64())], ["slot"])

    return _over(bags, place, "slot bigint")


def bag_contenders(
    bags: DataFrame, words: tuple[tuple[pa.StringArray, np.ndarray, int], np.ndarray, int], known: tuple[pa.StringArray, np.ndarray, int], marks: tuple[np.ndarray, np.ndarray],
    bits: int, total: int, top: int, kind: str,
) -> DataFrame:
    """(id, phrase, tf, df) as of ``contenders``, by what is known of all phrases in question: the most frequent are
    ``known``, and bitmaps ``marks`` hold those in one text and those in several."""
    shared = bags.sparkSession.sparkContext.broadcast((words, known, marks))

    def choose(b: _Bag) -> pa.RecordBatch:
        words, known, (once, several) = shared.value
        rows, phrases, tf, df, limit = _contending(b, words, total, top)
        slots, least = b.slots(phrases, bits), np.ones(len(df), np.int64)
        df[(df == 0) & ~_holds(several, slots)] = 1
        least[(df == 0) & ~_holds(once, slots)] = 2
        open_ = np.flatnonzero(df == 0)
        there, upper = _known(b.said(phrases[open_]), known)
        df[open_] = np.where(there, upper, 0)
        limit[open_] = np.maximum(least[open_], np.minimum(limit[open_], upper))
        kept = np.flatnonzero(_winning(b, rows, tf, df, limit, total, top, least))
        kept = kept[_first_alike(b, rows[kept], phrases[kept], tf[kept], df[kept], top)]
        rows, tf, df = rows[kept], tf[kept], df[kept]
        return pa.RecordBatch.from_arrays([b.ids.take(pa.array(rows)), b.said(phrases[kept]), pa.array(tf, pa.int64()), pa.array(df, pa.int64(), mask=df == 0)], ["id", "phrase", "tf", "df"])

    return _over(bags, choose, f"id {kind}, phrase string, tf bigint, df bigint")


def phrase_weights(candidates: DataFrame, spread: DataFrame, total: Column) -> DataFrame:
    """Candidates (id, phrase, tf, df) with df, where it was not known, and score = tf * (ln((1 + N) / (1 + df)) + 1).

    Phrases whose df is not known are in few texts, so that no key of the join is hot; those that
    ``spread`` lacks are in one. The others are dealt out by a name with the id, which no phrase has.
    """
    key = F.when(F.col("df").isNull(), F.col("phrase")).otherwise(F.concat(F.lit(" "), F.col("id").cast("string")))
    found = spread.select(F.col("phrase").alias("_key"), F.col("df").alias("_df"))
    weighted = candidates.withColumn("_key", key).join(found, "_key", "left").withColumn("df", F.coalesce("df", "_df", F.lit(1).cast("bigint"))).drop("_key", "_df")
    idf = F.ln((F.lit(1.0) + total) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return weighted.withColumn("score", F.col("tf") * idf)


def keyphrases(
    docs: DataFrame,
    id_column: str = "videoId",
    text_column: str = "text",
    top: int = TOP_PHRASES,
    stop_words: tuple[str, ...] = (),
    digits: int = 9,
) -> DataFrame:
    """(id, keywords) joined by ``; ``, best first; texts without words give an empty string.

    There is one row for each id. Rows that share an id are one text, of which the counts are summed.

    Scores are compared at ``digits`` decimals and ties go by the phrase, so that the result
    does not hang on the last bit of a logarithm.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    with dropped_shuffles(spark), scratch(spark, "keyphrases") as written:
        plain = docs.where(F.col(id_column).isNotNull()).select(id_column, text_column)
        words = tokens(F.coalesce(text_column, F.lit("")), stop_words).alias("_w")
        lists = _lists(_best(plain, id_column, words, docs.count(), top, digits, written), id_column).checkpoint()
    return _all_ids(docs.select(id_column).distinct(), lists, id_column)


def _best(plain: DataFrame, id_column: str, words: Column, total: int, top: int, digits: int, written: Callable[..., DataFrame]) -> DataFrame:
    """(id, phrase, _r) of the best phrases. Neither texts nor all their phrases are written or shuffled here.

    1. Texts are cut into words once, and these written, packed. 2. Words are counted. 3. Phrases that can
    be among the best, as far as the words' frequencies tell, are marked in a bitmap. 4. Only marked phrases
    are counted. 5. Those in several texts are marked, too, and the few phrases that are still in question
    meet their frequencies in a join. ``written`` keeps what is used more than once until the end.
    """
    kind = dict(plain.dtypes)[id_column]
    several = plain.groupBy(id_column).agg(F.count("*").alias("n")).where("n > 1").select(id_column).checkpoint()
    tf = None
    if several.isEmpty():
        single = _few_splits(plain, id_column).select(id_column, words)
    else:
        single = plain.join(several, id_column, "left_anti").select(id_column, words)
        tf = written(shared_counts(plain.join(several, id_column, "left_semi").select(id_column, words), id_column))
    # Small row groups, as readers take one at a time.
    bags = written(phrase_counts(single, id_column, total, top), **{"compression": "none", "parquet.block.size": 8 << 20, "parquet.enable.dictionary": "false"})
    n = bags.agg(F.sum("n")).first()[0] or 0
    bags = bags.coalesce(max(plain.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_WORDS)))
    bits = min(MOST_BITS, max(LEAST_BITS, int(n).bit_length()))
    spread = word_counts(bags)
    if tf is not None:
        each = tf.groupBy("phrase").agg(F.count("*").alias("df"))
        spread = spread.unionByName(each.where(~F.contains("phrase", F.lit(" ")))).groupBy("phrase").agg(F.sum("df").alias("df"))
    # Most words are in one text: what is not listed here has a df of 1.
    spread = written(spread.where("df > 1"))
    common, word_bits = frequent(spread, FREQUENT), max(LEAST_BITS, bits - 3)
    counted = (common, bitmap(placed(spread, word_bits), word_bits), word_bits)
    slots = contending_slots(bags, counted, total, top, bits)
    if tf is not None:
        listed = written(contenders(shared_lists(tf), common, total, top))
        slots = slots.unionByName(placed(listed.where("df is null"), bits).select("slot"))
    spread = marked_counts(bags, bitmap(slots, bits), bits)
    if tf is not None:
        spread = spread.unionByName(each)
    # Of those in one text, which are most, the places are enough.
    spread = placed(spread.groupBy("phrase").agg(F.sum("df").alias("df")), bits)
    spread = written(spread.select(F.when(F.col("df") > 1, F.col("phrase")).alias("phrase"), "df", F.col("slot").cast("int")))
    once, spread = spread.where("df = 1"), spread.where("df > 1")
    frequent_ones = frequent(spread, FREQUENT_PHRASES)
    candidates = bag_contenders(bags, counted, frequent_ones, (bitmap(once, bits), bitmap(spread, bits)), bits, total, top, kind)
    spread = spread.select("phrase", "df")
    if tf is None:
        spread = spread.where(F.col("df") <= int(frequent_ones[2]))
    else:
        candidates = candidates.unionByName(listed)
    scored = phrase_weights(candidates, spread, F.lit(total)).withColumnRenamed("id", id_column)
    ranked = scored.withColumn("_r", F.round("score", digits))
    return top_per_key(ranked.select(id_column, "phrase", "_r"), [id_column], [F.desc("_r"), F.asc("phrase")], top)


def _lists(best: DataFrame, id_column: str) -> DataFrame:
    """At most ``top`` phrases of a document in one string."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("_r")).alias("r"), "phrase")))
    return best.groupBy(id_column).agg(F.array_join(F.transform(ordered, lambda s: s["phrase"]), "; ").alias("keywords"))


def _all_ids(ids: DataFrame, lists: DataFrame, id_column: str) -> DataFrame:
    return ids.join(lists, id_column, "left").select(id_column, F.coalesce("keywords", F.lit("")).alias("keywords"))


def rerank(
    candidates: DataFrame, doc_vectors: DataFrame, phrase_vectors: DataFrame, id_column: str = "videoId",
    top: int = TOP_PHRASES,
) -> DataFrame:
    """Candidates (id, phrase) ordered by cosine of document ``vec`` and phrase ``vec``."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)

    pairs = candidates.join(doc_vectors.withColumnRenamed("vec", "_d"), id_column).join(
        phrase_vectors.withColumnRenamed("vec", "_p"), "phrase"
    )
    norm = F.sqrt(dot(F.col("_d"), F.col("_d")) * dot(F.col("_p"), F.col("_p")))
    scored = pairs.select(id_column, "phrase", F.try_divide(dot(F.col("_d"), F.col("_p")), norm).alias("_r"))
    best = top_per_key(scored, [id_column], [F.desc_nulls_last("_r"), F.asc("phrase")], top)
    return _all_ids(candidates.select(id_column).distinct(), _lists(best, id_column), id_column)

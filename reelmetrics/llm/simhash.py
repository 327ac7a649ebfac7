"""SimHash near-duplicates by a binary trie self-join.

Distinct fingerprints are the leaves of a binary trie. Pairs of nodes are walked down together,
adding up the bits in which they differ; a pair beyond the error budget is dropped with all
that lies below it. To share the walk between tasks, the trie is grown in several bit orders:
with a budget of k, two fingerprints that link agree on one of k + 1 blocks of bits, so the
order that begins with this block puts them below one node. These nodes are the groups the
tasks get. A group that is too large is parted again in the same way by the bits that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelmetrics.llm.common import flat, id_text, pieces
from reelmetrics.llm.components import components
from reelmetrics.session import shared_folder

SEED = 42
#: Fingerprints of a group beyond which it is parted again, and how often.
GROUP_ROWS = 1024
LEVELS = 3
#: Shingles whose bits are counted at once.
COUNTED = 1 << 17


def majority(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits set in over half of them; an empty run gives zero."""
    out = np.zeros(len(cuts) - 1, np.uint64)
    full = np.flatnonzero(np.diff(cuts))
    if not len(full):
        return out
    totals = np.zeros((len(full), 64), np.int64)
    starts = cuts[:-1][full]
    for lo in range(0, len(hashes), COUNTED):
        hi = min(lo + COUNTED, len(hashes))
        bits = np.unpackbits(hashes[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = int(np.searchsorted(starts, lo, side="right")) - 1
        last = int(np.searchsorted(starts, hi, side="left"))
        at = np.maximum(starts[first:last], lo) - lo
        totals[first:last] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    bits = (totals * 2 > np.diff(cuts)[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def text_fingerprints(texts: list[bytes], words: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes, cuts = [], [0]
    for text in texts:
        parts = text.lower().split()
        if parts:
            joined = b" ".join(parts)
            ends = np.cumsum([len(p) + 1 for p in parts]) - 1
            starts = np.append(0, ends[:-1] + 1)
            n = max(1, len(parts) - words + 1)
            ends = ends[words - 1 :] if len(parts) >= words else ends[-1:]
            hashes += [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)]
        cuts.append(len(hashes))
    return majority(np.array(hashes, np.uint64), np.array(cuts))


def fingerprints(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row; a null text is an empty one.

    ASCII letters are lower-cased, words are split at ASCII white space, and shingles of
    ``words`` words, repeats included, are hashed with XXH64 (seed 42). A shorter text is one
    shingle, one without words has the fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, at = flat(batch.column("text"))
            raw = data.tobytes()
            got = text_fingerprints([raw[a:b] for a, b in zip(at, at[1:])], words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got.view(np.int64))], ["doc_id", "fp"])

    return id_text(docs, key, text).mapInArrow(run, "doc_id long, fp long")


def trie_pairs(values: np.ndarray, starts: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of values of a group that differ in at most ``budget`` bits.

    ``values`` are distinct within a group and sorted there; ``starts`` has the n + 1 bounds
    of the groups, each the root of a trie.
    """
    a0, a1 = starts[:-1], starts[1:]
    keep = a1 - a0 > 1
    a0, a1 = a0[keep], a1[keep]
    b0, b1, diff = a0, a1, np.zeros(len(a0), np.int64)
    left, right = [], []
    for bit in range(63, -1, -1):
        if not len(a0):
            break
        ones = np.concatenate(([0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        across = ~same & (diff < budget)
        up = diff < budget
        a0, a1, b0, b1, diff = (
            np.concatenate(x)
            for x in (
                (a0, am, a0[up], am[across]),
                (am, a1, am[up], a1[across]),
                (b0, bm, bm[up], b0[across]),
                (bm, b1, b1[up], bm[across]),
                (diff, diff, diff[up] + 1, diff[across] + 1),
            )
        )
        live = (a1 > a0) & (b1 > b0) & ((a0 != b0) | (a1 - a0 > 1))
        a0, a1, b0, b1, diff = (x[live] for x in (a0, a1, b0, b1, diff))
        # Two leaves: the bits below are counted at once.
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        i, j = a0[leaf], b0[leaf]
        near = np.bitwise_count(values[i] ^ values[j]) <= budget
        left.append(i[near]), right.append(j[near])
        a0, a1, b0, b1, diff = (x[~leaf] for x in (a0, a1, b0, b1, diff))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable over the pairs, for each of ``n`` values."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _group_links(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links within each group; rows come sorted by group and value."""
    rest_k, rest_v = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def forest(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        by = np.lexsort((values, keys))
        keys, values = keys[by], values[by]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        i, j = trie_pairs(values, starts, budget)
        low = lowest(len(values), i, j)
        at = np.flatnonzero(low != np.arange(len(values)))
        signed = values.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[at]), pa.array(signed[low[at]])], ["a", "b"])

    for batch in batches:
        keys = np.concatenate((rest_k, batch.column("key").to_numpy()))
        values = np.concatenate((rest_v, batch.column("fp").to_numpy().view(np.uint64)))
        if not len(keys):
            continue
        cut = int(np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[-1])
        rest_k, rest_v = keys[cut:], values[cut:]
        if cut:
            yield forest(keys[:cut], values[:cut])
    if len(rest_k):
        yield forest(rest_k, rest_v)


def _parted(rows: DataFrame, budget: int) -> DataFrame:
    """Each row once for each block of its open bits (``free``, right-aligned, ``width`` of them).

    ``key`` is a hash of the path of blocks so far. Rows with equal paths have equal keys;
    a clash of hashes only makes two groups meet, whose pairs are compared in full.
    """
    choices = F.expr(
        "transform(sequence(0, {k}), i -> named_struct('i', i, 'lo', int(width * i div {n}), 'n', int(width * (i + 1) div {n} - width * i div {n})))".format(
            k=budget, n=budget + 1
        )
    )
    rows = rows.withColumn("block", F.explode(choices))
    bits: Column = F.expr("shiftrightunsigned(free, block.lo) & (shiftleft(1L, block.n) - 1)")
    below = F.expr("free & (shiftleft(1L, block.lo) - 1)")
    above = F.expr("shiftleft(shiftrightunsigned(shiftrightunsigned(free, block.lo), block.n), block.lo)")
    return rows.select(
        "fp", F.xxhash64("key", "block.i", bits).alias("key"), below.bitwiseOR(above).alias("free"), (F.col("width") - F.col("block.n")).alias("width")
    )


def links(distinct: DataFrame, budget: int = 2) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) that connect all that differ in at
    most ``budget`` bits: a spanning forest of each group, so that no number of near copies
    makes more links than fingerprints."""
    rows = distinct.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("free"), F.lit(64).alias("width"))
    ready = []
    for level in range(LEVELS):
        rows = _parted(rows, budget)
        if level < LEVELS - 1:
            large = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_ROWS).select("key").checkpoint()
            if large.isEmpty():
                break
            ready.append(rows.join(large, "key", "left_anti").select("key", "fp"))
            rows = rows.join(large, "key", "left_semi")
    found = rows.select("key", "fp")
    for more in ready:
        found = found.unionByName(more)
    grouped = found.repartition("key").sortWithinPartitions("key", "fp")
    return grouped.mapInArrow(lambda batches: _group_links(batches, budget), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Rows whose fingerprints differ in at most ``budget`` bits are linked, and component_id is
    the smallest id reachable over links (nulls apart; null if all ids are null). Equal
    fingerprints, as those of repeated rows and of empty texts, are one trie leaf. Other
    columns are not read. An empty table gives an empty result.
    """
    shared_folder(docs.sparkSession)
    prints = fingerprints(docs, words, key, text).checkpoint()
    leaves = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(leaves.select("fp"), budget)).withColumnRenamed("node", "fp")
    rooted = leaves.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest_ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(lowest_ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, budget: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows of ids that are not the smallest of a group of near-duplicates.

    All rows of an id that stays do stay; so do rows with a null id.
    """
    found = near_duplicates(docs, words, budget, key, text)
    kept = F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("kept")
    gone = found.groupBy("doc_id").agg(kept).where("kept = 0").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs[f"`{key}`"].cast("long") == gone["__gone"], "left_anti")

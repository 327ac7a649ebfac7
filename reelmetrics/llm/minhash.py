"""MinHash near-duplicates by tensored banding.

Two small collections of ``HALVES`` half keys are made for each set of shingles, a half key from
``ROWS`` minhashes. A table key is a pair of one half key of either collection, so 2 x HALVES x ROWS
minhashes (48) serve HALVES ** 2 tables (144) of 2 x ROWS minhashes each, which would take 576
of their own. Sets with similarity s meet in a table with 1 - 2 (1 - s ** ROWS) ** HALVES
at least: all but 5 pairs in ten million at 0.85, and all but one in 10 ** 8 at 0.9.

Half keys that one set alone has meet nobody and are dropped first. What meets is verified on full
sets, and without listing the pairs of a bucket:

1. Equal sets are one row from the start.
2. In the tables of a set's most shared half keys it is compared with the bucket's most central
   member. Sets that link are one class from then on; that settles most of a crowd of near copies.
3. Sets that meet sets of other classes are compared by their rarest shingles: with similarity t,
   two sets share one among their first n - ceil(t n) + 1 in any common order, and where the first
   such shingle stands bounds how many they can share at all. The order begins with shingles that one
   class alone has, which no other class can share, so two far copies of a text hardly ever become a
   pair. Pairs that pass and share a table key are compared in full, so no link is lost.

Sets are made again from the texts of those documents that share half keys; no other text is
read twice, and texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reelmetrics.llm.common import FILTER_BITS, flat, id_text, key_filter, may_hold, mix, pieces
from reelmetrics.llm.components import components
from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

WORDS = 5
#: Least similarity in hundredths.
PERCENT = 85
HALVES = 12
ROWS = 2
SEED = 42
#: Half keys of either collection, the most shared ones, whose tables give a set its first comparisons.
NEAREST = 2
SIGNED = "doc_id bigint, n_shingles bigint, set_id binary, halves array<bigint>"


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in one array, and the bounds of the texts in it."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    sets, cuts = [], [0]
    for text in texts:
        parts = text.lower().split()
        if parts:
            joined = b" ".join(parts)
            ends = np.cumsum([len(p) + 1 for p in parts]) - 1
            starts = np.append(0, ends[:-1] + 1)
            n = max(1, len(parts) - words + 1)
            ends = ends[words - 1 :] if len(parts) >= words else ends[-1:]
            hashes = [digest(joined[a:b]) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)]
            sets.append(np.unique(np.array(hashes, np.uint64)))
        cuts.append(cuts[-1] + (len(sets[-1]) if parts else 0))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array(cuts)


def half_keys(hashes: np.ndarray, starts: np.ndarray, halves: int = HALVES, rows: int = ROWS) -> np.ndarray:
    """2 x ``halves`` keys for each (non-empty) set, those of either collection side by side."""
    rng = np.random.default_rng(SEED)
    spread = mix(hashes)
    out = np.zeros((len(starts), 2 * halves), np.uint64)
    for k in range(2 * halves):
        key = np.full(len(starts), k + 1, np.uint64)
        for _ in range(rows):
            a, b = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            least = np.minimum.reduceat(spread * (a | np.uint64(1)) + b, starts)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
        out[:, k] = key
    return out


def signed(docs: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """Size, identity (128 bits) and half keys of each row's set of shingles; both null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, at = flat(batch.column("text"))
            raw = data.tobytes()
            hashes, cuts = shingle_sets([raw[a:b] for a, b in zip(at, at[1:])], words)
            size = np.diff(cuts)
            full = np.flatnonzero(size)
            starts = cuts[:-1][full]
            identity, keys = np.zeros((len(full), 2), np.uint64), np.zeros((0, 2 * HALVES), np.uint64)
            if len(full):
                identity = np.stack([np.add.reduceat(mix(hashes + np.uint64(s)), starts) for s in (1, 2)], axis=1)
                keys = half_keys(hashes, starts)
            names = np.full(len(size), None, object)
            names[full] = [row.tobytes() for row in identity]
            bounds = np.concatenate(([0], np.cumsum((size > 0) * 2 * HALVES))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), pa.array(names, pa.binary()), lists], ["doc_id", "n_shingles", "set_id", "halves"])

    return id_text(docs, key, text).mapInArrow(run, SIGNED)


def wanted_sets(docs: DataFrame, ids: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """(doc_id, shingles) of the rows with the wanted ids, filtered where the texts are read.

    The filter has a fixed size; what it lets through without need is not asked for later.
    """
    wanted = key_filter(ids.select(F.xxhash64("doc_id").alias("h")), FILTER_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in pieces(batches):
            ids = batch.column("doc_id").to_pylist()
            h = [xxhash.xxh64_intdigest((i or 0).to_bytes(8, "little", signed=True), 42) for i in ids]
            batch = batch.take(pa.array(np.flatnonzero(may_hold(shared.value, np.array(h, np.uint64)))))
            data, at = flat(batch.column("text"))
            raw = data.tobytes()
            hashes, cuts = shingle_sets([raw[a:b] for a, b in zip(at, at[1:])], words)
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "shingles"])

    return id_text(docs, key, text).mapInArrow(run, "doc_id bigint, shingles array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough. A document that many pairs have as ``b`` is met
    last, so its pairs can be split over tasks."""
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    whole = F.size("sa") + F.size("sb") - shared
    return both.where(100 * small >= percent * large).where(100 * shared >= percent * whole).select("a", "b")


def shared_halves(sets: DataFrame) -> DataFrame:
    """Sets (doc_id, n, halves) that share half keys of both collections, with these keys.

    left and right hold (sharing, half), the most shared first; degree is the sum of sharing.
    """
    halves = sets.select("doc_id", "n", F.posexplode("halves").alias("at", "half"))
    # Kept apart, so that the rows of a hot half key can be split when they are joined.
    met = halves.groupBy("half").agg(F.count("*").alias("sharing")).where("sharing > 1").checkpoint()

    def side(which):
        return F.reverse(F.array_sort(F.collect_list(F.when(which, F.struct("sharing", "half")))))

    alive = halves.join(met, "half").groupBy("doc_id").agg(
        F.first("n").alias("n"), F.sum("sharing").alias("degree"), side(F.col("at") < HALVES).alias("left"), side(F.col("at") >= HALVES).alias("right")
    )
    return alive.where("size(left) > 0 and size(right) > 0").checkpoint()


def central_pairs(shared: DataFrame) -> DataFrame:
    """Each set (a) with the most central members (b) of the tables of its most shared half keys."""
    left, right = (F.explode(F.slice(side, 1, NEAREST)) for side in ("left", "right"))
    tables = shared.select("doc_id", "degree", "right", left.alias("l")).select("doc_id", "degree", "l", right.alias("r"))
    tables = tables.select(F.xxhash64("l.half", "r.half").alias("bucket"), "doc_id", "degree")
    best = F.max(F.struct("degree", (-F.col("doc_id")).alias("m")))
    pivots = tables.groupBy("bucket").agg(F.count("*").alias("size"), best.alias("c")).where("size > 1").select("bucket", (-F.col("c.m")).alias("b")).checkpoint()
    return tables.join(pivots, "bucket").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()


def meeting_other_classes(classed: DataFrame) -> DataFrame:
    """Of sets with half keys and class those that share half keys of both collections with other classes."""

    def side(name):
        return F.transform(name, lambda x: F.struct(x["half"].alias("half"), F.lit(name == "left").alias("left")))

    halves = classed.select("doc_id", "class", F.explode(F.concat(side("left"), side("right"))).alias("h")).select("doc_id", "class", "h.*")
    mixed = halves.groupBy("half").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("half").checkpoint()
    met = halves.join(mixed, "half").groupBy("doc_id").agg(F.bool_or("left").alias("l"), F.bool_or(~F.col("left")).alias("r"))
    return classed.join(met.where("l and r").select("doc_id"), "doc_id")


def rare_pairs(classed: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different classes that may be similar enough, by their rarest shingles."""
    items = classed.select("doc_id", "n", "class").join(full, "doc_id").select("doc_id", "n", "class", F.explode("shingles").alias("x"))
    spread = items.groupBy("x").agg(F.count("*").alias("f"), F.min("class").alias("lo"), F.max("class").alias("hi"))
    spread = spread.where("lo <> hi").select("x", "f").checkpoint()
    own = Window.partitionBy("doc_id")
    place = F.row_number().over(own.orderBy("f", "x")) + F.col("n") - F.count("*").over(own)
    least = F.expr(f"(n * {percent} + 99) div 100")
    rare = items.join(spread, "x").withColumn("place", place).where(F.col("place") <= F.col("n") - least + 1)
    rare = rare.select("x", "doc_id", "n", "class", "place").checkpoint()
    # Sets outside the largest class of a shingle meet all that have it; those within are one class.
    most = rare.groupBy("x", "class").agg(F.count("*").alias("c")).groupBy("x").agg(F.max(F.struct("c", "class"))["class"].alias("most")).checkpoint()
    one = rare.join(most, "x").where("class <> most").select("x", *(F.col(c).alias(f"{c}_a") for c in ("doc_id", "n", "class", "place")))
    most_shared = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n") - F.col("place"))
    enough = most_shared * (100 + percent) >= (F.col("n_a") + F.col("n")) * percent
    pairs = one.join(rare, "x").where((F.col("class") != F.col("class_a")) & enough)
    return pairs.select(F.least("doc_id", "doc_id_a").alias("a"), F.greatest("doc_id", "doc_id_a").alias("b")).distinct()


def sharing_a_table(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """Pairs that share a half key of either collection, and so the table key made of both."""
    keys = shared.select("doc_id", F.col("left.half").alias("l"), F.col("right.half").alias("r"))
    of_a, of_b = (keys.select(F.col("doc_id").alias(c), F.col("l").alias(f"l{c}"), F.col("r").alias(f"r{c}")) for c in "ab")
    return pairs.join(of_a, "a").join(of_b, "b").where(F.arrays_overlap("la", "lb") & F.arrays_overlap("ra", "rb")).select("a", "b")


def similarity_links(docs: DataFrame, sets: DataFrame, words: int, percent: int, key: str, text: str) -> DataFrame:
    """Links (a, b) between sets (doc_id, n, halves) that join all that are linked to each other."""
    shared = shared_halves(sets)
    full = wanted_sets(docs, shared.select("doc_id"), words, key, text).checkpoint()
    links = verified(central_pairs(shared), full, percent).checkpoint()
    roots = components(links).withColumnRenamed("node", "doc_id").withColumnRenamed("root", "class")
    classed = shared.join(roots, "doc_id", "left").withColumn("class", F.coalesce("class", "doc_id")).checkpoint()
    pairs = sharing_a_table(rare_pairs(meeting_other_classes(classed).checkpoint(), full, percent), shared)
    return links.unionByName(verified(pairs, full, percent)).checkpoint()


def minhash_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    A row's set is its distinct shingles of ``words`` words, ASCII letters lower-cased; with
    fewer words it is the whole sequence. Sets link where the intersection is ``percent`` hundredths
    of the union or more; component_id is the smallest id reachable over links. A row without
    words (or with a null text) has an empty set and is linked with nothing. Rows with equal ids are
    one document in the links, each with its own set. Rows with a null id are linked with nothing and
    have no component. Other columns are not read; an empty table gives an empty result.
    """
    shared_folder(docs.sparkSession)
    rows = signed(docs, words, key, text).checkpoint()
    sets = rows.where("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves"))
    sets = sets.checkpoint()
    links = similarity_links(docs, sets.select(F.col("first").alias("doc_id"), "n", "halves"), words, percent, key, text)
    roots = components(links).withColumnRenamed("node", "first")
    classes = sets.join(roots, "first", "left").select("set_id", F.coalesce("root", "first").alias("root"), "copies")
    named = lookup_join(rows.select("doc_id", "n_shingles", "set_id"), classes, "set_id", "copies", ["doc_id"], small=False)
    return named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))

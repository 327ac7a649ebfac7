"""Helpers shared by the operators: input columns, Arrow texts, and a bounded key filter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TEXT_BYTES = 1 << 22


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; a null text is an empty one."""
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and the n + 1 offsets of the texts in it."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


# An odd multiplier, and its inverse modulo 2**64, for prefix hashes of byte strings.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each byte span that depends on its bytes alone, not on where it stands."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * powers(INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


FILTER_BITS = 1 << 23


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of the distinct long values in column ``h``, two probes a key.

    Its size is fixed, whatever the number of keys: at most ``bits`` / 64 rows come to the
    driver. A filter that is too full lets more keys through and loses none, so what it lets
    through is joined exactly afterwards.
    """
    slots = F.array(*(F.pmod(F.shiftrightunsigned("h", s), F.lit(bits)) for s in (0, 31)))
    words = keys.select(F.explode(slots).alias("slot")).selectExpr("slot div 64 as word", "shiftleft(1L, int(pmod(slot, 64))) as bit")
    out = np.zeros(bits // 64, np.int64)
    for row in words.groupBy("word").agg(F.expr("bit_or(bit)").alias("bit")).toLocalIterator():
        out[row["word"]] = row["bit"]
    return out.view(np.uint64)


def may_hold(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each 64-bit value whether the filter may hold it."""
    mask = np.uint64(len(words) * 64 - 1)
    found = np.ones(len(h), bool)
    for s in (0, 31):
        slot = (h >> np.uint64(s)) & mask
        found &= (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return found


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``: the fixed folds of the labelled rows."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))

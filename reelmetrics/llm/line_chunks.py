"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines chooses the ends of chunks, so inserted
or deleted lines move only the ends beside them. Chunks have two lines at least. A chunk that
stands anywhere else, too, is removed everywhere but at its first place.

Such chunks alone miss a passage that no whole chunk lies in: whether a short passage holds one
hangs on the lines beside it. So every line with text is also a chunk with the next one, as if
each place were a boundary for some hash, and what is removed is the union of all chunks that
repeat: wherever two or more lines in a row repeat an earlier place, the common run goes to its
last line. Chunks are found by 64-bit hashes and told apart by the SHA-256 of their bytes, which
has one size however long a line is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelmetrics.llm.common import BASE, flat, key_filter, may_hold, mix, pieces, span_hashes
from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

Bounds = Callable[[pa.Array], tuple[np.ndarray, ...]]

#: Lines that the rolling hash sees, and the share of its values that may end a chunk: one in ...
ROLLING = 2
DIVISOR = 2

ROW = ["doc_id", "row"]


def text_lines(texts: pa.Array):
    """Of all lines: owner (index of the text), number in it, begin and end in ``data``; the
    number of characters before each place of ``data`` that aren't white space; and ``data``."""
    data, at = flat(texts)
    full = at[1:] > at[:-1]
    breaks = np.flatnonzero(data == 10)
    # Lines of all texts that aren't empty, in order.
    starts = np.sort(np.concatenate((at[:-1][full], breaks + 1)))
    ends = np.sort(np.concatenate((breaks, at[1:][full])))
    # A break at the end of a text is followed by an empty line, whose start is the next text's.
    owner = np.sort(np.concatenate((np.flatnonzero(full), np.searchsorted(at, breaks, side="right") - 1)))
    line = np.arange(len(owner)) - np.searchsorted(owner, owner)
    solid = np.concatenate(([0], np.cumsum((data != 32) & ((data < 9) | (data > 13)))))
    return owner, line, starts, ends, solid, data


def chunk_bounds(texts: pa.Array, rolling: int = ROLLING, divisor: int = DIVISOR):
    """Of the chunks with two or more lines that have text: owner (index of the text), first
    line, number of lines, and begin and end in ``data``; and ``data`` itself.

    A chunk ends after a line whose rolling hash qualifies if that of the line before doesn't,
    which keeps ends two lines apart; the text's last line ends the last chunk, and a line is
    never left alone there.
    """
    owner, line, starts, ends, solid, data = text_lines(texts)
    size = np.bincount(owner)[owner]
    h = span_hashes(data, starts, ends)
    roll = np.zeros(len(h), np.uint64)
    for k in range(rolling):
        roll[k:] += h[: len(h) - k] * np.uint64(pow(BASE, k, 1 << 64))
    fits = (mix(roll) % np.uint64(divisor) == 0) & (line >= rolling - 1)
    before = np.concatenate(([False], fits[:-1])) & (line > 0)
    end = fits & ~before & (line >= 1) & (line < size - 2)
    end |= line == size - 1
    last = np.flatnonzero(end)
    first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    said = np.concatenate(([0], np.cumsum(solid[ends] > solid[starts])))
    many = said[last + 1] - said[first] > 1
    first, last = first[many], last[many]
    return owner[first], line[first], last - first + 1, starts[first], ends[last], data


def passage_bounds(texts: pa.Array, rolling: int = ROLLING, divisor: int = DIVISOR):
    """The same of the chunks of ``chunk_bounds`` and of every line with text together with the
    next one in its text that has any (blank lines between belong to the chunk)."""
    owner, line, starts, ends, solid, data = text_lines(texts)
    said = np.flatnonzero(solid[ends] > solid[starts])
    first, last = said[:-1], said[1:]
    same = owner[first] == owner[last]
    first, last = first[same], last[same]
    pairs = owner[first], line[first], line[last] - line[first] + 1, starts[first], ends[last]
    *chunks, _ = chunk_bounds(texts, rolling, divisor)
    return *(np.concatenate(both) for both in zip(chunks, pairs, strict=True)), data


def _hashes(batches: Iterator[pa.RecordBatch], bounds: Bounds) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        *_, begin, end, data = bounds(batch.column("text"))
        yield pa.RecordBatch.from_arrays([pa.array(span_hashes(data, begin, end).view(np.int64))], ["h"])


def repeated(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """doc_id, row, line, n_lines of every chunk that repeats an earlier one, by its digest.

    ``rows`` has doc_id, row (which tells rows of one id apart) and text, without nulls. Of a
    chunk that overlaps its own first place (a line said over and over) only the rest is given.
    The texts are read twice: for the hashes that repeat, and for the places of their chunks,
    which are written once. A chunk that very many texts hold is looked up by broadcast.
    """
    shared_folder(rows.sparkSession)
    hashes = rows.select("text").mapInArrow(lambda b: _hashes(b, bounds), "h long")
    often = hashes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.sparkSession.sparkContext.broadcast(key_filter(often))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            owner, line, n, begin, end, data = bounds(batch.column("text"))
            hit = np.flatnonzero(may_hold(shared.value, span_hashes(data, begin, end)))
            raw = memoryview(np.ascontiguousarray(data))
            take = pa.array(owner[hit])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("row").take(take),
                    pa.array(line[hit]),
                    pa.array(n[hit]),
                    pa.array([hashlib.sha256(raw[a:b]).digest() for a, b in zip(begin[hit].tolist(), end[hit].tolist())], pa.binary()),
                ],
                ["doc_id", "row", "line", "n_lines", "chunk"],
            )

    found = rows.mapInArrow(candidates, "doc_id long, row long, line long, n_lines long, chunk binary").checkpoint()
    place = F.struct("doc_id", "row", "line")
    first = found.groupBy("chunk").agg(F.min(place).alias("kept"), F.max(place).alias("other"), F.count("*").alias("n"))
    first = first.where("kept <> other").drop("other")
    again = lookup_join(found, first, "chunk", weight="n", spread=ROW + ["line"], small=False).where(place != F.col("kept"))
    own = (F.col("kept.doc_id") == F.col("doc_id")) & (F.col("kept.row") == F.col("row"))
    end = F.col("line") + F.col("n_lines")
    line = F.when(own, F.greatest("line", F.col("kept.line") + F.col("n_lines"))).otherwise(F.col("line"))
    return again.select("doc_id", "row", line.alias("line"), (end - line).alias("n_lines"))


def _left(batches: Iterator[pa.RecordBatch], union: bool) -> Iterator[pa.RecordBatch]:
    """The lines that stay, as ranges whose last one is open, and how much goes."""
    for batch in batches:
        rows = []
        for gone in batch.column("gone"):
            line, n = (gone.values.field(k).to_numpy() for k in (0, 1))
            by = np.argsort(line)
            line, end = line[by], np.maximum.accumulate((line + n)[by])
            new = np.concatenate(([True], line[1:] > end[:-1]))
            begin, end = line[new], end[np.append(new[1:], True)]
            stays = np.concatenate(([0], end)), np.append(begin, np.iinfo(np.int32).max) - np.concatenate(([0], end))
            rows.append((np.stack(stays, axis=1).tolist(), len(begin) if union else len(gone), int((end - begin).sum())))
        stay, chunks, lines = zip(*rows) if rows else [()] * 3
        kind = pa.list_(pa.list_(pa.int32()))
        arrays = [batch.column("__id"), batch.column("__row"), pa.array(stay, kind), pa.array(chunks, pa.int32()), pa.array(lines, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["__id", "__row", "__stay", "__chunks", "__lines"])


def _drop(docs: DataFrame, key: str, text: str, bounds: Bounds, union: bool) -> DataFrame:
    named = docs.drop("n_chunks_removed", "n_lines_removed")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("row"), F.col(f"`{text}`").alias("text"))
    gone = repeated(rows.where("doc_id is not null and text is not null"), bounds)
    gone = gone.distinct().groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_list(F.struct("line", "n_lines")).alias("gone"))
    left = gone.mapInArrow(lambda b: _left(b, union), "__id long, __row long, __stay array<array<int>>, __chunks int, __lines long")
    own = F.col(f"`{text}`")
    joined = named.join(left, (named[f"`{key}`"].cast("long") == left["__id"]) & (F.xxhash64(named[f"`{text}`"]) == left["__row"]), "left")
    # An array of one holds the lines, so that they are split once.
    cut = F.transform(
        F.array(F.split(own, "\n", -1)),
        lambda lines: F.array_join(F.flatten(F.transform("__stay", lambda s: F.slice(lines, s[0] + 1, s[1]))), "\n"),
    )
    return joined.select(
        *(F.when(F.col("__stay").isNull(), own).otherwise(cut[0]).alias(c) if c == text else F.col(f"`{c}`") for c in named.columns),
        F.coalesce("__chunks", F.lit(0)).alias("n_chunks_removed"),
        F.coalesce("__lines", F.lit(0).cast("long")).alias("n_lines_removed"),
    )


def drop_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", rolling: int = ROLLING, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with the text column shortened, and n_chunks_removed and n_lines_removed beside it.

    Of equal chunks of ``chunk_bounds`` the one with the smallest id, then the first line, stays,
    and the lines of the others go; the lines that are left are joined as they were. A text may
    become empty. Chunks with text in fewer than two lines stay, and so does a passage that no
    whole chunk lies in. Rows with equal ids and texts are one place; rows with a null id or text
    are neither changed nor counted. All other columns are kept, so are the two new names if
    ``docs`` has them (its own are replaced).
    """
    return _drop(docs, key, text, lambda texts: chunk_bounds(texts, rolling, divisor), False)


def drop_repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", rolling: int = ROLLING, divisor: int = DIVISOR) -> DataFrame:
    """As ``drop_repeated_chunks``, but every passage goes that repeats two or more lines with text.

    A line goes if a chunk of ``passage_bounds`` that it stands in has an earlier place that
    doesn't hold the line itself. So the first place of every line stays, if not always beside
    the lines that a later text had it with. n_chunks_removed counts the runs of lines removed.
    """
    return _drop(docs, key, text, lambda texts: passage_bounds(texts, rolling, divisor), True)

"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut where no piece reaches over, and each distinct part is counted once a task.
The symbols of many parts lie in one flat array; in each round every part merges its pair of
the lowest rank, all parts at once, until no part has a pair left. What survives is counted.
Long parts are merged rank by rank, too, but keep their pairs between rounds, sorted by rank, so
that a round touches the merged pairs and their neighbours alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelmetrics.llm.common import id_text, pieces
from reelmetrics.llm.pieces import PieceModel, key_text, part_keys

NEVER = np.int64(1 << 62)
#: Parts that a task keeps, and characters that are merged at once.
KEPT_PARTS = 400_000
MERGED_CHARS = 1 << 19
#: Parts of more symbols keep their pairs between rounds.
LONG_PART = 256


class LongParts:
    """Symbols of long parts in one array, linked to their neighbours, and their pairs by rank.

    Ranks are taken in order, over all parts at once, as parts don't touch. All pairs of a rank
    are merged together, of overlapping ones every other from the left. Where a merge makes a pair
    that is as good or better, the pairs around it are merged one by one, from the left: no piece
    has more than ``longest`` characters, so pairs that are further apart than that don't meet.
    """

    def __init__(self, model: PieceModel, symbol: np.ndarray, part: np.ndarray):
        n, self.model, self.symbol = len(symbol), model, symbol
        same = part[1:] == part[:-1]
        self.after = np.append(np.where(same, np.arange(1, n), -1), -1)
        self.before = np.append(-1, np.where(same, np.arange(n - 1), -1))
        self.alive = np.ones(n, bool)
        self.made = np.full(n, -1)
        self.waiting: dict[int, list[np.ndarray]] = {}
        self.ranks: list[int] = []
        self.pairs: dict[int, int] = {}

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that symbols at two places make; a place of -1 holds none."""
        made = self.model.find_pairs(self.symbol[left], self.symbol[right])
        return np.where((left >= 0) & (right >= 0), made, -1)

    def look(self, at: np.ndarray) -> None:
        """Note the pairs that begin at these places."""
        self.made[at] = made = self.pair(at, self.after[at])
        at, rank = at[made >= 0], self.model.rank[made[made >= 0]]
        by = np.argsort(rank, kind="stable")
        at, rank = at[by], rank[by]
        cut = np.flatnonzero(np.diff(rank, prepend=-1))
        for r, places in zip(rank[cut].tolist(), np.split(at, cut[1:])):
            if r not in self.waiting:
                self.waiting[r] = []
                heappush(self.ranks, r)
            self.waiting[r].append(places)

    def merge(self, at: np.ndarray) -> None:
        """Merge pairs that don't overlap."""
        gone = self.after[at]
        then = self.after[gone]
        self.symbol[at], self.alive[gone], self.after[at] = self.made[at], False, then
        self.before[then[then >= 0]] = at[then >= 0]
        left = self.before[at]
        self.look(np.unique(np.concatenate((at, left[left >= 0]))))

    def unsteady(self, at: np.ndarray, rank: int) -> np.ndarray:
        """Which of the pairs lie in a group in which a merge may make a pair as good or better."""
        ranks = self.model.rank
        over = self.after[at]
        right, left = self.after[over], self.before[at]
        made, none = self.made[at], np.full(len(at), -1)
        better = np.zeros(len(at), bool)
        for a, b in ((np.where(left >= 0, self.symbol[left], none), made), (made, np.where(right >= 0, self.symbol[right], none))):
            new = self.model.find_pairs(a, b)
            better |= (new >= 0) & (ranks[new] <= rank)
        touch = (at[1:] == over[:-1]) | (at[1:] == right[:-1])
        better[1:] |= touch
        better[:-1] |= touch
        group = np.cumsum(np.diff(at, prepend=at[0]) > 3 * self.model.longest)
        return np.bincount(group, better)[group] > 0

    def one_by_one(self, at: np.ndarray, rank: int) -> None:
        """Merge these pairs and all that follow from them up to ``rank``, the best and leftmost first."""
        if not self.pairs:
            self.pairs = dict(zip(self.model.pair_keys.tolist(), self.model.pair_piece.tolist()))
        symbol, after, before, alive, made, ranks = self.symbol, self.after, self.before, self.alive, self.made, self.model.rank
        open_, later = [(rank, i) for i in at.tolist()], []
        while open_:
            r, i = heappop(open_)
            if not alive[i] or made[i] < 0 or ranks[made[i]] != r:
                continue
            gone = after[i]
            then = int(after[gone])
            symbol[i], alive[gone], after[i] = made[i], False, then
            if then >= 0:
                before[then] = i
            for a, b in ((int(before[i]), i), (i, then)):
                if a >= 0:
                    new = self.pairs.get(int(symbol[a]) * self.model.size + int(symbol[b]), -1) if b >= 0 else -1
                    made[a] = new
                    if new >= 0 and ranks[new] <= rank:
                        heappush(open_, (int(ranks[new]), a))
                    elif new >= 0:
                        later.append(a)
        later = np.unique(np.array(later, np.int64))
        self.look(later[alive[later]])

    def run(self) -> np.ndarray:
        """Which symbols are left."""
        self.look(np.arange(len(self.symbol)))
        while self.ranks:
            rank = heappop(self.ranks)
            at = np.unique(np.concatenate(self.waiting.pop(rank)))
            at = at[self.alive[at] & (self.made[at] >= 0)]
            at = at[self.model.rank[self.made[at]] == rank]
            if len(at) and self.model.unsteady[rank]:
                slow = self.unsteady(at, rank)
                self.one_by_one(at[slow], rank)
                at = at[~slow]
            if len(at):
                begin = np.append(True, at[1:] != self.after[at[:-1]])
                since = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
                self.merge(at[since % 2 == 0])
        return self.alive


def part_lengths(model: PieceModel, keys: list[str]) -> np.ndarray:
    """The number of tokens of each part."""
    texts = [key_text(k) for k in keys]
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) for t in texts])
    symbol = model.char[chars].astype(np.int64)
    part = np.repeat(np.arange(len(keys)), size)
    width = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
    known = symbol >= 0
    out = np.bincount(part[~known], width[~known] if model.fallback else None, len(keys)).astype(np.int64)
    # A character without a piece merges with nothing: it parts the symbols around it.
    part = (part + np.cumsum(~known))[known]
    owner = np.repeat(np.arange(len(keys)), size)[known]
    symbol = symbol[known]
    long = np.bincount(part)[part] > LONG_PART if len(part) else np.zeros(0, bool)
    if long.any():
        left = LongParts(model, symbol[long], part[long]).run()
        out += np.bincount(owner[long][left], minlength=len(keys))
        symbol, part, owner = symbol[~long], part[~long], owner[~long]
    while len(symbol):
        made = model.find_pairs(symbol[:-1], symbol[1:])
        made[part[1:] != part[:-1]] = -1
        rank = np.where(made >= 0, model.rank[made], NEVER)
        rank = np.append(rank, NEVER)
        made = np.append(made, -1)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        length = np.diff(np.append(starts, len(part)))
        best = np.repeat(np.minimum.reduceat(rank, starts), length)
        over = best == NEVER
        out += np.bincount(owner[over], minlength=len(keys))
        chosen = (rank == best) & ~over
        # Of overlapping pairs every other one is merged, from the left. If the new piece may
        # take part in a better merge, only the first of the part is.
        at = np.flatnonzero(chosen)
        if not len(at):
            break
        begin = np.append(True, (np.diff(at) != 1) | (made[at][1:] != made[at][:-1]))
        since = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
        first = np.append(True, part[at][1:] != part[at][:-1])
        kinds = made[at]
        mixed = np.bincount(part[at] - part[0], kinds != kinds[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))])
        alone = model.volatile[kinds] | (mixed[part[at] - part[0]] > 0)
        at = at[np.where(alone, first, since % 2 == 0)]
        symbol[at] = made[at]
        keep = ~over
        keep[at + 1] = False
        symbol, part, owner = symbol[keep], part[keep], owner[keep]
    return out


def text_lengths(model: PieceModel, kept: dict[str, int], texts: list[str]) -> list[int]:
    """Tokens of each text; ``kept`` holds the counts of parts seen before."""
    cut = [part_keys(t, model.lines_apart) for t in texts]
    if len(kept) > KEPT_PARTS:
        kept.clear()
    if new := sorted(set().union(*cut).difference(kept), key=len):
        begin, chars = 0, 0
        for i, k in enumerate(new):
            chars += len(k) + 1
            if chars >= MERGED_CHARS or i == len(new) - 1:
                kept.update(zip(new[begin : i + 1], part_lengths(model, new[begin : i + 1]).tolist(), strict=True))
                begin, chars = i + 1, 0
    return [sum(map(kept.__getitem__, keys)) for keys in cut]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, by the BPE model at ``model_path``.

    No begin, end or special tokens are added; their strings in a text are ordinary text. A
    null text counts as an empty one, with no token. Repeated rows, and rows with a null id,
    each give a row; other columns are not read. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, kept = shared.value, {}
        for batch in pieces(batches):
            lengths = text_lengths(model, kept, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(lengths, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = id_text(docs, key, text).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is the composition of three machines over the tropical semiring:

* the normaliser writes a space mark before the text and for each space,
* the piece acceptor is a trie of the pieces with a byte path for every other character,
* the merge grammar has the last piece as its state. An arc weighs nothing if merging the two
  pieces' characters in rank order leaves exactly these two pieces, and infinity otherwise.

Every text has exactly one path of finite weight, the segmentation that merging gives. So the
shortest path keeps one state a position: the one piece that may end there. Many inputs are
composed and searched at once in flat arrays; each distinct part of a text is encoded once a
task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelmetrics.llm.common import id_text, lists, pieces
from reelmetrics.llm.pieces import SPACE, PieceModel, key_text, part_keys

KEPT_PARTS = 300_000
COMPOSED_CHARS = 1 << 17
#: Slots of the table of pair weights that a task has worked out.
WEIGHT_SLOTS = 1 << 21
#: Characters beyond which a text is composed apart, and the arcs whose meetings are weighed at once.
LONG_TEXT = 1024
ARCS = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)


class Transducer:
    """The compiled machine: trie arcs, byte arcs and what the merge grammar's weights need."""

    def __init__(self, path: str):
        self.model = model = PieceModel(path)
        # The pieces of spaces only come last of all merges, so runs of spaces are a machine of their own.
        self.blank = np.array([p.strip(SPACE) == "" and len(p) > 1 for p in model.pieces])
        self.left, self.right = self._halves()
        chars = sorted({c for p in model.normal for c in p})
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in chars]] = np.arange(len(chars))
        self.letters = len(chars)
        # Trie nodes are the prefixes of pieces; node 0 is the empty one.
        prefixes = sorted({p[:n] for p in self._usable() for n in range(1, len(p) + 1)}, key=lambda p: (len(p), p))
        node = {"": 0} | {p: i + 1 for i, p in enumerate(prefixes)}
        keys = np.array([node[p[:-1]] * self.letters + self.letter[ord(p[-1])] for p in prefixes], np.int64)
        by = np.argsort(keys)
        self.arc_keys, self.arc_to = keys[by], (by + 1).astype(np.int64)
        self.final = np.full(len(node), -1, np.int64)
        for p in self._usable():
            self.final[node[p]] = model.normal[p]
        self.inner = np.zeros(len(node), bool)
        self.inner[keys // self.letters] = True
        # Bytes a piece decodes to.
        said = [p.replace(SPACE, " ").encode() for p in model.pieces]
        for value, i in model.bytes.items():
            said[i] = bytes([value])
        for i in (i for i, p in enumerate(model.pieces) if p not in model.normal and i not in model.bytes.values()):
            said[i] = b"" if i != model.unknown else " ⁇ ".encode()
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_size = np.array([len(x) for x in said])
        self.said_at = np.cumsum(self.said_size) - self.said_size

    def _halves(self) -> tuple[np.ndarray, np.ndarray]:
        """The two pieces whose merge makes each piece; -1 for single characters.

        The last merge of a piece is the one left when its own characters are merged in rank
        order. A piece that merging never makes keeps -2 and is no arc of the machine.
        """
        model = self.model
        left, right = np.full(model.size, -2, np.int64), np.full(model.size, -2, np.int64)
        for piece, i in model.normal.items():
            parts = [model.normal.get(c, -1) for c in piece]
            if len(parts) == 1:
                left[i] = right[i] = -1
                continue
            last = None
            while len(parts) > 1:
                made = [model.normal.get(model.pieces[a] + model.pieces[b]) if a >= 0 and b >= 0 else None for a, b in zip(parts, parts[1:])]
                ranks = [model.rank[m] if m is not None else None for m in made]
                known = [r for r in ranks if r is not None]
                if not known:
                    break
                at = ranks.index(min(known))
                last = parts[at], parts[at + 1]
                parts[at : at + 2] = [made[at]]
            if parts == [i]:
                left[i], right[i] = last
        return left, right

    def _usable(self) -> list[str]:
        return [p for p, i in self.model.normal.items() if self.left[i] > -2 and not self.blank[i]]

    def allowed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the arc from piece ``first`` to piece ``second`` weighs nothing.

        Merging would join the two only where a piece on the right edge of the first meets
        one on the left edge of the second, both present at the same time, with a pair that
        ranks before the merge that takes either away. The edges are undone from the top,
        the later merge first, and each meeting is looked up.
        """
        rank, left, right = self.model.rank, self.left, self.right
        good = np.ones(len(first), bool)
        rows = np.flatnonzero((first >= 0) & (second >= 0))
        a, b = first[rows], second[rows]
        # When the pieces on the edges are merged away; a tie goes to the left one of the merges.
        never = np.int64(1 << 40)
        gone_a, gone_b = np.full(len(rows), never), np.full(len(rows), never)
        while len(rows):
            made = self.model.find_pairs(a, b)
            when = np.where(made >= 0, rank[made], never)
            # The crossing merge stands right of a's own and left of b's.
            bad = (made >= 0) & (when < gone_a) & (when <= gone_b)
            good[rows[bad]] = False
            undo_a, undo_b = left[a] >= 0, left[b] >= 0
            born_a, born_b = np.where(undo_a, rank[a], -1), np.where(undo_b, rank[b], -1)
            # What was made last is undone first; of equals b, whose merge is the right one.
            take_a = undo_a & (born_a > born_b)
            take_b = ~take_a & undo_b
            gone_a, gone_b = np.where(take_a, born_a, gone_a), np.where(take_b, born_b, gone_b)
            a, b = np.where(take_a, right[a], a), np.where(take_b, left[b], b)
            on = ~bad & (take_a | take_b)
            rows, a, b, gone_a, gone_b = rows[on], a[on], b[on], gone_a[on], gone_b[on]
        return good


class Encoder:
    """Composes inputs with the transducer; what was worked out before is kept for the task."""

    def __init__(self, machine: Transducer):
        self.machine, self.model = machine, machine.model
        self.kept: dict[str, bytes] = {}
        self.pair = np.full(WEIGHT_SLOTS, -1, np.int64)
        self.free = np.zeros(WEIGHT_SLOTS, bool)
        self.spaces: dict[int, list[int]] = {}

    def finite(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = (first + 2) * (self.model.size + 2) + second + 2
        slot = ((key.astype(np.uint64) * MIX) >> np.uint64(43)).astype(np.int64)
        new = np.flatnonzero(self.pair[slot] != key)
        out = self.free[slot]
        if len(new):
            out[new] = self.machine.allowed(first[new], second[new])
            self.pair[slot[new]], self.free[slot[new]] = key[new], out[new]
        return out

    def space_run(self, n: int) -> list[int]:
        """Pieces of ``n`` space marks that merge with nothing else.

        Equal neighbours are kept as one piece and a number, which stays a short list; a merge
        that no better one can follow is made for all of them at once.
        """
        if n not in self.spaces:
            model, runs = self.model, [(SPACE, n)]
            while True:
                best, at, inside = None, 0, False
                for i, (piece, times) in enumerate(runs):
                    after = runs[i + 1][0] if i + 1 < len(runs) else None
                    for other, within in ((piece if times > 1 else None, True), (after, False)):
                        whole = model.normal.get(piece + other) if other else None
                        if whole is not None and (best is None or model.rank[whole] < best):
                            best, at, inside = model.rank[whole], i, within
                if best is None:
                    break
                piece, times = runs[at]
                if inside:
                    whole = piece * 2
                    done = 1 if model.unsteady[best] else times // 2
                    new, end = [(whole, done), (piece, times - 2 * done)], at + 1
                else:
                    other, more = runs[at + 1]
                    new, end = [(piece, times - 1), (piece + other, 1), (other, more - 1)], at + 2
                joined: list[tuple[str, int]] = []
                for piece, times in (*runs[max(0, at - 1) : at], *new, *runs[end : end + 1]):
                    if times and joined and joined[-1][0] == piece:
                        joined[-1] = (piece, joined[-1][1] + times)
                    elif times:
                        joined.append((piece, times))
                runs[max(0, at - 1) : end + 1] = joined
            self.spaces[n] = [i for piece, times in runs for i in self.of_piece(piece) * times]
        return self.spaces[n]

    def of_piece(self, piece: str) -> list[int]:
        i = self.model.normal.get(piece)
        return [i] if i is not None else self.of_bytes(piece)

    def of_bytes(self, char: str) -> list[int]:
        return [self.model.bytes[b] for b in char.encode()] if self.model.fallback else [self.model.unknown]

    def abreast(self, n: int, begin: np.ndarray, start: np.ndarray, end: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts a character at a time. Gives the piece on the path to each place, and where it begins.

        States stand at the place after a character, so that neighbours in the flat array don't share one.
        """
        local = end - begin
        by = np.argsort(local, kind="stable")
        begin, start, end, piece, local = begin[by], start[by], end[by], piece[by], local[by]
        bounds = np.searchsorted(local, np.arange(1, local[-1] + 2))
        state, back = np.full(n, -2, np.int64), np.zeros(n, np.int64)
        for lo, hi in zip(bounds, bounds[1:]):
            s, e, p = start[lo:hi], end[lo:hi], piece[lo:hi]
            first = s == begin[lo:hi]
            last = np.where(first, -1, state[s - 1])
            fits = np.flatnonzero(first | ((last > -2) & self.finite(last, p)))
            state[e[fits] - 1], back[e[fits] - 1] = p[fits], s[fits]
        return state, back

    def along(self, n: int, begin: np.ndarray, start: np.ndarray, end: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``abreast``, for few long texts: the weights of all pairs of arcs that meet are looked
        up beforehand, a block of arcs at a time, and the arcs are relaxed one after the other."""
        by = np.argsort(end, kind="stable")
        begin, start, end, piece = begin[by], start[by], end[by], piece[by]
        scale = self.model.size + 2
        state, back = [-2] * n, [0] * n
        free: set[int] = set()
        seen = np.zeros(0, np.int64)
        for lo in range(0, len(end), ARCS):
            part = slice(lo, lo + ARCS)
            first = start[part] == begin[part]
            low = np.searchsorted(end, start[part], "left")
            count = np.where(first, 0, np.searchsorted(end, start[part], "right") - low)
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            meets = (piece[np.repeat(low, count) + within] + 2) * scale + np.repeat(piece[part], count) + 2
            new = np.setdiff1d(meets, seen)
            free.update(new[self.machine.allowed(new // scale - 2, new % scale - 2)].tolist())
            seen = np.union1d(seen, new)
            for s, e, p, f in zip(start[part].tolist(), end[part].tolist(), piece[part].tolist(), first.tolist()):
                if f or (state[s - 1] + 2) * scale + p + 2 in free:
                    state[e - 1], back[e - 1] = p, s
        return np.array(state, np.int64), np.array(back, np.int64)

    def segment(self, texts: list[str]) -> list[list[int]]:
        """Shortest paths for texts with at most one space mark, at their front."""
        if not texts:
            return []
        m, model = self.machine, self.model
        size = np.array([len(t) for t in texts])
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        letter = m.letter[chars]
        word = np.repeat(np.arange(len(texts)), size)
        ends = np.cumsum(size)
        begin = ends - size
        # Compose: all trie paths from every position, one character at a time.
        at, node, came = np.arange(len(chars)), np.zeros(len(chars), np.int64), np.arange(len(chars))
        arcs = []
        while len(at):
            key = node * m.letters + letter[at]
            hit = np.minimum(np.searchsorted(m.arc_keys, key), len(m.arc_keys) - 1)
            on = (letter[at] >= 0) & (m.arc_keys[hit] == key)
            at, came, node = at[on] + 1, came[on], m.arc_to[hit[on]]
            done = m.final[node] >= 0
            arcs.append((came[done], at[done], m.final[node[done]]))
            more = m.inner[node] & (at < ends[word[came]])
            at, came, node = at[more], came[more], node[more]
        # Byte paths for characters that are no piece. They are states that nothing merges with.
        odd = np.flatnonzero(model.char[chars] < 0)
        arcs.append((odd, odd + 1, np.full(len(odd), -1)))
        start, end, piece = (np.concatenate(x) for x in zip(*arcs))
        # Relax the arcs in the order of their ends; state[p] is the piece on the path to p.
        relax = self.along if size.max() > LONG_TEXT else self.abreast
        state, back = relax(len(chars), begin[word[start]], start, end, piece)
        # Walk back from the ends of all texts together.
        where = ends.copy()
        steps_word, steps_piece, steps_at = [], [], []
        live = np.arange(len(texts))
        while len(live := live[where[live] > begin[live]]):
            here = where[live] - 1
            if (state[here] == -2).any():
                raise ValueError("no path through the transducer")
            steps_word.append(live), steps_piece.append(state[here]), steps_at.append(back[here])
            where[live] = back[here]
        owner, got, pos = (np.concatenate(x) for x in (steps_word, steps_piece, steps_at))
        by = np.argsort(pos)
        owner, got, pos = owner[by], got[by], pos[by]
        cut = np.searchsorted(owner, np.arange(len(texts) + 1))
        plain = got >= 0
        whole, odd_in = got.tolist(), np.logical_or.reduceat(np.append(~plain, False), np.minimum(cut[:-1], len(got)))
        out = [whole[a:b] for a, b in zip(cut, cut[1:])]
        for i in np.flatnonzero(odd_in & (cut[1:] > cut[:-1])):
            text, base = texts[i], begin[i]
            out[i] = [t for g, p in zip(out[i], pos[cut[i] : cut[i + 1]]) for t in ([g] if g >= 0 else self.of_bytes(text[p - base]))]
        return out

    def segments(self, texts: list[str]) -> list[list[int]]:
        """Shortest paths; long texts apart from the others, which would take as many steps as they."""
        out: list[list[int]] = [[]] * len(texts)
        for long in (False, True):
            which = [i for i, t in enumerate(texts) if (len(t) > LONG_TEXT) == long]
            for i, ids in zip(which, self.segment([texts[i] for i in which])):
                out[i] = ids
        return out

    def parts(self, keys: list[str]) -> None:
        """Encode new parts and keep them."""
        texts, front = [], []
        for k in keys:
            t = key_text(k)
            body = t.lstrip(SPACE)
            marks = len(t) - len(body)
            front.append(marks if not body else max(0, marks - 1))
            texts.append(SPACE + body if marks and body else body)
        found = iter(self.segments([t for t in texts if t]))
        alone = self.model.normal.get(SPACE)
        for k, t, n in zip(keys, texts, front):
            ids = next(found) if t else []
            if n and t and ids[0] == alone:  # the last mark stays with the run
                ids, n = ids[1:], n + 1
            if n:
                ids = self.space_run(n) + ids
            self.kept[k] = np.array(ids, np.int32).tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, and the n + 1 offsets of the texts in them."""
        cut = [part_keys(t, self.model.lines_apart) for t in texts]
        if len(self.kept) > KEPT_PARTS:
            self.kept.clear()
        new = sorted(set().union(*cut).difference(self.kept), key=len)
        begin, chars = 0, 0
        for i, k in enumerate(new):
            chars += len(k) + 1
            if chars >= COMPOSED_CHARS or i == len(new) - 1:
                self.parts(new[begin : i + 1])
                begin, chars = i + 1, 0
        joined = [b"".join(map(self.kept.__getitem__, keys)) for keys in cut]
        offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in joined], dtype=np.int64)))
        return np.frombuffer(b"".join(joined), np.int32), offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts that the ids stand for: the reversed machine, which has one path. The
        space mark before a text is dropped; bytes that are no UTF-8 become U+FFFD."""
        m = self.machine
        size = m.said_size[ids]
        ends = np.cumsum(size)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
        data = m.said[np.repeat(m.said_at[ids], size) + within].tobytes()
        at = np.concatenate(([0], ends))[offsets].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
        return [t[1:] if t[:1] == " " else t for t in texts]


def encode_decode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int), n_tokens, decoded and exact (decoded equals the text) of every row.

    A null text is an empty one, with no ids. Texts that hold the space mark U+2581 itself
    decode to a space there, so they aren't exact. Repeated rows and rows with a null id each
    give a row; other columns are not read. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Transducer(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            ids, offsets = encoder.encode(texts)
            decoded = encoder.decode(ids, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    lists(ids, offsets, pa.int32()),
                    pa.array(np.diff(offsets).astype(np.int32)),
                    pa.array(decoded, pa.string()),
                    pa.array([a == b for a, b in zip(texts, decoded, strict=True)]),
                ],
                ["doc_id", "ids", "n_tokens", "decoded", "exact"],
            )

    return id_text(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>, n_tokens int, decoded string, exact boolean")


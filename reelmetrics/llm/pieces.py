"""A sentencepiece BPE model as plain arrays, shared by the token counter and the transducer."""

from __future__ import annotations

import re

import numpy as np

SPACE = "▁"


class PieceModel:
    """What a BPE model file says: pieces, merge ranks and bytes.

    Only models whose normaliser keeps all characters are read: it writes a space mark before
    a text that is not empty and in place of each space. Others raise ValueError.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("only models whose normaliser keeps all characters are supported")
        if trainer.model_type != trainer.BPE:
            raise ValueError("only BPE models are supported")
        kinds = pb.ModelProto.SentencePiece
        self.fallback: bool = trainer.byte_fallback
        self.size = len(model.pieces)
        self.pieces = [p.piece for p in model.pieces]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.normal = normal
        score = np.array([p.score for p in model.pieces])
        # Equal scores share a rank; the leftmost of equals is merged first.
        order = np.unique(-score)
        self.rank = np.searchsorted(order, -score)
        if any(SPACE in p.strip(SPACE) or p.startswith(SPACE * 2) and p.strip(SPACE) or p.endswith(SPACE) and p.strip(SPACE) for p in normal):
            raise ValueError("pieces that reach over a space are not supported")
        #: Whether no piece holds a line break, so that a text can be cut there.
        self.lines_apart = not any("\n" in p for p in normal if len(p) > 1)
        # Every way to put a piece together from two pieces.
        left, right, whole = [], [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                a, b = normal.get(piece[:cut]), normal.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), whole.append(i)
        keys = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        by = np.argsort(keys)
        self.pair_keys, self.pair_piece = keys[by], np.array(whole, np.int64)[by]
        #: Pieces that can be part of one with a better rank: only the leftmost is merged at a time.
        self.volatile = np.zeros(self.size, bool)
        for part in (left, right):
            part, made = np.array(part, np.int64), np.array(whole, np.int64)
            self.volatile[part[self.rank[made] <= self.rank[part]]] = True
        #: Ranks whose merges may be followed by one as good or better, or that several pieces share.
        shared = np.bincount(self.rank[list(normal.values())], minlength=len(order)) > 1
        self.unsteady = shared
        self.unsteady[self.rank[self.volatile]] = True
        self.longest = max(map(len, normal), default=1)
        self.char = np.full(0x110000, -1, np.int32)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i

    def find_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1; a part of -1 makes none."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_piece[at], -1)


# Parts of a text, with and without cuts at line breaks.
LINES_APART = re.compile(r"\n[^ \n]*| *[^ \n]+| +")
SPACES_APART = re.compile(r" *[^ ]+| +")


def part_keys(text: str, lines_apart: bool) -> list[str]:
    """The parts of a text between which no merge can happen, in order.

    A part is a key: a word stands for itself behind one space mark, a part that begins with
    a line break has no mark, and one that begins with a space is taken as written.
    """
    if not text:
        return []
    whole = " " + text.replace(SPACE, " ")
    if lines_apart:
        apart = whole.replace("\n", " \n")
        if "  " not in apart and apart[-1] != " ":
            return apart[1:].split(" ")
    found = (LINES_APART if lines_apart else SPACES_APART).findall(whole)
    return [p[1:] if p[0] == " " and len(p) > 1 and p[1] not in " \n" else p for p in found]


def key_text(key: str) -> str:
    """The escaped characters that a key stands for."""
    return key.replace(" ", SPACE) if key[0] in " \n" else SPACE + key

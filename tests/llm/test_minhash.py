"""MinHash near-duplicates against all pairs of a small table."""

import random

import numpy as np
import pytest
from cases import CLASHING, no_documents, odd_documents

from reelmetrics.llm import minhash as module
from reelmetrics.llm.minhash import HALVES, ROWS, half_keys, minhash_duplicates, shingle_sets

LETTERS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_set(text):
    words = (text or "").translate(LETTERS).encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows):
    sets = [(i, plain_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 85 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def crowd(n_bases, copies, seed, share=0.0):
    """Texts of several bases with a few replaced words each, in shuffled order."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(int(400 * share))]
    texts = []
    for b in range(n_bases):
        base = common + [f"w{rng.randrange(10**6)}" for _ in range(400 - len(common))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.choice((0, 1, 2, 4, 6, 8, 12))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, share", [(1, 0.0), (2, 0.9)])
def test_groups_of_near_copies(spark, seed, share):
    """With a large common part texts of different bases meet in tables without linking."""
    rows = crowd(25, 12, seed, share)
    assert found(minhash_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == plain(rows)


@pytest.mark.parametrize("nearest", [1, HALVES])
def test_one_large_group_that_no_member_holds_together(spark, monkeypatch, nearest):
    """A drifting copy of a copy: each links to its neighbours only, whatever central members see."""
    monkeypatch.setattr(module, "NEAREST", nearest)
    rng = random.Random(3)
    words, rows = [f"w{i}" for i in range(300)], []
    for i in range(120):
        for _ in range(2):
            words[rng.randrange(300)] = f"y{rng.randrange(10**6)}"
        rows.append((i * 37 % 1000, " ".join(words)))
    want = plain(rows)
    assert len({c for _, _, c in want}) < 10
    assert found(minhash_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_threshold_is_exact(spark):
    """Sets of 85 of 100, and of 84 of 100, shingles in common."""
    def text(tag, own):
        return " ".join([f"s{i}" for i in range(89)] + [f"{tag}{i}" for i in range(own)])

    rows = [(1, text("a", 0)), (2, text("b", 15)), (3, " ".join(f"t{i}" for i in range(88))), (4, " ".join([f"t{i}" for i in range(88)] + [f"u{i}" for i in range(16)]))]
    got = found(minhash_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain(rows) == [(1, 85, 1), (2, 100, 1), (3, 84, 3), (4, 100, 4)]


def test_odd_documents(spark):
    odd = odd_documents(spark)
    extra = [c for c in ("first", "copies", "halves", "set_id", "bucket", "degree", "class", "half", "b", "a", "shingles") if c not in CLASHING]
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert found(minhash_duplicates(odd.selectExpr("*", *(f"'c' as {c}" for c in extra)))) == plain(rows)


def test_short_texts_and_white_space(spark):
    rows = [(1, "a b"), (2, " A\t\nB "), (3, "a b c"), (4, "a b"), (5, "a b c d"), (6, "a b c d e"), (7, "A B C D E"), (8, "É b"), (9, "é b"), (10, ""), (11, None)]
    assert found(minhash_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_empty_table(spark):
    none = minhash_duplicates(no_documents(spark))
    assert none.columns == ["doc_id", "n_shingles", "component_id"] and none.count() == 0


def test_half_keys_match_as_often_as_sets_overlap():
    """Half keys of two sets agree with about similarity ** ROWS; table keys need one of either side."""
    rng = np.random.default_rng(5)
    agreed = []
    for _ in range(200):
        base = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        a, b = np.unique(base[:850]), np.unique(base)
        keys = half_keys(np.concatenate((a, b)), np.array([0, len(a)]))
        same = keys[0] == keys[1]
        agreed.append(same.mean())
        assert same[:HALVES].any() and same[HALVES:].any()
    assert abs(np.mean(agreed) - 0.85**ROWS) < 0.02


def test_shingles_are_distinct_and_whole():
    hashes, cuts = shingle_sets([b"a b c d e a b c d e", b"", b"x y"], 5)
    assert cuts.tolist() == [0, 5, 5, 6] and len(set(hashes.tolist())) == 6

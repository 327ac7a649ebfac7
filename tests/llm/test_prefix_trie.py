"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reelmetrics.llm import prefix_trie as module
from reelmetrics.llm.prefix_trie import end_digests, prefix_trie, regrown, turn_lists

SCHEMA = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_lists(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, digest, role, text))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}


def plain_regrown(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        leaves[key] = sum(leaves[k] for k in kids[key]) or 1
        saved[key] = sum(saved[k] for k in kids[key]) + (len(members[key]) - 1) * words
    out = []
    for key, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == len(key)))
        up = min(members[key[:-1]]) if key else None
        out.append((min(ids), len(key), up, len(ids), len(kids[key]), leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*OUT).collect()), key=repr)


def talks(n, seed=1, turns=6, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, ("user", "assistant")[t % 2], " ".join(rng.choice("ab") for _ in range(rng.randint(0, words)))))
    return rows


@pytest.mark.parametrize("group", [1, 3, 256])
def test_regrown_tries(spark, group):
    rows = talks(150)
    got = found(prefix_trie(regrown(turn_lists(spark.createDataFrame(rows, SCHEMA).repartition(4))), group))
    assert got == plain_trie(plain_regrown(plain_lists(rows)))


@pytest.mark.parametrize("group", [4, 256])
def test_hot_first_turns_and_copies(spark, group):
    """All share the first two turns, a third are copies, others part at the third turn."""
    rows = []
    for c in range(-30, 270):
        texts = ["sys tem", "hi", *([] if c % 3 == 0 else [f"t {c % 50}", f"u {c}"])]
        rows += [(c, i, "user", t) for i, t in enumerate(texts)]
    got = found(prefix_trie(turn_lists(spark.createDataFrame(rows, SCHEMA)), group))
    assert got == plain_trie(plain_lists(rows))


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_TURNS", 40)
    monkeypatch.setattr(module, "PACK_IDS", 3)
    rows = talks(120, 2)
    lists = turn_lists(spark.createDataFrame(rows, SCHEMA))
    assert found(prefix_trie(lists)) == plain_trie(plain_lists(rows))
    # Packs of a few ids give the digest of the whole list.
    ids = spark.range(-50, 1000).select(F.col("id").alias("conv_id"), F.unhex(F.when(F.col("id") % 9 == 0, "aa").otherwise("")).alias("seq"))
    want = {bytes.fromhex(k): hashlib.sha256(",".join(str(i) for i in range(-50, 1000) if (i % 9 == 0) == (k == "aa")).encode()).hexdigest() for k in ("", "aa")}
    assert {bytes(r["seq"]): r["ends"] for r in end_digests(ids).collect()} == want


def test_long_conversations(spark):
    """Thousands of turns are peeled inside a task, without a round for each."""
    rows = [(c, t, "user", f"w {t if t < 2900 else c}") for c in range(3) for t in range(3000)]
    got = found(prefix_trie(turn_lists(spark.createDataFrame(rows, SCHEMA))))
    assert got == plain_trie(plain_lists(rows))


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a  b\n c"), (1, 0, "user", "a  b\n c"), (1, 0, "assistant", "x"), (2, None, "", ""), (2, 0, "user", "a b c"),
            (None, 0, "user", "x"), (3, None, None, None), (3, 0, "assistant", "x"), (4, 5, "userx", ""), (5, 5, "user", "x"), (21, 0, "user", "ünï 日本"), (6, 0, "u", "x " * 50_000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *(f"'c' as {c}" for c in ("path", "words", "seq", "node", "t", "turns", "head", "cut", "n", "low", "len")))
    assert found(prefix_trie(turn_lists(docs))) == plain_trie(plain_lists(rows))
    assert found(prefix_trie(regrown(turn_lists(docs)))) == plain_trie(plain_regrown(plain_lists(rows)))


def test_turnless_conversations_and_empty_tables(spark):
    # A conversation shorter than its cut whose stem is absent ends at the root.
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "x"), (c, 1, "user", "y")]
    got = found(prefix_trie(regrown(turn_lists(spark.createDataFrame(rows, SCHEMA)))))
    assert got == plain_trie({c: []}) and got[0][1:6] == (0, None, 1, 0, 1)
    none = prefix_trie(regrown(turn_lists(spark.createDataFrame([], SCHEMA))))
    assert none.columns == OUT and none.count() == 0

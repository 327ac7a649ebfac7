"""The prefix trie of conversations, by truncation peeling.

Every distinct sequence of first turns is a node. From the greatest depth downwards, conversations
that end at a depth are merged with the nodes that survived from below, the last turn is stripped,
and what is left is grouped again; each grouping finds the nodes of one depth and finishes their
aggregates, so no node is listed before or counted again.

Turns are reduced to digests where the texts are read. Equal conversations become one row first,
so a group of copies is one row. Different conversations are then gathered by the first turns they
share: a prefix that at most ``GROUP`` of them share is peeled inside a task, down to that prefix,
and only prefixes that more of them share are peeled by grouping in Spark, a round a depth. A hot
first turn is such a prefix: its conversations are dealt out by their second turns, and so on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

#: Conversations that one task holds together for a prefix they share.
GROUP = 256
CHUNK_TURNS = 1 << 18
PACK_IDS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"
BYTES = 16

LISTS = "conv_id bigint, path array<binary>, words array<int>, seq binary"
MADE = "depth int, node binary, parent binary, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, top boolean, path array<binary>, words array<int>"


def turn_lists(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns) with the turns of each conversation in order, as digest and number of words.

    A null turn comes first, turns with equal numbers go by digest; repeated rows are turns of
    their own. A null role or text is an empty one. Rows without a conversation belong to none.
    """
    said, who = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (text, role))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256), 1, 2 * BYTES))
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.regexp_count(said, F.lit(WORD)).alias("words")).alias("t"),
    )
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def regrown(lists: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % every.

    h is crc32 of c in decimal, modulo ``most``; all turns if there are fewer, none if that
    conversation is absent. A group has ``every`` conversations, so no key of the join is hot.
    """
    heads = lists.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("stem"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    aimed = lists.withColumn("stem", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return aimed.join(heads, "stem", "left").select("conv_id", F.concat(head, own).alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of all prefixes of each conversation, each from the one before."""
    for batch in batches:
        turns = batch.column("turns")
        ends, flat = turns.offsets.to_numpy(), turns.values
        digests = flat.field("digest").to_pylist()
        path, seq = [], []
        for a, b in zip(ends[:-1], ends[1:]):
            last = b""
            for d in digests[a:b]:
                last = hashlib.sha256(last + d).digest()[:BYTES]
                path.append(last)
            seq.append(last)
        offsets = pa.array((ends - ends[0]).astype(np.int32))
        words = flat.field("words").slice(ends[0], ends[-1] - ends[0])
        lists = [pa.ListArray.from_arrays(offsets, pa.array(path, pa.binary())), pa.ListArray.from_arrays(offsets, words.cast(pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *lists, pa.array(seq, pa.binary())], ["conv_id", "path", "words", "seq"])


def _runs(keys: list) -> Iterator[tuple[int, int]]:
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield start, i
            start = i


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids that follow each other under one sequence, as rows of joined ids of bounded length."""
    for batch in batches:
        seq, ids = batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()
        cuts = [(a, min(a + PACK_IDS, b)) for lo, b in _runs(seq) for a in range(lo, b, PACK_IDS)]
        rows = [(seq[a], ids[a], ",".join(map(str, ids[a:b]))) for a, b in cuts]
        yield pa.RecordBatch.from_pylist([{"seq": s, "first": f, "ids": t} for s, f, t in rows], pa.schema([("seq", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each sequence, fed pack by pack: no list is held."""
    last, state = None, None
    schema = pa.schema([("seq", pa.binary()), ("ends", pa.string())])
    for batch in batches:
        done = []
        for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
            if seq == last:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                done.append({"seq": last, "ends": state.hexdigest()})
            last, state = seq, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pylist(done, schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"seq": last, "ends": state.hexdigest()}], schema)


def end_digests(ended: DataFrame) -> DataFrame:
    """(seq, ends): the digest of the ascending ids of the conversations that are that sequence.

    Ids are put in order over all tasks and packed there, so even a hot sequence sends a few packs
    to the task that hashes it, which reads them one after the other.
    """
    by = ["seq", "conv_id"]
    packs = ended.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_packed, "seq binary, first bigint, ids string")
    return packs.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(_hashed, "seq binary, ends string")


def _peel(rows: pa.Table) -> pa.Table:
    """All nodes from the greatest depth down to each row's ``cut``."""
    path, words = rows.column("path").combine_chunks(), rows.column("words").combine_chunks()
    start = path.offsets.to_numpy()[:-1].astype(np.int64) - path.offsets[0].as_py()
    flat = path.flatten()
    code = flat.dictionary_encode().indices.to_numpy()
    count = words.flatten().to_numpy()
    length, cut, n, low = (rows.column(c).to_numpy() for c in ("len", "cut", "n", "low"))
    ends = rows.column("ends")
    made: list[dict] = []
    below = None  # nodes of the depth before, still without their parent
    for depth in range(int(length.max()), int(cut.min()) - 1, -1):
        ended = np.flatnonzero(length == depth)
        rep, parts = ended, {"n": n[ended], "low": low[ended], "children": np.zeros(len(ended), np.int64), "leaves": np.zeros(len(ended), np.int64), "saved": np.zeros(len(ended), np.int64)}
        if below is not None:
            # What survived, with its last turn stripped.
            rep = np.concatenate((below["rep"], ended))
            up = {"n": below["n"], "low": below["low"], "children": np.ones(len(below["rep"]), np.int64), "leaves": below["leaves"], "saved": below["saved"]}
            parts = {k: np.concatenate((up[k], parts[k])) for k in parts}
        _, first, node = np.unique(code[start[rep] + depth - 1], return_index=True, return_inverse=True)
        now = {k: np.zeros(len(first), np.int64) for k in ("n", "children", "leaves", "saved")}
        for k in now:
            np.add.at(now[k], node, parts[k])
        now["low"] = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(now["low"], node, parts["low"])
        now["rep"] = rep[first]
        now["leaves"] = np.where(now["children"] == 0, 1, now["leaves"])
        now["saved"] += (now["n"] - 1) * count[start[now["rep"]] + depth - 1]
        # Conversations that end here carry the digest of their ids.
        last = np.full(len(first), -1)
        last[node[len(rep) - len(ended) :]] = ended
        now["ends"] = ends.take(pa.array(last, mask=last < 0))
        now["depth"] = np.full(len(first), depth, np.int32)
        now["top"] = cut[now["rep"]] == depth
        now["parent_low"] = np.zeros(len(first), np.int64)
        if below is not None:
            below["parent_low"][:] = now["low"][node[: len(below["rep"])]]
        made.append(now)
        open_ = ~now["top"]
        below = {k: v[open_] for k, v in now.items() if k != "ends"}
        # The view above is a copy: its parents are written to ``made`` through the mask.
        now["open"], now["kept"] = open_, below
    for now in made:
        now["parent_low"][now["open"]] = now["kept"]["parent_low"]
    whole = {k: np.concatenate([m[k] for m in made]) for k in ("rep", "depth", "low", "parent_low", "n", "children", "leaves", "saved", "top")}
    at = start[whole["rep"]] + whole["depth"]
    top = whole["top"]
    spans = np.where(top, whole["depth"], 0)
    take = np.repeat(start[whole["rep"]] - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
    offsets = pa.array(np.concatenate(([0], np.cumsum(spans))).astype(np.int32))
    parent = flat.take(pa.array(np.where(whole["depth"] > 1, at - 2, 0), mask=whole["depth"] <= 1))
    return pa.table({
        "depth": pa.array(whole["depth"]), "node": flat.take(pa.array(at - 1)), "parent": parent, "conv_id": pa.array(whole["low"]),
        "parent_conv_id": pa.array(whole["parent_low"], mask=top), "n_convs": pa.array(whole["n"]), "n_children": pa.array(whole["children"]),
        "n_leaves": pa.array(whole["leaves"]), "saved_tokens": pa.array(whole["saved"]),
        "ends": pa.chunked_array([c for m in made for c in m["ends"].chunks], pa.string()), "top": pa.array(top),
        "path": pa.ListArray.from_arrays(offsets, flat.take(pa.array(take))), "words": pa.ListArray.from_arrays(offsets, words.flatten().take(pa.array(take))),
    })


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peels rows sorted by ``head``, whole groups at a time and few enough to hold."""
    held: list[pa.RecordBatch] = []
    turns = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        turns += int(np.sum(batch.column("len").to_numpy()))
        if turns < CHUNK_TURNS:
            continue
        rows = pa.Table.from_batches(held)
        head = rows.column("head").to_pylist()
        last = max((a for a, _ in _runs(head)), default=0)  # the last group may go on
        if last:
            yield from _peel(rows.slice(0, last)).to_batches()
            rows = rows.slice(last)
        held = rows.to_batches()
        turns = int(np.sum(rows.column("len").to_numpy()))
    if held:
        yield from _peel(pa.Table.from_batches(held)).to_batches()


def prefix_trie(lists: DataFrame, group: int = GROUP) -> DataFrame:
    """The nodes of the trie over conversations (conv_id, turns), as ``turn_lists`` gives them.

    conv_id is the smallest member, ends_sha256 the digest of the ids of the members that end at
    the node. Conversations without turns are members of the root alone. An empty table has no
    nodes. ``group`` bounds how many different conversations a task gathers for a shared prefix.
    """
    shared_folder(lists.sparkSession)
    convs = lists.mapInArrow(_chained, LISTS).checkpoint()
    distinct = convs.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("path").alias("path"), F.first("words").alias("words"))
    rows = distinct.join(end_digests(convs), "seq").withColumn("len", F.size("path")).drop("seq").checkpoint()

    # Prefixes that too many share are followed a turn further; all others are cut out for a task.
    above, local, k = [], [], 1
    while True:
        above.append(rows.where(F.col("len") == k - 1))
        live = rows.where(F.col("len") >= k).withColumn("head", F.get("path", F.lit(k - 1)))
        crowded = live.groupBy("head").agg(F.count("*").alias("rows")).where(F.col("rows") > group).select("head").checkpoint()
        if crowded.isEmpty():
            local.append(live.withColumn("cut", F.lit(k)))
            break
        local.append(live.join(crowded, "head", "left_anti").withColumn("cut", F.lit(k)))
        rows = live.join(crowded, "head", "left_semi").drop("head").checkpoint()
        k += 1
    cut = local[0]
    for df in local[1:]:
        cut = cut.unionByName(df)
    made = cut.repartition("head").sortWithinPartitions("head").mapInArrow(_peeled, MADE).checkpoint()

    out = [made.where("not top")]
    tops = made.where("top")
    below = tops.where(F.col("depth") == k)
    for depth in range(k - 1, -1, -1):
        stripped = below.select(
            F.slice("path", 1, depth).alias("path"), F.slice("words", 1, depth).alias("words"), F.col("n_convs").alias("n"), F.col("conv_id").alias("low"),
            F.lit(1).alias("child"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"),
        )
        ended = above[depth].select("path", "words", "n", "low", F.lit(0).alias("child"), F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"), "ends")
        node = F.coalesce(F.get("path", F.lit(depth - 1)), F.unhex(F.lit("")))
        found = stripped.unionByName(ended).withColumn("node", node).groupBy("node").agg(
            F.sum("n").alias("n_convs"), F.min("low").alias("conv_id"), F.sum("child").alias("n_children"), F.sum("n_leaves").alias("l"),
            F.sum("saved_tokens").alias("s"), F.max("ends").alias("ends"), F.first("path").alias("path"), F.first("words").alias("words"),
        )
        spoken = F.coalesce(F.get("words", F.lit(depth - 1)), F.lit(0))
        nodes = found.select(
            F.lit(depth).alias("depth"), "node", F.coalesce(F.get("path", F.lit(depth - 2)), F.unhex(F.lit(""))).alias("parent"), "conv_id",
            F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(F.col("l")).cast("bigint").alias("n_leaves"),
            (F.col("s") + (F.col("n_convs") - 1) * spoken).alias("saved_tokens"), "ends", F.lit(True).alias("top"), "path", "words",
        ).checkpoint()
        parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("p"), F.col("n_children").alias("_n"))
        children = below.withColumn("parent", F.coalesce("parent", F.unhex(F.lit(""))))
        adopted = lookup_join(children, parents, "parent", "_n", ["node"])
        out.append(adopted.withColumn("parent_conv_id", F.col("p")).select(*made.columns))
        below = nodes.unionByName(tops.where(F.col("depth") == depth)) if depth else nodes
    out.append(below)
    trie = out[0]
    for df in out[1:]:
        trie = trie.unionByName(df)
    return trie.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )

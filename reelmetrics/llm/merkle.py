"""Merkle manifest of a dataset: a hash tree per group, one over the groups, and a proof per row.

Leaves of a group ascend by key; every 16 consecutive nodes (the last run may be shorter, even
one) become the hash of their hex digests, until one is left: the group's subroot. Subroots, in
the order of their groups, become the root the same way.

Proofs come from octopus multiproofs. Rows are put in order once and cut into parts of whole
blocks of leaves. A part hashes its own leaves upwards as far as its blocks reach, names the
minimal union of node coordinates that all its proofs together still lack, gets these in one join,
derives the shared interiors, and only then writes out the proof of each leaf. So what is fetched
grows with the height of the tree and the number of parts, not with the number of proofs.

Whole texts are hashed where they are read and never shuffled. A part holds ``PART`` + ``BLOCK``
rows at most, whatever the groups: a hot group is many parts, many small groups share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

FANOUT = 16
BLOCK_LEVELS = 2
BLOCK = FANOUT**BLOCK_LEVELS
PART = 4096
TOP = -1  # the tree over the subroots
HEX = 64

NODE = "part bigint, tree bigint, level int, idx bigint, hash binary"
PROOF = "array<struct<before: string, after: string>>"


def leaf_digest(*columns: Column) -> Column:
    """Lowercase hex SHA-256 of each value as byte count, colon, value; null as a hyphen."""

    def said(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(said, columns)), 256)


def height(n: int) -> int:
    """Levels above the leaves of a tree over ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lacking(known: np.ndarray, count: int) -> Iterator[np.ndarray]:
    """Level by level from nodes ``known`` of ``count`` upwards: the coordinates that proofs for all
    of them need and that can't be derived from them."""
    while count > 1:
        parents = np.unique(known // FANOUT)
        members = (parents[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        yield np.setdiff1d(members[members < count], known)
        known, count = parents, -(-count // FANOUT)


def _ordered(leaves: DataFrame) -> DataFrame:
    """Leaves with their place: tree, number of leaves n in it, position pos, and part.

    Rows are sorted over all tasks by range partitioning. What comes to the driver is two numbers
    a partition. Rows that are equal in all columns are told apart by where they were read, so that
    copies of one row don't end up in one task.
    """
    spark = leaves.sparkSession
    by = [F.asc_nulls_first("grp"), F.asc_nulls_first("key"), F.asc("leaf"), F.asc("serial")]
    # Ids from ranged partitions are kept by the checkpoint; a lost partition is read, not dealt again.
    ranged = leaves.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ranged = ranged.select("*", F.shiftright("at", 33).alias("pid"), F.col("at").bitwiseAND((1 << 33) - 1).alias("i")).drop("at", "serial").checkpoint()

    runs = ranged.groupBy("pid", "grp").agg(F.min("i").alias("first"), F.count("*").alias("rows")).checkpoint()
    groups = runs.groupBy("grp").agg(F.min_by("first", "pid").alias("first"), F.min("pid").alias("pid"), F.sum("rows").alias("n")).checkpoint()
    rows, starts = ({r["pid"]: r["n"] for r in df.collect()} for df in (runs.groupBy("pid").agg(F.sum("rows").alias("n")), groups.groupBy("pid").agg(F.count("*").alias("n"))))
    pids = sorted(rows)
    before = zip(pids, accumulate((rows[p] for p in pids), initial=0), accumulate((starts.get(p, 0) for p in pids), initial=0))
    offsets = F.broadcast(spark.createDataFrame(list(before), "pid long, rows_before long, trees_before long"))

    nth = F.row_number().over(Window.partitionBy("pid").orderBy("first")) - 1
    trees = groups.join(offsets, "pid").select(
        F.col("grp").alias("g"), (F.col("trees_before") + nth).alias("tree"), (F.col("rows_before") + F.col("first")).alias("start"), "n"
    )
    known = runs.join(offsets, "pid").join(trees, F.col("grp").eqNullSafe(F.col("g")))
    known = known.select(F.col("pid").alias("p"), "g", "tree", "n", "start", (F.col("rows_before") - F.col("start")).alias("shift"))
    placed = ranged.join(known, (F.col("pid") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))).withColumn("pos", F.col("i") + F.col("shift"))
    part = F.expr(f"(start + pos div {BLOCK} * {BLOCK}) div {PART}")
    return placed.select(part.alias("part"), "tree", "n", "pos", "leaf", "key", "claim")


def _segments(part: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Tree, its number of leaves, positions and row numbers of each tree in the part, in order."""
    tree, n, pos = (part.column(c).to_numpy() for c in ("tree", "n", "pos"))
    by = np.lexsort((pos, tree))
    for rows in np.split(by, np.flatnonzero(np.diff(tree[by])) + 1):
        if len(rows):
            yield int(tree[rows[0]]), int(n[rows[0]]), pos[rows], rows


def _blocks(trees: int):
    """Per part: the nodes its whole blocks end in, and without a hash the nodes it lacks."""

    def find(part: pa.Table) -> pa.Table:
        leaf, out, seen = part.column("leaf").to_pylist(), [], []
        for tree, n, pos, rows in _segments(part):
            seen.append(tree)
            idx, nodes, count = pos, [leaf[r].hex() for r in rows], n
            for level in range(min(BLOCK_LEVELS, height(n))):
                up, starts = np.unique(idx // FANOUT, return_index=True)
                nodes = [_digest("".join(nodes[a:b])) for a, b in zip(starts, [*starts[1:], len(nodes)])]
                idx, count = up, -(-count // FANOUT)
            level = min(BLOCK_LEVELS, height(n))
            out += [(tree, level, i, bytes.fromhex(h)) for i, h in zip(idx.tolist(), nodes)]
            out += [(tree, level + k, i, None) for k, need in enumerate(lacking(idx, count)) for i in need.tolist()]
        out += [(TOP, k, i, None) for k, need in enumerate(lacking(np.array(seen), trees)) for i in need.tolist()]
        tree, level, idx, digest = zip(*out)
        return pa.table({
            "part": pa.repeat(part.column("part")[0], len(out)), "tree": pa.array(tree, pa.int64()),
            "level": pa.array(level, pa.int32()), "idx": pa.array(idx, pa.int64()), "hash": pa.array(digest, pa.binary()),
        })

    return find


def _upward(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, level, idx, hash, count of the level); runs are 16 nodes at most."""
    out = [nodes]
    run = F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda x: F.lower(F.hex(x["hash"])))
    for _ in range(levels):
        more = out[-1].where("count > 1").withColumn("idx_up", F.expr(f"idx div {FANOUT}")).groupBy("tree", "level", "count", "idx_up")
        up = more.agg(F.unhex(F.sha2(F.array_join(run, ""), 256)).alias("hash"))
        out.append(up.select("tree", (F.col("level") + 1).alias("level"), F.col("idx_up").alias("idx"), "hash", F.expr(f"(count + {FANOUT - 1}) div {FANOUT}").alias("count")).checkpoint())
    return out


def _expand(trees: int):
    """Per part: interiors from its own leaves and the fetched nodes, then a proof for each leaf."""

    def climb(known: dict[int, str], count: int, fetched: dict, tree: int) -> list[dict[int, tuple[str, str]]]:
        """For each level the siblings before and after each known node; ``known`` ends as the top."""
        siblings = []
        while count > 1:
            got = fetched.get((tree, len(siblings)), {})
            beside, up = {}, {}
            for run in {i // FANOUT for i in known}:
                members = range(run * FANOUT, min(run * FANOUT + FANOUT, count))
                text = "".join(known[i] if i in known else got[i] for i in members)
                for k, i in enumerate(members):
                    if i in known:
                        beside[i] = text[: k * HEX], text[(k + 1) * HEX :]
                up[run] = _digest(text)
            siblings.append(beside)
            known, count = up, -(-count // FANOUT)
        siblings.append(known)
        return siblings

    def expand(part: pa.Table, nodes: pa.Table) -> pa.Table:
        fetched: dict = {}
        for tree, level, idx, h in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "idx", "hash"))):
            fetched.setdefault((tree, level), {})[idx] = h.hex()
        leaf = part.column("leaf").to_pylist()
        done = []
        for tree, n, pos, rows in _segments(part):
            *siblings, top = climb({int(p): leaf[r].hex() for p, r in zip(pos, rows)}, n, fetched, tree)
            done.append((tree, pos.tolist(), rows, siblings, top[0]))
        *over, _ = climb({tree: root for tree, *_, root in done}, trees, fetched, TOP)
        before, after, ends, order, subroots = [], [], [0], [], []
        for tree, pos, rows, siblings, root in done:
            shared = []
            for beside in over:
                shared.append(beside[tree])
                tree //= FANOUT
            for p in pos:
                path = []
                for beside in siblings:
                    path.append(beside[p])
                    p //= FANOUT
                path += shared
                before += [b for b, _ in path]
                after += [a for _, a in path]
                ends.append(len(before))
            order.append(rows)
            subroots += [root] * len(rows)
        taken = part.take(np.concatenate(order))
        levels = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
        return pa.table({
            "key": taken.column("key"), "leaf": taken.column("leaf"), "claim": taken.column("claim"), "subroot": pa.array(subroots, pa.string()),
            "proof": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), levels),
        })

    return expand


def merkle_proofs(docs: DataFrame, columns: list[str], group: str = "source", key: str = "doc_id", claim: Column | None = None) -> DataFrame:
    """key, leaf, claim, subroot, root and proof of every row; the hash of a leaf is that of ``columns``.

    ``proof`` holds for each level the siblings before and after the node as concatenated hex
    digests, via the subroot up to the root; ``fold`` recomputes the root with it. ``claim`` is an
    optional digest (hex) that travels with the row, such as that of a copy to be verified.

    A null group is a group of its own and comes first, a null key comes first in its group; rows
    with equal keys follow each other by digest. Repeated rows are leaves of their own. An empty
    table gives no rows. Other columns are not read.
    """
    shared_folder(docs.sparkSession)
    cols = [F.col(f"`{c}`") for c in columns]
    leaves = docs.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), F.unhex(leaf_digest(*cols)).alias("leaf"),
        F.unhex(claim if claim is not None else F.lit(None).cast("string")).alias("claim"), F.monotonically_increasing_id().alias("serial"),
    )
    placed = _ordered(leaves.checkpoint())
    size = placed.agg(F.count_distinct("tree").alias("trees"), F.max("n").alias("n")).first()
    trees, most = size["trees"], size["n"] or 0

    found = placed.groupBy("part").applyInArrow(_blocks(trees), NODE).checkpoint()
    ends = found.where("hash is not null")
    counts = ends.groupBy("tree").agg(F.count("*").alias("count"))
    blocks = lookup_join(ends.select("tree", "level", "idx", "hash"), counts, "tree", "count", ["idx"])
    upper = _upward(blocks, max(0, height(most) - BLOCK_LEVELS))
    subroots = [d.where("count = 1").select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "hash") for d in upper]
    first = subroots[0]
    for d in subroots[1:]:
        first = first.unionByName(d)
    top = _upward(first.withColumn("count", F.lit(trees).cast("bigint")).checkpoint(), height(trees))
    root = top[-1].select(F.lower(F.hex("hash")).alias("root")).first()

    node = F.struct("tree", "level", "idx").alias("node")
    nodes = upper[0].select(node, "hash")
    for d in [*upper[1:], *top]:
        nodes = nodes.unionByName(d.select(node, "hash"))
    wanted = found.where("hash is null").select("part", node)
    fetched = lookup_join(wanted, nodes, "node", spread=["part"]).select("part", "node.*", "hash")
    kind = dict(docs.dtypes)[key]
    schema = f"key {kind}, leaf binary, claim binary, subroot string, proof {PROOF}"
    done = placed.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(_expand(trees), schema)
    return done.select(
        F.col("key").alias(key), F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("claim")).alias("claim"), "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"), "proof",
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    return F.aggregate(proof, leaf, lambda h, level: F.sha2(F.concat(level["before"], h, level["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["before"], level["after"])), ""), 256)

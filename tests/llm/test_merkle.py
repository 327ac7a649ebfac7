"""Merkle proofs against a plain recursive version, and against tampering."""

import hashlib
from collections import defaultdict

import pytest
from cases import no_documents, odd_documents
from pyspark.sql import functions as F

from reelmetrics.llm import merkle
from reelmetrics.llm.merkle import fold, lacking, leaf_digest, merkle_proofs

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """Root, and for each leaf its siblings level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            proofs[i].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
        nodes = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return nodes[0], proofs


def plain_proofs(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    root, over = plain_tree([trees[s][0] for s in names])
    out = []
    for s, more in zip(names, over):
        for x, proof in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1]):
            out.append((x[3][0], x[2], trees[s][0], root, tuple(proof + more)))
    return out


def found(df):
    rows = df.select("doc_id", "leaf", "subroot", "root", "proof").collect()
    return [(r[0], r[1], r[2], r[3], tuple((x["before"], x["after"]) for x in r[4])) for r in rows]


def same(spark, rows):
    got = found(merkle_proofs(spark.createDataFrame(rows, SCHEMA).repartition(5), COLUMNS))
    assert sorted(got, key=repr) == sorted(plain_proofs(rows), key=repr)


def test_groups_of_every_height(spark):
    sizes = {None: 3, "": 1, "a": 16, "b": 17, "ünï": 256, "c": 257, "z": 1, "hot": 9000}
    rows = [(i * 7 + k, s, "en" if i % 3 else None, i, f"Text {i}") for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    same(spark, rows)


def test_many_groups(spark):
    same(spark, [(i, f"s{i % 700}", None, None, "x" * (i % 5)) for i in range(1500)])


def test_one_row(spark):
    same(spark, [(5, "only", "en", 1, "A")])


def test_ties_repeated_rows_and_nulls(spark):
    same(spark, [(1, "a", "en", 1, "x")] * 40 + [(1, "a", "en", 1, "y"), (None, "a", None, None, None), (None, None, None, None, None), (2, "a", "en", 0, "")])


def test_clashing_columns_and_empty_tables(spark):
    odd = odd_documents(spark)
    extra = [c for c in ("pid", "tree", "n", "pos", "part", "grp", "leaf", "claim", "serial", "node", "hash", "i") if c not in odd.columns]
    odd = odd.selectExpr("*", "cast(doc_id % 2 as string) as source", *(f"'c' as {c}" for c in extra))
    done = merkle_proofs(odd, ["doc_id", "text"]).withColumn("folded", fold(F.col("leaf"), F.col("proof")))
    assert done.count() == odd.count() and done.where("not folded <=> root").count() == 0
    none = merkle_proofs(no_documents(spark), COLUMNS)
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "claim", "subroot", "root", "proof"]


def test_tampering_is_seen(spark):
    docs = spark.createDataFrame([(i, f"s{i % 4}", "en", i, f"Text {i}") for i in range(600)], SCHEMA)
    lowered = leaf_digest(*(F.col(c) for c in COLUMNS[:-1]), F.lower("text"))
    done = merkle_proofs(docs, COLUMNS, claim=F.when(F.col("doc_id") % 5 == 0, lowered))
    wrong = done.where(fold(F.coalesce("claim", "leaf"), F.col("proof")) != F.col("root"))
    assert {r["doc_id"] for r in wrong.collect()} == set(range(0, 600, 5))


@pytest.mark.parametrize("known, count", [([0], 1), ([3], 40), ([0, 1, 17], 300), (list(range(256, 512)), 5000)])
def test_lacking_is_minimal(known, count):
    """With the known nodes every node up to the root can be derived, and no named one from others."""
    import numpy as np

    nodes, level = set(known), 0
    for need in lacking(np.array(known), count):
        need = set(need.tolist())
        assert not need & nodes
        runs = {i // 16 for i in nodes}
        assert nodes | need == {i for r in runs for i in range(16 * r, min(16 * r + 16, count))}
        nodes, count, level = runs, -(-count // 16), level + 1
    assert nodes == {0} or count == 1
    assert merkle.height(1) == 0 and merkle.height(17) == 2

"""SimHash groups against all pairs compared one by one."""

import re

import numpy as np
import pytest
from cases import no_documents, odd_documents

xxhash = pytest.importorskip("xxhash")

from reelmetrics.llm import simhash  # noqa: E402
from reelmetrics.llm.components import components  # noqa: E402
from reelmetrics.llm.simhash import keep_one, links, lowest, near_duplicates, text_fingerprints, trie_pairs  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def fingerprint(text: str, words: int = 3) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    parts = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles)) if shingles else 0


def groups(prints: list[int], budget: int) -> list[int]:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    texts = ["", "a", "A b", "a B c", "É é x y", "w " * 500, "one two three four ONE two three four", "x\x0by\x0cz\x1cq"]
    assert text_fingerprints([t.encode() for t in texts], 3).tolist() == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_pairs_are_all_pairs(budget):
    rng = np.random.default_rng(budget)
    base = rng.integers(0, 1 << 62, 6, dtype=np.uint64)
    values = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for b in base]))
    cuts = np.array([0, 40, 41, 41, len(values)])
    i, j = trie_pairs(values, cuts, budget)
    want = {
        (a, b) for lo, hi in zip(cuts, cuts[1:]) for a in range(lo, hi) for b in range(a + 1, hi) if int(values[a] ^ values[b]).bit_count() <= budget
    }
    assert {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)


def test_lowest():
    assert lowest(6, np.array([4, 3, 5]), np.array([3, 1, 2])).tolist() == [0, 1, 2, 1, 1, 2]


@pytest.mark.parametrize("rows", [1024, 4])
def test_links_connect_what_is_near(spark, monkeypatch, rows):
    """Also where groups are parted twice, down to the last level."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", rows)
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 62, 3, dtype=np.uint64)
    values = set(rng.integers(0, 1 << 62, 200, dtype=np.uint64).tolist())
    for b in base.tolist():
        for _ in range(60):
            for k in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                b ^= 1 << k
            values.add(b)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2)
    roots = {r.node: r.root for r in components(found).collect()}
    want = groups(values, 2)
    own = [roots.get(v, v) for v in signed]
    assert len({(a, b) for a, b in zip(want, own)}) == len(set(want)) == len(set(own))


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    prints = [fingerprint(t) for _, t in rows]
    roots = groups(prints, 2)
    want = {rows[i][0]: (f"{p:016x}", rows[roots[i]][0]) for i, p in enumerate(prints)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()} == want
    assert {r.doc_id for r in keep_one(docs).collect()} == {i for i, (_, c) in want.items() if i == c}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()]
    assert len(found) == docs.count()
    by_id = {i: c for i, _, c in found}
    assert by_id[1] == 1 and by_id[8] == 1 and by_id[10] == 9
    assert {by_id[i] for i in (2, 3, 6, None)} >= {2} and {c for i, f, c in found if f == "0" * 16} == {2}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 1, 2, 4, 5, 7, 9]


def test_empty_table(spark):
    assert near_duplicates(no_documents(spark)).collect() == []
    assert keep_one(no_documents(spark)).collect() == []

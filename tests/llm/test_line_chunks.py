"""Chunks of lines against a reading line by line."""

import numpy as np
from cases import no_documents, odd_documents

from reelmetrics.llm.common import BASE, mix, span_hashes
from reelmetrics.llm.line_chunks import drop_repeated_chunks, drop_repeated_passages

SMALL = "/root/testdata/sf0.001"


def line_hash(line: bytes) -> int:
    data = np.frombuffer(line, np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


def chunks(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    lines = text.split("\n")
    n, h = len(lines), [line_hash(x.encode()) for x in text.split("\n")]
    fits = [i >= 1 and int(mix(np.array([(h[i] + h[i - 1] * BASE) % (1 << 64)], np.uint64))[0]) % 2 == 0 for i in range(n)]
    out, start = [], 0
    for i in range(n):
        if i == n - 1 or (fits[i] and not fits[i - 1] and i < n - 2):
            out.append((start, i + 1))
            start = i + 1
    return lines, [(a, b) for a, b in out if sum(bool(x.strip(" \t\n\r\x0b\x0c")) for x in lines[a:b]) > 1]


def brute(docs: list[tuple[int, str]]) -> dict:
    seen, out = set(), {}
    for i, text in sorted(docs):
        lines, parts = chunks(text)
        gone, n = set(), 0
        for a, b in parts:
            chunk = "\n".join(lines[a:b])
            if chunk in seen:
                gone |= set(range(a, b))
                n += 1
            seen.add(chunk)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), n, len(gone))
    return out


def found(frame) -> dict:
    return {r.doc_id: (r.text, r.n_chunks_removed, r.n_lines_removed) for r in frame.collect()}


def test_small(spark):
    passage = "\n".join(f"passage line {k}" for k in range(12))
    docs = [(0, ""), (1, "\n"), (2, "a\nb"), (3, "a\nb"), (4, "a\nb\n"), (5, "x"), (6, "\n\n\n"), (7, "\n\n\n"), (8, passage), (9, f"new head\n{passage}\nnew tail"), (10, passage + "\n" + passage)]
    own = found(drop_repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string")))
    assert own == brute(docs)
    # The edges move, the middle doesn't.
    assert own[9][2] >= 4 and own[9][0].startswith("new head")


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert found(drop_repeated_chunks(docs)) == want and sum(n for _, n, _ in want.values())


def test_odd_rows(spark):
    docs = odd_documents(spark)
    done = drop_repeated_chunks(docs)
    assert done.columns == [*docs.columns, "n_chunks_removed", "n_lines_removed"]
    rows = done.collect()
    assert len(rows) == docs.count()
    before = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    after = sorted((r.doc_id or 0, r.text or "") for r in rows)
    assert [x for x in before if x not in after] == [(10, "line one\nline two\nline three\n")]
    assert sum(r.text is None for r in rows) == 2
    again = drop_repeated_chunks(done)
    assert again.columns == done.columns


def test_empty_table(spark):
    assert drop_repeated_chunks(no_documents(spark)).collect() == []


def brute_passages(docs: list[tuple[int, str]]) -> dict:
    """Lines in a chunk, or in two neighbouring lines with text, that an earlier place has."""
    first, out = {}, {}
    for i, text in sorted(docs):
        lines, parts = chunks(text)
        said = [k for k, x in enumerate(lines) if x.strip(" \t\n\r\x0b\x0c")]
        gone = set()
        for a, b in sorted([*parts, *((a, b + 1) for a, b in zip(said, said[1:]))]):
            owner, at = first.setdefault("\n".join(lines[a:b]), (i, a))
            if (owner, at) != (i, a):
                gone |= set(range(max(a, at + b - a) if owner == i else a, b))
        runs = sum(k - 1 not in gone for k in gone)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), runs, len(gone))
    return out


def test_passages_of_every_length_go_whole(spark):
    docs = []
    for n in range(1, 13):
        for k in range(4):
            passage = [f"passage {n}.{k} line {j}" for j in range(n)]
            for copy in range(2):
                own = [[f"own {n} {k} {copy} {side} {j}" for j in range((k + 2 * side + copy) % 4)] for side in (0, 1)]
                docs.append((1000 * copy + 10 * n + k, "\n".join(own[0] + passage + own[1])))
    own = found(drop_repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")))
    assert own == brute_passages(docs)
    for i, text in docs:
        n = i % 1000 // 10
        assert own[i][2] == (n if i >= 1000 and n > 1 else 0)
        assert all(x in own[i][0].split("\n") for x in text.split("\n") if x.startswith("own"))


def test_passages_with_blank_and_repeated_lines(spark):
    docs = [
        (0, "a\n\n\nb\nc"), (1, "x\na\n\n\nb\ny"), (2, "a\n"), (3, "q\n\na\n\nr"), (4, "z\nz\nz\nz\nend"), (5, "s\nt\ns\nt\ns\nt"), (6, ""), (7, "\n\n"), (8, "\n\n"),
        (9, "b\nc\nd"), (10, "c\nd\n"),
    ]
    own = found(drop_repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")))
    assert own == brute_passages(docs)
    assert own[1][0] == "x\ny" and own[3][2] == 0 and own[4][0] == "z\nz\nend" and own[5][0] == "s\nt" and own[9][0] == "d"


def test_one_line_between_blank_lines_stays(spark):
    docs = [(1000 * copy + i, f"{copy} head {i}\n\nline {i}\n\n{copy} tail {i}") for i in range(400) for copy in range(2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for drop in (drop_repeated_passages, drop_repeated_chunks):
        assert all(n == 0 for *_, n in found(drop(frame)).values())


def test_a_chunk_of_very_many_texts_is_dealt_out(spark):
    # Beyond the most frequent chunks, which are looked up, rows meet their first place by key.
    docs = [(i, f"own {i}\nhot line\nhot too\nrare {i // 2}\nrare too {i // 2}\nend {i}") for i in range(3000)]
    own = found(drop_repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(8)))
    assert own == brute_passages(docs)
    assert own[1][0] == "own 1\nend 1" and own[2][0] == "own 2\nrare 1\nrare too 1\nend 2"


def test_passages_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    own = found(drop_repeated_passages(docs))
    assert own == brute_passages([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(n for *_, n in own.values()) >= sum(n for *_, n in found(drop_repeated_chunks(docs)).values())


def test_passages_of_odd_rows(spark):
    docs = odd_documents(spark)
    done = drop_repeated_passages(docs)
    assert done.columns == [*docs.columns, "n_chunks_removed", "n_lines_removed"] and done.count() == docs.count()
    assert sorted((r.doc_id, r.n_lines_removed) for r in done.where("n_lines_removed > 0").collect()) == [(10, 3)]
    assert drop_repeated_passages(no_documents(spark)).collect() == []

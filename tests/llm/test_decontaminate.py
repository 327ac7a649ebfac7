"""Overlaps with benchmark items against every shift compared word by word."""

import random
import re
from itertools import combinations

import pytest
from cases import no_documents, odd_documents

from reelmetrics.llm.decontaminate import drop_contaminated, mask_family, needed, overlaps

SMALL = "/root/testdata/sf0.001"


def words(text: str) -> list[str]:
    low = "".join(c.lower() if c.isascii() or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
    return re.findall("[a-z0-9\u0080-\U0010ffff]+", low)


def brute(docs, items, window=13, similarity=0.8, least=5):
    out = {}
    for i, text in docs:
        w = words(text)
        for k, item in items:
            t = words(item)
            if len(t) < least:
                continue
            size, equal = needed(len(t), window, similarity)
            rows = []
            for a in range(len(w) - size + 1):
                for b in range(len(t) - size + 1):
                    n = sum(x == y for x, y in zip(w[a : a + size], t[b : b + size]))
                    if n >= equal:
                        rows.append((-n, a, b))
            if rows:
                n, a, b = min(rows)
                out[i, k] = min(out.get((i, k), (9, 9)), (a, b, -n, size)) if (i, k) in out else (a, b, -n, size)
    return out


def got(frame):
    return {(r.doc_id, r.item_id): (r.first_word, r.item_word, r.n_equal, r.n_words) for r in frame.collect()}


@pytest.mark.parametrize("length", range(5, 14))
def test_masks_lose_nothing(length):
    size, equal = needed(length, 13, 0.8)
    masks = mask_family(size, size - equal)
    for replaced in combinations(range(size), size - equal):
        assert any(not {o + i for i in m} & set(replaced) for m in masks for o in range(size - m[-1]))


def test_replaced_words(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([4, 5, 6, 8, 9, 10, 12, 13, 20, 40])]
    docs = []
    for i in range(120):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        _, item = items[i % len(items)]
        part = item.split()
        part = part[rng.randint(0, 3) :]
        for _ in range(rng.randint(0, 4)):
            part[rng.randrange(len(part))] = "zz"
        at = rng.randint(0, len(body))
        docs.append((i, ", ".join(body[:at] + part + body[at:]).upper()))
    found = got(overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert found == brute(docs, items) and len(found) > 20


def test_whole_table(spark):
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    short = [(r.doc_id, r.text) for r in docs.collect() if r.n_chars < 4000]
    want = brute(short, [(r.item_id, r.text) for r in items.collect()])
    found = got(overlaps(docs, items))
    assert {k: v for k, v in found.items() if k[0] in dict(short)} == want and want


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame(
        [(1, "one two THREE four; five"), (None, "no id here none at all"), (2, ""), (3, None), (4, "a b c"), (1, "one two THREE four; five")], "item_id long, text string"
    ).selectExpr("*", "1 as item", "2 as item_uid")
    found = got(overlaps(docs, items))
    assert set(found) == {(1, 1), (8, 1), (None, None)}
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 2, 3, 4, 5, 6, 7, 9, 10]


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    assert overlaps(no_documents(spark), items).collect() == []
    docs = odd_documents(spark)
    assert overlaps(docs, items.where("false")).collect() == []
    assert drop_contaminated(docs, items.where("false")).count() == docs.count()


def test_words_of_any_script(spark):
    items = [
        (1, "日本の首都は東京であり人口が多い"), (2, "กรุงเทพมหานครเป็นเมืองหลวง"), (3, "It’s “one two three” — four\u00a0five six"),
        (4, "ПРИВЕТ как твои дела сегодня утром"), (5, "re\u00adturn the five small words"), (6, "हिन्दी में यह एक वाक्य है"),
    ]
    docs = [
        (1, "前文。日本の首都は東京であり、人口が多い。後文"), (2, "ก่อน กรุงเทพมหานครเป็นเมืองหลวง หลัง"), (3, "so it's \"one two three\" - four five six."),
        (4, "x привет, Как твои дела сегодня утром y"), (5, "return the five small words"), (6, "और हिन्दी में यह एक वाक्य है।"), (7, "日本の人口は東京で、首都が多い"), (8, ""),
    ]
    rows = [spark.createDataFrame(r, f"{n} long, text string") for r, n in ((docs, "doc_id"), (items, "item_id"))]
    found = got(overlaps(*rows))
    assert set(found) == {(k, k) for k in range(1, 7)}
    assert found[1, 1] == (2, 0, 13, 13) and found[3, 3] == (1, 0, 8, 8)


def test_short_items_match_whole(spark):
    items = [(1, "Blue whale"), (2, "鯨"), (3, "four words in all"), (4, "..."), (5, None), (6, "one two three four five six")]
    docs = [
        (1, "a blue, whale. Blue whale"), (2, "blue whales"), (3, "大きな鯨だ"), (4, "four words in all"), (5, "four words at all"), (6, "zero one two three four five seven"),
        (None, "Blue-whale"), (7, None), (8, "blue whale " * 20_000),
    ]
    rows = [spark.createDataFrame(r, f"{n} long, text string") for r, n in ((docs, "doc_id"), (items, "item_id"))]
    found = got(overlaps(*rows, short_items=True))
    assert found == {(1, 1): (1, 0, 2, 2), (3, 2): (3, 0, 1, 1), (4, 3): (0, 0, 4, 4), (6, 6): (1, 0, 5, 6), (None, 1): (0, 0, 2, 2), (8, 1): (0, 0, 2, 2)}
    assert set(got(overlaps(*rows))) == {(6, 6)}
    assert sorted(r.doc_id or 0 for r in drop_contaminated(*rows, short_items=True).collect()) == [0, 2, 5, 7]

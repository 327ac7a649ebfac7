"""Personal data: base spans against Python's regular expressions, and what the trees add."""

import hashlib
import re

import pytest
from cases import no_documents, odd_documents

from reelmetrics.llm import pii

SMALL = "/root/testdata/sf0.001"
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits: str) -> bool:
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def base(text: str) -> list[tuple[int, int, int]]:
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            fits = (True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)
            if fits[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def named(spans) -> str:
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check(rows, texts):
    assert len(rows) == len(texts)
    by_id = dict(texts)
    for r in rows:
        own = base(by_id[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(named(own).encode()).hexdigest(), by_id[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in own) for n in range(4)]
        spans = [s for s in r.spans.split(",") if s]
        assert len(spans) == len(own) + r.n_added and not own or set(named(own).split(",")) <= set(spans)


@pytest.fixture(scope="module")
def trees(spark):
    return pii.model(spark)


def test_base_spans(spark):
    texts = [
        "a@b.c@d.e", "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 1234.5.6.7 0001.02.003.4 1.2.3.256", "é😀 x@y.zz 4539578763621486-1 +1 (988) 555-2485 4041894974608795",
        "+49 30 901820 12", "..@a.b.c...d@x", "1-2-3", "@@@", "a@-.-", "+1" + "2" * 40, "4539578763621486 4539578763621486", "4539-5787-6362-1486.", "",
        "٣٤٥@٣.٣ +٣٣٣٣٣٣٣٣٣", "a%b+c-d.e_f@g-h.i-j", "x a@b.cd y", "+1\n2345678901", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5",
    ]
    rows = list(enumerate(texts))
    check(pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 60_000, "1" * 60_000, "1 " * 30_000, "+1" + "-" * 60_000 + "x", "1." * 30_000, "a@" * 30_000, "a.b" * 20_000 + "@", "x@y.zz " * 800]
    rows = list(enumerate(texts))
    check(pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect(), rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(pii.personal_data(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_added_spans(spark, trees):
    texts = {
        1: ("call +1 (988) 555-2485 4041894974608795 now", ["phone:5:22", "card:23:39"]),
        2: ("mail kim (at) example (dot) org today", ["email:5:31"]),
        3: ("host 198[.]51[.]100[.]7 and order 4539578763621487", ["ip:5:23"]),
        4: ("version 2.0 of 2024", []),
        5: ("phone: 415-555-0132. ref 646.555.0119 closed", ["phone:7:19"]),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    found = {r.doc_id: [f"{pii.KINDS[s.kind]}:{s.begin}:{s.end}" for s in sorted([*r.base, *r.added], key=lambda s: s.begin)] for r in pii.find_spans(docs, trees=trees).collect()}
    assert found == {i: spans for i, (_, spans) in texts.items()}
    out = {r.doc_id: r.text for r in pii.redact(docs, trees=trees).collect()}
    assert out[1] == "call [phone] [card] now" and out[4] == texts[4][0] and out[2] == "mail [email] today"


def test_no_candidate_hangs_on_other_text(spark, trees):
    from pyspark.sql import functions as F

    texts, _ = pii.labelled()
    texts += ["jo @ example.com", "write to jo at example.com soon", "pat@example{dot}com", "a@b", "at .", "1(.)2(.)3(.)4", "::", "+", "@", "", "x at y dot z"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    both = rows.select(pii.candidates(F.col("text")).alias("gated"), pii.candidates(F.col("text"), gated=False).alias("every"))
    assert both.where("gated <> every").count() == 0
    alone = {"jo @ example.com": 1, "write to jo at example.com soon": 1, "pat@example{dot}com": 1, "look at example.com now": 0, "We arrived at 10.30 or so": 0}
    docs = spark.createDataFrame(list(enumerate(alone)), "doc_id long, text string")
    assert [len(r.added) for r in pii.find_spans(docs, trees=trees).orderBy("doc_id").collect()] == list(alone.values())


def test_many_numbers_in_one_text(spark, trees):
    texts = [", ".join(str(10**14 + i * 7919 % 1_000_003) for i in range(40_000)), "call (212) 555-0147, " * 2_000, "4539578763621486; " * 2_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.base, r.added) for r in pii.find_spans(docs, trees=trees).collect()}
    for i, text in enumerate(texts):
        assert [(s.begin, s.kind, s.end) for s in found[i][0]] == base(text)
        assert all(text[s.begin : s.end] == s.match for s in found[i][1])
    assert len(found[1][1]) == 2_000 and len(found[2][0]) == 2_000


def test_compiled_trees_say_what_the_trees_say(spark, trees):
    from pyspark.sql import functions as F

    texts, _ = pii.labelled()
    rows = spark.createDataFrame(list(enumerate(texts[::9])), "i int, text string").select(F.explode(pii.candidates(F.col("text"))).alias("s"))
    got = rows.select(pii.features(F.col("s")).alias("f")).withColumn("p", trees.probability(F.col("f"))).collect()
    for r in got:
        score = trees.start + sum(trees._value(t, list(r.f)) for t in trees.trees)
        assert abs(r.p - 1 / (1 + 2.718281828459045**-score)) < 1e-9


def test_no_python_in_the_plan(spark):
    plan = pii.personal_data(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_odd_rows(spark, trees):
    docs = odd_documents(spark)
    rows = pii.personal_data(docs).collect()
    assert sorted(r.doc_id or 0 for r in rows) == sorted(r.doc_id or 0 for r in docs.collect())
    assert all(r.spans == "" for r in rows)
    assert pii.personal_data(no_documents(spark)).collect() == []
    assert pii.redact(docs, trees=trees).count() == docs.count()

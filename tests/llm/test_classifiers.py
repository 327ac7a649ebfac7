"""Toxicity and quality on held-out labels, their solvers, and odd rows."""

import zlib

import numpy as np
import pytest
from cases import no_documents, odd_documents
from pyspark.sql import functions as F

from reelmetrics.llm import quality as q
from reelmetrics.llm import toxicity as t
from reelmetrics.llm.queries import op9_toxicity, op10_quality
from reelmetrics.llm.svm import calibrate, fit

TABLES = "/root/testdata/sf0.1"


def labelled(spark, scored, label):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").groupBy("doc_id").agg(F.max(label).alias("y"))
    return scored.join(labels, "doc_id").where("held_out").select("score", "predicted", "y").toPandas()


def test_toxicity_of_held_out_rows(spark):
    scored = op9_toxicity(spark, TABLES)
    assert scored.count() == 10_000
    rows = labelled(spark, scored, "toxic")
    assert (rows.predicted == rows.y).mean() > 0.975 and rows.score.between(0, 1).all()


def test_quality_of_held_out_rows(spark):
    scored = op10_quality(spark, TABLES)
    assert scored.count() == 10_000
    rows = labelled(spark, scored, "quality")
    assert (rows.predicted == rows.y).mean() > 0.98 and rows.score.between(0, 1).all()


def test_folds_are_crc32(spark):
    rows = op9_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    rows = op10_quality(spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_kernel_is_the_sum_over_common_subsequences():
    """Against the definition: all ways to pick three characters within the span."""

    def vector(word):
        s, out = t.marked(word), {}
        for i in range(len(s)):
            for a, b, weight in t.PATTERNS:
                if i + b < len(s):
                    u = s[i] + s[i + a] + s[i + b]
                    out[u] = out.get(u, 0) + weight
        return out

    def kernel(x, y):
        x, y = vector(x), vector(y)
        dot = sum(v * y.get(u, 0) for u, v in x.items())
        return dot / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    landmarks, words = ["idiot", "lose-", "aaaa"], ["idiot", "idixot", "ixdxixoxt", "looser", "aaa", "house", "é"]
    rows, values = t.Kernel(landmarks).values(words, 0.05)
    dense = np.zeros((len(words), len(landmarks)))
    dense[rows] = values
    want = np.array([[kernel(w, z) for z in landmarks] for w in words])
    assert np.allclose(dense, np.where(want >= 0.05, want, 0), atol=1e-5)


def small_corpus():
    rng = np.random.default_rng(2)
    clean = ["".join(rng.choice(list("abdehlmnortu"), rng.integers(3, 8))) for _ in range(300)]
    insults = ["idiot", "worthless", "stupid", "moron"]
    texts, labels = [], []
    for i in range(240):
        words = rng.choice(clean, 30).tolist()
        if i % 4 == 0:
            for at in rng.integers(0, 30, 3):
                words[at] = str(rng.choice(insults))
        texts.append(". ".join(" ".join(words[k : k + 10]) for k in (0, 10, 20)) + ".")
        labels.append(int(i % 4 == 0))
    return texts, np.array(labels)


def test_hidden_insults():
    texts, labels = small_corpus()
    model = t.train(texts, labels)
    assert ((model.scores(texts) >= 0.5) == labels).mean() > 0.98
    hidden = ["you id-iot, go", "such an i d i o t here", "a stupiid thing", "1d10t", "worth.less", "IDIOT!", "moroon"]
    assert (model.scores(hidden) >= 0.5).all()
    assert (model.scores(["", "the house was dull", "a moraine", "1 2 3", "!!!"]) < 0.5).all()


def test_svm_separates_and_is_near_the_optimum():
    rng = np.random.default_rng(0)
    x = np.c_[rng.normal(size=(200, 3)), np.ones(200)]
    y = np.where(x @ [1, -2, 0.5, 0.3] > 0, 1.0, -1.0)
    every = np.arange(4)

    def loss(w):
        return w @ w / 2 + np.maximum(0, 1 - y * (x @ w)).sum()

    w = fit([every] * 200, list(x), y, 4, np.ones(200), epochs=300)
    assert ((x @ w > 0) == (y > 0)).mean() > 0.97
    assert all(loss(w) <= loss(w + d) + 1e-2 for d in 0.05 * rng.normal(size=(200, 4)))
    slope, offset = calibrate(x @ w, (y > 0).astype(float))
    assert slope > 0 and abs(offset) < 5


def test_shapes():
    assert [q.shape(w) for w in ("word", "Word", "WORD!!", "wörd%%%", "|", "a1b22", "(x)", "É", "!!!!!")] == ["x", "Xx", "X!!", "x%%", "|", "x0x0", "(x)", "X", "!!"]
    words, grams = q.Shapes().ngrams("go go stop")
    assert words == {"go", "stop"} and len(grams) == 2 + 2 + 1


@pytest.mark.parametrize("rate", [t.toxicity, q.quality])
def test_odd_rows(spark, rate):
    texts, labels = small_corpus()
    model = t.train(texts, labels) if rate is t.toxicity else q.train(texts, labels)
    docs = odd_documents(spark)
    rows = rate(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert rate(docs, model).columns == docs.columns
    assert rate(docs, None).select("score").distinct().count() == 1
    assert rate(no_documents(spark), model).collect() == []


def test_labels_of_one_class_or_none(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 1), (2, None, None), (None, 0, 0)], "doc_id long, toxic int, quality int")
    assert t.toxicity_model(docs, labels) is None and q.quality_model(docs, labels) is None
    assert t.toxicity_model(no_documents(spark), labels.where("false")) is None

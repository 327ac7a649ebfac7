"""The pipeline's stages on their own inputs, and the registered queries."""

import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelmetrics.llm.queries import ORACLE, QUERIES

ROOT = Path(__file__).resolve().parents[2]
SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id: r for r in docs.collect()})
        assert docs.count() == len(kept[-1])
        if k < 4:
            assert docs.columns == COLUMNS
            assert all(r.n_chars == len(r.text) or r == before[i] for i, r in kept[-1].items())
    # Each stage judged on its own input.
    assert kept[1].keys() == kept[0].keys() and sum(r.n_chars for r in kept[1].values()) < sum(r.n_chars for r in kept[0].values())
    from test_decontaminate import brute
    from test_simhash import fingerprint, groups

    rows = sorted((i, r.text) for i, r in kept[1].items())
    roots = groups([fingerprint(t) for _, t in rows], 2)
    assert sorted(kept[2]) == [rows[i][0] for i in range(len(rows)) if roots[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    short = {i: r.text for i, r in kept[2].items() if len(r.text) < 4000}
    assert set(short) - set(kept[3]) == {i for i, _ in brute(short.items(), items)}
    assert kept[4].keys() == kept[3].keys() and all(r.exact == ("▁" not in kept[3][i].text) for i, r in kept[4].items())
    run = {r.doc_id: (r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert run == {i: (r.ids, r.decoded_sha256) for i, r in kept[4].items()}


def test_toxic_documents_go_and_clean_ones_stay(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id", F.lit(1).alias("kept"))
    rows = spark.read.parquet(f"{folder}/labels.parquet").join(kept, "doc_id", "left").fillna(0, "kept").groupBy("toxic").agg(F.avg("kept").alias("share")).collect()
    share = {r.toxic: r.share for r in rows}
    # Every tenth toxic document of the table is junk that has lost its words.
    assert share[1] < 0.12 and share[0] > 0.99


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0


def test_each_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES}
    assert numbers == set(range(1, 11)) and len(QUERIES) == 10


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in sorted(Path(SMALL).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, QUERIES[name](spark, SMALL).select(*names).collect())) == sorted(want.fetchall())


def test_the_rest_works_without_this_package(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('reelmetrics.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "q = e.queries()\n"
        "assert len(q) > 100 and not any(n.startswith('op') for n in q) and 'pipeline' not in q\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

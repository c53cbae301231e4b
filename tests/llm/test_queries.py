"""The registered queries against their SQL, and the pipeline against brute force."""

import hashlib
from collections import defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from corpuslink.llm import queries
from corpuslink.plans.harness import _rows, duck
from tests.conftest import SF_SMALL

from .test_lines_shards import brute_lines
from .test_pairs_and_rules import brute_classes


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in queries.QUERIES.items() if sql))
def test_query_equals_its_sql(spark, name):
    fn, sql = queries.QUERIES[name]
    df = fn(spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(SF_SMALL).execute(sql)
    assert got == _rows([c[0] for c in cur.description], cur.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_jaccard_query_equals_brute_force(spark):
    docs = [tuple(r) for r in queries.table(spark, SF_SMALL, "documents").select(
        "doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op7_jaccard(spark, SF_SMALL).collect()))
    assert got == brute_classes(docs)


def test_stages(spark, docs, rows, tmp_path):
    """Each stage on odd rows: its decisions, and the columns of its input."""
    sf = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(
        f"{sf}/labels.parquet")
    spark.createDataFrame([(1, rows[8][1])], "item_id long, text string").write.parquet(
        f"{sf}/benchmark.parquet")
    docs.write.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
        "packing"]
    good = stages["quality rules"](spark, docs, sf)
    assert good.columns == docs.columns
    lines = stages["line dedup"](spark, docs, sf)
    assert lines.columns == docs.columns
    got = lines.select("doc_id", "text", "n_chars").collect()
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    assert sorted((r.doc_id if r.doc_id is not None else -1,
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got) == sorted(
        (i, h) for i, _, _, h in brute_lines(rows))
    leaks = stages["benchmark decontamination"](spark, docs, sf)
    assert leaks.columns == docs.columns
    gone = {r[0] for r in rows} - {r.doc_id for r in leaks.select("doc_id").collect()}
    assert gone == {8}
    packed = corpus_pipeline.run(spark, sf).collect()
    pieces = defaultdict(int)
    for p in packed:
        pieces[p.doc_id] += p.length
    assert packed and all(pieces[p.doc_id] == p.doc_tokens for p in packed)


def test_pipeline_on_empty_documents(spark, none, tmp_path):
    sf = str(tmp_path)
    none.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(
        f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(
        f"{sf}/pages.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
    for name, (fn, _) in queries.QUERIES.items():
        assert fn(spark, sf).count() == 0, name

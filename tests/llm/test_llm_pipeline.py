"""The pipeline's stages against brute force, each on its own input (the copies stage: test_llm_near_copies)."""

import corpus_pipeline
import pytest

from helpers import edge_docs, no_docs


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stage(n):
    return corpus_pipeline.STAGES[n][1]


def test_language_keeps_nearly_all(spark, sf_dir, docs):
    kept = stage(0)(spark, docs, sf_dir)
    assert kept.dtypes == docs.dtypes and kept.count() >= 0.98 * docs.count()


def test_leaks_go_and_others_stay(spark, sf_dir, docs):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    held = lambda t: any(len(i.split()) > 8 and i in t for i in items)
    kept = {r.doc_id for r in stage(2)(spark, docs, sf_dir).collect()}
    rows = docs.collect()
    assert not {r.doc_id for r in rows if held(r.text)} & kept
    assert len(kept) >= len(rows) - 3 * max(1, sum(held(r.text) for r in rows))


def test_mix_repeats_or_drops_documents(spark, sf_dir, docs):
    mixed = stage(3)(spark, docs, sf_dir)
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.dtypes == docs.dtypes and set(counts.values()) <= {1, 2}
    assert mixed.subtract(docs).count() == 0


def test_whole_run(spark, sf_dir, docs):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
    ordered = sorted(rows, key=lambda r: r.start)
    assert ordered[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in rows)


@pytest.mark.parametrize("n", range(5))
def test_stages_take_edge_cases(spark, sf_dir, n):
    for table in (edge_docs(spark), no_docs(spark)):
        out = stage(n)(spark, table, sf_dir)
        assert out.count() <= 2 * table.count()
        assert n == 4 or out.dtypes == table.dtypes

"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from helpers import EDGE_ROWS, LONG_TEXT, edge_docs, no_docs

from clickwatch.llm import (
    ann,
    decontaminate,
    language_id,
    mixing,
    pii,
    secret_scan,
    simhash,
    token_store,
    toxicity,
    url_filter,
)

LAYOUT = token_store.Layout(public_tokenizers.path("word_bpe_49k.json"))
ITEMS = "item_id long, text string"


def bench(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def model_of(spark):
    return language_id.fit(edge_docs(spark), language_id.Training(steps=40))


OPERATORS = {
    "toxicity": lambda s, d: toxicity.scored(d, toxicity.fit(d, labels(s, [(1, 1), (1, None), (None, 1), (5, 0), (99, 1)]))),
    "pii": lambda s, d: pii.pseudonymised(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "secrets": lambda s, d: secret_scan.scan(d),
    "mix": lambda s, d: mixing.mix_report(d),
    "language": lambda s, d: d.select("doc_id", language_id.identified(F.col("text"), model_of(s), d).alias("n")),
    "tokens": lambda s, d: token_store.encoded_documents(d, LAYOUT),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_every_row(spark, name):
    assert OPERATORS[name](spark, edge_docs(spark)).count() == len(EDGE_ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, no_docs(spark)).count() == 0


@pytest.mark.parametrize(
    "filtering",
    [simhash.one_of_each, mixing.mix_documents, lambda d: decontaminate.without_leaks(d, bench(d.sparkSession, []))],
    ids=["simhash", "mix", "leaks"],
)
def test_filters_keep_columns(spark, filtering):
    for docs in (edge_docs(spark), no_docs(spark)):
        kept = filtering(docs)
        assert kept.dtypes == docs.dtypes
        assert kept.select("doc_id", "text").subtract(docs.select("doc_id", "text")).count() == 0


def test_no_labels_no_score(spark):
    model = toxicity.fit(edge_docs(spark), labels(spark, []))
    assert {r.score for r in toxicity.scored(edge_docs(spark), model).collect()} == {0.0}


def test_undetermined(spark):
    docs = edge_docs(spark)
    rows = docs.select("doc_id", "text", language_id.identified(F.col("text"), model_of(spark), docs).alias("n")).collect()
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.n.lang_pred == "und") == (not lettered)
        assert r.n.rejected or lettered
    untaught = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.n.lang_pred for r in docs.select(language_id.identified(F.col("text"), untaught, docs).alias("n")).collect()} == {"und"}


def test_simhash_of_edges(spark):
    rows = simhash.near_duplicates(edge_docs(spark)).collect()
    blank = {r.doc_id for r in rows if r.fp == 0}
    assert blank == {3, 4, 6, None} and {r.component_id for r in rows if r.fp == 0} == {3}
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    kept = simhash.one_of_each(edge_docs(spark)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 5, 7]


def test_secret_and_pii_leave_blank_texts(spark):
    assert all(r.spans == "" for r in secret_scan.scan(edge_docs(spark)).collect())
    done = {(r.doc_id, r.text) for r in pii.pseudonymised(edge_docs(spark)).collect()}
    assert done == {(r[0], r[1]) for r in EDGE_ROWS}


def test_tokens_of_edges(spark):
    rows = token_store.encoded_documents(edge_docs(spark), LAYOUT).collect()
    assert [r.n_tokens for r in rows if r.doc_id in (3, 4)] == [1, 1]
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))


def test_leaks_of_edges(spark):
    items = [(1, " ".join(LONG_TEXT.split()[400:460])), (2, ""), (3, None), (None, LONG_TEXT), (4, "quick brown"), (1, "more of it")]
    found = decontaminate.contained_items(edge_docs(spark), bench(spark, items)).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(5, 1)]
    assert decontaminate.contained_items(edge_docs(spark), bench(spark, [])).count() == 0
    assert decontaminate.contained_items(no_docs(spark), bench(spark, items)).count() == 0


def test_urls_of_edges(spark):
    urls = [None, "", "no scheme casino", "x://", "HTTP://A.Example.COM/en/x?y", "http://www.example.com/en/", "ftp://n.NET/es/#x",
            "http://a.com?b", "http://free.org/bets/free", "http://winter.org/freedom", "a\nb://Q.org/p", "http://x.org/" + "a" * 100_000]
    pages = spark.createDataFrame([(i if i else None, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, key int")
    rows = {r.url: r for r in url_filter.judge(pages).collect()}
    assert len(rows) == len(urls)
    assert (rows[None].host, rows[None].path, rows[None].rule, rows[None].verdict) == ("", "", None, "allow")
    assert rows["no scheme casino"].verdict == "block" and rows["no scheme casino"].host == ""
    assert rows["HTTP://A.Example.COM/en/x?y"].rule == "example.com/en/"
    assert rows["http://www.example.com/en/"].verdict == "allow"
    assert (rows["ftp://n.NET/es/#x"].host, rows["ftp://n.NET/es/#x"].verdict) == ("n.net", "block")
    assert rows["http://a.com?b"].rule is None
    assert rows["http://free.org/bets/free"].soft_terms == 2 and rows["http://free.org/bets/free"].verdict == "block"
    assert rows["http://winter.org/freedom"].verdict == "allow"
    assert (rows["a\nb://Q.org/p"].host, rows["a\nb://Q.org/p"].path) == ("q.org", "/p")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_vectors_of_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [2.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (40, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    found = sorted(ann.search(df, 20).collect())
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 20), (0, 2, 1), (0, 3, 2), (20, 1, 0), (20, 2, 1), (20, 3, 2)]
    assert ann.search(df.limit(0), 20).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert ann.search(one, 20).count() == 0

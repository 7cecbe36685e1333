"""The pipeline's copies stage against brute-force Jaccard similarity of five-word shingles."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from helpers import docs_of

from clickwatch.llm import near_copies


def shingle_set(text, width=5):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def near_pairs(texts, least=0.8):
    sets = sorted((d, shingle_set(t)) for d, t in texts.items())
    pairs = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if min(len(x), len(y)) >= least * max(len(x), len(y)) and (x == y or len(x & y) / len(x | y) >= least):
                pairs.append((b, a))
    return pairs


def heads(texts):
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in near_pairs(texts):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return sorted({find(d) for d in texts})


@pytest.fixture(scope="module")
def copies():
    """Random texts, each with copies in which some words are changed: similarities on both sides of 0.8."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for i in range(40):
        base = [word() for _ in range(rng.randrange(60, 200))]
        texts.append(base)
        for _ in range(i % 4):
            copy = list(base)
            for _ in range(rng.randrange(1, 6)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    rng.shuffle(texts)
    return dict(enumerate(map(" ".join, texts)))


def test_stage_keeps_one_of_every_group(spark, sf_dir, copies):
    kept = corpus_pipeline.STAGES[1][1](spark, docs_of(spark, list(copies.values())), sf_dir)
    want = heads(copies)
    assert len(want) < len(copies) - 20 and sorted(r.doc_id for r in kept.collect()) == want


def test_stage_keeps_no_near_pair_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.STAGES[1][1](spark, docs, sf_dir)
    assert kept.dtypes == docs.dtypes and sorted(r.doc_id for r in kept.collect()) == heads(texts)


@pytest.mark.parametrize("part", [4096, 7])
def test_partly_linked_texts_of_one_long_list(spark, monkeypatch, part):
    """300 drifting copies: many pairs on both sides of the limit, most of them in the same lists."""
    monkeypatch.setattr(near_copies, "_PART", part)
    rng = random.Random(9)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    texts = []
    for i in range(300):
        copy = list(base if i % 3 else rng.choice(texts).split() if texts else base)
        for _ in range(rng.randrange(7)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(3000)}"
        texts.append(" ".join(copy))
    want = heads(dict(enumerate(texts)))
    assert 1 < len(want) < 250
    kept = near_copies.one_of_each(docs_of(spark, texts), growth=2 if part == 7 else 16)
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_rows_without_words_or_with_null_ids(spark):
    rows = [(None, None), (None, " "), (3, ""), (2, "One  two"), (1, "one two"), (1, "one two"), (None, "three"), (None, "three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit("h"))
    kept = near_copies.one_of_each(docs).collect()
    assert sorted((r.doc_id or 0, r.text, r.hash) for r in kept) == [(0, "three", "h"), (1, "one two", "h"), (3, "", "h")]


def test_links_of_a_list_cost_few_comparisons(monkeypatch):
    """Texts in the largest group are not compared any more; the links give the groups of all pairs."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = [[f"x{rng.randrange(999)}" if rng.random() < 0.01 else w for w in base] for _ in range(400)]
    texts += [[f"y{i}" if j % 12 == 0 else w for j, w in enumerate(base)] for i in range(5)]  # linked to none
    sets = [near_copies.shingles(near_copies.words_of(" ".join(t))) for t in texts]
    compared, bincount = [], near_copies.np.bincount
    monkeypatch.setattr(near_copies.np, "bincount", lambda x, **k: compared.append(k) or bincount(x, **k))
    links = list(near_copies.spanning_links(sets, [str(i) for i in range(405)], [True] * 405, 0.8))
    root = list(range(405))
    for a, b in links:
        root = [root[a] if r == root[b] else r for r in root]
    want = heads({i: " ".join(t) for i, t in enumerate(texts)})
    assert len(set(root)) == len(want) >= 5 and len(links) == 405 - len(want)
    assert sum("minlength" in k for k in compared) < 60


def test_stage_links_by_fingerprints_first(spark):
    """Close copies are linked by five-word fingerprints within the limit of the method, others are not."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(9999)}" for _ in range(2000)]
    texts = [base, [*base, "end"], [f"w{rng.randrange(9999)}" for _ in range(2000)]]
    nodes = spark.createDataFrame(
        [(str(i), len(s), near_copies.fingerprint(s)) for i, t in enumerate(texts) for s in [near_copies.shingles([w.encode() for w in t])]],
        "node string, n int, fp long",
    )
    assert {tuple(sorted(r)) for r in near_copies._similar_fingerprints(nodes).collect()} == {("0", "1")}

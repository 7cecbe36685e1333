"""Filter audit and token alignment against plain counting."""

import hashlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import EDGE_ROWS, edge_docs, no_docs
from tokenizers import Tokenizer

from clickwatch.llm import filter_audit, token_align
from clickwatch.llm.queries import QUERIES

TOKENIZERS = token_align.Tokenizers(
    public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# ---- filter audit


def plain_audit(rows, labels):
    """Applies every order to the documents, one by one."""
    texts = [((d if d is not None else float("-inf")), t or "", lang or "") for d, t, lang in rows]
    first = {}
    for d, t, _ in texts:
        first[t] = min(first.get(t, d), d)
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    fails = []
    for d, t, _ in texts:
        words = t.encode().split()
        fails.append(
            {f for f, bad in {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                "D": any(c in t for c in "#$%&*|"),
                "E": d > first[t],
            }.items() if bad}
        )
    found, shapley = {}, Counter()
    for part in {p for _, _, p in texts}:
        for order in permutations("ABCDE"):
            left = [i for i, row in enumerate(texts) if row[2] == part]
            every = list(left)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in fails[i]]
                left = [i for i in left if f not in fails[i]]
                ids = [texts[i][0] for i in gone]
                redundant = sum(f in fails[i] for i in every) - len(gone)
                unique = sum(fails[i] == {f} for i in every)
                found[part, "".join(order), step] = (
                    len(left), len(gone), redundant, unique, sum(d in good for d in ids), sum(d in toxic for d in ids)
                )
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def audited(df):
    return {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in df.collect()}


def test_audit_equals_applying_every_order(spark):
    long = " ".join(f"w{i}" for i in range(250))
    rows = [
        (1, long, "en"), (2, long, "en"), (2, long, "en"), (3, "a a a # B", "en"), (4, long + " |", "de"),
        (5, "x " * 300, None), (6, "", ""), (7, None, "de"), (None, long, "de"), (8, "ABC def", "en"), (8, "ABC def", "en"),
        (9, "no break Ünï code", "en"),
    ]
    labels = [(1, 1, 0), (2, 1, 0), (3, 0, 1), (3, 1, 0), (8, None, 1), (77, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert audited(filter_audit.audit(docs, labels_of(spark, labels))) == plain_audit(rows, labels)


def test_audit_of_edge_rows_and_of_nothing(spark):
    labels = [(1, 1, 1)]
    rows = [(r[0], r[1], r[2]) for r in EDGE_ROWS]
    assert audited(filter_audit.audit(edge_docs(spark), labels_of(spark, labels))) == plain_audit(rows, labels)
    assert filter_audit.audit(no_docs(spark), labels_of(spark, labels)).count() == 0
    assert filter_audit.audit(edge_docs(spark), labels_of(spark, [])).count() == 600 * len({r[2] or "" for r in EDGE_ROWS})


def test_gray_walk_equals_direct_counting():
    counts = np.random.default_rng(3).integers(0, 50, (32, 3))
    left = filter_audit.survivors(counts)
    for state in range(32):
        assert (left[state] == sum(counts[m] for m in range(32) if not m & state)).all()


# ---- token alignment


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(TOKENIZERS.byte_level)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZERS.pieces), token_align.Aligner(TOKENIZERS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain_alignment(text, encoders):
    """Groups and links of a text by whole encoding and comparing all ranges that may overlap."""
    a, b, aligner = encoders
    if not text:
        return None
    raw = (" " + text).encode()
    sides = []
    for ids, bytes_of in ((a.encode(" " + text, add_special_tokens=False).ids, aligner.a.bytes), (b.encode(text), aligner.b.bytes)):
        if b"".join(bytes_of[i] for i in ids) != raw:
            return None
        ends = np.cumsum([len(bytes_of[i]) for i in ids]).tolist()
        sides.append((ids, [0, *ends[:-1]], ends))
    (ids_a, start_a, end_a), (ids_b, start_b, end_b) = sides
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(end_a) & set(end_b)):
        first_i, first_j = i, j
        while i < len(ids_a) and end_a[i] <= end:
            i += 1
        while j < len(ids_b) and end_b[j] <= end:
            j += 1
        groups.append(f"{','.join(map(str, ids_a[first_i:i]))}|{','.join(map(str, ids_b[first_j:j]))}")
        links += [
            (ids_a[x], ids_b[y])
            for x in range(first_i, i)
            for y in range(first_j, j)
            if start_a[x] < end_b[y] and start_b[y] < end_a[x]
        ]
    return len(ids_a), len(ids_b), groups, links


def plain_rows(texts, encoders):
    found = [plain_alignment(t, encoders) for t in texts]
    docs = Counter(pair for f in found if f for pair in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        top = sum(docs[pair] == best[pair[0]] for pair in links)
        rows.append((n_a, n_b, len(groups), len(links), top, sum(docs[pair] for pair in links), digest))
    return Counter(rows)


def rows_of(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r) for r in df.select(*names).collect())


def test_alignment_of_documents(spark, sf_dir, docs, encoders):
    rows = docs.collect()
    want = plain_rows([r.text for r in rows], encoders)
    got = QUERIES["op13_token_alignment"](spark, sf_dir)
    assert rows_of(got) == want and sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in rows)


def test_alignment_when_most_pairs_go_through_the_shuffle(spark, docs, encoders):
    few = token_align.Tokenizers(TOKENIZERS.byte_level, TOKENIZERS.pieces, pairs=40)
    assert rows_of(token_align.aligned(docs, few)) == plain_rows([r.text for r in docs.collect()], encoders)
    none = token_align.Tokenizers(TOKENIZERS.byte_level, TOKENIZERS.pieces, pairs=0)
    assert rows_of(token_align.aligned(edge_docs(spark), none)) == plain_rows([r[1] for r in EDGE_ROWS], encoders)


def test_alignment_of_edge_rows_and_of_nothing(spark, encoders):
    assert rows_of(token_align.aligned(edge_docs(spark), TOKENIZERS)) == plain_rows([r[1] for r in EDGE_ROWS], encoders)
    assert token_align.aligned(no_docs(spark), TOKENIZERS).count() == 0


def test_cut_texts_align_as_whole_ones(encoders):
    letters = list("ab cdé  \n\t\x00\xa0▁İ́'.,!?s日本😀ﬁ 　\x1c­Z09\r\x0b") + ["<|endoftext|>", "'ll", "  ", " \n", "<s>"]
    choice = np.random.default_rng(1)
    texts = ["".join(choice.choice(letters, choice.integers(0, 40))) for _ in range(4000)] + [" ", "  ", "a ", " a", "<0x41>"]
    numbers, digests, of, codes, times = encoders[2].align(texts)
    links = Counter()
    for t, code, n in zip(of.tolist(), codes.tolist(), times.tolist()):
        links[t, code >> 16, code & 0xFFFF] += n
    want = Counter()
    for i, text in enumerate(texts):
        f = plain_alignment(text, encoders)
        expected = (0, 0, 0, 0, "") if f is None else (f[0], f[1], len(f[2]), len(f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest())
        assert (*numbers[i].tolist(), digests[i]) == expected, text
        want.update((i, *pair) for pair in (f[3] if f else ()))
    assert links == want

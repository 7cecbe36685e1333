"""Registered queries against their SQL, and the digests of the others against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

from compare import difference, duck

from clickwatch.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_toxicity(spark, sf_dir, docs):
    rows = QUERIES["op1_toxicity_scores"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_pseudonyms_keep_everything_else(spark, sf_dir, docs):
    for r in QUERIES["op2_pseudonyms"](spark, sf_dir).collect():
        finds = r.n_email + r.n_iban + r.n_date + r.n_ip + r.n_ssn + r.n_phone + r.n_card
        assert (r.text != docs[r.doc_id]) == (finds > 0)
        assert re.sub(r"\S*[0-9@]\S*", "", r.text) == re.sub(r"\S*[0-9@]\S*", "", docs[r.doc_id])


def brute_fingerprint(text, width=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fingerprints, max_bits=2):
    root = {d: d for d in fingerprints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(fingerprints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash_groups(spark, sf_dir, docs):
    rows = QUERIES["op3_simhash_groups"](spark, sf_dir).collect()
    fingerprints = {d: brute_fingerprint(t) for d, t in docs.items()}
    groups = brute_components(fingerprints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (format(fingerprints[d], "016x"), groups[d]) for d in docs
    }
    assert len(rows) == len(docs)


def test_secrets(spark, sf_dir, docs):
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for r in QUERIES["op6_secret_scan"](spark, sf_dir).collect():
        text = docs[r.doc_id]
        spans = [("assign", m) for m in re.finditer(assign, text) if len(m[1]) >= 8]
        spans += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        spans.sort(key=lambda s: (s[1].start(), ["assign", "access", "hex"].index(s[0])))
        listed = [f"{k}:{m.start()}:{m.end()}" for k, m in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | set()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))


def test_languages(spark, sf_dir, con):
    truth = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in QUERIES["op7_languages"](spark, sf_dir).collect()]
    tested = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == held_out(r.doc_id) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.95 * len(tested)


def test_token_files(spark, sf_dir, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, start, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, {}
    for d in sorted(docs):
        ids = [*tokenizer.encode(docs[d] or "", add_special_tokens=False).ids, 2]
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    rows = QUERIES["op8_token_files"](spark, sf_dir).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want and len(rows) == len(want)


def test_neighbours_recall(spark, sf_dir, con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = QUERIES["op9_neighbours"](spark, sf_dir).collect()
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(abs(r.score - scores[ids == r.vec_id][0]) < 1e-12 for r in own)
        hits, total = hits + len({r.vec_id for r in own} & set(best.tolist())), total + 20
    assert hits >= 0.9 * total

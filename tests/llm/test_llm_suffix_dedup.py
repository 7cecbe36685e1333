"""Removal of repeated strings against a dictionary of all windows."""

import hashlib
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from helpers import EDGE_ROWS, edge_docs, no_docs

from clickwatch.llm import suffix_dedup
from clickwatch.llm.queries import QUERIES

HOW = suffix_dedup.Repeats()
SMALL = suffix_dedup.Repeats(length=12, gram=8, block_bytes=2000)


def plain(rows, length):
    """(id, n_bytes, n_removed, n_spans, digest) of rows whose order is known: ids differ, or ids and texts agree."""
    seen, found = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        found.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(found)


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_first_windows_equal_a_dictionary_of_windows():
    chance = random.Random(5)
    for _ in range(100):
        base = "".join(chance.choice("ab") for _ in range(chance.randint(12, 60)))
        contents = set()
        for _ in range(chance.randint(1, 8)):
            letters = list(base[chance.randint(0, 5) :])
            for _ in range(chance.randint(0, 3)):
                letters[chance.randrange(len(letters))] = chance.choice("abc")
            whole = "".join(letters) + "ab" * chance.randint(0, 10)
            if len(whole) >= SMALL.length:
                contents.add(whole.encode())
        contents = sorted(contents)
        if not contents:
            continue
        document = np.array([chance.randint(0, 3) for _ in contents])
        start = np.array([1000 * chance.randint(0, 3) + 100_000 * i for i in range(len(contents))])
        found = suffix_dedup.first_windows(contents, document, start, SMALL)
        got = {(i, at + k) for i, at, n in zip(*(c.tolist() for c in found)) for k in range(n)}
        windows = sorted(
            (document[i], start[i] + j, i, j) for i, c in enumerate(contents) for j in range(len(c) - SMALL.length + 1)
        )
        seen, want = set(), set()
        for _, _, i, j in windows:
            window = contents[i][j : j + SMALL.length]
            if window not in seen:
                want.add((i, j))
            seen.add(window)
        assert got == want


def test_equal_windows_have_equal_anchors():
    chance = random.Random(2)
    texts = [bytes(chance.choice(b"ab") for _ in range(chance.randint(0, 80))) for _ in range(60)] + [b"a" * 50, b"ab" * 30]
    of, start, key, anchor = suffix_dedup.anchors(texts, SMALL)
    known = {}
    for i, at, k, p in zip(of.tolist(), start.tolist(), key.tolist(), anchor.tolist()):
        window = texts[i][at : at + SMALL.length]
        assert len(window) == SMALL.length and 0 <= p - at <= SMALL.length - SMALL.gram
        assert known.setdefault(window, (k, p - at)) == (k, p - at)
    assert len(of) == sum(max(0, len(t) - SMALL.length + 1) for t in texts)


def test_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(QUERIES["op11_repeated_bytes"](spark, sf_dir)) == plain(rows, HOW.length)


@pytest.mark.parametrize("often", [1, 3, 1024])
def test_common_lines_copies_and_periods(spark, often):
    """A line in every text, texts that are nothing but a line or a period, copies; anchors split or not."""
    chance = random.Random(9)
    line = "the same line of sixty bytes that stands in each of the texts "
    noise = lambda n: "".join(chance.choice("abcdefgh é\n") for _ in range(n))
    rows = [(i, noise(40) + line + noise(60)) for i in range(60)]
    rows += [(100 + i, line * 5) for i in range(5)] + [(200 + i, "ab" * 150 + noise(i)) for i in range(5)]
    rows += [(300 + i, rows[i][1]) for i in range(30)] + [(400 + i, noise(20) + rows[2][1][5:150] + rows[3][1]) for i in range(5)]
    rows += [(500, line * 2), (500, line * 2), (500, line * 2), (501, ""), (502, None), (None, line + line), (503, "z" * 400)]
    docs = frame(spark, rows).repartition(3)
    how = replace(HOW, often=often, block_bytes=3000)
    assert rows_of(suffix_dedup.deduplicated(docs, how)) == plain(rows, how.length)


def test_short_strings(spark):
    chance = random.Random(4)
    rows = [(i, "".join(chance.choice("ab") for _ in range(chance.randint(0, 60)))) for i in range(80)]
    assert rows_of(suffix_dedup.deduplicated(frame(spark, rows), SMALL)) == plain(rows, SMALL.length)


def test_long_texts_are_cut_into_pieces_without_loss(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PIECE", 500)
    monkeypatch.setattr(suffix_dedup, "_GROUP", 1200)
    chance = random.Random(1)
    texts = [bytes(chance.choice(b"abc ") for _ in range(n)) for n in (4000, 90, 0, 2500, 100, 99)] + [b"q" * 2000]
    windows = set()
    for of, start, count, _, _ in suffix_dedup.runs(texts, HOW):
        for i, at, n in zip(of.tolist(), start.tolist(), count.tolist()):
            new = {(i, at + k) for k in range(n)}
            assert not new & windows
            windows |= new
    assert windows == {(i, k) for i, t in enumerate(texts) for k in range(len(t) - HOW.length + 1)}


def test_edge_rows_and_nothing(spark):
    rows = [(r[0], r[1]) for r in EDGE_ROWS if not (r[0] is None and r[1] is None)]
    got = rows_of(suffix_dedup.deduplicated(edge_docs(spark), HOW))
    assert got - plain(rows, HOW.length) == Counter({(None, 0, 0, 0, hashlib.sha256(b"").hexdigest()): 1})
    assert suffix_dedup.deduplicated(no_docs(spark), HOW).count() == 0

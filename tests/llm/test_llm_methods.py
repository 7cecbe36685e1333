"""The operators' own promises: bijections, confirmed keys, recall, exact containment, budgets, keyed reads."""

import base64
import datetime as dt
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from helpers import docs_of

from clickwatch.llm import ann, decontaminate, mixing, pii, secret_scan, simhash, token_store
from clickwatch.llm.components import connected_components

LAYOUT = token_store.Layout(public_tokenizers.path("word_bpe_49k.json"), shard_bytes=2_000, keys_per_bucket=40)


# ---- pseudonyms


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def mod97(iban):
    text = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def new_of(spark, values, key="k"):
    rows = pii.pseudonymised(docs_of(spark, [f"x {v} y" for v in values]), pii.Pseudonyms(key)).orderBy("doc_id").collect()
    return [r.text[2:-2] for r in rows], rows


def test_cards_stay_valid_and_linked(spark):
    rng = random.Random(1)
    cards = [card(rng) for _ in range(40)]
    spaced = [" ".join(c[i : i + 4] for i in range(0, 16, 4)) for c in cards]
    new, _ = new_of(spark, cards + spaced)
    assert all(luhn(n.replace(" ", "")) and n != c for n, c in zip(new, cards + spaced))
    assert [n.replace(" ", "") for n in new[40:]] == new[:40] and len(set(new[:40])) == len(set(cards))
    assert [n.count(" ") for n in new[40:]] == [3] * 40
    wrong = [c[:-1] + str((int(c[-1]) + 1) % 10) for c in cards]
    assert new_of(spark, wrong)[0] == wrong
    assert new_of(spark, cards, "other key")[0] != new[:40]


def test_dates_are_permuted_as_days(spark):
    days = [dt.date(1900, 1, 1) + dt.timedelta(days=i * 37) for i in range(60)]
    iso, _ = new_of(spark, [d.isoformat() for d in days])
    dotted, _ = new_of(spark, [d.strftime("%d.%m.%Y") for d in days])
    slashed, _ = new_of(spark, [d.strftime("%d/%m/%Y") for d in days])
    assert len(set(iso)) == 60 and not set(iso) & {d.isoformat() for d in days}
    assert [dt.datetime.strptime(x, "%d.%m.%Y").date().isoformat() for x in dotted] == iso
    assert [dt.datetime.strptime(x, "%d/%m/%Y").date().isoformat() for x in slashed] == iso
    untouched = ["2023-02-30", "31.04.2020", "1899-12-31", "2100-01-01"]
    assert new_of(spark, untouched)[0] == untouched


def test_other_kinds(spark):
    values = ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "192.168.0.1", "123-45-6789", "+1 (980) 555-2833",
              "(504) 555-5272", "ann.b@mail.example.com", "256.1.1.1", "666-45-6789", "GB83 WEST 1234 5698 7654 32"]
    new, rows = new_of(spark, values)
    assert new[7:] == values[7:]
    assert mod97(new[0]) == mod97(new[1]) == 1 and new[0][:2] == "GB" and new[0][5:9] == "WEST" and new[0].count(" ") == 5
    assert all(0 <= int(x) < 256 for x in new[2].split("."))
    assert len(new[3]) == 11 and new[3][:3] != "666" and new[4].startswith("+1 (") and len(new[4]) == len(values[4])
    assert new[6].startswith("user") and new[6].endswith("@mail.example.com")
    assert [a != b for a, b in zip(new[:7], values)] == [True] * 7
    assert (rows[0].n_iban, rows[2].n_ip, rows[3].n_ssn, rows[4].n_phone, rows[6].n_email) == (1, 1, 1, 1, 1)


def test_feistel_is_a_bijection(spark):
    grid = spark.range(35).select((F.col("id") % 5).alias("l"), F.floor(F.col("id") / 5).alias("r"))
    out = pii.feistel(F.col("l"), F.col("r"), F.lit(5), F.lit(7), "t", pii.Pseudonyms("k"))
    assert {tuple(r[0]) for r in grid.select(out).collect()} == {(x, y) for x in range(5) for y in range(7)}


# ---- secrets


def der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + content


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


RSA = der(0x30, integer(0) + b"".join(integer(3**k) for k in (300, 5, 290, 150, 140)))
SPKI = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d010101")) + der(5, b"")) + der(3, b"\0" + RSA))


def b64url(raw):
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def kinds(text):
    return sorted(k for k, _, _ in secret_scan.structural_spans(text))


def test_keys_are_confirmed_by_structure():
    ssh = b"".join(len(f).to_bytes(4, "big") + f for f in (b"ssh-rsa", b"\1\0\1", bytes(range(1, 130))))
    assert kinds("key " + base64.b64encode(RSA).decode() + " end") == ["der"]
    assert kinds(SPKI.hex()) == ["pub"] and kinds("x" + base64.b64encode(ssh).decode()[:-4] + " y") == []
    assert kinds("ssh-rsa " + base64.b64encode(ssh).decode() + " me@host") == ["pub"]
    assert kinds(base64.b64encode(RSA[:-1]).decode()) == [] and kinds(base64.b64encode(b"plain words " * 9).decode()) == []
    lines = base64.encodebytes(RSA).decode()
    assert kinds(f"a\n-----BEGIN RSA PRIVATE KEY-----\n{lines}-----END RSA PRIVATE KEY-----\n") == ["pem"]
    assert kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{lines[:-20]}-----END RSA PRIVATE KEY-----") == []


def armoured(body, name="RSA PRIVATE KEY"):
    return f"-----BEGIN {name}-----{body}-----END {name}-----"


def test_encrypted_keys_and_written_line_ends():
    lines = base64.encodebytes(RSA).decode()
    assert kinds('{"key": "' + armoured("\n" + lines).replace("\n", "\\n") + '"}') == ["pem"]
    legacy = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0A" * 16 + "\n\n"
    whole, short = (base64.encodebytes(bytes(range(n))).decode() for n in (160, 155))
    assert kinds(armoured(legacy + whole)) == ["pem"] and kinds(armoured(legacy + short)) == []
    assert kinds(armoured("\n" + whole)) == []  # no headers: must parse
    sealed = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d"))) + der(4, bytes(range(160))))
    assert kinds(armoured("\n" + base64.encodebytes(sealed).decode(), "ENCRYPTED PRIVATE KEY")) == ["pem"]


def test_open_headers_do_not_hide_a_key_and_cost_linear_time():
    key = armoured("\n" + base64.encodebytes(RSA).decode())
    begin, text = "-----BEGIN RSA PRIVATE KEY-----\n", "word " * 9
    spans = secret_scan.structural_spans(begin + text + key + text + begin)
    assert spans == [("pem", len(begin + text), len(begin + text + key))]
    assert kinds("-----BEGIN EC PRIVATE KEY-----\n" + key.split("-----", 2)[2]) == []  # names differ
    started = time.perf_counter()
    for unit in (begin, begin + "abcd\n", "-----BEGIN " + "A " * 20, key + "\n"):
        secret_scan.structural_spans(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - started < 5


def test_tokens_are_confirmed_by_header():
    head, body = b64url(b'{"alg":"HS256","typ":"JWT"}'), b64url(b'{"sub":"1"}')
    assert secret_scan.structural_spans(f"é {head}.{body}.c2ln x") == [("jwt", 2, 2 + len(f"{head}.{body}.c2ln"))]
    assert kinds(f"{head}.{body}.") == [] and kinds(f"{b64url(b'{}' * 5)}.{body}.c2ln") == [] and kinds(f"{head}.bm8.c2ln") == []
    assert kinds(f"{b64url(b'''{ "alg": "none"}''')}.{body}.") == ["jwt"]


# ---- copies


def test_index_finds_all_close_fingerprints(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(150)}
    for base in [centre] * 150 + sorted(values)[:40]:
        for _ in range(rng.randrange(4)):
            base ^= 1 << rng.randrange(64)
        values.add(base)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    close = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    # every list emits pairs: all links; every list is too long: enough links for the same components
    assert {tuple(r) for r in simhash.links(df, list_limit=10**6).collect()} == close
    stars = {tuple(r) for r in simhash.links(df, list_limit=1).collect()}
    assert stars <= close | {(b, a) for a, b in close} and len(close) > 50
    parts = [{r.node: r.root for r in connected_components(spark.createDataFrame(list(x), "a long, b long")).collect()} for x in (close, stars)]
    assert parts[0] == parts[1]


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5000, 5000)]
    random.Random(2).shuffle(links)
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


# ---- leaks


def test_containment_equals_brute_force_whatever_is_broadcast(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 5, 6, 9, 20, 33, 70, 200)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(400))) for _ in range(30)]
    for item in items:
        own = item.split()
        for lost in (0, 1, 2, 5, len(own) // 6):
            cut = own[:-lost] if lost and rng.random() < 0.5 else own[lost:]
            texts.append(" ".join([*texts[rng.randrange(30)].split(), *cut, "End.", *texts[rng.randrange(30)].split()]))
    texts += [items[0].upper() + "!", "(" + items[1] + ")"]

    def shingles(text):
        own = [w.strip(".!()") for w in text.lower().split()]
        return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()

    want = {
        (d, i) for d, t in enumerate(texts) for i, item in enumerate(items)
        if len(shingles(item) & shingles(t)) >= 0.8 * len(shingles(item))
    }
    assert len(want) > 15
    docs, bench = docs_of(spark, texts), docs_of(spark, items).withColumnRenamed("doc_id", "item_id")
    for rows in (0, 10**6):
        found = decontaminate.contained_items(docs, bench, decontaminate.Search(broadcast_rows=rows)).collect()
        assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
        kept = decontaminate.without_leaks(docs, bench, decontaminate.Search(broadcast_rows=rows))
        assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}


# ---- mixing


def test_targets_by_refilling(spark):
    rng = random.Random(7)
    for n in (1, 2, 5, 9):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 500, 5000]) for i in range(n)} | {None: 70}
        order = [*sorted(k for k in sizes if k), None]
        weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
        left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
        while open_:
            share = left / sum(weight[k] for k in open_)
            full = {k for k in open_ if 2 * sizes[k] <= share * weight[k]}
            if not full:
                target |= {k: share * weight[k] for k in open_}
                break
            target |= {k: 2.0 * sizes[k] for k in full}
            left, open_ = left - sum(2 * sizes[k] for k in full), open_ - full
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(target)


def test_a_hot_source_and_repeated_rows_meet_their_budget(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["word"] * rng.randrange(30)), "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    rows += [(1000, "same words again", "s1")] * 120
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    report = mixing.mix_report(docs).collect()
    assert len(report) == len(rows)
    by_source = {}
    for r in report:
        assert r.taken in (r["size"] * r.copies,) and 0 <= r.copies <= 2
        part = by_source.setdefault(r.source, [r.target, 0, 0])
        part[1], part[2] = part[1] + r.taken, max(part[2], r["size"])
    assert all(abs(taken - target) <= largest for target, taken, largest in by_source.values())
    mixed = mixing.mix_documents(docs).groupBy("source").count().collect()
    copies = {}
    for r in report:
        copies[r.source] = copies.get(r.source, 0) + r.copies
    assert {r["source"]: r["count"] for r in mixed} == {k: v for k, v in copies.items() if v}


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, ("clean words only " if i % 2 else "%$# 12 &&& 99 !! ") * 3, s) for i in range(800) for s in ("a",)] + [
        (2000 + i, "other words here", "b") for i in range(1600)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    report = mixing.mix_report(docs, mixing.Mix(weights=(1, 2), budget=0.3)).filter("source = 'a'").collect()
    good, bad = (sum(r.copies for r in report if r.doc_id % 2 == x) for x in (1, 0))
    assert good > 2 * bad > 0


# ---- token files


def test_keys_find_their_documents(spark):
    texts = [f"document {i} " * (i % 40) for i in range(300)]
    docs = docs_of(spark, texts).unionByName(docs_of(spark, ["twice told", "again"]))
    store = token_store.write_store(docs, LAYOUT)
    assert len(store.shards) > 3 and store.buckets > 3
    asked = spark.createDataFrame([(0,), (1,), (7,), (299,), (99_999,), (None,), (7,)], "doc_id long")
    rows = token_store.read_documents(asked, store).collect()
    assert sorted(r.doc_id for r in rows) == [0, 0, 1, 1, 7, 299]
    direct = dict(enumerate(token_store.encoded(texts, LAYOUT)))
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert ids[-1] == 2 and len(ids) == r.n_tokens
        if r.doc_id in (7, 299):
            assert (ids == np.frombuffer(direct[r.doc_id], "<u2")).all()


@pytest.mark.parametrize("keys", [1, 2, 3, 50, 5000])
def test_perfect_hash_is_minimal(keys):
    rng = np.random.default_rng(keys)
    h1, h2, x1, x2 = (rng.integers(0, 2**64, keys, np.uint64) for _ in range(4))
    data = token_store.build_index(h1, h2, np.arange(keys), np.full(keys, 3))
    known, first, rows = token_store.search_index(data, h1, h2)
    assert known.all() and (first == np.arange(keys)).all() and (rows == 3).all()
    assert token_store.search_index(data, x1, x2)[0].sum() <= 1
    assert len(data) < 200 + 20 * keys


def test_pieces_encode_like_whole_texts():
    odd = ["It's the end, isn't it?", "a b c", "Ünï é ́x", "<|endoftext|> and <|startoftext|>x", "x\x1cy\x85z", "ΑΣ Σας İstanbul",
           "don't'll 'sun 's", "éa,.b;:c!|d 12,5.", "你好\U0001f600", "word.́ x", "  lead\ttrail \r\n"]
    whole = token_store.Layout(LAYOUT.tokenizer, cut=False)
    for _ in range(3):  # pieces unknown, met once, met again
        for text, a, b in zip(odd, token_store.encoded(odd, LAYOUT), token_store.encoded(odd, whole)):
            assert a == b, text


def test_random_pieces_encode_like_whole_texts():
    """Every letter of the plain class before every mark, and random texts of both."""
    letters = [chr(c) for c in range(0xC0, 0x250)] + list("abcXYZ") * 40
    marks = [*".,;:!?|'\"-_()019#@", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "\u0307", "\u0301", "Σ", "日", "\xa0", " ", "\t", "\x1c"]
    rng = np.random.default_rng(0)
    pool = letters + marks * 8
    texts = [a + b for a in letters[:400] for b in marks]
    texts += ["".join(rng.choice(pool, rng.integers(0, 30))) for _ in range(10_000)] + ["TÜRKİYE BELEDİYESİ. Son."]
    whole = token_store.Layout(LAYOUT.tokenizer, cut=False)
    assert token_store._encoder(LAYOUT.tokenizer).pattern
    assert list(token_store.encoded(texts, LAYOUT)) == list(token_store.encoded(texts, whole))


# ---- neighbours


def test_hot_vector_and_ties(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(400, 8)), 2)
    x[100:300] = x[100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = ann.search(df, 20, ann.MultiIndex(k=10, block_rows=16, chunk_queries=3)).collect()
    for q in range(0, 400, 20):
        scores = np.einsum("nd,d->n", x, x[q])
        order = [i for i in sorted(range(400), key=lambda i: (-round(scores[i], 9), i)) if i != q][:10]
        assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == order


def test_token_memo_is_the_table_of_its_group(monkeypatch):
    """Words are looked up once a group, what is met again stays, long words go with their group; ids are those of whole texts."""
    import public_tokenizers

    from clickwatch.llm import token_store

    monkeypatch.setattr(token_store, "_REMEMBERED", 3)
    monkeypatch.setattr(token_store, "_GROUP_WORDS", 4)
    memo = token_store._Memo()
    assert sorted(memo.unknown({"a", "b", "x" * 99})) == ["a", "b", "x" * 99]
    table = memo.put({"a": b"1", "b": b"2", "x" * 99: b"3"})
    assert table is memo.young and table["x" * 99] == b"3"
    assert sorted(memo.unknown({"b", "c", "d"})) == ["c", "d"]
    memo.put({"c": b"4", "d": b"5"})
    assert sorted(memo.unknown({"a", "x" * 99})) == ["x" * 99] and memo.young == {"a": b"1"}
    layout = token_store.Layout(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["One two, three four's five!", "y" * 200 + " two two", "", "Ünder two's 12,3 " * 9, "y" * 200]
    token_store._encoder.cache_clear()
    cut = list(token_store.encoded(texts, layout))
    token_store._encoder.cache_clear()
    assert cut == list(token_store.encoded(texts, token_store.Layout(layout.tokenizer, cut=False)))

"""How the tokens of two tokenizers, byte-level A and piece-level B, lie over each other.

A text is encoded by both; where a token of A and one of B end at the same byte, the text is
cut into groups, and every A and B token whose byte ranges overlap are linked. The
count of an id pair is the number of documents that hold it linked.

Identity map: an A id whose bytes are a B piece too is mapped to that B id once, so a link of
such a pair (the bulk: exact one-to-one groups) is counted in a vector as long as A's vocabulary;
every task gives that vector once. Only other pairs are summed by pair, after every
task has summed its own. Each document leaves its distinct links and their numbers in the
staged table, so texts are encoded once.

Both tokenizers work apart on either side of a space that follows a character other than
white space: A's pre-tokenizer ends there, and no piece of B holds a space behind another
character (checked when B is loaded; else whole texts are encoded). So texts are cut
there, and each different cut is encoded and aligned once while a worker remembers it.

For the second reading the counts of the most frequent `pairs` irregular pairs are sent to
the tasks (at most that many, chosen by a count from which all are sent); links of rarer
pairs are joined to their counts by a shuffle, so nothing is left out and no key of
that join is in many documents.

Defined cases: null and empty texts, and texts whose bytes either tokenizer does not give back,
have no tokens: zeros and an empty digest; rows repeating an id are documents of their own; the id may be null;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwatch.session import stage, use_all_cores

#: fixed value: how byte-level vocabularies of this kind split a text before merging
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: characters whose class every library agrees on; pieces with others are encoded whole
_KNOWN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]*")
_CUT = re.compile(r" (?<=\S )")
_SPACE = "▁"
#: characters of pieces remembered by a worker, characters of texts aligned together, pairs summed in a task
_REMEMBERED, _GROUP, _PENDING = 6_000_000, 4_000_000, 2_000_000
_WORDS = 200_000  # pre-tokens of A remembered
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass(frozen=True)
class Tokenizers:
    byte_level: str  # A: a tokenizers file with a byte-level pre-tokenizer
    pieces: str  # B: a sentencepiece model
    pairs: int = 2_000_000  # irregular pairs whose counts are sent to the tasks


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next unused one from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class _ByteLevel:
    """Tokenizer A, a pre-token at a time."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        pre = parts["pre_tokenizer"] or {}
        splits = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.separable = bool(splits) and parts["normalizer"] is None
        letters = _byte_letters()
        self.letter_of = {b: letter for b, letter in enumerate(letters)}
        byte_of = {letter: b for b, letter in enumerate(letters)}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes = [b""] * size
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            known = all(c in byte_of for c in token)
            self.bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.size = np.array([len(raw) for raw in self.bytes], np.int64)
        self.pretoken = regex.compile(PRETOKEN)
        self.known: dict[str, list[int]] = {}

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each piece, one after the other, and their number for each piece.

        Pieces of known letters that end in no white space are split as one text, which
        splits each of them as if it were alone.
        """
        apart = [not (self.separable and _KNOWN.fullmatch(p) and p and not p[-1].isspace()) for p in pieces]
        plain = [p for p, a in zip(pieces, apart) if not a]
        if len(self.known) > _WORDS:
            self.known.clear()
        parts = self.pretoken.findall(" " + " ".join(plain)) if plain else []
        for part in set(parts).difference(self.known):
            letters = part.encode().decode("latin-1").translate(self.letter_of)
            self.known[part] = [token.id for token in self.model.tokenize(letters)]
        ids = np.array(list(chain.from_iterable(map(self.known.__getitem__, parts))), np.int64)
        counts = np.zeros(len(pieces), np.int64)
        ends = np.cumsum([len(p.encode()) + 1 for p in plain])
        counts[~np.array(apart, bool)] = np.diff(np.searchsorted(np.cumsum(self.size[ids]), ends, "right"), prepend=0)
        if len(plain) == len(pieces):
            return ids, counts
        lists, at = [], 0
        for i, alone in enumerate(apart):
            if alone:
                found = self.tokenizer.encode(" " + pieces[i], add_special_tokens=False).ids
                counts[i] = len(found)
                lists.append(np.array(found, np.int64))
            else:
                lists.append(ids[at : at + counts[i]])
                at += counts[i]
        return np.concatenate(lists), counts


class _Pieces:
    """Tokenizer B; it puts a space before every text by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.separable = not any(_SPACE in name.lstrip(_SPACE) for name in names)
        self.byte = [self.model.is_byte(i) for i in range(len(names))]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if byte else name.replace(_SPACE, " ").encode() for name, byte in zip(names, self.byte)
        ]
        self.space = [self.model.piece_to_id(_SPACE)]

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each piece; a piece without characters would lose its space."""
        lists = [ids or self.space for ids in self.model.encode(pieces, num_threads=1)]
        return np.array(list(chain.from_iterable(lists)), np.int64), np.array(list(map(len, lists)), np.int64)


def _expanded(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (size[0] of them), first[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _same_bytes(ids: np.ndarray, counts: np.ndarray, bytes_of: list[bytes], raw: list[bytes]) -> np.ndarray:
    """Whether the ids of each piece give its bytes back."""
    found = list(map(bytes_of.__getitem__, ids.tolist()))
    if b"".join(found) == b"".join(raw):
        sizes = np.cumsum([0, *map(len, found)])[np.cumsum(counts)]
        if np.array_equal(sizes, np.cumsum([len(r) for r in raw])):
            return np.ones(len(raw), bool)
    ends = np.cumsum(counts).tolist()
    return np.array([b"".join(found[i:j]) == r for i, j, r in zip([0, *ends], ends, raw)], bool)


class Aligner:
    """Aligned pieces, remembered; link codes are a * 65536 + b."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.a, self.b = _ByteLevel(tokenizers.byte_level), _Pieces(tokenizers.pieces)
        if max(len(self.a.bytes), len(self.b.bytes)) > 1 << 16:
            raise ValueError("vocabularies of more than 65,536 ids")
        self.cut = self.a.separable and self.b.separable
        piece_of = {raw: i for i, raw in enumerate(self.b.bytes) if self.b.byte[i]}
        piece_of |= {raw: i for i, raw in enumerate(self.b.bytes) if not self.b.byte[i]}
        #: B id of the same bytes for every A id, -1 if there is none
        self.same = np.array([piece_of.get(raw, -1) for raw in self.a.bytes], np.int64)
        self.size_a = np.array([len(raw) for raw in self.a.bytes], np.int64)
        self.size_b = np.array([len(raw) for raw in self.b.bytes], np.int64)
        #: how an id is written within (2 * id) and at the end (2 * id + 1) of its side of a group, B after A
        self.names = [b"%d%s" % (i, end) for i in range(len(self.a.bytes)) for end in (b",", b"|")]
        self.names += [b"%d%s" % (i, end) for i in range(len(self.b.bytes)) for end in (b",", b";")]
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.remembered = 0
        self.rendered: list[bytes] = []
        self.numbers = np.zeros((0, 4), np.int64)  # as _NUMBERS
        self.lossless = np.zeros(0, bool)
        self.first_link = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.uint32)

    def regular(self, codes: np.ndarray) -> np.ndarray:
        return self.same[codes >> 16] == (codes & 0xFFFF)

    def _learn(self, pieces: list[str]) -> None:
        (a, count_a), (b, count_b) = self.a.encode(pieces), self.b.encode(pieces)
        raw = [(" " + p).encode() for p in pieces]
        lossless = _same_bytes(a, count_a, self.a.bytes, raw) & _same_bytes(b, count_b, self.b.bytes, raw)
        a, b = a[np.repeat(lossless, count_a)], b[np.repeat(lossless, count_b)]
        count_a, count_b = count_a * lossless, count_b * lossless
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        start_a, start_b = end_a - self.size_a[a], end_b - self.size_b[b]
        # groups end where both sides do
        joint_a, joint_b = np.isin(end_a, end_b), np.isin(end_b, end_a)
        piece_a = np.repeat(np.arange(len(pieces)), count_a)
        groups = np.bincount(piece_a[joint_a], minlength=len(pieces))
        first = np.searchsorted(end_b, start_a, "right")
        partners = np.searchsorted(start_b, end_a, "left") - first
        links = (np.repeat(a, partners) << 16) | b[_expanded(first, partners)]
        count = np.bincount(piece_a, partners, len(pieces)).astype(np.int64)
        # the A ids of a group, then its B ids
        group_a, group_b = np.cumsum(joint_a) - joint_a, np.cumsum(joint_b) - joint_b
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        number = np.concatenate([2 * a + joint_a, 2 * (b + len(self.a.bytes)) + joint_b])[order]
        names = list(map(self.names.__getitem__, number.tolist()))
        ends = np.cumsum(count_a + count_b).tolist()
        self.rendered += [b"".join(names[i:j]) for i, j in zip([0, *ends], ends)]
        self.index.update(zip(pieces, range(len(self.index), len(self.index) + len(pieces))))
        self.remembered += sum(map(len, pieces)) + 8 * len(pieces)
        self.numbers = np.concatenate([self.numbers, np.stack([count_a, count_b, groups, count], axis=1)])
        self.lossless = np.concatenate([self.lossless, lossless])
        self.first_link = np.concatenate([self.first_link, len(self.links) + np.cumsum(count) - count])
        self.links = np.concatenate([self.links, links.astype(np.uint32)])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and digest of every text; distinct links as (text, code, times)."""
        if self.remembered > _REMEMBERED:
            self._forget()
        split = [[] if not t else _CUT.split(t) if self.cut else [t] for t in texts]
        flat = list(chain.from_iterable(split))
        unknown = set(flat).difference(self.index)
        if unknown:
            self._learn(list(unknown))
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        sizes = np.array([len(p) for p in split], np.int64)
        text = np.repeat(np.arange(len(texts)), sizes)
        lost = np.bincount(text, ~self.lossless[at], len(texts)) > 0
        numbers = np.zeros((len(texts), 4), np.int64)
        for i in range(4):
            numbers[:, i] = np.bincount(text, self.numbers[at, i], len(texts))
        numbers[lost] = 0
        digests, begin, places = [], 0, at.tolist()
        for end, empty in zip(np.cumsum(sizes).tolist(), lost.tolist()):
            whole = b"" if empty else b"".join([self.rendered[i] for i in places[begin:end]])
            digests.append(hashlib.sha256(whole[:-1]).hexdigest() if whole else "")
            begin = end
        kept = ~lost[text]
        at, text = at[kept], text[kept]
        count = self.numbers[at, 3]
        codes = self.links[_expanded(self.first_link[at], count)]
        keys = (np.repeat(text, count).astype(np.uint64) << np.uint64(32)) | codes
        keys, times = np.unique(keys, return_counts=True)
        return numbers, digests, (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), times


@lru_cache(maxsize=2)
def _aligner(tokenizers: Tokenizers) -> Aligner:
    return Aligner(tokenizers)


def _packed(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending codes as steps, and the times; both compress well."""
    return np.concatenate([np.diff(codes, prepend=0), times]).astype("<u4").tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(data, "<u4").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > _GROUP:
            yield begin, i + 1
            begin, size = i + 1, 0
    yield begin, len(texts)


class _PairCounts:
    """Numbers of documents per pair of one task; given away whenever many pairs are held."""

    def __init__(self) -> None:
        self.codes, self.docs, self.pending = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, codes: np.ndarray) -> None:
        self.pending.append(codes)
        if sum(map(len, self.pending)) > _PENDING:
            self.sum()

    def sum(self) -> None:
        fresh, times = np.unique(np.concatenate([*self.pending, self.codes[:0]]), return_counts=True)
        codes, place = np.unique(np.concatenate([self.codes, fresh]), return_inverse=True)
        self.docs = np.bincount(place, np.concatenate([self.docs, times]), len(codes)).astype(np.int64)
        self.codes, self.pending = codes, []

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.sum()
        taken = self.codes, self.docs
        self.codes, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return taken


def _rows_of_counts(kind: pa.DataType, codes: np.ndarray, docs: np.ndarray, regular: bool) -> pa.RecordBatch:
    n = len(codes)
    columns = [pa.nulls(n, kind), *[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.string()), pa.nulls(n, pa.binary())]
    columns += [pa.array([regular] * n, pa.bool_()), pa.array(codes, pa.int64()), pa.array(docs, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=_STAGED)


_STAGED = ["key", *_NUMBERS, "groups_sha256", "links", "regular", "code", "docs"]


def _encoded(docs: DataFrame, tokenizers: Tokenizers, key: str, text: str) -> DataFrame:
    """Per document its numbers and links; and per task its counts of pairs (`regular` not null)."""
    kind = docs.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, pairs, pack = _aligner(tokenizers), _PairCounts(), zstandard.ZstdCompressor(level=1)
        vector, key_type = np.zeros(len(aligner.same), np.int64), None
        for batch in batches:
            key_type, texts = batch.schema.types[0], batch.column(1).to_pylist()
            for begin, end in _groups(texts):
                numbers, digests, of, codes, times = aligner.align(texts[begin:end])
                regular = aligner.regular(codes)
                vector += np.bincount(codes[regular] >> 16, minlength=len(vector))
                pairs.add(codes[~regular])
                edges = np.searchsorted(of, np.arange(end - begin + 1)).tolist()
                links = [pack.compress(_packed(codes[i:j], times[i:j])) if i < j else None for i, j in zip(edges, edges[1:])]
                n = end - begin
                columns = [batch.column(0).slice(begin, n), *[pa.array(numbers[:, i]) for i in range(4)]]
                columns += [pa.array(digests, pa.string()), pa.array(links, pa.binary())]
                columns += [pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=_STAGED)
                if len(pairs.codes) > _PENDING:
                    yield _rows_of_counts(key_type, *pairs.take(), False)
        if key_type is not None:
            yield _rows_of_counts(key_type, *pairs.take(), False)
            seen = np.flatnonzero(vector)
            yield _rows_of_counts(key_type, (seen << 16) | aligner.same[seen], vector[seen], True)

    numbers = ", ".join(f"{n} long" for n in _NUMBERS)
    schema = f"key {kind}, {numbers}, groups_sha256 string, links binary, regular boolean, code long, docs long"
    rows = use_all_cores(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
    return stage(rows.mapInArrow(encode, schema), "aligned")


def _frequent(pairs: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """Pairs in at least so many documents that no more than `most` are; and whether these are all."""
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    sizes = sorted(pairs.groupBy(power).count().collect(), reverse=True)  # a row per power of two
    total, least = 0, 64
    for power_of_two, count in sizes:
        if total + count > most:
            break
        total, least = total + count, power_of_two
    every = total == sum(s[1] for s in sizes)
    return pairs.filter(F.col("docs") >= 2.0**least), every


def aligned(docs: DataFrame, tokenizers: Tokenizers, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    staged = _encoded(docs, tokenizers, key, text)
    regular = staged.filter("regular").groupBy("code").agg(F.sum("docs").alias("docs"))
    summed = staged.filter("NOT regular").groupBy("code").agg(F.sum("docs").alias("docs"))
    pairs = stage(summed, "pairs")
    aligner = _aligner(tokenizers)
    # one number per A id each
    vector, best = (np.zeros(len(aligner.same), np.int64) for _ in range(2))
    for row in regular.collect():
        vector[row.code >> 16] = row.docs
    for row in pairs.groupBy(F.shiftright("code", 16).alias("a")).agg(F.max("docs").alias("docs")).collect():
        best[row.a] = row.docs
    best = np.maximum(best, vector)
    frequent, every = _frequent(pairs, tokenizers.pairs)
    sent = frequent.toPandas().sort_values("code")
    tables = (vector, best, sent["code"].to_numpy(np.int64), sent["docs"].to_numpy(np.int64))
    shared = spark.sparkContext.broadcast(tables)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, best, known, docs = shared.value
        aligner, pack, number = _aligner(tokenizers), zstandard.ZstdDecompressor(), TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            lists = [_unpacked(pack.decompress(d)) if d else None for d in batch.column(6).to_pylist()]
            of = np.repeat(np.arange(n), [len(x[0]) if x else 0 for x in lists])
            codes, times = (np.concatenate([x[i] for x in lists if x] or [np.zeros(0, np.int64)]) for i in range(2))
            regular, first = aligner.regular(codes), codes >> 16
            place = np.searchsorted(known, codes)
            place[place == len(known)] = 0
            found = known[place] == codes if len(known) else np.zeros(len(codes), bool)
            count = np.where(regular, vector[first], docs[place] if len(known) else 0)
            have = regular | found
            count[~have] = 0
            top = have & (count == best[first])
            numbers = [np.bincount(of, w, n).astype(np.int64) for w in (np.where(top, times, 0), times * count)]
            ids = pa.array(np.arange(number, number + n))
            columns = [ids, *[batch.column(i) for i in range(6)], *map(pa.array, numbers)]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(n, pa.int64())] * 3], names=_RATED)
            rest = np.flatnonzero(~have)
            if len(rest):
                m = len(rest)
                nothing = [pa.nulls(m, batch.schema.types[0]), *[pa.nulls(m, pa.int64())] * 4, pa.nulls(m, pa.string())]
                nothing += [pa.nulls(m, pa.int64())] * 2
                columns = [pa.array(number + of[rest]), *nothing, pa.array(codes[rest]), pa.array(times[rest])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(best[first[rest]])], names=_RATED)
            number += n

    numbers = ", ".join(f"{n} long" for n in _NUMBERS)
    schema = f"row long, key {kind}, {numbers}, groups_sha256 string, n_best long, count_sum long, code long, times long, best long"
    texts = staged.filter("regular IS NULL").select("key", *_NUMBERS, "groups_sha256", "links")
    rated = texts.mapInArrow(rate, schema)
    result = ["key", *_NUMBERS, "n_best", "count_sum", "groups_sha256"]
    if every:
        return rated.select(*result).withColumnRenamed("key", key)
    rated = stage(rated, "rated")
    rest = rated.filter("code IS NOT NULL").select("row", "code", "times", "best").join(pairs, "code")
    more = rest.groupBy("row").agg(
        F.sum(F.when(F.col("docs") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("docs")).alias("more_sum"),
    )
    whole = rated.filter("code IS NULL").join(more, "row", "left").na.fill(0, ["more_best", "more_sum"])
    whole = whole.withColumn("n_best", F.col("n_best") + F.col("more_best"))
    whole = whole.withColumn("count_sum", F.col("count_sum") + F.col("more_sum"))
    return whole.select(*result).withColumnRenamed("key", key)


_RATED = ["row", "key", *_NUMBERS, "groups_sha256", "n_best", "count_sum", "code", "times", "best"]

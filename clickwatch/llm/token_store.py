"""Token ids of documents in flat files, with keyed access by minimal perfect hashing.

Layout below a store's folder, which all executors share:

* `<shard>.ids`: raw little-endian ids of its documents one after the other, two
  bytes each if the vocabulary has at most 65,536 ids, else four;
* `<shard>.off`: little-endian unsigned 64-bit starts of its documents, in ids, and the end;
* `<bucket>.mph`: the index of the keys whose hash falls in the bucket: header,
  displacements, then a slot per key with a fingerprint of the key, its first row and its
  number of rows.

Documents are in ascending key order over all shards (null first). A key is hashed to its
bucket and displacement, which gives its slot; the stored fingerprint tells absent keys;
the slot gives the row, the shard directory the file, the offsets the ids: a constant
number of reads. Rows repeating a key follow each other, so a slot has one run.

Files get names of their own per task attempt, and only those that a finished task
reports enter the directory, so a lost or repeated task leaves nothing behind that is
read. The directory has a row per shard (of `shard_bytes`) and is all that is
collected. Files are written with pyarrow's file systems, so the shared folder must be
one they reach (local mount, HDFS, S3, GCS).

Texts are cut at ASCII white space if the tokenizer file says that white space only separates, and what
is left is split by the file's own pattern and encoded by its model, every different word once
while a worker remembers it. Pieces with letters whose lower case or composition libraries may see
differently, or with a special token, are encoded whole by the tokenizers library; so are all texts
of a tokenizer of another kind.

Defined cases: a null text is empty and has the end id alone; a null key is a key,
first in order; rows repeating a key are ordered by their text; an empty table gives an empty store.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwatch.llm.common import text_key
from clickwatch.session import new_path, stage

#: characters that are composed as they stand and whose class and lower case (one character) every library agrees on
_KNOWN = re.compile("[\x20-\x7eÀ-ÖØ-öø-įı-ɏ]*")
#: words remembered by a worker (twice that at most, of so many bytes each), and words whose ids are looked up together
_REMEMBERED, _LONGEST, _GROUP_WORDS = 240_000, 64, 200_000
_ROWS = 256  # documents taken out of a batch at once
_MAGIC, _HEADER = b"MPHI", "<4sIQ"  # magic, displacements, keys
_SLOT = np.dtype([("fingerprint", "<u4"), ("rows", "<u4"), ("first", "<u8")])
_TRIES = 1 << 20
_MIX = np.array([0x9E3779B97F4A7C15, 0xC4CEB9FE1A85EC53], np.uint64)


@dataclass(frozen=True)
class Layout:
    tokenizer: str
    end_id: int = 2
    shard_bytes: int = 32 << 20
    keys_per_bucket: int = 50_000
    cut: bool = True  # where the tokenizer allows it


@dataclass(frozen=True)
class Store:
    root: str
    width: int
    shards: tuple[str, ...]  # in row order
    first_rows: np.ndarray  # of every shard, and the end
    first_ids: np.ndarray
    buckets: int
    index: tuple[str, ...]  # a file per bucket, "" if it has no key


# ---- encoding


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the threads
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def id_width(path: str) -> int:
    return 2 if _tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def _separating_pattern(path: str) -> str | None:
    """The pattern by which a tokenizer splits lower-cased words, if white space separates and does no more."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    steps = [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ]
    normal = parts["normalizer"] or {}
    splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    split, letters = splits if len(splits) == 2 else ({}, {})
    fits = (
        normal.get("normalizers") == steps
        and split.get("type") == "Split"
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and letters.get("type") == "ByteLevel"
        and not (letters.get("add_prefix_space") or letters.get("use_regex"))
        and parts["post_processor"] is None
    )
    return split["pattern"]["Regex"] if fits else None


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memo:
    """Ids of words met lately: what is met again moves to the young half, the old half goes when that is full.

    The young half holds all words of the group at hand, so it is the table by which that is put together.
    """

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}
        self.long: list = []

    def unknown(self, words: set) -> list:
        """The words of the next group that have no ids yet; `put` has to follow."""
        for w in self.long:
            del self.young[w]
        self.long = []
        if len(self.young) > _REMEMBERED:
            self.young, self.old = {}, self.young
        young, old, left = self.young, self.old.get, []
        for w in words.difference(young):
            if (ids := old(w)) is None:
                left.append(w)
            else:
                young[w] = ids
        return left

    def put(self, fresh: dict) -> dict:
        """Ids of all words of the group, and of others."""
        if fresh and max(map(len, fresh)) > _LONGEST:
            self.long = [w for w in fresh if len(w) > _LONGEST]
        self.young.update(fresh)
        return self.young


class _Encoder:
    """Encodes texts by words, every different word of a group once."""

    def __init__(self, path: str) -> None:
        self.tokenizer, self.code = _tokenizer(path), "H" if id_width(path) == 2 else "I"
        self.model = self.tokenizer.model
        pattern = _separating_pattern(path)
        self.pattern = regex.compile(pattern) if pattern else None
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.pieces, self.words = _Memo(), _Memo()

    def whole(self, texts: Iterable[str]) -> Iterator[bytes]:
        for text in texts:
            yield array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def cut(self, texts: Iterable[str]) -> Iterator[bytes]:
        group, words = [], 0
        for text in texts:
            raw = text.encode("utf-8", "replace")
            # ASCII letters may be lowered here, but not where that may make or unmake a special token
            low = raw.lower()
            group.append((raw if any(t.lower() in low for t in self.special) else low).split())
            words += len(group[-1])
            if words >= _GROUP_WORDS:
                yield from self._joined(group)
                group, words = [], 0
        yield from self._joined(group)

    def _joined(self, group: list[list[bytes]]) -> list[bytes]:
        unknown = self.pieces.unknown(set().union(*group))
        table = self.pieces.put(self._encoded_pieces(unknown) if unknown else {})
        return [b"".join(map(table.__getitem__, pieces)) for pieces in group]

    def _encoded_pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        joined = b" ".join(pieces)
        text, fresh = joined.decode("utf-8", "replace"), {}
        if any(s in joined for s in self.special) or not _KNOWN.fullmatch(text):
            plain = []
            for piece in pieces:
                letters = piece.decode("utf-8", "replace")
                if _KNOWN.fullmatch(letters) and not any(s in piece for s in self.special):
                    plain.append(piece)
                else:
                    fresh[piece] = next(self.whole([letters]))
            pieces = plain
            text = b" ".join(pieces).decode("utf-8", "replace")
        # the pattern takes every character but white space, so the parts of a piece are found by their lengths
        parts = self.pattern.findall(text.lower())
        found = {}
        for word in self.words.unknown(set(parts)):
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            found[word] = array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
        ids = list(map(self.words.put(found).__getitem__, parts))
        lengths = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        ends = np.searchsorted(lengths, np.cumsum(list(map(len, text.split(" ")))), "right").tolist()
        # most pieces have one part
        fresh.update((p, ids[i] if j == i + 1 else b"".join(ids[i:j])) for p, i, j in zip(pieces, [0, *ends], ends))
        return fresh


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _release() -> None:
    """Give back what encoding held in this worker; the tasks that index and read have no use for it."""
    _encoder.cache_clear()
    _tokenizer.cache_clear()
    pa.default_memory_pool().release_unused()


def encoded(texts: Iterable[str | None], layout: Layout) -> Iterator[bytes]:
    """The ids of every text and the end id, in the store's width."""
    encoder = _encoder(layout.tokenizer)
    end = array(encoder.code, [layout.end_id]).tobytes()
    texts = (t or "" for t in texts)
    return (ids + end for ids in (encoder.cut(texts) if layout.cut and encoder.pattern else encoder.whole(texts)))


# ---- files


def _open_folder(root: str) -> tuple[fs.FileSystem, str]:
    found = fs.FileSystem.from_uri(root)
    found[0].create_dir(found[1], recursive=True)
    return found


def _write(root: str, name: str, data: bytes) -> None:
    files, folder = _open_folder(root)
    with files.open_output_stream(f"{folder}/{name}") as out:
        out.write(data)


def _read(root: str, name: str) -> bytes:
    files, folder = fs.FileSystem.from_uri(root)
    with files.open_input_file(f"{folder}/{name}") as file:
        return file.read()


class _ShardWriter:
    """Writes the documents of one task, as they come, into shards of about `shard_bytes`."""

    def __init__(self, root: str, layout: Layout) -> None:
        self.root, self.layout, self.width = root, layout, id_width(layout.tokenizer)
        self.task, self.attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        self.files, self.folder = _open_folder(root)
        self.done: list[tuple[int, int, str, int, int]] = []
        self.out, self.starts, self.bytes, self.number = None, array("Q", [0]), 0, 0

    def _name(self) -> str:
        return f"{self.task:06d}-{self.number:04d}-{self.attempt}"

    def add(self, ids: bytes) -> tuple[int, int, int]:
        """(task, shard of the task, row of the shard) of the next document."""
        if self.bytes and self.bytes + len(ids) > self.layout.shard_bytes:
            self.close()
        if self.out is None:
            self.out = self.files.open_output_stream(f"{self.folder}/{self._name()}.ids", buffer_size=1 << 20)
        self.out.write(ids)
        self.bytes += len(ids)
        self.starts.append(self.bytes // self.width)
        return self.task, self.number, len(self.starts) - 2

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            _write(self.root, f"{self._name()}.off", np.array(self.starts, "<u8").tobytes())
            self.done.append((self.task, self.number, self._name(), len(self.starts) - 1, self.starts[-1]))
            self.number += 1
        self.out, self.starts, self.bytes = None, array("Q", [0]), 0


# ---- minimal perfect hash


def _slots_of(h1: np.ndarray, h2: np.ndarray, displacement: np.ndarray, keys: int) -> np.ndarray:
    x = (h2 ^ (displacement.astype(np.uint64) * _MIX[0])) + h1
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    moved = ((x ^ (x >> np.uint64(29))) % np.uint64(keys)).astype(np.int64)
    return np.where(displacement < 0, -displacement - 1, moved)


def build_index(h1: np.ndarray, h2: np.ndarray, first: np.ndarray, rows: np.ndarray) -> bytes:
    """The file of one bucket of different keys, given by two 64-bit hashes each."""
    keys = len(h1)
    groups = max(1, keys // 4)
    group = (h1 % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    begins = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    displacement = np.zeros(groups, np.int64)
    used, place = np.zeros(keys, bool), np.empty(keys, np.int64)
    for g in np.argsort(-sizes, kind="stable"):
        own = order[begins[g] : begins[g + 1]]
        if len(own) < 2:
            break
        at, width = 0, 16
        while True:
            if at > _TRIES:
                raise ValueError("keys repeat, or their hashes agree")
            tries = np.arange(at, at + width)
            found = _slots_of(h1[own][None], h2[own][None], tries[:, None], keys)
            ordered = np.sort(found, axis=1)
            free = ~used[found].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if free.any():
                hit = int(free.argmax())
                displacement[g] = tries[hit]
                place[own] = found[hit]
                used[found[hit]] = True
                break
            at, width = at + width, min(4096, 2 * width)
    # groups of one key take what is left, by slot number
    single = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(~used)
    displacement[single] = -left - 1
    place[order[begins[single]]] = left
    slots = np.empty(keys, _SLOT)
    slots["fingerprint"][place] = (h2 >> np.uint64(32)).astype(np.uint32)
    slots["first"][place], slots["rows"][place] = first, rows
    return struct.pack(_HEADER, _MAGIC, groups, keys) + displacement.astype("<i8").tobytes() + slots.tobytes()


def search_index(data: bytes, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, first row, rows) of keys; unknown ones differ from the stored fingerprint (all but one in 2**32)."""
    magic, groups, keys = struct.unpack_from(_HEADER, data)
    if magic != _MAGIC:
        raise ValueError("not an index file")
    at = struct.calcsize(_HEADER)
    displacement = np.frombuffer(data, "<i8", groups, at)
    slots = np.frombuffer(data, _SLOT, keys, at + 8 * groups)
    found = slots[_slots_of(h1, h2, displacement[(h1 % np.uint64(groups)).astype(np.int64)], keys)]
    return found["fingerprint"] == (h2 >> np.uint64(32)).astype(np.uint32), found["first"], found["rows"]


def _hashes(key: Column) -> tuple[Column, Column]:
    """Two hashes of a key; null has hashes of its own."""
    text, null = F.coalesce(key.cast("string"), F.lit("")), key.isNull()
    return F.xxhash64(text, null), F.xxhash64(null, F.lit("second"), text)


def _bucket(buckets: int) -> Column:
    """By a third hash: what falls in a bucket must still be spread evenly by the other two."""
    return F.pmod(F.xxhash64("h1", "h2"), F.lit(buckets)).cast("int")


def _unsigned(values: pd.Series) -> np.ndarray:
    return values.to_numpy(np.int64).view(np.uint64)


# ---- jobs


def write_store(docs: DataFrame, layout: Layout, key: str = "doc_id", text: str = "text") -> Store:
    """Encode all texts and write shards and index."""
    spark = docs.sparkSession
    root, width = new_path(spark, "token-store"), id_width(layout.tokenizer)
    kind = docs.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _ShardWriter(root, layout)
        names = ["key", "task", "number", "row", "name", "rows", "ids"]
        types = [None, pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        key_type = None
        for batch in batches:
            key_type = batch.schema.types[0]
            parts = (batch.column(1).slice(i, _ROWS).to_pylist() for i in range(0, batch.num_rows, _ROWS))
            texts = chain.from_iterable(parts)
            places = list(zip(*[shards.add(ids) for ids in encoded(texts, layout)])) or [[], [], []]
            none = [None] * batch.num_rows
            columns = [*places, none, none, none]
            arrays = [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types[1:])]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        shards.close()
        if shards.done:  # the shards' own rows: no row number
            task, number, name, rows, ids = zip(*shards.done)
            columns = [task, number, [None] * len(task), name, rows, ids]
            arrays = [pa.nulls(len(task), key_type), *[pa.array(c, t) for c, t in zip(columns, types[1:])]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    # the last part splits rows that are equal in key and text, which are interchangeable
    order = [F.col("key").asc_nulls_first(), F.col("text_key").asc_nulls_first(), F.col("part")]
    part = (F.monotonically_increasing_id() % 1024).alias("part")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), text_key(F.col(text)).alias("text_key"), part)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    schema = f"key {kind}, task int, number int, row long, name string, rows long, ids long"
    written = stage(ordered.mapInArrow(encode, schema), "token-rows")

    found = written.filter("row IS NULL").select("task", "number", "name", "rows", "ids").collect()  # one per shard
    found.sort(key=lambda s: (s.task, s.number))
    first_rows = np.cumsum([0, *[s.rows for s in found]])
    first_ids = np.cumsum([0, *[s.ids for s in found]])
    directory = spark.createDataFrame(
        [(s.task, s.number, int(r)) for s, r in zip(found, first_rows)], "task int, number int, first_row long"
    )
    at = written.filter("row IS NOT NULL").join(directory, ["task", "number"])
    runs = at.groupBy("key").agg(F.min(F.col("first_row") + F.col("row")).alias("first"), F.count(F.lit(1)).alias("rows"))
    buckets = max(1, -(-int(first_rows[-1]) // layout.keys_per_bucket))
    h1, h2 = _hashes(F.col("key"))
    hashed = runs.select(h1.alias("h1"), h2.alias("h2"), "first", "rows")
    hashed = hashed.withColumn("bucket", _bucket(buckets))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        _release()
        bucket, name = int(frame["bucket"].iloc[0]), f"{frame['bucket'].iloc[0]:06d}-{uuid.uuid4().hex}.mph"
        frame = frame.sort_values(["h1", "h2"])
        data = build_index(
            _unsigned(frame["h1"]), _unsigned(frame["h2"]), frame["first"].to_numpy(), frame["rows"].to_numpy()
        )
        _write(root, name, data)
        return pd.DataFrame({"bucket": [bucket], "name": [name]})

    files = hashed.groupBy("bucket").applyInPandas(build, "bucket int, name string").collect()  # one per bucket
    names = [""] * buckets
    for file in files:
        names[file.bucket] = file.name
    return Store(root, width, tuple(s.name for s in found), first_rows, first_ids, buckets, tuple(names))


def read_documents(keys: DataFrame, store: Store, key: str = "doc_id") -> DataFrame:
    """Rows of the store whose key is in `keys`: key, start, n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    spark: SparkSession = keys.sparkSession
    kind = keys.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast(store)  # a name and two numbers per shard, a name per bucket

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        """Runs of rows, cut at shard ends."""
        _release()
        store = shared.value
        name = store.index[int(frame["bucket"].iloc[0])]
        if not name:
            return pd.DataFrame({"key": frame["key"][:0], "shard": [], "row": [], "rows": []})
        known, first, rows = search_index(_read(store.root, name), _unsigned(frame["h1"]), _unsigned(frame["h2"]))
        first, rows = first.astype(np.int64), rows.astype(np.int64)
        begin = np.searchsorted(store.first_rows, first, "right") - 1
        end = np.searchsorted(store.first_rows, first + rows - 1, "right") - 1
        pieces = np.where(known, end - begin + 1, 0)
        which = np.repeat(np.arange(len(frame)), pieces)
        shard = begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        low = np.maximum(first[which], store.first_rows[shard])
        high = np.minimum((first + rows)[which], store.first_rows[shard + 1])
        return pd.DataFrame(
            {"key": frame["key"].iloc[which], "shard": shard, "row": low - store.first_rows[shard], "rows": high - low}
        )

    def read(frame: pd.DataFrame) -> pd.DataFrame:
        _release()
        store = shared.value
        shard = int(frame["shard"].iloc[0])
        ids = np.frombuffer(_read(store.root, f"{store.shards[shard]}.ids"), f"<u{store.width}")
        starts = np.frombuffer(_read(store.root, f"{store.shards[shard]}.off"), "<u8").astype(np.int64)
        which = np.repeat(np.arange(len(frame)), frame["rows"])
        row = frame["row"].to_numpy()[which] + np.arange(len(which)) - np.repeat(np.cumsum(frame["rows"]) - frame["rows"], frame["rows"]).to_numpy()
        begin, end = starts[row], starts[row + 1]
        payload = [ids[a:b].astype("<u4").tobytes() for a, b in zip(begin, end)]
        return pd.DataFrame(
            {"key": frame["key"].iloc[which], "start": store.first_ids[shard] + begin, "n_tokens": end - begin, "ids": payload}
        )

    h1, h2 = _hashes(F.col("key"))
    asked = keys.select(F.col(key).alias("key")).distinct().select("key", h1.alias("h1"), h2.alias("h2"))
    asked = asked.withColumn("bucket", _bucket(store.buckets))
    found = asked.groupBy("bucket").applyInPandas(search, f"key {kind}, shard int, row long, rows long")
    schema = f"key {kind}, start long, n_tokens long, ids binary"
    return found.groupBy("shard").applyInPandas(read, schema).withColumnRenamed("key", key)


def encoded_documents(docs: DataFrame, layout: Layout, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write a store of `docs` and read every document back by its key: key, start, n_tokens, ids_crc32."""
    store = write_store(docs, layout, key, text)
    rows = read_documents(docs.select(key), store, key)
    return rows.select(key, "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

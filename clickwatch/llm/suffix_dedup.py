"""Removal of every byte that lies in a string of `length` bytes which also starts earlier in the corpus.

All texts are one sequence of suffixes; what must be found is runs of suffixes that share
their first `length` bytes. A Burrows-Wheeler transform of the whole corpus is not built in one
place. It is built in blocks that no shared string can straddle:

1. Every string of `length` bytes (a window) has an anchor, the `gram` bytes in it of the smallest
   hash, the leftmost of equals, so equal windows have equal anchors. Consecutive windows of one anchor are a run.
2. Runs whose anchor is met once in the corpus share nothing and go no further. The others
   are read from the texts, equal contents are folded to their earliest place, and all
   contents of an anchor come to one block.
3. A block joins its contents by a byte that UTF-8 does not use, sorts its suffixes and
   takes the transform. Intervals of equal prefixes are then extended backwards, breadth
   first: strings of one byte, then of two, and so on; where the interval of a string of n + 1 bytes
   ends at a border not yet seen, the common prefix there has n bytes. It stops after `length`
   bytes: borders not seen by then have a longer common prefix, and what lies between seen ones
   is a group of equal windows. All but the earliest window of a group start earlier elsewhere.
4. A document's windows in shared runs, less those that are first of their group or
   content, give its removed bytes.

An anchor met often (a line that a third of all documents hold) has many different contents.
Its windows are split by how far the anchor is from their start, in 2 to 128 classes,
the more the oftener it is met, and by the bytes that all windows of the class share: the
most frequent anchors are split by the whole window. So a block never grows with one anchor, and nothing is left out.

Defined cases: a null text is empty; a null id is smaller than all others; rows of one id are in the order
of a 64-bit hash of id and text, by which documents are also told apart; of rows repeating both, one
is the earlier; a text shorter than `length` keeps all its bytes; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickwatch.session import stage, use_all_cores


@dataclass(frozen=True)
class Repeats:
    length: int = 100
    gram: int = 24
    block_bytes: int = 1 << 18
    often: int = 1024  # an anchor met more often is split


_NO_ID = -(1 << 63)
#: bytes hashed at once (few enough for the cache; positions take 24 bits), and windows of a piece of a longer text
_GROUP, _PIECE = 1 << 18, 1 << 18
_BORDER = 0xFF  # not used by UTF-8
_LENGTH_BITS = 20  # of a run's number of windows, behind its start
_CLASS_BITS = 7
_PLACE = np.uint64((1 << 24) - 1)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93], np.uint64)


# ---- anchors


def _expanded(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (size[0] of them), first[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view("<u8")[:, 0]
    count = len(data) - gram + 1
    h = words[:count] * _MIX[0]
    for step in range(8, gram, 8):
        at = min(step, gram - 8)
        h += (words[at : at + count] ^ (h >> np.uint64(31))) * _MIX[step // 8 % 4]
    h ^= h >> np.uint64(32)
    h *= _MIX[1]
    h ^= h >> np.uint64(29)
    return h


def anchors(texts: list[bytes], how: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of every text: text, start, anchor hash and anchor start, by text and start.

    Together the texts may have at most `_GROUP` + `_PIECE` bytes.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    windows = np.maximum(sizes - how.length + 1, 0)
    if not windows.any():
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    hashes = _gram_hashes(data, how.gram)
    smallest = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span, wide = 1, how.length - how.gram + 1
    while span < wide:
        step = min(span, wide - span)
        smallest = np.minimum(smallest[:-step], smallest[step:])
        span += step
    begins = np.cumsum(sizes) - sizes
    place = _expanded(begins, windows)
    text = np.repeat(np.arange(len(texts)), windows)
    at = (smallest[place] & _PLACE).astype(np.int64)
    return text, place - begins[text], hashes[at], at - begins[text]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns changes."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def runs(texts: list[bytes], how: Repeats) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows of one anchor hash, a group of texts after the other: text, start, windows, hash, anchors.

    A run has several anchors, and may repeat windows within itself, where a text has a short period.
    """
    pieces: list[tuple[int, int, bytes]] = []
    held = 0

    def found():
        of, start, key, anchor = anchors([p[2] for p in pieces], how)
        if not len(of):
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        first = _starts(of, key, start >> (_LENGTH_BITS - 1))
        count = np.diff(np.append(first, len(of)))
        new = np.zeros(len(of), np.int64)
        new[_starts(of, anchor)] = 1
        new[first] = 1
        met = np.add.reduceat(new, first)
        of = of[first]
        number, offset = (np.array([p[i] for p in pieces], np.int64) for i in range(2))
        return number[of], start[first] + offset[of], count, key[first], met

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - how.length + 1), _PIECE):
            pieces.append((i, at, text[at : at + _PIECE + how.length - 1]))
            held += len(pieces[-1][2])
            if held >= _GROUP:
                yield found()
                pieces, held = [], 0
    if pieces:
        yield found()


# ---- a block


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of `data` in the order of at least their first `depth` bytes.

    Sorted by eight bytes, then by twice as many each round; only rotations not yet told apart are sorted again.
    """
    n = len(data)
    padded = np.concatenate([data, np.resize(data, 8)])
    keys = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1)).copy().view(">u8")[:, 0].astype(np.uint64)
    order, known = np.argsort(keys), 8
    keys, rows = keys[order], np.arange(n)
    rank = np.empty(n, np.int64)  # the first row of the rotations equal so far
    while True:
        new = np.append(True, keys[1:] != keys[:-1])
        rank[order[rows]] = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
        alike = ~new
        alike[:-1] |= ~new[1:]
        rows = rows[alike]
        if known >= depth or not len(rows):
            return order
        tied = order[rows]
        keys = rank[tied] * n + rank[(tied + known) % n]
        again = np.argsort(keys)
        order[rows], keys = tied[again], keys[again]
        known *= 2


def seen_borders(transform: np.ndarray, length: int) -> np.ndarray:
    """True at row i if rows i - 1 and i share fewer than `length` bytes; rows whose first `length`
    bytes hold the border byte are not told apart."""
    n = len(transform)
    by_byte = np.argsort(transform, kind="stable")
    step = np.empty(n, np.int64)  # row of the suffix that is longer by the byte before
    step[by_byte] = np.arange(n)
    same = transform[by_byte[1:]] == transform[by_byte[:-1]]
    before, after = np.full(n, -1), np.full(n, n)
    before[by_byte[1:][same]] = by_byte[:-1][same]
    after[by_byte[:-1][same]] = by_byte[1:][same]
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    counts = np.bincount(transform, minlength=256)
    ends = np.cumsum(counts)
    real = np.flatnonzero(counts[:_BORDER])
    low, high = (ends - counts)[real], ends[real]
    border[high] = True
    for _ in range(1, length):
        size = high - low
        lone = low[size == 1]  # one row: one byte before it
        lone = step[lone[transform[lone] != _BORDER]]
        low, high, size = low[size > 1], high[size > 1], size[size > 1]
        rows, of = _expanded(low, size), np.repeat(np.arange(len(low)), size)
        byte = transform[rows]
        # every different byte before an interval once, by its first and by its last row
        first = (before[rows] < low[of]) & (byte != _BORDER)
        last = (after[rows] >= high[of]) & (byte != _BORDER)
        kind = of * 256 + byte
        begin = step[rows[first][np.argsort(kind[first], kind="stable")]]
        end = step[rows[last][np.argsort(kind[last], kind="stable")]] + 1
        begin, end = np.concatenate([begin, lone]), np.concatenate([end, lone + 1])
        new = ~border[end]
        low, high = begin[new], end[new]
        if not len(low):
            break
        border[high] = True
    return border[:n]


def first_windows(contents: list[bytes], document: np.ndarray, start: np.ndarray, how: Repeats):
    """(content, offset, windows): ranges of windows that start nowhere earlier.

    `document` and `start` give the order of the contents' windows.
    """
    sizes = np.array([len(c) for c in contents], np.int64)
    data = np.frombuffer(bytes([_BORDER]) + bytes([_BORDER]).join(contents), np.uint8)
    order = suffix_order(data, how.length + 1)
    border = seen_borders(data[order - 1], how.length)
    begins = np.cumsum(sizes + 1) - sizes
    windows = sizes - how.length + 1
    place = _expanded(begins, windows)
    content = np.repeat(np.arange(len(contents)), windows)
    # rank of every window: document, then place in it
    rank = np.full(len(data), -1, np.int64)
    rank[place] = np.argsort(np.lexsort([start[content] + place - begins[content], document[content]]))
    ranks = rank[order]
    whole = ranks >= 0
    border |= ~whole
    border[1:] |= ~whole[:-1]
    groups = np.flatnonzero(border)
    earliest = np.minimum.reduceat(ranks, groups)
    is_first = np.zeros(len(data) + 1, bool)
    is_first[order] = whole & (ranks == np.repeat(earliest, np.diff(np.append(groups, len(ranks)))))
    change = np.flatnonzero(is_first[1:] != is_first[:-1]) + 1
    begin, end = change[::2], change[1::2]
    of = np.searchsorted(begins, begin, "right") - 1
    return of, begin - begins[of], end - begin


# ---- jobs


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def _packed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, id, row hash, number of bytes and compressed text of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [packer.compress(t.as_buffer()) for t in batch.column(4)]
            arrays = [*[batch.column(i) for i in range(4)], pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "id", "row", "n_bytes", "packed"])

    rows = _rows(docs, key, text)
    return rows.mapInArrow(pack, f"doc {kind}, id long, row long, n_bytes long, packed binary")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    number = F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("id")
    rows = docs.select(F.col(key).alias("doc"), number, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    row = F.xxhash64("id", "text").alias("row")
    return use_all_cores(rows).select("doc", "id", row, F.octet_length("text").cast("long").alias("n_bytes"), "text")


def shared_runs(docs: DataFrame, how: Repeats, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of every document (row) whose anchor is met more than once, as (place, key, times) structs."""
    rows = _rows(docs, key, text).filter(F.col("n_bytes") >= how.length).select("row", "text")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            for _, _, _, key, met in runs(texts, how):
                yield pa.RecordBatch.from_arrays([_signed(key), pa.array(met)], names=["key", "met"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0).to_numpy()
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            for of, start, windows, key, _ in runs(texts, how):
                place = (start << _LENGTH_BITS) | windows
                yield pa.RecordBatch.from_arrays([_signed(key), pa.array(row[of]), pa.array(place)], names=["key", "row", "place"])

    met = rows.mapInArrow(keys, "key long, met long").groupBy("key").agg(F.sum("met").alias("times"))
    repeated = stage(met.filter("times > 1"), "anchors")
    found = rows.mapInArrow(places, "key long, row long, place long").join(repeated, "key")
    # a set: rows repeating id and text give the same runs
    listed = found.groupBy("row").agg(F.collect_set(F.struct("place", "key", "times")).alias("runs"))
    return stage(listed, "shared-runs")


def _run_columns(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row number, start, windows, key and times of the runs of a batch."""
    fields = column.flatten()
    of = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    place, key, times = (fields.field(name).to_numpy() for name in ("place", "key", "times"))
    return of, place >> _LENGTH_BITS, place & ((1 << _LENGTH_BITS) - 1), key, times


def _split_windows(contents: list[bytes], keys: list[int], depth: list[int], how: Repeats):
    """Windows of runs of a frequent anchor, split: (content, offset, windows, key)."""
    of, start, _, anchor = anchors(contents, how)
    deep = np.array(depth)[of]
    kind = (anchor - start) >> (_CLASS_BITS - deep)
    first = _starts(of, anchor, kind)
    count = np.diff(np.append(first, len(of)))
    shift = _CLASS_BITS - deep[first]
    nearest = kind[first] << shift
    farthest = nearest + (1 << shift) - 1
    low, high = anchor[first] - nearest, anchor[first] + how.length - np.minimum(farthest, how.length - how.gram)
    for i, offset, windows, a, b, group in zip(
        of[first].tolist(), start[first].tolist(), count.tolist(), low.tolist(), high.tolist(), kind[first].tolist()
    ):
        digest = xxhash.xxh64_intdigest(b"%d %d %d " % (keys[i], depth[i], group) + contents[i][a:b])
        yield i, offset, windows, digest - (1 << 64) if digest >> 63 else digest


def _contents(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Different contents of runs with their earliest place in the batch: key, content, id, row, start."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = [unpacker.decompress(t) for t in batch.column(2).to_pylist()]
        earliest: dict[tuple[int, bytes], tuple[int, int, int]] = {}

        def add(key: int, content: bytes, place: tuple[int, int, int]) -> None:
            held = earliest.get((key, content))
            if held is None or place < held:
                earliest[key, content] = place

        of, start, windows, key, times = _run_columns(batch.column(3))
        depth = np.clip(np.ceil(np.log2(times / how.often)), 0, _CLASS_BITS).astype(np.int64)
        frequent: list[tuple[bytes, int, int, tuple[int, int, int]]] = []
        for i, at, n, k, d in zip(of.tolist(), start.tolist(), windows.tolist(), key.tolist(), depth.tolist()):
            content = texts[i][at : at + n + how.length - 1]
            if d:
                frequent.append((content, k, d, (ids[i], rows[i], at)))
            else:
                add(k, content, (ids[i], rows[i], at))
        held = 0
        begin = 0
        for end, run in enumerate(frequent, 1):
            held += len(run[0])
            if held >= _PIECE or end == len(frequent):
                part = frequent[begin:end]
                whole = [run[0] for run in part]
                for i, offset, n, k in _split_windows(whole, [r[1] for r in part], [r[2] for r in part], how):
                    place = part[i][3]
                    add(k, whole[i][offset : offset + n + how.length - 1], (*place[:2], place[2] + offset))
                begin, held = end, 0
        columns = list(zip(*[(k, c, *place) for (k, c), place in earliest.items()])) or [[]] * 5
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["key", "content", "id", "row", "start"])


def _firsts(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Blocks of whole keys, given in order of the key: ranges of first windows as row, start, windows."""
    block: dict[bytes, tuple[int, int, int]] = {}
    size, last = 0, None

    def solved() -> pa.RecordBatch:
        contents = list(block)
        ids, rows, start = (np.array(c, np.int64) for c in zip(*block.values()))
        # documents in order of id and row
        order = np.lexsort([rows, ids])
        new = np.append(False, (ids[order][1:] != ids[order][:-1]) | (rows[order][1:] != rows[order][:-1]))
        document = np.empty(len(ids), np.int64)
        document[order] = np.cumsum(new)
        of, offset, windows = first_windows(contents, document, start, how)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[of]), pa.array(start[of] + offset), pa.array(windows)], names=["row", "start", "windows"]
        )

    for batch in batches:
        keys, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        places = zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)])
        for key, content, place in zip(keys, contents, places):
            if key != last and size >= how.block_bytes:
                yield solved()
                block, size = {}, 0
            last = key
            held = block.get(content)
            if held is None:
                size += len(content) + 1
            if held is None or place < held:
                block[content] = place
    if block:
        yield solved()


def _removed(start: np.ndarray, windows: np.ndarray, first_start: np.ndarray, first_windows: np.ndarray, length: int) -> np.ndarray:
    """Removed spans (begin, end in turn) of a document: its shared windows but for the first ones."""
    places = np.concatenate([start, start + windows, first_start, first_start + first_windows])
    change = np.repeat([1, -1, -1, 1], [len(start), len(start), len(first_start), len(first_start)])
    order = np.argsort(places, kind="stable")
    places = places[order]
    last = np.append(places[1:] != places[:-1], True)
    covered, places = np.cumsum(change[order])[last] > 0, places[last]
    edge = np.flatnonzero(covered != np.append(False, covered[:-1]))
    begin, end = places[edge[::2]], places[edge[1::2]] + length - 1
    apart = begin[1:] > end[:-1]
    return np.stack([begin[np.append(True, apart)], end[np.append(apart, True)]], axis=1).ravel() if len(begin) else begin


def removed_spans(docs: DataFrame, how: Repeats, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row (hash of id and text) and spans (begin and end, in bytes, in turn) of documents that lose bytes."""
    listed = shared_runs(docs, how, key, text)
    texts = _packed_texts(docs, key, text).select("id", "row", "packed").join(listed, "row").select("id", "row", "packed", "runs")
    contents = texts.mapInArrow(lambda b: _contents(b, how), "key long, content binary, id long, row long, start long")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    blocks = max(2 * cores, 4 * listed.rdd.getNumPartitions())
    ordered = contents.repartition(blocks, "key").sortWithinPartitions("key")
    firsts = ordered.mapInArrow(lambda b: _firsts(b, how), "row long, start long, windows long")
    firsts = firsts.groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("firsts"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, start, windows, _, _ = _run_columns(batch.column(1))
            of_first = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(2).offsets.to_numpy()))
            pairs = batch.column(2).flatten()
            first_start, first_windows = pairs.field("start").to_numpy(), pairs.field("windows").to_numpy()
            edges = np.searchsorted(of, np.arange(batch.num_rows + 1))
            first_edges = np.searchsorted(of_first, np.arange(batch.num_rows + 1))
            found = []
            for (a, b), (c, d) in zip(zip(edges, edges[1:]), zip(first_edges, first_edges[1:])):
                found.append(_removed(start[a:b], windows[a:b], first_start[c:d], first_windows[c:d], how.length))
            kept = np.array([len(f) > 0 for f in found], bool)
            lists = pa.array([f.tolist() for f in found if len(f)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept)), lists], names=["row", "spans"])

    none = F.from_json(F.lit("[]"), "array<struct<start:long,windows:long>>")
    both = listed.join(firsts, "row", "left").select("row", "runs", F.coalesce("firsts", none).alias("firsts"))
    return stage(both.mapInArrow(spans, "row long, spans array<long>"), "spans")


def deduplicated(docs: DataFrame, how: Repeats = Repeats(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 and spans of every document."""
    kind = docs.schema[key].dataType.simpleString()
    spans = removed_spans(docs, how, key, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, n_spans, digests = [], [], []
            for packed, edges in zip(batch.column(3), batch.column(4).to_pylist()):
                content, digest, at = memoryview(unpacker.decompress(packed.as_buffer())), hashlib.sha256(), 0
                pairs = list(zip(edges[::2], edges[1::2])) if edges else []
                for begin, end in pairs:
                    digest.update(content[at:begin])
                    at = end
                digest.update(content[at:])
                removed.append(sum(end - begin for begin, end in pairs))
                n_spans.append(len(pairs))
                digests.append(digest.hexdigest())
            columns = [*[batch.column(i) for i in range(3)], pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64())]
            columns += [pa.array(digests, pa.string()), batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    packed = _packed_texts(docs, key, text).select("doc", "row", "n_bytes", "packed").join(spans, "row", "left")
    packed = packed.select("doc", "row", "n_bytes", "packed", "spans")
    schema = f"doc {kind}, row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    once = packed.mapInArrow(cut, schema)
    # of rows that repeat id and text, all but one start later: counted per task, the first task's first row is the earlier
    counted = once.withColumn("task", F.spark_partition_id()).groupBy(*names, "task").agg(F.count(F.lit(1)).alias("rows"))
    is_first = F.row_number().over(Window.partitionBy("row").orderBy("task")) == 1
    copies = counted.withColumn("is_first", is_first).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    gone = (F.col("n_bytes") >= how.length) & ~(F.col("is_first") & (F.col("copy") == 1))
    empty = hashlib.sha256(b"").hexdigest()
    return copies.select(
        F.col("doc").alias(key),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(gone, F.lit(empty)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(gone, F.array(F.lit(0).cast("long"), F.col("n_bytes"))).otherwise(F.col("spans")).alias("spans"),
    )

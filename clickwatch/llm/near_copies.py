"""Near copies by five-word Jaccard similarity: SimHash and MinHash lists find candidates, exact sets decide.

Two texts are near copies if the sets of their five-word shingles have a Jaccard similarity of
at least `similarity`. Texts of equal words (ASCII case and white space aside) are folded
first, so exact copies cost nothing. Every pair that meets in a list is decided on the sets of
64-bit shingle hashes, and what is linked is joined to groups by star components.

First comes the method of `simhash` with five-word fingerprints: lists under positional bytes, the tally
of shared ones, the check of at most `simhash.MAX_BITS` differing bits. Its links, checked on the sets, are the closest copies (a pair
of similarity 0.8 differs in some ten bits of 64, which no list of whole bytes finds). For the
others, texts are listed under `BANDS` keys of `ROWS` MinHash values each; a pair of similarity s
meets with probability 1 - (1 - s**ROWS)**BANDS, 0.9998 at 0.8.

Lists do not emit all their pairs. A list and the sets of its texts are dealt to one task, and a text
is compared with all the list only while it is outside the list's largest group; a list whose texts have one
root is done before its sets travel. The bands are taken in turns, and lists of the same texts are taken once. So a
group of copies costs a few comparisons a text, any pair in two groups is compared, and the
result is that of all pairs that meet. A long list is worked on in parts: each by itself, then the texts outside its
largest group, in rounds, with all parts.

Defined cases: a text of fewer words than a shingle is one shingle; null, empty and blank texts
are copies of one another; the smallest id of a group stays (null last), one row of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.llm import simhash
from clickwatch.llm.common import free_name, text_key
from clickwatch.llm.components import connected_components
from clickwatch.session import stage

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 4
_BLOCK = 1 << 12  # shingles whose MinHash values are computed at once
_RANDOM = np.random.RandomState(42)
_XOR, _ODD = (_RANDOM.randint(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
LISTED = "node string, n int, fp long, bands array<long>"
_TURNS = (0, 4, BANDS)  # bands that are taken together
_PART = 4096  # texts of a part of a list
_SHINGLES = 1 << 19  # shingles of a part of a list, and of the lists that one group of rows holds, about


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and white space only


def shingles(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(width, len(words))
    cuts = zip(starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist())
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b]) for a, b in cuts], np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        least = np.minimum(least, ((hashes[at : at + _BLOCK, None] ^ _XOR) * _ODD).min(axis=0))
    keys = [xxhash.xxh64_intdigest(row.tobytes()) for row in least.reshape(BANDS, ROWS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def fingerprint(hashes: np.ndarray) -> int:
    """The SimHash of a text: bits set in over half of its shingle hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def _listed(text: Column) -> Column:
    """struct: a 128-bit hash of the words, the number of distinct shingles, the fingerprint and the band keys."""

    @F.pandas_udf(LISTED)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            hashes = shingles(words := words_of(t))
            rows.append((xxhash.xxh3_128_hexdigest(b" ".join(words)), len(hashes), fingerprint(hashes), band_keys(hashes)))
        return pd.DataFrame(rows, columns=["node", "n", "fp", "bands"])

    return of(text)


def _sets(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(words_of(t)).view(np.int64) for t in texts], dtype=object)

    return of(text)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of `pairs` (a, b) whose sets are similar."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("left")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("right")), "b"
    )
    common = F.size(F.array_intersect("left", "right"))
    return both.filter(common / (F.size("left") + F.size("right") - common) >= similarity).select("a", "b")


def spanning_links(sets: list[np.ndarray], roots: list[str], asked: list[bool], similarity: float) -> Iterator[tuple[int, int]]:
    """Links among the texts of a list that, with `roots`, give the groups of all its similar pairs.

    Only pairs with a text that is `asked` count. If all are, a text in the largest group is not compared: those outside are.
    """
    number = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    if len(number) < 2:
        return
    group = np.array([number[r] for r in roots])  # of every text
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    ends = np.cumsum(sizes)
    _, shingle, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    having = np.repeat(np.arange(len(sets)), sizes)[np.argsort(shingle, kind="stable")]  # texts by shingle
    begins = np.cumsum(counts) - counts
    central = np.add.reduceat(counts[shingle], ends - sizes) / sizes  # shares most with the others
    waiting, every = np.array(asked), all(asked)
    while waiting.any():
        members = np.bincount(group)
        if members.max() == len(group):
            return
        open_ = waiting & (group != members.argmax()) if every and members.max() > 1 else waiting
        if not open_.any():
            return
        pick = int(np.where(open_, central, -1.0).argmax())
        waiting[pick] = False
        own = shingle[ends[pick] - sizes[pick] : ends[pick]]
        long = counts[own]
        at = np.repeat(begins[own] - (np.cumsum(long) - long), long) + np.arange(long.sum())
        common = np.bincount(having[at], minlength=len(sets))
        near = (common / (sizes + sizes[pick] - common) >= similarity) & (group != group[pick])
        _, first = np.unique(group[near], return_index=True)
        for other in np.flatnonzero(near)[first].tolist():
            yield pick, other
            group[group == group[other]] = group[pick]


def _list_links(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of the lists in `rows` (list, node, n, root, asked), each of which fits a task."""
    total = rows.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    bundle = F.pmod(F.xxhash64("list"), F.lit(1 + total // _SHINGLES)).alias("bundle")

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, own in frame.groupby("list", sort=False):
            nodes, arrays = own["node"].tolist(), own["set"].tolist()
            pairs = spanning_links(arrays, own["root"].tolist(), own["asked"].tolist(), similarity)
            found += [(nodes[i], nodes[j]) for i, j in pairs]
        return pd.DataFrame(found, columns=["a", "b"], dtype=object)

    named = rows.join(sets, "node").select(bundle, "list", "node", "root", "asked", "set")
    return named.groupBy("bundle").applyInPandas(of, "a string, b string")


def _joined(links: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links, and (node, root) of every text linked by them."""
    links = links.unionByName(more)
    return links, stage(connected_components(links), "near-roots")


def _rooted(index: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return index.withColumn("root", F.col("node"))
    return index.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open(rooted: DataFrame) -> DataFrame:
    """The rows of `rooted` (band, key, node, n, root) in lists of two roots or more, of lists of the same texts one, and their parts."""
    hashes = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"digest{i}") for i in range(2)]
    totals = [F.count(F.lit(1)).alias("members"), F.sum(F.col("n").cast("long")).alias("shingles")]
    lists = rooted.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"), *totals, *hashes)
    lists = lists.filter("low < high").groupBy("members", "shingles", "digest0", "digest1")
    lists = lists.agg(F.min(F.struct("band", "key")).alias("l")).select("l.*", "members", "shingles")
    parts = F.expr(f"int(1 + greatest(members div {_PART}, shingles div {_SHINGLES}))")
    lists = lists.withColumn("parts", parts).withColumn("fit", F.expr("int(greatest(1, members div parts))"))
    return rooted.join(lists.select("band", "key", "parts", "fit"), ["band", "key"])


def _similar_fingerprints(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts whose fingerprints `simhash` links, by one text of every fingerprint, and equal ones."""
    nodes = nodes.filter("n > 0")
    of = nodes.groupBy("fp").agg(F.min("node").alias("head"))
    links = simhash.links(of.select("fp"))
    a, b = of.select(F.col("fp").alias("a"), F.col("head").alias("x")), of.select(F.col("fp").alias("b"), F.col("head").alias("y"))
    between = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return between.unionByName(nodes.join(of, "fp").filter("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")))


def _roots(
    index: DataFrame, sets: DataFrame, alike: DataFrame, similarity: float, picks: int, growth: int
) -> DataFrame:
    """(node, root) of every linked text of `index` (band, key, node, n) or `alike` (a, b)."""
    links, roots = stage(_verified(alike, sets, similarity), "near-links"), None
    part = F.pmod(F.xxhash64("node", F.lit("part")), "parts").cast("int").alias("p")

    def named(rows: DataFrame, *parts: str, asked: bool) -> DataFrame:
        name = F.concat_ws(":", *[F.col(c).cast("string") for c in ("band", "key", *parts)])
        return rows.select(name.alias("list"), "node", "n", "root", F.lit(asked).alias("asked"))

    for low, high in zip(_TURNS, _TURNS[1:]):
        turn = index.filter((F.col("band") >= low) & (F.col("band") < high))
        rows = stage(_open(_rooted(turn, roots)), "near-open")
        own = named(rows.withColumn("p", part), "p", asked=True)
        links, roots = _joined(links, stage(_list_links(own, sets, similarity), "near-links"))

        # long lists: texts outside the largest group are compared with all parts, more in every round
        long, asked, slots = rows.filter("parts > 1").drop("root"), None, picks
        while not long.isEmpty():
            rooted = stage(_rooted(long, roots), "near-long")
            groups = rooted.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("size"))
            largest = groups.groupBy("band", "key").agg(F.max_by("root", F.struct("size", "root")).alias("main"))
            outside = rooted.join(largest, ["band", "key"]).filter("root != main")
            outside = outside if asked is None else outside.join(asked, ["band", "key", "node"], "left_anti")
            slot = F.pmod(F.xxhash64("node"), F.lit(slots)).alias("slot")
            least = F.min(F.struct("node", "n", "root", "parts", "fit")).alias("c")
            chosen = stage(outside.groupBy("band", "key", slot).agg(least).select("band", "key", "slot", "c.*"), "near-chosen")
            if chosen.isEmpty():
                break
            # a part meets as many chosen texts at once as it has texts itself
            chosen = chosen.withColumn("block", F.expr("int(slot div fit)"))
            everywhere = chosen.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            held = rooted.join(chosen.select("band", "key", "node"), ["band", "key", "node"], "left_anti").withColumn("p", part)
            held = held.join(chosen.select("band", "key", "block").distinct(), ["band", "key"])
            both = named(held, "p", "block", asked=False).unionByName(named(everywhere, "p", "block", asked=True))
            links, roots = _joined(links, stage(_list_links(both, sets, similarity), "near-links"))
            done = chosen.select("band", "key", "node")
            asked, slots = done if asked is None else asked.unionByName(done), slots * growth
    return roots


def one_of_each(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    picks: int = 1,
    growth: int = 16,
) -> DataFrame:
    """The rows of `docs`, all columns, that stand for their group of near copies.

    `picks` texts of a long list are compared with all its parts in the first round, `growth` times as many
    in every further round; they change the work, not the result.
    """
    this = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), text_key(F.col(text)).alias("hash"))
    tagged = docs.select(this.alias("this"), _listed(F.col(text)).alias("l")).select("this", "l.*")
    folded = tagged.groupBy("node").agg(F.min("this").alias("this"), *[F.first(c).alias(c) for c in ("n", "fp", "bands")])
    nodes = stage(folded, "near-nodes")
    index = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))

    # the sets of texts that meet another, each made from one row that has it
    alike = stage(_similar_fingerprints(nodes), "near-alike")
    met = index.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    index = stage(index.join(met.select("band", "key"), ["band", "key"]), "near-met")
    meeting = index.select("node").union(alike.select("a")).union(alike.select("b")).distinct()
    needed = meeting.join(nodes, "node").select("node", "this")
    one = docs.select(this.alias("this"), F.col(text).alias("text"))
    same = (
        F.col("x.this.id").eqNullSafe(F.col("y.this.id")) & F.col("x.this.hash").eqNullSafe(F.col("y.this.hash"))
    )
    texts = one.alias("x").join(needed.alias("y"), same).select("y.node", "x.text").dropDuplicates(["node"])
    sets = stage(texts.select("node", _sets(F.col("text")).alias("set")), "near-sets")

    roots = _roots(index, sets, alike, similarity, picks, growth)
    grouped = nodes.select("node", "this").join(roots, "node", "left")
    heads = grouped.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("this").alias("head")).select("head")
    hashed, nth = free_name(docs, "hash"), free_name(docs, "nth")
    wide = docs.withColumn(hashed, text_key(F.col(text)))
    kept = wide.join(heads, wide[doc_id].eqNullSafe(heads["head.id"]) & wide[hashed].eqNullSafe(heads["head.hash"]))
    first = F.row_number().over(Window.partitionBy(wide[doc_id], wide[hashed]).orderBy(wide[hashed]))
    return kept.select(*[wide[c] for c in docs.columns], first.alias(nth)).filter(F.col(nth) == 1).drop(nth)

"""Exact Jaccard join of documents on word shingles: who is linked, and in which component.

Texts become sorted arrays of 64-bit shingle hashes. Documents with equal arrays are one
class, and only classes are compared.

*Groups.* Two sets with a Jaccard similarity of t share one of the first (1 - t) n + 1 elements
of each, in any fixed order. The order puts shingles that several documents of a sample hold
last, the most frequent at the very end, so sets are looked up by what is rare in them; the
order decides the speed, never the result. Classes that meet in an element form a group; equal
groups are taken once. Groups are ordered by set size and only pairs of compatible size are
looked at. If an element is the first that two sets share, they share no more than it and
what follows it in either; pairs that this leaves too little are not given. The group of
their first shared element gives every linked pair.

*Bound.* Each set has a bitmap, its elements hashed to a number of bits that follows the size
band (a power of two, so bitmaps of neighbouring bands fold onto each other). Bits that one
has and the other lacks are elements that cannot be shared, which bounds the intersection
from above. A small group is one row and gives its pairs that the bound lets pass. A large one
stays rows and is cut into blocks of neighbouring sizes. Blocks make tiles of bounded size, and
a tile gives pairs that connect its classes as all its passing pairs would. Each block is a tile
first, with one class of some blocks before it. Classes that these tiles have connected are not
compared again: the largest part of a group is only held against the classes outside of it,
in tiles of every two blocks of compatible sizes. So near copies of one text cost about linear
work, and only what the first tiles leave apart is tiled in full.

*Families.* What passing pairs connect is a family: no link leaves it. Only then are the sets
themselves brought in, once for each family that fits a block, else in tiles as above, and
what the bound lets pass is intersected exactly, as sorted arrays. A tile gives links that
connect its classes as all its links would, so no result grows with the square of a group.

Classes are told apart by a 64-bit digest of their arrays.

Defined cases: a null text, or one without words, has an empty set and is linked with
nothing. Fewer words than a shingle make one shingle of all words. Rows that share an id are
one node, linked if any of their texts is; each row keeps its own set size. A null id is
linked with nothing and has a null component. An empty table gives no rows. Whole texts are
read; other columns are not.
"""

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from stratamart.llm.graphs import components, stored
from stratamart.operators.joins import inner_lookup

SHINGLE = 4
PERCENT = 85
#: Documents sampled for the order of shingles, and how many of them must hold one that goes last.
ORDER_SAMPLE = 32_768
FREQUENT = 5
#: Largest group that gives pairs; classes in a block of a larger group or family.
SMALL_GROUP = 128
BLOCK = 256
#: Bits of a bitmap per element, before rounding up to a power of two.
BITS = 4
BLOCK_CHARS = 4_000_000

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
GOLDEN, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * SPREAD
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [WORD.findall((t or "").encode("utf-8", "replace").lower()) for t in texts]
    numbers, distinct = pd.factorize(np.array([*chain.from_iterable(words), None], object)[:-1])
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], np.uint64)
    every = hashed[numbers] if len(numbers) else np.zeros(0, np.uint64)
    sets, at = [], 0
    for found in words:
        own = every[at : at + len(found)]
        at += len(found)
        width = min(size, len(own))
        mixed = np.full(max(0, len(own) - width + 1) if width else 0, width, np.uint64)
        for k in range(width):
            mixed = _mix(mixed * GOLDEN + own[k : k + len(mixed)])
        sets.append(np.unique(mixed))
    return sets


#: Frequent elements, sorted, and the place of each in the order.
Order = tuple[np.ndarray, np.ndarray]


def prefix_of(elements: np.ndarray, frequent: Order, percent: int = PERCENT) -> np.ndarray:
    """The elements that a set must be looked up by, in order: rare ones first."""
    n = len(elements)
    if not n:
        return elements
    length = n - -(-percent * n // 100) + 1
    known, places = frequent
    if len(known):
        at = np.minimum(np.searchsorted(known, elements), len(known) - 1)
        common = known[at] == elements
        last = elements[common][np.argsort(places[at[common]])]
        elements = np.concatenate([elements[~common], last])
    return elements[:length]


def bitmap(elements: np.ndarray) -> np.ndarray:
    """The signature, as 64-bit words; their number is a power of two that follows the size."""
    width = max(64, 1 << (BITS * max(1, len(elements)) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(elements & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def overlap_bound(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> int:
    """At most so many elements can be shared, by the bitmaps."""
    words = min(len(a), len(b))
    a, b = _fold(a, words), _fold(b, words)
    return int(
        min(n_a - np.bitwise_count(a & ~b).sum(dtype=int), n_b - np.bitwise_count(b & ~a).sum(dtype=int))
    )


def reaches(shared: int, n_a: int, n_b: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (n_a + n_b - shared)


def shared_count(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _blocks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    chars = batch["text"].map(lambda text: len(text or "")).cumsum()
    for _, block in batch.groupby(chars // BLOCK_CHARS, sort=True):
        yield block


def _frequent(docs: DataFrame, size: int, sample: int = ORDER_SAMPLE) -> Order:
    """Shingles in several documents of a sample by id hash, and their order by frequency.

    These are at most the sample's shingles / ``FREQUENT``, whatever the size of the corpus.
    """
    share = sample / max(1, docs.count())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in (block for batch in batches for block in _blocks(batch)):
            found = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(block["text"], size)])
            values, n = np.unique(found, return_counts=True)
            yield pd.DataFrame({"element": values.view(np.int64), "n": n})

    limit = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    picked = docs.filter(F.xxhash64("doc_id") <= F.lit(limit))
    rows = (
        picked.mapInPandas(count, "element long, n long")
        .groupBy("element")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .toPandas()
    )
    elements = rows["element"].to_numpy(np.int64).view(np.uint64)
    places = np.empty(len(rows), np.int64)
    places[np.lexsort((elements, rows["n"].to_numpy()))] = np.arange(len(rows))
    by_element = np.argsort(elements)
    return elements[by_element], places[by_element]


def _scan(docs: DataFrame, frequent: Order, size: int, percent: int) -> DataFrame:
    """Per row: size of the set, its digest (the class), its prefix and its bitmap."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in (block for batch in batches for block in _blocks(batch)):
            sets = shingle_sets(block["text"], size)
            yield pd.DataFrame(
                {
                    "doc_id": block["doc_id"].array,
                    "n": [len(s) for s in sets],
                    "node": np.array(
                        [xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64
                    ).view(np.int64),
                    "prefix": [prefix_of(s, frequent, percent).view(np.int64) for s in sets],
                    "bits": [bitmap(s).tobytes() for s in sets],
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(
        task, f"doc_id {kind}, n long, node long, prefix array<long>, bits binary"
    )


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in (block for batch in batches for block in _blocks(batch)):
            sets = [s.tobytes() for s in shingle_sets(block["text"], size)]
            yield pd.DataFrame({"node": block["node"].array, "elements": sets})

    return docs.mapInPandas(task, "node long, elements binary")


def _groups(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Who meets in an element: small groups as arrays by size of set, large ones as rows.

    Members of small groups carry ``at``, the place of the element in their order; equal
    groups are one, without places. Large ones are ``grp, id, n``; of
    equal large groups one is given.
    """
    rows = scanned.select(F.posexplode("prefix").alias("at", "element"), "n", F.col("node").alias("id"))
    # Counting rows is lighter than telling classes apart; groups of one class go below.
    shared = rows.groupBy("element").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    met = inner_lookup(rows, shared, "element")
    members = F.sort_array(F.collect_set(F.struct("n", "id", "at"))).alias("members")
    few = met.filter(F.col("times") <= SMALL_GROUP).groupBy("element").agg(members).select("members")
    few = _once(few.filter(F.size("members") > 1))
    many = met.filter(F.col("times") > SMALL_GROUP).select("element", "id", "n", "at").distinct()
    # Written in one job, so that the rows are dealt out once.
    both = stored(few.unionByName(many, allowMissingColumns=True))
    few = both.filter(F.col("members").isNotNull()).select("members")
    many = both.filter(F.col("members").isNull()).select("element", "id", "n", "at")
    sized = many.groupBy("element").agg(
        F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("id")).alias("digest"),
        F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("digest2"),
    )
    small = sized.filter(F.col("size").between(2, SMALL_GROUP)).select("element")
    more = _once(inner_lookup(many, small, "element").groupBy("element").agg(members).select("members"))
    one = sized.filter(F.col("size") > SMALL_GROUP).groupBy("size", "digest", "digest2")
    large = one.agg(F.min("element").alias("element")).select("element")
    wide = inner_lookup(many.drop("at"), large, "element").withColumnRenamed("element", "grp")
    return few.unionByName(more), wide


def _once(groups: DataFrame) -> DataFrame:
    """Groups with the same members as one; its places are then unknown and count as first."""
    apart = groups.select(
        F.transform("members", lambda m: F.struct(m["n"], m["id"])).alias("who"),
        F.transform("members", lambda m: m["at"]).alias("places"),
    )
    merged = apart.groupBy("who").agg(F.count(F.lit(1)).alias("groups"), F.first("places").alias("places"))

    def member(one, i):
        at = F.when(F.col("groups") == 1, F.get("places", i)).otherwise(0)
        return F.struct(one["n"].alias("n"), one["id"].alias("id"), at.alias("at"))

    return merged.select(F.transform("who", member).alias("members"))


def _small_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs in groups of bounded size that may share enough, by sizes and places."""

    def able(x, y):
        shared = F.least(x["n"] - x["at"], y["n"] - y["at"])
        enough = 100 * shared >= percent * (x["n"] + y["n"] - shared)
        return (y["n"] * percent <= x["n"] * 100) & enough & (y["id"] != x["id"])

    def after(x, i):
        rest = F.slice("members", i + 2, F.lit(SMALL_GROUP))
        fit = F.filter(rest, lambda y: able(x, y))
        return F.transform(
            fit,
            lambda y: F.struct(F.least(x["id"], y["id"]).alias("a"), F.greatest(x["id"], y["id"]).alias("b")),
        )

    pairs = F.flatten(F.transform("members", after))
    return (
        groups.select(F.explode(pairs).alias("p"))
        .select("p.a", "p.b")
        .distinct()
    )


def _in_blocks(members: DataFrame) -> DataFrame:
    """``grp, id, n`` rows with a ``block``: numbers by size of set, about ``BLOCK`` rows each.

    Only sizes and their counts are ordered. Rows of one size are spread by a hash of the id.
    """
    counts = members.groupBy("grp", "n").agg(F.count(F.lit(1)).alias("times"))
    before = Window.partitionBy("grp").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    slot = F.struct("grp", "n").alias("slot")
    starts = counts.select(
        slot, F.coalesce(F.sum("times").over(before), F.lit(0)).alias("start"), "times"
    )
    spread = F.pmod(F.xxhash64("id"), F.ceil(F.col("times") / BLOCK))
    block = (F.floor(F.col("start") / BLOCK) + spread).cast("long").alias("block")
    return inner_lookup(members.select(slot, *members.columns), starts, "slot").select(
        *members.columns, block
    )


def _connected(members: DataFrame, links: Callable[..., DataFrame], percent: int) -> DataFrame:
    """Links that connect the classes of each group as all links within the groups would.

    ``members`` are ``grp, id, n``; ``links`` takes rows of tiles and the columns that name a
    tile. The first tiles are the blocks, each with a class of the blocks 1, 2, 4, ... before
    it. What they connect is not compared again: of each group the largest part so connected
    stands on one side, and only the other classes are tiled, with each other and with it.
    """
    placed = stored(_in_blocks(members))
    blocks = placed.groupBy("grp", "block").agg(F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("id"))
    several = blocks.groupBy("grp").agg(F.max("block").alias("last")).filter("last > 0")
    after = F.transform(
        F.sequence(F.lit(0), F.lit(40)), lambda k: F.col("block") + F.pow(F.lit(2), k).cast("long")
    )
    heads = blocks.join(several, "grp").select(
        "grp", F.explode(F.filter(after, lambda b: b <= F.col("last"))).alias("block"), "id"
    )
    found = links(placed.select("grp", "block", "id").unionByName(heads), ["grp", "block"])
    if several.isEmpty():
        return found
    found = stored(found)
    known = components(found).withColumnRenamed("node", "id")
    wide = inner_lookup(placed, several.select("grp"), "grp").join(known, "id", "left")
    wide = stored(wide.withColumn("component", F.coalesce("component", "id")))
    parts = wide.groupBy("grp", "component").agg(F.count(F.lit(1)).alias("times"))
    largest = parts.groupBy("grp").agg(
        F.max(F.struct("times", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("parts")
    )
    wide = inner_lookup(wide, largest.filter("parts > 1").drop("parts"), "grp")
    columns = ["grp", "id", "n", "component"]
    rest = stored(_in_blocks(wide.filter("component <> largest").select(*columns)))
    sides = rest.withColumn("rest", F.lit(True)).unionByName(
        wide.filter("component = largest").select(*columns, "block").withColumn("rest", F.lit(False))
    )
    spans = sides.groupBy("grp", "rest", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    own = spans.filter("rest").select("grp", F.col("block").alias("own"), F.col("least").alias("from"), F.col("most").alias("to"))
    able = (F.col("least") * percent <= F.col("to") * 100) & (F.col("from") * percent <= F.col("most") * 100)
    tiles = own.join(spans, "grp").filter(able & (~F.col("rest") | (F.col("block") >= F.col("own"))))
    tiles = stored(tiles.select("grp", "own", "rest", "block"))
    names = ["grp", "own", "rest", "block"]
    here = tiles.join(rest.select("grp", F.col("block").alias("own"), "id", "component"), ["grp", "own"])
    there = tiles.filter(~F.col("rest") | (F.col("block") != F.col("own"))).join(
        sides.select("grp", "rest", "block", "id", "component"), ["grp", "rest", "block"]
    )
    rows = here.unionByName(there).select(*names, "id", "component")
    return found.unionByName(links(rows, names))


def _passing(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bitmaps do not rule them out."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fit = [
                reaches(
                    overlap_bound(np.frombuffer(x, np.uint64), n, np.frombuffer(y, np.uint64), m), n, m, percent
                )
                for x, n, y, m in zip(batch["bits_a"], batch["n_a"], batch["bits_b"], batch["n_b"])
            ]
            yield batch.loc[fit, ["a", "b"]]

    def side(name):
        return bitmaps.select(
            F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}")
        )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(task, "a long, b long")


def tile_links(ids: list, sizes: list[int], maps: list[np.ndarray], sets=None, percent: int = PERCENT, known=None) -> list[tuple]:
    """Pairs that connect the classes of a tile as all its links would.

    Without ``sets``, as all its pairs would that the bitmaps let pass. ``known`` are the
    components that links elsewhere lead to.
    """
    n = np.array(sizes, np.int64)
    order = np.argsort(n, kind="stable")
    width = np.array([len(m) for m in maps])
    stacked = {w: np.stack([maps[i] for i in order if width[i] == w]) for w in set(width.tolist())}
    members = {w: np.array([i for i in order if width[i] == w]) for w in stacked}
    folded: dict[tuple[int, int], np.ndarray] = {}
    # Of the component, kept flat.
    root = np.arange(len(ids)) if known is None else np.unique(np.asarray(known), return_inverse=True)[1]
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    links = []
    for i in order:
        for w, others in members.items():
            narrow = min(w, int(width[i]))
            if (w, narrow) not in folded:
                folded[w, narrow] = np.stack([_fold(m, narrow) for m in stacked[w]])
            able = (place[others] > place[i]) & (n[others] * percent <= n[i] * 100) & (root[others] != root[i])
            if not able.any():
                continue
            other, own = folded[w, narrow][able], _fold(maps[i], narrow)
            able = others[able]
            bound = np.minimum(
                n[i] - np.bitwise_count(own & ~other).sum(1, dtype=np.int64),
                n[able] - np.bitwise_count(other & ~own).sum(1, dtype=np.int64),
            )
            for j in able[100 * bound >= percent * (n[i] + n[able] - bound)].tolist():
                if root[j] != root[i] and (
                    sets is None or reaches(shared_count(sets[i], sets[j]), int(n[i]), int(n[j]), percent)
                ):
                    root[root == root[j]] = root[i]
                    links.append((ids[i], ids[j]))
    return links


def _passing_in_tiles(tiles: DataFrame, names: list[str], bitmaps: DataFrame, percent: int) -> DataFrame:
    def task(frame: pd.DataFrame) -> pd.DataFrame:
        maps = [np.frombuffer(b, np.uint64) for b in frame["bits"]]
        known = frame.get("component")
        found = tile_links(frame["id"].tolist(), frame["n"].tolist(), maps, None, percent, known)
        return pd.DataFrame(found, columns=["a", "b"])

    rows = tiles.join(bitmaps.withColumnRenamed("node", "id"), "id")
    return rows.groupBy(*names).applyInPandas(task, "a long, b long")


def _links_in_tiles(tiles: DataFrame, names: list[str], sets: DataFrame, percent: int) -> DataFrame:
    def task(frame: pd.DataFrame) -> pd.DataFrame:
        found = [np.frombuffer(e, np.uint64) for e in frame["elements"]]
        sizes, maps = [len(s) for s in found], [bitmap(s) for s in found]
        known = frame.get("component")
        found = tile_links(frame["id"].tolist(), sizes, maps, found, percent, known)
        return pd.DataFrame(found, columns=["a", "b"])

    rows = tiles.join(sets.withColumnRenamed("node", "id"), "id")
    return rows.groupBy(*names).applyInPandas(task, "a long, b long")


def link(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row: the smallest id that links lead to."""
    rows = docs.select("doc_id", "text")
    scanned = stored(_scan(rows, _frequent(rows, size), size, percent))
    named = scanned.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    # Each class, with the smallest id that has its set.
    classes = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    groups, large = _groups(named)
    bitmaps = named.select("node", "n", "bits").dropDuplicates(["node"])
    passing = _passing(_small_pairs(groups, percent), bitmaps, percent)
    passing = passing.unionByName(
        _connected(large, lambda tiles, names: _passing_in_tiles(tiles, names, bitmaps, percent), percent)
    )
    families = stored(components(passing).join(named.select("node", "n").distinct(), "node"))
    sets = stored(_sets(rows.join(families.join(classes, "node").select("node", "doc_id"), "doc_id"), size))
    members = families.select(F.col("component").alias("grp"), F.col("node").alias("id"), "n")
    links = _connected(members, lambda tiles, names: _links_in_tiles(tiles, names, sets, percent), percent)
    # From classes to ids: several classes may have rows of one id.
    ids = named.select("node", "doc_id").distinct()
    ends = classes.withColumnRenamed("doc_id", "least")
    edges = (
        links.join(ends.select(F.col("node").alias("a"), F.col("least").alias("x")), "a")
        .join(ends.select(F.col("node").alias("b"), F.col("least").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
        .unionByName(
            ids.join(ends, "node").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
        )
    )
    joined = components(edges)
    result = scanned.select("doc_id", "n").join(
        joined, (F.col("doc_id") == F.col("node")) & (F.col("n") > 0), "left"
    )
    return result.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents less those linked, by any chain, with one of a smaller id.

    Rows that share a kept id all stay, as do rows with a null id.
    """
    linked = link(docs, size, percent)
    gone = linked.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")

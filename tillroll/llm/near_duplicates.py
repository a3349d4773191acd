"""Exact near-duplicate join on 5-word shingles, Jaccard similarity 0.8 or more.

1. Texts with equal shingle sets become one set.
2. Sets that share a shingle of their prefixes are candidates; a set's prefix is its
   rarest shingles, as many as two similar sets must share one of.
3. Each set is first compared with one other, a set that shares most of its prefix. That joins groups of near copies at a cost linear in their size.
4. Pairs of sets that are not yet in one component are compared next, all of them,
   so no link between components is lost, and pairs inside one are never listed.

Comparisons run in size-banded tiles: sets of about one size with hashed parity
bitmaps, whose differing bits bound the overlap from above; only pairs that pass get
the exact intersection of their sorted arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices_by_bytes, staged
from tillroll.llm.components import components
from tillroll.llm.shingles import fingerprint, mix, shingle_sets

# Links: 100 * intersection >= 80 * union, so intersection >= 4/9 * (size + size).
NUMERATOR, DENOMINATOR = 4, 9
BINS = 1 << 20  # of the shingle counts that order prefixes
TILE_PAIRS = 1_024
SLICE_BYTES = 1 << 20  # of text whose hashes are computed at a time
FILTER_BITS = 1 << 24  # of the bitmap that says which texts are read again

_NODE = "struct<x:bigint,y:bigint>"


def least_overlap(sizes: int) -> int:
    """The intersection that two sets need, given the sum of their sizes."""
    return -(-NUMERATOR * sizes // DENOMINATOR)


def probe_length(n: int) -> int:
    """Prefix of a set that meets every similar set's `index_length` if that one is no larger."""
    return n - -(-4 * n // 5) + 1


def index_length(n: int) -> int:
    return n - least_overlap(2 * n) + 1


def _frame(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def common_bins(docs: DataFrame, text: str = "text") -> np.ndarray:
    """For each bin of shingle hashes 0, or the binary order of how many texts hold a frequent shingle of it.

    Each task gives what its bins hold beyond their mean and its spread, so that a passage
    which is a little above them in every task adds up, while most bins need no exchange.
    The order decides time, not links, as any one order of shingles is right. The driver
    gets BINS rows at most.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            sets = shingle_sets(batch.column(0))
            every = np.concatenate([np.empty(0, np.uint64), *sets])
            counts += np.bincount((every & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
        beyond = counts - math.ceil(counts.mean() + math.sqrt(counts.mean()))
        often = np.flatnonzero(beyond > 0)
        yield pa.RecordBatch.from_arrays([pa.array(often), pa.array(beyond[often])], names=["bin", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(counted, "bin long, n long")
    level = F.ceil(F.log2(F.sum("n") + 1)).cast("byte")  # its binary order
    got = sums.groupBy("bin").agg(level.alias("level")).withColumn("bin", F.col("bin").cast("int")).toArrow()
    order = np.zeros(BINS, np.uint8)
    order[got["bin"].to_numpy()] = got["level"].to_numpy()
    return order


def bits_for(n: int) -> int:
    """Bits of the bitmap of a set of n shingles, a power of two."""
    return 1 << min(15, max(6, (2 * n - 1).bit_length()))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """64-bit words in which bit h mod `bits_for(n)` is the parity of the shingles hashed there.

    Each shingle that only one of two sets has flips one bit at most, so the bits in
    which two bitmaps differ are no more than the shingles in which the sets differ.
    """
    bits = bits_for(len(shingles))
    places = (mix(shingles) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def folded(words: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap with fewer bits: its halves laid over each other, which keeps the parities."""
    while 64 * len(words) > bits:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def shingled(docs: DataFrame, order: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n, node, bits, prefix` of each row: the set's size, what stands for it, its bitmap and rarest shingles."""
    frame = _frame(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            sets = shingle_sets(batch.column(1))
            prefixes = []
            for s in sets:
                rank = order[(s & np.uint64(BINS - 1)).astype(np.int64)]
                first = np.lexsort((s, rank))[: probe_length(len(s)) if len(s) else 0]
                prefixes.append(s[first])
            maps = pa.array([bitmap(s).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), _nodes(sets), maps, _lists(prefixes)],
                names=["doc_id", "n", "node", "bits", "prefix"],
            )

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(rows, f"doc_id {kind}, n long, node {_NODE}, bits binary, prefix array<bigint>")


def _nodes(sets: list[np.ndarray]) -> pa.Array:
    marks = [fingerprint(s) for s in sets]
    return pa.StructArray.from_arrays([pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1)], names=["x", "y"])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate([np.empty(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _slot(rep: Column) -> Column:
    return F.pmod(F.xxhash64(rep), F.lit(FILTER_BITS))


def _filter_bits(wanted: DataFrame) -> np.ndarray:
    """One bit for each slot that a wanted `rep` falls in; FILTER_BITS bits at any size."""
    slots = wanted.select((_slot(F.col("rep")) + 1).alias("slot"))  # Spark counts from 1
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps.collect():  # buckets of 32768 bits
        at = (row["bucket"] - 1) * 4096
        bits[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return bits


def sets_of(docs: DataFrame, wanted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`sid, shingles` of the wanted sets (`sid, rep, node`), from the texts of the documents `rep`."""
    # A bitmap says which texts are worth reading again, then the join leaves the wanted ones.
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(wanted))
    frame = _frame(docs, doc_id, text).withColumn("slot", _slot(F.col("doc_id")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            slot = batch.column(2).to_numpy(zero_copy_only=False)
            hit = (bits.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            sets = shingle_sets(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _nodes(sets), _lists(sets)], names=["rep", "node", "shingles"]
            )

    kind = frame.schema["doc_id"].dataType.simpleString()
    found = frame.mapInArrow(rows, f"rep {kind}, node {_NODE}, shingles array<bigint>")
    # Repeated rows of one identifier and text give their set twice; equal keys need no further exchange.
    return found.join(wanted, ["rep", "node"]).dropDuplicates(["rep", "node"]).select("sid", "shingles")


def _places(members: pd.Series, ends: pd.Series) -> np.ndarray:
    """Where each pair's end stands among the tile's members."""
    ids = members.to_numpy(dtype=np.int64)
    order = np.argsort(ids)
    return order[np.searchsorted(ids, ends.to_numpy(dtype=np.int64), sorter=order)]


def _possible(key: tuple, members: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """The pairs of a tile whose bitmaps leave room for a link."""
    words = [np.frombuffer(b, np.uint64) for b in members["bits"]]
    bits = 64 * min(map(len, words), default=1)
    maps = np.array([folded(w, bits) for w in words], dtype=np.uint64).reshape(len(words), -1)
    left, right = _places(members["sid"], pairs["left"]), _places(members["sid"], pairs["right"])
    total = pairs["sizes"].to_numpy(dtype=np.int64)
    needed = -(-NUMERATOR * total // DENOMINATOR)
    possible = np.zeros(len(pairs), dtype=bool)
    step = max(1, (64 << 20) // bits)
    for at in range(0, len(pairs), step):
        rows = slice(at, at + step)
        apart = np.bitwise_count(maps[left[rows]] ^ maps[right[rows]]).sum(axis=1, dtype=np.int64)
        possible[rows] = (total[rows] - apart) // 2 >= needed[rows]
    return pairs.loc[possible, ["band", "tile", "left", "right"]]


def _linked(key: tuple, members: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """The pairs of a tile that are links, by exact intersection."""
    sets = [np.asarray(s, dtype=np.int64).view(np.uint64) for s in members["shingles"]]
    left, right = _places(members["sid"], pairs["left"]), _places(members["sid"], pairs["right"])
    linked = np.zeros(len(pairs), dtype=bool)
    for k, (i, j) in enumerate(zip(left.tolist(), right.tolist())):
        both = np.concatenate([sets[i], sets[j]])
        both.sort(kind="stable")  # two sorted runs, so a merge
        overlap = int((both[1:] == both[:-1]).sum())
        linked[k] = overlap >= least_overlap(len(both))
    return pairs.loc[linked, ["left", "right"]].set_axis(["a", "b"], axis=1)


def links_among(docs: DataFrame, pairs: DataFrame, reps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`a, b`: the pairs of sets that are links.

    pairs: `left, right` structs `(n, sid)`, left not larger. A left set with many
    partners stands in several tiles, so no tile grows with a group of copies.
    """
    band = F.floor(F.log(F.col("left.n").cast("double")) / math.log(1.25)).cast("int")
    pairs = staged(pairs.withColumn("band", band), "near-pairs")
    of_band = {r["band"]: r["n"] for r in pairs.groupBy("band").agg(F.count("*").alias("n")).collect()}
    if not of_band:
        return pairs.select(F.col("left.sid").alias("a"), F.col("right.sid").alias("b"))
    slots = F.create_map(*(F.lit(int(x)) for b, n in of_band.items() for x in (b, -(-n // TILE_PAIRS))))
    partners = pairs.groupBy("left").agg(F.count("*").alias("partners"))
    share = F.pmod(F.xxhash64("right.sid"), F.ceil(F.col("partners") / (TILE_PAIRS // 2)))
    tile = F.pmod(F.xxhash64("left.sid", share), F.element_at(slots, F.col("band")))
    sizes = (F.col("left.n") + F.col("right.n")).alias("sizes")
    ends = [F.col("left.sid").alias("left"), F.col("right.sid").alias("right")]
    pairs = staged(pairs.join(partners, "left").select("band", tile.alias("tile"), *ends, sizes), "near-tiles")

    def in_tiles(pairs: DataFrame) -> DataFrame:
        member = F.explode(F.array("left", "right")).alias("sid")
        return pairs.select(F.col("band").alias("of_band"), F.col("tile").alias("of_tile"), member).distinct()

    def by_tile(members: DataFrame, pairs: DataFrame, function, schema: str) -> DataFrame:
        groups = members.groupBy("of_band", "of_tile").cogroup(pairs.groupBy("band", "tile"))
        return groups.applyInPandas(function, schema)

    mapped = in_tiles(pairs).join(reps.select("sid", "bits"), "sid")
    possible = by_tile(mapped, pairs, _possible, "band int, tile long, left long, right long")
    possible = staged(possible, "near-possible")
    members = in_tiles(possible)
    wanted = members.select("sid").distinct().join(reps.select("sid", "rep", "node"), "sid")
    with_sets = members.join(sets_of(docs, wanted, doc_id, text), "sid")
    return staged(by_tile(with_sets, possible, _linked, "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per input row: `doc_id, n_shingles, component_id`.

    `component_id` is the smallest identifier that links reach. Null and empty texts,
    and those without words, have no shingles, are linked with nothing and are their
    own component. Repeated rows stay repeated. A row with a null identifier gets the
    component of its text, null if no row with an identifier has that text.
    """
    rows = staged(shingled(docs, common_bins(docs, text), doc_id, text), "near-rows")
    some = rows.filter("n > 0")
    reps = some.groupBy("n", "node").agg(F.min("doc_id").alias("rep")).filter("rep is not null")
    chosen = some.select(F.col("doc_id").alias("rep"), "node", "bits").join(reps, ["rep", "node"])
    chosen = chosen.dropDuplicates(["rep", "node"]).withColumn("sid", F.monotonically_increasing_id())
    reps = staged(chosen.select("sid", "n", "rep", "node", "bits"), "near-sets")
    prefixes = some.select(F.col("doc_id").alias("rep"), "node", "prefix")
    prefixes = prefixes.join(reps.select("sid", "n", "rep", "node"), ["rep", "node"]).dropDuplicates(["rep", "node"])
    last = F.col("n") - F.ceil(F.lit(2 * NUMERATOR) * F.col("n") / DENOMINATOR)  # index_length - 1
    postings = prefixes.select("n", "sid", F.posexplode_outer("prefix").alias("pos", "token"))
    postings = postings.select("token", "n", "sid", "pos", (F.col("pos") <= last).alias("indexed"))
    shared = postings.groupBy("token").count().filter("count > 1").select("token")
    postings = staged(postings.join(shared, "token"), "near-postings")

    # One comparison for each set, with the set that most of its shingles lead to: of each
    # shingle the one with the fewest rarer ones, which is the least changed of near copies.
    me = F.struct("n", "sid")
    hub = postings.groupBy("token").agg(F.min(F.struct("pos", "n", "sid")).alias("hub"))
    hub = hub.select("token", F.struct("hub.n", "hub.sid").alias("hub"))
    fits = 5 * F.least("n", "hub.n") >= 4 * F.greatest("n", "hub.n")
    tries = postings.join(hub, "token").filter((F.col("hub.sid") != F.col("sid")) & fits)
    tries = tries.groupBy(me.alias("me"), "hub").count()
    best = tries.groupBy("me").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    ordered = best.select(F.least("me", "hub").alias("left"), F.greatest("me", "hub").alias("right")).distinct()
    links = links_among(docs, ordered, reps, doc_id, text)

    # All other pairs that are not in one component yet.
    known = components(links).withColumnRenamed("id", "sid")
    open_ = postings.join(known, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    open_ = staged(open_, "near-open")
    mixed = open_.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = open_.join(mixed.filter("low != high").select("token"), "token")
    small = open_.filter("indexed").select("token", me.alias("left"), F.col("component").alias("left_component"), F.col("pos").alias("left_pos"))
    large = open_.select("token", me.alias("right"), F.col("component").alias("right_component"), F.col("pos").alias("right_pos"))
    # Of the first shared shingle, neither set's rarer ones are shared, so this much is left to share.
    room = F.least(F.col("left.n") - F.col("left_pos"), F.col("right.n") - F.col("right_pos"))
    apart = (
        (F.col("left_component") != F.col("right_component"))
        & (F.col("left") < F.col("right"))
        & (5 * F.col("left.n") >= 4 * F.col("right.n"))
        & (DENOMINATOR * room >= NUMERATOR * (F.col("left.n") + F.col("right.n")))
    )
    others = small.join(large, "token").filter(apart).select("left", "right").distinct()
    links = links.unionByName(links_among(docs, others, reps, doc_id, text))

    found = components(links).withColumnRenamed("id", "sid")
    of_set = reps.select("sid", "n", "rep", "node").join(found, "sid", "left")
    of_set = of_set.withColumn("component", F.coalesce("component", "sid"))
    least = of_set.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_set = of_set.join(least, "component").select("n", "node", "component_id")
    with_words = some.select("doc_id", "n", "node").join(of_set, ["n", "node"], "left")
    without = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return with_words.select("doc_id", "n", "component_id").unionByName(without).withColumnRenamed("n", "n_shingles")

"""Exact Jaccard join of shingle sets by size-banded tiles with bitmap signatures.

Two sets of sizes s <= t with Jaccard at least p % differ in at most d = (100 - p)(s + t) / (100 + p) shingles. Sizes are cut
into bands; a set is placed in its own band and in those of sets it is small enough for. A band cuts the range of shingle
hashes into d + 1 + e parts, d being its largest difference: of a pair that links, at least 1 + e parts are equal. A set joins one
tile per part, keyed by the band, the part and the part's shingles; parts without shingles are left out unless a set has more
than e of them, which its partner then has as well. So every pair that links meets in a tile, and whatever shingles many
documents share, sets meet only where a whole part agrees.

Each set is compared with the least set it meets in a tile, and where that does not connect them with the least set and the
neighbour of each of its tiles (within a task, then among tasks). In tiles that are left in several components, all sets of different components are compared by bitmaps, in blocks. A bitmap has a bit per
hash modulo a power of two; bits set on one side only bound the overlap from above, and pairs that may pass are decided by
intersecting the sorted hashes. Components come from star contraction. Only fingerprint-sized rows are shuffled for all
documents; the hashes of sets in shared tiles are computed anew from their texts.

Equal sets are one node, so copies cost no pairs, and a task places a set once. Nodes are 64-bit hashes of sets; should two
different sets get the same one, all is done again with another seed. Texts without words (null, empty, white space) have size 0
and are linked with nothing, a text with fewer words than a shingle is one shingle. A text of any length is one set. Rows with
equal ids are rows of their own, null ids are not the smallest of a component (its id is null if it has no other); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .shared import discard, slices, staged
from .simhash import components, shingle_hashes

SHINGLE, PERCENT = 4, 85
SLICE_BYTES = 1 << 20
#: A band's largest size is about this many times its least.
BAND = 1.38
#: Tile places that a task keeps before it pairs and writes them.
HELD = 1_500_000
#: Sets of a tile whose bitmaps are compared in one task, on either side.
BLOCK = 1024
#: Bytes of bitmaps compared in one task at once.
BUCKET_BYTES = 32 << 20
ROWS = "doc_id {}, node long, n long, check long, hint long, tile array<long>, least array<long>, more_tile array<long>, more array<long>, more_least array<long>"
SETS = "node long, n long, bits binary, hashes binary"
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(None)
def bands(percent: int, most: int = 1 << 40) -> list[tuple[int, int, int, int]]:
    """(least size, largest difference, parts, empty parts a set may have) of each band, up to size ``most``."""
    out, low = [], 1
    while low <= most:
        high = max(low + 1, int(low * BAND))
        differ = (100 - percent) * 2 * (high - 1) // (100 + percent)
        empty = (differ + 1) * math.exp(-low / (differ + 1))
        spare = math.ceil(empty + 3 * math.sqrt(empty)) if differ else 0
        out.append((low, differ, differ + 1 + spare, spare))
        low = high
    return out


def places(h: np.ndarray, percent: int) -> np.ndarray:
    """The tiles of a sorted set of hashes."""
    table, n, out = bands(percent), len(h), []
    own = next(i for i in range(len(table) - 1, -1, -1) if table[i][0] <= n)
    for number in range(own, len(table)):
        low, differ, parts, spare = table[number]
        if percent * low > 100 * n:
            break
        if not differ:
            continue  # only equal sets link, and those are one node
        of = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        part, signs = of[starts], np.add.reduceat(_mixed(h), starts)
        if parts - len(part) > spare:
            none = np.setdiff1d(np.arange(parts, dtype=np.uint64), part)
            part, signs = np.concatenate([part, none]), np.concatenate([signs, np.zeros(len(none), np.uint64)])
        out.append(_mixed(signs + _mixed(part + np.uint64((number + 1) << 32))))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def bitmap(h: np.ndarray, percent: int) -> bytes:
    """Four bits or more per shingle of the largest set of its band, so that bitmaps of wider bands fold to it."""
    size = 64
    while size < 4 * len(h):
        size *= 2
    bits = np.zeros(size, bool)
    bits[h & np.uint64(size - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def shingle_set(text: str | None, words: int, seed: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes((text or "").encode(), words, seed), np.uint64))


def _placed(batches, words: int, percent: int, seed: int):
    """Rows of documents (doc_id, node, n, check, hint); and the task's tiles with their least node, and their other nodes."""
    seen, tiles, nodes, held = set(), [], [], 0
    names = ["doc_id", "node", "n", "check", "hint", "tile", "least", "more_tile", "more", "more_least"]

    def rows(columns, lists):
        n = len(columns[0])
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([x] * n if x is not None else [None] * n, pa.list_(pa.int64())) for x in lists)], names)

    def flush():
        tile, node = np.concatenate(tiles), np.concatenate(nodes)
        order = np.lexsort((node, tile))
        tile, node = tile[order], node[order]
        first = np.concatenate([[True], tile[1:] != tile[:-1]])
        least = node[first][np.cumsum(first) - 1]
        none = [pa.nulls(1, t) for t in (kind, pa.int64(), pa.int64(), pa.int64(), pa.int64())]
        for a in range(0, len(tile), 100_000):
            b = slice(a, a + 100_000)
            f = first[b]
            yield rows(none, [tile[b][f], node[b][f], tile[b][~f], node[b][~f], least[b][~f]])

    for batch in slices(batches, "text", SLICE_BYTES):
        kind, node, size, check = batch.schema.field("doc_id").type, [], [], []
        for text in batch["text"].to_pylist():
            h = shingle_set(text, words, seed)
            size.append(len(h))
            if not len(h):
                node.append(None)
                check.append(None)
                continue
            key = xxhash.xxh3_128_intdigest(h.tobytes(), seed)
            name = (key & (1 << 64) - 1) - (1 << 63)
            node.append(name)
            check.append((key >> 64) - (1 << 63))
            if name not in seen:
                seen.add(name)
                own = places(h, percent)
                tiles.append(own)
                nodes.append(np.full(len(own), name, np.int64))
                held += len(own)
        yield rows([batch["doc_id"], pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(check, pa.int64()), batch["hint"]], [None] * 5)
        if held >= HELD:
            yield from flush()
            tiles, nodes, held = [], [], 0
    if held:
        yield from flush()


def _sets(batches, words: int, percent: int, seed: int):
    """node, n, bits, hashes of each set, once a task."""
    seen = set()
    for batch in slices(batches, "text", SLICE_BYTES):
        out = []
        for text in batch["text"].to_pylist():
            h = shingle_set(text, words, seed)
            name = (xxhash.xxh3_128_intdigest(h.tobytes(), seed) & (1 << 64) - 1) - (1 << 63)
            if len(h) and name not in seen:
                seen.add(name)
                out.append((name, len(h), bitmap(h, percent), h.tobytes()))
        kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], [f.split()[0] for f in SETS.split(", ")])


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) folded to ``size`` bytes."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, size), 1)


def may_link(n: int, bits: np.ndarray, other_n: np.ndarray, other_bits: np.ndarray, percent: int) -> np.ndarray:
    """Which of the others may link with a set: bits on one side only are shingles that the other side lacks."""
    size = min(bits.shape[-1], other_bits.shape[-1])
    a, b = folded(bits.reshape(1, -1), size), folded(other_bits, size)
    mine = np.bitwise_count(a & ~b).sum(1, dtype=np.int64)
    theirs = np.bitwise_count(b & ~a).sum(1, dtype=np.int64)
    overlap = np.minimum(n - mine, other_n - theirs)
    return (100 + percent) * overlap >= percent * (n + other_n)


def _compared(rows: pa.Table, percent: int) -> pa.Table:
    """Pairs of two blocks of a tile (or of one with itself) that are in different components and may link."""
    node, root, n, tile, i, j = (rows[c].to_numpy() for c in ("node", "root", "n", "tile", "i", "j"))
    left, right = (rows[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("is_left", "is_right"))
    bits = rows["bits"].to_pylist()
    width = np.fromiter(map(len, bits), np.int64, len(bits))
    order, out = np.lexsort((width, j, i, tile)), [np.zeros((0, 2), np.int64)]
    changes = (np.diff(tile[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)
    for group in np.split(order, np.flatnonzero(changes) + 1):
        asked = group[left[group]]
        for size in np.unique(width[group]):
            at = group[right[group] & (width[group] == size)]
            maps = np.frombuffer(b"".join(bits[k] for k in at), np.uint8).reshape(len(at), size)
            for k in asked:
                ok = (root[at] != root[k]) & (at != k)
                if ok.any():
                    ok &= may_link(int(n[k]), np.frombuffer(bits[k], np.uint8), n[at], maps, percent)
                    found = node[at[ok]]
                    out.append(np.stack([np.minimum(found, node[k]), np.maximum(found, node[k])], 1))
    pairs = np.unique(np.concatenate(out), axis=0)
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _linked(batches, percent: int):
    """The pairs whose overlap, counted in the sorted hashes, is large enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch["hashes"].to_pylist(), batch["hashes_b"].to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            few, many = (x, y) if len(x) < len(y) else (y, x)
            at = np.searchsorted(many, few)
            same = int((many[np.minimum(at, len(many) - 1)] == few).sum())
            keep.append(100 * same >= percent * (len(x) + len(y) - same))
        at = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([batch["a"].take(pa.array(at)), batch["b"].take(pa.array(at))], ["a", "b"])


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their bitmaps do not rule out."""
    def run(batches):
        for batch in batches:
            ok = [bool(may_link(n, np.frombuffer(x, np.uint8), np.array([m]), np.frombuffer(y, np.uint8).reshape(1, -1), percent)[0])
                  for n, m, x, y in zip(*(batch[c].to_pylist() for c in ("n", "n_b", "bits", "bits_b")))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    other = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    return pairs.join(sets.select(F.col("node").alias("a"), "n", "bits"), "a").join(other, "b").select("a", "b", "n", "n_b", "bits", "bits_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    other = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))
    both = pairs.join(sets.select(F.col("node").alias("a"), "hashes"), "a").join(other, "b")
    return both.mapInArrow(lambda batches: _linked(batches, percent), "a long, b long")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs.where("root_a <> root_b").select("a", "b")


def _spread(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of each tile, copied to all pairs of the tile's blocks they belong to, in buckets of bounded bytes."""
    held = entries.groupBy("tile").agg((1 + F.floor(F.count(F.lit(1)) / BLOCK)).alias("blocks"))
    blocks = entries.join(held, "tile").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    pairs = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "node", "root", F.xxhash64("tile", F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
        "tile", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("is_left"), (F.col("own") >= F.col("other")).alias("is_right"))
    return pairs.join(sets.select("node", "n", "bits"), "node")


def near_duplicates(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id among all documents linked in any number of steps."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("hint"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    for seed in itertools.count():
        placed = staged(texts.mapInArrow(lambda batches: _placed(batches, words, percent, seed), ROWS.format(kind)), "jaccard-places", tidy=True)
        nodes = staged(placed.where("node is not null").groupBy("node").agg(
            F.min("check").alias("check"), F.max("check").alias("other"), F.min("doc_id").alias("first"), F.min("hint").alias("hint")), "jaccard-nodes", tidy=True)
        if not nodes.where("check <> other").head(1):
            break
        discard(placed, nodes)
    rows = staged(placed.where("n is not null").select("doc_id", "node", "n"), "jaccard-rows")

    def unpacked(*columns):
        return placed.where(F.col(columns[0]).isNotNull()).select(F.explode(F.arrays_zip(*columns)).alias("e")).select("e.*")

    # a task's least nodes of tiles meet in the shuffle; its other nodes are paired with their least one
    tile = Window.partitionBy("tile")
    met = unpacked("tile", "least").select(
        "tile", F.col("least").alias("node"), F.min("least").over(tile).alias("a"), F.max("least").over(tile).alias("z"), F.lag("least").over(tile.orderBy("least")).alias("before"))
    more = unpacked("more_tile", "more", "more_least").select(F.col("more_tile").alias("tile"), F.col("more").alias("node"), F.col("more_least").alias("a"))
    met = staged(met.where("a <> z").select("tile", "node", "a", "before").union(more.withColumn("before", F.lit(None).cast("long"))), "jaccard-tiles", tidy=True)
    discard(placed)
    members = met.select("tile", F.explode(F.array("node", "a")).alias("node")).distinct()

    hints = nodes.join(members.select("node").distinct(), "node", "left_semi").select("hint").distinct()
    sets = texts.join(hints, "hint", "left_semi").select("text").mapInArrow(lambda batches: _sets(batches, words, percent, seed), SETS)
    sets = staged(sets.dropDuplicates(["node"]), "jaccard-sets", tidy=True)
    # each set against one least set it meets; then those pairs of least sets and neighbours that are still apart
    first = met.where("a <> node").groupBy(F.col("node").alias("b")).agg(F.min("a").alias("a")).select("a", "b")
    first = staged(_possible(first, sets, percent), "jaccard-possible", tidy=True)
    links = staged(_verified(first, sets, percent), "jaccard-links", tidy=True)
    pairs = met.select(F.explode(F.array("a", "before")).alias("a"), F.col("node").alias("b")).where("a <> b")
    pairs = _apart(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), components(links))
    pairs = staged(_possible(pairs, sets, percent), "jaccard-possible", tidy=True)
    links = links.union(staged(_verified(pairs, sets, percent), "jaccard-links", tidy=True))
    roots = components(links)

    # tiles whose nodes are still in several components: all their sets of different components are compared
    rooted = members.join(roots, "node", "left").select("tile", "node", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("tile").agg(F.min("root").alias("a"), F.max("root").alias("z")).where("a <> z").select("tile")
    spread = staged(_spread(rooted.join(mixed, "tile"), sets), "jaccard-mixed", tidy=True)
    size = spread.agg(F.sum(F.octet_length("bits") + 64)).first()[0] or 0
    found = spread.groupBy(F.pmod("pair", F.lit(1 + size // BUCKET_BYTES)).alias("bucket")).applyInArrow(lambda t: _compared(t, percent), "a long, b long")
    late = staged(_verified(found.distinct(), sets, percent), "jaccard-late", tidy=True)
    if late.head(1):
        roots = components(links.union(late))

    rooted = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("node", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(named, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))

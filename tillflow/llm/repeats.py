"""Removal of every byte that a 200-byte string covers which also starts elsewhere, by merging Burrows-Wheeler transforms.

1. Equal 200-byte windows have the same least hash of ``KMER`` bytes, their anchor. A text is cut into segments, runs of windows
   of one anchor; anchors are counted over all texts, and only segments whose anchor occurs again go on (a bitmap of ``BITS``
   bits rules the others out; where it is small for a corpus, more segments go on).
2. Segments meet by anchor in buckets. In a bucket, equal segments are one; the others form ``SHARDS`` shards. A segment is
   read as ``STEP`` interleaved strings whose symbols are its ``STEP``-byte pieces. Each shard sorts its own suffixes once and
   keeps its transform. The shards are merged by refining an interleave: each round deals the merged rows by their preceding
   symbol, stably, which orders them by one more symbol, without comparing suffixes again. The round in which two neighbours part
   is their common prefix; rows that are still together after ``WINDOW / STEP`` rounds are an interval of a repeated window.
3. Repeated windows give the spans to remove, and the spans of a text are joined to its documents.

Texts are known by their SHA-256, so copies are cut once to a task; texts of several documents are removed as a whole if they
have 200 bytes. An anchor with more than ``CROWDED`` different segments (a frequent line in changing surroundings) would make one
task grow: windows of such segments are compared by 128-bit hashes in a plain grouping instead, which nothing limits.

Null texts are empty. Rows with equal ids are documents of their own. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .shared import slices, staged
from .suffix_tree import bitmap

WINDOW, STEP, KMER = 200, 40, 48
SHARDS = 4
#: Different segments of one anchor that one task merges at most: some 6 MB of text.
CROWDED = 20_000
BUCKET_BYTES = 256 << 10
SLICE_BYTES = 1 << 19
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


@lru_cache(4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    return tuple(np.cumprod(np.full(n, b, np.uint64)) for b in (base, pow(base, -1, 1 << 64)))


def rolling(raw: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(1 << max(20, len(raw).bit_length()), base)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw + np.uint64(1)) * powers[: len(raw)], out=sums[1:])
    h = (sums[length:] - sums[:-length]) * inverse[:n]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: of the rest of a block and the begin of the next."""
    n = len(h) - width + 1
    blocks = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(h)] = h
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts one after another; per segment its anchor, text, begin and end there, whether it can repeat in itself; and
    where the texts begin.

    Equal windows d apart in a segment make it periodic, so its anchor stands at one of the first d windows' begins, and the
    next window, which has lost that one, still has the anchor.
    """
    data = b"".join(texts)
    starts = np.cumsum([0, *map(len, texts)])
    empty = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return data, np.zeros(0, np.uint64), empty, empty, empty, empty > 0, starts
    h = rolling(np.frombuffer(data, np.uint8), KMER)
    anchor = least_of(h, WINDOW - KMER + 1)
    inside = np.zeros(len(anchor) + 2, bool)  # windows that lie in one text, shifted by one
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= WINDOW:
            inside[a + 1:b - WINDOW + 2] = True
    same = anchor[1:] == anchor[:-1]
    first = np.flatnonzero(inside[1:-1] & ~(np.r_[False, same] & inside[:-2]))
    last = np.flatnonzero(inside[1:-1] & ~(np.r_[same, False] & inside[2:]))
    heads = np.concatenate([[0], np.cumsum(h[: len(anchor)] == anchor)])
    return data, anchor[first], np.searchsorted(starts, first, "right") - 1, first, last + WINDOW, heads[last] > heads[first], starts


def anchor_counts(texts: DataFrame) -> DataFrame:
    """key (an anchor) and n, of how many segments it is the anchor; one that can repeat in itself counts twice."""
    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            _, anchor, _, _, _, inner, _ = segments(batch["text"].to_pylist())
            keys, n = np.unique(np.concatenate([anchor, anchor[inner]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])
    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def cut(texts: DataFrame, repeated) -> DataFrame:
    """anchor, sid (hash of the bytes), text key, start and bytes of the segments whose anchor may occur again."""
    def run(batches):
        seen = set()
        for batch in slices(batches, "text", SLICE_BYTES):
            new = [(k, t) for k, t in zip(batch["sha"].to_pylist(), batch["text"].to_pylist()) if not (k in seen or seen.add(k))]
            data, anchor, owner, first, end, _, starts = segments([t for _, t in new])
            at = np.flatnonzero(repeated.value.has(anchor))
            parts = [data[a:b] for a, b in zip(first[at].tolist(), end[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[at].view(np.int64)), pa.array([xxhash.xxh3_128_digest(p) for p in parts], pa.binary()), pa.array([new[i][0] for i in owner[at]], pa.string()),
                 pa.array(first[at] - starts[owner[at]]), pa.array(parts, pa.binary())], ["anchor", "sid", "sha", "start", "part"])
            if len(seen) > 1 << 17:
                seen.clear()
    return texts.mapInArrow(run, "anchor long, sid binary, sha string, start long, part binary")


def stable_order(values: np.ndarray) -> np.ndarray:
    """As a stable argsort of numbers from 0 below 2^31: each number and its place are sorted as one."""
    return (np.sort(values.astype(np.int64) << 32 | np.arange(len(values))) & (1 << 32) - 1)


def packed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The columns in fewer ones of the same order: as many side by side as 63 bits hold."""
    bits = max(int(c.max(initial=0)).bit_length() for c in columns) or 1
    out = []
    for i in range(0, len(columns), 63 // bits):
        out.append(columns[i].astype(np.int64))
        for c in columns[i + 1:i + 63 // bits]:
            out[-1] = out[-1] << bits | c
    return out


def interleaved(orders: list[np.ndarray], transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all shards in the order of their first ``rounds`` symbols, and each row's common prefix with the row before.

    ``transforms``: per shard the preceding symbol of each of its rows, 0 at a string's begin; the shard's rows are in order.
    """
    shard = np.repeat(np.arange(len(orders), dtype=np.int8), [len(o) for o in orders])
    block = np.zeros(len(shard), np.int32)
    common = np.full(len(shard), rounds, np.int8)
    common[:1] = 0
    preceding = np.empty(len(shard), np.int32)
    for h in range(1, rounds + 1):
        for j, b in enumerate(transforms):
            preceding[shard == j] = b
        source = stable_order(preceding)
        symbol, came, ended = preceding[source], block[source], int(np.count_nonzero(preceding == 0))
        shard = shard[source]
        shard[:ended] = np.sort(shard[:ended])  # strings that have ended are one block, in the order of the shards
        parted = np.zeros(len(shard), bool)
        parted[1:] = (symbol[1:] != symbol[:-1]) | ((came[1:] != came[:-1]) & (symbol[1:] > 0))
        common[parted & (common >= h)] = h - 1
        block = np.cumsum(parted, dtype=np.int32)
    rows = np.empty(len(shard), np.int64)
    for j, o in enumerate(orders):
        rows[shard == j] = o
    return rows, common


def repeated_windows(parts: list[bytes]) -> list[np.ndarray]:
    """Per part, all of which differ, which of its windows occur again in them."""
    sizes = np.array([len(p) for p in parts])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])  # a part's rows are its positions and its end
    raw = np.frombuffer(b"\0".join([*parts, b""]), np.uint8)
    total = int((sizes + 1).sum())
    part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes + 1)
    place = (np.arange(total) - begins[part]).astype(np.int32)
    symbols = np.zeros(total + WINDOW, np.int32)
    real = np.flatnonzero(place <= sizes[part] - STEP)
    symbols[real] = pa.array(rolling(raw, STEP)[real]).dictionary_encode().indices.to_numpy() + 1
    del real
    rounds = WINDOW // STEP
    columns = [symbols[:total]]
    for k in range(1, rounds):  # behind the end of a string there is nothing
        columns.append(np.where(columns[-1] > 0, symbols[k * STEP:k * STEP + total], 0))
    columns = packed(columns)
    preceding = np.where(place >= STEP, np.r_[np.zeros(STEP, np.int32), symbols[:total - STEP]], 0)
    orders, transforms = [], []
    for j in range(SHARDS):
        rows = np.flatnonzero(part % SHARDS == j)
        orders.append(rows[np.lexsort([c[rows] for c in columns[::-1]])])
        transforms.append(preceding[orders[-1]])
    rows, common = interleaved(orders, transforms, rounds)
    equal = common >= rounds  # to the row before
    again = equal | np.r_[equal[1:], False]
    hit = np.zeros(total, bool)
    hit[rows[again]] = True
    hit &= place <= sizes[part] - WINDOW
    return [hit[b:b + n - WINDOW + 1] for b, n in zip(begins.tolist(), sizes.tolist())]


def _runs(sids: list[bytes], hits: list[np.ndarray]) -> pa.RecordBatch:
    """sid, begin and end of the bytes that runs of repeated windows cover."""
    out = []
    for sid, hit in zip(sids, hits):
        edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
        out += [(sid, a, b - 1 + WINDOW) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
    columns = list(zip(*out)) if out else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["sid", "a", "b"])


RUNS = "sid binary, a long, b long"


def merged(different: DataFrame) -> DataFrame:
    """Repeated runs of windows among the different segments of each bucket."""
    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("sid")
        return pa.Table.from_batches([_runs(table["sid"].to_pylist(), repeated_windows(table["part"].to_pylist()))])
    size = different.agg(F.sum(F.length("part"))).first()[0] or 0
    buckets = F.lit(1 + size // BUCKET_BYTES)
    return different.withColumn("bucket", F.pmod("anchor", buckets)).select("bucket", "sid", "part").groupBy("bucket").applyInArrow(one, RUNS)


def crowded(different: DataFrame) -> DataFrame:
    """The same for segments of crowded anchors, window by window."""
    def run(batches):
        for batch in slices(batches, "part", 1 << 18):
            sids, parts = batch["sid"].to_pylist(), batch["part"].to_pylist()
            sizes = np.array([len(p) for p in parts])
            raw = np.frombuffer(b"".join(parts), np.uint8)
            place = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = np.flatnonzero(place + WINDOW <= np.repeat(sizes, sizes))
            one, two = (pa.array(rolling(raw, WINDOW, base)[at].view(np.int64)) for base in BASES)
            owner = pa.array(sids, pa.binary()).take(pa.array(np.repeat(np.arange(len(parts)), sizes)[at]))
            yield pa.RecordBatch.from_arrays([one, two, owner, pa.array(place[at])], ["one", "two", "sid", "a"])
    windows = different.select("sid", "part").mapInArrow(run, "one long, two long, sid binary, a long")
    again = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("one", "two")
    return windows.join(again, ["one", "two"]).select("sid", "a", (F.col("a") + WINDOW).alias("b"))


def spans(texts: DataFrame) -> DataFrame:
    """sha and the spans (a, b) of its text that repeated windows cover; spans of a text may overlap."""
    repeated = bitmap(anchor_counts(texts).where("n > 1").select("key"))
    parts = staged(cut(texts, repeated), "repeats-segments", tidy=True)
    different = parts.groupBy("anchor", "sid").agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("part"))
    different = staged(different, "repeats-different", tidy=True)
    whole = different.where("n > 1").select("sid", F.lit(0).cast("long").alias("a"), F.length("part").cast("long").alias("b"))
    crowds = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > CROWDED)
    known = staged(different.join(crowds, "anchor", "left"), "repeats-shared", tidy=True)
    runs = merged(known.where("kinds is null")).union(crowded(known.where("kinds is not null"))).union(whole)
    runs = staged(runs, "repeats-runs", tidy=True)
    return parts.select("sid", "sha", "start").join(runs, "sid").select("sha", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))


def joined(a: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as maximal runs."""
    out: list[list[int]] = []
    for x, y in sorted(a):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def remove(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    known = docs.select("doc_id", data.alias("text"), F.sha2(data, 256).alias("sha"))
    texts = known.where(F.length("text") >= WINDOW).select("sha", "text")
    copied = texts.groupBy("sha").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit((1 << 62)).alias("b"))).alias("list"))
    found = spans(texts).groupBy("sha").agg(F.collect_set(F.struct("a", "b")).alias("list"))
    found = found.union(copied).groupBy("sha").agg(F.flatten(F.collect_list("list")).alias("list"))
    found = staged(found, "repeats-spans", tidy=True)

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = []
            for text, sha, list_ in zip(*(batch[c].to_pylist() for c in ("text", "sha", "list"))):
                runs = joined([(x["a"], min(x["b"], len(text))) for x in list_ or ()])
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                rows.append((len(text), sum(b - a for a, b in runs), len(runs), hashlib.sha256(b"".join([*kept, text[at:]])).hexdigest() if runs else sha))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return known.join(found, "sha", "left").select("doc_id", "text", "sha", "list").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

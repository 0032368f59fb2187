"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints at most two bits apart have a common variant at most one bit from either. So every distinct fingerprint emits
itself and its one-bit variants, equal variants meet in the shuffle, and neighbours in the sorted fingerprints of a variant
are linked: at most 65 fingerprints share a variant, and a chain of them connects what pairs would.

Documents of equal fingerprint are one node, so copies cost no links. Texts without words (null, empty, white space) have
fingerprint zero and are linked like any other. Rows with equal ids are rows of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .shared import slices, staged

SEED = 42
SHINGLE = 3
#: Bits of a slice's shingle table held at once are about 64 times the words of so many text bytes.
SLICE_BYTES = 1 << 20


def shingle_hashes(text: bytes, words: int = SHINGLE, seed: int = SEED) -> list[int]:
    """Hashes of the shingles, repeats included; a text with fewer words is one shingle, one without words has none."""
    parts = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), seed)] if parts else []
    joined, ends, at = b" ".join(parts), [], -1
    for n in map(len, parts):
        at += n + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-words]]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:])]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """Per list the 64-bit number whose bits are set in over half of the hashes."""
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        flat = np.concatenate([np.array(hashes[i], np.uint64) for i in full])
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(ones * 2 > counts[full][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""
    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            found = majority([shingle_hashes((t or "").encode(), words) for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "fp"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def ball_links(nodes: DataFrame) -> DataFrame:
    """Links (a < b) between distinct fingerprints ``fp`` at most two bits apart, enough to connect all such pairs."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    variants = nodes.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    met = variants.select(F.col("fp").alias("b"), F.lag("fp").over(Window.partitionBy("variant").orderBy("fp")).alias("a"))
    return met.where(F.col("a").isNotNull() & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, root being the smallest node it reaches, by large-star and small-star rounds.

    Each round gives every node's neighbours its smallest neighbour; only minima are gathered, never neighbour lists, and
    each round's links are written to the shared folder.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u")
        small = (pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, "star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        state = now


def near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id among all documents linked in any number of steps."""
    marked = staged(fingerprints(docs, words), "simhash")
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    rooted = nodes.join(components(ball_links(nodes)).withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    return (marked.join(named.select("fp", "component_id"), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def kept(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """One document of each component, that of the smallest id (null ids last; of equal ids the smallest text hash); columns as they were.

    Of equal rows one stays. Texts without words are all linked, so one of them stays.
    """
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("hash"))
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_id")
    stay = near_duplicates(docs.select(name.alias("doc_id"), "text"), words).select("component_id").distinct()
    stay = staged(stay.select(plain("component_id.id"), F.col("component_id.hash").alias("_hash")).distinct(), "simhash-kept", tidy=True)
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], plain("doc_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_hash"))
    chosen = inner.join(stay, ["_id", "_hash"]).withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.lit(0))))
    return chosen.where("_n = 1").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])

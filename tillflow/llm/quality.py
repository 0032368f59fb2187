"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its words and their pieces of three and four letters, in lower case and hashed; beside them, as shape, n-grams over
character classes (lower, upper, digit, white space, each punctuation mark; runs shortened) and marks for words and lines that repeat. Their TF-IDF vectors, whose document frequencies count all documents, are projected on
the leading singular vectors of a labelled sample of at most ``MOST_LABELLED`` rows. Every document is compared with every
vector of that sample by exact cosine products in blocks; the ``NEIGHBOURS`` nearest vote with weights by similarity.

A text without terms (null, empty) or unlike all of the sample gets the share of label 1 in the sample, and 0.5 if there is no
label. Equal cosines at the edge of the neighbourhood are chosen by the order of the
sample, the same in every run. Whole texts of any length count; of repeated label rows the smallest label holds; rows with equal ids are rows of their own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .shared import fold, slices

MOST_LABELLED = 4000
RANK = 48
NEIGHBOURS = 15
SHARPNESS = 8
THRESHOLD = 0.7
ORDERS, PIECES = (1, 2, 3, 4), (3, 4)
#: Hashed shapes, then hashed words and pieces of words.
HASHED, WORDS = 1 << 13, 1 << 13
#: Behind the hashed terms: words equal to the one 1 to 4 words before, and lines seen before in the text, in ``LEVELS`` steps of share.
LAGS, LEVELS = 4, 6
MARKS = HASHED + WORDS
SPACE = MARKS + (LAGS + 1) * LEVELS
SLICE_BYTES = 1 << 18
BLOCK = 1024


def _classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[ord("a"):ord("z") + 1] = table[128:] = ord("a")
    table[ord("A"):ord("Z") + 1] = ord("A")
    table[ord("0"):ord("9") + 1] = ord("9")
    table[[9, 11, 12, 13]] = 32
    return table


CLASSES = _classes()


def terms(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its terms and their damped counts, 1 + log of the count."""
    raw = [(t or "").encode() for t in texts]
    for data in raw:
        if not data:
            yield np.zeros(0, np.int64), np.zeros(0, np.float32)
            continue
        codes = CLASSES[np.frombuffer(data, np.uint8)]
        if len(codes) > 2:
            codes = codes[np.r_[True, True, (codes[2:] != codes[1:-1]) | (codes[1:-1] != codes[:-2])]]  # runs of two at most
        words, lines = data.split(), [line for line in data.split(b"\n") if line]
        same = np.fromiter(map(xxhash.xxh32_intdigest, data.lower().split()), np.int64, len(words))
        parts = [same % WORDS + HASHED]
        parts += [h for _, h in _grams(codes, ORDERS)]
        letters = np.frombuffer(data.lower(), np.uint8).astype(np.uint32)
        inside = letters > 32
        for n, h in _grams(letters, PIECES):
            whole = np.lib.stride_tricks.sliding_window_view(inside, n).all(1)  # no piece reaches over white space
            parts.append(h[whole] + HASHED)
        counts = np.bincount(np.concatenate(parts), minlength=MARKS)
        at = np.flatnonzero(counts)
        counts = counts[at]
        same = np.fromiter(map(hash, words), np.int64, len(words))
        shares = [np.count_nonzero(same[lag:] == same[:-lag]) / max(1, len(words) - lag) for lag in range(1, LAGS + 1)]
        shares.append(1 - len(set(lines)) / max(1, len(lines)))
        marks = [MARKS + k * LEVELS + i for k, share in enumerate(shares) for i in range(LEVELS) if share > 0.5 ** (LEVELS - i)]
        yield np.r_[at, np.array(marks, np.int64)], (1 + np.log(np.r_[counts, np.full(len(marks), 20)])).astype(np.float32)


def _grams(codes: np.ndarray, orders: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """Per order the hashes of all n-grams, of 13 bits."""
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, min(orders[-1], len(codes)) + 1):
        h = (h[: len(codes) - n + 1] + codes[n - 1:]) * np.uint32(0x9E3779B1)
        if n in orders:
            yield n, (h >> np.uint32(19)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches):
        seen, n = np.zeros(SPACE, np.int64), 0
        for batch in slices(batches, "text", SLICE_BYTES):
            for at, _ in terms(batch["text"].to_pylist()):
                seen[at] += 1
            n += batch.num_rows
        at = np.flatnonzero(seen)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1], pa.int32()), pa.array([*seen[at].tolist(), n], pa.int64())], ["term", "n"])
    out = np.zeros(SPACE + 1, np.int64)
    for term, n in docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out[:-1], int(out[-1])


def labelled_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Label, terms and damped counts of at most ``MOST_LABELLED`` documents, the first by a hash of the id."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~fold("doc_id", 4, 2))
              .groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(MOST_LABELLED))
    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = list(terms(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), batch["quality"].cast(pa.int64()), pa.array([a for a, _ in rows], pa.list_(pa.int64())), pa.array([c for _, c in rows], pa.list_(pa.float32()))],
                ["doc_id", "label", "at", "n"])
    # the sample's size is bounded by its parameter, whatever the tables hold
    table = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, label long, at array<long>, n array<float>").toArrow()
    rows = zip(table["doc_id"].to_pylist(), table["label"].to_pylist(), [v.values.to_numpy() for v in table["at"]], [v.values.to_numpy() for v in table["n"]])
    return [r[1:] for r in sorted(rows, key=lambda r: (r[0], len(r[2]), r[1]))]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projection (terms by rank), unit vectors of the sample, and its labels."""
    x = np.zeros((len(rows), SPACE), np.float32)
    for i, (_, at, n) in enumerate(rows):
        x[i, at] = n * idf[at]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    draw = np.random.default_rng(11).standard_normal((SPACE, RANK + 8), np.float32)
    for _ in range(3):  # subspace iterations towards the leading right singular vectors
        draw = np.linalg.qr(x.T @ (x @ draw))[0]
    _, _, right = np.linalg.svd(x @ draw, full_matrices=False)
    projection = (draw @ right.T)[:, :RANK].astype(np.float32)
    return projection * idf[:, None], _unit(x @ projection), np.array([r[0] for r in rows], np.float32)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def vote(vectors: np.ndarray, sample: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weighted share of label 1 among the nearest of the sample, all of which are compared."""
    out = np.empty(len(vectors))
    k, prior = min(NEIGHBOURS, len(sample)), float(labels.mean())
    for i in range(0, len(vectors), BLOCK):
        cosine = vectors[i:i + BLOCK] @ sample.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(1)
        out[i:i + BLOCK] = np.where(total > 1e-9, (weight * labels[near]).sum(1) / np.maximum(total, 1e-9), prior)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; documents whose crc32(doc_id) leaves 2 by 4 are held out from learning."""
    docs = docs.select("doc_id", "text", fold("doc_id", 4, 2).alias("held_out"))
    df, n = document_frequencies(docs)
    rows = labelled_sample(docs, labels)
    model = fit(rows, (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)) if rows else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            found = np.full(batch.num_rows, 0.5)
            if shared.value:
                projection, sample, known = shared.value
                vectors = np.stack([n @ projection[at] for at, n in terms(batch["text"].to_pylist())])
                found = vote(_unit(vectors), sample, known)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")

"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; everything but letters becomes one space; n-grams of one to three characters are hashed into
``SPACE`` features. A feature's value is its share of the text's n-grams times its inverse document frequency, which counts
all learning documents. The weights are learned with follow-the-regularised-leader and elastic-net penalties from a sample
of at most about ``MOST_EXAMPLES`` documents, spread evenly over the languages; a temperature fitted on a part of the sample
that was kept out calibrates the probabilities.

Null texts and texts without a letter are ``und`` with score 0, and so is everything when there is nothing to learn from.
Whole texts count; rows with equal ids are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import fold, slices

SPACE = 1 << 16
ORDERS = (1, 2, 3)
MOST_EXAMPLES = 4000
UNKNOWN = "und"
SCALE, EPOCHS = 10.0, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
#: Every so many examples of the sample one is kept for the temperature.
KEPT_OUT = 5
SLICE_BYTES = 1 << 18


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def features(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order, the hashed n-gram that begins at each character; where each text's characters begin; which texts have letters.

    An n-gram that would reach into the next text is ``SPACE``, a feature that counts for nothing.
    """
    lowered = [f" {t.lower()} " if t else " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *map(len, lowered)])[:-1]
    letter = _letters().take(codes)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of other characters, the first
    keep[starts] = True
    has = np.logical_or.reduceat(letter, starts)
    codes = np.where(letter, codes, np.uint32(32))[keep]
    starts = np.cumsum([0, *np.add.reduceat(keep, starts, dtype=np.int64)])[:-1]
    ends = np.append(starts[1:], len(codes))
    found, h = [], np.zeros(len(codes), np.uint32)
    for n in ORDERS:
        h[: len(h) - n + 1] += codes[n - 1:]
        h *= np.uint32(0x9E3779B1)
        at = (h >> np.uint32(16)).astype(np.int32)
        for k in range(1, n):
            at[np.maximum(ends - k, starts)] = SPACE
        found.append(at)
    return found, starts, has


def counted(found: list[np.ndarray], starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its features and their shares of its n-grams."""
    for a, b in zip(starts, [*starts[1:], len(found[0])]):
        at, n = np.unique(np.concatenate([f[a:b] for f in found]), return_counts=True)
        at, n = at[at < SPACE], n[: np.count_nonzero(at < SPACE)]
        yield at.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, and how many documents there are."""
    def run(batches):
        seen, n = np.zeros(SPACE + 1, np.int64), 0
        flags = np.zeros(SPACE + 1, bool)
        for batch in slices(batches, "text", SLICE_BYTES):
            found, starts, _ = features(batch["text"].to_pylist())
            for a, b in zip(starts, [*starts[1:], len(found[0])]):
                for f in found:
                    flags[f[a:b]] = True
                seen += flags
                flags[:] = False
            n += batch.num_rows
        at = np.flatnonzero(seen[:SPACE])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1], pa.int32()), pa.array([*seen[at].tolist(), n], pa.int64())], ["feature", "n"])
    out = np.zeros(SPACE + 1, np.int64)
    for feature, n in docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n")).collect():
        out[feature] = n  # -1 is the last: the documents
    return out[:-1], int(out[-1])


def examples(docs: DataFrame, label: str) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """A bounded sample, about as many of each label: label, features, their shares of the text."""
    counts = {r[0]: r[1] for r in docs.groupBy(label).count().collect()}
    if not counts:
        return []
    rate = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, MOST_EXAMPLES / len(counts) / n)))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) / (1 << 20)

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            found, starts, has = features(batch["text"].to_pylist())
            rows = list(counted(found, starts))
            yield pa.RecordBatch.from_arrays(
                [batch[label], pa.array([i for i, _ in rows], pa.list_(pa.int32())),
                 pa.array([c for _, c in rows], pa.list_(pa.float32())),
                 batch["doc_id"].cast(pa.int64())], ["label", "at", "share", "id"]).filter(pa.array(has))
    sample = docs.where(draw < rate[F.col(label)]).select("doc_id", label, "text").mapInArrow(run, "label string, at array<int>, share array<float>, id long")
    table = sample.toArrow()
    rows = list(zip(table["label"].to_pylist(), table["id"].to_pylist(), map(_flat, table["at"]), map(_flat, table["share"])))
    rows.sort(key=lambda r: (r[1] * 0x9E3779B97F4A7C15 & (1 << 64) - 1, len(r[2])))  # one order, whatever task was first
    return [(r[0], r[2], r[3]) for r in rows]


def _flat(value) -> np.ndarray:
    return value.values.to_numpy()


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """Labels, weights times idf (labels by features, with a zero for ``SPACE``), and the temperature."""
    labels = sorted({r[0] for r in rows})
    number = {x: i for i, x in enumerate(labels)}
    z, n, w = (np.zeros((SPACE, len(labels)), np.float64) for _ in range(3))
    kept = [r for i, r in enumerate(rows) if i % KEPT_OUT == KEPT_OUT - 1]
    for _ in range(EPOCHS):
        for i, (label, at, share) in enumerate(rows):
            if i % KEPT_OUT == KEPT_OUT - 1:
                continue
            x = share * idf[at] * SCALE
            error = _softmax(x @ w[at])
            error[number[label]] -= 1
            g = x[:, None] * error
            was = n[at]
            n[at] = now = was + g * g
            z[at] = zz = z[at] + g - (np.sqrt(now) - np.sqrt(was)) / ALPHA * w[at]
            w[at] = np.where(np.abs(zz) <= L1, 0.0, (np.sign(zz) * L1 - zz) / ((BETA + np.sqrt(now)) / ALPHA + L2))
    weights = (w * (idf * SCALE)[:, None]).astype(np.float32)
    logits = np.array([share @ weights[at] for _, at, share in kept]).reshape(-1, len(labels))
    truth = np.array([number[r[0]] for r in kept], np.int64)

    def loss(t: float) -> float:
        scaled = logits / t
        top = scaled.max(1)
        return float((np.log(np.exp(scaled - top[:, None]).sum(1)) + top - scaled[np.arange(len(truth)), truth]).mean())
    choices = np.geomspace(0.2, 20, 60)
    return labels, np.vstack([weights, np.zeros_like(weights[:1])]).T.copy(), min(choices, key=loss) if len(kept) else 1.0


def _softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def identify(docs: DataFrame, learn_from: Column, keep: list[str], label: str = "lang") -> DataFrame:
    """Columns ``keep`` and then ``_pred`` and ``_score``; learns from rows where ``learn_from`` holds and the label is known."""
    known = docs.where(learn_from & F.col(label).isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col(label).alias("label"))
    rows = examples(known, "label")
    df, n = document_frequencies(known) if rows else (np.zeros(SPACE), 0)
    model = train(rows, np.log((1 + n) / (1 + df)) + 1) if rows else ([], np.zeros((0, SPACE + 1), np.float32), 1.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text, returned = "_text" if "text" not in keep else f"_{keep.index('text')}", [f"_{i}" for i in range(len(keep))]

    def run(batches):
        labels, weights, temperature = shared.value
        for batch in slices(batches, text, SLICE_BYTES):
            predicted, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if labels:
                found, starts, has = features(batch[text].to_pylist())
                size = np.diff(np.append(starts, len(found[0])))
                counts = sum(np.maximum(size - n + 1, 0) for n in ORDERS)
                logits = np.stack([sum(np.add.reduceat(w.take(f), starts) for f in found) for w in weights], 1).astype(np.float64)
                p = _softmax(logits / np.maximum(counts, 1)[:, None] / temperature)
                best = p.argmax(1)
                predicted = [labels[b] if h else UNKNOWN for b, h in zip(best, has)]
                scores = np.where(has, p[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in returned], pa.array(predicted, pa.string()), pa.array(scores)], [*returned, "_pred", "_score"])
    plain = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, returned)], *[F.col("text").alias("_text")] * (text == "_text"))
    kinds = "".join(f"{k} {docs.schema[c].dataType.simpleString()}, " for c, k in zip(keep, returned))
    out = plain.mapInArrow(run, f"{kinds}_pred string, _score double")
    return out.select(*[F.col(k).alias(c) for k, c in zip(returned, keep)], "_pred", "_score")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; documents whose crc32(doc_id) leaves 1 by 3 are held out from learning."""
    held = fold("doc_id", 3, 1)
    found = identify(docs.select("doc_id", "text", "lang", held.alias("held_out")), ~F.col("held_out") & F.col("doc_id").isNotNull(), ["doc_id", "held_out"])
    return found.withColumnsRenamed({"_pred": "lang_pred", "_score": "score"})


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is told with at least this probability; columns as they were."""
    found = identify(docs, ~fold("doc_id", 3, 1) & F.col("doc_id").isNotNull(), docs.columns)
    return found.where((F.col("_pred") != UNKNOWN) & (F.col("_score") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Alignment of two tokenizers: which tokens of one overlap which of the other, and in how many documents.

Space + text is tokenized by a byte-level BPE (A) and by a sentencepiece model (B). Byte offsets where tokens of both end cut the
tokens into groups; A and B tokens whose byte ranges overlap are links, one per byte range between neighbouring ends.

First pass: texts become ids, which are written; each task counts, per pair of ids, its documents that hold the pair linked, and
writes the pairs in shards of A ids. Per shard, a minimal perfect hash of the distinct pairs is built (levels of bits; a key that falls alone on a bit keeps it, the
others go to the next level; a key's index is the number of bits before its own), the tasks' counts become dense vectors
indexed by it, and the vectors are summed in a tree. Second pass: the written ids are aligned again and look their pairs up;
the pair kept at an index is compared with the one asked for, so pairs that the table does not have count 0. An A id's pairs
are in one shard, which so knows the highest of them. Tables larger than ``ROUND`` pairs are looked up in several rounds.

Both tokenizers cut at a space between two other characters, so texts are tokenized by such words and a worker keeps the ids of
the words it has met. Null and empty texts, and texts whose tokens do not give their bytes back, have no tokens: zeros and empty groups.
Special tokens inside texts are plain text. A text of any length is taken whole. Rows with equal ids are documents of their own
and are counted each; null ids are kept; ties for the highest count are all highest. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections import defaultdict
from functools import lru_cache
from itertools import chain, islice
from operator import eq

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .shared import slices, staged

#: Shards by A id. A shard has at most (A ids / SHARDS) x (B ids) pairs, whatever the corpus.
SHARDS = 256
#: Vectors that one task sums, and pairs of a broadcast table (13 bytes each).
FAN, ROUND = 64, 8_000_000
SLICE_BYTES = 4 << 20
#: Tokens of B after which links of one long text are made in pieces.
LONG = 1 << 20
#: Words a worker keeps, and the bytes of all their characters, before it starts anew.
MOST_WORDS, MOST_BYTES = 300_000, 32 << 20
#: Pairs that a task holds before it merges them.
HELD = 4_000_000
#: Words put together in one text for the tokenizers.
JOINED = 256
CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space other than the space.
SPACES = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c != " "]
PIECES = "shard int, part long, keys binary, counts binary"
TABLE = "shard int, part long, n long, sizes binary, words binary, keys binary"
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


# ---- minimal perfect hash -------------------------------------------------------------------------------------------


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Distinct keys to 0 .. n - 1; ``keys`` holds each index's key, by which a foreign key is told."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, keys: np.ndarray):
        self.sizes, self.words, self.keys = sizes, words, keys
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        rest, sizes, words = keys, [], []
        while len(rest):
            size = -(-2 * len(rest) // 64) * 64
            at = _place(rest, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            rest = rest[~alone[at]]
        out = PerfectHash(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint64), *words]), keys)
        at, ordered = out._index(keys), np.empty_like(keys)
        ordered[at] = keys
        out.keys = ordered
        return out

    def _index(self, keys: np.ndarray) -> np.ndarray:
        """An index of each key, -1 for keys that fall on no bit."""
        out, rest, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _place(keys[rest], level, size)
            word, bit = self.words[base + (at >> 6)], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[rest[hit]] = (self.before[base + (at >> 6)] + below)[hit]
            rest, base = rest[~hit], base + size // 64
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 for those that the table does not have."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = self._index(keys)
        return np.where((at >= 0) & (self.keys[at] == keys), at, -1)


# ---- tokens of words ------------------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, each id's bytes, and the ids of words."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, special = _byte_letters(), {t.content for t in self.a.get_added_tokens_decoder().values()}
        spelled = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if t not in special}
        self.a_bytes = [spelled.get(i, b"") for i in range(self.a.get_vocab_size())]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))]
        if any(re.search("[^▁]▁", p) for p in self.b.id_to_piece(list(range(self.b.get_piece_size())))):
            raise ValueError("a piece of this model spans words")
        # where merges are ranked by their result's id, words of Latin-1 characters take a quicker way to the same ids
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        ranks = [model["vocab"][x + y] for x, y in merges]
        plain = ranks == sorted(ranks) and min(ranks, default=256) >= 256 and {len(spelled[i]) for i in range(256)} == {1}
        self.quick = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in spelled.items()}, special_tokens={}) if plain else None
        self.shift = len(self.b_bytes).bit_length()
        if len(self.a_bytes) << self.shift > 1 << 32:
            raise ValueError("a pair of ids does not fit in 32 bits")
        self.kind = np.dtype(np.uint32)
        self.ids = [np.dtype(np.uint16 if len(b) <= 1 << 16 else np.uint32) for b in (self.a_bytes, self.b_bytes)]
        self.a_size, self.b_size = (np.array(list(map(len, b)), np.int64) for b in (self.a_bytes, self.b_bytes))
        texts = [f"{i}{end}".encode() for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for end in ends for i in range(n)]
        self.texts = np.array(texts, object)

    def _ids(self, texts: list[str], quick: bool) -> tuple[list[list[int]], list[np.ndarray]]:
        a = [f" {t}" for t in texts]
        a = list(map(self.quick.encode_ordinary, a)) if quick and self.quick else [f.ids for f in self.a.encode_batch(a, add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1, return_type="numpy")

    def _flat(self, a: list[list[int]], b: list[np.ndarray]) -> list[np.ndarray]:
        return [np.fromiter(chain.from_iterable(a), self.ids[0]), np.concatenate([np.zeros(0, self.ids[1]), *b]).astype(self.ids[1])]

    def joined(self, words: list[str], quick: bool) -> list[np.ndarray] | None:
        """The ids of both for words put together by spaces; None if they do not give back the bytes. ``quick``: words are Latin-1."""
        texts = [" ".join(words[i:i + JOINED]) for i in range(0, len(words), JOINED)]
        a, b = self._flat(*self._ids(texts, quick))
        raw = "".join([f" {t}" for t in texts]).encode()
        if any(b"".join(map(spelled.__getitem__, ids.tolist())) != raw for spelled, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return None
        return [a, b]

    def alone(self, words: list[str], quick: bool) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of both for words one by one, and which words give back their bytes; the others have no ids."""
        good, flat = [], ([], [])
        for word, a, b in zip(words, *self._ids(words, quick)):
            raw = f" {word}".encode()
            good.append(b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b.tolist()]))
            if good[-1]:
                flat[0].append(a)
                flat[1].append(b)
        return self._flat(*flat), np.array(good, bool)


def _kinds(words: list[str]) -> np.ndarray:
    """0 and 1: words that may be put together, of Latin-1 characters and of others; 2: those with white space at an end or with B's sign for a space."""
    loose = ~np.fromiter(map(eq, map(str.strip, words), words), bool, len(words))
    other = ~np.fromiter(map(str.isascii, words), bool, len(words))
    out = 2 * loose.astype(np.int64)
    for i in np.flatnonzero(other & ~loose).tolist():
        out[i] = 2 if "▁" in words[i] else int(max(words[i]) > "\xff")
    return out


def _cut(text: str) -> list[str]:
    """The words of a text: cut at spaces between two characters that are no white space."""
    if "  " in text or text[0] == " " or text[-1] == " " or any(c in text and (f"{c} " in text or f" {c}" in text) for c in SPACES):
        return CUT.split(text)
    return text.split(" ")


@lru_cache(1)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


class Words:
    """The words a worker has met: their ids of both sides."""

    def __init__(self, both: Tokenizers):
        self.both, self.index = both, defaultdict()
        self.index.default_factory = self.index.__len__  # a new word gets the next number
        self.forget()

    def forget(self) -> None:
        self.index.clear()
        self.size, self.bad = 0, np.zeros(0, bool)
        self.ids = [np.zeros(0, kind) for kind in self.both.ids]
        self.start, self.count = ([np.zeros(0, np.int64)] * 2 for _ in range(2))

    def learn(self, words: list[str]) -> None:
        both, kinds, n = self.both, _kinds(words), len(words)
        order = np.argsort(kinds, kind="stable")
        words = [words[i] for i in order.tolist()]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(kinds, minlength=3))]).tolist()
        good, ids = np.ones(n, bool), []
        for kind, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])):
            found = both.joined(words[x:y], kind == 0) if x < y and kind < 2 else None
            if found is None:
                found, good[x:y] = both.alone(words[x:y], kind == 0)
            ids.append(found)
        sizes = np.fromiter(map(len, map(str.encode, words)), np.int64, n) + 1
        ends, bad = np.cumsum(sizes * good), np.zeros(n, bool)
        bad[order] = ~good
        self.bad = np.concatenate([self.bad, bad])
        for side, size in enumerate((both.a_size, both.b_size)):
            flat = np.concatenate([found[side] for found in ids])
            counts = np.bincount(np.searchsorted(ends, np.cumsum(size[flat])), minlength=n)
            start, count = np.empty((2, n), np.int64)
            start[order], count[order] = np.cumsum(counts) - counts + len(self.ids[side]), counts
            self.ids[side] = np.concatenate([self.ids[side], flat])
            self.start[side], self.count[side] = np.concatenate([self.start[side], start]), np.concatenate([self.count[side], count])
        self.size += int(sizes.sum())

    def of(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side the ids of all texts, and how many each text has; texts without tokens have none."""
        if len(self.index) > MOST_WORDS or self.size > MOST_BYTES:
            self.forget()
        parts, before = [_cut(t) if t else [] for t in texts], len(self.index)
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        del parts
        if len(self.index) > before:
            self.learn(list(islice(self.index, before, None)))
        text = np.repeat(np.arange(len(texts)), counts)
        bad = np.bincount(text, self.bad[at], len(texts)) > 0
        at, ends = at[~bad[text]], np.cumsum(np.where(bad, 0, counts))
        out = []
        for ids, start, count in zip(self.ids, self.start, self.count):
            n = count[at]
            until = np.concatenate([[0], np.cumsum(n)])
            out.append((ids[np.arange(until[-1]) + np.repeat(start[at] - until[:-1], n)], np.diff(until[np.concatenate([[0], ends])])))
        return out


class Links:
    """Links of texts whose ids stand one after the other: one per byte range between neighbouring ends of tokens."""

    def __init__(self, both: Tokenizers, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.both, self.a, self.b, self.n_a, self.n_b = both, a, b, n_a, n_b
        a_end, b_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
        ends = np.zeros(int(a_end[-1]) + 1 if len(a) else 1, np.uint8)  # ends of a side are all different
        ends[a_end] = 1
        ends[b_end] += 2
        ends = ends[ends > 0]
        self.common, self.in_a, self.in_b = ends == 3, ends & 1, ends >> 1
        self.till_a, self.till_b = (np.cumsum(e, dtype=np.int64) for e in (self.in_a, self.in_b))
        # the byte range that ends there is in one token of each side
        kind = both.kind.type
        self.keys = a[self.till_a - self.in_a].astype(both.kind) << kind(both.shift) | b[self.till_b - self.in_b]
        last = np.cumsum(n_a)  # the last A token of a text ends with the text
        self.until = np.concatenate([[0], np.where(last > 0, np.searchsorted(self.till_a, last) + 1, 0)])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text the sum over its links."""
        return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[self.until])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs linked in these texts, and in how many of them."""
        text = np.repeat(np.arange(len(self.n_a)), np.diff(self.until))
        found = _distinct(text << 32 | self.keys) & (1 << 32) - 1
        found.sort()
        first = _first(found)
        return found[first], np.diff(np.append(first, len(found)))

    def groups(self) -> list[str]:
        """Per text its groups (``a1,a2|b1;a3|b2,b3``)."""
        in_a, in_b, group = self.in_a == 1, self.in_b == 1, np.cumsum(self.common) - self.common
        # before an A token are the B tokens of earlier groups, before a B token the A tokens up to its group
        before_b, until_a = np.concatenate([[0], self.till_b[self.common]]), self.till_a[self.common]
        n_a, n_b = len(self.both.a_bytes), len(self.both.b_bytes)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + before_b[group[in_a]]] = self.a.astype(np.int64) + n_a * self.common[in_a]
        codes[np.arange(len(self.b)) + until_a[group[in_b]]] = 2 * n_a + self.b.astype(np.int64) + n_b * self.common[in_b]
        texts, stops = self.both.texts[codes].tolist(), np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(texts[x:y])[:-1].decode() for x, y in zip([0, *stops], stops)]


def _pieces(both: Tokenizers, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
    """The links of these texts; those of one long text in pieces, cut where tokens of both end."""
    own = n_a > 0
    if len(b) <= LONG or np.count_nonzero(own) != 1:
        yield Links(both, a, b, n_a, n_b)
        return
    a_end, b_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
    at = np.searchsorted(a_end, b_end)
    common = np.flatnonzero(a_end[at] == b_end)  # the last tokens end together
    b_stop = common[np.unique(np.searchsorted(common, np.minimum(np.arange(LONG, len(b) + LONG, LONG), len(b) - 1)))]
    stops = [(0, 0), *zip((at[b_stop] + 1).tolist(), (b_stop + 1).tolist())]
    del a_end, b_end, at, common
    for (x, u), (y, v) in zip(stops, stops[1:]):
        yield Links(both, a[x:y], b[u:v], own * (y - x), own * (v - u))


def _pairs(both: Tokenizers, *ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs linked in these texts, and in how many of them."""
    found = [links.pairs() for links in _pieces(both, *ids)]
    if len(found) == 1:
        return found[0]
    keys = _distinct(np.concatenate([keys for keys, _ in found]))  # of one text
    return keys, np.ones_like(keys)


def _first(ordered: np.ndarray) -> np.ndarray:
    """Where each different value of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def _distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[_first(ordered)]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = _first(keys)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


# ---- first pass -----------------------------------------------------------------------------------------------------


def _tokenized(batches, paths: tuple[str, str], rows: bool, pairs: bool):
    """The documents' ids (``rows``), and the task's pairs and their documents by shard (``pairs``); the columns of the other kind are null."""
    both = tokenizers(*paths)
    words, keys, counts, held = Words(both), [], [], 0
    names = ["doc_id", "a", "b", *(f.split()[0] for f in PIECES.split(", "))]
    for batch in slices(batches, "text", SLICE_BYTES):
        (a, n_a), (b, n_b) = words.of(batch["text"].to_pylist())
        id_type = batch.column("doc_id").type
        if rows:
            nulls = [pa.nulls(batch.num_rows, t) for t in (pa.int32(), pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], _binary(a, n_a), _binary(b, n_b), *nulls], names)
        if pairs:
            found = _pairs(both, a, b, n_a, n_b)
            keys.append(found[0])
            counts.append(found[1])
            held += len(found[0])
        if held > HELD:
            merged = _merged(keys, counts)
            keys, counts = [merged[0]], [merged[1]]
            held = len(merged[0]) // 2
    if keys:
        keys, counts = _merged(keys, counts)
        shard, part = (keys >> both.shift) % SHARDS, TaskContext.get().partitionId()
        for s in np.unique(shard).tolist():
            own = shard == s
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([s], pa.int32()), pa.array([part], pa.int64()),
                 pa.array([keys[own].astype(both.kind).tobytes()], pa.binary()), pa.array([counts[own].astype(np.int64).tobytes()], pa.binary())], names)


def _binary(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    raw, stops = ids.tobytes(), (np.cumsum(counts) * ids.itemsize).tolist()
    return pa.array([raw[x:y] for x, y in zip([0, *stops], stops)], pa.binary())


def _tokens(docs: DataFrame, paths: tuple[str, str], rows: bool, pairs: bool) -> DataFrame:
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, a binary, b binary, {PIECES}"
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _tokenized(batches, paths, rows, pairs), schema)


def _row(schema: str, *values) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(f.split() for f in schema.split(", ")))
    return pa.table([pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], kinds[t]) for v, t in zip(values, types)], list(names))


def _arrays(table: pa.Table, column: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table[column].to_pylist()]


def _up(df: DataFrame, combine, schema: str) -> DataFrame:
    """One level of a tree: FAN parts of a shard become one."""
    return df.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("shard", "part").applyInArrow(lambda key, t: combine(key, t), schema)


def count_pairs(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per shard the perfect hash of its pairs (n, sizes, words, keys) and ``counts``: twice a pair's documents, plus 1 where its A id has no higher one."""
    docs = docs.select(F.lit(0).alias("doc_id"), "text")
    return _ranked(staged(_tokens(docs, (a_path, b_path), False, True), "alignment-pieces"), tokenizers(a_path, b_path))


def _ranked(written: DataFrame, both: Tokenizers) -> DataFrame:
    kind, shift = both.kind, both.shift
    pieces = written.where(F.col("shard").isNotNull()).select("shard", "part", "keys", "counts")
    parts = 1 + (pieces.agg(F.max("part")).first()[0] or 0)
    levels = 1
    while FAN ** levels < parts:
        levels += 1

    def distinct(key, table):
        return _row(PIECES, key[0].as_py(), key[1].as_py(), np.unique(np.concatenate(_arrays(table, "keys", kind))), None)

    def hashed(key, table):
        found = PerfectHash.of(np.frombuffer(table["keys"][0].as_py(), kind))
        return _row(TABLE, key[0].as_py(), 0, len(found.keys), found.sizes, found.words, found.keys)

    def dense(key, table, hashes):
        if not table.num_rows or not hashes.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.binary(), pa.binary())], [f.split()[0] for f in PIECES.split(", ")])
        own, vector = _hash(hashes.to_pylist()[0], kind), np.zeros(hashes["n"][0].as_py(), np.int64)
        for keys, counts in zip(_arrays(table, "keys", kind), _arrays(table, "counts", np.int64)):
            at = own.find(keys)
            if len(at) and at.min() < 0:
                raise ValueError("a pair is not in the hash that was made from it")
            vector[at] += counts
        return _row(PIECES, key[0].as_py(), key[1].as_py(), None, vector)

    def summed(key, table):
        vectors = _arrays(table, "counts", np.int64)
        total = vectors[0].copy()
        for v in vectors[1:]:
            total += v
        return _row(PIECES, key[0].as_py(), key[1].as_py(), None, total)

    def ranked(key, hashes, sums):
        keys, counts = np.frombuffer(hashes["keys"][0].as_py(), kind), np.frombuffer(sums["counts"][0].as_py(), np.int64)
        a, own = np.unique(keys >> kind.type(shift), return_inverse=True)
        highest = np.zeros(len(a), np.int64)
        np.maximum.at(highest, own, counts)
        return _row(f"{TABLE}, counts binary", key[0].as_py(), 0, len(keys), *(hashes[c][0].as_py() for c in ("sizes", "words", "keys")), counts * 2 + (counts == highest[own]))

    tree = pieces
    for _ in range(levels):
        tree = _up(tree, distinct, PIECES)
    hashes = staged(tree.groupBy("shard").applyInArrow(lambda key, t: hashed(key, t), TABLE), "alignment-hashes")
    leaves = (parts - 1) // FAN
    copies = hashes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(leaves).cast("long"))))
    tree = pieces.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(
        lambda key, t, h: dense(key, t, h), PIECES)
    for _ in range(levels - 1):
        tree = _up(tree, summed, PIECES)
    return staged(hashes.groupBy("shard").cogroup(tree.groupBy("shard")).applyInArrow(lambda key, h, s: ranked(key, h, s), f"{TABLE}, counts binary"), "alignment-table")


def _hash(row: dict, kind) -> PerfectHash:
    return PerfectHash(np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["words"], np.uint64), np.frombuffer(row["keys"], kind))


# ---- second pass ----------------------------------------------------------------------------------------------------


class Counts:
    """Some shards of a table of pairs."""

    def __init__(self, rows: list[dict], both: Tokenizers):
        self.shift = both.shift
        self.shards = {r["shard"]: (_hash(r, both.kind), np.frombuffer(r["counts"], np.int64)) for r in rows}

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Per pair whether it is its A id's best, and its count."""
        kinds, back = np.unique(keys, return_inverse=True)
        shard = (kinds >> kinds.dtype.type(self.shift)).astype(np.int64) % SHARDS
        order, out = np.argsort(shard, kind="stable"), np.zeros((2, len(kinds)), np.int64)
        shards, starts = np.unique(shard[order], return_index=True)
        for s, own in zip(shards.tolist(), np.split(order, starts[1:])):
            if s in self.shards:
                hashes, counts = self.shards[s]
                at = hashes.find(kinds[own])
                found = np.where(at >= 0, counts[at], 0)
                out[:, own] = found & 1, found >> 1
        return out[:, back]


def _aligned(batches, paths: tuple[str, str], table, later: bool):
    """The rows with what their pairs have in this part of the table; ``later``: added to what earlier rounds found."""
    both = tokenizers(*paths)
    lookup = Counts(table.value, both)
    for batch in slices(batches, "b", SLICE_BYTES // 2):
        ids = [np.frombuffer(b"".join(batch[c].to_pylist()), kind) for c, kind in zip("ab", both.ids)]
        sizes = [pa.compute.binary_length(batch[c]).to_numpy() // kind.itemsize for c, kind in zip("ab", both.ids)]
        sizes = [n.astype(np.int64) for n in sizes]
        sums, groups = np.zeros((4, batch.num_rows), np.int64), []
        for links in _pieces(both, *ids, *sizes):
            sums += [links.sums(links.common), np.diff(links.until), *map(links.sums, lookup(links.keys))]
            if not later:
                groups.append(links.groups())
        if later:
            sums[2] += batch["n_best"].to_numpy()
            sums[3] += batch["count_sum"].to_numpy()
        groups = batch["groups"] if later else pa.array([";".join(filter(None, g)) for g in zip(*groups)], pa.string())
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "a", "b")), *map(pa.array, [*sizes, *sums]), groups], ["doc_id", "a", "b", *(f.split()[0] for f in ALIGNED.split(", "))])


def align(docs: DataFrame, a_path: str, b_path: str, table: DataFrame | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (``a1,a2|b1;a3|b2,b3``).

    Counts are those of ``table``, as ``count_pairs`` gives it; by default of these documents.
    """
    spark, paths = docs.sparkSession, (a_path, b_path)
    written = _tokens(docs, paths, True, table is None)
    if table is None:
        written = staged(written, "alignment-tokens", codec="zstd")
        table = _ranked(written, tokenizers(*paths))
    rounds, held = [[]], 0
    for r in table.select("shard", "n").orderBy("shard").collect():  # SHARDS rows at most
        if rounds[-1] and held + r.n > ROUND:
            rounds, held = [*rounds, []], 0
        rounds[-1].append(r.shard)
        held += r.n
    out = written.where(F.col("shard").isNull()).select("doc_id", "a", "b")
    for i, shards in enumerate(rounds):
        rows = table.where(F.col("shard").isin(shards)).select("shard", "sizes", "words", "keys", "counts").toArrow().to_pylist()
        part = spark.sparkContext.broadcast(rows)
        schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, a binary, b binary, {ALIGNED}"
        out = out.mapInArrow(lambda batches, part=part, i=i: _aligned(batches, paths, part, i > 0), schema)
        if i + 1 < len(rounds):
            out = staged(out, "alignment-round")
    return out.drop("a", "b")

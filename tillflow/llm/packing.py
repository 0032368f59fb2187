"""Packing documents into windows of at most 4096 tokens by order-preserving dynamic programming.

Documents are spread over parts by a hash and stay in the order of their ids within a part. A part is one stream of tokens;
windows are cut at document ends, sentence ends, or, in sentences longer than ``PIECE`` tokens, every ``PIECE`` tokens. The
cuts minimise padding plus penalties for cutting a document or a sentence. Null and empty texts are documents of the end
token alone. Rows with equal ids are packed each for itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import slices, total_bytes

WINDOW = 4096
END_ID = 2
#: Cost, in padding tokens, of ending a window within a document at a sentence end, and within a sentence.
CUT_DOCUMENT, CUT_SENTENCE = 8, 64
PIECE = 256
PART_BYTES = 16 << 20
#: Tokens of a part that are planned at once; the last window's documents move on to the next plan.
PLAN_TOKENS = 1 << 18
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Words(dict):
    """The ids of a word as little-endian bytes. Words never merge across white space, so a text's ids are its words' ids.
    Of more than ``MOST`` words, those that do not come again before as many others have come are forgotten.

    A word of letters with ASCII punctuation behind it is two such units, and letters make one unit only, whose last id is
    the only one that ends a unit: so many of them can be encoded as one text and parted again.
    """

    MOST = 500_000
    MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
    TAIL = re.compile(r"(.*[^!-&(-/:-@\[-`{-~'])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        if len(self) > self.MOST:
            self.older = dict(self)
            self.clear()
        split, stems, odd, older = [], set(), [], self.older
        if older:
            known = words & older.keys()
            self.update((word, older[word]) for word in known)
            words = words - known
        for word in words:
            stem = word.rstrip(self.MARKS)
            if stem.isalpha():  # of bytes: ASCII letters only, the usual case
                key, tail = stem.lower(), word[len(stem):]
            else:
                text = word.decode()
                match = self.TAIL.fullmatch(text)
                stem, tail = (match[1], match[2].encode()) if match else (text, b"")
                stem = stem.lower()
                if not (stem.isalpha() and unicodedata.is_normalized("NFC", stem) and unicodedata.is_normalized("NFC", text)):
                    odd.append((word, text))
                    continue
                key = stem.encode()
            if tail or key != word:
                split.append((word, key, tail))
            if key not in self:
                if key in older:
                    self[key] = older[key]
                else:
                    stems.add(key)
        stems = list(stems)
        groups = [stems[i:i + 256] for i in range(0, len(stems), 256)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            self.update(zip(group, [raw[a:b] for a, b in zip([0, *ends], ends)], strict=True))
        for word, key, tail in split:
            if tail:
                if tail not in self:
                    self[tail] = self.ids(tail.decode())
                self[word] = self[key] + self[tail]
            else:
                self[word] = self[key]
        for word, text in odd:
            self[word] = self.ids(text)


@lru_cache(1)
def _words(path: str) -> Words:
    return Words(path)


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?"]] = True
#: Words are told apart by a polynomial of their bytes modulo 2^64 whose base nobody knows beforehand, longer ones by a keyed
#: hash: some long words of two letters have equal polynomials for every base. Modulo 8 the base is 5, which rules such words
#: out up to ``SHORT`` bytes.
BASE, KEY, SHORT = int.from_bytes(os.urandom(8)) >> 3 << 3 | 5, int.from_bytes(os.urandom(8)), 64


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    return tuple(np.cumprod(np.full(n, base, np.uint64)) for base in (BASE, pow(BASE, -1, 1 << 64)))


def split(texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as bytes; begin, end and hash of each word (at ASCII white space only); how many words each text has."""
    parts = [(t or "").encode() for t in texts]
    data = b"\n".join([b"", *parts, b""])
    raw = np.frombuffer(data, np.uint8)
    space = SPACE[raw]
    begin, end = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
    powers, inverse = _powers(1 << max(21, (len(data) + 1).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw + np.uint64(1)) * powers[: len(raw)], out=sums[1:])
    h = (sums[end] - sums[begin]) * inverse[begin]
    for i in np.flatnonzero(end - begin > SHORT).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[begin[i]:end[i]], KEY)
    edges = np.cumsum([1, *(len(p) + 1 for p in parts)])
    return data, begin, end, h ^ (h >> np.uint64(32)), np.diff(np.searchsorted(begin, edges))


def encode(texts: list[str | None], words: Words) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Per text: ids with the end token, and where a window may end (token positions) with the cost of ending there.

    Each distinct word of the texts is looked up once.
    """
    data, begin, end, h, counts = split(texts)
    kind = pa.array(h).dictionary_encode().indices.to_numpy()
    first = np.zeros(int(kind.max(initial=-1)) + 1, np.int64)
    first[kind[::-1]] = np.arange(len(kind))[::-1]
    keys = [data[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
    found = list(map(words.get, keys))
    if gaps := [i for i, x in enumerate(found) if x is None]:
        words.learn({keys[i] for i in gaps})
        for i in gaps:
            found[i] = words[keys[i]]
    found.append(END_ID.to_bytes(4, "little"))
    ids = np.frombuffer(b"".join(found), "<u4")
    size = np.fromiter(map(len, found), np.int64, len(found)) >> 2
    origin = np.cumsum(size) - size
    # an end token as the last word of each text
    last = np.cumsum(counts)
    kind = np.insert(kind, last, len(found) - 1)
    stops = np.insert(STOP[np.frombuffer(data, np.uint8)[end - 1]], last, False)
    until = np.cumsum(size[kind])
    flat = ids[np.arange(until[-1]) + np.repeat(origin[kind] - until + size[kind], size[kind])].tobytes()
    last += np.arange(len(last))
    begins = np.concatenate([[0], until[last][:-1]])
    places, before = until[stops], 0
    bounds = np.searchsorted(np.flatnonzero(stops), last)
    for i, (start, stop) in enumerate(zip(begins.tolist(), until[last].tolist())):
        ends = np.unique(np.append(places[before:bounds[i]] - start, stop - start - 1))
        before = bounds[i]
        ends = ends[ends > 0]
        steps = np.diff(ends, prepend=0)
        costs = np.full(len(ends), CUT_DOCUMENT)
        if len(steps) and steps.max() > PIECE:
            inner = [np.arange(e - n + PIECE, e, PIECE) for e, n in zip(ends, steps) if n > PIECE]
            at = np.concatenate([ends, *inner])
            costs = np.concatenate([costs, np.full(len(at) - len(ends), CUT_SENTENCE)])
            order = np.argsort(at, kind="stable")
            ends, costs = at[order], costs[order]
        yield flat[start * 4:stop * 4], [*ends.tolist(), stop - start], [*costs.tolist(), 0]


def cuts(ends: list[int], costs: list[int], window: int = WINDOW) -> list[int]:
    """Indexes into ``ends`` of the last position of each window, with the least padding plus cost over all choices.

    best(j) = cost(j) + min over i with ends[j] - ends[i] <= window of best(i) + window - (ends[j] - ends[i]); the part
    that depends on i, best(i) + ends[i], stays in a monotone queue while i is in reach.
    """
    queue = deque([(0, 0, -1)])  # best(i) + ends[i], ends[i], i
    best, before = [], []
    for j, (end, cost) in enumerate(zip(ends, costs)):
        while end - queue[0][1] > window:
            queue.popleft()
        key, _, i = queue[0]
        value = key + window - end + cost
        best.append(value)
        before.append(i)
        key = value + end
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, end, j))
    found, j = [], len(ends) - 1
    while j >= 0:
        found.append(j)
        j = before[j]
    return found[::-1]


class Packer:
    """Plans a stream of documents, a bounded number of tokens at a time, and turns windows into rows of pieces."""

    def __init__(self, part: int):
        self.next = part << 40
        self.docs: list[tuple[int | None, bytes, int]] = []  # id, ids, tokens already packed
        self.ends: list[int] = []
        self.costs: list[int] = []
        self.size = 0

    def add(self, doc_id, ids: bytes, ends: list[int], costs: list[int]) -> None:
        self.docs.append((doc_id, ids, 0))
        self.ends += [self.size + e for e in ends]
        self.costs += costs
        self.size += len(ids) >> 2

    def rows(self, last: bool) -> list[tuple]:
        """Pieces of all planned windows, but for the last one unless the stream ends."""
        plan = cuts(self.ends, self.costs)
        if not last:
            plan = plan[:-1]
        rows, k, passed = [], 0, 0  # passed: tokens before document k
        at = 0
        for j in plan:
            end, offset = self.ends[j], 0
            while at < end:
                doc_id, ids, done = self.docs[k]
                here = done + at - passed
                n = min(end - at, (len(ids) >> 2) - here)
                rows.append((doc_id, here, n, zlib.crc32(ids[here * 4:(here + n) * 4]), len(ids) >> 2, self.next, offset))
                at, offset = at + n, offset + n
                if here + n == len(ids) >> 2:
                    passed += (len(ids) >> 2) - done
                    k += 1
            self.next += 1
        if plan:
            kept = self.docs[k:]
            if kept and at > passed:
                doc_id, ids, done = kept[0]
                kept[0] = (doc_id, ids, done + at - passed)
            self.docs, self.size = kept, self.size - at
            self.ends = [e - at for e in self.ends[plan[-1] + 1:]]
            self.costs = self.costs[plan[-1] + 1:]
        return rows


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    parts = 1 + total_bytes(docs) // PART_BYTES
    spread = F.xxhash64("doc_id", "text")
    ordered = (docs.select("doc_id", "text", spread.alias("h")).repartition(parts, "h").sortWithinPartitions("doc_id", "h"))
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches):
        words, packer = _words(tokenizer), Packer(TaskContext.get().partitionId())
        out = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
        for batch in slices(batches, "text", 2 << 20):
            for doc_id, found in zip(batch["doc_id"].to_pylist(), encode(batch["text"].to_pylist(), words)):
                packer.add(doc_id, *found)
                if packer.size >= PLAN_TOKENS and (rows := packer.rows(last=False)):
                    yield out(rows)
        if packer.size and (rows := packer.rows(last=True)):
            yield out(rows)

    return ordered.mapInArrow(run, SCHEMA)

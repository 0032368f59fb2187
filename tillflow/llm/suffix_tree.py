"""Scoring texts with a probabilistic suffix tree over tokens.

Tokens are words (ASCII lower case) and one end per text. The root predicts by add-one counts. A context of one or two tokens
becomes a state when its repeated successors diverge enough from what its suffix predicts: count times divergence, in nats, must
reach ``GAIN`` for each of them. A state predicts a successor by

    P(x | s) = (c(s, x) + (N(s) - C(s) + KAPPA) * P(x | suffix of s)) / (N(s) + KAPPA)

over its repeated successors c(s, x) >= 2 with sum C(s); rarer ones are left to the suffix. A text is scored at each token with
the longest suffix that is a state.

Texts are cut into tokens once: a task writes blocks of about ``BLOCK_BYTES`` as the block's distinct tokens and their numbers,
which all passes read. Counts cover all learning documents. A context can only repeat where its parts do, so each pass skips what
a bitmap of ``BITS`` bits rules out; the bitmap's size is fixed, and where it is too small for a corpus it only rules out less. For
scoring, a block asks for the values of its distinct tokens and contexts, and is answered in the order it asked. What tasks send
each other are columns of numbers, one row for each part of the keys; a part holds a bounded share of the keys, and there are as
many as the text is long. A part also holds its share of a bitmap.

Null and empty texts are their end token. Rows with equal ids are rows of their own; an empty table gives an empty result; with
nothing to learn from all counts are 0. Words are told apart by 64-bit hashes. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import discard, fold, slices, staged, total_bytes

GAIN, KAPPA = 3.0, 1.0
BITS = 1 << 26
#: Text of a block, of what is cut into tokens at once, and of a part of the keys.
BLOCK_BYTES = 12 << 20
SLICE_BYTES = 1 << 20
PART_BYTES = 8 << 20
#: Blocks are scored in so many rounds: only one round's requests and answers lie on disk at a time.
ROUNDS = 3
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))
ODD = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words of more bytes are hashed one by one.
SHORT = 32
LOW = np.uint64((1 << 32) - 1)


def joined(s: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The id of s followed by x."""
    h = (s ^ (s >> np.uint64(32))) * ODD + x
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts one after another, and how many each text has."""
    parts = [(t or "").encode().lower() for t in texts]
    data = b"\n".join([b"", *parts, bytes(8)])
    space = SPACE[np.frombuffer(data, np.uint8)[:-8]]
    begin, end = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the bytes from each position on
    length = end - begin
    h = length.astype(np.uint64)
    for at in range(0, SHORT, 8):
        own = np.flatnonzero(length > at)
        if not len(own):
            break
        beyond = np.maximum(0, 8 - length[own] + at).astype(np.uint64) << np.uint64(3)
        h[own] = joined(h[own], eight[begin[own] + at] << beyond)
    for i in np.flatnonzero(length > SHORT).tolist():
        h[i] = xxhash.xxh64_intdigest(data[begin[i]:end[i]])
    edges = np.cumsum([1, *(len(p) + 1 for p in parts)])
    size = np.diff(np.searchsorted(begin, edges)) + 1
    ends = np.cumsum(size)
    out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint64)
    plain = np.ones(len(out), bool)
    plain[ends - 1] = False
    out[plain] = h
    return out, size


# ---- columns of numbers ---------------------------------------------------------------------------------------------


class Bitmap:
    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64(BITS - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(keys: DataFrame):
    """A broadcast bitmap of the column ``key``: BITS / 64 rows at most, whatever the number of keys."""
    at = F.col("key").bitwiseAND(F.lit(BITS - 1))
    rows = keys.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((key & {BITS - 1}) & 63 as int))")).alias("bits")).toArrow()
    words = np.zeros(BITS >> 6, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(Bitmap(words))


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of the bitmap's words."""
    return ((key & np.uint64(BITS - 1)) >> np.uint64(6)).astype(np.int64) * parts // (BITS >> 6)


def bits_of(part: int, parts: int, key: np.ndarray) -> bytes:
    """The part's words of a bitmap of these keys, all of that part."""
    first, end = (-(-p * (BITS >> 6) // parts) for p in (part, part + 1))
    bits = np.zeros((end - first) << 6, bool)
    bits[(key & np.uint64(BITS - 1)).astype(np.int64) - (first << 6)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def together(rows: DataFrame, parts: int):
    """A broadcast bitmap from the parts' words: BITS / 8 bytes, whatever the number of keys."""
    words = np.zeros(BITS >> 6, np.uint64)
    for part, bits in zip(*rows.select("part", "bits").toArrow().to_pydict().values()):
        own = np.frombuffer(bits, np.uint64)
        first = -(-part * (BITS >> 6) // parts)
        words[first:first + len(own)] = own
    return rows.sparkSession.sparkContext.broadcast(Bitmap(words))


def by_part(parts: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the keys by part, the parts that occur, and where each begins and the last ends."""
    part = part_of(key, parts)
    if parts < 1 << 16:
        part = part.astype(np.uint16)  # sorted by digits
    order = np.argsort(part, kind="stable")
    part = part[order].astype(np.int64)
    edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    return order, part[edges[:-1]], edges


def dealt(parts: int, key: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each part of the keys that occurs: the part, and the columns' values there as bytes."""
    order, part, edges = by_part(parts, key)
    cut = [pa.array([v[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()) for v in (c[order] for c in columns.values())]
    return pa.RecordBatch.from_arrays([pa.array(part), *cut], ["part", *columns])


def rows_of(schema: str, *batches: pa.RecordBatch) -> pa.Table:
    """The batches as a table; columns that one of them lacks are null."""
    fields = [pa.field(name, pa.binary() if kind == "binary" else pa.int64()) for name, kind in (f.split() for f in schema.split(", "))]
    full = [pa.RecordBatch.from_arrays([b[f.name] if f.name in b.schema.names else pa.nulls(b.num_rows, f.type) for f in fields], schema=pa.schema(fields)) for b in batches]
    return pa.Table.from_batches(full, pa.schema(fields))


def row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], pa.int64() if isinstance(v, int) else pa.binary()) for k, v in values.items()})


def thin(keys: np.ndarray) -> bytes:
    """Keys in order as their differences, byte by byte: the high bytes are zeros, which take no room when compressed."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def thick(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def small(values: np.ndarray) -> bytes:
    """How many eight-byte numbers, and these compressed."""
    return len(values).to_bytes(8, "little") + pa.compress(values.tobytes(), "zstd", asbytes=True)


def large(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little") * 8, "zstd", asbytes=True), kind)


def taken(table: pa.Table, column: str, kind=np.uint64) -> np.ndarray:
    """The values of all rows of a column of bytes."""
    return np.frombuffer(b"".join(x for x in table[column].to_pylist() if x), kind)


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key is, in order, and the sum of its n."""
    order = np.argsort(key)
    first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, np.int64)
    return order[first], np.add.reduceat(n[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)


class Values:
    """The values of keys; 0 for others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, ordered: bool = False):
        order = slice(None) if ordered else np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(wanted), self.values.dtype)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], 0)


# ---- blocks ---------------------------------------------------------------------------------------------------------


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in the order they first occur, and the number of each value's."""
    found = pa.array(values).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def blocks(docs: DataFrame) -> DataFrame:
    """block, ids, held (which are held out), learned, sizes (tokens of each text), words (the block's distinct tokens) and
    codes (its tokens as numbers of these, byte by byte, compressed); ``docs``: doc_id, held_out, text."""
    names = ["block", "ids", "held", "learned", "sizes", "words", "codes"]

    def one(number, ids, held, found, sizes):
        words, codes = numbered(np.concatenate(found))
        often = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")  # frequent tokens have small numbers
        rank = np.empty(len(words), np.int32)
        rank[often] = np.arange(len(words), dtype=np.int32)
        ids, held = pa.concat_arrays(ids), pa.concat_arrays(held).to_numpy(zero_copy_only=False).astype(bool)
        learned = ~held & ids.is_valid().to_numpy(zero_copy_only=False)
        planes = np.ascontiguousarray(rank[codes].view(np.uint8).reshape(-1, 4).T).tobytes()
        columns = [held, learned, np.concatenate(sizes).astype(np.int64), words[often]]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([c.tobytes()], pa.binary()) for c in columns),
             pa.array([pa.compress(planes, "zstd", asbytes=True)], pa.binary())], names)

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 32, ([], [], [], []), 0
        for batch in slices(batches, "text", SLICE_BYTES):
            found = tokens(batch["text"].to_pylist())
            for column, x in zip(held, (batch["doc_id"], batch["held_out"], *found)):
                column.append(x)
            size += pc.sum(pc.binary_length(batch["text"])).as_py() or 0
            if size > BLOCK_BYTES:
                yield one(number, *held)
                number, held, size = number + 1, ([], [], [], []), 0
        if held[0]:
            yield one(number, *held)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"block long, ids array<{kind}>, held binary, learned binary, sizes binary, words binary, codes binary")


class Block:
    def __init__(self, batch: pa.RecordBatch | pa.Table, i: int):
        value = lambda name, kind: np.frombuffer(batch[name][i].as_py(), kind)
        self.number = batch["block"][i].as_py()
        self.held, self.learned = value("held", bool), value("learned", bool)
        self.sizes, self.words = value("sizes", np.int64), value("words", np.uint64)
        planes = pa.decompress(batch["codes"][i].as_py(), int(self.sizes.sum()) * 4, "zstd", asbytes=True)
        self.codes = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.int32).ravel()
        self.starts = np.cumsum(self.sizes) - self.sizes

    def after(self, depth: int, learned: bool = False) -> np.ndarray:
        """Which tokens have so many before them in their text; ``learned``: of learning documents."""
        out = np.repeat(self.learned, self.sizes) if learned else np.ones(len(self.codes), bool)
        for d in range(depth):
            at = self.starts[self.sizes > d] + d
            out[at] = False
        return out

    def runs(self) -> np.ndarray:
        """Ids of the pairs that end with each token."""
        x = self.words[self.codes]
        return joined(np.roll(x, 1), x)


def each_block(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch, i)


# ---- counts ---------------------------------------------------------------------------------------------------------

WORDS = "part long, keys binary, ns binary, total long, kinds long, bits binary"
PAIRS = "part long, ss binary, xs binary, ns binary"
MODEL = "part long, keys binary, ns binary, lams binary, shares binary, bits binary"
STATES = "part long, ids binary, ns binary, ps binary, shares binary, keys binary, lams binary"


def token_counts(texts: DataFrame, parts: int) -> DataFrame:
    """By part: keys and ns of every token, their sum and number, and the bits of those that repeat."""
    def run(batches):
        for block in each_block(batches):
            n = np.bincount(block.codes[block.after(0, True)], minlength=len(block.words))
            own = np.flatnonzero(n)
            yield dealt(parts, block.words[own], {"keys": block.words[own], "ns": n[own].astype(np.uint32)})

    def merge(key, table):
        keys = taken(table, "keys")
        at, n = summed(keys, taken(table, "ns", np.uint32))
        part = key[0].as_py()
        return rows_of(WORDS, row(part=part, keys=keys[at], ns=n, total=int(n.sum()), kinds=len(n), bits=bits_of(part, parts, keys[at[n >= 2]])))
    return texts.mapInArrow(run, "part long, keys binary, ns binary").groupBy("part").applyInArrow(lambda key, t: merge(key, t), WORDS)


def repeated(sent: DataFrame, parts: int) -> DataFrame:
    """Sums up ss, xs, ns by the id of both; by part, what occurs at least twice, and the bits of its ids."""
    def merge(key, table):
        s, x = taken(table, "ss"), taken(table, "xs")
        ids = joined(s, x)
        at, n = summed(ids, taken(table, "ns", np.uint32))
        at, n, part = at[n >= 2], n[n >= 2], key[0].as_py()
        return rows_of(f"{PAIRS}, bits binary", row(part=part, ss=s[at], xs=x[at], ns=n, bits=bits_of(part, parts, ids[at])))
    return sent.groupBy("part").applyInArrow(lambda key, t: merge(key, t), f"{PAIRS}, bits binary")


def distinct(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of numbers and how often each occurs."""
    both = np.sort(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(both))).astype(np.uint32)
    return (both[first] >> np.uint64(32)).astype(np.int64), (both[first] & LOW).astype(np.int64), n


def pair_counts(texts: DataFrame, may_repeat, parts: int) -> DataFrame:
    """ss, xs and ns >= 2 for tokens s before tokens x."""
    def run(batches):
        for block in each_block(batches):
            again = may_repeat.value.has(block.words)[block.codes]
            real = np.flatnonzero(block.after(1, True) & again & np.roll(again, 1))
            s, x, n = distinct(block.codes[real - 1], block.codes[real])
            s, x = block.words[s], block.words[x]
            yield dealt(parts, joined(s, x), {"ss": s, "xs": x, "ns": n})
    return repeated(texts.mapInArrow(run, PAIRS), parts)


def triple_counts(texts: DataFrame, may_repeat, parts: int) -> DataFrame:
    """ss, xs and ns >= 2 for pairs s and the pairs x that begin with the last token of s: three tokens."""
    def run(batches):
        for block in each_block(batches):
            runs = block.runs()
            again = may_repeat.value.has(runs)
            real = np.flatnonzero(block.after(2, True) & again & np.roll(again, 1))
            pairs, number = numbered(runs[real - 1])
            last = np.zeros(len(pairs), np.int64)
            last[number] = block.codes[real - 1]
            s, x, n = distinct(number, block.codes[real])
            x = joined(block.words[last[s]], block.words[x])
            s = pairs[s]
            yield dealt(parts, joined(s, x), {"ss": s, "xs": x, "ns": n})
    return repeated(texts.mapInArrow(run, PAIRS), parts)


# ---- model ----------------------------------------------------------------------------------------------------------


def dealt_by(pairs: DataFrame, column: str, parts: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            s, x, n = taken(batch, "ss"), taken(batch, "xs"), taken(batch, "ns", np.int64)
            yield dealt(parts, s if column == "ss" else x, {"ss": s, "xs": x, "ns": n})
    return pairs.select("ss", "xs", "ns").mapInArrow(run, PAIRS)


def states(pairs: DataFrame, parts: int, below: DataFrame, totals: DataFrame, predicted) -> DataFrame:
    """ids, ns, ps (what the tree predicts), shares (0 where s is no state) of all successors, by part of their ids; keys and lams
    of the states.

    ``pairs``: ss, xs, ns. ``below``: keys and what x's key has there, from which ``predicted`` tells what the suffix predicts; ``totals``: keys and ns.
    """
    found = f"{PAIRS}, lows binary"

    def lower(table, known):
        if not table.num_rows:
            return rows_of(found)
        s, x, n = taken(table, "ss"), taken(table, "xs"), taken(table, "ns", np.int64)
        return rows_of(found, dealt(parts, s, {"ss": s, "xs": x, "ns": n, "lows": predicted(Values(taken(known, "keys"), taken(known, "values", np.int64))(x))}))

    def judged(key, table, known):
        if not table.num_rows:
            return rows_of(STATES)
        s, x, n, p = taken(table, "ss"), taken(table, "xs"), taken(table, "ns", np.int64), taken(table, "lows", np.float64)
        order = np.argsort(s, kind="stable")
        s, x, n, p = s[order], x[order], n[order], p[order]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        kinds, c, total = np.diff(np.append(first, len(s))), np.add.reduceat(n, first), Values(taken(known, "keys"), taken(known, "ns", np.int64))(s[first])
        every = np.repeat(total, kinds)
        state = np.add.reduceat(n * np.log(n / every / p), first) >= GAIN * kinds
        lam = (total - c + KAPPA) / (total + KAPPA)
        share = np.where(np.repeat(state, kinds), n / (every + KAPPA), 0.0)
        p = share + np.repeat(np.where(state, lam, 1.0), kinds) * p
        ids = joined(s, x)
        return rows_of(STATES, dealt(parts, ids, {"ids": ids, "ns": n, "ps": p, "shares": share}), row(part=key[0].as_py(), keys=s[first][state], lams=lam[state]))
    lows = dealt_by(pairs, "xs", parts).groupBy("part").cogroup(below.groupBy("part")).applyInArrow(lambda key, t, k: lower(t, k), found)
    return lows.groupBy("part").cogroup(totals.groupBy("part")).applyInArrow(lambda key, t, k: judged(key, t, k), STATES)


def kept(df: DataFrame, purpose: str) -> DataFrame:
    return staged(df, purpose, tidy=True, codec="zstd")


def model(texts: DataFrame, parts: int) -> tuple[DataFrame, int, int]:
    """By part, the keys of tokens, states and their successors with counts of tokens, weights of states' suffixes and shares of
    successors; then N and V. Tables between the steps go when they have been used."""
    words = kept(token_counts(texts, parts), "tree-tokens")
    total, kinds = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    may_repeat = together(words, parts)
    pairs = kept(pair_counts(texts, may_repeat, parts), "tree-pairs")
    may_repeat.destroy()
    may_repeat = together(pairs, parts)
    one = kept(states(pairs, parts, words.select("part", "keys", F.col("ns").alias("values")), words.select("part", "keys", "ns"),
                      lambda n: (n + 1) / float(total + kinds + 1)), "tree-states")
    discard(pairs)
    pairs = kept(triple_counts(texts, may_repeat, parts).drop("bits"), "tree-pairs")
    may_repeat.destroy()
    known = one.where("ids is not null").withColumnRenamed("ids", "key_").drop("keys").withColumnRenamed("key_", "keys")
    two = kept(states(pairs, parts, known.select("part", "keys", F.col("ps").alias("values")), known.select("part", "keys", "ns"), lambda p: p.view(np.float64)).drop("ns", "ps"),
               "tree-states")
    discard(pairs)

    none = F.lit(None).cast("binary")
    known = words.select("part", "keys", "ns", none.alias("lams"), none.alias("shares"))
    for t in (one, two):
        known = known.union(t.where("keys is not null").select("part", "keys", none, "lams", none)).union(t.where("ids is not null").select("part", "ids", none, none, "shares"))
    every = kept(known.groupBy("part").applyInArrow(lambda key, t: assembled(key, t, parts), MODEL), "tree-model")
    discard(words, one, two)
    return every, total, kinds


def assembled(key, table: pa.Table, parts: int) -> pa.Table:
    """The part's keys in order with their values, 0 where a key has none, and the bits of those that are more than tokens."""
    found = []
    for name, kind in (("ns", np.int64), ("lams", np.float64), ("shares", np.float64)):
        own = table.filter(pc.is_valid(table[name]))
        found.append(Values(taken(own, "keys"), taken(own, name, kind)))
    keys = np.unique(np.concatenate([f.keys[f.values > 0] for f in found]))
    n, lam, share = (f(keys) for f in found)
    part = key[0].as_py()
    return rows_of(MODEL, row(part=part, keys=thin(keys), ns=n, lams=lam, shares=share, bits=bits_of(part, parts, keys[(share > 0) | (n == 0)])))


# ---- scores ---------------------------------------------------------------------------------------------------------


def wanted(block: Block, in_model: Bitmap) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The distinct runs of two and three tokens of a block that the model may hold; for both lengths, where they end and their numbers there."""
    runs = block.runs()
    pair = in_model.has(runs)
    keys, places, size = [], [], 0
    for depth in (1, 2):
        if depth == 1:
            at = np.flatnonzero(block.after(1) & pair)
            ids = runs[at]
        else:  # a run of three is a successor of a pair that is a state
            at = np.flatnonzero(block.after(2) & np.roll(pair, 1))
            ids = joined(runs[at - 1], runs[at])
            real = in_model.has(ids)
            at, ids = at[real], ids[real]
        own, number = numbered(ids)
        keys.append(own), places.append((at, number + size))
        size += len(own)
    return np.concatenate(keys), places


def in_order(parts: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``by_part``, with each part's keys in order."""
    first = np.argsort(keys)
    order, part, edges = by_part(parts, keys[first])
    return first[order], part, edges


ASKED = "block long, part long, keys binary, runs binary"
ANSWERED = "block long, part long, ns binary, lams binary, shares binary, run_lams binary"


def asked(texts: DataFrame, in_model, parts: int) -> DataFrame:
    """The distinct tokens of each block, and its runs that the model may hold, for each part of the keys."""
    def run(batches):
        for block in each_block(batches):
            sent = []
            for column, keys in (("keys", block.words), ("runs", wanted(block, in_model.value)[0])):
                order, part, edges = in_order(parts, keys)
                keys = keys[order]
                sent += [row(block=block.number, part=p, **{column: thin(keys[a:b])}) for p, a, b in zip(part.tolist(), edges[:-1], edges[1:])]
            yield from rows_of(ASKED, *sent).combine_chunks().to_batches()
    return texts.mapInArrow(run, ASKED)


def answered(requests: pa.Table, known: pa.Table) -> pa.Table:
    """For each request the values of its keys, 0 for those that the model's part does not have."""
    keys = thick(b"".join(known["keys"].to_pylist()))  # one row, or none
    value = {name: Values(keys, taken(known, name, kind), True) for name, kind in (("ns", np.int64), ("lams", np.float64), ("shares", np.float64))}
    rows = []
    for r in requests.to_pylist():
        keys = thick(r["keys"] or r["runs"])
        names = {"ns": "ns", "lams": "lams"} if r["keys"] else {"shares": "shares", "run_lams": "lams"}
        rows.append(row(block=r["block"], part=r["part"], **{n: small(value[v](keys)) for n, v in names.items()}))
    return rows_of(ANSWERED, *rows)


def scores(table: pa.Table, found: pa.Table, in_model: Bitmap, parts: int, total: int, kinds: int) -> pa.Table:
    """doc_id, held_out, n_tokens, n_known, base_score and score of a block's documents."""
    block = Block(table, 0)
    runs, places = wanted(block, in_model)

    def values(keys: np.ndarray, name: str, kind) -> np.ndarray:
        """What has come from the parts, in the order of the keys."""
        own = found.filter(pc.is_valid(found[name]))
        out = np.zeros(len(keys), kind)
        out[in_order(parts, keys)[0]] = np.concatenate([np.zeros(0, kind), *(large(x, kind) for x in own.take(pc.sort_indices(own["part"]))[name].to_pylist())])
        return out
    n, lam = values(block.words, "ns", np.int64), values(block.words, "lams", np.float64)
    share, run_lam = values(runs, "shares", np.float64), values(runs, "run_lams", np.float64)
    count = n[block.codes]
    base = (count + 1) / float(total + kinds + 1)
    p, shares, lower = base, np.zeros((2, len(base))), np.zeros((2, len(base)))
    lower[0] = np.roll(lam[block.codes], 1)
    for i, (at, number) in enumerate(places):
        shares[i, at] = share[number]
    lower[1, places[0][0]] = run_lam[places[0][1]]
    lower[1] = np.roll(lower[1], 1)
    for i in range(2):
        p = np.where(block.after(i + 1) & (lower[i] > 0), shares[i] + lower[i] * p, p)
    each = lambda v: pa.array(np.add.reduceat(v, block.starts))
    return pa.table([table["ids"].combine_chunks().flatten(), pa.array(block.held), pa.array(block.sizes), each((count > 0).astype(np.int64)), each(np.log10(base)), each(np.log10(p))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; texts whose crc32(doc_id) leaves 2 by 7 are not learned."""
    docs = docs.select("doc_id", fold("doc_id", 7, 2).alias("held_out"), "text")
    parts = min(1 + total_bytes(docs) // PART_BYTES, BITS >> 6)
    texts = kept(blocks(docs), "tree-blocks")
    known, total, kinds = model(texts, parts)
    in_model = together(known, parts)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = []
    for i in range(ROUNDS):
        own = texts.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == i)
        answers = asked(own, in_model, parts).groupBy("part").cogroup(known.drop("bits").groupBy("part")).applyInArrow(lambda key, r, m: answered(r, m), ANSWERED)
        found = kept(answers, "tree-found")
        rows = own.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(lambda key, t, f: scores(t, f, in_model.value, parts, total, kinds), schema)
        out.append(kept(rows, "tree-scores"))
        discard(found)
    discard(known, texts)
    out = reduce(DataFrame.union, out)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")

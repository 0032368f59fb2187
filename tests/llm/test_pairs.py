"""Hard negatives, tokenizer alignment and the Jaccard join against brute force."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillflow.llm import alignment, jaccard, negatives

from .conftest import documents

SF = "/root/testdata/sf0.01"
A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# ---- hard negatives -------------------------------------------------------------------------------------------------


def mined(rows, anchors, k_positive=5, k_negative=5):
    """rows: (vec_id, label, x); every row is scored against every anchor."""
    out = []
    for own, label, x in anchors:
        scored = sorted(((-int(np.dot(x, y)), i, other) for i, other, y in rows if i != own), key=lambda t: t)
        liked = [(i, -s) for s, i, other in scored if other == label][:k_positive]
        for positive, high in liked:
            found = [(i, -s) for s, i, other in scored if other != label and 80 * high <= -100 * s <= 100 * high][:k_negative]
            out += [(own, positive, n + 1, i, high, s) for n, (i, s) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("block, depth", [(4096, 16), (37, 2)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, depth):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "DEPTH", depth)
    draw = np.random.default_rng(4)
    x = draw.normal(size=(400, 6)).round(2)
    x[350:] = x[300]  # ties
    x[200:210, :3] = 0
    x[20] = 0  # an anchor without components
    labels = draw.integers(0, 4, 400)
    table = spark.createDataFrame([(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(x, labels))], "vec_id long, embedding array<double>, label int")
    rows = [(i, int(n), np.floor(256 * v).astype(int)) for i, (v, n) in enumerate(zip(x, labels))]
    got = sorted(tuple(r) for r in negatives.mine(table, F.col("vec_id") % 20 == 0).collect())
    assert got == mined(rows, rows[::20]) and len(got) > 100


def test_search_stops_early_and_keeps_ties():
    """A threshold equal to the k-th score must not end a search: the row of the smaller id may still be unmet."""
    x = np.array([[10, 0], [9, 1], [5, 5], [0, 10], [1, 1]])
    lists = negatives.Lists(np.array([9, 8, 7, 1, 5]), np.zeros(5, np.int64), x, np.argsort(x, axis=0, kind="stable").T)
    best, = lists.search(np.array([1, 1]), np.ones(5, bool), np.array([-100]), np.array([100]), 2)
    assert lists.ids[best].tolist() == [1, 7]


def test_negatives_odd_and_empty(spark):
    fine = [1.0, 2.0]
    rows = [(0, fine, 1), (0, [1.0, 1.0], 1), (1, fine, 1), (1, fine, 1), (2, [0.9, 2.0], 2), (None, fine, 1), (3, None, 1), (4, [None, 1.0], 2), (5, [float("nan"), 1.0], 2),
            (6, [float("inf"), 1.0], 2), (7, fine, None), (8, [], 2), (9, [1.0], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for clash in ("x", "block", "group", "score", "rank", "place", "scores", "anchor_id"):
        table = table.withColumn(clash, F.lit("clash"))
    got = [tuple(r) for r in negatives.mine(table, F.col("vec_id") == 0).collect()]
    # of the two anchor rows the one with the smaller vector is the anchor; both rows of id 1 are positives
    high, low = 256 * 256 + 256 * 512, 256 * 230 + 256 * 512
    assert got == [(0, 1, 1, 2, high, low)] * 2
    assert negatives.mine(table.limit(0), F.col("vec_id") == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e15], 1), (1, [1e15], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        negatives.mine(huge, F.col("vec_id") == 0).count()


# ---- tokenizer alignment --------------------------------------------------------------------------------------------


def aligned(texts):
    """Whole texts by both tokenizers, links by two pointers, counts by a plain counter."""
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    letters = alignment._byte_letters()
    a_bytes = lambda i: bytes(letters[c] for c in a_model.id_to_token(i))
    b_bytes = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for text in texts:
        a, b = (a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)) if text else ([], [])
        if not a or {b"".join(map(a_bytes, a)), b"".join(map(b_bytes, b))} != {(" " + text).encode()}:
            found.append(None)
            continue
        i = j = at_a = at_b = 0
        links, groups, own = [], [], ([], [])
        at_a, at_b = len(a_bytes(a[0])), len(b_bytes(b[0]))
        while True:
            links.append((a[i], b[j]))
            if not own[0] or own[0][-1] != i:
                own[0].append(i)
            if not own[1] or own[1][-1] != j:
                own[1].append(j)
            step_a, step_b = at_a <= at_b, at_b <= at_a
            if at_a == at_b:
                groups.append(",".join(str(a[k]) for k in own[0]) + "|" + ",".join(str(b[k]) for k in own[1]))
                own = ([], [])
            i, j = i + step_a, j + step_b
            if i == len(a):
                break
            at_a, at_b = at_a + (len(a_bytes(a[i])) if step_a else 0), at_b + (len(b_bytes(b[j])) if step_b else 0)
        found.append((len(a), len(b), groups, links))
    counts = Counter(pair for f in found if f for pair in set(f[3]))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return [(f[0], f[1], len(f[2]), len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), ";".join(f[2])) if f else (0,) * 6 + ("",) for f in found]


def test_alignment_equals_brute_force(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()
    draw = random.Random(3)
    texts = [r.text for r in rows] + ["a  b   c\n\n d\t e", "", "\n", " ", " x", "x ", "  lead", "▁ foo ▁bar", "<|endoftext|> </s> <unk> <0x41>", "日本語 テキスト　空白", "x\x00y",
                                      "é é ​ z", "don't we'll I'M 12,345.67", "a" * 3000, "\x1c \x85 a", None]
    texts += ["".join(draw.choice("ab Zé\n\t  '1.▁日<>|😀\x00​ı") for _ in range(draw.randint(1, 60))) for _ in range(300)]
    table = documents(spark, texts).repartition(5).withColumn("groups", F.lit("clash")).withColumn("part", F.lit("clash"))
    want = aligned(texts)
    for most, fan, words in ((alignment.ROUND, 64, alignment.MOST_WORDS), (10_000, 2, 500)):  # one round and tree level, and several
        monkeypatch.setattr(alignment, "ROUND", most)
        monkeypatch.setattr(alignment, "FAN", fan)
        monkeypatch.setattr(alignment, "MOST_WORDS", words)
        got = alignment.align(table, A, B).collect()
        assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r.doc_id)] == want


def test_alignment_odd_and_empty(odd, empty):
    got, rows = alignment.align(odd, A, B).collect(), odd.collect()
    want = aligned([r.text for r in rows])
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *w) for r, w in zip(rows, want))
    assert alignment.align(empty, A, B).count() == 0


def test_perfect_hash_is_minimal_and_tells_foreign_keys():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(draw.integers(0, 1 << 31, n)).astype(np.uint32)
        found = alignment.PerfectHash.of(keys)
        assert sorted(found.find(keys).tolist()) == list(range(len(keys)))
        foreign = np.setdiff1d(draw.integers(0, 1 << 31, 1000).astype(np.uint32), keys)
        assert (found.find(foreign) == -1).all()


def test_counts_of_another_corpus(spark):
    table = alignment.count_pairs(documents(spark, ["one two"] * 3), A, B)
    got = {r.doc_id: r for r in alignment.align(documents(spark, ["one", "zebra"]), A, B, table).collect()}
    assert (got[0].count_sum, got[0].n_best) == (3 * got[0].n_links, got[0].n_links) and (got[1].count_sum, got[1].n_best) == (0, 0)


def test_alignment_reads_texts_once(spark, tmp_path):
    documents(spark, ["some words", None, "", "some other words"]).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got = alignment.align(docs, A, B)
    assert not set(docs.inputFiles()) & set(got.inputFiles()) and "text" not in got._jdf.queryExecution().analyzed().toString()
    assert got.count() == 4


def test_long_texts_are_linked_in_pieces(monkeypatch):
    both = alignment.tokenizers(A, B)
    (a, n_a), (b, n_b) = alignment.Words(both).of(["", "Some words, été and 日本語 テキスト again: some words  and\n\nmore; antidisestablishmentarianism. " * 9, None])
    whole, pairs = alignment.Links(both, a, b, n_a, n_b), alignment._pairs(both, a, b, n_a, n_b)
    for most in (1, 7, 50, len(b) // 2):
        monkeypatch.setattr(alignment, "LONG", most)
        pieces = list(alignment._pieces(both, a, b, n_a, n_b))
        assert len(pieces) > 1 and np.array_equal(np.concatenate([p.keys for p in pieces]), whole.keys)
        assert [";".join(filter(None, g)) for g in zip(*(p.groups() for p in pieces))] == whole.groups()
        assert np.array_equal(sum(p.sums(p.common) for p in pieces), whole.sums(whole.common))
        assert all(map(np.array_equal, alignment._pairs(both, a, b, n_a, n_b), pairs))


def test_quick_ways_to_words_and_their_ids():
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choice("aé  \n\t\x1c\x85\xa0\u2003\u200b日") for _ in range(draw.randint(1, 9)))
        assert alignment._cut(text) == alignment.CUT.split(text)
    both = alignment.tokenizers(A, B)
    latin = [chr(i) for i in range(1, 256)]
    texts = [" " + x + c + y + x for c in latin for x in ["", "a", "1", "é", "'", "\n", "\xa0"] for y in latin[::5]]
    assert [both.quick.encode_ordinary(t) for t in texts] == [f.ids for f in both.a.encode_batch(texts, add_special_tokens=False)]
    words = ["abc", "été", "naïve\x85x", "日本", "ı", "\xa0x", "x\u2003", "a▁b", "ÿ", "Ā"]
    assert alignment._kinds(words).tolist() == [0, 0, 0, 1, 1, 2, 2, 2, 0, 1]


# ---- Jaccard join ---------------------------------------------------------------------------------------------------


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def joined(sets):
    """Smallest id reachable by links, all pairs compared."""
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)):
                same = len(x & y)
                if 100 * same >= 85 * (len(x) + len(y) - same):
                    low, high = sorted((top(a), top(b)))
                    root[high] = low
    return sorted((i, len(sets[i]), top(i)) for i in ids)


def test_jaccard_on_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in jaccard.near_duplicates(table).collect())
    assert got == joined({r.doc_id: shingles(r.text) for r in table.collect()})


@pytest.mark.parametrize("block", [1024, 3])
def test_jaccard_near_the_threshold(spark, monkeypatch, block):
    """Chains of edits, lengths of all sizes, a passage that all share, and clusters whose texts are near but not linked."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HELD", 500)
    draw = random.Random(7)
    word = lambda: f"w{draw.randrange(10_000)}"
    shared, texts = [word() for _ in range(30)], []
    for n in (1, 2, 3, 4, 6, 8, 9, 10, 11, 13, 15, 20, 30, 45, 70, 150, 400):
        base = [word() for _ in range(n)]
        texts += [base, shared + base]
        for _ in range(6):
            now = list(base)
            for _ in range(max(1, n // draw.choice((20, 40, 60, 100)))):
                at = draw.randrange(len(now))
                now[at:at + draw.choice((0, 1, 1))] = draw.choice(([word()], [], [word(), word()])) or [word()]
            texts += [now, now + base[:n // draw.choice((5, 8, 12))], shared + now]
            base = draw.choice((base, now))
    texts = [" ".join(t) for t in texts]
    texts += [t.upper() for t in texts[::9]]
    got = sorted(tuple(r) for r in jaccard.near_duplicates(documents(spark, texts).repartition(6)).collect())
    want = joined({i: shingles(t) for i, t in enumerate(texts)})
    assert got == want and 20 < sum(i != c for i, _, c in want) < len(texts) - 20


def test_bitmaps_never_rule_out_a_link():
    draw = np.random.default_rng(2)
    for n in (10, 100, 1000):
        both = draw.integers(0, 1 << 63, n).astype(np.uint64)
        for extra in range(0, n // 6, max(1, n // 60)):
            x, y = (np.unique(np.concatenate([both, draw.integers(0, 1 << 63, e).astype(np.uint64)])) for e in (extra, n // 7 - extra if extra < n // 7 else 0))
            same = len(np.intersect1d(x, y))
            if 100 * same >= 85 * (len(x) + len(y) - same):
                maps = [np.frombuffer(jaccard.bitmap(h, 85), np.uint8) for h in (x, y)]
                assert jaccard.may_link(len(x), maps[0], np.array([len(y)]), maps[1].reshape(1, -1), 85)[0]


def test_jaccard_odd_and_empty(odd, empty):
    got, rows = jaccard.near_duplicates(odd).collect(), odd.collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((r.doc_id, len(shingles(r.text))) for r in rows)
    equal = {}
    for r in rows:
        if shingles(r.text) and r.doc_id is not None:
            equal[shingles(r.text)] = min(r.doc_id, equal.get(shingles(r.text), r.doc_id))
    want = Counter((r.doc_id, equal.get(shingles(r.text)) if shingles(r.text) else r.doc_id) for r in rows)
    assert Counter((r.doc_id, r.component_id) for r in got) == want
    assert jaccard.near_duplicates(empty).count() == 0

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ebbtide.llm import lm_score as L

from .fixtures import copies, empty, odd_rows, table


def trained(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2


def tokens(t):
    return [w.lower() for w in (t or "").encode().split()] + [None]


def check_base(got, rows):
    count = Counter(w for i, t, _ in rows if trained(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted(
        (str(i), not trained(i), len(ws := tokens(t)), sum(count[w] > 0 for w in ws), n,
         round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6))
        for i, t, _ in rows
    )
    assert want == sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got
    )


@pytest.mark.parametrize("common", [1 << 18, 4])
def test_base_score(spark, monkeypatch, common):
    """With few common words most counts come by the join."""
    monkeypatch.setattr(L, "COMMON_WORDS", common)
    rows = copies() + odd_rows()
    check_base(L.score(table(spark, rows)).collect(), rows)


def test_empty(spark):
    assert L.score(empty(spark)).collect() == []
    (r,) = L.score(table(spark, [(2, "a", None), ])).collect()
    assert r["n_tokens"] == 2


def plain_tree(texts, depth):
    """Context-tree weighting with dictionaries: the log2 probability of the last byte of a context."""
    counts = Counter()
    for t in texts:
        x = b"\n" * depth + t
        for i in range(depth, len(x)):
            for b in range(8):
                bits = (x[i] >> (8 - b)) | 1 << b
                for d in range(depth + 1):
                    counts[x[i - d : i], bits, x[i] >> (7 - b) & 1] += 1
    nodes = {(c, p) for c, p, _ in counts}

    def kt(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    weighted = {}
    for c, p in sorted(nodes, key=lambda k: -len(k[0])):
        own = kt(counts[c, p, 0], counts[c, p, 1])
        if len(c) == depth:
            weighted[c, p] = own
        else:
            longer = sum(weighted[k, p] for k, q in nodes if q == p and len(k) == len(c) + 1 and k[1:] == c)
            weighted[c, p] = np.logaddexp(math.log(0.5) + own, math.log(0.5) + longer)

    def one(context, p, d=0):
        c = context[len(context) - d :]
        if (c, p) not in nodes:
            return 0.5
        z, o = counts[c, p, 0], counts[c, p, 1]
        if d == depth:
            return (o + 0.5) / (z + o + 1)
        stop = math.exp(math.log(0.5) + kt(z, o) - weighted[c, p])
        return stop * (o + 0.5) / (z + o + 1) + (1 - stop) * one(context, p, d + 1)

    def log_probability(context, byte):
        total = 0.0
        for b in range(8):
            p1 = one(context, (byte >> (8 - b)) | 1 << b)
            total += math.log(p1 if byte >> (7 - b) & 1 else 1 - p1)
        return total

    return log_probability


def test_tree_as_plain(monkeypatch):
    monkeypatch.setattr(L, "DEPTH", 3)
    texts = [b"the cat sat on the mat\n", b"a cat and a hat\n", b"the end\n"]
    data = np.frombuffer(b"".join(t[:-1] for t in texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) - 1 for t in texts])
    codes, n = L.grams(data, offsets, 0, 3)
    assert n.tolist() == [len(t) for t in texts]
    levels = [np.unique(codes & np.uint64((1 << (8 * (d + 1))) - 1), return_counts=True) for d in range(4)]
    tree = L.Tree.build(levels)
    plain = plain_tree(texts, 3)
    wanted = [b"the ", b"at o", b"zzzq", b"a ca", b" hat", b"nd\nz", b"\n\n\nt"]
    got = tree.log_probability(np.array([int.from_bytes(w) for w in wanted], np.uint64))
    assert got == pytest.approx([plain(w[:3], w[3]) for w in wanted], abs=1e-5)


@pytest.mark.parametrize("held", [1 << 18, 4, 0])
def test_score_of_the_whole_tree(spark, monkeypatch, held):
    """However few contexts the tasks hold, the score is that of all that was seen."""
    monkeypatch.setattr(L, "GRAMS", held)
    learned = [i for i in range(40) if trained(i)][:3]
    apart = [i for i in range(40) if not trained(i)][:2]
    texts = dict(zip([*learned, *apart], ["the cat sat on the mat", "a cat and a hat", "the end", "a hat that sat", "Zzq \u00e9 the"]))
    got = {r["doc_id"]: r for r in L.score(table(spark, [(i, t, None) for i, t in texts.items()])).collect()}
    plain = plain_tree([texts[i].encode() + b"\n" for i in learned], L.DEPTH)
    for i, t in texts.items():
        x = b"\n" * L.DEPTH + t.lower().encode() + b"\n"
        want = sum(plain(x[k - L.DEPTH : k], x[k]) for k in range(L.DEPTH, len(x))) / math.log(10)
        assert got[i]["score"] == pytest.approx(want, abs=1e-4) and got[i]["held_out"] == (i in apart)


def test_probabilities_sum_to_one(monkeypatch):
    monkeypatch.setattr(L, "DEPTH", 2)
    codes = np.array([int.from_bytes(w) for w in (b"abc", b"abd", b"bcd", b"xab", b"abc")], np.uint64)
    levels = [np.unique(codes & np.uint64((1 << (8 * (d + 1))) - 1), return_counts=True) for d in range(3)]
    levels[2] = tuple(a[:2] for a in levels[2])  # some contexts are not held
    tree = L.Tree.build(levels)
    for context in (b"ab", b"zb", b"zz"):
        every = np.array([int.from_bytes(context + bytes([c])) for c in range(256)], np.uint64)
        assert np.exp(tree.log_probability(every)).sum() == pytest.approx(1, abs=1e-4)


def test_training_text_costs_less(spark):
    rows = [(i, "the same words come again and again in every text", None) for i in range(30)]
    strange = next(i for i in range(100, 200) if not trained(i))
    got = {r["doc_id"]: r for r in L.score(table(spark, [*rows, (strange, "qzx jvk wpy" * 4, None)])).collect()}
    assert got[5]["bits_per_byte"] < 0.7 and got[strange]["bits_per_byte"] > 3 and got[strange]["held_out"]

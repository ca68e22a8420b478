import hashlib
from collections import Counter

import pytest

from ebbtide.llm.substring_dedup import remove_repeats
from ebbtide.llm.suffix_dedup import remove_later_copies

from .fixtures import copies, empty, odd_rows, table


def brute_words(rows, length):
    """Words kept of each distinct (number, text)."""
    docs = {(i, t): (t or "").encode().split() for i, t, _ in rows}
    seen = Counter(tuple(w[a : a + length]) for w in docs.values() for a in range(len(w) - length + 1))
    out = {}
    for key, w in docs.items():
        gone = [False] * len(w)
        for a in range(len(w) - length + 1):
            if seen[tuple(w[a : a + length])] > 1:
                gone[a : a + length] = [True] * length
        out[key] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def brute_bytes(rows, length):
    docs = sorted({(i, t) for i, t, _ in rows}, key=lambda k: (k[0] is not None, k[0] or 0))
    seen, out = set(), {}
    for key in docs:
        x = (key[1] or "").encode()
        gone = bytearray(len(x))
        for a in range(len(x) - length + 1):
            w = x[a : a + length]
            if w in seen:
                gone[a : a + length] = b"\1" * length
            seen.add(w)
        out[key] = (len(x), sum(gone), bytes(c for c, g in zip(x, gone) if not g))
    return out


def texts_of(rows):
    out = {}
    for i, t, _ in rows:
        out.setdefault(i, []).append(t)
    return out


@pytest.mark.parametrize("length, seed", [(12, 3), (35, 6)])
def test_words(spark, length, seed):
    rows = copies() + [(1000, "a b " * 60, "en"), (1001, "z " * 100, "en"), (1002, "a b " * 9 + "c", "en")]
    got = remove_repeats(table(spark, rows), length, seed).collect()
    want = brute_words(rows, length)
    assert len(got) == len(rows)
    for r in got:
        (text,) = texts_of(rows)[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept"]) == want[r["doc_id"], text]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


@pytest.mark.parametrize("length, seed", [(20, 5), (100, 20)])
def test_bytes(spark, length, seed):
    rows = copies() + [(1000, "ab" * 200, "en"), (1001, "é" * 150, "en"), (1002, "xyz" * 90 + "q", "en")]
    got = remove_later_copies(table(spark, rows), length, seed).collect()
    want = brute_bytes(rows, length)
    for r in got:
        (text,) = texts_of(rows)[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], bytes(r["kept"])) == want[r["doc_id"], text]


def test_odd_rows(spark):
    rows = odd_rows()
    words = remove_repeats(table(spark, rows)).collect()
    want = brute_words(rows, 35)
    assert sorted((str(r["doc_id"]), r["kept"]) for r in words) == sorted((str(i), want[i, t][2]) for i, t, _ in rows)
    cut = remove_later_copies(table(spark, [r for r in rows if r[0] != 5])).collect()
    want = brute_bytes([r for r in rows if r[0] != 5], 100)
    assert sorted((str(r["doc_id"]), hashlib.sha256(r["kept"]).hexdigest()) for r in cut) == sorted(
        (str(i), hashlib.sha256(want[i, t][2]).hexdigest()) for i, t, _ in rows if i != 5
    )


def test_empty_tables(spark):
    assert remove_repeats(empty(spark)).collect() == []
    assert remove_later_copies(empty(spark)).collect() == []

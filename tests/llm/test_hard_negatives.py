import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, positives string, y int, x int"


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def brute(rows, step):
    """The result by plain loops over whole numbers of any size."""
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x * 256) for x in v):
            continue
        held[i] = min(held.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in held.items()}

    def score(a, b):
        return max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(whole[a][1], whole[b][1]))))

    out = set()
    for a in (i for i in whole if i % step == 0):
        others = sorted(((-score(a, b), b) for b in whole if b != a))
        same = [(s, b) for s, b in others if whole[b][0] == whole[a][0]][:5]
        for s, p in same:
            fit = [(t, b) for t, b in others if whole[b][0] != whole[a][0] and 80 * -s <= 100 * -t <= 100 * -s]
            out |= {(a, p, k + 1, b, -s, -t) for k, (t, b) in enumerate(fit[:5])}
    return out


def drawn(seed, n, size=6):
    rng = random.Random(seed)
    return [(i, [rng.choice([0.5, -0.25, 0.1, 0.003, -1.0, rng.uniform(-1, 1)]) for _ in range(size)], rng.randrange(4)) for i in range(n)]


def mined(spark, rows, step=5):
    got = H.hard_negatives(H.usable(embeddings(spark, rows).repartition(3)), F.col("vec_id") % step == 0).collect()
    assert len(set(map(tuple, got))) == len(got)
    return set(map(tuple, got))


def test_against_plain_loops(spark):
    rows = drawn(1, 120)
    assert mined(spark, rows) == brute(rows, 5) != set()


def test_many_cells_and_parts(spark, monkeypatch):
    rows = drawn(2, 90)
    monkeypatch.setattr(H, "BLOCK", 8)
    monkeypatch.setattr(H, "FEWEST", 8)
    assert mined(spark, rows) == brute(rows, 5)


def test_odd_rows(spark):
    rows = drawn(3, 60)
    rows += [(None, [1.0] * 6, 1), (100, None, 1), (105, [1.0] * 6, None), (110, [1.0, None], 1), (115, [float("nan")] * 6, 1)]
    rows += [(120, [float("inf")] * 6, 1), (125, [1.7e308] * 6, 1), (130, [], 1), (135, [0.5] * 9, 2), (140, [0.25], 2)]
    rows += [(10, rows[10][1], rows[10][2])] * 3 + [(15, [0.5] * 6, 0), (15, [0.25] * 6, 3)]  # repeated rows and numbers
    rows += [(200 + i, [0.5] * 6, i % 2) for i in range(40)]  # one very common vector
    assert mined(spark, rows) == brute(rows, 5)
    assert mined(spark, []) == set()
    assert mined(spark, [(5, [1.0], 1)]) == set()
    assert mined(spark, [(5, [1.0], 1), (6, [1.0], 1), (7, [0.9], 2)]) == {(5, 6, 1, 7, 65536, 256 * 230)}


def test_large_components(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 3, 6, 9]) for _ in range(4)], i % 3) for i in range(40)]
    assert mined(spark, rows) == brute(rows, 5)
    rows += [(50 + i, [1e200, -1e150, 0.0, 1e18 * i], i % 3) for i in range(6)]
    assert mined(spark, rows) == brute(rows, 5)


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_products(data):
    high = data.draw(st.sampled_from([1, 160, 5_000, 1 << 23, 1 << 40]))
    size = data.draw(st.integers(1, 9))
    vectors = st.lists(st.lists(st.integers(-high, high), min_size=size, max_size=size), min_size=1, max_size=11)
    a, c = data.draw(vectors), data.draw(vectors)
    kind = np.int64 if high < 1 << 24 else object
    got = H.packed_products(np.array(a, kind), np.array(c, kind))
    want = [[max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(p, q)))) for q in c] for p in a]
    assert got.tolist() == want


@pytest.mark.parametrize("kind", [np.int64, object])
def test_best_with_ties(kind):
    scores = np.array([[5, 7, 7, 1, 7], [0, 0, 0, 0, 0], [-3, -3, -9, 2, 2]]).astype(kind)
    allowed = np.array([[1, 1, 1, 1, 0], [0, 0, 0, 0, 0], [1, 1, 1, 1, 1]], bool)
    row, column = H.best(scores, allowed, 3)
    assert list(zip(row.tolist(), column.tolist())) == [(0, 1), (0, 2), (0, 0), (2, 3), (2, 4), (2, 0)]

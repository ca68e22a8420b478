import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbtide.llm import importance
from ebbtide.llm.importance import joined_crc, resampled, runs_of

from .fixtures import copies, empty, odd_rows, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5, min_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for text in texts for f in features(text)[1]) for texts in ([r[1] for r in rows], target))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text, *_ in rows:
        words, fs = features(text)
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(fs), gain, gain + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    eligible = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = percent * len(eligible) // 100
    done = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(eligible)]
    return Counter(done + [(*r, None) for r in out if r[1] < min_words])


@pytest.mark.parametrize("percent, min_words", [(5, 20), (50, 3), (100, 0)])
def test_against_plain_loops(spark, percent, min_words):
    rows = copies(n=60) + odd_rows() + [(900 + i, f"Straße {i} ÀÉ à-la_Carte 3.14 x{i % 7}\x00y " * 9, None) for i in range(30)]
    target = [r[1] for r in copies(seed=12, n=9)] + [None, "", "Straße ÀÉ à la carte"]
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = resampled(table(spark, rows).repartition(5), bench, percent, min_words).collect()
    assert Counter(map(tuple, got)) == brute(rows, target, percent, min_words)


def test_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resampled(empty(spark), bench).collect() == []
    rows = [("a", "one two " * 20), ("b", None), ("b", None)]
    got = resampled(spark.createDataFrame(rows, "doc_id string, text string"), bench, 100).collect()
    assert Counter(map(tuple, got)) == brute(rows, [], 100)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=8), st.lists(st.binary(max_size=70_000), min_size=1, max_size=3))
def test_crc_of_parts(firsts, seconds):
    pairs = [(a, b) for a in firsts for b in seconds]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    got = joined_crc(crc([a for a, _ in pairs]), crc([b for _, b in pairs]), np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB9 é-\n漢\x00_", max_size=30), max_size=6))
def test_runs(texts):
    got = Counter((int(d), int(b[r])) for docs, runs, b in runs_of(pa.array(texts, pa.string())) for d, r in zip(docs, runs))
    assert got == Counter((i, zlib.crc32(f.encode()) % 10_000) for i, x in enumerate(texts) for f in features(x)[1])


def test_groups_of_any_size_agree(spark, monkeypatch):
    rng = random.Random(4)
    texts = pa.array([" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(60))) for _ in range(40)])
    whole = [len(b) for _, b in importance._groups(iter([pa.record_batch({"text": texts})]))]
    monkeypatch.setattr(importance, "GROUP_BYTES", 50)
    cut = [len(b) for _, b in importance._groups(iter([pa.record_batch({"text": texts})]))]
    assert whole == [40] and sum(cut) == 40 and len(cut) > 10

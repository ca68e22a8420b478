import random
from collections import Counter

import pytest

from ebbtide.llm.line_dedup import without_shared_lines

from .fixtures import copies, empty, odd_rows, table

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_docs, min_chars):
    """The result by plain loops."""
    seen = Counter()
    for _, text, _ in rows:
        seen.update({key(line) for line in (text or "").split("\n")})
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or seen[key(x)] < min_docs]
        out.append((i, text, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def lined(seed, n):
    rng = random.Random(seed)
    pool = ["Imprint ", "\timprint", "ÉTÉ", "été", "All rights reserved.", "", " \x0b", " ", "漢字", "a\rb"]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"line {rng.randrange(40)} of {i % 9}" for _ in range(rng.randrange(12))]
        rows.append((i, "\n".join(lines), None))
    return rows


@pytest.mark.parametrize("min_docs, min_chars", [(1, 0), (3, 1), (4, 5), (10, 1)])
def test_against_plain_loops(spark, min_docs, min_chars):
    rows = lined(3, 60) + odd_rows() + copies(n=10) + [(99, "a\n\nb\n", None), (100, "\n" * 50, None)]
    got = without_shared_lines(table(spark, rows).repartition(5), min_docs, min_chars)
    assert Counter(map(tuple, got.collect())) == brute(rows, min_docs, min_chars)


def test_one_line_in_all_rows_and_a_text_of_many_lines(spark):
    rows = [(i, f"Same footer\nown {i}\nSAME FOOTER ", None) for i in range(3000)]
    rows.append((5000, "\n".join("same footer" if i % 2 else f"x{i}" for i in range(40_000)), None))
    got = {r["doc_id"]: r for r in without_shared_lines(table(spark, rows).repartition(4)).collect()}
    assert all(got[i]["kept_text"] == f"own {i}" and got[i]["n_dropped"] == 2 for i in range(3000))
    assert got[5000]["n_dropped"] == 20_000 and got[5000]["kept_text"] == "\n".join(f"x{i}" for i in range(0, 40_000, 2))


def test_numbers_as_text_and_nothing(spark):
    rows = [(f"d{i}", "shared\nown") for i in range(2)] + [(None, "shared")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted(map(tuple, without_shared_lines(docs, 3).select("doc_id", "n_dropped", "kept_text").collect()), key=repr)
    assert got == [("d0", 1, "own"), ("d1", 1, "own"), (None, 1, "")]
    assert without_shared_lines(empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = without_shared_lines(table(spark, lined(1, 5)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

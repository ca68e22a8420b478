import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import exact_dedup, sharding
from ebbtide.llm.exact_dedup import exact_groups
from ebbtide.llm.sharding import communication_matrix, hypergeometric, shuffled_shards

from .fixtures import copies, empty, odd_rows, table


def test_exact_groups(spark):
    rows = copies() + odd_rows()
    got = exact_groups(table(spark, rows).repartition(7)).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(i)
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        ids = groups[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (min(known) if known else None)
        assert r["group_size"] == len(ids)
        if r["kept"]:
            kept[r["text_sha256"]] += 1
            assert r["doc_id"] == r["keep_id"]
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_exact_groups_of_nothing(spark):
    assert exact_groups(empty(spark)).collect() == []


def test_shards(spark):
    rows = copies() + odd_rows()
    got = shuffled_shards(table(spark, rows).repartition(5), shards=7).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_few_rows_and_none(spark):
    assert shuffled_shards(empty(spark)).collect() == []
    assert [r["slot"] for r in shuffled_shards(table(spark, [(1, "a", None)])).collect()] == [0]


def test_matrix_has_both_sums(spark):
    """Also where the tree has several levels and some partitions are without rows."""
    for bits in (1, 2, 5):
        counts = {0: 10, 2: 7, 3: 25, 9: 1, 41: 300}
        sizes = [58, 57, 57, 57, 57, 57]
        given = spark.createDataFrame(list(counts.items()), "part int, n bigint")
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(sharding, "FAN_OUT_BITS", bits)
            got = {r["part"]: r["row"] for r in communication_matrix(given, sizes, 41, 3).collect()}
        assert {p: sum(r) for p, r in got.items()} == counts
        assert [sum(c) for c in zip(*got.values())] == sizes
        assert min(min(r) for r in got.values()) >= 0


def test_hypergeometric_law(spark):
    from math import comb

    n = 20_000
    for good, bad, draws in ((6, 9, 5), (3, 2, 4), (40, 1, 7), (0, 5, 3), (5, 0, 3), (4, 4, 0)):
        take = hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), sharding.uniform(F.lit(1), F.col("id")))
        got = {r["k"]: r["n"] for r in spark.range(n).groupBy(take.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for k in range(draws + 1):
            p = comb(good, k) * comb(bad, draws - k) / comb(good + bad, draws) if k <= good and draws - k <= bad else 0
            assert abs(got.get(k, 0) / n - p) < 4 * (p * (1 - p) / n) ** 0.5 + 1e-3
        assert sum(got.values()) == n


def test_large_draws(spark):
    take = hypergeometric(F.lit(10**8), F.lit(23 * 10**8), F.lit(10**7), sharding.uniform(F.lit(2), F.col("id")))
    got = [r["k"] for r in spark.range(30).select(take.alias("k")).collect()]
    mean, deviation = 10**7 / 24, (10**7 / 24 * 23 / 24) ** 0.5
    assert all(abs(k - mean) < 6 * deviation for k in got) and len(set(got)) > 25


def test_repeated_rows_meet_all_shards(spark):
    rows = [(7, "the same row", None)] * 240 + [(i, f"row {i}", None) for i in range(2400)]
    got = shuffled_shards(table(spark, rows).repartition(3)).where("doc_id = 7 AND text_crc32 = " + str(zlib.crc32(b"the same row")))
    met = Counter(r["shard"] for r in got.collect())
    assert sum(met.values()) == 240 and len(met) == 24 and max(met.values()) <= 25


def test_identifiers_as_text_and_no_python(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x", 1), (None, None, 2), ("a", "x", 1)], "doc_id string, text string, shard int")
    docs.write.parquet(str(tmp_path / "d"))
    got = shuffled_shards(spark.read.parquet(str(tmp_path / "d")), shards=2)
    assert sorted((r["doc_id"] or "", r["size"]) for r in got.collect()) == [("", 8), ("a", 9), ("a", 9)]
    plan = got._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "ExistingRDD", "LogicalRDD"))


def test_shuffle_is_uniform(spark):
    """Over some seeds rows of every partition meet every shard about as often, and no row always the same one."""
    docs = table(spark, [(i, str(i), None) for i in range(36)]).repartition(3).cache()
    met, of_row = Counter(), defaultdict(set)
    for seed in range(10):
        for r in shuffled_shards(docs, shards=3, seed=seed).collect():
            met[r["doc_id"] % 4, r["shard"]] += 1
            of_row[r["doc_id"]].add(r["shard"])
    assert all(15 <= met[i, s] <= 45 for i in range(4) for s in range(3))
    assert all(len(s) > 1 for s in of_row.values())


def test_runs_are_sorted_and_merged_in_rounds(spark):
    """A digest in every run, runs that are read in pieces, and each round's runs in order with every digest once."""
    rows = [(run * 10 + i, f"t{(run * i) % 7}", run) for run in range(20) for i in range(10)] + [(None, "t1", 3)] * 5
    given = spark.createDataFrame(rows, "doc_id bigint, t string, run int").select(
        "run",
        F.sha2("t", 256).alias("text_sha256"),
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.length("t").alias("bytes"),
        F.xxhash64("t").alias("hash"),
    )
    given = spark.createDataFrame(given.collect(), given.schema).repartition(6)
    runs = exact_dedup.sorted_runs(given)
    for bits in (3, 3):
        runs = exact_dedup.merge_runs(runs, bits)
        parts = runs.withColumn("task", F.spark_partition_id()).collect()
        assert len({(r["run"], r["text_sha256"]) for r in parts}) == len(parts)
        by_task = defaultdict(list)
        for r in parts:
            by_task[r["task"]].append((r["run"], r["text_sha256"]))
        assert all(keys == sorted(keys) for keys in by_task.values())
    want = defaultdict(list)
    for i, t, _ in rows:
        want[hashlib.sha256(t.encode()).hexdigest()].append(i)
    got = {r["text_sha256"]: (r["keep_id"], r["n"]) for r in runs.collect()}
    assert got == {d: (min(i for i in ids if i is not None), len(ids)) for d, ids in want.items()}


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_entries_that_go_on_in_the_next_batch(size):
    entries = [(0, "a", 1), (0, "a", 4), (0, "a", None), (0, "b", 2), (1, "b", 3), (1, "b", 5), (2, "c", None)]
    batch = pa.RecordBatch.from_pylist(
        [{"run": r, "text_sha256": d, "keep_id": i, "row": k, "n": 1, "bytes": 1, "hash": ord(d)} for k, (r, d, i) in enumerate(entries)]
    )
    parts = [batch.slice(a, size) for a in range(0, len(entries), size)]
    got = [(r["run"], r["text_sha256"], r["keep_id"], r["n"]) for b in exact_dedup._merged(iter(parts)) for r in b.to_pylist()]
    assert got == [(0, "a", 1, 3), (0, "b", 2, 1), (1, "b", 3, 2), (2, "c", None, 1)]


def test_two_texts_of_one_digest_stop_the_job():
    rows = [{"run": 0, "text_sha256": "d", "keep_id": k, "row": k, "n": 1, "bytes": 1 + k, "hash": 1} for k in range(2)]
    with pytest.raises(ValueError, match="share a digest"):
        list(exact_dedup._merged(iter([pa.RecordBatch.from_pylist(rows)])))


def test_exact_groups_of_identifiers_as_text(spark):
    docs = spark.createDataFrame([("b", "x  y"), ("a", "x y"), (None, "x\ty"), ("c", "z"), (None, None)], "doc_id string, text string")
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(docs.repartition(3)).collect()}
    assert got == {("b", "a", 3, False), ("a", "a", 3, True), (None, "a", 3, False), ("c", "c", 1, True), (None, None, 1, True)}

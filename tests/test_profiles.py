import random

import edgelog as E
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ebbtide.plans import digests, discovery, history, quality
from ebbtide.sources import changelog, topics
from ebbtide.specs import GOODS_INFO, ORDER_GOODS

KV = "id int, part string, x double, y string"


def drawn(seed, n):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", None]), rng.choice([1.5, None, -0.25]), rng.choice(["p", "q", None])) for i in range(n)]


@pytest.fixture(scope="module")
def pair(spark):
    left = drawn(1, 400)
    right = [r for r in left if r[0] not in (5, 77)] + [(900, "a", 1.0, None)]
    right = [(i, a, None, "changed") if i == 33 else (i, a, None, str(x)) if i == 40 else (i, a, x, y) for i, a, x, y in right]
    right.append(left[8])  # a repeated row
    return spark.createDataFrame(left, KV), spark.createDataFrame(right, KV).repartition(5)


def test_digests_find_what_comparing_all_rows_finds(pair):
    left, right = pair
    assert rows(digests.differences_by_digests(left, right, ["id"])) == rows(quality.differences(left, right))
    want = quality.reconcile(left, right, ["id"], "t")
    assert rows(digests.reconcile_by_digests(left, right, ["id"], "t"), *want.columns) == rows(want)
    same = digests.reconcile_by_digests(left, left.repartition(3), ["id"], "t").first()
    assert same["identical"] and same["left_rows"] == 400
    assert digests.reconcile_by_digests(left.limit(0), left.limit(0), ["id"], "t").first()["identical"]


def test_few_rows_are_opened(spark):
    left = spark.range(20_000).select("id", F.sha1(F.col("id").cast("string")).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 777, "other").otherwise(F.col("v")))
    trees = [digests.saved_tree(df, ["id"]) for df in (left, right)]
    nodes = digests.differing_nodes(*trees)
    assert rows(nodes.groupBy("level").count()) == [(0, 1), (1, 1), (2, 1)]
    assert 1 <= digests.rows_to_open(left, nodes, ["id"]).count() < 20
    # every level adds up to all rows
    assert {r["sum(n)"] for r in trees[0].groupBy("level").sum("n").collect()} == {20_000}
    # null is no value, and its column matters
    a, b = (spark.createDataFrame([r], KV) for r in ((1, "a", None, None), (1, None, None, "a")))
    assert digests.differences_by_digests(a, b, ["id"]).count() == 2


def brute_keys(table, names, largest):
    from itertools import combinations

    found = []
    for n in range(1, largest + 1):
        for s in combinations(range(len(names)), n):
            values = [tuple(r[i] for i in s) for r in table]
            if any(set(k) <= set(s) for k in found) or any(None in v for v in values):
                continue
            if len(set(values)) == len(values):
                found.append(s)
    return {tuple(names[i] for i in s) for s in found}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_minimal_keys(spark, seed):
    rng = random.Random(seed)
    table = [(i // 6, i % 6, rng.randrange(5), rng.choice("abc"), rng.choice(["x", None]), rng.randrange(40)) for i in range(36)]
    names = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(table, "a int, b int, c int, d string, e string, f long")
    got = set(discovery.minimal_keys(df, largest=3))
    assert got == brute_keys(table, names, 3) and ("a", "b") in got
    assert discovery.minimal_keys(df.limit(0)) == []
    assert discovery.minimal_keys(df.union(df), largest=3) == []


def test_keys_in_slices(spark, monkeypatch):
    """However few values are grouped at once, a value that repeats anywhere shows, and keys are found."""
    rows = [(i, i % 40, i // 40, i if i != 77 else 76) for i in range(120)]
    df = spark.createDataFrame(rows, "a INT, b INT, c INT, d INT")
    for at_once in (7, 100, 1000):
        monkeypatch.setattr(discovery, "VALUES_AT_ONCE", at_once)
        assert set(discovery.minimal_keys(df, largest=2)) == {("a",), ("b", "c"), ("b", "d")}


def test_references(spark):
    parent = spark.createDataFrame([(i, f"n{i}") for i in range(300)], "p_id long, p_name string")
    child = spark.createDataFrame([(i, i % 290 if i % 7 else None, f"n{i % 11}", i + 1) for i in range(5000)], "c_id int, fk_id int, fk_name string, near int")
    tables = {"parent": parent, "child": child}
    got = discovery.discovered_references(tables, [("parent", "p_id"), ("parent", "p_name"), ("child", "c_id")])
    found = {(r["child_table"], r["fk_column"], r["parent_table"], r["parent_column"]): r for r in got.collect()}
    assert set(found) == {
        ("child", "fk_id", "parent", "p_id"), ("child", "fk_name", "parent", "p_name"),
        ("child", "fk_id", "child", "c_id"), ("parent", "p_id", "child", "c_id"),
    }
    assert found["child", "fk_id", "parent", "p_id"]["named_alike"] and found["child", "fk_name", "parent", "p_name"]["n_values"] == 11
    assert discovery.discovered_references(tables, []).collect() == []


@pytest.mark.parametrize("spans", [1, 3, 64])
def test_history(spark, spans):
    events = topics.decode_topic(E.rich().df(spark), ORDER_GOODS)
    versions = history.history(events, ORDER_GOODS, spans).cache()
    for position in (-1, 0, 9, 17, 29):
        want = changelog.replay(events.where(F.col("seq") <= position), ORDER_GOODS)
        assert rows(history.at_positions(versions, [position]).drop("position")) == rows(want)
    assert versions.where("valid_to <= valid_from").count() == 0
    assert history.history(events.limit(0), ORDER_GOODS, spans).count() == 0


@pytest.mark.parametrize("spans", [1, 4, 64])
def test_as_of_join(spark, spans):
    rng = random.Random(spans)
    log, state, held = E.Log(), {}, []
    for seq in range(120):
        k = rng.choice([5, 5, 5, 6, 7])
        old = state.get(k)
        new = None if old and rng.random() < 0.3 else E.product(k, rng.choice(["food", "toys", None]))
        log.add(GOODS_INFO, "c" if old is None else "d" if new is None else "u", old, new)
        state[k] = new
        held.append(dict(state))
    facts = [(i, rng.choice([5, 6, 7, 8, None]), rng.randrange(-5, 130)) for i in range(300)]
    want = []
    for i, k, at in facts:
        then = held[min(at, 119)].get(k) if at >= 0 else None
        want.append((i, then["category_level1"] if then else None))
    events = topics.decode_topic(log.df(spark), GOODS_INFO)
    df = spark.createDataFrame(facts, "i int, g long, at long")
    got = history.as_of_join(df, events, GOODS_INFO, ["g"], "at", ["category_level1"], spans)
    assert rows(got, "i", "category_level1") == sorted(want, key=repr)
    assert history.as_of_join(df, events.limit(0), GOODS_INFO, ["g"], "at", ["brand"], spans).where("brand IS NULL").count() == 300

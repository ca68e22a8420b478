from collections import Counter

from ebbtide.llm.jaccard_join import Rule, similar_groups
from ebbtide.llm.suffix_dedup import remove_later_copies
from ebbtide.llm.texts import identified

from .fixtures import empty, odd_rows, table


def test_documents_are_numbered_in_order(spark):
    rows = odd_rows()
    got = identified(table(spark, rows).repartition(5), "test").collect()
    assert Counter({(r["doc_id"], r["text"]): r["copies"] for r in got}) == Counter((i, t) for i, t, _ in rows)
    assert len({r["uid"] for r in got}) == len(got)
    in_order = [r["doc_id"] for r in sorted(got, key=lambda r: r["uid"])]
    assert in_order == sorted(in_order, key=lambda i: (i is not None, i or 0))


def test_unique_numbers_stay(spark):
    got = identified(table(spark, [(9, "a", None), (-3, None, None)]), "test").collect()
    assert {(r["uid"], r["doc_id"], r["text"], r["copies"]) for r in got} == {(9, 9, "a", 1), (-3, -3, None, 1)}
    assert identified(empty(spark), "test").collect() == []


def test_identifiers_as_text(spark):
    docs = spark.createDataFrame(
        [("b", "x"), ("a", None), (None, "y"), ("a", None), ("10", "z"), ("9", "z")], "doc_id string, text string"
    )
    got = sorted(identified(docs.repartition(4), "test").collect(), key=lambda r: r["uid"])
    assert [(r["doc_id"], r["text"], r["copies"]) for r in got] == [
        (None, "y", 1), ("10", "z", 1), ("9", "z", 1), ("a", None, 2), ("b", "x", 1)
    ]


def test_operators_take_identifiers_as_text(spark):
    same = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([("b", same), ("a", same), ("c", "something else entirely"), (None, None)], "doc_id string, text string")
    got = {r["doc_id"]: r["component_id"] for r in similar_groups(docs, Rule()).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", None: None}
    removed = {r["doc_id"]: r["n_removed"] for r in remove_later_copies(docs).collect()}
    assert removed == {"a": 0, "b": len(same), "c": 0, None: 0}

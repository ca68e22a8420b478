import random
import re

from pyspark.sql import functions as F

import corpus_pipeline as P
from ebbtide.llm import language_id

from .fixtures import SCHEMA, table
from .test_jaccard_join import brute
from .test_language_id import corpus

QUESTION = "Alice has 12 apples and gives 5 of them to Bob before the two walk home together and count what is left of all."


def rows_of():
    rng = random.Random(12)
    rows = corpus(700)
    texts = [t for _, t, _ in rows]
    rows += [(1000 + i, texts[i].replace(" ", "  ", 2), "en") for i in range(20)]  # equal but for white space
    for i in range(20, 50):
        w = texts[i].split()
        if len(w) > 40:
            rows.append((2000 + i, " ".join(w[:-1] + ["theand"]), "en"))  # near copies
    rows += [(3000, texts[60] + " " + QUESTION, "en"), (3001, None, "en"), (3002, "12 34 !!", None)]
    rows += [(3003, "zxqj kvwq pzxk jqxv " * 30, None), rows[3], (rows[4][0], texts[70] + " theing", "en")]
    rng.shuffle(rows)
    return rows


def test_stages(spark, tmp_path):
    rows = rows_of()
    table(spark, rows).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, docs = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out-{i}"))
        docs = spark.read.parquet(str(tmp_path / f"out-{i}"))
        if i < len(P.STAGES) - 1:
            assert docs.columns == SCHEMA.names
            kept.append(sorted(((r["doc_id"], r["text"]) for r in docs.collect())))
    # language: what the model rejects
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    judged = language_id.predict(read, language_id.fit(read)).where("NOT rejected")
    assert [i for i, _ in kept[0]] == sorted(r["doc_id"] for r in judged.collect())
    assert not {3001, 3002, 3003} & {i for i, _ in kept[0]} and 3000 in {i for i, _ in kept[0]}
    # exact
    best = {}
    for i, t in kept[0]:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        best[key] = min(best.get(key, (i, t)), (i, t))
    assert kept[1] == sorted(best.values())
    # near
    groups = brute([(i, t, None) for i, t in kept[1]], P.NEAR)
    assert kept[2] == sorted(k for k, (_, _, first) in groups.items() if first)
    # leaks
    assert kept[3] == [d for d in kept[2] if d[0] != 3000]
    # tokens
    last = docs.collect()
    assert sorted(r["doc_id"] for r in last) == [i for i, _ in kept[3]]
    assert all(r["n_tokens"] == len(r["ids"]) for r in last)
    again = P.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, last))


def test_nothing(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []




def test_clashing_names_repeated_rows_and_no_labels(spark, tmp_path):
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    long = " ".join(f"word{i} and" for i in range(40))
    rows = [(1, long, None, "b"), (1, long, None, "a"), (2, long + " more", None, "c"), (3, "quite another text " * 4, None, "d")]
    schema = "doc_id long, text string, lang string, _number string"
    names = ["_id", "_hash", "_digest", "_sha", "_Again", "_place", "first", "g"]
    docs = spark.createDataFrame(rows, schema).select("*", *[F.lit("x").alias(n) for n in names])
    kept = [stage(spark, docs, str(tmp_path)) for _, stage in P.STAGES[:4]]
    assert all(k.columns == docs.columns for k in kept)
    got = [sorted((r["doc_id"], r["_number"]) for r in k.collect()) for k in kept]
    assert got[0] == got[3] == [(1, "a"), (1, "b"), (2, "c"), (3, "d")]  # no label: all stay; no leak: all stay
    assert got[1] == [(1, "a"), (2, "c"), (3, "d")]
    assert got[2] == [(1, "a"), (3, "d")]

"""Small tables of documents with the cases that every operator must take."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *(T.StructField(c, T.StringType()) for c in ("uid", "h", "node", "shard", "ids", "kept", "component", "score")),
    ]
)


def table(spark, rows):
    """Documents from ``(doc_id, text, lang)``."""
    full = [(i, t, lang, None, None if t is None else len(t), *["x"] * 8) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return table(spark, [])


def sentence(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Null, empty and blank texts, a null number, repeated rows, repeated numbers, a very long text."""
    rng = random.Random(5)
    long = sentence(rng, 30_000, 5_000)
    same = sentence(rng, 80)
    return [
        (1, None, None),
        (2, "", "en"),
        (3, " \t\n ", None),
        (None, same, "en"),
        (4, same, "en"),
        (4, same, "en"),
        (5, same + " and more", "fr"),
        (5, "another text of number five", "fr"),
        (6, long, "en"),
        (7, long[: len(long) // 2], None),
        (8, "éàü 漢字 😀 " * 30, "de"),
    ]


def copies(seed=11, n=40):
    """Texts that share passages, copies and near copies."""
    rng = random.Random(seed)
    passage = sentence(rng, 45, 900)
    rows = []
    for i in range(n):
        text = sentence(rng, rng.randrange(3, 160), 900)
        kind = i % 5
        if kind == 1:
            text = sentence(rng, 20, 900) + " " + passage + " " + sentence(rng, 20, 900)
        elif kind == 2 and rows:
            text = rows[-1][1]
        elif kind == 3 and rows:
            w = rows[-1][1].split()
            w[len(w) // 2] = "edited"
            text = "  ".join(w)
        elif kind == 4:
            text = passage[: rng.randrange(40, len(passage))] + " end"
        rows.append((i * 3, text, "en"))
    return rows

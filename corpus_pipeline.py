"""A corpus pipeline: five stages, each one of the operators in ``ebbtide.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm import bpe, decontaminate, exact_dedup, jaccard_join, language_id
from ebbtide.llm.registry import table
from ebbtide.session import work_dir

#: Near duplicates: shingles of five words, similarity of 0.8 or more.
NEAR = jaccard_join.Rule(words=5, over=80, under=100, sketch=2)


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of ``docs`` is called so, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _first_of_repeated(rows: DataFrame, again: str, columns: list[str], by: list[str]) -> DataFrame:
    """Rows that are not marked as repeated, and of those that are one for each value of ``by``: the first by all columns."""
    (place,) = _free(rows, "_place")
    first = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    repeated = rows.where(F.col(again)).withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    return rows.where(~F.col(again)).select(columns).unionByName(repeated.select(columns))


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known; those without letters or unlike all that was learned go.

    Null and empty texts go. Without any label to learn from, all texts with a letter stay. Repeated rows are judged alike.
    """
    return language_id.recognised(docs, language_id.fit(docs))


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts are equal but for white space: that with the smallest number.

    Null texts count as empty and are one group with blank ones. Of rows with the smallest number in the group, the first
    by text and other columns stays. A group without any number keeps its first row.
    """
    number, sha, again = _free(docs, "_number", "_sha", "_again")
    groups = exact_dedup.exact_groups(docs)
    keepers = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy(F.col("doc_id").alias(number), F.col("text_sha256").alias("_text_sha"))
        .agg((F.count(F.lit(1)) > 1).alias(again))
        .select(number, F.col("_text_sha").alias(f"{sha}_k"), again)
    )
    text = exact_dedup.normalized(F.col("text"))
    kept = docs.withColumn(sha, F.sha2(text.cast("binary"), 256)).join(
        keepers, [F.col("doc_id").eqNullSafe(F.col(number)), F.col(sha) == F.col(f"{sha}_k")]
    )
    return _first_of_repeated(kept, again, docs.columns, [number, sha])


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest number.

    Texts without words are near nothing and stay. Of rows with equal number and text, the first by other columns stays.
    """
    number, digest, again = _free(docs, "_number", "_digest", "_again")
    firsts = (
        jaccard_join.similar_groups(docs, NEAR)
        .where("first")
        .groupBy(F.col("doc_id").alias(number), F.col("text_hash").alias(digest))
        .agg((F.count(F.lit(1)) > 1).alias(again))
    )
    same = F.col("doc_id").eqNullSafe(F.col(number)) & (F.xxhash64("text") == F.col(digest))
    return _first_of_repeated(docs.join(firsts, same), again, docs.columns, [number, digest])


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts stay; of repeated rows all go or all stay."""
    number, digest = _free(docs, "_number", "_digest")
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias(number), F.col("text_hash").alias(digest)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(number)) & (F.xxhash64("text") == F.col(digest))
    return docs.join(leaked, same, "left_anti")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``: each document as tokens, and digests of both ways."""
    return bpe.round_trip(docs, bpe.public_codec(), with_ids=True)


STAGES = [
    ("language_id", known_languages),
    ("exact_dedup", one_of_equal),
    ("ngram_jaccard_join", one_of_near),
    ("benchmark_decontamination", without_leaks),
    ("byte_bpe", encoded),
]

#: SQL has no language models; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is a table in the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    root = work_dir(spark, "corpus-pipeline")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}-{name}")
        docs = spark.read.parquet(f"{root}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

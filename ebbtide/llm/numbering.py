"""A number for each row of a table of documents, whatever its ``doc_id`` holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import work_dir


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``uid, doc_id, text``: each row under a number of its own.

    Whole numbers that are unique and not null serve as they are. Otherwise
    (nulls, repeated rows, numbers as text) the rows are written once to the
    shared folder with a number each, so that all later reads agree on it.
    Nothing is sorted, and texts are not shuffled.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        counted = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        if counted.where("n > 1 OR doc_id IS NULL").isEmpty():
            return rows.select(F.col("doc_id").cast("bigint").alias("uid"), "doc_id", "text")
    path = work_dir(docs.sparkSession, name)
    rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text").write.parquet(path)
    return docs.sparkSession.read.parquet(path)

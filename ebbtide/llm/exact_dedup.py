"""Exact dedup: a tree merge of sorted digest runs.

Each input partition gives one run: its digests in order, every digest once,
with the smallest identifier that holds it and the number of its rows. In every
round ``FAN_IN`` neighbouring runs exchange their entries by digest, the sorted
pieces that meet in a task are merged into one sorted stream, and neighbouring
entries of one digest become one, so that a text with copies in every partition
still reaches a round as one entry of each run. A run is spread over tasks by
digest; no task holds a whole run, and a task holds one batch of its stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.session import work_dir

#: Runs that one round merges into one, as a power of two.
FAN_IN_BITS = 3

SPACES = r"[\x20\x09-\x0D]+"

#: What two entries of one digest must agree in.
_PROOF = ("bytes", "hash")


def normalized(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry for each digest of each run, from entries in the order of ``_in_order``.

    The first of equal entries has the smallest identifier. The last entry of a
    batch waits for the next one, as the digest may go on there.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        run = _column(batch, "run")
        digest = batch.column(batch.schema.get_field_index("text_sha256"))
        same = np.zeros(batch.num_rows, bool)
        same[1:] = (run[1:] == run[:-1]) & pc.equal(digest[1:], digest[:-1]).to_numpy(zero_copy_only=False)
        for c in _PROOF:
            x = _column(batch, c)
            if (same[1:] & (x[1:] != x[:-1])).any():
                raise ValueError("two texts share a digest")
        first = np.flatnonzero(~same)
        at = batch.schema.get_field_index("n")
        out = batch.take(pa.array(first))
        out = out.set_column(at, batch.schema.field(at), pa.array(np.add.reduceat(_column(batch, "n"), first)))
        held = out.slice(out.num_rows - 1)
        yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def _in_order(entries: DataFrame) -> DataFrame:
    """Each task's entries by run and digest, then by identifier (null last) and row."""
    return entries.sortWithinPartitions("run", "text_sha256", F.col("keep_id").asc_nulls_last(), "row")


def sorted_runs(digests: DataFrame) -> DataFrame:
    """The runs of a table of ``run, text_sha256, doc_id, row, bytes, hash``: sorted where they are read, without exchange.

    A run that is read by several tasks is some sorted pieces, which the first round merges.
    """
    entries = digests.select(
        "run", "text_sha256", F.col("doc_id").alias("keep_id"), "row", F.lit(1).cast("bigint").alias("n"), *_PROOF
    )
    return _in_order(entries).mapInArrow(_merged, entries.schema)


def merge_runs(runs: DataFrame, bits: int) -> DataFrame:
    """One round: runs whose numbers agree without their last ``bits`` bits become one.

    Entries of one digest must agree in length and second digest; a digest
    that does not stops the job.
    """
    exchanged = runs.withColumn("run", F.shiftright("run", bits)).repartition("run", "text_sha256")
    return _in_order(exchanged).mapInArrow(_merged, runs.schema)


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row of ``docs`` (``doc_id``, ``text``, others ignored).

    Texts are equal when they are the same after each run of white space is
    one space; null counts as empty. The row with the smallest ``doc_id`` stays,
    a null ``doc_id`` only if the group has no other; of rows with that same
    ``doc_id`` exactly one stays. ``doc_id`` may be of any type that has an order.
    """
    spark = docs.sparkSession
    root = work_dir(spark, "exact-dedup")
    text = normalized(F.col("text"))
    docs.select(
        "doc_id",
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        F.octet_length(text).alias("bytes"),
        F.xxhash64(text).alias("hash"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
    ).write.parquet(f"{root}/digests")
    digests = spark.read.parquet(f"{root}/digests")

    top = digests.agg(F.max("run")).first()[0] or 0
    runs = merge_runs(sorted_runs(digests), FAN_IN_BITS)
    while top >> FAN_IN_BITS > 0:
        top >>= FAN_IN_BITS
        runs = merge_runs(runs, FAN_IN_BITS)
    groups = runs.select("text_sha256", "keep_id", F.col("row").alias("_kept_row"), F.col("n").alias("group_size"))
    return digests.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("_kept_row")).alias("kept"), "text_sha256"
    )

SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM d
"""


@query("op10_exact_dedup", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of equal texts with the number of the one that stays; nulls, ties and repeated rows as in ``exact_groups``."""
    return exact_groups(table(spark, sf_dir, "documents"))

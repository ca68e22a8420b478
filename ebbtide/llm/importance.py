"""Target-distribution importance resampling: documents drawn in proportion to how like a target their n-grams are.

Features are runs of 1 to 3 words, counted in buckets of their CRC. Arrow
kernels cut a batch of texts into words and give every distinct word a number;
runs are shifted numbers, so a run is spelt out for no occurrence: the CRC of a
distinct run follows from the CRCs of its distinct words. Documents then sum
the gains of their buckets, and the highest sums with Gumbel noise are drawn,
which is sampling without replacement in proportion to the weights' exponentials.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.llm.texts import small_batches
from ebbtide.session import work_dir

BUCKETS = 10_000
#: Words in the longest run.
LONGEST = 3
#: Gains and noise are kept as whole thousandths.
SCALE = 1000
#: Documents of fewer words are not drawn; of the others so many in a hundred are.
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: What stands between words, after A-Z have become a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text looked at together; a longer text is looked at whole.
GROUP_BYTES = 1 << 22

_U32 = np.uint32


@cache
def _byte_table() -> np.ndarray:
    """What one byte does to a CRC register."""
    t = np.arange(256, dtype=_U32)
    for _ in range(8):
        t = np.where(t & _U32(1), (t >> _U32(1)) ^ _U32(0xEDB88320), t >> _U32(1))
    return t


def _tables(images: np.ndarray) -> np.ndarray:
    """Four tables of 256 for the linear map that takes bit ``i`` of a register to ``images[i]``."""
    out = np.zeros((4, 256), _U32)
    for byte in range(4):
        for bit in range(8):
            with_bit = (np.arange(256) >> bit) & 1 == 1
            out[byte, with_bit] ^= images[8 * byte + bit]
    return out


def _mapped(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & _U32(255)] ^ tables[1][(x >> _U32(8)) & _U32(255)] ^ tables[2][(x >> _U32(16)) & _U32(255)] ^ tables[3][x >> _U32(24)]


@cache
def _zeros(power: int) -> np.ndarray:
    """Tables for what ``2**power`` zero bytes do to a register."""
    bits = _U32(1) << np.arange(32, dtype=_U32)
    if power == 0:
        return _tables(_byte_table()[bits & _U32(255)] ^ (bits >> _U32(8)))
    half = _zeros(power - 1)
    return _tables(_mapped(half, _mapped(half, bits)))


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of strings put together from those of their two parts, and the second's length in bytes."""
    x = first.copy()
    for power in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero((length >> power) & 1)
        x[at] = _mapped(_zeros(power), x[at])
    return x ^ second


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Document and word number of each word of a batch, and the distinct words."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    words, parents = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.greater(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(words.filter(real))
    return (
        parents.filter(real).to_numpy(zero_copy_only=False).astype(np.int64),
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        coded.dictionary.cast(pa.binary()).to_pylist(),
    )


def runs_of(texts: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: the document and the number of each run, and the bucket of each number."""
    docs, words, dictionary = words_of(texts)
    crc = np.fromiter((zlib.crc32(w) for w in dictionary), _U32, len(dictionary))
    # each further word of a run comes with the space before it
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in dictionary), _U32, len(dictionary))
    lengths = np.fromiter((len(w) + 1 for w in dictionary), np.int64, len(dictionary))
    at, runs = np.arange(len(words)), words
    for n in range(1, longest + 1):
        yield docs[at], runs, (crc % _U32(buckets)).astype(np.int64)
        if n == longest or not len(at):
            return
        longer = at + n < len(words)
        at, runs = at[longer], runs[longer]
        longer = docs[at + n] == docs[at]
        at, runs = at[longer], runs[longer]
        distinct, runs = np.unique(runs * len(dictionary) + words[at + n], return_inverse=True)
        before, last = distinct // len(dictionary), distinct % len(dictionary)
        crc = joined_crc(crc[before], spaced[last], lengths[last])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Rows of about ``GROUP_BYTES`` of text, with their texts; null is empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < len(batch):
            before = int(ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(ends, before + GROUP_BYTES, side="right")))
            yield batch.slice(i, j - i), texts.slice(i, j - i)
            i = j


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that has any. A task sends a bucket once."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in _groups(batches):
            for _, runs, bucket in runs_of(texts, buckets, longest):
                times = np.bincount(runs, minlength=len(bucket))
                total += np.bincount(bucket, weights=times, minlength=buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(held, pa.int32()), "n": pa.array(total[held], pa.int64())})

    small_batches(docs.sparkSession)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight: how much more frequent it is in the target.

    ``floor(SCALE * ln(((t + 1) * (S + buckets)) / ((s + 1) * (T + buckets))))`` with the counts ``s`` and ``t`` of the
    bucket and ``S`` and ``T`` of all. The driver sees one number for each bucket and side, however large the tables are.
    """
    counts = []
    for df in (docs, target):
        of = np.zeros(buckets, np.int64)
        for bucket, n in bucket_counts(df, buckets, longest).collect():
            of[bucket] = n
        counts.append(of)
    s, t = counts
    high, low = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array(
        [math.floor(SCALE * math.log((float(a) + 1.0) * high / ((float(b) + 1.0) * low))) for a, b in zip(t, s)], np.int64
    )


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``doc_id, n_words, n_features, weight``, one row for each row: its features' gains are summed."""
    kind = docs.schema["doc_id"].dataType

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(gain)
        for batch, texts in _groups(batches):
            rows = np.arange(len(texts) + 1)
            n_words, n_features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for n, (of, runs, bucket) in enumerate(runs_of(texts, len(gain), longest)):
                cut = np.searchsorted(of, rows)
                of_runs = pc.take(table, pa.array(bucket)).to_numpy()
                total = np.concatenate(([0], np.cumsum(of_runs[runs])))
                weight += total[cut[1:]] - total[cut[:-1]]
                n_features += cut[1:] - cut[:-1]
                if n == 0:
                    n_words += cut[1:] - cut[:-1]
            columns = {"doc_id": batch.column(batch.schema.get_field_index("doc_id"))}
            yield pa.record_batch({**columns, "n_words": n_words, "n_features": n_features, "weight": weight})

    small_batches(docs.sparkSession)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(summed, f"doc_id {kind.simpleString()}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a digest of the seed and ``doc_id`` alone; a null one is hashed as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``, one row for each row of ``docs`` (``doc_id``, ``text``).

    ``rank`` counts from 1 along falling scores, equal ones by ``doc_id`` (nulls last), and is null for rows that
    are not drawn: those of fewer than ``min_words`` words, and all but ``percent`` of a hundred of the others. Null
    and empty texts have no feature and weight 0. Each row is a document, so repeated rows share their score and
    can both be drawn. Other columns are not read; ``doc_id`` may be of any type. An empty table gives an empty
    result, an empty ``target`` counts 0 for every bucket.
    """
    spark = docs.sparkSession
    root = work_dir(spark, "importance")
    scored = weighted(docs, gains(docs, target)).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored.write.parquet(f"{root}/scored")
    scored = spark.read.parquet(f"{root}/scored")
    enough = F.col("n_words") >= min_words
    # A range-sorted table: a row's rank is its place in its part and the rows of all parts before.
    (
        scored.where(enough)
        .orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        .withColumn("at", F.monotonically_increasing_id())
        .write.parquet(f"{root}/ordered")
    )
    ordered = spark.read.parquet(f"{root}/ordered").withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, total = {}, 0
    for part, n in parts:
        before[part] = total
        total += n
    drawn = percent * total // 100
    # as one array: there are as many parts as the sort has tasks
    firsts = F.from_json(F.lit(json.dumps([before.get(i, 0) for i in range(max(before, default=0) + 1)])), "array<bigint>")
    rank = F.element_at(firsts, F.col("part").cast("int") + 1) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = ordered.withColumn("rank", F.when(rank <= drawn, rank)).select(*scored.columns, "rank")
    return ranked.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint")))


@query("op12_importance_resampling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of each row of ``documents``, drawn towards ``benchmark``; see ``resampled``."""
    drawn = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")

"""Texts as arrays: the bytes of an Arrow batch, cut into pieces of bounded size, and rolling hashes over them.

Arithmetic is modulo 2**64 on purpose; numpy wraps unsigned integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import work_dir

#: Rows of an Arrow batch: long texts make batches large, whatever their number.
BATCH_ROWS = 512
#: Bytes looked at together. A longer text is cut into pieces that overlap.
PIECE_BYTES = 1 << 19
#: Bits that hold a position inside a piece.
POSITION_BITS = 20

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


@dataclass(frozen=True)
class Rolling:
    """A polynomial hash; ``which`` chooses one of several independent ones."""

    which: int = 0

    @property
    def base(self) -> int:
        return int(np.random.default_rng(7_001 + self.which).integers(1 << 62, (1 << 63) - 1)) * 2 + 1

    def letters(self) -> np.ndarray:
        """A random number for each byte."""
        return _letters(self.which)

    def prefix(self, x: np.ndarray) -> np.ndarray:
        """``p`` such that ``of(p, s, n)`` is the hash of ``x[s:s + n]``."""
        p = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * _powers(self.base, _room(len(x)))[: len(x)], out=p[1:])
        return p

    def of(self, p: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        inverse = _powers(pow(self.base, -1, 1 << 64), _room(len(p)))
        return (p[start + length] - p[start]) * inverse[start]

    def every(self, p: np.ndarray, length: int) -> np.ndarray:
        """The hash at every start, for one length."""
        n = len(p) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        inverse = _powers(pow(self.base, -1, 1 << 64), _room(len(p)))
        return (p[length:] - p[:n]) * inverse[:n]


def _room(n: int) -> int:
    return max(1 << 12, 1 << int(n).bit_length())


@cache
def _letters(which: int) -> np.ndarray:
    return np.random.default_rng(9_001 + which).integers(1, 1 << 63, 256, dtype=np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """At least ``n`` powers of a base; the longest run asked for is kept."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(n, base, np.uint64)
        held[0] = 1
        _POWERS[base] = held = np.multiply.accumulate(held)
    return held


def strings(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    a = batch.column(batch.schema.get_field_index(column))
    a = a.cast(pa.string()) if a.type not in (pa.string(), pa.binary()) else a
    if a.null_count:
        a = a.fill_null(b"" if a.type == pa.binary() else "")
    offsets = np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    data = a.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def integers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)


def pieces(offsets: np.ndarray, overlap: int, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, int, int]]:
    """Runs of rows of about ``size`` bytes, as (first row, end row, first byte, end byte).

    A row longer than that comes as several pieces, each ``overlap`` bytes
    into the next.
    """
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        if j > i:
            yield i, j, int(offsets[i]), int(offsets[j])
            i = j
            continue
        at, end = int(offsets[i]), int(offsets[i + 1])
        while True:
            stop = min(end, at + size)
            yield i, i + 1, at, stop
            if stop == end:
                break
            at = stop - overlap
        i += 1


def sliding_argmin(order: np.ndarray, width: int) -> np.ndarray:
    """For every full window of ``width`` values the position of the least, the first of equal ones.

    The upper ``64 - POSITION_BITS`` bits count; two windows of equal values
    choose the same place.
    """
    n = len(order) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    step = (1 << POSITION_BITS) - width
    if n > step:  # positions are packed beside the values, so look at bounded parts
        parts = [a + sliding_argmin(order[a : min(n, a + step) + width - 1], width) for a in range(0, n, step)]
        return np.concatenate(parts)
    low = np.uint64((1 << POSITION_BITS) - 1)
    m = (order & ~low) | np.arange(len(order), dtype=np.uint64)
    have = 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[:n], m[width - have : width - have + n])
    return (m[:n] & low).astype(np.int64)


def runs(of: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of neighbouring ``positions`` with one value of ``of``."""
    if not len(of):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero((of[1:] != of[:-1]) | (positions[1:] != positions[:-1] + 1)) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(of)])) - 1


def identified(docs: DataFrame, name: str) -> DataFrame:
    """``uid, doc_id, text, copies``: documents under a unique number that grows with ``doc_id``.

    A document is a pair of ``doc_id`` and text; ``copies`` counts equal rows.
    Where ``doc_id`` is a whole number, unique and not null it is the number
    itself. Otherwise (nulls, repeated rows, identifiers of another type)
    documents are numbered in the order of ``doc_id``, null first, and then of
    a digest of the text. Only identifiers and digests are sorted; texts go once
    to the number of their document.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id", "text")
    if isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        twice = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        if twice.where("n > 1 OR doc_id IS NULL").isEmpty():
            return ids.select(F.col("doc_id").cast("bigint").alias("uid"), "doc_id", "text", F.lit(1).alias("copies"))
    path = work_dir(spark, name)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("digest")
    ids.select("doc_id", "text", digest, F.monotonically_increasing_id().alias("row")).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    (
        rows.groupBy("doc_id", "digest")
        .agg(F.count(F.lit(1)).cast("int").alias("copies"), F.min("row").alias("row"))
        .orderBy(F.col("doc_id").asc_nulls_first(), F.col("digest").asc_nulls_first())
        .select(F.monotonically_increasing_id().alias("uid"), "row", "copies")
        .write.parquet(f"{path}/numbers")
    )
    numbers = spark.read.parquet(f"{path}/numbers")
    rows.join(numbers, "row").select("uid", "doc_id", "text", "copies").write.parquet(f"{path}/documents")
    return spark.read.parquet(f"{path}/documents")


def as_rows(df: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, without that column."""
    rest = [c for c in df.columns if c != "copies"]
    return df.select(*rest, F.explode(F.expr("sequence(1, copies)")).alias("_copy")).select(*rest)

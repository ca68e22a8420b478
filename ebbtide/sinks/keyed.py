"""Keyed tables fed by micro-batches.

A table is a folder of parquet *segments*, each holding the net effect of a
range of batches.  A batch writes one segment and never touches the rest, so
its cost follows the size of the change and not of the table, and writing the
same batch twice leaves the same table.  ``compact`` folds neighbouring
segments of similar size, which keeps their number logarithmic.

Segment ``s_7_7`` holds batch 7, ``s_4_7`` batches 4 to 7, and ``s_-1_7`` is a
base: everything up to batch 7, free of deletions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.signed import W
from ebbtide.sinks.files import Folder
from ebbtide.specs import TableSpec

START = -1
#: Batches for which a replaced segment stays, for readers that began before it was replaced.
KEEP_REPLACED = 20


@dataclass(frozen=True, order=True)
class Segment:
    low: int
    high: int

    @property
    def name(self) -> str:
        return f"s_{self.low}_{self.high}"

    @classmethod
    def parse(cls, name: str) -> Segment | None:
        parts = name.split("_")
        if len(parts) != 3 or parts[0] != "s":
            return None
        return cls(int(parts[1]), int(parts[2]))

    def covers(self, other: Segment) -> bool:
        return self != other and self.low <= other.low and other.high <= self.high


class _SegmentedTable:
    """What both kinds of table share: segments, visibility, compaction."""

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.path = path.rstrip("/")
        self.folder = Folder(spark, path)

    # -- to be given by the kind of table
    stored: T.StructType
    sort_by: str | None = None

    def fold(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _as_base(self, rows: DataFrame, newer_than: Column | None = None) -> DataFrame:
        raise NotImplementedError

    # -- segments
    def create_if_absent(self) -> None:
        """An empty table, unless there is one already."""
        if not self.segments():
            self._write(Segment(START, START), self.spark.createDataFrame([], self.stored))

    def segments(self, as_of: int | None = None) -> list[Segment]:
        """Committed segments up to batch ``as_of``, without those a wider one replaces."""
        found = [Segment.parse(name) for name in self.folder.list()]
        seen = [
            s
            for s in found
            if s is not None and (as_of is None or s.high <= as_of) and self.folder.committed(s.name)
        ]
        return sorted(s for s in seen if not any(other.covers(s) for other in seen))

    def last_batch(self) -> int:
        return max((s.high for s in self.segments()), default=START)

    def _write(self, segment: Segment, rows: DataFrame) -> None:
        self.folder.revoke(segment.name)
        if self.sort_by:
            rows = rows.sortWithinPartitions(self.sort_by)
        rows.select(*self.stored.names).write.mode("overwrite").parquet(f"{self.path}/{segment.name}", compression="zstd")
        self.folder.commit(segment.name)

    def _rows(self, segments: list[Segment]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*[f"{self.path}/{s.name}" for s in segments])

    def compact(
        self, as_of: int, fan_in: int = 8, ratio: int = 4, newer_than: Column | None = None
    ) -> Segment | None:
        """Fold the newest run of at least ``fan_in`` segments of similar size.

        A run grows backwards while the next older segment is at most ``ratio``
        times as large as the run so far.  ``as_of`` must be a batch that will not
        run again: inside a stream, the one before the current.  A run that
        reaches the oldest segment becomes the new base, without deletions and
        without rows that were last touched at ``newer_than`` or before.
        """
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        self.drop_replaced(as_of - KEEP_REPLACED)
        segments = self.segments(as_of)
        if len(segments) < fan_in:
            return None
        run, size = [], 0
        for segment in reversed(segments):
            own = self.folder.bytes(segment.name)
            if run and own > ratio * size:
                break
            run.insert(0, segment)
            size += own
        if len(run) < fan_in:
            return None
        whole = run[0] == segments[0]
        merged = Segment(START if whole else run[0].low, run[-1].high)
        rows = self._as_base(self._merged(run), newer_than) if whole else self.fold(self._rows(run))
        self._write(merged, rows)
        return merged

    def _merged(self, segments: list[Segment]) -> DataFrame:
        raise NotImplementedError

    def drop_replaced(self, before: int) -> list[str]:
        """Delete segments replaced by one that ends at batch ``before`` or earlier.

        ``compact`` does so in every batch, so the folder holds the live segments
        and those replaced lately, however old the job is.
        """
        wide = [s for s in self.segments(before) if s.low < s.high] if before > START else []
        found = [Segment.parse(name) for name in self.folder.list()] if wide else []
        retired = [s.name for s in found if s is not None and any(w.covers(s) for w in wide)]
        for name in retired:
            self.folder.remove(name)
        return retired

    def vacuum(self) -> list[str]:
        """Delete segments that a wider one replaces.  Call it when no reader is using them."""
        live = {s.name for s in self.segments()}
        retired = [n for n in self.folder.list() if Segment.parse(n) is not None and n not in live]
        for name in retired:
            self.folder.remove(name)
        return retired


class UpsertTable(_SegmentedTable):
    """The last row per key; a deletion removes the key.

    ``first_seen`` names a column the table fills itself: the time of the batch
    that made the key appear.  Updates keep it, deletion forgets it.
    ``sort_by`` orders rows inside each file, so that range filters on it skip
    row groups.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: TableSpec,
        first_seen: str | None = None,
        sort_by: str | None = None,
    ):
        super().__init__(spark, path, spec)
        self.first_seen = first_seen
        self.sort_by = sort_by
        self.stored = spec.widened(
            _deleted="boolean", _reset="boolean", _first="timestamp", _touched="timestamp", _batch="bigint"
        ).schema

    def load(self, rows: DataFrame, at: Column) -> None:
        """Fill the table from a snapshot, before the first batch."""
        base = self.spec.conform(rows).select(
            "*",
            F.lit(False).alias("_deleted"),
            F.lit(False).alias("_reset"),
            at.cast("timestamp").alias("_first"),
            at.cast("timestamp").alias("_touched"),
            F.lit(START).cast("bigint").alias("_batch"),
        )
        self._write(Segment(START, START), base)

    def write(self, batch: int, changes: DataFrame, at: Column) -> None:
        """Write batch ``batch``: one row per key with ``_deleted`` true or false."""
        rows = changes.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema.fields],
            "_deleted",
            F.col("_deleted").alias("_reset"),
            F.when(~F.col("_deleted"), at.cast("timestamp")).alias("_first"),
            at.cast("timestamp").alias("_touched"),
            F.lit(batch).cast("bigint").alias("_batch"),
        )
        self._write(Segment(batch, batch), rows)

    def read(self, as_of: int | None = None, newer_than: Column | None = None) -> DataFrame:
        """The table after batch ``as_of``; rows not touched after ``newer_than`` have expired."""
        rows = self._merged(self.segments(as_of))
        if newer_than is not None:
            rows = rows.where(F.col("_touched") > newer_than)
        columns = list(self.spec.columns)
        if self.first_seen:
            columns.append(F.col("_first").alias(self.first_seen))
        return rows.select(*columns)

    def fold(self, rows: DataFrame) -> DataFrame:
        """Several segments' rows as one row per key (a segment has at most one each)."""
        latest = F.max_by(F.struct(*self.spec.values, "_deleted"), "_batch").alias("_latest")
        keyed = rows
        first = F.lit(None).cast("timestamp")
        if self.first_seen:
            by_key = Window.partitionBy(*self.spec.key)
            keyed = rows.withColumn("_gone", F.max(F.when(F.col("_reset"), F.col("_batch"))).over(by_key))
            first = F.min(F.when(F.col("_gone").isNull() | (F.col("_batch") >= F.col("_gone")), F.col("_first")))
        folded = keyed.groupBy(*self.spec.key).agg(
            latest,
            F.max("_reset").alias("_reset"),
            first.alias("_first") if self.first_seen else F.min("_first").alias("_first"),
            F.max("_touched").alias("_touched"),
            F.max("_batch").alias("_batch"),
        )
        flat = folded.select(*self.spec.key, "_latest.*", "_reset", "_first", "_touched", "_batch")
        return flat.select(*self.stored.names)

    def _as_base(self, rows: DataFrame, newer_than: Column | None = None) -> DataFrame:
        if newer_than is not None:
            rows = rows.where(F.col("_touched") > newer_than)
        return rows.withColumn("_deleted", F.lit(False)).withColumn("_reset", F.lit(False))

    def _merged(self, segments: list[Segment]) -> DataFrame:
        """Live rows of the segments.

        The base keeps its place: its rows are only checked against the changed
        keys, and Catalyst broadcasts those when the change segments are small
        enough on disk.
        """
        base = [s for s in segments if s.low == START]
        newer = [s for s in segments if s.low != START]
        if not newer:
            return self._rows(base)
        changed = self._rows(newer)
        if len(newer) > 1:
            changed = self.fold(changed)
        live = changed.where(~F.col("_deleted"))
        if not base:
            return live
        old = self._rows(base)
        untouched = old.join(changed.select(*self.spec.key).alias("c"), self._same_key(old, "c"), "left_anti")
        if self.first_seen:
            live = self._keep_first(live, old)
        return untouched.unionByName(live)

    def _keep_first(self, live: DataFrame, old: DataFrame) -> DataFrame:
        """Rows that were there before keep their first-seen time."""
        updated = live.where(~F.col("_reset"))
        before = old.select(*[F.col(k).alias(f"_old_{k}") for k in self.spec.key], F.col("_first").alias("_was"))
        match = reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in self.spec.key]
        )
        # Inner first, so that a small set of changed keys can be broadcast
        # against the base; the left join below then meets only the matches.
        matched = before.join(updated.select(*self.spec.key), match, "inner").select(*before.columns)
        kept = live.join(matched, match & ~F.col("_reset"), "left")
        return kept.withColumn("_first", F.coalesce("_was", "_first")).select(*self.stored.names)

    def _same_key(self, left: DataFrame, alias: str) -> Column:
        return reduce(
            lambda a, b: a & b,
            [left[k].eqNullSafe(F.col(f"{alias}.{k}")) for k in self.spec.key],
        )


class SumTable(_SegmentedTable):
    """Running totals per key: segments add up, and a key that counts 0 rows is gone.

    ``counter`` is the column that counts rows.  With ``positive_only`` a key
    that counts less than nothing is hidden as well.
    """

    def __init__(
        self, spark: SparkSession, path: str, spec: TableSpec, counter: str, positive_only: bool = True
    ):
        super().__init__(spark, path, spec)
        self.stored = spec.schema
        self.counter = counter
        self.positive_only = positive_only

    def write(self, batch: int, deltas: DataFrame) -> None:
        self._write(Segment(batch, batch), self.spec.conform(deltas))

    def batch(self, number: int) -> DataFrame:
        """What one batch wrote, before it is folded with others."""
        return self._rows([Segment(number, number)])

    def read(self, as_of: int | None = None) -> DataFrame:
        rows = self._merged(self.segments(as_of))
        return rows.where(F.col(self.counter) > 0) if self.positive_only else rows

    def fold(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.spec.key).agg(*[F.sum(c).alias(c) for c in self.spec.values])

    def _merged(self, segments: list[Segment]) -> DataFrame:
        rows = self._rows(segments)
        folded = self.fold(rows) if len(segments) > 1 else rows
        return folded.where(F.col(self.counter) != 0)

    def _as_base(self, rows: DataFrame, newer_than: Column | None = None) -> DataFrame:
        return rows


def keyed_changes(signed: DataFrame, spec: TableSpec) -> DataFrame:
    """Signed rows of one batch as one upsert or deletion per key.

    Equal rows cancel first, combined within each task, so a key with very many
    changes crosses the shuffle as few rows.  A key with a surviving insertion
    is an upsert, one with only retractions a deletion, and one that nets to
    nothing is left alone.
    """
    typed = signed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields], W)
    net = typed.groupBy(*spec.columns).agg(F.sum(W).alias(W)).where(F.col(W) != 0)
    winner = F.max(F.when(F.col(W) > 0, F.struct(*spec.values))).alias("_row")
    return (
        net.groupBy(*spec.key)
        .agg(winner)
        .select(*spec.key, "_row.*", F.col("_row").isNull().alias("_deleted"))
        .select(*spec.columns, "_deleted")
    )

"""Topics kept as numbered segments, with offsets: a source that can start at the latest record.

A topic is dealt over partitions by key, and each append adds one segment to
them, ``path/topic=<t>/partition=<p>/segment=<n>/``. An offset is the number of
the next segment of each partition, so it stays as small as the number of
partitions. The checkpoint of a query keeps it: the start position only applies
to a first start.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ebbtide.sources.topics import EARLIEST, LATEST

FORMAT = "topic_segments"
SCHEMA = "topic string, partition int, seq bigint, value string"
ARROW = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("seq", pa.int64()), ("value", pa.string())])
#: Bits of a record number that hold its place in its segment; the segment's number stands above them.
PLACE_BITS = 40
#: Bytes of a segment that one task reads, and lines that it hands over at once.
SPLIT_BYTES = 64 << 20
LINES_AT_ONCE = 10_000

Offsets = dict[str, dict[str, int]]


@dataclass
class Split(InputPartition):
    """Lines of a file that begin within a range of bytes; ``first`` is the record number of the file's first byte."""

    path: str
    topic: str
    partition: int
    first: int
    begin: int
    end: int


def _opened(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a path, and the path in it; a path without a scheme is a local one."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return files.FileSystem.from_uri(path) if "://" in path else (files.LocalFileSystem(), path)


def _numbered(fs: files.FileSystem, path: str, name: str) -> dict[str, str]:
    """Folders ``<name>=<value>`` below ``path``, by value."""
    found = fs.get_file_info(files.FileSelector(path, allow_not_found=True))
    return {
        i.base_name.split("=", 1)[1]: i.path
        for i in found
        if i.type == files.FileType.Directory and i.base_name.startswith(f"{name}=")
    }


class _Topics:
    """Where the segments of the chosen topics are."""

    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.wanted = [t for t in options.get("topics", "").split(",") if t]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        start = options.get("startingOffsets", LATEST)
        if start not in (EARLIEST, LATEST):
            start = json.loads(start)
        self.start: str | Offsets = start

    def partitions(self) -> Iterator[tuple[str, str, str]]:
        fs, root = _opened(self.path)
        for topic, folder in sorted(_numbered(fs, root, "topic").items()):
            if not self.wanted or topic in self.wanted:
                for partition, below in sorted(_numbered(fs, folder, "partition").items()):
                    yield topic, partition, below

    def end(self) -> Offsets:
        fs, _ = _opened(self.path)
        out: Offsets = {}
        for topic, partition, folder in self.partitions():
            numbers = [int(n) for n in _numbered(fs, folder, "segment")]
            out.setdefault(topic, {})[partition] = max(numbers, default=-1) + 1
        return out

    def first(self) -> Offsets:
        """Where a first start begins; a partition that is not named begins at its first segment."""
        if self.start == LATEST:
            return self.end()
        return {} if self.start == EARLIEST else self.start

    def splits(self, start: Offsets, end: Offsets) -> list[Split]:
        fs, _ = _opened(self.path)
        out = []
        for topic, partition, folder in self.partitions():
            upto = end.get(topic, {}).get(partition, 0)
            since = start.get(topic, {}).get(partition, 0)
            if since >= upto:
                continue
            for number, below in sorted(_numbered(fs, folder, "segment").items(), key=lambda s: int(s[0])):
                if not since <= int(number) < upto:
                    continue
                place = int(number) << PLACE_BITS
                for f in sorted(fs.get_file_info(files.FileSelector(below)), key=lambda f: f.base_name):
                    if f.type == files.FileType.File and f.base_name[0] not in "._":
                        out += [
                            Split(f.path, topic, int(partition), place, a, min(f.size, a + self.split))
                            for a in range(0, f.size, self.split)
                        ]
                        place += f.size
        return out

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        fs, _ = _opened(self.path)
        with fs.open_input_file(split.path) as raw:
            lines = io.BufferedReader(raw, 1 << 20)
            at = split.begin
            if at:  # the line under way belongs to the range it began in
                lines.seek(at - 1)
                at += len(lines.readline()) - 1
            seq, values = [], []
            while at < split.end and (line := lines.readline()):
                seq.append(split.first + at)
                values.append(line.rstrip(b"\r\n").decode("utf-8"))
                at += len(line)
                if len(seq) == LINES_AT_ONCE:
                    yield self._batch(split, seq, values)
                    seq, values = [], []
            if seq:
                yield self._batch(split, seq, values)

    @staticmethod
    def _batch(split: Split, seq: list[int], values: list[str]) -> pa.RecordBatch:
        n = len(seq)
        return pa.RecordBatch.from_arrays(
            [pa.array([split.topic] * n, pa.string()), pa.array([split.partition] * n, pa.int32()), pa.array(seq, pa.int64()), pa.array(values, pa.string())],
            schema=ARROW,
        )


class _Bounded(DataSourceReader):
    def __init__(self, topics: _Topics):
        self.topics = topics

    def partitions(self):
        # A read without splits still needs one, which has no lines.
        return self.topics.splits(self.topics.first(), self.topics.end()) or [Split("", "", 0, 0, 0, 0)]

    def read(self, partition):
        return self.topics.read(partition) if partition.path else iter(())


class _Unbounded(DataSourceStreamReader):
    def __init__(self, topics: _Topics):
        self.topics = topics

    def initialOffset(self) -> Offsets:
        return self.topics.first()

    def latestOffset(self) -> Offsets:
        return self.topics.end()

    def partitions(self, start: Offsets, end: Offsets):
        return self.topics.splits(start, end)

    def read(self, partition):
        return self.topics.read(partition)

    def commit(self, end: Offsets) -> None:
        pass


class TopicSegments(DataSource):
    """``spark.read`` and ``spark.readStream`` of segments.

    Options: ``path``, ``topics`` (comma-separated, all if absent),
    ``startingOffsets`` (``earliest``, ``latest``, or segments as JSON by topic
    and partition) and ``splitBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        if self.options.get("startingOffsets", LATEST) == LATEST:
            raise ValueError(f"a bounded read cannot start at {LATEST}: nothing comes after it")
        return _Bounded(_Topics(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Unbounded(_Topics(self.options))


def segment_changes(
    spark: SparkSession,
    path: str,
    start: str | Offsets = LATEST,
    topics: tuple[str, ...] = (),
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """``topic, partition, seq, value``: records of segments, in order of ``seq`` within a partition of a topic.

    Empty topics and a path without any give no rows. ``start`` decides for a
    first start only; a query that has a checkpoint goes on where it stood.
    """
    spark.dataSource.register(TopicSegments)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT).options(**options)
    reader = reader.option("path", path).option("topics", ",".join(topics))
    return reader.option("startingOffsets", start if isinstance(start, str) else json.dumps(start)).load()


def append_segment(encoded: DataFrame, path: str, key: Column | str, partitions: int, segment: int) -> None:
    """Write encoded events (``topic, value``) as segment ``segment`` of their topics, dealt over partitions by key.

    All events of a key go to one partition, in the order of the rows of
    ``encoded`` within its partitions. Each topic and partition gets one file,
    which appears whole.
    """
    key = F.col(key) if isinstance(key, str) else key
    dealt = encoded.select("topic", "value", F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("partition"))
    (
        dealt.withColumn("segment", F.lit(segment))
        .repartition(partitions, "topic", "partition")
        .write.partitionBy("topic", "partition", "segment")
        .mode("append")
        .text(path)
    )

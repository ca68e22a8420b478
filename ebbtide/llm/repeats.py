"""Repeated windows of whole texts, found exactly, in passes that look at ever more tokens of ever fewer windows.

Pass 1 groups *blocks* (all windows of a text around one anchor, see
``windows``) by the anchor's seed; groups of one are finished. A group whose
blocks agree in all that they cover is finished too: every window of it repeats.
Pass 2 takes one block for each distinct content of the other groups and cuts
it into cells of ``CELL`` windows, grouped by the tokens that all windows of a
cell share. Pass 3 compares what is left window by window. Rows grow with the
text, never with the square of a group: a group is counted by partial sums and
then joined back by its key, which adaptive execution splits where it is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.texts import POSITION_BITS, Rolling, integers, mixed, pieces, small_batches, strings
from ebbtide.llm.windows import blocks, fingerprints
from ebbtide.session import work_dir

#: Windows in a cell of the second pass.
CELL = 8

_BLOCKS = "h bigint, s bigint, uid bigint, start int, n int"


@dataclass(frozen=True)
class Tokens:
    """How texts become numbers: ``read(bytes, ends)`` gives the numbers and where in them each text ends.

    With ``cut``, tokens are bytes and a long text may be read in pieces. A
    token that is sent on takes ``width`` bytes: ``pack(text, numbers)`` makes
    them and ``unpack`` gives the numbers back.
    """

    read: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    cut: bool
    width: int
    pack: Callable[[np.ndarray, np.ndarray], bytes]
    unpack: Callable[[bytes], np.ndarray]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def tokenized(batch: pa.RecordBatch, tokens: Tokens, overlap: int) -> Iterator[tuple]:
    """Per piece: row of each text, first token number of the piece, numbers, ends."""
    data, offsets = strings(batch, "text")
    for i, j, a, z in pieces(offsets, overlap) if tokens.cut else _whole(offsets):
        ends = np.minimum(offsets[i + 1 : j + 1], z) - a
        x, at = tokens.read(data[a:z], ends)
        yield i, a - int(offsets[i]), x, at


def _whole(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    return pieces(offsets, 0, max(1 << 19, int(np.diff(offsets).max(initial=0))))


def _emit_blocks(tokens: Tokens, length: int, seed: int):
    def emit(batches):
        for batch in batches:
            uid = integers(batch, "uid")
            for i, shift, x, ends in tokenized(batch, tokens, length - 1):
                b = blocks(x, ends, length, seed)
                if not len(b.start):
                    continue
                row = np.searchsorted(ends, b.start, side="right")
                begin = np.concatenate(([0], ends))[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(b.seed),
                        _signed(b.span),
                        pa.array(uid[i + row]),
                        pa.array((b.start - begin + shift).astype(np.int32)),
                        pa.array(b.windows.astype(np.int32)),
                    ],
                    names=["h", "s", "uid", "start", "n"],
                )

    return emit


def _emit_chosen(tokens: Tokens, length: int):
    """The tokens of the chosen blocks of each text, packed: ``uid, start, n, x``."""

    def emit(batches):
        for batch in batches:
            data, offsets = strings(batch, "text")
            uid = integers(batch, "uid")
            chosen = batch.column(batch.schema.get_field_index("chosen")).to_pylist()
            ids, starts, counts, out = [], [], [], []
            for r, picks in enumerate(chosen):
                text = data[offsets[r] : offsets[r + 1]]
                x = tokens.pack(text, tokens.read(text, np.array([len(text)]))[0])
                for c in picks:
                    ids.append(uid[r])
                    starts.append(c["start"])
                    counts.append(c["n"])
                    out.append(x[c["start"] * tokens.width : (c["start"] + c["n"] + length - 1) * tokens.width])
                if len(ids) > 20_000:
                    yield _chosen(ids, starts, counts, out)
                    ids, starts, counts, out = [], [], [], []
            if ids:
                yield _chosen(ids, starts, counts, out)

    return emit


def _chosen(ids, starts, counts, out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(counts, pa.int32()), pa.array(out, pa.binary())],
        names=["uid", "start", "n", "x"],
    )


def _spans(batch: pa.RecordBatch, tokens: Tokens):
    """All rows' ``x`` in one array of numbers, with the begin of each."""
    data, offsets = strings(batch, "x")
    return tokens.unpack(data[offsets[0] : offsets[-1]].tobytes()), (offsets - offsets[0]) // tokens.width


def _emit_cells(tokens: Tokens, length: int, seed: int):
    """Cells of each block: ``k`` hash of what its windows share, ``t`` of all it covers, ``first`` window and ``w`` windows."""

    def emit(batches):
        for batch in batches:
            x, begin = _spans(batch, tokens)
            uid, start, n = (integers(batch, c).astype(np.int64) for c in ("uid", "start", "n"))
            roll = Rolling(1)
            p = roll.prefix(x)
            # The anchor sits where the block's windows say; all hold it, so it is the least seed of the first one.
            seeds = mixed(Rolling(0).every(Rolling(0).prefix(x), seed))
            anchor = _anchors(seeds, begin[:-1], length - seed + 1)
            row = np.repeat(np.arange(len(n)), n)
            window = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + begin[:-1][row]
            cell = (anchor[row] - window) // CELL
            cut = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (cell[1:] != cell[:-1]))))
            w = np.diff(np.concatenate((cut, [len(row)])))
            r, c, at = row[cut], cell[cut], window[cut]
            # Windows of cell c begin c * CELL to c * CELL + CELL - 1 tokens before the anchor.
            a = anchor[r]
            core = roll.of(p, a - c * CELL, np.full(len(a), length - CELL + 1))
            k = mixed(core + mixed(c.astype(np.uint64) + np.uint64(1)))
            t = mixed(roll.of(p, at, w + length - 1) + mixed((w * 1000 + a - at).astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(k),
                    _signed(t),
                    pa.array(uid[r]),
                    pa.array(start[r].astype(np.int32)),
                    pa.array((start[r] + at - begin[:-1][r]).astype(np.int32)),
                    pa.array(w.astype(np.int32)),
                ],
                names=["k", "t", "uid", "start", "first", "w"],
            )

    return emit


def _anchors(seeds: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    """Position of the least seed among the ``width`` from each ``begin``, by the bits that ``sliding_argmin`` counts."""
    high = seeds >> np.uint64(POSITION_BITS)
    out = np.empty(len(begin), np.int64)
    for i in range(0, len(begin), 4096):
        b = begin[i : i + 4096]
        out[i : i + 4096] = b + np.argmin(high[b[:, None] + np.arange(width)[None, :]], axis=1)
    return out


def _emit_windows(tokens: Tokens, length: int):
    """Each window of the chosen cells: two hashes and its place."""

    def emit(batches):
        for batch in batches:
            x, begin = _spans(batch, tokens)
            uid, start = integers(batch, "uid"), integers(batch, "start")
            f1, f2 = fingerprints(x, length)
            cells = batch.column(batch.schema.get_field_index("cells")).to_pylist()
            row = np.array([r for r, cs in enumerate(cells) for _ in cs], np.int64)
            first = np.array([c["first"] for cs in cells for c in cs], np.int64)
            w = np.array([c["w"] for cs in cells for c in cs], np.int64)
            each = np.repeat(np.arange(len(w)), w)
            step = np.arange(len(each)) - np.repeat(np.cumsum(w) - w, w)
            at = first[each] + step
            place = begin[:-1][row[each]] + at - start[row[each]]
            yield pa.RecordBatch.from_arrays(
                [_signed(f1[place]), _signed(f2[place]), pa.array(uid[row[each]]), pa.array(at.astype(np.int32))],
                names=["f1", "f2", "uid", "start"],
            )

    return emit


def release(df: DataFrame) -> None:
    """Let the driver drop what finished steps no longer use: Spark deletes shuffle files when it forgets their plans."""
    df.sparkSession.sparkContext._jvm.System.gc()


def repeated_windows(docs: DataFrame, tokens: Tokens, length: int, seed: int, keep_first: bool, name: str) -> DataFrame:
    """``uid, found``: for each text the windows of ``length`` tokens that occur elsewhere, in this text or another.

    ``docs`` has ``uid`` (unique, not null) and ``text``. ``found`` lists
    ``start, n, g``: ``n`` windows from ``start`` on. With ``keep_first`` the
    first occurrence, by ``uid`` and then ``start``, is left out; of entries
    with equal ``g`` (not null) in one text, the one that starts first is that
    occurrence.
    """
    spark = docs.sparkSession
    small_batches(spark)
    root = work_dir(spark, name)
    seen = docs.select("uid", "text").mapInArrow(_emit_blocks(tokens, length, seed), _BLOCKS)

    # Pass 1: seeds that occur again.
    (
        seen.groupBy("h")
        .agg(F.count(F.lit(1)).alias("c"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.min("uid").alias("first"))
        .where("c > 1")
        .select("h", (F.col("lo") != F.col("hi")).alias("differ"), "first")
        .write.parquet(f"{root}/seeds")
    )
    release(docs)
    seen.join(spark.read.parquet(f"{root}/seeds"), "h").write.parquet(f"{root}/blocks")
    release(docs)
    again = spark.read.parquet(f"{root}/blocks")
    if keep_first:
        plain = again.where("NOT differ").select("uid", "start", "n", F.expr("IF(uid = first, h, NULL)").alias("g"))
    else:
        plain = again.where("NOT differ").select("uid", "start", "n", F.lit(None).cast("bigint").alias("g"))

    # One block for each distinct content of a seed whose blocks differ.
    differ = again.where("differ")
    (
        differ.groupBy("h", "s")
        .agg(F.min(F.struct("uid", "start", "n")).alias("rep"), F.count(F.lit(1)).alias("c"))
        .select("h", "s", "c", "rep.*")
        .write.parquet(f"{root}/contents")
    )
    contents = spark.read.parquet(f"{root}/contents")
    copies = contents.where("c > 1").select("h", "s", F.col("uid").alias("_u"), F.col("start").alias("_s"))
    same = differ.join(copies, ["h", "s"])
    if keep_first:
        same = same.where("NOT (uid = _u AND start = _s)")
    same = same.select("uid", "start", "n", F.lit(None).cast("bigint").alias("g"))

    chosen = contents.groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("chosen"))
    (
        docs.select("uid", "text")
        .join(chosen, "uid")
        .mapInArrow(_emit_chosen(tokens, length), "uid bigint, start int, n int, x binary")
        .write.parquet(f"{root}/chosen")
    )
    release(docs)
    spans = spark.read.parquet(f"{root}/chosen")

    # Pass 2: cells.
    cells = spans.mapInArrow(_emit_cells(tokens, length, seed), "k bigint, t bigint, uid bigint, start int, first int, w int")
    place = F.struct("uid", "first")
    (
        cells.groupBy("k")
        .agg(F.count(F.lit(1)).alias("c"), F.min("t").alias("lo"), F.max("t").alias("hi"), F.min(place).alias("rep"))
        .where("c > 1")
        .select("k", (F.col("lo") != F.col("hi")).alias("differ"), F.col("rep.uid").alias("_u"), F.col("rep.first").alias("_f"))
        .write.parquet(f"{root}/cells")
    )
    cells.join(spark.read.parquet(f"{root}/cells"), "k").select(
        "uid", "start", "first", "w", "differ", F.expr("uid = _u AND first = _f").alias("is_first")
    ).write.parquet(f"{root}/cells-again")
    release(docs)
    found = spark.read.parquet(f"{root}/cells-again")
    alike = found.where("NOT differ" + (" AND NOT is_first" if keep_first else ""))
    alike = alike.select("uid", F.col("first").alias("start"), F.col("w").alias("n"), F.lit(None).cast("bigint").alias("g"))

    # Pass 3: windows.
    rest = found.where("differ").groupBy("uid", "start").agg(F.collect_list(F.struct("first", "w")).alias("cells"))
    windows = spans.join(rest, ["uid", "start"]).mapInArrow(
        _emit_windows(tokens, length), "f1 bigint, f2 bigint, uid bigint, start int"
    )
    windows.write.parquet(f"{root}/windows")
    windows = spark.read.parquet(f"{root}/windows")
    place = F.struct("uid", "start")
    twice = windows.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("rep")).where("c > 1")
    twice.select("f1", "f2", F.col("rep.uid").alias("_u"), F.col("rep.start").alias("_s")).write.parquet(f"{root}/twice")
    release(docs)
    single = windows.join(spark.read.parquet(f"{root}/twice"), ["f1", "f2"])
    if keep_first:
        single = single.where("NOT (uid = _u AND start = _s)")
    single = single.select("uid", "start", F.lit(1).alias("n"), F.lit(None).cast("bigint").alias("g"))

    every = plain.unionByName(same).unionByName(alike).unionByName(single)
    return every.groupBy("uid").agg(F.collect_list(F.struct("start", "n", "g")).alias("found"))


def covered(found: list | None, n_tokens: int, length: int) -> np.ndarray:
    """Which tokens of a text the windows of ``found`` cover."""
    out = np.zeros(n_tokens + 1, np.int32)
    if found:
        start = np.array([f["start"] for f in found], np.int64)
        n = np.array([f["n"] for f in found], np.int64)
        keep = np.ones(len(start), bool)
        earliest: dict[int, int] = {}
        for i, f in enumerate(found):
            g = f["g"]
            if g is not None and (g not in earliest or start[i] < start[earliest[g]]):
                earliest[g] = i
        keep[list(earliest.values())] = False
        np.add.at(out, start[keep], 1)
        np.add.at(out, start[keep] + n[keep] + length - 1, -1)
    return np.cumsum(out)[:-1] > 0

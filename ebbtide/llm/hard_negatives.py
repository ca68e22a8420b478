"""Hard-negative mining: exact integer inner products, several candidates at a time in one wide integer.

The components of some candidates are made non-negative by a bias and put side
by side into fields of one integer, wide enough that no sum of products leaves
its field. One multiplication with an anchor's component then serves all of
them, and the sum over components holds their scores, to be unpacked.

Anchors and candidates are dealt over a grid: each cell gets a block of either
side and returns its few best, which are merged for each anchor. Blocks come
from a hash of ``vec_id`` and labels play no part in it, so neither a frequent
label nor a frequent vector makes a block large.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.session import work_dir

#: Components are whole 256ths.
SCALE = 256
#: Vectors that a cell holds of either side at most, on average; below ``CELLS`` cells also fewer, but not under ``FEWEST``.
BLOCK = 1 << 16
FEWEST = 1 << 10
CELLS = 64
#: Scores of a cell that are worked out together.
SCORES = 1 << 21
#: Positives of an anchor, negatives of an anchor and positive, and the share of the positive's score that these need.
POSITIVES = 5
NEGATIVES = 5
SHARE = (80, 100)

_LONG = (-(1 << 63), (1 << 63) - 1)


# ---- inside a cell


def components(vectors: pa.Array) -> np.ndarray:
    """Rows of whole components, shorter vectors filled up with 0; Python integers where 64 bits could not hold a score."""
    lengths = np.diff(np.asarray(vectors.offsets)).astype(np.int64)
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    width = max(1, int(lengths.max(initial=0)))
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < lengths[:, None]] = x
    if np.abs(out).max(initial=0) < 1 << 24:
        return out.astype(np.int64)
    return np.array([int(v) for v in out.ravel()], object).reshape(out.shape)


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.hstack([x, np.zeros((len(x), width - x.shape[1]), x.dtype)]) if x.shape[1] < width else x


def packed_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """All inner products of two sets of whole vectors, exactly."""
    width = max(anchors.shape[1], candidates.shape[1])
    a, c = _widened(anchors, width), _widened(candidates, width)
    if not len(a) or not len(c):
        return np.zeros((len(a), len(c)), np.int64)
    bias = max(0, -int(c.min()))
    top = int(c.max()) + bias
    below = int((-np.minimum(a, 0)).sum(axis=1).max()) * top  # no sum is less than -below
    above = int(np.maximum(a, 0).sum(axis=1).max()) * top
    field = max(1, (below + above).bit_length())
    kind = np.uint64 if field <= 64 and a.dtype != object and c.dtype != object else object
    # what does not fit 64 bits goes into Python's integers, four fields to one
    fields = 64 // field if kind is np.uint64 else 4
    groups = -(-len(c) // fields)
    biased = np.zeros((groups * fields, width), c.dtype)
    biased[: len(c)] = c + bias
    biased = biased.reshape(groups, fields, width)
    wide = np.zeros((groups, width), kind)
    lift = 0
    for f in range(fields):
        wide += biased[:, f].astype(kind) << kind(f * field) if kind is np.uint64 else biased[:, f].astype(object) << (f * field)
        lift += below << (f * field)
    # 64 bits wrap, and no field of the lifted total is negative, so what comes out is right
    if kind is np.uint64:
        total = a.astype(np.int64).view(np.uint64) @ wide.T + np.uint64(lift)
        mask = np.uint64((1 << field) - 1)
        parts = [((total >> np.uint64(f * field)) & mask).view(np.int64) for f in range(fields)]
    else:
        total = a.astype(object) @ wide.T + lift
        parts = [(total >> (f * field)) & ((1 << field) - 1) for f in range(fields)]
    scores = np.stack(parts, axis=2).reshape(len(a), groups * fields)[:, : len(c)]
    scores = scores - (below + bias * a.sum(axis=1))[:, None]
    return np.clip(scores, *_LONG) if kind is object else scores


def best(scores: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``n`` highest allowed scores of each row, of equal ones those further left."""
    columns = scores.shape[1]
    kind = np.int64 if scores.dtype != object and int(np.abs(scores).max(initial=0)) < (1 << 62) // max(columns, 1) else object
    order = scores.astype(kind) * columns + np.arange(columns - 1, -1, -1).astype(kind)
    least = int(order.min()) - 1 if order.size else 0
    order[~allowed] = least
    if columns > n and kind is np.int64:
        order = np.partition(order, columns - n, axis=1)[:, columns - n :]
    order = -np.sort(-order, axis=1)[:, :n]
    row, place = np.nonzero(order > least)
    return row, columns - 1 - (order[row, place] % columns).astype(np.int64)


class _Cell:
    """Anchors and candidates of a cell, candidates by rising ``vec_id``, and their scores, some anchors at a time."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table) -> None:
        anchors, candidates = anchors.combine_chunks(), candidates.sort_by("vec_id").combine_chunks()
        self.table = anchors
        self.anchor_ids, self.anchor_labels = (anchors[c].to_numpy() for c in ("vec_id", "label"))
        self.ids, self.labels = (candidates[c].to_numpy() for c in ("vec_id", "label"))
        self.a, self.c = (_vectors(t) for t in (anchors, candidates))

    def parts(self):
        step = max(1, SCORES // max(1, len(self.ids)))
        for i in range(0, len(self.anchor_ids), step):
            s = slice(i, i + step)
            yield s, packed_products(self.a[s], self.c), self.anchor_labels[s, None] == self.labels


def _vectors(t: pa.Table) -> np.ndarray:
    column = t["embedding"].combine_chunks()
    return components(column) if len(t) else np.zeros((0, 1), np.int64)


def _whole(values: list[np.ndarray]) -> pa.Array:
    return pa.array([int(v) for a in values for v in a], pa.int64())


def best_positives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    """``anchor_id, positive_id, positive_score``: the best of a cell for each of its anchors."""
    cell, out = _Cell(anchors, candidates), ([], [], [])
    for s, scores, same in cell.parts():
        row, column = best(scores, same & (cell.anchor_ids[s, None] != cell.ids), POSITIVES)
        for held, values in zip(out, (cell.anchor_ids[s][row], cell.ids[column], scores[row, column])):
            held.append(values)
    return pa.table([_whole(v) for v in out], ["anchor_id", "positive_id", "positive_score"])


def best_negatives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    """``anchor_id, positive_id, positive_score, negative_id, negative_score``: the best of a cell for each positive."""
    cell, out = _Cell(anchors, candidates), ([], [], [], [], [])
    low, high = SHARE
    positives = [cell.table["positives"][i].as_py() for i in range(len(cell.table))]
    for s, scores, same in cell.parts():
        of_part = positives[s]
        for k in range(max(map(len, of_part), default=0)):
            rows = np.array([i for i, p in enumerate(of_part) if k < len(p)], np.int64)
            ids = np.array([of_part[i][k]["positive_id"] for i in rows], np.int64)
            upper = np.array([of_part[i][k]["positive_score"] for i in rows], np.int64)
            # the least whole number that is not below the share
            lower = np.array([-(-low * int(u) // high) for u in upper], object).clip(*_LONG).astype(np.int64)
            of_rows = scores[rows]
            allowed = ~same[rows] & (of_rows <= upper[:, None]) & (of_rows >= lower[:, None])
            row, column = best(of_rows, allowed.astype(bool), NEGATIVES)
            found = (cell.anchor_ids[s][rows[row]], ids[row], upper[row], cell.ids[column], of_rows[row, column])
            for held, values in zip(out, found):
                held.append(values)
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    return pa.table([_whole(v) for v in out], names)


# ---- over all cells


def usable(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """``vec_id, label, embedding``: rows that take part, one for each ``vec_id``.

    Rows with a null ``vec_id``, label or vector, or a component that is null
    or whose 256-fold is not finite, take no part. Of rows with one ``vec_id`` the least by label and
    vector does.
    """
    bound = float(np.finfo(np.float64).max) / SCALE
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= bound))
    return (
        embeddings.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            (F.col("label") if label is None else label).cast("bigint").alias("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fit)
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "embedding")).alias("least"))
        .select("vec_id", "least.*")
    )


def _blocks(n: int, others: int) -> int:
    """Into how many blocks ``n`` vectors go, where the other side has ``others`` blocks."""
    return max(1, -(-n // BLOCK), min(-(-n // FEWEST), -(-CELLS // others)))


def _over_cells(anchors: DataFrame, vectors: DataFrame, grid: tuple[int, int], work: Callable, schema: str) -> DataFrame:
    """``work`` on every pair of a block of anchors and a block of vectors; each row is sent to one line of cells."""
    tall, wide = grid

    def block(of: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(of)).cast("int")

    def line(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    cells = tall * wide
    left = anchors.withColumn("y", block(tall)).withColumn("x", line(wide)).repartition(cells, "y", "x")
    right = vectors.withColumn("x", block(wide)).withColumn("y", line(tall)).repartition(cells, "y", "x")
    return left.groupBy("y", "x").cogroup(right.groupBy("y", "x")).applyInArrow(work, schema)


def hard_negatives(vectors: DataFrame, anchors: Column) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` chooses.

    ``vectors`` is what ``usable`` returns. An anchor's positives are the
    ``POSITIVES`` other vectors of its label with the highest inner product; for each, the ``NEGATIVES`` best vectors
    of other labels whose product is at most the positive's and at least ``SHARE`` of it. Equal
    scores go by the smaller ``vec_id``. Vectors of unequal length are compared
    as if filled up with zeros. Scores beyond 64 bits are held at the ends of
    their range. An anchor without positives or negatives gives no row, an empty table none at all.
    """
    spark = vectors.sparkSession
    root = work_dir(spark, "hard-negatives")
    vectors.withColumn("is_anchor", anchors).write.parquet(f"{root}/vectors")
    vectors, chosen = spark.read.parquet(f"{root}/vectors"), spark.read.parquet(f"{root}/vectors").where("is_anchor")
    n, n_anchors = vectors.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    tall = max(1, -(-n_anchors // BLOCK))
    grid = tall, _blocks(n, tall)

    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    (
        _over_cells(chosen, vectors, grid, best_positives, "anchor_id long, positive_id long, positive_score long")
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= POSITIVES)
        .groupBy(F.col("anchor_id").alias("vec_id"))
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
        .write.parquet(f"{root}/positives")
    )
    chosen = chosen.join(spark.read.parquet(f"{root}/positives"), "vec_id")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        _over_cells(chosen, vectors, grid, best_negatives, schema)
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= NEGATIVES)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS c
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, positive_score, s.other_id AS negative_id, s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
     AND {SHARE[0]} * positive_score <= {SHARE[1]} * s.score AND s.score <= positive_score
QUALIFY rank <= {NEGATIVES}
"""


@query("op11_hard_negatives", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each row of ``embeddings`` whose ``vec_id`` is divisible by 100, against all rows; see ``hard_negatives``.

    Where ``vec_id`` is divisible by 7 the label is moved on by one, modulo 10.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(usable(table(spark, sf_dir, "embeddings"), moved), F.col("vec_id") % 100 == 0)

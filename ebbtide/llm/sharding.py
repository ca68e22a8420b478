"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of each input partition go to each shard is drawn first, exactly
as a uniform permutation of all rows would have it. Then each partition is
permuted by itself and cut by its row of the matrix, the parts are exchanged,
and each shard is permuted again.

Everything is DataFrame expressions. The matrix is drawn down a tree over the
input partitions: a node deals its rows of each shard to its ``FAN_OUT``
children, so the nodes of a level are drawn side by side, and the driver sees
two numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.session import work_dir

SHARDS = 24
SEED = 20_240_607
#: Rows that a task orders at once when slots are given out.
ROWS_AT_ONCE = 200_000
#: Children of a node of the tree over input partitions, as a power of two.
FAN_OUT_BITS = 5
#: Standard deviations around the mode that a draw looks at; what lies beyond is under the resolution of a double.
REACH = 10.0
#: Low bits of Spark's increasing row number, which count the rows of one partition.
PLACE_BITS = 33


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def uniform(*of) -> Column:
    """A number in (0, 1) for each combination of values."""
    return (F.shiftrightunsigned(F.xxhash64(*of), 12).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` without replacement are good: inversion of the law around its mode.

    Values are visited from the mode down and then from above it up, each
    weight got from the one before; ``u`` decides at which of them the walk ends.
    """
    d = lambda c: c.cast("double")

    def bounds(p: Column) -> Column:
        good, bad, draws = p["good"], p["bad"], p["draws"]
        low, high = F.greatest(F.lit(0).cast("bigint"), draws - bad), F.least(good, draws)
        total = F.greatest(d(good + bad), F.lit(1.0))
        middle = F.floor((d(draws) + 1) * (d(good) + 1) / (d(good) + d(bad) + 2)).cast("bigint")
        spread = F.sqrt(
            d(draws) * (d(good) / total) * (d(bad) / total) * (total - d(draws)) / F.greatest(F.lit(1.0), total - 1)
        )
        return F.struct(
            good.alias("good"),
            bad.alias("bad"),
            draws.alias("draws"),
            p["u"].alias("u"),
            low.alias("low"),
            high.alias("high"),
            F.least(high, F.greatest(low, middle)).alias("mode"),
            (F.floor(spread * REACH).cast("bigint") + F.lit(12)).alias("reach"),
        )

    def drawn(p: Column) -> Column:
        good, bad, draws, mode = p["good"], p["bad"], p["draws"], p["mode"]
        first, last = F.greatest(p["low"], mode - p["reach"]), F.least(p["high"], mode + p["reach"])
        nothing = F.array().cast("array<bigint>")
        down = F.when(first < mode, F.sequence(mode, first + 1, F.lit(-1).cast("bigint"))).otherwise(nothing)
        up = F.when(mode < last, F.sequence(mode, last - 1)).otherwise(nothing)

        def below(w: Column, k: Column) -> Column:  # the weight of k - 1 from that of k
            return w * d(k) * d(bad - draws + k) / (d(good - k + 1) * d(draws - k + 1))

        def above(w: Column, k: Column) -> Column:  # the weight of k + 1 from that of k
            return w * d(good - k) * d(draws - k) / (d(k + 1) * d(bad - draws + k + 1))

        def state(w: Column, x: Column, k: Column | None = None) -> Column:
            more = [] if k is None else [k.alias("k")]
            return F.struct(w.alias("w"), x.alias("x"), *more)

        def mass(values: Column, step) -> Column:
            add = lambda s, k: _let(step(s["w"], k), lambda w: state(w, s["x"] + w))
            return F.aggregate(values, state(F.lit(1.0), F.lit(0.0)), add, lambda s: s["x"])

        def walk(values: Column, step, begin: Column, by: int) -> Column:
            def one(s: Column, k: Column) -> Column:
                moved = _let(step(s["w"], k), lambda w: state(w, s["x"] - w, k + F.lit(by).cast("bigint")))
                return F.when(s["x"] < 0, s).otherwise(moved)

            return F.aggregate(values, begin, one)

        at = p["u"] * (F.lit(1.0) + mass(down, below) + mass(up, above))
        lower = walk(down, below, state(F.lit(1.0), at - F.lit(1.0), mode), -1)
        # Above the mode the weights start anew; a walk that has ended stays where it is.
        return _let(
            lower,
            lambda s: F.when(s["x"] < 0, s["k"]).otherwise(walk(up, above, state(F.lit(1.0), s["x"], mode), 1)["k"]),
        )

    given = F.struct(
        good.cast("bigint").alias("good"), bad.cast("bigint").alias("bad"), draws.cast("bigint").alias("draws"), u.alias("u")
    )
    return _let(_let(given, bounds), drawn)


def _dealt(counts: Column, left: Column, shards: int, *key) -> Column:
    """Rows of each child (``counts``) for each shard, out of ``left`` for each shard; both sums agree."""
    none = F.array().cast("array<bigint>")

    def child(s: Column, c: Column) -> Column:
        def shard(t: Column, j: Column) -> Column:
            size = s["left"][j]
            bad = t["bad"] - size
            take = hypergeometric(size, bad, t["draws"], uniform(*key, F.size(s["out"]), j))
            return _let(
                take,
                lambda n: F.struct(
                    F.concat(t["row"], F.array(n)).alias("row"), (t["draws"] - n).alias("draws"), bad.alias("bad")
                ),
            )

        everything = F.aggregate(s["left"], F.lit(0).cast("bigint"), lambda a, b: a + b)
        begin = F.struct(none.alias("row"), c.alias("draws"), everything.alias("bad"))
        row = F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), begin, shard, lambda t: t["row"])
        return _let(
            row,
            lambda r: F.struct(
                F.zip_with(s["left"], r, lambda a, b: a - b).alias("left"),
                F.concat(s["out"], F.array(r)).alias("out"),
            ),
        )

    begin = F.struct(left.alias("left"), F.array().cast("array<array<bigint>>").alias("out"))
    return F.aggregate(counts, begin, child, lambda s: s["out"])


def communication_matrix(counts: DataFrame, sizes: list[int], last: int, seed: int) -> DataFrame:
    """``part, row``: rows of each partition for each shard, as a uniform permutation of all rows would have them.

    ``counts`` (``part, n``) holds each partition with rows once, ``last`` its
    greatest ``part``; ``sizes`` sum to the rows of all. A level of the tree
    is one join on the number of a node; a node is at most ``2 ** FAN_OUT_BITS``
    counts.
    """
    levels = 1
    while last >> (FAN_OUT_BITS * levels):
        levels += 1
    spark = counts.sparkSession
    left = F.array(*(F.lit(n).cast("bigint") for n in sizes))
    nodes = spark.range(1).select(F.col("id").alias("node"), left.alias("row"))
    for level in reversed(range(levels)):
        under = F.col("part").cast("bigint")
        children = (
            counts.groupBy(F.shiftright(under, FAN_OUT_BITS * level).alias("child"))
            .agg(F.sum("n").cast("bigint").alias("n"))
            .groupBy(F.shiftright("child", FAN_OUT_BITS).alias("node"))
            .agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children"))
        )
        dealt = _dealt(
            F.transform("children", lambda c: c["n"]), F.col("row"), len(sizes), F.lit(seed), F.lit(level), F.col("node")
        )
        rows = F.arrays_zip(F.transform("children", lambda c: c["child"]).alias("child"), dealt.alias("dealt"))
        nodes = (
            nodes.join(children, "node")
            .select(F.explode(rows).alias("c"))
            .select(F.col("c.child").alias("node"), F.col("c.dealt").alias("row"))
        )
    return nodes.select(F.col("node").cast("int").alias("part"), "row")


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs`` (others ignored).

    Shard sizes differ by one row at most (law ``rows``), slots are gapless
    from 0. A null text has size 8 and the checksum of no bytes. Rows are told
    apart by their place in the input alone, so repeated rows and rows of one
    text are spread like any others; null identifiers are identifiers like
    others, of any type. No rows give no rows. ``grown_shard`` is null: another
    number of shards is another shuffle.
    """
    spark = docs.sparkSession
    root = work_dir(spark, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The first permutation orders each input partition where it is, by draws over the places of its rows. It is settled
    # as a table before it is counted, so that counts hold whatever runs again.
    (
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).alias("draw"),
        )
        .sortWithinPartitions("draw")
        .select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("id"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.shiftright("id", PLACE_BITS).cast("int").alias("part"),
            F.col("id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("at"),
        )
        .write.parquet(f"{root}/rows")
    )
    rows = spark.read.parquet(f"{root}/rows")
    rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/counts")
    counts = spark.read.parquet(f"{root}/counts")
    seen = counts.agg(F.sum("n").alias("total"), F.max("part").alias("last")).first()
    total, last = seen["total"] or 0, seen["last"] or 0
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    communication_matrix(counts, sizes, last, seed).write.parquet(f"{root}/matrix")
    upto = F.aggregate(
        F.col("row"),
        F.array().cast("array<bigint>"),
        lambda a, n: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("bigint")) + n)),
    )
    cut = spark.read.parquet(f"{root}/matrix").select("part", upto.alias("cut"))

    placed = (
        rows.join(cut, "part")
        .withColumn("shard", F.size(F.filter("cut", lambda c: c <= F.col("at"))))
        .withColumn("draw", F.xxhash64(F.lit(seed + 1), "part", "at"))
    )
    # A shard is ordered by its draws, range by range; ranges before it say where a range begins.
    ranges = max(1, -(-total // (shards * ROWS_AT_ONCE)))
    width = 2.0**64 / ranges
    placed = placed.withColumn("range", F.floor((F.col("draw").cast("double") + F.lit(2.0**63)) / F.lit(width)).cast("int"))
    place = ["part", "at"]
    placed.select("doc_id", "size", "text_crc32", *place, "shard", "draw", "range").write.parquet(f"{root}/placed")
    placed = spark.read.parquet(f"{root}/placed")
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        placed.groupBy("shard", "range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    )
    within = Window.partitionBy("shard", "range").orderBy("draw", *place)
    return (
        placed.withColumn("rank", F.row_number().over(within) - 1)
        .join(begins, ["shard", "range"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("begin") + F.col("rank")).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shuffled_shards`` of all documents; its statements on nulls, repeated rows and no rows hold."""
    return shuffled_shards(table(spark, sf_dir, "documents"))

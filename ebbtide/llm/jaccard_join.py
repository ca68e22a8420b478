"""N-gram Jaccard join: prefix filters under several global orders, then exact verification.

Documents with equal shingle sets are one *node*. Two nodes can only be similar
if they share a token among the first ones of both under every global order of
tokens. The first order puts tokens that very many documents hold last, and its
prefixes are what nodes are joined on; prefixes under two further orders are
intersected for each candidate before its sets are compared.

Nodes that share a token are compared in groups of bounded size: a group keeps
pairs whose sizes and parity sketches allow the similarity (the sketches of two
sets differ in at most as many bits as the sets do in tokens). A pair is left to
the group of its first common token where the first tokens of both tell. Large groups keep
a spanning forest of such pairs only. If a pair of a forest turns out false,
its components are compared again, this time with every pair between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.components import components
from ebbtide.llm.lm_score import Tally, most_seen
from ebbtide.llm.registry import query, table
from ebbtide.llm.repeats import release
from ebbtide.llm.substring_dedup import words
from ebbtide.llm.texts import Rolling, as_rows, identified, integers, mixed, pieces, small_batches, strings
from ebbtide.session import work_dir

#: Tokens that come last in the first order: those in most documents.
COMMON_TOKENS = 1 << 18
#: Documents of a task from which a token is counted, and tokens that a task counts at once. Beyond them it forgets
#: those seen once, so a token may miss a few documents of each task; this moves it in the order and changes no result.
COUNTED_FROM = 3
COUNTED_AT_ONCE = 1 << 20
#: Nodes of a group that are compared at once; tokens of more are laid out in tiles.
TILE = 4096
#: Groups up to this size keep every possible pair, larger ones a forest.
SMALL_GROUP = 64
#: 64-bit words of the parity sketches of the second join.
FINE_SKETCH = 16
#: First tokens of a node that each of its rows carries.
FIRST = 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; similar from ``over / under`` on; words of the first sketches."""

    words: int = 3
    over: int = 90
    under: int = 100
    sketch: int = 4

    def prefix(self, n: int) -> int:
        """Tokens of a set of ``n`` that suffice to meet every similar set."""
        return n - -(-self.over * n // self.under) + 1

    def similar(self, common, a, b):
        return self.under * common >= self.over * (a + b - common)

    def may_be_similar(self, a, b, different):
        """Can sets of ``a`` and ``b`` tokens be similar that differ in at least ``different``?"""
        low, high = np.minimum(a, b), np.maximum(a, b)
        return (self.under * low >= self.over * high) & self.similar((a + b - different) // 2, a, b)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows in the jobs inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shingle_sets(batch: pa.RecordBatch, rule: Rule) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted shingle hashes of each text of a batch."""
    data, offsets = strings(batch, "text")
    roll = Rolling(4)
    for i, j, a, z in pieces(offsets, 0, max(1 << 19, int(np.diff(offsets).max(initial=0)))):
        w, upto = words(_LOWER[data[a:z]], offsets[i + 1 : j + 1] - a)
        p = roll.prefix(w)
        every = mixed(roll.every(p, rule.words))
        begin = 0
        for r, end in enumerate(upto.tolist()):
            n = end - begin
            if n >= rule.words:
                yield i + r, np.unique(every[begin : end - rule.words + 1])
            elif n:  # the whole sequence; its length tells it from shingles
                yield i + r, mixed(roll.of(p, np.array([begin]), n) + np.uint64(n))
            else:
                yield i + r, np.zeros(0, np.uint64)
            begin = end


def node_of(tokens: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set; the first names its node."""
    n = np.uint64(len(tokens))
    a = mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    b = mixed(tokens * np.uint64(0x9E3779B97F4A7C15) + np.uint64(77)).sum(dtype=np.uint64)
    both = mixed(np.array([a + n, b ^ n], np.uint64)).view(np.int64)
    return int(both[0]), int(both[1])


def sketch(tokens: np.ndarray, size: int) -> bytes:
    """Parity of the tokens in each of ``64 * size`` bins."""
    bins = (mixed(tokens + np.uint64(5)) % np.uint64(64 * size)).astype(np.int64)
    return np.packbits((np.bincount(bins, minlength=64 * size) & 1).astype(np.uint8)).tobytes()


def own_sketch(tokens: np.ndarray) -> bytes:
    """A sketch with about as many bins as there are tokens."""
    return sketch(tokens, max(2, 1 << (max(1, len(tokens) // 64) - 1).bit_length()))


def difference(x: bytes, y: bytes) -> int:
    """In how many bins two own sketches differ at least; the longer one is folded to the length of the other."""
    a, b = (np.frombuffer(s, np.uint64) for s in sorted((x, y), key=len))
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ folded).sum())


def other_prefix(tokens: np.ndarray, which: int, rule: Rule) -> bytes:
    """The prefix under another order, as 32-bit parts of its hashes."""
    n = rule.prefix(len(tokens))
    order = np.partition(mixed(tokens + np.uint64(1_000_003 * which)), n - 1)
    return (order[:n] >> np.uint64(32)).astype("<u4").tobytes()


def _survey(rule: Rule):
    """A row for each text, and how many documents of the task hold a token if they are several."""

    def rows(kind, a, b, c, n, p, q, s):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(a), kind, np.int32)),
                pa.array(a, pa.int64()),
                pa.array(b, pa.int64()),
                pa.array(c, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(p, pa.binary()),
                pa.array(q, pa.binary()),
                pa.array(s, pa.binary()),
            ],
            names=["kind", "a", "b", "c", "n", "p", "q", "s"],
        )

    def counted(tally: Tally):
        keys, c = tally.taken()
        keys, c = keys[c >= COUNTED_FROM], c[c >= COUNTED_FROM]
        nothing = [None] * len(keys)
        return rows(1, keys.view(np.int64), nothing, nothing, c, nothing, nothing, nothing)

    def run(batches):
        tally = Tally(COUNTED_AT_ONCE)
        for batch in batches:
            uid = integers(batch, "uid")
            out, seen = [], []
            for r, tokens in shingle_sets(batch, rule):
                if len(tokens):
                    seen.append(tokens)
                    f, g = node_of(tokens)
                    prefixes = other_prefix(tokens, 1, rule), other_prefix(tokens, 2, rule)
                    out.append((uid[r], f, g, len(tokens), *prefixes, own_sketch(tokens)))
                else:
                    out.append((uid[r], None, None, 0, None, None, None))
            if out:
                yield rows(0, *map(list, zip(*out)))
            if seen:
                tally.add(np.concatenate(seen))
            if tally.size() > COUNTED_AT_ONCE:
                tally.drop_single()
                if tally.size() > COUNTED_AT_ONCE // 2:
                    yield counted(tally)
        yield counted(tally)

    return run


def _sort_order(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tokens under the first order: common ones last, the most common at the end."""
    keys, level = common
    order = tokens >> np.uint64(7)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
        hit = keys[at] == tokens
        order = order | (np.where(hit, level[at], 0).astype(np.uint64) << np.uint64(57))
    return tokens[np.argsort(order)]


def _tiled(token: int, node: int, tiles: int) -> list[int]:
    """Keys of the groups in which a node meets all others of the token."""
    if tiles == 1:
        return [token]
    own = node % tiles
    pairs = np.array([min(own, o) * tiles + max(own, o) + 1 for o in range(tiles)], np.uint64)
    return mixed(np.uint64(token) + pairs * np.uint64(0x9E3779B97F4A7C15)).tolist()


def _prefix_rows(common, counts, size: int, nodes: list[tuple]) -> pa.RecordBatch:
    """``key, node, component, n, s`` for each prefix token of ``nodes`` (node, component, tokens, prefix length).

    ``s`` holds the sketch, the node's first tokens, and how many of them come
    before the row's own token.
    """
    key, node, comp, n, s = [], [], [], [], []
    for name, component, tokens, prefix in nodes:
        first = _sort_order(tokens, common)[:prefix]
        rank = np.minimum(np.arange(prefix), FIRST)
        keys = first
        if len(counts[0]):
            at = np.minimum(np.searchsorted(counts[0], first), len(counts[0]) - 1)
            many = (counts[0][at] == first) & (counts[1][at] > TILE)
            if many.any():
                wide = [_tiled(int(t), name, -(-int(c) // TILE)) for t, c in zip(first[many], counts[1][at][many])]
                keys = np.concatenate([first[~many], *(np.array(x, np.uint64) for x in wide)])
                rank = np.concatenate([rank[~many], np.repeat(rank[many], [len(x) for x in wide])])
        m = len(keys)
        row = np.zeros((m, size + FIRST + 1), np.uint64)
        row[:, :size] = np.frombuffer(sketch(tokens, size), np.uint64)
        row[:, size : size + min(FIRST, prefix)] = first[:FIRST]
        row[:, -1] = rank
        key.append(keys)
        node.append(np.full(m, name, np.int64))
        comp.append(np.full(m, component, np.int64))
        n.append(np.full(m, len(tokens), np.int32))
        s.append(row.tobytes())
    width = 8 * (size + FIRST + 1)
    total = sum(map(len, key))
    data = pa.py_buffer(b"".join(s))
    offsets = pa.py_buffer((np.arange(total + 1) * width).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(key).view(np.int64)),
            pa.array(np.concatenate(node)),
            pa.array(np.concatenate(comp)),
            pa.array(np.concatenate(n)),
            pa.Array.from_buffers(pa.binary(), total, [None, offsets, data]),
        ],
        names=["key", "node", "component", "n", "s"],
    )


_PREFIX = "key bigint, node bigint, component bigint, n int, s binary"


def _forest(node, component, n, bits, rule: Rule):
    """Pairs that span what may be similar in a group, breadth first from the smallest node."""
    left = np.argsort(node, kind="stable")
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop(0)
            ok = _possible(x, left, component, n, bits, rule) | (component[left] == component[x])
            for y in left[ok]:
                if component[y] != component[x]:
                    yield x, y
            queue.extend(left[ok])
            left = left[~ok]


def _possible(x, others, component, n, bits, rule: Rule) -> np.ndarray:
    """Which of ``others`` may be similar to ``x`` and meet it in this group first, as far as their first tokens tell."""
    size = bits.shape[1] - FIRST - 1
    different = np.bitwise_count(bits[others, :size] ^ bits[x, :size]).sum(axis=1).astype(np.int64)
    ok = (component[others] != component[x]) & rule.may_be_similar(n[others], n[x], different)
    for p in range(int(bits[x, -1])):
        for q in range(FIRST):
            ok &= ~((bits[others, size + q] == bits[x, size + p]) & (bits[others, -1] > q))
    return ok


def _pairs(rule: Rule, all_pairs: bool):
    """``a, b, whole``: candidates of each group of rows with one key; the rows come sorted by it.

    ``whole`` is false for pairs that stand for others.
    """

    def of_group(node, component, n, bits):
        node, first = np.unique(node, return_index=True)
        component, n, bits = component[first], n[first], bits[first]
        if len(node) < 2:
            return
        if all_pairs or len(node) <= SMALL_GROUP:
            for x in range(len(node) - 1):
                others = np.arange(x + 1, len(node))
                for y in others[_possible(x, others, component, n, bits, rule)]:
                    yield node[x], node[y], True
        else:
            for x, y in _forest(node, component, n, bits, rule):
                yield min(node[x], node[y]), max(node[x], node[y]), False

    def run(batches):
        held: list[tuple] = []
        seen: set[tuple] = set()
        out: list[tuple] = []

        def groups(rows, last: bool):
            """Whole groups of sorted rows; the last one is held back unless it is the end."""
            key = rows[0]
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            bounds = np.concatenate(([0], cut, [len(key)]))
            if not last:
                held.append(tuple(c[bounds[-2] :] for c in rows))
                bounds = bounds[:-1]
            size = np.diff(bounds)
            for g in np.flatnonzero(size > 1):
                yield tuple(c[bounds[g] : bounds[g + 1]] for c in rows[1:])

        def taken(rows, last):
            for group in groups(rows, last):
                for pair in of_group(*group):
                    if pair not in seen:
                        seen.add(pair)
                        out.append(pair)
            if len(seen) > 100_000:
                seen.clear()

        def flushed():
            rows = list(zip(*out)) or [[], [], []]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.bool_())],
                names=["a", "b", "whole"],
            )
            out.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            raw, offsets = strings(batch, "s")
            bits = raw[offsets[0] : offsets[-1]].reshape(batch.num_rows, -1).copy().view(np.uint64)
            own = (
                integers(batch, "key"),
                integers(batch, "node"),
                integers(batch, "component"),
                integers(batch, "n").astype(np.int64),
                bits,
            )
            parts = [*held, own]
            if held and own[0][0] == held[0][0][0] and own[0][-1] == own[0][0]:
                held.append(own)  # the group goes on
                continue
            held.clear()
            taken(tuple(np.concatenate(c) for c in zip(*parts)), last=False)
            if len(out) > 50_000:
                yield flushed()
        if held:
            parts = list(held)
            held.clear()
            taken(tuple(np.concatenate(c) for c in zip(*parts)), last=True)
        if out:
            yield flushed()

    return run


def _share_prefixes(rule: Rule):
    """Candidates that share a token under both further orders and whose own sketches allow the similarity."""

    def run(batches):
        for batch in batches:
            names = ("na", "nb", "sa", "sb", "pa", "pb", "qa", "qb")
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]
            keep = []
            for na, nb, sa, sb, *prefixes in zip(*columns):
                ok = bool(rule.may_be_similar(na, nb, difference(sa, sb)))
                for x, y in (prefixes[:2], prefixes[2:]):
                    ok = ok and bool(np.isin(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")).any())
                keep.append(ok)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "whole"])

    return run


def _compare(rule: Rule):
    def run(batches):
        for batch in batches:
            sa, sb = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("sa", "sb"))
            good = []
            for x, y in zip(sa, sb):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(bool(rule.similar(common, len(x), len(y))))
            out = batch.select(["a", "b", "whole"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(good)], names=["a", "b", "whole", "good"])

    return run


def _sets(rule: Rule):
    def run(batches):
        for batch in batches:
            node = integers(batch, "node")
            got = [(int(node[r]), tokens.tobytes()) for r, tokens in shingle_sets(batch, rule)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary())], names=["node", "set"]
            )

    return run


class Join:
    """The steps of one join; every step leaves a table under ``root``."""

    def __init__(self, docs: DataFrame, rule: Rule):
        self.spark = docs.sparkSession
        small_batches(self.spark)
        self.rule = rule
        self.root = work_dir(self.spark, "jaccard-join")
        self.docs = docs.select("uid", "text")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        release(df)
        return self.spark.read.parquet(f"{self.root}/{name}")

    def survey(self) -> None:
        columns = "a bigint, b bigint, c bigint, n bigint, p binary, q binary, s binary"
        self.docs.mapInArrow(_survey(self.rule), f"kind int, {columns}").write.partitionBy("kind").parquet(f"{self.root}/survey")
        seen = self.spark.read.schema(f"{columns}, kind int").parquet(f"{self.root}/survey")
        own = seen.where("kind = 0")
        self.members = own.select(F.col("a").alias("uid"), F.col("b").alias("node"), F.col("c").alias("twin"), "n")
        nodes = own.where("n > 0").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("uid"), F.max("n").alias("n"))
        self.nodes = self.save(nodes, "nodes")
        # What candidates are filtered by, from the first document of a node.
        orders = own.select(F.col("a").alias("uid"), F.col("b").alias("node"), "n", "p", "q", "s").join(
            self.nodes.select("uid"), "uid", "left_semi"
        )
        self.orders = orders.select("node", "n", "p", "q", "s")
        tokens = seen.where("kind = 1").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("c"))
        got = most_seen(self.save(tokens, "tokens"), COMMON_TOKENS).toArrow()
        keys = got.column("key").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        counts = got.column("c").to_numpy()[order]
        self.common = (keys[order], np.minimum(1 + np.log2(np.maximum(counts, 1)), 63).astype(np.int64))
        self.counts = (keys[order], counts)

    def candidates(self, rows: DataFrame, all_pairs: bool, name: str) -> DataFrame:
        with batches_of(self.spark, 10_000):
            found = (
                rows.repartition("key")
                .sortWithinPartitions("key")
                .mapInArrow(_pairs(self.rule, all_pairs), "a bigint, b bigint, whole boolean")
                .groupBy("a", "b")
                # A pair that stands for others in any group does so.
                .agg(F.min("whole").alias("whole"))
            )
            return self.save(found, name)

    def first_rows(self) -> DataFrame:
        shared = self.spark.sparkContext.broadcast((self.common, self.counts))
        rule = self.rule

        def run(batches):
            common, counts = shared.value
            for batch in batches:
                nodes, seen = [], set()
                for _, tokens in shingle_sets(batch, rule):
                    if len(tokens):
                        name = node_of(tokens)[0]
                        if name not in seen:  # equal sets of a batch are one node already
                            seen.add(name)
                            nodes.append((name, name, tokens, rule.prefix(len(tokens))))
                if nodes:
                    yield _prefix_rows(common, counts, rule.sketch, nodes)

        return self.docs.select("text").mapInArrow(run, _PREFIX)

    def later_rows(self, chosen: DataFrame, name: str) -> DataFrame:
        """Prefix rows of chosen nodes (``node``, ``component``), with fine sketches."""
        shared = self.spark.sparkContext.broadcast((self.common, self.counts))
        rule = self.rule
        sets = self.sets(chosen.select("node"), f"{name}-sets").join(chosen, "node")

        def run(batches):
            common, counts = shared.value
            for batch in batches:
                node, component = integers(batch, "node"), integers(batch, "component")
                sets_ = batch.column(batch.schema.get_field_index("set")).to_pylist()
                nodes = []
                for r, s in enumerate(sets_):
                    tokens = np.frombuffer(s, np.uint64)
                    nodes.append((int(node[r]), int(component[r]), tokens, rule.prefix(len(tokens))))
                if nodes:
                    yield _prefix_rows(common, counts, FINE_SKETCH, nodes)

        return sets.mapInArrow(run, _PREFIX)

    def sets(self, wanted: DataFrame, name: str) -> DataFrame:
        uids = self.nodes.join(wanted, "node", "left_semi").select("uid", "node")
        return self.save(
            self.docs.join(uids, "uid").select("node", "text").mapInArrow(_sets(self.rule), "node bigint, set binary"), name
        )

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """``a, b, whole, good`` of the candidates that share prefixes under all orders; others are not similar."""
        left, right = (
            self.orders.select(F.col("node").alias(end), *(F.col(c).alias(c + end) for c in "npqs")) for end in "ab"
        )
        kept = pairs.join(left, "a").join(right, "b")
        kept = kept.mapInArrow(_share_prefixes(self.rule), "a bigint, b bigint, whole boolean")
        kept = self.save(kept, f"{name}-kept")
        ends = kept.select(F.col("a").alias("node")).unionByName(kept.select(F.col("b").alias("node"))).distinct()
        sets = self.sets(ends, f"{name}-sets")
        with batches_of(self.spark, 64):
            compared = (
                kept.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
                .mapInArrow(_compare(self.rule), "a bigint, b bigint, whole boolean, good boolean")
            )
            return self.save(compared, f"{name}-verified")

    def run(self) -> DataFrame:
        """``uid, n, component``, the component being that of its node, or null."""
        self.survey()
        pairs = self.candidates(self.first_rows(), False, "pairs")
        checked = self.verified(pairs, "first")
        links = checked.where("good").select("a", "b")
        labels = self.save(components(links, f"{self.root}/stars-1"), "labels-1")
        # Forest pairs that are false, whether refused by a prefix or by comparison, may have hidden others.
        false = pairs.where("NOT whole").join(links, ["a", "b"], "left_anti")
        ends = false.select(F.col("a").alias("node")).unionByName(false.select(F.col("b").alias("node"))).distinct()
        ends = self.save(self.labelled(ends, labels), "false-ends")
        if not ends.isEmpty():
            touched = ends.select("component").distinct()
            members = self.nodes.select("node").join(labels, "node", "left")
            members = members.select("node", F.coalesce("component", "node").alias("component"))
            again = self.save(members.join(touched, "component", "left_semi"), "again")
            more = self.candidates(self.later_rows(again, "second-rows"), True, "pairs-2")
            links = links.unionByName(self.verified(more, "second").where("good").select("a", "b"))
            labels = self.save(components(links, f"{self.root}/stars-2"), "labels-2")
        return self.members.join(labels, "node", "left").select(
            "uid", F.col("n").cast("bigint").alias("n"), "node", F.coalesce("component", "node").alias("component")
        )

    @staticmethod
    def labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
        return nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def similar_groups(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n_shingles, component_id, first, text_hash`` for each row of ``docs`` (``doc_id``, ``text``; others ignored).

    ``component_id`` is the smallest ``doc_id`` that a document reaches by
    links, itself included; ``first`` marks that document, ``text_hash`` is
    ``xxhash64`` of the text. A text without words links with nothing. Rows with
    equal ``doc_id`` and text are one document, returned for each row; a null
    ``doc_id`` comes before others.
    """
    keyed = identified(docs, "jaccard-docs")
    # uid, n, node and component of each document; documents without a node stand for themselves.
    join = Join(keyed, rule)
    found = join.run()
    ids = keyed.select("uid", "doc_id", "copies", F.xxhash64("text").alias("text_hash"))
    labelled = found.join(ids, "uid")
    alone = F.col("node").isNull()
    # As a table, so that the join below is split where one component has very many documents.
    least = labelled.where(~alone).groupBy("component").agg(F.min(F.struct("uid", "doc_id")).alias("least"))
    least = join.save(least, "least")
    result = labelled.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        (alone | (F.col("uid") == F.col("least.uid"))).alias("first"),
        "text_hash",
        "copies",
    )
    return as_rows(result)


@query("op9_ngram_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), Rule()).select("doc_id", "n_shingles", "component_id")

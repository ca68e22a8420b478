"""Language-model scores of texts: context-tree weighting over bytes.

Every byte is eight binary decisions. A decision's contexts are the zero to
``DEPTH`` bytes before it, and each context keeps a Krichevsky-Trofimov
estimate of the decision. Context-tree weighting mixes the estimates of all
depths, each context by how well it described the training texts compared with
its own longer contexts. The score is the code length of a text in this model.

Counts are summed over all training texts in Spark, and all of them are in the
tree. Contexts that end in the same ``SUFFIX`` bytes are a subtree of their own,
which one task builds; the driver has the contexts above, at most 256 of one
byte. What comes out is a table of all contexts with a next byte and the
probability of it. Tasks that score hold the most frequent of them, ``GRAMS`` at
most; what they lack is looked up by a join. A byte that never followed its
context is looked up bit by bit in its subtree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.llm.substring_dedup import words
from ebbtide.llm.texts import as_rows, identified, integers, pieces, small_batches, strings
from ebbtide.session import work_dir

DEPTH = 5
#: Contexts with a next byte that every task holds; the probabilities of others are joined.
GRAMS = 1 << 18
#: Contexts that agree in so many last bytes are in one task when the tree is built.
SUFFIX = 2
#: Parts that the subtrees are dealt into.
PARTS = 256
#: Words whose counts every task holds; the counts of others are joined.
COMMON_WORDS = 1 << 18
#: Entries of a task's tally, after which it is sent on.
TALLY = 1 << 21

_WORD, _GRAM = 0, 1
_END = 0x5EED_0E4D
_HALF = math.log(0.5)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def trains(doc_id: Column) -> Column:
    """Is a document learned from: the checksum of its number, as text, has not remainder 2 by 7 (null: empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


def grams(data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """The last ``DEPTH + 1`` bytes at every byte that the model sees of texts ``i`` to ``j``, and their number by text.

    The model sees the words in lower case with one space between them, and a
    line end. ``DEPTH`` line ends come before each text.
    """
    pad = b"\n" * DEPTH
    seen = [pad + b" ".join(_LOWER[data[offsets[r] : offsets[r + 1]]].tobytes().split()) + b"\n" for r in range(i, j)]
    n = np.array([len(s) for s in seen], np.int64)
    x = np.frombuffer(b"".join(seen), np.uint8).astype(np.uint64)
    code = np.zeros(max(0, len(x) - DEPTH), np.uint64)
    for k in range(DEPTH + 1):
        code |= x[k : k + len(code)] << np.uint64(8 * (DEPTH - k))
    keep = np.ones(len(code), bool)
    edge = np.cumsum(n)[:-1]
    for k in range(1, DEPTH + 1):  # grams that begin in the text before
        keep[edge - k] = False
    return code[keep], n - DEPTH


class Tally:
    """Counts by key, in sorted arrays of about ``limit`` entries."""

    def __init__(self, limit: int = TALLY):
        self.limit = limit
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.loose = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.loose += len(self.parts[-1][0])
            if self.loose > self.limit // 2:
                self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys = np.concatenate([k for k, _ in self.parts])
            order = np.argsort(keys)
            keys, c = keys[order], np.concatenate([c for _, c in self.parts])[order]
            cut = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.parts = [(keys[cut], np.add.reduceat(c, cut))]
        self.loose = 0

    def drop_single(self) -> None:
        """Forget what was counted once."""
        self.merge()
        self.parts = [(k[c > 1], c[c > 1]) for k, c in self.parts]

    def size(self) -> int:
        return sum(len(k) for k, _ in self.parts)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        out = self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.parts = []
        return out


def _count(batches):
    """``kind, key, c``: words and grams of the training texts, summed in the task."""
    tallies = {_WORD: Tally(), _GRAM: Tally()}

    def rows(kind: int) -> pa.RecordBatch:
        keys, c = tallies[kind].taken()
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(c.astype(np.int64))],
            names=["kind", "key", "c"],
        )

    for batch in batches:
        data, offsets = strings(batch, "text")
        for i, j, a, z in pieces(offsets, 0, max(1 << 20, int(np.diff(offsets).max(initial=0)))):
            w, _ = words(_LOWER[data[a:z]], offsets[i + 1 : j + 1] - a)
            tallies[_WORD].add(w)
            tallies[_WORD].add(np.full(j - i, _END, np.uint64))
            tallies[_GRAM].add(grams(data, offsets, i, j)[0])
            for kind, tally in tallies.items():
                if tally.size() > TALLY:
                    yield rows(kind)
    for kind in tallies:
        yield rows(kind)


_STEP = "CAST(floor(log2(c) * 8) AS INT)"


def _bound(sizes: DataFrame, limit: int) -> int | None:
    """The least ``b`` from which the ``n`` of all rows sum to ``limit`` at most; ``sizes`` has a few hundred rows."""
    left, bound = limit, None
    for r in sorted(sizes.select("b", "n").collect(), reverse=True):
        if r["n"] > left:
            break
        left, bound = left - r["n"], r["b"]
    return bound


def most_seen(counts: DataFrame, limit: int) -> DataFrame:
    """The rows with the largest ``c``, ``limit`` at most: those above a bound that a histogram of logarithms gives."""
    bound = _bound(counts.groupBy(F.expr(_STEP).alias("b")).agg(F.count(F.lit(1)).alias("n")), limit)
    return counts.where(F.lit(False) if bound is None else F.expr(_STEP) >= bound)


def _sorted(t: pa.Table, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Column ``key`` in order, and the column ``value`` beside it."""
    keys = t.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], t.column(value).to_numpy()[order]


def _arrays(rows: DataFrame, value: str = "c") -> tuple[np.ndarray, np.ndarray]:
    return _sorted(rows.select("key", value).toArrow(), value)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys, each once, and the sums of their values."""
    cut = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[cut], np.add.reduceat(values, cut) if len(cut) else values


def _lgamma(x: np.ndarray) -> np.ndarray:
    product, y = np.ones_like(x), x.copy()
    for _ in range(8):
        product *= y
        y = y + 1
    r = 1 / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + r / 12 - r**3 / 360 + r**5 / 1260 - np.log(product)


def _evidence(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - math.log(math.pi)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


@dataclass(frozen=True)
class Above:
    """What the driver knows of the contexts shorter than ``SUFFIX`` bytes: the tree there, and the mixture that goes on below."""

    nodes: list[list[tuple[np.ndarray, np.ndarray]]]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[np.ndarray]
    on: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # by bit: sorted nodes of the last depth, mixture so far and weight left


@dataclass(frozen=True)
class Tree:
    """By bit and depth: sorted nodes (context and the byte's bits so far) and the mixture's probability of a one.

    The probability is that of a context which the tree does not follow further.
    """

    nodes: list[list[tuple[np.ndarray, np.ndarray]]]
    grams: list[tuple[np.ndarray, np.ndarray]]  # by depth: sorted grams and their log-probabilities
    contexts: list[np.ndarray]

    @staticmethod
    def build(levels: list[tuple[np.ndarray, np.ndarray]], above: Above | None = None) -> Tree:
        """From sorted grams and counts by depth, the shortest first; a context is held if its shorter one is.

        With ``above`` the first depth is ``SUFFIX``, and the tree goes on below what is there.
        """
        first = 0 if above is None else SUFFIX
        levels = list(levels)
        for i in range(1, len(levels)):
            codes, c = levels[i]
            shorter = (codes >> np.uint64(8)) & np.uint64((1 << (8 * (first + i - 1))) - 1)
            keep = np.isin(shorter, levels[i - 1][0] >> np.uint64(8))
            levels[i] = codes[keep], c[keep]
        nodes = [Tree._mixed(Tree._weighted(levels, b, first), first, above and above.on[b])[0] for b in range(8)]
        grams = [(codes, Tree._gram_logs(codes, [nodes[b][i] for b in range(8)])) for i, (codes, _) in enumerate(levels)]
        contexts = [np.unique(codes >> np.uint64(8)) for codes, _ in levels]
        if above is None:
            return Tree(nodes, grams, contexts)
        return Tree([above.nodes[b] + nodes[b] for b in range(8)], above.grams + grams, above.contexts + contexts)

    @staticmethod
    def _gram_logs(codes: np.ndarray, nodes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        ln = np.zeros(len(codes))
        for b in range(8):
            keys, p = nodes[b]
            ln += _log_of_bit(codes, b, p[np.searchsorted(keys, Tree._node(codes, b))])
        return ln.astype(np.float32)

    @staticmethod
    def _weighted(levels, b: int, first: int = 0, below: tuple[np.ndarray, np.ndarray] | None = None) -> dict:
        """Nodes from the deepest depth up: how much each context weighs, and how much of that is its own.

        The depths are those from ``first`` on. ``below`` has sorted nodes of the last one and the weights of all
        contexts one byte longer, if the tree goes on there.
        """
        keys, zeros, ones = [], [], []
        for codes, c in levels:
            key = Tree._node(codes, b)
            cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
            bit = (codes >> np.uint64(7 - b)) & np.uint64(1)
            keys.append(key[cut])
            for out, chosen in ((zeros, bit == 0), (ones, bit == 1)):
                out.append(np.add.reduceat(np.where(chosen, c, 0).astype(float), cut) if len(cut) else np.zeros(0))
        last = len(levels) - 1
        parents = [None] + [
            _find(keys[i - 1], keys[i] & np.uint64((1 << (8 * (first + i))) - 1)) for i in range(1, last + 1)
        ]
        stop, other, total = [None] * last + [np.ones(1)], [None] * last + [0.5], None
        for i in range(last, -1, -1):
            own, longer = _evidence(zeros[i], ones[i]), total
            total = own
            if i < last:
                seen, at = parents[i + 1]

                def held(of, n=len(own), at=at[seen], seen=seen):
                    return np.bincount(at, weights=of[seen], minlength=n)

                # What went on in contexts that are not held is a branch of its own.
                z, o = zeros[i] - held(zeros[i + 1]), ones[i] - held(ones[i + 1])
                split = held(np.ones(len(seen))) > 0
                total = np.where(split, np.logaddexp(_HALF + own, _HALF + held(longer) + _evidence(z, o)), own)
                stop[i] = np.where(split, np.exp(_HALF + own - total), 1.0)
                other[i] = (o + 0.5) / (z + o + 1.0)
            elif below is not None:
                seen, at = _find(below[0], keys[i])
                weight = np.where(seen, below[1][at] if len(below[1]) else 0.0, 0.0)
                total = np.where(seen, np.logaddexp(_HALF + own, _HALF + weight), own)
                stop[i], other[i] = np.where(seen, np.exp(_HALF + own - total), 1.0), 0.5
        return {"keys": keys, "zeros": zeros, "ones": ones, "parents": parents, "stop": stop, "other": other, "total": total}

    @staticmethod
    def _mixed(w: dict, first: int = 0, on: tuple | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple]:
        """Nodes with the mixture's probability of a one, and the mixture and the weight left at those of the last depth."""
        out, mix, left = [], np.zeros(1), np.ones(1)
        for i, keys in enumerate(w["keys"]):
            one = (w["ones"][i] + 0.5) / (w["zeros"][i] + w["ones"][i] + 1.0)
            if i:  # a held context's shorter one is held
                at = w["parents"][i][1]
                mix, left = mix[at], left[at]
            elif on is not None:
                _, at = _find(on[0], keys & np.uint64((1 << (8 * first)) - 1))
                mix, left = on[1][at], on[2][at]
            mix, left = mix + left * w["stop"][i] * one, left * (1 - w["stop"][i])
            out.append((keys, (mix + left * w["other"][i]).astype(np.float32)))
        return out, (w["keys"][-1], mix, left)

    @staticmethod
    def _node(codes: np.ndarray, b: int) -> np.ndarray:
        """Context and the first ``b`` bits of the byte, under a leading one."""
        prefix = ((codes & np.uint64(255)) >> np.uint64(8 - b)) | np.uint64(1 << b)
        return (codes >> np.uint64(8) << np.uint64(8)) | prefix

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each gram's last byte after the bytes before it."""
        out = np.zeros(len(codes))
        rest = np.arange(len(codes))
        for d in range(len(self.grams) - 1, -1, -1):
            own = codes[rest] & np.uint64((1 << (8 * (d + 1))) - 1)
            found, at = _find(self.grams[d][0], own)
            if found.any():
                out[rest[found]] = self.grams[d][1][at[found]]
            rest, own = rest[~found], own[~found]
            # A context that is held but never went on like this: bit by bit.
            held, _ = _find(self.contexts[d], own >> np.uint64(8))
            if d == 0:
                held[:] = True
            if held.any():
                out[rest[held]] = self._by_bits(own[held], d)
            rest = rest[~held]
        return out

    def _by_bits(self, codes: np.ndarray, depth: int) -> np.ndarray:
        out = np.zeros(len(codes))
        for b in range(8):
            node = Tree._node(codes, b)
            one = np.full(len(codes), 0.5)
            rest = np.arange(len(codes))
            for d in range(depth, -1, -1):
                keys, p = self.nodes[b][d]
                hit, at = _find(keys, node[rest] & np.uint64((1 << (8 * (d + 1))) - 1))
                one[rest[hit]] = p[at[hit]]
                rest = rest[~hit]
                if not len(rest):
                    break
            out += _log_of_bit(codes, b, one)
        return out


def _log_of_bit(codes: np.ndarray, b: int, one: np.ndarray) -> np.ndarray:
    one = np.clip(one.astype(float), 1e-9, 1 - 1e-9)
    return np.log(np.where((codes >> np.uint64(7 - b)) & np.uint64(1) == 1, one, 1 - one))


def _part(key: Column) -> Column:
    """The part of the subtrees that a gram belongs to, by the last ``SUFFIX`` bytes of its context."""
    suffix = F.shiftrightunsigned(key, 8).bitwiseAND(F.lit((1 << (8 * SUFFIX)) - 1).cast("bigint"))
    return F.pmod(F.xxhash64(suffix), F.lit(PARTS)).cast("int")


def _subtree_levels(t: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and counts from depth ``SUFFIX`` on, of whole subtrees."""
    levels = [_sorted(t, "c")]
    for d in range(DEPTH - 1, SUFFIX - 1, -1):
        codes, c = levels[0]
        shorter = codes & np.uint64((1 << (8 * (d + 1))) - 1)
        order = np.argsort(shorter, kind="stable")
        levels.insert(0, _summed(shorter[order], c[order]))
    return levels


def _weights(t: pa.Table) -> pa.Table:
    """``key, total``: nodes one byte above the subtrees, and the weights of the subtrees below them."""
    levels = _subtree_levels(t)
    keys, totals = [], []
    for b in range(8):
        w = Tree._weighted(levels, b, SUFFIX)
        key = w["keys"][0] & np.uint64((1 << (8 * SUFFIX)) - 1)
        order = np.argsort(key, kind="stable")
        for out, x in zip((keys, totals), _summed(key[order], w["total"][order])):
            out.append(x)
    return pa.table({"key": np.concatenate(keys).view(np.int64), "total": np.concatenate(totals)})


def _above(counts: DataFrame, parts: DataFrame) -> Above:
    """The contexts shorter than ``SUFFIX`` bytes, from ``counts`` of all grams and ``parts`` of them by ``part``."""
    longest = F.col("key").bitwiseAND(F.lit((1 << (8 * SUFFIX)) - 1).cast("bigint"))
    levels = [_arrays(counts.groupBy(longest.alias("key")).agg(F.sum("c").alias("c")))]
    for d in range(SUFFIX - 2, -1, -1):
        shorter = levels[0][0] & np.uint64((1 << (8 * (d + 1))) - 1)
        order = np.argsort(shorter, kind="stable")
        levels.insert(0, _summed(shorter[order], levels[0][1][order]))
    weights = parts.groupBy("part").applyInArrow(_weights, "key bigint, total double").groupBy("key").agg(F.sum("total").alias("total"))
    below = _arrays(weights, "total")
    nodes, on = [], []
    for b in range(8):
        bits = (below[0] & np.uint64(255)) >> np.uint64(b) == 1  # nodes with ``b`` bits of the byte
        n, mixture = Tree._mixed(Tree._weighted(levels, b, 0, (below[0][bits], below[1][bits])))
        nodes.append(n)
        on.append(mixture)
    grams = [(codes, Tree._gram_logs(codes, [nodes[b][d] for b in range(8)])) for d, (codes, _) in enumerate(levels)]
    return Above(nodes, grams, [np.unique(codes >> np.uint64(8)) for codes, _ in levels], on)


@dataclass(frozen=True)
class Learned:
    grams: np.ndarray  # the most frequent ones, sorted
    logs: np.ndarray
    words: np.ndarray  # hashes of common words, sorted
    counts: np.ndarray
    tokens: int
    distinct: int


def learn(docs: DataFrame, root: str) -> tuple[Learned, Above]:
    """Counts of ``docs`` (``text``) in ``root``, as ``kind``, ``key``, ``c``, and what tasks need of them.

    ``root`` also gets ``grams`` as ``key``, ``c``, ``ln``: all grams that were seen, with the logarithm of the probability
    that the whole tree gives them.
    """
    spark = docs.sparkSession
    (
        docs.select("text")
        .mapInArrow(_count, "kind int, key bigint, c bigint")
        .groupBy("kind", "key")
        .agg(F.sum("c").alias("c"))
        .write.partitionBy("kind")
        .parquet(f"{root}/counts")
    )
    counts = spark.read.schema("key bigint, c bigint, kind int").parquet(f"{root}/counts")
    word = counts.where(F.col("kind") == _WORD).select("key", "c")
    total = word.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    gram = counts.where(F.col("kind") == _GRAM).select("key", "c")
    parts = gram.withColumn("part", _part(F.col("key")))
    above = _above(gram, parts)
    shared = spark.sparkContext.broadcast(above)

    def logs(t: pa.Table) -> pa.Table:
        levels = _subtree_levels(t)
        codes, ln = Tree.build(levels, shared.value).grams[-1]
        return pa.table({"key": codes.view(np.int64), "c": levels[-1][1], "ln": ln})

    parts.groupBy("part").applyInArrow(logs, "key bigint, c bigint, ln float").write.parquet(f"{root}/grams")
    grams = spark.read.schema("key bigint, c bigint, ln float").parquet(f"{root}/grams")
    common = _arrays(most_seen(grams, GRAMS), "ln")
    return Learned(*common, *_arrays(most_seen(word, COMMON_WORDS)), total["n"] or 0, total["v"]), above


def _unseen(grams: DataFrame, keys: DataFrame, above: Above) -> DataFrame:
    """``key, ln``: the probabilities of grams (``key``) that were never seen, each in its subtree of ``grams``."""
    shared = grams.sparkSession.sparkContext.broadcast(above)

    def logs(seen: pa.Table, wanted: pa.Table) -> pa.Table:
        key = wanted.column("key").to_numpy().astype(np.int64)
        codes = key.view(np.uint64)
        ln = Tree.build(_subtree_levels(seen), shared.value).log_probability(codes) if len(key) else np.zeros(0)
        return pa.table({"key": key, "ln": ln.astype(np.float32)})

    sides = [df.withColumn("part", _part(F.col("key"))).groupBy("part") for df in (grams, keys)]
    return sides[0].cogroup(sides[1]).applyInArrow(logs, "key bigint, ln float")


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte`` per row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; others are ignored. A null text is
    empty and has one token, the end. ``base_score`` is that of single words
    with one added to every count, ``score`` that of the whole weighted tree over
    the ``n_bytes`` which it sees; both are logarithms to base ten. Rows with equal
    ``doc_id`` and text are one document, returned for each row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    root = work_dir(spark, "lm-score")
    keyed = identified(docs, "lm-docs")
    learned, above = learn(as_rows(keyed.where(trains(F.col("doc_id"))).select("text", "copies")), root)
    shared = spark.sparkContext.broadcast(learned)

    def run(batches):
        m = shared.value
        base = np.log10((m.counts + 1) / (m.tokens + m.distinct + 1))
        for batch in batches:
            data, offsets = strings(batch, "text")
            uid = integers(batch, "uid")
            for i, j, a, z in pieces(offsets, 0, max(1 << 20, int(np.diff(offsets).max(initial=0)))):
                w, upto = words(_LOWER[data[a:z]], offsets[i + 1 : j + 1] - a)
                n = np.diff(np.concatenate(([0], upto)))
                row = np.repeat(np.arange(j - i + 0), n)
                row = np.concatenate((row, np.arange(j - i)))
                w = np.concatenate((w, np.full(j - i, _END, np.uint64)))
                codes, unique = pd.factorize(w)
                common, at = _find(m.words, unique)
                value = np.zeros(len(unique))
                value[common] = base[at[common]]
                found = common[codes]
                sums = np.bincount(row, weights=value[codes], minlength=j - i)
                known = np.bincount(row[found], minlength=j - i)
                rare_row, rare = row[~found], w[~found]
                order = np.argsort(rare_row, kind="stable")
                bounds = np.searchsorted(rare_row[order], np.arange(j - i + 1))
                code, seen = grams(data, offsets, i, j)
                codes, unique = pd.factorize(code)
                common, at = _find(m.grams, unique)
                ln = np.zeros(len(unique))
                ln[common] = m.logs[at[common]]
                ln, lacking = ln[codes], ~common[codes]
                place = np.repeat(np.arange(j - i), seen)
                others = np.concatenate(([0], np.cumsum(np.bincount(place[lacking], minlength=j - i))))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uid[i:j]),
                        pa.array(n + 1),
                        pa.array(known.astype(np.int64)),
                        pa.array(sums),
                        pa.array(np.bincount(place, weights=ln, minlength=j - i) / math.log(10)),
                        pa.array(seen),
                        pa.ListArray.from_arrays(
                            pa.array(bounds.astype(np.int32)), pa.array(rare[order].view(np.int64))
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(others.astype(np.int32)), pa.array(code[lacking].view(np.int64))
                        ),
                    ],
                    names=["uid", "n_tokens", "n_known", "base", "score", "n_bytes", "rare", "others"],
                )

    keyed.select("uid", "text").mapInArrow(
        run,
        "uid bigint, n_tokens bigint, n_known bigint, base double, score double, n_bytes bigint, rare array<bigint>, others array<bigint>",
    ).write.parquet(f"{root}/scored")
    scored = spark.read.parquet(f"{root}/scored")
    counts = spark.read.schema("key bigint, c bigint, kind int").parquet(f"{root}/counts")
    word = counts.where(F.col("kind") == _WORD).select("key", "c")
    c = F.coalesce("c", F.lit(0))
    rare = (
        scored.select("uid", F.explode("rare").alias("key"))
        .join(word, "key", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.log10((c + 1) / F.lit(float(learned.tokens + learned.distinct + 1)))).alias("_base"),
            F.sum((c > 0).cast("bigint")).alias("_known"),
        )
    )
    # Bytes in grams that tasks do not hold: what was seen has its probability, the others get theirs once each.
    seen = spark.read.schema("key bigint, c bigint, ln float").parquet(f"{root}/grams")
    other = scored.select("uid", F.explode("others").alias("key"))
    wanted = other.select("key").distinct().join(seen.select("key"), "key", "left_anti")
    _unseen(seen.select("key", "c"), wanted, above).write.parquet(f"{root}/unseen")
    unseen = spark.read.schema("key bigint, ln float").parquet(f"{root}/unseen")
    logs = seen.select("key", "ln").unionByName(unseen)
    summed = other.join(logs, "key").groupBy("uid").agg(F.sum(F.col("ln").cast("double")).alias("_ln"))
    score = F.col("score") + F.coalesce("_ln", F.lit(0.0)) / F.lit(math.log(10))
    return as_rows(
        keyed.select("uid", "doc_id", "copies")
        .join(scored.drop("rare", "others"), "uid")
        .join(rare, "uid", "left")
        .join(summed, "uid", "left")
        .withColumn("score", score)
        .select(
            "doc_id",
            (~trains(F.col("doc_id"))).alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
            F.lit(learned.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
            "score",
            "n_bytes",
            (-F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
            "copies",
        )
    )


@query("op5_lm_score")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))

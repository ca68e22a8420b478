"""Personal data: exact patterns, and a skip-chain conditional random field that adds what they miss.

What a pattern finds is an observed node; other words with a digit or an at
sign, and numbers written as several words, are hidden ones, whether or not a
pattern matches anywhere in the text. Neighbours share a chain potential. Nodes
with the same text, the same last digits or the same name before an at sign
share a skip potential, however far apart they stand. All potentials are
learned from the whole table; loopy message passing then gives each hidden node
its distribution over kinds, and those that are clear become spans.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.llm.texts import small_batches

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
STATES = OTHER + 1
#: Probability from which a hidden node becomes a span.
CLEAR = 0.9
#: Share of nodes whose own features are hidden from learning, so that links learn to do without them.
HIDE = 0.25
#: Means of the potentials before anything is seen: a node is nothing of note, linked nodes agree.
BIAS, AGREE = -2.0, 5.0
#: Variance of that law.
VARIANCE = 9.0
STEPS, RATE = 400, 0.05
#: Rounds of messages at most, the share of the old message that is kept, and the change that ends them.
ROUNDS, KEEP, STILL = 40, 0.25, 1e-6
#: Last digits that make two numbers similar; characters between chain neighbours.
SIMILAR_DIGITS = 7
NEAR = 40
#: Digits of a number written as several words, of one of them, and white space between two of them.
NUMBER_DIGITS, PART_DIGITS, GAP = 15, 9, 3

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never begins inside a run of digits, so the look-behind changes nothing but the time.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_NUMERIC = re.compile(r"[0-9+()./-]+")
_WORD_END = re.compile(r"[\x20\x09-\x0D]|\Z")
_NOT_DIGIT = re.compile(r"[^0-9]")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += _DOUBLED[d] if i % 2 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, sought from each at sign."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``kind, start, end`` by kind, then start, in code points."""
    out = [(0, a, z) for a, z in emails(text)] if "@" in text else []
    if any(c in text for c in "0123456789"):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NOT_DIGIT.sub("", m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def _bucket(n: int, bounds: tuple[int, ...]) -> int:
    return sum(n > b for b in bounds)


#: Values of each feature of a node, in the order of ``features``.
VALUES = (9, 4, 2, 3)


def features(word: str) -> tuple[int, int, int, int]:
    """Digits (and whether 16 to 19 of them pass the card check), dots, an at sign, letters.

    What a pattern alone insists on, such as a leading plus or a domain with a
    dot, is left out: its absence says nothing about what the pattern missed.
    """
    digits = _NOT_DIGIT.sub("", word)
    number = _bucket(len(digits), (0, 3, 6, 9, 12, 15, 19))
    if number == 6 and luhn(digits):
        number = 8
    return (
        number,
        _bucket(word.count("."), (0, 1, 2)),
        int("@" in word),
        _bucket(sum(c.isalpha() for c in word), (0, 3)),
    )


def links(word: str) -> list[str]:
    """What a node shares with those that are the same or similar."""
    digits = _NOT_DIGIT.sub("", word)
    out = [f"w{word.lower()}"]
    if len(digits) >= SIMILAR_DIGITS:
        out.append(f"d{digits[-SIMILAR_DIGITS:]}")
    if (at := word.find("@")) >= 3:
        out.append(f"n{word[:at].lower()}")
    return out


@dataclass
class Graph:
    """Nodes in order of their start, and pairs of them."""

    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)  # -1: hidden
    word: list[str] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Words with a digit or an at sign outside of ``taken`` (in order), without marks around them.

    Neighbouring words of digits and their punctuation make one candidate as
    long as it stays a number of ``NUMBER_DIGITS`` digits.
    """
    out: list[tuple[int, int]] = []
    open_digits = 0  # digits of the last candidate if words may still be added to it
    i, at = 0, _MARK.search(text)
    while at:
        p = at.start()
        a = p
        while a > 0 and not _SPACE.match(text, a - 1):
            a -= 1
        z = word_end = _WORD_END.search(text, p).start()
        while a < z and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while z > a and not text[z - 1].isalnum():
            z -= 1
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if a < z and (i == len(taken) or taken[i][0] >= z):
            word = text[a:z]
            digits = len(_NOT_DIGIT.sub("", word))
            # A bracket that closes at the end of the word belongs to the number.
            part = bool(_NUMERIC.fullmatch(word)) and digits <= PART_DIGITS and word.count(".") < 3
            between = text[out[-1][1] : a] if out and part and open_digits else None
            if (
                between is not None
                and open_digits + digits <= NUMBER_DIGITS
                and 0 < len(between.lstrip(")")) <= GAP
                and not between.strip(") \t\n\v\f\r")
            ):
                out[-1] = (out[-1][0], z)
                open_digits += digits
            else:
                out.append((a, z))
                open_digits = digits if part else 0
        at = _MARK.search(text, max(word_end, p + 1))
    return out


def graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    """Nodes and links of a text.

    Skip links go from each occurrence to the next, and between each hidden one
    and an observed one if there is any: they grow with the text and not with
    its square.
    """
    nodes: list[tuple[int, int, int]] = []
    taken = -1
    for kind, a, z in sorted(base, key=lambda s: (s[1], -s[2])):
        if a >= taken:  # of overlapping spans the first stands for all
            nodes.append((a, z, kind))
            taken = z
    hidden = [(a, z, -1) for a, z in candidates(text, [(a, z) for a, z, _ in nodes])]
    g = Graph()
    last: dict[str, int] = {}
    seen: dict[str, int] = {}  # an observed node by key
    waiting: dict[str, list[int]] = {}  # hidden nodes by key before the first observed one
    pairs: set[tuple[int, int]] = set()
    for n, (a, z, kind) in enumerate(sorted(nodes + hidden)):
        word = text[a:z]
        g.start.append(a)
        g.end.append(z)
        g.kind.append(kind)
        g.word.append(word)
        if n and a - g.end[n - 1] <= NEAR:
            g.chain.append((n - 1, n))
        for key in links(word):
            if key in last:
                pairs.add((last[key], n))
            last[key] = n
            if kind >= 0:
                pairs.update((i, n) for i in waiting.pop(key, ()))
                seen[key] = n
            elif key in seen:
                pairs.add((seen[key], n))
            else:
                waiting.setdefault(key, []).append(n)
    g.skip.extend(sorted(pairs))
    return g


@dataclass(frozen=True)
class Potentials:
    """Logarithms of potentials: of features (one row each, the last for every node), of neighbours, of linked pairs."""

    own: np.ndarray
    chain: np.ndarray
    skip: float

    def of(self, word: str) -> np.ndarray:
        return self.own[_columns(features(word))].sum(axis=0)


def _columns(values: tuple[int, ...]) -> list[int]:
    """Rows of ``Potentials.own`` that a node with these features has."""
    out, first = [], 0
    for v, n in zip(values, VALUES):
        out.append(first + v)
        first += n
    return [*out, first]


def beliefs(own: np.ndarray, g: Graph, p: Potentials) -> np.ndarray:
    """Logarithms of the marginals by loopy message passing: exact where links make no loop."""
    pairs = np.array(g.chain + g.skip, np.int64).reshape(-1, 2)
    m = len(pairs)
    belief = own.copy()
    if m:
        pair = np.concatenate(
            (np.repeat(p.chain[None], len(g.chain), 0), np.repeat(np.eye(STATES)[None] * p.skip, len(g.skip), 0))
        )
        source = np.concatenate((pairs[:, 0], pairs[:, 1]))
        target = np.concatenate((pairs[:, 1], pairs[:, 0]))
        table_ = np.concatenate((pair, pair.transpose(0, 2, 1)))
        reverse = np.concatenate((np.arange(m, 2 * m), np.arange(m)))
        message = np.zeros((2 * m, STATES))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[reverse]
            new = np.logaddexp.reduce(out[:, :, None] + table_, axis=1)
            new -= np.logaddexp.reduce(new, axis=1)[:, None]
            change = np.abs(new - message).max()
            message = KEEP * message + (1 - KEEP) * new
            if change < STILL:
                break
        belief = own.copy()
        np.add.at(belief, target, message)
    return belief - np.logaddexp.reduce(belief, axis=1)[:, None]


def added_spans(g: Graph, p: Potentials) -> list[tuple[int, int, int]]:
    """Hidden nodes that message passing makes clear."""
    if all(k >= 0 for k in g.kind):
        return []
    own = np.zeros((len(g.kind), STATES))
    for i, k in enumerate(g.kind):
        if k >= 0:
            own[i] = -1e3
            own[i, k] = 0.0
        else:
            own[i] = p.of(g.word[i])
    belief = beliefs(own, g, p)
    out = []
    for i, k in enumerate(g.kind):
        best = int(belief[i, :OTHER].argmax())
        if k < 0 and belief[i, best] >= math.log(CLEAR):
            out.append((best, g.start[i], g.end[i]))
    return out


def _lessons(g: Graph):
    """What each node teaches: features, kinds of linked nodes (as bits), kinds before and after, its own kind.

    A hidden node linked to an observed one may be the same thing, so it
    teaches nothing, and is no one's neighbour.
    """
    n = len(g.kind)
    linked = [0] * n
    unsure = [False] * n
    for i, j in g.skip:
        if (g.kind[i] < 0) == (g.kind[j] < 0):
            linked[i] |= 1 << (g.kind[j] if g.kind[j] >= 0 else OTHER)
            linked[j] |= 1 << (g.kind[i] if g.kind[i] >= 0 else OTHER)
        else:
            unsure[i if g.kind[i] < 0 else j] = True
    kind = [k if k >= 0 else OTHER for k in g.kind]
    before, after = [STATES] * n, [STATES] * n  # STATES: nothing there
    for i, j in g.chain:
        if not unsure[i] and not unsure[j]:
            before[j], after[i] = kind[i], kind[j]
    for i in range(n):
        if not unsure[i]:
            yield (*features(g.word[i]), linked[i], before[i], after[i], kind[i])


def _observations(batches):
    """``lesson, n``: what nodes teach, counted in the task."""
    counts: dict[tuple[int, ...], int] = {}
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py() or ""
            if _MARK.search(text):
                for key in _lessons(graph(text, base_spans(text))):
                    counts[key] = counts.get(key, 0) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(map(list, counts)), pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())],
        names=["lesson", "n"],
    )


def fitted(lessons: np.ndarray, n: np.ndarray) -> Potentials:
    """Potentials of greatest pseudo-likelihood under a normal law around their means.

    Each lesson counts once with the features of its node and once, by
    ``HIDE``, without them.
    """
    rows = sum(VALUES) + 1
    own = np.zeros((rows, STATES))
    own[-1, :OTHER] = BIAS
    mean = {"own": own, "chain": np.zeros((STATES, STATES)), "skip": np.array(AGREE)}
    if not len(n):
        return Potentials(mean["own"], mean["chain"], float(mean["skip"]))
    k = len(VALUES)
    x = np.zeros((len(n), rows))
    for r, values in enumerate(lessons[:, :k]):
        x[r, _columns(tuple(values))] = 1.0
    bare = np.zeros_like(x)
    bare[:, -1] = 1.0
    x = np.concatenate((x, bare))
    linked, before, after, kind = (np.concatenate((c, c)) for c in lessons[:, k:].T)
    agree = (linked[:, None] >> np.arange(STATES)) & 1
    edge = np.eye(STATES + 1)[:, :STATES]  # no neighbour: a row of zeros
    before, after, truth = edge[before], edge[after], np.eye(STATES)[kind]
    weight = np.concatenate((n * (1 - HIDE), n * HIDE))[:, None]
    total = weight.sum()
    now = {c: v.copy() for c, v in mean.items()}
    first, second = ({c: np.zeros_like(v) for c, v in mean.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        score = x @ now["own"] + now["skip"] * agree + before @ now["chain"] + after @ now["chain"].T
        score -= np.logaddexp.reduce(score, axis=1)[:, None]
        miss = (truth - np.exp(score)) * weight
        slope = {"own": x.T @ miss, "chain": before.T @ miss + miss.T @ after, "skip": (agree * miss).sum()}
        for c in now:  # Adam
            d = (slope[c] - (now[c] - mean[c]) / VARIANCE) / total
            first[c] = 0.9 * first[c] + 0.1 * d
            second[c] = 0.999 * second[c] + 0.001 * d * d
            now[c] = now[c] + RATE * (first[c] / (1 - 0.9**step)) / (np.sqrt(second[c] / (1 - 0.999**step)) + 1e-8)
    return Potentials(now["own"], now["chain"], float(now["skip"]))


def learn(docs: DataFrame) -> Potentials:
    """Potentials from what the patterns find in all of ``docs``.

    The driver gets counts of distinct lessons, whose number the values of the
    features bound, whatever the number of documents.
    """
    small_batches(docs.sparkSession)
    rows = (
        docs.select("text")
        .mapInArrow(_observations, "lesson array<int>, n bigint")
        .groupBy("lesson")
        .agg(F.sum("n").alias("n"))
        .orderBy("lesson")
        .collect()
    )
    return fitted(np.array([r["lesson"] for r in rows], np.int64), np.array([r["n"] for r in rows], float))


def measured(docs: DataFrame, potentials: Potentials, one_in: int = 3) -> DataFrame:
    """``kind, hidden, found, wrong``: one in ``one_in`` spans of the patterns is hidden and sought by the field alone.

    ``found`` are spans given back with their kind and both ends; ``wrong`` are
    others that were added, outside of any span of a pattern as well.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        hidden, found, wrong = np.zeros(OTHER, int), np.zeros(OTHER, int), np.zeros(OTHER, int)
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                base = base_spans(text)
                away = {s for s in base if zlib.crc32(f"{s[1]}:{text[s[1] : s[2]]}".encode()) % one_in == 0}
                for s in away:
                    hidden[s[0]] += 1
                for s in added_spans(graph(text, [s for s in base if s not in away]), potentials):
                    (found if s in away else wrong)[s[0]] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(KINDS), pa.array(hidden), pa.array(found), pa.array(wrong)], names=["kind", "hidden", "found", "wrong"]
        )

    counted = docs.select("text").mapInArrow(run, "kind string, hidden bigint, found bigint, wrong bigint")
    return counted.groupBy("kind").agg(*(F.sum(c).alias(c) for c in ("hidden", "found", "wrong")))


def find(docs: DataFrame, potentials: Potentials) -> DataFrame:
    """``doc_id, base, added``: lists of ``kind, start, end`` (code points, end exclusive) for each row of ``docs``.

    Null is an empty text; other columns are ignored. ``base`` is ordered by
    kind, as in ``KINDS``, then start.
    """
    small_batches(docs.sparkSession)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            base, added = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                own = base_spans(text)
                base.append([{"kind": KINDS[k], "start": a, "end": z} for k, a, z in own])
                more = added_spans(graph(text, own), potentials) if _MARK.search(text) else []
                added.append([{"kind": KINDS[k], "start": a, "end": z} for k, a, z in sorted(more)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(added, span)], names=["doc_id", "base", "added"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    struct = "array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base {struct}, added {struct}")


def joined(spans):
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``find`` over all documents, as counts and digests; one row for each row, null texts as empty ones."""
    docs = table(spark, sf_dir, "documents")
    found = find(docs, learn(docs))

    def of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    place = F.transform(
        F.concat("base", "added"),
        lambda s: F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
        ),
    )
    return found.select(
        "doc_id",
        *map(of, KINDS),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.array_sort(place)).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )

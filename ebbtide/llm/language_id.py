"""Language identification with interpolated Kneser-Ney character models.

One model of ``ORDER`` characters for each language. All models share sorted
arrays of hashes, one for the n-grams and one for the contexts of each order;
beside each hash stand the probabilities (or back-off weights) in all
languages. A text gets the language with the lowest cross-entropy per
character, and is rejected if that is far above what texts of that language
have in a calibration set: beyond a cut that is set by the share of texts of
known languages that may be rejected by mistake.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.llm.texts import Rolling, mixed, small_batches
from ebbtide.session import work_dir

ORDER = 5
#: Labelled texts of each language that a model is fitted on at most, chosen by a hash of their number.
SAMPLE = 600
#: One in so many of them calibrates and is not fitted on.
CALIBRATE_ONE_IN = 5
#: Share of the texts of known languages that may be rejected by mistake. The cut is where the tail of the calibration
#: texts' deviations comes down to it.
FALSE_REJECTIONS = 1e-5
#: Share of the calibration texts that are the tail, and texts of one deviation each that are counted with it.
TAIL, TAIL_BEFORE = 0.1, 4.0
#: Calibration texts that what is known without any of them counts for.
LEAN = 2.0
#: Characters beyond which a text's cross-entropy is not trusted more.
FULL_TRUST = 400
UNKNOWN = "und"
#: Characters that are looked at together, unless one text has more.
TEXT_AT_ONCE = 1 << 19

_PAD = "\x00" * (ORDER - 1)


@cache
def _letters() -> np.ndarray:
    """By code point: is it a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def normalized(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts in lower case, with runs of other characters as one space, and each text's end.

    Every text begins with ``ORDER - 1`` spaces.
    """
    lowered = [_PAD + t.lower() for t in texts]
    ends = np.cumsum([len(t) for t in lowered])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    keep = letter | (points == 0)
    keep[1:] |= letter[:-1]
    kept = np.where(letter, points, np.uint32(32))[keep]
    return kept, np.cumsum(keep)[ends - 1] if len(ends) else ends


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    roll = Rolling(0)
    return mixed(roll.every(roll.prefix(mixed(points.astype(np.uint64) + np.uint64(1))), n))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    grams: list[np.ndarray]  # by order, from 1: sorted hashes
    probabilities: list[np.ndarray]  # beside them, a column for each language; 0 where it lacks the n-gram
    contexts: list[np.ndarray]
    weights: list[np.ndarray]  # 1 where the language lacks the context
    usual: np.ndarray | None = None  # cross-entropy of calibration texts, by language
    spread: np.ndarray | None = None
    cut: float = np.inf  # deviations from which a text is rejected

    def log_probabilities(self, points: np.ndarray) -> np.ndarray:
        """Of the last character of each row of code points after those before it; a column for each language."""
        p = np.full((len(points), len(self.languages)), 1.0 / 0x10000)
        for n in range(1, ORDER + 1):
            own = _rows_hash(points[:, ORDER - n :])
            seen, at = _find(self.grams[n - 1], own)
            known = np.where(seen[:, None], self.probabilities[n - 1][at], 0.0)
            seen, at = _find(self.contexts[n - 1], _rows_hash(points[:, ORDER - n : -1]))
            back = np.where(seen[:, None], self.weights[n - 1][at], 1.0)
            p = np.where(known > 0, known, back * p)
        return np.log(p)

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per character in each language, characters, and whether there is any letter."""
        points, ends = normalized(texts)
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        sums = np.zeros((len(texts), len(self.languages)))
        hashes = gram_hashes(points, ORDER)
        step = 1 << 20
        for a in range(0, len(hashes), step):
            part = hashes[a : a + step]
            codes, unique = pd.factorize(part)
            first = np.zeros(len(unique), np.int64)
            first[codes[::-1]] = np.arange(len(part) - 1, -1, -1)
            rows = points[(first + a)[:, None] + np.arange(ORDER)[None, :]]
            table = self.log_probabilities(rows)
            last = np.arange(a, a + len(part)) + ORDER - 1  # the character that a gram predicts
            doc = np.searchsorted(ends, last, side="right")
            own = last - starts[doc] >= ORDER - 1
            for j in range(len(self.languages)):
                sums[:, j] += np.bincount(doc[own], weights=table[codes[own], j], minlength=len(texts))
        n = ends - starts - (ORDER - 1)
        letters = np.add.reduceat(np.concatenate(((points != 32), [False])), starts) > 0 if len(texts) else n > 0
        return -sums / np.maximum(n, 1)[:, None], n, letters


def _rows_hash(rows: np.ndarray) -> np.ndarray:
    h = np.full(len(rows), rows.shape[1] + 1, np.uint64)
    for j in range(rows.shape[1]):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j].astype(np.uint64) + np.uint64(1))
    return h


def _find(sorted_hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_hashes, wanted), len(sorted_hashes) - 1)
    return sorted_hashes[at] == wanted, at


def _kneser_ney(rows: np.ndarray, counts: np.ndarray):
    """Interpolated probabilities and back-off weights by order of one language, from counts of its longest n-grams.

    Lower orders count in how many places an n-gram continues a text.
    """
    by_order = {ORDER: (rows, counts.astype(float))}
    for n in range(ORDER - 1, 0, -1):
        shorter, times = np.unique(by_order[n + 1][0][:, 1:], axis=0, return_counts=True)
        by_order[n] = (shorter, times.astype(float))
    grams, weights, previous = [], [], None
    for n in range(1, ORDER + 1):
        r, c = by_order[n]
        ones, twos = (c == 1).sum(), (c == 2).sum()
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))
        context, inverse = np.unique(_rows_hash(r[:, :-1]), return_inverse=True)
        total = np.bincount(inverse, weights=c)
        kinds = np.bincount(inverse)
        weight = discount * kinds / total
        if n == 1:
            lower = np.full(len(r), 1.0 / 0x10000)
        else:
            seen, at = _find(previous[0], _rows_hash(r[:, 1:]))
            lower = np.where(seen, previous[1][at], 1.0 / 0x10000)
        p = np.maximum(c - discount, 0) / total[inverse] + weight[inverse] * lower
        own = _rows_hash(r)
        order = np.argsort(own)
        previous = (own[order], p[order])
        grams.append(previous)
        weights.append((context, weight))
    return grams, weights


def _beside(parts: list[tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.unique(np.concatenate([h for h, _ in parts]))
    values = np.full((len(hashes), len(parts)), missing)
    for j, (h, v) in enumerate(parts):
        values[np.searchsorted(hashes, h), j] = v
    return hashes, values


def held_out(doc_id: Column) -> Column:
    """Is a document kept from training: by the checksum of its number, as text (null as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, per_language: int) -> DataFrame:
    """``lang, text, calibrates``: at most ``per_language`` labelled texts of each language, whole, as a table.

    They are those of the least draws, by a hash of ``doc_id``. A row whose draw is beyond four times the share that
    its language needs is left out at once, so a language brings few rows to the task that orders them.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "language-sample")
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    usable = usable.select("lang", "doc_id", "text", F.xxhash64(F.lit(17), "doc_id").alias("draw"))
    usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/languages")
    share = spark.read.parquet(f"{path}/languages").select("lang", (F.lit(4.0 * per_language) / F.col("n")).alias("share"))
    first = Window.partitionBy("lang").orderBy("draw", "doc_id")
    (
        usable.select("lang", "doc_id", "draw")
        .join(share, "lang")
        .where(F.col("draw") / F.lit(float(1 << 64)) + 0.5 <= F.col("share"))
        .select("lang", "doc_id", "draw")
        .distinct()
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= per_language)
        .select("lang", "doc_id")
        .write.parquet(f"{path}/chosen")
    )
    # A table of known size: Catalyst broadcasts it if it is small. Repeated rows are cut once more.
    again = Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text"))
    (
        usable.join(spark.read.parquet(f"{path}/chosen"), ["lang", "doc_id"])
        .withColumn("place", F.row_number().over(again))
        .where(F.col("place") <= per_language)
        .select("lang", "text", (F.col("place") % CALIBRATE_ONE_IN == 0).alias("calibrates"))
        .write.parquet(f"{path}/texts")
    )
    return spark.read.parquet(f"{path}/texts")


def _count_grams(batches):
    """Counts of n-grams by language, summed in the task."""
    counts: dict[tuple[str, str], int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            points, _ = normalized([text])
            joined = points.tobytes().decode("utf-32-le", "surrogatepass")
            for i in range(len(joined) - ORDER + 1):
                key = (lang, joined[i : i + ORDER])
                counts[key] = counts.get(key, 0) + 1
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in counts], pa.string()),
            pa.array([k[1] for k in counts], pa.string()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        names=["lang", "gram", "c"],
    )


def _characters(counted: pd.DataFrame) -> tuple[float, float]:
    """Entropy of the single characters that n-grams with counts end in, and the variance of their code lengths."""
    share = counted.groupby(counted["gram"].str[-1])["c"].sum().to_numpy().astype(float)
    share /= share.sum()
    bits = -np.log(share)
    entropy = float((share * bits).sum())
    return entropy, float((share * bits**2).sum()) - entropy**2


def _calibrated(
    languages: list[str], checked: pd.DataFrame, characters: list[tuple[float, float]]
) -> tuple[np.ndarray, np.ndarray, float]:
    """Usual cross-entropy of each language, the deviation from it of a text of one character, and the cut.

    ``checked`` has ``lang_pred, own, cross_entropy, n_chars`` of the calibration texts. A language leans, the more the
    fewer texts of its own it has, on the entropy of its single characters, which a small model comes to at worst, and
    on the deviation of the texts of all languages. The cut is set on all calibration texts, whatever their label: its
    tail is taken as exponential beyond the largest tenth, down to a share of ``FALSE_REJECTIONS``.
    """
    trust = np.minimum(checked["n_chars"].to_numpy(float), FULL_TRUST)
    entropy = checked["cross_entropy"].to_numpy(float)
    chosen = np.searchsorted(languages, checked["lang_pred"].to_numpy(str)) if len(checked) else np.zeros(0, np.int64)
    k = len(languages)
    own = checked["own"].to_numpy(bool)
    n = np.bincount(chosen[own], minlength=k).astype(float)
    mean = np.bincount(chosen[own], trust[own] * entropy[own], k) / np.maximum(1, np.bincount(chosen[own], trust[own], k))
    plain, plain_variance = (np.array([c[i] for c in characters]) for i in (0, 1))
    usual = (n * mean + LEAN * plain) / (n + LEAN)
    squares = np.bincount(chosen[own], trust[own] * (entropy[own] - mean[chosen[own]]) ** 2, k)
    of_all = (squares.sum() + LEAN * plain_variance) / (np.maximum(0, n - 1).sum() + LEAN)
    spread = np.maximum(0.05, np.sqrt((squares + LEAN * of_all) / (np.maximum(0, n - 1) + LEAN)))

    far = np.sort((entropy - usual[chosen]) * np.sqrt(trust) / spread[chosen])[::-1]
    tail = int(np.ceil(len(far) * TAIL))
    start = max(0.0, far[tail]) if len(far) > tail else 0.0
    slope = (np.maximum(0, far[:tail] - start).sum() + TAIL_BEFORE) / (tail + TAIL_BEFORE)
    share = tail / len(far) if len(far) else 1.0
    return usual, spread, float(start + slope * np.log(share / FALSE_REJECTIONS))


def fit(docs: DataFrame, per_language: int = SAMPLE) -> Model | None:
    """Models of the languages in ``docs`` (``doc_id, text, lang``); None if no text has a language.

    What comes to the driver are n-grams of the bounded sample.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = labelled_sample(docs, per_language)
    counted = (
        sample.where("NOT calibrates")
        .select("lang", "text")
        .mapInArrow(_count_grams, "lang string, gram string, c bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("c").alias("c"))
        .toPandas()
    )
    if not len(counted):
        return None
    languages = sorted(counted["lang"].unique())
    grams, weights = [], []
    for lang in languages:
        own = counted[counted["lang"] == lang]
        points = np.frombuffer("".join(own["gram"]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
        g, w = _kneser_ney(points, own["c"].to_numpy())
        grams.append(g)
        weights.append(w)
    by_order = [_beside([g[n] for g in grams], 0.0) for n in range(ORDER)]
    by_context = [_beside([w[n] for w in weights], 1.0) for n in range(ORDER)]
    model = Model(
        languages, [h for h, _ in by_order], [v for _, v in by_order], [h for h, _ in by_context], [v for _, v in by_context]
    )
    # The label goes along as the number, so that texts of other languages can be told from a language's own.
    checked = predict(sample.where("calibrates").withColumn("doc_id", F.col("lang")), model)
    # Four numbers of each calibration text, which are as bounded as the sample is.
    texts = checked.where("n_chars > 0").select(
        "lang_pred", (F.col("doc_id") == F.col("lang_pred")).alias("own"), "cross_entropy", "n_chars"
    )
    characters = [_characters(counted[counted["lang"] == lang]) for lang in languages]
    limits = _calibrated(languages, texts.toPandas(), characters)
    return Model(languages, model.grams, model.probabilities, model.contexts, model.weights, *limits)


def _judged(model: Model | None, column: pa.Array) -> list[tuple]:
    """Language, score, cross-entropy, characters and rejection of each text of a column."""
    texts = [t or "" for t in column.to_pylist()]
    nothing = (UNKNOWN, 0.0, None, 0, True)
    if model is None:
        return [nothing] * len(texts)
    out, i = [], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= TEXT_AT_ONCE):
            size += len(texts[j])
            j += 1
        entropy, n, letters = model.cross_entropies(texts[i:j])
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(j - i), best]
        share = 1 / np.exp(-(entropy - low[:, None]) * np.minimum(n, 50)[:, None]).sum(axis=1)
        if model.usual is None:
            odd = np.zeros(j - i, bool)
        else:
            odd = (low - model.usual[best]) * np.sqrt(np.minimum(n, FULL_TRUST)) > model.cut * model.spread[best]
        for r in range(j - i):
            if letters[r]:
                out.append((model.languages[best[r]], float(share[r]), float(low[r]), int(n[r]), bool(odd[r])))
            else:
                out.append(nothing)
        i = j
    return out


def recognised(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns.

    Without a model, as where no row has a label to learn from, nothing is known of languages and every text with a
    letter stays. Null texts and those without letters go either way.
    """
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            out = _judged(shared.value, batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array([not o[4] for o in out], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, n_chars, rejected`` for each row of ``docs`` (others ignored).

    The language is ``und``, with score 0 and rejected, if the text is null or
    has no letter, or nothing was learned. ``score`` is the share of the chosen
    language among all, by likelihood of up to 50 characters. ``rejected`` marks
    texts unlike any that were learned.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            out = _judged(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(
                        pa.array([o[k] for o in out], kind)
                        for k, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()))
                    ),
                ],
                names=["doc_id", "lang_pred", "score", "cross_entropy", "n_chars", "rejected"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, lang_pred string, score double, cross_entropy double, n_chars bigint, rejected boolean",
    )


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from ebbtide.llm import language_id as L

from .fixtures import empty, odd_rows, table

SYLLABLES = {"en": ["the", "ing", "and", "tion", "er"], "fr": ["eau", "eux", "ent", "éré", "que"], "de": ["ung", "sch", "ein", "ich", "äte"]}


def corpus(n=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    return rows


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = table(spark, rows)
    got = {r["doc_id"]: r for r in L.predict(docs, L.fit(docs)).collect()}
    tested = [(i, lang) for i, _, lang in rows if held(i)]
    assert tested and all(got[i]["lang_pred"] == lang for i, lang in tested)
    assert not any(r["rejected"] for r in got.values())
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_rejects_what_is_unlike_all(spark):
    rows = corpus(700)
    docs = table(spark, rows)
    odd = table(spark, [(1000, "zxq jkv wqpzx kjqx vbnx " * 20, None), (1001, "Theand ertion", None), (1002, "12 !? 34", "en")])
    got = {r["doc_id"]: r for r in L.predict(odd, L.fit(docs)).collect()}
    assert got[1000]["rejected"] and not got[1001]["rejected"]
    assert got[1002]["lang_pred"] == "und" and got[1002]["score"] == 0
    kept = L.recognised(odd, L.fit(docs))
    assert kept.columns == odd.columns and [r["doc_id"] for r in kept.collect()] == [1001]


CYRILLIC = "вот это письмо никто здесь никогда раньше не читал "


def test_rejects_with_few_calibration_texts(spark):
    """Languages of some texts, of one text, and texts that are unlike both."""
    rng = random.Random(8)
    rare = [" ".join("".join(rng.choice(["oka", "umi", "zet"]) for _ in range(3)) for _ in range(40)) for _ in range(6)]
    rows = corpus(240) + [(i, t, "xx") for i, t in zip((5000, 5002, 5003), rare)] + [(6001, "ok", "typo")]
    assert not any(held(i) for i in (5000, 5002, 5003, 6001))
    odd = [(i, CYRILLIC * n, None) for i, n in enumerate((1, 2, 10, 40))]
    asked = table(spark, odd + [(100 + i, t, None) for i, t in enumerate(rare)] + [(200, "Theand ertion", None)])
    model = L.fit(table(spark, rows))
    assert np.isfinite(model.spread).all()
    got = {r["doc_id"]: r["rejected"] for r in L.predict(asked, model).collect()}
    assert [i for i, rejected in sorted(got.items()) if rejected] == [i for i, _, _ in odd]


def test_label_of_a_text_is_never_used(spark):
    rows = corpus(120)
    model = L.fit(table(spark, rows))
    swapped = [(i + 5000, t, "xx") for i, t, _ in rows]
    a = [r["lang_pred"] for r in L.predict(table(spark, rows).coalesce(1), model).collect()]
    b = [r["lang_pred"] for r in L.predict(table(spark, swapped).coalesce(1), model).collect()]
    assert a == b


def test_kneser_ney_sums_to_one():
    points = np.array([[97, 98, 97, 98, 99], [97, 98, 97, 98, 97], [98, 97, 98, 97, 98], [99, 97, 98, 97, 98]], np.uint32)
    grams, weights = L._kneser_ney(points, np.array([3, 2, 4, 1]))
    model = L.Model(["x"], *_model(grams, weights))
    every = np.array([[97, 98, 97, 98, c] for c in range(0x10000)], np.uint32)
    assert np.exp(model.log_probabilities(every)).sum() == pytest.approx(1, abs=1e-3)


def plain_kneser_ney(texts):
    """Interpolated Kneser-Ney written down from its definition, as a function of a context and a character."""
    counts = {n: Counter() for n in range(1, L.ORDER + 1)}
    for text in texts:
        for i in range(len(text) - L.ORDER + 1):
            counts[L.ORDER][text[i : i + L.ORDER]] += 1
    for n in range(L.ORDER - 1, 0, -1):
        for gram in counts[n + 1]:
            counts[n][gram[1:]] += 1
    discounts = {}
    for n, c in counts.items():
        ones, twos = (sum(v == k for v in c.values()) for k in (1, 2))
        discounts[n] = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))

    def p(context, character, n=L.ORDER):
        if n == 0:
            return 1 / 0x10000
        context = context[len(context) - n + 1 :]
        follow = {g[-1]: v for g, v in counts[n].items() if g[:-1] == context}
        if not follow:
            return p(context[1:], character, n - 1)
        total, d = sum(follow.values()), discounts[n]
        return max(follow.get(character, 0) - d, 0) / total + d * len(follow) / total * p(context[1:], character, n - 1)

    return p


def test_cross_entropy_is_that_of_plain_kneser_ney(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(SYLLABLES[lang]) + rng.choice(SYLLABLES[lang]) for _ in range(6)) for lang in SYLLABLES for _ in range(8)]
    langs = [lang for lang in SYLLABLES for _ in range(8)]
    ids = [i for i in range(200) if not held(i)][: len(texts)]
    docs = table(spark, list(zip(ids, texts, langs)))
    learned = L.labelled_sample(docs, 100).where("NOT calibrates").collect()
    model = L.fit(docs, 100)
    asked = ["theing éré", "schein und nichts", "q", "Eau-de-vie 12 thE"]
    entropy, n, _ = model.cross_entropies(asked)

    def prepared(text):
        points, _ = L.normalized([text])
        return "".join(map(chr, points))

    for j, lang in enumerate(model.languages):
        p = plain_kneser_ney([prepared(r["text"]) for r in learned if r["lang"] == lang])
        for i, text in enumerate(map(prepared, asked)):
            logs = [np.log(p(text[a - L.ORDER + 1 : a], text[a])) for a in range(L.ORDER - 1, len(text))]
            assert len(logs) == n[i] and entropy[i, j] == pytest.approx(-np.mean(logs), rel=1e-9)


def _checked(far, lang="a"):
    """Calibration texts of 100 characters whose cross-entropy is 2 and ``far`` deviations of a hundredth."""
    return pd.DataFrame({"lang_pred": lang, "own": True, "cross_entropy": 2 + np.asarray(far, float) / 100, "n_chars": 100})


def test_cut_follows_the_rate_of_false_rejections():
    rng = np.random.default_rng(1)
    calibration, others = (rng.normal(size=n) for n in (2000, 200_000))
    cuts = []
    for rate in (1e-2, 1e-3, 1e-4):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(L, "FALSE_REJECTIONS", rate)
            usual, spread, cut = L._calibrated(["a"], _checked(calibration), [(2.0, 0.01)])
        rejected = ((2 + others / 100 - usual[0]) * 10 > cut * spread[0]).mean()
        cuts.append(cut)
        assert rejected <= rate
    assert cuts == sorted(cuts) and np.isfinite(cuts).all()


def test_calibration_has_no_threshold_of_texts():
    """One more calibration text moves limits a little, at every number of them; none at all gives limits too."""
    rng = np.random.default_rng(2)
    far = rng.normal(size=40)
    limits = [L._calibrated(["a", "b"], _checked(far[:n]), [(2.5, 0.3), (2.6, 0.4)]) for n in range(41)]
    assert all(np.isfinite(u).all() and np.isfinite(s).all() and np.isfinite(c) for u, s, c in limits)
    usual = [u[0] for u, _, _ in limits]
    steps = np.abs(np.diff(usual))
    assert usual[0] == 2.5 and steps[10:].max() < 0.02 and abs(usual[40] - 2) < 0.05
    assert all(u[1] == 2.6 for u, _, _ in limits)


def _model(grams, weights):
    a = [L._beside([g], 0.0) for g in grams]
    b = [L._beside([w], 1.0) for w in weights]
    return [h for h, _ in a], [v for _, v in a], [h for h, _ in b], [v for _, v in b]


def test_odd_rows(spark):
    docs = table(spark, odd_rows())
    got = L.predict(docs, L.fit(docs)).collect()
    assert len(got) == len(odd_rows())
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in got if r["doc_id"] in (1, 2, 3))
    nothing = empty(spark)
    assert L.fit(nothing) is None
    assert L.predict(nothing, None).collect() == []
    assert {r["lang_pred"] for r in L.predict(docs, None).collect()} == {"und"}


def test_sample_is_bounded(spark):
    rows = [(i, f"text number {i}", "en") for i in range(60)] + [(7, f"again {i}", "en") for i in range(60)]
    assert L.labelled_sample(table(spark, rows), 10).count() == 10


def test_sample_is_that_of_the_least_draws(spark):
    """Though only rows below a threshold are ordered: 4,000 rows of a language, a third of them one repeated row."""
    from pyspark.sql import functions as F

    rows = [(i, f"text number {i}", "en") for i in range(3000)] + [(None, "the same", "en")] * 1500 + [(9001, "rar", "xx")]
    assert not held(9001)
    docs = table(spark, rows)
    got = {r["text"] for r in L.labelled_sample(docs, 20).where("lang = 'en'").collect()}
    draws = docs.where("lang = 'en'").where(~L.held_out(F.col("doc_id"))).select("text", F.xxhash64(F.lit(17), "doc_id").alias("draw"))
    want = [r["text"] for r in draws.distinct().orderBy("draw").limit(20).collect()]
    assert got <= set(want) and len(got) == (20 if "the same" not in want else want.index("the same") + 1)
    assert L.labelled_sample(docs, 20).where("lang = 'xx'").count() == 1


def test_identifiers_as_text(spark):
    docs = spark.createDataFrame([(f"d{i}", t, lang) for i, t, lang in corpus(90)], "doc_id string, text string, lang string")
    got = L.predict(docs, L.fit(docs)).collect()
    assert {r["doc_id"] for r in got} == {f"d{i}" for i in range(90)}

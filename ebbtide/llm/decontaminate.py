"""Benchmark decontamination by templates, with DataFrame functions only.

Texts become templates: numbers, names and units turn into typed placeholders.
Windows of ``WINDOW`` template tokens of documents are joined with those of
benchmark items by hash. Where enough of an item is found, the placeholders
are filled again: an item's value must stand for one value of the document
throughout an occurrence, so a question with other numbers or names is found
and a chance likeness is not.

Matches at one distance between document and item are an occurrence, and so
are those at neighbouring distances, where tokens came in or went, and all of
them together. An item is found if any occurrence passes, so that several
copies with different values do not speak against each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.llm.texts import identified
from ebbtide.session import work_dir

#: Template tokens of a window, and those among them that are no placeholder.
WINDOW = 8
LITERALS = 5
#: An item is leaked if so many of its tokens are found, or this share of them.
FOUND_TOKENS = 13
FOUND_SHARE = 0.5
#: Share of an item's slot values that may stand for several values of the document.
CONFLICTS = 0.2

TOKEN = r"[0-9]+(?:[.,][0-9]+)*|\p{L}+"
NUMBER, NAME, UNIT = "#", "@", "%"
#: How a window is compared: as a template, or by its own words.
TEMPLATE, RAW = "template", "raw"
#: Tokens of the shortest item that is compared as a template, and its literals. Shorter ones are found as whole documents.
SHORTEST = 4
SHORT_LITERALS = 3
#: Distances between document and item that differ by so much are one occurrence with tokens put in or left out.
NEAR = 3
UNITS = (
    "km kg cm mm mg ml lb lbs oz mi ft mph kmh hz khz mhz ghz kb mb gb tb kw kwh gram grams meter meters metre metres "
    "mile miles inch inches foot feet yard yards pound pounds ounce ounces liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent "
    "cents percent degree degrees"
).split()


def template(token: Column) -> Column:
    """The typed placeholder of a token, or the token in lower case."""
    low, rest = F.lower(token), F.substring(token, 2, 1 << 30)
    return (
        F.when(token < F.lit(":"), F.lit(NUMBER))
        .when(low.isin(UNITS), F.lit(UNIT))
        .when((token != low) & (F.length(token) > 1) & (rest == F.lower(rest)), F.lit(NAME))
        .otherwise(low)
    )


def raw_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once for the row, not again in every inner call."""
    return F.element_at(F.transform(F.array(value), body), 1)


def windows(tokens: Column, mode: str = TEMPLATE, width: int = WINDOW) -> Column:
    """A hash for each window of ``width`` tokens, as templates or ``RAW`` in lower case; none for fewer tokens."""

    def hashed(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(h) - F.lit(width - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.lit(f"{mode}{width}"), F.slice(h, i, width)))
        return F.when(F.size(h) >= width, hashes).otherwise(F.array().cast("array<bigint>"))

    return bound(F.transform(tokens, lambda t: F.xxhash64(template(t) if mode == TEMPLATE else F.lower(t))), hashed)


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id, mode, width, at, h``: the windows by which each item (``item_id, tokens``) is looked for.

    Template windows with enough literals. An item shorter than a window is one window by itself, with
    ``SHORT_LITERALS`` of them; an item without any such window is looked for by its own words, all windows of it.
    """
    size = F.size("tokens")
    width = F.least(size, F.lit(WINDOW))
    enough = F.when(size < WINDOW, SHORT_LITERALS).otherwise(LITERALS)
    token = F.transform(
        "tokens",
        lambda t: F.struct(
            F.xxhash64(template(t)).alias(TEMPLATE), F.xxhash64(F.lower(t)).alias(RAW), (~template(t).isin(NUMBER, NAME, UNIT)).alias("literal")
        ),
    )

    def window(held: Column, i: Column) -> Column:
        part = F.slice(held, i, width)
        return F.struct(
            (i - F.lit(1)).alias("at"),
            ((F.size(F.filter(part, lambda t: t["literal"])) >= enough) & (width >= SHORTEST)).alias("rich"),
            *[F.xxhash64(F.concat(F.lit(m), width.cast("string")), part[m]).alias(m) for m in (TEMPLATE, RAW)],
        )

    every = bound(token, lambda held: F.transform(F.sequence(F.lit(1), size - width + F.lit(1)), lambda i: window(held, i)))
    whole = items.select("item_id", width.alias("width"), every.alias("windows"))
    # by item: one of several texts under one number may have such windows
    rich = F.max(F.exists("windows", lambda w: w["rich"])).over(Window.partitionBy("item_id"))
    each = whole.withColumn("any_rich", rich).select("item_id", "width", "any_rich", F.explode("windows").alias("w"))
    mode = F.when(F.col("w.rich"), TEMPLATE).when(~F.col("any_rich"), RAW)
    return each.withColumn("mode", mode).where("mode IS NOT NULL").select(
        "item_id", "mode", "width", "w.at", F.when(F.col("mode") == TEMPLATE, F.col(f"w.{TEMPLATE}")).otherwise(F.col(f"w.{RAW}")).alias("h")
    )


def occurrences(met: DataFrame) -> DataFrame:
    """``met`` (``uid, item_id, shift, ...``) with the occurrence ``g`` that a row belongs to: each shift, runs of neighbouring ones, all."""
    pair = Window.partitionBy("uid", "item_id")
    by_shift = pair.orderBy("shift")
    apart = F.coalesce(F.col("shift") - F.lag("shift").over(by_shift) > NEAR, F.lit(True))
    runs = met.withColumn("_apart", apart.cast("int")).withColumn("_run", F.sum("_apart").over(by_shift)).withColumn("_n", F.count(F.lit(1)).over(pair))
    single = F.concat(F.lit("s"), F.col("shift").cast("string"))
    groups = F.when(F.col("_n") == 1, F.array(single)).otherwise(F.array(single, F.concat(F.lit("r"), F.col("_run").cast("string")), F.lit("a")))
    return runs.withColumn("g", F.explode(groups)).drop("_apart", "_run", "_n")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_found, n_tokens, n_slots, n_values, n_conflicts, text_hash``: which items a document holds.

    One row for each document (``doc_id``, ``text``) and item (``item_id``,
    ``text``) with an occurrence in which ``FOUND_TOKENS`` tokens or ``FOUND_SHARE`` of all are
    found and whose ``n_values`` slot values agree but for ``CONFLICTS`` of
    them; the counts are those of the occurrence with most tokens. ``text_hash`` is ``xxhash64`` of the document's text.

    Items shorter than a window are found whole, as templates if they have ``SHORTEST`` tokens and ``SHORT_LITERALS``
    literals, else by their own words; items of fewer tokens than ``SHORTEST`` only where a document has no other.
    Items in which no window has ``LITERALS`` literals are found by their own words. Texts without tokens hold nothing and are found nowhere. Rows with equal ``doc_id`` and text
    are one document; repeated items count once. Other columns are not read.
    """
    spark = docs.sparkSession
    root = work_dir(spark, "decontaminate")
    keyed = identified(docs, "decontaminate-docs").select("uid", "doc_id", "text")
    items = benchmark.select("item_id", raw_tokens(F.col("text")).alias("tokens")).where(F.size("tokens") > 0).distinct()
    item_windows(items).write.parquet(f"{root}/windows")
    of_items = spark.read.parquet(f"{root}/windows")
    # at most two for each width
    kinds = [(r["mode"], r["width"]) for r in of_items.select("mode", "width").distinct().collect()]
    lengths = items.groupBy("item_id").agg(F.max(F.size("tokens")).alias("n_tokens"))

    def of_docs(mode: str, width: int) -> DataFrame:
        of_kind = of_items.where((F.col("mode") == mode) & (F.col("width") == width))
        tokens = raw_tokens(F.col("text"))
        if width < SHORTEST:
            whole = F.when(F.size(tokens) == width, windows(tokens, mode, width))
            return keyed.select("uid", F.posexplode(whole).alias("pos", "h")).join(of_kind, "h")
        return keyed.select("uid", F.posexplode(windows(tokens, mode, width)).alias("pos", "h")).join(of_kind, "h")

    # Items that share a window are kept apart; a window is met at the same distance all along a copy.
    found = [of_docs(*kind).select("uid", "item_id", "pos", "at", "width") for kind in kinds]
    if not found:
        found = [keyed.where("false").select("uid", *[F.lit(0).alias(c) for c in ("pos", "at", "width")]).join(items.select("item_id").limit(0))]
    (
        reduce(DataFrame.unionByName, found)
        .groupBy("uid", "item_id", (F.col("pos") - F.col("at")).alias("shift"), "width")
        .agg(F.sort_array(F.collect_set("at")).alias("starts"))
        .write.parquet(f"{root}/met")
    )
    met = spark.read.parquet(f"{root}/met")
    # Places of an item stay lists until documents are few: a list is as long as the item at most.
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("width") - F.lit(1)))))
    all_places = F.array_distinct(F.flatten(F.transform("parts", lambda p: p["places"])))
    enough = (
        occurrences(met.select("uid", "item_id", "shift", covered.alias("places")))
        .groupBy("uid", "item_id", "g")
        .agg(F.collect_list(F.struct("shift", "places")).alias("parts"))
        .withColumn("n_found", F.size(all_places).cast("bigint"))
        .join(lengths, "item_id")
        .where((F.col("n_found") >= FOUND_TOKENS) | (F.col("n_found") >= F.col("n_tokens") * FOUND_SHARE))
    )

    # What stands in the slots: of candidates only.
    def filled(tokens: Column) -> Column:
        def of_part(held: Column, part: Column) -> Column:
            return F.transform(
                part["places"],
                lambda at: F.struct(
                    *(held[c].alias(c) for c in ("item_id", "g", "n_found", "n_tokens")),
                    at.alias("place"),
                    F.element_at(tokens, at + part["shift"] + 1).alias("theirs"),
                ),
            )

        return F.flatten(F.transform("held", lambda h: F.flatten(F.transform(h["parts"], lambda p: of_part(h, p)))))

    in_docs = (
        enough.groupBy("uid")
        .agg(F.collect_list(F.struct("item_id", "g", "n_found", "n_tokens", "parts")).alias("held"))
        .join(keyed, "uid")
        .select("doc_id", "uid", F.xxhash64("text").alias("text_hash"), F.explode(bound(raw_tokens(F.col("text")), filled)).alias("p"))
        .select("doc_id", "uid", "text_hash", "p.*")
    )
    in_items = items.select("item_id", F.posexplode("tokens").alias("place", "ours"))
    slot = template(F.col("ours")).isin(NUMBER, NAME, UNIT)
    values = (
        in_docs.join(in_items, ["item_id", "place"])
        .groupBy("uid", "doc_id", "text_hash", "item_id", "g", "n_found", "n_tokens", F.when(slot, F.lower("ours")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.lower("theirs")).alias("kinds"))
    )
    has_value = F.col("value").isNotNull()
    judged = (
        values.groupBy("uid", "doc_id", "text_hash", "item_id", "g", "n_found", "n_tokens")
        .agg(
            F.sum(F.when(has_value, F.col("n")).otherwise(0)).alias("n_slots"),
            F.count("value").alias("n_values"),
            F.sum((has_value & (F.col("kinds") > 1)).cast("bigint")).alias("n_conflicts"),
        )
        .where(F.col("n_conflicts") <= F.col("n_values") * CONFLICTS)
    )
    best = F.min(F.struct((-F.col("n_found")).alias("f"), "n_conflicts", (-F.col("n_values")).alias("v"), (-F.col("n_slots")).alias("s"))).alias("b")
    return (
        judged.groupBy("uid", "doc_id", "text_hash", "item_id", "n_tokens")
        .agg(best)
        .select(
            "doc_id", "item_id", (-F.col("b.f")).alias("n_found"), "n_tokens", (-F.col("b.s")).alias("n_slots"),
            (-F.col("b.v")).alias("n_values"), F.col("b.n_conflicts").alias("n_conflicts"), "text_hash",
        )
    )


_UNITS_SQL = ", ".join(f"'{u}'" for u in UNITS)
_TEMPLATE_SQL = f"""list_transform(ts, lambda t: CASE WHEN t < ':' THEN '#' WHEN lower(t) IN ({_UNITS_SQL}) THEN '%'
    WHEN t <> lower(t) AND length(t) > 1 AND substr(t, 2) = lower(substr(t, 2)) THEN '@' ELSE lower(t) END)"""
SQL = rf"""
WITH dt AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS ts FROM documents),
bt AS (SELECT item_id, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS ts FROM benchmark),
d AS (SELECT doc_id, ts, {_TEMPLATE_SQL} AS cs, list_transform(ts, lambda t: lower(t)) AS ls FROM dt),
b AS (SELECT DISTINCT item_id, ts, {_TEMPLATE_SQL} AS cs, list_transform(ts, lambda t: lower(t)) AS ls,
             least(len(ts), {WINDOW}) AS width FROM bt WHERE len(ts) > 0),
bp AS (SELECT *, unnest(range(1, len(cs) - width + 2)) AS p FROM b),
bl AS (SELECT *, len(list_filter(cs[p:p + width - 1], lambda c: c NOT IN ('#', '@', '%')))
         >= CASE WHEN width = {WINDOW} THEN {LITERALS} ELSE {SHORT_LITERALS} END AND width >= {SHORTEST} AS rich FROM bp),
bw AS (SELECT item_id, 't' AS mode, width, p, array_to_string(cs[p:p + width - 1], ' ') AS w FROM bl WHERE rich
       UNION ALL SELECT item_id, 'r', width, p, array_to_string(ls[p:p + width - 1], ' ') FROM bl
       WHERE item_id NOT IN (SELECT item_id FROM bl WHERE rich)),
dp AS (SELECT doc_id, cs, ls, mode, width, unnest(range(1, len(cs) - width + 2)) AS p
       FROM d, (SELECT DISTINCT mode, width FROM bw) WHERE len(cs) >= width AND (width >= {SHORTEST} OR len(cs) = width)),
dw AS (SELECT doc_id, mode, width, p, array_to_string(CASE WHEN mode = 't' THEN cs ELSE ls END[p:p + width - 1], ' ') AS w FROM dp),
met AS (SELECT DISTINCT doc_id, item_id, dw.p - bw.p AS shift, bw.p AS p, width FROM dw JOIN bw USING (mode, width, w)),
at_ AS (SELECT DISTINCT doc_id, item_id, shift, unnest(range(p, p + width)) AS place FROM met),
sh AS (SELECT DISTINCT doc_id, item_id, shift FROM met),
lg AS (SELECT *, lag(shift) OVER (PARTITION BY doc_id, item_id ORDER BY shift) AS prev FROM sh),
rn AS (SELECT *, sum(CASE WHEN shift - prev <= {NEAR} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, item_id ORDER BY shift) AS run FROM lg),
gr AS (SELECT doc_id, item_id, shift, unnest(['s' || shift, 'r' || run, 'a']) AS g FROM rn),
places AS (SELECT * FROM at_ JOIN gr USING (doc_id, item_id, shift)),
found AS (SELECT doc_id, item_id, g, count(DISTINCT place) AS n_found FROM places GROUP BY doc_id, item_id, g),
enough AS (SELECT doc_id, item_id, g, n_found, len(ts) AS n_tokens FROM found JOIN b USING (item_id)
           WHERE n_found >= {FOUND_TOKENS} OR n_found >= len(ts) * {FOUND_SHARE}),
filled AS (SELECT doc_id, item_id, g, n_found, n_tokens, lower(d.ts[place + shift]) AS theirs,
           CASE WHEN b.cs[place] IN ('#', '@', '%') THEN lower(b.ts[place]) END AS value
           FROM enough JOIN places USING (doc_id, item_id, g) JOIN d USING (doc_id) JOIN b USING (item_id)),
vals AS (SELECT doc_id, item_id, g, n_found, n_tokens, value, count(*) AS n, count(DISTINCT theirs) AS kinds
         FROM filled GROUP BY ALL),
judged AS (SELECT doc_id, item_id, g, n_found, CAST(n_tokens AS INTEGER) AS n_tokens,
       CAST(sum(CASE WHEN value IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS n_slots, count(value) AS n_values,
       CAST(sum(CASE WHEN value IS NOT NULL AND kinds > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_conflicts
FROM vals GROUP BY doc_id, item_id, g, n_found, n_tokens
HAVING sum(CASE WHEN value IS NOT NULL AND kinds > 1 THEN 1 ELSE 0 END) <= count(value) * {CONFLICTS})
SELECT doc_id, item_id, n_found, n_tokens, n_slots, n_values, n_conflicts FROM judged
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_found DESC, n_conflicts, n_values DESC, n_slots DESC) = 1
"""


@query("op7_benchmark_decontamination", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` that rows of ``documents`` hold; see ``leaks``."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")

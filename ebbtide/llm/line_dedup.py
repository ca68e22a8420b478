"""Line dedup: lines that many documents share go, with DataFrame functions only.

Lines are normalised, exploded and hashed; the documents of each hash are
counted; lines of hashes over the threshold give their positions back to their
document, which is put together from the runs of lines between them. A line
travels as a position and a 128-bit hash, a text only meets its own positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.numbering import numbered
from ebbtide.llm.registry import query, table
from ebbtide.session import work_dir

#: A key in so many documents loses its lines, if it has so many code points.
MIN_DOCS = 10
MIN_CHARS = 1
#: So many of the most frequent keys are spread over ``SALTS`` parts of the join; each other key holds
#: at most one in ``HOT_KEYS`` of all pairs of key and document.
HOT_KEYS = 1000
SALTS = 64

#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    """The lines of a text, at ``\\n`` alone; null is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() changes letters beyond A-Z too, so it is for lines of single bytes only
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashes(key: Column) -> list[Column]:
    """128 bits of a key."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, n_docs``: hashes of the keys of at least ``min_chars`` code points found in ``min_docs`` rows or more.

    A key counts once for each row. It is made distinct inside the row, so that
    counting starts before the shuffle and a frequent line leaves a task once.
    """
    keys = F.array_distinct(F.transform(split_lines(F.col("text")), line_key))
    return (
        docs.select(F.explode(keys).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .groupBy(*_hashes(F.col("key")))
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )


def dropped_positions(rows: DataFrame, shared: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``uid, dropped``: the sorted positions (from 0) of lines of ``rows`` (``uid, text``) whose key is shared.

    Of a key that a third of all lines have, no task gets all: the most
    frequent keys are known to every task, and their lines are dealt over
    ``SALTS`` copies of the key.
    """
    hot = shared.orderBy(F.desc("n_docs"), "h1", "h2").limit(HOT_KEYS).select("h1", "h2", F.lit(True).alias("hot"))
    lines = (
        rows.select("uid", F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("pos", "key"))
        .where(F.char_length("key") >= min_chars)
        .select("uid", "pos", *_hashes(F.col("key")))
        .join(F.broadcast(hot), ["h1", "h2"], "left")
        .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("uid", "pos"), F.lit(SALTS))).otherwise(F.lit(0)))
    )
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    keys = shared.select("h1", "h2").join(F.broadcast(hot), ["h1", "h2"], "left")
    keys = keys.select("h1", "h2", F.explode(salts.cast("array<bigint>")).alias("salt"))
    return (
        lines.join(keys, ["h1", "h2", "salt"], "left_semi")
        .groupBy("uid")
        .agg(F.sort_array(F.collect_list("pos")).alias("dropped"))
    )


def _kept(lines: Column, dropped: Column) -> Column:
    """Lines whose position is not in ``dropped``, as the runs between dropped ones."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + F.lit(1)))
    ends = F.concat(dropped, F.array(F.size(lines)))
    gaps = F.arrays_zip(starts.alias("start"), ends.alias("end"))
    return F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["start"] + F.lit(1), g["end"] - g["start"])))


def without_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped, kept_text``, one row for each row of ``docs`` (``doc_id``, ``text``, others unused).

    Lines whose key (see ``line_key``) is found in ``min_docs`` rows or more
    are left out; the others stay as they are, in their order, joined by
    ``\\n``. A null or empty text is one empty line, whose key is shorter than
    ``min_chars`` unless that is 0. Each row counts as a document, also one of
    a repeated or null ``doc_id``; a key found twice in a row counts once.
    ``doc_id`` may be of any type. A document whose lines all go has an empty
    ``kept_text``. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = numbered(docs, "line-dedup-rows")
    path = work_dir(spark, "line-dedup-shared")
    shared_lines(rows, min_docs, min_chars).write.parquet(path)
    dropped = dropped_positions(rows, spark.read.parquet(path), min_chars)
    none = F.array().cast("array<int>")
    # an array of one text's lines, so that its lines are worked out once and not again for every run
    whole = F.transform(
        F.array(F.struct(split_lines(F.col("text")).alias("lines"), F.coalesce("dropped", none).alias("dropped"))),
        lambda r: F.struct(
            F.size(r["lines"]).cast("bigint").alias("n_lines"),
            F.size(r["dropped"]).cast("bigint").alias("n_dropped"),
            F.array_join(_kept(r["lines"], r["dropped"]), "\n").alias("kept_text"),
        ),
    )
    return (
        rows.join(dropped, "uid", "left")
        .select("doc_id", "text", F.element_at(whole, 1).alias("r"))
        .select("doc_id", "text", "r.n_lines", "r.n_dropped", "r.kept_text")
    )


_BLANKS_SQL = " || ".join(f"chr({ord(c)})" for c in BLANKS)
SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, {_BLANKS_SQL}), '{UPPER}', '{LOWER}') AS key FROM l),
s AS (SELECT key FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (s.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN s ON k.key = s.key GROUP BY doc_id
"""


@query("op13_line_dedup", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of each row of ``documents``; see ``without_shared_lines``."""
    kept = without_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))

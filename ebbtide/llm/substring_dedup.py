"""Substring dedup over words: seed and extend.

Documents meet on winnowed anchors (seeds of ``SEED`` words, chosen by their
content, at least one in every window). From a shared anchor a match is
extended both ways as far as a window can hold the anchor; extensions that
agree are repeated windows, and neighbouring ones merge into maximal repeats of
at least ``LENGTH`` words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.llm.repeats import Tokens, covered, repeated_windows
from ebbtide.llm.texts import Rolling, as_rows, identified, mixed, strings

#: Words of a window, and of a seed.
LENGTH = 35
SEED = 6

#: Bytes between words: [\x20\x09-\x0D], as ``bytes.split()`` takes them.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number for each word, and the count of words up to each of ``ends``."""
    n = len(data)
    inside = ~_SPACE[data]
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    begins_text = np.zeros(n + 1, bool)
    begins_text[0] = True
    begins_text[ends] = True
    starts = np.flatnonzero(inside & (~before[:-1] | begins_text[:-1]))
    after = np.ones(n + 1, bool)
    after[:n] = ~inside
    stops = np.flatnonzero(inside & (after[1:] | begins_text[1:])) + 1
    roll = Rolling(3)
    p = roll.prefix(roll.letters()[data])
    length = stops - starts
    return mixed(roll.of(p, starts, length) + length.astype(np.uint64)), np.searchsorted(starts, ends)


WORDS = Tokens(
    words, cut=False, width=8, pack=lambda text, x: x.tobytes(), unpack=lambda packed: np.frombuffer(packed, np.uint64)
)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans`` for each row of ``docs`` (``doc_id``, ``text``, others ignored).

    ``kept`` are the words outside every repeated window, joined by one space;
    ``spans`` the maximal repeats as word positions ``start`` and ``end``
    (exclusive). A null text has no words. Rows with equal ``doc_id`` and text
    are one document, returned for each row; a null ``doc_id`` is a value.
    """
    keyed = identified(docs, "substring-docs")
    found = repeated_windows(keyed, WORDS, length, seed, keep_first=False, name="substring-dedup")

    def apply(batches):
        for batch in batches:
            data, offsets = strings(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            copies = batch.column(batch.schema.get_field_index("copies"))
            marks = batch.column(batch.schema.get_field_index("found")).to_pylist()
            n, removed, kept, spans = [], [], [], []
            for r, mark in enumerate(marks):
                tokens = data[offsets[r] : offsets[r + 1]].tobytes().split()
                gone = covered(mark, len(tokens), length)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                n.append(len(tokens))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([t for t, g in zip(tokens, gone.tolist()) if not g] if mark else tokens))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([k.decode() for k in kept], pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    copies,
                ],
                names=["doc_id", "n_words", "n_removed", "kept", "spans", "copies"],
            )

    joined = keyed.join(found, "uid", "left").select("doc_id", "text", "copies", "found")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return as_rows(
        joined.mapInArrow(
            apply,
            f"doc_id {kind}, n_words bigint, n_removed bigint, kept string, "
            "spans array<struct<start: bigint, end: bigint>>, copies int",
        )
    )


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
s AS (
  SELECT doc_id, unnest(range(1, len(ws) - {LENGTH} + 2)) AS p0,
         ws FROM w WHERE len(ws) >= {LENGTH}),
k AS (SELECT doc_id, p0, md5(array_to_string(ws[p0:p0 + {LENGTH - 1}], ' ')) AS key FROM s),
r AS (SELECT doc_id, p0 FROM k QUALIFY count(*) OVER (PARTITION BY key) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p0, p0 + {LENGTH})) AS wpos FROM r),
lists AS (SELECT doc_id, list(wpos) AS gone FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE
         list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id)
"""


@query("op2_substring_dedup", SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )

"""Suffix-array dedup over bytes: a depth-limited radix sort of suffixes.

Suffixes are told apart by their first ``LENGTH`` bytes only, most significant
digits first: a digit of ``SEED`` bytes, then one of ``LENGTH - CELL + 1``
bytes, then all ``LENGTH``. A suffix that is alone in its group after a digit
is finished; groups that are left after the last one are exactly the repeated
windows. A digit is read around an anchor that the window's content chooses, so
that neighbouring suffixes stay together as one row as long as they agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.registry import query, table
from ebbtide.llm.repeats import Tokens, covered, repeated_windows
from ebbtide.llm.texts import Rolling, as_rows, identified, strings

#: Bytes of a window, and of the first digit.
LENGTH = 100
SEED = 20


def as_letters(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return Rolling(0).letters()[data], ends


BYTES = Tokens(
    as_letters,
    cut=True,
    width=1,
    pack=lambda text, x: text.tobytes(),
    unpack=lambda packed: Rolling(0).letters()[np.frombuffer(packed, np.uint8)],
)


def remove_later_copies(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``doc_id, n_bytes, n_removed, kept, spans`` for each row of ``docs`` (``doc_id``, ``text``, others ignored).

    ``kept`` (binary) are the bytes that no window covers which starts earlier
    as well; ``spans`` the maximal removed runs as ``start`` and ``end``
    (exclusive). A null text is empty. Rows with equal ``doc_id`` and text are
    one document, returned for each row; a null ``doc_id`` comes first.
    """
    keyed = identified(docs, "suffix-docs")
    found = repeated_windows(keyed, BYTES, length, seed, keep_first=True, name="suffix-dedup")

    def apply(batches):
        for batch in batches:
            data, offsets = strings(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            copies = batch.column(batch.schema.get_field_index("copies"))
            marks = batch.column(batch.schema.get_field_index("found")).to_pylist()
            n, removed, kept, spans = [], [], [], []
            for r, mark in enumerate(marks):
                text = data[offsets[r] : offsets[r + 1]]
                gone = covered(mark, len(text), length)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                n.append(len(text))
                removed.append(int(gone.sum()))
                kept.append(text[~gone].tobytes())
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    copies,
                ],
                names=["doc_id", "n_bytes", "n_removed", "kept", "spans", "copies"],
            )

    joined = keyed.join(found, "uid", "left").select("doc_id", "text", "copies", "found")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return as_rows(
        joined.mapInArrow(
            apply,
            f"doc_id {kind}, n_bytes bigint, n_removed bigint, kept binary, "
            "spans array<struct<start: bigint, end: bigint>>, copies int",
        )
    )


SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, x, unnest(range(0, len(x) // 2 - {LENGTH} + 1)) AS p0 FROM d WHERE len(x) >= {2 * LENGTH}),
k AS (SELECT doc_id, p0, hash(substr(x, 2 * p0 + 1, {2 * LENGTH})) AS h1,
      hash(reverse(substr(x, 2 * p0 + 1, {2 * LENGTH}))) AS h2 FROM s),
r AS (SELECT doc_id, p0 FROM k QUALIFY row_number() OVER (PARTITION BY h1, h2 ORDER BY doc_id, p0) > 1),
p AS (SELECT doc_id, p0, lag(p0) OVER (PARTITION BY doc_id ORDER BY p0) AS before FROM r),
b AS (SELECT doc_id, p0, CASE WHEN before IS NULL OR p0 > before + {LENGTH} THEN 1 ELSE 0 END AS opens FROM p),
g AS (SELECT doc_id, p0, sum(opens) OVER (PARTITION BY doc_id ORDER BY p0) AS run FROM b),
m AS (SELECT doc_id, run, min(p0) AS a, max(p0) + {LENGTH} AS z FROM g GROUP BY doc_id, run),
q AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM m),
t AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS tail,
      string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
      FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


@query("op8_suffix_dedup", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_later_copies(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

"""Byte-level BPE: encoding and decoding of whole texts.

Two tiers. A minimal perfect hash finds pre-tokens that are in the vocabulary
as they are. Others are merged: their bytes form a linked list, and a heap
holds the pairs that may be joined, lowest rank first, leftmost of equal ones.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm.registry import query, table
from ebbtide.llm.texts import small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens whose ids a worker remembers; it starts anew beyond that.
REMEMBERED = 400_000
#: Pre-tokens of a text that are held at once.
PRETOKENS_AT_ONCE = 1 << 18


class PerfectHash:
    """Minimal perfect hash by hashing into buckets and displacing each: ``len(keys)`` slots, one for each key."""

    def __init__(self, keys: list[bytes]):
        self.n = n = max(1, len(keys))
        self.buckets = max(1, n // 4)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        where = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        bounds = np.searchsorted(where[order], np.arange(self.buckets + 1))
        taken = np.zeros(n, bool)
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot_of = np.zeros(n, np.int64)
        by_size = np.argsort(-np.diff(bounds), kind="stable")
        tries = np.arange(256, dtype=np.uint64)
        for b in by_size:
            own = order[bounds[b] : bounds[b + 1]]
            if len(own) < 2:
                break
            base = 0
            while True:
                slots = self._slots(hashes[own][:, None], tries[None, :] + np.uint64(base)) % np.uint64(n)
                free = ~taken[slots.astype(np.int64)].any(axis=0)
                for d in np.flatnonzero(free):
                    s = slots[:, d].astype(np.int64)
                    if len(np.unique(s)) == len(own):
                        break
                else:
                    base += len(tries)
                    continue
                break
            taken[s] = True
            self.shift[b] = base + d
            self.slot_of[own] = s
        rest = iter(np.flatnonzero(~taken))
        for b in by_size:  # buckets of one key name their slot
            if bounds[b + 1] - bounds[b] == 1:
                s = next(rest)
                self.shift[b] = -1 - s
                self.slot_of[order[bounds[b]]] = s

    @staticmethod
    def _slots(h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        x = h ^ (shift * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        shift = int(self.shift[h % self.buckets])
        if shift < 0:
            return -1 - shift
        x = h ^ (shift * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> 32)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 29)) % self.n


class Codec:
    """A vocabulary of byte strings with their ranks, and the pattern that splits texts before merging."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        tokens = sorted(ranks, key=ranks.get)
        self.tokens = tokens
        self.ids = [ranks[t] for t in tokens]
        self.hash = PerfectHash(tokens)
        at_slot = np.zeros(len(tokens), np.int64)
        at_slot[self.hash.slot_of] = np.arange(len(tokens))
        self.at_slot = at_slot.tolist()
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")

    @staticmethod
    def load(path: str, pattern: str) -> Codec:
        """Read a rank file: a base64 token and its rank on each line."""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return Codec(ranks, pattern)

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        return dict(zip(self.tokens, self.ids))

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        return dict(zip(self.ids, self.tokens))

    @cached_property
    def splitter(self):
        return regex.compile(self.pattern)

    def whole(self, piece: bytes) -> int | None:
        """The id of a pre-token that is in the vocabulary."""
        i = self.at_slot[self.hash.slot(piece)]
        return self.ids[i] if self.tokens[i] == piece else None

    def merged(self, piece: bytes) -> list[int]:
        """The ids of a pre-token by merging."""
        n = len(piece)
        bits = n.bit_length()
        low = (1 << bits) - 1
        rank = self.ranks.get
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank(piece[i : i + 2])
            if r is not None:
                heap.append(r << bits | i)
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            i = top & low
            j = after[i]
            if j < 0 or j >= n:  # joined to its left, or nothing follows
                continue
            k = after[j]
            if rank(piece[i:k]) != top >> bits:  # one of the two has grown since
                continue
            after[i], after[j] = k, -1
            if k < n:
                before[k] = i
                r = rank(piece[i : after[k]])
                if r is not None:
                    heapq.heappush(heap, r << bits | i)
            if i:
                p = before[i]
                r = rank(piece[p:k])
                if r is not None:
                    heapq.heappush(heap, r << bits | p)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        one = self.whole(piece)
        return self.merged(piece) if one is None else [one]

    def encode(self, text: str, memo: _Memo) -> bytes:
        """The ids of a text, four bytes each, lowest byte first."""
        if len(text) <= PRETOKENS_AT_ONCE:
            return b"".join(map(memo.__getitem__, self.splitter.findall(text)))
        found = (m.group() for m in self.splitter.finditer(text))
        out = []
        while part := list(islice(found, PRETOKENS_AT_ONCE)):
            out.append(b"".join(map(memo.__getitem__, part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Memo(dict):
    """Packed ids by pre-token."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.codec.encode_piece(piece.encode()), "<u4").tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids


_MEMOS: dict[str, _Memo] = {}


def _memo(key: str, codec: Codec) -> _Memo:
    """This worker's memo for a vocabulary; it outlives the task."""
    if key not in _MEMOS:
        _MEMOS.clear()
        _MEMOS[key] = _Memo(codec)
    return _MEMOS[key]


def _encoded(batch: pa.RecordBatch, memo: _Memo) -> Iterator[bytes]:
    column = batch.column(batch.schema.get_field_index("text"))
    for text in column:
        yield memo.codec.encode(text.as_py() or "", memo)


def _lists(packed: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0] + [len(x) // 4 for x in packed]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))


def _key(codec: Codec) -> str:
    return hashlib.sha256(b"".join(codec.tokens) + codec.pattern.encode()).hexdigest()


def encode(docs: DataFrame, codec: Codec) -> DataFrame:
    """``doc_id, ids`` for each row of ``docs``: the ids of its whole text; null has none. Other columns are ignored."""
    small_batches(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast(codec), _key(codec)

    def run(batches):
        memo = _memo(key, shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(list(_encoded(batch, memo)))], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, codec: Codec) -> DataFrame:
    """``doc_id, bytes`` for each row of ``tokens`` (``doc_id``, ``ids``); null or no ids give no bytes."""
    shared = tokens.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        for batch in batches:
            out = [
                shared.value.decode(np.array(ids.as_py() or [], "<u4").tobytes())
                for ids in batch.column(batch.schema.get_field_index("ids"))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def round_trip(docs: DataFrame, codec: Codec, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded, decoded again, and the digests of both.

    One row for each row of ``docs``; null is an empty text. ``with_ids`` adds
    the ``ids`` themselves.
    """
    small_batches(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast(codec), _key(codec)

    def run(batches):
        memo = _memo(key, shared.value)
        for batch in batches:
            n, encoded, decoded, kept = [], [], [], []
            for ids in _encoded(batch, memo):
                if with_ids:
                    kept.append(ids)
                n.append(len(ids) // 4)
                encoded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(memo.codec.decode(ids)).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(_lists(kept))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def public_codec(name: str = VOCABULARY) -> Codec:
    import public_tokenizers

    return Codec.load(public_tokenizers.path(name), public_tokenizers.PATTERN)


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_codec())

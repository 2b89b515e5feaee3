"""Byte-level BPE as a reduction over a tree.

Encodings form a monoid: the encoding of two neighbouring byte strings is made
from their encodings by re-encoding a window around the seam. The window grows
by doubling until the token on either side of it and its own outermost token form a pair
that re-encodes to itself; a token sequence whose neighbours all do so is the
encoding of its bytes, so nothing outside the window can change. Each
pre-token is halved down to single bytes and joined up again; halves that were
seen before are taken from a bounded memory. Decoding joins byte strings up a
tree in the same way.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import ragged
from millrace.llm.frames import map_texts

# Encoded byte strings, and seams of two tokens, that a worker remembers.
REMEMBERED = 1_000_000
# Longer byte strings are not remembered.
LONGEST_REMEMBERED = 24
# Ids whose bytes are joined at once at the leaves of the decoding tree.
LEAF_IDS = 512


class TreeCodec:
    """Encoder and decoder over a file of ranks (base64 bytes, rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as source:
            pairs = [line.split() for line in source if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self._parts: dict[bytes, tuple[int, ...]] = {}
        self._seams: dict[tuple[int, int], tuple[int, ...]] = {}

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        if len(data) < 2:
            return (self.ranks[data],) if data else ()
        known = self._parts.get(data)
        if known is not None:
            return known
        half = len(data) // 2
        out = self.join(self.encode(data[:half]), self.encode(data[half:]))
        if len(data) <= LONGEST_REMEMBERED:
            if len(self._parts) >= REMEMBERED:
                self._parts.clear()
            self._parts[data] = out
        return out

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbours' bytes."""
        if not left or not right:
            return left or right
        start, end = len(left) - 1, 1
        left_step = right_step = 1
        inner = self._seam(left[-1], right[0])
        while True:
            open_left = start > 0 and self._seam(left[start - 1], inner[0]) != (left[start - 1], inner[0])
            open_right = end < len(right) and self._seam(inner[-1], right[end]) != (inner[-1], right[end])
            if not open_left and not open_right:
                return left[:start] + inner + right[end:]
            if open_left:
                start, left_step = max(0, start - left_step), 2 * left_step
            if open_right:
                end, right_step = min(len(right), end + right_step), 2 * right_step
            inner = self._window(left[start:] + right[:end])

    def _seam(self, left: int, right: int) -> tuple[int, ...]:
        known = self._seams.get((left, right))
        if known is None:
            if len(self._seams) >= REMEMBERED:
                self._seams.clear()
            known = self._seams[left, right] = self._window((left, right))
        return known

    def _window(self, ids: tuple[int, ...]) -> tuple[int, ...]:
        """Lowest-rank merges over the bytes of a few tokens."""
        parts: list[bytes | None] = [bytes([b]) for i in ids for b in self.bytes_of[i]]
        rank_of, last = self.ranks.get, len(parts) - 1
        after, before = list(range(1, last + 2)), list(range(-1, last))
        queue = []
        for at in range(last):
            rank = rank_of(parts[at] + parts[at + 1])
            if rank is not None:
                queue.append((rank, at, parts[at] + parts[at + 1]))
        heapify(queue)
        while queue:
            _, at, pair = heappop(queue)
            right = after[at]
            if parts[at] is None or right > last or parts[at] + parts[right] != pair:
                continue
            parts[at], parts[right] = pair, None
            after[at] = after[right]
            if after[at] <= last:
                before[after[at]] = at
                rank = rank_of(pair + parts[after[at]])
                if rank is not None:
                    heappush(queue, (rank, at, pair + parts[after[at]]))
            if before[at] >= 0:
                rank = rank_of(parts[before[at]] + pair)
                if rank is not None:
                    heappush(queue, (rank, before[at], parts[before[at]] + pair))
        return tuple(self.ranks[p] for p in parts if p is not None)

    def encode_texts(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as a flat array with bounds per text."""
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        points, firsts, at = ragged.code_points(buf, offsets)
        begins = ragged.pre_tokens(points, firsts, "tiktoken")
        starts, ends = at[begins], at[np.append(begins[1:], len(points))]
        place, like = ragged.distinct_spans(buf, starts, ends)
        raw = buf.tobytes()
        known = [self.encode(raw[s:e]) for s, e in zip(starts[place].tolist(), ends[place].tolist())]
        ids, per_token = ragged.taken(*ragged.flattened(known), like)
        return ids.astype("<u4"), per_token[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids, joined up a tree."""
        known = self.bytes_of
        level = [b"".join([known[i] for i in ids[k : k + LEAF_IDS].tolist()]) for k in range(0, len(ids), LEAF_IDS)]
        while len(level) > 1:
            level = [b"".join(level[k : k + 2]) for k in range(0, len(level), 2)]
        return level[0] if level else b""


@lru_cache(maxsize=4)
def codec(path: str) -> TreeCodec:
    return TreeCodec(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every text: (doc_id, token_ids array<int>).

    ``path`` names a rank file that every executor can read. A null text counts
    as empty and has an empty list; repeated ids stay one row each; other
    columns are not read. No shuffle.
    """

    def run(batch: pa.RecordBatch, tokens: TreeCodec) -> pa.RecordBatch:
        ids, bounds = tokens.encode_texts(*ragged.column_bytes(batch["text"]))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
        return pa.record_batch([batch["id"], lists], ["doc_id", "token_ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(docs, {"id": doc_id, "text": text}, run, f"doc_id {kind}, token_ids array<int>", setup=lambda: codec(path))


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """Bytes of every list of ids: (doc_id, bytes); a null list gives empty bytes."""

    def run(batches):
        tokens = codec(path)
        for batch in batches:
            out = [tokens.decode(np.array(row if row is not None else [], np.int64)) for row in batch["ids"].to_pylist()]
            yield pa.record_batch([batch["id"], pa.array(out, pa.binary())], ["doc_id", "bytes"])

    kind = encoded.schema[doc_id].dataType.simpleString()
    chosen = encoded.select(encoded[doc_id].alias("id"), encoded[ids].alias("ids"))
    return chosen.mapInArrow(run, f"doc_id {kind}, bytes binary")


def round_trip_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass and return digests of both.

    Gives (doc_id, n_tokens, ids_sha256 of the ids as little-endian 32-bit
    integers, decoded_sha256 of the decoded bytes); nulls as in ``encode``.
    """

    def run(batch: pa.RecordBatch, tokens: TreeCodec) -> pa.RecordBatch:
        ids, bounds = tokens.encode_texts(*ragged.column_bytes(batch["text"]))
        sums, texts = [], []
        for k in range(batch.num_rows):
            own = ids[bounds[k] : bounds[k + 1]]
            sums.append(hashlib.sha256(own.tobytes()).hexdigest())
            texts.append(hashlib.sha256(tokens.decode(own)).hexdigest())
        return pa.record_batch(
            [batch["id"], pa.array(np.diff(bounds)), pa.array(sums, pa.string()), pa.array(texts, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(
        docs,
        {"id": doc_id, "text": text},
        run,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
        setup=lambda: codec(path),
    )

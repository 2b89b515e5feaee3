"""Token counts by rank-synchronous merging over ragged arrays.

The different pre-tokens of a batch stand side by side in one array of symbols.
In every round each pre-token finds the lowest rank among its own adjacent
pairs and merges all places of that pair at once; a pre-token without a known
pair is finished, and what is left of it is its number of tokens.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import ragged
from millrace.llm.frames import map_texts

NO_RANK = np.int32(2**31 - 1)


class MergeRanks:
    """Ranks of symbol pairs in two levels of hash tables; most pairs need one look."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        ranks = np.arange(len(keys), dtype=np.int32)
        self.merged = merged.astype(np.int64)
        self.levels = []
        for multiplier in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407):
            bits = max(8, int(len(keys)).bit_length() + 4)
            slots = (keys * np.uint64(multiplier)) >> np.uint64(64 - bits)
            _, first = np.unique(slots, return_index=True)
            table, held = np.full(1 << bits, 2**64 - 1, np.uint64), np.full(1 << bits, NO_RANK, np.int32)
            table[slots[first]], held[slots[first]] = keys[first], ranks[first]
            self.levels.append((np.uint64(multiplier), np.uint64(64 - bits), table, held))
            rest = np.delete(np.arange(len(keys)), first)
            keys, ranks = keys[rest], ranks[rest]
            if not len(keys):
                return
        raise ValueError("the merge table cannot be hashed")

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(len(keys), NO_RANK, np.int32)
        for multiplier, shift, table, held in self.levels:
            slots = (keys * multiplier) >> shift
            np.copyto(out, held[slots], where=table[slots] == keys)
        return out


class ByteLevelCounter:
    """Merges, byte symbols and special strings of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
        self.byte_symbols = np.array([vocab[c] for c in byte_alphabet()], np.int64)
        self.ranks = MergeRanks(
            np.array([vocab[a] for a, _ in merges]),
            np.array([vocab[b] for _, b in merges]),
            np.array([vocab[a + b] for a, b in merges]),
        )
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in special)) if special else None

    def counts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of tokens of each text."""
        bounds, owner, special = self._segments(buf, offsets)
        total = np.bincount(owner[special], minlength=len(offsets) - 1).astype(np.int64)
        if not len(buf):
            return total
        points, firsts, at = ragged.code_points(buf, bounds)
        begins = ragged.pre_tokens(points, firsts)
        starts, ends = at[begins], at[np.append(begins[1:], len(points))]
        segment = np.searchsorted(bounds, starts, "right") - 1
        place, like = ragged.distinct_spans(buf, starts, ends)
        lengths = ends[place] - starts[place]
        inner = np.zeros(len(place) + 1, np.int64)
        np.cumsum(lengths, out=inner[1:])
        held = np.arange(inner[-1]) + np.repeat(starts[place] - inner[:-1], lengths)
        per_token = surviving(self.byte_symbols[buf[held]], inner, self.ranks)[like]
        per_token[special[segment]] = 0
        return total + np.bincount(owner[segment], per_token, len(offsets) - 1).astype(np.int64)

    def _segments(self, buf, offsets):
        """Texts cut at special strings: bounds, the text of each piece, whether it is a special string."""
        owner = np.arange(len(offsets) - 1)
        plain = np.zeros(len(owner), bool)
        if self.special is None or not self.special.search(raw := buf.tobytes()):
            return offsets, owner, plain
        cuts, marks, owners = [0], [], []
        for text in range(len(offsets) - 1):
            start, end = int(offsets[text]), int(offsets[text + 1])
            for found in self.special.finditer(raw, start, end):
                cuts += [found.start(), found.end()]
                marks += [False, True]
                owners += [text, text]
            cuts.append(end)
            marks.append(False)
            owners.append(text)
        return np.array(cuts), np.array(owners), np.array(marks)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def surviving(symbols: np.ndarray, bounds: np.ndarray, ranks: MergeRanks) -> np.ndarray:
    """Number of symbols left of each sequence after all merges."""
    left = np.diff(bounds)
    for done, lengths, _ in _rounds(symbols, bounds, ranks):
        left[done] = lengths
    return left


def merged(symbols: np.ndarray, bounds: np.ndarray, ranks: MergeRanks) -> tuple[np.ndarray, np.ndarray]:
    """The symbols left of each sequence after all merges, with their bounds."""
    short = np.flatnonzero(np.diff(bounds) < 2)
    done, lengths, flat = [short], [np.diff(bounds)[short]], [ragged.taken(symbols, bounds, short)[0]]
    for part in _rounds(symbols, bounds, ranks):
        for held, piece in zip((done, lengths, flat), part):
            held.append(piece)
    order = np.argsort(np.concatenate(done), kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
    return ragged.taken(np.concatenate(flat), ends, order)


def _rounds(symbols, bounds, ranks):
    """Merge in rounds; yields (which, lengths, symbols) of the sequences that each round finds finished."""
    active = np.flatnonzero(np.diff(bounds) > 1)
    symbols, bounds = ragged.taken(symbols, bounds, active)
    while len(active):
        lengths = np.diff(bounds)
        rank = np.full(len(symbols), NO_RANK, np.int32)
        rank[:-1] = ranks.of(symbols[:-1], symbols[1:])
        rank[bounds[1:] - 1] = NO_RANK
        lowest = np.minimum.reduceat(rank, bounds[:-1])
        going = lowest != NO_RANK
        wide = np.repeat(going, lengths)
        if not going.all():
            yield active[~going], lengths[~going], symbols[~wide]
        at = np.flatnonzero((rank == np.repeat(lowest, lengths)) & wide)
        at = _apart(at)
        symbols[at] = ranks.merged[rank[at]]
        gone = np.zeros(len(symbols), np.int32)
        gone[at + 1] = 1
        lengths = (lengths - np.add.reduceat(gone, bounds[:-1]))[going]
        symbols = symbols[(gone == 0) & wide]
        active = active[going]
        bounds = np.zeros(len(active) + 1, np.int64)
        np.cumsum(lengths, out=bounds[1:])


def _apart(at: np.ndarray) -> np.ndarray:
    """Of places that follow each other directly (a pair of equal symbols in a run), every second one."""
    if len(at) < 2 or not (follows := np.append(False, at[1:] == at[:-1] + 1)).any():
        return at
    order = np.arange(len(at))
    first = np.maximum.accumulate(np.where(follows, 0, order))
    return at[(order - first) % 2 == 0]


@lru_cache(maxsize=4)
def counter(path: str) -> ByteLevelCounter:
    return ByteLevelCounter(path)


def count_tokens(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024
) -> DataFrame:
    """Bytes and tokens of every text, and whether the tokens exceed ``limit``.

    ``path`` names a byte-level tokenizer file that every executor can read;
    its special strings count one token wherever they stand. A null or empty
    text has no bytes and no tokens; null or repeated ids stay as they are, one
    row for each input row; other columns are not read. No shuffle: one pass in
    the tasks that read the texts.
    """

    def run(batch: pa.RecordBatch, tokens: ByteLevelCounter) -> pa.RecordBatch:
        buf, offsets = ragged.column_bytes(batch["text"])
        n = tokens.counts(buf, offsets)
        return pa.record_batch(
            [batch["id"], pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(
        docs,
        {"id": doc_id, "text": text},
        run,
        f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean",
        setup=lambda: counter(path),
    )

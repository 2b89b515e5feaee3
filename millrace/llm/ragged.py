"""Numpy views of text columns: bytes, words, pre-tokens and their hashes.

A column of texts is one byte buffer plus offsets; a list of spans is a pair of
start and end arrays. Nothing here is per row or per character in Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Bytes of text that one numpy step holds at a time; a longer single text is taken whole.
SLICE_BYTES = 2 << 20
# Bytes of spans that are hashed together: what a step holds fits into a cache.
SPANS_AT_ONCE = 1 << 18

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SEEDED = np.random.default_rng(20240229)
# Random values of bytes, or of the first code points, for two independent hashes.
_VALUES = _SEEDED.integers(1, 2**64, (2, 1024), dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
SPACE, LETTER, NUMBER, OTHER = range(4)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray) or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=1)
def _trimming():
    """glibc's way to hand free pages back to the system; None where there is none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError, TypeError):
        return None


def give_back() -> None:
    """Hand free memory back: workers outlive their tasks, and what one step freed adds up with the next one's peak."""
    pa.default_memory_pool().release_unused()
    trim = _trimming()
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; one row at least. Free memory goes back at the end."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        lengths = np.diff(column_bytes(batch[text])[1])
        total = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, "right")))
            piece = batch.slice(start, end - start)
            size = int(total[end - 1] - base)
            if waiting and held + size > limit:
                yield _joined(waiting)
                waiting, held = [], 0
            waiting.append(piece)
            held += size
            start = end
    if waiting:
        yield _joined(waiting)
    give_back()


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values so that every bit depends on every bit."""
    values = values.astype(np.uint64, copy=True)
    shifted = values >> np.uint64(30)
    values ^= shifted
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= np.right_shift(values, np.uint64(27), out=shifted)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= np.right_shift(values, np.uint64(31), out=shifted)
    return values


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(base: int, length: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    return _powers(base, 1 << max(6, int(length - 1).bit_length()))[:length]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than ``[\\x20\\x09-\\x0D]``, and each text's first word."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~IS_SPACE[buf]
    border = np.zeros(len(buf) + 1, bool)
    border[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | border[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | border[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes (or of code points below 1024); spans ascend and do not overlap."""
    return families_of_hashes(data, starts, ends, (family,))[0]


def families_of_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, families: Sequence[int]) -> list[np.ndarray]:
    """``span_hashes`` of several families at once."""
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in families]
    lengths = ends - starts
    upto = np.cumsum(lengths)
    total = int(upto[-1])
    if total > 2 * SPANS_AT_ONCE and len(starts) > 1:
        # A part takes spans while it has room, and one at least.
        cuts = np.flatnonzero(np.diff(upto // SPANS_AT_ONCE)) + 1
        if len(cuts):
            parts = [families_of_hashes(data, *x, families) for x in zip(np.split(starts, cuts), np.split(ends, cuts))]
            return [np.concatenate(x) for x in zip(*parts)]
    first = upto - lengths
    held = spans_held(data, starts, ends)
    place = np.arange(total)
    place -= np.repeat(first, lengths)
    scale = powers(int(_ODD), int(lengths.max()) + 1)[place]
    del place
    out = []
    for family in families:
        values = _VALUES[family][held]
        values *= scale
        sums = np.add.reduceat(values, np.minimum(first, total - 1)) if total else np.zeros(len(starts), np.uint64)
        if not lengths.all():
            sums[lengths == 0] = 0
        out.append(mixed(sums + lengths.astype(np.uint64)))
    return out


def window_hashes(values: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive values, by place of the first."""
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    scale = powers(multiplier | 1, len(values))
    inverse = powers(pow(multiplier | 1, -1, 2**64), len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * scale, out=sums[1:])
    return mixed((sums[size:] - sums[:count]) * inverse[:count])


def within(firsts: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` words lie in one text; ``firsts`` are the texts' first words."""
    total = int(firsts[-1])
    good = np.zeros(max(0, total - size + 1), bool)
    steps = np.zeros(total + 2, np.int64)
    lengths = np.diff(firsts)
    whole = lengths >= size
    np.add.at(steps, firsts[:-1][whole], 1)
    np.add.at(steps, firsts[1:][whole] - size + 1, -1)
    good[:] = np.cumsum(steps)[: len(good)] > 0
    return good


def taken(flat: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ragged rows ``which`` of (flat, bounds), as a new flat array with its bounds."""
    lengths = bounds[which + 1] - bounds[which]
    out = np.zeros(len(which) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return flat[np.arange(out[-1]) + np.repeat(bounds[which] - out[:-1], lengths)], out


def spans_held(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What lies in spans that ascend and do not overlap, one after the other."""
    if not len(starts) or np.array_equal(starts[1:], ends[:-1]):
        return flat[starts[0] : ends[-1]] if len(starts) else flat[:0]
    # Between and in spans by turns.
    lengths = np.empty(2 * len(starts), np.int64)
    lengths[0], lengths[2::2] = 0, starts[1:] - ends[:-1]
    lengths[1::2] = ends - starts
    return flat[starts[0] : ends[-1]][np.repeat(np.tile([False, True], len(starts)), lengths)]


def flattened(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """A list of short sequences of ids as a flat array with its bounds."""
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=bounds[1:])
    flat = np.fromiter((x for part in lists for x in part), np.int64, int(bounds[-1]))
    return flat, bounds


@lru_cache(maxsize=2)
def char_classes(library: str = "regex") -> np.ndarray:
    """Class of every code point: white space, letter, number or other.

    Libraries follow different versions of Unicode; ``library`` names the one
    whose classes are asked for, ``regex`` or ``tiktoken``.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    find = _found_by_tiktoken if library == "tiktoken" else _found_by_regex
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        classes[np.frombuffer(find(pattern, every).encode("utf-32-le"), np.uint32)] = kind
    return classes


def _found_by_regex(pattern: str, text: str) -> str:
    import regex

    return "".join(regex.findall(r"\p{White_Space}" if pattern == r"\s" else pattern, text))


def _found_by_tiktoken(pattern: str, text: str) -> str:
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    found = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
    return bytes(found.encode_ordinary(text)).decode("utf-8")


def code_points(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, each text's first code point, and the byte at which each code point begins (and the end)."""
    lead = (buf & 0xC0) != 0x80
    at = np.append(np.flatnonzero(lead), len(buf))
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, np.searchsorted(at, offsets), at


def points_of_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``code_points`` without the bytes at which they begin, which take sixteen bytes a byte on the way."""
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    upto = np.zeros(len(buf) + 1, np.int32 if len(buf) < 2**31 - 1 else np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=upto[1:])
    return points, upto[offsets].astype(np.int64)


def _runs(points, firsts, library="regex"):
    kinds = char_classes(library)[points]
    border = np.zeros(len(points) + 1, bool)
    border[firsts] = True
    begins = border[:-1].copy()
    begins[1:] |= kinds[1:] != kinds[:-1]
    starts = np.flatnonzero(begins)
    return kinds, border, starts, np.append(starts[1:], len(points))


def _contractions(points, kinds, border, starts, ends, alone):
    """Apostrophes that start 's 't 'm 'd 're 've 'll, and the letters each takes."""
    quote = (points[starts] == ord("'")) & (ends - starts == 1) & alone
    quote &= ~border[ends] & (ends < len(points))
    at = starts[quote]
    at = at[kinds[at + 1] == LETTER]
    if not len(at):
        return at, at
    one = points[at + 1]
    two = np.where((at + 2 < len(points)) & ~border[np.minimum(at + 2, len(points))], points[np.minimum(at + 2, len(points) - 1)], 0)
    takes = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
    for pair in ("re", "ve", "ll"):
        takes[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
    return at[takes > 0], takes[takes > 0]


def pre_tokens(points: np.ndarray, firsts: np.ndarray, library: str = "regex") -> np.ndarray:
    """First code point of each pre-token of the byte-level pattern; the pre-tokens cover the texts.

    The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
    """
    if not len(points):
        return np.zeros(0, np.int64)
    kinds, border, starts, ends = _runs(points, firsts, library)
    space = kinds[starts] == SPACE
    begins = np.zeros(len(points) + 1, bool)
    begins[starts[space]] = True
    # White space before a word leaves its last character to the word or on its own.
    begins[ends[space & ~border[ends]] - 1] = True
    solid, after = starts[~space], ends[~space]
    joined = (solid > 0) & ~border[solid] & (points[solid - 1] == 0x20)
    begins[solid[~joined]] = True
    at, takes = _contractions(points, kinds, border, solid, after, ~joined)
    begins[at + 1] = False
    rest = at + 1 + takes
    keeps = ~border[rest] & (kinds[np.minimum(rest, len(points) - 1)] == LETTER)
    begins[rest[keeps]] = True
    return np.flatnonzero(begins[:-1])


def lower_case_tokens(points: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each match of ``'s|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+`` in lower-cased text."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds, border, starts, ends = _runs(points, firsts)
    solid = kinds[starts] != SPACE
    starts, ends = starts[solid], ends[solid]
    begins = np.zeros(len(points) + 1, bool)
    begins[starts] = True
    begins[:-1] |= kinds == NUMBER
    at, takes = _contractions(points, kinds, border, starts, ends, np.ones(len(starts), bool))
    begins[at + 1] = False
    rest = at + 1 + takes
    keeps = ~border[rest] & (kinds[np.minimum(rest, len(points) - 1)] == LETTER)
    begins[rest[keeps]] = True
    first = np.flatnonzero(begins[:-1])
    stops = begins.copy()
    stops[:-1] |= kinds == SPACE
    stops |= border
    stops[-1] = True
    stop = np.flatnonzero(stops)
    return first, stop[np.searchsorted(stop, first, "right")]


def distinct_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different span, and for every span the number of its like.

    Two independent 64-bit hashes decide, so that unequal spans are never taken for equal.
    """
    one = span_hashes(buf, starts, ends)
    _, place, like = np.unique(one, return_index=True, return_inverse=True)
    two = span_hashes(buf, starts, ends, 1)
    if not np.array_equal(two[place][like], two):
        both = np.stack([one, two], axis=1)
        _, place, like = np.unique(both, axis=0, return_index=True, return_inverse=True)
    return place, like.ravel()

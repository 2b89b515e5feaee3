"""Quality rules with compression bands.

Text that repeats itself compresses too well, noise hardly compresses. How
well ordinary prose compresses depends on its length, so the limits do, too:
the ratio of bytes to zstandard-compressed bytes must lie in the band of the
document's length, and most of its full chunks of a fixed size in the band of
chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import ragged
from millrace.llm.frames import map_texts

# Upper end of a length band in bytes, and the lowest and highest ratio of ordinary text in it.
BANDS = (
    (512, 1.10, 1.95),
    (1024, 1.20, 2.06),
    (2048, 1.30, 2.24),
    (4096, 1.40, 2.34),
    (8192, 1.50, 2.44),
    (16384, 1.55, 2.52),
    (65536, 1.60, 2.62),
    (2**62, 1.60, 2.90),
)
CHUNK_BYTES = 4096
CHUNK_BAND = (1.40, 2.34)
# Of the full chunks, in per cent, that may lie outside their band.
ODD_CHUNKS_PCT = 25
LEVEL = 3
MIN_WORDS = 50
REPEATED_PCT = 50
SYMBOLS = b"#*$%&|<>"


def signals(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Word, symbol, line and repetition counts of every text."""
    texts = len(offsets) - 1
    starts, ends, firsts = ragged.words(buf, offsets)
    lead = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=lead[1:])
    chars = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lead[ends] - lead[starts], out=chars[1:])
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True
    symbols = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(marks[buf], out=symbols[1:])
    return {
        "n_words": np.diff(firsts),
        "word_chars": np.diff(chars[firsts]),
        "n_symbols": np.diff(symbols[offsets]),
        "n_dup_lines": _repeated_lines(buf, offsets, starts, texts),
        "n_repeat_words": _repeated_words(buf, starts, ends, firsts),
    }


def _repeated_lines(buf, offsets, word_starts, texts):
    breaks = np.flatnonzero(buf == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    filled = np.searchsorted(word_starts, starts) < np.searchsorted(word_starts, ends)
    starts, ends = starts[filled], ends[filled]
    owner = np.searchsorted(offsets, starts, "right") - 1
    keys = ragged.mixed(ragged.span_hashes(buf, starts, ends) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(starts), bool)
    again[first] = False
    return np.bincount(owner[again], minlength=texts)


def _repeated_words(buf, starts, ends, firsts):
    good = np.flatnonzero(ragged.within(firsts, 3))
    covered = np.zeros(int(firsts[-1]) + 1, np.int64)
    if len(good):
        keys = ragged.window_hashes(ragged.span_hashes(buf, starts, ends), 3, 0xD1342543DE82EF95)[good]
        owner = (np.searchsorted(firsts, good, "right") - 1).astype(np.uint64)
        keys = ragged.mixed(keys + owner * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(good), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = good[twice]
        flags = np.zeros(int(firsts[-1]), bool)
        for k in range(3):
            flags[at + k] = True
        np.cumsum(flags, out=covered[1:])
    return np.diff(covered[firsts])


def compression(data: memoryview, compressor, chunk: int) -> tuple[float, list[float]]:
    """Ratio of the whole text and of each full chunk; 0 for an empty text."""
    if not len(data):
        return 0.0, []
    whole = len(data) / len(compressor.compress(data))
    pieces = range(0, len(data) - chunk + 1, chunk)
    return whole, [chunk / len(compressor.compress(data[k : k + chunk])) for k in pieces]


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    bands: tuple = BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    odd_chunks_pct: int = ODD_CHUNKS_PCT,
) -> DataFrame:
    """Signals, compression ratios and the verdict on every text.

    One row for each input row: the base counts, ``base_failed``, ``ratio`` (0
    if empty), ``n_chunks`` (full ones), ``n_odd_chunks`` and ``kept``. A null
    text counts as empty: no words, so it fails. Repeated ids stay one row
    each; other columns are not read. No shuffle.
    """
    tops = np.array([band[0] for band in bands])
    lows = np.array([band[1] for band in bands])
    highs = np.array([band[2] for band in bands])

    def compressor():
        import zstandard

        return zstandard.ZstdCompressor(level=LEVEL)

    def run(batch: pa.RecordBatch, zstd) -> pa.RecordBatch:
        buf, offsets = ragged.column_bytes(batch["text"])
        out = signals(buf, offsets)
        failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEATED_PCT * out["n_words"])
        view = memoryview(np.ascontiguousarray(buf))
        rated = [compression(view[offsets[k] : offsets[k + 1]], zstd, chunk_bytes) for k in range(len(offsets) - 1)]
        ratio = np.array([r for r, _ in rated])
        chunks = np.array([len(c) for _, c in rated], np.int64)
        odd = np.array([sum(not chunk_band[0] <= x <= chunk_band[1] for x in c) for _, c in rated], np.int64)
        band = np.searchsorted(tops, np.diff(offsets), "right")
        fits = (ratio >= lows[band]) & (ratio <= highs[band]) & (100 * odd <= odd_chunks_pct * chunks)
        columns = out | {
            "base_failed": failed,
            "kept": ~failed & fits,
            "ratio": ratio,
            "n_chunks": chunks,
            "n_odd_chunks": odd,
        }
        return pa.record_batch([batch["id"], *map(pa.array, columns.values())], ["doc_id", *columns])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(
        docs,
        {"id": doc_id, "text": text},
        run,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, n_chunks long, n_odd_chunks long",
        setup=compressor,
    )

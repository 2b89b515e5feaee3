"""Packing documents into sequences by minimum bin slack.

A sequence is filled with the fullest combination of the lengths still
available: the longest of them, and with it the subset-sum solution for the
rest of the room, found by dynamic programming on a bit set. The combination
is removed and the next sequence is filled.

Lengths are bounded by the size of a sequence, so all that the driver needs is
the number of pieces of each length: a table of at most ``size`` rows however
many documents there are. A combination is used as many times at once as the
counts allow. Which piece goes where then follows from its number among the
pieces of its length, which a window over small salted groups gives.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from millrace.llm import ragged
from millrace.llm.frames import map_texts, named_inside, written
from millrace.llm.token_counts import MergeRanks, byte_alphabet, merged

# Groups into which the pieces of one length are dealt for numbering.
SALTS = 256
# Bytes of text that are tokenized together; a worker holds some hundred times as much.
TEXT_BYTES = 1 << 20
# Different words whose ids a worker keeps, before it begins anew.
WORDS_REMEMBERED = 500_000
# Code points up to here are lower-cased and split here; other texts go to the tokenizer whole.
_PLAIN_LETTERS = (0x00C0, 0x024F)


class WordTokenizer:
    """Ids of a lower-casing word tokenizer, as its library gives them.

    Texts of plain letters are split here, and each different word is merged
    once and remembered; texts with other characters go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner = np.array([vocab[c] for c in byte_alphabet()], np.int64)
        self.closing = np.array([vocab[c + end] for c in byte_alphabet()], np.int64)
        self.ranks = MergeRanks(*(np.array(ids) for ids in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])))
        lower = np.arange(_PLAIN_LETTERS[1] + 1, dtype=np.uint32)
        plain = np.zeros(0x110000, bool)
        for point in (*range(0x09, 0x0E), *range(0x20, 0x7F), *range(_PLAIN_LETTERS[0], _PLAIN_LETTERS[1] + 1)):
            other = chr(point).lower()
            if len(other) == 1 and ord(other) <= _PLAIN_LETTERS[1]:
                plain[point] = True
                lower[point] = ord(other)
        self.plain, self.lower = plain, lower
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.ids, self.bounds = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def encode_texts(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, without special tokens added, as a flat array with bounds per text."""
        texts = len(offsets) - 1
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(texts + 1, np.int64)
        points, firsts, at = ragged.code_points(buf, offsets)
        odd = np.zeros(len(points) + 1, np.int64)
        np.cumsum(~self.plain[points], out=odd[1:])
        whole = np.diff(odd[firsts]) > 0
        raw = buf.tobytes()
        for special in self.special:
            found = raw.find(special)
            while found >= 0:
                whole[np.searchsorted(offsets, found, "right") - 1] = True
                found = raw.find(special, found + 1)
        ids, bounds = self._by_word(points, firsts, ~whole)
        if not whole.any():
            return ids, bounds
        parts = [ids[bounds[k] : bounds[k + 1]] for k in range(texts)]
        for k in np.flatnonzero(whole):
            text = raw[offsets[k] : offsets[k + 1]].decode("utf-8")
            parts[k] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)
        bounds = np.zeros(texts + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=bounds[1:])
        return np.concatenate(parts), bounds

    def _by_word(self, points, firsts, wanted):
        lengths = np.diff(firsts)
        points = self.lower[np.minimum(points[np.repeat(wanted, lengths)], _PLAIN_LETTERS[1])]
        firsts = np.concatenate([[0], np.cumsum(np.where(wanted, lengths, 0))])
        starts, ends = ragged.lower_case_tokens(points, firsts)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(firsts), np.int64)
        keys, place, like = np.unique(ragged.span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        order = np.argsort(place)
        checks = np.zeros(len(place), np.uint64)
        checks[order] = ragged.span_hashes(points, starts[place[order]], ends[place[order]], 1)
        known = np.searchsorted(self.keys, keys)
        inside = np.minimum(known, max(0, len(self.keys) - 1))
        hit = (self.keys[inside] == keys) & (self.checks[inside] == checks) if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~hit)
        flat, bounds = self._encode_words(points, starts[place[new]], ends[place[new]])
        pool, pool_bounds = np.concatenate([self.ids, flat]), np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
        row = inside.copy()
        row[new] = len(self.keys) + np.arange(len(new))
        ids, per_word = ragged.taken(pool, pool_bounds, row[like.ravel()])
        self._remember(keys[new], checks[new], pool, pool_bounds)
        return ids, per_word[np.searchsorted(starts, firsts)]

    def _encode_words(self, points, starts, ends):
        """Ids of lower-case words: bytes to symbols, the last one closing the word, then all merges."""
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        held = points[np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)]
        wide = held >= 0x80
        at = np.arange(len(held)) + np.cumsum(wide) - wide
        data = np.zeros(len(held) + int(wide.sum()), np.int64)
        data[at] = np.where(wide, 0xC0 | held >> 6, held)
        data[at[wide] + 1] = 0x80 | held[wide] & 0x3F
        bounds = np.append(at[first], len(data)) if len(first) else np.zeros(1, np.int64)
        symbols = self.inner[data]
        symbols[bounds[1:] - 1] = self.closing[data[bounds[1:] - 1]]
        return merged(symbols, bounds, self.ranks)

    def _remember(self, keys, checks, pool, pool_bounds):
        keys, checks = np.concatenate([self.keys, keys]), np.concatenate([self.checks, checks])
        if len(keys) > WORDS_REMEMBERED:
            self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            self.ids, self.bounds = np.zeros(0, np.int64), np.zeros(1, np.int64)
            return
        order = np.argsort(keys, kind="stable")
        self.keys, self.checks = keys[order], checks[order]
        self.ids, self.bounds = ragged.taken(pool, pool_bounds, order)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    words = WordTokenizer(path)
    # The vocabulary file's own objects go.
    ragged.give_back()
    return words


def pieces_of(
    docs: DataFrame,
    path: str,
    size: int = 2048,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Token pieces of every text: (doc_id, row, piece, start, length, ids_crc32 and token_ids if wanted).

    A document is its ids and one closing ``end_id``; only documents longer
    than ``size`` are cut. ``row`` tells rows with equal ids apart.
    """

    def run(batch: pa.RecordBatch, words: WordTokenizer) -> pa.RecordBatch:
        ids, bounds = words.encode_texts(*ragged.column_bytes(batch["text"]))
        owner, piece, start, length, crc, lists = [], [], [], [], [], []
        for k in range(batch.num_rows):
            own = np.append(ids[bounds[k] : bounds[k + 1]], end_id).astype("<u4")
            for n, first in enumerate(range(0, len(own), size)):
                part = own[first : first + size]
                owner.append(k)
                piece.append(n)
                start.append(first)
                length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
                if with_ids:
                    lists.append(part.astype(np.int32))
        out = [
            batch["id"].take(pa.array(owner, pa.int64())),
            batch["row"].take(pa.array(owner, pa.int64())),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(crc, pa.int64()),
        ]
        names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            out.append(pa.array(lists, pa.list_(pa.int32())))
            names.append("token_ids")
        return pa.record_batch(out, names)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, row long, piece int, start long, length long, ids_crc32 long"
    row = named_inside("row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return map_texts(
        numbered,
        {"id": doc_id, "row": row, "text": text},
        run,
        schema + (", token_ids array<int>" if with_ids else ""),
        setup=lambda: tokenizer(path),
        limit=TEXT_BYTES,
    )


def fullest(counts: dict[int, int], size: int) -> dict[int, int]:
    """The longest available length and the combination that fills the rest of the room best."""
    first = max(counts)
    room = size - first
    if not room:
        return {first: 1}
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left = min(counts[length] - (length == first), room // length)
        times = 1
        while left > 0 and not reach >> room & 1:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    out = {first: 1}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            at -= length * times
            out[length] = out.get(length, 0) + times
    return out


def combinations(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Combinations that use up all pieces, each with the number of sequences that hold it."""
    left = {length: n for length, n in counts.items() if n > 0}
    out = []
    while left:
        chosen = fullest(left, size)
        times = min(left[length] // n for length, n in chosen.items())
        out.append((chosen, times))
        for length, n in chosen.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return out


def pack(pieces: DataFrame, size: int = 2048, length: str = "length", order: tuple[str, ...] = ("row", "piece")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``size`` tokens.

    ``pieces`` is read twice (counting, placing): pass a written table. Places
    within a sequence leave no gaps. Ties of equal length are dealt in
    ``order``, which only decides which of the equal places each piece gets.
    An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    salt, number = named_inside("salt"), named_inside("number")
    dealt = pieces.withColumn(salt, F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int"))
    # At most size * SALTS rows, whatever the number of pieces.
    groups = dealt.groupBy(F.col(length).alias("l"), F.col(salt).alias("s")).count().collect()
    counts: dict[int, int] = {}
    ahead = []
    for row in sorted(groups):
        if not 0 < row.l <= size:
            raise ValueError(f"a piece of {row.l} tokens does not fit sequences of {size}")
        ahead.append((row.l, row.s, counts.get(row.l, 0)))
        counts[row.l] = counts.get(row.l, 0) + row["count"]

    used = dict.fromkeys(counts, 0)
    plan: dict[int, list] = {n: [] for n in counts}
    sequence = 0
    for chosen, times in combinations(counts, size):
        offset = 0
        for own, n in sorted(chosen.items(), reverse=True):
            plan[own].append((used[own], n, times, sequence, offset))
            used[own] += n * times
            offset += own * n
        sequence += times

    places = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("since", "each", "times", "sequence", "offset")]))
    rows = [(own, [s for s in range(SALTS)], parts) for own, parts in plan.items()]
    known = {(own, s): before for own, s, before in ahead}
    rows = [(own, [known.get((own, s), 0) for s in salts], parts) for own, salts, parts in rows]
    schema = T.StructType(
        [T.StructField("l", T.LongType()), T.StructField("ahead", T.ArrayType(T.LongType())), T.StructField("plan", places)]
    )
    table = spark.createDataFrame(rows, schema)
    ranked = dealt.withColumn(
        number, F.row_number().over(Window.partitionBy(length, salt).orderBy(*order)).cast("long") - 1
    )
    # The table has at most ``size`` rows.
    joined = ranked.join(F.broadcast(table), F.col(length) == F.col("l"))
    number_of = F.col(number) + F.element_at("ahead", F.col(salt) + 1)
    place = F.element_at(F.filter("plan", lambda p: p["since"] <= number_of), -1)
    inner = number_of - place["since"]
    return joined.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        (place["sequence"] + F.pmod(inner, place["times"])).alias("sequence_id"),
        (place["offset"] + F.expr(f"`{length}`") * F.floor(inner / place["times"]).cast("long")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Pieces of all texts with their places: ``pieces_of`` written once, then ``pack``.

    A null text counts as empty and is one piece of one token. Repeated ids are
    separate documents. Other columns are not read. The rows of ids are written
    only on request; ``sequences`` turns them into training sequences.
    """
    parts = written(pieces_of(docs, path, size, end_id, doc_id, text, with_ids), "pieces")
    return pack(parts, size).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, token_ids) of packed pieces with their ids; a group holds at most one sequence of tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "token_ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["token_ids"])).alias("token_ids"))

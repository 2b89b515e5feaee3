"""Line deduplication by a segment-partition edit join.

Two lines within an edit distance of t agree in one of the t + 1 segments into
which one of them is cut, moved by no more than the edits before it. Every
different line indexes its segments by length, number and content, and probes
the indexes of its own and of slightly shorter lengths with the few substrings
that such a match can have. Lines that meet are compared by parity sketches of
their character pairs and verified by a banded bit-parallel edit distance.
Of the lines that are connected, the first stays.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm import meetings, ragged
from millrace.llm.components import components
from millrace.llm.frames import map_texts, named_inside, only_wanted, written

# Edits within which lines are near copies.
EDITS = 3
# Shorter lines, in code points, are only compared exactly.
MIN_LENGTH = 24
LINES_PER_BUCKET = 6_000
SLICE_BYTES = 2 << 20
SKETCH_BITS = 256
# Code points of lines whose signatures are made together.
SIGNED_AT_ONCE = 1 << 18
# Lines that are sketched together: what a step holds fits into a cache.
LINES_AT_ONCE = 512
# Pairs that are verified together, their code points, and below how many they are taken one by one.
PAIRS_AT_ONCE, POINTS_AT_ONCE, FEW_PAIRS = 8192, 2_000_000, 16
_MULTIPLIER = 0x9FB21C651E98DF25


def lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and number of every \\n-split line that holds more than white space."""
    breaks = np.flatnonzero(buf == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    counts = np.diff(np.searchsorted(breaks, offsets)) + 1
    owner = np.repeat(np.arange(len(offsets) - 1), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    solid = np.zeros(len(buf) + 1, np.int32 if len(buf) < 2**31 - 1 else np.int64)
    np.cumsum(~ragged.IS_SPACE[buf], out=solid[1:])
    filled = solid[starts] < solid[ends]
    return starts[filled], ends[filled], owner[filled], number[filled]


def line_names(buf, starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of every line; the first is not negative as a signed number."""
    one, two = ragged.families_of_hashes(buf, starts, ends, (0, 1))
    return (one >> np.uint64(1)).view(np.int64), two.view(np.int64)


def _first_names(buf, starts, ends) -> np.ndarray:
    return (ragged.span_hashes(buf, starts, ends) >> np.uint64(1)).view(np.int64)


def _occurrences(docs: DataFrame) -> DataFrame:
    """Lines of every row; ``of`` tells different texts under one id apart."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = ragged.column_bytes(batch["text"])
        starts, ends, owner, number = lines(buf, offsets)
        one, two = line_names(buf, starts, ends)
        rows = pa.array(owner, pa.int64())
        columns = [batch["id"].take(rows), batch["of"].take(rows), pa.array(number, pa.int32()), pa.array(one), pa.array(two)]
        return pa.record_batch(columns, ["doc_id", "of", "line_no", "one", "two"])

    named = docs.withColumn("of", F.xxhash64("text"))
    return map_texts(named, {"id": "doc_id", "of": "of", "text": "text"}, run, "doc_id long, of long, line_no int, one long, two long")


def different_lines(buf, offsets, least: int):
    """Code points, bounds and name of each different line of a slice with ``least`` code points or more."""
    starts, ends, _, _ = lines(buf, offsets)
    one = _first_names(buf, starts, ends)
    one, place = np.unique(one, return_index=True)
    # No line has more code points than bytes.
    long = ends[place] - starts[place] >= least
    one, place = one[long], place[long]
    order = np.argsort(place)
    one, starts, ends = one[order], starts[place[order]], ends[place[order]]
    held = ragged.spans_held(buf, starts, ends)
    inner = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=inner[1:])
    points, bounds = ragged.points_of_spans(held, inner)
    long = np.flatnonzero(np.diff(bounds) >= least)
    if len(long) < len(one):
        points, bounds = ragged.taken(points, bounds, long)
    return points, bounds, one[long]


def _point_values(points: np.ndarray) -> np.ndarray:
    """A random value of every code point."""
    most = int(points.max()) + 1 if len(points) else 0
    if most <= len(points):
        return ragged.mixed(np.arange(77, 77 + most, dtype=np.uint64))[points]
    return ragged.mixed(points.astype(np.uint64) + np.uint64(77))


def signatures(points: np.ndarray, bounds: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, line, role): indexed segments, and the substrings that probe for them."""
    # Parts of lines, one line at least.
    cuts = [0, *(np.flatnonzero(np.diff(bounds[1:] // SIGNED_AT_ONCE)) + 1).tolist(), len(bounds) - 1]
    found = [(a, _some_signatures(points[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], edits)) for a, b in zip(cuts[:-1], cuts[1:])]
    names, owner, role = zip(*((names, owner + a, role) for a, (names, owner, role) in found))
    return np.concatenate(names), np.concatenate(owner), np.concatenate(role)


def _some_signatures(points, bounds, edits: int):
    values = _point_values(points)
    total = np.zeros(len(points) + 1, np.uint64)
    scale = ragged.powers(_MULTIPLIER, len(points) + 1)
    inverse = ragged.powers(pow(_MULTIPLIER, -1, 2**64), len(points) + 1)
    values *= scale[: len(points)]
    np.cumsum(values, out=total[1:])
    del values
    lengths = np.diff(bounds)
    parts = edits + 1
    out: list[tuple[np.ndarray, np.ndarray, int]] = []

    def content(at, size, length, segment):
        sums = (total[at + size] - total[at]) * inverse[at]
        return ragged.mixed(sums + ragged.mixed((length.astype(np.uint64) << np.uint64(8)) + np.uint64(segment)))

    def segment_of(length, k):
        """Start and size of segment k of a line of a length; the last ones are longer by one."""
        size, longer = length // parts, length % parts
        start = k * size + np.maximum(0, k - (parts - longer))
        return start, size + (k >= parts - longer)

    every = np.arange(len(lengths), dtype=np.int32)
    for k in range(parts):
        start, size = segment_of(lengths, k)
        out.append((content(bounds[:-1] + start, size, lengths, k), every, meetings.INDEX))
        for fewer in range(edits + 1):
            length = lengths - fewer
            start, size = segment_of(length, k)
            low = np.maximum(0, np.maximum(start - k, start + fewer - (edits - k)))
            high = np.minimum(lengths - size, np.minimum(start + k, start + fewer + (edits - k)))
            for step in range(2 * edits + 1):
                ok = np.flatnonzero((low + step <= high) & (length > 0))
                if len(ok):
                    at = bounds[ok] + low[ok] + step
                    out.append((content(at, size[ok], length[ok], k), ok.astype(np.int32), meetings.PROBE))
    return (
        np.concatenate([x for x, _, _ in out]),
        np.concatenate([x for _, x, _ in out]),
        np.concatenate([np.full(len(x), role, np.uint8) for x, _, role in out]),
    )


def pair_sketches(points, bounds):
    """Sketches of each line's adjacent pairs; an edit changes at most four of them."""
    parts = [_some_pair_sketches(points, bounds[k : k + LINES_AT_ONCE + 1]) for k in range(0, len(bounds) - 1, LINES_AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros((0, SKETCH_BITS // 8), np.uint8)


def _some_pair_sketches(points, bounds):
    lengths = np.diff(bounds)
    values = _point_values(points[bounds[0] : bounds[-1]])
    pairs = values[:-1] * np.uint64(_MULTIPLIER)
    pairs += values[1:]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inner = owner[1:] == owner[:-1]
    return meetings.sketches(pairs[inner], owner[:-1][inner], len(lengths), SKETCH_BITS)


def within_edits(one: str, two: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``.

    The bits of a word of 2 * edits + 1 are the diagonals of the band around
    the main one; each row of the matrix updates them with a few operations.
    """
    if len(one) > len(two):
        one, two = two, one
    if len(two) - len(one) > edits:
        return False
    # What both begin and end with is no edit.
    start, end = 0, 0
    while start < len(one) and one[start] == two[start]:
        start += 1
    while end < len(one) - start and one[-1 - end] == two[-1 - end]:
        end += 1
    one, two = one[start : len(one) - end], two[start : len(two) - end]
    if not one or not two:
        return len(two) + len(one) <= edits
    width = 2 * edits + 1
    band = (1 << width) - 1
    masks: dict[str, int] = {}
    for n in range(min(edits, len(two))):
        masks[two[n]] = masks.get(two[n], 0) | 1 << (n + edits + 1)
    # reach[e]: diagonals on which some prefix pair ends within e edits after this row.
    reach = [0] * (edits + 1)
    for e in range(edits + 1):
        reach[e] = ((1 << (e + 1)) - 1) << edits & band
    for row, char in enumerate(one):
        # Move the window of ``two`` one place on.
        for key in list(masks):
            masks[key] >>= 1
            if not masks[key]:
                del masks[key]
        ahead = row + edits
        if ahead < len(two):
            masks[two[ahead]] = masks.get(two[ahead], 0) | 1 << (2 * edits)
        match = masks.get(char, 0)
        last = 0
        after = []
        for e in range(edits + 1):
            now = reach[e] & match
            if e:
                # A changed character, one left out of ``one`` (next diagonal down), one left out of ``two``.
                now |= reach[e - 1] | reach[e - 1] >> 1 | last << 1
            last = now & band
            after.append(last)
        reach = after
        if not reach[edits]:
            return False
    return bool(reach[edits] >> (len(two) - len(one) + edits) & 1)


def pairs_within_edits(contents: list[bytes], a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """``within_edits`` of many pairs of UTF-8 texts, given by their places."""
    width = 2 * edits + 1
    out = np.zeros(len(a), bool)
    if not len(a):
        return out
    texts = [x.decode("utf-8") for x in contents]
    if width > 64:
        return np.array([within_edits(texts[x], texts[y], edits) for x, y in zip(a.tolist(), b.tolist())])
    lengths = np.array([len(x) for x in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(lengths) - lengths
    swap = lengths[a] > lengths[b]
    one, two = np.where(swap, b, a), np.where(swap, a, b)
    order = np.argsort(lengths[one], kind="stable")
    order = order[lengths[two[order]] - lengths[one[order]] <= edits]
    begin = 0
    while begin < len(order):
        # The shorter texts come first, so a part takes as many pairs as its last one has room for.
        size = np.arange(1, min(PAIRS_AT_ONCE, len(order) - begin) + 1) * np.maximum(1, lengths[one[order[begin : begin + PAIRS_AT_ONCE]]])
        end = begin + max(1, int(np.searchsorted(size, POINTS_AT_ONCE, "right")))
        now = order[begin:end]
        if len(now) < FEW_PAIRS:
            out[now] = [within_edits(texts[x], texts[y], edits) for x, y in zip(one[now].tolist(), two[now].tolist())]
        else:
            out[now] = _banded(points, starts, lengths, one[now], two[now], edits)
        begin = end
    return out


def _banded(points, starts, lengths, one, two, edits: int) -> np.ndarray:
    """The matrix of ``within_edits`` row by row for all pairs; ``one`` is the shorter, in order of length."""
    width = 2 * edits + 1
    kind = np.uint8 if width <= 8 else np.uint64
    band = kind((1 << width) - 1)
    rows = lengths[one]
    most = int(rows[-1])
    last_point = len(points) - 1
    # Either end, by row; beyond its end a text holds what no other holds.
    at = np.arange(most)[:, None]
    held = np.where(at < rows, points[np.minimum(starts[one] + at, last_point)], np.uint32(0xFFFFFFFF))
    ahead = np.arange(-edits, most + edits)[:, None]
    other = np.where((ahead >= 0) & (ahead < lengths[two]), points[np.clip(starts[two] + ahead, 0, last_point)], np.uint32(0xFFFFFFFE))
    reach = [np.full(len(one), ((1 << (e + 1)) - 1) << edits & int(band), kind) for e in range(edits + 1)]
    out = np.zeros(len(one), bool)
    goal = kind(1) << (lengths[two] - rows + edits).astype(kind)
    done = np.searchsorted(rows, np.arange(most + 1), "right")
    start = int(done[0])
    out[:start] = reach[edits][:start] & goal[:start] > 0
    reach = [x[start:] for x in reach]
    for row in range(most):
        match = np.zeros(len(one) - start, kind)
        for q in range(width):
            match |= (held[row, start:] == other[row + q, start:]).astype(kind) << kind(q)
        after = [reach[0] & match]
        for e in range(1, edits + 1):
            after.append(((reach[e] & match) | reach[e - 1] | (reach[e - 1] >> kind(1)) | (after[-1] << kind(1))) & band)
        reach = after
        if not reach[edits].any():
            break
        end = int(done[row + 1])
        if end > start:
            out[start:end] = reach[edits][: end - start] & goal[start:end] > 0
            reach = [x[end - start :] for x in reach]
            start = end
    return out


def _rows(docs: DataFrame, edits: int, buckets: int) -> DataFrame:
    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            chunk += 1
            points, bounds, names = different_lines(*ragged.column_bytes(batch["text"]), max(MIN_LENGTH, edits + 1))
            if len(names):
                tags = (names & 0xFFFFFFFF).astype(np.uint32)
                sketch = pair_sketches(points, bounds)
                yield from meetings.packed(chunk, buckets, names, np.diff(bounds), sketch, *signatures(points, bounds, edits), tags)

    return docs.select("text").mapInArrow(run, meetings.PACKED)


def _texts(docs: DataFrame, occurrences: DataFrame):
    """Texts of wanted lines, each from its first document."""

    def contents(wanted: DataFrame) -> DataFrame:
        where = occurrences.join(wanted.withColumnRenamed("item", "one"), "one", "left_semi")
        where = where.groupBy("one").agg(F.min("doc_id").alias("doc_id"))
        where = written(where.groupBy("doc_id").agg(F.collect_set("one").alias("names")), "where")

        def run(batches):
            for batch in ragged.slices(batches, "text"):
                buf, offsets = ragged.column_bytes(batch["text"])
                starts, ends, owner, _ = lines(buf, offsets)
                names = _first_names(buf, starts, ends)
                asked, bounds = ragged.flattened(batch["names"].to_pylist())
                pairs = {(k, x) for k in range(batch.num_rows) for x in asked[bounds[k] : bounds[k + 1]].tolist()}
                raw, items, texts = buf.tobytes(), [], []
                for n, key in enumerate(zip(owner.tolist(), names.tolist())):
                    if key in pairs:
                        pairs.discard(key)
                        items.append(key[1])
                        texts.append(raw[starts[n] : ends[n]])
                yield pa.record_batch([pa.array(items, pa.int64()), pa.array(texts, pa.binary())], ["item", "content"])

        chosen = only_wanted(docs, where).select("text", "names")
        return chosen.mapInArrow(run, "item long, content binary").dropDuplicates(["item"])

    return contents


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS) -> DataFrame:
    """(doc_id, line_no, rep_doc_id, rep_line_no, n_links, kept) of every line that holds a word.

    Lines are cut at \\n and numbered from 0 in their document. Equal lines,
    and lines of MIN_LENGTH code points or more within ``edits`` edits, are
    linked; ``rep_*`` is the first line (by document, then number) that links
    lead to, and only that one is kept. ``n_links`` counts all links of
    the line's text to other texts. Documents with a null id and blank lines have no rows; rows
    with equal ids count as one document. Names of lines have 127 bits, 63 of
    them in the join.
    """
    return _judged_lines(docs, doc_id, text, edits).drop("of")


def _judged_lines(docs: DataFrame, doc_id: str, text: str, edits: int) -> DataFrame:
    """The rows of ``classes``, and in ``of`` the hash of the text that each line stands in."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("doc_id IS NOT NULL")
    occurrences = written(_occurrences(docs), "lines")
    total = occurrences.count()
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / LINES_PER_BUCKET))
    bound = meetings.Bound(SKETCH_BITS, 1, 0, 4 * edits, edits)

    def linked(one: bytes, two: bytes) -> bool:
        return within_edits(one.decode("utf-8"), two.decode("utf-8"), edits)

    def judged(contents: pa.ChunkedArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return pairs_within_edits(contents.to_pylist(), a, b, edits)

    links, counted = meetings.counted_links(_rows(docs, edits, buckets), bound, _texts(docs, occurrences), linked, judged)
    counted = written(counted.select(F.col("item").alias("one"), F.col("n").alias("n_links")), "counts")
    member = components(links).withColumnRenamed("node", "one").join(counted, "one")
    firsts = occurrences.groupBy("one", "two").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n"))
    joined = firsts.join(member, "one", "left")
    least = joined.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("least"))
    joined = joined.join(least, "component", "left").filter("n > 1 OR component IS NOT NULL")
    special = written(joined.select("one", "two", F.coalesce("least", "first").alias("rep"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "special")
    own = F.struct("doc_id", "line_no")
    out = occurrences.join(special, ["one", "two"], "left").withColumn("rep", F.coalesce("rep", own))
    return out.select(
        "doc_id",
        "of",
        "line_no",
        F.col("rep.doc_id").alias("rep_doc_id"),
        F.col("rep.line_no").alias("rep_line_no"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (own == F.col("rep")).alias("kept"),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS) -> DataFrame:
    """The rows of ``docs`` without the lines that are not kept; other lines, blank ones too, stay as they are.

    Columns keep their names and types, whatever they are called. Of rows with
    one id and different texts each loses its own lines only. Rows with a null
    id or text stay as they are; an empty table stays empty.
    """
    dropped = _judged_lines(docs, doc_id, text, edits).filter(~F.col("kept"))
    of, same, gone = named_inside("of"), named_inside("text"), named_inside("gone")
    dropped = dropped.groupBy(F.col("doc_id").alias(of), F.col("of").alias(same)).agg(F.collect_set("line_no").alias(gone))
    left = F.filter(F.split(F.col(f"`{text}`"), "\n", -1), lambda line, at: ~F.array_contains(gone, at))
    joined = docs.join(dropped, (F.col(f"`{doc_id}`").cast("long") == F.col(of)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(same)), "left")
    out = F.when(F.col(gone).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(left, "\n"))
    return joined.select(*[out.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])

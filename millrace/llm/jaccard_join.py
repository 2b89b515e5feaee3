"""N-gram Jaccard join by partitioning the universe of shingles.

Sets of similar size share a scheme: their shingles are hashed into one segment
more than the shingles in which two linked sets may differ, so a linked pair
agrees in at least one segment. Every set indexes the content of all its
segments, and for a part of the segments also the content with any one shingle
left out. A set looks for sets of its own size band and of the bands below; a
cost model chooses which of its segments it probes: each probed segment counts
one difference, and a probe that also allows one deletion counts two, so empty
and tiny segments, which many sets have in common, are avoided. Sets that meet
are compared by a lower bound of their difference and then exactly.

Documents with the very same set are one class with one member in the join.
How candidates meet and are verified is in ``meetings``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm import meetings, ragged
from millrace.llm.components import components
from millrace.llm.frames import map_texts, only_wanted, written

SHINGLE = 5
# Linked: 100 * intersection >= PERCENT * union.
PERCENT = 80
SKETCH_BITS = 512
SLICE_BYTES = 2 << 20
WORDS_PER_BUCKET = 250_000
# One segment in so many is also indexed with one shingle left out.
DELETION_EVERY = 16
# Cost of probing a segment with 0, 1, 2, ... shingles, with and without one deletion.
COST = np.array([400, 40, 4, 2, 1], np.int64)
_ROLL = 0x9FB21C651E98DF25
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def size_bands(percent: int) -> list[tuple[int, int]]:
    """Size bands: no set is linked with one more than a band away."""
    out, low = [], 1
    while low < 2**40:
        high = max(low, low * 100 // percent)
        out.append((low, high))
        low = high + 1
    return out


class Scheme:
    """Bands, segments and differences for one threshold."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bands = size_bands(percent)
        self.lows = np.array([low for low, _ in self.bands])
        self.highs = np.array([high for _, high in self.bands])
        # The larger set has at most 100 / percent times as many.
        self.segments = self.differences(self.highs, self.highs * 100 // percent) + 1

    def differences(self, one, two):
        """Most shingles in which linked sets of these sizes differ."""
        return (100 - self.percent) * (one + two) // (100 + self.percent)

    def band(self, sizes):
        return np.searchsorted(self.lows, sizes, "right") - 1


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of every text, ascending, as a flat array with bounds."""
    buf = _LOWER[buf]
    starts, ends, firsts = ragged.words(buf, offsets)
    counts = np.diff(firsts)
    values = ragged.span_hashes(buf, starts, ends)
    at = np.flatnonzero(ragged.within(firsts, size))
    hashes, owner = [ragged.window_hashes(values, size, _ROLL)[at]], [np.searchsorted(firsts, at, "right") - 1]
    for short in range(1, size):
        texts = np.flatnonzero(counts == short)
        if len(texts):
            hashes.append(ragged.mixed(ragged.window_hashes(values, short, _ROLL)[firsts[texts]] + np.uint64(short)))
            owner.append(texts)
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
        hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(offsets)))


def _sums(values, bounds):
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, one, two): the size of every text's set and two 64-bit sums that tell sets apart."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, bounds = shingle_sets(*ragged.column_bytes(batch["text"]), size)
        one = _sums(ragged.mixed(hashes), bounds).view(np.int64)
        two = _sums(ragged.mixed(hashes ^ np.uint64(_ROLL)), bounds).view(np.int64)
        return pa.record_batch([batch["id"], pa.array(np.diff(bounds)), pa.array(one), pa.array(two)], ["doc_id", "n_shingles", "one", "two"])

    chosen = docs.withColumn(doc_id, F.col(f"`{doc_id}`").cast("long"))
    return map_texts(chosen, {"id": doc_id, "text": text}, run, "doc_id long, n_shingles long, one long, two long")


def _segmented(hashes, owner, sizes, bands, scheme):
    """Content sums and counts of all segments of the given sets in the given bands.

    Returns flat arrays over (set, segment): content, count, and each set's first
    segment; and for every shingle the place of its segment.
    """
    per_set = scheme.segments[bands]
    first = np.cumsum(per_set) - per_set
    seeds = ragged.mixed(bands.astype(np.uint64) + np.uint64(1))
    where = first[owner] + ((ragged.mixed(hashes ^ seeds[owner]) >> np.uint64(24)) % per_set[owner].astype(np.uint64)).astype(np.int64)
    total = int(per_set.sum())
    order = np.argsort(where, kind="stable")
    spread = ragged.mixed(hashes + np.uint64(0x632BE59BD9B4E019))
    content = np.zeros(total, np.uint64)
    count = np.bincount(where, minlength=total)
    filled = np.flatnonzero(count)
    begin = np.cumsum(count[filled]) - count[filled]
    if len(filled):
        content[filled] = np.add.reduceat(spread[order], begin)
    return content, count, first, per_set, where, spread


def _named(content, segment, band):
    """Signature of a segment's content within its scheme."""
    return ragged.mixed(content + ragged.mixed((band.astype(np.uint64) << np.uint64(32)) + segment.astype(np.uint64)))


def signatures(hashes, bounds, scheme):
    """(signature, set, role) of all sets; role 1 is an index entry, 2 a probe."""
    sizes = np.diff(bounds)
    some = np.flatnonzero(sizes)
    out: list[tuple[np.ndarray, np.ndarray, int]] = []
    bands = scheme.band(sizes)
    step = 0
    while len(some):
        # Sets that may find sets ``step`` bands below their own.
        target = bands - step
        least = -(-sizes * scheme.percent // 100)
        ok = some[(target[some] >= 0) & (scheme.highs[np.maximum(target[some], 0)] >= least[some])]
        if not len(ok):
            break
        held, inner = ragged.taken(hashes, bounds, ok)
        owner = np.repeat(np.arange(len(ok)), np.diff(inner))
        band = target[ok]
        content, count, first, per_set, where, spread = _segmented(held, owner, sizes[ok], band, scheme)
        of = np.repeat(np.arange(len(ok)), per_set)
        segment = np.arange(len(of)) - first[of]
        names = _named(content, segment, band[of])
        apart = segment % DELETION_EVERY == 0
        deleted = apart[where]
        at = where[deleted]
        fewer = _named(content[at] - spread[deleted], segment[at], band[of[at]])
        if step == 0:
            out.append((names, ok[of], meetings.INDEX))
            out.append((fewer, ok[of[at]], meetings.INDEX))
        # What linked sets of these sizes may differ by, and one more.
        needed = scheme.differences(np.minimum(scheme.highs[band], sizes[ok]), sizes[ok]) + 1
        plain = COST[np.minimum(count, len(COST) - 1)]
        more = np.where(apart & (count > 1), count + COST[np.clip(count - 1, 0, len(COST) - 1)] + plain, 0)
        unit_set = np.concatenate([of, of[more > 0]])
        unit_cost = np.concatenate([plain, more[more > 0]])
        unit_at = np.concatenate([np.arange(len(of)), np.flatnonzero(more)])
        order = np.lexsort((unit_cost, unit_set))
        begin = np.searchsorted(unit_set[order], np.arange(len(ok)))
        rank = np.arange(len(order)) - begin[unit_set[order]]
        chosen = order[rank < needed[unit_set[order]]]
        probed = np.zeros(len(of), bool)
        probed[unit_at[chosen[chosen < len(of)]]] = True
        wide = np.zeros(len(of), bool)
        wide[unit_at[chosen[chosen >= len(of)]]] = True
        probed |= wide
        out.append((names[probed], ok[of[probed]], meetings.PROBE))
        out.append((fewer[wide[at]], ok[of[at[wide[at]]]], meetings.PROBE))
        step += 1
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return (
        np.concatenate([x for x, _, _ in out]),
        np.concatenate([x for _, x, _ in out]),
        np.concatenate([np.full(len(x), role, np.uint32) for x, _, role in out]),
    )


def _rows(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    def run(batches):
        scheme = Scheme(percent)
        chunk = TaskContext.get().partitionId() << 32
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            chunk += 1
            hashes, bounds = shingle_sets(*ragged.column_bytes(batch["text"]), size)
            sizes = np.diff(bounds)
            sketch = meetings.sketches(hashes, np.repeat(np.arange(len(sizes)), sizes), len(sizes), SKETCH_BITS)
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            yield from meetings.packed(chunk, buckets, ids, sizes, sketch, *signatures(hashes, bounds, scheme))

    return docs.select("doc_id", "text").mapInArrow(run, meetings.PACKED)


def _sets(docs: DataFrame, size: int):
    """Shingle sets of wanted documents, packed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, bounds = shingle_sets(*ragged.column_bytes(batch["text"]), size)
        raw = hashes.tobytes()
        contents = [raw[8 * a : 8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return pa.record_batch([batch["item"], pa.array(contents, pa.binary())], ["item", "content"])

    def contents(wanted: DataFrame) -> DataFrame:
        chosen = only_wanted(docs, wanted.withColumnRenamed("item", "doc_id"), "left_semi")
        return map_texts(chosen, {"item": "doc_id", "text": "text"}, run, "item long, content binary")

    return contents


def linked_sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, buckets: int = 64) -> DataFrame:
    """(a, b): verified links between (doc_id, text) rows that connect all that are linked."""

    def linked(one: bytes, two: bytes) -> bool:
        x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * shared >= percent * (len(x) + len(y) - shared)

    bound = meetings.Bound(SKETCH_BITS, 100 + percent, 100 - percent, 0)
    return meetings.links(_rows(docs, size, percent, buckets), bound, _sets(docs, size), linked)


def classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Lower-cases A-Z; a text with fewer than ``size`` words has its whole
    sequence of words as its one shingle; without words the set is empty and
    the row is its own component. Rows with equal ids count as one document
    with several texts. A null id keeps its count and has no component.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    digests = written(set_digests(docs, size=size), "digests")
    total = digests.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first().n
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / WORDS_PER_BUCKET))
    key = ["one", "two", "n_shingles"]
    same = digests.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("first"), F.count("*").alias("c"))
    # Written, so that the join has a shuffle on either side and Spark can split a set with very many copies.
    same = written(same.filter("c > 1").drop("c"), "firsts")
    flagged = digests.join(same, key, "left")
    flagged = written(flagged.select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("first")), "classes")
    settled = flagged.groupBy("doc_id").agg(F.min(F.col("doc_id") > F.col("first")).alias("copy")).filter("copy").select("doc_id")
    settled = written(settled, "settled")
    members = docs.filter(F.col("doc_id").isNotNull()).join(settled, "doc_id", "left_anti")
    links = linked_sets(members, size, percent, buckets)
    # A repeated id ties the classes of its texts together.
    again = flagged.filter("doc_id > first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    again = again.join(settled.withColumnRenamed("doc_id", "a"), "a", "left_anti")
    found = components(links.union(again))
    joined = flagged.join(found.withColumnRenamed("node", "first"), "first", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"))

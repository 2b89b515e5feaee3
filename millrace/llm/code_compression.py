"""Compression of vectors to short codes, with nearest entries found by sliced bit masks.

Vectors are cut into parts, each with a codebook of its own. For every
dimension of a part the entries' coordinates are sorted, and every place in
that order carries a mask of the entries before it. An entry at hand gives an
initial radius; in each dimension the radius selects a range of coordinates,
whose entries are the difference of two prefix masks. The masks of all
dimensions, ANDed, are exactly the entries in the box around the vector, among
them every entry as near as the one at hand. Their exact distances decide.

A round reads the vectors once; tasks hand on sums per entry and component, so
the driver sees no more than the codebooks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm.frames import named_inside, written
from millrace.llm.integer_vectors import Sums, by_length, exact, group_sums, integers, largest, longs, moved

PARTS = 4
ENTRIES = 256
ROUNDS = 4
FACTOR = 1024
# Entries next to a vector in the widest dimension, which give the radius.
NEIGHBOURS = 8
# Boxes that hold more than this share of all entries are compared as one matrix.
DENSE = 0.05


class Slices:
    """Sorted coordinates and prefix masks of one codebook."""

    def __init__(self, entries: list[list[int]]):
        self.whole = np.array(entries, object).reshape(len(entries), -1)
        self.most = max((abs(v) for v in self.whole.ravel()), default=0)
        self.small = self.whole.astype(np.float64)
        count, width = self.whole.shape
        words = -(-count // 64)
        bits = np.zeros((count, words), np.uint64)
        bits[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (np.arange(count) % 64).astype(np.uint64)
        self.order = [np.argsort(self.whole[:, d], kind="stable") for d in range(width)]
        self.sorted = [self.whole[o, d] for d, o in enumerate(self.order)]
        none = np.zeros((1, words), np.uint64)
        self.prefixes = [np.concatenate([none, np.bitwise_or.accumulate(bits[o], axis=0)]) for o in self.order]
        self.widest = int(np.argmax(self.small.std(axis=0))) if width else 0

    def bound(self, most: int) -> int:
        return 8 * max(self.most, most, 1) ** 2 * max(self.whole.shape[1], 1)

    def masks(self, rows: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Bit masks of the entries in the box of ``radius`` around each row."""
        small = rows.dtype != object
        out = np.broadcast_to(self.prefixes[0][-1], (len(rows), self.prefixes[0].shape[1])).copy()
        for d, prefix in enumerate(self.prefixes):
            line = self.sorted[d].astype(np.float64) if small else self.sorted[d]
            first = np.searchsorted(line, rows[:, d] - radius, "left")
            last = np.searchsorted(line, rows[:, d] + radius, "right")
            out &= prefix[last] & ~prefix[first]
        return out

    def radius(self, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """A whole radius around each row that reaches the nearest of a few entries at hand."""
        d = self.widest
        line = self.sorted[d].astype(rows.dtype)
        at = np.searchsorted(line, rows[:, d])[:, None] + np.arange(-(NEIGHBOURS // 2), NEIGHBOURS - NEIGHBOURS // 2)
        near = self.order[d][np.clip(at, 0, len(line) - 1)]
        best = ((rows[:, None, :] - entries[near]) ** 2).sum(axis=2).min(axis=1)
        if rows.dtype == object:
            return np.array([math.isqrt(v) for v in best], object)
        return np.floor(np.sqrt(best)) + 1

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the nearest entries, smaller ones first, and exact squared distances of int64 rows."""
        rows = exact(rows, self.bound(largest(rows)))
        entries = self.whole if rows.dtype == object else self.small
        if not rows.shape[1]:
            return np.zeros(len(rows), np.int64), np.zeros(len(rows))
        masks = self.masks(rows, self.radius(rows, entries))
        held = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : len(entries)].astype(bool)
        if rows.dtype != object and held.mean() > DENSE:
            far = (rows * rows).sum(axis=1)[:, None] + (entries * entries).sum(axis=1) - 2 * (rows @ entries.T)
            far[~held] = np.inf
            index = far.argmin(axis=1)
            return index, far[np.arange(len(rows)), index]
        row, entry = np.nonzero(held)
        far = ((rows[row] - entries[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(rows)))
        best = np.minimum.reduceat(far, starts)
        winners = np.flatnonzero(far == best[row])
        first = winners[np.unique(row[winners], return_index=True)[1]]
        return entry[first], best


def _common_size(kept: DataFrame, parts: int) -> int | None:
    """The most common length that the parts divide; of equally common ones the shortest."""
    sizes = kept.groupBy(F.size("vec").alias("size")).count().filter((F.col("size") > 0) & (F.col("size") % parts == 0))
    found = sizes.orderBy(F.desc("count"), "size").limit(1).collect()
    return found[0]["size"] if found else None


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    factor: int = FACTOR,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    Vectors that are null, empty or hold null or non-finite components take no
    part; of several lengths only the most common one does that the parts
    divide. Codebooks start from the smallest ids (equal ids in the order of
    their components, null ids never); with fewer ids they are shorter, with
    none the result is empty. Repeated rows count as often as they stand. Rows
    with a null label share one sum. Scaled components beyond 2^62 count as
    that, errors beyond a long as the largest long. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index takes two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    rows = written(integers(vectors, factor, vec_id, embedding, label=label), "vectors")
    kind = rows.schema["label"].dataType
    size = _common_size(rows, parts)
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if size is None:
        return spark.createDataFrame([], schema)
    width = size // parts
    kept = rows.filter(F.size("vec") == size)
    first = kept.filter("vec_id IS NOT NULL").orderBy("vec_id", "vec").select("vec").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], schema)
    books = [[list(row["vec"][p * width : (p + 1) * width]) for row in first] for p in range(parts)]

    def pieces(matrix):
        return [matrix[:, p * width : (p + 1) * width] for p in range(parts)]

    def gathered(books):
        def run(batches):
            slices = [Slices(book) for book in books]
            sums = [Sums(len(book), width) for book in books]
            for batch in batches:
                for _, matrix in by_length(batch["vec"]):
                    for part, one, total in zip(pieces(matrix), slices, sums):
                        total.add(one.nearest(part)[0], exact(part, largest(part) * 2**20))
            for p, total in enumerate(sums):
                yield total.table(p * entries)

        return run

    for _ in range(rounds):
        sums = group_sums(kept.select("vec"), gathered(books))
        books = [moved(book, sums, p * entries) for p, book in enumerate(books)]

    def coded(batches):
        slices = [Slices(book) for book in books]
        for batch in batches:
            for at, matrix in by_length(batch["vec"]):
                found = [one.nearest(part) for part, one in zip(pieces(matrix), slices)]
                index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
                codes = [row.tobytes().hex() for row in index]
                errors = sum((longs(far).astype(object) for _, far in found), np.zeros(len(at), object))
                at = pa.array(at)
                columns = [batch["vec_id"].take(at), batch["label"].take(at), pa.array(codes, pa.string()), pa.array(longs(errors), pa.int64())]
                yield pa.record_batch(columns, ["vec_id", "label", "code", "error"])

    fields = [StructField("vec_id", LongType()), StructField("label", kind), StructField("code", StringType()), StructField("error", LongType())]
    out = written(kept.mapInArrow(coded, StructType(fields)), "codes")
    # The sums are a table of their own, so that a label with most rows may be split in the join.
    name = named_inside("label")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    sums = written(out.groupBy(F.col("label").alias(name)).agg(total.alias("label_error")), "labels")
    told = ",".join(str(v) for book in books for entry in book for v in entry)
    digest = hashlib.sha256(told.encode()).hexdigest()
    joined = out.join(sums, out["label"].eqNullSafe(sums[name]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))

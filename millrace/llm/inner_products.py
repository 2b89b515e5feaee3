"""Exact top-k search by inner product, over vectors in order of their lengths.

Vectors become whole numbers and are turned into the singular directions of a
sample, so that the first dimensions carry most of a product. Candidates stand
in bands of descending norm, cut into blocks. A query leaves a band out if its
norm times the band's largest stays below the score it already has; within a
block it meets candidates by descending norm, and after each group of
dimensions the Cauchy-Schwarz bound on what remains, |q_rest| |c_rest|, drops
those that cannot reach that score. What is left is scored in exact integers.

Turned values only prune, with room for their rounding; the sample decides
nothing but speed. A candidate moves once for every QUERIES_PER_TURN queries;
queries stream past the block that a task holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.frames import written
from millrace.llm.integer_vectors import by_length, exact, integers, largest, longs

FACTOR = 256
# Vectors from which directions and bands are taken, at most; they change no result.
FIT_ROWS = 8192
BANDS = 32
# Rows of the band of largest norms, which every query meets first, and of a block of the other bands.
HEAD_ROWS = 16384
BLOCK_ROWS = 32768
QUERIES_PER_TURN = 262144
COLUMN_BLOCK = 16
FIRST_CANDIDATES = 64
MOST_CANDIDATES = 2048
# Below this share of pairs still open, they are looked at one by one.
SPARSE = 0.05
PAIRS = 65536
# Room for rounding in bounds, as a share of the product of norms.
ROOM = 1e-9


class Turned:
    """Vectors of one length, as they are and turned, with the norms of what is left after each group of dimensions."""

    def __init__(self, rows: np.ndarray, directions: np.ndarray | None):
        self.rows = rows
        plain = rows.astype(np.float64)
        self.values = plain @ directions if directions is not None and len(directions) == rows.shape[1] else plain
        self.bounds = [*range(0, rows.shape[1], COLUMN_BLOCK), rows.shape[1]]
        squares = self.values * self.values
        self.rests = np.sqrt(np.stack([squares[:, b:].sum(axis=1) for b in self.bounds]))
        self.norms = self.rests[0]


def exact_scores(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of int64 rows, pair by pair, as longs."""
    bound = max(largest(one), 1) * max(largest(other), 1) * max(one.shape[1], 1)
    return longs((exact(one, bound) * exact(other, bound)).sum(axis=1))


def open_pairs(asked: Turned, who: np.ndarray, held: Turned, where: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of queries ``who`` and candidates ``where`` whose products may reach the queries' limits."""
    partial = np.zeros((len(who), len(where)))
    bars = limits[who][:, None] - ROOM * np.outer(asked.norms[who], held.norms[where]) - 1
    for group, (a, b) in enumerate(zip(asked.bounds[:-1], asked.bounds[1:]), 1):
        partial += asked.values[who, a:b] @ held.values[where, a:b].T
        alive = partial + np.outer(asked.rests[group][who], held.rests[group][where]) >= bars
        rows, columns = alive.any(axis=1), alive.any(axis=0)
        if not rows.any():
            break
        if not rows.all() or not columns.all():
            who, where = who[rows], where[columns]
            partial, bars, alive = (x[rows][:, columns] for x in (partial, bars, alive))
        if alive.mean() < SPARSE:
            q, c = np.nonzero(alive)
            return _narrowed(asked, who[q], held, where[c], partial[q, c], bars[q, c], group)
    else:
        q, c = np.nonzero(partial >= bars)
        return who[q], where[c]
    return who[:0], where[:0]


def _narrowed(asked, who, held, where, partial, bars, group):
    """The remaining dimensions of single pairs."""
    for number in range(group + 1, len(asked.bounds)):
        a, b = asked.bounds[number - 1 : number + 1]
        for start in range(0, len(who), PAIRS):
            at = slice(start, start + PAIRS)
            partial[at] += (asked.values[who[at], a:b] * held.values[where[at], a:b]).sum(axis=1)
        near = partial + asked.rests[number][who] * held.rests[number][where] >= bars
        who, where, partial, bars = who[near], where[near], partial[near], bars[near]
    return who, where


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each query's ``keep`` highest scores of different ids, ties to the smaller, with their ranks."""
    order = np.lexsort((-scores, ids, query))
    query, ids, scores = query[order], ids[order], scores[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
    query, ids, scores = query[new], ids[new], scores[new]
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    kept = rank < keep
    return query[kept], ids[kept], scores[kept], rank[kept]


def scan(asked: Turned, bars: np.ndarray, held: Turned, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score): for each query its best candidates among those that reach its bar.

    ``held`` is in descending order of norm; NaN is no bar.
    """
    limits = np.where(np.isnan(bars), -np.inf, bars)
    query, found, scores = (np.zeros(0, np.int64) for _ in range(3))
    start, step = 0, FIRST_CANDIDATES
    while start < len(ids):
        stop = min(len(ids), start + step)
        who = np.flatnonzero(asked.norms * held.norms[start] * (1 + ROOM) + 1 >= limits)
        if not len(who):
            break
        who, where = open_pairs(asked, who, held, np.arange(start, stop), limits)
        if len(who):
            new = [exact_scores(asked.rows[who[n : n + PAIRS]], held.rows[where[n : n + PAIRS]]) for n in range(0, len(who), PAIRS)]
            merged = (np.concatenate(x) for x in ([query, who], [found, ids[where]], [scores, *new]))
            query, found, scores, rank = best_of(*merged, keep)
            full = rank == keep - 1
            limits[query[full]] = np.maximum(limits[query[full]], scores[full])
        start, step = stop, min(2 * step, MOST_CANDIDATES)
    return query, found, scores


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (row numbers, rows) of packed vectors."""
    raw = column.to_pylist()
    sizes = np.array([len(x) for x in raw], np.int64)
    out = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out[int(size) // 8] = at, np.frombuffer(b"".join(raw[n] for n in at), np.int64).reshape(len(at), -1)
    return out


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    values = np.stack([batch[k].to_numpy() for k in keys], axis=1)
    cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(values)]):
        yield tuple(values[a]), batch.slice(a, b - a)


def _answers(directions: np.ndarray | None, keep: int):
    """Blocks of candidates, each followed by the queries that meet it, to (asked, vec_id, score)."""

    def run(batches):
        block, parts, held = None, [], None
        for batch in batches:
            for (*at, kind), rows in _runs(batch, ["band", "cut", "turn", "kind"]):
                if at != block:
                    block, parts, held = at, [], None
                if kind == 0:
                    parts.append((rows["id"].to_numpy(), _matrix(rows["vec"])))
                    continue
                if held is None:
                    held = _held(parts, directions)
                    parts = []
                bars = rows["bar"].cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
                for size, (place, vectors) in _matrix(rows["vec"]).items():
                    if size not in held:
                        continue
                    ids, candidates = held[size]
                    query, found, scores = scan(Turned(vectors, directions), bars[place], candidates, ids, keep)
                    columns = [rows["class"].take(pa.array(place[query])), pa.array(found, pa.int64()), pa.array(scores, pa.int64())]
                    yield pa.record_batch(columns, ["asked", "vec_id", "score"])

    return run


def _held(parts, directions) -> dict[int, tuple[np.ndarray, Turned]]:
    gathered: dict[int, list] = {}
    for ids, by_size in parts:
        for size, (at, vectors) in by_size.items():
            gathered.setdefault(size, []).append((ids[at], vectors))
    out = {}
    for size, pairs in gathered.items():
        out[size] = np.concatenate([i for i, _ in pairs]), Turned(np.concatenate([v for _, v in pairs]), directions)
    return out


def _packed(rows: DataFrame) -> DataFrame:
    """(vec_id, class, norm, vec): vectors as bytes, with a name for equal ones."""

    def run(batches):
        for batch in batches:
            for at, matrix in by_length(batch["vec"]):
                raw = [row.tobytes() for row in matrix]
                names = [hashlib.blake2b(x, digest_size=16).digest() for x in raw]
                norms = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))
                columns = [batch["vec_id"].take(pa.array(at)), pa.array(names, pa.binary()), pa.array(norms), pa.array(raw, pa.binary())]
                yield pa.record_batch(columns, ["vec_id", "class", "norm", "vec"])

    return rows.mapInArrow(run, "vec_id long, class binary, norm double, vec binary")


def _fit(rows: DataFrame, total: int) -> tuple[np.ndarray | None, list[float]]:
    """Singular directions of the sample's most common length, and descending norms at which a new band begins."""
    sample = rows.orderBy(F.xxhash64("class"), "vec_id").select("norm", "vec").limit(FIT_ROWS).toArrow()
    if not sample.num_rows:
        return None, []
    size, (_, vectors) = max(_matrix(sample["vec"].combine_chunks()).items(), key=lambda item: (len(item[1][0]), -item[0]))
    directions = None
    if size:
        # The triangle of a QR decomposition has the sample's singular directions and no more than size rows.
        triangle = np.linalg.qr(vectors.astype(np.float64), mode="r")
        directions = np.linalg.svd(triangle, full_matrices=True)[2].T
    norms = np.sort(sample["norm"].to_numpy())[::-1]
    head = min(len(norms) - 1, int(len(norms) * min(1.0, HEAD_ROWS / total)))
    places = np.linspace(head, len(norms), BANDS, endpoint=False).astype(int) if head < len(norms) - 1 else []
    return directions, sorted({float(norms[p]) for p in places}, reverse=True)


def search(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 50, k: int = 5, factor: int = FACTOR
) -> DataFrame:
    """(query_id, rank, vec_id, score): highest inner products of every row whose id ``every`` divides.

    Components count as floor(factor * x). Ties go to the smaller id. Null
    vectors, such with null or non-finite components, and rows without an id
    take no part. A query meets candidates of its own length only. Repeated ids
    are one candidate, and of its vectors the highest score counts; so it is
    for a query. A query gets fewer than ``k`` rows only if there are fewer
    candidates. Scaled components beyond 2^62 count as that, scores beyond a
    long as the largest or smallest long. An empty table gives an empty result.
    """
    usable = integers(vectors, factor, vec_id, embedding).filter("vec_id IS NOT NULL")
    rows = written(_packed(usable), "vectors")
    total = rows.count()
    directions, borders = _fit(rows, max(total, 1))
    band = sum((F.when(F.col("norm") < border, 1).otherwise(0) for border in borders), F.lit(0)).cast("int")
    rows = rows.withColumn("band", band)
    bands = {row["band"]: (row["n"], row["most"]) for row in rows.groupBy("band").agg(F.count("*").alias("n"), F.max("norm").alias("most")).collect()}
    queries = rows.filter(F.col("vec_id") % every == 0)
    asked = written(queries.groupBy("class").agg(F.first("norm").alias("norm"), F.first("vec").alias("vec")), "asked")
    turns = -(-asked.count() // QUERIES_PER_TURN) or 1

    def cuts(number: Column) -> Column:
        sizes = [-(-bands.get(n, (1, 0))[0] // BLOCK_ROWS) for n in range(len(borders) + 1)]
        return F.element_at(F.array(*[F.lit(n) for n in sizes]), number + 1)

    def wave(candidates: DataFrame, asking: DataFrame) -> DataFrame:
        """What the queries find in the bands that ``asking`` names for them; no more than k + 1 per query and block."""
        candidates = candidates.withColumn("cut", F.pmod(F.xxhash64("vec_id"), cuts(F.col("band"))).cast("int"))
        candidates = candidates.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
        asking = asking.withColumn("cut", F.explode(F.sequence(F.lit(0), cuts(F.col("band")) - 1)))
        asking = asking.withColumn("turn", F.pmod(F.xxhash64("class"), F.lit(turns)).cast("int"))
        left = candidates.select("band", "cut", "turn", F.lit(0).alias("kind"), "norm", F.col("vec_id").alias("id"), "class", "vec", F.lit(None).cast("long").alias("bar"))
        right = asking.select("band", "cut", "turn", F.lit(1).alias("kind"), "norm", F.lit(0).cast("long").alias("id"), "class", "vec", "bar")
        keys = ["band", "cut", "turn"]
        met = left.union(right).repartition(*keys).sortWithinPartitions(*keys, "kind", F.desc("norm"))
        return met.mapInArrow(_answers(directions, k + 1), "asked binary, vec_id long, score long")

    order = [F.desc("score"), F.asc("vec_id")]

    def best(found: DataFrame) -> DataFrame:
        """The k + 1 best ids of each query vector: one more than asked for, as every query leaves itself out."""
        single = found.groupBy("asked", "vec_id").agg(F.max("score").alias("score"))
        return single.withColumn("n", F.row_number().over(Window.partitionBy("asked").orderBy(*order))).filter(F.col("n") <= k + 1)

    head = wave(rows.filter("band = 0"), asked.withColumn("band", F.lit(0)).withColumn("bar", F.lit(None).cast("long")))
    found = written(best(head), "head")
    if len(bands) > 1:
        bars = found.filter(F.col("n") == k + 1).select(F.col("asked").alias("class"), F.col("score").alias("bar"))
        most = F.array(*[F.lit(bands.get(n, (0, -1.0))[1]) for n in range(len(borders) + 1)])
        asking = asked.join(bars, "class", "left").withColumn("band", F.explode(F.sequence(F.lit(1), F.lit(len(borders)))))
        near = F.col("norm") * F.element_at(most, F.col("band") + 1) * (1 + ROOM) + 1 >= F.col("bar")
        rest = wave(rows.filter("band > 0"), asking.filter(F.col("bar").isNull() | near))
        found = written(best(found.select("asked", "vec_id", "score").union(rest)), "best")
    # An id with several vectors asks with all of them.
    ids = queries.select(F.col("vec_id").alias("query_id"), F.col("class").alias("asked")).distinct()
    answers = ids.join(found.select("asked", "vec_id", "score"), "asked").filter("vec_id <> query_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

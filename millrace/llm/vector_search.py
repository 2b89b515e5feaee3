"""Approximate nearest neighbours by an adaptive scan of dimensions.

Vectors are scaled to length one and turned by a random rotation, so that the
distance over the first dimensions estimates the whole distance. An inverted
file sends them to lists; a query probes the lists with the nearest centroids.
Within a list, dimensions are scanned in column blocks: after each block a
hypothesis test abandons the candidates whose partial distance says that they
are, but for a small error, farther than the best known so far; only survivors
pay for the remaining blocks and for the exact score.

The number of lists grows with the root of the rows, and how many of them a
query probes is measured on a bounded sample, so data with clusters need few
and data without any need many. The sample also gives each query a first bound
on its distance, which it carries into every list.

Equal vectors are one candidate with its few smallest ids, which is all that an
answer can hold, so a vector that a third of all rows share is one candidate.
Lists are cut into blocks of bounded size, and so are the queries that probe
one list: a candidate moves once for each such block of queries.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.frames import written

# Vectors on which centroids are fitted, at most, and their bytes, unless a thousand take more; every row is indexed.
FIT_ROWS = 32_768
FIT_BYTES = 32 << 20
# Lists are the root of the different vectors, but no more than one for so many fitted vectors.
FIT_ROWS_PER_LIST = 16
# Probes are as many as find this part of the neighbours that some fitted vectors have among all fitted ones.
RECALL = 0.96
MEASURED_QUERIES = 512
# Fitted vectors that give each query its first bound.
BOUND_ROWS = 2048
COLUMN_BLOCK = 16
# Width of the hypothesis test; a larger one abandons later and errs less.
WIDTH = 2.1
# Bytes of vectors in a block of candidates or queries, and pairs that are scanned together.
BLOCK_BYTES = 4 << 20
PAIRS_AT_ONCE = 1 << 18
SEED = 17


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Usable vectors of a list column as float64 rows, and their places; a matrix for each length."""
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == size)
        rows = values[starts[at][:, None] + np.arange(size)]
        with np.errstate(over="ignore", invalid="ignore"):
            norms = np.sqrt((rows * rows).sum(axis=1))
            good = np.isfinite(rows).all(axis=1) & np.isfinite(norms) & (norms > 0)
        yield rows[good], at[good]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def _nearest(rows: np.ndarray, centroids: np.ndarray, most: int) -> np.ndarray:
    """Numbers of the ``most`` nearest centroids of each row, nearest first."""
    out = np.zeros((len(rows), most), np.int64)
    step = max(1, PAIRS_AT_ONCE // len(centroids))
    for start in range(0, len(rows), step):
        likeness = rows[start : start + step] @ centroids.T
        out[start : start + step] = likeness.argmax(axis=1)[:, None] if most == 1 else np.argsort(-likeness, axis=1, kind="stable")[:, :most]
    return out


def fitted_centroids(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    order = np.random.default_rng(SEED).permutation(len(sample))
    centroids = sample[order[: min(lists, len(sample))]].copy()
    for _ in range(rounds):
        nearest = _nearest(sample, centroids, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.sqrt((sums * sums).sum(axis=1))
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return centroids


def probes_needed(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float = RECALL) -> int:
    """Nearest lists that hold at least a part ``recall`` of the ``k`` nearest neighbours within the sample.

    In a sample neighbours are farther away than among all rows, so this asks
    rather for too many lists than for too few.
    """
    own = _nearest(sample, centroids, 1)[:, 0]
    asked = np.random.default_rng(SEED + 1).permutation(len(sample))[:MEASURED_QUERIES]
    ranks = []
    for n in asked:
        likeness = sample @ sample[n]
        likeness[n] = -np.inf
        near = np.argpartition(-likeness, min(k, len(sample)) - 1)[:k]
        place = np.empty(len(centroids), np.int64)
        place[np.argsort(-(centroids @ sample[n]), kind="stable")] = np.arange(len(centroids))
        ranks.append(place[own[near[near != n]]])
    ranks = np.sort(np.concatenate(ranks))
    return int(ranks[int(np.ceil(recall * len(ranks))) - 1]) + 1 if len(ranks) else len(centroids)


def first_bounds(queries: np.ndarray, some: np.ndarray, keep: int) -> np.ndarray:
    """Squared distance within which each query has ``keep`` of the vectors ``some``; infinite if there are fewer."""
    if len(some) < keep:
        return np.full(len(queries), np.inf)
    out = np.zeros(len(queries))
    step = max(1, PAIRS_AT_ONCE // len(some))
    for start in range(0, len(queries), step):
        likeness = queries[start : start + step] @ some.T
        out[start : start + step] = 2 + 2 * np.partition(-likeness, keep - 1, axis=1)[:, keep - 1]
    return out


def scan(queries: np.ndarray, limits: np.ndarray, columns: list[np.ndarray], keep: int, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate): which candidates may be among the ``keep`` nearest of a query.

    ``columns`` are the rotated candidates in blocks of dimensions, ``limits``
    the squared distances beyond which nothing is wanted. No query gets more
    than ``keep``.
    """
    total, size = len(columns[0]), queries.shape[1]
    ends = np.cumsum([block.shape[1] for block in columns])
    parts = np.split(queries, ends[:-1], axis=1)
    none = np.zeros(0, np.int64)
    if not total or not len(queries):
        return none, none
    first = (columns[0] ** 2).sum(axis=1)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, PAIRS_AT_ONCE // total)
    for start in range(0, len(queries), step):
        some = slice(start, start + step)
        far = first + (parts[0][some] ** 2).sum(axis=1)[:, None] - 2 * (parts[0][some] @ columns[0].T)
        limit = limits[some]
        if total > keep:
            # The whole distances of those that are nearest so far bound what a query can want.
            near = np.argpartition(far, keep - 1, axis=1)[:, :keep]
            whole = sum(((block[near] - part[some][:, None, :]) ** 2).sum(axis=2) for block, part in zip(columns, parts))
            limit = np.minimum(limit, whole.max(axis=1))
        limit = limit * (1 + 1e-9) + 1e-12
        bars = [limit if seen == size else limit * seen / size * (1 + width / np.sqrt(seen)) ** 2 for seen in ends.tolist()]
        who, at = np.nonzero(far <= bars[0][:, None])
        far = far[who, at]
        for block, part, bar in zip(columns[1:], parts[1:], bars[1:]):
            far = far + ((block[at] - part[some][who]) ** 2).sum(axis=1)
            left = far <= bar[who]
            who, at, far = who[left], at[left], far[left]
        order = np.lexsort((at, far, who))
        who, at = who[order], at[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        found.append((who[place < keep] + start, at[place < keep]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, class, vec) of usable rows; rows of one class hold the same vector."""

    def run(batches):
        for batch in batches:
            for rows, at in matrices(batch["embedding"]):
                rows = rows + 0.0  # no negative zeros
                raw = [row.tobytes() for row in rows]
                names = [hashlib.blake2b(x, digest_size=16).digest() for x in raw]
                yield pa.record_batch(
                    [batch["vec_id"].take(pa.array(at)), pa.array(names, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "class", "vec"]
                )

    chosen = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))
    return chosen.filter("vec_id IS NOT NULL").mapInArrow(run, "vec_id long, class binary, vec binary")


def search(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    every: int = 50,
    k: int = 5,
    lists: int | None = None,
    probes: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): nearest rows by cosine of every row whose id ``every`` divides.

    ``lists`` and ``probes`` are chosen by the rows unless they are given. Ties
    go to the smaller id. A query gets fewer than ``k`` rows only if fewer
    candidates are found. Null, empty or zero vectors, such with null or
    non-finite components, and rows without an id take no part; of vectors of
    several lengths only the most common length among the fitted ones does.
    Repeated ids are one candidate, and of its vectors the nearest counts. An
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = written(_classes(vectors, vec_id, embedding), "vectors")
    one = rows.groupBy("class").agg(F.first("vec").alias("vec"))
    longest = rows.agg(F.max(F.octet_length("vec"))).first()[0] or 1
    most = min(FIT_ROWS, max(1000, FIT_BYTES // longest))
    sample = one.orderBy(F.xxhash64("class"), "class").select("vec").limit(most).toArrow()["vec"].to_pylist()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    size = int(np.bincount([len(x) for x in sample]).argmax())
    fitted = unit(np.stack([np.frombuffer(x) for x in sample if len(x) == size]))
    turn = rotation(size // 8)
    rows, one = (x.filter(F.octet_length("vec") == size) for x in (rows, one))

    # Of equal vectors, only the smallest ids can be in an answer: k, and one for the query itself.
    numbered = rows.select("class", "vec_id").distinct()
    numbered = numbered.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("vec_id")))
    ids = numbered.filter(F.col("n") <= k + 1).groupBy("class").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    candidates = written(one.join(ids, "class"), "candidates")
    queries = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "class").distinct()
    asked = written(candidates.join(queries.select("class").distinct(), "class", "left_semi").select("class", "vec"), "asked")
    lists = lists or math.isqrt(candidates.count())
    centroids = fitted_centroids(fitted, max(1, min(lists, len(fitted) // FIT_ROWS_PER_LIST)))
    probed = min(probes or probes_needed(fitted, centroids, k), len(centroids))
    bounding = fitted[:BOUND_ROWS]

    def listed(most: int):
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                held = unit(np.stack([np.frombuffer(x) for x in batch["vec"].to_pylist()]))
                near = _nearest(held, centroids, most)
                owner = pa.array(np.repeat(np.arange(batch.num_rows), most))
                bound = first_bounds(held, bounding, k + 1) if most == probed else np.zeros(batch.num_rows)
                columns = [pa.array(near.ravel(), pa.int32()), batch["class"].take(owner), batch["vec"].take(owner), pa.array(bound).take(owner)]
                yield pa.record_batch(columns, ["list", "class", "vec", "bound"])

        return run

    kind = "list int, class binary, vec binary, bound double"
    block_rows = max(1, BLOCK_BYTES // size)

    def parts_of(rows: DataFrame):
        """Of each list, into how many blocks its rows are cut; a list with many rows has many."""
        sizes = {row["list"]: row["count"] for row in rows.groupBy("list").count().collect()}
        counts = F.array(*[F.lit(-(-sizes.get(n, 1) // block_rows)) for n in range(len(centroids))])
        return F.element_at(counts, F.col("list") + 1)

    def block(parts):
        return F.pmod(F.xxhash64("class"), parts).cast("int")

    def every_block(parts):
        return F.explode(F.sequence(F.lit(0), parts - 1))

    left = written(candidates.select("class", "vec").mapInArrow(listed(1), kind).drop("bound"), "lists")
    right = written(asked.mapInArrow(listed(probed), kind), "probes")
    cuts, turns = parts_of(left), parts_of(right)
    left = left.withColumn("cut", block(cuts)).withColumn("turn", every_block(turns))
    right = right.withColumn("turn", block(turns)).withColumn("cut", every_block(cuts))

    def scanned(held: pa.Table, asking: pa.Table) -> pa.Table:
        names, near, scores = pa.array([], pa.binary()), pa.array([], pa.binary()), pa.array([], pa.float64())
        if held.num_rows and asking.num_rows:
            originals = np.stack([np.frombuffer(x) for x in held["vec"].to_pylist()])
            wanted = np.stack([np.frombuffer(x) for x in asking["vec"].to_pylist()])
            turned = unit(originals) @ turn
            columns = [np.ascontiguousarray(turned[:, a : a + COLUMN_BLOCK]) for a in range(0, turned.shape[1], COLUMN_BLOCK)]
            who, at = scan(unit(wanted) @ turn, asking["bound"].to_numpy(), columns, k + 1)
            one, two = originals[at], wanted[who]
            scores = (one * two).sum(axis=1) / (np.sqrt((one * one).sum(axis=1)) * np.sqrt((two * two).sum(axis=1)))
            names, near, scores = asking["class"].take(pa.array(who)), held["class"].take(pa.array(at)), pa.array(scores)
        return pa.table([names, near, scores], ["asked", "class", "score"])

    keys = ["list", "cut", "turn"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scanned, "asked binary, class binary, score double")
    members = found.join(candidates.select("class", "ids"), "class").select("asked", "score", F.explode("ids").alias("vec_id"))
    members = members.groupBy("asked", "vec_id").agg(F.max("score").alias("score"))
    order = [F.desc("score"), F.asc("vec_id")]
    place = F.row_number().over(Window.partitionBy("asked").orderBy(*order))
    # One answer for each different query vector; every query then leaves itself out.
    best = members.withColumn("n", place).filter(F.col("n") <= k + 1)
    answers = queries.select(F.col("vec_id").alias("query_id"), F.col("class").alias("asked")).join(best, "asked")
    answers = answers.filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Centroid clustering by a tournament of bisectors, in exact integers.

Of two centroids a and b, a vector x is nearer to a unless 2 x.(b - a) exceeds
|b|^2 - |a|^2. Normals b - a and these thresholds are computed once for all
pairs; each vector then meets the centroids in ascending order, keeps a
champion, and one sign test per further centroid eliminates the loser. Zero
favours the smaller number, which is the champion's. Only the distance to the
winner is computed.

A round reads the vectors once; tasks hand on sums per centroid and component,
so the driver sees no more than the centroids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.frames import named_inside, written
from millrace.llm.integer_vectors import LONGEST, Sums, by_length, exact, group_sums, integers, largest, longs, moved

CENTROIDS = 40
ROUNDS = 5
SIZE = 64
FACTOR = 256


class Tournament:
    """Bisectors of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object).reshape(len(centroids), -1)
        self.normals = self.centroids[None, :, :] - self.centroids[:, None, :]
        squares = (self.centroids * self.centroids).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]
        self.most = max((abs(v) for v in self.centroids.ravel()), default=0)
        self.small = None
        if self.bound(0) < 2**53:
            self.small = self.normals.astype(np.float64), self.thresholds.astype(np.float64), self.centroids.astype(np.float64)

    def bound(self, most: int) -> int:
        """No value of a test or of a distance is larger, for components up to ``most``."""
        return 8 * max(self.most, most, 1) ** 2 * max(self.centroids.shape[1], 1)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the nearest centroids and exact squared distances of int64 rows."""
        rows = exact(rows, self.bound(largest(rows)))
        whole = self.normals, self.thresholds, self.centroids
        normals, thresholds, centroids = whole if rows.dtype == object or self.small is None else self.small
        champion = np.zeros(len(rows), np.int64)
        for challenger in range(1, len(centroids)):
            side = 2 * (normals[champion, challenger] * rows).sum(axis=1) - thresholds[champion, challenger]
            champion[side > 0] = challenger
        return champion, ((rows - centroids[champion]) ** 2).sum(axis=1)


def seeds(vectors: DataFrame, centroids: int) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes; equal ids in the order of their components."""
    named = vectors.filter("vec_id IS NOT NULL").withColumn("place", F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256))
    return [list(row["vec"]) for row in named.orderBy("place", "vec").select("vec").limit(centroids).collect()]


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    factor: int = FACTOR,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Vectors of another length than ``size``, null ones and those with null or
    non-finite components take no part. Repeated rows and ids count as often as
    they stand; a null id takes part but is no first centroid. With fewer ids
    than ``centroids`` each is a centroid, and with none the result is empty.
    Scaled components beyond 2^62 count as that, distances and inertia beyond a
    long as the largest long. Other columns are not read.
    """
    kept = written(integers(vectors, factor, vec_id, embedding).filter(F.size("vec") == size), "vectors")
    entries = seeds(kept, centroids)
    if not entries:
        return kept.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )

    def gathered(entries):
        def run(batches):
            tournament, sums = Tournament(entries), Sums(len(entries), size)
            for batch in batches:
                for _, rows in by_length(batch["vec"]):
                    champion, _ = tournament.nearest(rows)
                    sums.add(champion, exact(rows, largest(rows) * 2**20))
            yield sums.table()

        return run

    for _ in range(rounds):
        entries = moved(entries, group_sums(kept.select("vec"), gathered(entries)))

    def assigned(batches):
        tournament = Tournament(entries)
        for batch in batches:
            for at, rows in by_length(batch["vec"]):
                champion, far = tournament.nearest(rows)
                columns = [batch["vec_id"].take(pa.array(at)), pa.array(champion, pa.int32()), pa.array(longs(far), pa.int64())]
                yield pa.record_batch(columns, ["vec_id", "cluster", "distance"])

    out = written(kept.mapInArrow(assigned, "vec_id long, cluster int, distance long"), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {row["cluster"]: int(row["total"]) for row in out.groupBy("cluster").agg(total.alias("total")).collect()}
    whole = min(sum(inertia.values()), LONGEST)
    hashes = [hashlib.sha256(",".join(map(str, entry)).encode()).hexdigest() for entry in entries]
    # One row a centroid: as small as the centroids that every task holds.
    number = named_inside("cluster")
    facts = [(c, min(n, LONGEST), whole, hashes[c]) for c, n in inertia.items()]
    facts = kept.sparkSession.createDataFrame(facts, f"{number} int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), out["cluster"] == facts[number]).drop(number)

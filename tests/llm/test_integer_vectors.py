"""Inner products, code compression and bisector clusters against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest

from millrace.llm import bisector_clusters, code_compression, inner_products
from millrace.llm.integer_vectors import LARGEST, LONGEST, Sums

SCHEMA = "vec_id long, embedding array<double>, label string, score double, class string, vec int, cluster int, error int, band int, distance int"


def frame(llm, rows, partitions=None):
    """Rows of (vec_id, embedding, label) among columns whose names the operators use themselves."""
    out = llm.createDataFrame([(*row, 1.0, "x", 2, 3, 4, 5, 6) for row in rows], SCHEMA)
    return out.repartition(partitions, "vec_id") if partitions else out


def scaled(vector, factor):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [max(-LARGEST, min(LARGEST, math.floor(factor * x))) for x in vector]


def clamped(value):
    return max(-LONGEST, min(LONGEST, value))


def square(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(vector, entries):
    return min((square(vector, e), n) for n, e in enumerate(entries))


def lloyd(vectors, entries, rounds):
    for _ in range(rounds):
        groups = {}
        for v in vectors:
            groups.setdefault(nearest(v, entries)[1], []).append(v)
        entries = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else e for n, e in enumerate(entries)]
    return entries


def odd_rows(size):
    """Rows that take no part, or that need care."""
    return [
        (9000, None, "a"),
        (9050, [float("nan")] * size, "a"),
        (9100, [1.0] * (size - 1) + [None], "a"),
        (9150, [float("inf")] + [0.0] * (size - 1), None),
        (9200, [0.0] * size, None),
        (9250, [-0.0] * size, None),
        (9300, [1e300] + [0.0] * (size - 1), "b"),
        (9350, [-3e9] * size, "b"),
        (9400, [1e17 if n % 2 else -1e17 for n in range(size)], "b"),
        (None, [0.25] * size, "b"),
        (9450, [], "b"),
    ]


def products(rows, every, k, factor=256):
    held = {}
    for i, v, _ in rows:
        v = scaled(v, factor)
        if i is not None and v is not None:
            held.setdefault(i, []).append(v)
    out = []
    for q in held:
        if q % every:
            continue
        found = []
        for c in held:
            scores = [clamped(sum(x * y for x, y in zip(a, b))) for a in held[q] for b in held[c] if len(a) == len(b)]
            if c != q and scores:
                found.append((-max(scores), c))
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


def search(llm, rows, partitions=None, **options):
    got = inner_products.search(frame(llm, rows, partitions), **options)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    return sorted(tuple(r) for r in got.collect())


def mixed(size, count, seed=5, odd=True):
    rng = np.random.default_rng(seed)
    norms = rng.lognormal(sigma=0.7, size=count)
    rows = [(k, (norms[k] * rng.normal(size=size)).tolist(), "abc"[k % 3]) for k in range(count)]
    hot = rng.normal(size=size).tolist()
    rows += [(3000 + k, hot, None) for k in range(count // 2)]
    rows += rows[:9] + [(0, hot, "z"), (1, rng.normal(size=size).tolist(), "z")]
    return rows + odd_rows(size) if odd else rows


@pytest.mark.parametrize("odd", [True, False])
def test_inner_products(llm, odd):
    rows = mixed(20, 400, odd=odd) + [(7000 + k, [float(k % 5), 1.0, -2.0], "c") for k in range(120)]
    assert search(llm, rows) == products(rows, 50, 5)


def test_inner_products_over_many_blocks(llm, monkeypatch):
    """Bands, cuts and turns of a few rows each give the same answers."""
    for name, value in {"HEAD_ROWS": 40, "BLOCK_ROWS": 30, "QUERIES_PER_TURN": 7, "FIRST_CANDIDATES": 4, "MOST_CANDIDATES": 16, "SPARSE": 0.4, "PAIRS": 11}.items():
        monkeypatch.setattr(inner_products, name, value)
    rows = mixed(40, 300, seed=8)
    llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        assert search(llm, rows, partitions=5, every=10, k=3) == products(rows, 10, 3)
    finally:
        llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_scan_prunes_and_keeps_ties():
    rng = np.random.default_rng(2)
    held = rng.integers(-40, 40, size=(3000, 32))
    held[1000:1040] = held[7]
    held = held[np.argsort(-(held * held).sum(axis=1), kind="stable")]
    ids = rng.permutation(len(held)).astype(np.int64)
    asked = rng.integers(-40, 40, size=(25, 32))
    directions = np.linalg.svd(held.astype(float), full_matrices=True)[2].T
    one, other = inner_products.Turned(asked, directions), inner_products.Turned(held, directions)
    query, found, scores = inner_products.scan(one, np.full(25, np.nan), other, ids, 6)
    for n in range(25):
        best = sorted((-int(s), int(i)) for s, i in zip(held @ asked[n], ids))[:6]
        assert [(-s, i) for s, i in zip(scores[query == n].tolist(), found[query == n].tolist())] == best
    looked_at = inner_products.open_pairs(one, np.arange(25), other, np.arange(3000), np.array([scores[query == n].min() for n in range(25)], float))
    assert len(looked_at[0]) < 25 * 3000 * 0.02


def test_inner_products_of_few_and_no_rows(llm):
    few = [(0, [1.0, 0.0], "a"), (50, [0.0, 2.0], "a"), (7, [1.0, 1.0], "a")]
    assert search(llm, few) == [(0, 1, 7, 65536), (0, 2, 50, 0), (50, 1, 7, 131072), (50, 2, 0, 0)]
    assert search(llm, [(0, [1.0], "a")]) == []
    assert search(llm, []) == []
    assert search(llm, odd_rows(3)[:4]) == []


def compressed(rows, parts=4, entries=256, rounds=4, factor=1024):
    kept = [(i, scaled(v, factor), label) for i, v, label in rows]
    kept = [row for row in kept if row[1]]
    lengths = [len(v) for _, v, _ in kept if len(v) % parts == 0]
    size = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    kept = [row for row in kept if len(row[1]) == size]
    width = size // parts
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    books = []
    for p in range(parts):
        at = slice(p * width, (p + 1) * width)
        books.append(lloyd([v[at] for _, v, _ in kept], [v[at] for _, v in first], rounds))
    out, sums = [], {}
    for i, v, label in kept:
        found = [nearest(v[p * width : (p + 1) * width], book) for p, book in enumerate(books)]
        error = clamped(sum(min(f, LONGEST) for f, _ in found))
        out.append((i, bytes(n for _, n in found).hex(), error, label))
        sums[label] = sums.get(label, 0) + error
    told = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return ordered((i, code, error, clamped(sums[label]), told) for i, code, error, label in out)


def ordered(rows):
    return sorted(rows, key=lambda row: (row[0] is None, row))


@pytest.mark.parametrize("odd", [True, False])
def test_code_compression(llm, odd):
    rows = mixed(12, 300, odd=odd) + [(-5, [1.0] * 8, "b")]
    got = code_compression.compress(frame(llm, rows, 3), entries=40, rounds=3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert ordered(tuple(r) for r in got.collect()) == compressed(rows, entries=40, rounds=3)


def test_code_compression_with_few_rows(llm):
    rows = [(3, [1.0, 2.0, 3.0, 4.0], None), (1, [1.0, 2.0, 3.0, 4.5], None), (3, [1.0, 2.0, 3.0, 4.0], "a")]
    assert ordered(tuple(r) for r in code_compression.compress(frame(llm, rows)).collect()) == compressed(rows)
    for none in ([], odd_rows(4)[:4], [(None, [1.0] * 4, "a")], [(1, [1.0] * 3, "a")]):
        assert code_compression.compress(frame(llm, none)).collect() == []


def test_boxes_hold_what_is_near_and_little_else():
    rng = np.random.default_rng(4)
    centers = rng.integers(-5000, 5000, size=(16, 6))
    entries = (centers[rng.integers(0, 16, 200)] + rng.integers(-30, 30, size=(200, 6))).tolist()
    entries[120] = entries[3]
    rows = np.array(entries)[rng.integers(0, 200, 500)] + rng.integers(-20, 20, size=(500, 6))
    one = code_compression.Slices(entries)
    index, far = one.nearest(rows)
    assert list(zip(far.astype(int).tolist(), index.tolist())) == [nearest(v, entries) for v in rows.tolist()]
    assert 120 not in index
    plain = rows.astype(float)
    bits = np.unpackbits(one.masks(plain, one.radius(plain, one.small)).view(np.uint8), axis=1)
    assert bits.sum(axis=1).mean() < 0.25 * len(entries)


def clustered(rows, centroids=40, rounds=5, size=64):
    kept = [(i, scaled(v, 256)) for i, v, _ in rows if v is not None and len(v) == size]
    kept = [row for row in kept if row[1]]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    entries = lloyd([v for _, v in kept], [v for _, v in named[:centroids]], rounds)
    found = [(i, *nearest(v, entries)) for i, v in kept]
    sums = {}
    for _, far, n in found:
        sums[n] = sums.get(n, 0) + min(far, LONGEST)
    whole = clamped(sum(sums.values()))
    sha = [hashlib.sha256(",".join(map(str, e)).encode()).hexdigest() for e in entries]
    return ordered((i, n, clamped(far), clamped(sums[n]), whole, sha[n]) for i, far, n in found)


@pytest.mark.parametrize("odd", [True, False])
def test_bisector_clusters(llm, odd):
    rows = mixed(64, 150, odd=odd) + [(-5, [1.0] * 8, "b")]
    got = bisector_clusters.cluster(frame(llm, rows, 3), centroids=12, rounds=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert ordered(tuple(r) for r in got.collect()) == clustered(rows, 12, 3)


def test_bisector_clusters_with_few_rows(llm):
    rows = [(3, [1.0] * 64, None), (1, [0.5] * 64, None), (3, [1.0] * 64, "a")]
    assert ordered(tuple(r) for r in bisector_clusters.cluster(frame(llm, rows)).collect()) == clustered(rows)
    for none in ([], odd_rows(64)[:4], [(None, [1.0] * 64, "a")], [(1, [1.0] * 3, "a")]):
        assert bisector_clusters.cluster(frame(llm, none)).collect() == []


def test_zero_favours_the_smaller_number():
    one = bisector_clusters.Tournament([[4, 0], [0, 0], [2, 2], [0, 0], [4, 4]])
    rows = np.array([[2, 0], [0, 0], [1, 1], [2, 1], [3, 3], [4, 2]])
    champion, far = one.nearest(rows)
    assert list(zip(far.tolist(), champion.tolist())) == [nearest(v, [[4, 0], [0, 0], [2, 2], [0, 0], [4, 4]]) for v in rows.tolist()]


def test_sums_are_exact():
    sums = Sums(3, 2)
    sums.add(np.array([1, 1]), np.array([[LARGEST, -1], [LARGEST, -2**40]], object))
    sums.add(np.array([1, 2]), np.array([[3.0, 4.0], [-5.0, 0.0]]))
    rows = [tuple(r.values()) for r in sums.table(10).to_pylist()]
    assert {(g, p): (h << 31) + l for g, p, h, l in rows} == {
        (11, -1): 3, (11, 0): 2 * LARGEST + 3, (11, 1): 3 - 2**40, (12, -1): 1, (12, 0): -5, (12, 1): 0
    }

import numpy as np
import pytest

from millrace.llm import vector_search


def vectors(llm, rows):
    return llm.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<double>, score double, list string")


def nearest(rows, every, k):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = np.array(v) / np.linalg.norm(v)
    out = {}
    for i, v in good.items():
        if i % every == 0:
            near = sorted((-round(float(v @ w), 12), j) for j, w in good.items() if j != i)
            out[i] = [j for _, j in near[:k]]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 24))
    out = [(k, (centers[k % 12] + 0.4 * rng.normal(size=24)).tolist()) for k in range(900)]
    hot = rng.normal(size=24).tolist()
    out += [(1000 + k, hot) for k in range(400)]
    return out + [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [1.0] * 23 + [None]), (5200, []), (None, hot), (5250, [float("inf")] * 24)]


def test_recall_and_scores(llm, rows):
    got = vector_search.search(vectors(llm, rows)).collect()
    expected = nearest(rows, 50, 5)
    assert {r.query_id for r in got} == set(expected)
    hits = sum(r.vec_id in expected[r.query_id] for r in got)
    assert hits / (5 * len(expected)) >= 0.9
    held = {i: np.array(v) for i, v in rows if v and i is not None and None not in v}
    for r in got:
        a, b = held[r.query_id], held[r.vec_id]
        assert r.score == pytest.approx(float(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), abs=1e-12)
        assert r.vec_id != r.query_id
    # Of equal vectors the smallest ids come first.
    hot = sorted((r.rank, r.vec_id) for r in got if r.query_id == 1000)
    assert hot == [(k, 1000 + k) for k in range(1, 6)]


def test_all_lists_give_the_exact_answer(llm, rows):
    got = vector_search.search(vectors(llm, rows), lists=4, probes=4)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    expected = nearest(rows, 50, 5)
    same = sum(len(set(found[q]) & set(expected[q])) for q in expected)
    assert same / (5 * len(expected)) > 0.98


def test_repeated_rows_of_a_hot_vector(llm):
    """Copies of one row take no place of the other ids with the same vector."""
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8).tolist()
    rows = [(k, hot) for k in range(1, 101)] + [(1, hot)] * 6 + [(1000 + k, rng.normal(size=8).tolist()) for k in range(1, 40)]
    got = vector_search.search(vectors(llm, rows)).filter("query_id = 50").orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in got] == [(k, k) for k in range(1, 6)]
    assert all(r.score == pytest.approx(1) for r in got)


def test_few_and_no_rows(llm):
    few = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (7, [1.0, 1.0])]
    got = [(r.query_id, r.rank, r.vec_id) for r in vector_search.search(vectors(llm, few)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    assert vector_search.search(vectors(llm, [])).collect() == []
    assert vector_search.search(vectors(llm, [(0, None)])).collect() == []


def test_other_lengths_do_not_depend_on_batches(llm):
    """A minority of other lengths, together in one batch, takes no part; all other rows do."""
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(60)]
    odd = [(100 + k, rng.normal(size=5).tolist()) for k in range(20)]
    expected = nearest(rows, 50, 5)
    for size in ("7", "2000"):
        llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = vector_search.search(vectors(llm, odd + rows).coalesce(1)).orderBy("query_id", "rank").collect()
        finally:
            llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        found = {}
        for r in got:
            found.setdefault(r.query_id, []).append(r.vec_id)
        assert set(found) == set(expected)
        assert sum(len(set(found[q]) & set(expected[q])) for q in expected) >= 0.9 * 5 * len(expected)


def test_scan_keeps_the_nearest_within_the_bound():
    """With a test that never errs, the scan is exact; bounds cut off what lies beyond them and nothing else."""
    rng = np.random.default_rng(11)
    held, asked = (vector_search.unit(rng.normal(size=(n, 40))) for n in (3000, 70))
    columns = [held[:, a : a + 16] for a in range(0, 40, 16)]
    far = ((asked[:, None, :] - held[None, :, :]) ** 2).sum(axis=2)
    best = np.sort(far, axis=1)
    for limits in (np.full(70, np.inf), best[:, 5], best[:, 2]):
        who, at = vector_search.scan(asked, limits, columns, 6, width=1e6)
        got = {(q, c) for q, c in zip(who.tolist(), at.tolist())}
        expected = {(q, int(c)) for q in range(70) for c in np.argsort(far[q])[:6] if far[q, c] <= limits[q] * (1 + 1e-9)}
        assert got == expected
    # The usual width abandons early and errs little.
    who, at = vector_search.scan(asked, np.full(70, np.inf), columns, 6)
    true = {(q, int(c)) for q in range(70) for c in np.argsort(far[q])[:6]}
    assert len(true & set(zip(who.tolist(), at.tolist()))) >= 0.97 * len(true)
    assert [len(x) for x in vector_search.scan(asked[:0], np.zeros(0), columns, 6)] == [0, 0]


def test_first_bounds_hold_enough_vectors():
    rng = np.random.default_rng(12)
    some, asked = (vector_search.unit(rng.normal(size=(n, 12))) for n in (300, 20))
    bounds = vector_search.first_bounds(asked, some, 6)
    far = ((asked[:, None, :] - some[None, :, :]) ** 2).sum(axis=2)
    assert ((far <= bounds[:, None] + 1e-12).sum(axis=1) == 6).all()
    assert np.isinf(vector_search.first_bounds(asked, some[:5], 6)).all()


def test_probes_follow_the_data():
    """Clusters need few lists, rows without any need many; either way the recall is the one asked for."""
    rng = np.random.default_rng(13)
    centers = rng.normal(size=(60, 32))
    clustered = vector_search.unit(centers[rng.integers(60, size=4000)] + 0.05 * rng.normal(size=(4000, 32)))
    plain = vector_search.unit(rng.normal(size=(4000, 32)))
    needed = {}
    for name, rows in (("clustered", clustered), ("plain", plain)):
        centroids = vector_search.fitted_centroids(rows, 60)
        needed[name] = vector_search.probes_needed(rows, centroids, 5, 0.9)
        own = (rows @ centroids.T).argmax(axis=1)
        hits = total = 0
        for n in range(0, 4000, 40):
            near = np.argsort(-(rows @ rows[n]))[1:6]
            probed = np.argsort(-(centroids @ rows[n]))[: needed[name]]
            hits, total = hits + np.isin(own[near], probed).sum(), total + 5
        assert hits / total >= 0.87
    assert needed["clustered"] <= 5 < 20 <= needed["plain"]
    one = vector_search.unit(rng.normal(size=(1, 4)))
    assert vector_search.probes_needed(one, one, 5) == 1

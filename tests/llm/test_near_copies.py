"""Jaccard join and substring deduplication against brute force."""

import hashlib
import random
import re

import pytest

from millrace.llm import jaccard_join, meetings, substring_dedup

WORD = r"[^\x20\x09-\x0D]+"


def near_copies(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"W{k}" for k in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (3, 4, 5, 8, 30, 60, 120, 300, 300)]
    out = []
    for k in range(count):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            words = words + [rng.choice(vocabulary) for _ in range(rng.randint(1, 40))]
        text = rng.choice([" ", "  ", "\n"]).join(words)
        out.append((k, text.lower() if rng.random() < 0.3 else text))
    return [*out, (5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "one"), (5005, "É é")]


def shingles(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(frame, seed):
    rows = near_copies(seed, 250)
    got = jaccard_join.classes(frame(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == components(rows)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t)) for i, t in rows}


def test_large_meetings_in_small_blocks(frame, monkeypatch):
    monkeypatch.setattr(meetings, "SMALL_GROUP", 3)
    monkeypatch.setattr(meetings, "BLOCK", 20)
    rows = near_copies(4, 250)
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(frame(rows)).collect()}
    assert got == components(rows)


def test_every_linked_pair_shares_a_signature():
    scheme = jaccard_join.Scheme(80)
    rng = random.Random(9)
    import numpy as np

    for _ in range(60):
        size = rng.choice([1, 2, 3, 6, 20, 90, 400])
        a = {rng.getrandbits(63) for _ in range(size)}
        b = set(a)
        while True:
            c = set(b)
            if rng.random() < 0.5 and len(c) > 1:
                c.discard(rng.choice(sorted(c)))
            else:
                c.add(rng.getrandbits(63))
            if 100 * len(a & c) < 80 * len(a | c):
                break
            b = c
        flat = np.array(sorted(a) + sorted(b), np.uint64)
        names, owner, role = jaccard_join.signatures(flat, np.array([0, len(a), len(a) + len(b)]), scheme)
        index = {(n, o) for n, o, r in zip(names.tolist(), owner.tolist(), role.tolist()) if r == 1}
        probe = {(n, o) for n, o, r in zip(names.tolist(), owner.tolist(), role.tolist()) if r == 2}
        assert any((n, 1 - o) in probe for n, o in index)


def test_repeated_and_null_ids(frame):
    text = " ".join(f"w{k}" for k in range(40))
    other = " ".join(f"v{k}" for k in range(40))
    rows = [(4, text), (4, text), (None, text), (9, text + " x"), (7, other), (7, text), (8, other)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_join.classes(frame(rows)).collect())
    assert [(i, c) for i, _, c in got] == [(-1, None), (4, 4), (4, 4), (7, 4), (7, 4), (8, 4), (9, 4)]
    assert jaccard_join.classes(frame([])).collect() == []


def passages(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"W{k}" for k in range(80)] + ["é", "ü,"]
    shared = [[rng.choice(vocabulary) for _ in range(n)] for n in (49, 50, 51, 75, 120)]
    out = []
    for k in range(count):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(shared) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        out.append((k, rng.choice([" ", "\n", "  "]).join(words)))
    return [*out, out[3], (3, out[5][1]), (700, None), (701, ""), (-5, out[1][1]), (None, out[2][1]), (702, out[2][1])]


def left(rows, window=50):
    words = [(i, re.findall(WORD, t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k : k + window])] < i:
                    gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_equal_brute_force(frame, seed):
    rows = passages(seed, 150)
    got = [tuple(r) for r in substring_dedup.digests_after(frame(rows)).collect()]
    assert sorted(got, key=str) == left(rows)


def test_texts_lose_their_repeats(frame):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"start\n{passage}\nend"), (2, f"own  {passage}\n\nrest"), (3, passage), (4, "short"), (5, None)]
    got = {r.doc_id: r.text for r in substring_dedup.deduplicated(frame(rows)).collect()}
    assert got == {1: rows[0][1], 2: "own  rest", 4: "short", 5: None}
    assert substring_dedup.digests_after(frame([])).collect() == []


def test_negative_ids_count_like_others(frame):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(-5, passage), (3, f"own {passage}"), (None, passage), (-9, f"x {passage[:-4]}")]
    got = [tuple(r) for r in substring_dedup.digests_after(frame(rows)).collect()]
    assert sorted(got, key=str) == left(rows)
    assert {(r[0], r[2]) for r in got} == {(-9, 0), (-5, 59), (3, 60), (None, 0)}


def test_columns_of_any_name_stay(llm):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, passage, "a", 1), (2, f"own {passage}", "b", 2), (2, "other words", "c", 3), (None, None, None, None)]
    docs = llm.createDataFrame(rows, "doc_id int, text string, _of string, _gone long")
    out = substring_dedup.deduplicated(docs)
    assert out.schema == docs.schema
    assert {tuple(r) for r in out.collect()} == {rows[0], (2, "own ", "b", 2), rows[2], rows[3]}
    assert substring_dedup.deduplicated(docs.limit(0)).collect() == []

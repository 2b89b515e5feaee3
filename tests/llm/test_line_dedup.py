import random
import subprocess
import sys
import tracemalloc

import numpy as np
import pytest

from millrace.llm import line_dedup, ragged


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def changed(rng, line, edits):
    out = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.33:
            out.insert(at, rng.choice("xyz"))
        elif kind < 0.66:
            out.pop(at)
        else:
            out[at] = rng.choice("xyz")
    return "".join(out)


def documents(seed, texts):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(20, 40))) for _ in range(8)]
    out = []
    for k in range(texts):
        own = [changed(rng, rng.choice(base), rng.randint(0, 5)) for _ in range(rng.randint(0, 4))]
        out.append((k, "\n".join(own + rng.choice([[], [""], ["short"], ["  "], ["\t"]]))))
    return [*out, (1000, None), (None, base[0]), (1001, ""), (1001, base[1]), (1002, base[2]), (1002, base[2])]


def expected(rows, edits):
    lines = [(d, n, x) for d, t in rows if d is not None and t is not None for n, x in enumerate(t.split("\n")) if x.strip(" \t\r\f\v")]
    texts = sorted({x for *_, x in lines})
    parent = {x: x for x in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(texts):
        for b in texts[k + 1 :]:
            if min(len(a), len(b)) >= line_dedup.MIN_LENGTH and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                parent[root(a)] = root(b)
    first = {}
    for d, n, x in sorted(lines):
        first.setdefault(root(x), (d, n))
    return {(d, n): (*first[root(x)], first[root(x)] == (d, n)) for d, n, x in lines}


@pytest.mark.parametrize("seed,texts,edits", [(1, 50, 3), (2, 50, 1), (3, 140, 3)])
def test_equals_brute_force(frame, seed, texts, edits):
    rows = documents(seed, texts)
    got = line_dedup.classes(frame(rows), edits=edits).collect()
    assert {(r.doc_id, r.line_no): (r.rep_doc_id, r.rep_line_no, r.kept) for r in got} == expected(rows, edits)


@pytest.mark.parametrize("block", [600, 20])
def test_links_of_large_groups_are_all_counted(frame, monkeypatch, block):
    """Groups beyond SMALL_GROUP, in one block and in many, whose pairs share several meetings."""
    monkeypatch.setattr(line_dedup.meetings, "SMALL_GROUP", 4)
    monkeypatch.setattr(line_dedup.meetings, "BLOCK", block)
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(24, 60))) for _ in range(3)]
    rows = [(k, changed(rng, base[k % 3 if k % 5 else 0], rng.randint(0, 3))) for k in range(150)]
    texts = {d: x for d, x in rows}
    different = set(texts.values())
    near = {x: sum(y != x and min(len(x), len(y)) >= line_dedup.MIN_LENGTH and distance(x, y) <= 3 for y in different) for x in different}
    got = {r.doc_id: r.n_links for r in line_dedup.classes(frame(rows)).collect()}
    assert got == {d: near[x] for d, x in rows}
    assert max(got.values()) > 40


def test_many_pairs_at_once():
    rng = random.Random(5)
    for edits in (0, 1, 3, 5):
        texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 12))) for _ in range(60)]
        a, b = (x.ravel() for x in np.indices((60, 60)))
        got = line_dedup.pairs_within_edits([x.encode() for x in texts], a, b, edits)
        assert got.tolist() == [distance(texts[x], texts[y]) <= edits for x, y in zip(a, b)]


def test_texts_keep_their_first_lines(frame):
    line = "this line stands in every document of the table"
    rows = [(1, f"{line}\n\nown one\n"), (2, f"own two\n{line}x"), (3, None), (4, ""), (5, line)]
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(frame(rows)).collect()}
    assert got == {1: f"{line}\n\nown one\n", 2: "own two", 3: None, 4: "", 5: ""}


def test_banded_distance():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b = changed(rng, a, rng.randint(0, 5)) if len(a) > 5 else "".join(rng.choice("abc") for _ in range(4))
        for edits in range(5):
            assert line_dedup.within_edits(a, b, edits) == (distance(a, b) <= edits)


def test_long_line_and_empty_table(frame):
    rows = [(1, "ab c" * 50_000), (2, "ab c" * 50_000 + "d"), (3, "x" * 100)]
    got = {r.doc_id: r.kept for r in line_dedup.classes(frame(rows)).collect()}
    assert got == {1: True, 2: False, 3: True}
    assert line_dedup.classes(frame([])).collect() == []


def test_columns_of_any_name_stay_and_equal_ids_lose_their_own_lines(llm):
    line = "the very same line stands in both of them"
    rows = [
        (1, f"{line}\nfirst of all", "a", 1),
        (2, f"alone here\n{line}", "b", 2),
        (2, f"kept in the other text\nwith this line of its own\n{line}", "c", 3),
        (2, f"alone here\n{line}", "d", 4),
        (None, line, None, None),
        (4, None, "e", 5),
    ]
    docs = llm.createDataFrame(rows, "doc_id int, text string, _of string, _gone long")
    out = line_dedup.deduplicated(docs)
    assert out.schema == docs.schema
    texts = {r._gone: r.text for r in out.collect()}
    assert texts == {1: rows[0][1], 2: "alone here", 3: "kept in the other text\nwith this line of its own", 4: "alone here", None: line, 5: None}
    assert line_dedup.deduplicated(docs.limit(0)).collect() == []


def test_a_slice_is_signed_in_parts():
    rng = np.random.default_rng(5)
    buf = rng.integers(97, 123, line_dedup.SLICE_BYTES).astype(np.uint8)
    buf[80::81] = 0x0A
    offsets = np.array([0, len(buf) // 2, len(buf)])

    def signed():
        points, bounds, names = line_dedup.different_lines(buf, offsets, 24)
        return points, bounds, names, line_dedup.pair_sketches(points, bounds), line_dedup.signatures(points, bounds, 3)

    signed()
    tracemalloc.start()
    points, bounds, names, sketch, (found, owner, role) = signed()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Some fifty bytes a byte of text when all lines were taken at once.
    assert peak < 36 * len(buf)
    assert len(names) == len(sketch) == len(bounds) - 1 > 2 * line_dedup.LINES_AT_ONCE
    for k in (0, 511, 512, 13_000, len(names) - 1):
        alone = points[bounds[k] : bounds[k + 1]], np.array([0, bounds[k + 1] - bounds[k]])
        assert (line_dedup.pair_sketches(*alone)[0] == sketch[k]).all()
        own = sorted(zip(found[owner == k].tolist(), role[owner == k].tolist()))
        assert own == sorted(zip(*(x.tolist() for x in line_dedup.signatures(*alone, 3)[::2])))


def test_hashes_of_spans_do_not_depend_on_the_parts():
    rng = np.random.default_rng(6)
    buf = rng.integers(0, 256, 3 * ragged.SPANS_AT_ONCE).astype(np.uint8)
    cuts = np.sort(np.append(rng.choice(len(buf), 4000), [0, 0, 7, 7]))
    # A span that is longer than a part, and empty ones; with and without gaps.
    cuts = cuts[(cuts < 100_000) | (cuts > 100_000 + 2 * ragged.SPANS_AT_ONCE)]
    for starts, ends in ((cuts[:-1], cuts[1:]), (cuts[:-1:2], cuts[1::2])):
        one, two = ragged.families_of_hashes(buf, starts, ends, (0, 1))
        for k in rng.choice(len(starts), 50):
            assert ragged.span_hashes(buf, starts[k : k + 1], ends[k : k + 1])[0] == one[k]
            assert ragged.span_hashes(buf, starts[k : k + 1], ends[k : k + 1], 1)[0] == two[k]


def test_a_slice_is_signed_in_less_memory():
    rng = np.random.default_rng(5)
    buf = rng.integers(97, 123, line_dedup.SLICE_BYTES).astype(np.uint8)
    buf[80::81] = 0x0A
    offsets = np.array([0, len(buf) // 2, len(buf)])

    def signed():
        points, bounds, _ = line_dedup.different_lines(buf, offsets, 24)
        return line_dedup.pair_sketches(points, bounds), line_dedup.signatures(points, bounds, 3)

    ragged._powers.cache_clear()
    tracemalloc.start()
    signed()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Thirty bytes a byte of text when points were valued all at once and half a slice was signed together.
    assert peak < 25 * len(buf)


def test_points_of_spans_are_those_of_code_points():
    texts = ["", "aé", "", "漢字 x", "\U0001f600", ""]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(x.encode()) for x in texts)])
    for one, two in zip(ragged.points_of_spans(buf, offsets), ragged.code_points(buf, offsets)):
        assert one.tolist() == two.tolist()
    assert [x.tolist() for x in ragged.points_of_spans(buf[:0], offsets[:1])] == [[], [0]]


def test_a_worker_gives_free_memory_back():
    """What lies free between small arrays that stay is not the process's own any more once the slices are through."""
    script = """
import re
import numpy as np, pyarrow as pa
from millrace.llm import ragged

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

small = []
for batch in ragged.slices([pa.record_batch([pa.array(["x"])], ["text"])], "text"):
    before = held()
    large = []
    for _ in range(2000):
        large.append(np.ones(60_000, np.uint8))
        small.append(np.ones(2_000, np.uint8))
    del large
print(held() - before)
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, cwd=str(ragged.__file__).rsplit("/millrace/", 1)[0])
    assert float(out.stdout) < 40

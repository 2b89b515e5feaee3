"""Lines of growing files, and pieces that begin within a line."""

import io
import os

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from millrace.sources import growing
from millrace.streaming import tables


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé\r", max_size=9), max_size=12), st.integers(1, 12), st.integers(0, 3))
def test_pieces_give_every_line_once(texts, size, known):
    lines = [t.encode() for t in texts]
    data = b"".join(line + b"\n" for line in lines)
    first = sum(len(line) + 1 for line in lines[:known])
    reader = growing.LineReader("/none", size)
    found = []
    for piece in reader.partitions({"f": first}, {"f": len(data)}):
        for batch in growing._lines(pa.PythonFile(io.BytesIO(data), "r"), piece):
            found += zip(batch["position"].to_pylist(), batch["value"].to_pylist())
    at, expected = first, []
    for line in lines[known:]:
        expected.append((at, line.removesuffix(b"\r").decode()))
        at += len(line) + 1
    assert found == expected


def test_blocks_smaller_than_lines(monkeypatch):
    monkeypatch.setattr(growing, "BLOCK", 3)
    data = b"one long line\n\nb\n" * 3
    pieces = growing.LineReader("/none", 5).partitions({}, {"f": len(data)})
    found = [v for p in pieces for b in growing._lines(pa.PythonFile(io.BytesIO(data), "r"), p) for v in b["value"].to_pylist()]
    assert found == ["one long line", "", "b"] * 3


def test_offsets_stop_at_finished_lines(tmp_path):
    reader = growing.LineReader(str(tmp_path), 100)
    assert reader.latestOffset() == {}
    (tmp_path / "a.log").write_bytes(b"one\ntwo\nthr")
    (tmp_path / "_SUCCESS").write_bytes(b"x\n")
    (tmp_path / "b.log").write_bytes(b"no end")
    assert reader.latestOffset() == {"a.log": 8}
    with open(tmp_path / "a.log", "ab") as file:
        file.write(b"ee\n")
    assert reader.latestOffset() == {"a.log": 14} == growing.LineReader(str(tmp_path), 100).latestOffset()
    (tmp_path / "a.log").write_bytes(b"one\n")
    with pytest.raises(ValueError, match="only grow"):
        reader.partitions({"a.log": 14}, reader.latestOffset())


def test_growing_file_over_restarts(spark, tmp_path):
    """A line split between two turns arrives once, whole, in the later one; nothing comes twice after a restart."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    os.mkdir(folder)
    turns = [[("a", b"1 first\n2 sec")], [("a", b"ond\n"), ("b", b"3 third\r\n\xff\n")], [], [("b", b"5 fifth\n6 open")]]
    counts = []
    for turn in turns:
        for name, data in turn:
            with open(folder / name, "ab") as file:
                file.write(data)
        stream = growing.growing_lines(spark, str(folder), piece_bytes=4)
        tables.drain(tables.append_table(stream, out))
        counts.append(tables.read_appended(spark, out).count())
    found = {(r.file, r.position, r.value) for r in tables.read_appended(spark, out).collect()}
    assert counts == [1, 4, 4, 5]
    assert found == {("a", 0, "1 first"), ("a", 8, "2 second"), ("b", 0, "3 third"), ("b", 9, "�"), ("b", 11, "5 fifth")}

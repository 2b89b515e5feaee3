"""A stream of lines from files that grow.

Spark's file source takes a file once, as it is when it is first seen. This
source follows files that producers append to: an offset is the number of bytes
of every file up to its last finished line, so a batch is a fixed range of bytes
of each file. Replaying it after a crash gives the same lines, and a line that is
still being written waits for its end.

The driver lists the folder and looks for the last line break of files that
grew; tasks read the bytes, in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing_lines"
SCHEMA = "file string, position long, value string"
BLOCK = 1 << 20
PIECE_BYTES = 64 << 20


@dataclass
class Piece(InputPartition):
    """Lines of a file that begin at ``start`` or later and before ``stop``; ``first`` begins a line."""

    file: str
    first: int
    start: int
    stop: int
    end: int


class GrowingLines(DataSource):
    """Options: ``path``, a folder that every executor reaches, and ``pieceBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineReader:
        return LineReader(self.options["path"], int(self.options.get("pieceBytes", PIECE_BYTES)))


class LineReader(DataSourceStreamReader):
    def __init__(self, path: str, piece_bytes: int):
        self.path, self.piece_bytes = path, piece_bytes
        self.seen: dict[str, tuple[int, int]] = {}

    def _folder(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Bytes of finished lines of every file. Names that begin with a dot or an underline are left out."""
        system, folder = self._folder()
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        for info in found:
            if info.type != fs.FileType.File or info.base_name[0] in "._":
                continue
            size, done = self.seen.get(info.base_name, (0, 0))
            if info.size != size:
                done = _finished(system, info.path, done if info.size > size else 0, info.size)
                self.seen[info.base_name] = (info.size, done)
        return {name: done for name, (_, done) in sorted(self.seen.items()) if done}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Pieces of the bytes between two offsets. A file that was cut short or has gone ends the query."""
        pieces = []
        for name in sorted(start.keys() | end.keys()):
            first, stop = start.get(name, 0), end.get(name, 0)
            if stop < first:
                raise ValueError(f"{name} had {first} bytes and now has {stop}; files may only grow")
            for at in range(first, stop, self.piece_bytes):
                pieces.append(Piece(name, first, at, min(at + self.piece_bytes, stop), stop))
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, folder = self._folder()
        with system.open_input_file(f"{folder}/{partition.file}") as file:
            yield from _lines(file, partition)

    def commit(self, end: dict) -> None:
        pass


def _finished(system: fs.FileSystem, path: str, done: int, size: int) -> int:
    """Place after the last line break before ``size``, or ``done`` if none follows it."""
    with system.open_input_file(path) as file:
        stop = size
        while stop > done:
            begin = max(done, stop - BLOCK)
            file.seek(begin)
            at = file.read(stop - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            stop = begin
    return done


def _lines(file: pa.NativeFile, piece: Piece) -> Iterator[pa.RecordBatch]:
    """Lines of a piece in batches of about a block; a line that begins before ``stop`` is read to its end."""
    # One byte earlier shows whether a line begins at the start of the piece.
    at = piece.start if piece.start == piece.first else piece.start - 1
    skipping = at < piece.start
    rest = b""
    position = at
    file.seek(at)
    while position < piece.stop and (block := file.read(min(BLOCK, piece.end - at))):
        at += len(block)
        rest += block
        if skipping:
            cut = rest.find(b"\n") + 1
            if not cut:
                position, rest = at, b""
                continue
            position, rest, skipping = position + cut, rest[cut:], False
        cut = rest.rfind(b"\n") + 1
        whole, rest = rest[:cut], rest[cut:]
        places, values = [], []
        for line in whole.split(b"\n")[:-1]:
            if position >= piece.stop:
                break
            places.append(position)
            values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
            position += len(line) + 1
        if values:
            yield pa.record_batch(
                [pa.array([piece.file] * len(values)), pa.array(places, pa.int64()), pa.array(values)],
                ["file", "position", "value"],
            )


def growing_lines(spark: SparkSession, folder: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Lines (file, position of their first byte, value) of the files of a folder, as they grow and as files come.

    Bytes that are no UTF-8 become replacement characters, and a carriage return at the end of a line goes.
    """
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).option("pieceBytes", str(piece_bytes)).load(folder)

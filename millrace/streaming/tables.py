"""Where streaming results go.

Update-mode aggregates are written as one folder of changed rows per batch and
read back with the last write per key. Batch folders are overwritten when a
batch is retried, so every batch counts exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.layout import reused
from millrace.operators.windows import latest_per_key

BATCH = "batch_id"


_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def drain(writer: DataStreamWriter, closing_batch: bool = True) -> None:
    """Process everything that has arrived, then stop.

    With a watermark Spark ends with an empty batch that emits and clears
    expired state. Update-mode results do without: they were emitted when they
    changed, and the next batch with data clears the state.
    """
    conf = SparkSession.active().conf
    before = conf.get(_EMPTY_BATCHES)
    conf.set(_EMPTY_BATCHES, str(closing_batch).lower())
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        conf.set(_EMPTY_BATCHES, before)
    query.awaitTermination()


def run_for(writer: DataStreamWriter, seconds: int, every: str = "5 seconds") -> None:
    """Process in intervals for a limited time."""
    query = writer.trigger(processingTime=every).start()
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


def per_batch(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> DataStreamWriter:
    """Hand every micro-batch to a function as an ordinary frame."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)


def batch_report(
    stream: DataFrame, out: str, report: Callable[[DataFrame], DataFrame], mode: str = "append"
) -> DataStreamWriter:
    """Write ``report(batch)`` of every micro-batch to its own folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        report(batch).write.mode("overwrite").parquet(f"{out}/data/{BATCH}={batch_id}")

    return per_batch(stream, f"{out}/checkpoint", handle, mode)


def changes_table(
    aggregate: DataFrame, out: str, keys: Sequence[str] | None = None, compact_every: int | None = None
) -> DataStreamWriter:
    """Write the rows an update-mode aggregate changed in every micro-batch.

    With ``keys`` and ``compact_every`` the batches before the current one are
    folded into a base each time so many have come together.
    """
    schema = aggregate.schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/{BATCH}={batch_id}")
        if keys and compact_every and batch_id and batch_id % compact_every == 0:
            compact(batch.sparkSession, out, schema, keys, batch_id - 1)

    return per_batch(aggregate, f"{out}/checkpoint", handle, "update")


def read_batches(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(with_batch).parquet(f"{out}/data")


def _fs(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _numbered(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the finished folders ``prefix=number`` below a folder, ascending."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    names = {s.getPath().getName(): s.getPath() for s in fs.listStatus(path)}
    done = [name for name, at in names.items() if name.startswith(f"{prefix}=") and fs.exists(at.suffix("/_SUCCESS"))]
    return sorted(int(name.partition("=")[2]) for name in done)


def finished_batches(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the batches below ``out`` that are written in full, ascending."""
    return _numbered(spark, f"{out}/data", BATCH)


def _changes_since(spark: SparkSession, out: str, schema: T.StructType, bases: list[int], upto: int | None = None) -> DataFrame:
    """The newest finished base, if there is one, and the batches after it."""
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    batches = [n for n in _numbered(spark, f"{out}/data", BATCH) if (not bases or n > bases[-1]) and (upto is None or n <= upto)]
    reader = spark.read.schema(with_batch)
    found = [reader.parquet(f"{out}/base/upto={bases[-1]}")] if bases else []
    if batches:
        # Their batch numbers are read from the names of the folders.
        paths = [f"{out}/data/{BATCH}={n}" for n in batches]
        found.append(reader.option("basePath", f"{out}/data").parquet(*paths))
    if not found:
        return spark.createDataFrame([], with_batch)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def read_latest(spark: SparkSession, out: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Current value per key: the last batch that changed it wins. Reads the newest base and the batches after it."""
    changes = _changes_since(spark, out, schema, _numbered(spark, f"{out}/base", "upto"))
    return latest_per_key(changes, keys, [F.col(BATCH).desc()]).drop(BATCH)


def compact(spark: SparkSession, out: str, schema: T.StructType, keys: Sequence[str], upto: int | None = None) -> int | None:
    """Write the last value per key up to a batch as a new base, then remove what it replaces.

    ``upto`` is the last finished batch unless it is named; a batch that may
    still be retried must not be folded in, so name the one before it while a
    query runs. A base counts once its _SUCCESS is there: a crash before that
    leaves the old base and its batches in use, and a crash afterwards leaves
    files that nobody reads and that the next call removes. Readers that began
    before the call may lose their files; they read again.
    """
    batches, bases = _numbered(spark, f"{out}/data", BATCH), _numbered(spark, f"{out}/base", "upto")
    batches = [n for n in batches if upto is None or n <= upto]
    last = batches[-1] if batches else None
    if last is not None and (not bases or last > bases[-1]):
        changes = _changes_since(spark, out, schema, bases, last)
        latest = latest_per_key(changes, keys, [F.col(BATCH).desc()])
        latest.write.mode("overwrite").parquet(f"{out}/base/upto={last}")
        bases.append(last)
    for folder, prefix, old in ((f"{out}/data", BATCH, [n for n in batches if bases and n <= bases[-1]]), (f"{out}/base", "upto", bases[:-1])):
        for n in old:
            fs, path = _fs(spark, f"{folder}/{prefix}={n}")
            fs.delete(path, True)
    return bases[-1] if bases else None


def append_table(stream: DataFrame, out: str) -> DataStreamWriter:
    """Append rows as Parquet with the exactly-once file sink."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .option("path", f"{out}/data")
    )


def read_appended(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/data")


def carried_state(
    stream: DataFrame,
    out: str,
    schema: T.StructType,
    step: Callable[[DataFrame | None, DataFrame], DataFrame],
    after: Callable[[DataFrame, int], None] | None = None,
    each: Callable[[DataFrame | None, DataFrame, int], None] | None = None,
    keep: int | None = 2,
) -> DataStreamWriter:
    """Carry a keyed state from batch to batch as a written table.

    ``step(state, batch)`` returns the new state and runs as an ordinary
    distributed join, so a hot key is handled like in any batch job. ``after``
    sees the new state, ``each`` the state before and the batch. Each batch
    rewrites the state once: choose the trigger interval by the state's size. With
    ``keep`` the folders are reused in turn (the previous state is never the
    one overwritten); with ``None`` every batch keeps its own.
    """

    def folder(batch_id: int) -> str:
        slot = batch_id % keep if keep else batch_id
        return f"{out}/data/{BATCH}={slot}"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0:
            before = spark.read.schema(schema).parquet(folder(batch_id - 1))
        with reused(batch) as rows:
            step(before, rows).write.mode("overwrite").parquet(folder(batch_id))
            if each:
                each(before, rows, batch_id)
        if after:
            after(spark.read.schema(schema).parquet(folder(batch_id)), batch_id)

    return per_batch(stream, f"{out}/checkpoint", handle)


def read_state(spark: SparkSession, out: str, schema: T.StructType, batch_id: int, keep: int = 2) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{out}/data/{BATCH}={batch_id % keep}")

"""Small helpers that the operators share on the Spark side."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.ragged import SLICE_BYTES, slices
from millrace.operators.layout import written
from millrace.session import configure

__all__ = ["map_texts", "named_inside", "only_wanted", "prepared", "written"]


SETTINGS = {
    # A batch of texts stays within a few megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # So do the texts that a task of Spark's reader holds, whose buffers double as they grow.
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    # Where few documents are wanted, Spark filters the others before it shuffles their texts.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "200MB",
}


def prepared(spark: SparkSession) -> SparkSession:
    """Settings of the operators: the library's own, and Arrow batches of a bounded number of texts.

    Python workers look for this package where the driver found it; on a
    cluster it is installed there or passed with ``--py-files``.
    """
    configure(spark)
    environment = spark.sparkContext.environment
    folder = str(Path(__file__).resolve().parents[2])
    if folder not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), folder]))
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def named_inside(label: str) -> str:
    """A column name that no input can clash with."""
    return f"_{label}_{uuid.uuid4().hex[:8]}"


def only_wanted(docs: DataFrame, wanted: DataFrame, how: str = "inner", on: str = "doc_id") -> DataFrame:
    """Join documents with a written table of the wanted ones.

    The comparison, which every id passes, tells Spark that the table is a
    selection, so that it may filter documents by a Bloom filter of the ids
    before it shuffles their texts.
    """
    return docs.join(wanted.filter(F.col(on) >= F.lit(-(2**63)).cast("long")), on, how)


def map_texts(
    df: DataFrame,
    columns: dict[str, str],
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    text: str = "text",
    setup: Callable[[], object] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Apply ``fn`` to batches of about ``limit`` bytes of text.

    ``columns`` maps the names that ``fn`` sees to columns of ``df``; no other
    column is read. ``setup`` runs once a task and its result is passed on.
    """
    chosen = df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = (setup(),) if setup else ()
        for batch in slices(batches, text, limit):
            out = fn(batch, *extra)
            if out is not None and out.num_rows:
                yield out

    return chosen.mapInArrow(run, schema)

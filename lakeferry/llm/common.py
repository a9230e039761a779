"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of whole texts that travel to a Python worker at once, so that its memory stays small.
BATCH_ROWS = 1000

_HELD: dict[Hashable, Any] = {}


def held(kind: Hashable, make: Callable[[], Any]) -> Any:
    """The object a worker process keeps between tasks. Workers serve one operator after another, so
    what is kept for another one is dropped first."""
    if kind not in _HELD:
        _HELD.clear()
        _HELD[kind] = make()
    return _HELD[kind]


def in_small_batches(df: DataFrame) -> DataFrame:
    """The frame, in a session that sends at most ``BATCH_ROWS`` rows an Arrow batch."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def id_text(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` (string) of a documents-like frame and the columns ``more``,
    whatever else it holds."""
    return in_small_batches(df).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more)


def slices(batch: pa.RecordBatch, column: str, chars: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts sum to about ``chars`` bytes (one longer text stays whole)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(
        zero_copy_only=False
    )
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)

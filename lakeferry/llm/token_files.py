"""Token-id output with Elias-Fano document boundaries.

``write`` range-partitions documents by id, encodes whole texts and writes segments; ``documents``
reads them back. A segment is one row of a Parquet file in the shared folder:

    part, seq      place of the segment in the global order
    n_tokens       ids in the segment (the only column the offset pass reads)
    doc_ids        ids of its documents, ascending
    boundaries     Elias-Fano code of the n + 1 document starts inside the segment
    ids            all ids in a row, two bytes each where every id fits, else four

Starts are stored as floor(log2(U / n)) low bits each plus a unary bit vector of the high parts,
about 2 + log2(U / n) bits a document instead of 64. Global starts are never stored: they are the
segment's base (a prefix sum over segment sizes) plus a select in its code.

Defined results: a null text counts as empty (only the end id); a null doc_id sorts first; rows that
repeat a doc_id are kept, ordered by a hash of their texts; no rows give no segments; a text longer
than a segment fills one by itself; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeferry.llm.common import id_text, slices
from lakeferry.llm.tokens import default_vocabulary, encoder

_MAGIC = b"EFB1"
_HEAD = struct.Struct("<4sQQB")
SEGMENT_SCHEMA = (
    "part int, seq int, n_tokens long, doc_ids array<long>, boundaries binary, ids binary"
)


class EliasFano:
    """A non-decreasing sequence of n integers up to ``top``."""

    def __init__(self, n: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.top, self.low_bits = n, top, low_bits
        self._low, self._high = low, high
        self._ones = np.cumsum(_popcount(high), dtype=np.int64)

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << low_bits) - 1)
        bits = (low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        high = np.zeros(n + (top >> low_bits) + 1, np.uint8)
        high[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        return (
            _HEAD.pack(_MAGIC, n, top, low_bits)
            + packed.tobytes()
            + np.packbits(high, bitorder="little").tobytes()
        )

    @classmethod
    def decode(cls, data: bytes) -> EliasFano:
        magic, n, top, low_bits = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not an Elias-Fano code")
        n_low = (n * low_bits + 7) // 8
        body = np.frombuffer(data, np.uint8, offset=_HEAD.size)
        return cls(n, top, low_bits, body[:n_low], body[n_low:])

    def select(self, index: np.ndarray) -> np.ndarray:
        """Values at the given places: the i-th one of the high bits, joined with its low bits."""
        index = np.asarray(index, np.int64)
        byte = np.searchsorted(self._ones, index, side="right")
        before = np.where(byte > 0, self._ones[byte - 1], 0)
        inside = np.unpackbits(self._high[byte][:, None], axis=1, bitorder="little")
        place = np.argmax(np.cumsum(inside, axis=1) == (index - before + 1)[:, None], axis=1)
        high = byte * 8 + place - index
        low = np.zeros(len(index), np.int64)
        for b in range(self.low_bits):
            at = index * self.low_bits + b
            low |= ((self._low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << b
        return (high << self.low_bits) | low


def _popcount(data: np.ndarray) -> np.ndarray:
    return np.bitwise_count(data)


def write(
    docs: DataFrame,
    path: str,
    *,
    vocabulary: str | None = None,
    end_id: int = 0,
    segment_tokens: int = 1 << 18,
    segment_docs: int = 1 << 14,
    partitions: int | None = None,
) -> None:
    """Write the token files of ``docs`` in ascending doc_id order.

    One shuffle, by ranges of (doc_id, hash of the text), so that no doc_id is too hot for a task.
    """
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        encode = encoder(vocabulary).encode
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        ends: list[int] = []
        total = 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            wide = "<u4" if int(ids.max()) > 0xFFFF else "<u2"
            starts = np.concatenate(([0], np.array(ends, np.int64)))
            columns = [[part], [seq], [len(ids)], [list(doc_ids)], [EliasFano.encode(starts)]]
            return pa.record_batch(
                [
                    pa.array(v, t)
                    for v, t in zip(
                        [*columns, [ids.astype(wide).tobytes()]],
                        [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()],
                        strict=True,
                    )
                ],
                names=["part", "seq", "n_tokens", "doc_ids", "boundaries", "ids"],
            )

        for batch in batches:
            for piece in slices(batch, "text"):
                ids, counts = encode(piece.column("text").to_pylist())
                stops = np.cumsum(counts)
                for doc_id, count, stop in zip(
                    piece.column("doc_id").to_pylist(), counts.tolist(), stops.tolist(), strict=True
                ):
                    if doc_ids and (
                        total + count + 1 > segment_tokens or len(doc_ids) >= segment_docs
                    ):
                        yield segment()
                        seq += 1
                        doc_ids, parts, ends, total = [], [], [], 0
                    parts += [ids[stop - count : stop], np.array([end_id], np.uint32)]
                    total += count + 1
                    doc_ids.append(doc_id)
                    ends.append(total)
        if doc_ids:
            yield segment()

    (
        id_text(docs)
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(partitions, "doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
        .mapInArrow(segments, SEGMENT_SCHEMA)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def bases(segments: DataFrame) -> DataFrame:
    """part, seq, base: ids before each segment. Reads the sizes only; sums run per part and over
    the parts' totals, so no task sees all segments."""
    inside = Window.partitionBy("part").orderBy("seq")
    local = segments.select(
        "part", "seq", (F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("_local")
    )
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    over = totals.select(
        "part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before")
    )
    return local.join(over, "part").select(
        "part", "seq", (F.col("_local") + F.col("_before")).alias("base")
    )


def segment_arrays(boundaries: bytes, ids: bytes, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (with the end) and ids of one segment."""
    code = EliasFano.decode(boundaries)
    starts = code.select(np.arange(code.n))
    return starts, np.frombuffer(ids, "<u2" if len(ids) == 2 * n_tokens else "<u4").astype("<u4")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts, ids = segment_arrays(row["boundaries"], row["ids"], row["n_tokens"])
                crc = [
                    zlib.crc32(ids[a:b].tobytes())
                    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
                ]
                n = len(crc)
                yield pa.record_batch(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["seq"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts[:-1], pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "_at", "n_tokens", "ids_crc32"],
                )

    rows = segments.select("part", "seq", "n_tokens", "doc_ids", "boundaries", "ids").mapInArrow(
        read, "part int, seq int, doc_id long, _at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(bases(segments.select("part", "seq", "n_tokens")), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32"
    )

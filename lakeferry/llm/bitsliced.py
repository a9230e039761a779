"""Exact top-k inner products by a bit-sliced index.

Components are quantised to integers ``floor(scale * x)``. Rows are dealt by a hash of the id into
blocks of about ``block_rows``; for every component a block keeps the smallest value and, for each
bit of what lies above it, a bitmap over the block's rows (a slice). A query's scores of a whole
block are then computed by bitmap arithmetic: slices are weighted by the binary digits of the
query's components (the complement of a slice for negative ones, with a constant that is the same for
all rows), equal weights are added by carry-save adders, and what is left is one bitmap per bit of
the score. The best rows are taken from the most significant slice downward: rows with the bit set
are in as long as they are at most k, otherwise the search goes on among them. Rows that tie at the
boundary are resolved by the smaller id. The k best of each block meet in a last exact ranking.

Queries meet blocks as whole groups of queries: one task works on one (block, group of queries).

Defined results: null vectors and vectors with null or non-finite components take no part; a vector so
long that scores could leave 64 bits (its integers' largest square times their number reaches 2**63) is
an error; an id that repeats counts once, with
its smallest vector; only vectors of equal length meet; rows with a null id take no part; ties go to
the smaller id; fewer candidates give fewer rows; columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.session import staged

_LIMIT = 2.0**63
_HEAD = struct.Struct("<III")


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """vec_id, v (integers), one row an id, of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    sound = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )
    most = F.aggregate(v, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x * scale) + 1))
    kept = F.when(F.size(v) * most * most < _LIMIT, F.transform(v, lambda x: F.floor(x * scale))).otherwise(
        F.raise_error(F.concat(F.lit("scores would leave 64 bits: vec_id "), F.col("vec_id").cast("string")))
    )
    return (
        vectors.where(sound)
        .select(F.col("vec_id").cast("long"), v.alias("v"), kept.alias("_kept"))
        .groupBy("vec_id")
        .agg(F.min_by("_kept", "v").alias("v"))
    )


class Slices:
    """The slices of one block: ``ids`` ascending, bitmaps in 64-bit words."""

    def __init__(self, ids: np.ndarray, lows: np.ndarray, maps: list[np.ndarray]) -> None:
        self.ids, self.lows, self.maps = ids, lows, maps
        n = len(ids)
        self.words = -(-n // 64)
        self.everyone = _bitmap(np.ones(n, bool), self.words)
        self._stack: np.ndarray | None = None  # all slices and their complements

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> Slices:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order].astype(np.int64)
        lows = values.min(axis=0) if values.shape[1] else np.zeros(0, np.int64)
        words, maps = -(-len(ids) // 64), []
        for d in range(values.shape[1]):
            above = values[:, d] - lows[d]
            bits = int(above.max()).bit_length()
            maps.append(
                np.stack([_bitmap((above >> b) & 1 == 1, words) for b in range(bits)])
                if bits
                else np.zeros((0, words), np.uint64)
            )
        return cls(ids, lows, maps)

    def to_bytes(self) -> bytes:
        n_bits = np.array([len(m) for m in self.maps], "<u4")
        head = _HEAD.pack(len(self.ids), len(self.maps), self.words)
        parts = [head, self.ids.astype("<i8").tobytes(), self.lows.astype("<i8").tobytes(), n_bits.tobytes()]
        return b"".join(parts + [m.astype("<u8").tobytes() for m in self.maps])

    @classmethod
    def from_bytes(cls, data: bytes) -> Slices:
        n, dims, words = _HEAD.unpack_from(data)
        at = _HEAD.size
        ids = np.frombuffer(data, "<i8", n, at)
        lows = np.frombuffer(data, "<i8", dims, at := at + 8 * n)
        bits = np.frombuffer(data, "<u4", dims, at := at + 8 * dims)
        at += 4 * dims
        maps = []
        for b in bits.tolist():
            maps.append(np.frombuffer(data, "<u8", b * words, at).reshape(b, words))
            at += 8 * b * words
        return cls(ids, lows, maps)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the score's bits, least first, and a constant to add to every score."""
        if self._stack is None:
            plain = np.concatenate([*self.maps, np.zeros((0, self.words), np.uint64)])
            self._stack = np.concatenate((plain, ~plain))
        half, first = len(self._stack) // 2, 0
        picked: dict[int, list[int]] = {}
        constant = 0
        for d, q in enumerate(query.tolist()):
            constant += q * int(self.lows[d])
            bits, size, k = len(self.maps[d]), abs(q), 0
            if q < 0:  # -|q| u  =  |q| (2**bits - 1 - u) - |q| (2**bits - 1)
                constant += q * ((1 << bits) - 1)
            base = first + half if q < 0 else first
            first += bits
            while size:
                if size & 1:
                    for b in range(bits):
                        picked.setdefault(b + k, []).append(base + b)
                size >>= 1
                k += 1
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        at = 0
        while picked or carried:
            column = np.concatenate([self._stack[picked.pop(at, [])], *carried])
            carried = []
            while len(column) > 2:  # full adders on thirds of the column
                t = len(column) // 3
                a, b, c = column[:t], column[t : 2 * t], column[2 * t : 3 * t]
                either = a ^ b
                carried.append((a & b) | (either & c))
                column = np.concatenate((either ^ c, column[3 * t :]))
            if len(column) == 2:
                carried.append(column[:1] & column[1:])
                column = column[:1] ^ column[1:]
            out.append(column[0] if len(column) else np.zeros(self.words, np.uint64))
            at += 1
        return out, constant

    def top(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but ``own``, ties to the smaller id."""
        bits, constant = self.scores(query)
        open_ = self.everyone.copy()
        if own is not None:
            at = int(np.searchsorted(self.ids, own))
            if at < len(self.ids) and self.ids[at] == own:
                open_[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
        sure = np.zeros_like(open_)
        n_sure = 0
        for one in reversed(bits):
            among = open_ & one
            n = n_sure + int(np.bitwise_count(among).sum())
            if n > k:
                open_ = among
            else:
                sure |= among
                n_sure = n
                open_ &= ~one
                if n == k:
                    break
        rows = _rows(sure)
        if n_sure < k:
            rows = np.concatenate((rows, _rows(open_)[: k - n_sure]))
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        # sums in between may leave 64 bits, the score does not: all of it modulo 2**64
        score = np.full(len(rows), (constant + (1 << 63)) % (1 << 64) - (1 << 63), np.int64)
        for i, one in enumerate(bits[:64]):
            score += ((one[word] >> bit) & np.uint64(1)).astype(np.int64) << i
        return self.ids[rows], score


def _bitmap(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 64, np.uint8)
    out[: len(flags)] = flags
    return np.packbits(out, bitorder="little").view(np.uint64)


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.int64)


def build(rows: DataFrame, block_rows: int) -> DataFrame:
    """dims, block, slices: the index of quantised rows."""
    n = rows.count()
    blocks = max(1, -(-n // block_rows))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["vec_id"].to_numpy(np.int64)
        values = _matrix(pdf["v"]) if int(pdf["dims"].iloc[0]) else np.zeros((len(ids), 0), np.int64)
        data = Slices.build(ids, values).to_bytes()
        return pd.DataFrame(
            {"dims": pdf["dims"].iloc[:1], "block": pdf["block"].iloc[:1], "slices": [data]}
        )

    return (
        rows.withColumn("dims", F.size("v"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
        .groupBy("dims", "block")
        .applyInPandas(make, "dims int, block long, slices binary")
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    *,
    scale: float = 64.0,
    block_rows: int = 1 << 14,
    queries_per_task: int = 1 << 10,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query but itself."""
    spark = vectors.sparkSession
    rows = staged(quantised(vectors, scale), "sliced-rows")
    index = staged(build(rows, block_rows), "sliced-index")
    queries = rows.where(is_query).select("vec_id", "v", F.size("v").alias("dims"))
    groups = max(1, -(-queries.count() // queries_per_task))
    queries = queries.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(groups)))
    # block numbers are repeated for each group of queries, and queries for each block, so that a
    # (block, group) pair is one key; slices move once a group, queries once a block
    blocks = index.select(F.col("dims").alias("dims"), F.col("block").alias("block"))
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    right = queries.join(blocks, "dims").select("dims", "block", "part", "vec_id", "v")

    def search(_, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out_q, out_id, out_s = [], [], []
        for data in block["slices"]:
            own = Slices.from_bytes(data)
            for vec_id, v in zip(asked["vec_id"], asked["v"], strict=True):
                ids, scores = own.top(np.asarray(v, np.int64), vec_id, k)
                out_q.append(np.full(len(ids), vec_id))
                out_id.append(ids)
                out_s.append(scores)
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_id, out_s)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), joined, strict=True)))

    keys = ["dims", "block", "part"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = (
        left.repartition(tasks, *keys)
        .groupBy(*keys)
        .cogroup(right.repartition(tasks, *keys).groupBy(*keys))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

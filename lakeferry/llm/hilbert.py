"""Approximate nearest neighbours by shifted space-filling curves.

Each of several orderings projects unit vectors onto a few random orthogonal directions, shifts the
grid by a random amount and numbers its cells along a Hilbert curve. An ordering is cut at quantiles
of its keys into ranges of about ``range_rows`` rows; a query visits the ranges around its own key in
every ordering, each visited range gives its nearest rows by exact cosine, and the lists are merged
and ranked again.

How many ranges a query visits is fitted: a bounded sample of queries is compared with all rows, and
the window is the smallest share of an ordering for which the sample's true neighbours lie inside one
of the windows as often as ``recall`` asks. Structured vectors get narrow windows; vectors that are
nearly isotropic in many dimensions have no order that keeps neighbours together and get wide ones.

Equal vectors are one point: only its k + 1 smallest ids can appear in an answer, and a query that
repeats is searched once. Keys carry 16 low bits of a hash, so equal keys are spread over ranges.

Defined results: null, empty and zero vectors and vectors with null or non-finite components take no
part, nor do rows with a null id; an id that repeats counts once, with its smallest vector; only
vectors of equal length meet; ties go to the smaller id; fewer candidates give fewer rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.session import staged

_HASH_BITS = 16


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of integer coordinates (``bits`` bits each)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of the curve from the coarsest level down
        for i in range(n):
            set_ = (x[i] & q) > 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(set_, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        gray = np.where((x[n - 1] & q) > 0, gray ^ (q - 1), gray)
        q >>= 1
    x ^= gray
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Orderings:
    """Random directions and shifts for vectors of one length, the same on every machine."""

    def __init__(self, dims: int, orderings: int, directions: int, seed: int = 11) -> None:
        rng = np.random.default_rng((seed, dims))
        self.directions = min(directions, dims)
        self.bits = max(1, min(12, 36 // self.directions))
        self.axes = [
            np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, : self.directions] for _ in range(orderings)
        ]
        self.shifts = [rng.uniform(0, 1, self.directions) for _ in range(orderings)]
        # unit vectors: a projection has a spread of about dims ** -0.5
        self.width = 8 / np.sqrt(dims)

    def keys(self, unit: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """(orderings, rows) keys as whole numbers in float64."""
        low = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _HASH_BITS)
        top = (1 << self.bits) - 1
        out = []
        for axes, shift in zip(self.axes, self.shifts, strict=True):
            place = (unit @ axes / self.width + 0.5 + (shift - 0.5) * 0.25) * top
            key = hilbert_keys(np.clip(place, 0, top).astype(np.int64), self.bits)
            out.append((key * (1 << _HASH_BITS) + low.astype(np.int64)).astype(np.float64))
        return np.array(out)


def _sound(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part, one row an id."""
    v = F.col("embedding").cast("array<double>")
    fine = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
        & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )
    return (
        vectors.where(fine)
        .select(F.col("vec_id").cast("long"), v.alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def _unit(values) -> np.ndarray:
    m = np.stack([np.asarray(v, np.float64) for v in values])
    m = m / np.abs(m).max(axis=1, keepdims=True)  # far from over- and underflow
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _best(unit: np.ndarray, ids: list[list[int]], asked: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, id, score) of the k best rows of a block for each asked vector, ids of equal
    vectors spread out."""
    rows, found, scores = [], [], []
    for a in range(0, len(asked), 256):
        s = asked[a : a + 256] @ unit.T
        if s.shape[1] > k:
            edge = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            q, r = np.nonzero(s >= edge[:, None] - 1e-12)
        else:
            q, r = (x.ravel() for x in np.indices(s.shape))
        for i, j in zip(q.tolist(), r.tolist(), strict=True):
            for one in ids[j]:
                rows.append(a + i)
                found.append(one)
                scores.append(s[i, j])
    return np.array(rows, np.int64), np.array(found, np.int64), np.array(scores, np.float64)


def _points(rows: DataFrame, k: int) -> DataFrame:
    """point (smallest id), v, ids (the k + 1 smallest) of each distinct vector."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("_nth", nth).where(F.col("_nth") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.element_at("ids", 1).alias("point"), "v", "ids"
    )


def _keyed(points: DataFrame, orderings: int, directions: int) -> DataFrame:
    """point, dims and the key in each ordering."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            for dims, part in pdf.groupby(pdf["v"].map(len)):
                own = Orderings(int(dims), orderings, directions)
                keys = own.keys(_unit(part["v"]), part["point"].to_numpy())
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame({"point": part["point"].to_numpy(), "dims": np.int32(dims), "keys": list(keys.T)}),
                    preserve_index=False,
                )

    return points.select("point", "v").mapInArrow(work, "point long, dims int, keys array<double>")


def _quantiles(keyed: DataFrame, orderings: int, grid: list[float], error: float) -> list[list[float]]:
    columns = [f"_{o}" for o in range(orderings)]
    if not grid:
        return [[] for _ in columns]
    split = keyed.select(*[F.col("keys")[o].alias(c) for o, c in enumerate(columns)])
    return [m or [0.0] * len(grid) for m in split.approxQuantile(columns, grid, error)]


def _fitted_share(
    points: DataFrame, keyed: DataFrame, k: int, orderings: int, recall: float, sample: int, n: int
) -> float:
    """Half the window of an ordering, as a share of its rows, for ``recall`` on sampled points."""
    share = max(1, int(sample / max(n, 1) * (1 << 20)))
    asked = points.where(F.pmod(F.xxhash64(F.lit(5), "point"), F.lit(1 << 20)) < share)
    asked = asked.select("point", "v").orderBy(F.xxhash64(F.lit(5), "point")).limit(sample).collect()
    by_dims: dict[int, list] = {}
    for row in asked:
        by_dims.setdefault(len(row["v"]), []).append(row)
    queries = {d: (np.array([r["point"] for r in rs]), _unit([r["v"] for r in rs])) for d, rs in by_dims.items()}
    if not queries:
        return 0.5

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            for dims, part in pdf.groupby(pdf["v"].map(len)):
                if dims not in queries:
                    continue
                names, unit = queries[dims]
                ids = [[i] for i in part["point"].tolist()]
                q, found, scores = _best(_unit(part["v"]), ids, unit, k + 1)
                keep = names[q] != found
                yield pa.record_batch(
                    [pa.array(names[q][keep]), pa.array(found[keep]), pa.array(scores[keep])],
                    names=["query", "point", "score"],
                )

    near = points.select("point", "v").mapInArrow(scan, "query long, point long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    true = near.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= k)
    at = keyed.select("point", "keys")
    pairs = (
        true.join(at, "point")
        .join(at.select(F.col("point").alias("query"), F.col("keys").alias("own")), "query")
        .select("keys", "own")
        .collect()
    )
    if not pairs:
        return 0.5
    # places of keys in their ordering, from quantiles
    grid = np.linspace(0, 1, 513)
    gaps = np.ones(len(pairs))
    for o, marks in enumerate(_quantiles(keyed, orderings, grid.tolist(), 0.001)):
        a = np.interp([p["keys"][o] for p in pairs], marks, grid)
        b = np.interp([p["own"][o] for p in pairs], marks, grid)
        gaps = np.minimum(gaps, np.abs(a - b))
    return float(np.quantile(gaps, recall))


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    *,
    orderings: int = 4,
    directions: int = 3,
    range_rows: int = 4096,
    recall: float = 0.96,
    sample: int = 128,
    queries_per_task: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every query but itself."""
    rows = staged(_sound(vectors), "curve-rows")
    points = staged(_points(rows, k), "curve-points")
    keyed = staged(_keyed(points, orderings, directions), "curve-keys")
    n = points.count()
    half = _fitted_share(points, keyed, k, orderings, recall, sample, n)
    ranges = max(1, -(-n // range_rows))
    reach = int(np.ceil(half * ranges))
    grid = [i / ranges for i in range(1, ranges)]
    # ranges - 1 marks an ordering: bounded by rows / range_rows
    marks = _quantiles(keyed, orderings, grid, max(0.1 / ranges, 1e-5))

    def place(pdf_keys: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(m, pdf_keys[:, o], side="right") for o, m in enumerate(marks)], axis=1)

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack(batch.column("keys").to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, orderings))
            yield pa.record_batch(
                [batch.column("point"), batch.column("dims"), pa.array(list(place(keys)), pa.list_(pa.int64()))],
                names=["point", "dims", "ranges"],
            )

    asked_rows = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    asked = staged(
        asked_rows.join(points.select("v", "point"), "v").select("query_id", "point"), "curve-queries"
    )
    asked_count = asked.count()
    placed = staged(keyed.mapInArrow(ranged, "point long, dims int, ranges array<long>"), "curve-ranges")
    left = points.join(placed, "point").select(
        "dims", F.posexplode("ranges").alias("ordering", "range"), "v", "ids"
    )
    # a range meets its visitors in parts of bounded size
    parts = max(1, -(-asked_count // queries_per_task))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    once = asked.select("point").distinct().join(points.select("point", "v"), "point")
    visits = (
        once.join(placed, "point")
        .select("point", "v", "dims", F.posexplode("ranges").alias("ordering", "own"))
        .select(
            "point",
            "v",
            "dims",
            "ordering",
            F.explode(
                F.sequence(
                    F.greatest(F.col("own") - reach, F.lit(0)),
                    F.least(F.col("own") + reach, F.lit(ranges - 1)),
                )
            ).alias("range"),
        )
        .withColumn("part", F.pmod(F.hash("point"), F.lit(parts)))
    )

    visits = visits.select(*[F.col(c).alias(c) for c in visits.columns])

    def search(_, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if block.empty or asked.empty:
            return pd.DataFrame({"point": [], "vec_id": [], "score": []})
        q, found, scores = _best(_unit(block["v"]), block["ids"].tolist(), _unit(asked["v"]), k + 1)
        return pd.DataFrame({"point": asked["point"].to_numpy()[q], "vec_id": found, "score": scores})

    keys = ["dims", "ordering", "range", "part"]
    found = (
        left.groupBy(*keys)
        .cogroup(visits.groupBy(*keys))
        .applyInPandas(search, "point long, vec_id long, score double")
        # a row met in several orderings counts once
        .groupBy("point", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    top = Window.partitionBy("point").orderBy(F.desc("score"), "vec_id")
    merged = found.withColumn("_nth", F.row_number().over(top)).where(F.col("_nth") <= k + 1)
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(merged, "point")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

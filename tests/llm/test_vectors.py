import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeferry.llm import bitsliced, hilbert

SCHEMA = "vec_id long, embedding array<float>, label int, rank int"


def vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0, 0) for i in range(400)]
    rows += [(400 + i, rows[7][1], 0, 0) for i in range(60)]  # one common vector
    rows += [(500, None, 0, 0), (501, [0.0] * 6, 0, 0), (502, [1.0, None] * 3, 0, 0)]
    rows += [(503, [math.nan] * 6, 0, 0), (504, [math.inf] * 6, 0, 0), (None, [1.0] * 6, 0, 0), (505, [], 0, 0)]
    rows += [(3, rows[3][1], 0, 0), (506, [1.0, 2.0], 0, 0), (508, [2.0, 4.0], 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


def sound(df, zero: bool):
    found = {}
    for r in df.collect():
        v = r.embedding
        if r.vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if zero and not any(v):
            continue
        found[r.vec_id] = np.array(v, float)
    return found


def test_exact_top_k_matches_brute_force(spark):
    df = vectors(spark)
    found = {}
    for r in bitsliced.top_k(df, F.col("vec_id") % 3 == 0, 7, block_rows=100, queries_per_task=40).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    rows = {i: np.floor(64 * v).astype(int) for i, v in sound(df, False).items()}
    for q in (i for i in rows if i % 3 == 0):
        other = [(-int(rows[q] @ v), i) for i, v in rows.items() if i != q and len(v) == len(rows[q])]
        expected = {n + 1: (i, -s) for n, (s, i) in enumerate(sorted(other)[:7])}
        assert found.get(q, {}) == expected, q
    assert bitsliced.top_k(df.where("false"), F.lit(True)).collect() == []


def test_large_components_stay(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-(2**23), 2**23, 6)]) for i in range(60)]
    rows += [(60 + i, [float(x) for x in rng.normal(size=6)]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in bitsliced.top_k(df, F.col("vec_id") % 3 == 0, 5).collect()}
    ints = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    for q in range(0, 80, 3):
        other = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)
        assert [got[q, n + 1] for n in range(5)] == [(i, -s) for s, i in other[:5]]
    too_long = spark.createDataFrame([(1, [1e9, 1e9]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        bitsliced.top_k(too_long, F.lit(True)).collect()


def test_neighbours_match_brute_force_with_wide_windows(spark):
    df = vectors(spark)
    found = {}
    for r in hilbert.neighbours(df, F.col("vec_id") % 2 == 0, 5, range_rows=60, recall=1.0).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    rows = {i: v / np.linalg.norm(v) for i, v in sound(df, True).items()}
    hits = total = 0
    for q in (i for i in rows if i % 2 == 0):
        other = [(-round(float(rows[q] @ v), 12), i) for i, v in rows.items() if i != q and len(v) == len(rows[q])]
        expected = [i for _, i in sorted(other)[:5]]
        got = [found.get(q, {})[n + 1][0] for n in range(len(found.get(q, {})))]
        hits += len(set(got) & set(expected))
        total += len(expected)
        for vec_id, score in found.get(q, {}).values():
            assert score == pytest.approx(float(rows[q] @ rows[vec_id]), abs=1e-12)
    assert hits >= 0.97 * total
    assert hilbert.neighbours(df.where("false"), F.lit(True)).collect() == []


def test_recall_on_the_test_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {i: v / np.linalg.norm(v) for i, v in sound(df, True).items()}
    ids = np.array(sorted(rows))
    matrix = np.stack([rows[i] for i in ids])
    found = {}
    for r in hilbert.neighbours(df, F.col("vec_id") % 50 == 0, 5, range_rows=256).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        s = matrix @ rows[q]
        s[ids == q] = -2
        hits += len(found[q] & set(ids[np.argsort(-s)[:5]].tolist()))
        total += 5
    assert hits >= 0.9 * total


def test_hilbert_order_visits_neighbouring_cells():
    side = 16
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = hilbert.hilbert_keys(cells, 4)
    path = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(side**3))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()

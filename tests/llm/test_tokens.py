import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeferry.llm import packing, token_files
from lakeferry.llm.queries import QUERIES
from lakeferry.llm.tokens import PieceEncoder, default_vocabulary
from lakeferry.session import scratch_path
from tests.llm.helpers import AWKWARD, awkward, empty

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(default_vocabulary())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(st.sampled_from(" \n\t\x1c 　aBé日'1²!Ġ"), max_size=12), max_size=8))
@settings(max_examples=300, deadline=None)
def test_ids_equal_those_of_the_tokenizer(plain, texts):
    ids, counts = PieceEncoder(default_vocabulary()).encode(texts) if not texts else SHARED.encode(texts)
    assert counts.tolist() == [len(plain(t)) for t in texts]
    assert ids.tolist() == [i for t in texts for i in plain(t)]


SHARED = PieceEncoder(default_vocabulary(), limit=500)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("n,top", [(0, 0), (1, 0), (1, 10**12), (5, 4), (3000, 10**7), (100, 99)])
def test_elias_fano_round_trip(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    code = token_files.EliasFano.encode(values)
    assert token_files.EliasFano.decode(code).select(np.arange(n)).tolist() == values.tolist()
    if n == 3000:
        assert len(code) * 8 < n * (2 + np.log2(top / n)) + 64 * 8


def read_back(spark, docs, **options):
    path = scratch_path(spark, "test-tokens")
    token_files.write(docs, path, **options)
    return token_files.documents(spark, path).collect()


def test_token_files_hold_whole_texts_in_order(spark, plain):
    docs = awkward(spark)
    for options in ({}, {"segment_tokens": 7, "segment_docs": 2, "partitions": 3}):
        rows = sorted(read_back(spark, docs, **options), key=lambda r: r.start)
        assert [r.doc_id for r in rows] == sorted((d[0] for d in AWKWARD), key=lambda i: (i is not None, i or 0))
        assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
        expected = sorted((d[0] or -1, len(plain(d[1])) + 1, crc(plain(d[1]) + [0])) for d in AWKWARD)
        assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert read_back(spark, empty(spark)) == []


def test_pieces_and_sequences(spark, plain):
    docs = awkward(spark)
    found = packing.pieces(docs, 64, keep_ids=True)
    by_doc = {}
    for r in found.collect():
        by_doc.setdefault((r.doc_id, r.start + r.length if r.piece == 0 and r.start == 0 else None), []).append(r)
        assert len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 and 0 < r.length <= 64
    whole = sum(len(plain(d[1])) + 1 for d in AWKWARD)
    packed = packing.pack(packing.pieces(docs, 64), 64).collect()
    assert sum(r.length for r in packed) == whole and len(packed) == found.count()
    bins = {}
    for r in sorted(packed, key=lambda r: r.offset):
        assert r.offset == bins.get(r.sequence_id, 0)
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 64
    assert packing.pack(packing.pieces(empty(spark)), 64).collect() == []


@pytest.mark.parametrize("sizes", [[60, 40, 50, 50, 30, 30, 40], [], [100], list(range(1, 100))])
def test_evolution_places_every_piece(sizes):
    labels = packing.evolve(sizes, 100, [], 1, 5, 4)
    used = {}
    for label, size in zip(labels, sizes, strict=True):
        used[label] = used.get(label, 0) + size
    assert len(labels) == len(sizes) and all(v <= 100 for v in used.values())
    assert sorted(used) == list(range(len(used)))


def test_evolution_improves_on_best_fit():
    """Triples that fill a bin exactly: best fit decreasing wastes bins, crossover finds some back."""
    rng = random.Random(4)
    sizes = []
    for _ in range(40):
        a = rng.randint(260, 370)
        b = rng.randint(260, 1000 - a - 260)
        sizes += [a, b, 1000 - a - b]
    first = max(packing.evolve(sizes, 1000, [], 3, 0, 1)) + 1
    best = max(packing.evolve(sizes, 1000, [], 3, 300, 8)) + 1
    assert 40 <= best <= first


def test_queries_against_the_tokenizer(spark, plain):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    start = 0
    expected = []
    for doc_id, text in docs:
        ids = [*plain(text), 0]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    rows = QUERIES["op8_token_files"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, rows.collect())) == expected
    packed = QUERIES["op6_packing"](spark, SF_DIR).collect()
    ids = {d: [*plain(t), 2] for d, t in docs}
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))
    for r in packed:
        assert crc(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32
    total = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-total // 1024) * 1.02 + 1

"""Periodic runs against a plain search for every period."""

import random

from lakeferry.llm import runs
from lakeferry.llm.queries import op11_runs
from tests.llm.helpers import awkward, empty


def plain(words):
    """Maximal stretches of each period, those with a smaller period left out."""
    n, found = len(words), []
    for q in range(1, n // runs.REPEATS + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(runs.LEAST, runs.REPEATS * q):
                unit = words[i : i + size]
                if not any(unit[p:] == unit[:-p] for p in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(5)
    for trial in range(600):
        alphabet = [b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]
        words: list[bytes] = []
        while len(words) < rng.randint(0, 60):
            unit = [rng.choice(alphabet) for _ in range(rng.randint(1, 7))]
            words += unit * rng.randint(1, 6)
        assert runs.runs(words) == plain(words), words
        other = [rng.choice(alphabet) for _ in range(rng.randint(0, 30))]
        assert runs.of_texts([other, words, [], other + words]) == [
            plain(other),
            plain(words),
            [],
            plain(other + words),
        ]


def test_nested_runs_and_borders():
    words = b"x a a a a a a b a a a a a a b a a a a a a b a a a a a a b y".split()
    found = runs.runs(words)
    assert found == plain(words)
    assert (1, 28, 7) in found and (1, 6, 1) in found
    assert runs.runs([b"w"] * 5) == [] and runs.runs([b"w"] * 6) == [(0, 6, 1)]


def test_a_repeated_line_is_no_run():
    line = [str(i).encode() for i in range(20)]
    assert runs.stretches([line + line + line]) == [[]]
    assert runs.of_texts([line * 4]) == [[(0, 80, 20)]]


def test_summary_names_the_longest_and_drops_repeats():
    words = b"p q r s p q r s p q r s p q r s end".split()
    n, start, length, period, exponent, _, collapsed = runs.summary(words, runs.runs(words))
    assert (n, start, length, period, exponent) == (1, 0, 16, 4, 4000)
    assert collapsed == runs.sha256(b"p q r s end").hexdigest()


def test_documents(spark, tmp_path):
    found = runs.detect(awkward(spark)).collect()
    assert len(found) == awkward(spark).count()
    by_id = {r["doc_id"]: r for r in found}
    assert (by_id[5]["start"], by_id[5]["length"], by_id[5]["period"]) == (0, 40000, 1)
    assert by_id[5]["collapsed_sha256"] == runs.sha256(b"word").hexdigest()
    assert by_id[2]["n_runs"] == 0 and by_id[2]["start"] is None
    assert by_id[2]["runs_sha256"] == by_id[3]["collapsed_sha256"] == runs.sha256(b"").hexdigest()
    assert runs.detect(empty(spark)).count() == 0


def test_query_against_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op11_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    repeated = 0
    for doc in docs:
        words = runs.repeated_tail(doc["doc_id"], (doc["text"] or "").encode().split())
        if len(words) > 1500:
            continue
        expected = runs.summary(words, plain(words))
        assert tuple(rows[doc["doc_id"]])[1:] == expected
        repeated += expected[0]
    assert repeated > 5

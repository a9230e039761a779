import random
from fractions import Fraction

import numpy as np
import pytest

from lakeferry.llm import jaccard
from tests.llm.helpers import AWKWARD, DOCS, awkward, empty

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def shingles(text, width=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, **options).collect()}


def edited(rng, text, changes):
    out = list(text)
    for _ in range(changes):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[f"new{rng.randrange(10**6)}"], [], [out[at], "more"]])
    return out


def corpus(seed, bases=25):
    """Copies, edited copies of texts of many lengths around the threshold, a passage in most."""
    rng = random.Random(seed)
    passage = [f"common{i}" for i in range(60)]
    texts = []
    for b in range(bases):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 6, 7, 8, 9, 12, 20, 40, 150]))]
        texts += [base, base, edited(rng, base, 1), edited(rng, base, max(1, len(base) // 40))]
        chain = base
        for _ in range(3):  # neighbours in the chain are alike, its ends need not be
            chain = edited(rng, chain, max(1, len(base) // 50))
            texts.append(chain)
        if b % 2:
            texts.append(base + passage)
            texts.append([f"x{rng.randrange(10**6)}" for _ in range(30)] + passage)
    rng.shuffle(texts)
    return [(i, rng.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,bits", [(1, 12), (2, 6), (3, 22)])
def test_components_match_brute_force(spark, seed, bits):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df, sketch_bits=bits, salts=4) == brute_force(rows)


@pytest.mark.parametrize("light", [0, 8, 64])
def test_the_boundary_changes_no_result(spark, monkeypatch, light):
    rows = corpus(7, 15)
    monkeypatch.setattr(jaccard, "boundary", lambda *_: light)
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=12) == brute_force(rows)


def test_copies_of_one_text_edited_apart(spark):
    """A hub that all copies resemble, though the copies hardly resemble each other."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(500, " ".join(base))]
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(len(copy)), 3):
            copy[at] = f"e{i}x{at}"
        rows.append((i, " ".join(copy)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=10) == brute_force(rows)


def test_awkward_rows(spark):
    found = sorted(
        ((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(awkward(spark), sketch_bits=12).collect()),
        key=str,
    )
    sizes = sorted(((d[0], len(shingles(d[1])), d[0]) for d in AWKWARD), key=str)
    assert found == sizes
    assert jaccard.join(empty(spark), sketch_bits=12).collect() == []


def test_repeated_ids_share_a_component(spark):
    df = spark.createDataFrame([(9, "a b c d e f g", None, None, 1), (9, "x y", None, None, 1), (4, "A b c\td e f g", None, None, 1)], DOCS)
    rows = sorted(tuple(r) for r in jaccard.join(df, sketch_bits=12).collect())
    assert rows == [(4, 3, 4), (9, 1, 9), (9, 3, 4)]


def test_hashed_sets_have_the_sizes_of_the_word_sets():
    texts = [d[1] for d in AWKWARD] + ["a", "a b c d", "a b c d e", "é É e\x0bF", "A a A a A a A a"]
    assert [len(s) for s in jaccard.shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    one, two = jaccard.shingle_sets(["Some Words\tin a  row here", "some words in\na row here"])
    assert np.array_equal(one, two)


def test_boundary_follows_the_cost():
    threshold = Fraction(3, 4)
    assert jaccard.boundary({6: 100}, 1.0, threshold, 2) == 0
    assert jaccard.boundary({6: 100}, 1e6, threshold, 2) >= 6


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = rng.integers(0, 2**63, 300).astype(np.uint64)
        b = np.concatenate((a[: rng.integers(0, 300)], rng.integers(0, 2**63, 40).astype(np.uint64)))
        apart = int(np.bitwise_count(jaccard.parity(a).view(np.uint64) ^ jaccard.parity(b).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(a, b))


def counted_stages(monkeypatch):
    """Rows of what a join stages from now on, by label."""
    rows, stage = {}, jaccard.staged

    def counting(df, label):
        out = stage(df, label)
        rows.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "staged", counting)
    return rows


def test_sets_of_sizes_far_apart_leave_their_lists(spark, monkeypatch):
    """A passage in a short and in a long text puts both in one list; neither is kept there."""
    rows = []
    for i in range(30):
        passage = [f"p{i}x{j}" for j in range(20)]
        rows += [(2 * i + k, " ".join(passage + [f"u{i}x{k}x{j}" for j in range(n)])) for k, n in enumerate((30, 200))]
    staged = counted_stages(monkeypatch)
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=6) == brute_force(rows)
    assert staged["jaccard-shared"] == [0]


def test_pairs_that_share_too_few_entries_are_not_counted_on_whole_sets(spark, monkeypatch):
    """Every two texts share a passage of their own: each has many shared entries, few with one partner,
    and too many shingles for bitmaps to tell."""
    texts = [[f"u{i}x{j}" for j in range(1800)] for i in range(8)]
    for a in range(8):
        for b in range(a):
            for i in (a, b):
                texts[i] += [f"p{a}x{b}x{j}" for j in range(600)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    staged = counted_stages(monkeypatch)
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=6) == brute_force(rows)
    assert staged["jaccard-entries"][0] > 0 and staged["jaccard-pairs"][1] == 0


def test_shortened_copies_stay_in_their_lists(spark):
    """Sizes as far apart as a link allows, and a little farther; a text of another size between them."""
    rng, rows = random.Random(11), []
    for i, n in enumerate([12, 24, 44, 84, 124, 204, 404, 604] * 3):
        base = [f"t{i}x{j}" for j in range(n)]
        least = -(-3 * (n - 4) // 4) + 4  # words of a copy with three quarters of the shingles
        other = [f"o{i}x{j}" for j in range(int(0.6 * n))] + base[: int(0.3 * n)]
        for text in (base, base[: least + rng.choice([-1, 0, 1])], base[n // 8 :], other):
            rows.append((len(rows), " ".join(text)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=6) == brute_force(rows)


def test_what_the_stars_leave_of_a_long_list_meets_its_most_typical_text(spark, monkeypatch):
    """Copies edited so much that they resemble few others; a part of their lists has no text near the
    one they were made from. Pairs counted on whole sets stay in proportion to the sets."""
    rng = random.Random(23)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.randrange(6)):
            copy[at] = f"e{i}x{at}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(f"o{i}x{j}" for j in range(40))) for i in range(400)]
    staged = counted_stages(monkeypatch)
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=14) == brute_force(rows)
    assert sum(staged["jaccard-pairs"]) <= 2 * staged["jaccard-bitmaps"][0]

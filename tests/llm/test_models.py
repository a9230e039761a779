import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeferry.llm import lang_cnn, string_kernel
from lakeferry.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, awkward, empty, held_out

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def network():
    texts = {"xx": "lorem ipsum dolor sit amet consectetur ", "yy": "žluťoučký kůň úpěl ďábelské ódy "}
    return lang_cnn.train([((t * n).encode(), lang) for lang, t in texts.items() for n in range(1, 12)], epochs=30)


def naive_response(model, window):
    """Largest response of each filter, by the definition of a convolution."""
    padded = np.concatenate((window, np.zeros(8, np.uint8)))
    out = []
    for width, taps in sorted(model.filters.items()):
        sums = [sum(taps[k][padded[i + k]] for k in range(width)) for i in range(len(window))]
        out.append(np.max(sums, axis=0))
    return np.concatenate(out) + model.bias


def test_tables_give_the_convolution(network):
    rows = lang_cnn.windows("Some Text, žluťoučký 42!".encode() * 30)
    fast = lang_cnn._responses(network, rows, network.tables())
    assert np.allclose(fast, [naive_response(network, w) for w in rows], atol=1e-4)


def test_windows_cover_the_whole_text():
    text = bytes(range(97, 123)) * 40
    assert lang_cnn.windows(text).ravel()[: len(text)].tolist() == list(text)
    assert lang_cnn.windows(b"").shape == (1, lang_cnn.WINDOW)


def test_language_of_awkward_rows(spark, network):
    rows = lang_cnn.predict(awkward(spark), network).collect()
    assert len(rows) == len(AWKWARD)
    by_text = {r.text: r for r in rows}
    for text in (None, "", "1234 !!! \n\t 99"):
        assert (by_text[text].lang_pred, by_text[text].score) == ("und", 0.0)
    assert all(r.lang_pred in ("xx", "yy", "und") and 0 <= r.score <= 1 and r["_rank"] == 1 for r in rows)
    assert lang_cnn.predict(empty(spark), network).collect() == []
    assert {r.lang_pred for r in lang_cnn.predict(awkward(spark), None).collect()} == {"und"}
    assert lang_cnn.fit(empty(spark), F.lit(True)) is None


def test_language_query_on_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op7_language"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(lang) and len(rows) == len(lang)
    assert all(r.held_out == held_out(r.doc_id, 4, 2) for r in rows)
    kept = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in kept) >= 0.98 * len(kept)


def naive_kernel(a, b, kernel):
    """Gap-weighted triples by three nested loops."""

    def features(word):
        out = {}
        code = [c if "a" <= c <= "z" else "?" for c in word]
        for i in range(len(code)):
            for j in range(i + 1, len(code)):
                for k in range(j + 1, min(len(code), i + 7)):
                    key = (code[i], code[j], code[k])
                    out[key] = out.get(key, 0) + kernel.decay ** (k - i + 1)
        return out

    x, y = features(a), features(b)
    norm = sum(v * v for v in x.values()) * sum(v * v for v in y.values())
    value = (sum(v * y.get(t, 0) for t, v in x.items()) / norm**0.5) ** kernel.sharpness if norm else 0.0
    return value if value >= kernel.floor else 0.0


def test_kernel_values():
    kernel = string_kernel.Kernel(["idiot", "worthless", "àéz"])
    words = ["idiot", "idxiot", "idiiot", "worthles", "thththth", "ab", "", "worthlessness", "ézà", "otidi"]
    found = kernel.values(words)
    assert np.allclose(found, [[naive_kernel(w, m, kernel) for m in kernel.landmarks] for w in words], atol=1e-4)


def model():
    rows = [(f"some harmless words about thing{i} and more", 0) for i in range(60)]
    rows += [(f"some words about thing{i} you {w} and more", 1) for i in range(30) for w in ("idiot", "worthless")]
    return string_kernel.train(rows)


def test_gapped_and_padded_insults_are_caught():
    machine = model()
    view = string_kernel.Views(machine.kernel)
    assert set(machine.kernel.landmarks) >= {"idiot", "worthless"}
    score = lambda text: float(machine.scores(view, [text])[0])
    for insult in ("idiot", "IDIOT!!", "i.d.i.o.t", "i d i o t", "idiiot", "idi-ot", "worthles", "wworthless", "worth*less"):
        assert score(f"you are an {insult} my friend") >= 0.7, insult
    for harmless in ("", None, "some words", "idea worth less of a riot", "thing " * 5000):
        assert score(harmless) < 0.3, harmless


def test_a_hot_insult_hides_no_rarer_one():
    rng = np.random.default_rng(2)
    plain = "the of house river walking table lemon idea moral critical".split()

    def text(*extra):
        return " ".join([*rng.choice(plain, 30), *extra, *rng.choice(plain, 30)])

    rare = ("moron", "cretin", "imbecile")
    rows = [(text("idiot") if i % 7 else text(rare[i // 7 % 3]), 1) for i in range(700)]
    rows += [(text(), 0) for _ in range(700)]
    machine = string_kernel.train(rows)
    view = string_kernel.Views(machine.kernel)
    assert all(machine.scores(view, [f"a {w} here"])[0] >= 0.7 for w in ("idiot", *rare))
    assert all(machine.scores(view, [f"a {w} here"])[0] < 0.3 for w in plain)


def test_copies_are_no_evidence():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(400)]
    copied = " ".join(words[:60])
    rows = [(f"{copied} {i}", 1) for i in range(40)]
    rows += [(" ".join([*rng.choice(words[60:], 40), "worthless"]), 1) for _ in range(80)]
    rows += [(" ".join(rng.choice(words[60:], 40)), 0) for _ in range(120)]
    assert string_kernel._landmarks(rows)[0] == "worthless"
    assert len(string_kernel._apart(rows)) <= 201


def test_other_scripts_differ():
    kernel = string_kernel.Kernel(["дурак", "idiót"])
    values = kernel.values(["дурак", "дом", "москва", "idiot", "ídiot"])
    assert values[0, 0] > 0.99 and values[1, 0] == 0 and values[2, 0] < 0.5
    assert values[3, 1] > 0.99 and values[4, 1] > 0.99


def test_scores_against_plain_ones(spark):
    """Margins and probabilities of whole texts, from kernel values by nested loops."""
    machine = model()
    texts = ["you IDIOT!", "an i d i o t", "no harm at all", "", None, "worth-less idea", "thing " * 9 + "worthlesss"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in string_kernel.predict(frame, machine).collect()}
    spelled = {1: ["idiot"]}
    for i, text in enumerate(texts):
        margins = [machine.bias]
        for word in (text or "").lower().split() + spelled.get(i, []):
            plain = "".join(c for c in word if c.isalpha())
            view = np.array([naive_kernel(plain, m, machine.kernel) for m in machine.kernel.landmarks])
            margins.append(float(view @ machine.factor @ machine.weights) + machine.bias)
        expected = 1 / (1 + np.exp(-np.clip(machine.slope * max(margins) + machine.shift, -30, 30)))
        assert abs(found[i] - expected) < 1e-3


def test_long_harmless_texts_stay_harmless():
    machine = model()
    rng = np.random.default_rng(1)
    text = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(20000))
    assert machine.scores(string_kernel.Views(machine.kernel), [text])[0] < 0.3


def test_toxicity_of_awkward_rows(spark):
    rows = string_kernel.predict(awkward(spark).drop("score"), model()).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert string_kernel.predict(empty(spark), model()).collect() == []
    assert {r.score for r in string_kernel.predict(awkward(spark).drop("score"), None).collect()} == {0.0}
    assert string_kernel.train([("a", 0)]) is None


def test_toxicity_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op5_toxicity"](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    kept = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    caught = [r for r in kept if labels[r.doc_id] == 1]
    # some labels are noise: texts without any insult
    assert sum(r.predicted for r in caught) >= 0.7 * len(caught)
    assert sum(r.predicted for r in kept if labels[r.doc_id] == 0) <= 0.01 * len(kept)

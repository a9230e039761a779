"""Toxicity by a subsequence string kernel and a linear support vector machine.

Two words are similar by the letter triples they share as gapped subsequences: a triple that spans
``s`` letters counts ``decay ** s`` (spans up to 7), so insults with left-out, swapped or inserted
characters stay close to the plain word. The kernel is the normalised dot product of these weights
to the power ``sharpness``, which is a kernel too. Landmark words are chosen from the training rows, one
after another, as long as a word occurs in more of the toxic texts that no earlier one explains than
chance does; a word's view is its kernel
values to the landmarks, mapped by the Nyström factor of the landmarks' own kernel matrix. A linear
support vector machine separates words. Labels belong to texts, so it is trained on witnesses: each
labelled text is represented by its words nearest to a landmark, which together weigh one. A text's margin is the largest of its words', which a long
harmless text does not raise by its length; a logistic fit makes it a probability.

Words are the lower-cased runs between white space, stripped of everything but letters, accented ones
read as plain ones and those of other scripts as one of 13 symbols; runs of
single letters ("i d i o t") count as one word too, and a word longer than 16 letters is read in
overlapping windows of 16. Values under ``floor`` count as 0. All words of all of a text are read.

Trained in numpy on the driver on a bounded sample of labelled rows (about ``per_class`` rows a
class, chosen by a hash of the id), with a fixed seed.

Defined results: null or empty texts have the score of a word without a view; without
rows of both classes every score is 0; repeated rows score alike; extra columns are kept.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import held, in_small_batches, slices

_LETTERS = 40  # a-z, thirteen for letters of other scripts by their code points, one for "none"
_OTHER, _NONE = 26, 39
_LONGEST, _SPAN = 16, 6
_SPELLED = re.compile(r"(?<!\S)(?:\S{1,2}(?:\s+|\Z)){3,}")


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _cut(word: str) -> list[str]:
    if len(word) <= _LONGEST:
        return [word]
    half = _LONGEST // 2
    return [word[i : i + _LONGEST] for i in range(0, len(word) - half, half)]


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of each code point up to 0x10000: accents fall off, other scripts share 13 symbols."""
    out = _OTHER + np.arange(0x10001) % (_NONE - _OTHER)
    for code in (*range(0x250), *range(0x1E00, 0x1F00), *range(0xFF00, 0xFF60)):
        base = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if "a" <= base <= "z":
            out[code] = ord(base) - 97
    out[0] = _NONE
    return out.astype(np.int32)


def _codes(words: list[str]) -> np.ndarray:
    padded = "".join([w.ljust(_LONGEST, "\0") for w in words])
    raw = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _symbols()[np.minimum(raw, 0x10000)].reshape(len(words), _LONGEST)


def _triples(codes: np.ndarray, decay: float) -> Iterator[tuple[np.ndarray, float]]:
    """(triple number or 0 where there is none, weight) for each start and pair of gaps."""
    n = codes.shape[1]
    for b in range(2, _SPAN + 1):
        for a in range(1, b):
            i, j, k = codes[:, : n - b], codes[:, a : n - b + a], codes[:, b:]
            number = (i * _LETTERS + j) * _LETTERS + k + 1
            yield np.where(k == _NONE, 0, number), decay ** (b + 1)


_TRIPLES = _LETTERS**3 + 1


@dataclass
class Kernel:
    """Kernel values of words to the landmarks."""

    landmarks: list[str]
    decay: float = 0.85
    sharpness: int = 2
    floor: float = 0.2
    table: np.ndarray = field(init=False)
    used: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        table = np.zeros((_TRIPLES, len(self.landmarks)), np.float32)
        codes = _codes(self.landmarks)
        for number, weight in _triples(codes, self.decay):
            rows = np.repeat(np.arange(len(codes))[:, None], number.shape[1], axis=1)
            np.add.at(table, (number.ravel(), rows.ravel()), weight)
        table[0] = 0
        norms = np.sqrt((table**2).sum(0))
        self.table = table / np.where(norms > 0, norms, 1)
        self.used = self.table.any(axis=1)

    def values(self, words: list[str]) -> np.ndarray:
        """(words, landmarks): normalised kernel values to the power, 0 under the floor."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        if not words:
            return out
        codes = _codes(words)
        squares = np.zeros(len(words))
        for number, weight in _triples(codes, self.decay):
            squares += (number > 0).sum(1) * weight**2
            row, at = np.nonzero(self.used[number])
            if len(row):
                np.add.at(out, row, weight * self.table[number[row, at]])
        # the true norm counts repeated triples together and is no smaller: values can only fall,
        # so only words that reach the floor with this bound need it
        near = np.flatnonzero(
            out.max(axis=1) >= self.floor ** (1 / self.sharpness) * np.sqrt(np.maximum(squares, 1e-12))
        )
        exact = np.ones(len(words))
        for at in range(0, len(near), 2000):
            some = near[at : at + 2000]
            exact[some] = self._norms(codes[some])
        mask = np.zeros(len(words), bool)
        mask[near] = True
        out[~mask] = 0
        out = (out / exact[:, None]) ** self.sharpness
        out[out < self.floor] = 0
        return out


    def _norms(self, codes: np.ndarray) -> np.ndarray:
        """Length of each word's vector of triple weights, 1 for words without a triple."""
        keys, weights = [], []
        for number, weight in _triples(codes, self.decay):
            row, at = np.nonzero(number)
            keys.append(row * _TRIPLES + number[row, at])
            weights.append(np.full(len(row), weight))
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        summed = np.bincount(which, np.concatenate(weights), minlength=len(distinct))
        squares = np.bincount(distinct // _TRIPLES, summed**2, minlength=len(codes))
        return np.where(squares > 0, np.sqrt(squares), 1.0)


class Views:
    """Kernel values of raw words, with a bounded memo from raw word to the number of its row; row 0
    is that of words without any similarity."""

    def __init__(self, kernel: Kernel, limit: int = 250_000) -> None:
        self.kernel, self.limit = kernel, limit
        self._reset()

    def _reset(self) -> None:
        self._row: dict[str, int] = {}
        self.rows = np.zeros((1, len(self.kernel.landmarks)), np.float32)

    def _learn(self, raw: set[str]) -> None:
        forms: dict[str, list[str]] = {}
        for word in raw:
            forms.setdefault(letters(word), []).append(word)
        self._row.update(dict.fromkeys(raw, 0))
        words = [w for w in forms if len(w) > 2]
        if not words:
            return
        cut = [_cut(w) for w in words]
        values = self.kernel.values([c for own in cut for c in own])
        ends = np.cumsum([len(c) for c in cut])
        best = np.maximum.reduceat(values, np.concatenate(([0], ends[:-1])), axis=0)
        hit = np.flatnonzero(best.any(axis=1))
        for row, i in enumerate(hit.tolist(), len(self.rows)):
            self._row.update(dict.fromkeys(forms[words[i]], row))
        self.rows = np.concatenate((self.rows, best[hit]))

    def of(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of the rows of each text's words, 0 always among them. They hold until the next
        call."""
        if len(self._row) > self.limit:
            self._reset()
        split = [_words(t) for t in texts]
        new = set().union(*split) - self._row.keys()
        if new:
            self._learn(new)
        look = self._row.__getitem__
        return [list({0, *map(look, words)}) for words in split]


def _words(text: str | None) -> list[str]:
    low = (text or "").lower()
    words = low.split()
    joined: list[str] = []
    for spelled in _SPELLED.finditer(low):
        run: list[str] = []
        for w in [*spelled[0].split(), ""]:
            own = letters(w)
            if len(own) == 1:
                run.append(own)
            else:
                if len(run) > 2:
                    joined.append("".join(run))
                run = []
    return words + joined


@dataclass
class Model:
    kernel: Kernel
    factor: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        return rows @ (self.factor @ self.weights) + self.bias

    def scores(self, views: Views, texts: list[str | None]) -> np.ndarray:
        found = views.of(texts)
        margin = self.margins(views.rows)
        best = np.array([margin[own].max() for own in found])
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -30, 30)))


def _apart(rows: list[tuple[str, int]], alike: float = 0.5) -> list[tuple[str, int]]:
    """One of each group of texts of a class that share most of their three-word shingles: copies of a
    text are no further evidence. Candidates come from min-hash bands."""
    seen: dict[tuple, list[int]] = {}
    kept: list[tuple[set[int], int]] = []
    out = []
    salts = np.random.default_rng(5).integers(1, 1 << 62, 40).astype(np.uint64) | np.uint64(1)
    for text, y in rows:
        words = text.lower().split()
        runs = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        own = {zlib.crc32(r.encode("utf-8", "surrogatepass")) + 1 for r in runs}
        coded = np.fromiter(own, np.uint64, len(own))
        least = (coded[:, None] * salts >> np.uint64(20)).min(axis=0)
        bands = [(y, i, *least[i : i + 4].tolist()) for i in range(0, len(salts), 4)]
        others = {i for band in bands for i in seen.get(band, ())}
        if any(len(own & kept[i][0]) >= alike * len(own | kept[i][0]) for i in others):
            continue
        for band in bands:
            seen.setdefault(band, []).append(len(kept))
        kept.append((own, y))
        out.append((text, y))
    return out


def _surprise(counts: np.ndarray, expected: float) -> np.ndarray:
    """Minus the logarithm of Chernoff's bound on the probability that so many of a word's texts are
    toxic if ``expected`` of them were; 0 where they are not more."""
    held_ = np.maximum(counts.sum(axis=0), 1)
    share = np.clip(counts[1] / held_, 1e-12, 1 - 1e-12)
    out = held_ * (share * np.log(share / expected) + (1 - share) * np.log((1 - share) / (1 - expected)))
    return np.where((share > expected) & (counts[1] > 0), out, 0)


def _landmarks(
    rows: list[tuple[str, int]], chance: float = 0.3, odds: float = 6.0, least: int = 8
) -> list[str]:
    """Words that occur in more toxic texts than chance explains.

    First those whose texts are toxic at more than ``odds`` times the odds of all texts: the ``least``
    surest in any case, and every other one that passes. Then the texts with a word chosen so far are put
    aside, as what it explains, the rest is counted anew, and the surest word of the rest, at so many times
    the odds of the rest, is taken, again and again. So a hot insult hides neither equally clear nor
    rarer ones, and words that are only usual where insults are (those of one language, say) lose their
    excess. A word passes if the probability of so many toxic texts (Chernoff's bound) is under ``chance``
    over the number of words tried; there is no limit to the number of landmarks. Of texts that are copies
    of each other one counts.
    """
    texts = [
        ({w for w in (letters(x)[:_LONGEST] for x in _words(t)) if len(w) >= 3}, y) for t, y in _apart(rows)
    ]
    holders: dict[str, list[int]] = {}
    for i, (words, _) in enumerate(texts):
        for w in words:
            holders.setdefault(w, []).append(i)
    names = sorted(holders)
    at = {w: i for i, w in enumerate(names)}
    inside = [np.array([at[w] for w in words], np.int64) for words, _ in texts]
    counts, sizes = np.zeros((2, len(names))), np.zeros(2)
    for own, (_, y) in zip(inside, texts, strict=True):
        counts[y, own] += 1
        sizes[y] += 1
    if not names or not sizes.all():
        return names[:least]
    bound = float(np.log(max(1, int((counts[1] > 1).sum())) / chance))
    chosen: list[int] = []
    open_ = np.ones(len(texts), bool)

    def take(best: int) -> None:
        chosen.append(best)
        for i in holders[names[best]]:
            if open_[i]:
                open_[i] = False
                y = texts[i][1]
                counts[y, inside[i]] -= 1
                sizes[y] -= 1

    def surest() -> np.ndarray:
        """Surprise of the words at ``odds`` times the present odds at least."""
        often = (counts[1] + 0.5) * sizes[0] >= odds * (counts[0] + 0.5) * sizes[1]
        return np.where(often, _surprise(counts, sizes[1] / sizes.sum()), 0)

    clear = _surprise(counts, odds * sizes[1] / (odds * sizes[1] + sizes[0]))
    sure = surest()
    order = [i for i in np.argsort(-sure, kind="stable").tolist() if sure[i] > 0]
    passed = [i for k, i in enumerate(order, 1) if k <= least or clear[i] >= bound]
    for best in passed or [int(counts[1].argmax())]:
        take(best)
    while sizes.all():
        rest = surest()
        best = int(rest.argmax())
        if rest[best] <= max(bound, 0):
            break
        take(best)
    return [names[i] for i in chosen]


def train(
    rows: list[tuple[str, int]],
    *,
    rounds: int = 1000,
    ridge: float = 1e-3,
) -> Model | None:
    """None unless both classes are there."""
    if {y for _, y in rows} != {0, 1}:
        return None
    chosen = _landmarks(rows)
    if not chosen:
        return None
    kernel = Kernel(chosen)
    own = kernel.values(chosen).astype(float)
    own = (own + own.T) / 2 + 1e-6 * np.eye(len(own))
    values, vectors = np.linalg.eigh(own)
    factor = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    view = Views(kernel, limit=1 << 62)
    bags = [own for i in range(0, len(rows), 64) for own in view.of([t for t, _ in rows[i : i + 64]])]
    mapped = view.rows.astype(float) @ factor
    y = np.array([y for _, y in rows])
    closest = view.rows.max(axis=1)
    picked = [[r for r in own if closest[r] >= 0.9 * closest[own].max()] for own in bags]
    share = np.concatenate([np.full(len(p), 1 / len(p)) for p in picked])
    truth = np.repeat(y, [len(p) for p in picked])
    w, b = _separate(mapped[np.concatenate(picked)], truth, share, rounds, ridge)
    margin = mapped @ w + b
    margin = np.array([margin[own].max() for own in bags])
    slope, shift = _logistic(margin, y)
    return Model(kernel, factor, w, b, slope, shift)


def _separate(
    z: np.ndarray, y: np.ndarray, share: np.ndarray, rounds: int, ridge: float
) -> tuple[np.ndarray, float]:
    """Squared-hinge machine, classes weighing the same, by gradient steps with momentum."""
    sign = np.where(y == 1, 1.0, -1.0)
    weight = share * np.where(y == 1, 0.5 / share[y == 1].sum(), 0.5 / share[y == 0].sum())
    w, b = np.zeros(z.shape[1]), 0.0
    rate = 0.5 / (2 * float((weight[:, None] * z**2).sum()) + 2 + ridge)
    move, move_b = np.zeros_like(w), 0.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - sign * (z @ w + b)) * weight * sign
        move = 0.9 * move + rate * (2 * slack @ z - ridge * w)
        move_b = 0.9 * move_b + rate * 2 * slack.sum()
        w, b = w + move, b + move_b
    return w, b


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a light pull to slope 1."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        r = p * (1 - p) + 1e-9
        g = np.array([((p - y) * margin).sum() + 1e-2 * (slope - 1), (p - y).sum()])
        h = np.array(
            [[(r * margin**2).sum() + 1e-2, (r * margin).sum()], [(r * margin).sum(), r.sum()]]
        )
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def sample(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int) -> list[tuple[str, int]]:
    """About ``per_class`` labelled rows a class, chosen by a hash of the id."""
    known = labels.where(learn & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    counts = known.groupBy("toxic").count().collect()
    spread = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(1 << 20))
    chosen = None
    for row in counts:
        share = max(1, int(per_class / row["count"] * (1 << 20)))
        rule = (F.col("toxic") == row["toxic"]) & (spread < share)
        chosen = rule if chosen is None else chosen | rule
    if chosen is None:
        return []
    rows = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        # about per_class labels a class: a size fixed by that parameter
        .join(F.broadcast(known.where(chosen).distinct()), "doc_id")
        .select("doc_id", "text", "toxic")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["toxic"]))
    return [(r["text"], int(r["toxic"])) for r in rows]


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 1500, **options
) -> Model | None:
    """The machine from labelled rows for which ``learn`` (on doc_id) holds."""
    return train(sample(docs, labels, learn, per_class), **options)


def predict(docs: DataFrame, model: Model | None, column: str = "score") -> DataFrame:
    """Adds the probability of the toxic class to every row."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([f for f in docs.schema if f.name != column] + [StructField(column, DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        view = _views(machine) if machine else None
        for batch in batches:
            keep = [n for n in batch.schema.names if n != column]
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                scores = machine.scores(view, texts) if machine else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.names.index(n)) for n in keep], pa.array(scores, pa.float64())],
                    names=[*keep, column],
                )

    return in_small_batches(docs).mapInArrow(work, schema)


def _views(model: Model) -> Views:
    """One memo per worker process and set of landmarks."""
    key = zlib.crc32("\n".join(model.kernel.landmarks).encode("utf-8", "surrogatepass"))
    return held(("toxicity", key), lambda: Views(model.kernel))

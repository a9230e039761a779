"""Periodic runs of words: stretches that repeat a short unit four times or more.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical),
of at least ``max(6, 4 * q)`` words, that no neighbouring word extends keeping that period.

The words go through a suffix automaton. The suffix links form a tree in which the ancestors of a
prefix are its suffixes; it is held as a link-cut tree whose preferred paths are the states that last
ended at one place. Appending word ``i`` accesses the state of the prefix ending there: the path to the
root, cut into segments of one last end ``j``, is recoloured to ``i``. A segment whose deepest state has
``L`` words says that the last ``L`` words also ended at ``j``, and no longer suffix did: with the
distance ``d = i - j`` and ``L >= d`` the last ``L + d`` words are a square that cannot grow to the left,
and it is a run if the next word breaks it too and it is long enough. The number of segments recoloured
is a logarithm a word in the mean.

Only stretches that can hold a run go through an automaton: each five words in a row inside a run occur
again in the same text, and one of them occurs again within a quarter of the stretch. Fingerprints find
such stretches, a superset at worst. The others hold no run, so nothing is lost.

Words are the runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return of the whole text. Defined results: a null text, or one without words, has no run and an empty
collapsed text; repeated rows give equal rows; other columns are ignored. Texts are independent of each
other, so nothing is shuffled; memory follows the longest single text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import slices

LEAST, REPEATS, GRAM = 6, 4, 5
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
Run = tuple[int, int, int]  # start, length, period
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


class Tree:
    """Suffix links of a growing automaton as a link-cut tree; state 1 is the empty word, 0 is none.

    A preferred path holds the states that last ended at one place, kept at the root of the path's
    splay tree, which is ordered by depth.
    """

    def __init__(self) -> None:
        self.up, self.left, self.right = [0, 0], [0, 0], [0, 0]
        self.last = [-1, -1]

    def leaf(self, parent: int) -> int:
        """A new state under ``parent``, on a path of its own."""
        self.up.append(parent)
        self.left.append(0)
        self.right.append(0)
        self.last.append(-1)
        return len(self.up) - 1

    def insert_above(self, state: int) -> int:
        """A new state between ``state`` and its parent, on the path of ``state``."""
        self.splay(state)
        new = self.leaf(state)
        below = self.left[new] = self.left[state]
        self.left[state] = new
        if below:
            self.up[below] = new
        return new

    def splay(self, x: int) -> None:
        """Makes ``x`` the root of its path's splay tree."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while True:
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner and (left[g] == p) == (left[p] == x):
                # the parent turns first where all three lie on one side
                top = up[g]
                if left[p] == x:
                    left[g], right[p] = right[p], g
                    if left[g]:
                        up[left[g]] = g
                    left[p], right[x] = right[x], p
                    if left[p]:
                        up[left[p]] = p
                else:
                    right[g], left[p] = left[p], g
                    if right[g]:
                        up[right[g]] = g
                    right[p], left[x] = left[x], p
                    if right[p]:
                        up[right[p]] = p
                up[g], up[p], old = p, x, g
            else:
                top = g
                if left[p] == x:
                    left[p], right[x] = right[x], p
                    if left[p]:
                        up[left[p]] = p
                else:
                    right[p], left[x] = left[x], p
                    if right[p]:
                        up[right[p]] = p
                up[p], old = x, p
            up[x] = top
            if top and left[top] == old:
                left[top] = x
            elif top and right[top] == old:
                right[top] = x
            else:
                self.last[x] = self.last[old]
                return
            p = top

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolours the path from ``state`` to the root to ``end``; returns the deepest state and
        the former end of each of its segments, from the deepest one up."""
        last, right, segments = self.last, self.right, []
        x, below = state, 0
        while x:
            self.splay(x)
            segments.append((x, last[x]))
            cut = right[x]
            if cut:
                last[cut] = last[x]
            right[x] = below
            below, x = x, self.up[x]
        self.splay(state)
        last[state] = end
        return segments


def runs(words: list) -> list[Run]:
    """All runs of a list of words, by start and period."""
    n = len(words)
    tree = Tree()
    step: list[dict] = [{}, {}]
    link, length = [0, 0], [0, 0]
    state, out = 1, []
    for i, word in enumerate(words):
        p, state = state, len(length)
        step.append({})
        length.append(i + 1)
        while p and word not in step[p]:
            step[p][word] = state
            p = link[p]
        parent = 1
        if p:
            parent = q = step[p][word]
            if length[p] + 1 != length[q]:
                # the states below keep their number, so the new one is made last
                parent = state + 1
                length.append(length[p] + 1)
                step.append(step[q].copy())
        link.append(parent)
        tree.leaf(parent)
        if parent > state:
            tree.insert_above(q)
            link.append(link[q])
            link[q] = parent
            while p and step[p].get(word) == q:
                step[p][word] = parent
                p = link[p]
        following = words[i + 1] if i + 1 < n else None
        for deepest, j in tree.access(state, i):
            size, d = length[deepest], i - j
            if (
                j >= 0
                and size >= (REPEATS - 1) * d
                and size + d >= LEAST
                and (i + 1 == n or following != words[i + 1 - d])
            ):
                out.append((i - size - d + 1, size + d, d))
    out.sort(key=lambda r: (r[0], r[2]))
    return out


def stretches(texts: list[list[bytes]]) -> list[list[tuple[int, int]]]:
    """For each text the stretches (start, end) outside which there is no run."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    if total < LEAST:
        return out
    coded = np.fromiter((hash(w) for t in texts for w in t), np.int64, total).view(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    room = total - GRAM + 1
    gram = coded[:room].copy()
    for k in range(1, GRAM):
        gram = gram * _FACTOR + coded[k : k + room]
    at = np.flatnonzero(owner[:room] == owner[GRAM - 1 :])
    value = (gram[at] ^ (gram[at] >> np.uint64(29))) * _FACTOR + owner[at].astype(np.uint64) * (_FACTOR >> np.uint64(3))
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(same):
        return out
    again = np.zeros(total + 1, bool)
    lag = np.full(total + 1, total)
    before, after = at[order[same]], at[order[same + 1]]
    again[before] = again[after] = True
    lag[after] = after - before
    edges = np.diff(np.concatenate(([0], again.view(np.int8))))
    # two texts side by side are cut where the words of one end
    for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        size = b - a + GRAM - 1
        if size >= LEAST and REPEATS * int(lag[a:b].min()) <= size:
            text = int(owner[a])
            first = int(starts[text])
            out[text].append((a - first, a - first + size))
    return out


def summary(words: list[bytes], found: list[Run]) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    if found:
        kept = np.ones(len(words), bool)
        for s, n, q in found:
            kept[s + q : s + n] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
        s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    else:
        best = (None,) * 4
    return len(found), *best, sha256(listed.encode()).hexdigest(), sha256(b" ".join(words)).hexdigest()


def of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """Runs of each text."""
    return [
        sorted(
            ((a + s, n, q) for a, b in parts for s, n, q in runs(words[a:b])), key=lambda r: (r[0], r[2])
        )
        for words, parts in zip(texts, stretches(texts), strict=True)
    ]


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, in every tenth document by the CRC-32 of its number with a tail that repeats."""
    mark = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if mark % 10 or not n:
        return words
    g = mark // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // len(unit))))[: n - a]


def detect(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Per row of ``docs``: number of runs, the longest one, digests of all runs and of the text without
    what the runs repeat. ``rewrite`` changes the words of a document before."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                raw = part.column("text").cast(pa.binary()).to_pylist()
                texts = [(t or b"").split() for t in raw]
                if rewrite:
                    texts = [rewrite(i, words) for i, words in zip(ids, texts, strict=True)]
                rows = [summary(w, found) for w, found in zip(texts, of_texts(texts), strict=True)]
                columns = [ids, *zip(*rows, strict=True)]
                types = [pa.int64()] * 6 + [pa.string()] * 2
                names = [f.split()[0] for f in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names
                )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(work, SCHEMA)

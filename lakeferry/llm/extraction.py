"""Main text of web pages by a recurrent labeller of their blocks.

A page is cut into blocks, the leaf texts between block-level tags, whole and in page order. A block is
seen as the names on its path (tags, class and id words, roles), hashed into learned vectors, its hashed
words, likewise, and a dozen measures (length, links, punctuation, place). A bidirectional LSTM reads the
sequence of blocks, so every block is classified in the context of its whole page; the text is what it
calls article, joined by blanks. Scripts, styles, templates and the head are no blocks.

Trained in numpy on the driver with a fixed seed, on layouts (``layouts``) filled with sentences of a
bounded sample of pages (about ``sample_pages`` pages of at most ``sample_chars`` characters, chosen by
a hash of the id), and on those of the sampled pages that mark their article themselves.

Inside a block white space becomes one blank, character references are decoded. Defined results: null or
empty html has an empty text; html without tags is one block; unclosed and stray tags are tolerated, an
unclosed script ends with the page; names are read from at most the ``ENDS`` outermost and innermost open
elements; repeated rows are extracted alike; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import slices
from lakeferry.llm.layouts import MARK, Pages

# Elements of HTML.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s"
    " samp small span strike strong sub sup time tt u var wbr input".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("script style noscript template title textarea iframe object svg canvas xmp noembed noframes".split())
_PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " main nav ol p pre section table ul".split()
)
_SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_SCOPES = frozenset("ul ol dl table select div section article aside main body td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>", re.S
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

ENDS = 16
PATH_ROWS, PATH_SIZE = 4096, 24
WORD_ROWS, WORD_SIZE = 8192, 12
MEASURES = 14
_ARTICLE = {"t:article", "t:main"}
_AROUND = {"t:nav", "t:aside", "t:footer", "t:form", "t:dialog", "n:ad", "n:comments", "n:sidebar", "n:cookie"}


def element_names(tag: str, attributes: str) -> tuple[str, ...]:
    """The names an element puts on the paths of its blocks."""
    names = [f"t:{tag}"]
    for found in _NAMED.finditer(attributes):
        value = found[2] or found[3] or found[4] or ""
        for piece in _PIECE.findall(value)[:24]:
            piece = piece.lower()
            if not piece.isdigit():
                names += [f"n:{piece}", f"p:{piece[:4]}"]
    if attributes and _HIDDEN.search(attributes):
        names.append("hidden")
    return tuple(dict.fromkeys(names))


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    linked: int  # characters inside links


class Reader:
    """Cuts pages into blocks; elements and paths are numbered, the same ones once."""

    def __init__(self, limit: int = 50_000) -> None:
        self.limit = limit
        self.numbers: dict[tuple[str, str], int] = {}
        self.names: list[tuple[str, ...]] = []

    def _element(self, tag: str, attributes: str) -> int:
        key = (tag, attributes)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.names)
            self.names.append(element_names(tag, attributes))
        return number

    def start(self) -> None:
        """Forgets numbered elements if they became many; call between batches only."""
        if len(self.names) > self.limit:
            self.numbers.clear()
            self.names.clear()

    def blocks(self, page: str) -> list[Block]:
        out: list[Block] = []
        tags: list[str] = []
        path: list[int] = []
        count: dict[str, int] = {}
        parts: list[str] = []
        own: tuple[int, ...] = ()
        linked = 0

        def close_block() -> None:
            nonlocal linked
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, own, min(linked, len(text))))
            parts.clear()
            linked = 0

        def pop_to(depth: int) -> None:
            for tag in tags[depth:]:
                count[tag] -= 1
            del tags[depth:], path[depth:]

        def add(text: str) -> None:
            nonlocal own, linked
            if not parts:
                if not text.strip():
                    return
                own = tuple(path) if len(path) <= 2 * ENDS else (*path[:ENDS], *path[-ENDS:])
            parts.append(text)
            if count.get("a"):
                linked += len(text)

        def last_open(names: str, until: frozenset[str] = frozenset()) -> int:
            """Depth of the innermost open element of these names inside the present scope, or -1."""
            wanted = names.split()
            if not any(count.get(n) for n in wanted):
                return -1
            for depth in range(len(tags) - 1, -1, -1):
                if tags[depth] in wanted:
                    return depth
                if tags[depth] in until:
                    return -1
            return -1

        at, size = 0, len(page)
        while at < size:
            found = _TOKEN.search(page, at)
            if found is None:
                add(page[at:])
                break
            if found.start() > at:
                add(page[at : found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if tag not in _INLINE:
                close_block()
            if found[1]:
                depth = last_open(tag)
                if depth >= 0:
                    pop_to(depth)
                continue
            if tag in _SKIPPED:
                end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
                continue
            if tag in _VOID:
                continue
            if tag in _PARAGRAPH_ENDS:
                depth = last_open("p", _SCOPES)
                if depth >= 0:
                    pop_to(depth)
            elif tag in _SIBLINGS:
                depth = last_open(_SIBLINGS[tag], _SCOPES - set(_SIBLINGS[tag].split()))
                if depth >= 0:
                    pop_to(depth)
            if not found[3].endswith("/"):
                tags.append(tag)
                path.append(self._element(tag, found[3]))
                count[tag] = count.get(tag, 0) + 1
        close_block()
        return out


@dataclass
class Seen:
    """Features of the blocks of several pages, one page after the other."""

    sizes: np.ndarray  # blocks of each page
    path: np.ndarray  # number of each block's path
    path_names: list[np.ndarray]  # hashed names of each path
    words: np.ndarray  # hashed words of all blocks
    word_sizes: np.ndarray
    measures: np.ndarray


def _hashed(text: str, rows: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % rows


class Features:
    def __init__(self, limit: int = 300_000) -> None:
        self.reader = Reader()
        self.limit = limit
        self.word: dict[str, int] = {}

    def _numbers(self, words: list[str]) -> list[int]:
        memo = self.word
        out = []
        for w in words:
            number = memo.get(w)
            if number is None:
                if len(memo) > self.limit:
                    memo.clear()
                number = memo[w] = _hashed(w.lower(), WORD_ROWS)
            out.append(number)
        return out

    def see(self, pages: list[list[Block]]) -> Seen:
        known: dict[tuple[int, ...], int] = {}
        paths, words, sizes, rows = [], [], [], []
        for blocks in pages:
            n = len(blocks)
            for i, block in enumerate(blocks):
                text = block.text
                split = text.split(" ")
                words += self._numbers(split)
                sizes.append(len(split))
                paths.append(known.setdefault(block.path, len(known)))
                chars = len(text)
                stops = text.count(". ") + text.count(", ") + text.count("? ") + text.count("! ")
                rows.append(
                    (
                        np.log1p(len(split)) / 3,
                        np.log1p(chars) / 5,
                        block.linked / chars,
                        float(block.linked > 0),
                        stops / len(split),
                        float(text[-1] in ".!?…:;\"»”"),
                        chars / len(split) / 10,
                        float(text[0].isupper()),
                        float("©" in text or "|" in text),
                        float(len(split) <= 3),
                        len(block.path) / 10,
                        i / n,
                        np.log1p(i) / 3,
                        np.log1p(n - 1 - i) / 3,
                    )
                )
        names = [
            np.array(
                sorted({_hashed(x, PATH_ROWS) for e in path for x in self.reader.names[e]})
                + [_hashed(f"own:{x}", PATH_ROWS) for e in path[-2:] for x in self.reader.names[e][:1]],
                np.int64,
            )
            for path in known
        ]
        return Seen(
            np.array([len(b) for b in pages], np.int64),
            np.array(paths, np.int64),
            names,
            np.array(words, np.int64),
            np.array(sizes, np.int64),
            np.array(rows, np.float32).reshape(-1, MEASURES),
        )


def _pooled(table: np.ndarray, index: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of rows over the square root of their number."""
    out = np.zeros((len(sizes), table.shape[1]), np.float32)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        out[some] = np.add.reduceat(table[index], starts, axis=0) / np.sqrt(sizes[some])[:, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Vectors of names and words, both LSTMs (inputs, state, offset) and the output layer."""

    params: dict[str, np.ndarray] = field(default_factory=dict)

    def inputs(self, seen: Seen) -> np.ndarray:
        sizes = np.array([len(x) for x in seen.path_names], np.int64)
        names = np.concatenate(seen.path_names) if len(sizes) else np.zeros(0, np.int64)
        paths = _pooled(self.params["path"], names, sizes)
        words = _pooled(self.params["word"], seen.words, seen.word_sizes)
        return np.concatenate((paths[seen.path], words, seen.measures), axis=1)

    def article(self, seen: Seen, rows_at_once: int = 20_000) -> np.ndarray:
        """Probability of each block to belong to the article."""
        out = np.zeros(len(seen.path), np.float32)
        starts = np.cumsum(seen.sizes) - seen.sizes
        order = np.argsort(-seen.sizes, kind="stable")
        order = order[seen.sizes[order] > 0]
        x = self.inputs(seen)
        a = 0
        while a < len(order):
            step = max(1, rows_at_once // int(seen.sizes[order[a]]))
            some = order[a : a + step]
            a += step
            sizes = seen.sizes[some]
            place = np.arange(int(sizes[0]))[:, None]
            inside = place < sizes
            forward = np.where(inside, starts[some] + place, 0)
            backward = np.where(inside, starts[some] + sizes - 1 - place, 0)
            active = inside.sum(axis=1)
            score = np.zeros(forward.shape, np.float32)
            for side, at in (("f", forward), ("b", backward)):
                hidden = self._states(x[at], active, side) @ self.params[f"out_{side}"]
                if side == "f":
                    score += hidden
                else:
                    back = np.where(inside, sizes - 1 - place, 0)
                    score += np.take_along_axis(hidden, back, axis=0)
            out[forward[inside]] = _sigmoid(score[inside] + self.params["bias"][0])
        return out

    def _states(self, x: np.ndarray, active: np.ndarray, side: str) -> np.ndarray:
        """States of an LSTM over the pages of ``x`` (step, page, input), longest page first."""
        p = self.params
        u = p[f"u_{side}"]
        n = u.shape[0]
        fed = x @ p[f"w_{side}"] + p[f"o_{side}"]
        out = np.zeros((*x.shape[:2], n), np.float32)
        h = np.zeros((x.shape[1], n), np.float32)
        c = np.zeros_like(h)
        for t, k in enumerate(active.tolist()):
            z = fed[t, :k] + h[:k] @ u
            gates = _sigmoid(z[:, : 3 * n])
            c = gates[:, n : 2 * n] * c[:k] + gates[:, :n] * np.tanh(z[:, 3 * n :])
            h = gates[:, 2 * n :] * np.tanh(c)
            out[t, :k] = h
        return out


def _trained_side(x: np.ndarray, p: dict[str, np.ndarray], side: str) -> tuple[np.ndarray, dict]:
    w, u, o = p[f"w_{side}"], p[f"u_{side}"], p[f"o_{side}"]
    n = u.shape[0]
    fed = x @ w + o
    steps, pages = x.shape[:2]
    h = np.zeros((steps + 1, pages, n), np.float32)
    c = np.zeros_like(h)
    gates = np.zeros((steps, pages, 4 * n), np.float32)
    for t in range(steps):
        z = fed[t] + h[t] @ u
        gates[t, :, : 3 * n] = _sigmoid(z[:, : 3 * n])
        gates[t, :, 3 * n :] = np.tanh(z[:, 3 * n :])
        i, f, out, g = np.split(gates[t], 4, axis=1)
        c[t + 1] = f * c[t] + i * g
        h[t + 1] = out * np.tanh(c[t + 1])
    return h[1:], {"x": x, "h": h, "c": c, "gates": gates}


def _gradient_side(dh: np.ndarray, memo: dict, p: dict, side: str, grads: dict) -> np.ndarray:
    u = p[f"u_{side}"]
    h, c, gates, x = memo["h"], memo["c"], memo["gates"], memo["x"]
    dz = np.zeros_like(gates)
    next_h, next_c = np.zeros_like(h[0]), np.zeros_like(h[0])
    for t in range(len(gates) - 1, -1, -1):
        i, f, out, g = np.split(gates[t], 4, axis=1)
        th = np.tanh(c[t + 1])
        down = dh[t] + next_h
        dc = next_c + down * out * (1 - th**2)
        dz[t] = np.concatenate(
            (dc * g * i * (1 - i), dc * c[t] * f * (1 - f), down * th * out * (1 - out), dc * i * (1 - g**2)), axis=1
        )
        next_c = dc * f
        next_h = dz[t] @ u.T
    flat = dz.reshape(-1, dz.shape[2])
    grads[f"w_{side}"] = x.reshape(len(flat), -1).T @ flat
    grads[f"u_{side}"] = h[:-1].reshape(len(flat), -1).T @ flat
    grads[f"o_{side}"] = flat.sum(0)
    return dz @ p[f"w_{side}"].T


def train(
    pages: list[tuple[list[Block], list[bool]]],
    features: Features,
    *,
    hidden: int = 20,
    epochs: int = 10,
    rate: float = 0.01,
    at_once: int = 48,
    seed: int = 17,
) -> Model:
    """Adam on the cross entropy of blocks. Words are hidden from the network on some pages, so that
    it does not lean on the vocabulary of the sample."""
    rng = np.random.default_rng(seed)
    size = PATH_SIZE + WORD_SIZE + MEASURES
    p = {"path": rng.normal(0, 0.1, (PATH_ROWS, PATH_SIZE)), "word": rng.normal(0, 0.1, (WORD_ROWS, WORD_SIZE))}
    for side in "fb":
        p[f"w_{side}"] = rng.normal(0, 0.15, (size, 4 * hidden))
        p[f"u_{side}"] = rng.normal(0, 0.15, (hidden, 4 * hidden))
        p[f"o_{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)
        p[f"out_{side}"] = rng.normal(0, 0.3, hidden)
    p["bias"] = np.zeros(1)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    model = Model(p)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    pages = sorted((x for x in pages if x[0]), key=lambda x: len(x[0]))
    groups = []
    for a in range(0, len(pages), at_once):
        some = pages[a : a + at_once]
        groups.append((features.see([b for b, _ in some]), np.concatenate([y for _, y in some]).astype(np.float32)))
    steps = 0
    for epoch in range(epochs):
        for g in rng.permutation(len(groups)).tolist():
            seen, truth = groups[g]
            sizes, starts = seen.sizes, np.cumsum(seen.sizes) - seen.sizes
            x = model.inputs(seen)
            dark = np.repeat(rng.random(len(sizes)) < 0.4, sizes)
            x[dark, PATH_SIZE : PATH_SIZE + WORD_SIZE] = 0
            place = np.arange(int(sizes.max()))[:, None]
            inside = place < sizes
            forward = np.where(inside, starts + place, 0)
            backward = np.where(inside, starts + sizes - 1 - place, 0)
            logit, memos = np.zeros(len(x), np.float32), {}
            for side, at in (("f", forward), ("b", backward)):
                states, memos[side] = _trained_side(x[at] * inside[:, :, None], p, side)
                logit[at[inside]] += (states @ p[f"out_{side}"])[inside]
            slope = (_sigmoid(logit + p["bias"][0]) - truth) / len(truth)
            grads: dict[str, np.ndarray] = {"bias": np.array([slope.sum()], np.float32)}
            dx = np.zeros_like(x)
            for side, at in (("f", forward), ("b", backward)):
                own = np.where(inside, slope[at], 0).astype(np.float32)
                states = memos[side]["h"][1:]
                grads[f"out_{side}"] = np.einsum("tb,tbn->n", own, states)
                below = _gradient_side(own[:, :, None] * p[f"out_{side}"], memos[side], p, side, grads)
                dx[at[inside]] += below[inside]
            dx[dark, PATH_SIZE : PATH_SIZE + WORD_SIZE] = 0
            grads["word"] = np.zeros_like(p["word"])
            share = np.repeat(1 / np.sqrt(seen.word_sizes), seen.word_sizes)
            row = np.repeat(np.arange(len(x)), seen.word_sizes)
            np.add.at(grads["word"], seen.words, dx[row, PATH_SIZE : PATH_SIZE + WORD_SIZE] * share[:, None])
            on_path = np.zeros((len(seen.path_names), PATH_SIZE), np.float32)
            np.add.at(on_path, seen.path, dx[:, :PATH_SIZE])
            counts = np.array([len(n) for n in seen.path_names])
            grads["path"] = np.zeros_like(p["path"])
            np.add.at(
                grads["path"],
                np.concatenate(seen.path_names),
                np.repeat(on_path / np.sqrt(np.maximum(counts, 1))[:, None], counts, axis=0),
            )
            steps += 1
            pace = rate * (0.3 if epoch >= epochs * 2 // 3 else 1.0)
            norm = np.sqrt(sum(float((v**2).sum()) for v in grads.values()))
            for key, value in grads.items():
                value = value * min(1.0, 1.0 / (norm + 1e-9))
                first[key] = 0.9 * first[key] + 0.1 * value
                second[key] = 0.999 * second[key] + 0.001 * value**2
                move = first[key] / (1 - 0.9**steps) / (np.sqrt(second[key] / (1 - 0.999**steps)) + 1e-6)
                p[key] -= (pace * move).astype(np.float32)
    return model


def self_marked(reader: Reader, blocks: list[Block]) -> list[bool] | None:
    """Labels of a page that holds its article in an element of that kind, else None."""
    names = [{n for e in b.path for n in reader.names[e]} for b in blocks]
    labels = [bool(n & _ARTICLE) and not n & _AROUND for n in names]
    return labels if any(labels) and not all(labels) else None


def training_pages(
    samples: list[str], features: Features, count: int, seed: int = 13
) -> list[tuple[list[Block], list[bool]]]:
    """Laid out pages with sentences of the samples, and the samples that mark their article."""
    read = [features.reader.blocks(s) for s in samples]
    own = [(b, y) for b in read if (y := self_marked(features.reader, b))]
    rng = random.Random(seed)
    sentences = [s for b in read for block in b for s in re.split(r"(?<=[.!?]) ", block.text)]
    rng.shuffle(sentences)
    maker = Pages([s.replace(MARK, "") for s in sentences[:5000] if s.strip()], seed)
    out = []
    for _ in range(count):
        blocks = features.reader.blocks(maker.page())
        labels = [MARK in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MARK, "").strip() or "-"
            b.linked = min(b.linked, len(b.text))
        out.append((blocks, labels))
    return out + own


def fit(
    pages: DataFrame, *, sample_pages: int = 200, sample_chars: int = 100_000, count: int = 1400, **options
) -> Model:
    """The labeller from a bounded sample of ``pages`` (page_id, html)."""
    some = pages.where(F.length("html").between(1, sample_chars))
    total = some.count()
    spread = F.pmod(F.xxhash64(F.lit(3), "page_id"), F.lit(1 << 20))
    share = max(1, int(sample_pages / max(total, 1) * (1 << 20)))
    rows = some.where(spread < share).select("page_id", "html").collect()
    rows.sort(key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["html"]))
    features = Features()
    chosen = [r["html"] for r in rows[: 2 * sample_pages]]
    return train(training_pages(chosen, features, count), features, **options)


def extract(model: Model, features: Features, pages: list[str | None], least: float = 0.5) -> list[str]:
    """Main text of each page."""
    features.reader.start()
    blocks = [features.reader.blocks(p or "") for p in pages]
    if not any(blocks):
        return [""] * len(pages)
    kept = (model.article(features.see(blocks)) >= least).tolist()
    out, at = [], 0
    for own in blocks:
        out.append(" ".join(b.text for b, keep in zip(own, kept[at : at + len(own)], strict=True) if keep))
        at += len(own)
    return out


def main_text(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, features = shared.value, Features()
        for batch in batches:
            for part in slices(batch, "html"):
                texts = extract(net, features, part.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return slim.mapInArrow(work, "page_id long, url string, text string, n_chars long")

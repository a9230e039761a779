"""Language identification by a byte convolutional network.

A text is cut into windows of a fixed number of UTF-8 bytes, all of it. Bytes are folded to 128
symbols (A-Z to a-z, digits to one, control characters to a blank; bytes from 128 up share symbols
by their low bits). Filters of several widths slide over a window, each filter's largest response is
kept, and a softmax over these gives the window's language distribution. A text's distribution is
the mean over its windows, weighted by their bytes.

The network is trained in numpy on the driver, on a bounded sample of labelled rows (about
``per_language`` rows of each language, chosen by a hash of the id, and ``windows_per_row`` windows
of each), with a fixed seed. A filter over one-hot symbols is a sum of table rows, so prediction
looks responses up in tables of symbol pairs.

Defined results: null, empty or letterless texts are ``und`` with score 0; with no labelled rows all
texts are ``und``; ties go to the smaller language name; repeated rows are predicted alike; columns
other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import held, in_small_batches, slices

SYMBOLS = 128
WINDOW = 256
UNKNOWN = "und"


def _symbols() -> np.ndarray:
    table = np.arange(256) % SYMBOLS
    for b in range(256):
        if 65 <= b <= 90:
            table[b] = b + 32
        elif 48 <= b <= 57:
            table[b] = 48
        elif b < 33 or b == 127:
            table[b] = 32
        elif b >= 128:  # lead bytes to 65..90 and below, the rest by their low bits
            table[b] = b - 128 if b < 192 else (b - 192) % 26 + 65
    table[0] = 0
    return table.astype(np.uint8)


_FOLD = _symbols()


@dataclass
class Model:
    languages: list[str]
    filters: dict[int, np.ndarray]  # width → (width, SYMBOLS, n_filters)
    bias: np.ndarray
    weights: np.ndarray  # (all filters, languages)
    offset: np.ndarray

    def tables(self) -> list[tuple[int, np.ndarray]]:
        """(shift, responses of a symbol pair at that shift) for all filters side by side."""
        out = []
        widest = max(self.filters)
        for shift in range(0, widest, 2):
            columns = []
            for width, taps in sorted(self.filters.items()):
                first = taps[shift] if shift < width else np.zeros_like(taps[0])
                second = taps[shift + 1] if shift + 1 < width else np.zeros_like(taps[0])
                columns.append((first[:, None, :] + second[None, :, :]).reshape(SYMBOLS**2, -1))
            out.append((shift, np.concatenate(columns, axis=1).astype(np.float32)))
        return out


def windows(text: bytes, size: int = WINDOW) -> np.ndarray:
    """Folded symbols of all windows of a text, the last one padded with symbol 0."""
    folded = _FOLD[np.frombuffer(text, np.uint8)]
    n = max(1, -(-len(folded) // size))
    out = np.zeros(n * size, np.uint8)
    out[: len(folded)] = folded
    return out.reshape(n, size)


def _responses(model: Model, rows: np.ndarray, tables: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Largest response of every filter in every window."""
    widest = max(model.filters)
    padded = np.zeros((len(rows), rows.shape[1] + widest), np.int32)
    padded[:, : rows.shape[1]] = rows
    pairs = padded[:, :-1] * SYMBOLS + padded[:, 1:]
    out = np.empty((len(rows), len(model.bias)), np.float32)
    step = 16
    for a in range(0, len(rows), step):
        at = pairs[a : a + step]
        total = tables[0][1].take(at[:, : rows.shape[1]], axis=0)
        for shift, table in tables[1:]:
            total += table.take(at[:, shift : shift + rows.shape[1]], axis=0)
        out[a : a + step] = total.max(axis=1)
    return out + model.bias


def probabilities(model: Model, rows: np.ndarray, tables: list[tuple[int, np.ndarray]]) -> np.ndarray:
    hidden = np.maximum(_responses(model, rows, tables), 0)
    logits = hidden @ model.weights + model.offset
    logits -= logits.max(axis=1, keepdims=True)
    out = np.exp(logits)
    return out / out.sum(axis=1, keepdims=True)


def train(
    rows: list[tuple[bytes, str]],
    *,
    widths: tuple[int, ...] = (2, 3, 4),
    filters: int = 16,
    windows_per_row: int = 12,
    epochs: int = 8,
    rate: float = 0.01,
    seed: int = 7,
) -> Model | None:
    """Adam on the cross entropy of windows; None without rows."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in rows})
    parts, labels = [], []
    for text, lang in rows:
        own = windows(text)
        if len(own) > windows_per_row:
            own = own[rng.choice(len(own), windows_per_row, replace=False)]
        # shorter windows teach short texts
        cut = own.copy()
        for row in cut:
            row[int(rng.integers(12, WINDOW)) :] = 0
        parts += [own, cut]
        labels += [languages.index(lang)] * (2 * len(own))
    x, y = np.concatenate(parts), np.array(labels)
    n_all = filters * len(widths)
    params = {w: rng.normal(0, 0.3, (w, SYMBOLS, filters)).astype(np.float32) for w in widths}
    params["bias"] = np.zeros(n_all, np.float32)
    params["weights"] = rng.normal(0, 0.3, (n_all, len(languages))).astype(np.float32)
    params["offset"] = np.zeros(len(languages), np.float32)
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    steps, size = 0, 128

    def model() -> Model:
        return Model(
            languages,
            {w: params[w] for w in widths},
            params["bias"],
            params["weights"],
            params["offset"],
        )

    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), size):
            at = order[a : a + size]
            rows_, truth = x[at], y[at]
            padded = np.zeros((len(at), WINDOW + max(widths)), np.uint8)
            padded[:, :WINDOW] = rows_
            best, peaks = [], []
            for w in widths:
                total = params[w][0][padded[:, :WINDOW]]
                for k in range(1, w):
                    total += params[w][k][padded[:, k : k + WINDOW]]
                top = total.argmax(axis=1)
                peaks.append(top)
                best.append(np.take_along_axis(total, top[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(best, axis=1) + params["bias"]
            hidden = np.maximum(raw, 0)
            logits = hidden @ params["weights"] + params["offset"]
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), truth] -= 1
            p /= len(at)
            back = (p @ params["weights"].T) * (raw > 0)
            grads = {"weights": hidden.T @ p, "offset": p.sum(0), "bias": back.sum(0)}
            lane = np.arange(filters)[None, :]
            for i, w in enumerate(widths):
                g = np.zeros_like(params[w])
                own = back[:, i * filters : (i + 1) * filters]
                for k in range(w):
                    symbol = padded[np.arange(len(at))[:, None], peaks[i] + k]
                    np.add.at(g[k], (symbol, np.broadcast_to(lane, symbol.shape)), own)
                grads[w] = g
            steps += 1
            for key, g in grads.items():
                first[key] = 0.9 * first[key] + 0.1 * g
                second[key] = 0.999 * second[key] + 0.001 * g * g
                move = first[key] / (1 - 0.9**steps)
                params[key] = params[key] - rate * move / (
                    np.sqrt(second[key] / (1 - 0.999**steps)) + 1e-8
                )
    return model()


def sample(docs: DataFrame, learn: Column, per_language: int) -> list[tuple[bytes, str]]:
    """About ``per_language`` labelled rows of each language, chosen by a hash of the id: a rate is
    set from each language's row count, so what is collected does not grow with the input."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").count().collect()
    spread = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 20))
    chosen = None
    for row in counts:
        share = max(1, int(per_language / row["count"] * (1 << 20)))
        rule = (F.col("lang") == row["lang"]) & (spread < share)
        chosen = rule if chosen is None else chosen | rule
    if chosen is None:
        return []
    rows = labelled.where(chosen).select("doc_id", "text", "lang").collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    return [(r["text"].encode("utf-8", "replace"), r["lang"]) for r in rows]


def fit(docs: DataFrame, learn: Column, per_language: int = 250, **options) -> Model | None:
    """The network from the rows of ``docs`` (doc_id, text, lang) for which ``learn`` holds."""
    return train(sample(docs, learn, per_language), **options)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (the text's mean probability of that language)."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType(
        [f for f in docs.schema if f.name not in ("lang_pred", "score")]
        + [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter = regex.compile(r"\p{L}").search
        net = shared.value
        held("language", lambda: None)
        tables = net.tables() if net else []
        for batch in batches:
            keep = [n for n in batch.schema.names if n not in ("lang_pred", "score")]
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                known = [i for i, t in enumerate(texts) if net and t and letter(t)]
                if known:
                    coded = [texts[i].encode("utf-8", "replace") for i in known]
                    cut = [windows(c) for c in coded]
                    p = probabilities(net, np.concatenate(cut), tables)
                    at = 0
                    for i, own, code in zip(known, cut, coded, strict=True):
                        weight = np.full(len(own), float(WINDOW))
                        weight[-1] = len(code) - WINDOW * (len(own) - 1)
                        mean = (p[at : at + len(own)] * weight[:, None]).sum(0) / weight.sum()
                        at += len(own)
                        best = int(mean.argmax())
                        langs[i], scores[i] = net.languages[best], min(1.0, float(mean[best]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(part.schema.names.index(n)) for n in keep],
                        pa.array(langs, pa.string()),
                        pa.array(scores, pa.float64()),
                    ],
                    names=[*keep, "lang_pred", "score"],
                )

    return in_small_batches(docs).mapInArrow(work, schema)

"""Byte-level BPE ids of whole texts, memoised per space-delimited piece.

The byte-level pre-tokenizer splits a text at every single blank between two non-blanks, whatever
stands around it, so the ids of a text are the ids of its pieces in a row. Pieces not seen before are
encoded by the ``tokenizers`` library, many in one call; the memo is emptied at a fixed number of
entries, so memory is bounded. The result equals ``Tokenizer.encode(text, add_special_tokens=False)``
with ``encode_special_tokens`` on (the texts of special tokens are ordinary text), which the tests
check.
"""

from __future__ import annotations

import os
from array import array

import numpy as np

from lakeferry.llm.common import held

def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Memo(dict):
    """Piece → number, in the order in which pieces are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


#: New pieces that are encoded as one text: texts of some KB stay in a processor's cache.
LINE_PIECES = 200
_ODD = -1  # length of a piece that is empty or begins or ends with white space


class PieceEncoder:
    """Pieces are kept by their text without the blank before them; the first piece of a text, which
    has none, is kept with a blank put before it, as no other key has one."""

    def __init__(self, path: str, limit: int = 500_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.limit = limit
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        vocabulary = self._tokenizer.get_vocab()
        self._blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self._blank[[i for t, i in vocabulary.items() if t[0] == "\u0120"]] = True
        self._reset()

    def _reset(self) -> None:
        self._memo = _Memo()
        self._flat, self._starts, self._lens = array("I"), array("q"), array("q")

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        done = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in done]

    def _learn(self) -> None:
        new, self._memo.new = self._memo.new, []
        lens, starts = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        firsts, others = [], []
        for i, piece in enumerate(new):
            if piece[:1] == " ":
                if len(piece) > 1 and not piece[-1].isspace():
                    firsts.append(i)
                    continue
            elif piece and not piece[0].isspace() and not piece[-1].isspace():
                others.append(i)
                continue
            lens[i] = _ODD
        at = len(self._flat)
        if others:
            # a token with a blank in it begins a piece: pieces hold no other blanks
            lines = (others[i : i + LINE_PIECES] for i in range(0, len(others), LINE_PIECES))
            ids = np.concatenate(self._ids([" " + " ".join([new[i] for i in line]) for line in lines]))
            begins = np.flatnonzero(self._blank[ids])
            starts[others] = at + begins
            lens[others] = np.diff(begins, append=len(ids))
            self._flat.frombytes(ids.tobytes())
            at += len(ids)
        for i, ids in zip(firsts, self._ids([new[i][1:] for i in firsts]), strict=True):
            starts[i], lens[i] = at, len(ids)
            self._flat.frombytes(ids.tobytes())
            at += len(ids)
        self._starts.frombytes(starts.tobytes())
        self._lens.frombytes(lens.tobytes())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and the number of ids of each text."""
        if len(self._memo) > self.limit:
            self._reset()
        look = self._memo.__getitem__
        index = []
        for text in texts:
            pieces = text.split(" ") if text else []
            if pieces:
                pieces[0] = " " + pieces[0]
            index.append(np.fromiter(map(look, pieces), np.int64, len(pieces)))
        self._learn()
        every = np.concatenate(index) if index else np.zeros(0, np.int64)
        cuts = np.cumsum([0] + [len(i) for i in index])
        lens = np.frombuffer(self._lens, np.int64)[every]
        starts = np.frombuffer(self._starts, np.int64)[every]
        odd = np.concatenate(([0], np.cumsum(lens == _ODD)))
        odd_texts = np.flatnonzero(odd[cuts[1:]] > odd[cuts[:-1]])
        for i in odd_texts.tolist():
            lens[cuts[i] : cuts[i + 1]] = 0
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(starts - (ends - lens), lens)
        ids = np.frombuffer(self._flat, np.uint32)[at]
        sums = np.concatenate(([0], ends))[cuts]
        counts = np.diff(sums)
        if len(odd_texts):
            parts, done = [], 0
            for i, own in zip(odd_texts.tolist(), self._ids([texts[i] for i in odd_texts]), strict=True):
                parts += [ids[done : sums[i]], own]
                done = sums[i]
                counts[i] = len(own)
            ids = np.concatenate([*parts, ids[done:]])
        return ids, counts


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary file."""
    return held(("tokens", path), lambda: PieceEncoder(path))

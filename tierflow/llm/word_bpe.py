"""Whole-text encoding with the tokenizers library, each distinct unit of text once per worker.

The vocabulary file's normaliser and pre-tokeniser never join what stands on the two sides of ASCII white space, nor a
Latin letter and a following sentence mark, nor such a mark and a following ASCII letter. So texts are cut there, distinct
units are encoded by the library, and the ids are put together again: the ids are those of the whole text.
"""

from __future__ import annotations

from functools import cache
from itertools import chain

import numpy as np

from tierflow.llm.piececache import PieceCache
from tierflow.llm.textscan import SPACES, lowered, span_keys

_WORD, _MARK, _ALPHA = 1, 2, 4  # classes of bytes, looked up in one pass
_CLASS = np.where(SPACES, 0, _WORD).astype(np.uint8)
_CLASS[list(b".,!?;:*$%&#()-")] |= _MARK
_CLASS[[*range(65, 91), *range(97, 123)]] |= _ALPHA
_CLASSES = _CLASS.tobytes()


def units(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, units per row)."""
    n = len(b)
    kinds = np.frombuffer(b.tobytes().translate(_CLASSES), np.uint8)
    word = np.zeros(n + 2, bool)
    np.not_equal(kinds, 0, out=word[1:-1])
    cut = np.zeros(n + 1, bool)
    if n > 1:
        mark, letter = (kinds & _MARK) != 0, (kinds & _ALPHA) != 0
        latin = np.zeros(n, bool)  # last byte of U+00C0 to U+023F without two signs and the one that gives two in lower case
        lead, last = b[:-1], b[1:]
        latin[1:] = (lead >= 0xC3) & (lead <= 0xC8) & (last >= 0x80) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7))) & ~((lead == 0xC4) & (last == 0xB0))
        cut[1:-1] = ((letter | latin)[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    cut[offs] = True
    cut |= word[1:] != word[:-1]
    starts = np.flatnonzero(word[1:-1] & cut[:-1])
    ends = np.flatnonzero(word[1:-1] & cut[1:]) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))


def _byte_letters() -> dict[int, int]:
    """Byte-level letters: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in set(own)]
    return dict(zip(own, own, strict=True)) | {x: 0x100 + k for k, x in enumerate(rest)}


_BYTES = _byte_letters()


class WordEncoder:
    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = PieceCache(self._encode)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode("utf-8", "replace") for p in pieces]
        out: list = [None] * len(texts)
        model, other = self.tokenizer.model.tokenize, []
        for k, x in enumerate(texts):
            if pieces[k].isalpha():  # ASCII letters stand for their own bytes
                out[k] = [y.id for y in model(x.lower())]
            elif x.isalpha() and max(x) <= "\xff":  # one word without normal forms to make: straight to the merges
                out[k] = [y.id for y in model(x.lower().encode().decode("latin-1").translate(_BYTES))]
            else:
                other.append(k)
        for k, x in zip(other, self.tokenizer.encode_batch_fast([texts[k] for k in other], add_special_tokens=False), strict=True):
            out[k] = x.ids
        lens = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint16, int(lens.sum())), lens

    def encode(self, b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, ids per row)."""
        starts, ends, per_row = units(b, offs)
        known = lowered(b)  # the model works in lower case, so these may share an entry
        if (b == 60).any():  # special tokens are matched before the lower case
            sign = np.concatenate(([0], np.cumsum(b == 60)))
            for k in np.flatnonzero(sign[ends] > sign[starts]).tolist():
                known[starts[k] : ends[k]] = b[starts[k] : ends[k]]
        ids, lens = self.pieces.tokens(b.tobytes(), span_keys(known, starts, ends, lower=False), starts, ends)
        total = np.concatenate(([0], np.cumsum(lens)))
        return ids, np.diff(total[np.concatenate(([0], np.cumsum(per_row)))])


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_end(ids: np.ndarray, per_row: np.ndarray, end: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The rows' ids, each followed by ``end``."""
    out = np.full(len(ids) + len(per_row), end, ids.dtype)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(per_row + 1) - 1] = False
    out[keep] = ids
    return out, per_row + 1

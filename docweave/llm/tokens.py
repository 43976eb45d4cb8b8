"""Token ids of whole texts by a word-level BPE file, many texts at once.

The tokenizer joins nothing across blanks, nor after a run of letters, so texts
are cut there, each distinct piece is encoded once per worker, and the ids of a
batch are put together by array lookups. Ids are those of the library for the
whole text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from docweave.llm.texts import BLANK, BYTE_CODE, LOWER, prefix_sums, ranges, slices, span_hash, word_spans

END_ID = 1
VOCABULARY = "word_bpe_49k.json"
# Pieces kept by one worker before it starts anew.
KEPT_PIECES = 1_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Second bytes of the Latin-1 letters (first byte C3): all but the signs for times and divide.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_LATIN_LOWER = np.arange(256, dtype=np.uint8)
_LATIN_LOWER[0x80:0x9F] += 0x20
_LATIN_LOWER[0x97] = 0x97


class WordBpe:
    """Encoder of many texts with a memory of the pieces it has seen."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.special = [str(t.content).encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)
        self.store = np.empty(0, np.uint16 if self.size <= 1 << 16 else np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of new pieces."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        found: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if t.isalpha() and (t.isascii() or max(t) < "\u0100")]
        for a in range(0, len(plain), 1000):
            some = plain[a : a + 1000]
            ids = np.array(self._encode([" ".join(texts[i] for i in some)])[0], self.store.dtype)
            for i, part in zip(some, np.split(ids, np.flatnonzero(self.ends[ids])[:-1] + 1)):
                found[i] = part
        rest = [i for i, f in enumerate(found) if f is None]
        for a in range(0, len(rest), 1000):
            for i, ids in zip(rest[a : a + 1000], self._encode([texts[i] for i in rest[a : a + 1000]])):
                found[i] = np.array(ids, self.store.dtype)
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids, lengths = self._pieces(pieces)
        starts = len(self.store) + np.cumsum(lengths) - lengths
        self.store = np.concatenate([self.store, ids])
        into = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, into, hashes)
        self.at = np.insert(self.at, into, starts)
        self.length = np.insert(self.length, into, lengths)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number by text."""
        body = data.tobytes()
        if any(s in body for s in self.special):  # cut inside, their strings would be lost
            parts = []
            for a, b in zip(offs[:-1], offs[1:]):
                if any(s in body[a:b] for s in self.special):
                    parts.append(np.array(self._encode([body[a:b].decode()])[0], self.store.dtype))
                else:
                    parts.append(self._whole(data[a:b], np.array([0, b - a]))[0])
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return self._whole(data, offs)

    def _whole(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, _ = word_spans(data, offs)
        if not len(starts):
            return self.store[:0], np.zeros(len(offs) - 1, np.int64)
        latin = np.zeros(len(data) + 1, bool)  # second byte of a Latin-1 letter
        latin[1:-1] = (data[:-1] == 0xC3) & _LATIN[data[1:]]
        pair = latin[:-1] | latin[1:]
        odd = np.concatenate(([0], np.cumsum((data >= 0x80) & ~pair)))
        simple = odd[ends] == odd[starts]
        letter = _LETTER[data] | pair
        cut = np.flatnonzero(letter[:-1] & ~letter[1:] & ~BLANK[data[1:]]) + 1
        cut = cut[simple[np.searchsorted(starts, cut, side="right") - 1]]
        # A cut at the first byte of a word would be an empty piece.
        cut = np.setdiff1d(cut, starts, assume_unique=True)
        step = np.zeros(len(data) + 1, np.int8)
        step[starts[simple]] += 1
        step[ends[simple]] -= 1
        low = np.where(np.cumsum(step[:-1]) > 0, np.where(latin[:-1], _LATIN_LOWER[data], LOWER[data]), data)
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        hashes = span_hash(prefix_sums(BYTE_CODE[low]), starts, ends)
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > KEPT_PIECES and len(self.known):
            self.forget()
        here = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.known):
            new = self.known[np.minimum(here, len(self.known) - 1)] != distinct
        if new.any():
            text = low.tobytes()
            fresh = first[new]
            self._learn(distinct[new], [text[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())])
            here = np.searchsorted(self.known, distinct)
        lengths = self.length[here][place]
        ids = self.store[ranges(self.at[here][place], lengths)]
        upto = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(upto[np.searchsorted(starts, offs)])


_encoders: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = WordBpe(path)
    return _encoders[path]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encoded(batches: Iterator[pa.RecordBatch], path: str | None = None, end_id: int | None = END_ID):
    """(batch slice, ids, ends): ids of the texts, each closed by ``end_id``; text i ends at ends[i]."""
    bpe = encoder(path or vocabulary_path())
    for batch, data, offs in slices(batches):
        ids, counts = bpe.encode(data, offs)
        upto = np.cumsum(counts)
        if end_id is not None:
            ids = np.insert(ids, upto, end_id)
            upto = upto + np.arange(1, len(upto) + 1)
        yield batch, ids, upto

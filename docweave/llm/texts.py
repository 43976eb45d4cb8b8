"""Texts of Arrow batches as byte arrays: slices, words, hashes, windows.

Everything works on many texts at once. ``data`` holds the UTF-8 bytes of the
texts one after the other, ``offs`` where each begins (and the end of the last).
Words are runs without ASCII blanks (space, tab to carriage return); a null text
has none.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_CODE = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64)
# Text handled at once; numpy columns of eight bytes per byte stay near 4 MB.
SLICE_BYTES = 1 << 19


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``data`` and ``offs`` of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, ends, body = column.buffers()
    offs = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES):
    """(batch slice, data, offs) with at most ``most`` bytes of text, or one text."""
    for batch in batches:
        yield from batch_slices(batch, column, most)
    give_back()


def batch_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    """``slices`` of one batch."""
    if not batch.num_rows:
        return
    data, offs = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offs, offs[at] + most, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def give_back() -> None:
    """Memory that a task has freed goes back to the system: workers are kept between tasks."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def word_spans(data: np.ndarray, offs: np.ndarray, kind: np.ndarray | None = None):
    """Starts and ends of all words, and for each text the index of its first word.

    ``kind``: which bytes are part of a word, all but blanks unless given.
    """
    return mask_spans(~BLANK[data] if kind is None else kind[data], offs)


def mask_spans(inside: np.ndarray, offs: np.ndarray):
    """As ``word_spans``, of the runs of true in ``inside`` that no border of texts cuts."""
    edge = np.zeros(len(inside) + 1, bool)  # a text begins here
    edge[offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs)


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 1), b, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of code * BASE**i, from which every span's hash is one subtraction."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.multiply(codes, powers(len(codes))[0], out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, alike for equal content wherever it stands."""
    back = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_sums(BYTE_CODE[data]), starts, ends)


def window_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` consecutive entries at ``starts``."""
    return span_hash(prefix_sums(words), starts, starts + size)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, … of every run, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def covered(marks: np.ndarray, size: int) -> np.ndarray:
    """Places covered by windows of ``size`` that start where ``marks`` is true."""
    step = np.zeros(len(marks) + size + 1, np.int32)
    step[: len(marks)] += marks
    step[size : size + len(marks)] -= marks
    return np.cumsum(step)[: len(marks)] > 0


def runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    step = np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)

"""Quality rules: lines labelled content or boilerplate by a conditional random field.

Counts over a whole text (words, symbols, repeated lines and windows) rule out
the worst. What is left is judged line by line: features of each line and the
label of the line before decide, by Viterbi decoding of a linear chain, and the
share of the text that is content decides whether it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.tables import labelled_sample, prior_shift
from docweave.llm.texts import (
    BLANK, BYTE_CODE, covered, mix, prefix_sums, slices, span_hash, window_hashes, word_hashes, word_spans,
)

SAMPLE = 2000
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CONTENT, BOILERPLATE = 1, 0
KEEP_SHARE = 0.5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

_UPPER, _DIGIT, _PUNCT, _STOP = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP[list(b".!?:;\"'")] = True
# Bounds of the steps that turn each measure of a line into features.
STEPS = {
    "words": (1, 2, 4, 8, 16, 32, 64),
    "word_length": (2, 4, 6, 8, 12),
    "upper": (0.02, 0.1, 0.3, 0.6),
    "digits": (0.001, 0.05, 0.2, 0.5),
    "punctuation": (0.01, 0.03, 0.06, 0.12, 0.25),
    "symbols": (0.001, 0.02, 0.1),
    "distinct": (0.2, 0.4, 0.6, 0.8, 0.95),
    "stopped": (0.5,),
    "seen": (0.5,),
}
FEATURES = sum(len(s) + 1 for s in STEPS.values())


@dataclass
class Lines:
    """Lines of many texts: owner, size in bytes, and the feature of each measure."""

    first: np.ndarray
    size: np.ndarray
    features: np.ndarray


def _sum(marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(marks)))
    return upto[ends] - upto[starts]


def measures(data: np.ndarray, offs: np.ndarray) -> tuple[dict[str, np.ndarray], Lines]:
    """Counts of each text, and its lines."""
    n = len(offs) - 1
    starts, ends, first = word_spans(data, offs)
    words = word_hashes(data, starts, ends)
    whole = (data & 0xC0) != 0x80
    doc_of_word = np.repeat(np.arange(n), np.diff(first))
    out = {
        "n_words": np.diff(first),
        "word_chars": _sum(whole & ~BLANK[data], offs[:-1], offs[1:]),
        "n_symbols": _sum(SYMBOLS[data], offs[:-1], offs[1:]),
    }
    # Windows found twice within one text.
    usable = np.maximum(np.diff(first) - REPEAT_WINDOW + 1, 0)
    place = np.arange(len(words))
    at = place[place - first[doc_of_word] < usable[doc_of_word]]
    keys = mix(window_hashes(words, at, REPEAT_WINDOW) + doc_of_word[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    marks = np.zeros(len(words), bool)
    marks[at] = count[which] > 1
    out["n_repeat_words"] = _sum(covered(marks, REPEAT_WINDOW), first[:-1], first[1:])
    # Lines: one more than a text has line feeds.
    feed = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offs[:-1], feed + 1]))
    end = np.sort(np.concatenate([offs[1:], feed]))
    line_first = np.searchsorted(feed, offs) + np.arange(n + 1)
    owner = np.repeat(np.arange(n), np.diff(line_first))
    begin, end = begin[: len(owner)], end[: len(owner)]
    word_from, word_to = np.searchsorted(starts, begin), np.searchsorted(starts, end)
    has = word_to > word_from
    line_key = mix(span_hash(prefix_sums(BYTE_CODE[data]), begin, end) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    seen = np.zeros(len(owner), bool)
    rows = np.flatnonzero(has)
    order = rows[np.argsort(line_key[rows], kind="stable")]
    seen[order[1:]] = line_key[order[1:]] == line_key[order[:-1]]
    out["n_dup_lines"] = _sum(seen, line_first[:-1], line_first[1:])
    size = np.maximum(end - begin, 1)
    count_words = np.maximum(word_to - word_from, 1)
    line_of_word = np.searchsorted(begin, starts, side="right") - 1
    word_key = np.unique(mix(words + line_of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    distinct = np.bincount(line_of_word[word_key], minlength=len(owner))[: len(owner)]
    last = np.zeros(len(owner), bool)
    last[has] = _STOP[data[ends[word_to[has] - 1] - 1]]
    values = {
        "words": word_to - word_from,
        "word_length": _sum(~BLANK[data], begin, end) / count_words,
        "upper": _sum(_UPPER[data], begin, end) / size,
        "digits": _sum(_DIGIT[data], begin, end) / size,
        "punctuation": _sum(_PUNCT[data], begin, end) / size,
        "symbols": _sum(SYMBOLS[data], begin, end) / size,
        "distinct": distinct / count_words,
        "stopped": last,
        "seen": seen,
    }
    features, base = [], 0
    for name, steps in STEPS.items():
        features.append(base + np.searchsorted(np.array(steps), values[name], side="right"))
        base += len(steps) + 1
    return out, Lines(line_first, _sum(whole & ~BLANK[data], begin, end), np.stack(features, 1))


@dataclass
class Chain:
    """Linear-chain conditional random field with two labels."""

    emission: np.ndarray  # (FEATURES, 2)
    moves: np.ndarray  # (2, 2), from and to
    start: np.ndarray  # (2,)

    def scores(self, lines: Lines) -> np.ndarray:
        return self.emission[lines.features].sum(axis=1)


def _steps(first: np.ndarray):
    """For t = 0, 1, …: indices of the t-th lines of the texts that have one, longest texts first."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    left = -np.sort(-count)
    for t in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -t, side="left"))
        yield first[:-1][order[:n]] + t


def viterbi(chain: Chain, lines: Lines) -> np.ndarray:
    """The likeliest labels of all lines, all texts decoded side by side; ties go to content."""
    score = chain.scores(lines)
    labels = np.zeros(len(score), np.int64)
    steps = list(_steps(lines.first))
    if not steps:
        return labels
    best = chain.start + score[steps[0]]
    back = []
    for at in steps[1:]:
        ways = best[: len(at), :, None] + chain.moves
        came = np.where(ways[:, 1] >= ways[:, 0], 1, 0)
        back.append(came)
        new = np.take_along_axis(ways, came[:, None, :], axis=1)[:, 0] + score[at]
        best = np.concatenate([new, best[len(at) :]])
    state = (best[:, 1] >= best[:, 0]).astype(np.int64)
    for t in range(len(steps) - 1, 0, -1):
        n = len(steps[t])
        labels[steps[t]] = state[:n]
        state[:n] = back[t - 1][np.arange(n), state[:n]]
    labels[steps[0]] = state
    return labels


def _marginals(chain: Chain, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of all lines and expected moves, by forward and backward sums."""
    score, steps = chain.scores(lines), list(_steps(lines.first))
    forward, backward = np.zeros_like(score), np.zeros_like(score)
    forward[steps[0]] = chain.start + score[steps[0]]
    for before, at in zip(steps, steps[1:]):
        ways = forward[before[: len(at)], :, None] + chain.moves
        forward[at] = np.logaddexp(ways[:, 0], ways[:, 1]) + score[at]
    moves = np.zeros((2, 2))
    for before, at in zip(steps[-2::-1], steps[:0:-1]):
        ahead = chain.moves + (score[at] + backward[at])[:, None, :]
        backward[before[: len(at)]] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
        joint = forward[before[: len(at)], :, None] + ahead
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = forward + backward
    both -= both.max(axis=1, keepdims=True)
    both = np.exp(both)
    return both / both.sum(axis=1, keepdims=True), moves


def train(lines: Lines, labels: np.ndarray, rounds: int = 80, rate: float = 0.5, decay: float = 1e-3) -> Chain:
    """Fit to labelled lines by gradient ascent on the likelihood of whole texts."""
    chain = Chain(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    if not len(labels) or len(set(labels.tolist())) < 2:
        chain.emission[:, CONTENT] = 0.1
        return chain
    truth = np.eye(2)[labels]
    head = lines.first[:-1]
    pairs = np.setdiff1d(np.arange(len(labels)), lines.first[1:] - 1)
    true_moves = np.zeros((2, 2))
    np.add.at(true_moves, (labels[pairs], labels[pairs + 1]), 1)
    seen = [np.full(x.shape, 1e-6) for x in (chain.emission, chain.moves, chain.start)]
    for _ in range(rounds):
        p, moves = _marginals(chain, lines)
        rest = (truth - p) / len(labels)
        emission = np.zeros_like(chain.emission)
        for column in lines.features.T:
            np.add.at(emission, column, rest)
        steps = (emission, (true_moves - moves) / len(labels), rest[head].sum(axis=0))
        for x, g, s in zip((chain.emission, chain.moves, chain.start), steps, seen):
            g = g - decay * x
            s += g**2
            x += rate * g / np.sqrt(s)
    return chain


def learned(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Chain:
    """A chain learned from lines of documents labelled good (content) or bad (boilerplate).

    The score of a first line is set to the share of good documents among all labelled ones.
    """

    def read(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(batches):
            _, lines = measures(data, offs)
            spans = list(zip(lines.first[:-1], lines.first[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lines.features[a:b].astype(np.uint8).tobytes() for a, b in spans], pa.binary()),
                    batch.column("label"),
                ],
                ["features", "label"],
            )

    sample = labelled_sample(docs, labels, "quality", most).mapInArrow(read, "features binary, label int")
    rows = sorted((bytes(r.features), r.label) for r in sample.collect())  # at most 2 * most rows
    features = [np.frombuffer(f, np.uint8).reshape(-1, len(STEPS)) for f, _ in rows]
    counts = np.array([len(f) for f in features], np.int64)
    lines = Lines(np.concatenate(([0], np.cumsum(counts))), np.empty(0), np.concatenate(features).astype(np.int64) if rows else np.empty((0, len(STEPS)), np.int64))
    chain = train(lines, np.repeat(np.array([y for _, y in rows], np.int64), counts))
    chain.start[CONTENT] += prior_shift(docs, labels, "quality", most)
    return chain


def judged(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, counts, base_failed, kept, n_lines, content_share) of every row of (doc_id, text).

    The share is taken over the characters of words; a text without any has
    share 0. Base rules: fewer than 10 words, or more than a fifth of the words
    in windows of five found twice or more.
    """

    def judge(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(batches):
            counts, lines = measures(data, offs)
            content = viterbi(chain, lines) == CONTENT
            spans = lines.first[:-1], lines.first[1:]
            share = _sum(lines.size * content, *spans) / np.maximum(_sum(lines.size, *spans), 1)
            failed = (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])
            columns = {
                "doc_id": batch.column("doc_id"),
                **{c: pa.array(counts[c], pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
                "base_failed": pa.array(failed),
                "kept": pa.array(~failed & (share >= KEEP_SHARE)),
                "n_lines": pa.array(np.diff(lines.first), pa.int64()),
                "content_share": pa.array(share, pa.float64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, n_lines long, content_share double"
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judge, schema)


def quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Counts and verdict of every row of (doc_id, text).

    The chain learns from ``labels`` (doc_id, quality); ``most``: labelled
    documents of each kind, at most. Without labels of both kinds every line is
    content. Null and empty texts have no words and fail. Ids may be missing,
    repeated rows are judged each, an empty table gives no rows.
    """
    return judged(docs, learned(docs, labels, most))

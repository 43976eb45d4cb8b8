"""Finite automata over long byte arrays without a step per byte in Python."""

from __future__ import annotations

import numpy as np

# Bytes of a row: so many steps are taken, each over all rows at once.
ROW = 64


def state_maps(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each row of ``codes`` the map from the state before it to the state after it.

    ``table[byte, state]`` is the next state. Maps compose, so rows are folded
    side by side: the steps are as many as a row is long.
    """
    maps = np.broadcast_to(np.arange(table.shape[1], dtype=table.dtype), (len(codes), table.shape[1])).copy()
    for k in range(codes.shape[1]):
        maps = table[codes[:, k, None], maps]
    return maps


def states_after(data: np.ndarray, table: np.ndarray, start: int = 0) -> np.ndarray:
    """The state after each byte of ``data``, beginning in ``start``.

    Rows of ``ROW`` bytes are turned into maps, the maps of the rows are applied
    one after the other, and with the state each row begins in known all rows
    run side by side once more.
    """
    rows = -(-len(data) // ROW)
    padded = np.zeros(rows * ROW, np.uint8)
    padded[: len(data)] = data
    codes = padded.reshape(rows, ROW)
    maps = state_maps(codes, table)
    begin = np.empty(rows, table.dtype)
    state = start
    for r, row in enumerate(maps.tolist()):
        begin[r] = state
        state = row[state]
    out = np.empty((rows, ROW), table.dtype)
    for k in range(ROW):
        begin = table[codes[:, k], begin]
        out[:, k] = begin
    return out.ravel()[: len(data)]


def automaton(states: int, moves: list[tuple[int, str, int]], error: int) -> np.ndarray:
    """A table of ``states`` from (state, bytes as hex ranges "41-5A 61", next state); all else leads to ``error``."""
    table = np.full((256, states), error, np.uint8)
    for state, ranges, to in moves:
        for part in ranges.split():
            low, _, high = part.partition("-")
            table[int(low, 16) : int(high or low, 16) + 1, state] = to
    return table

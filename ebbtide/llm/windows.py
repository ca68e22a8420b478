"""Windows of a fixed number of tokens, gathered at seeds that their content chooses.

Every window holds ``length - seed + 1`` seeds (runs of ``seed`` tokens). The
one with the least hash is its anchor, so equal windows have equal anchors at
equal places. Windows of one text with the same anchor are neighbours; they are
a *block*, and one row stands for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ebbtide.llm.texts import Rolling, mixed, runs, sliding_argmin

_PLACE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Blocks:
    """Blocks of windows: hash of the anchor's seed, hash of all that the block covers, first window, windows."""

    seed: np.ndarray
    span: np.ndarray
    start: np.ndarray
    windows: np.ndarray


def blocks(x: np.ndarray, ends: np.ndarray, length: int, seed: int) -> Blocks:
    """The blocks of tokens ``x``; no window crosses one of ``ends`` (ends of texts, ascending, the last one ``len(x)``)."""
    roll = Rolling(0)
    p = roll.prefix(x)
    seeds = mixed(roll.every(p, seed))
    anchor = sliding_argmin(seeds, length - seed + 1)
    starts = np.arange(len(anchor), dtype=np.int64)
    if len(ends) > 1:  # drop windows across ends
        inside = np.ones(len(anchor) + 1, np.int32)
        mark = np.zeros(len(anchor) + 1, np.int32)
        cut = ends[:-1]
        np.add.at(mark, np.clip(cut - length + 1, 0, len(anchor)), 1)
        np.add.at(mark, np.clip(cut, 0, len(anchor)), -1)
        inside = np.cumsum(mark)[:-1] == 0
        starts, anchor = starts[inside], anchor[inside]
    first, last = runs(anchor, starts)
    s, n, at = starts[first], last - first + 1, anchor[first]
    span = mixed(roll.of(p, s, n + length - 1) + (at - s).astype(np.uint64) * _PLACE + n.astype(np.uint64))
    return Blocks(seeds[at], span, s, n)


def fingerprints(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window of ``x``."""
    return tuple(mixed(r.every(r.prefix(x), length)) for r in (Rolling(1), Rolling(2)))

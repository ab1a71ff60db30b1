"""Linear-chain conditional random fields over many sequences at once.

A sequence is a run of rows of one array of emission scores. Sequences are cut into segments of
``_SEGMENT`` elements; the transfer matrices of all segments are multiplied side by side, then the
segments of a sequence are passed one after the other, then the elements inside all segments side
by side again. A very long sequence therefore takes length / 64 short steps, not length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SEGMENT = 64


@dataclass
class _Layout:
    """Segments, the longest first; ``active[t]`` of them have an element t."""

    start: np.ndarray
    size: np.ndarray
    opens: np.ndarray  # the first of its sequence
    follows: np.ndarray  # the segment after it in the sequence, or -1
    turn: list[np.ndarray]  # the segments that are number 0, 1, ... of their sequences
    active: np.ndarray


def _layout(first: np.ndarray) -> _Layout:
    lengths = np.diff(first)
    counts = -(-lengths // _SEGMENT)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    of = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(total) - np.repeat(ends - counts, counts)
    start = first[:-1][of] + number * _SEGMENT
    size = np.minimum(_SEGMENT, lengths[of] - number * _SEGMENT)
    order = np.argsort(-size, kind="stable")
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    last = number == counts[of] - 1
    follows = np.full(total, -1)
    follows[~last] = place[np.flatnonzero(~last) + 1]
    by_number = np.argsort(number, kind="stable")
    cuts = np.searchsorted(number[by_number], np.arange(1, (counts.max() if total else 0)))
    turn = [place[x] for x in np.split(by_number, cuts)] if total else []
    size = size[order]
    active = np.searchsorted(-size, -np.arange(_SEGMENT), "left")
    return _Layout(start[order], size, (number == 0)[order], follows[order], turn, active)


def _scaled(x: np.ndarray, axes) -> np.ndarray:
    return x / x.max(axis=axes, keepdims=True)


def marginals(
    scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """P(state) of each element by forward-backward; with ``pairs``, expected transition counts too.

    ``scores`` (n, states) and ``transitions`` (states, states) are log potentials; sequence i has
    the rows first[i]:first[i + 1].
    """
    n, states = scores.shape
    if not n:
        return np.zeros((0, states)), np.zeros((states, states)) if pairs else None
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    lay = _layout(np.asarray(first))
    segments = len(lay.start)
    whole = np.empty((segments, states, states))
    enter = np.where(lay.opens[:, None, None], np.eye(states), move)
    whole[:] = enter * emit[lay.start][:, None, :]
    for t in range(1, _SEGMENT):
        k = lay.active[t]
        if not k:
            break
        step = (whole[:k].reshape(-1, states) @ move).reshape(k, states, states)
        whole[:k] = _scaled(step * emit[lay.start[:k] + t][:, None, :], (1, 2))

    before = np.ones((segments, states))
    after = np.ones((segments, states))
    for own in lay.turn:
        nxt = lay.follows[own]
        own, nxt = own[nxt >= 0], nxt[nxt >= 0]
        before[nxt] = _scaled(np.einsum("si,sij->sj", before[own], whole[own]), 1)
    for own in reversed(lay.turn):
        nxt = lay.follows[own]
        own, nxt = own[nxt >= 0], nxt[nxt >= 0]
        after[own] = _scaled(np.einsum("sij,sj->si", whole[nxt], after[nxt]), 1)

    ahead = np.empty((n, states))
    now = np.einsum("si,sij->sj", before, enter) * emit[lay.start]
    ahead[lay.start] = now = _scaled(now, 1)
    for t in range(1, _SEGMENT):
        k = lay.active[t]
        if not k:
            break
        at = lay.start[:k] + t
        ahead[at] = now = _scaled((now[:k] @ move) * emit[at], 1)
    behind = np.empty((n, states))
    now = after.copy()
    for t in range(_SEGMENT - 1, -1, -1):
        k = lay.active[t]
        if not k:
            continue
        at = lay.start[:k] + t
        behind[at] = now[:k]
        now[:k] = _scaled((emit[at] * now[:k]) @ move.T, 1)
    both = ahead * behind
    both /= both.sum(axis=1, keepdims=True)
    if not pairs:
        return both, None
    inner = np.ones(n, bool)
    starts = np.asarray(first)[:-1]
    inner[starts[starts < n]] = False
    at = np.flatnonzero(inner)
    joint = ahead[at - 1][:, :, None] * move * (emit[at] * behind[at])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return both, joint.sum(axis=0)


class Adam:
    """The usual step rule, for arrays that are changed in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.turn = arrays, rate, 0
        self.mean = [np.zeros_like(a) for a in arrays]
        self.square = [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.turn += 1
        for a, g, m, s in zip(self.arrays, gradients, self.mean, self.square):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            a -= self.rate * (m / (1 - 0.9**self.turn)) / (np.sqrt(s / (1 - 0.999**self.turn)) + 1e-8)

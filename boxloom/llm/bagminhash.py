"""BagMinHash signatures of many multisets at once.

An element of weight w takes part in the Poisson processes of the weight ranges that
its weight reaches: [0, 1), [1, 2), [2, 4), [4, 8), ..., each with its own random
stream and a rate of its length. A process draws one point and is then split in
halves: the half that a coin gives the point to goes on from it, the other draws a
point of its own after it, and so on down to ranges of length one, which go on
drawing. So the points are the same whatever the weight; those in ranges that it
reaches wholly count, and halves beyond it are dropped. A point that counts takes
the lower of its own and the held time in one random register. A process ends at the first point later than all registers of its
multiset, so most elements of a large multiset are done after one point. Two
multisets agree in a register with the probability of their weighted Jaccard
similarity. A register holds the random state of its winning point, not its time.
"""

from __future__ import annotations

import numpy as np

from .wordhash import mix

REGISTERS = 100


def _uniform(state: np.ndarray) -> np.ndarray:
    return (state >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, count: int, registers: int = REGISTERS) -> np.ndarray:
    """uint64[count, registers] for distinct elements with integer weights >= 1, each
    of the multiset numbered owner. A multiset without elements has only zeros."""
    won = np.zeros(count * registers, np.uint64)
    best = np.full(count * registers, np.inf)
    filled = np.zeros(count, bool)
    filled[owner] = True
    best.reshape(count, registers)[~filled] = 0  # nothing comes

    # (owner, element's state, time, low and high of its range, weight)
    tops = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)  # ranges above the first
    which = np.repeat(np.arange(len(elements)), tops + 1)
    level = np.arange(len(which)) - np.repeat(np.cumsum(tops + 1) - tops - 1, tops + 1)
    low = np.where(level == 0, 0, 2.0 ** (level - 1))
    high = 2.0**level
    state = mix(elements[which] ^ mix(level.astype(np.uint64)))
    own, weight, time = owner[which], weights[which].astype(np.float64), np.zeros(len(which))
    point, counted = state.copy(), np.zeros(len(which), bool)
    fresh = np.ones(len(which), bool)  # has its next point to draw
    while len(own):
        state = np.where(fresh, mix(state), state)
        time = np.where(fresh, time - np.log1p(-_uniform(state)) / (high - low), time)
        point, counted = np.where(fresh, state, point), counted & ~fresh
        live = time <= best.reshape(count, registers).max(axis=1)[own]
        own, state, time, point, counted, low, high, weight = (x[live] for x in (own, state, time, point, counted, low, high, weight))
        now = np.flatnonzero((high <= weight) & ~counted)
        if len(now):
            p, t = point[now], time[now]
            at = own[now] * registers + (mix(p ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(best, at, t)
            wins = best[at] == t
            won[at[wins]] = p[wins]
        counted = counted | (high <= weight)
        unit = high - low == 1
        fresh = np.ones(int(unit.sum()), bool)
        if unit.all():
            continue
        o, s, t, p, c, a, b, w = (x[~unit] for x in (own, state, time, point, counted, low, high, weight))
        middle = (a + b) / 2
        to_left = mix(p ^ mix(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64))) >> np.uint64(63) == 0
        upper = middle < w
        own, time, point, counted, weight = (np.concatenate([x[unit], y, y[upper]]) for x, y in ((own, o), (time, t), (point, p), (counted, c), (weight, w)))
        state = np.concatenate([state[unit], mix(s ^ np.uint64(0x9E6C63D0876A9A63)), mix(s ^ np.uint64(0xD6E8FEB86659FD93))[upper]])
        low, high = np.concatenate([low[unit], a, middle[upper]]), np.concatenate([high[unit], middle, b[upper]])
        fresh = np.concatenate([fresh, ~to_left, to_left[upper]])
    return won.reshape(count, registers)

"""64-bit hashes of the words of many texts at once, over Arrow's string buffers.

Words are runs without the ASCII white space, in lower case. A word's hash is that of
its bytes alone: the difference of two prefix sums of a polynomial modulo 2**64,
divided by the power at its start, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: An odd base with its inverse modulo 2**64, and the constants of splitmix64.
BASE = 0x9E3779B97F4A7C55
INVERSE = pow(BASE, -1, 1 << 64)
GOLDEN, MIX_1, MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes hashed at once; a longer text is hashed in several steps.
STEP = 1 << 20

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _hash_bytes(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words in raw; a word also ends at each of the breaks."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = breaks[(breaks > 0) & (breaks < len(raw))]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def windows(texts: pa.Array, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(raw, ends, cuts): the texts' bytes, the place of the first of each and of the
    end, and windows of about STEP bytes that end with a text or at a gap byte."""
    texts = texts.cast(pa.large_string())
    texts = pa.concat_arrays([texts]) if texts.offset else texts
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    cuts, at = [], int(ends[0])
    while at < ends[-1]:
        to = min(at + STEP, int(ends[-1]))
        if to < ends[-1]:  # back to the start of a text, or else on to a gap
            k = int(np.searchsorted(ends, to, "right")) - 1
            if ends[k] > at:
                to = int(ends[k])
            else:
                stop = int(ends[k + 1])
                while to < stop and not (gaps := np.flatnonzero(gap[raw[to : min(stop, to + STEP)]])).size:
                    to = min(stop, to + STEP)
                to = to + int(gaps[0]) if to < stop else stop
        cuts.append((at, to))
        at = to
    return raw, ends, cuts


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): text k has the words hashes[offsets[k]:offsets[k + 1]], and
    none if it is null."""
    raw, ends, cuts = windows(pc.utf8_lower(texts.cast(pa.large_string())))
    hashes, starts = [], []
    for at, to in cuts:
        own, places = _hash_bytes(raw[at:to], ends[(ends > at) & (ends < to)] - at)
        hashes.append(own)
        starts.append(places + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), ends)


def runs(batch: pa.RecordBatch, column: str = "text", limit: int = STEP):
    """The batch in runs of rows whose texts have about limit bytes together; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, start = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(start, k - start)
            total, start = 0, k
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of word runs, their text's number): every run of width words, or of a
    shorter text's words the only one; none for a text without words."""
    counts = np.diff(offsets)
    made = np.maximum(np.minimum(counts, 1), counts - width + 1)
    text = np.repeat(np.arange(len(counts)), made)
    place = offsets[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made)
    out = np.zeros(len(text), np.uint64)
    for k in range(width):
        have = k < counts[text] if width > 1 else np.ones(len(text), bool)
        at = np.minimum(place + k, max(len(hashes) - 1, 0))
        out = np.where(have, mix(out ^ hashes[at]) if len(hashes) else out, out)
    return out, text

"""Token ids of whole texts by the tokenizers library, each distinct unit encoded once.

Where the tokenizer's ids of a text are those of its pre-tokens one after another, texts
are cut into units (a run of letters, a digit, a run of marks) over Arrow's string
buffers. A unit is known by its very bytes, held in three 64-bit numbers, and its ids are
gathered from a table. The library encodes only units that the table has not, and whole
words in which something else than plain letters, digits and marks occurs.
"""

from __future__ import annotations

import ctypes
import gc
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .wordhash import mix, windows

#: The normalizer and pre-tokenizer under which a unit's ids depend on that unit alone.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: log2 of the table's places; ids that its units have together at most; words remembered besides.
PLACES, MAX_IDS, MAX_WORDS = 19, 1 << 22, 50_000
#: Bytes of a unit that the table can tell apart; longer ones are looked up as words.
UNIT = 24

GAP, LETTER, DIGIT, MARK, ODD = range(5)
_CLASS = np.full(256, ODD, np.uint8)
_CLASS[[0x20, 0x0A]] = GAP
_CLASS[0x30:0x3A] = DIGIT
_CLASS[[c for c in range(0x21, 0x7F) if chr(c) not in "'0123456789"]] = MARK  # an apostrophe may begin a contraction
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Of 8 bytes as one little-endian number, the first k.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Codec:
    """encode(texts): the ids of all texts, without special tokens, and the offset of each text's first.

    They are the ids of the library's encode_batch on whole texts; a null or empty text
    has none. Memory is bounded by the table, MAX_IDS and MAX_WORDS, and a long text is
    done in windows."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = {k: parts[0].get(k) for k in ("type", "pattern", "behavior", "invert")}
        added = spec["added_tokens"]
        self.by_unit = (
            (spec.get("normalizer") or {}).get("normalizers") == NORMALIZER
            and split == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
            and [(p.get("type"), p.get("add_prefix_space")) for p in parts[1:]] == [("ByteLevel", False)]
            and spec["model"].get("end_of_word_suffix") == "</w>"
            and not any(any(c.isspace() for c in t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        )
        self.added = [t["content"].encode() for t in added]
        # for units, which are normalized pre-tokens already: the model behind a cut at blanks
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.last = np.zeros(self.size, bool)
        self.last[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        """Forgets all units and words."""
        self.units = [np.zeros(1 << PLACES, np.uint64) for _ in range(UNIT // 8)]  # no unit has a zero byte
        self.starts, self.lengths = np.zeros(1 << PLACES, np.int32), np.zeros(1 << PLACES, np.int32)
        self.words: dict[tuple[bool, bytes], tuple[int, int]] = {}
        self.ids, self.used = np.zeros(1 << 16, self.dtype), 0

    def _store(self, ids: np.ndarray) -> int:
        """Where ids begin in the table of ids."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(self.ids), 2 * len(ids)), self.dtype)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(starts, lengths) of the stored ids. Each unit is one pre-token, so it ends at the first id that closes a word."""
        lines = [" ".join(units[k : k + 64]) for k in range(0, len(units), 64)]
        ids = np.concatenate([np.array(e.ids, self.dtype) for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(units):
            raise ValueError("this tokenizer does not close each word")
        starts = np.concatenate([[0], ends[:-1]])
        return self._store(ids) + starts, ends - starts

    def _window(self, raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit starts, their ids' starts, their ids' lengths) of bytes that are cut at gaps and at the breaks."""
        if self.used > MAX_IDS or len(self.words) > MAX_WORDS:
            self._clear()
        kind, low = _CLASS[raw], np.zeros(len(raw) + UNIT + 8, np.uint8)
        low[: len(raw)] = _LOWER[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)  # Latin-1 letters, which lower-case one to one and are all composed
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        low[lead + 1] += np.where(raw[lead + 1] < 0x9F, 0x20, 0).astype(np.uint8)
        inside = kind != GAP
        cut = np.zeros(len(raw) + 1, bool)  # a word cannot go on here
        cut[0] = cut[-1] = True
        cut[breaks] = True
        cut[1:] |= ~inside[:len(raw)]
        cut[:-1] |= ~inside
        first = cut[:-1] & inside
        begins = cut[:-1].copy()
        begins[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        begins &= inside
        odd = kind == ODD
        data = raw.tobytes()
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                odd[at] = True
                at = data.find(token, at + 1)
        whole = np.zeros(0, np.int64)
        if odd.any():  # words that the library encodes as they are
            word = np.flatnonzero(first)
            whole = word[np.unique(np.searchsorted(word, np.flatnonzero(odd), "right") - 1)]
            edges = np.flatnonzero(cut)
            stops = edges[np.searchsorted(edges, whole, "right")]
            begins[spans(whole, stops - whole)] = False
            begins[whole] = True
        starts = np.flatnonzero(begins)
        edge = cut.copy()
        edge[:-1] |= begins
        if len(whole):
            edge[spans(whole + 1, stops - whole - 1)] = False
        edges = np.flatnonzero(edge)
        sizes = edges[np.searchsorted(edges, starts, "right")] - starts
        at, many = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        special = sizes > UNIT
        special[np.searchsorted(starts, whole)] = True
        self._plain(low, starts, sizes, np.flatnonzero(~special), at, many)
        if special.any():
            self._special(data, low.tobytes(), starts, sizes, np.flatnonzero(special), set(whole.tolist()), at, many)
        return starts, at, many

    def _plain(self, low: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray, at: np.ndarray, many: np.ndarray) -> None:
        begin, size = starts[which], sizes[which]
        eight = np.ndarray(len(low) - 7, "<u8", low.tobytes(), 0, (1,)).copy()  # the 8 bytes from each place on
        keys = [eight[begin + 8 * k] & _FIRST[np.clip(size - 8 * k, 0, 8)] for k in range(UNIT // 8)]
        state = keys[-1]
        for key in keys[-2::-1]:
            state = key ^ mix(state)
        state = mix(state)
        place = (state >> np.uint64(64 - PLACES)).astype(np.int64)
        known = np.logical_and.reduce([held[place] == key for held, key in zip(self.units, keys)])
        hit, new = np.flatnonzero(known), np.flatnonzero(~known)
        at[which[hit]], many[which[hit]] = self.starts[place[hit]], self.lengths[place[hit]]
        while len(new):
            _, one, back = np.unique(state[new], return_index=True, return_inverse=True)
            one = new[one]
            text = low.tobytes()
            ids, lengths = self._units([text[b : b + n].decode() for b, n in zip(begin[one].tolist(), size[one].tolist())])
            for held, key in zip(self.units, keys):
                held[place[one]] = key[one]
            self.starts[place[one]], self.lengths[place[one]] = ids, lengths
            # the units whose state another one shares wait for the next turn
            same = np.logical_and.reduce([key[new] == key[one][back] for key in keys])
            at[which[new[same]]], many[which[new[same]]] = ids[back[same]], lengths[back[same]]
            new = new[~same]

    def _special(self, data: bytes, low: bytes, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray, whole: set[int], at: np.ndarray, many: np.ndarray) -> None:
        """Words as they stand in the text, by the whole tokenizer, and long units, by its model."""
        own = [(b in whole, (data if b in whole else low)[b : b + n]) for b, n in zip(starts[which].tolist(), sizes[which].tolist())]
        known = self.words
        new = [x for x in dict.fromkeys(own) if x not in known]
        texts = [text.decode() for is_word, text in new if is_word]
        encoded = iter(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)) if texts else None
        for key in new:
            if key[0]:
                ids = np.array(next(encoded).ids, self.dtype)
                known[key] = (self._store(ids), len(ids))
            else:
                begin, length = self._units([key[1].decode()])
                known[key] = (int(begin[0]), int(length[0]))
        at[which], many[which] = np.array([known[x] for x in own]).T

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_unit:
            ids = [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.concatenate([*ids, np.zeros(0, self.dtype)]), np.cumsum([0, *map(len, ids)])
        made, begins, counts = [], [], []
        raw, ends, cuts = windows(texts, _CLASS == GAP)
        for a, b in cuts:
            starts, at, many = self._window(raw[a:b], ends[(ends > a) & (ends < b)] - a)
            made.append(self.ids[spans(at, many)])
            begins.append(starts + a)
            counts.append(many)
        if not made:
            return np.zeros(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        before = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return np.concatenate(made), before[np.searchsorted(np.concatenate(begins), ends)]


    def ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """encode() as 32-bit numbers, with end_id after each text's ids."""
        ids, offsets = self.encode(texts)
        lengths, ends = np.diff(offsets), offsets + np.arange(len(offsets))
        out = np.full(int(ends[-1]), end_id, "<u4")
        out[spans(ends[:-1], lengths)] = ids
        return out, ends


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per worker process and tokenizer."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    made = Codec(path)
    trim()  # reading the vocabulary leaves much behind
    return made


def release() -> None:
    """Frees the units that this worker process remembers: a later operator may reuse it."""
    codec.cache_clear()
    trim()


def trim() -> None:
    """Hands free memory of this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if give:
        give(0)

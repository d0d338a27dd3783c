"""Benchmark decontamination by spaced seeds.

A mask looks at some words of a run and ignores the others, so a seed still hits when
an ignored word was replaced. All seeds of the benchmark make a table (seed, item,
place) and, of that, a bitmap of a fixed size. One pass over the documents keeps the
seeds whose bit is set; a join with the table leaves the true hits, each of which
puts an item at one place of a document. There the item's words are compared one by
one with the document's: the item leaks if, of some WINDOW of its words in a row, or of
all if it has fewer, at least SHARE are equal.

The four masks miss no pattern of two replaced words in a window of 13. An item of fewer
words is cut into one run more than words may be replaced, so that one run is whole:
those runs, of the lengths that occur, are its seeds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .codec import release
from .wordhash import hash_words, mix, runs

#: Fixed values, for windows of 13 words and more. Six words count in each; the spans are 7, 8, 10 and 11 words.
MASKS = ("1111011", "11010111", "1100101101", "10110010011")
WINDOW, SHARE = 13, 0.8
#: log2 of the bitmap's bits: 8 MB whatever the benchmark's size; with very many seeds more pass it, and the join removes them.
BITS = 26
ODD = np.uint64(0xD1342543DE82EF95)


def _seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each word where the mask fits in hashes."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    made = np.full(n, int(mask, 2), np.uint64)
    for k, one in enumerate(mask):
        if one == "1":
            made = made * ODD + hashes[k : k + n]
    return mix(made)


def plan(words: int, masks: tuple[str, ...] = MASKS, window: int = WINDOW, share: float = SHARE) -> list[tuple[str, int | None]]:
    """The masks of an item of so many words, and where each lies in it; None: everywhere."""
    if words >= window:
        return [(mask, None) for mask in masks]
    runs_ = words - math.ceil(share * words) + 1
    cuts = [words * k // runs_ for k in range(runs_ + 1)]
    return [("1" * (b - a), a) for a, b in zip(cuts[:-1], cuts[1:])] if words else []


def seed_table(items: DataFrame, masks: tuple[str, ...] = MASKS, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """A stored table (seed, mask, item_id, place) of items (item_id, text)."""

    def make(batches):
        for batch in batches:
            for run in runs(batch):
                hashes, offsets = hash_words(run.column("text"))
                for item, a, b in zip(run.column("item_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    for mask, at in plan(b - a, masks, window, share):
                        own = hashes[a:b] if at is None else hashes[a + at : a + at + len(mask)]
                        made = _seeds(own, mask).view(np.int64)
                        if len(made):
                            n = len(made)
                            yield pa.RecordBatch.from_pydict({"seed": made, "mask": [mask] * n, "item_id": pa.array([item] * n, pa.int64()), "place": np.arange(n) + (at or 0)})

    rows = items.where("item_id IS NOT NULL").select("item_id", "text")
    return store.table(rows.mapInArrow(make, "seed bigint, mask string, item_id bigint, place bigint").distinct(), "seeds")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    bit = F.call_function("shiftrightunsigned", F.col("seed"), F.lit(64 - BITS))
    word = seeds.select(F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(63).cast("int")).alias("bit"))
    found = word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most 2**(BITS - 6) rows
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


def _hits(docs: DataFrame, seeds: DataFrame, masks: list[str]) -> DataFrame:
    """(doc_id, content, place, seed): the documents' seeds that the bitmap has."""
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds))

    def find(batches):
        release()
        held = bits.value
        for batch in batches:
            for run in runs(batch):
                hashes, offsets = hash_words(run.column("text"))
                texts, places, seeds_ = [], [], []
                for mask in masks:
                    made = _seeds(hashes, mask)
                    slot = made >> np.uint64(64 - BITS)
                    at = np.flatnonzero((held[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1))
                    text = np.searchsorted(offsets, at, "right") - 1
                    fits = at + len(mask) <= offsets[text + 1]
                    at, text = at[fits], text[fits]
                    texts.append(text)
                    places.append(at - offsets[text])
                    seeds_.append(made[at].view(np.int64))
                text = np.concatenate(texts) if texts else np.zeros(0, np.int64)
                if len(text):
                    take = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [run.column("doc_id").cast(pa.int64()).take(take), run.column("content").take(take), pa.array(np.concatenate(places)), pa.array(np.concatenate(seeds_))], names=["doc_id", "content", "place", "seed"]
                    )

    return docs.mapInArrow(find, "doc_id bigint, content bigint, place bigint, seed bigint")


def aligned(window: int = WINDOW, share: float = SHARE):
    """(text, item, shift) to the number of the item's words that the text has at the
    same places, shifted; null if no window of the item has enough of them. A text is
    hashed once for its rows that come together."""

    @F.arrow_udf("bigint")
    def matched(text: pa.Array, item: pa.Array, shift: pa.Array) -> pa.Array:
        out: list[int | None] = []
        for run in runs(pa.RecordBatch.from_arrays([text, item, shift], names=["text", "item", "shift"])):
            texts, items = run.column("text").dictionary_encode(), run.column("item").dictionary_encode()
            (words, starts), (own, begins) = hash_words(texts.dictionary), hash_words(items.dictionary)
            for t, i, s in zip(texts.indices.to_pylist(), items.indices.to_pylist(), run.column("shift").to_pylist()):
                x, y = words[starts[t] : starts[t + 1]], own[begins[i] : begins[i + 1]]
                equal = np.zeros(len(y), np.int64)
                a, b = max(0, -s), min(len(y), len(x) - s)
                if a < b:
                    equal[a:b] = x[a + s : b + s] == y[a:b]
                w = min(window, len(y))
                sums = np.concatenate([[0], np.cumsum(equal)])
                best = int((sums[w:] - sums[:-w]).max()) if w else 0
                out.append(int(sums[-1]) if w and best >= share * w else None)
        return pa.array(out, pa.int64())

    return matched


def leaks(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, content, item_id, place, matched) of each item of items (item_id, text)
    that leaks into a document of docs (doc_id, text): the word where the item would
    begin and how many of its words are there; of several places that with the most,
    then the first. content is xxhash64 of the text.

    Repeated rows leak once; rows with a null id have a null doc_id; items with a null
    id, a null text or no words are not searched; an empty table on either side gives no
    rows. Texts of any length are searched whole, and items of any length found."""
    own = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("content"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    seeds = seed_table(items, masks, window, share)
    hits = _hits(own, seeds, sorted(r.mask for r in seeds.select("mask").distinct().collect()))  # the masks, and runs shorter than the window
    seeds = seeds.drop("mask")
    at = hits.join(store.small(seeds.withColumnRenamed("place", "in_item")), "seed").select("doc_id", "content", "item_id", (F.col("place") - F.col("in_item")).alias("place"))
    spots = store.table(at.distinct(), "spots")
    wanted = store.table(spots.select(F.col("doc_id").alias("__id"), F.col("content").alias("__content")).distinct(), "wanted")
    texts = own.join(store.small(wanted), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("content") == F.col("__content")), "left_semi")
    texts = store.table(texts.dropDuplicates(["doc_id", "content"]), "texts")
    there = spots.withColumnRenamed("doc_id", "__id").withColumnRenamed("content", "__content")
    sides = texts.join(there, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("content") == F.col("__content"))).drop("__id", "__content")
    item_rows = store.table(items.select("item_id", F.col("text").alias("item")).where("item IS NOT NULL"), "items")
    sides = sides.join(store.small(item_rows, 20_000, F.octet_length("item")), "item_id").withColumn("matched", aligned(window, share)("text", "item", "place"))
    found = sides.where("matched IS NOT NULL").groupBy("doc_id", "content", "item_id").agg(F.max(F.struct("matched", (-F.col("place")).alias("back"))).alias("best"))
    return found.select("doc_id", "content", "item_id", (-F.col("best.back")).alias("place"), F.col("best.matched").alias("matched"))


def keep(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """docs without the rows that a benchmark item leaks into, in docs' columns."""
    bad = store.table(leaks(docs, items, **how).select(F.col("doc_id").alias("__id"), F.col("content").alias("__content")).distinct(), "leaking")
    own = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return own.join(store.small(bad), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__content")), "left_anti").select(*docs.columns)

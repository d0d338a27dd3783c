"""Stupid-backoff scores of documents under the counts of the whole corpus.

Documents are dealt by hash to blocks. A block hashes its words once; from then on it is
the numbers of its words and the table of their hashes, about as large as its texts are
compressed. For each order n a block explodes its words into n-grams and counts them: rows (gram, block, n), one for each block that has the gram,
however often, so that no gram is hot. The rows are partitioned by the gram's hash; there
they are sorted by the gram and summed to the count table, which is joined to the same rows
on the gram. The counts go back to their blocks in the order of the grams, which a block
knows, so that no gram goes back. With all counts, a block scores its documents' words and
sums them for each document.

An n-gram can be in another document only if the two (n-1)-grams in it are. So of each
order only those are asked for whose parts have been found elsewhere; it leaves out none
that another document has.

A document's own n-grams are taken out of the counts that score it, since they
would vouch for it: the score tells how well the rest of the corpus predicts it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .codec import trim
from .wordhash import hash_words, mix

ORDER = 3
BACKOFF = 0.4
BLOCK_DOCS = 4096
#: Bytes of text of a block on average at most.
BLOCK_BYTES = 8 << 20
#: Blocks whose rows a partition of the count table takes on average at most.
BLOCKS_A_PART = 4
#: A partition of the count table takes some of 2 ** SLOT_BITS ranges of the hash, or of more if there are many partitions.
SLOT_BITS = 12
ODD = np.uint64(0xD1342543DE82EF95)

#: Rows of grams; own is the block and, in the lower half, the count there: two columns cost less than three on their way.
ASKED = "gram bigint, own bigint"
ANSWERS = "block int, gram_order int, bits int, slots binary, size bigint, totals binary"
SUMS = "doc_id bigint, n_words bigint, n_unigrams bigint, logs double"


def gram_places(offsets: np.ndarray, n: int) -> np.ndarray:
    """The places of the last words of all n-grams. No n-gram spans two texts."""
    whole = np.ones(offsets[-1], bool)
    for k in range(n - 1):
        whole[np.minimum(offsets[:-1] + k, offsets[1:])[offsets[:-1] + k < offsets[1:]]] = False
    return np.flatnonzero(whole)


def gram_hashes(hashes: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """The hashes of the n-grams whose last words are at the places."""
    key = hashes[places - (n - 1)] + np.uint64(n * int(ODD) % (1 << 64))
    for k in range(n - 2, -1, -1):
        key *= ODD
        key += hashes[places - k]
    return mix(key).view(np.int64)


#: Places out of order that are put right one by one.
FEW = 1000


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, key[order]): the places by their key, and of one key as they are. Sorts
    numbers of the key's upper bits and the place, which costs less than places by the key."""
    low = (1 << max(len(key) - 1, 1).bit_length()) - 1
    order = np.sort((key & ~low) | np.arange(len(key)))
    order &= low
    got = key[order]
    wrong = np.flatnonzero(got[1:] < got[:-1])
    if len(wrong) > FEW:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    if len(wrong):  # keys that agree in the upper bits
        top = got & ~low
        for at in np.unique(top[wrong]):
            a, b = np.searchsorted(top, at), np.searchsorted(top, at, "right")
            own = a + np.argsort(got[a:b], kind="stable")
            order[a:b], got[a:b] = order[own], got[own]
    return order, got


def in_document(number: np.ndarray, owner: np.ndarray, counts: np.ndarray, sort: bool = True) -> np.ndarray:
    """Of grams numbered below 2 ** 32, of each place how often its document has its gram;
    owner ascends, counts has how often each gram is there. Without sort the number
    ascends, and owner among the places of one."""
    mine = np.ones(len(number), np.int64)
    several = np.flatnonzero(counts[number] > 1)
    if len(several):
        number, owner = number[several], owner[several]
        if sort:  # a gram's places stay in the order of their documents
            bits = len(several).bit_length()
            order = np.sort((number.astype(np.int64) << bits) | np.arange(len(several))) & ((1 << bits) - 1)
            number, owner, several = number[order], owner[order], several[order]
        first = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (owner[1:] != owner[:-1])]))
        sizes = np.diff(np.append(first, len(number)))
        mine[several] = np.repeat(sizes, sizes)
    return mine


#: A row for each block: of its documents the ids and the numbers of words, and its words (see _pack).
BLOCKS = "block int, ids array<bigint>, sizes binary, words binary, size bigint, numbers binary"


def _pack(key: tuple[pa.Scalar, ...], texts: pa.Table) -> pa.Table:
    """The block of texts: the hashes of its words, the most frequent first, and at each place
    which it is, as four planes of bytes, the lowest first, compressed."""
    hashes, offsets = hash_words(texts.column("text").cast(pa.large_string()).combine_chunks())
    order, ranks = ranked(hashes.view(np.int64))
    first = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]])) if len(ranks) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(ranks)))
    frequent = np.argsort(-counts, kind="stable")
    place = np.empty(len(first), np.uint32)
    place[frequent] = np.arange(len(first))
    numbers = np.empty(len(hashes), np.uint32)
    numbers[order] = np.repeat(place, counts)
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T).tobytes()
    row = {"block": [key[0].as_py()], "ids": [texts.column("doc_id").to_pylist()], "sizes": [np.diff(offsets).astype(np.int64).tobytes()], "words": [ranks[first][frequent].tobytes()], "size": [len(planes)], "numbers": [pa.Codec("zstd", 1).compress(planes, asbytes=True)]}
    del hashes, order, ranks, numbers, planes
    trim()
    return pa.table(row, pa.schema([("block", pa.int32()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("words", pa.binary()), ("size", pa.int64()), ("numbers", pa.binary())]))


class Block:
    """The words of a block, a row (BLOCKS), and the answers (ANSWERS) that it got."""

    def __init__(self, row: dict, answers: pa.Table | None):
        self.ids, sizes = row["ids"], np.frombuffer(row["sizes"], np.int64)
        planes = np.frombuffer(pa.Codec("zstd").decompress(row["numbers"], row["size"], asbytes=True), np.uint8).reshape(4, -1)
        self.numbers = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.hashes, self.offsets = self.words[self.numbers], np.concatenate([[0], np.cumsum(sizes)])
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.answers = answers.to_pylist() if answers is not None else []

    def single(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, grams, counts): the words as grams of order 1, ascending, and which word each is."""
        order, grams = ranked(gram_hashes(self.words, np.arange(len(self.words)), 1))
        return order, grams, np.bincount(self.numbers, minlength=len(self.words))[order]

    def count(self, n: int, shorter: np.ndarray) -> tuple[np.ndarray, ...]:
        """(all places of n-grams, places in the order of their grams, grams, their counts)
        of order 2 or more, only of those whose parts have outside counts, of order n - 1."""
        every = gram_places(self.offsets, n)
        known = shorter > 0
        places = every[known[every] & known[every - 1]]
        order, key = ranked(gram_hashes(self.hashes, places, n))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return every, places[order], key[first], np.diff(np.append(first, len(key)))

    def total(self, n: int, grams: np.ndarray) -> np.ndarray:
        """The counts of all grams that were asked for in order n, from the answers of each partition."""
        totals, zstd = np.zeros(len(grams), np.int64), pa.Codec("zstd")
        for row in self.answers:
            if row["gram_order"] == n:
                slots = np.frombuffer(row["slots"], np.int32).astype(np.int64)
                shift = 64 - row["bits"]
                starts = np.searchsorted(grams, slots << shift)
                sizes = np.searchsorted(grams, (slots << shift) + ((1 << shift) - 1), "right") - starts
                got = np.frombuffer(zstd.decompress(row["totals"], row["size"], asbytes=True), np.int64 if row["size"] == 8 * sizes.sum() else np.int32)
                totals[np.arange(len(got)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)] = got
        return totals

    def outside(self, n: int, shorter: np.ndarray | None = None) -> np.ndarray:
        """At each word, how often the n-gram that ends there occurs outside its document; -1 where none ends."""
        if n == 1:
            order, grams, own = self.single()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            number = place[self.numbers]
            return self.total(n, grams)[number] - in_document(number, self.owner, own)
        every, places, grams, own = self.count(n, shorter)
        number, totals = np.repeat(np.arange(len(grams)), own), self.total(n, grams)
        rest = np.full(len(self.hashes), -1, np.int64)
        rest[every] = 0
        rest[places] = totals[number] - in_document(number, self.owner[places], own, sort=False)
        return rest

    def logs(self, order: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
        """At each word the log10 of its score, without the division of those scored as
        single words by the number of words, and whether it is one of them."""
        shorter = self.outside(1)
        # a word that the rest of the corpus lacks counts as one half
        logs = np.log10(np.maximum(shorter, 0.5))
        single, penalty = np.ones(len(self.hashes), bool), np.zeros(len(self.hashes))
        for n in range(2, order + 1):
            rest = self.outside(n, shorter)
            context = np.concatenate([[1], shorter[:-1]]) if len(shorter) else shorter
            seen = (rest > 0) & (context > 0)
            penalty = np.where(seen, 0, penalty + np.where(rest >= 0, np.log10(backoff), 0))
            logs = np.where(seen, np.log10(np.maximum(rest, 1)) - np.log10(np.maximum(context, 1)), logs)
            single &= ~seen
            shorter = rest
        return logs + penalty, single


def _first(batches):
    """The rows of blocks for order 1."""
    for batch in batches:
        for row in batch.to_pylist():
            _, grams, counts = Block(row, None).single()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (grams, counts + (row["block"] << 32))], names=["gram", "own"])


def _ask(n: int):
    """The rows of a block for order n, with the answers to all orders before."""
    def ask(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        grams = counts = np.zeros(0, np.int64)
        if rows.num_rows:
            block = Block(rows.to_pylist()[0], answers)
            shorter = None
            for k in range(1, n):
                shorter = block.outside(k, shorter)
            *_, grams, counts = block.count(n, shorter)
            del block
            trim()
        return pa.table([pa.array(c, pa.int64()) for c in (grams, counts + (key[0].as_py() << 32))], names=["gram", "own"])

    return ask


def _score(order: int, backoff: float):
    names = [x.split()[0] for x in SUMS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())

    def score(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        block = Block(rows.to_pylist()[0], answers)
        logs, single = block.logs(order, backoff)
        ids, n = pa.array(block.ids, kinds[0]), len(block.ids)
        sums = (np.diff(block.offsets), np.bincount(block.owner, single, n), np.bincount(block.owner, logs, n))
        del block
        trim()
        return pa.table([ids, *(pa.array(np.asarray(x), pa.float64()).cast(k) for x, k in zip(sums, kinds[1:]))], names=names)

    return score


def _count(n: int, bits: int):
    """The answers to all rows of a partition: the sum of each gram, in the order of (block, gram)."""
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary())

    def count(batches):
        parts = [[batch.column(c).to_numpy() for c in ("gram", "own")] for batch in batches if batch.num_rows]
        if not parts:
            return
        gram, own = (np.concatenate(c) for c in zip(*parts))
        block, counts = (own >> 32).astype(np.int32), own & ((1 << 32) - 1)
        del parts, own
        order, grams = ranked(gram)
        new = np.concatenate([[True], grams[1:] != grams[:-1]])
        sums = np.add.reduceat(counts[order], np.flatnonzero(new), dtype=np.int64)
        totals = np.empty(len(gram), np.int64)
        totals[order] = sums[np.cumsum(new) - 1]
        del grams, new, sums, counts
        # by gram, and then stable by block, of few by two bytes of it
        order = order[np.argsort((block.astype(np.uint16) if block.max() < 1 << 16 else block)[order], kind="stable")]
        gram, block, totals = gram[order], block[order], totals[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        zstd, rows = pa.Codec("zstd", 3), []
        for a, b in zip(first, [*first[1:], len(block)]):
            slot = gram[a:b] >> (64 - bits)
            slots = slot[np.concatenate([[True], slot[1:] != slot[:-1]])].astype(np.int32)
            raw = totals[a:b].astype(np.int32 if totals[a:b].max() < 1 << 31 else np.int64).tobytes()
            rows.append((int(block[a]), n, bits, slots.tobytes(), len(raw), zstd.compress(raw, asbytes=True)))
        del gram, block, totals
        trim()
        for k in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows[k : k + 64]), kinds)], names=[c.split()[0] for c in ANSWERS.split(", ")])

    return count


def _answers(asked: DataFrame, n: int, parts: int) -> DataFrame:
    """The counts (ANSWERS) of all rows asked for in order n. All rows of a range of the
    hash are in one partition, so an answer has the counts of whole ranges of a block's grams."""
    bits = max(SLOT_BITS, (16 * parts - 1).bit_length())
    return asked.repartition(parts, F.shiftright("gram", 64 - bits)).mapInArrow(_count(n, bits), ANSWERS)


def scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_unigrams (the words scored
    without context) and score, the mean log10 of the words' stupid-backoff scores.

    Words are lower-case runs without white space. A text without words has a null
    score. Rows are documents: a repeated row counts for the other. Null ids stay null.
    Blocks take at most block_docs rows and BLOCK_BYTES on average, dealt by id and text;
    a longer text makes its block that much larger."""
    spark = docs.sparkSession
    sizes = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-sizes.n // block_docs), -(-(sizes.bytes or 0) // BLOCK_BYTES))
    parts = min(blocks, max(2 * store.partitions(spark), -(-blocks // BLOCKS_A_PART)))
    block = F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(blocks)).cast("int").alias("block")
    dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), block)
    packed = store.table(dealt.repartition(parts, "block").groupBy("block").applyInArrow(_pack, BLOCKS), "blocks")
    found = [store.table(_answers(packed.mapInArrow(_first, ASKED), 1, parts), "answers")]
    dealt = packed.repartition(parts, "block").groupBy("block")
    for n in range(2, order + 1):
        asked = dealt.cogroup(reduce(DataFrame.unionByName, found).groupBy("block")).applyInArrow(_ask(n), ASKED)
        found.append(store.table(_answers(asked, n, parts), "answers"))
    answers = reduce(DataFrame.unionByName, found)
    sums = store.table(dealt.cogroup(answers.groupBy("block")).applyInArrow(_score(order, backoff), SUMS), "sums")
    total = sums.agg(F.sum("n_words")).first()[0] or 0
    mean = (F.col("logs") - F.col("n_unigrams") * F.log10(F.greatest(F.lit(total) - F.col("n_words"), F.lit(1)))) / F.col("n_words")
    return sums.select("doc_id", "n_words", "n_unigrams", F.when(F.col("n_words") > 0, mean).alias("score"))

"""Near-duplicate classes: BagMinHash signatures, banded, then verified.

1. One pass makes of each text a key (of its words, in order), a signature of the
   multiset of its five-word shingles, and band hashes. Texts with equal keys are
   copies; each key is one node, represented by its least doc_id from here on.
2. A band hash is a bucket. Each bucket elects two centres, one at random and one that
   has the most company over all its buckets, such as the original of many copies. Both
   ranks are a member's own, so buckets of like members elect the same. Each member is a candidate pair with them: as many pairs as members, whatever the
   bucket's size. Pairs whose signatures agree enough are verified on the texts, and
   the classes so far are the connected components of the links.
3. In buckets that still hold several classes, the members outside the largest class
   (visitors) meet all members (residents) in cells of bounded rows and bytes. A first
   pass over the cells keeps those whose signatures agree enough with one of another
   class. To these alone come their texts, and a second pass verifies each visitor with
   each resident of another class. A link joins the two classes within the cell, so a
   cell gives fewer links than it has members, never its pairs.
4. Classes are the connected components of all links, found by distributed rounds of
   least labels with pointer jumping; a class is named by its least doc_id.

Two texts whose multisets of shingles overlap by SIMILARITY or more are linked. With 20
bands of 5 rows a pair of similarity 0.8 shares no bucket with a probability of 0.0004,
of 0.9 with 1e-8; nothing else that depends on chance or size leaves a pair out, apart
from LIKELY.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .bagminhash import signatures
from .codec import release, spans
from .wordhash import hash_words, mix, runs, shingles

SIMILARITY = 0.8
WIDTH = 5
BANDS, ROWS = 20, 5
#: Of a signature's registers, the share that must agree for a pair to be verified: five standard deviations below SIMILARITY.
LIKELY = 0.6
#: Rows and bytes of text on either side of a cell, on average at most.
BLOCK, BLOCK_BYTES = 512, 16 << 20
#: A key of more rows than this, and than one in HOT_SHARE of all, is joined by broadcast: there are at most HOT_SHARE of them.
HOT_ROWS, HOT_SHARE = 1024, 50_000

SIGNED = "doc_id bigint, content bigint, size bigint, key binary, bands array<bigint>, low binary"


def _multisets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, its weight, its text's number), sorted by text and shingle."""
    hashes, offsets = hash_words(texts)
    made, owner = shingles(hashes, offsets, width)
    order = np.lexsort((made, owner))
    made, owner = made[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])])) if len(made) else np.zeros(0, np.int64)
    return made[first], np.diff(np.concatenate([first, [len(made)]])), owner[first]


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, offsets): of each text the set of its (shingle, how many-th) as small
    numbers. Two of these sets overlap as the multisets of shingles do."""
    shingle, weight, owner = _multisets(texts, width)
    nth = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
    element = mix(np.repeat(shingle, weight) ^ mix(nth.astype(np.uint64)))
    _, number = np.unique(element, return_inverse=True)
    return number, np.searchsorted(np.repeat(owner, weight), np.arange(len(texts) + 1))


def _jaccards(elements: np.ndarray, offsets: np.ndarray, flags: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """The overlap of set `one` with each of the others. flags: all false, and again at the end."""
    own = elements[offsets[one] : offsets[one + 1]]
    lengths = offsets[others + 1] - offsets[others]
    flags[own] = True
    hits = np.concatenate([[0], np.cumsum(flags[elements[spans(offsets[others], lengths)]])])
    flags[own] = False
    ends = np.cumsum(lengths)
    common = hits[ends] - hits[ends - lengths]
    return common / np.maximum(len(own) + lengths - common, 1)


def _sign(bands: int, rows: int, width: int):
    def sign(batches):
        release()
        for batch in batches:
            for run in runs(batch):
                texts = run.column("text")
                hashes, offsets = hash_words(texts)
                keys = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                regs = signatures(*_multisets(texts, width), run.num_rows, bands * rows)
                grouped = regs.reshape(run.num_rows, bands, rows)
                made = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64)), (run.num_rows, bands))
                for k in range(rows):
                    made = mix(made ^ grouped[:, :, k])
                low = regs.astype(np.uint16)
                flat = pa.array(made.reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, bands), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id").cast(pa.int64()), run.column("content"), run.column("size"), pa.array(keys, pa.binary()), lists, pa.array([x.tobytes() for x in low], pa.binary())],
                    names=[c.split()[0] for c in SIGNED.split(", ")],
                )

        release()

    return sign


LINK = "a bigint, b bigint"


def _links(batch: pa.RecordBatch, kept: np.ndarray) -> pa.RecordBatch:
    return batch.select(["a", "b"]).filter(pa.array(kept))


def _agree(registers: int):
    """Of pairs (a, b) with their signatures (x, y), those with enough equal registers."""
    def likely(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, registers) for k in ("x", "y"))
            yield _links(batch, (x == y).mean(axis=1) >= LIKELY)

    return likely


def _overlaps(a: pa.Array, b: pa.Array, width: int) -> np.ndarray:
    out, at = np.zeros(len(a)), 0
    for run in runs(pa.RecordBatch.from_arrays([a, b], names=["text", "other"])):
        n = run.num_rows
        coded = pa.concat_arrays([run.column("text"), run.column("other")]).dictionary_encode()  # a text is hashed once
        elements, offsets = _sets(coded.dictionary, width)
        x, y = np.split(coded.indices.to_numpy(zero_copy_only=False), 2)
        flags = np.zeros(int(elements.max(initial=-1)) + 1, bool)
        order = np.argsort(x, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
            out[at + some] = _jaccards(elements, offsets, flags, x[some[0]], y[some])
        at += n
    return out


def overlap(width: int = WIDTH):
    """Multiset Jaccard similarity of the shingles of two texts, as a column function.
    Two texts without words overlap by 0."""
    @F.arrow_udf("double")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(_overlaps(a, b, width))

    return similar


def _verify(similarity: float, width: int):
    """Of pairs (a, b) with their texts (x, y), those whose texts overlap enough."""
    def verified(batches):
        for batch in batches:
            yield _links(batch, _overlaps(batch.column("x"), batch.column("y"), width) >= similarity)

    return verified


# Cells of a bucket that holds several classes

CELL = ["bucket", "home", "room"]
FLAGGED = "bucket bigint, home int, room int, node bigint, own bigint, visits boolean"


def _flag(registers: int):
    """Of a cell, its members whose signatures agree enough with one of another class on the other side."""
    def flag(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy()
        low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint16).reshape(-1, registers)
        visits = table.column("visits").to_numpy(zero_copy_only=False).astype(bool)
        v, h = np.flatnonzero(visits), np.flatnonzero(~visits)
        resident, hit = np.ascontiguousarray(low[h].T), np.zeros(len(own), bool)
        for at in range(0, len(v), 256):
            some = v[at : at + 256]
            agree = np.zeros((len(some), len(h)), np.uint16)
            for k in range(registers):
                agree += low[some, k][:, None] == resident[k][None, :]
            likely = (agree >= LIKELY * registers) & (own[some][:, None] != own[h][None, :])
            hit[some] = likely.any(axis=1)
            hit[h] |= likely.any(axis=0)
        return table.select([*CELL, "node", "own", "visits"]).filter(pa.array(hit))

    return flag


def _join(similarity: float, width: int):
    """Of a cell, links (a, b) that join the classes of its visitors and residents as all verified pairs would."""
    def join(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node, own = table.column("node").to_numpy(), table.column("own").to_numpy().copy()
        visits = table.column("visits").to_numpy(zero_copy_only=False).astype(bool)
        coded = table.column("text").combine_chunks().dictionary_encode()  # a member may be on both sides
        (elements, offsets), place = _sets(coded.dictionary, width), coded.indices.to_numpy(zero_copy_only=False)
        flags, lengths = np.zeros(int(elements.max(initial=-1)) + 1, bool), np.diff(offsets)[place]
        residents, made = np.flatnonzero(~visits), []
        for v in np.flatnonzero(visits).tolist():
            few, many = np.minimum(lengths[residents], lengths[v]), np.maximum(lengths[residents], lengths[v])
            some = residents[(own[residents] != own[v]) & (few >= similarity * many)]
            if not len(some):
                continue
            some = some[_jaccards(elements, offsets, flags, place[v], place[some]) >= similarity]
            classes, first = np.unique(own[some], return_index=True)
            made += [(node[v], node[h]) for h in some[first]]
            own[np.isin(own, classes)] = own[v]
        a, b = (np.array(x, np.int64) for x in zip(*made)) if made else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return join


def _across(docs: DataFrame, nodes: DataFrame, members: DataFrame, held: int, named: DataFrame, linked: int, registers: int, similarity: float, width: int, block: int) -> DataFrame | None:
    """The links between classes within buckets, found in cells; None if each bucket's members are of one class."""
    own = members.join(store.small(named, rows=linked), "node", "left").select("node", "bucket", "size", F.coalesce("class", "node").alias("own"))
    own, _ = store.handed(own, "own")
    classes_ = own.groupBy("bucket", "own").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    mixed = classes_.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "own", "bytes")).alias("m"), F.count("*").alias("k")).where("k > 1")
    parts = lambda n, size: F.ceil(F.greatest(n / block, size / BLOCK_BYTES)).cast("int")
    mixed = mixed.select("bucket", F.col("m.own").alias("main"), parts(F.col("n"), F.col("bytes")).alias("homes"), parts(F.col("n") - F.col("m.n"), F.col("bytes") - F.col("m.bytes")).alias("rooms"))
    mixed, several = store.handed(store.fitted(mixed, held), "mixed")
    if not several["n"]:
        return None
    rows = own.join(store.small(mixed, rows=several["n"]), "bucket").withColumn("apart", F.col("own") != F.col("main"))
    rows, _ = store.handed(rows.select("node", "bucket", "own", "apart", "homes", "rooms"), "sides")
    rows = rows.join(nodes.select("node", "low"), "node")
    place = lambda seed, n: F.pmod(F.xxhash64("node", "bucket", F.lit(seed)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = ("node", "own", "low", "bucket")
    at_home = rows.select(*names, F.lit(False).alias("visits"), place(1, "homes").alias("home"), each("rooms").alias("room"))
    visitors = rows.where("apart").select(*names, F.lit(True).alias("visits"), place(2, "rooms").alias("room"), each("homes").alias("home"))
    flagged = at_home.unionByName(visitors).groupBy(CELL).applyInArrow(_flag(registers), FLAGGED)
    flagged, likely = store.counted(flagged, "flagged")
    if not likely["n"]:
        return None
    texts, _ = _texts(docs, nodes, flagged.select("node").distinct(), likely["n"])
    cells = flagged.join(texts, "node").groupBy(CELL).applyInArrow(_join(similarity, width), LINK)
    return store.table(cells, "across")


# Links and classes


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, most: int) -> tuple[DataFrame, int]:
    """A stored table (node, text) of the wanted nodes, at most so many. Only their texts move."""
    wanted = nodes.select("node", F.col("rep").alias("__rep"), F.col("content").alias("__content")).join(store.small(wanted, rows=most), "node")
    wanted, known = store.handed(store.fitted(wanted, most), "wanted")
    rows = docs.select(F.col("doc_id").alias("rep"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("content", F.xxhash64("text"))
    texts = rows.join(store.small(wanted, rows=known["n"]), (F.col("rep") == F.col("__rep")) & (F.col("content") == F.col("__content")))
    # one of the rows that repeat an id and its text
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    return store.handed(texts, "texts")[0], known["n"]


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, count: int, similarity: float, width: int) -> tuple[DataFrame, dict[str, int]]:
    """A stored table of those of pairs (a, b) whose texts overlap enough, and its rows."""
    texts, _ = _texts(docs, nodes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), 2 * count)
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return store.handed(sides.select("a", "b", "x", "y"), "stars", _verify(similarity, width), LINK)


def components(links: DataFrame, count: int) -> tuple[DataFrame, int]:
    """links (a, b), so many, to a stored table (node, class), and its rows: the least
    node of its connected component.

    Each round gives a node the least label of its own, its neighbours' and its label's
    label; rounds end when none changes. All state is in written tables."""
    both, _ = store.handed(store.fitted(links.select("a", "b").union(links.select("b", "a")).distinct(), 2 * count), "links")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node")
    labels, known = store.handed(store.fitted(labels, count), "labels")
    none = F.lit(None).cast("bigint")
    while True:
        small = lambda names: store.small(labels.toDF(*names), rows=known["n"])
        own = labels.select("node", "label", F.col("label").alias("was"))
        near = both.join(small(("b", "label")), "b").select(F.col("a").alias("node"), "label", none.alias("was"))
        jump = labels.join(small(("at", "jump")), F.col("label") == F.col("at")).select("node", F.col("jump").alias("label"), none.alias("was"))
        lower = own.unionByName(near).unionByName(jump).groupBy("node").agg(F.min("label").alias("label"), F.max("was").alias("was"))
        lower, moved = store.handed(store.fitted(lower, count), "labels", changed=F.count_if(F.col("label") < F.col("was")))
        labels = lower.select("node", "label")
        if not moved["changed"]:
            return labels.withColumnRenamed("label", "class"), known["n"]


def _stars(nodes: DataFrame, members: DataFrame, held: int, registers: int) -> tuple[DataFrame, int]:
    """Pairs (a, b) of the members of each bucket with its two centres, whose signatures agree enough."""
    company, several = store.handed(store.fitted(members.groupBy("node").agg(F.sum("n").alias("company")), held), "company")
    ranked = members.join(store.small(company, rows=several["n"]), "node")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("company", "node")).alias("hub"), F.min(F.struct(F.xxhash64("node"), "node")).alias("any"))
    centres, elected = store.handed(store.fitted(centres.select("bucket", F.array("hub.node", "any.node").alias("centres")), held), "centres")
    met = members.join(store.small(centres, rows=elected["n"]), "bucket").select("node", F.explode("centres").alias("centre")).where("node != centre")
    pairs = met.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    pairs, found = store.handed(store.fitted(pairs, 2 * held), "pairs")
    side = lambda k, v: nodes.select(F.col("node").alias(k), F.col("low").alias(v))
    sides = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
    likely, left = store.handed(sides, "likely", _agree(registers), LINK)
    return likely, left["n"]


def classes(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, content (xxhash64 of the text), class_id
    and copy_of, the least doc_id with the same words in the same order.

    A text without words is a class of its own, also among others like it, and so is a
    row with a null id (class_id null); a text of under five words has one shingle.
    Rows that repeat an id are in the classes of their texts, also where these differ.
    A text of any length is signed and verified whole."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", F.xxhash64(text).alias("content"), F.octet_length(text).cast("bigint").alias("size"), text.alias("text"))
    signed, total = store.handed(read, "signed", _sign(bands, rows, width), SIGNED)
    alone = F.col("key").isNull() | F.col("doc_id").isNull()
    # bands and registers are the same in all copies, so that copies meet before the shuffle
    keyed = signed.where(~alone).groupBy("key").agg(F.min(F.struct("doc_id", "content")).alias("r"), F.count("*").alias("n"), F.max("size").alias("size"), F.first("bands").alias("bands"), F.first("low").alias("low"))
    keyed = keyed.select(F.monotonically_increasing_id().alias("node"), "key", F.col("r.doc_id").alias("rep"), F.col("r.content").alias("content"), "n", "size", "bands", "low")
    nodes, texts = store.handed(keyed, "nodes")

    named = _named(docs, nodes, texts["n"], bands, rows, similarity, width, block)
    named = named.select(F.col("key").alias("__key"), F.col("rep").alias("copy_of"), "class_id", "n")
    out = signed.where(~alone).select("doc_id", "content", "key")
    single = signed.where(alone).select("doc_id", "content", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"))
    final, same = ("doc_id", "content", "class_id", "copy_of"), F.col("key") == F.col("__key")
    if texts["n"] <= store.BROADCAST_ROWS:
        return out.join(F.broadcast(named), same).select(*final).unionByName(single)
    # copies that are many do not meet in one task
    hot = F.broadcast(named.where(F.col("n") > max(HOT_ROWS, total["n"] // HOT_SHARE)))
    rest = out.join(hot.select("__key"), same, "left_anti").join(named, same)
    return out.join(hot, same).select(*final).unionByName(rest.select(*final)).unionByName(single)


def _named(docs: DataFrame, nodes: DataFrame, count: int, bands: int, rows: int, similarity: float, width: int, block: int) -> DataFrame:
    """nodes with their class_id."""
    members = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    sizes, shared = store.handed(store.fitted(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), count * bands), "buckets")
    alone = nodes.withColumn("class_id", F.col("rep"))
    if not shared["n"]:
        return alone
    members, held = store.handed(store.fitted(members.join(store.small(sizes, rows=shared["n"]), "bucket"), count * bands), "members")
    likely, pairs = _stars(nodes, members, held["n"], bands * rows)
    stars, found = _verified(docs, nodes, likely, pairs, similarity, width) if pairs else (likely, {"n": 0})
    named, linked = components(stars, found["n"])
    across = _across(docs, nodes, members, held["n"], named, linked, bands * rows, similarity, width, block)
    if across is not None:
        both, found = store.handed(across.union(named.where("node != class").toDF("a", "b")).distinct(), "both")
        named, linked = components(both, found["n"])
    least = nodes.select("node", "rep").join(store.small(named, rows=linked), "node").groupBy("class").agg(F.min("rep").alias("class_id"))
    least, several = store.handed(store.fitted(least, linked), "least")
    named = named.join(store.small(least, rows=several["n"]), "class").select(F.col("node").alias("__node"), "class_id")
    named, linked = store.handed(store.fitted(named, linked), "named")
    return nodes.join(store.small(named, rows=linked["n"]), F.col("node") == F.col("__node"), "left").withColumn("class_id", F.coalesce("class_id", "rep")).drop("__node")


def _same() -> Column:
    return (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__content"))


def keep(docs: DataFrame, **how) -> DataFrame:
    """docs with one document of each class, its least doc_id, in docs' columns; of rows
    that repeat that id with the same text, one. Rows with a null id stay."""
    found, _ = store.handed(classes(docs, **how).where("doc_id != class_id").select(F.col("doc_id").alias("__id"), F.col("content").alias("__content")).distinct(), "dropped")
    content = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    left = docs.withColumn("__own", content).join(store.small(found), _same(), "left_anti")
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id", content.alias("__content")).count().where("count > 1").select(F.col("doc_id").alias("__id"), "__content")
    again, several = store.handed(again, "again")
    if not several["n"]:
        return left.select(*docs.columns)
    again = store.small(again, rows=several["n"])
    single = left.join(again, _same(), "left_semi").dropDuplicates(["doc_id", "__own"])
    return left.join(again, _same(), "left_anti").unionByName(single).select(*docs.columns)

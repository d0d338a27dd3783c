"""Each operator on small tables: its rule by brute force, and nulls, empty and long
texts, repeated rows, empty tables and extra columns."""

import hashlib
import math
import os
import random
import re
import shutil
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.llm import bagminhash, decontaminate, lm, neardup, packing, quality, queries, shards, store, tokenfiles, toxicity, urls, warc, wordhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, key string, uid int"


def docs(spark, texts, ids=None, source="s"):
    """Rows with column names that operators use for their own."""
    return spark.createDataFrame([(k if ids is None else ids[k], t, "en", source, None, "x", "y", "z", 1) for k, t in enumerate(texts)], DOCS)


def words(n, seed=0, start=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) + str(start) for _ in range(n))


def encoded(text):
    from tokenizers import Tokenizer

    return np.array([*Tokenizer.from_file(tokenfiles.default_path()).encode(text or "", add_special_tokens=False).ids, 1], "<u4")


ODD = ["It's 3 o'clock.\tÀ é ñ ß İ 你好 áb <|endoftext|> x!!", None, "", " \n ", "Word, word; WORD... x&&&y", "naïve space\r\nnext", "long " * 9000]


# WARC


def test_warc_round_trip_by_ranges(spark):
    big = ("é<p>" * 600, "ab" * 700)
    rows = [(1, "http://a/", big[0]), (2, None, big[0]), (3, "http://b\r\nc", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (7, "u", big[1]), (7, "u", big[1]), (3, "v", big[1]), (None, "w", big[0])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    for split in (50, 64 << 20):
        got = Counter(tuple(r) for r in warc.round_trip(pages, split).collect())
        want = Counter()
        for page, _, html in rows:
            raw = (html or "").encode()
            ref = {big[0]: 2, big[1]: 7}.get(html)
            ref = None if ref == page else ref
            want[(page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if ref is None else "revisit", ref)] += 1
        assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [0, 200_000])
def test_warc_keeps_records_with_long_headers(spark, monkeypatch, limit):
    monkeypatch.setattr(store, "BROADCAST_ROWS", limit)
    long = "http://a/" + "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz0123456789", k=150_000))
    rows = [(1, long, "one" * 500), (2, "u", "two"), (3, long + "x", "one" * 500), (4, None, "é" * 400_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    folder = store.fresh_dir(spark, "warc")
    archives = warc.write(pages, folder)
    for split in (1000, 70_001, 1 << 30):
        got = {warc_page: uri for warc_page, uri in warc.read(archives, split).select(warc.page_of("record_id"), "target_uri").collect()}
        assert got == {1: long, 2: "u", 3: long + "x", 4: None}
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(pages, 5000).collect()}
    assert kinds == {1: ("revisit", 3), 2: ("response", None), 3: ("response", None), 4: ("response", None)}


def test_warc_fails_on_records_without_whole_headers():
    import gzip
    import io

    for text in (b"WARC/1.1\r\nWARC-Type: response\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n"):
        data = gzip.compress(text)
        with pytest.raises(ValueError, match="headers"):
            list(warc.scan_range(io.BytesIO(data), len(data), 0, len(data)))
    data = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" * 50)[:-20]
    with pytest.raises(ValueError, match="damaged"):
        list(warc.scan_range(io.BytesIO(data), len(data), 0, len(data)))


def test_warc_ignores_magic_that_is_no_record():
    import io

    record = warc._record(1, "u", b"x" * 3000, hashlib.sha1(b"x" * 3000).hexdigest(), None)
    data = b"junk\x1f\x8b\x08\0junk" + record + record
    out = [at for s in range(0, len(data), 7) for at, *_ in warc.scan_range(io.BytesIO(data), len(data), s, min(s + 7, len(data)))]
    assert out == [12, 12 + len(record)]


# URLs


def test_url_rules_and_list(spark):
    rows = [(1, "http://WWW.Example.net/en/1.html?q#f"), (2, "https://sub.example.com/de/"), (3, "http://x.org/fr/a"), (4, "http://x.org/en/a"), (5, "http://net?x"), (6, None), (7, "no scheme"), (8, "http://other.com/p/"), (8, "http://other.com/p/"), (9, "http://badnet/x"), (10, "http://y.net/z"), (None, "http://m.other.com/p.html")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("listed", F.lit(1)).withColumn("block", F.lit(2))
    listed = spark.createDataFrame([("other.com/p",), (None,), ("other.com/p",)], "canonical string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, listed).collect()), key=str)
    want = [(1, "www.example.net", "/en/1.html", "example.net/en/", "allow"), (2, "sub.example.com", "/de/", "example.com/de/", "block"), (3, "x.org", "/fr/a", "org/fr/", "allow"), (4, "x.org", "/en/a", None, "allow"), (5, "net", "", None, "allow")]
    want += [(6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "other.com", "/p/", None, "block"), (8, "other.com", "/p/", None, "block"), (9, "badnet", "/x", None, "allow"), (10, "y.net", "/z", "net/", "block"), (None, "m.other.com", "/p.html", None, "block")]
    assert got == sorted(want, key=str)
    assert urls.judge(pages.limit(0), listed).count() == 0 and urls.judge(pages, listed.limit(0)).count() == len(rows)


@pytest.mark.parametrize("limit", [0, 200_000])
def test_listed_urls_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(store, "BROADCAST_ROWS", limit)
    rows = [(k, f"http://a.com/{k % 50}" if k % 3 else None) for k in range(300)] + [(500, "http://a.com/" + "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    listed = spark.createDataFrame([(f"a.com/{k}",) for k in range(0, 50, 7)] + [("a.com/" + "x" * 100_000,)], "canonical string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, listed, ()).collect()}
    assert got == {k: "block" if u and (len(u) > 100 or int(u.split("/")[-1]) % 7 == 0) else "allow" for k, u in rows}


def test_of_equally_long_rules_the_first_wins(spark):
    pages = spark.createDataFrame([("http://x.a.com/b/c",)], "url string").withColumn("page_id", F.lit(1))
    rules = (("a.com", "/b", "block"), ("x.a.com", "", "allow"), ("a.com", "/b", "allow"))
    none = spark.createDataFrame([], "canonical string")
    for own, want in ((rules, ("a.com/b", "block")), (rules[1:], ("x.a.com", "allow")), (rules[::-1], ("a.com/b", "allow"))):
        assert [(r.rule, r.verdict) for r in urls.judge(pages, none, own).collect()] == [want]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    import duckdb
    import pandas as pd

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want, got = con.sql(queries.ORACLES[name]).df(), queries.QUERIES[name](spark, sf).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    got, want = (x[cols].sort_values(cols).reset_index(drop=True).astype(str) for x in (got, want))
    pd.testing.assert_frame_equal(got, want)


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(2000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("k"))
    rows = spark.range(1000, 6000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("k"))
    got = urls.with_listed(rows, "k", listed)
    assert got.where("listed").count() == 1000 and got.count() == 5000


# Tokens and packing


HARD = ["x<|endoftext|>y <|EndOfText|> <|startoftext|><|endoftext|>", "É×÷ÿŸ ÀÉ'S don't THEY'LL x'y", "a" * 50 + "1" * 30, "\x00 \x01a b\x7f", "½ ²³ Ⅷ ﬁ", "\u00a0nb\u00a0sp", "é é", "e\u0301 \u0301", "…", "Ã", "ab\n\n\ncd", "x" * 24 + " " + "y" * 25 + " Z" * 23, "é" * 12 + " " + "é" * 13, "\r\n\ta\x0bb\x0cc"]


@pytest.mark.parametrize("small", [False, True])
def test_codec_equals_the_library(monkeypatch, small):
    import pyarrow as pa

    from boxloom.llm import codec

    if small:  # windows within texts, and a table that forgets
        monkeypatch.setattr(wordhash, "STEP", 40)
        monkeypatch.setattr(codec, "MAX_IDS", 20)
        monkeypatch.setattr(codec, "PLACES", 4)
    coder = codec.Codec(tokenfiles.default_path())
    texts = [*ODD, *HARD, words(500, 3), None, words(500, 3).title()]
    for _ in range(2):
        ids, at = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [encoded(t)[:-1].tolist() for t in texts]
    ids, at = coder.ended(pa.array(texts, pa.string()).slice(1, 4), 1)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [encoded(t).tolist() for t in texts[1:5]]
    assert coder.by_unit and coder.encode(pa.array([], pa.string()))[1].tolist() == [0]


@pytest.mark.parametrize("ids", [[5, 3, None, 9, 3, 1, 2]])
def test_token_files_round_trip(spark, ids):
    rows = docs(spark, ODD, ids)
    got = sorted(map(tuple, tokenfiles.round_trip(rows).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(ids, key=lambda i: -1 if i is None else i)
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    want = Counter((i, len(e), zlib.crc32(e)) for i, e in zip(ids, map(encoded, ODD)))
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    assert tokenfiles.round_trip(rows.limit(0)).count() == 0


def test_token_files_in_many_parts(spark):
    rows = docs(spark, [words(k % 40, k) for k in range(300)], [k // 3 for k in range(300)])
    folder = store.fresh_dir(spark, "tokens")
    made = tokenfiles.write(rows, folder, part_bytes=4000)
    assert len(made["parts"]) > 10 and made["tokens"] == sum(p["tokens"] for p in made["parts"])
    got = sorted(map(tuple, tokenfiles.read(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [k // 3 for k in range(300)]
    assert Counter(r[3] for r in got) == Counter(zlib.crc32(encoded(words(k % 40, k))) for k in range(300))


def packed_right(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_documents(spark):
    rows = packing.pack_documents(docs(spark, ODD, [5, 3, None, 9, 3, 1, 2])).collect()
    want = Counter((i, k, s, len(e[s : s + 4096]), zlib.crc32(e[s : s + 4096])) for i, e in zip([5, 3, None, 9, 3, 1, 2], map(encoded, ODD)) for k, s in enumerate(range(0, len(e), 4096)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    packed_right(rows, 4096)
    assert packing.pack_documents(docs(spark, ODD).limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_packing_tree_is_dense(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice((rng.randint(1, 100), rng.randint(30, 60))) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "uid bigint, length bigint")
    rows = packing.pack(items, 100, 2, group=200).join(items, "uid").collect()
    assert len(rows) == 3000
    whole = len(packing.best_fit(np.array(sizes), 100)[2])
    assert packed_right(rows, 100) <= 1.02 * whole
    assert whole <= 1.25 * math.ceil(sum(sizes) / 100)


def test_packing_passes_on_all_open_bins(spark):
    """Items over half the capacity fill a bin each, and the small ones are all in one node's share of the items."""
    sizes = [60] * 900 + [40] * 900
    items = spark.createDataFrame(list(enumerate(sizes)), "uid bigint, length bigint")
    rows = packing.pack(items, 100, 2, group=100).join(items, "uid").collect()
    assert packed_right(rows, 100) <= 1.05 * 900 and len(rows) == 1800
    alone = spark.createDataFrame([(k, 70) for k in range(500)], "uid bigint, length bigint")
    assert packed_right(packing.pack(alone, 100, 2, group=50).join(alone, "uid").collect(), 100) == 500


def test_packed_documents_fill_their_sequences(spark):
    """On a table of the driver: against the least number of sequences that the tokens need."""
    rows = packing.pack_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert packed_right(rows, 4096) <= math.ceil(sum(r.length for r in rows) / 4096) + 1


# Hashes and near duplicates


def test_word_hashes_do_not_depend_on_the_step(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["a b  c", None, "", "Über über\tx" * 40, "q" * 300, words(50)])
    hashes, offsets = wordhash.hash_words(texts)
    assert np.diff(offsets).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts.to_pylist()]
    monkeypatch.setattr(wordhash, "STEP", 20)
    again, cuts = wordhash.hash_words(texts)
    assert (hashes == again).all() and (offsets == cuts).all()


@pytest.mark.parametrize("top", [1, 3, 40])
def test_bagminhash_estimates_weighted_jaccard(top):
    rng = np.random.default_rng(top)
    a = {k: int(w) for k, w in enumerate(rng.integers(1, top + 1, 80))}
    b = {k + (1000 if k % 9 == 0 else 0): w + int(rng.integers(0, top)) for k, w in a.items()}
    keys = wordhash.mix(np.array([*a, *b], np.uint64))
    sig = bagminhash.signatures(keys, np.array([*a.values(), *b.values()]), np.repeat([0, 1], [len(a), len(b)]), 3, 8192)
    both = set(a) | set(b)
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in both) / sum(max(a.get(k, 0), b.get(k, 0)) for k in both)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.025 and not sig[2].any()


def multiset(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def test_near_duplicates_equal_brute_force(spark):
    rng, texts = random.Random(4), []
    for g in range(12):
        own = words(rng.randint(30, 200), g, g).split()
        for _ in range(rng.choice((1, 2, 6))):
            w = list(own)
            for _ in range(rng.choice((0, 1, len(w) // 60))):
                w[rng.randrange(len(w))] = "new" + str(rng.random())
            texts.append(" ".join(w))
    texts += [None, "", "one two", "one two", "One  two", texts[0]]
    bags, root = [multiset(t) for t in texts], list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            total = sum((bags[i] | bags[j]).values())
            if total and sum((bags[i] & bags[j]).values()) >= 0.8 * total and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = {r.doc_id: r.class_id for r in neardup.classes(docs(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == root
    kept = neardup.keep(docs(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root)) and kept.columns == docs(spark, texts).columns


@pytest.mark.parametrize("copies, block", [(1000, None), (120, 16)])
def test_near_duplicates_link_copies_through_their_original(spark, copies, block):
    hub, rng, texts = words(200).split(), random.Random(7), []
    for k in range(copies):
        w = list(hub)
        for at in rng.sample(range(10, 190, 6), 3):
            w[at] = f"new{k}x{at}"
        texts.append(" ".join(w))
    texts.insert(copies // 2, " ".join(hub))
    bags = [multiset(t) for t in texts]
    alike = lambda a, b: sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values())
    assert all(alike(copies // 2, k) for k in range(copies + 1)) and sum(alike(0, k) for k in range(copies + 1)) < copies / 10
    found = neardup.classes(docs(spark, texts), **({"block": block} if block else {}))
    assert {r.class_id for r in found.collect()} == {0}


def test_near_duplicates_of_odd_rows(spark):
    long = words(40)
    rows = docs(spark, [long, long, long, "", None, long + " end"], [4, 4, None, 6, 7, 2])
    kept = neardup.keep(rows)
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, None, 6, 7])
    assert neardup.keep(rows.limit(0)).count() == 0


def test_near_duplicates_of_an_id_with_two_texts(spark):
    one, two = words(60, 1), words(60, 2)
    rows = docs(spark, [one, two, one + " end", two + " end", two], [1, 1, 2, 3, 4])
    got = {(r.doc_id, r.content): r.class_id for r in neardup.classes(rows).collect()}
    at = {r.text: r.c for r in rows.select("text", F.xxhash64("text").alias("c")).collect()}
    assert got[(2, at[one + " end"])] == got[(1, at[one])] == 1 and got[(3, at[two + " end"])] == got[(4, at[two])] == got[(1, at[two])] == 1
    links = neardup.classes(docs(spark, [one, two, two + " end"], [5, 5, 6])).collect()
    assert {r.class_id for r in links} == {5} and len(links) == 3


def test_near_duplicates_of_many_copies_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(store, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(neardup, "HOT_ROWS", 50)
    texts = [words(40, 1)] * 80 + [words(40, 1) + " end", None, words(12, 3)] + [words(40, k) for k in range(5, 15)]
    got = {r.doc_id: (r.class_id, r.copy_of) for r in neardup.classes(docs(spark, texts)).collect()}
    assert len(got) == len(texts) and all(got[k] == (0, 0) for k in range(80)) and got[80] == (0, 80)
    assert all(got[k] == (k, k) for k in range(81, len(texts)))


def test_overlap_equals_multisets(spark):
    texts = ["", "a b c", "a b c d e f a b c d e f", "a b c d e f", "x " * 50, "x " * 40, words(80), words(80) + " end"]
    pairs = spark.createDataFrame([(x, y) for x in texts for y in texts], "x string, y string")
    for r in pairs.withColumn("s", neardup.overlap()("x", "y")).collect():
        a, b = multiset(r.x), multiset(r.y)
        assert r.s == pytest.approx(sum((a & b).values()) / max(1, sum((a | b).values())))


# Decontamination, quality, toxicity


def test_leaks_tolerate_substitutions(spark):
    item = words(30, 8)
    w = item.split()
    changed = list(w)
    changed[7] = changed[20] = "other"
    filler = words(60, 9)
    texts = [filler + " " + item + " " + filler, filler + " " + " ".join(changed), filler, None, "", " ".join(w[:6]), " ".join(w[5:22]) + " " + filler, words(3000, 10) + " " + item.upper()]
    items = spark.createDataFrame([(1, item), (2, None), (None, item), (3, "too short")], "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    rows = docs(spark, texts)
    got = sorted((r.doc_id, r.item_id, r.place, r.matched) for r in decontaminate.leaks(rows, items).collect())
    assert got == [(0, 1, 60, 30), (1, 1, 60, 28), (6, 1, -5, 17), (7, 1, 3000, 30)]
    assert sorted(r.doc_id for r in decontaminate.keep(rows, items).collect()) == [2, 3, 4, 5]
    assert decontaminate.leaks(rows.limit(0), items).count() == 0 and decontaminate.keep(rows, items.limit(0)).count() == len(texts)


@pytest.mark.parametrize("words_", range(1, 17))
def test_every_accepted_replacement_has_a_seed(words_):
    from itertools import combinations

    size = min(words_, decontaminate.WINDOW)
    masks = decontaminate.plan(words_)
    for lost in combinations(range(size), size - math.ceil(decontaminate.SHARE * size)):
        for start in range(words_ - size + 1):
            gone = {start + k for k in lost}
            places = [(m, p) for m, at in masks for p in (range(start, start + size - len(m) + 1) if at is None else [at])]
            assert any(not gone & {p + k for k, one in enumerate(m) if one == "1"} for m, p in places), (words_, lost)


def brute_leaks(texts, items):
    """Every place of every item in every text."""
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    found = set()
    for d, t in enumerate(texts):
        x = cut(t)
        for i, item in enumerate(items):
            y = cut(item)
            w, best = min(13, len(y)), None
            for shift in range(-len(y) + 1, len(x)):
                equal = [0 <= shift + k < len(x) and x[shift + k] == v for k, v in enumerate(y)]
                if w and max(sum(equal[k : k + w]) for k in range(len(y) - w + 1)) >= 0.8 * w:
                    best = max(best or (0, 0), (sum(equal), -shift))
            if best:
                found.add((d, i, -best[1], best[0]))
    return found


def test_leaks_equal_all_places(spark):
    rng, vocabulary = random.Random(5), [f"w{k}" for k in range(400)]
    items = [" ".join(rng.choices(vocabulary, k=n)) for n in (1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, 11, 12, 12, 13, 14, 20, 35)]
    texts = []
    for k in range(120):
        w = rng.choices(vocabulary, k=rng.randint(0, 60))
        item = items[k % len(items)].split()
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            item[rng.randrange(len(item))] = "other"
        at = rng.randint(0, len(w))
        texts.append(" ".join(w[:at] + item[rng.choice((0, 0, 1)) :] + w[at:]))
    table = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.place, r.matched) for r in decontaminate.leaks(docs(spark, texts), table).collect()}
    assert got == brute_leaks(texts, items) and len(got) > 60


def brute_quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    rep = {p for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(rep), failed


def test_quality_statistics_equal_brute_force(spark):
    texts = [*ODD, words(60), "a b c d a b c x a b c", "a a a a a a", "l one\nl one\n \nl one", "#*$%&|<> " * 20, words(30) + "\n" + words(30), "\x0b\x0c tab\tx"]
    got = {r.doc_id: tuple(r)[1:7] for r in quality.judge(docs(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == [brute_quality(t) for t in texts]
    assert quality.judge(docs(spark, texts).limit(0)).count() == 0


def test_repeated_windows_are_exact_under_collisions(spark):
    """With hashes of no, one or two bits, all windows collide."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcd", k=rng.randint(1, 40))) for _ in range(40)] + [words(40), words(20) + " " + words(20)]
    rows = docs(spark, texts)
    for bits in (0, 1, 2, 64):
        got = {r.doc_id: r.n for r in rows.select("doc_id", quality.repeat_words(quality.words_of(F.col("text")), bits).alias("n")).collect()}
        assert [got[k] for k in range(len(texts))] == [brute_quality(t)[4] for t in texts]


def test_common_lines_go_and_depleted_documents(spark):
    common, more = "  Menu   " + words(20, 1), words(40, 2)
    texts = [common + "\n" + more + "\n" + words(100, k + 50) for k in range(8)] + [common.upper() + "\n" + words(60, 90) + "\n" + common, common + "\n" + words(30, 7) + "\n" + more]
    copies = [words(70, 77)] * 9
    rows = docs(spark, texts + copies + [None])
    got = {r.doc_id: r for r in quality.judge(rows, line_docs=5).collect()}
    assert got[8].removed == 42 and got[8].kept and got[0].removed == 61
    assert not got[9].kept and not got[9].base_failed and all(got[k].kept and not got[k].removed for k in range(10, 19))
    kept = {r.doc_id: r for r in quality.keep(rows, line_docs=5).collect()}
    assert sorted(kept) == [k for k in range(19) if k != 9]
    assert kept[0].text == words(100, 50) and kept[0].n_chars == len(kept[0].text) and kept[12].text == copies[0]


def test_toxicity_learns_from_positives_only_of_its_folds(spark):
    rng = random.Random(3)
    bad = ["moron", "idiot", "trash"]
    texts, marks = [], []
    for k in range(900):
        w = words(rng.randint(20, 80), k % 50, k % 7).split()
        toxic = k % 6 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(("", ".", "!"))
        texts.append(" ".join(w))
        marks.append((k, int(toxic)))
    texts += [None, ""]
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id bigint, toxic int").withColumn("text", F.lit("clash"))
    rows = toxicity.judge(docs(spark, texts), labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, dict(marks)[r.doc_id]) for r in rows if r.held_out and r.doc_id < 900]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert [r.predicted for r in rows if r.doc_id >= 900] == [0, 0]
    kept = toxicity.keep(docs(spark, texts), labels)
    assert kept.columns == docs(spark, texts).columns and abs(kept.count() - 752) < 20
    assert toxicity.judge(docs(spark, texts), labels.limit(0)).count() == len(texts)
    assert toxicity.judge(docs(spark, texts).limit(0), labels).count() == 0


def test_toxicity_with_few_positives_repeated_ids_and_long_texts(spark, monkeypatch):
    texts = [words(30, k) for k in range(40)] + ["word " * 300_000, ""]
    for marks in ([(0, 1)], [(0, 1), (1, 1), (2, 1)], [(3, 0)], []):
        labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
        rows = toxicity.judge(docs(spark, texts), labels).collect()
        assert len(rows) == len(texts) and len({r.score for r in rows}) == 1
    monkeypatch.setattr(toxicity, "POSITIVES", 5)
    monkeypatch.setattr(toxicity, "LEAST_GAP", 0.0)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, positive, *a: (seen.append((int(positive.sum()), len(rows))), (np.zeros(a[0]), 0.0))[1])
    ids = [k for k in range(0, 40, 1) for _ in range(30)]
    texts = [f"bad{k % 3} trash moron " + words(9, k) if k < 20 else words(9, k) for k in ids]
    toxicity.judge(docs(spark, texts, ids), spark.createDataFrame([(k, int(k < 20)) for k in range(40)], "doc_id bigint, toxic int"))
    assert seen and seen[0][0] == 5 and seen[0][1] <= 45


def test_a_score_of_the_threshold_is_toxic(spark):
    rows = toxicity.judge(docs(spark, ["a", "b"]), spark.createDataFrame([], "doc_id bigint, toxic int"), 0.5).collect()
    assert [r.score for r in rows] == [0.5, 0.5] and [r.predicted for r in rows] == [1, 1]


@pytest.mark.parametrize("prior", [0.1, 0.85])
def test_risk_slope_equals_differences(prior):
    rng = np.random.default_rng(1)
    pos, unl = ([rng.choice(6, rng.integers(0, 4), replace=False).tolist() for _ in range(n)] for n in (7, 11))
    params, seen = rng.normal(size=7) + (2 if prior > 0.5 else 0), set()
    for scale in (1, -1):
        at = params * scale
        _, bracket, slope = toxicity.risk(at, pos, unl, prior)
        seen.add(bracket >= 0)
        whole = lambda x: sum(toxicity.risk(x, pos, unl, prior)[:2]) if bracket >= 0 else -toxicity.risk(x, pos, unl, prior)[1]
        steps = np.eye(7) * 1e-6
        assert slope == pytest.approx([(whole(at + s) - whole(at - s)) / 2e-6 for s in steps], abs=1e-6)
        assert toxicity.risk(at, [[]], [[]], prior)[2].dtype == float
    assert True in seen


# Language model and shards


def test_the_query_scores_words_by_trigrams(spark, tmp_path):
    texts = ["a b c a b", "a b d", None, "x", "a b c a b d", "b c a d", "c a b c"]
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in queries.op2_lm_scoring(spark, str(tmp_path)).collect()}
    bags = [(t or "").split() for t in texts]
    counts = lambda b: Counter(tuple(b[k : k + n]) for n in (1, 2, 3) for k in range(len(b) - n + 1))
    total, used = sum((counts(b) for b in bags), Counter()), 0
    for k, b in enumerate(bags):
        rest, logs = total - counts(b), []
        words_left = sum(v for g, v in rest.items() if len(g) == 1)
        for i in range(len(b)):
            most = min(3, i + 1)
            n = next((n for n in range(most, 1, -1) if rest[tuple(b[i - n + 1 : i + 1])] and rest[tuple(b[i - n + 1 : i])]), 1)
            used += n == 3
            gram = tuple(b[i - n + 1 : i + 1])
            logs.append((most - n) * math.log10(0.4) + math.log10(rest[gram] or 0.5) - math.log10(rest[gram[:-1]] if n > 1 else words_left))
        assert got[k] == (pytest.approx(sum(logs) / len(logs)) if b else None)
    assert used > 5


def backoff_scores(texts, order):
    """Each text's score under the counts of all the others, by definition."""
    bags = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for t in texts]
    counts = lambda b: Counter(tuple(b[k : k + n]) for n in range(1, order + 1) for k in range(len(b) - n + 1))
    total = sum((counts(b) for b in bags), Counter())
    for b in bags:
        rest, logs = total - counts(b), []
        left = sum(v for g, v in rest.items() if len(g) == 1)
        for i in range(len(b)):
            most = min(order, i + 1)
            n = next((n for n in range(most, 1, -1) if rest[tuple(b[i - n + 1 : i + 1])] and rest[tuple(b[i - n + 1 : i])]), 1)
            gram = tuple(b[i - n + 1 : i + 1])
            logs.append((most - n) * math.log10(0.4) + math.log10(rest[gram] or 0.5) - math.log10(rest[gram[:-1]] if n > 1 else max(left, 1)))
        yield sum(logs) / len(logs) if logs else None


@pytest.mark.parametrize("order, block_docs", [(1, 3), (3, 1), (3, 4), (3, 1000), (4, 5)])
def test_stupid_backoff_of_any_order_equals_brute_force(spark, order, block_docs):
    rng = random.Random(order)
    texts = [" ".join(rng.choices("abcdefghijkl", [40, 20, 10, 5, 4, 3, 2, 1, 1, 1, 1, 1], k=rng.randint(0, 50))) for _ in range(24)]
    texts += [None, "", "x", texts[0], texts[0], texts[1], "long " * 2000 + texts[2]]
    rows = docs(spark, texts, [*range(len(texts) - 1), 3])
    got = Counter((r.doc_id, None if r.score is None else round(r.score, 9)) for r in lm.scores(rows, order, block_docs=block_docs).collect())
    want = Counter((r.doc_id, None if s is None else round(s, 9)) for r, s in zip(rows.collect(), backoff_scores(texts, order)))
    assert got == want


CLASSES = """
import os, sys
from pyspark.sql import SparkSession
from boxloom.llm import neardup
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "file://" + sys.argv[1]).getOrCreate()
text = " ".join(f"w{k}" for k in range(60))
rows = neardup.classes(spark.createDataFrame([(1, text), (2, text + " x"), (3, text), (4, "other words")], "doc_id bigint, text string")).collect()
print(sorted((r.doc_id, r.class_id, r.copy_of) for r in rows))
"""


def test_near_duplicates_start_no_process_for_each_file(tmp_path):
    """While a process is started, it counts as the JVM's memory a second time."""
    log, path = tmp_path / "log", tmp_path / "bin"
    path.mkdir()
    (path / "chmod").write_text(f'#!/bin/sh\necho "$@" >> {log}\nexec {shutil.which("chmod")} "$@"\n')
    (path / "chmod").chmod(0o755)
    env = os.environ | {"PATH": f"{path}:{os.environ['PATH']}", "PYTHONPATH": str(Path(__file__).resolve().parents[2])}
    done = subprocess.run([sys.executable, "-c", CLASSES, str(tmp_path / "shared")], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip() == "[(1, 1, 1), (2, 1, 2), (3, 1, 1), (4, 4, 4)]", done.stderr[-2000:]
    assert [x for x in (log.read_text().splitlines() if log.exists() else []) if ".parquet" in x] == []


def test_handed_tables_hold_what_is_given(spark):
    given = spark.range(0, 5000, 1, 3).select("id", F.array("id", F.lit(None).cast("bigint")).alias("many"), F.when(F.col("id") % 2 == 0, F.lit("é")).alias("text"), F.encode(F.lit("b"), "utf-8").alias("raw"))
    got, found = store.handed(given, "test", odd=F.count_if(F.col("id") % 2 == 1))
    assert found == {"n": 5000, "odd": 2500} and got.dtypes == given.dtypes and sorted(got.collect()) == sorted(given.collect())
    none, found = store.handed(given.where("id < 0"), "test")
    assert found == {"n": 0} and none.dtypes == given.dtypes and none.count() == 0


def test_a_stored_table_leaves_no_shuffle_files(spark):
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = files()
    store.table(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().join(spark.range(50).withColumnRenamed("id", "k"), "k"), "test")
    assert files() <= before


def test_stupid_backoff_equals_brute_force(spark):
    texts = ["a b c a b", "a b d", None, "", "x", "a b c a b", "B c A"]
    got = {r.doc_id: r for r in lm.scores(docs(spark, texts), order=2, block_docs=2).collect()}
    bags = [re.findall(r"\S+", (t or "").lower()) for t in texts]
    one, two = Counter(w for b in bags for w in b), Counter(p for b in bags for p in zip(b, b[1:]))
    total = sum(one.values())
    for k, b in enumerate(bags):
        own1, own2, logs, alone = Counter(b), Counter(zip(b, b[1:])), 0.0, 0
        for i, w in enumerate(b):
            if i and two[b[i - 1], w] > own2[b[i - 1], w]:
                logs += math.log10((two[b[i - 1], w] - own2[b[i - 1], w]) / (one[b[i - 1]] - own1[b[i - 1]]))
                continue
            alone += 1
            logs += math.log10(max(one[w] - own1[w], 0.5) / (total - len(b))) + (math.log10(0.4) if i else 0)
        assert got[k].n_words == len(b) and got[k].n_unigrams == alone
        assert got[k].score is None if not b else abs(got[k].score - logs / len(b)) < 1e-9
    assert lm.scores(docs(spark, texts).limit(0)).count() == 0


def test_shards_compact_and_keep_versions(spark):
    s = shards.ShardStore(spark, store.fresh_dir(spark, "test"))
    for k in range(5):
        s.append(docs(spark, ["x" * 10, None], [2 * k, None]).coalesce(1))
    before = s.manifest()
    assert len(before["shards"]) == 5
    after = s.compact(1 << 20)
    assert len(after["shards"]) == 1 and after["version"] == before["version"] + 1
    assert s.read(before["version"]).count() == s.read().count() == 10
    assert s.compact(1 << 20) == after
    with pytest.raises(shards.Conflict):
        s._commit(before, before["schema"], before["shards"])
    assert s.vacuum(0) == 5 and s.read().where("doc_id IS NULL").count() == 5 and s.versions() == [after["version"]]


def test_shards_keep_a_column_of_their_name_and_long_texts(spark):
    s = shards.ShardStore(spark, store.fresh_dir(spark, "test"))
    s.append(spark.createDataFrame([("a", "x" * 2_000_000), ("b", None)], "shard string, text string"))
    got = {r.shard: (r.text, r._shard) for r in s.read().collect()}
    assert got["a"][0] == "x" * 2_000_000 and got["b"][0] is None and got["a"][1].endswith(".parquet")


def test_arrivals_are_merged_and_swept(spark):
    folder = store.fresh_dir(spark, "test")
    rows, state = shards.shard_documents(docs(spark, [words(50, k) for k in range(400)]).repartition(3), folder, 8000)
    assert rows.count() == 400 and state["versions"] > 1 and state["rows_before"] == 400
    assert not state["arrivals_left"] and not state["unnamed"] and not state["surplus_shards"]
    left = rows.select("shard").distinct().count()
    assert left < 40 and shards.ShardStore(spark, folder).vacuum() == 0
    none, state = shards.shard_documents(docs(spark, []), store.fresh_dir(spark, "test"))
    assert none.count() == 0 and state["rows_before"] == 0
    s = shards.ShardStore(spark, folder)
    s._write(docs(spark, ["stray"]))
    assert s.vacuum(3600) == 0 and s.vacuum(0) >= 1 and s.read().count() == 400


def test_tiers_merge_only_alike():
    sizes = [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 60), ("f", 200)]
    merges = shards.ShardStore.plan([{"path": p, "bytes": b} for p, b in sizes], 100)
    assert [[x["path"] for x in m] for m in merges] == [["a", "b", "c", "d"]]

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_only_drop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        now = {r.doc_id for r in docs.collect()}
        assert docs.columns == names and now <= ids and now, name
        ids = now
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()} == ids


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, kept boolean, node string, score double"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean documents, and what each stage should catch: (folder, rows, what remains)."""
    rng, folder = random.Random(11), tmp_path_factory.mktemp("planted")
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(3000)]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    rows, gone = [], {}

    def add(text, why=None, doc_id=None):
        doc_id = len(rows) if doc_id is None else doc_id
        rows.append((doc_id, text, "en", f"s{len(rows) % 3}", None if text is None else len(text), "k", True, "n", 0.5))
        if why:
            gone[doc_id] = why
        return doc_id

    items = [make(20), make(30)]
    for _ in range(300):
        add(make(rng.randint(60, 200)))
    for k in range(120):  # toxic, the labelled ones and others alike
        words = make(80).split()
        for at in rng.sample(range(80), 6):
            words[at] = rng.choice(("moron", "idiot", "trash"))
        add(" ".join(words), "toxic")
    labels = [(r[0], 1, int(r[0] in gone)) for r in rows if r[0] % 4]
    for text in (None, "", "too short", "again and again " * 60):
        add(text, "quality")
    base = add(make(150))
    words = rows[base][1].split()
    add(" ".join(words), "duplicate")
    for at in (30, 70, 110):
        add(" ".join([*words[:at], "changed", *words[at + 1 :]]), "duplicate")
    for item in items:
        add(make(60) + " " + item + " " + make(60), "benchmark")
    other = items[1].split()
    other[5] = other[20] = "other"
    add(make(60) + " " + " ".join(other) + " " + make(60), "benchmark")
    add(make(6000))  # of two sequences
    add(make(90), None, None)
    null = (None, make(90), "en", None, 1, "k", True, "n", 0.5)
    spark.createDataFrame([*rows, null], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("clash")).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").withColumn("source", F.lit("clash")).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, gone


def test_run_drops_what_was_planted_and_keeps_the_rest(spark, planted):
    from tokenizers import Tokenizer

    from boxloom.llm.codec import default_path

    folder, rows, gone = planted
    out = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in out}
    caught = Counter(why for k, why in gone.items() if k not in kept)
    assert caught["quality"] == 4 and caught["duplicate"] == 4 and caught["benchmark"] == 3 and caught["toxic"] >= 114
    clean = {r[0] for r in rows} - set(gone)
    assert len(clean - kept) <= 6 and None in kept
    # every document that is left, whole, in sequences that hold it without gaps
    coder, texts = Tokenizer.from_file(default_path()), {r[0]: r[1] for r in rows}
    for k in list(kept - {None})[:40] + [max(texts) - 1]:
        assert sum(r.length for r in out if r.doc_id == k) == len(coder.encode(texts[k], add_special_tokens=False).ids) + 1
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(offset == sum(n for at, n in items if at < offset) and offset + length <= 4096 for items in bins.values() for offset, length in items)
    assert len(bins) <= math.ceil(sum(r.length for r in out) / 4096) + 1


def test_each_stage_by_plain_rules(spark, planted):
    """The stages that have an exact rule, each on its own input."""
    folder, rows, gone = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: {r.doc_id for r in df.collect()}
    every = {r[0] for r in rows} | {None}
    assert every - ids(stages["quality rules"](spark, docs, folder)) == {k for k, w in gone.items() if w == "quality"}
    short = lambda t: tuple(re.findall(r"\S+", (t or "").lower()))
    left = ids(stages["near duplicates"](spark, docs, folder))
    assert every - left == {k for k, w in gone.items() if w == "duplicate"} and short(rows[0][1])
    assert every - ids(stages["benchmark decontamination"](spark, docs, folder)) == {k for k, w in gone.items() if w == "benchmark"}


def test_stages_take_empty_and_repeated_rows(spark, planted):
    folder, rows, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    few = docs.where("doc_id < 3").unionByName(docs.where("doc_id < 3"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name
        found = {r.doc_id for r in stage(spark, few, folder).collect()}
        assert found == {0, 1, 2}, name
    assert {r.doc_id: r for r in corpus_pipeline.STAGES[2][1](spark, few, folder).collect()}.keys() == {0, 1, 2}
    assert corpus_pipeline.STAGES[2][1](spark, few, folder).count() == 3

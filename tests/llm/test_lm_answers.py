from collections import Counter

import numpy as np
import pyarrow as pa

from boxloom.llm import lm


def test_answers_carry_counts_of_ranges_and_no_grams():
    rng = np.random.default_rng(3)
    asks, sums = [], Counter()
    for block in range(3):
        grams = np.unique(np.concatenate([rng.integers(-(1 << 63), (1 << 63) - 1, 500), [-(1 << 63), (1 << 63) - 1, 0, -1, 7]]))
        counts = rng.integers(2, 4, len(grams)) * (1 << 29 if block else 1)
        asks.append((block, grams, counts))
        sums.update(dict(zip(grams.tolist(), counts.tolist())))
    rows = [(g, (block << 32) + n) for block, grams, counts in asks for g, n in zip(grams.tolist(), counts.tolist())]
    rng.shuffle(rows)
    for bits in (1, 12):
        answers = []
        for part in range(5):  # a partition has some of the ranges, in any order
            own = [r for r in rows if (r[0] >> (64 - bits)) % 5 == part]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*own) if own else ((),) * 2, (pa.int64(),) * 2)], names=["gram", "own"])
            answers += [r for b in lm._count(2, bits)([batch]) for r in b.to_pylist()]
        assert not any("gram" in r for r in answers)
        for block, grams, _ in asks:
            held = lm.Block.__new__(lm.Block)
            held.answers = [r for r in answers if r["block"] == block]
            assert held.total(2, grams).tolist() == [sums[g] for g in grams.tolist()]


def test_counts_within_documents_equal_a_count_of_pairs():
    rng = np.random.default_rng(4)
    for kinds in (1, 50, 200_000):
        number = rng.integers(0, kinds, 5000) if kinds < 200_000 else np.concatenate([rng.permutation(kinds), rng.integers(0, kinds, 50_000)])
        owner = np.sort(rng.integers(0, 40, len(number)))
        pairs = Counter(zip(number.tolist(), owner.tolist()))
        got = lm.in_document(number, owner, np.bincount(number, minlength=kinds))
        assert got.tolist() == [pairs[p] for p in zip(number.tolist(), owner.tolist())]
    assert len(lm.in_document(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def test_a_block_hashes_its_words_once(monkeypatch):
    texts = ["a b c a", None, "", "B b", "x " * 70_000 + "ü"]
    hashes, offsets = lm.hash_words(pa.array(texts))
    rows = lm._pack((pa.scalar(7),), pa.table({"doc_id": pa.array([1, None, 3, 4, 5], pa.int64()), "text": texts}))
    monkeypatch.setattr(lm, "hash_words", None)  # from here on no text is looked at
    block = lm.Block(rows.to_pylist()[0], None)
    assert block.ids == [1, None, 3, 4, 5] and (block.hashes == hashes).all() and (block.offsets == offsets).all()
    asked = [r for b in lm._first(rows.to_batches()) for r in b.to_pylist()]
    grams, counts = np.unique(lm.gram_hashes(hashes, np.arange(len(hashes)), 1), return_counts=True)
    assert [(r["gram"], r["own"]) for r in asked] == [(g, (7 << 32) + n) for g, n in zip(grams.tolist(), counts.tolist())]
    answers = pa.Table.from_batches([b for b in lm._count(1, 12)(iter([pa.RecordBatch.from_pylist(asked)]))])
    assert lm._ask(2)((pa.scalar(7),), rows, answers).num_rows == 1  # only b is in two documents
    assert lm._score(1, 0.4)((pa.scalar(7),), rows, answers).column("n_words").to_pylist() == [4, 0, 0, 2, 70_001]


def test_ranked_is_a_stable_sort():
    rng = np.random.default_rng(5)
    far = rng.integers(-(1 << 63), (1 << 63) - 1, 3000)
    near = far.copy()
    near[:200] = far[200:400] ^ rng.integers(0, 4, 200)  # agree in the upper bits
    for key in (far, near, rng.choice(near, 9000), rng.integers(0, 9, 5000), far[:1], far[:0], np.array([(1 << 63) - 1, -(1 << 63)] * 3)):
        order, got = lm.ranked(key)
        assert order.tolist() == np.argsort(key, kind="stable").tolist() and got.tolist() == key[order].tolist()

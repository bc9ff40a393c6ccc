import random

import numpy as np

from panelspark.llm.decontaminate import check, leaks, longest_common, terms, times

DOCS, ITEMS = "doc_id long, text string, cosine double", "item_id long, text string"


def words(rng, n, kind="w"):
    """A third of common words, else rare ones."""
    return [f"{kind}{rng.randrange(20) if rng.random() < 0.3 else rng.randrange(4000)}" for _ in range(n)]


def brute(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 90)), rng.integers(0, 6, rng.integers(0, 90))
        assert longest_common(a, b) == brute(a.tolist(), b.tolist())
    assert check(np.arange(10), np.arange(6)) == (0.6, False)
    assert check(np.arange(10), np.array([0, 1, 2, 7, 8, 9])) == (0.6, True)


def test_terms_and_sparse_products():
    rng = np.random.default_rng(5)
    for size in (1, 2, 700):
        vocabulary = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64, endpoint=False))
        asked = np.concatenate([rng.permutation(vocabulary), vocabulary + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        where = {h: i for i, h in enumerate(vocabulary.tolist())}
        assert terms(vocabulary, asked).tolist() == [where.get(h, -1) for h in asked.tolist()]
    whole = rng.standard_normal((300, 90)) * (rng.random((300, 90)) < rng.random((300, 1)))
    whole[[0, 7, 299]] = 0
    dense = rng.standard_normal((90, 5)).astype(np.float32)
    row, column = np.nonzero(whole)
    assert np.allclose(times(row, column, whole[row, column].astype(np.float32), dense, 300), whole @ dense, atol=1e-4)
    assert not times(row[:0], column[:0], whole[:0, 0], dense, 3).any()


def test_planted_items_and_paraphrases(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randint(14, 110)))) for i in range(40)]
    docs, expected = [], set()
    for d in range(200):
        text = words(rng, rng.randint(30, 400))
        if d % 4 == 0:
            item, own = rng.choice(items)
            own = own.split()
            if d % 8 == 0:  # every eighth word is replaced, one more is added
                own = [w if k % 8 else "other" for k, w in enumerate(own, 1)] + ["more"]
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() + "," for w in own]
            expected.add((d, item))
        docs.append((d, " ".join(text), 0.0))
    docs += [(900, None, 0.0), (901, "", 0.0), (None, items[0][1], 0.0), (902, items[1][1], 0.0), (902, items[1][1], 0.0)]
    found = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items + [(99, None), (98, " !")], ITEMS)).collect()
    pairs = [(r.doc_id, r.item_id) for r in found]
    assert expected <= set(pairs)
    assert {p for p in pairs if p[0] is not None and p[0] < 900} == expected
    assert pairs.count((None, 0)) == 1 and pairs.count((902, 1)) == 2
    assert all(0.6 <= r.overlap <= 1 and r.cosine >= 0.45 for r in found)


def test_empty_tables_and_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three four five six", 0.0)], DOCS)
    items = spark.createDataFrame([(1, "one two three four five six"), (2, "six five four three two one")], ITEMS)
    assert leaks(docs, items.limit(0)).count() == 0
    assert leaks(docs.limit(0), items).count() == 0
    assert {r.item_id for r in leaks(docs, items).collect()} == {1}
    monkeypatch.setattr("panelspark.llm.decontaminate.ITEMS", 1)
    assert {r.item_id for r in leaks(docs, items).collect()} == {1}

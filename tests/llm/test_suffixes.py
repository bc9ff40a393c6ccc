import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from panelspark.llm import suffixes
from panelspark.llm.suffixes import merge, remove_repeats, suffix_order, transform


def brute(rows, n=400):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for (k, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(t), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefghij éß\n") for _ in range(n))
    passage, short = text(420), text(395)
    docs = [text(rng.randint(0, 900)) for _ in range(40)]
    for i in range(0, 40, 3):
        docs[i] = docs[i] + passage + text(rng.randint(0, 9)) + short
    near = docs[6][:-300] + "#" + docs[6][-299:]
    docs += [docs[3], docs[3], docs[4], near, "la " * 400, "la " * 200, text(700) + text(5) * 150, docs[9][-700:] + docs[7][:500], "x" * 399, "x" * 400, "y" * 401]
    rows = list(enumerate(docs))
    return rows + [(None, docs[5]), (99, None), (98, ""), (3, docs[3]), (97, text(40_000))]


@pytest.mark.parametrize("shard,crowd", [(8 << 20, 4096), (4000, 4096), (9000, 1)])
def test_against_brute_force(spark, monkeypatch, shard, crowd):
    monkeypatch.setattr(suffixes, "SHARD", shard)
    monkeypatch.setattr(suffixes, "BUCKET", shard)
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rows = corpus()
    found = remove_repeats(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_bytes int")).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str) == brute(rows)


def test_other_lengths(spark):
    rows = corpus(4)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for string, anchor in ((200, 64), (90, 30)):
        found = remove_repeats(frame, string=string, anchor=anchor).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str) == brute(rows, string)


def test_merged_transforms_give_order_and_common_prefixes():
    rng = random.Random(7)
    for _ in range(40):
        shards = [[[rng.randint(1, 3) for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 4))]
        transforms, ends, expected = [], [], []
        for s, strings in enumerate(shards):
            symbols = np.array([x for t in strings for x in [*t, 0]])
            string = np.repeat(np.arange(len(strings)), [len(t) + 1 for t in strings])
            transforms.append(transform(symbols, string, suffix_order(symbols, string)))
            ends.append(len(strings))
            expected += [(t[i:], s, k) for k, t in enumerate(strings) for i in range(len(t) + 1)]
        expected.sort(key=lambda e: ([(x + 1, 0, 0) for x in e[0]] + [(0, e[1], e[2])]))
        interleave, common = merge(transforms, ends)
        assert interleave.tolist() == [s for _, s, _ in expected]
        lengths = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for (a, *_), (b, *_) in zip(expected, expected[1:])]
        assert common.tolist() == lengths


def test_repeats_that_end_their_document(spark):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefghij \n") for _ in range(n))
    rows = []
    for i in range(0, 300, 2):
        passage = text(400 + i % 6)
        rows += [(i, text(rng.randint(0, 60)) + passage), (i + 1, text(rng.randint(0, 60)) + passage + text(rng.randint(1, 60)))]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str) == brute(rows)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0

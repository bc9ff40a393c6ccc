import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from panelspark.llm.likelihood import MARK, Vocabulary, score

PIECES = [MARK, MARK + "a", "a", "b", "ab", MARK + "ab", "ba", "é"]


def vocabulary():
    return Vocabulary(PIECES, [-float(i) for i in range(len(PIECES))])


def brute(model, word):
    """Sum over all segmentations of the marked word, one by one."""
    word = MARK + word
    if not word:
        return 1.0

    def rest(i):
        if i == len(word):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(word) + 1):
            piece = word[i:j]
            p = math.exp(model.log[model.pieces[piece]]) if piece in model.pieces else 0.0
            if j == i + 1:
                p += math.exp(model.log_byte * len(piece.encode()))
            total += p * rest(j) if p else 0.0
        return total

    return rest(0)


def test_lattice_against_every_segmentation():
    model = vocabulary()
    words = ["", "a", "ab", "abab", "bbab", "é", "xé", "aaaaaaa"]
    assert np.allclose(np.exp(model.log_likelihood(words)), [brute(model, w) for w in words], rtol=1e-12, atol=0)


def test_expected_counts_of_a_word():
    model = vocabulary()
    found = model.expected(["ab", "ab", "a"], np.array([1, 2, 1]))
    total = brute(model, "ab")
    marked = math.exp(model.log[model.pieces[MARK + "ab"]]) / total
    assert abs(found[model.pieces[MARK + "ab"]] - 3 * marked) < 1e-12


def test_long_word_and_probabilities():
    model = vocabulary()
    assert np.isfinite(model.log_likelihood(["ab" * 3000])).all()
    model.learn(np.arange(len(model.log)))
    assert abs(np.exp(model.log).sum() + 256 * math.exp(model.log_byte) - 1) < 1e-12


def test_scores_against_counting(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["a", "AB", "ba", "b", "Éa", "abab"], k=rng.randint(0, 40))) for _ in range(60)]
    texts += [None, "", " \n", "unseen-1 a", "ab " * 40_000, "x" * 3000]
    rows = [(i, t, 1.0) for i, t in enumerate(texts)] + [(3, texts[3], 1.0), (None, "a b", 1.0)]
    model = vocabulary()
    found = score(spark.createDataFrame(rows, "doc_id long, text string, score double"), vocabulary=model).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    low = lambda t: (t or "").encode().lower().decode().split()
    counts, ends = Counter(), 0
    for i, t, _ in rows:
        if not held(i):
            counts.update(low(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    prob = {w: (counts[w] + v * brute(model, w)) / (n + v) for t in texts for w in set(low(t)) if len(w) < 20}
    end = (ends + v * math.exp(model.log[-1])) / (n + v)
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i, t, _ in rows:
        r, words = by[i], low(t)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(i), len(words) + 1, n)
        assert r.n_known == sum(counts[w] > 0 for w in words) + 1
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if all(len(w) < 20 for w in words):
            assert r.score == pytest.approx(sum(math.log10(prob[w]) for w in words) + math.log10(end), rel=1e-9)


def test_empty_table(spark):
    assert score(spark.createDataFrame([], "doc_id long, text string"), vocabulary=vocabulary()).count() == 0

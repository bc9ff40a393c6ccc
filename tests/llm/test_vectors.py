import math
import random

import numpy as np
import pytest

from panelspark.llm import vectors
from panelspark.llm.vectors import Code, near_vectors


def brute(rows, cosine=0.95):
    unit = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        w = np.array(v, float) / max(map(abs, v)) if ok else None
        unit.append(w / np.linalg.norm(w) if ok else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        for i in range(n):
            label[i] = min([label[i], *(label[j] for j in near[i])])
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[label[i]] = min(least.get(label[i], k), k)
    return sorted(((k, len(near[i]), least.get(label[i]) if unit[i] is not None else k) for i, (k, _) in enumerate(rows)), key=str)


def sample(n, seed, dimension=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dimension))
    near = [b + 0.05 * rng.standard_normal(dimension) for b in base[: n // 2] for _ in range(2)]
    crowd = [base[0] + 0.1 * rng.standard_normal(dimension) for _ in range(60)]
    return [list(map(float, v)) for v in [*base, *near, *crowd]]


@pytest.mark.parametrize("members", [8192, 10])
def test_against_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(vectors, "MEMBERS", members)
    data = sample(60, 1)
    rows = list(enumerate(data + data[:5] + data[:1] * 9))
    random.Random(2).shuffle(rows)
    odd = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0], [1e200, 2e200]]
    rows += [(1000 + i, v) for i, v in enumerate(odd)] + [(None, data[3]), (None, None), (7, data[4]), (7, data[4])]
    frame = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, n_links int")
    found = near_vectors(frame).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    off = rng.standard_normal((400, 64))
    off -= (off * a).sum(axis=1, keepdims=True) * a
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * off
    for n in (1000, 100_000):
        code = Code.for_size(n, 0.95)
        sets = [[set() for _ in range(400)] for _ in "ab"]
        for side, x in zip(sets, (a, b)):
            for row, number in zip(*code.decode(x)):
                side[row].add(int(number))
        assert sum(bool(x & y) for x, y in zip(*sets)) >= 0.97 * 400


def test_decoding_finds_exactly_the_filters_above_the_cap():
    code, x = Code(3, 5, 1.5), np.random.default_rng(3).standard_normal((40, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    scores = [x @ d for d in code.directions(12)]
    full = scores[0][:, :, None, None] + scores[1][:, None, :, None] + scores[2][:, None, None, :]
    expected = {(r, (i * 5 + j) * 5 + k) for r, i, j, k in zip(*np.nonzero(full >= 1.5))}
    assert set(zip(*(v.tolist() for v in code.exceeding(x, np.full(40, 1.5))))) == expected
    assert np.bincount(code.decode(x)[0], minlength=40).min() >= 24


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0

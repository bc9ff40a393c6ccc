import random
from hashlib import sha256
from zlib import crc32

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm.runs import RunFinder, collapse_runs, op11, runs_of, stretches
from panelspark.llm.words import Texts


def brute(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, times * q) and not any(
                all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)
            ):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def collapsed(words, found):
    keep = [True] * len(words)
    for start, length, q in found:
        for k in range(start + q, start + length):
            keep[k] = False
    return " ".join(w for w, k in zip(words, keep) if k)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70))
def test_automaton_against_brute_force(words):
    assert runs_of(words) == brute(words)
    assert runs_of(words, 2, 2) == brute(words, 2, 2)


@pytest.mark.parametrize("q", [1, 2, 3, 7, 40])
def test_periodic_sequences(q):
    rng = random.Random(q)
    root = [rng.randrange(10**6) for _ in range(q)]
    words = [-1, *(root * 30)[: 4 * q + 5], -2, *(root * 5), *root[:1]]
    assert runs_of(words) == brute(words)


def test_long_repetition_takes_amortised_logarithmic_time(monkeypatch):
    steps = [0]
    splay = RunFinder._splay
    monkeypatch.setattr(RunFinder, "_splay", lambda self, x: (steps.__setitem__(0, steps[0] + 1), splay(self, x))[1])
    assert runs_of(["a"] * 5000) == [(0, 5000, 1)]
    assert steps[0] < 20_000


def corpus(seed=3):
    rng = random.Random(seed)
    texts = [None, "", " \n ", "a", "a a a a a", "a a a a a a", "x" * 30_000, " ".join(["b"] * 3000), "a b a b a b a b", "a b a b a b a"]
    for k in range(60):
        words = [rng.choice("abcdefgh") if k % 3 else f"w{rng.randrange(4000)}é" for _ in range(rng.randrange(0, 200))]
        for _ in range(rng.randrange(3)):
            at, root = rng.randrange(len(words) + 1), words[: rng.randrange(1, 12)]
            words[at:at] = (root * 9)[: len(root) * rng.randrange(2, 8) + rng.randrange(3)]
        texts.append(rng.choice([" ", "\t", " \n"]).join(words))
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[-1]), (5, texts[5]), (5, texts[5])]


def test_whole_documents(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, runs int, n_words int")
    out = {}
    for r in collapse_runs(frame).collect():
        out.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed_text))
    assert sum(map(len, out.values())) == len(rows)
    for k, text in rows:
        words = (text or "").split()
        found = brute(words)
        assert (len(words), found, collapsed(words, found)) in out[k]


def test_stretches_hold_every_run():
    for _, text in corpus(8):
        texts = Texts.of(pa.array([text], pa.string()))
        words = texts.words()
        places = stretches(words, words.hashes())
        for start, length, _ in brute((text or "").split()):
            assert any(a <= start and start + length <= b for _, a, b in places)


def test_results_come_through_the_automaton(monkeypatch):
    monkeypatch.setattr(RunFinder, "append", lambda self, word: [])
    assert runs_of(["a"] * 50) == []


def test_query(spark, tmp_path):
    rows = [(i, " ".join(f"{'abc'[k * k % 3]}{k % 37}" for k in range(i % 90))) for i in range(300)] + [(None, "a " * 9), (300, None)]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, start string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11(spark, str(tmp_path)).collect()}
    planted = 0
    for k, text in rows:
        words = (text or "").split()
        n, h = len(words), crc32(str(k).encode()) if k is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = brute(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        r = got[k]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(collapsed(words, found).encode()).hexdigest()
    assert planted > 10


def test_empty_table(spark):
    assert collapse_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0

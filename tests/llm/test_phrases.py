import random
from hashlib import sha256

import numpy as np

from panelspark.llm import phrases
from panelspark.llm.phrases import PHRASE, PhraseAutomaton, remove_repeats


def brute(rows, n=50):
    words = [(t or "").encode().split() for _, t in rows]
    rank = [i if i is not None else 1 << 63 for i, _ in rows]
    first = {}
    for r, w in zip(rank, words):
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            first[key] = min(first.get(key, r), r)
    out = []
    for (k, _), r, w in zip(rows, rank, words):
        keep = [True] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < r:
                keep[i : i + n] = [False] * n
        out.append((k, len(w), len(w) - sum(keep), sha256(b" ".join(x for x, y in zip(w, keep) if y)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    text = lambda n: [rng.choice(["the", "of"]) if rng.random() < 0.4 else f"w{rng.randrange(3000)}é" for _ in range(n)]
    passage, other = text(51), text(49)
    docs = [text(rng.randint(0, 200)) for _ in range(60)]
    for i in range(0, 60, 4):
        docs[i] = docs[i] + passage + text(rng.randint(0, 9)) + other
    docs += [list(docs[k]) for k in (3, 3, 4, 8)] + [["la"] * 300, ["la"] * 120, text(20) + ["la"] * 70]
    near = list(docs[8])
    near[len(near) // 2] = "changed"
    docs += [near, docs[8][:60] + docs[4][-60:], text(49), text(50)]
    rows = [(i * 7 % 101, rng.choice([" ", "  \n", "\t"]).join(d)) for i, d in enumerate(docs)]
    return rows + [(None, rows[4][1]), (5000, None), (5001, ""), (5002, " \n "), rows[8], (5003, "x" * 30_000), (5004, " ".join(text(30_000)))]


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_words int")
    for size in (phrases.SHARD, 3000):
        monkeypatch.setattr(phrases, "SHARD", size)
        found = remove_repeats(frame).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str) == brute(rows)
        assert all(sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in found)


def test_automaton_finds_every_occurrence():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 2, 400).astype(np.uint64)
    text[::97] = 5
    chosen = np.unique(np.array([text[i : i + PHRASE] for i in (3, 50, 51, 200)]), axis=0)
    known = {tuple(p) for p in chosen.tolist()}
    expected = [i for i in range(400 - PHRASE + 1) if tuple(text[i : i + PHRASE].tolist()) in known]
    assert PhraseAutomaton(chosen).occurrences(text).tolist() == expected


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0

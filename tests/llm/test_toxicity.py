import random
import zlib

import numpy as np
import pyarrow as pa

from panelspark.llm import toxicity
from panelspark.llm.toxicity import WINDOW, Lexicon, Network, keep_clean, score, windows
from panelspark.llm.words import Texts


def words_of(texts):
    return Texts.of(pa.array(texts, pa.string())).lower().words(letters=True)


def test_windows_cover_every_word():
    words = words_of(["a b c", "", " ".join(map(str, range(100))), None])
    doc, place = windows(words)
    assert sorted(set(doc.tolist())) == [0, 1, 2, 3]
    assert set(place[place >= 0].tolist()) == set(range(len(words)))
    assert (place[doc == 1] == -1).all() and (doc == 2).sum() == 12
    assert place.shape[1] == WINDOW


def test_gradients():
    words = words_of(["one two three", "two four five six two"])
    lexicon = Lexicon.of_words(words)
    _, place = windows(words)
    ids = np.where(place >= 0, lexicon.which[place], -1)
    odds = np.linspace(-1, 1, len(lexicon.hashes))
    net, slope = Network(1), np.array([0.7, -0.4])
    kept = []
    vectors = net.inputs(lexicon, odds)
    net.forward(vectors, ids, kept)
    grad = net.backward(lexicon, vectors, ids, kept[0], slope)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        used = np.flatnonzero(grad[name].reshape(-1)) if name in ("word", "pair") else np.arange(len(flat))
        for i in rng.choice(used, min(6, len(used)), replace=False):
            old, out = flat[i], []
            for step in (1e-5, -1e-5):
                flat[i] = old + step
                out.append(slope @ net.forward(net.inputs(lexicon, odds), ids))
            flat[i] = old
            assert abs((out[0] - out[1]) / 2e-5 - grad[name].reshape(-1)[i]) < 1e-6, name


def corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        text = [f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 150))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["Idiot", "moron,", "trash", "scum"]))
        rows.append((i, " ".join(text), 1.0))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = corpus()
    rows += [(700, None, 0.0), (701, "", 0.0), (None, "idiot scum", 0.0), (702, "w1 " * 40_000 + "idiot moron scum", 0.0), (702, "w3", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (9999, 1), (700, 0)], "doc_id long, toxic int")
    found = score(docs, marks).collect()
    assert len(found) == len(rows)
    truth = dict(labels)
    for r in found:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95
    assert {r.predicted for r in found if r.doc_id in (700, 701)} == {0}
    assert sorted(r.predicted for r in found if r.doc_id == 702) == [0, 1]
    kept = keep_clean(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in found)


def test_threshold_does_not_move_with_the_sample(spark, monkeypatch):
    # one in four documents with the word is toxic, whatever share of the clean ones trains
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(10)}" for _ in range(12)) + (" maybe" if i % 2 else "")) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 8 == 1)) for i, _ in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE", {1: 100, 0: 100})
    found = [r for r in score(docs, marks).collect() if r.held_out]
    assert np.mean([r.predicted for r in found]) < 0.05
    assert abs(np.mean([r.score for r in found]) - 1 / 8) < 0.06


def test_empty_and_unlabelled(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert [r.score for r in score(docs, marks).collect()] == [0.0]
    assert score(docs.limit(0), marks.limit(0)).count() == 0

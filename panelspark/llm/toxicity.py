"""Toxicity: a bidirectional gated recurrent network with attention, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .tables import query, read
from .words import Texts, Words

#: Words of a window; windows overlap by half.
WINDOW, STEP = 16, 8
#: Hashed word and letter-pair tables, their widths, and hidden units of each direction.
WORDS, PAIRS, WIDTH, HIDDEN, ATTEND = 8192, 1024, 6, 8, 8
#: Slots of the counts that tell how often a word stands in toxic texts.
SLOTS = 1 << 18
#: At most so many labelled documents of each class train the network (counts use all of them).
SAMPLE = {1: 800, 0: 1600}
#: Labels that are sent to all tasks; more are joined by a shuffle.
BROADCAST = 500_000
EPOCHS, BATCH, RATE = 5, 64, 0.01
#: In training, the vectors of so many words are left out, so that no word is learnt by heart.
DROP = 0.5


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Lexicon:
    """The distinct words of some texts as the network reads them."""

    hashes: np.ndarray
    which: np.ndarray  # for each word of the texts, which one it is
    pair: np.ndarray  # letter pairs of all distinct words
    of: np.ndarray  # the word of each pair
    share: np.ndarray  # one divided by the number of pairs of the word

    @classmethod
    def of_words(cls, words: Words) -> Lexicon:
        hashes, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        start, length = words.start[first], words.end[first] - words.start[first]
        of = np.repeat(np.arange(len(hashes)), length)
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + start[of]
        data = words.texts.data.astype(np.int64)
        before = np.where(at > start[of], data[np.maximum(at - 1, 0)], 0)
        return cls(hashes, which, (before * 257 + data[at]) % PAIRS, of, 1.0 / length)


def windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, word positions) of overlapping windows over whole texts; -1 fills short ones.

    Every document has one at least, an empty one if it has no words.
    """
    counts = words.counts()
    many = np.maximum(1, -(-(counts - (WINDOW - STEP)) // STEP))
    doc = np.repeat(np.arange(len(counts)), many)
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    place = (words.first[doc] + at * STEP)[:, None] + np.arange(WINDOW)
    return doc, np.where(place < words.first[doc + 1][:, None], place, -1)


def log_odds(toxic: np.ndarray, clean: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """Log odds of a word in toxic against clean documents; a few documents weigh little."""
    n = toxic + clean
    odds = np.log((toxic + 0.5) / (totals[0] + 1)) - np.log((clean + 0.5) / (totals[1] + 1))
    return odds * n / (n + 3)


class Network:
    """Parameters and both passes. Inputs are word ids of a lexicon; -1 is padding."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        size, h = 2 * WIDTH + 1, HIDDEN
        normal = lambda *shape: rng.standard_normal(shape) / np.sqrt(shape[0])
        self.p = {"word": 0.02 * rng.standard_normal((WORDS, WIDTH)), "pair": 0.02 * rng.standard_normal((PAIRS, WIDTH))}
        for d in "fb":
            self.p |= {f"w{d}": normal(size, 3 * h), f"u{d}": normal(h, 3 * h), f"c{d}": np.zeros(3 * h)}
        self.p |= {"wa": normal(2 * h, ATTEND), "va": normal(ATTEND), "wo": normal(2 * h), "bo": np.zeros(1) - 1.0}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, lexicon: Lexicon, odds: np.ndarray, dtype=np.float64) -> np.ndarray:
        """Word vector, mean of the letter pairs' vectors, log odds; some words at a time, as pairs take room."""
        p, n = self.p, len(lexicon.hashes)
        out = np.empty((n, 2 * WIDTH + 1), dtype)
        heads = np.searchsorted(lexicon.of, np.arange(n + 1))  # every word has a pair
        for a in range(0, n, 16384):
            b = min(n, a + 16384)
            pairs = p["pair"][lexicon.pair[heads[a] : heads[b]]]
            out[a:b, WIDTH : 2 * WIDTH] = np.add.reduceat(pairs, heads[a:b] - heads[a], axis=0) * lexicon.share[a:b, None]
            out[a:b, :WIDTH] = p["word"][(lexicon.hashes[a:b] % np.uint64(WORDS)).astype(np.int64)]
        out[:, 2 * WIDTH] = 0.25 * odds
        return out

    def forward(self, vectors: np.ndarray, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """A logit for each window; with ``keep``, what the backward pass needs goes there."""
        p, h, n = self.p, HIDDEN, len(ids)
        dtype = vectors.dtype
        real = ids >= 0
        hidden = np.zeros((WINDOW, n, 2 * h), dtype)
        trace = {}
        for d, order in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            table = (vectors @ p[f"w{d}"] + p[f"c{d}"]).astype(dtype)
            table = np.vstack([table, np.zeros((1, 3 * h), dtype)])
            u = p[f"u{d}"].astype(dtype)
            state = np.zeros((n, h), dtype)
            part = slice(0, h) if d == "f" else slice(h, 2 * h)
            for t in order:
                x, back = table[ids[:, t]], state @ u
                gates = sigmoid(x[:, : 2 * h] + back[:, : 2 * h])
                r, z = gates[:, :h], gates[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * back[:, 2 * h :])
                after = np.where(real[:, t, None], new + z * (state - new), state)
                if keep is not None:
                    trace[d, t] = (state, r, z, new, back[:, 2 * h :])
                state = after
                hidden[t, :, part] = state
        tanh = np.tanh(hidden @ p["wa"].astype(dtype))
        energy = np.where(real.T, tanh @ p["va"].astype(dtype), -1e9)
        weight = np.exp(energy - energy.max(axis=0)) * real.T
        weight /= np.maximum(weight.sum(axis=0), 1e-30)
        pooled = (weight[:, :, None] * hidden).sum(axis=0)
        if keep is not None:
            keep.append((trace, hidden, tanh, weight, pooled, real))
        return pooled @ p["wo"].astype(dtype) + dtype.type(p["bo"][0])

    def backward(self, lexicon: Lexicon, vectors: np.ndarray, ids: np.ndarray, kept: tuple, dlogit: np.ndarray, mask: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        """Gradients of sum(dlogit * logit); ``mask`` is what the inputs were multiplied by."""
        p, h = self.p, HIDDEN
        trace, hidden, tanh, weight, pooled, real = kept
        grad = {"bo": np.array([dlogit.sum()]), "wo": pooled.T @ dlogit}
        dpooled = dlogit[:, None] * p["wo"]
        dhidden = weight[:, :, None] * dpooled
        dweight = (hidden * dpooled).sum(axis=2)
        denergy = weight * (dweight - (weight * dweight).sum(axis=0))
        grad["va"] = np.einsum("tn,tna->a", denergy, tanh)
        dtanh = denergy[:, :, None] * p["va"] * (1 - tanh**2)
        grad["wa"] = np.einsum("tnh,tna->ha", hidden, dtanh)
        dhidden = dhidden + dtanh @ p["wa"].T
        dvectors = np.zeros_like(vectors)
        for d, order in (("f", range(WINDOW - 1, -1, -1)), ("b", range(WINDOW))):
            part = slice(0, h) if d == "f" else slice(h, 2 * h)
            u = p[f"u{d}"]
            du, dtable = np.zeros_like(u), np.zeros((len(vectors) + 1, 3 * h))
            dstate = np.zeros((len(ids), h))
            for t in order:
                dstate = dstate + dhidden[t, :, part]
                state, r, z, new, inner = trace[d, t]
                live = real[:, t, None]
                dafter = np.where(live, dstate, 0)
                dz = dafter * (state - new) * z * (1 - z)
                dnew = dafter * (1 - z) * (1 - new**2)
                dr = dnew * inner * r * (1 - r)
                dx = np.concatenate([dr, dz, dnew], axis=1)
                dback = np.concatenate([dr, dz, dnew * r], axis=1)
                np.add.at(dtable, ids[:, t], dx)
                du += state.T @ dback
                dstate = np.where(live, dafter * z, dstate) + dback @ u.T
            dtable = dtable[:-1]
            grad[f"u{d}"], grad[f"c{d}"], grad[f"w{d}"] = du, dtable.sum(axis=0), vectors.T @ dtable
            dvectors += dtable @ p[f"w{d}"].T
        dvectors *= mask
        grad["word"], grad["pair"] = np.zeros_like(p["word"]), np.zeros_like(p["pair"])
        np.add.at(grad["word"], (lexicon.hashes % np.uint64(WORDS)).astype(np.int64), dvectors[:, :WIDTH])
        letters = dvectors[:, WIDTH : 2 * WIDTH] * lexicon.share[:, None]
        np.add.at(grad["pair"], lexicon.pair, letters[lexicon.of])
        return grad


class Adam:
    def __init__(self, p: dict[str, np.ndarray]):
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.n = 0

    def step(self, p: dict[str, np.ndarray], grad: dict[str, np.ndarray]) -> None:
        self.n += 1
        for k, g in grad.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            p[k] -= RATE * self.m[k] / (1 - 0.9**self.n) / (np.sqrt(self.v[k] / (1 - 0.999**self.n)) + 1e-8)


def _words(batch_column: pa.Array) -> Iterator[tuple[int, Words]]:
    for begin, _, texts in Texts.of(batch_column).pieces():
        yield begin, texts.lower().words(letters=True)


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(SLOTS)).astype(np.int64)


def counts(labelled: DataFrame) -> np.ndarray:
    """(2, SLOTS): clean and toxic documents of all labelled (text, label) that hold a word of the slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * SLOTS, np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy()
            for begin, words in _words(batch.column(0)):
                seen = np.unique(words.document() * SLOTS + slots(words.hashes()))
                total += np.bincount(seen % SLOTS + SLOTS * label[begin + seen // SLOTS], minlength=2 * SLOTS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["slot", "n"])

    # at most 2 * SLOTS rows, whatever the input
    parts = labelled.select("text", "label").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(2 * SLOTS, np.int64)
    table = parts.toArrow()
    out[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return out.reshape(2, SLOTS)


@dataclass
class Model:
    network: Network
    clean: np.ndarray
    toxic: np.ndarray
    totals: tuple[float, float]  # toxic, clean documents

    def odds(self, hashes: np.ndarray) -> np.ndarray:
        at = slots(hashes)
        return log_odds(self.toxic[at].astype(float), self.clean[at].astype(float), self.totals)

    def logits(self, words: Words) -> np.ndarray:
        """The largest logit of each document's windows."""
        lexicon = Lexicon.of_words(words)
        vectors = self.network.inputs(lexicon, self.odds(lexicon.hashes), np.float32)
        doc, place = windows(words)
        best = np.full(len(words.first) - 1, -np.inf)
        for a in range(0, len(doc), 8192):
            at = place[a : a + 8192]
            ids = np.where(at >= 0, lexicon.which[at] if len(lexicon.which) else -1, -1)
            np.maximum.at(best, doc[a : a + 8192], self.network.forward(vectors, ids).astype(np.float64))
        return best

    def scores(self, words: Words) -> np.ndarray:
        return sigmoid(self.network.scale * self.logits(words) + self.network.shift)


def train(texts: list[str], labels: np.ndarray, clean: np.ndarray, toxic: np.ndarray, totals: tuple[float, float], seed: int = 5) -> Model:
    """Fit on whole documents; a document is as toxic as its worst window.

    Each epoch takes the worst window of each document by the present model (at first
    by log odds) and some others of clean ones. A document's own words are taken out
    of the counts while it trains.
    """
    network = Network(seed)
    rng = np.random.default_rng(seed)
    words = Texts.of(pa.array(texts, pa.string())).lower().words(letters=True)
    lexicon = Lexicon.of_words(words)
    doc, place = windows(words)
    at = slots(lexicon.hashes)
    # a distinct word has one row of inputs for each label, as the own document is taken out
    rows = []
    for label in (0, 1):
        rows.append(log_odds(np.maximum(toxic[at] - label, 0.0), np.maximum(clean[at] - (1 - label), 0.0), (totals[0] - label, totals[1] - (1 - label))))
    n = len(lexicon.hashes)
    double = Lexicon(
        np.tile(lexicon.hashes, 2), lexicon.which, np.tile(lexicon.pair, 2), np.r_[lexicon.of, lexicon.of + n], np.tile(lexicon.share, 2)
    )
    odds = np.concatenate(rows)
    ids = np.where(place >= 0, lexicon.which[place] + n * labels[doc][:, None] if n else -1, -1)
    strength = np.where(ids >= 0, odds[ids] if n else 0.0, -9.0).max(axis=1)
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    adam = Adam(network.p)
    end = np.searchsorted(double.of, np.arange(2 * n), "right")
    begin = np.searchsorted(double.of, np.arange(2 * n))
    for epoch in range(EPOCHS):
        if epoch:
            vectors = network.inputs(double, odds, np.float32)
            strength = np.concatenate([network.forward(vectors, ids[a : a + 8192]) for a in range(0, len(ids), 8192)])
        order = np.lexsort((-strength, doc))
        worst = order[np.r_[True, doc[order][1:] != doc[order][:-1]]]
        others = rng.choice(np.flatnonzero(labels[doc] == 0), min(len(texts), int((labels[doc] == 0).sum())), replace=False)
        chosen = rng.permutation(np.concatenate([worst, others]))
        for a in range(0, len(chosen), BATCH):
            some = chosen[a : a + BATCH]
            used, local = np.unique(ids[some], return_inverse=True)
            local = local.reshape(len(some), WINDOW) - (used[0] < 0)
            used = used[used >= 0]
            many = end[used] - begin[used]
            pairs = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[used], many)
            small = Lexicon(double.hashes[used], None, double.pair[pairs], np.repeat(np.arange(len(used)), many), double.share[used])
            vectors, kept = network.inputs(small, odds[used]), []
            mask = np.ones_like(vectors)
            mask[:, : 2 * WIDTH] = (rng.random((len(used), 1)) >= DROP) / (1 - DROP)
            vectors = vectors * mask
            logit = network.forward(vectors, local, kept)
            slope = (sigmoid(logit) - labels[doc[some]]) * weight[doc[some]] / len(some)
            adam.step(network.p, network.backward(small, vectors, local, kept[0], slope, mask))
    vectors = network.inputs(double, odds, np.float32)
    logit = np.concatenate([network.forward(vectors, ids[a : a + 8192]) for a in range(0, len(ids), 8192)])
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, doc, logit)
    sampled = np.bincount(labels, minlength=2)
    true = np.array(totals[::-1])
    # the sample's classes count with their share of all labelled documents
    part = true / true.sum() * len(labels) / np.maximum(sampled, 1)
    network.scale, network.shift = calibrate(best, labels, part[labels])
    return Model(network, clean, toxic, totals)


def calibrate(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make the scores of weighted documents most likely (Newton's method, a little shrunk)."""
    beta = np.array([1.0, 0.0])
    x = np.stack([logits, np.ones(len(logits))], axis=1)
    for _ in range(50):
        score = sigmoid(x @ beta)
        curve = (x * (weight * score * (1 - score))[:, None]).T @ x + np.diag([1e-1, 1e-3])
        step = np.linalg.solve(curve, x.T @ (weight * (score - labels)) + np.array([1e-1 * (beta[0] - 1), 1e-3 * beta[1]]))
        beta = beta - np.clip(step, -1, 1)
    return max(1e-3, float(beta[0])), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, folds: int) -> Model | None:
    """A model from all labelled rows outside the held-out fold; None if a class is missing."""
    # one label for each id: the larger of several
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")).where("label in (0, 1)")
    if marks.count() <= BROADCAST:  # texts need not move then
        marks = F.broadcast(marks)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.where(F.crc32(F.col("id").cast("string")) % folds != 0).join(marks, "id")
    rows = stored(rows.select("id", "text", F.col("label").cast("long").alias("label")), "labelled")
    table = counts(rows)
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    texts, marks = [], []
    for label, most in SAMPLE.items():
        # a bounded sample: the documents with the least hashes
        for r in rows.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id", "text").select("text").limit(most).toLocalIterator():
            texts.append(r.text)
            marks.append(label)
    return train(texts, np.array(marks), table[0], table[1], (float(totals[1]), float(totals[0])))


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
) -> DataFrame:
    """One row for each document: id, held_out, score (0 to 1), predicted (1 from 0.5).

    A document's score is that of its worst window; all windows of 16 words, half
    overlapping, of the whole text count. A bidirectional gated recurrent network with
    attention reads each window; a word's input is its hashed vector, its letter
    pairs' vectors and its log odds among all labelled documents. Rows whose crc32(id
    as text) modulo ``folds`` is 0 are held out of counts and training. The network
    itself trains on at most SAMPLE documents of each class.

    Null and empty texts are one empty window; a null id is not held out and never
    trains; repeated rows each get their row; without both classes among the labels
    every score is 0; an empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, folds=folds)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))
    picked = docs.select(F.col(id_col), held.alias("held_out"), F.col(text_col).alias("text"))
    schema = picked.select(id_col, "held_out", F.lit(0.0).alias("score")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(len(batch))
            if shared.value is not None:
                for begin, words in _words(batch.column(2)):
                    out[begin : begin + len(words.first) - 1] = shared.value.scores(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], schema.names)

    scored = picked.mapInArrow(run, schema)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_clean(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5
) -> DataFrame:
    """The documents, all columns, that score below 0.5; the model is that of :func:`score`."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, folds=folds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(len(batch), bool)
            if shared.value is not None:
                for begin, words in _words(batch.column(text)):
                    keep[begin : begin + len(words.first) - 1] = shared.value.scores(words) < 0.5
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


@query("op6_toxicity")
def op6(spark, folder):
    return score(read(spark, folder, "documents"), read(spark, folder, "labels"))

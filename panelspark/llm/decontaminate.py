"""Benchmark decontamination by latent semantic retrieval and subsequence checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, query, read
from .words import Texts, Words

#: Words of a passage; searched passages overlap by half.
PASSAGE = 48
#: Dimensions of the latent space, and further ones that sharpen it.
RANK, EXTRA = 128, 8
#: Entries of a sparse row that are multiplied together.
SPAN = 24
#: Items that one search holds; larger benchmarks are searched block after block.
ITEMS = 2000
#: Latent cosine from which a passage is checked.
COSINE = 0.45
#: Share of an item's words found in order: enough alone, or enough if its answer is there.
CERTAIN, WITH_ANSWER = 0.8, 0.6
#: The answer is the last words of an item: this share of it, three at least.
ANSWER = 0.2


@dataclass
class Items:
    """A block of the benchmark: its items as word hashes, and the vocabulary they use."""

    ids: list
    words: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes

    @classmethod
    def of(cls, ids: list, texts: list[str]) -> Items:
        words = Texts.of(pa.array(texts, pa.string())).lower().words(letters=True)
        hashes = words.hashes()
        split = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        kept = [i for i, w in enumerate(split) if len(w)]
        return cls([ids[i] for i in kept], [split[i] for i in kept], np.unique(hashes))

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first word, end) of each item's own passages."""
        rows = []
        for i, words in enumerate(self.words):
            starts = range(0, max(1, len(words) - PASSAGE // 2), PASSAGE // 2)
            rows += [(i, s, min(len(words), s + PASSAGE)) for s in starts]
        return tuple(np.array(x) for x in zip(*rows))


def passages(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, end) of passages of ``size`` words; a document's last one may be shorter."""
    many = -(-words.counts() // size)
    doc = np.repeat(np.arange(len(many)), many)
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = words.first[doc] + at * size
    return doc, start, np.minimum(start + size, words.first[doc + 1])


def terms(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index in the sorted vocabulary, -1 for other words; the leading bits of a hash lead near its place."""
    bits = len(vocabulary).bit_length() + 2
    shift = np.uint64(64 - bits)
    edges = np.searchsorted(vocabulary >> shift, np.arange((1 << bits) + 1, dtype=np.uint64))
    at = np.minimum(edges[hashes >> shift], len(vocabulary) - 1)
    out = np.full(len(hashes), -1)
    for _ in range(int(np.diff(edges).max())):
        same = vocabulary[at] == hashes
        out[same] = at[same]
        at = np.minimum(at + 1, len(vocabulary) - 1)
    return out


def sparse(term: np.ndarray, start: np.ndarray, end: np.ndarray, weight: np.ndarray | None, size: int):
    """(row, column, value) of the passages' term counts; with weights, of TF-IDF."""
    length = end - start
    row = np.repeat(np.arange(len(start)), length)
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
    column = term[at]
    known = column >= 0
    if weight is not None:
        known &= weight[column] > 0
    key, count = np.unique(row[known] * size + column[known], return_counts=True)
    row, column = key // size, key % size
    if weight is None:
        return row, column, count
    return row, column, (count * weight[column]).astype(np.float32)


def scaled(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int):
    """The same matrix with rows of length one."""
    norm = np.sqrt(np.bincount(row, value * value, minlength=rows))
    return row, column, (value / norm[row]).astype(np.float32)


def times(row: np.ndarray, column: np.ndarray, value: np.ndarray, dense: np.ndarray, rows: int) -> np.ndarray:
    """The sparse matrix (sorted by row) times a dense one.

    Rows are cut into stretches of SPAN entries, so that a few stretches and the lines
    they need stay in cache; the stretches of a row are added in the end.
    """
    out = np.zeros((rows, dense.shape[1]), np.float32)
    if not len(row):
        return out
    count = np.bincount(row, minlength=rows)
    many = -(-count // SPAN)
    start = np.cumsum(many) - many
    at = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    place = (start[row] + at // SPAN, at % SPAN)
    columns, values = np.zeros((many.sum(), SPAN), np.int64), np.zeros((many.sum(), SPAN), np.float32)
    columns[place], values[place] = column, value
    sums = np.empty((len(values), dense.shape[1]), np.float32)
    for a in range(0, len(values), 128):
        sums[a : a + 128] = np.matmul(values[a : a + 128, None], dense[columns[a : a + 128]])[:, 0]
    some = np.flatnonzero(many)
    out[some] = np.add.reduceat(sums, start[some], axis=0)
    return out


def _pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, Words]]:
    for batch in batches:
        for begin, _, texts in Texts.of(batch.column(column)).pieces():
            yield batch, begin, texts.lower().words(letters=True)


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many passages of all documents each term is, and how many passages there are."""
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, np.int64)
        for _, _, words in _pieces(batches, 0):
            _, start, end = passages(words, PASSAGE)
            _, column, _ = sparse(terms(vocabulary, words.hashes()), start, end, None, size)
            counts[:size] += np.bincount(column, minlength=size)
            counts[size] += len(start)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["term", "n"])

    # one row for each term of a benchmark block: bounded by its words
    rows = docs.select(text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size + 1, np.int64)
    for row in rows:
        counts[row.term] = row.n
    return counts[:size], int(counts[size])


def gram_times(docs: DataFrame, text_col: str, vocabulary: np.ndarray, weight: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """A' (A dense) for the TF-IDF matrix A of all passages, one pass; sums of terms meet in a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weight, dense.astype(np.float32)))
    size, rank = dense.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weight, dense = shared.value
        total = np.zeros((size, rank))
        for _, _, words in _pieces(batches, 0):
            _, start, end = passages(words, PASSAGE)
            row, column, value = scaled(*sparse(terms(vocabulary, words.hashes()), start, end, weight, size), len(start))
            latent = times(row, column, value, dense, len(start))
            order = np.argsort(column, kind="stable")
            total += times(column[order], row[order], value[order], latent, size)
        some = np.flatnonzero(total.any(axis=1))
        for a in range(0, len(some), 1024):
            lines = [x.tobytes() for x in total[some[a : a + 1024]].astype(np.float32)]
            yield pa.RecordBatch.from_arrays([pa.array(some[a : a + 1024]), pa.array(lines, pa.binary())], ["term", "line"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        line = np.sum([np.frombuffer(x, np.float32) for x in group["line"]], axis=0, dtype=np.float64)
        return pd.DataFrame({"term": [group["term"].iloc[0]], "line": [line.astype(np.float32).tobytes()]})

    parts = docs.select(text_col).mapInArrow(run, "term long, line binary")
    out = np.zeros((size, rank))
    for row in parts.groupBy("term").applyInPandas(add, "term long, line binary").collect():
        out[row.term] = np.frombuffer(row.line, np.float32)
    shared.unpersist()
    return out


def latent_space(docs: DataFrame, text_col: str, items: Items, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights of terms, basis, latent vectors of the items' passages).

    Randomised singular value decomposition in one pass: the Gram matrix of the
    TF-IDF passages of all documents is multiplied by random vectors, and Nystrom's
    formula gives its leading eigenvectors. The benchmark's own passages are stacked
    below and get as much weight together, so that their directions are kept.
    """
    size = len(items.vocabulary)
    often, n = document_frequencies(docs, text_col, items.vocabulary)
    # terms in over a quarter of all passages tell nothing; a few passages tell little about that
    weight = np.maximum(0, np.log((n + 1000) / (4 * often + 1)))
    item, first, end = items.passages()
    term = [terms(items.vocabulary, w) for w in items.words]
    shift = np.concatenate([[0], np.cumsum([len(t) for t in term])])
    own = sparse(np.concatenate(term), first + shift[item], end + shift[item], weight, size)
    probe = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, min(size, RANK + EXTRA))))[0]
    row, column, value = scaled(*own, len(item))
    small = times(row, column, value, probe.astype(np.float32), len(item))
    image = np.zeros_like(probe)
    np.add.at(image, column, small[row] * value[:, None])
    image = gram_times(docs, text_col, items.vocabulary, weight, probe) + image * max(1, n) / len(item)
    nudge = 1e-6 * (np.linalg.norm(image) + 1e-30)
    image += nudge * probe
    core = probe.T @ image
    values, turn = np.linalg.eigh((core + core.T) / 2)
    half = turn / np.sqrt(np.maximum(values, nudge / 2))
    basis = np.linalg.svd(image @ half, full_matrices=False)[0][:, :RANK].astype(np.float32)
    return weight, basis, unit(times(*own, basis, len(item)))


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def longest_common(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit for each word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    row = everything = (1 << len(item)) - 1
    for w in text.tolist():
        if (mask := masks.get(w)) is not None:
            found = row & mask
            row = ((row + found) | (row - found)) & everything
    return len(item) - row.bit_count()


def check(item: np.ndarray, text: np.ndarray) -> tuple[float, bool]:
    """(share of the item's words found in order, whether its answer is there)."""
    answer = item[-max(3, round(ANSWER * len(item))) :]
    share = longest_common(item, text) / len(item)
    return share, share > 0 and longest_common(answer, text) >= 0.8 * len(answer)


def _search(docs: DataFrame, id_col: str, text_col: str, items: Items, item_type) -> DataFrame:
    weight, basis, asked = latent_space(docs, text_col, items)
    of, size = items.passages()[0], len(items.vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((items, weight, basis, asked, of))
    schema = docs.select(id_col).schema.add("item", "integer").add("cosine", "double").add("overlap", "double").add("answer", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, basis, asked, of = shared.value
        numbers = [terms(items.vocabulary, w).tolist() for w in items.words]
        for batch, begin, words in _pieces(batches, 1):
            hashes = words.hashes()
            # latent vectors add up: a passage is a half and the next one of its document
            doc, start, end = passages(words, PASSAGE // 2)
            term = terms(items.vocabulary, hashes)
            near = times(*sparse(term, start, end, weight, size), basis, len(start))
            follows = np.flatnonzero(doc[1:] == doc[:-1])
            next_half = near[follows + 1]
            near[follows] += next_half
            end[follows] = end[follows + 1]
            near = unit(near)
            found: dict[tuple[int, int], tuple[float, float, bool]] = {}
            widest = max(map(len, items.words))
            for a in range(0, len(near), 8192):
                cosine = near[a : a + 8192] @ asked.T
                last, around = -1, set()
                for p, q in zip(*(x.tolist() for x in np.nonzero(cosine >= COSINE))):
                    key = (int(doc[a + p]), int(of[q]))
                    low, high = words.first[key[0]], words.first[key[0] + 1]
                    if p != last:  # words near the passage: a bound of any subsequence, for all items at once
                        around = set(term[max(low, start[a + p] - widest) : min(high, end[a + p] + widest)].tolist())
                        last = p
                    own = numbers[key[1]]
                    if sum(map(around.__contains__, own)) < WITH_ANSWER * len(own) or key in found and found[key][1] >= CERTAIN:
                        continue
                    item = items.words[key[1]]
                    text = hashes[max(low, start[a + p] - len(item)) : min(high, end[a + p] + len(item))]
                    share, answer = check(item, text)
                    if share >= CERTAIN or share >= WITH_ANSWER and answer:
                        if key not in found or found[key][1] < share:
                            found[key] = (float(cosine[p, q]), share, answer)
            if found:
                rows = batch.column(0).take(pa.array([begin + d for d, _ in found]))
                parts = [[i for _, i in found], *zip(*found.values())]
                types = [pa.int32(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([rows, *(pa.array(x, t) for x, t in zip(parts, types))], schema.names)

    hits = docs.select(id_col, text_col).mapInArrow(run, schema)
    names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), "item int, item_id " + item_type)
    return hits.join(F.broadcast(names), "item").select(id_col, "item_id", "cosine", "overlap", "answer")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item_id, cosine, overlap, answer) for each benchmark item that a document contains.

    Passages of all documents and the items are TF-IDF vectors over the benchmark's
    words, projected to a latent space from a distributed randomised SVD. Passages
    whose cosine with an item is COSINE or more are candidates; a candidate counts if
    the longest common subsequence with the surrounding words holds CERTAIN of the
    item's words, or WITH_ANSWER of them and its answer, the last words.

    Words are runs of letters and digits, A-Z lower-cased. Null or wordless texts and
    items match nothing; repeated rows each give their rows; a null id stays null; an
    empty table gives no rows; other columns are ignored. The benchmark is taken in
    blocks of ITEMS, which bounds what the driver and the tasks hold.
    """
    item_type = benchmark.schema[item_col].dataType.simpleString()
    blocks = max(1, -(-benchmark.count() // ITEMS))
    parts = []
    for i in range(blocks):
        mine = benchmark.where(F.pmod(F.xxhash64(item_col, item_text_col), F.lit(blocks)) == i)
        rows = mine.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t")).collect()
        rows.sort(key=lambda r: (str(r.i), r.t or ""))
        items = Items.of([r.i for r in rows], [r.t for r in rows])
        if items.ids:
            parts.append(_search(docs, id_col, text_col, items, item_type))
    if not parts:
        empty = docs.select(id_col).limit(0)
        nothing = {"item_id": item_type, "cosine": "double", "overlap": "double", "answer": "boolean"}
        return empty.select(id_col, *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()))
    return reduce(DataFrame.union, parts)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    rows, number = numbered(docs)
    hits = leaks(rows, benchmark, id_col=number, text_col=text_col).select(number).distinct()
    return rows.join(hits, number, "left_anti").select(*docs.columns)


@query("op7_benchmark_leaks")
def op7(spark, folder):
    return leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))

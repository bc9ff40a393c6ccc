"""Periodic run detection by a suffix automaton whose link tree answers last-occurrence queries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import query, read
from .words import Rolling, Texts, Words, mix

#: A run of period q has at least max(LEAST, TIMES * q) words.
LEAST, TIMES = 6, 4
#: Words of the phrases whose recurrence tells where a run can be.
PHRASE = 4
SPACES = " \t\n\x0b\x0c\r"


class RunFinder:
    """Suffix automaton of a growing sequence, its link tree cut into paths of one last occurrence.

    The suffixes of the sequence are the path from the newest state to the root. All
    strings of a path segment of one colour ended last at the same place, the colour.
    :meth:`append` recolours that path: each old segment whose longest string is at
    least as long as the distance between its old and the new end is the second half
    of a square of that period, and its longest string reaches back to where the
    repetition starts. Segments are splay trees ordered by length (``access`` of a
    link-cut tree), so a word costs amortised logarithmic time at any depth.
    """

    def __init__(self):
        self.edges: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.shallow, self.deep, self.above = [-1], [-1], [-1]
        self.colour = [-1]  # of the root of a splay tree
        self.newest, self.words = 0, 0

    def _state(self, edges: dict, length: int) -> int:
        self.edges.append(edges)
        self.length.append(length)
        self.link.append(0)
        self.shallow.append(-1)
        self.deep.append(-1)
        self.above.append(-1)
        self.colour.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Make a state the root of its segment's tree; the colour goes along."""
        shallow, deep, above, colour = self.shallow, self.deep, self.above, self.colour
        while True:
            p = above[x]
            if p < 0:
                return
            left = shallow[p] == x
            if not left and deep[p] != x:
                return
            g = above[p]
            if g >= 0:
                outer = shallow[g] == p
                if outer or deep[g] == p:
                    if outer == left:  # p over g first
                        top = above[g]
                        if left:
                            mid = shallow[g] = deep[p]
                            deep[p] = g
                        else:
                            mid = deep[g] = shallow[p]
                            shallow[p] = g
                        if mid >= 0:
                            above[mid] = g
                        above[g], above[p], colour[p] = p, top, colour[g]
                        if top >= 0:
                            if shallow[top] == g:
                                shallow[top] = p
                            elif deep[top] == g:
                                deep[top] = p
                        g = top
                    # x over p, and over g in the next turn
            if left:
                mid = shallow[p] = deep[x]
                deep[x] = p
            else:
                mid = deep[p] = shallow[x]
                shallow[x] = p
            if mid >= 0:
                above[mid] = p
            above[p], above[x], colour[x] = x, g, colour[p]
            if g >= 0:
                if shallow[g] == p:
                    shallow[g] = x
                elif deep[g] == p:
                    deep[g] = x

    def _extend(self, word) -> int:
        """The state of the whole sequence with one more word."""
        edges, link, length = self.edges, self.link, self.length
        p = self.newest
        new = self._state({}, length[p] + 1)
        while p >= 0 and word not in edges[p]:
            edges[p][word] = new
            p = link[p]
        parent = 0
        if p >= 0:
            q = parent = edges[p][word]
            if length[q] != length[p] + 1:
                parent = self._state(edges[q].copy(), length[p] + 1)
                link[parent], link[q] = link[q], parent
                self._splay(q)  # the copy goes between q and what is shorter, in the same segment
                short = self.shallow[parent] = self.shallow[q]
                if short >= 0:
                    self.above[short] = parent
                self.shallow[q], self.above[parent] = parent, q
                while p >= 0 and edges[p].get(word) == q:
                    edges[p][word] = parent
                    p = link[p]
        link[new] = self.above[new] = parent
        self.newest = new
        return new

    def append(self, word) -> list[tuple[int, int]]:
        """(period, start) of the repetitions that the new word ends or goes on, of two periods at least."""
        end = self.words
        new, found = self._extend(word), []
        deep, above, colour, length = self.deep, self.above, self.colour, self.length
        x, below = above[new], new
        while x >= 0:
            self._splay(x)
            period = end - colour[x]
            if period <= length[x]:
                found.append((period, end - period - length[x] + 1))
            rest = deep[x]
            if rest >= 0:
                colour[rest] = colour[x]  # stays with the old end
            deep[x], below, x = below, x, above[x]
        colour[below] = end
        self._splay(new)
        self.words += 1
        return found


def runs_of(words: Sequence, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal repetitions of max(least, times * period) words, sorted."""
    finder, until, out = RunFinder(), {}, []
    n = len(words)
    for i, word in enumerate(words):
        for period, start in finder.append(word):
            if i <= until.get(period, -1):
                continue
            end = i + 1
            while end < n and words[end] == words[end - period]:
                end += 1
            until[period] = end - 1
            if end - start >= max(least, times * period):
                out.append((start, end - start, period))
    return sorted((a, b, c) for a, b, c in out)


def stretches(words: Words, hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """(document, from, to) of word numbers that hold every run of max(LEAST, TIMES * q) words, apart from each other.

    In such a run all phrases of PHRASE words but the first q have occurred at most q
    words before. These are at least (TIMES - 1) * q - 3 in a row, so a stretch of m
    phrases that recur bounds q by (m + 3) / (TIMES - 1); phrases last seen longer ago
    cut it. Only these stretches go through the automaton.
    """
    rolled = Rolling(hashes).every(PHRASE)
    document = words.document()
    if not len(rolled):
        return []
    at = np.flatnonzero(document[: len(rolled)] == document[PHRASE - 1 :])
    codes = rolled[at] ^ mix(document[at].astype(np.uint64) + np.uint64(1))
    ordered = np.sort(codes)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return []
    place = np.minimum(np.searchsorted(twice, codes), len(twice) - 1)
    again = twice[place] == codes
    at, place = at[again], place[again]
    order = np.lexsort((at, place))
    since = np.zeros(len(at), np.int64)
    same = place[order][1:] == place[order][:-1]
    since[order[1:]] = np.where(same, np.diff(at[order]), 0)
    at, since = at[since > 0], since[since > 0]
    while len(at):
        first = np.ones(len(at), bool)
        first[1:] = (np.diff(at) != 1) | (document[at[1:]] != document[at[:-1]])
        group = np.cumsum(first) - 1
        count = np.bincount(group)
        near = (TIMES - 1) * since <= count[group] + 3
        if near.all():
            break
        at, since = at[near], since[near]
    if not len(at):
        return []
    begin = at[first]
    doc = document[begin]
    low = np.maximum(begin - (count + 3) // (TIMES - 1) - 1, words.first[doc]) - words.first[doc]
    high = np.minimum(begin + count + PHRASE, words.first[doc + 1]) - words.first[doc]
    out: list[tuple[int, int, int]] = []
    for d, a, b in zip(doc.tolist(), low.tolist(), high.tolist()):
        if out and out[-1][0] == d and a < out[-1][2]:
            out[-1] = (d, min(a, out[-1][1]), max(b, out[-1][2]))
        else:
            out.append((d, a, b))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    keep = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        keep[start + period : start + length] = bytes(length - period)
    return [w for w, k in zip(words, keep) if k]


def collapse_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, n_words, runs, collapsed_text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` lists (start, length,
    period), by start, then period, of all maximal stretches of smallest period q (words
    q apart are equal) and at least max(6, 4 * q) words. ``collapsed_text`` joins by one
    space the words that no run contains after its first period.

    Documents are worked on where they are read, so nothing is shuffled and a lost task
    is simply run again; a task holds some documents, and about half a kilobyte for each
    word of the longest stretch in which phrases keep recurring. Null and empty texts
    have no words, no runs and an empty text; repeated rows and null ids each get their
    row; an empty table gives no rows; other columns are ignored.
    """
    run_type = "array<struct<start:long,length:long,period:long>>"
    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    zero = F.lit(0).cast("long").alias("n_words")
    schema = picked.select(id_col, zero, F.lit(None).cast(run_type).alias("runs"), F.lit("").alias("collapsed_text")).schema
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in Texts.of(batch.column(1)).pieces():
                words = texts.words()
                found: dict[int, list[tuple[int, int, int]]] = {}
                data, offsets = texts.data.tobytes(), texts.offsets.tolist()
                split = [data[a:b].split() for a, b in zip(offsets, offsets[1:])]
                for doc, low, high in stretches(words, words.hashes()):
                    runs = [(low + s, length, q) for s, length, q in runs_of(split[doc][low:high])]
                    if runs:
                        found.setdefault(doc, []).extend(runs)
                counts = words.counts()
                kept, listed = [], []
                for doc, own in enumerate(split):
                    runs = sorted(found.get(doc, ()))
                    kept.append(b" ".join(_collapsed(own, runs) if runs else own))
                    listed.append([{"start": s, "length": length, "period": q} for s, length, q in runs])
                columns = [batch.column(0)[begin:end], pa.array(counts), pa.array(listed, pa.list_(struct)), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return picked.mapInArrow(run, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """Texts of every tenth document by crc32 of the id, periodic from one of their words on."""
    bare = F.btrim(text, F.lit(SPACES))
    words = F.split(bare, r"[\x20\x09-\x0D]+")
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.concat_ws(" ", F.slice(words, F.lit(1), a), F.slice(copies, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (bare != ""), made).otherwise(text)


@query("op11_periodic_runs")
def op11(spark, folder):
    docs = read(spark, folder, "documents")
    found = collapse_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    top = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(F.col("top.length") * 1000 / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )

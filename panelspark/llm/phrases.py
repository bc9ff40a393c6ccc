"""Substring dedup by repeated-phrase automata."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .tables import query, read
from .words import Rolling, Texts, Words, minimisers

#: Words of a window, and of the phrases that are sampled from it.
WINDOW, PHRASE = 50, 16
#: Bytes of text of a shard.
SHARD = 8 << 20
LAST = (1 << 63) - 1


def phrase_starts(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word positions, hashes) of sampled phrases; every window inside a document holds one at least."""
    hashes = Rolling(hashes).every(PHRASE)
    if not len(hashes):
        return np.zeros(0, np.int64), hashes
    document = words.document()
    inside = document[: len(hashes)] == document[PHRASE - 1 :]
    # phrases over the border of two documents never are the least
    picked = minimisers(np.where(inside, hashes, np.uint64(2**64 - 1)), WINDOW - PHRASE + 1) & inside
    at = np.flatnonzero(picked)
    return at, hashes[at]


def window_starts(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word positions, hashes) of all windows."""
    rolled = Rolling(hashes).every(WINDOW)
    document = words.document()
    at = np.flatnonzero(document[: len(rolled)] == document[WINDOW - 1 :]) if len(rolled) else np.zeros(0, np.int64)
    return at, rolled[at]


class PhraseAutomaton:
    """Aho-Corasick over words: finds every occurrence of confirmed phrases in a stream of words.

    Nodes search their edges one by one, so they should have few: a word of the phrases
    is written as three digits (four if there are many words), each place with letters
    of its own, so that matches start and end with words. Other words are one letter.
    """

    OTHER = 255

    def __init__(self, phrases: np.ndarray):
        """``phrases``: one row of word hashes for each."""
        self.names = np.unique(phrases)
        self.digits = 3 if len(self.names) <= 85**3 else 4
        self.base = 255 // self.digits
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        self.empty = not len(phrases)
        if not self.empty:
            keys, length = self.letters(phrases.reshape(-1)), PHRASE * self.digits
            for i in range(0, len(keys), length):
                self.machine.add_word(keys[i : i + length])
            self.machine.make_automaton()

    def letters(self, words: np.ndarray) -> str:
        at = np.minimum(np.searchsorted(self.names, words), len(self.names) - 1)
        out = np.full((len(words), self.digits), self.OTHER, np.uint8)
        known, number = self.names[at] == words, at
        for place in range(self.digits):
            out[known, place] = number[known] % self.base + place * self.base
            number = number // self.base
        return out.tobytes().decode("latin-1")

    def occurrences(self, words: np.ndarray) -> np.ndarray:
        """Where phrases start."""
        if self.empty:
            return np.zeros(0, np.int64)
        found = np.fromiter((end for end, _ in self.machine.iter(self.letters(words))), np.int64)
        return (found + 1) // self.digits - PHRASE


def shards(docs: DataFrame, id_col: str, text_col: str, size_of_shard: int, *others: Column) -> DataFrame:
    """(shard, rank, id, text, others); rank is the id, the largest number for a null one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    number = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(-(-size // size_of_shard) or 1)).cast("int")
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    return docs.select(number.alias("shard"), rank.alias("rank"), F.col(id_col).alias("id"), text.alias("text"), *others)


def _recurring(sharded: DataFrame) -> DataFrame:
    """(shard, hash) of sampled phrases that stand in documents of different ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, rank = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for begin, _, texts in Texts.of(batch.column(2)).pieces():
                words = texts.words()
                at, hashes = phrase_starts(words, words.hashes())
                doc = begin + np.searchsorted(words.first, at, "right") - 1
                order = np.lexsort((doc, hashes))
                hashes, doc = hashes[order], doc[order]
                new = np.ones(len(doc), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
                columns = (hashes[new].view(np.int64), shard[doc[new]], rank[doc[new]])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", "shard", "rank"])

    seen = sharded.select("shard", "rank", "text").mapInArrow(run, "hash long, shard int, rank long")
    seen = stored(seen, "phrases")
    again = seen.groupBy("hash").agg(F.min("rank").alias("a"), F.max("rank").alias("b")).where("a < b").select("hash")
    return seen.join(again, "hash").select("shard", "hash").distinct()


def _candidates(sharded: DataFrame, phrases: DataFrame) -> DataFrame:
    """(hash, shard, rank): windows that hold a confirmed phrase, once for each shard with its smallest document."""

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        known = np.sort(found.column("hash").to_numpy().view(np.uint64))
        rank, hashes, ranks = texts.column("rank").to_numpy(), [], []
        pieces, phrases, named = [], [], []
        for begin, _, piece in Texts.of(texts.column("text")).pieces():
            words = piece.words()
            word = words.hashes()
            at, phrase = phrase_starts(words, word)
            mine = np.isin(phrase, known)
            phrase, first = np.unique(phrase[mine], return_index=True)
            phrases.append(word[at[mine][first][:, None] + np.arange(PHRASE)])
            named.append(phrase)
            pieces.append((begin, words, word))
        if pieces:
            _, first = np.unique(np.concatenate(named), return_index=True)
            automaton = PhraseAutomaton(np.concatenate(phrases)[first])
            for begin, words, word in pieces:
                marks = np.zeros(len(word) + 1, np.int64)
                at = automaton.occurrences(word)
                np.add.at(marks, at, 1)
                total = np.concatenate([[0], np.cumsum(marks)])
                start, window = window_starts(words, word)
                holds = total[start + WINDOW - PHRASE + 1] > total[start]
                start, window = start[holds], window[holds]
                hashes.append(window)
                ranks.append(rank[begin + np.searchsorted(words.first, start, "right") - 1])
        hash_, rank_ = least_rank(hashes, ranks)
        shard = np.full(len(hash_), texts.column("shard")[0].as_py() if texts.num_rows else 0, np.int32)
        return pa.table({"hash": hash_.view(np.int64), "shard": shard, "rank": rank_})

    pairs = sharded.select("shard", "rank", "text").groupBy("shard").cogroup(phrases.groupBy("shard"))
    return pairs.applyInArrow(run, "hash long, shard int, rank long")


def least_rank(hashes: list[np.ndarray], ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes with the smallest rank of each."""
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hash_, rank = np.concatenate(hashes), np.concatenate(ranks)
    order = np.lexsort((rank, hash_))
    hash_, rank = hash_[order], rank[order]
    first = np.ones(len(hash_), bool)
    first[1:] = hash_[1:] != hash_[:-1]
    return hash_[first], rank[first]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, n_words, n_removed, kept_sha256, kept_text.

    A word is removed if a window of 50 words covers it whose sequence also starts in
    a document with a smaller id. Windows are judged on the input. Phrases of 16 words
    are sampled so that each window holds one; those in documents of different ids are
    confirmed as recurring. Each shard of documents compiles its confirmed phrases into
    an automaton and streams all its texts through it; windows around the occurrences
    are the candidates. A candidate leaves its shard once, with the shard's smallest
    document. If a smaller one has it elsewhere, the shard removes all of its own;
    otherwise all but those of its smallest document.

    Sequences are compared by 64-bit hashes. A null text has no words; a null id counts
    as the largest; rows with one id never remove each other's words; an empty table
    gives no rows; other columns are ignored.
    """
    sharded = shards(docs, id_col, text_col, SHARD)
    phrases = _recurring(sharded)
    candidates = stored(_candidates(sharded, phrases), "windows")
    least = F.min("rank").over(Window.partitionBy("hash"))  # a hash has a row for each shard at most
    elsewhere = candidates.withColumn("least", least).where("least < rank").select("shard", "hash")
    answer = docs.select(F.col(id_col).alias("id")).schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string"), ("kept_text", "string")):
        answer = answer.add(name, kind)

    def clean(texts: pa.Table, found: pa.Table) -> pa.Table:
        gone = np.sort(found.column("hash").to_numpy().view(np.uint64))
        rank, hashes, ranks, pieces = texts.column("rank").to_numpy(), [], [], []
        for begin, _, piece in Texts.of(texts.column("text")).pieces():
            words = piece.words()
            start, window = window_starts(words, words.hashes())
            mine = rank[begin + np.searchsorted(words.first, start, "right") - 1]
            pieces.append((words, start, window, mine))
            hashes.append(window)
            ranks.append(mine)
        known, smallest = least_rank(hashes, ranks)
        counts, removed, digests, kept = [], [], [], []
        for words, start, window, mine in pieces:
            drop = np.isin(window, gone)
            drop |= mine > smallest[np.searchsorted(known, window)]
            edge = np.zeros(len(words) + 1, np.int64)
            edge[start[drop]] += 1
            edge[start[drop] + WINDOW] -= 1
            keep = np.cumsum(edge)[:-1] == 0
            for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                text = words.texts.data[words.texts.offsets[i] : words.texts.offsets[i + 1]].tobytes().split()
                left = b" ".join(compress(text, keep[a:b].tolist()))
                counts.append(b - a)
                removed.append(int((b - a) - keep[a:b].sum()))
                digests.append(sha256(left).hexdigest())
                kept.append(left)
        columns = [texts.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.Table.from_arrays(columns, answer.names)

    pairs = sharded.groupBy("shard").cogroup(elsewhere.groupBy("shard"))
    return pairs.applyInArrow(clean, answer).withColumnRenamed("id", id_col)


@query("op3_repeated_phrases")
def op3(spark, folder):
    return remove_repeats(read(spark, folder, "documents")).drop("kept_text")

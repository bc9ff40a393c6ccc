"""Language-model scores: the likelihood of a text over all its segmentations into subwords."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_dir, stored
from .tables import query, read
from .words import BASE, Texts, Words, mix

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text of a chunk; its distinct words are looked up together.
CHUNK = 16 << 20
#: Share of the byte pieces, which cover what no other piece does.
BYTE_SHARE = 1e-3
#: How many observations the vocabulary's own scores count as.
PRIOR = 10_000.0
MARK = "▁"


class PieceTable:
    """Finds pieces by the polynomial hash of their letters, many at a time.

    Slots take one piece each; pieces that find theirs taken go to a further table.
    A bit for each slot of all beginnings of pieces tells where longer ones may follow.
    """

    BITS = 18
    #: Bits of the slots of beginnings; a slot taken by chance costs a search, never a result.
    BEGINNINGS = 22

    def __init__(self, pieces: list[str]):
        codes, begun = np.zeros(len(pieces), np.uint64), set()
        for i, piece in enumerate(pieces):
            code = 0
            for letter in piece:
                begun.add(code)
                code = (code * int(BASE) + ord(letter) + 1) % 2**64
            codes[i] = code
        self.begun = np.zeros(1 << self.BEGINNINGS, bool)
        self.begun[self._beginning(np.array(sorted(begun), np.uint64))] = True
        self.tables, left = [], np.arange(len(pieces))
        while len(left):
            slot, first = np.unique(self.slot(codes[left]), return_index=True)
            code, piece = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32)
            code[slot], piece[slot] = codes[left[first]], left[first]
            self.tables.append((code, piece))
            left = np.delete(left, first)

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return (mix(codes) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def _beginning(self, codes: np.ndarray) -> np.ndarray:
        return (mix(codes) >> np.uint64(64 - self.BEGINNINGS)).astype(np.int64)

    def longer(self, codes: np.ndarray) -> np.ndarray:
        """Whether a piece may go on after each hash."""
        return self.begun[self._beginning(codes)]

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 where there is none."""
        slot, found = self.slot(codes), np.full(len(codes), -1, np.int32)
        for code, piece in self.tables:
            found = np.where(code[slot] == codes, piece[slot], found)
        return found


class Vocabulary:
    """The pieces of an existing subword vocabulary and their log probabilities.

    A piece with the word mark stands at the start of a word. Scores of a merge
    vocabulary are ranks and become probabilities by Zipf's law; scores of a unigram
    vocabulary are log probabilities already.
    """

    def __init__(self, pieces: list[str], scores: list[float]):
        ranks = all(float(s).is_integer() for s in scores)
        self.table = None  # built where it is used, so that it is never sent
        weight = np.array([1 / (2 - s) if ranks else math.exp(s) for s in scores])
        self.pieces = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.prior = np.append(weight / weight.sum(), 0) if pieces else np.zeros(1)
        self.prior[-1] = np.median(self.prior[:-1]) if pieces else 1  # the end of a text
        self.learn(np.zeros(len(self.prior)))

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        ids = [i for i in ids if MARK not in model.id_to_piece(i)[1:]]
        return cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids])

    def learn(self, counts: np.ndarray) -> None:
        """Probabilities from expected counts and the prior; they and the byte pieces add up to one."""
        share = counts + PRIOR * self.prior
        self.log = np.log(share / share.sum() * (1 - BYTE_SHARE))
        self.log_byte = math.log(BYTE_SHARE / 256)

    def edges(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """For words of one length with the mark: (start, end, which words, piece or -1, log probability)."""
        if self.table is None:
            self.table = PieceTable(list(self.pieces))
        length = len(words[0])
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), length)
        size = 1 + (letters >= 0x80) + (letters >= 0x800) + (letters >= 0x10000)  # bytes of UTF-8
        for start in range(length):
            at, code = np.arange(len(words)), np.zeros(len(words), np.uint64)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                code = code * BASE + letters[at, end - 1] + np.uint64(1)
                piece = self.table.find(code)
                if end == start + 1:
                    value = np.where(piece >= 0, self.log[piece], -np.inf)
                    yield start, end, at, piece, np.logaddexp(value, size[:, start] * self.log_byte)
                else:
                    found = piece >= 0
                    if found.any():
                        yield start, end, at[found], piece[found], self.log[piece[found]]
                more = self.table.longer(code)
                at, code = at[more], code[more]
                if not len(at):
                    break

    def forward(self, words: list[str]) -> tuple[np.ndarray, list]:
        """Log-space forward recursion over all segmentations: log sums (words, positions), and the edges."""
        out = np.full((len(words), len(words[0]) + 1), -np.inf)
        out[:, 0] = 0
        edges = []
        for edge in self.edges(words):  # by start, so what ends there is complete
            start, end, at, _, value = edge
            out[at, end] = np.logaddexp(out[at, end], out[at, start] + value)
            edges.append(edge)
        return out, edges

    def log_likelihood(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's probability, over all segmentations."""
        out = np.empty(len(words))
        for at in by_length(words):
            out[at] = self.forward([MARK + words[i] for i in at])[0][:, -1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece is used in the words, each segmentation weighted by its probability."""
        total = np.zeros(len(self.log))
        for at in by_length(words):
            alpha, edges = self.forward([MARK + words[i] for i in at])
            beta = np.full_like(alpha, -np.inf)
            beta[:, -1] = 0
            for start, end, which, _, value in reversed(edges):
                beta[which, start] = np.logaddexp(beta[which, start], value + beta[which, end])
            for start, end, which, piece, _ in edges:
                known = piece >= 0
                which, piece = which[known], piece[known]
                use = alpha[which, start] + self.log[piece] + beta[which, end] - alpha[which, -1]
                total += np.bincount(piece, np.exp(use) * counts[at][which], minlength=len(total))
        return total


def by_length(words: list[str], most: int = 4096) -> Iterator[list[int]]:
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    for at in groups.values():
        for a in range(0, len(at), most):
            yield at[a : a + most]


def distinct(words: Words) -> tuple[list[str], np.ndarray]:
    """(distinct words, for each word which one it is)."""
    _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    raw = words.texts.data.tobytes()
    return [raw[a:b].decode() for a, b in zip(words.start[first].tolist(), words.end[first].tolist())], which


def _chunks(docs: DataFrame, id_col: str, text_col: str, held_out) -> DataFrame:
    """(chunk, id, held_out, text): each task numbers runs of documents of about CHUNK bytes.

    It is stored, since both passes must see the same chunks.
    """
    picked = docs.select(F.col(id_col), held_out.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = picked.withColumn("chunk", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, used = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            size = np.diff(Texts.of(batch.column(2)).offsets)
            number = chunk + (used + np.cumsum(size)) // CHUNK
            used += int(size.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number)], schema.names)

    path = fresh_dir(docs.sparkSession, "chunks")
    picked.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _chunk_words(chunks: DataFrame) -> DataFrame:
    """(chunk, word, n): the distinct words of each chunk, and how often its training documents have them.

    A chunk that two tasks read in parts may have a word twice; its counts add up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = defaultdict(int)
        last = None

        def rows() -> pa.RecordBatch:
            columns = [pa.array(np.full(len(total), last)), pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "word", "n"])

        for batch in batches:
            chunk, held = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for number in np.unique(chunk):
                if last is not None and number != last:
                    yield rows()
                    total.clear()
                last = number
                at = np.flatnonzero(chunk == number)
                for begin, _, texts in Texts.of(batch.column(2).take(pa.array(at))).pieces():
                    words = texts.lower().words()
                    names, which = distinct(words)
                    training = ~held[at[begin + words.document()]]
                    for name, n in zip(names, np.bincount(which, training, len(names)).astype(np.int64).tolist()):
                        total[name] += n
        if last is not None:
            yield rows()

    return chunks.select("chunk", "held_out", "text").mapInArrow(run, "chunk long, word string, n long")


def score(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | Vocabulary = VOCABULARY,
    folds: int = 7,
    held_fold: int = 2,
    rounds: int = 2,
) -> DataFrame:
    """One row for each document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words (A-Z lower-cased) and one end. Documents whose crc32(id as text)
    modulo ``folds`` is ``held_fold`` are held out; the others train. ``base_score`` is
    the log10 probability under add-one word counts. ``score`` is that of the model: a
    word's probability is c / (N + V) + V / (N + V) * L, with its count c, all N
    training tokens, V distinct ones (Witten and Bell's weights), and L the sum over
    all segmentations into the pieces of an existing vocabulary. The pieces' scores
    are the vocabulary's own, adapted to the training words by ``rounds`` of expected
    counts. Pieces do not cross words, so a text's sum is the product of its words'.

    Distinct words meet in shuffles: counts are summed by word, each word's lattice is
    computed once, and each chunk of documents gets back the words it asked for. The
    driver holds only counts of the vocabulary's pieces and two totals.

    A null text is empty and has the end alone; a null id trains; repeated rows count
    as often as they stand there; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    model = vocabulary if isinstance(vocabulary, Vocabulary) else Vocabulary.load(vocabulary)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == held_fold, F.lit(False))
    chunks = _chunks(docs, id_col, text_col, held)
    asked = stored(_chunk_words(chunks.select("chunk", "held_out", "text")), "asked")
    counts = stored(asked.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = chunks.agg(F.count_if(~F.col("held_out")).alias("n")).first().n
    n, v = totals.n + ends, totals.v + (ends > 0)

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value.log))
            for batch in batches:
                total += shared.value.expected(batch.column(0).to_pylist(), batch.column(1).to_numpy())
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])

        used = counts.where("c > 0").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        expected = np.zeros(len(model.log))
        for row in used.collect():  # at most one row for each piece of the vocabulary
            expected[row.piece] = row.n
        expected[-1] = ends
        model.learn(expected)
    shared = spark.sparkContext.broadcast(model)
    known, new = (1.0, float(v)) if n + v else (0.0, 1.0)
    all_ = float(n + v) or 1.0

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lattice = shared.value.log_likelihood(batch.column(0).to_pylist())
            c = batch.column(1).to_numpy()
            with np.errstate(divide="ignore"):
                log = np.logaddexp(np.log(known * c / all_), np.log(new / all_) + lattice) / math.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(log)], ["word", "c", "log"])

    weighed = counts.mapInArrow(weigh, "word string, c long, log double")
    answers = asked.select("chunk", "word").join(weighed, "word").select("chunk", "word", "c", "log")
    end_log = float(np.logaddexp(math.log(known * ends / all_) if ends else -math.inf, math.log(new / all_) + model.log[-1])) / math.log(10)
    base = math.log10(n + v + 1)
    end_base = math.log10(ends + 1) - base
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    extra = {"n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double"}
    schema = chunks.select(id_col, "held_out", *(F.lit(None).cast(t).alias(c) for c, t in extra.items())).schema

    def judge(texts: pa.Table, found: pa.Table) -> pa.Table:
        at = {w: i for i, w in enumerate(found.column("word").to_pylist())}
        count, log = found.column("c").to_numpy(), found.column("log").to_numpy()
        sums = []
        for _, _, piece in Texts.of(texts.column("text")).pieces():
            words = piece.lower().words()
            unique, which = distinct(words)
            index = np.array([at[w] for w in unique], np.int64)[which]
            doc, size = words.document(), len(piece)
            own = count[index]
            values = (own > 0, np.log10(own + 1) - base, log[index])
            sums.append([words.counts(), *(np.bincount(doc, x, size) for x in values)])
        words, seen, plain, full = (np.concatenate(x) for x in zip(*sums))
        columns = [
            texts.column(id_col), texts.column("held_out"),
            pa.array(words + 1), pa.array(seen.astype(np.int64) + (ends > 0)), pa.array(np.full(len(words), n)),
            pa.array(plain + end_base), pa.array(full + end_log),
        ]
        return pa.Table.from_arrays(columns, names)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(judge, schema)


@query("op8_subword_likelihood")
def op8(spark, folder):
    return score(read(spark, folder, "documents"))

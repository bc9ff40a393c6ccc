"""Suffix-array dedup: Burrows-Wheeler transforms of shards, merged by interleave refinement."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .tables import query, read
from .phrases import shards
from .words import Rolling, Texts, sliding_min

#: Bytes of a string that must not repeat, and of the anchors sampled from it.
STRING, ANCHOR = 400, 128
#: Bytes of text of a shard, and of text for each bucket of anchors.
SHARD, BUCKET = 8 << 20, 4 << 20
#: Contexts of an anchor that go to one bucket; strings of more frequent anchors are spread by their hash.
CROWD = 4096
#: A phrase ends after bytes whose hash has these bits clear; its end depends on so many bytes before it.
PHRASE_MASK, LOOK = np.uint64(15), 8


def _bytes_hash(data: np.ndarray) -> Rolling:
    return Rolling(data.astype(np.uint64) + np.uint64(1))


@dataclass
class Contexts:
    """Runs of neighbouring string starts that have the same anchor.

    A string's anchor is its leftmost part of the given length with the least hash, so equal
    strings have equal anchors at equal distances. A context is the text of all
    strings of a run; each string start of a document lies in exactly one.
    """

    first: np.ndarray  # first string start
    starts: np.ndarray  # how many
    anchor: np.ndarray  # hash of the anchor
    key: np.ndarray  # hash of the text
    rolling: Rolling

    @classmethod
    def of(cls, texts: Texts, string: int, anchor: int) -> Contexts:
        rolling = _bytes_hash(texts.data)
        hashes = rolling.every(anchor)
        width = string - anchor + 1
        none = np.zeros(0, np.int64)
        if len(hashes) < width:
            return cls(none, none, none.view(np.uint64), none.view(np.uint64), rolling)
        low = np.uint64(0xFFFFFFFF)
        place = (sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), width) & low).astype(np.int64)
        doc = np.searchsorted(texts.offsets, np.arange(len(place)), "right")
        valid = np.arange(len(place)) + string <= texts.offsets[np.minimum(doc, len(texts))]
        at = np.flatnonzero(valid)
        if not len(at):
            return cls(none, none, none.view(np.uint64), none.view(np.uint64), rolling)
        new = np.ones(len(at), bool)
        new[1:] = (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        starts = np.diff(np.append(head, len(at)))
        first = at[head]
        return cls(first, starts, hashes[place[first]], rolling.of(first, first + starts - 1 + string), rolling)


def ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each run, one after the other."""
    return np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(first, length)


def suffix_order(symbols: np.ndarray, string: np.ndarray) -> np.ndarray:
    """Suffix array of strings that each end in a 0; ends differ and sort by string. Prefix doubling."""
    n = len(symbols)
    rank, step = np.where(symbols == 0, string, symbols + n).astype(np.int64), 1
    while True:
        second = rank[np.minimum(np.arange(n) + step, n - 1)]  # past an end nothing is left to decide
        both = rank * (int(rank.max()) + 1) + second
        order = np.argsort(both)
        both = both[order]
        new = np.r_[False, both[1:] != both[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


def transform(symbols: np.ndarray, string: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The symbol before each suffix in order; a string's first suffix has its final 0 before it."""
    return np.where((order > 0) & (string[order - 1] == string[order]), symbols[order - 1], 0)


def deal(values: np.ndarray) -> np.ndarray:
    """Stable order by values below 2**32: two passes of counting, by the lower and the upper half."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    upper = (values >> 16).astype(np.uint16)
    return order[np.argsort(upper[order], kind="stable")] if upper.any() else order


def merge(transforms: list[np.ndarray], ends: list[int], most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merge the transforms of shards: (shard of each merged suffix, symbols it shares with the one before).

    The interleave says from which shard each merged suffix comes. It starts unsorted;
    each pass deals the shards out again by the symbols before their suffixes, which
    sorts by one symbol more, until no block of equal prefixes splits. When a block
    first splits is the length of the common prefix. No suffix is sorted again: only
    counts of symbols are used, and each shard keeps its order. ``ends`` has the number
    of strings of each shard; their ends sort first, by shard and string. Prefixes are
    followed up to ``most`` symbols; with longer ones the order of equal ones is open.
    """
    interleave = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms])
    symbols = np.concatenate(transforms)
    n, total_ends = len(symbols), sum(ends)
    block = np.zeros(n, np.int64)
    common = np.full(n, -1)
    common[:1] = 0
    length = 0
    while True:
        # the k-th suffix of a shard in the interleave is the k-th of its transform
        before = np.empty(n, symbols.dtype)
        before[deal(interleave)] = symbols
        order = deal(before)
        dealt, source, previous = before[order], interleave[order], block[order]
        # suffixes that are an end alone keep their order by shard, and differ from each other
        source[:total_ends] = np.repeat(np.arange(len(transforms)), ends)
        new = np.ones(n, bool)
        new[1:] = (dealt[1:] != dealt[:-1]) | (previous[1:] != previous[:-1])
        new[:total_ends] = True
        split = new & (common < 0)
        common[split] = length
        fresh = np.cumsum(new)
        length += 1
        if length == most or not split.any() and np.array_equal(source, interleave) and np.array_equal(fresh, block):
            common[common < 0] = length
            return source, common
        interleave, block = source, fresh


def repeated_starts(texts: Texts, starts: np.ndarray, counts: np.ndarray, shard: np.ndarray, string: int = STRING) -> np.ndarray:
    """For each string start of the contexts (one text each, one after the other): does its string repeat?

    Contexts are cut into phrases where their content says so. Each shard's phrase
    sequences have their transform; merging these gives each phrase start the longest
    phrase prefix that it shares with another one. Only strings whose phrases all lie
    in such a prefix can repeat; these are compared by hash.
    """
    many = np.repeat(counts, starts)
    rolling = _bytes_hash(texts.data)
    look = rolling.every(LOOK)
    begin = texts.offsets[:-1]
    cut = np.flatnonzero((look & PHRASE_MASK) == 0) + LOOK
    context = np.searchsorted(texts.offsets, cut - LOOK, "right") - 1
    inside = cut <= texts.offsets[context + 1]  # a cut at the end closes the last phrase
    cut, context = cut[inside], context[inside]  # positions where a phrase starts
    shared = np.zeros(len(cut), np.int64)
    if len(cut):
        follows = np.r_[context[1:] == context[:-1], False]
        phrase = rolling.of(cut, np.where(follows, np.r_[cut[1:], 0], cut))
        number = np.unique(phrase, return_inverse=True)[1].astype(np.int64) + 1
        symbols = np.where(follows, number, 0)  # the last cut of a context ends its sequence
    place = ragged(begin, starts)
    left = np.searchsorted(cut, place + LOOK)  # the first cut that the string determines
    right = np.searchsorted(cut, place + string, "right") - 1
    if len(cut):
        shared = shared_phrases(symbols, context, shard, max(1, int((right - left).max(initial=1))))
    near = (right <= left) | (left >= len(cut))
    near |= shared[np.minimum(left, max(0, len(cut) - 1))] >= right - left if len(cut) else True
    near |= many > 1
    out = many > 1
    at = np.flatnonzero(near)
    key = rolling.of(place[at], place[at] + string)
    _, which = np.unique(key, return_inverse=True)
    out[at] = np.bincount(which, many[at])[which] > 1 if len(at) else False
    return out


def shared_phrases(symbols: np.ndarray, context: np.ndarray, shard: np.ndarray, most: int) -> np.ndarray:
    """For each symbol of the contexts' sequences: the longest run from it on, up to ``most``, that also starts elsewhere."""
    transforms, places, ends = [], [], []
    for s in np.unique(shard[context]):
        mine = np.flatnonzero(shard[context] == s)
        names, local = np.unique(context[mine], return_inverse=True)
        order = suffix_order(symbols[mine], local)
        transforms.append(transform(symbols[mine], local, order))
        places.append(mine[order])
        ends.append(len(names))
    interleave, common = merge(transforms, ends, most)
    merged = np.empty(len(symbols), np.int64)
    merged[deal(interleave)] = np.concatenate(places)
    out = np.empty(len(symbols), np.int64)
    out[merged] = np.maximum(common, np.append(common[1:], 0))
    return out


def _anchors(sharded: DataFrame, string: int, anchor: int) -> DataFrame:
    """(shard, anchor, hot) of anchors with several contexts in all documents; hot ones have more than CROWD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column(0).to_numpy()
            for begin, _, texts in Texts.of(batch.column(1)).pieces():
                found = Contexts.of(texts, string, anchor)
                mine = shard[begin + np.searchsorted(texts.offsets, found.first, "right") - 1]
                order = np.lexsort((mine, found.anchor))
                code, mine, starts = found.anchor[order], mine[order], found.starts[order]
                head = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (mine[1:] != mine[:-1])]) if len(mine) else np.zeros(0, np.int64)
                count = np.diff(np.append(head, len(mine)))
                yield pa.RecordBatch.from_arrays([pa.array(code[head].view(np.int64)), pa.array(mine[head]), pa.array(count)], ["anchor", "shard", "n"])

    seen = stored(sharded.select("shard", "text").mapInArrow(run, "anchor long, shard int, n long"), "anchors")
    again = seen.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", (F.col("n") > CROWD).alias("hot"))
    return stored(seen.join(again, "anchor").select("shard", "anchor", "hot").distinct(), "anchors")


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each distinct key, how often it is there)."""
    _, first, count = np.unique(keys, return_index=True, return_counts=True)
    return first, count


def _contexts(sharded: DataFrame, anchors: DataFrame, buckets: int, string: int, anchor_bytes: int) -> DataFrame:
    """(bucket, shard, key, n, starts, text): distinct contexts of each shard that may hold repeats.

    Contexts with one anchor meet in one bucket. If its anchor is hot, each string of a
    context goes by the hash of the string instead, without text.
    """
    schema = "bucket int, shard int, key long, n long, starts long, text binary"
    names = ["bucket", "shard", "key", "n", "starts", "text"]

    def run(texts: pa.Table, found: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor, hot = found.column("anchor").to_numpy().view(np.uint64), found.column("hot").to_numpy().astype(bool)
        order = np.argsort(anchor)
        anchor, hot = anchor[order], hot[order]
        if not len(anchor) or not texts.num_rows:
            return
        shard, total, strings = texts.column("shard")[0].as_py(), {}, []
        for _, _, piece in Texts.of(texts.column("text")).pieces():
            own = Contexts.of(piece, string, anchor_bytes)
            at = np.minimum(np.searchsorted(anchor, own.anchor), len(anchor) - 1)
            known = anchor[at] == own.anchor
            few, many = np.flatnonzero(known & ~hot[at]), np.flatnonzero(known & hot[at])
            raw = piece.data.tobytes()
            first, count = _unique(own.key[few])
            for i, n in zip(few[first].tolist(), count.tolist()):
                key = int(own.key[i])
                if key in total:
                    total[key][1] += n
                else:
                    a, size = int(own.first[i]), int(own.starts[i])
                    total[key] = [int(own.anchor[i] % np.uint64(buckets)), n, size, raw[a : a + size - 1 + string]]
            place = ragged(own.first[many], own.starts[many])
            strings.append(own.rolling.of(place, place + string))
        columns = list(zip(*total.values())) if total else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([
            pa.array(columns[0], pa.int32()), pa.array([shard] * len(total), pa.int32()), pa.array(np.array(list(total), np.uint64).view(np.int64)),
            pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()),
        ], names)
        keys = np.concatenate(strings)
        first, count = _unique(keys)
        keys = keys[first]
        yield pa.RecordBatch.from_arrays([
            pa.array((keys % np.uint64(buckets)).astype(np.int32)), pa.array(np.full(len(keys), shard, np.int32)), pa.array(keys.view(np.int64)),
            pa.array(count), pa.array(np.ones(len(keys), np.int64)), pa.nulls(len(keys), pa.binary()),
        ], names)

    def whole(texts: pa.Table, found: pa.Table) -> pa.Table:
        parts = list(run(texts, found))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.Table.from_batches(parts) if parts else pa.schema(list(zip(names, kinds))).empty_table()

    pairs = sharded.select("shard", "text").groupBy("shard").cogroup(anchors.groupBy("shard"))
    return pairs.applyInArrow(whole, schema)


def _repeats(contexts: DataFrame, string: int) -> DataFrame:
    """(shard, key, low, high): the string starts low to high of a context repeat; low is -1 for a string by itself."""

    def run(group: pa.Table) -> pa.Table:
        alone = group.column("text").is_null().to_numpy()
        shard, key, n = (group.column(c).to_numpy() for c in ("shard", "key", "n"))
        _, which = np.unique(key[alone], return_inverse=True)
        again = np.bincount(which, n[alone])[which] > 1 if alone.any() else np.zeros(0, bool)
        out = [(shard[alone][again], key[alone][again], np.full(again.sum(), -1), np.full(again.sum(), -1))]
        table = group.filter(pa.array(~alone))
        if table.num_rows:
            # one context for each key; its count is that of all shards
            _, first, same = np.unique(key[~alone], return_index=True, return_inverse=True)
            many, senders = np.bincount(same, n[~alone]).astype(np.int64), np.argsort(same, kind="stable")
            sent = np.searchsorted(same[senders], np.arange(len(first) + 1))
            senders = shard[~alone][senders]
            table = table.take(pa.array(first))
            binary = table.column("text").combine_chunks().cast(pa.large_binary())
            data = np.frombuffer(binary.buffers()[2], np.uint8)
            offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
            texts = Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])
            starts = table.column("starts").to_numpy()
            bad = repeated_starts(texts, starts, many, shard[~alone][first], string)
            context = np.repeat(np.arange(len(starts)), starts)
            within = ragged(np.zeros(len(starts), np.int64), starts)
            edge = bad & np.r_[True, ~bad[:-1] | (context[1:] != context[:-1])]
            close = bad & np.r_[~bad[1:] | (context[1:] != context[:-1]), True]
            of = context[edge]
            each = sent[of + 1] - sent[of]  # every shard that sent the context gets the answer
            to = senders[ragged(sent[of], each)]
            out.append((to, *(np.repeat(x, each) for x in (key[~alone][first][of], within[edge], within[close]))))
        columns = [np.concatenate(c) for c in zip(*out)]
        kinds = [np.int32, np.int64, np.int64, np.int64]
        return pa.Table.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds)], ["shard", "key", "low", "high"])

    return contexts.groupBy("bucket").applyInArrow(run, "shard int, key long, low long, high long")


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), string: int = STRING, anchor: int = ANCHOR
) -> DataFrame:
    """One row for each document: id, n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    A byte is removed if a string of ``string`` bytes covers it that also starts anywhere
    else, in the same document too; strings are judged on the input, and do not cross
    documents. Strings whose anchor, a sampled part, stands in one place only cannot
    repeat. The others meet, with their context, in the bucket of their anchor, where
    :func:`repeated_starts` merges the transforms of the shards they come from. Shards
    send equal contexts once, with a count. Strings of anchors with more than CROWD
    contexts are spread by their own hash and counted.

    Strings are told apart by 64-bit hashes at last. Null texts are empty; a null id
    keeps its row; repeated rows are copies like others; an empty table gives no rows;
    other columns come along in the struct ``rest`` if ``carry`` names them. The hash is
    that of the kept bytes; ``kept_text`` leaves out bytes of a letter that is cut apart.
    """
    rest = F.struct(F.isnull(text_col).alias("no_text"), F.struct(*carry).alias("carried")).alias("rest")
    sharded = shards(docs, id_col, text_col, SHARD, rest).select("shard", "id", "text", "rest")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    plain = sharded.select("shard", "text")
    anchors = _anchors(plain, string, anchor)
    repeats = _repeats(_contexts(plain, anchors, -(-size // BUCKET) or 1, string, anchor), string)
    hot = anchors.where("hot").select("shard", F.col("anchor").alias("key"), F.lit(-2).cast("long").alias("low"), F.lit(-2).cast("long").alias("high"))
    found = repeats.union(hot)
    answer = docs.select(F.col(id_col).alias("id")).schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept_text", "string")):
        answer = answer.add(name, kind)
    answer = answer.add(sharded.schema["rest"])

    def clean(texts: pa.Table, found: pa.Table) -> pa.Table:
        key, low, high = found.column("key").to_numpy().view(np.uint64), found.column("low").to_numpy(), found.column("high").to_numpy()
        hot, alone, runs = np.sort(key[low == -2]), np.sort(key[low == -1]), np.flatnonzero(low >= 0)
        runs = runs[np.argsort(key[runs], kind="stable")]
        key, low, high = key[runs], low[runs], high[runs]
        out = [[], [], [], [], []]
        for _, _, piece in Texts.of(texts.column("text")).pieces():
            own = Contexts.of(piece, string, anchor)
            edge = np.zeros(len(piece.data) + 1, np.int64)
            a, b = np.searchsorted(key, own.key), np.searchsorted(key, own.key, "right")
            which, run = np.repeat(np.arange(len(a)), b - a), ragged(a, b - a)
            np.add.at(edge, own.first[which] + low[run], 1)
            np.add.at(edge, own.first[which] + high[run] + string, -1)
            crowded = np.flatnonzero(np.isin(own.anchor, hot)) if len(hot) else np.zeros(0, np.int64)
            place = ragged(own.first[crowded], own.starts[crowded])
            place = place[np.isin(own.rolling.of(place, place + string), alone)]
            edge[place] += 1
            edge[place + string] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            head = gone & np.r_[True, ~gone[:-1]] if len(gone) else gone
            head[piece.offsets[:-1][piece.offsets[:-1] < len(gone)]] |= gone[piece.offsets[:-1][piece.offsets[:-1] < len(gone)]]
            removed, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, head))
            out[0].append(np.diff(piece.offsets))
            out[1].append(np.diff(removed[piece.offsets]))
            out[2].append(np.diff(spans[piece.offsets]))
            for i, j in zip(piece.offsets[:-1].tolist(), piece.offsets[1:].tolist()):
                left = piece.data[i:j][~gone[i:j]].tobytes()
                out[3].append(sha256(left).hexdigest())
                out[4].append(left.decode("utf-8", "ignore"))
        numbers = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out[:3]]
        return pa.Table.from_arrays([texts.column("id"), *numbers, pa.array(out[3], pa.string()), pa.array(out[4], pa.string()), texts.column("rest")], answer.names)

    pairs = sharded.groupBy("shard").cogroup(found.groupBy("shard"))
    return pairs.applyInArrow(clean, answer).withColumnRenamed("id", id_col)


def strip_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
    string: int = STRING,
    anchor: int = ANCHOR,
) -> DataFrame:
    """The documents, all of them, with repeated strings cut out of the text; ``chars_col``, if there, counts what is left.

    Bytes of a letter of which only a part is cut are left out. A null text stays null. Ids
    spread documents over shards, whatever ids are null or repeated.
    """
    others = [c for c in docs.columns if c != text_col]
    cut = remove_repeats(docs, id_col=id_col, text_col=text_col, carry=others, string=string, anchor=anchor)
    changed, carried = F.col("n_removed") > 0, F.col("rest.carried")
    out = {c: carried[c] for c in others}
    out[text_col] = F.when(~F.col("rest.no_text"), F.col("kept_text"))
    if chars_col in others:
        out[chars_col] = F.when(changed, F.length("kept_text")).otherwise(carried[chars_col]).cast(docs.schema[chars_col].dataType)
    return cut.select(*(out[c].alias(c) for c in docs.columns))


@query("op4_repeated_substrings")
def op4(spark, folder):
    return remove_repeats(read(spark, folder, "documents")).drop("kept_text", "rest")

"""Quality rules: thresholds that adapt to each language and source, from mergeable quantile sketches."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .tables import query, read
from .words import NO_SPACE, Rolling, Texts, Words, mix

#: Words of the windows whose repetition counts.
WINDOW = 8
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80

#: Relative error of a sketch's quantiles; a bucket holds values up to GROWTH times its least.
ERROR = 0.01
GROWTH = (1 + ERROR) / (1 - ERROR)
#: Documents that a group needs for thresholds of its own.
LEAST_DOCS = 400


@dataclass(frozen=True)
class Rule:
    """A share or mean of a document, and how far beyond a quartile it may lie at least, on one side or both."""

    name: str
    part: str
    whole: str
    margin: float
    low: bool = False


RULES = (
    Rule("mean_word", "word_chars", "n_words", 1.5, low=True),
    Rule("symbol_share", "n_symbols", "word_chars", 0.05),
    Rule("dup_line_share", "n_dup_lines", "n_lines", 0.3),
    Rule("repeat_share", "n_repeat_words", "n_words", 0.3),
)
#: An outlier lies further beyond a quartile than SPREADS times the distance of the quartiles.
SPREADS = 3.0
QUARTILES = (0.25, 0.75)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated(codes: np.ndarray) -> np.ndarray:
    """True where a code stands more than once."""
    ordered = np.sort(codes)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(codes), bool)
    return twice[np.minimum(np.searchsorted(twice, codes), len(twice) - 1)] == codes


def _own(codes: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Codes that are equal only within a document."""
    return codes ^ mix(document.astype(np.uint64) + np.uint64(1))


def _lines(texts: Texts) -> Words:
    """The stretches between line feeds, as words are held."""
    breaks = np.flatnonzero(texts.data == 10)
    breaks = np.concatenate([breaks, texts.offsets[1:]])  # a document's end comes after its line feeds
    order = np.argsort(breaks, kind="stable")
    ends_text = order >= len(breaks) - len(texts)
    end = breaks[order]
    first = np.concatenate([[0], np.flatnonzero(ends_text) + 1])
    start = np.concatenate([[0], end[:-1] + ~ends_text[:-1]]) if len(end) else end
    return Words(texts, start, end, first)


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """COUNTS of each text."""
    data, at = texts.data, texts.offsets
    words = texts.words()
    count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[at])
    out = {"n_words": words.counts(), "word_chars": count((NO_SPACE & FIRST_BYTE)[data]), "n_symbols": count(SYMBOLS[data])}

    lines = _lines(texts)
    filled = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    document = lines.document()[filled]
    codes = _own(Words(texts, lines.start[filled], lines.end[filled], lines.first).hashes(), document)
    again = _repeated(codes)
    kinds = np.unique(codes[again], return_index=True)[1] if again.any() else np.zeros(0, np.int64)
    dup = np.bincount(document[again], minlength=len(texts)) - np.bincount(document[again][kinds], minlength=len(texts))
    out |= {"n_lines": np.bincount(document, minlength=len(texts)), "n_dup_lines": dup}

    rolled, document = Rolling(words.hashes()).every(WINDOW), words.document()
    start = np.flatnonzero(document[: len(rolled)] == document[WINDOW - 1 :]) if len(rolled) else np.zeros(0, np.int64)
    start = start[_repeated(_own(rolled[start], document[start]))]
    change = np.bincount(start, minlength=len(words) + 1) - np.bincount(start + WINDOW, minlength=len(words) + 1)
    covered = np.cumsum(change)[: len(words)] > 0
    return out | {"n_repeat_words": np.bincount(document[covered], minlength=len(texts))}


def measured(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with COUNTS of the text before them (null: empty)."""
    others = [c for c in docs.columns if c != text_col]
    schema = docs.select(*(F.lit(0).cast("long").alias(f"count_{c}") for c in COUNTS), *others).schema
    picked = docs.select(F.col(text_col).cast("string").alias("the_text"), *others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(piece) for _, _, piece in Texts.of(batch.column(0)).pieces()]
            counts = [pa.array(np.concatenate([f[c] for f in found] or [np.zeros(0, np.int64)]).astype(np.int64)) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([*counts, *batch.columns[1:]], schema.names)

    return picked.mapInArrow(run, schema)


def ratio(rule: Rule) -> Column:
    return F.when(F.col(rule.whole) > 0, F.col(rule.part) / F.col(rule.whole)).otherwise(0.0)


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Quantile sketches of all rules for each group: (keys, rule, bucket, n).

    A bucket holds the values above GROWTH ** (bucket - 1) and up to GROWTH ** bucket
    (null: zero). Sketches merge by adding up counts, in any order and with the same
    result, so tasks combine before the shuffle and wider groups are sums of narrower
    ones. A group has a few hundred buckets, however many rows it has.
    """
    values = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), ratio(r).alias("x")) for r in RULES))).alias("v")
    bucket = F.when(F.col("v.x") > 0, F.ceil(F.log("v.x") / math.log(GROWTH))).cast("int")
    one = F.lit(1).cast("long")
    return merged(rows.select(*keys, values).select(*keys, "v.rule", bucket.alias("bucket"), one.alias("n")), keys)


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, docs, low and high of each rule): how far the quartiles of a group's sketch let its documents go."""
    along = Window.partitionBy(*keys, "rule").orderBy(F.col("bucket").asc_nulls_first())
    below = sketch.withColumn("below", F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(F.pow(F.lit(GROWTH), F.col("bucket")) * (2 / (GROWTH + 1)))
    total = below.withColumn("docs", F.sum("n").over(Window.partitionBy(*keys, "rule")))
    quartile = lambda q: F.min(F.when(F.col("below") >= q * F.col("docs"), value))
    each = total.groupBy(*keys, "rule").agg(F.max("docs").alias("docs"), *(quartile(q).alias(f"q{k}") for k, q in enumerate(QUARTILES)))
    spread = SPREADS * (F.col("q1") - F.col("q0"))
    of = lambda rule, x: F.max(F.when(F.col("rule") == rule.name, x))
    high = [of(r, F.col("q1") + F.greatest(spread, F.lit(r.margin))).alias(f"high_{r.name}") for r in RULES]
    low = [of(r, F.col("q0") - F.greatest(spread, F.lit(r.margin))).alias(f"low_{r.name}") for r in RULES if r.low]
    return each.groupBy(*keys).agg(F.max("docs").alias("docs"), *high, *low)


LIMITS = [f"high_{r.name}" for r in RULES] + [f"low_{r.name}" for r in RULES if r.low]


def limits(rows: DataFrame) -> DataFrame:
    """(lang, source, level, LIMITS) for each language and source of ``rows``.

    A group with fewer than LEAST_DOCS documents takes the thresholds of its language,
    and a language with fewer those of all documents.
    """
    levels = [["lang", "source"], ["lang"], []]
    sketch = stored(sketches(rows, levels[0]), "sketches")
    out = sketch.select(*levels[0]).distinct()
    for k, keys in enumerate(levels):
        found = fences(sketch if k == 0 else merged(sketch, keys), keys)
        if k < len(levels) - 1:
            found = found.where(F.col("docs") >= LEAST_DOCS)
        names = {c: f"{c}_{k}" for c in found.columns}
        found = found.withColumnsRenamed(names)
        if keys:
            out = out.join(found, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(names[c])) for c in keys)), "left")
        else:
            out = out.crossJoin(F.broadcast(found))  # one row
    level = F.when(F.col("docs_0").isNotNull(), "source").when(F.col("docs_1").isNotNull(), "language").otherwise("all")
    return out.select(*levels[0], level.alias("level"), *(F.coalesce(*(f"{c}_{k}" for k in range(len(levels)))).alias(c) for c in LIMITS))


def judge(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """One row for each document: id, lang, source, COUNTS, base_failed, failed (names of rules), level, kept.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``word_chars`` counts code points in words,
    ``n_symbols`` the characters ``#*$%&|<>``, ``n_lines`` lines with a word and
    ``n_dup_lines`` those equal to an earlier one, ``n_repeat_words`` the words in
    8-word windows that stand twice or more in the text. A document with fewer than 20
    words, or more than 30 % of them in such windows, fails outright. The others are
    held against the quartiles of their language and source (see :func:`limits`): a
    mean word length, share of symbols, repeated lines or repeated words too far beyond
    them fails its rule. Documents that fail outright are not in the sketches.

    Texts are read once, where they are; sketches are combined in each task, and of a
    language and source that hold a third of all rows only some hundred counts move.

    Null texts are empty; null languages and sources form groups of their own; repeated
    rows and null ids each get their row; an empty table gives no rows; other columns
    are ignored.
    """
    picked = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text")
    )
    rows = measured(picked).withColumnsRenamed({f"count_{c}": c for c in COUNTS})
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = stored(rows.withColumn("base_failed", base), "measured")
    known = limits(rows.where(~F.col("base_failed"))).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    broken = [F.when(ratio(r) > F.col(f"high_{r.name}"), r.name) for r in RULES]
    broken += [F.when(ratio(r) < F.col(f"low_{r.name}"), r.name) for r in RULES if r.low]
    failed = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*broken)))
    judged = rows.join(known, same, "left").withColumn("failed", failed)
    return judged.select(
        F.col("id").alias(id_col),
        F.col("lang").alias(lang_col),
        F.col("source").alias(source_col),
        *COUNTS,
        "base_failed",
        "failed",
        "level",
        (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
    )


@query("op13_quality_rules")
def op13(spark, folder):
    return judge(read(spark, folder, "documents")).drop("lang", "source")

"""The corpus pipeline: five stages from raw documents to a mix for training.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before
kept, and returns a DataFrame; all but the last return the columns of documents. The
last one returns the documents of the mix with the words it takes of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm.decontaminate import drop_leaks
from panelspark.llm.mixing import mix
from panelspark.llm.simhash import keep_first
from panelspark.llm.suffixes import strip_repeats
from panelspark.llm.tables import read
from panelspark.llm.toxicity import keep_clean
from panelspark.session import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return keep_clean(docs, read(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_first(docs)


#: Bytes of the strings that the substring stage cuts out: passages of 50 words have more.
PASSAGE, ANCHOR = 200, 64


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of PASSAGE bytes that stand in several places are cut out; every document stays."""
    return strip_repeats(docs, string=PASSAGE, anchor=ANCHOR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with their number, repeats counted."""
    return mix(docs, carry=["text", "lang", "n_chars"]).where("taken > 0")


STAGES = [
    ("toxicity", toxicity),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL cannot express a trained network or a latent space; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents through the operators of ``tallyloom.llm``, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the
last return the columns of ``documents``, whatever else those may be named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, mixing, quality_rules, simhash, toxicity
from tallyloom.session import configure, cut_lineage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; each row is judged alone.

    Null and empty texts have too few words and go. Null ids and repeated rows are judged like any
    other; an empty table gives none. Without labels only the base rule decides.
    """
    return quality_rules.keep_good(docs, quality_rules.train(docs, _table(spark, sf_dir, "labels")))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; each row is judged alone.

    Null and empty texts share no term with toxic examples and stay. Null ids and repeated rows are
    judged like any other; an empty table gives none. Without labels of both kinds all stay, unless
    every label there is says toxic.
    """
    return toxicity.keep_harmless(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    A null id counts as larger than any other. Null and empty texts are one group. Rows that repeat
    an id are told apart by their fingerprints; an empty table gives none.
    """
    configure(spark)
    return simhash.keep_one(docs, shingle=3, radius=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Each row is judged by its own text, whatever its id: rows are named by a digest of the text.
    Null and empty texts have no hits and stay; an empty table gives none, and an empty benchmark
    lets all stay.
    """
    digest = F.sha2(docs.text.cast("string").cast("binary"), 256)
    named = docs.select(digest.alias("digest"), docs.text.alias("text"))
    found = decontamination.decontaminate(named, _table(spark, sf_dir, "benchmark"), id_col="digest")
    gone = found.where(F.size("items") > 0).select(F.col("digest").alias("gone")).distinct()
    return docs.join(gone, digest == gone["gone"], "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of documents that make up the mix, shuffled.

    A null source is a source of its own; rows that repeat an id are repeated alike; sources
    without any text, and an empty table, give none.
    """
    configure(spark)
    return mixing.mix(docs, temperature=0.5, seed=11)


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxic),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
]

#: Trained models and bit distances of all pairs are beyond SQL; tests hold the rows against loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are kept as a table for the next."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences, stage by stage over the whole table.

Every stage gives an empty result for an empty table and reads texts of any length whole; all
but the last return the columns they got, whatever further ones there are and whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglark.llm import exact_dedup, language, minhash, mixing, packing
from loglark.llm.common import Stage, documents


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network finds; null texts and those without a letter go.

    Rows with a null or repeated id are rows like others. Where no document has a language, none stays.
    """
    return language.keep_known(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case, null as empty) the one with the largest id.

    A null id is smaller than any other; of rows with one id and text one stays.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Texts without words are linked with nothing and stay; rows that share the smallest id all stay.
    """
    return minhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a document of a source that is short can come once more, in a second epoch.

    Null sources and languages are leaves of their own; equal hashes are ordered by the row.
    """
    return mixing.mix(docs).select(*[f"`{c}`" for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens: of every row, also of those with a null or empty text."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: The trained network and the packing's tokens are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's rows are written to the shared folder, read again by the next and then deleted."""
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        done = Stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            last.drop()
        docs, last = done.df, done
    return docs

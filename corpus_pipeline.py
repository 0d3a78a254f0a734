"""A corpus pipeline over `documents`: identify, deduplicate, mix and encode.

Each stage takes (spark, docs, folder) and returns a DataFrame; between stages the rows are written
as Parquet and read again. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import language, lines, minhash, mixing, pieces
from postloom.llm.common import ship_code, table
from postloom.session import delete, scratch, shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is not rejected."""
    ship_code(spark)
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of documents alike in 80% of their five-word shingles the one of the smallest id."""
    ship_code(spark)
    return minhash.one_of_each(docs, width=5)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, their repeated lines and sentences cut; `n_chars` follows the text."""
    ship_code(spark)
    cut = lines.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[n_chars.alias(c) if c == "n_chars" else c for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    ship_code(spark)
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sampled segmentations: doc_id, sample, ids, log_prob, value, log_inclusion and round_trip."""
    ship_code(spark)
    return pieces.encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("line_dedup", cut_repeated_lines),
    ("source_mix", mix_sources),
    ("sentencepiece", encode_pieces),
]

# SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage. Of the tables the stages store only the last stage's input stays."""
    docs, before = table(spark, folder, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/stage-{name}-{uuid4().hex}"
        with scratch(spark):
            kept = stage(spark, docs, folder)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, folder)

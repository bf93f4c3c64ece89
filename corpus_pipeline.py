"""A training corpus from raw documents: language, lines, near copies, mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. ``run`` writes each stage as Parquet and gives it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import dart_minhash, line_runs, mixing, zstd_langid
from matchlake.llm.queries import token_digests
from matchlake.llm.shared import Scratch, small_batches, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language prediction stands; ``lang`` stays as it was."""
    small_batches(spark)
    model = zstd_langid.train(docs.where(~zstd_langid.held_out("doc_id")))
    answered = docs.withColumn("_answer", zstd_langid.language("text", model))
    return answered.where("_answer.accepted").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them hold."""
    kept = line_runs.drop_repeated_lines(docs.select(*COLUMNS))
    return with_text(kept.select("row.*", "kept"), F.col("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return dart_minhash.one_of_each(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, a row for each copy; a part of one has the taken words."""
    mixed = mixing.mixed_documents(docs.select(*COLUMNS))
    return with_text(mixed, F.col("text"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every row, and of the text they decode to."""
    small_batches(spark)
    return token_digests(docs)


def with_text(docs: DataFrame, text) -> DataFrame:
    """The columns of documents with another text and its number of characters."""
    changed = docs.withColumns({"text": text, "n_chars": F.length(text).cast("long")})
    return changed.select(*COLUMNS)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("BPE tokens", encode_tokens),
]

#: SQL cannot express compression, darts, seeded blocks or merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs

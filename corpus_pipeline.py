"""A training-data pipeline over ``documents``: five of the operators in a row.

Each stage takes what the one before kept, as read back from Parquet, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.llm import jaccard, packing, pii, quality, queries, suffix_dedup
from basinflow.llm.common import cut, discard, folders, table

#: No SQL expresses the learned stages and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None
#: A passage counts from here on.  In words, as no number of bytes does: 51 words are about 320 bytes here, and from 101 bytes on;
#: a limit that low would take phrases of 16 words.  The 400 bytes stay for texts with few spaces.
PASSAGE_WORDS = 51


def recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays."""
    return jaccard.keep_one(docs, k=5, percent=80)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 400, and passages of more than 50 words, that start anywhere else as well are removed from the texts."""
    return recounted(suffix_dedup.strip_repeats(docs, length=400, words=PASSAGE_WORDS))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return recounted(pii.redact_documents(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs, *queries.tokenizer_files())


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("repeats", repeats_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), len(folders())
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        discard(spark, since)  # all that led to this table
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents to token files in five stages.

Each stage is a function of (spark, docs, sf_dir) over all rows its predecessor kept. Its result is written as
Parquet in the shared folder and read again for the next one, so a lost executor costs part of one stage. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontaminate, mixing, neardup, quality, tokens
from basketry.llm.common import Cut

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality classifier scores 0.5 or more; texts without words are rejected too,
    having nothing to score."""
    weights = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights).filter((F.col("predicted") == 1) & (F.length(F.trim("text")) > 0))
    return scored.select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five words, similarity 0.8."""
    return neardup.kept_only(docs, width=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item or one like it with other values."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the sources to their targets; a document comes as often as it is taken."""
    return mixing.mixed(docs).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the mix as token files and return what the files hold."""
    return tokens.read_shards(tokens.write_shards(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The classifier, the forest, the drawing and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Cut(stage(spark, docs, sf_dir), f"stage-{name}").df
    return docs

"""The corpus pipeline: five stages, each one operator of docweave.llm, each reading what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import bpe, common, jaccard, linelabel, mixing, queries, substrings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose content lines hold too few words, go; so null, empty and wordless texts go. Each row is judged alone."""
    common.ship(spark)
    return linelabel.keep_good(docs, linelabel.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, that with the smallest id; rows repeated whole become one, rows without an id stay."""
    common.ship(spark)
    return jaccard.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus are cut; documents of which no word is left go, those that had none stay. n_chars follows the text.

    Rows without an id stay whole and nothing is cut for their sake; other columns stay as they are.
    """
    common.ship(spark)
    cut = substrings.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType)) if "n_chars" in cut.columns else cut


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come near their targets; a null source is one of them. A source without words goes."""
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each row: doc_id, the number and digest of its text's ids, and the digest of the text decoded from them; null is as empty."""
    common.ship(spark)
    return bpe.round_trip(docs, queries.tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("bpe_encoding", bpe_encoding),
]

#: SQL can express neither the fitted field nor the vocabulary's merges; tests/llm compares the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents; between two, the rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.stored(docs)
    return docs

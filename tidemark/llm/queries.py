"""The queries of problems 7 to 9 over the documents of a folder. None has SQL: tests hold them against brute force."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import encoding, packing, sentences


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.token_ids(documents(spark, folder), "doc_id", "text")


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pack_targets.parquet")


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    sizes = encoding.token_counts(documents(spark, folder), "doc_id", "text")
    return packing.pack(sizes, _targets(spark, folder), "doc_id", "tokens", "target_id", "capacity_tokens")


def p8_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Where each piece of each document lies, for each pack target; sizes in tokens of byte_bpe_50k."""
    return _packed(spark, folder).withColumnsRenamed({"target": "target_id", "item": "doc_id", "first": "first_token", "size": "tokens"})


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How many containers each pack target takes, and how many it takes at least."""
    return packing.fill(_packed(spark, folder), _targets(spark, folder), "target_id", "capacity_tokens").withColumnsRenamed({"target": "target_id", "size": "tokens"})


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.sentence_units(documents(spark, folder), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p7_ids, p8_bins, p8_fill, p9_found)}
SQL: dict[str, str] = {}

"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, fertility, jaccard, lines, merkle, mixing, neighbours, pieces, sharding, style_tree, substrings, toxicity, url_reputation
from .common import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge(documents(spark, sf_dir, "pages")).drop("bound")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(documents(spark, sf_dir))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document, and the SHA-256 of what they decode to."""
    decoded = pieces.decode(pieces.encode(documents(spark, sf_dir)), keep_ids=True)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("text", 256).alias("decoded_sha256"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(documents(spark, sf_dir, "embeddings"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.measure(documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeats(documents(spark, sf_dir), counts=True)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(documents(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filters": url_reputation.oracle(), "op11_merkle_manifest": merkle.oracle(), "op12_html_extraction": style_tree.oracle(), "op13_collocations": collocations.oracle()}

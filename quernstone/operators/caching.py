"""Costly vectors or scores kept in a table by the digest of what they are made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


NAME = "content_digest"


def digest(*parts: Column) -> Column:
    """A name of contents: SHA-256 of the parts, each with its length in front, so that parts can't run together."""
    lengths = [F.coalesce(F.octet_length(p).cast("string"), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*[x for n, p in zip(lengths, parts, strict=True) for x in (n, F.lit(":"), F.coalesce(p.cast("string"), F.lit("")))]), 256)


def cached(items: DataFrame, content: Column, compute: Callable[[DataFrame], DataFrame], path: str, version: str = "1") -> DataFrame:
    """items with the columns that compute gives, each distinct content computed once over all runs.

    compute takes (content_digest, and items' columns but one of that name), one row for each content that the table at
    path doesn't have, and returns (content_digest, values...); its rows are appended before they are read, so what a failed run has written is kept and a
    changed content is new. Runs with another `version` (a model's name) share nothing. A content for which compute gives
    no row is asked for again next time, and has nulls. Two runs at one time may compute a content twice; the first row wins.
    """
    spark = items.sparkSession
    named = items.withColumn("_digest", digest(F.lit(version), content))
    known = _read(spark, path)
    one = named.groupBy("_digest").agg(F.first(F.struct(*[c for c in items.columns if c.lower() != NAME])).alias("_item"))
    fresh = one if known is None else one.join(known.select(F.col(NAME).alias("_digest")), "_digest", "left_anti")
    fresh = fresh.select(F.col("_digest").alias(NAME), "_item.*")
    compute(fresh).write.mode("append").parquet(path)
    values = _read(spark, path)
    names = [c for c in values.columns if c != NAME]
    first = values.groupBy(NAME).agg(F.first(F.struct(*names)).alias("_v"))
    return named.join(first.withColumnRenamed(NAME, "_digest"), "_digest", "left").select(*[F.col(f"`{c}`") for c in items.columns], *[F.col(f"_v.`{c}`") for c in names])


def _read(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        # no table yet, or a folder in which a run has written nothing
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise

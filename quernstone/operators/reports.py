"""Rollups behind a dataset report: pauses, edges, bandwidth, judgements, raters. Each is one aggregation with partial sums, but where said."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(hit: Column) -> Column:
    return F.count_if(hit) * 100.0 / F.count("*")


def pauses(clips: DataFrame, by: list[str]) -> DataFrame:
    """Mean silence before, after and within clips of (lead_s, trail_s, speech_s, total_s). Clips without length or speech are left out."""
    inside = F.greatest(F.lit(0.0), 1 - (F.col("speech_s") + F.col("lead_s") + F.col("trail_s")) / F.col("total_s"))
    heard = clips.where("total_s > 0 and speech_s > 0").withColumn("_inside", inside)
    return heard.groupBy(*by).agg(*[F.round(F.avg(c), 3).alias(n) for c, n in (("lead_s", "mean_leading_s"), ("trail_s", "mean_trailing_s"), ("_inside", "mean_internal_fraction"))], F.count("*").alias("clips"))


def edges(clips: DataFrame, by: list[str], most: float = 0.15) -> DataFrame:
    """What trimming the silence at both ends would take, of (lead_s, trail_s)."""
    ms = lambda c: F.bround(c * 1000, 0)
    per = [f(F.col(f"{side}_s")) for side in ("lead", "trail") for f in (lambda c: ms(F.median(c)), lambda c: ms(F.avg(c)))]
    names = [f"{side}_ms_{what}" for side in ("lead", "trail") for what in ("median", "mean")]
    return clips.groupBy(*by).agg(F.count("*").alias("clips"), *[c.alias(n) for c, n in zip(per, names, strict=True)], F.bround(percent((F.col("lead_s") > most) | (F.col("trail_s") > most)), 0).alias("long_edge_percent"), F.round(F.sum(F.col("lead_s") + F.col("trail_s")), 1).alias("trimmable_s"))


def bandwidth(clips: DataFrame, by: list[str], wide: float = 0.005) -> DataFrame:
    """Median roll-off and share of energy above 8 kHz, and how many clips are truly wide, of (rolloff_hz, above_8khz)."""
    return clips.groupBy(*by).agg(F.count("*").alias("n"), F.bround(F.median("rolloff_hz"), 0).alias("rolloff_hz_median"), F.round(F.median("above_8khz") * 100, 2).alias("above_8khz_median_percent"), F.bround(percent(F.col("above_8khz") > wide), 0).alias("wideband_percent"))


def overlap(clips: DataFrame, by: list[str], below: float) -> DataFrame:
    """Clips whose cohesion hints at a second voice, by group and (all null) over all."""
    return clips.rollup(*by).agg(F.count_if(F.col("cohesion") < below).alias("flagged"), F.count("*").alias("clips"), F.round(F.median("cohesion"), 3).alias("median_cohesion"))


def judge_summary(judged: DataFrame, total: Column) -> DataFrame:
    """How a judge found clips, of (tts_suitable, transcript_clean, emotion_supported); `total` aggregates what was asked, rows without an answer have a null topic."""
    got = F.col("topic_category").isNotNull()
    share = lambda c: F.bround(F.count_if(got & c) * 100.0 / F.greatest(F.count_if(got), F.lit(1)), 0)
    return judged.agg(
        total.alias("asked"), F.count_if(got).alias("judged"), F.count_if(got & ~F.col("transcript_clean")).alias("unclean"), F.count_if(got & ~F.col("emotion_supported")).alias("unsupported"),
        F.count_if(got & (F.col("tts_suitable") < 0.5)).alias("unsuitable"), share(F.col("transcript_clean")).alias("clean_percent"), share(F.col("tts_suitable") >= 0.5).alias("suitable_percent"), share(F.col("emotion_supported")).alias("supported_percent"),
    )


def flag_counts(clips: DataFrame, by: list[str], probabilities: list[str], least: float) -> DataFrame:
    """(by, flag, n, clips): clips whose probability reaches `least`, a row for each flag."""
    pairs = ", ".join(f"'{p}', `{p}`" for p in probabilities)
    tidy = clips.select(*by, F.expr(f"stack({len(probabilities)}, {pairs}) as (flag, p)"))
    return tidy.groupBy(*by, "flag").agg(F.count_if(F.col("p") >= least).alias("n"), F.count("*").alias("clips"))


def histograms(clips: DataFrame, by: list[str], labels: list[str]) -> DataFrame:
    """(by, kind, label, n, place): one row for each label, most frequent first, ties by label; null labels are none."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in labels)
    n = clips.select(*by, F.expr(f"stack({len(labels)}, {pairs}) as (kind, label)")).where("label is not null").groupBy(*by, "kind", "label").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy(*by, "kind").orderBy(F.col("n").desc(), "label")))


def three_raters(kept: DataFrame, second: DataFrame, third: DataFrame, key: str, labels: tuple[str, ...], default: str) -> DataFrame:
    """(key, a, b, c): what rater 2 saw, with the kept row's own label and rater 3's where there is one.

    Rows whose own label is unknown go; an unknown second label is the default, an unknown third one is missing.
    """
    both = second.select(key, F.col("label").alias("b")).join(kept.select(key, F.col("label").alias("a")), key).join(third.select(key, F.col("label").alias("c")), key, "left")
    known = lambda c: F.col(c).isin(*labels)
    return both.where(known("a")).select(key, "a", F.when(known("b"), F.col("b")).otherwise(default).alias("b"), F.when(known("c"), F.col("c")).alias("c"))


def agreement_by(rated: DataFrame, by: str, a: Column, b: Column) -> DataFrame:
    """Percent of rows on which both raters agree, by group and over all ('all'); rows that a rater left out don't count."""
    both = rated.where(a.isNotNull() & b.isNotNull())
    return both.rollup(by).agg(F.count("*").alias("n"), F.round(percent(a == b), 4).alias("agreement_percent")).withColumn(by, F.coalesce(F.col(by).cast("string"), F.lit("all")))

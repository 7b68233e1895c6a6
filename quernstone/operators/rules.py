"""Ordered rules that leave their reasons: quality gates, flags, annotations, what counts as kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as T


@dataclass(frozen=True)
class Limits:
    clipping: float = 0.01
    snr: float = 15.0
    silence: float = 0.45
    min_rate: float = 2.0
    max_rate: float = 32.0
    min_seconds: float = 3.0
    max_seconds: float = 25.0
    confidence: float = 0.60
    gap: float = 0.32
    latin: float = 0.5


def reasons(*rules: tuple[Column, Column | str]) -> Column:
    """An array of the names whose condition is true, in order; a null condition is false."""
    return F.filter(F.array(*[F.when(c, F.lit(n) if isinstance(n, str) else n) for c, n in rules]), lambda x: x.isNotNull())


def with_value(name: str, fmt: str, value: Column) -> Column:
    return F.format_string(f"{name}({fmt})", value)


def gate(segments: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Adds reject_reasons, flags and status to segments (transcript, language, duration_s and metrics; missing metrics reject nothing)."""
    s, c = limits, F.col
    stripped = F.regexp_replace("transcript", r"(?U)^\s+|\s+$", "")
    chars = F.length(stripped)
    rate = F.when(c("duration_s") > 0, chars / c("duration_s")).otherwise(0.0)
    rejects = reasons(
        (stripped == "", "empty_transcript"),
        (c("clipped_fraction") > s.clipping, with_value("clipping", "%.3f", c("clipped_fraction"))),
        (c("snr_db") < s.snr, with_value("low_snr", "%.1fdB", c("snr_db"))),
        (c("silence_ratio") > s.silence, with_value("too_much_silence", "%.2f", c("silence_ratio"))),
        ((chars > 0) & ~rate.between(s.min_rate, s.max_rate), with_value("char_rate", "%.1f", rate)),
        (~c("duration_s").between(s.min_seconds, s.max_seconds), "duration_out_of_range"),
        (c("asr_language_probability") < s.confidence, with_value("low_asr_conf", "%.2f", c("asr_language_probability"))),
    )
    flags = reasons(
        (c("gap_energy_ratio") > s.gap, with_value("music_or_noise_bed", "%.2f", c("gap_energy_ratio"))),
        ((c("asr_language_code") != "") & (c("asr_language_code") != c("language_code")), with_value("lang_mismatch", "%s", c("asr_language_code"))),
        ((c("language") != "en") & (T.latin_fraction(c("transcript")) > s.latin), with_value("code_mixed", "%.2f", T.latin_fraction(c("transcript")))),
    )
    status = F.when(F.size("reject_reasons") > 0, "reject").when(F.size("flags") > 0, "flag").otherwise("pass")
    return segments.withColumn("reject_reasons", rejects).withColumn("flags", flags).withColumn("status", status)


def kept(status: Column, decision: Column) -> Column:
    """A reviewer's word counts before the gate's."""
    return F.coalesce(F.when(decision == "reject", False).when(decision == "accept", True), F.coalesce(status, F.lit("")).isin("pass", "flag"))


def reason_counts(segments: DataFrame, canonical: tuple[str, ...]) -> DataFrame:
    """(reason, n): reasons without their values, canonical ones also if they never occur."""
    seen = segments.select(F.explode("reject_reasons").alias("r")).groupBy(F.split_part("r", F.lit("("), F.lit(1)).alias("reason")).agg(F.count("*").alias("n"))
    known = segments.sparkSession.createDataFrame([(x,) for x in canonical], "reason string")
    return known.join(seen, "reason", "full_outer").select("reason", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def low_confidence(segments: DataFrame, least: float = 0.55) -> DataFrame:
    """Adds the flag low_emotion_confidence once and lifts pass to flag."""
    low = F.coalesce(F.col("emotion_confidence") < least, F.lit(False))
    flags = F.when(low & ~F.array_contains("flags", "low_emotion_confidence"), F.array_append("flags", F.lit("low_emotion_confidence"))).otherwise(F.col("flags"))
    return segments.withColumn("status", F.when(low & (F.col("status") == "pass"), "flag").otherwise(F.col("status"))).withColumn("flags", flags)


def whispered(voiced: Column, rms_z: Column, harmonics: Column) -> Column:
    return (F.coalesce(voiced, F.lit(1.0)) < 0.30) & (F.coalesce(rms_z, F.lit(0.0)) < -0.40) & (F.coalesce(harmonics, F.lit(99.0)) < 7.0)


def annotations(transcript: Column, language: Column, ovrl: Column, snr: Column, gap: Column, confidence: Column, clean: Column, align: Column, overlap: Column) -> Column:
    """Edge-case flags joined by a bar. A confidence of 0 counts as 1, as one that is missing does."""
    found = reasons(
        ((ovrl < 3.0) | (snr < 18) | (F.coalesce(gap, F.lit(0.0)) > 0.30), "quality"),
        (T.truncated(transcript), "truncation"),
        (T.code_mixed(transcript, language), "codemix"),
        (F.coalesce(F.nullif(confidence, F.lit(0.0)), F.lit(1.0)) < 0.55, "emotion_low_confidence"),
        ((clean.eqNullSafe(F.lit(False))) | (align < 0.85), "transcript_review_needed"),
        (overlap, "overlap_suspected"),
        (ovrl < 2.8, "low_quality_audio"),
    )
    return F.array_join(found, "|")


#: Conditions that users of a published set filter by.
RECIPES = {
    "studio": "dnsmos_pass and not quality_flag and not has_truncation",
    "expressive": "emotion_confidence > 0.7 and emotion <> 'neutral'",
    "storytelling": "topic in ('mythology', 'folktale', 'fiction')",
    "review_queue": "transcript_review_needed or emotion_low_confidence",
}


def recipe(rows: DataFrame, name: str) -> DataFrame:
    """The rows of a published set that a recipe takes."""
    return rows.where(RECIPES[name])


def recipe_views(rows: DataFrame, prefix: str = "") -> list[str]:
    """A temporary view for each recipe; their names."""
    for name in RECIPES:
        recipe(rows, name).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in RECIPES]

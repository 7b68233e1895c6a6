"""The steps that a curator runs again and again, as functions of tables: tag, retag, requalify, merge reviews, build, show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import joins, near_duplicates, rules, sequence
from quernstone.plans import workflow

#: Features whose z-scores tell how a clip sounds next to its speaker's others.
Z_FEATURES = ("f0_mean", "f0_std", "f0_range", "rms_mean", "rms_dynamic", "speaking_rate_wps", "hf_lf_ratio", "hnr_mean", "voiced_fraction")


def z_structs(segments: DataFrame, features: tuple[str, ...] = Z_FEATURES) -> DataFrame:
    """Segments with features_z: z-scores by speaker of the fields of the struct `features`; a field that isn't there counts as 0."""
    known = segments.schema["features"].dataType.names
    flat = segments.withColumns({f"_f_{n}": F.col(f"features.{n}") if n in known else F.lit(None).cast("double") for n in features})
    scored = sequence.z_scores(flat, "speaker_id", [f"_f_{n}" for n in features])
    z = F.struct(*[F.col(f"_f_{n}_z").alias(n) for n in features])
    return scored.withColumn("features_z", z).drop(*[f"_f_{n}{tail}" for n in features for tail in ("", "_z")])


def tagged(segments: DataFrame, answers: DataFrame, emotions: tuple[str, ...], styles: tuple[str, ...], least: float = 0.55) -> DataFrame:
    """Segments with emotion, style, confidence and rationale of a model's answers (id, answer); rejected ones keep theirs.

    An answer without JSON, or none, gives neutral and narrative at 0.3. What the acoustics call a whisper is one,
    whatever the answer says. A confidence under `least` flags the segment and lifts pass to flag.
    """
    names = segments.columns
    met = segments.join(answers.select("id", T.extracted_json(F.col("answer")).alias("_j")), "id", "left")
    of = lambda k: F.get_json_object("_j", f"$.{k}")
    voice = lambda s, n: F.col(f"{s}.{n}") if n in segments.schema[s].dataType.names else F.lit(None).cast("double")
    whisper = rules.whispered(voice("features", "voiced_fraction"), voice("features_z", "rms_mean"), voice("features", "hnr_mean"))
    said = F.when(F.col("_j").isNull(), "fallback (no/invalid LLM output)").otherwise(T.cut_rationale(of("rationale")))
    new = {
        "emotion": T.checked_label(of("emotion"), emotions, "neutral"), "style": F.when(whisper, "whisper").otherwise(T.checked_label(of("style"), styles, "narrative")), "emotion_confidence": F.round(T.checked_confidence(of("confidence")), 3),
        "emotion_rationale": F.when(whisper, F.when(F.trim(said) == "", "whisper set acoustically").otherwise(F.concat(said, F.lit(" | whisper set acoustically")))).otherwise(said), "tag_source": F.lit("auto"),
    }
    live = F.coalesce(F.col("status"), F.lit("")) != "reject"
    out = met.withColumns({c: F.when(live, v).otherwise(F.col(c)) if c in names else F.when(live, v) for c, v in new.items()})
    low = rules.low_confidence(out.withColumn("_status", F.col("status")).withColumn("_flags", F.col("flags")), least)
    return low.withColumns({c: F.when(live, F.col(c)).otherwise(F.col(f"_{c}")) for c in ("status", "flags")}).select(*names, *[c for c in new if c not in names])


def retag(segments: DataFrame, answers: DataFrame, emotions: tuple[str, ...], styles: tuple[str, ...]) -> DataFrame:
    """z-scores over all segments anew, then tags."""
    return tagged(z_structs(segments), answers, emotions, styles)


def requalify(segments: DataFrame, limits: rules.Limits = rules.Limits(), similarity: int = 90) -> DataFrame:
    """Gates anew over what has been measured before, then first-wins duplicates within each source and language; labels stay as they are."""
    gated = rules.gate(segments, limits)
    group = "_group"
    open_rows = gated.where("status <> 'reject'").withColumn(group, F.to_json(F.array("source_id", "language")))
    twins = near_duplicates.greedy_kept(open_rows, "id", "transcript", group, similarity).where("dropped").select("id", F.lit(True).alias("_twin"))
    twin = F.coalesce("_twin", F.lit(False))
    marked = gated.join(twins, "id", "left").withColumn("status", F.when(twin, "reject").otherwise(F.col("status")))
    marked = marked.withColumn("reject_reasons", F.when(twin, F.array_append("reject_reasons", F.lit("duplicate"))).otherwise(F.col("reject_reasons")))
    return marked.select(*[F.col(c) for c in gated.columns])


def kept_by_source(segments: DataFrame) -> DataFrame:
    """(source_id, kept, clips)."""
    return segments.groupBy("source_id").agg(F.count_if(F.col("status") != "reject").alias("kept"), F.count("*").alias("clips"))


def review_merge(segments: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments with reviewers' decisions, and one row of how many were accepted, rejected, relabelled and had their text mended."""
    after = joins.review_merge(segments, decisions)
    decision = F.lower(F.trim(F.coalesce("d.decision", F.lit(""))))
    pairs = segments.alias("s").join(after.alias("a"), "id").join(decisions.alias("d"), "id")
    differs = {c: ~F.col(f"s.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("emotion", "style", "transcript")}
    counts = pairs.agg(
        F.count_if(decision == "accept").alias("accepted"), F.count_if(decision == "reject").alias("rejected"), F.count_if(differs["emotion"] | differs["style"] | differs["transcript"]).alias("relabeled"), F.count_if(differs["transcript"]).alias("transcript_fixed"),
    )
    return after, counts


def build(segments: DataFrame, minutes: float, topics: tuple[str, ...] = (), rate: int = 24000) -> tuple[DataFrame, DataFrame]:
    """(records, statistics by language) of what is selected: kept clips, balanced over emotions up to the target."""
    chosen = workflow.selected(segments, minutes, topics)
    records = workflow.records(chosen, rate)
    stats = records.groupBy("language").agg(
        F.count("*").alias("clips"), F.round(F.sum("duration") / 60, 2).alias("minutes"), F.count_distinct("speaker_id").alias("speakers"), F.count_if(F.col("tag_source") == "human").alias("human"), F.round(F.avg("duration"), 2).alias("mean_s"),
        F.round(F.median("dnsmos_ovrl"), 3).alias("dnsmos_median"), F.round(F.count_if("dnsmos_pass") * 100.0 / F.count("*"), 1).alias("dnsmos_pass_percent"),
    )
    return records, stats


def shown(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(language, status, clips, minutes) of all segments, and (language, emotion, n) of the kept ones, most frequent first."""
    candidates = segments.groupBy("language", "status").agg(F.count("*").alias("clips"), F.round(F.sum("duration_s") / 60, 1).alias("minutes")).orderBy("language", "status")
    kept = segments.where(rules.kept(F.col("status"), F.col("review_decision")))
    mix = kept.groupBy("language", T.missing(F.col("emotion"), "?").alias("emotion")).agg(F.count("*").alias("n")).orderBy("language", F.col("n").desc(), "emotion")
    return candidates, mix

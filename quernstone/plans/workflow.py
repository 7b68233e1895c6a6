"""The curation workflow end to end, as DataFrame steps: process, requalify, enrich, review, select, publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions import numbers
from quernstone.functions import text as T
from quernstone.operators import joins, near_duplicates, rules, sequence

FLAGS = ("quality_flag", "has_truncation", "has_codemix", "has_laughter", "emotion_low_confidence", "transcript_review_needed", "low_quality_audio", "overlap_flag")
#: Columns that are published under another name.
RENAMED = {"text": "transcript", "segment_start": "start_s", "segment_end": "end_s", "topic": "topic_category", "llm_tts_suitable": "tts_suitable"}
#: Columns that are published as 32-bit floats.
NARROW = ("emotion_confidence", "duration", "snr_db", "dnsmos_ovrl", "dnsmos_sig", "dnsmos_bak", "squim_stoi", "squim_pesq", "squim_sisdr", "mms_align_score", "valence", "arousal", "dominance", "llm_tts_suitable", "segment_start", "segment_end")
#: Fixed value: the median pitch under which an unknown voice counts as male, in Hz.
PITCH_BOUNDARY = 165.0


def clips(chunks: DataFrame, gap: float = 0.4) -> DataFrame:
    """(source_id, id, speaker_id, start_s, end_s, duration_s, transcript_batch) of chunks (source_id, speaker_id, start_s, end_s, text).

    The dominant speaker's chunks are joined into runs (others' interjections don't break one), packed into clips,
    numbered, and given the text of the chunks that overlap them.
    """
    main = sequence.dominant(chunks, "source_id", "speaker_id", F.col("end_s") - F.col("start_s"), F.col("start_s")).select("source_id", "speaker_id")
    own = chunks.join(main, ["source_id", "speaker_id"])
    runs = sequence.runs(own, ["source_id"], "start_s", "end_s", gap)
    packed = sequence.pack(runs, "source_id", "run_start", "run_end")
    named = sequence.numbered_ids(packed, "source_id", [F.col("clip_start")])
    said = joins.overlapping_text(named, own.select("source_id", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "text"), "source_id")
    return said.join(main, "source_id").select("source_id", "id", "speaker_id", F.round("clip_start", 3).alias("start_s"), F.round("clip_end", 3).alias("end_s"), F.round(F.col("clip_end") - F.col("clip_start"), 3).alias("duration_s"), F.col("text").alias("transcript_batch"))


def transcribed(segments: DataFrame) -> DataFrame:
    """The recogniser's text, or the diariser's where it is empty, and the rate of words."""
    t = T.missing(F.col("transcript"), F.col("transcript_batch"))
    return segments.withColumn("transcript", t).withColumn("speaking_rate_wps", T.speaking_rate(F.size(T.words(t)), F.col("duration_s")))


def qualify(segments: DataFrame, features: list[str], limits: rules.Limits = rules.Limits()) -> DataFrame:
    """z-scores by speaker, gates, then near duplicates among what the gates keep, by language."""
    gated = rules.gate(sequence.z_scores(segments, "speaker_id", features), limits)
    open_rows = gated.where("status <> 'reject'")
    dropped = near_duplicates.greedy_kept(open_rows, "id", "transcript", "language").where("dropped").select("id", F.lit(True).alias("_twin"))
    twin = F.coalesce("_twin", F.lit(False))
    marked = gated.join(dropped, "id", "left").withColumn("status", F.when(twin, "reject").otherwise(F.col("status")))
    return marked.withColumn("reject_reasons", F.when(twin, F.array_append("reject_reasons", F.lit("duplicate"))).otherwise(F.col("reject_reasons"))).drop("_twin")


def voices(segments: DataFrame, known: dict[str, str], accents: dict[str, str]) -> DataFrame:
    """Adds gender (known, or from the speaker's median pitch; without pitch female) and accent to each row."""
    median = F.coalesce(F.median(F.nullif("f0_mean", F.lit(0.0))).over(Window.partitionBy("speaker_id")), F.lit(0.0))
    guess = F.when((median > 0) & (median < PITCH_BOUNDARY), "male").otherwise("female")
    look = lambda table, c, default: F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col(c)], default) if table else default
    return segments.withColumn("gender", look(known, "speaker_id", guess)).withColumn("accent", look(accents, "language", F.col("language")))


def corrections(segments: DataFrame, most: int = 4) -> DataFrame:
    """English rows whose two transcripts differ by 1 to `most` words."""
    a, b = T.comparison_form(F.col("transcript_batch")), T.comparison_form(F.col("transcript"))
    far = F.abs(F.size(T.words(a)) - F.size(T.words(b)))
    return segments.where((a != "") & (b != "") & (a != b) & far.between(1, most) & (F.col("language") == "en"))


def selected(segments: DataFrame, minutes: float, topics: tuple[str, ...] = ()) -> DataFrame:
    """Kept rows of each language up to the target, round robin over emotions: wanted topics first, then the cleanest."""
    ok = segments.where(rules.kept(F.col("status"), F.col("review_decision"))).withColumn("_bucket", T.missing(F.col("emotion"), "neutral"))
    liked = F.when(F.coalesce(F.col("topic_category"), F.lit("")).isin(*topics), 0).otherwise(1) if topics else F.lit(1)
    order = [liked.asc(), F.coalesce("dnsmos_ovrl", F.lit(0.0)).desc(), F.col("id")]
    return sequence.balanced(ok, "language", "_bucket", "duration_s", minutes * 60, order).drop("_bucket")


def column(rows: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)


def records(segments: DataFrame, rate: int = 24000) -> DataFrame:
    """The published columns: renamed, rounded, with defaults; columns that are missing are null (flags false)."""
    s = segments
    text = ("audio", "language", "language_code", "emotion", "style", "tag_source", "speaker_id", "gender", "accent", "ser_emotion", "source_video_id", "source_url", "source_channel", "license")
    out = {c: column(s, c, "string") for c in text}
    out |= {c: column(s, RENAMED.get(c, c), "double") for c in NARROW if c != "duration"}
    out |= {c: F.coalesce(column(s, c, "boolean"), F.lit(False)) for c in FLAGS}
    out |= {
        "text": F.col("transcript"), "normalized_text": numbers.spoken(F.col("transcript"), F.col("language")), "duration": F.round("duration_s", 3), "dnsmos_pass": F.coalesce(column(s, "dnsmos_ovrl", "double") > 3.0, F.lit(False)), "topic": column(s, "topic_category", "string"),
        "annotated_text": T.missing(column(s, "annotated_text", "string"), F.col("transcript")), "annotation_flags": F.coalesce(column(s, "annotation_flags", "string"), F.lit("")), "sample_rate": F.lit(rate),
    }
    return s.select(*[c.alias(n) for n, c in out.items()])


def narrowed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("float") for c in NARROW if c in rows.columns})


def publishable(rows: DataFrame, fraction: float = 0.05) -> DataFrame:
    """Narrow rows with config (language) and split, in the order of emotion, speaker and path."""
    order = [F.coalesce("emotion", F.lit("")), F.col("speaker_id"), F.col("audio")]
    return sequence.split3(narrowed(rows).withColumn("config", F.col("language")), ["config"], fraction, order)


def tumbling(rows: DataFrame, length: str, size: float, least: float) -> DataFrame:
    """Adds w_start and w_end: windows of `size` from 0 on; a tail under `least` goes."""
    n = F.greatest(F.ceil(F.col(length) / size).cast("int"), F.lit(1))
    cut = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("w_start", F.col("_k") * F.lit(size)).withColumn("w_end", F.least(F.col("w_start") + size, F.col(length)))
    return cut.where(F.col("w_end") - F.col("w_start") >= least).drop("_k")


def sliding(rows: DataFrame, length: str, size: float, hop: float) -> DataFrame:
    """Adds w_start and w_end: whole windows of `size` every `hop`; a row shorter than one has none."""
    n = F.floor((F.col(length) - size) / hop).cast("int") + 1
    return rows.where(F.col(length) >= size).withColumn("_k", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("w_start", F.col("_k") * F.lit(hop)).withColumn("w_end", F.col("_k") * F.lit(hop) + size).drop("_k")


def centred(length: Column, size: float) -> tuple[Column, Column]:
    """(start, end) of the middle `size` of a length, or all of it."""
    start = F.greatest((length - size) / 2, F.lit(0.0))
    return start, start + F.least(length, F.lit(size))

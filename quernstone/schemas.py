"""Schemas, declared and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NUM, LONG, FLAG = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


#: Acoustic features of a clip.
FEATURES = struct(f0_mean=NUM, f0_range=NUM, f0_std=NUM, rms_mean=NUM, rms_dynamic=NUM, hnr_mean=NUM, voiced_fraction=NUM, centroid_mean=NUM, hf_lf_ratio=NUM, pause_ratio=NUM, speaking_rate_wps=NUM, n_words=NUM)
#: What gates and models measure.
METRICS = struct(peak=NUM, clipped_fraction=NUM, snr_db=NUM, silence_ratio=NUM, gap_energy_ratio=NUM, spectral_flatness=NUM, chars_per_sec=NUM, latin_fraction=NUM, dnsmos_ovrl=NUM, align_score=NUM, overlap_flag=FLAG, topic_category=TEXT, tts_suitable=NUM, annotated_text=TEXT)
#: The central record: one clip.
SEGMENT = struct(
    id=TEXT, source_id=TEXT, language=TEXT, language_code=TEXT, speaker_id=TEXT, wav_path=TEXT, start_s=NUM, end_s=NUM, duration_s=NUM, transcript=TEXT, transcript_batch=TEXT, asr_language_probability=NUM, asr_language_code=TEXT, features=FEATURES, features_z=FEATURES, metrics=METRICS, status=TEXT,
    reject_reasons=T.ArrayType(TEXT), flags=T.ArrayType(TEXT), emotion=TEXT, style=TEXT, emotion_confidence=NUM, emotion_rationale=TEXT, tag_source=TEXT, review_decision=TEXT, source_url=TEXT, source_title=TEXT, channel=TEXT, license=TEXT, content_type=TEXT, upload_date=TEXT,
)
#: A curated source.
SOURCE = struct(id=TEXT, url=TEXT, language=TEXT, content_type=TEXT, speaker_id=TEXT, license=TEXT, title=TEXT, notes=TEXT, expected_speakers=T.IntegerType(), enabled=FLAG, max_minutes=NUM, start_offset_s=NUM, end_trim_s=NUM)
#: Where a source was taken from.
PROVENANCE = struct(video_id=TEXT, title=TEXT, channel=TEXT, upload_date=TEXT, license=TEXT, url=TEXT, duration_s=NUM, audio_path=TEXT)
#: A diariser's answer for one recording.
DIARIZATION = struct(
    request_id=TEXT, transcript=TEXT, language_code=TEXT, language_probability=NUM, timestamps=struct(words=T.ArrayType(TEXT), start_time_seconds=T.ArrayType(NUM), end_time_seconds=T.ArrayType(NUM)),
    diarized_transcript=struct(entries=T.ArrayType(struct(transcript=TEXT, start_time_seconds=NUM, end_time_seconds=NUM, speaker_id=TEXT))),
)
DECISION = struct(id=TEXT, decision=TEXT, emotion=TEXT, style=TEXT, transcript=TEXT)
#: A second judgement of labels.
RELABEL = struct(id=TEXT, language=TEXT, emotion=TEXT, transcript=TEXT, human_emotion=TEXT)
AUDIT = struct(id=TEXT, language=TEXT, emotion=TEXT, transcript=TEXT, transcript_correct=TEXT, emotion_correct=TEXT, audio_ok=TEXT, notes=TEXT)

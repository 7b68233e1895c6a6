"""Commands over tables, settings, provenance, lookups, recipes, zips, and the sinks of a build."""

import json

import pytest
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import joins, rules
from quernstone.plans import commands
from quernstone.sources import readers, settings, writers

YAML = """
audio: {asr_sample_rate: 16000, master_sample_rate: 24000, channels: 1}
segmentation: {min_duration_s: 3, max_duration_s: 25, target_min_s: 5, target_max_s: 15, silence_top_db: 40, min_silence_gap_s: 0.3, edge_pad_s: 0.1, merge_gap_s: 0.4}
quality: {max_clipped_fraction: 0.02, min_snr_db: 12, max_silence_ratio: 0.45, min_language_probability: 0.6, max_gap_energy_ratio: 0.32, min_chars_per_sec: 2, max_chars_per_sec: 32, dedup_similarity: 0.9}
asr: {batch_model: a, batch_mode: b, batch_timeout_s: 2400, realtime_model: c}
llm: {model: m, temperature: 0.2, max_tokens: 900}
emotion: {emotions: [neutral, sad], styles: [narrative, whisper], low_confidence_threshold: 0.55, whisper: {max_voiced_fraction: 0.3, max_energy_zscore: -0.4, max_hnr_db: 7}}
targets: {minutes_per_language: 30, val_fraction: 0.05}
languages: {en: {code: en-IN, name: English, config: english}}
dataset: {license: cc}
"""


def test_settings(tmp_path):
    s = settings.parsed(YAML)
    assert (s.limits().snr, s.limits().clipping, s.limits().max_seconds, s.languages["en"].code, s.emotion.emotions, s.targets.prefer_topics) == (12.0, 0.02, 25.0, "en-IN", ("neutral", "sad"), ())
    (tmp_path / "c.yaml").write_text(YAML)
    assert settings.load(str(tmp_path / "c.yaml")) is settings.load(str(tmp_path / "c.yaml"))
    for bad, said in (("channels: 1", "channels: one"), ("channels: 1", "channels: true"), ("channels: 1", "channels: 1, more: 2"), ("license: cc", "other: cc"), ("license: cc", ""), ("[neutral, sad]", "neutral"), ("{license: cc}", "cc")):
        with pytest.raises(ValueError):
            settings.parsed(YAML.replace(bad, said))
    with pytest.raises(ValueError):
        settings.parsed("")


def test_provenance_and_licence(spark, tmp_path):
    (tmp_path / "a.meta.json").write_text(json.dumps({"video_id": "v", "title": "T", "channel": "C", "upload_date": "20240101", "license": "", "url": "u", "duration_s": 3.0, "audio_path": "p"}))
    (tmp_path / "b.meta.json").write_text(json.dumps({"license": "own"}, indent=1))
    p = readers.provenance(spark, f"{tmp_path}/*.meta.json")
    assert readers.provenance(spark, f"{tmp_path}/none/*.json").count() == 0
    segments = spark.createDataFrame([(k, k, "old") for k in "abc"], "id string, source_id string, license string")
    sources = spark.createDataFrame([("a", "declared"), ("c", None)], "id string, license string")
    got = {r.id: r for r in joins.with_provenance(segments, p, sources).collect()}
    assert [got[k].license for k in "abc"] == ["declared", "own", "unknown"] and (got["a"].source_url, got["a"].source_title, got["b"].source_title, got["c"].source_url) == ("u", "T", "", "")


SEGMENT = "id string, source_id string, speaker_id string, language string, language_code string, transcript string, duration_s double, clipped_fraction double, snr_db double, silence_ratio double, gap_energy_ratio double, asr_language_probability double, asr_language_code string, features struct<voiced_fraction:double,rms_mean:double,hnr_mean:double>, status string, flags array<string>, emotion string, style string, emotion_confidence double, emotion_rationale string, tag_source string, review_decision string, topic_category string, dnsmos_ovrl double"


def segment(i, text="some words that are said", source="s", status="pass", features=(0.9, 0.1, 20.0), snr=30.0, emotion="old", decision=None, seconds=5.0, ovrl=3.5):
    return (i, source, "p", "en", "en", text, seconds, 0.0, snr, 0.1, 0.1, 0.9, "en", features, status, [], emotion, "narrative", 0.9, "", "auto", decision, None, ovrl)


def test_tags_of_answers(spark):
    whisper = (0.1, 0.01, 5.0)
    rows = [segment("a"), segment("b"), segment("c", status="reject"), segment("d"), segment("e", features=whisper), segment("f", features=(0.9, 0.5, 20.0))]
    said = [("a", '{"emotion": " SAD", "style": "narrative", "confidence": 1.7, "rationale": "%s"}' % ("r" * 200)), ("b", '```json\n{"emotion": "odd", "confidence": "0.5"}\n```'), ("c", '{"emotion": "sad"}'), ("d", "no"), ("e", '{"emotion": "sad", "confidence": 0.9, "rationale": ""}')]
    d = commands.retag(spark.createDataFrame(rows, SEGMENT), spark.createDataFrame(said, "id string, answer string"), ("neutral", "sad"), ("narrative", "whisper"))
    got = {r.id: r for r in d.collect()}
    assert (got["a"].emotion, got["a"].emotion_confidence, got["a"].emotion_rationale, got["a"].status) == ("sad", 1.0, "r" * 160, "pass")
    assert (got["b"].emotion, got["b"].emotion_confidence, got["b"].status, got["b"].flags) == ("neutral", 0.5, "flag", ["low_emotion_confidence"])
    assert (got["c"].emotion, got["c"].status, got["c"].flags) == ("old", "reject", [])
    assert (got["d"].emotion, got["d"].emotion_confidence, got["d"].emotion_rationale) == ("neutral", 0.3, "fallback (no/invalid LLM output)") and got["f"].emotion == "neutral"
    assert (got["e"].style, got["e"].emotion_rationale) == ("whisper", "whisper set acoustically") and got["e"].features_z.rms_mean < -0.4 and got["e"].features_z.f0_mean == 0


def test_requalify(spark):
    words = "the very same words are said here"
    rows = [segment("a", words), segment("b", words), segment("c", words, source="t"), segment("d", "other words", snr=1.0, status="pass"), segment("e", "quite another text", status="reject")]
    got = {r.id: r for r in commands.requalify(spark.createDataFrame(rows, SEGMENT)).collect()}
    assert {k: r.status for k, r in got.items()} == {"a": "pass", "b": "reject", "c": "pass", "d": "reject", "e": "pass"}
    assert got["b"].reject_reasons == ["duplicate"] and got["d"].reject_reasons[0].startswith("low_snr") and got["b"].emotion == "old"
    counts = commands.kept_by_source(commands.requalify(spark.createDataFrame(rows, SEGMENT))).collect()
    assert {tuple(r) for r in counts} == {("s", 2, 4), ("t", 1, 1)}


def test_review_merge_counts(spark):
    d = spark.createDataFrame([segment(k) for k in "abcd"], SEGMENT)
    said = spark.createDataFrame([("a", "Accept ", "", "", ""), ("b", "reject", "sad", "", "new"), ("c", "", "sad", "", "fixed text"), ("x", "accept", "", "", "")], "id string, decision string, emotion string, style string, transcript string")
    after, counts = commands.review_merge(d, said)
    got = {r.id: r for r in after.collect()}
    assert (got["a"].review_decision, got["b"].review_decision, got["b"].emotion, got["c"].emotion, got["c"].tag_source, got["d"].tag_source) == ("accept", "reject", "old", "sad", "human", "auto")
    assert tuple(counts.first()) == (1, 1, 1, 1)


def test_build_and_its_sinks(spark, tmp_path):
    rows = [segment(f"{k}", emotion="sad" if k % 3 else "calm", seconds=6.0 + k, decision="reject" if k == 5 else None, ovrl=2.0 + k / 4) for k in range(12)]
    d = spark.createDataFrame(rows, SEGMENT).withColumn("audio", F.concat(F.lit("clips/"), "id", F.lit(".wav")))
    records, stats = commands.build(d, 0.75)
    chosen = records.collect()
    total = sum(r.duration for r in chosen)
    assert 45 <= total < 45 + max(r.duration for r in chosen) and "clips/5.wav" not in {r.audio for r in chosen}
    s = stats.first()
    assert (s.clips, s.minutes, s.speakers) == (len(chosen), round(total / 60, 2), 1)
    candidates, mix = commands.shown(d)
    assert [tuple(r) for r in candidates.collect()] == [("en", "pass", 12, round(sum(r[6] for r in rows) / 60, 1))] and [tuple(r)[1:] for r in mix.collect()] == [("sad", 7), ("calm", 4)]
    writers.final_selection(records, {"per_language": stats}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/records")).count() == len(chosen)
    assert json.loads("\n".join(r.value for r in spark.read.text(str(tmp_path / "out/stats"), wholetext=True).collect()))["per_language"][0]["clips"] == len(chosen)
    sheet = writers.audit_rows(records, 3).collect()
    assert len(sheet) == 3 and sheet[0].audio == f"clips/{sheet[0].id}.wav" and sheet[0].notes == ""
    page = writers.audit_page(spark.createDataFrame([("a</script>", "en", "t", "q.wav")], "id string, language string, transcript string, audio string"))
    assert "a<\\/script>" in page and page.count("</script>") == 1


def test_evaluation_section():
    assert writers.evaluation({"speaker": None, "words": {}}) == ""
    said = writers.evaluation({"speaker": {"within_cosine": 0.712, "between_cosine": 0.21, "auc": 0.98, "eer": 0.034, "flagged": 0}, "words": {"mean": 0.0512, "n": 40}, "phonemes": {"te": 0.9, "en": 1.0}, "judge": {"clean_percent": 98.0, "suitable_percent": None, "supported_percent": 71.0}, "audit": {"en": "93%"}, "emotion": {"kappa": 0.5}})
    assert [x for x in said.splitlines() if x.startswith("-")] == [
        "- **Single speaker**: same speaker cosine 0.71, different speaker cosine 0.21, AUC 0.98, EER 3.4%, flagged speakers 0.", "- **Transcripts**: word error rate 5.1%, clips 40.", "- **Emotion tags**: kappa 0.50.",
        "- **Phonemes, en**: coverage 100%.", "- **Phonemes, te**: coverage 90%.", "- **Larger model**: clean transcripts 98 %, emotion supported 71 %.", "- **Listening audit, en**: yes 93%.",
    ]


def test_lookups(spark):
    docs = {'{"a": {"b": "x"}}': "x", '{"a": {"b": null}}': None, '{"a": {}}': "?", '{"a": 5}': "?", "[1]": "?", "no": "?", '{"a": {"b": {"c": 1}}}': '{"c":1}', None: "?"}
    d = spark.createDataFrame([(k,) for k in docs], "j string")
    assert {r.j: r.v for r in d.select("j", T.looked_up(F.col("j"), "a", "b", default=F.lit("?")).alias("v")).collect()} == docs


def test_recipes(spark):
    rows = [(1, True, False, False, 0.9, "sad", "fiction", False, False), (2, True, True, False, 0.9, "neutral", "news", True, False), (3, False, False, False, None, None, None, False, True)]
    d = spark.createDataFrame(rows, "id int, dnsmos_pass boolean, quality_flag boolean, has_truncation boolean, emotion_confidence double, emotion string, topic string, transcript_review_needed boolean, emotion_low_confidence boolean")
    names = rules.recipe_views(d, "set_")
    assert {n: [r.id for r in spark.table(n).orderBy("id").collect()] for n in names} == {"set_studio": [1], "set_expressive": [1], "set_storytelling": [1], "set_review_queue": [2, 3]}


def test_zipped(spark):
    a, b = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(10.0,), (30.0,)], "x double")
    got = joins.zipped(a, b, [F.col("k")], [F.col("x").desc()]).orderBy("place").collect()
    assert [(r.left.v, r.right.x) for r in got] == [("a", 30.0), ("b", 10.0)]

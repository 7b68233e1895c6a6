from pyspark.sql import functions as F

from quernstone.plans import workflow


def test_clips_follow_the_dominant_speaker(spark):
    chunks = [("s", "a", 0.0, 4.0, "one"), ("s", "b", 4.1, 4.3, "hm"), ("s", "a", 4.35, 9.0, "two"), ("s", "a", 12.0, 16.0, "three"), ("s", "b", 20.0, 21.0, "bye")]
    got = workflow.clips(spark.createDataFrame(chunks, "source_id string, speaker_id string, start_s double, end_s double, text string")).orderBy("id").collect()
    assert [(r.id, r.speaker_id, r.start_s, r.end_s, r.transcript_batch) for r in got] == [("s_0000", "a", 0.0, 9.0, "one two"), ("s_0001", "a", 12.0, 16.0, "three")]


def test_qualify_marks_twins_among_what_gates_keep(spark):
    cols = "id string, speaker_id string, transcript string, language string, language_code string, duration_s double, clipped_fraction double, snr_db double, silence_ratio double, gap_energy_ratio double, asr_language_probability double, asr_language_code string, f double"
    row = lambda i, t, d: (i, "p", t, "en", "en", d, 0.0, 30.0, 0.1, 0.1, 0.9, "en", 1.0)
    d = spark.createDataFrame([row("a", "the same words here", 2.0), row("b", "the same words here", 5.0), row("c", "here the same words", 5.0), row("d", "quite another text", 5.0)], cols)
    got = {r.id: r for r in workflow.qualify(d, ["f"]).collect()}
    assert [got[k].status for k in "abcd"] == ["reject", "pass", "reject", "pass"]
    assert got["a"].reject_reasons == ["duration_out_of_range"] and got["c"].reject_reasons == ["duplicate"]


def test_voices(spark):
    d = spark.createDataFrame([("x", 100.0, "en"), ("x", 0.0, "en"), ("x", 120.0, "en"), ("y", None, "te"), ("z", 90.0, "te")], "speaker_id string, f0_mean double, language string")
    got = {(r.speaker_id, r.gender, r.accent) for r in workflow.voices(d, {"z": "female"}, {"en": "indian"}).collect()}
    assert got == {("x", "male", "indian"), ("y", "female", "te"), ("z", "female", "te")}


def test_records_have_defaults(spark):
    d = spark.createDataFrame([("a", "Say 2.", "en", 1.23456, "", None)], "id string, transcript string, language string, duration_s double, annotated_text string, dnsmos_ovrl double")
    r = workflow.narrowed(workflow.records(d)).first()
    assert (r.text, r.normalized_text, r.annotated_text, r.dnsmos_pass, r.has_laughter, r.annotation_flags, r.emotion) == ("Say 2.", "Say two.", "Say 2.", False, False, "", None)
    assert abs(r.duration - 1.235) < 1e-6 and len(r) == 45


def test_corrections(spark):
    rows = [(1, "a b c", "a b c d", "en"), (2, "a b", "a b c d e f g", "en"), (3, "a b!", "A b", "en"), (4, "a b c", "a b c d", "te"), (5, "", "a", "en")]
    got = workflow.corrections(spark.createDataFrame(rows, "id int, transcript_batch string, transcript string, language string"))
    assert [r.id for r in got.collect()] == [1]


def test_windows(spark):
    d = spark.createDataFrame([(1, 20.3), (2, 0.4), (3, 25.0)], "id int, d double")
    assert sorted((r.id, r.w_start) for r in workflow.tumbling(d, "d", 10.0, 0.5).collect()) == [(1, 0.0), (1, 10.0), (3, 0.0), (3, 10.0), (3, 20.0)]
    assert workflow.sliding(d, "d", 2.0, 1.0).where("id = 1").count() == 19 and workflow.sliding(d, "d", 2.0, 1.0).where("id = 2").count() == 0
    a, b = workflow.centred(F.col("d"), 8.0)
    assert [tuple(r) for r in d.select(a, b).collect()][1:] == [(0.0, 0.4), (8.5, 16.5)]

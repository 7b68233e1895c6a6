import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions import audio
from quernstone.operators import joins, metrics
from quernstone.sources import readers, writers
from quernstone.streaming import sessions


def test_later_scores_win_and_a_present_null_counts(spark):
    s = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    one = spark.createDataFrame([("a", 1.0, "en"), ("b", 2.0, "en"), ("zz", 9.0, "en")], "id string, m double, language string")
    two = spark.createDataFrame([("b", None)], "id string, m double")
    got = joins.score_merge(s, [one, two])
    assert got.columns == ["id", "m"] and {r.id: r.m for r in got.collect()} == {"a": 1.0, "b": None, "c": None}


def test_review_merge(spark):
    cols = "id string, transcript string, emotion string, style string, emotion_confidence double, tag_source string, review_decision string"
    s = spark.createDataFrame([(i, "old", "sad", "story", 0.4, "auto", None) for i in "abcd"], cols)
    d = spark.createDataFrame([("a", "REJECT", "happy", "", ""), ("b", " accept ", "Happy", "", "new"), ("c", "", "sad", "", None), ("x", "reject", "", "", "")], "id string, decision string, emotion string, style string, transcript string")
    got = {r.id: r for r in joins.review_merge(s, d).collect()}
    assert (got["a"].review_decision, got["a"].emotion, got["a"].tag_source) == ("reject", "sad", "auto")
    assert (got["b"].review_decision, got["b"].emotion, got["b"].transcript, got["b"].tag_source, got["b"].emotion_confidence) == ("accept", "happy", "new", "human", 1.0)
    assert got["c"].tag_source == "auto" and got["d"].review_decision is None and len(got) == 4


def plain_kappa(pairs):
    n = len(pairs)
    po = sum(a == b for a, b in pairs) / n
    pe = sum(sum(a == l for a, _ in pairs) * sum(b == l for _, b in pairs) for l in {x for p in pairs for x in p}) / n**2
    return po, (po - pe) / (1 - pe) if pe != 1 else None


def test_kappa(spark):
    rng = random.Random(1)
    for pairs in ([(0, 0)] * 5, [(0, 0), (1, 1)], [(rng.randrange(3), rng.randrange(3)) for _ in range(50)]):
        r = metrics.kappa(metrics.confusion(spark.createDataFrame(pairs, "a int, b int"), F.col("a"), F.col("b"))).first()
        po, k = plain_kappa(pairs)
        assert r.agreement == pytest.approx(po, abs=1e-6) and (r.kappa is None if k is None else r.kappa == pytest.approx(k, abs=1e-6))


def test_krippendorff_on_the_textbook_example(spark):
    coders = ["*****34121113311*3"[: 0] or "* * * * * 3 4 1 2 1 1 3 3 * 3", "1 * 2 1 3 3 4 3 * * * * * * *", "* * 2 1 3 4 4 * 2 1 1 3 3 * 4"]
    rows = [(u, int(v)) for c in coders for u, v in enumerate(c.split()) if v != "*"]
    assert metrics.krippendorff(spark.createDataFrame(rows, "u int, l int"), "u", "l").first().alpha == pytest.approx(0.691, abs=5e-4)


def test_auc_and_equal_error(spark):
    rng = random.Random(2)
    rows = [(round(rng.random() + 0.3 * y, 1), y) for y in (0, 1) for _ in range(60)]
    d = spark.createDataFrame(rows, "s double, y int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert metrics.roc_auc(d, "s", "y").first().auc == pytest.approx(auc, abs=1e-6)
    at = [(round(abs(sum(p < t for p in pos) / 60 - sum(n >= t for n in neg) / 60), 9), -t) for t in {s for s, _ in rows}]
    t = -min(at)[1]
    got = metrics.equal_error(d, "s", "y").first()
    assert got.threshold == t and got.eer == pytest.approx((sum(p < t for p in pos) + sum(n >= t for n in neg)) / 120, abs=1e-6)
    assert metrics.roc_auc(d.where("y = 1"), "s", "y").first().auc is None


def test_cohesion_and_balance(spark):
    v = np.random.default_rng(0).normal(size=(9, 5))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(int(k > 0), [float(x) for x in u]) for k, u in enumerate(v)]
    got = {r.g: r.within for r in metrics.cohesion(spark.createDataFrame(rows, "g int, v array<double>"), "g", "v").collect()}
    w = v[1:] @ v[1:].T
    assert got[0] == 1.0 and got[1] == pytest.approx((w.sum() - 8) / 56, abs=1e-6)
    counts = spark.createDataFrame([("a", 1), ("a", 1), ("b", 9), ("c", 3), ("c", 1)], "g string, n int")
    b = {r.g: r.balance for r in metrics.balance_index(counts, ["g"]).collect()}
    assert b["a"] == 1.0 and b["b"] == 0.0 and b["c"] == pytest.approx(0.5)
    e = {r.g: r.entropy for r in metrics.entropy(counts, ["g"]).collect()}
    assert e == {"a": 1.0, "b": 0.0, "c": round(-(0.75 * math.log2(0.75) + 0.25 * math.log2(0.25)), 3)}


def test_leaks(spark):
    d = spark.createDataFrame([("x", "train"), ("x", "test"), ("y", "test"), ("x", "validation")], "t string, split string")
    assert sorted(tuple(r) for r in joins.leaks(d, F.col("t")).collect()) == [("test", "x"), ("validation", "x")]


def test_manifests_round_trip(spark, tmp_path):
    (tmp_path / "a.segments.json").write_text(json.dumps([{"id": "a_0000", "source_id": "a", "duration_s": 4.5, "features": {"f0_mean": 120.0}, "status": "pass"}]))
    d = readers.segments(spark, f"{tmp_path}/*.segments.json")
    r = d.first()
    assert (r.id, r.transcript, r.reject_reasons, r.license, r.features.f0_mean, r.emotion) == ("a_0000", "", [], "unknown", 120.0, None)
    assert readers.segments(spark, f"{tmp_path}/none/*.json").count() == 0
    writers.save_segments(d.drop("file"), f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out").count() == 1
    assert '"a_0000"' in writers.review_page(d)


def test_diarization_and_sheets(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"transcript": "all", "diarized_transcript": {"entries": [{"transcript": "hi", "start_time_seconds": 1.0, "end_time_seconds": 2.0}]}, "timestamps": {"words": ["hi", "ho"], "start_time_seconds": [0.0, 1.0], "end_time_seconds": [1.0, 2.0]}}))
    r = readers.diarization(spark, f"{tmp_path}/x.json").first()
    assert (r.text, r.speaker_id, r.start_s, r.language_code) == ("hi", "0", 1.0, "")
    assert [w.word for w in readers.word_times(spark, f"{tmp_path}/x.json").orderBy("n").collect()] == ["hi", "ho"]
    rows = spark.createDataFrame([("a", "accept", None, 'say "so"\nand go')], "id string, decision string, emotion string, transcript string")
    writers.sheet(rows.select("id", "decision", "emotion", F.lit("").alias("style"), "transcript"), f"{tmp_path}/sheet")
    assert tuple(readers.sheet(spark, f"{tmp_path}/sheet").first()) == ("a", "accept", "", "", 'say "so"\nand go')


def test_scores_and_sources(spark, tmp_path):
    from pyspark.sql import types as t

    (tmp_path / "s.json").write_text(json.dumps({"a": {"m": 1.5}, "b": {}}))
    schema = t.StructType([t.StructField("m", t.DoubleType())])
    assert {r.id: r.m for r in readers.scores(spark, f"{tmp_path}/s.json", schema).collect()} == {"a": 1.5, "b": None}
    assert readers.scores(spark, f"{tmp_path}/none.json", schema).count() == 0
    r = readers.source_list(spark, "sources:\n- {id: a, url: u, language: en, max_minutes: 3}\n").first()
    assert (r.id, r.enabled, r.max_minutes, r.title) == ("a", True, 3.0, None)
    assert readers.source_list(spark, "").count() == 0


def test_signals(spark, tmp_path):
    rate = 16000
    t = np.arange(rate) / rate
    tone = (0.5 * np.sin(2 * np.pi * 220 * t)).astype(np.float32)
    y = np.concatenate((np.zeros(rate), tone, np.zeros(rate))).astype(np.float32)
    assert len(audio.speech_intervals(y, rate)) == 1 and audio.speech_intervals(np.zeros(rate), rate) == []
    assert audio.silence_ratio(np.zeros(0), rate) == 1.0 and 0.5 < audio.silence_ratio(y, rate) < 0.7 and audio.silence_ratio(tone, rate) < 0.2
    assert abs(audio.peak_level(audio.peak_normalize(tone)) - 10 ** (-1 / 20)) < 1e-3
    assert audio.peak_level(audio.loudness_normalize(tone, rate)) <= 10 ** (-1 / 20) + 1e-6
    assert audio.clipped_fraction(np.ones(10)) == 1.0 and audio.snr_db(y, rate) > 40 and audio.snr_db(np.zeros(100), rate) == 0.0
    f0 = audio.pitch(tone, rate)
    assert abs(np.median(f0[f0 > 0]) - 220) < 6
    assert abs(audio.roll_off(tone, rate) - 220) < 40
    assert audio.resample(tone, rate, 8000).size == 8000
    back, r = audio.read_wav(audio.write_wav(tone, rate))
    assert r == rate and np.abs(back - tone).max() < 1e-3
    (tmp_path / "a.wav").write_bytes(audio.write_wav(y, rate))
    m = audio.measured(readers.recordings(spark, f"{tmp_path}/a.wav")).first()
    assert m.duration_s == 3.0 and abs(m.lead_s - 1.0) < 0.05


def test_sessions_as_a_stream(spark, tmp_path):
    e = spark.sql("select user_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, m) as ts, 'v' as event_type, 1.0D as value from values (1, 0), (1, 30), (1, 200), (2, 5), (9, 9999) as t(user_id, m)")
    e.write.parquet(f"{tmp_path}/in")
    expected = sorted(tuple(r) for r in sessions.sessions(e).collect())
    s = sessions.sessions(sessions.stream(spark, f"{tmp_path}/in", e.schema), late="1 minute")
    q = s.writeStream.format("memory").queryName("sess").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.table("sess").collect())
    assert got == expected[:3] and expected[0][3] == 2  # the last session is still open at the watermark

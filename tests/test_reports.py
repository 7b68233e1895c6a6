"""Answers of models, scores under several names, and trials, on rows that the driver's tables lack."""

import json
import math

from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import reports


def test_extracted_json(spark):
    good = '{"a": {"b": 1}}'
    cases = {
        good: good, f"```json\n{good}\n```": good, f"```\n{good}```": good, f"so {{x}} {good} and {{}}": good, f"}} {good}": good, "[1, 2]": "[1, 2]",
        "no json": None, "{open": None, "": None, "{a} {b}": None, "``` ```": None,
    }
    d = spark.createDataFrame([(k,) for k in cases] + [(None,)], "answer string")
    got = {r.answer: r.j for r in d.select("answer", T.extracted_json(F.col("answer")).alias("j")).collect()}
    assert {k: v and json.loads(v) for k, v in got.items()} == {k: v and json.loads(v) for k, v in cases.items()} | {None: None}


def test_judgement_puts_each_field_in_range(spark):
    rows = [
        ('{"topic_category": " NEWS", "tts_suitable": 7, "transcript_clean": 1, "emotion_supported": "false"}', ("news", "", 1.0, True, True, "")),
        ('{"topic_category": "x", "tts_suitable": "bad", "transcript_clean": 0, "emotion_supported": false, "topic": "%s", "issue": "%s"}' % ("t" * 70, "i" * 90), ("other", "t" * 60, 0.0, False, False, "i" * 80)),
        ('{"tts_suitable": 0.126, "transcript_clean": null, "emotion_supported": true}', ("other", "", 0.13, False, True, "")),
        ("{}", ("other", "", 0.0, False, False, "")),
        (None, None),
    ]
    d = spark.createDataFrame([(r[0],) for r in rows], "j string")
    got = [r.x and tuple(r.x) for r in d.select(T.judgement(F.col("j"), ("news",)).alias("x")).collect()]
    assert got == [r[1] for r in rows]


def test_phonemes_scores_and_seconds(spark):
    d = spark.createDataFrame([("AH0", {"b": 2.0}, "1.5\n"), (" ", {"a": 1.0, "b": 2.0}, "N/A"), ("N,", {}, None), (None, None, "")], "t string, m map<string,double>, s string")
    got = d.select(T.phoneme(F.col("t")), T.first_present(F.col("m"), ("a", "b")), T.probed_seconds(F.col("s"))).collect()
    assert [r[0] for r in got] == ["AH", None, None, None]
    assert [r[1] for r in got[:2]] == [2.0, 1.0] and all(math.isnan(r[1]) for r in got[2:])
    assert [r[2] for r in got] == [1.5, 0.0, 0.0, 0.0]


def test_reports_on_an_empty_table(spark):
    none = spark.createDataFrame([], "g string, lead_s double, trail_s double, speech_s double, total_s double, rolloff_hz double, above_8khz double")
    assert reports.pauses(none, ["g"]).count() == reports.edges(none, ["g"]).count() == reports.bandwidth(none, ["g"]).count() == 0
    assert reports.histograms(none, ["g"], ["lead_s"]).count() == 0

import pytest
from pyspark.sql import functions as F

from quernstone.functions import numbers
from quernstone.functions import text as T
from quernstone.operators import rules


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'boolean' if isinstance(v, bool) else 'int'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("r")).first().r


@pytest.mark.parametrize(("n", "said"), [(0, "zero"), (7, "seven"), (21, "twenty-one"), (100, "one hundred"), (342, "three hundred and forty-two"), (1005, "one thousand and five"), (10000, "ten thousand"), (1234567, "one million, two hundred and thirty-four thousand, five hundred and sixty-seven")])
def test_cardinals(n, said):
    assert numbers.cardinal(n) == said


@pytest.mark.parametrize(("n", "said"), [(1, "first"), (12, "twelfth"), (20, "twentieth"), (23, "twenty-third"), (101, "one hundred and first")])
def test_ordinals(n, said):
    assert numbers.ordinal(n) == said


@pytest.mark.parametrize(
    ("text", "language", "said"),
    [
        ("  Two   words ", "en", "Two words"),
        ("I saw 3 birds", "en", "I saw three birds"),
        ("it cost $5", "en", "it cost five dollars"),
        ("Rs. 40 only", "en", "forty rupees only"),
        ("Dr. Rao, e.g. him", "en", "doctor Rao, for example him"),
        ("the 2nd of 10,000", "en", "the second of ten thousand"),
        ("pi is 3.14", "en", "pi is three point one four"),
        ("50% & more", "en", "fifty percent and more"),
        ("Dr. Rao has 2", "xx", "Dr. Rao has two"),
        ("9" * 30, "en", "9" * 30),
        ("", "en", ""),
    ],
)
def test_spoken_text(spark, text, language, said):
    assert one(spark, numbers.spoken(F.col("t"), F.col("l")), t=text, l=language) == said


def test_jaccard_and_tokens(spark):
    j = lambda a, b: one(spark, T.jaccard(T.token_set(F.col("a")), T.token_set(F.col("b"))), a=a, b=b)
    assert j("A b c", "a B c") == 1.0 and j("a b", "c d") == 0.0 and j("", "a") == 0.0 and j("a b c", "a b d") == 0.5


def test_latin_fraction(spark):
    f = lambda t: one(spark, T.latin_fraction(F.col("t")), t=t)
    assert f("abc") == 1.0 and f("తెలుగు") == 0.0 and f("123 !") == 0.0 and 0 < f("ok తెలు") < 1


def test_word_error_rate(spark):
    w = lambda a, b: one(spark, T.word_error_rate(F.col("a"), F.col("b")), a=a, b=b)
    assert w("the cat sat", "the cat sat") == 0.0 and w("the cat sat", "the dog sat") == pytest.approx(1 / 3) and w("a b", "a b c d") == 1.0 and w("a b c", "") == 1.0 and w("", "a") is None


def test_z_levels_and_quadrants(spark):
    z = lambda v: one(spark, T.z_level(F.col("v")), v=v)
    assert [z(v) for v in (1.0, 0.4, 0.0, -0.4, -1.0)] == ["much higher than usual", "higher than usual", "around this speaker's average", "lower than usual", "much lower than usual"]
    q = lambda v, a: one(spark, T.quadrant(F.col("v"), F.col("a")), v=v, a=a)
    assert [q(0.9, 0.9), q(0.1, 0.9), q(0.5, 0.6), q(0.5, 0.4), q(0.45, 0.4), q(0.5, 0.5), q(0.55, 0.5)] == ["excited", "angry", "happy", "calm", "sad", "neutral", "happy"]


def test_truncation_and_annotation(spark):
    t = lambda x: one(spark, T.truncated(F.col("x")), x=x)
    assert not t("Done.") and t("cut off") and not t("  ") and not t('he said "so"')
    a = lambda x, l: one(spark, T.annotated(F.col("x"), F.col("l")), x=x, l=l)
    assert a("అది very good అని.", "te") == "అది [very good] అని." and a("cut off .", "en") == "cut off ." and a("cut off", "en") == "cut off —"


def test_long_latin_run_is_bracketed(spark):
    run = " ".join(["it's well-known"] * 40_000)
    got = spark.createDataFrame([(f"అది {run}  4 ab\nc.", "te")], "x string, l string").select(T.annotated(F.col("x"), F.col("l")).alias("r")).first().r
    assert got == f"అది [{run}]  4 [ab\nc]."


def test_labels(spark):
    assert one(spark, T.folded_label(F.col("x")), x="Anger/x") == "angry" and one(spark, T.folded_label(F.col("x")), x="odd") == "neutral"
    assert one(spark, T.first_known(F.col("x"), ("angry", "sad")), x="生气/Angry") == "angry" and one(spark, T.first_known(F.col("x"), ("sad",)), x="x") == "other"
    assert one(spark, T.checked_confidence(F.col("x")), x="1.7") == 1.0 and one(spark, T.checked_confidence(F.col("x")), x="bad") == 0.3
    assert one(spark, T.yes_no(F.col("x")), x=" Yes ") is True and one(spark, T.yes_no(F.col("x")), x="maybe") is None


def test_whisper_gate_takes_missing_as_loud(spark):
    w = lambda v, r, h: one(spark, rules.whispered(F.col("v").cast("double"), F.col("r").cast("double"), F.col("h").cast("double")), v=v, r=r, h=h)
    assert w(0.1, -0.9, 3.0) and not w(0.1, -0.9, None) and not w(None, -0.9, 3.0) and not w(0.3, -0.9, 3.0)


def test_kept(spark):
    k = lambda s, d: one(spark, rules.kept(F.col("s"), F.col("d")), s=s, d=d)
    assert k("pass", None) and k("flag", None) and not k("reject", None) and not k("candidate", None) and k("reject", "accept") and not k("pass", "reject")


def test_gates_on_their_limits(spark):
    cols = "id int, transcript string, language string, language_code string, duration_s double, clipped_fraction double, snr_db double, silence_ratio double, gap_energy_ratio double, asr_language_probability double, asr_language_code string"
    rows = [
        (1, "a good sentence", "en", "en", 3.0, 0.01, 15.0, 0.45, 0.32, 0.60, "en"),
        (2, "   ", "en", "en", 25.1, 0.011, 14.9, 0.46, 0.1, 0.59, "en"),
        (3, "hello there friend", "te", "te", 5.0, None, None, None, 0.5, None, "hi"),
        (4, "x" * 40, "en", "en", 0.0, 0.0, 20.0, 0.1, 0.1, 0.9, ""),
    ]
    got = {r.id: r for r in rules.gate(spark.createDataFrame(rows, cols)).collect()}
    assert got[1].status == "pass" and got[1].reject_reasons == []
    assert got[2].reject_reasons == ["empty_transcript", "clipping(0.011)", "low_snr(14.9dB)", "too_much_silence(0.46)", "duration_out_of_range", "low_asr_conf(0.59)"]
    assert got[3].status == "flag" and got[3].flags == ["music_or_noise_bed(0.50)", "lang_mismatch(hi)", "code_mixed(1.00)"]
    assert got[4].reject_reasons == ["char_rate(0.0)", "duration_out_of_range"]
    counts = {r.reason: r.n for r in rules.reason_counts(rules.gate(spark.createDataFrame(rows, cols)), ("low_snr", "duplicate")).collect()}
    assert counts["low_snr"] == 1 and counts["duplicate"] == 0 and counts["duration_out_of_range"] == 2


def test_low_confidence_is_flagged_once(spark):
    d = spark.createDataFrame([(0.5, "pass", []), (0.5, "reject", ["low_emotion_confidence"]), (None, "pass", [])], "emotion_confidence double, status string, flags array<string>")
    assert [tuple(r) for r in rules.low_confidence(d).select("status", F.size("flags")).collect()] == [("flag", 1), ("reject", 1), ("pass", 0)]


def test_telugu_numbers_and_composed_forms(spark):
    from quernstone.functions import numbers, text

    said = spark.createDataFrame([("16 \u0c38\u0c48\u0c28\u0c3f\u0c15\u0c41\u0c32\u0c41 1,00,000 2.5 90210345", "te"), ("5 apples", "xx"), (None, "te")], "t string, lang string").select(numbers.spoken(F.col("t"), F.col("lang")).alias("s")).collect()
    assert not any(c.isascii() and c.isalnum() for c in said[0].s) and "\u0c38\u0c48\u0c28\u0c3f\u0c15\u0c41\u0c32\u0c41" in said[0].s
    assert said[1].s == "five apples" and said[2].s is None
    assert numbers.telugu(100_000) == numbers.TELUGU_LARGE[1][1]
    two = spark.createDataFrame([("Caf\u00e9!", "Cafe\u0301!")], "a string, b string").select(*[f(F.col(c)) for f in (text.comparison_form, text.recognition_form) for c in "ab"]).first()
    assert len(set(two)) == 1

"""Queries of the report rollups and of answers from models, beside the catalogue's. Importing this module adds them to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import reports
from quernstone.plans.catalog import ORACLES, RATED, SEG, SPLIT, WORDS, cer, query, rated, segments, split_documents, table

#: Measures that the driver tables lack, as fractions of whole numbers so that both engines agree.
CLIPS = {
    "lead_s": "(doc_id % 7) / 20.0D", "trail_s": "(doc_id % 5) / 25.0D", "speech_s": "n_chars / 20.0D", "total_s": "n_chars / 15.0D",
    "rolloff_hz": "4000.0D + (doc_id % 97) * 100", "above_8khz": "(doc_id % 19) / 2000.0D", "cohesion": "(doc_id % 83) / 100.0D",
    "laughter": "(doc_id % 11) / 10.0D", "cough": "(doc_id % 31) / 100.0D", "breath": "(doc_id % 53) / 100.0D", "music": "(doc_id % 101) / 250.0D",
}
CLIP = "clip AS (SELECT doc_id, lang, source, " + ", ".join(f"{e.replace('0D', '0::DOUBLE')} AS {n}" for n, e in CLIPS.items()) + " FROM documents)"


def clips(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", *[F.expr(e).alias(n) for n, e in CLIPS.items()])


# --- clips -------------------------------------------------------------------------------------------------------


@query("pause_stats", f"""WITH {CLIP} SELECT lang, round(avg(lead_s), 3) AS mean_leading_s, round(avg(trail_s), 3) AS mean_trailing_s, round(avg(greatest(0, 1 - (speech_s + lead_s + trail_s) / total_s)), 3) AS mean_internal_fraction, count(*) AS clips
FROM clip WHERE total_s > 0 AND speech_s > 0 GROUP BY lang""")
def pause_stats(spark, sf):
    return reports.pauses(clips(spark, sf), ["lang"])


@query("edge_trim", f"""WITH {CLIP} SELECT lang, count(*) AS clips, round_even(median(lead_s) * 1000, 0) AS lead_ms_median, round_even(avg(lead_s) * 1000, 0) AS lead_ms_mean, round_even(median(trail_s) * 1000, 0) AS trail_ms_median, round_even(avg(trail_s) * 1000, 0) AS trail_ms_mean,
round_even(100.0::DOUBLE * count_if(lead_s > 0.15 OR trail_s > 0.15) / count(*), 0) AS long_edge_percent, round(sum(lead_s + trail_s), 1) AS trimmable_s FROM clip GROUP BY lang""")
def edge_trim(spark, sf):
    return reports.edges(clips(spark, sf), ["lang"])


@query("spectral_summary", f"""WITH {CLIP} SELECT lang, count(*) AS n, round_even(median(rolloff_hz), 0) AS rolloff_hz_median, round(median(above_8khz) * 100, 2) AS above_8khz_median_percent, round_even(100.0::DOUBLE * count_if(above_8khz > 0.005) / count(*), 0) AS wideband_percent FROM clip GROUP BY lang""")
def spectral_summary(spark, sf):
    return reports.bandwidth(clips(spark, sf), ["lang"])


@query("overlap_summary", f"WITH {CLIP} SELECT lang, count_if(cohesion < 0.4)::BIGINT AS flagged, count(*) AS clips, round(median(cohesion), 3) AS median_cohesion FROM clip GROUP BY GROUPING SETS ((lang), ())")
def overlap_summary(spark, sf):
    return reports.overlap(clips(spark, sf), ["lang"], 0.4)


@query("speech_events", f"WITH {CLIP}, t AS (SELECT lang, unnest(['laughter', 'cough', 'breath', 'music']) AS flag, unnest([laughter, cough, breath, music]) AS p FROM clip) SELECT lang, flag, count_if(p >= 0.3)::BIGINT AS n, count(*) AS clips FROM t GROUP BY ALL")
def speech_events(spark, sf):
    return reports.flag_counts(clips(spark, sf), ["lang"], ["laughter", "cough", "breath", "music"], 0.3)


@query("label_histograms", """WITH t AS (SELECT lang, unnest(['source', 'quality', 'toxic']) AS kind, unnest([source, CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR)]) AS label FROM documents LEFT JOIN labels USING (doc_id)),
n AS (SELECT lang, kind, label, count(*) AS n FROM t WHERE label IS NOT NULL GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY lang, kind ORDER BY n DESC, label) AS place FROM n""")
def label_histograms(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    return reports.histograms(d, ["lang"], ["source", "quality", "toxic"])


@query("dataset_quality", """SELECT lang, count(*) AS clips, count(quality) AS human, list_sort(list(n_chars / 15.0::DOUBLE))[(count(*) // 2 + 1)::INT] AS align_upper_median, round(max(source_minutes), 4) AS most_minutes, round(min(source_minutes), 4) AS least_minutes
FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN (SELECT lang, source, sum(n_chars) / 900.0::DOUBLE AS source_minutes FROM documents GROUP BY ALL) USING (lang, source) GROUP BY lang""")
def dataset_quality(spark, sf):
    """Clips that people judged, an upper median, and the most and least minutes of a speaker."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    per = d.groupBy("lang", "source").agg((F.sum("n_chars") / 900.0).alias("m")).groupBy("lang").agg(F.round(F.max("m"), 4).alias("most_minutes"), F.round(F.min("m"), 4).alias("least_minutes"))
    upper = F.expr("percentile_disc(0.5) within group (order by n_chars / 15.0D desc)")
    return d.join(table(spark, sf, "labels"), "doc_id", "left").groupBy("lang").agg(F.count("*").alias("clips"), F.count("quality").alias("human"), upper.alias("align_upper_median")).join(per, "lang")


@query("sources_by_minutes", "SELECT lang, source, minutes, row_number() OVER (PARTITION BY lang ORDER BY minutes DESC, source) AS place FROM (SELECT lang, source, round(sum(n_chars) / 900.0::DOUBLE, 4) AS minutes FROM documents GROUP BY ALL)")
def sources_by_minutes(spark, sf):
    from pyspark.sql import Window

    m = table(spark, sf, "documents").groupBy("lang", "source").agg(F.round(F.sum("n_chars") / 900.0, 4).alias("minutes"))
    return m.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("minutes").desc(), "source"))).orderBy("lang", F.col("minutes").desc(), "source")


@query("split_labels", f"WITH {SPLIT} SELECT lang, split, quality AS label, count(*) AS n FROM split JOIN labels USING (doc_id) GROUP BY ALL")
def split_labels(spark, sf):
    return split_documents(spark, sf).select("doc_id", "lang", "split").join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id").groupBy("lang", "split", "label").agg(F.count("*").alias("n"))


@query("reading_stats", f"""WITH {SEG}, r AS (SELECT language, duration_s AS d, length(transcript) AS chars, len({WORDS}) AS words, len({WORDS}) / duration_s * 60 AS wpm FROM seg WHERE duration_s > 0)
SELECT language, round(min(d), 4) AS shortest, round(median(d), 4) AS median_duration, round(avg(d), 4) AS mean_duration, round(max(d), 4) AS longest, trunc(median(words))::BIGINT AS words, trunc(median(chars))::BIGINT AS chars, trunc(median(wpm))::BIGINT AS wpm, round(avg(wpm), 4) AS mean_wpm,
round(100.0::DOUBLE * count_if(wpm < 110) / count(*), 4) AS slow_percent, round(100.0::DOUBLE * count_if(wpm BETWEEN 110 AND 160) / count(*), 4) AS medium_percent, round(100.0::DOUBLE * count_if(wpm > 160) / count(*), 4) AS fast_percent FROM r GROUP BY language""")
def reading_stats(spark, sf):
    n = F.size(T.words(F.col("transcript")))
    s = segments(spark, sf).select("language", F.col("duration_s").alias("d"), F.length("transcript").alias("chars"), n.alias("words"), T.words_per_minute(n, F.col("duration_s")).alias("wpm")).where("d > 0")
    whole = [F.median(c).cast("long").alias(c) for c in ("words", "chars", "wpm")]
    ends = [F.round(f("d"), 4).alias(a) for f, a in ((F.min, "shortest"), (F.median, "median_duration"), (F.avg, "mean_duration"), (F.max, "longest"))]
    bands = [F.round(reports.percent(c), 4).alias(f"{a}_percent") for a, c in (("slow", F.col("wpm") < 110), ("medium", F.col("wpm").between(110, 160)), ("fast", F.col("wpm") > 160))]
    return s.groupBy("language").agg(*ends, *whole, F.round(F.avg("wpm"), 4).alias("mean_wpm"), *bands)


@query("cer_summary", f"SELECT count(*) AS n, round(avg(cer), 5) AS mean, round(median(cer), 5) AS median FROM ({ORACLES['cer']})")
def cer_summary(spark, sf):
    return cer(spark, sf).agg(F.count("*").alias("n"), F.round(F.avg("cer"), 5).alias("mean"), F.round(F.median("cer"), 5).alias("median"))


@query("phoneme_coverage", r"""WITH t AS (SELECT role, regexp_replace(unnest(string_split_regex(text, '\s+')), '[0-9]', '', 'g') AS p FROM conversations) SELECT role, count(DISTINCT p) AS phonemes, round(least(1, count(DISTINCT p) / 39.0::DOUBLE), 4) AS coverage FROM t WHERE regexp_full_match(p, '\pL+') GROUP BY role""")
def phoneme_coverage(spark, sf):
    """Turns stand for lists of phonemes, as the step that makes them is outside."""
    t = table(spark, sf, "conversations").select("role", F.explode(F.split("text", r"\s+")).alias("t")).select("role", T.phoneme(F.col("t")).alias("p")).where("p is not null")
    n = t.distinct().groupBy("role").agg(F.count("*").alias("phonemes"))
    return n.withColumn("coverage", F.round(F.least(F.lit(1.0), F.col("phonemes") / 39.0), 4))


# --- filters and lookups -------------------------------------------------------------------------------------------


@query("enabled_sources", "SELECT DISTINCT user_id, event_type FROM events WHERE user_id % 4 <> 0 AND event_type = 'view'")
def enabled_sources(spark, sf):
    """Sources that are switched on, of one language."""
    on = table(spark, sf, "events").select("user_id", "event_type", (F.col("user_id") % 4 != 0).alias("enabled"))
    return on.where("enabled and event_type = 'view'").select("user_id", "event_type").distinct()


@query("review_queue", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'en' AND n_chars > 300 AND quality IS NULL")
def review_queue(spark, sf):
    """What a reviewer sees who filters by language and status and asks for the undecided."""
    d = table(spark, sf, "documents").where("lang = 'en' and n_chars > 300").select("doc_id")
    return d.join(table(spark, sf, "labels").where("quality is not null").select("doc_id"), "doc_id", "left_anti")


@query("truthy_counts", "SELECT lang, count(quality) AS present, count_if(quality IS NOT NULL AND quality <> 0)::BIGINT AS truthy FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def truthy_counts(spark, sf):
    """A filter on what is present keeps 0, one on what is true doesn't."""
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.groupBy("lang").agg(F.count("quality").alias("present"), F.count_if(F.col("quality").isNotNull() & (F.col("quality") != 0)).alias("truthy"))


@query("score_aliases", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN value + 1 END AS score, CASE WHEN event_id % 5 = 0 THEN 0 ELSE value END AS seconds FROM events")
def score_aliases(spark, sf):
    """Scores under whichever name they have (none: null here, as not a number equals nothing), and a probe's seconds."""
    named = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("ovrl_mos"), F.col("value"))).when(F.col("event_id") % 3 == 1, F.create_map(F.lit("OVRL"), F.col("value") + 1, F.lit("ovrl"), F.lit(0.0))).otherwise(F.create_map(F.lit("other"), F.col("value")))
    said = F.when(F.col("event_id") % 5 == 0, "N/A").otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit("\n")))
    e = table(spark, sf, "events")
    return e.select("event_id", F.nanvl(T.first_present(named, ("ovrl_mos", "OVRL", "ovrl")), F.lit(None).cast("double")).alias("score"), T.probed_seconds(said).alias("seconds"))


# --- raters and voices ---------------------------------------------------------------------------------------------


@query("agreement_by_language", f"WITH {RATED} SELECT coalesce(event_type, 'all') AS event_type, count(*) AS n, round(100.0::DOUBLE * count_if(a = b) / count(*), 4) AS agreement_percent FROM r JOIN events USING (event_id) WHERE b IS NOT NULL GROUP BY GROUPING SETS ((event_type), ())")
def agreement_by_language(spark, sf):
    r = rated(spark, sf).join(table(spark, sf, "events").select("event_id", "event_type"), "event_id")
    return reports.agreement_by(r, "event_type", F.col("a"), F.col("b"))


THREE = """three AS (SELECT e.event_id, ['calm', 'sad', 'happy', 'odd'][e.user_id % 4 + 1] AS a, CASE e.event_id % 5 WHEN 0 THEN 'calm' WHEN 1 THEN 'sad' WHEN 2 THEN 'happy' ELSE 'calm' END AS b,
CASE WHEN e.event_id % 6 <> 0 THEN NULL WHEN e.event_id % 7 < 3 THEN ['calm', 'sad', 'happy'][e.event_id % 7 + 1] END AS c FROM events e WHERE e.event_id % 3 <> 0 OR e.event_id % 2 = 0)"""


def three(spark, sf):
    """Rater 2 hears all but the odd multiples of 3 and has a word of its own; rater 3 hears every sixth clip."""
    e = table(spark, sf, "events")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (n + 1).cast("int"))
    kept = e.select("event_id", pick(F.col("user_id") % 4, "calm", "sad", "happy", "odd").alias("label"))
    second = e.where("event_id % 3 <> 0 or event_id % 2 = 0").select("event_id", pick(F.col("event_id") % 5, "calm", "sad", "happy", "bored", "calm").alias("label"))
    third = e.where("event_id % 6 = 0").select("event_id", pick(F.col("event_id") % 7, "calm", "sad", "happy", "x", "y", "z", "w").alias("label"))
    return reports.three_raters(kept, second, third, "event_id", ("calm", "sad", "happy"), "calm")


@query("three_raters", f"WITH {THREE} SELECT * FROM three WHERE a <> 'odd'")
def three_raters(spark, sf):
    return three(spark, sf)


@query("disagreements", f"WITH {THREE} SELECT event_id, a, b FROM three WHERE a <> 'odd' AND a <> b ORDER BY event_id LIMIT 6")
def disagreements(spark, sf):
    """Six examples: a limit that is the feature."""
    return three(spark, sf).where("a <> b").select("event_id", "a", "b").orderBy("event_id").limit(6)


@query("audit_status", "SELECT lang, CASE WHEN count(quality) = 0 THEN 'pending' ELSE CAST(CAST(round_even(100.0::DOUBLE * avg(quality), 0) AS INT) AS VARCHAR) || '%' END AS quality FROM documents LEFT JOIN (SELECT * FROM labels WHERE doc_id % 2 = 0) USING (doc_id) GROUP BY lang, doc_id % 2 ")
def audit_status(spark, sf):
    """Percent of yes for each half of a language's documents; the half that nobody has judged is pending."""
    said = table(spark, sf, "labels").where("doc_id % 2 = 0").select("doc_id", T.yes_no(F.when(F.col("quality") == 1, "Yes").otherwise("n")).alias("yes"))
    d = table(spark, sf, "documents").select("doc_id", "lang").join(said, "doc_id", "left")
    share = F.concat(F.bround(F.avg(F.col("yes").cast("double")) * 100, 0).cast("int").cast("string"), F.lit("%"))
    return d.groupBy("lang", (F.col("doc_id") % 2).alias("half")).agg(F.coalesce(share, F.lit("pending")).alias("quality")).select("lang", "quality")


@query("voice_report", """WITH l AS (SELECT label, vec_id FROM embeddings) SELECT label, count(*) AS clips, round(sum(vec_id % 13) / 60.0::DOUBLE, 4) AS minutes, round(median((vec_id % 13)::DOUBLE), 4) AS median_score, round(100.0::DOUBLE * count_if(vec_id % 13 > 6) / count(*), 4) AS pass_percent, count(DISTINCT vec_id % 5) AS emotions FROM l GROUP BY label""")
def voice_report(spark, sf):
    """The part of a candidate voice's row that voice_screen lacks."""
    s = F.col("vec_id") % 13
    return table(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("clips"), F.round(F.sum(s) / 60.0, 4).alias("minutes"), F.round(F.median(s.cast("double")), 4).alias("median_score"), F.round(reports.percent(s > 6), 4).alias("pass_percent"), F.count_distinct(F.col("vec_id") % 5).alias("emotions"))


# --- answers of models ---------------------------------------------------------------------------------------------

TOPICS = ("user", "assistant", "other")


def answers(spark, sf):
    """Turns as a judge's answers: plain JSON, in a fence, in prose after braces that are no JSON, and no JSON at all."""
    body = F.concat(F.lit('{"topic_category": " '), F.upper("role"), F.lit('", "topic": "'), F.repeat(F.col("role"), 12), F.lit('", "tts_suitable": '), (F.col("turn") / 4.0).cast("string"), F.lit(', "transcript_clean": '), F.when(F.col("turn") % 2 == 0, "true").otherwise("false"), F.lit(', "emotion_supported": "false", "issue": "}"}'))
    form = F.col("conv_id") % 4
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", F.when(form == 0, body).when(form == 1, F.concat(F.lit("\n```json\n"), body, F.lit("\n```"))).when(form == 2, F.concat(F.lit("I {think} so: "), F.replace(body, F.lit('"}"'), F.lit('"x"')), F.lit(" or {} so"))).otherwise("no {idea").alias("answer"))


def judged(spark, sf):
    j = T.judgement(T.extracted_json(F.col("answer")), TOPICS)
    return answers(spark, sf).select("conv_id", "turn", "role", j.alias("j")).select("conv_id", "turn", "role", "j.*")


JUDGED = """judged AS (SELECT conv_id, turn, role, conv_id % 4 < 3 AS got, CASE WHEN role IN ('user', 'assistant') THEN role ELSE 'other' END AS topic_category, substring(repeat(role, 12), 1, 60) AS topic,
round(least(1, turn / 4.0::DOUBLE), 2) AS tts_suitable, turn % 2 = 0 AS transcript_clean, true AS emotion_supported, CASE WHEN conv_id % 4 = 2 THEN 'x' ELSE '}' END AS issue FROM conversations)"""


@query("judge_answers", f"WITH {JUDGED} SELECT conv_id, turn, topic_category, topic, tts_suitable, transcript_clean, emotion_supported, issue FROM judged WHERE got")
def judge_answers(spark, sf):
    return judged(spark, sf).where("topic_category is not null").drop("role")


@query("judge_summary", f"""WITH {JUDGED} SELECT count(*) AS asked, count_if(got)::BIGINT AS judged, count_if(got AND NOT transcript_clean)::BIGINT AS unclean, 0::BIGINT AS unsupported, count_if(got AND tts_suitable < 0.5)::BIGINT AS unsuitable,
round_even(100.0::DOUBLE * count_if(got AND transcript_clean) / greatest(count_if(got), 1), 0) AS clean_percent, round_even(100.0::DOUBLE * count_if(got AND tts_suitable >= 0.5) / greatest(count_if(got), 1), 0) AS suitable_percent, 100.0::DOUBLE AS supported_percent FROM judged""")
def judge_summary(spark, sf):
    return reports.judge_summary(judged(spark, sf), F.count("*"))


@query("judge_topics", f"WITH {JUDGED}, n AS (SELECT role, topic_category AS label, count(*) AS n FROM judged WHERE got GROUP BY ALL) SELECT role, 'topic_category' AS kind, label, n, row_number() OVER (PARTITION BY role ORDER BY n DESC, label) AS place FROM n")
def judge_topics(spark, sf):
    return reports.histograms(judged(spark, sf), ["role"], ["topic_category"])


@query("judge_join", f"WITH {JUDGED} SELECT conv_id, turn, length(text) AS n, tts_suitable FROM judged JOIN conversations USING (conv_id, turn) WHERE got")
def judge_join(spark, sf):
    """Judgements with the segments that they are about; either alone is left out."""
    j = judged(spark, sf).where("topic_category is not null").select("conv_id", "turn", "tts_suitable")
    return j.join(table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("n")), ["conv_id", "turn"])

"""Named queries of the library over the driver tables, each with the SQL it is compared with.

Documents stand for segments (lang: language, source: source, n_chars / 15 seconds), labels for raters, conversations
for diarised chunks, events for timed intervals and features, embeddings for speaker vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import joins, metrics, near_duplicates, rules, sequence

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("transcript"), F.col("lang").alias("language"), F.col("source").alias("source_id"), (F.col("n_chars") / F.lit(15.0)).alias("duration_s"))


SEG = "seg AS (SELECT doc_id AS id, text AS transcript, lang AS language, source AS source_id, n_chars / 15.0::DOUBLE AS duration_s FROM documents)"
WORDS = r"list_filter(regexp_split_to_array(lower(transcript), '\s+'), lambda x: x <> '')"


# --- rollups -----------------------------------------------------------------------------------------------------


@query(
    "source_rollup_entropy",
    """
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
e AS (SELECT user_id, round(-sum(p * log2(p)), 3) AS entropy, count(*) AS kinds FROM (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c) GROUP BY ALL),
m AS (SELECT user_id, count(*) AS n, round(sum(value), 2) AS seconds, round(quantile_cont(value, 0.5), 6) AS median_value FROM events GROUP BY ALL)
SELECT user_id, n, seconds, median_value, kinds, entropy FROM m JOIN e USING (user_id)""",
)
def source_rollup_entropy(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "value")
    kinds = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    e = metrics.entropy(kinds, ["user_id"]).join(kinds.groupBy("user_id").agg(F.count("*").alias("kinds")), "user_id")
    per = events.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("seconds"), F.round(F.percentile("value", F.lit(0.5)), 6).alias("median_value"))
    return per.join(e, "user_id").select("user_id", "n", "seconds", "median_value", "kinds", "entropy")


@query("status_distribution", "SELECT event_type, user_id % 3 AS status, count(*) AS n, round(sum(value) / 60, 4) AS minutes FROM events GROUP BY ALL")
def status_distribution(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", (F.col("user_id") % 3).alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("value") / 60, 4).alias("minutes"))


@query("label_mix", "SELECT lang, coalesce(CAST(quality AS VARCHAR), '?') AS label, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL")
def label_mix(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.groupBy("lang", T.missing(F.col("quality").cast("string"), "?").alias("label")).agg(F.count("*").alias("n"))


@query(
    "dataset_stats",
    f"""WITH {SEG} SELECT language, count(*) AS clips, round(sum(duration_s) / 60, 2) AS minutes, count(DISTINCT source_id) AS sources, round(avg(duration_s), 4) AS mean_clip,
 list_sort(list(duration_s))[(count(*) // 2 + 1)::INT] AS upper_median, round(100.0 * count_if(duration_s > 60) / count(*), 4) AS pass_percent FROM seg GROUP BY language""",
)
def dataset_stats(spark, sf):
    d = segments(spark, sf).select("language", "source_id", "duration_s")
    # the upper median is an order statistic: the least value whose cumulative count passes half
    upper = F.expr("percentile_disc(0.5) within group (order by duration_s desc)")
    return d.groupBy("language").agg(
        F.count("*").alias("clips"), F.round(F.sum("duration_s") / 60, 2).alias("minutes"), F.count_distinct("source_id").alias("sources"), F.round(F.avg("duration_s"), 4).alias("mean_clip"), upper.alias("upper_median"), F.round(F.count_if(F.col("duration_s") > 60) * 100.0 / F.count("*"), 4).alias("pass_percent")
    )


@query(
    "per_speaker",
    "SELECT user_id, count(*) AS clips, round(sum(value) / 60, 4) AS minutes, round(median(value), 6) AS median_value, count(DISTINCT event_type) AS kinds, arg_min(event_type, event_id) AS first_kind FROM events GROUP BY user_id",
)
def per_speaker(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(F.count("*").alias("clips"), F.round(F.sum("value") / 60, 4).alias("minutes"), F.round(F.median("value"), 6).alias("median_value"), F.count_distinct("event_type").alias("kinds"), F.min_by("event_type", "event_id").alias("first_kind"))


@query("percentiles", "SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type")
def percentiles(spark, sf):
    p = F.percentile("value", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return table(spark, sf, "events").groupBy("event_type").agg(p.alias("p")).select("event_type", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p10", "p50", "p90"))])


@query("pearson", "SELECT event_type, round(corr(value, hour(ts)), 6) AS r FROM events GROUP BY event_type")
def pearson(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.corr("value", F.hour("ts")), 6).alias("r"))


@query("pass_rollup", "SELECT coalesce(lang, 'all') AS lang, count(*) AS n, round(100.0 * count_if(n_chars > 1000) / count(*), 4) AS pass_percent FROM documents GROUP BY GROUPING SETS ((lang), ())")
def pass_rollup(spark, sf):
    return table(spark, sf, "documents").rollup("lang").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("n_chars") > 1000) * 100.0 / F.count("*"), 4).alias("pass_percent")).withColumn("lang", F.coalesce("lang", F.lit("all")))


@query("group_mean_check", "SELECT kind, round(avg(m), 6) AS mean_of_means, count(*) AS groups FROM (SELECT event_type = 'view' AS kind, user_id, avg(value) AS m FROM events GROUP BY ALL) GROUP BY kind")
def group_mean_check(spark, sf):
    per = table(spark, sf, "events").groupBy((F.col("event_type") == "view").alias("kind"), "user_id").agg(F.avg("value").alias("m"))
    return per.groupBy("kind").agg(F.round(F.avg("m"), 6).alias("mean_of_means"), F.count("*").alias("groups"))


@query("extreme_sources", "SELECT arg_max(user_id, (m, -user_id)) AS top_user, arg_min(user_id, (m, user_id)) AS low_user FROM (SELECT user_id, round(avg(value), 6) AS m FROM events GROUP BY user_id)")
def extreme_sources(spark, sf):
    per = table(spark, sf, "events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("m"))
    return per.agg(F.max_by("user_id", F.struct("m", -F.col("user_id"))).alias("top_user"), F.min_by("user_id", F.struct("m", "user_id")).alias("low_user"))


@query("emotion_means", "SELECT event_type AS emotion, round(avg(value), 6) AS valence, round(avg(user_id), 6) AS arousal, count(*) AS n FROM events GROUP BY event_type")
def emotion_means(spark, sf):
    t = table(spark, sf, "events")
    return t.groupBy(F.col("event_type").alias("emotion")).agg(F.round(F.avg("value"), 6).alias("valence"), F.round(F.avg("user_id"), 6).alias("arousal"), F.count("*").alias("n"))


@query("language_means", "SELECT lang, round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def language_means(spark, sf):
    t = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return t.groupBy("lang").agg(F.round(F.avg("quality"), 6).alias("quality"), F.round(F.avg("toxic"), 6).alias("toxic"), F.count("*").alias("n"))


@query("selection_surplus", "SELECT lang, count(*) AS total, count_if(quality = 1)::BIGINT AS kept, count_if(quality = 1 AND toxic = 0)::BIGINT AS selected, greatest(count_if(quality = 1) - count_if(quality = 1 AND toxic = 0), 0) AS surplus FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def selection_surplus(spark, sf):
    t = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    kept, selected = F.count_if(F.col("quality") == 1), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0))
    per = t.groupBy("lang").agg(F.count("*").alias("total"), kept.alias("kept"), selected.alias("selected"))
    return per.withColumn("surplus", F.greatest(F.col("kept") - F.col("selected"), F.lit(0)).cast("long"))


@query("dense_counts", "SELECT event_type, count_if(user_id % 3 = 0)::BIGINT AS a, count_if(user_id % 3 = 1)::BIGINT AS b, count_if(user_id % 3 = 2)::BIGINT AS c FROM events GROUP BY event_type")
def dense_counts(spark, sf):
    g = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("user_id") % 3 + 1).cast("int"))
    return table(spark, sf, "events").withColumn("g", g).groupBy("event_type").pivot("g", ["a", "b", "c"]).count().na.fill(0)


@query("length_histogram", "WITH r AS (SELECT lang, n_chars, min(n_chars) OVER () AS lo, max(n_chars) OVER () AS hi FROM documents) SELECT lang, least(20, 1 + ((n_chars - lo) * 20) // greatest(hi - lo, 1))::BIGINT AS bin, count(*) AS n FROM r GROUP BY ALL")
def length_histogram(spark, sf):
    d = table(spark, sf, "documents").select("lang", "n_chars")
    ends = d.agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"))  # one row
    b = F.expr("least(20, 1 + ((n_chars - lo) * 20) div greatest(hi - lo, 1))").cast("long")
    return d.crossJoin(F.broadcast(ends)).groupBy("lang", b.alias("bin")).agg(F.count("*").alias("n"))


@query("balance_index", """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c),
a AS (SELECT user_id, stddev_pop(p) AS sd, count(*) AS k FROM p GROUP BY user_id)
SELECT user_id, round(CASE WHEN k < 2 THEN 0 ELSE greatest(0, least(1, 1 - sd / sqrt((1 - 1.0::DOUBLE / k) / k))) END, 6) AS balance FROM a""")
def balance_index(spark, sf):
    c = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return metrics.balance_index(c, ["user_id"]).withColumn("balance", F.round("balance", 6))


@query("radar_scores", "SELECT lang, round(greatest(0, least(1, avg(n_chars) / 5000)), 6) AS length_score, round(greatest(0, least(1, count(DISTINCT source) / 20.0::DOUBLE)), 6) AS variety_score FROM documents GROUP BY lang")
def radar_scores(spark, sf):
    clip = lambda c: F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)), 6)
    return table(spark, sf, "documents").groupBy("lang").agg(clip(F.avg("n_chars") / 5000).alias("length_score"), clip(F.count_distinct("source") / 20.0).alias("variety_score"))


# --- rules -------------------------------------------------------------------------------------------------------

#: Metrics that the driver tables lack, from the id and the length: whole fractions, so that both engines agree.
METRICS = {"clipped_fraction": "(id % 97) / 4000.0D", "snr_db": "10 + (id % 31)", "silence_ratio": "(id % 53) / 100.0D", "gap_energy_ratio": "(id % 41) / 100.0D", "asr_language_probability": "case when id % 5 = 0 then null else (id % 50) / 50.0D end"}


def measured(spark, sf):
    s = segments(spark, sf)
    for name, expr in METRICS.items():
        s = s.withColumn(name, F.expr(expr).cast("double"))
    return s.withColumn("language_code", F.col("language")).withColumn("asr_language_code", F.when(F.col("id") % 11 == 0, "xx").when(F.col("id") % 7 == 0, "").otherwise(F.col("language"))).withColumn("duration_s", F.least("duration_s", F.lit(40.0)))


MEASURED = f"""{SEG}, meas AS (SELECT * REPLACE (least(duration_s, 40.0) AS duration_s), {', '.join(f"({e.replace('0D', '0::DOUBLE')})::DOUBLE AS {n}" for n, e in METRICS.items())}, CASE WHEN id % 11 = 0 THEN 'xx' WHEN id % 7 = 0 THEN '' ELSE language END AS asr_code,
 length(regexp_replace(transcript, '^\\s+|\\s+$', '', 'g')) AS chars, length(regexp_replace(transcript, '[^A-Za-z]', '', 'g')) / nullif(length(regexp_replace(transcript, '\\P{{L}}', '', 'g')), 0) AS latin FROM seg),
gated AS (SELECT *, list_filter([CASE WHEN chars = 0 THEN 'empty_transcript' END, CASE WHEN clipped_fraction > 0.01 THEN 'clipping' END, CASE WHEN snr_db < 15 THEN 'low_snr' END, CASE WHEN silence_ratio > 0.45 THEN 'too_much_silence' END,
 CASE WHEN chars > 0 AND NOT (CASE WHEN duration_s > 0 THEN chars / duration_s ELSE 0 END) BETWEEN 2 AND 32 THEN 'char_rate' END, CASE WHEN duration_s < 3 OR duration_s > 25 THEN 'duration_out_of_range' END, CASE WHEN asr_language_probability < 0.6 THEN 'low_asr_conf' END], lambda x: x IS NOT NULL) AS rejects,
 list_filter([CASE WHEN gap_energy_ratio > 0.32 THEN 'music_or_noise_bed' END, CASE WHEN asr_code <> '' AND asr_code <> language THEN 'lang_mismatch' END, CASE WHEN language <> 'en' AND coalesce(latin, 0) > 0.5 THEN 'code_mixed' END], lambda x: x IS NOT NULL) AS marks FROM meas),
judged AS (SELECT *, CASE WHEN len(rejects) > 0 THEN 'reject' WHEN len(marks) > 0 THEN 'flag' ELSE 'pass' END AS status FROM gated)"""


@query("gate_status", f"WITH {MEASURED} SELECT id, status, array_to_string(rejects, ',') AS rejects, array_to_string(marks, ',') AS flags FROM judged")
def gate_status(spark, sf):
    bare = lambda c: F.array_join(F.transform(c, lambda x: F.split_part(x, F.lit("("), F.lit(1))), ",")
    return rules.gate(measured(spark, sf)).select("id", "status", bare(F.col("reject_reasons")).alias("rejects"), bare(F.col("flags")).alias("flags"))


CANONICAL = ("empty_transcript", "clipping", "low_snr", "too_much_silence", "char_rate", "duration_out_of_range", "low_asr_conf", "duplicate")


@query("gate_reasons", f"WITH {MEASURED}, c AS (SELECT unnest(rejects) AS reason FROM judged) SELECT k.reason, count(c.reason) AS n FROM (VALUES {', '.join(f"('{x}')" for x in CANONICAL)}) k(reason) LEFT JOIN c USING (reason) GROUP BY k.reason")
def gate_reasons(spark, sf):
    return rules.reason_counts(rules.gate(measured(spark, sf)), CANONICAL)


@query("funnel", f"WITH {MEASURED} SELECT count(*) AS candidates, count_if(status <> 'reject')::BIGINT AS kept, count_if(status = 'reject')::BIGINT AS rejected FROM judged")
def funnel(spark, sf):
    s = rules.gate(measured(spark, sf))
    return s.agg(F.count("*").alias("candidates"), F.count_if(F.col("status") != "reject").alias("kept"), F.count_if(F.col("status") == "reject").alias("rejected"))


@query("gate_ablation", f"WITH {MEASURED} SELECT language, count(*) AS n_all, count_if(status <> 'reject')::BIGINT AS n_kept, round(median(snr_db), 4) AS all_median, round(median(CASE WHEN status <> 'reject' THEN snr_db END), 4) AS kept_median FROM judged GROUP BY language")
def gate_ablation(spark, sf):
    s = rules.gate(measured(spark, sf))
    ok = F.col("status") != "reject"
    return s.groupBy("language").agg(F.count("*").alias("n_all"), F.count_if(ok).alias("n_kept"), F.round(F.median("snr_db"), 4).alias("all_median"), F.round(F.median(F.when(ok, F.col("snr_db"))), 4).alias("kept_median"))


DECISION = "case when id % 13 = 0 then 'reject' when id % 17 = 0 then 'accept' end"


@query("kept_filter", f"WITH {MEASURED} SELECT id, language FROM judged WHERE CASE {DECISION.removeprefix('case ').removesuffix(' end')} ELSE status END IN ('accept', 'pass', 'flag')")
def kept_filter(spark, sf):
    return rules.gate(measured(spark, sf)).where(rules.kept(F.col("status"), F.expr(DECISION))).select("id", "language")


@query(
    "annotation_flags",
    f"""WITH {MEASURED}, f AS (SELECT id, language, list_filter([CASE WHEN id % 40 / 10.0 < 3.0 OR snr_db < 18 OR gap_energy_ratio > 0.3 THEN 'quality' END,
 CASE WHEN chars > 0 AND NOT contains('.!?।॥"'')]}}”', right(regexp_replace(transcript, '^\\s+|\\s+$', '', 'g'), 1)) THEN 'truncation' END, CASE WHEN language <> 'en' AND regexp_matches(transcript, '[A-Za-z]{{2,}}') THEN 'codemix' END,
 CASE WHEN coalesce(nullif(asr_language_probability, 0), 1) < 0.55 THEN 'emotion_low_confidence' END, CASE WHEN quality = 0 THEN 'transcript_review_needed' END, CASE WHEN toxic = 1 THEN 'overlap_suspected' END, CASE WHEN id % 40 / 10.0 < 2.8 THEN 'low_quality_audio' END], lambda x: x IS NOT NULL) AS f
 FROM judged LEFT JOIN labels ON id = doc_id) SELECT language, flag, count(*) AS n FROM (SELECT language, unnest(f) AS flag FROM f) GROUP BY ALL""",
)
def annotation_flags(spark, sf):
    s = measured(spark, sf).join(table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic"), "id", "left")
    marks = rules.annotations(F.col("transcript"), F.col("language"), F.expr("id % 40 / 10.0D"), F.col("snr_db"), F.col("gap_energy_ratio"), F.col("asr_language_probability"), F.col("quality") == 1, F.lit(1.0), F.col("toxic") == 1)
    return s.select("language", F.explode(F.split(marks, r"\|")).alias("flag")).where("flag <> ''").groupBy("language", "flag").agg(F.count("*").alias("n"))


# --- text --------------------------------------------------------------------------------------------------------


@query("latin_fraction", r"SELECT doc_id, round(coalesce(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / nullif(length(regexp_replace(text, '\P{L}', '', 'g')), 0), 0), 6) AS latin FROM documents")
def latin_fraction(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(T.latin_fraction(F.col("text")), 6).alias("latin"))


@query("token_stats", f"WITH {SEG}, w AS (SELECT language, source_id, {WORDS} AS ws FROM seg), x AS (SELECT language, unnest(ws) AS word FROM w) SELECT language, count(*) AS n_words, count(DISTINCT word) AS vocabulary, round(count(DISTINCT word) / count(*), 6) AS ttr FROM x GROUP BY language")
def token_stats(spark, sf):
    w = segments(spark, sf).select("language", F.explode(T.words(F.col("transcript"))).alias("word")).groupBy("language", "word").agg(F.count("*").alias("c"))
    return w.groupBy("language").agg(F.sum("c").alias("n_words"), F.count("*").alias("vocabulary"), F.round(F.count("*") / F.sum("c"), 6).alias("ttr"))


VOCAB = r"""v AS (SELECT language, word, count(*) AS n FROM (SELECT language, trim(unnest(list_filter(regexp_split_to_array(lower(transcript), '\s+'), lambda x: x <> '')), '.,!?;:"''') AS word FROM seg) WHERE word <> '' GROUP BY ALL)"""


def vocabulary(spark, sf):
    w = segments(spark, sf).select("language", F.explode(T.words(F.col("transcript"))).alias("w")).select("language", T.vocabulary_word(F.col("w")).alias("word"))
    return w.where("word <> ''").groupBy("language", "word").agg(F.count("*").alias("n"))


def ranked_words(spark, sf):
    from pyspark.sql import Window

    return vocabulary(spark, sf).withColumn("rank", F.row_number().over(Window.partitionBy("language").orderBy(F.col("n").desc(), "word")))


@query("top_words", f"WITH {SEG}, {VOCAB} SELECT language, word, n, row_number() OVER (PARTITION BY language ORDER BY n DESC, word) AS rank FROM v QUALIFY rank <= 20")
def top_words(spark, sf):
    return ranked_words(spark, sf).where("rank <= 20")


@query("zipf", f"WITH {SEG}, {VOCAB} SELECT language, n AS frequency, count(*) AS words, min(rank) AS first_rank FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY n DESC, word) AS rank FROM v) GROUP BY ALL")
def zipf(spark, sf):
    return ranked_words(spark, sf).groupBy("language", F.col("n").alias("frequency")).agg(F.count("*").alias("words"), F.min("rank").alias("first_rank"))


@query("rare_and_common", f"WITH {SEG}, {VOCAB}, t AS (SELECT *, n / sum(n) OVER (PARTITION BY language) AS share, row_number() OVER (PARTITION BY language ORDER BY n DESC, word) AS hi, row_number() OVER (PARTITION BY language ORDER BY n, word) AS lo FROM v) SELECT language, word, n, round(100 * share, 6) AS percent FROM t WHERE hi <= 8 OR lo <= 8")
def rare_and_common(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("language")
    t = vocabulary(spark, sf).withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn("hi", F.row_number().over(w.orderBy(F.col("n").desc(), "word"))).withColumn("lo", F.row_number().over(w.orderBy("n", "word")))
    return t.where("hi <= 8 or lo <= 8").select("language", "word", "n", F.round(100 * F.col("share"), 6).alias("percent"))


@query("wpm_bands", f"WITH {SEG}, r AS (SELECT language, len({WORDS}) / duration_s * 60 AS wpm FROM seg WHERE duration_s > 0) SELECT language, CASE WHEN wpm < 110 THEN 'slow' WHEN wpm <= 160 THEN 'medium' ELSE 'fast' END AS band, count(*) AS n, round(min(wpm), 4) AS low, round(max(wpm), 4) AS high FROM r GROUP BY ALL")
def wpm_bands(spark, sf):
    s = segments(spark, sf).select("language", T.words_per_minute(F.size(T.words(F.col("transcript"))), F.col("duration_s")).alias("wpm")).where("wpm is not null")
    band = F.when(F.col("wpm") < 110, "slow").when(F.col("wpm") <= 160, "medium").otherwise("fast")
    return s.groupBy("language", band.alias("band")).agg(F.count("*").alias("n"), F.round(F.min("wpm"), 4).alias("low"), F.round(F.max("wpm"), 4).alias("high"))


@query("normalized_currency", r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '\$\s?(\d[\d,]*(?:\.\d+)?)', '\1 dollars', 'g'), '(?:Rs\.?|₹)\s?(\d[\d,]*(?:\.\d+)?)', '\1 rupees', 'g')) AS said FROM documents")
def normalized_currency(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.spoken_currency(F.col("text"))).alias("said"))


@query("normalize_text")
def normalize_text(spark, sf):
    from quernstone.functions import numbers

    return table(spark, sf, "documents").select("doc_id", numbers.spoken(F.col("text"), F.col("lang")).alias("normalized_text"))


@query("duplicate_keys", r"SELECT key, count(*) AS n FROM (SELECT md5(array_to_string(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> ''), ' ')) AS key FROM documents) GROUP BY key HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return table(spark, sf, "documents").groupBy(F.md5(T.duplicate_key(F.col("text"))).alias("key")).agg(F.count("*").alias("n")).where("n > 1")


@query("annotated_text", r"""SELECT doc_id, md5(CASE WHEN cut THEN regexp_replace(b, '[ .]+$', '') || ' —' ELSE b END) AS h FROM (SELECT doc_id, CASE WHEN lang <> 'en' THEN regexp_replace(t, '([A-Za-z][A-Za-z''\-]*(?:\s+[A-Za-z][A-Za-z''\-]*)*)', '[\1]', 'g') ELSE t END AS b, t <> '' AND NOT contains('.!?।॥"'')]}”', right(t, 1)) AS cut
FROM (SELECT doc_id, lang, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents))""")
def annotated_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.annotated(F.col("text"), F.col("lang"))).alias("h"))


@query("json_label_parse", """WITH p AS (SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type FROM events)
SELECT event_id, CASE WHEN lower(trim(event_type)) IN ('view', 'click', 'purchase') THEN lower(trim(event_type)) ELSE 'other' END AS label, greatest(0, least(1, coalesce(k / 10, 0.3))) AS confidence FROM p""")
def json_label_parse(spark, sf):
    k = F.get_json_object("props", "$.k").try_cast("double")
    return table(spark, sf, "events").select("event_id", T.checked_label(F.col("event_type"), ("view", "click", "purchase"), "other").alias("label"), T.checked_confidence((k / 10).cast("string")).alias("confidence"))


@query("quadrant_label", "SELECT event_id, CASE WHEN a <= 0.4 THEN CASE WHEN v <= 0.45 THEN 'sad' ELSE 'calm' END WHEN a >= 0.6 THEN CASE WHEN v >= 0.55 THEN 'excited' WHEN v <= 0.45 THEN 'angry' ELSE 'happy' END WHEN v >= 0.55 THEN 'happy' WHEN v <= 0.45 THEN 'sad' ELSE 'neutral' END AS label FROM (SELECT event_id, (event_id * 7919 % 1001) / 1000.0::DOUBLE AS v, (event_id * 104729 % 1001) / 1000.0::DOUBLE AS a FROM events)")
def quadrant_label(spark, sf):
    return table(spark, sf, "events").select("event_id", T.quadrant(F.expr("(event_id * 7919 % 1001) / 1000.0D"), F.expr("(event_id * 104729 % 1001) / 1000.0D")).alias("label"))


def edit_distance(pairs: str) -> str:
    """CTEs after `pairs` (id, x, y), lists: `far` (id, d), by rows of the table of prefixes; a step along a row is a running least."""
    return f"""{pairs},
r AS (SELECT id, 0::BIGINT AS i, j, j AS d FROM (SELECT id, unnest(range(0, len(y) + 1)) AS j FROM p)
  UNION ALL
  SELECT id, i + 1, j, min(t - j) OVER (PARTITION BY id ORDER BY j) + j FROM (
    SELECT r.id, r.i, r.j, least(d + 1, coalesce(lag(d) OVER (PARTITION BY r.id ORDER BY j) + CASE WHEN p.x[r.i + 1] = p.y[j] THEN 0 ELSE 1 END, d + 1)) AS t FROM r JOIN p ON p.id = r.id WHERE r.i < len(p.x))),
far AS (SELECT r.id, d FROM r JOIN p ON p.id = r.id WHERE i = len(x) AND j = len(y))"""


#: Characters as single bytes, as many as there are different ones (under 127 in the driver's items): the other engine's own distance counts bytes.
@query("cer", """WITH ch AS (SELECT c, row_number() OVER (ORDER BY c) AS k FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM benchmark)), m AS (SELECT string_agg(c, '' ORDER BY k) AS a, string_agg(chr(k::INT), '' ORDER BY k) AS b FROM ch),
t AS (SELECT item_id, translate(text, a, b) AS t FROM benchmark, m) SELECT a.item_id, round(levenshtein(a.t, b.t) / length(a.t), 6) AS cer FROM t a JOIN t b ON b.item_id = a.item_id + 1 WHERE a.t <> ''""")
def cer(spark, sf):
    """Character error rate of each benchmark item against the next one."""
    b = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("a"))
    nxt = b.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return b.where("a <> ''").join(nxt, "item_id").select("item_id", F.round(T.character_error_rate(F.col("a"), F.col("b")), 6).alias("cer"))


def heard_form(text: str) -> str:
    """The words of T.recognition_form in SQL; white space that isn't in text's ASCII is made a blank by name."""
    marks = "".join(T.LEFT_OUT)
    low = rf"translate(lower(regexp_replace(nfc_normalize({text}), '<\|.*?\|>', '', 'g')), '{marks}', '')"
    return rf"list_filter(regexp_split_to_array(regexp_replace(regexp_replace({low}, '[\p{{P}}\p{{S}}]', ' ', 'g'), '[\p{{Z}}\x0B\x1C-\x1F\x85]', ' ', 'g'), '\s+'), lambda w: w <> '')"


HEARD = edit_distance(f"f AS (SELECT item_id, {heard_form('text')} AS w FROM benchmark), p AS (SELECT a.item_id AS id, a.w AS x, b.w AS y FROM f a JOIN f b ON b.item_id = a.item_id + 1)")
RATES = f"{HEARD}, rates AS (SELECT p.id AS item_id, CASE WHEN len(x) > 0 THEN round(d / len(x)::DOUBLE, 6) END AS wer FROM p LEFT JOIN far ON far.id = p.id)"


@query("wer", f"WITH RECURSIVE {RATES} SELECT item_id, wer FROM rates")
def wer(spark, sf):
    """Word error rate of each benchmark item against the next one."""
    b = table(spark, sf, "benchmark").select("item_id", T.recognition_form(F.col("text")).alias("a"))
    nxt = b.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return b.join(nxt, "item_id").select("item_id", F.round(T.word_error_rate(F.col("a"), F.col("b")), 6).alias("wer"))


# --- sequences ---------------------------------------------------------------------------------------------------


@query(
    "speaker_runs",
    """WITH i AS (SELECT user_id, epoch_us(ts) / 1000000 AS s, epoch_us(ts) / 1000000 + value AS e FROM events),
m AS (SELECT *, coalesce((s - max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 7200)::INT, 1) AS new FROM i),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT user_id, round(min(s), 3) AS run_start, round(max(e), 3) AS run_end, count(*) AS n FROM r GROUP BY user_id, run HAVING max(e) > min(s)""",
)
def speaker_runs(spark, sf):
    s = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000
    i = table(spark, sf, "events").select("user_id", s.alias("s"), (s + F.col("value")).alias("e"))
    return sequence.runs(i, ["user_id"], "s", "e", 7200.0).select("user_id", F.round("run_start", 3).alias("run_start"), F.round("run_end", 3).alias("run_end"), "n")


@query("role_dominant", "WITH r AS (SELECT conv_id, role, sum(length(text)) AS total, min(turn) AS first FROM conversations GROUP BY ALL) SELECT conv_id, role, total FROM r QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY total DESC, first) = 1")
def role_dominant(spark, sf):
    return sequence.dominant(table(spark, sf, "conversations"), "conv_id", "role", F.length("text"), F.col("turn"))


@query("pack_segments")
def pack_segments(spark, sf):
    """Conversation turns as pieces of a twentieth of their characters in seconds, packed into clips."""
    from pyspark.sql import Window

    c = table(spark, sf, "conversations").withColumn("d", F.length("text") / 20.0).withColumn("end", F.sum("d").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)))
    return sequence.pack(c.select("conv_id", (F.col("end") - F.col("d")).alias("start"), "end"), "conv_id", "start", "end")


@query("zscore", """SELECT event_id, CASE WHEN sd > 1e-6 THEN round((value - m) / sd, 3) ELSE 0 END AS z FROM (SELECT event_id, value, avg(value) OVER w AS m, stddev_pop(value) OVER w AS sd FROM events WINDOW w AS (PARTITION BY user_id))""")
def zscore(spark, sf):
    return sequence.z_scores(table(spark, sf, "events").select("event_id", "user_id", "value"), "user_id", ["value"]).select("event_id", F.col("value_z").alias("z"))


@query("zlevel", """SELECT event_id, CASE WHEN z >= 1 THEN 'much higher than usual' WHEN z >= 0.4 THEN 'higher than usual' WHEN z <= -1 THEN 'much lower than usual' WHEN z <= -0.4 THEN 'lower than usual' ELSE 'around this speaker''s average' END AS level
FROM (SELECT event_id, CASE WHEN sd > 1e-6 THEN round((value - m) / sd, 3) ELSE 0 END AS z FROM (SELECT event_id, value, avg(value) OVER w AS m, stddev_pop(value) OVER w AS sd FROM events WINDOW w AS (PARTITION BY user_id)))""")
def zlevel(spark, sf):
    return zscore(spark, sf).select("event_id", T.z_level(F.col("z")).alias("level"))


@query("balanced_selection", f"""WITH {SEG}, q AS (SELECT seg.*, coalesce(CAST(toxic AS VARCHAR), 'neutral') AS bucket, coalesce(quality, 0) AS quality FROM seg LEFT JOIN labels ON id = doc_id),
a AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY quality DESC, id) AS pos FROM q), b AS (SELECT *, row_number() OVER (PARTITION BY language, bucket ORDER BY pos) AS rnd, count(*) OVER (PARTITION BY language, bucket) AS size, min(pos) OVER (PARTITION BY language, bucket) AS first FROM a),
c AS (SELECT *, sum(duration_s) OVER (PARTITION BY language ORDER BY rnd, size, first ROWS UNBOUNDED PRECEDING) - duration_s AS before, sum(duration_s) OVER (PARTITION BY language) AS whole FROM b)
SELECT id, language, bucket FROM c WHERE whole <= 1800 OR before < 1800""")
def balanced_selection(spark, sf):
    s = segments(spark, sf).join(table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic"), "id", "left")
    s = s.select("id", "language", "duration_s", T.missing(F.col("toxic").cast("string"), "neutral").alias("bucket"), F.coalesce("quality", F.lit(0)).alias("quality"))
    return sequence.balanced(s, "language", "bucket", "duration_s", 1800.0, [F.col("quality").desc(), F.col("id")]).select("id", "language", "bucket")


SPLIT = "split AS (SELECT doc_id, lang, source, text, CASE WHEN i % 20 = 0 THEN 'test' WHEN i % 20 = 1 THEN 'validation' ELSE 'train' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY source, doc_id) - 1 AS i FROM documents))"


def split_documents(spark, sf):
    return sequence.split3(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"), ["lang"], 0.05, [F.col("source"), F.col("doc_id")])


@query("stratified_split", f"WITH {SPLIT} SELECT doc_id, split FROM split")
def stratified_split(spark, sf):
    return split_documents(spark, sf).select("doc_id", "split")


@query("split_integrity", f"""WITH {SPLIT}, s AS (SELECT lang, split, count(*) AS n, count(DISTINCT source) AS sources FROM split GROUP BY ALL),
t AS (SELECT DISTINCT lang, source FROM split WHERE split = 'train'), u AS (SELECT DISTINCT lang, split, source FROM split WHERE split <> 'train')
SELECT s.lang, s.split, n, sources, CASE WHEN s.split = 'train' THEN 0 ELSE (SELECT count(*) FROM u ANTI JOIN t USING (lang, source) WHERE u.lang = s.lang AND u.split = s.split) END AS unseen FROM s""")
def split_integrity(spark, sf):
    d = split_documents(spark, sf).select("lang", "source", "split")
    sizes = d.groupBy("lang", "split").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))
    train = d.where("split = 'train'").select("lang", "source").distinct()
    unseen = d.where("split <> 'train'").distinct().join(train, ["lang", "source"], "left_anti").groupBy("lang", "split").agg(F.count("*").alias("unseen"))
    return sizes.join(unseen, ["lang", "split"], "left").na.fill(0, ["unseen"])


@query("cross_split_dups", rf"WITH {SPLIT}, k AS (SELECT split, md5(array_to_string(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> ''), ' ')) AS key FROM split) SELECT DISTINCT split AS held_out, key FROM k WHERE split <> 'train' AND key IN (SELECT key FROM k WHERE split = 'train')")
def cross_split_dups(spark, sf):
    return joins.leaks(split_documents(spark, sf), F.md5(T.duplicate_key(F.col("text"))))


@query("stride_sample_a", "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY lang) // 40) AS k FROM documents) WHERE i % k = 0 AND i // k < 40")
def stride_sample_a(spark, sf):
    return sequence.stride_a(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], 40, [F.col("doc_id")])


@query("stride_sample_b", "WITH d AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY lang) AS c FROM documents) SELECT doc_id, lang FROM d WHERE c <= 60 OR EXISTS (SELECT 1 FROM range(60) t(i) WHERE i * c // 60 = r)")
def stride_sample_b(spark, sf):
    return sequence.stride_b(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], 60, [F.col("doc_id")])


@query("stratified_sample", "SELECT doc_id, lang, quality FROM (SELECT doc_id, lang, quality, row_number() OVER w - 1 AS i, greatest(1, count(*) OVER (PARTITION BY lang, quality) // 4) AS k FROM documents JOIN labels USING (doc_id) WINDOW w AS (PARTITION BY lang, quality ORDER BY doc_id)) WHERE i % k = 0 AND i // k < 4")
def stratified_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return sequence.stride_a(d, ["lang", "quality"], 4, [F.col("doc_id")])


@query("lmh_picks", """WITH d AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang, 'low' AS band FROM d WHERE i < 3 UNION ALL SELECT doc_id, lang, 'mid' FROM d WHERE i BETWEEN n // 2 - 1 AND n // 2 + 1 UNION ALL SELECT doc_id, lang, 'high' FROM d WHERE i >= n - 3""")
def lmh_picks(spark, sf):
    return sequence.low_mid_high(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), ["lang"], [F.col("n_chars"), F.col("doc_id")]).select("doc_id", "lang", "band")


@query("first_per_key", "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY lower(trim(source)) ORDER BY doc_id) = 1")
def first_per_key(spark, sf):
    return sequence.first_per_key(table(spark, sf, "documents").select("doc_id", "source"), F.lower(F.trim("source")), [F.col("doc_id")])


@query("segment_ids", "SELECT doc_id, source || '_' || lpad(CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS VARCHAR), greatest(4, length(CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS VARCHAR)))::INT, '0') AS id FROM documents")
def segment_ids(spark, sf):
    return sequence.numbered_ids(table(spark, sf, "documents").select("doc_id", "source"), "source", [F.col("doc_id")]).select("doc_id", "id")


@query("trim_window", "SELECT doc_id, s AS start_s, least(e - s, CASE WHEN doc_id % 4 = 0 THEN 60 ELSE e - s END) AS seconds FROM (SELECT doc_id, (doc_id % 30)::DOUBLE AS s, greatest((doc_id % 30)::DOUBLE, n_chars / 15.0::DOUBLE - 5) AS e FROM documents)")
def trim_window(spark, sf):
    s, d = sequence.trim_window((F.col("doc_id") % 30).cast("double"), F.lit(5.0), F.col("n_chars") / 15.0, F.when(F.col("doc_id") % 4 == 0, 1.0).when(F.col("doc_id") % 4 == 1, 0.0))
    return table(spark, sf, "documents").select("doc_id", s.alias("start_s"), d.alias("seconds"))


# --- joins -------------------------------------------------------------------------------------------------------


@query("score_merge", f"WITH {SEG} SELECT id, CASE WHEN b.doc_id IS NOT NULL THEN b.toxic ELSE a.quality END AS score FROM seg LEFT JOIN labels a ON id = a.doc_id LEFT JOIN (SELECT * FROM labels WHERE doc_id % 3 = 0) b ON id = b.doc_id")
def score_merge(spark, sf):
    l = table(spark, sf, "labels")
    first = l.select(F.col("doc_id").alias("id"), F.col("quality").alias("score"), F.lit("x").alias("language"))
    later = l.where("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), F.col("toxic").alias("score"))
    return joins.score_merge(segments(spark, sf).select("id", "language"), [first, later]).select("id", "score")


@query("review_merge", """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'reject' WHEN doc_id % 5 = 1 THEN 'accept' ELSE '' END AS decision, CASE WHEN doc_id % 3 = 0 THEN 'calm' ELSE '' END AS emotion FROM labels)
SELECT x.doc_id AS id, CASE WHEN decision IN ('accept', 'reject') THEN decision END AS review_decision, CASE WHEN decision <> 'reject' AND emotion <> '' THEN emotion ELSE x.lang END AS emotion, CASE WHEN decision <> 'reject' AND emotion <> '' THEN 'human' ELSE 'auto' END AS tag_source
FROM documents x LEFT JOIN d USING (doc_id)""")
def review_merge(spark, sf):
    s = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("transcript"), F.col("lang").alias("emotion"), F.lit("narrative").alias("style"), F.lit(0.5).alias("emotion_confidence"), F.lit("auto").alias("tag_source"), F.lit(None).cast("string").alias("review_decision"))
    d = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.expr("case when doc_id % 5 = 0 then 'Reject' when doc_id % 5 = 1 then ' accept' else '' end").alias("decision"), F.expr("case when doc_id % 3 = 0 then 'CALM ' else '' end").alias("emotion"), F.lit("").alias("style"), F.lit(None).cast("string").alias("transcript"))
    return joins.review_merge(s, d).select("id", "review_decision", "emotion", "tag_source")


CHUNKS = """t AS (SELECT conv_id, turn, role, text, length(text) / 20.0::DOUBLE AS d FROM conversations), k AS (SELECT conv_id, text, turn, sum(d) OVER w - d AS start, sum(d) OVER w AS "end" FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))"""


@query("chunk_overlap_text", f"""WITH {CHUNKS}, c AS (SELECT conv_id, i * 10.0::DOUBLE AS clip_start, i * 10.0::DOUBLE + 10 AS clip_end FROM (SELECT conv_id, unnest(range(0, greatest(ceil(max("end") / 10), 1)::BIGINT)) AS i FROM k GROUP BY conv_id))
SELECT c.conv_id, clip_start, clip_end, coalesce(string_agg(text, ' ' ORDER BY start), '') AS text FROM c LEFT JOIN k ON c.conv_id = k.conv_id AND k.start < clip_end AND k."end" > clip_start AND trim(text) <> '' GROUP BY ALL""")
def chunk_overlap_text(spark, sf):
    """Every conversation cut into stretches of 10 s, with the texts of the turns that reach into each."""
    from pyspark.sql import Window

    t = table(spark, sf, "conversations").withColumn("d", F.length("text") / 20.0)
    end = F.sum("d").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0))
    k = t.withColumn("end", end).select("conv_id", (F.col("end") - F.col("d")).alias("start"), "end", "text")
    n = F.greatest(F.ceil(F.max("end") / 10), F.lit(1))
    c = k.groupBy("conv_id").agg(n.alias("n")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("conv_id", (F.col("i") * F.lit(10.0)).alias("clip_start"), (F.col("i") * F.lit(10.0) + 10).alias("clip_end"))
    return joins.overlapping_text(c, k, "conv_id")


@query("semi_published", "SELECT doc_id, lang FROM documents SEMI JOIN labels USING (doc_id)")
def semi_published(spark, sf):
    return joins.only_known(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


@query("not_processed", "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def not_processed(spark, sf):
    return joins.not_processed(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


@query("source_lookup", "SELECT event_id, coalesce(n_name, '?') AS name FROM events LEFT JOIN nation ON user_id = n_nationkey")
def source_lookup(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("user_id"), F.col("n_name").alias("name"))
    return joins.with_lookup(table(spark, sf, "events").select("event_id", "user_id"), n, "user_id", {"name": "?"}).select("event_id", "name")


@query("benchmark_leaks", r"WITH k AS (SELECT DISTINCT md5(array_to_string(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> ''), ' ')) AS key FROM documents) SELECT item_id FROM benchmark WHERE md5(array_to_string(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> ''), ' ')) IN (SELECT key FROM k)")
def benchmark_leaks(spark, sf):
    k = table(spark, sf, "documents").select(T.duplicate_key(F.col("text")).alias("key"))
    return table(spark, sf, "benchmark").select("item_id", T.duplicate_key(F.col("text")).alias("key")).join(k, "key", "left_semi").select("item_id")


# --- metrics -----------------------------------------------------------------------------------------------------

RATED = "r AS (SELECT event_id, user_id % 4 AS a, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 3 = 0 THEN event_id % 4 ELSE user_id % 4 END AS b FROM events)"


def rated(spark, sf):
    return table(spark, sf, "events").select("event_id", F.expr("user_id % 4").alias("a"), F.expr("case when event_id % 9 = 0 then null when event_id % 3 = 0 then event_id % 4 else user_id % 4 end").alias("b"))


@query("confusion", f"WITH {RATED} SELECT a, b, count(*) AS n FROM r WHERE b IS NOT NULL GROUP BY ALL")
def confusion(spark, sf):
    return metrics.confusion(rated(spark, sf), F.col("a"), F.col("b"))


@query("kappa", f"""WITH {RATED}, c AS (SELECT a, b, count(*) AS n FROM r WHERE b IS NOT NULL GROUP BY ALL), t AS (SELECT sum(n)::DOUBLE AS n, sum(CASE WHEN a = b THEN n ELSE 0 END) AS same FROM c),
p AS (SELECT sum(na * nb) AS x FROM (SELECT a AS l, sum(n) AS na FROM c GROUP BY a) JOIN (SELECT b AS l, sum(n) AS nb FROM c GROUP BY b) USING (l))
SELECT n::BIGINT AS n, round(same / n, 6) AS agreement, round((same / n - x / (n * n)) / nullif(1 - x / (n * n), 0), 6) AS kappa FROM t, p""")
def kappa(spark, sf):
    return metrics.kappa(metrics.confusion(rated(spark, sf), F.col("a"), F.col("b")))


@query("krippendorff", f"""WITH {RATED}, l AS (SELECT event_id, a AS label FROM r UNION ALL SELECT event_id, b FROM r WHERE b IS NOT NULL), c AS (SELECT event_id, label, count(*)::DOUBLE AS n FROM l GROUP BY ALL), m AS (SELECT *, sum(n) OVER (PARTITION BY event_id) AS m FROM c QUALIFY m > 1),
s AS (SELECT sum(n * (n - 1) / (m - 1)) AS same, sum(n) AS t FROM m), q AS (SELECT sum(nc * nc) AS sq FROM (SELECT sum(n) AS nc FROM m GROUP BY label)) SELECT round(1 - (t - 1) * (t - same) / nullif(t * t - sq, 0), 6) AS alpha FROM s, q""")
def krippendorff(spark, sf):
    r = rated(spark, sf)
    return metrics.krippendorff(r.select("event_id", F.col("a").alias("label")).unionByName(r.select("event_id", F.col("b").alias("label"))), "event_id", "label")


@query("pairwise_agreement", f"WITH {RATED} SELECT count(*) AS n, round(coalesce(avg((a = b)::INT), 0), 6) AS agreement FROM r WHERE b IS NOT NULL")
def pairwise_agreement(spark, sf):
    return metrics.pairwise_agreement(rated(spark, sf), F.col("a"), F.col("b"))


@query("va_distance", """WITH v(e, x, y) AS (VALUES ('neutral', 0.0, 0.0), ('calm', 0.3, -0.5), ('sad', -0.6, -0.4), ('happy', 0.7, 0.4)), p AS (SELECT user_id % 4 AS a, event_id % 4 AS b FROM events WHERE user_id % 4 <> event_id % 4),
n AS (SELECT ['neutral', 'calm', 'sad', 'happy'][a + 1] AS a, ['neutral', 'calm', 'sad', 'happy'][b + 1] AS b FROM p)
SELECT n.a, n.b, count(*) AS n, sqrt(pow(s.x - t.x, 2) + pow(s.y - t.y, 2)) < 0.6 AS neighbouring FROM n JOIN v s ON s.e = n.a JOIN v t ON t.e = n.b GROUP BY ALL""")
def va_distance(spark, sf):
    name = lambda c: F.element_at(F.array(*map(F.lit, ("neutral", "calm", "sad", "happy"))), (F.col(c) % 4 + 1).cast("int"))
    p = table(spark, sf, "events").select(name("user_id").alias("a"), name("event_id").alias("b")).where("a <> b")
    return p.groupBy("a", "b").agg(F.count("*").alias("n")).withColumn("neighbouring", metrics.emotion_distance(F.col("a"), F.col("b")) < 0.6)


CENTROIDS = "x AS (SELECT label, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings), m AS (SELECT label, d, avg(x) AS x FROM x GROUP BY ALL), c AS (SELECT label, d, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m)"


@query("centroid_similarity", f"WITH {CENTROIDS} SELECT a.label AS a, b.label AS b, round(sum(a.x * b.x), 6) AS cosine FROM c a JOIN c b ON a.d = b.d AND a.label < b.label GROUP BY ALL")
def centroid_similarity(spark, sf):
    return metrics.centroid_pairs(metrics.centroids(table(spark, sf, "embeddings"), "label", "embedding"), "label")


@query("within_cohesion", "WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings), p AS (SELECT label, d, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM x GROUP BY ALL) SELECT label, max(n) AS n, round(coalesce((sum(s * s) - sum(q)) / nullif(max(n) * (max(n) - 1), 0), 1), 6) AS within FROM p GROUP BY label")
def within_cohesion(spark, sf):
    return metrics.cohesion(table(spark, sf, "embeddings"), "label", "embedding")


@query("nearest_centroid", f"WITH {CENTROIDS}, s AS (SELECT vec_id, c.label, round(sum(x.x * c.x), 6) AS cosine FROM x JOIN c USING (d) GROUP BY ALL) SELECT vec_id, arg_min(label, (-cosine, label)) AS nearest, max(cosine) AS cosine FROM s GROUP BY vec_id")
def nearest_centroid(spark, sf):
    e = table(spark, sf, "embeddings")
    return metrics.nearest_centroid(e, "vec_id", "embedding", metrics.centroids(e, "label", "embedding"), "label")


SCORED = "s AS (SELECT quality AS y, round(n_chars / 1000.0::DOUBLE, 1) AS s FROM documents JOIN labels USING (doc_id))"


def scored(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(F.col("n_chars") / 1000.0, 1).alias("s")).join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id")


@query("roc_auc", f"WITH {SCORED}, r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r FROM s), t AS (SELECT sum(y) AS p, count(*) - sum(y) AS n, sum(r * y) AS x FROM r) SELECT p::BIGINT AS n_pos, n::BIGINT AS n_neg, round((x - p * (p + 1) / 2) / nullif(p * n, 0), 6) AS auc FROM t")
def roc_auc(spark, sf):
    return metrics.roc_auc(scored(spark, sf), "s", "y")


@query("eer", f"""WITH {SCORED}, c AS (SELECT s, sum(y) AS p, count(*) - sum(y) AS n FROM s GROUP BY s), k AS (SELECT s, 1 - sum(p) OVER w / sum(p) OVER () AS fnr, sum(n) OVER w / sum(n) OVER () AS fpr FROM c WINDOW w AS (ORDER BY s DESC))
SELECT round((fnr + fpr) / 2, 6) AS eer, round(s, 6) AS threshold FROM k ORDER BY round(abs(fnr - fpr), 9), s DESC LIMIT 1""")
def eer(spark, sf):
    return metrics.equal_error(scored(spark, sf), "s", "y")


# --- near duplicates ---------------------------------------------------------------------------------------------

TOKENS = r"t AS (SELECT min(doc_id) AS doc_id, lang, w FROM (SELECT doc_id, lang, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> ''))) AS w FROM documents) WHERE len(w) > 0 GROUP BY lang, w)"


@query("near_dup_pairs", f"WITH {TOKENS} SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.lang = b.lang AND a.doc_id < b.doc_id AND least(len(a.w), len(b.w)) * 10 >= 9 * greatest(len(a.w), len(b.w)) WHERE len(list_intersect(a.w, b.w)) * 10 >= 9 * len(list_distinct(list_concat(a.w, b.w)))")
def near_dup_pairs(spark, sf):
    """Pairs between the first documents of each token set; near_dup_members has the documents that each stands for."""
    return near_duplicates.similar_pairs(table(spark, sf, "documents"), "doc_id", "text", "lang")


MEMBERS = TOKENS.replace("min(doc_id) AS doc_id", "unnest(list(doc_id)) AS doc_id, min(doc_id) AS representative")


@query("near_dup_members", f"WITH {MEMBERS} SELECT doc_id, representative FROM t")
def near_dup_members(spark, sf):
    """Each document with the first document of its token set: the membership that near_dup_pairs is read with."""
    return near_duplicates.members(table(spark, sf, "documents"), "doc_id", "text", "lang")


NEAR = f"{TOKENS}, e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.lang = b.lang AND a.doc_id < b.doc_id AND least(len(a.w), len(b.w)) * 10 >= 9 * greatest(len(a.w), len(b.w)) WHERE len(list_intersect(a.w, b.w)) * 10 >= 9 * len(list_distinct(list_concat(a.w, b.w))))"


@query("dedup_greedy", f"""WITH RECURSIVE {NEAR}, nodes AS (SELECT id, row_number() OVER (ORDER BY id) AS k, list(a) AS earlier FROM (SELECT a AS id, NULL AS a FROM e UNION ALL SELECT b, a FROM e) GROUP BY id),
r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS kept UNION ALL SELECT n.k, CASE WHEN list_has_any(r.kept, n.earlier) THEN r.kept ELSE list_append(r.kept, n.id) END FROM r JOIN nodes n ON n.k = r.k + 1),
kept AS (SELECT kept FROM r ORDER BY k DESC LIMIT 1), m AS (SELECT unnest(ids) AS doc_id, representative FROM (SELECT list(doc_id) AS ids, min(doc_id) AS representative FROM (SELECT doc_id, lang, {WORDS.replace("transcript", "text")} AS w FROM documents) WHERE len(w) > 0 GROUP BY lang, list_sort(list_distinct(w))))
SELECT d.doc_id, coalesce(d.doc_id <> m.representative OR (m.representative IN (SELECT id FROM nodes) AND NOT list_contains((SELECT kept FROM kept), m.representative)), false) AS dropped FROM documents d LEFT JOIN m USING (doc_id)""")
def dedup_greedy(spark, sf):
    """First wins: a document goes if one before it that stays is similar."""
    return near_duplicates.greedy_kept(table(spark, sf, "documents"), "doc_id", "text", "lang")


# --- workflow ----------------------------------------------------------------------------------------------------


#: What the driver tables lack of a record, made of ids; nulls and empty values take the defaults.
RECORD = {
    **{c: f"CASE WHEN id % 5 = 0 THEN NULL ELSE concat('{c}', CAST(id % 7 AS STRING)) END" for c in ("emotion", "style", "tag_source", "speaker_id", "gender", "accent", "ser_emotion", "source_video_id", "source_url", "source_channel", "license", "topic_category", "annotation_flags")},
    **{c: f"CASE WHEN id % 9 = 0 THEN NULL ELSE (id % {k}) / 8.0D END" for k, c in enumerate(("emotion_confidence", "dnsmos_ovrl", "dnsmos_sig", "dnsmos_bak", "squim_stoi", "squim_pesq", "squim_sisdr", "mms_align_score", "valence", "arousal", "dominance", "tts_suitable", "start_s", "end_s"), 31)},
    **{c: f"CASE WHEN id % 13 = 0 THEN NULL ELSE id % {k} = 0 END" for k, c in enumerate(("quality_flag", "has_truncation", "has_codemix", "has_laughter", "emotion_low_confidence", "transcript_review_needed", "low_quality_audio", "overlap_flag"), 2)},
    "annotated_text": "CASE WHEN id % 4 = 0 THEN '' WHEN id % 4 = 1 THEN NULL ELSE concat('a ', transcript) END", "audio": "concat('clips/', CAST(id AS STRING), '.wav')",
}


def _record_sql() -> str:
    """Every published column but normalized_text, whose number words are no SQL."""
    renamed = {"topic_category": "topic", "tts_suitable": "llm_tts_suitable", "start_s": "segment_start", "end_s": "segment_end"}
    out = [f"{e.replace('8.0D', '8.0::DOUBLE')} AS {renamed.get(c, c)}" for c, e in RECORD.items() if c not in ("annotated_text", "annotation_flags") and " = 0 END" not in e]
    out += [f"coalesce({e}, false) AS {c}" for c, e in RECORD.items() if " = 0 END" in e]
    ovrl = RECORD["dnsmos_ovrl"].replace("8.0D", "8.0::DOUBLE")
    out += ["language", "language AS language_code", "snr_db", "transcript AS text", "round(duration_s, 3) AS duration", f"coalesce(({ovrl}) > 3.0, false) AS dnsmos_pass", f"coalesce(nullif({RECORD['annotated_text']}, ''), transcript) AS annotated_text", f"coalesce({RECORD['annotation_flags']}, '') AS annotation_flags", "24000 AS sample_rate"]
    return f"WITH {MEASURED} SELECT {', '.join(out)} FROM meas"


@query("final_records", _record_sql())
def final_records(spark, sf):
    """44 of the 45 published columns: renamed, rounded, with defaults."""
    from quernstone.plans import workflow

    s = measured(spark, sf)
    return workflow.records(s.select(*[c for c in s.columns if c not in RECORD], *[F.expr(e).alias(c) for c, e in RECORD.items()])).drop("normalized_text")


@query("speaker_gender", "WITH m AS (SELECT user_id, median(nullif(value, 0)) AS f FROM events GROUP BY user_id) SELECT event_id, CASE WHEN user_id = 3 THEN 'female' WHEN f > 0 AND f < 165 THEN 'male' ELSE 'female' END AS gender, CASE WHEN event_type = 'view' THEN 'wide' ELSE event_type END AS accent FROM events JOIN m USING (user_id)")
def speaker_gender(spark, sf):
    from quernstone.plans import workflow

    e = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("speaker_id"), F.col("value").alias("f0_mean"), F.col("event_type").alias("language"))
    return workflow.voices(e, {"3": "female"}, {"view": "wide"}).select("event_id", "gender", "accent")


@query("audit_percent", "SELECT lang, question, round(100 * avg(answer), 4) AS yes_percent, count(*) AS n FROM (SELECT lang, unnest(['quality', 'toxic']) AS question, unnest([quality, toxic]) AS answer FROM documents JOIN labels USING (doc_id)) WHERE answer IS NOT NULL GROUP BY ALL")
def audit_percent(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id")
    said = d.select("lang", F.expr("stack(2, 'quality', if(quality = 1, 'Yes', 'no'), 'toxic', if(toxic = 1, 'y', '0')) as (question, answer)"))
    return said.withColumn("yes", T.yes_no(F.col("answer"))).where("yes is not null").groupBy("lang", "question").agg(F.round(F.avg(F.col("yes").cast("double")) * 100, 4).alias("yes_percent"), F.count("*").alias("n"))


@query("first_issues", f"WITH {MEASURED}, x AS (SELECT id, unnest(rejects) AS issue FROM judged) SELECT issue, min(id) AS id FROM x GROUP BY issue ORDER BY id, issue LIMIT 3")
def first_issues(spark, sf):
    g = rules.gate(measured(spark, sf)).select("id", F.explode("reject_reasons").alias("r"))
    return g.groupBy(F.split_part("r", F.lit("("), F.lit(1)).alias("issue")).agg(F.min("id").alias("id")).orderBy("id", "issue").limit(3)


@query("tumbling_windows", "WITH d AS (SELECT doc_id, n_chars / 15.0::DOUBLE AS s FROM documents), w AS (SELECT doc_id, i * 10.0::DOUBLE AS w_start, least(i * 10.0::DOUBLE + 10, s) AS w_end FROM d, range(greatest(ceil(s / 10)::BIGINT, 1)) r(i)) SELECT doc_id, count(*) AS n, round(max(w_end - w_start), 6) AS longest FROM w WHERE w_end - w_start >= 0.5 GROUP BY doc_id")
def tumbling_windows(spark, sf):
    from quernstone.plans import workflow

    w = workflow.tumbling(table(spark, sf, "documents").select("doc_id", (F.col("n_chars") / 15.0).alias("s")), "s", 10.0, 0.5)
    return w.groupBy("doc_id").agg(F.count("*").alias("n"), F.round(F.max(F.col("w_end") - F.col("w_start")), 6).alias("longest"))


@query("sliding_windows", "SELECT doc_id, floor(n_chars / 15.0::DOUBLE - 2)::BIGINT + 1 AS n FROM documents WHERE n_chars / 15.0::DOUBLE >= 2")
def sliding_windows(spark, sf):
    from quernstone.plans import workflow

    return workflow.sliding(table(spark, sf, "documents").select("doc_id", (F.col("n_chars") / 15.0).alias("s")), "s", 2.0, 1.0).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("duration_range", "SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN 300 AND 3600")
def duration_range(spark, sf):
    return table(spark, sf, "documents").where(F.col("n_chars").between(300, 3600)).select("doc_id", "n_chars")


@query("split_id_leaks", f"WITH {SPLIT} SELECT DISTINCT doc_id FROM split WHERE split = 'test' AND doc_id IN (SELECT doc_id FROM split WHERE split <> 'test') UNION SELECT DISTINCT doc_id FROM split WHERE split = 'validation' AND doc_id IN (SELECT doc_id FROM split WHERE split <> 'validation')")
def split_id_leaks(spark, sf):
    d = split_documents(spark, sf).select("doc_id", "split")
    part = {s: d.where(F.col("split") == s).select("doc_id") for s in ("train", "validation", "test")}
    return part["train"].intersect(part["test"]).union(part["train"].intersect(part["validation"])).union(part["test"].intersect(part["validation"])).distinct()


@query("voice_screen", f"""WITH {CENTROIDS}, p AS (SELECT a.label AS a, b.label AS b, round(sum(a.x * b.x), 6) AS cosine FROM c a JOIN c b ON a.d = b.d AND a.label <> b.label GROUP BY ALL), n AS (SELECT label, count(*) AS clips FROM embeddings GROUP BY label)
SELECT a AS label, clips, arg_min(b, (-cosine, b)) AS nearest, max(cosine) AS max_cosine, max(cosine) < 0.5 AS distinct_voice FROM p JOIN n ON label = a GROUP BY ALL""")
def voice_screen(spark, sf):
    c = metrics.centroids(table(spark, sf, "embeddings"), "label", "embedding")
    p = metrics.centroid_pairs(c, "label")
    both = p.union(p.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    near = both.groupBy(F.col("a").alias("label")).agg(F.min_by("b", F.struct(-F.col("cosine"), "b")).alias("nearest"), F.max("cosine").alias("max_cosine"))
    return c.select("label", F.col("n").alias("clips")).join(near, "label").withColumn("distinct_voice", F.col("max_cosine") < 0.5)


@query("separation", f"""WITH {CENTROIDS}, p AS (SELECT round(sum(a.x * b.x), 6) AS cosine FROM c a JOIN c b ON a.d = b.d AND a.label < b.label GROUP BY a.label, b.label),
q AS (SELECT label, d, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM x GROUP BY ALL), w AS (SELECT label, round(coalesce((sum(s * s) - sum(q)) / nullif(max(n) * (max(n) - 1), 0), 1), 6) AS within FROM q GROUP BY label)
SELECT round(b, 5) AS between_cosine, round(w, 5) AS within_cosine, f AS flagged FROM (SELECT avg(cosine) AS b FROM p), (SELECT avg(within) AS w FROM w), (SELECT count(*) AS f FROM w, (SELECT avg(cosine) AS b FROM p) WHERE within < b + 0.1)""")
def separation(spark, sf):
    e = table(spark, sf, "embeddings")
    between = metrics.centroid_pairs(metrics.centroids(e, "label", "embedding"), "label").agg(F.avg("cosine").alias("b"))  # one row
    w = metrics.cohesion(e, "label", "embedding")
    return w.crossJoin(F.broadcast(between)).agg(F.round(F.first("b"), 5).alias("between_cosine"), F.round(F.avg("within"), 5).alias("within_cosine"), F.count_if(F.col("within") < F.col("b") + 0.1).alias("flagged"))


@query("session_stream", """WITH m AS (SELECT user_id, ts, value, coalesce((ts >= lag(ts) OVER w + INTERVAL 2 HOUR)::INT, 1) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM m) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n, round(sum(value), 2) AS total FROM r GROUP BY user_id, run""")
def session_stream(spark, sf):
    """The batch form of the streaming sessions; the test runs both."""
    from quernstone.streaming import sessions

    return sessions.sessions(table(spark, sf, "events")).select("user_id", F.unix_micros("session_start").alias("start_us"), "n", F.round("total", 2).alias("total"))


@query("event_rates", "SELECT event_type, epoch_us(date_trunc('hour', ts)) AS start_us, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_rates(spark, sf):
    from quernstone.streaming import sessions

    return sessions.rates(table(spark, sf, "events")).select("event_type", F.unix_micros("start").alias("start_us"), "n", F.round("total", 2).alias("total"))


@query("wer_summary", f"WITH RECURSIVE {RATES} SELECT count(wer) AS n, round(avg(wer), 6) AS mean, round(median(wer), 6) AS median FROM rates")
def wer_summary(spark, sf):
    """Mean and median word error rate over the benchmark items that have one."""
    return wer(spark, sf).where("wer is not null").agg(F.count("*").alias("n"), F.round(F.avg("wer"), 6).alias("mean"), F.round(F.median("wer"), 6).alias("median"))


def compared(text: str) -> str:
    """T.comparison_form in SQL."""
    return rf"trim(regexp_replace(regexp_replace(lower(nfc_normalize({text})), '[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}\s\p{{Z}}]', '', 'g'), '[\s\p{{Z}}]+', ' ', 'g'))"


@query("corrections", f"""WITH c AS (SELECT a.conv_id, b.turn, a.text AS transcript_batch, b.text AS transcript, 'en' AS language, {compared("a.text")} AS x, {compared("b.text")} AS y FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, transcript_batch, transcript, language FROM c WHERE x <> '' AND y <> '' AND x <> y AND abs(len(string_split(x, ' ')) - len(string_split(y, ' '))) BETWEEN 1 AND 4 ORDER BY length(transcript), conv_id, turn LIMIT 3""")
def corrections(spark, sf):
    """Pairs of neighbouring conversation turns as two transcripts of one clip; the three shortest that differ a little."""
    from quernstone.plans import workflow

    c = table(spark, sf, "conversations")
    pairs = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("transcript_batch")).join(c.select("conv_id", "turn", F.col("text").alias("transcript")), ["conv_id", "turn"]).withColumn("language", F.lit("en"))
    return workflow.corrections(pairs).orderBy(F.length("transcript"), "conv_id", "turn").limit(3)


@query("workflow")
def workflow_clips(spark, sf):
    """Conversations as diarised chunks, cut into clips with their texts."""
    from pyspark.sql import Window

    from quernstone.plans import workflow

    t = table(spark, sf, "conversations").withColumn("d", F.length("text") / 20.0)
    end = F.sum("d").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0))
    chunks = t.withColumn("end_s", end).select(F.col("conv_id").alias("source_id"), F.col("role").alias("speaker_id"), (F.col("end_s") - F.col("d")).alias("start_s"), "end_s", "text")
    return workflow.clips(chunks)


@query("published_split")
def published_split(spark, sf):
    """Documents through qualify, selection, projection and split: the workflow's last steps in one plan."""
    from quernstone.plans import workflow

    s = measured(spark, sf).withColumn("speaker_id", F.col("source_id")).withColumn("duration_s", F.least("duration_s", F.lit(20.0)) + 3)
    q = workflow.qualify(s, ["snr_db"])
    ready = q.withColumns({"review_decision": F.lit(None).cast("string"), "emotion": F.element_at(F.array(F.lit("calm"), F.lit("sad"), F.lit("neutral")), (F.col("id") % 3 + 1).cast("int")), "topic_category": F.lit(None).cast("string"), "dnsmos_ovrl": F.expr("id % 40 / 10.0D"), "audio": F.col("id").cast("string")})
    return workflow.publishable(workflow.records(workflow.selected(ready, 20.0))).select("audio", "config", "split", "emotion", "duration")

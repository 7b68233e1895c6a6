"""Queries of alignment, window cohesion, balanced trials and signal measures, beside the catalogue's. Importing this module adds them to it.

Embeddings stand for frames of scores, for window vectors and, end to end, for samples.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import alignment, loudness, romanised, voice
from quernstone.operators import metrics, trials
from quernstone.plans.catalog import query, table

#: Labels of a frame (0 is the blank), and frames of a clip.
LABELS, FRAMES = 8, 20
#: Vectors of a clip of sound, and its rate.
VECTORS, RATE = 100, 8000


@query(
    "alignment_scores",
    f"""
WITH RECURSIVE f AS (SELECT vec_id // {FRAMES} AS clip, vec_id % {FRAMES} AS frame, list_transform(embedding[1:{LABELS}], lambda x: x::DOUBLE * 20) AS s FROM embeddings),
e AS (SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY frame) - 1 AS t, list_transform(s, lambda x: x - ln(list_sum(list_transform(s, lambda y: exp(y))))) AS e FROM f),
c AS (SELECT clip, count(*) AS frames, list_transform(range(1, (clip * 7) % 24 + 1), lambda i: (1 + (clip * 5 + i * i) % {LABELS - 1})::BIGINT) AS tok FROM e GROUP BY clip),
l AS (SELECT *, 2 * len(tok) + 1 AS states, list_transform(range(1, 2 * len(tok) + 2), lambda i: CASE WHEN i % 2 = 1 THEN 0 ELSE tok[i // 2] END) AS lab FROM c WHERE len(tok) > 0 AND len(tok) < frames),
st AS (
  SELECT clip, 0::BIGINT AS t, list_transform(range(1, states + 1), lambda i: CASE WHEN i <= 2 THEN e[lab[i] + 1] ELSE '-Infinity'::DOUBLE END) AS a,
    list_transform(range(1, states + 1), lambda i: CASE WHEN i <= 2 THEN exp(e[lab[i] + 1]) ELSE 0.0::DOUBLE END) AS p
  FROM l JOIN e USING (clip) WHERE t = 0
  UNION ALL
  SELECT clip, t + 1, list_transform(range(1, states + 1), lambda i: a[k[i]] + e[lab[i] + 1]), list_transform(range(1, states + 1), lambda i: p[k[i]] + exp(e[lab[i] + 1]))
  FROM (
    SELECT s.clip, s.t, s.a, s.p, l.states, l.lab, n.e, list_transform(range(1, states + 1), lambda i: CASE
      WHEN a[i] >= CASE WHEN i > 1 THEN a[i - 1] ELSE '-Infinity'::DOUBLE END AND a[i] >= CASE WHEN i > 2 AND i % 2 = 0 AND lab[i] <> lab[i - 2] THEN a[i - 2] ELSE '-Infinity'::DOUBLE END THEN i
      WHEN a[i - 1] >= CASE WHEN i > 2 AND i % 2 = 0 AND lab[i] <> lab[i - 2] THEN a[i - 2] ELSE '-Infinity'::DOUBLE END THEN i - 1 ELSE i - 2 END) AS k
    FROM st AS s JOIN l ON l.clip = s.clip JOIN e AS n ON n.clip = s.clip AND n.t = s.t + 1
  )
),
done AS (SELECT clip, CASE WHEN a[states] > a[states - 1] THEN states ELSE states - 1 END AS k, a, p, frames FROM st JOIN l USING (clip) WHERE t = frames - 1)
SELECT c.clip, c.frames::INT AS n_frames, len(tok)::INT AS n_tokens, round(CASE WHEN a[k] > '-Infinity'::DOUBLE THEN p[k] / c.frames END, 6) AS confidence FROM c LEFT JOIN done USING (clip)""",
)
def alignment_scores(spark, sf):
    """Tokens of each clip aligned to its frames; some clips have none, some as many as frames."""
    v = table(spark, sf, "embeddings").select(F.expr(f"vec_id div {FRAMES}").alias("clip"), (F.col("vec_id") % FRAMES).alias("frame"), F.transform(F.slice("embedding", 1, LABELS), lambda x: x.cast("double") * 20).alias("s"))
    total = F.log(F.aggregate("s", F.lit(0.0), lambda a, x: a + F.exp(x)))
    frames = v.select("clip", "frame", F.transform("s", lambda x: x - total).alias("scores"))
    n = (F.col("clip") * 7) % 24
    tokens = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: (1 + (F.col("clip") * 5 + i * i) % (LABELS - 1)).cast("int"))).otherwise(F.array().cast("array<int>"))
    targets = v.select("clip").distinct().withColumn("tokens", tokens)
    return alignment.align(frames, targets, "clip", "frame", "scores", "tokens").withColumn("confidence", F.round("confidence", 6))


@query(
    "window_cohesion",
    """
WITH w AS (SELECT CASE WHEN vec_id % 10 = 0 THEN -vec_id - 1 ELSE vec_id // 10 END AS clip, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM embeddings),
u AS (SELECT clip, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding)::DOUBLE / (norm + 1e-9) AS x FROM w),
q AS (SELECT clip, d, sum(x) AS s, sum(x * x) AS q FROM u GROUP BY ALL), n AS (SELECT clip, count(*) AS windows FROM w GROUP BY clip),
r AS (SELECT clip, windows, CASE WHEN windows >= 2 THEN round((sum(s * s) - sum(q)) / (windows * (windows - 1)), 6) END AS cohesion FROM q JOIN n USING (clip) GROUP BY clip, windows)
SELECT clip, windows, cohesion, coalesce(cohesion < 0.55, false) AS overlap FROM r""",
)
def window_cohesion(spark, sf):
    """Mean cosine of all pairs of a clip's window vectors; every tenth vector is a clip of one window."""
    v = F.col("vec_id")
    w = table(spark, sf, "embeddings").select(F.when(v % 10 == 0, -v - 1).otherwise(F.expr("vec_id div 10")).alias("clip"), "embedding")
    return metrics.window_cohesion(w, "clip", "embedding")


def _drawn(name: str, total: str, wanted: str, seed: int) -> str:
    """CTEs of a permutation's first `wanted` values below `total`, as trials.drawn makes them."""
    ctes = [f"{name}b AS (SELECT {total} AS total, {wanted} AS wanted, greatest(1, (length(bin(greatest({total} - 1, 1))) + 1) // 2) AS b FROM t)"]
    ctes.append(f"{name}0 AS (SELECT i, total, wanted, b, (1::BIGINT << b) - 1 AS m, i >> b AS l, i & ((1::BIGINT << b) - 1) AS r FROM {name}b, range(200000) AS x(i) WHERE i < (1::BIGINT << (2 * b)))")
    for k, (factor, addend) in enumerate(trials.ROUNDS):
        x = f"(r * {factor} + {addend + seed * trials.MIX})"
        y = f"((xor({x}, {x} >> 17) & {(1 << 31) - 1}) * {trials.MIX})"
        ctes.append(f"{name}{k + 1} AS (SELECT i, total, wanted, b, m, r AS l, xor(l, (xor({y}, {y} >> 23) >> 11) & m) AS r FROM {name}{k})")
    last = f"{name}{len(trials.ROUNDS)}"
    ctes.append(f"{name} AS (SELECT number FROM (SELECT (l << b) | r AS number, wanted, total, row_number() OVER (ORDER BY i) AS k FROM {last} WHERE ((l << b) | r) < total) WHERE k <= wanted OR total <= wanted)")
    return ",\n".join(ctes)


@query(
    "trial_pairs",
    f"""
WITH v AS (SELECT vec_id, label AS s, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM embeddings WHERE label IS NOT NULL),
g AS (SELECT s, n, sum(n) OVER w - n AS before, sum(n * (n - 1) // 2) OVER w - n * (n - 1) // 2 AS p FROM (SELECT DISTINCT s, n FROM v) WINDOW w AS (ORDER BY s)),
h AS (SELECT *, sum(n * before) OVER (ORDER BY s) - n * before AS q FROM g),
t AS (SELECT sum(n * (n - 1) // 2)::BIGINT AS same, sum(n * before)::BIGINT AS other, least(5000, sum(n * (n - 1) // 2))::BIGINT AS few FROM h),
{_drawn("ps", "same", "few", 0)},
{_drawn("ng", "other", "least(few, other)", 1)},
one AS (SELECT s, number - p AS r, floor((1 + sqrt(8 * (number - p) + 1)) / 2)::BIGINT AS j FROM ps JOIN h ON number >= p AND number < p + n * (n - 1) // 2),
two AS (SELECT s, (number - q) // before AS i, (number - q) % before AS at FROM ng JOIN h ON before > 0 AND number >= q AND number < q + n * before),
places AS (SELECT v.vec_id, v.s, v.i, h.before + v.i AS at FROM v JOIN h USING (s)),
pairs AS (SELECT a.vec_id AS x, b.vec_id AS y, true AS same FROM one JOIN places a ON a.s = one.s AND a.i = j JOIN places b ON b.s = one.s AND b.i = r - j * (j - 1) // 2
  UNION ALL SELECT a.vec_id, b.vec_id, false FROM two JOIN places a ON a.s = two.s AND a.i = two.i JOIN places b ON b.at = two.at)
SELECT least(x, y) AS a, greatest(x, y) AS b, same FROM pairs""",
)
def trial_pairs(spark, sf):
    """5000 pairs of vectors of one label, and as many of two."""
    return trials.balanced_trials(table(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", "label")


def sounds(spark, sf):
    """(clip, samples): a hundred vectors, end to end."""
    v = table(spark, sf, "embeddings").groupBy(F.expr(f"vec_id div {VECTORS}").alias("clip"))
    return v.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"])).alias("samples"))


@query("clip_loudness")
def clip_loudness(spark, sf):
    """Loudness with the ear's weighting; recursive filters over thousands of samples are no SQL, tests hold them against a plain loop."""
    return loudness.measured(sounds(spark, sf), "clip", "samples", RATE).withColumn("lufs", F.round("lufs", 4))


@query("clip_features")
def clip_features(spark, sf):
    """Pitch, harmonics to noise, brightness, band ratio and pauses of each clip; tests hold them against tones."""
    return voice.extracted(sounds(spark, sf), "clip", "samples", RATE).select("clip", *[F.round(F.col(f"features.{n}"), 4).alias(n) for n in voice.NAMES])


#: ASCII letters, and the letters and one vowel sign that they stand for in the query's texts.
LATIN, TELUGU = "kgtdpbmlsraei", "\u0c15\u0c17\u0c24\u0c26\u0c2a\u0c2c\u0c2e\u0c32\u0c38\u0c30\u0c05\u0c0e\u0c3f"


@query("romanised", rf"""WITH t AS (SELECT doc_id, regexp_replace(lower(regexp_replace(text, '[^ -~\s]', '', 'g')), '[\s]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, md5(trim(replace(replace(regexp_replace(replace(t, '~', ''), '([kgtdpbmlsr])', '\1~', 'g'), '~i', 'i'), '~', 'a'))) AS digest FROM t""")
def romanised_texts(spark, sf):
    """Texts whose letters are put into an Indic script, and romanised back: a consonant has its own vowel unless a sign follows."""
    t = F.translate(F.lower(F.regexp_replace(F.regexp_replace("text", r"[^ -~\s]", ""), "~", "")), LATIN, TELUGU)
    # a column of its own, so that it is made once and not wherever romanised() reads it
    return table(spark, sf, "documents").select("doc_id", t.alias("t")).select("doc_id", F.md5(romanised.romanised(F.col("t"))).alias("digest"))

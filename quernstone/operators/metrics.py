"""Agreement, error rates, similarity and ranking metrics, each a DataFrame of one or few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators.ranking import running


def entropy(counts: DataFrame, by: list[str], n: str = "n", digits: int = 3) -> DataFrame:
    """(by, entropy): Shannon entropy in bits of the counts of each group."""
    p = F.col(n) / F.sum(n).over(Window.partitionBy(*by))
    return counts.withColumn("_p", p).groupBy(*by).agg(F.round(-F.sum(F.when(F.col("_p") > 0, F.col("_p") * F.log2("_p")).otherwise(0.0)), digits).alias("entropy"))


def balance_index(counts: DataFrame, by: list[str], n: str = "n") -> DataFrame:
    """(by, balance): 1 less the deviation of shares over the largest possible one; 0 for a single category or no counts."""
    p = F.try_divide(F.col(n), F.sum(n).over(Window.partitionBy(*by)))
    k = F.col("k")
    out = counts.withColumn("_p", p).groupBy(*by).agg(F.stddev_pop("_p").alias("sd"), F.count("*").alias("k"), F.sum(n).alias("total"))
    index = F.when((k < 2) | (F.col("total") == 0), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.try_divide(F.col("sd"), F.sqrt((1 - 1 / k) / k)))))
    return out.select(*by, index.alias("balance"))


def confusion(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    return rows.where(a.isNotNull() & b.isNotNull()).groupBy(a.alias("a"), b.alias("b")).agg(F.count("*").alias("n"))


def kappa(counts: DataFrame) -> DataFrame:
    """(n, agreement, kappa) of a confusion table (a, b, n); kappa is null where chance agreement is 1."""
    total = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    sides = counts.groupBy(F.col("a").alias("label")).agg(F.sum("n").alias("na")).join(counts.groupBy(F.col("b").alias("label")).agg(F.sum("n").alias("nb")), "label")
    chance = sides.agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("x"))
    po, pe = F.col("same") / F.col("n"), F.col("x") / (F.col("n") * F.col("n"))
    return total.crossJoin(chance).select("n", F.round(po, 6).alias("agreement"), F.round(F.try_divide(po - pe, F.nullif(1 - pe, F.lit(0.0))), 6).alias("kappa"))  # one row each


def krippendorff(ratings: DataFrame, unit: str, label: str) -> DataFrame:
    """(alpha): nominal alpha of ratings in long form, missing ones absent or null; units with one rating don't count."""
    counts = ratings.where(F.col(label).isNotNull()).groupBy(unit, label).agg(F.count("*").cast("double").alias("n"))
    counts = counts.withColumn("m", F.sum("n").over(Window.partitionBy(unit))).where("m > 1")
    agree = counts.agg(F.sum(F.col("n") * (F.col("n") - 1) / (F.col("m") - 1)).alias("same"), F.sum("n").alias("total"))
    per = counts.groupBy(label).agg(F.sum("n").alias("nc")).agg(F.sum(F.col("nc") * F.col("nc")).alias("square"))
    t = F.col("total")
    return agree.crossJoin(per).select(F.round(1 - F.try_divide((t - 1) * (t - F.col("same")), F.nullif(t * t - F.col("square"), F.lit(0.0))), 6).alias("alpha"))


def pairwise_agreement(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """(n, agreement) over the rows with both labels; 0 without any."""
    both = rows.where(a.isNotNull() & b.isNotNull())
    return both.agg(F.count("*").alias("n"), F.round(F.coalesce(F.avg((a == b).cast("double")), F.lit(0.0)), 6).alias("agreement"))


def emotion_distance(a: Column, b: Column) -> Column:
    """Distance of two emotions in the plane of valence and arousal; null for an unknown one."""
    x, y = (F.create_map(*[F.lit(v) for e, xy in T.VALENCE_AROUSAL.items() for v in (e, xy[k])]) for k in (0, 1))
    return T.euclidean(x[a], y[a], x[b], y[b])


def centroids(vectors: DataFrame, by: str, vector: str) -> DataFrame:
    """(by, c, n): the mean of each group's vectors, made a unit vector."""
    per = vectors.select(by, F.posexplode(vector).alias("d", "x")).groupBy(by, "d").agg(F.avg(F.col("x").cast("double")).alias("x"), F.count("*").alias("n"))
    mean = per.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda s: s["x"]).alias("m"), F.max("n").alias("n"))
    return mean.select(by, T.unit(F.col("m")).alias("c"), "n")


def cohesion(vectors: DataFrame, by: str, vector: str) -> DataFrame:
    """(by, n, within): the mean cosine of all pairs of a group of unit vectors, from sums: (|sum v|^2 - sum |v|^2) / (n (n - 1)); 1 for a single one."""
    x = F.col("x").cast("double")
    per = vectors.select(by, F.posexplode(vector).alias("d", "x")).groupBy(by, "d").agg(F.sum(x).alias("s"), F.sum(x * x).alias("q"), F.count("*").alias("n"))
    out = per.groupBy(by).agg(F.max("n").alias("n"), F.sum(F.col("s") * F.col("s")).alias("a"), F.sum("q").alias("b"))
    return out.select(by, "n", F.round(F.coalesce(F.try_divide(F.col("a") - F.col("b"), F.nullif(F.col("n") * (F.col("n") - 1), F.lit(0))), F.lit(1.0)), 6).alias("within"))


def centroid_pairs(c: DataFrame, by: str) -> DataFrame:
    """(a, b, cosine) of all pairs of centroids: as many as the square of the groups, which are few."""
    x, y = c.select(F.col(by).alias("a"), F.col("c").alias("ca")), c.select(F.col(by).alias("b"), F.col("c").alias("cb"))
    return x.join(y, F.col("a") < F.col("b")).select("a", "b", F.round(T.dot(F.col("ca"), F.col("cb")), 6).alias("cosine"))


def nearest_centroid(vectors: DataFrame, key: str, vector: str, c: DataFrame, by: str) -> DataFrame:
    """(key, nearest, cosine): the centroid (one of few) closest to each vector; ties to the smaller name."""
    met = vectors.select(key, vector).join(c.select(F.col(by).alias("name"), "c"), how="cross").withColumn("cosine", F.round(T.dot(F.col(vector), F.col("c")), 6))
    return met.groupBy(key).agg(F.min_by("name", F.struct(-F.col("cosine"), "name")).alias("nearest"), F.max("cosine").alias("cosine"))


def window_cohesion(windows: DataFrame, clip: str, vector: str, below: float = 0.55) -> DataFrame:
    """(clip, windows, cohesion, overlap): the mean cosine of all pairs of a clip's window vectors, and whether it hints at a second voice.

    From sums: with unit vectors u, (|sum u|^2 - sum |u|^2) / (n (n - 1)). A clip of one window has a null cohesion and no
    overlap. A clip's windows meet in one row, as many as its seconds; null vectors don't count, and vectors are of one length.
    """
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    units = windows.where(F.col(vector).isNotNull()).select(clip, F.transform(v, lambda x: x / (norm + 1e-9)).alias("u"))
    per = units.groupBy(clip).agg(F.collect_list("u").alias("u"))
    total = F.aggregate(F.slice("u", F.lit(2), F.size("u")), F.get("u", F.lit(0)), lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
    square = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)
    n = F.size("u")
    mean = (square(total) - F.aggregate("u", F.lit(0.0), lambda s, x: s + square(x))) / (n * (n - 1))
    out = per.select(clip, n.cast("long").alias("windows"), F.when(n >= 2, F.round(mean, 6)).alias("cohesion"))
    return out.withColumn("overlap", F.coalesce(F.col("cohesion") < below, F.lit(False)))


def per_score(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(score, p, n): of each distinct score the rows with label 1, and all."""
    return scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("p"), F.count("*").alias("n"))


def roc_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(n_pos, n_neg, auc) by rank sums with average ranks; null with one class only. Ranks are running counts over ranges of scores."""
    per = running(per_score(scored, score, label), [], [F.col(score)], {"below": F.col("n")})
    ranked = per.withColumn("r", F.col("below") + (F.col("n") + 1) / 2)
    t = ranked.agg(F.sum("p").alias("n_pos"), F.sum(F.col("n") - F.col("p")).alias("n_neg"), F.sum(F.col("r") * F.col("p")).alias("s"))
    auc = F.try_divide(F.col("s") - F.col("n_pos") * (F.col("n_pos") + 1) / 2, F.nullif(F.col("n_pos") * F.col("n_neg"), F.lit(0)))
    return t.select("n_pos", "n_neg", F.round(auc, 6).alias("auc"))


def equal_error(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(eer, threshold): where missed and false accepts are closest over all thresholds (accept from the threshold up); ties to the higher one."""
    per = running(per_score(scored, score, label), [], [F.col(score).desc()], {"tp": F.col("p"), "fp": F.col("n") - F.col("p")}, {"all_p": "tp", "all_n": "fp"})
    tpr = F.try_divide(F.col("tp") + F.col("p"), F.col("all_p"))
    fpr = F.try_divide(F.col("fp") + F.col("n") - F.col("p"), F.col("all_n"))
    at = per.withColumn("fnr", 1 - tpr).withColumn("fpr", fpr).withColumn("gap", F.round(F.abs(F.col("fnr") - F.col("fpr")), 9))
    best = at.agg(F.min_by(F.struct("fnr", "fpr", F.col(score).alias("t")), F.struct("gap", -F.col(score))).alias("m"))
    return best.select(F.round((F.col("m.fnr") + F.col("m.fpr")) / 2, 6).alias("eer"), F.round("m.t", 6).alias("threshold"))

"""Ordered operators as windows: runs, packing, samples, splits, balanced selection, z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.ranking import fresh, positions, running


def runs(intervals: DataFrame, keys: list[str], start: str, end: str, gap: float) -> DataFrame:
    """(keys, run_start, run_end, n): intervals of a key joined while the next starts at most `gap` after the furthest end so far; empty runs go."""
    # zero-length and turned intervals sort last among equal starts
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("_new", F.coalesce((F.col(start) - before > gap).cast("int"), F.lit(1)))
    numbered = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "_run").agg(F.min(start).alias("run_start"), F.max(end).alias("run_end"), F.count("*").alias("n")).where("run_end > run_start").drop("_run")


def dominant(rows: DataFrame, by: str, who: str, weight: Column, order: Column) -> DataFrame:
    """(by, who, total): of each group the one with the largest sum of non-negative weight; ties to who came first."""
    per = rows.groupBy(by, who).agg(F.sum(F.greatest(weight, F.lit(0))).alias("total"), F.min(order).alias("_first"))
    return per.groupBy(by).agg(F.max_by(F.struct(who, "total"), F.struct("total", -F.col("_first"))).alias("_m")).select(by, f"_m.{who}", "_m.total")


def pack(pieces: DataFrame, key: str, start: str, end: str, low: float = 5.0, high: float = 15.0, least: float = 3.0, most: float = 25.0) -> DataFrame:
    """(key, clip, clip_start, clip_end): pieces of a key, in order, packed greedily into clips of low to high, none under least or over most.

    A fold over the sorted pieces of a key (as many as one source has): it carries the open clip and the closed ones.
    """
    rows = pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(start).cast("double").alias("s"), F.col(end).cast("double").alias("e")))).alias("p"))
    span = "struct<s:double,e:double>"
    zero = F.struct(F.lit(None).cast("double").alias("s"), F.lit(None).cast("double").alias("e"), F.array().cast(f"array<{span}>").alias("out"))

    def clip(s: Column, e: Column) -> Column:
        return F.array(F.struct(s.alias("s"), e.alias("e")))

    def step(a: Column, x: Column) -> Column:
        fits = x["e"] - a["s"] <= high
        full = a["e"] - a["s"] >= low
        extended = F.struct(a["s"].alias("s"), x["e"].alias("e"), a["out"].alias("out"))
        fresh = F.struct(x["s"].alias("s"), x["e"].alias("e"), F.concat(a["out"], clip(a["s"], a["e"])).alias("out"))
        first = F.struct(x["s"].alias("s"), x["e"].alias("e"), a["out"].alias("out"))
        return F.when(a["s"].isNull(), first).when(fits, extended).when(full, fresh).otherwise(extended)

    def finish(a: Column) -> Column:
        last = F.get(a["out"], F.size(a["out"]) - 1)
        glued = F.concat(F.slice(a["out"], F.lit(1), F.greatest(F.size(a["out"]) - 1, F.lit(0))), clip(last["s"], a["e"]))
        return F.when(a["s"].isNull(), a["out"]).when(a["e"] - a["s"] >= least, F.concat(a["out"], clip(a["s"], a["e"]))).when((F.size(a["out"]) > 0) & (a["e"] - last["s"] <= most), glued).otherwise(a["out"])

    packed = rows.select(key, F.explode(F.aggregate("p", zero, step, finish)).alias("c"))
    return hard_split(packed.select(key, F.col("c.s").alias("clip_start"), F.col("c.e").alias("clip_end")), key, most, high).where(F.col("clip_end") - F.col("clip_start") >= least)


def hard_split(clips: DataFrame, key: str, most: float = 25.0, target: float = 15.0) -> DataFrame:
    """Clips over `most` cut into ceil(length / target) equal parts; the last takes what is left."""
    d = F.col("clip_end") - F.col("clip_start")
    n = F.when(d > most, F.ceil(d / target)).otherwise(1).cast("int")
    cut = clips.withColumn("_n", n).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = F.col("clip_start") + F.col("_k") * d / F.col("_n")
    end = F.when(F.col("_k") == F.col("_n") - 1, F.col("clip_end")).otherwise(F.col("clip_start") + (F.col("_k") + 1) * d / F.col("_n"))
    return cut.select(key, at.alias("clip_start"), end.alias("clip_end"))


def z_scores(rows: DataFrame, by: str, features: list[str], digits: int = 3) -> DataFrame:
    """Adds <feature>_z for each feature over the rows of `by` (population deviation); a missing feature counts as 0, no spread gives 0."""
    w = Window.partitionBy(by)
    for f in features:
        x = F.coalesce(F.col(f), F.lit(0.0))
        sd = F.stddev_pop(x).over(w)
        rows = rows.withColumn(f"{f}_z", F.when(sd > 1e-6, F.round((x - F.avg(x).over(w)) / sd, digits)).otherwise(0.0))
    return rows


def balanced(rows: DataFrame, by: str, bucket: str, amount: str, target: float, order: list[Column]) -> DataFrame:
    """The rows of each `by` that round-robin over its buckets takes until `amount` reaches the target, the row that crosses it included.

    Buckets are visited from the smallest on, ties by which appears first; where all rows don't reach the target all are taken.
    Places and sums are taken in ranges of the order, so a `by` or bucket with most rows is spread.
    """
    placed = positions(rows, [by, bucket], order, "_round", "_size")
    # one row for each bucket: which of a `by` appears first
    of, at = fresh(placed, "__by"), fresh(placed, "__bucket")
    firsts = placed.where("_round = 0").withColumn("_first", F.row_number().over(Window.partitionBy(by).orderBy(*order))).select(F.col(by).alias(of), F.col(bucket).alias(at), "_first")
    met = placed.join(firsts, F.col(by).eqNullSafe(F.col(of)) & F.col(bucket).eqNullSafe(F.col(at))).drop(of, at)
    summed = running(met, [by], [F.col("_round"), F.col("_size"), F.col("_first")], {"_before": F.col(amount)}, {"_all": "_before"})
    return summed.where((F.col("_all") <= target) | (F.col("_before") < target)).drop("_round", "_size", "_first", "_before", "_all")


def split3(rows: DataFrame, by: list[str], fraction: float, order: list[Column]) -> DataFrame:
    """Adds split: every k-th row in order is test, the next validation, k = max(3, round(1 / fraction)); all train if the fraction isn't positive."""
    if fraction <= 0:
        return rows.withColumn("split", F.lit("train"))
    k = max(3, round(1 / fraction))
    i = F.col("_i") % k
    return positions(rows, by, order, "_i").withColumn("split", F.when(i == 0, "test").when(i == 1, "validation").otherwise("train")).drop("_i")


def stride_a(rows: DataFrame, by: list[str], n: int, order: list[Column]) -> DataFrame:
    """ordered[::k][:n] of each group, k = max(1, size div n)."""
    k = F.greatest(F.lit(1), F.expr(f"_n div {n}"))
    return positions(rows, by, order, "_i", "_n").where((F.col("_i") % k == 0) & (F.col("_i") / k < n)).drop("_i", "_n")


def stride_b(rows: DataFrame, by: list[str], n: int, order: list[Column]) -> DataFrame:
    """Rows int(i * size / n) for i < n of each group; all of a group of n or fewer."""
    # row r is taken if some i has floor(i * size / n) = r
    r = positions(rows, by, order, "_r", "_c")
    hit = F.expr(f"((_r * {n} + _c - 1) div _c) * _c div {n}") == F.col("_r")
    return r.where((F.col("_c") <= n) | (hit & (F.expr(f"(_r * {n} + _c - 1) div _c") < n))).drop("_r", "_c")


def low_mid_high(rows: DataFrame, by: list[str], order: list[Column], k: int = 3) -> DataFrame:
    """Adds band: the first k, k around the middle, the last k of each group; a row may be in several."""
    mid = F.expr("_n div 2")
    bands = F.filter(F.array(F.when(F.col("_i") < k, "low"), F.when(F.col("_i").between(mid - 1, mid + k - 2), "mid"), F.when(F.col("_i") >= F.col("_n") - k, "high")), lambda x: x.isNotNull())
    return positions(rows, by, order, "_i", "_n").withColumn("band", F.explode(bands)).drop("_i", "_n")


def first_per_key(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    return rows.withColumn("_k", key).withColumn("_n", F.row_number().over(Window.partitionBy("_k").orderBy(*order))).where("_n = 1").drop("_k", "_n")


def numbered_ids(rows: DataFrame, by: str, order: list[Column], name: str = "id") -> DataFrame:
    """Adds ids like source_0007: a running number for each source."""
    return positions(rows, [by], order, "_i").withColumn(name, F.format_string("%s_%04d", F.col(by).cast("string"), F.col("_i"))).drop("_i")


def trim_window(offset: Column, end_trim: Column, duration: Column, max_minutes: Column) -> tuple[Column, Column]:
    """(start, length) of what is read of a recording."""
    start = F.greatest(F.lit(0.0), offset)
    end = F.greatest(start, duration - F.coalesce(end_trim, F.lit(0.0)))
    cap = F.nullif(max_minutes, F.lit(0.0)) * 60
    return start, F.least(end - start, F.coalesce(cap, end - start))


def sample_windows(clips: DataFrame, samples: str, size: int, hop: int) -> DataFrame:
    """clips with (window, window_samples): a row for each whole window of `size` samples, every `hop`; shorter clips have none."""
    last = F.expr(f"(size(`{samples}`) - {size}) div {hop}")
    whole = clips.where(F.size(samples) >= size).withColumn("window", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    return whole.withColumn("window_samples", F.slice(samples, F.col("window") * hop + 1, F.lit(size)))

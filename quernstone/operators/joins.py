"""Enrichment and upserts: score merges, review decisions, interval text, leakage checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators.ranking import positions


def score_merge(segments: DataFrame, scores: list[DataFrame], key: str = "id", skip: tuple[str, ...] = ("language",)) -> DataFrame:
    """Segments with the columns of score tables keyed by `key`, the later table winning where it has the row (a null in it wins too). Unknown ids are ignored."""
    for k, table in enumerate(scores):
        names = [c for c in table.columns if c != key and c not in skip]
        side = table.select(key, F.lit(True).alias("_has"), *[F.col(c).alias(f"_new_{c}") for c in names])
        joined = segments.join(side, key, "left")
        for c in names:
            old = F.col(c) if c in segments.columns else F.lit(None).cast(table.schema[c].dataType)
            joined = joined.withColumn(c, F.when(F.col("_has"), F.col(f"_new_{c}")).otherwise(old))
        segments = joined.drop("_has", *[f"_new_{c}" for c in names])
    return segments


def review_merge(segments: DataFrame, decisions: DataFrame) -> DataFrame:
    """Segments (id, transcript, emotion, style, emotion_confidence, tag_source, review_decision) with reviewers' decisions.

    A reject leaves labels alone; otherwise a label that isn't empty and differs replaces the old one and marks the row as human.
    """
    said = lambda c: F.coalesce(F.trim(F.col(f"d.{c}")), F.lit(""))
    rows = segments.alias("s").join(decisions.alias("d"), "id", "left")
    decision = F.lower(said("decision"))
    open_row = F.col("d.decision").isNotNull() & (decision != "reject")
    new = {"emotion": F.lower(said("emotion")), "style": F.lower(said("style")), "transcript": said("transcript")}
    differs = {c: open_row & (v != "") & (v != F.coalesce(F.col(f"s.{c}"), F.lit(""))) for c, v in new.items()}
    changed = reduce(lambda a, b: a | b, differs.values())
    out = {c: F.when(differs[c], v).otherwise(F.col(f"s.{c}")) for c, v in new.items()}
    out["review_decision"] = F.when(decision.isin("accept", "reject"), decision).otherwise(F.col("s.review_decision"))
    out["tag_source"] = F.when(changed, "human").otherwise(F.col("s.tag_source"))
    out["emotion_confidence"] = F.when(changed, 1.0).otherwise(F.col("s.emotion_confidence"))
    return rows.select("id", *[out[c].alias(c) if c in out else F.col(f"s.{c}") for c in segments.columns if c != "id"])


def overlapping(left: DataFrame, right: DataFrame, key: str, width: float = 30.0) -> DataFrame:
    """All pairs of rows of one key whose intervals (left_start, left_end), (right_start, right_end) overlap, touching ones not.

    Either side is dealt to the stretches of `width` seconds that it reaches into, so rows meet by (key, stretch) and a
    key with most rows is spread over its time; a pair counts in the first stretch that both reach into. Turned
    intervals count from their lower end; null or endless times meet nothing.
    """

    def dealt(rows: DataFrame, side: str) -> DataFrame:
        low, high = (f(F.col(f"{side}_start"), F.col(f"{side}_end")) for f in (F.least, F.greatest))
        timed = rows.where((F.abs(f"{side}_start") < 1e15) & (F.abs(f"{side}_end") < 1e15))
        first = F.floor(low / width)
        return timed.withColumn(f"_{side}", first).withColumn("_stretch", F.explode(F.sequence(first, F.floor(high / width))))

    met = dealt(left, "left").join(dealt(right, "right"), [key, "_stretch"])
    return met.where("left_end > right_start and right_end > left_start and _stretch = greatest(_left, _right)").drop("_stretch", "_left", "_right")


def overlapping_text(clips: DataFrame, chunks: DataFrame, key: str, width: float = 30.0) -> DataFrame:
    """clips (key, clip_start, clip_end) with the texts of the chunks (key, start, end, text) that overlap them, in order, joined by blanks; equal clips are one."""
    names = [c for c in clips.columns if c not in (key, "clip_start", "clip_end")]
    left = clips.select(F.col(key), F.col("clip_start").alias("left_start"), F.col("clip_end").alias("left_end"), F.struct(F.lit(0).alias("_"), *names).alias("more"))
    right = chunks.where(F.trim("text") != "").select(F.col(key), F.col("start").alias("right_start"), F.col("end").alias("right_end"), "text")
    met = overlapping(left, right, key, width).select(key, "left_start", "left_end", "more", F.struct(F.col("right_start").alias("start"), "text").alias("said"))
    every = left.withColumn("said", F.lit(None).cast(met.schema["said"].dataType)).unionByName(met)
    texts = F.array_join(F.transform(F.array_sort(F.collect_list("said")), lambda x: x["text"]), " ")
    whole = every.groupBy(key, "left_start", "left_end", "more").agg(texts.alias("text"))
    of = {"clip_start": "left_start", "clip_end": "left_end", key: key} | {c: f"more.{c}" for c in names}
    return whole.select(*[F.col(of[c]).alias(c) for c in clips.columns], "text")


def with_lookup(rows: DataFrame, table: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """Left join to a table of attributes; what is missing gets its default."""
    return rows.join(table, key, "left").withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def only_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.join(known.select(key), key, "left_semi")


def not_processed(rows: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    return rows if force else rows.join(done.select(key), key, "left_anti")


def leaks(rows: DataFrame, key: Column, split: str = "split") -> DataFrame:
    """(held_out, key): keys of validation or test that train has too."""
    keyed = rows.select(key.alias("key"), split)
    train = keyed.where(F.col(split) == "train").select("key").distinct()
    return keyed.where(F.col(split) != "train").select(F.col(split).alias("held_out"), "key").distinct().join(train, "key", "left_semi").select("held_out", "key")


def with_provenance(segments: DataFrame, provenance: DataFrame, sources: DataFrame) -> DataFrame:
    """segments (source_id, ...) with url, title, channel, upload date and license of where they come from.

    The license is the record's, else the one declared in sources (id, license), else `unknown`; what is missing is empty.
    """
    names = {"source_url": "url", "source_video_id": "video_id", "source_title": "title", "source_channel": "channel", "upload_date": "upload_date"}
    p = provenance.select("source_id", F.col("license").alias("_said"), *[F.col(c).alias(f"_{n}") for n, c in names.items()])
    met = segments.join(p, "source_id", "left").join(sources.select(F.col("id").alias("source_id"), F.col("license").alias("_declared")), "source_id", "left")
    values = {n: F.coalesce(F.col(f"_{n}"), F.lit("")) for n in names} | {"license": T.missing(F.col("_said"), T.missing(F.col("_declared"), "unknown"))}
    return met.select(*[F.col(f"`{c}`") for c in segments.columns if c not in values], *[v.alias(n) for n, v in values.items()])


def zipped(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column], name: str = "place") -> DataFrame:
    """(place, left, right): structs of the rows that have the same place in their table's order, as many as the shorter has."""
    a = positions(left, [], left_order, name).select(name, F.struct(*left.columns).alias("left"))
    b = positions(right, [], right_order, name).select(name, F.struct(*right.columns).alias("right"))
    return a.join(b, name)

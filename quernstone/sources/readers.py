"""Readers: manifests, score files, diarisations, review sheets, source lists, recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from quernstone import schemas


def or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """What read() gives, or no rows of the schema where the path has nothing."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """Segment manifests (a JSON array a file), by one path or a glob, with the file they come from; none gives no rows.

    Text that is missing is empty, never null; lists that are missing are empty. Order by (file, id) for the order of files.
    """
    schema = T.StructType([*schemas.SEGMENT.fields, T.StructField("file", T.StringType())])
    d = or_empty(spark, lambda: spark.read.schema(schemas.SEGMENT).json(path, multiLine=True).withColumn("file", F.input_file_name()), schema)
    empty = {"transcript": "", "transcript_batch": "", "source_url": "", "source_title": "", "channel": "", "license": "unknown", "content_type": "", "upload_date": "", "tag_source": "auto", "status": "candidate"}
    return d.fillna(empty).withColumn("reject_reasons", F.coalesce("reject_reasons", F.array().cast("array<string>"))).withColumn("flags", F.coalesce("flags", F.array().cast("array<string>")))


def scores(spark: SparkSession, path: str, metrics: T.StructType) -> DataFrame:
    """(id, metrics...) of a JSON object that maps ids to objects; a missing file gives no rows."""
    schema = T.StructType([T.StructField("id", T.StringType()), *metrics.fields])

    def read() -> DataFrame:
        text = spark.read.text(path, wholetext=True)
        return text.select(F.explode(F.from_json("value", T.MapType(T.StringType(), metrics)))).select(F.col("key").alias("id"), "value.*")

    return or_empty(spark, read, schema)


def diarization(spark: SparkSession, path: str) -> DataFrame:
    """(file, language_code, full_transcript, start_s, end_s, speaker_id, text): one row a chunk. No file is an error."""
    d = spark.read.schema(schemas.DIARIZATION).json(path, multiLine=True).withColumn("file", F.input_file_name())
    e = d.select("file", F.coalesce("language_code", F.lit("")).alias("language_code"), F.coalesce("transcript", F.lit("")).alias("full_transcript"), F.explode("diarized_transcript.entries").alias("e"))
    zero, blank = F.lit(0.0), F.lit("")
    return e.select("file", "language_code", "full_transcript", F.coalesce("e.start_time_seconds", zero).alias("start_s"), F.coalesce("e.end_time_seconds", zero).alias("end_s"), F.coalesce("e.speaker_id", F.lit("0")).alias("speaker_id"), F.coalesce("e.transcript", blank).alias("text"))


def preferred(files: DataFrame, stem: str) -> DataFrame:
    """The rows of the file whose name has the stem, or else of the first file by name."""
    named = files.withColumn("_miss", (~F.element_at(F.split("file", "/"), -1).contains(stem)).cast("int"))
    best = named.agg(F.min(F.struct("_miss", "file")).alias("b"))  # one row
    return named.join(F.broadcast(best), (F.col("_miss") == F.col("b._miss")) & (F.col("file") == F.col("b.file"))).drop("_miss", "b")


def word_times(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, word, start_s, end_s) of the parallel arrays of a diarisation."""
    d = spark.read.schema(schemas.DIARIZATION).json(path, multiLine=True).withColumn("file", F.input_file_name())
    z = d.select("file", F.posexplode(F.arrays_zip(F.col("timestamps.words").alias("w"), F.col("timestamps.start_time_seconds").alias("s"), F.col("timestamps.end_time_seconds").alias("e"))).alias("n", "z"))
    return z.select("file", "n", F.col("z.w").alias("word"), F.col("z.s").alias("start_s"), F.col("z.e").alias("end_s"))


def sheet(spark: SparkSession, path: str, schema: T.StructType = schemas.DECISION) -> DataFrame:
    """A review or audit sheet: all text, quoted fields may hold line ends, missing is empty."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"').na.fill("")


def source_list(spark: SparkSession, text: str) -> DataFrame:
    """Curated sources of a YAML text with a list under `sources`; an empty text gives no rows. The list is short and on the driver."""
    import yaml

    rows = (yaml.safe_load(text) or {}).get("sources") or []
    defaults = {"enabled": True, "start_offset_s": 0.0, "end_trim_s": 0.0}
    names = schemas.SOURCE.fieldNames()
    number = lambda n, v: float(v) if v is not None and isinstance(schemas.SOURCE[n].dataType, T.DoubleType) else v
    return spark.createDataFrame([tuple(number(n, r.get(n, defaults.get(n))) for n in names) for r in rows], schemas.SOURCE)


def recordings(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of audio files; decode with quernstone.functions.audio."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def published(spark: SparkSession, path: str) -> DataFrame:
    """A published dataset, with config and split as columns."""
    return spark.read.parquet(path)


def provenance(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, video_id, title, channel, ...) of records named <source_id>.meta.json, by a path or a glob; none gives no rows."""
    schema = T.StructType([T.StructField("source_id", T.StringType()), *schemas.PROVENANCE.fields])
    named = F.regexp_extract(F.input_file_name(), r"([^/]+)\.meta\.json$", 1)
    return or_empty(spark, lambda: spark.read.schema(schemas.PROVENANCE).json(path, multiLine=True).select(named.alias("source_id"), "*"), schema)

"""Mining of phrases whose words keep together, per language.

Pieces. Texts are lower-cased (A-Z) and split at punctuation and line ends; equal pieces of a language become one row
with their number, so that copies of documents and passages are counted once and weigh as often as they occur.

Counts. A task codes the words of some megabytes of pieces as whole numbers and adds up their phrases of 1 to
`max_words` words, each weighed by its piece's number. These partial counts go to hash buckets as compressed Arrow
blobs, one row for each bucket, so Spark moves few large rows. In a bucket, DuckDB reads the blobs as a stream and adds
up equal phrases under a memory limit; beyond that it spills to a folder of the task's own, which goes with the task.
Phrases are compared as strings, so counts are exact. Those that occur `least` times stay.

Parts. Each cut of a candidate asks for the counts of its two parts: requests are shuffled to where the part's count
is. Parts with at least a thousandth of all words are at most 1000 for each length, and answer from a broadcast table
instead; any other part has under n / (1000 * least) candidates on either side, so no key is hot.

Cases. Null text: no words. Null lang: `und`, with rows that say so themselves. Repeated rows count each. A piece of
one word has no candidate. Very long texts are split before anything is sorted; a text without any punctuation is one
piece. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import itertools
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, doc_chunks, materialise, mix64, partitions, word_hashes

ENDS = r"[.,;:!?\x0A-\x0D]"
CHUNK = 8 << 20
COUNTED = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("words", pa.int32()), ("f", pa.int64())])


def split_pieces(docs: DataFrame) -> DataFrame:
    """(lang, piece, m): the distinct pieces of each language, their words joined by one blank, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for x in batches for b in doc_chunks([x], "text")):
            # taken, as ascii_lower reads slices of an array wrongly
            text = pc.ascii_lower(pc.fill_null(batch.column("text").cast(pa.large_string()), "").take(pa.array(range(batch.num_rows))))
            split = pc.split_pattern_regex(text, ENDS)
            piece = split.flatten()
            # blanks inside are made one only where there are more or a tab, which few pieces have
            odd = pc.match_substring_regex(piece, r"\t|  ")
            if pc.any(odd).as_py():
                piece = pc.if_else(odd, pc.replace_substring_regex(piece, r"[ \t]+", " "), piece)
            piece = pc.ascii_trim(piece, " \t")
            lang = pc.take(pc.fill_null(batch.column("lang").cast(pa.string()), "und"), pc.list_parent_indices(split))
            kept = pc.not_equal(piece, "")
            part = pa.table({"lang": lang.filter(kept), "piece": piece.filter(kept)}).group_by(["lang", "piece"]).aggregate([([], "count_all")])
            yield from part.select(["lang", "piece", "count_all"]).rename_columns(["lang", "piece", "m"]).cast(pa.schema([("lang", pa.string()), ("piece", pa.string()), ("m", pa.int64())])).to_batches(65536)

    pieces = docs.select("lang", "text").mapInArrow(run, "lang string, piece string, m long")
    return pieces.groupBy("lang", "piece").agg(F.sum("m").alias("m"))


def summed(keys: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the first of each distinct key is, the sums of m for them, and the number of each key's group."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    head = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.zeros(0, bool)
    at = np.flatnonzero(head)
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(head) - 1
    return order[at], np.add.reduceat(m[order], at) if len(at) else np.zeros(0, np.int64), group


def counted(pieces: pa.Table, max_words: int) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """For each phrase length, the bucket hashes and (lang, gram, words, f) of the phrases of some pieces; length 0 has the words of each language."""
    split = pc.split_pattern(pieces.column("piece").combine_chunks(), " ")
    parent = pc.list_parent_indices(split).to_numpy()
    words = split.flatten().dictionary_encode()
    names = words.dictionary
    langs = pieces.column("lang").combine_chunks().dictionary_encode()
    m = pieces.column("m").combine_chunks().to_numpy()[parent]
    lang = langs.indices.to_numpy().astype(np.int64)[parent]
    hashes = word_hashes(np.frombuffer("\n".join(names.to_pylist()).encode(), np.uint8), 3)[2]
    lang_hash = mix64(np.arange(len(langs.dictionary), dtype=np.uint64))
    for k, name in enumerate(langs.dictionary.to_pylist()):
        lang_hash[k] = word_hashes(np.frombuffer(b"=" + (name or "").encode().replace(b" ", b"_"), np.uint8), 5)[2][0]
    total = np.zeros(len(langs.dictionary), np.int64)
    np.add.at(total, lang, m)
    yield lang_hash, pa.table([langs.dictionary.cast(pa.string()), pa.array([""] * len(total)), pa.array(np.zeros(len(total), np.int32)), pa.array(total)], schema=COUNTED)
    code = words.indices.to_numpy().astype(np.int64)
    first, f, group = summed(lang * len(names) + code, m)
    # the dense number of the phrase of n words that begins at each word; -1 where its piece ends before
    phrase = group
    for n in range(1, max_words + 1):
        text, h = names.take(pa.array(code[first])), mix64(lang_hash[lang[first]] + hashes[code[first]])
        for k in range(1, n):
            text = pc.binary_join_element_wise(text, names.take(pa.array(code[first + k])), " ")
        # phrases of one beginning go together, in order, as their strings then compress well
        h = h if n == 1 else mix64(h * np.uint64(0x9E3779B97F4A7C15) + hashes[code[first + 1]])
        yield h, pa.table([langs.dictionary.take(pa.array(lang[first])).cast(pa.string()), text.cast(pa.string()), pa.array(np.full(len(first), n, np.int32)), pa.array(f)], schema=COUNTED)
        begins = np.flatnonzero(parent[:-n] == parent[n:])
        if n == max_words or not len(begins):
            return
        at, f, group = summed(phrase[begins] * len(names) + code[begins + n], m[begins])
        first = begins[at]
        phrase = np.full(len(code), -1, np.int64)
        phrase[begins] = group


def phrase_counts(pieces: DataFrame, least: int, max_words: int, buckets: int, memory: str = "256MB") -> DataFrame:
    """(lang, gram, words, f) of phrases that occur `least` times, and with words 0 the number of words of each language."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks() -> Iterator[pa.Table]:
            held, size = [], 0
            for batch in (b for x in batches for b in doc_chunks([x], "piece", CHUNK)):
                held.append(batch)
                size += batch.column("piece").nbytes
                if size >= CHUNK:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
            if held:
                yield pa.Table.from_batches(held)

        for chunk in chunks():
            parts: dict[int, list[pa.Table]] = {}
            for h, grams in counted(chunk, max_words):
                bucket = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                grams, bucket = grams.take(pa.array(order)), bucket[order]
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
                for a, b in itertools.pairwise(cuts):
                    parts.setdefault(int(bucket[a]), []).append(grams.slice(a, b - a))
            for bucket in sorted(parts):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, COUNTED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(pa.concat_tables(parts.pop(bucket)).combine_chunks())
                yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["bucket", "blob"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b, blob) for x in batches for b, blob in zip(x.column("bucket").to_pylist(), x.column("blob"), strict=True))
        with tempfile.TemporaryDirectory() as spill, duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": spill, "preserve_insertion_order": False}) as db:
            for _, group in itertools.groupby(rows, lambda r: r[0]):
                stream = (part for _, blob in group for part in pa.ipc.open_stream(blob.as_buffer()))
                partial_counts = pa.RecordBatchReader.from_batches(COUNTED, stream)  # noqa: F841 - DuckDB reads it by name
                found = db.sql(f"SELECT lang, gram, words, sum(f)::BIGINT AS f FROM partial_counts GROUP BY ALL HAVING words = 0 OR sum(f) >= {least}")
                for out in found.to_arrow_reader(65536):
                    yield out.cast(COUNTED)

    blobs = pieces.mapInArrow(partial, "bucket long, blob binary")
    # a bucket is a partition, so tasks are even; what one task writes is at most a row for each of them
    return blobs.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket").mapInArrow(whole, "lang string, gram string, words int, f long")


def collocations(docs: DataFrame, least: int = 10, max_words: int = 3, inside: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases by score, a, phrase.

    A phrase goes if a longer one that has at least `inside` percent of its count holds it.
    """
    counts = materialise(phrase_counts(split_pieces(docs), least, max_words, partitions(docs.sparkSession)), "phrase-counts")
    # one number: a part is common if it makes up a thousandth of all words
    total = counts.where("words = 0").agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    words = F.split("gram", " ")
    candidates = counts.where("words >= 2")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    sides = F.explode(F.array(F.struct(F.lit("l").alias("side"), F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("part")), F.struct(F.lit("r").alias("side"), F.array_join(F.slice(words, F.col("k") + 1, F.col("words")), " ").alias("part"))))
    asked = candidates.withColumn("k", cut).withColumn("s", sides).select("lang", "gram", F.col("f").alias("a"), "k", "s.side", "s.part")
    known = counts.where(F.col("words").between(1, max_words - 1)).select("lang", F.col("gram").alias("part"), F.col("f").alias("times"))
    common = F.broadcast(known.where(F.col("times") * 1000 >= total).withColumnRenamed("times", "common_times"))  # at most 1000 for each length
    asked = asked.join(common, ["lang", "part"], "left")
    answered = asked.where("common_times is not null").select("lang", "gram", "a", "k", "side", F.col("common_times").alias("times"))
    looked_up = asked.where("common_times is null").join(known, ["lang", "part"]).select("lang", "gram", "a", "k", "side", "times")
    cuts = answered.unionByName(looked_up).groupBy("lang", "gram", "a", "k").agg(F.max(F.when(F.col("side") == "l", F.col("times"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("times"))).alias("r"))
    # 38 digits: a, l and r have up to 15
    big = lambda c: F.col(c).cast("decimal(15,0)")
    scored = cuts.withColumn("score", F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (big("a") * big("a")), big("l") * big("r")))
    best = scored.groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    held = candidates.where("words > 2").withColumn("len", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("len") + 1)))
    held = held.select("lang", F.array_join(F.slice(words, F.col("i"), F.col("len")), " ").alias("gram"), "f").groupBy("lang", "gram").agg(F.max("f").alias("longer"))
    kept = best.join(held, ["lang", "gram"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * inside, F.lit(True))).select("lang", F.col("gram").alias("phrase"), "a", "m.l", "m.r", "m.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the first `top` of each of 64 parts of a language, then of these
    parts = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def oracle(least: int = 10, inside: int = 50, top: int = 2000) -> str:
    """The same in SQL for phrases of up to three words."""
    low = f"translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}')"
    return rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({low}, '{ENDS}')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w, count(*) AS m FROM p GROUP BY ALL),
c AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS gram, sum(m)::BIGINT AS f
  FROM (SELECT lang, w, m, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) AS t(k)) GROUP BY ALL
),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k AS words, gram, string_split(gram, ' ') AS w, f AS a FROM c WHERE k > 1 AND f >= {least}),
cuts AS (
  SELECT x.lang, x.gram, x.a, x.cut, l.f AS l, r.f AS r, (1000000::HUGEINT * x.a * x.a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, words)) AS cut FROM cand) AS x
  JOIN c AS l ON l.lang = x.lang AND l.gram = array_to_string(x.w[1:x.cut], ' ') AND l.k = x.cut
  JOIN c AS r ON r.lang = x.lang AND r.gram = array_to_string(x.w[x.cut + 1:], ' ') AND r.k = x.words - x.cut
),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) AS place FROM cuts QUALIFY place = 1),
held AS (SELECT lang, gram, max(a) AS longer FROM (SELECT lang, array_to_string(w[i:i + 1], ' ') AS gram, a FROM (SELECT *, unnest(range(1, 3)) AS i FROM cand WHERE words = 3)) GROUP BY ALL),
kept AS (SELECT b.* FROM best AS b LEFT JOIN held AS h ON h.lang = b.lang AND h.gram = b.gram WHERE coalesce(100 * h.longer < {inside} * b.a, true))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, gram) AS rank, gram AS phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= {top}"""

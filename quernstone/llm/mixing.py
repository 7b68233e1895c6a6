"""Mixing sources to target weights over a low-discrepancy schedule.

Targets. Sources, by code point with null last, weigh 5, 2, 1, repeating, and share `share` times all words; a
target stops at `repeat` times its source's words and the excess goes to the others by weight (water-filling, in
closed form over the sources sorted by capacity / weight).

Schedule. A source needs q = ceil(target / block) slots of `block` words. The schedule has 2**m >= sum(q) places;
place i has the van der Corput point reverse_bits(i) / 2**m, and the cumulative q map that point to a source (or to
none, for the places beyond sum(q)). As bit reversal is a permutation, each source gets exactly q slots, spread
evenly over every stretch of the schedule. The rank of a slot among those of its source has a closed form (counts
of residues over the dyadic parts of the source's range), so places are ranked where they are made, without a
shuffle. Slot r of a source is block r of the source's stream: its documents in hash order, `repeat` times over.

Scale. Running word counts are taken in `BUCKETS` hash buckets for each source, so a source with a third of all
rows is spread as any other; only the table of sources (one row each) is in one task.

Cases. Null text: 0 words. Documents without words take nothing. Null source: a source of its own, ordered last.
Repeated rows count each on their own. No words at all: targets are 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise

WEIGHTS = (5.0, 2.0, 1.0)
BUCKETS = 256


def source_targets(sizes: DataFrame, share: float = 1.5, repeat: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target) of a table of (source, size): one row for each source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row for each source: the single task below holds the list of sources, not of documents.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    full = by_room.rowsBetween(0, Window.unboundedFollowing)
    rated = per.withColumn("weight", w).withColumn("cap", F.lit(repeat) * F.col("source_size")).withColumn("room", F.col("cap") / F.col("weight"))
    level = rated.withColumn("wanted", F.least(F.lit(share) * F.sum("source_size").over(every), F.sum("cap").over(every)))
    # The level at which sources below this one are full and all others take weight * level; valid if this one isn't full.
    level = level.withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(full))
    level = level.withColumn("water", F.max(F.when(F.col("level") <= F.col("room"), F.col("level"))).over(every))
    return level.select("source", "source_size", "weight", F.least(F.col("cap"), F.col("weight") * F.coalesce("water", F.col("room"))).alias("target"))


def reverse_bits(i: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(i)
    for b in range(bits):
        out |= ((i >> b) & 1) << (bits - 1 - b)
    return out


def ranks_below(i: np.ndarray, bound: np.ndarray, bits: int) -> np.ndarray:
    """How many j < i have reverse_bits(j) < bound: each one-bit of bound is a dyadic range, that is a residue class of j."""
    count = np.where(bound >> bits > 0, i, 0)
    for b in range(bits):
        # bound's bit b gives the range that shares bound's higher bits and has a 0 there
        period = 1 << (bits - b)
        first = reverse_bits((bound >> (b + 1)) << (b + 1), bits) % period
        count += np.where((bound >> b) & 1, np.maximum(0, (i - first + period - 1) // period), 0)
    return count


def schedule(spark, quotas: list[tuple[int, int]], chunk: int = 1 << 16) -> DataFrame:
    """(place, source_no, rank): the slots of sources (number, quota), in the order of the schedule."""
    numbers = np.array([s for s, _ in quotas], np.int64)
    ends = np.cumsum([q for _, q in quotas]).astype(np.int64)
    total = int(ends[-1]) if len(ends) else 0
    bits = max(1, (max(total, 1) - 1).bit_length())
    starts = ends - np.array([q for _, q in quotas], np.int64)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in batch.column(0).to_pylist():
                i = np.arange(c * chunk, min((c + 1) * chunk, 1 << bits), dtype=np.int64)
                point = reverse_bits(i, bits)
                i, point = i[point < total], point[point < total]
                k = np.searchsorted(ends, point, "right")
                rank = ranks_below(i, ends[k], bits) - ranks_below(i, starts[k], bits)
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(numbers[k]), pa.array(rank)], ["place", "source_no", "rank"])

    n = ((1 << bits) + chunk - 1) // chunk if total else 0
    return spark.range(0, n, 1, max(1, min(n, 4096))).mapInArrow(places, "place long, source_no long, rank long")


def sized(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(*carry, "doc_id", "source", F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(WORD))).cast("long").alias("size"), F.xxhash64("doc_id", F.lit(11)).alias("h"))


def laid_out(docs: DataFrame, share: float = 1.5, repeat: float = 2.0, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Documents with their place `start` in their source's stream, and the sources with their number and target. Columns named in `carry` stay and settle ties."""
    size = materialise(sized(docs, carry), "mix-size").withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    targets = materialise(source_targets(size, share, repeat).withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")), "mix-target")
    per = size.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
    base = per.select("source", "bucket", (F.sum("s").over(Window.partitionBy("source").orderBy("bucket")) - F.col("s")).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = size.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
    a, b, t = runs.alias("a"), base.alias("b"), targets.alias("t")
    rows = a.join(b, F.expr("a.source <=> b.source and a.bucket = b.bucket")).join(t, F.expr("a.source <=> t.source"))
    return rows.select(*[f"a.{c}" for c in carry], "a.doc_id", "a.source", "t.source_no", "a.h", "a.size", "t.source_size", "t.target", (F.col("b.base") + F.col("a.inside")).alias("start")), targets


def mix(docs: DataFrame, block: int = 64, share: float = 1.5, repeat: int = 2, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with sizes and targets, pieces of them in blocks, slots of the schedule).

    A piece is (source_no, block, doc key, epoch, first word, words); joined to the slots on (source_no, rank = block)
    it gives the mixed stream in the order of `place`.
    """
    rows, targets = laid_out(docs, share, repeat, carry)
    rows = materialise(rows, "mix-rows")
    # One row for each source: the quotas that the schedule is made of.
    quotas = [(r[0], r[1]) for r in targets.orderBy("source_no").select("source_no", F.expr(f"(cast(round(target) as long) + {block - 1}) div {block}")).toLocalIterator()]
    slots = schedule(docs.sparkSession, quotas)
    pieces = (
        rows.where("size > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
        .withColumn("lo", F.col("start") + F.col("epoch") * F.col("source_size"))
        .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.round("target").cast("long")))
        .where("lo < hi")
        .withColumn("rank", F.explode(F.sequence(F.expr(f"lo div {block}"), F.expr(f"(hi - 1) div {block}"))))
        .select(*carry, "source_no", "rank", "doc_id", "start", "size", "epoch", (F.greatest("lo", F.col("rank") * block) - F.col("lo")).alias("first_word"), (F.least("hi", (F.col("rank") + 1) * block) - F.greatest("lo", F.col("rank") * block)).alias("words"))
    )
    return rows, pieces, slots


def mixed_stream(docs: DataFrame, block: int = 64, share: float = 1.5, repeat: int = 2) -> DataFrame:
    """(place, source_no, doc_id, first_word, words): what the mix reads, slot by slot."""
    _, pieces, slots = mix(docs, block, share, repeat)
    return slots.hint("merge").join(pieces, ["source_no", "rank"])


def taken(docs: DataFrame, block: int = 64, share: float = 1.5, repeat: int = 2) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row: the words that the scheduled slots take of it."""
    rows, pieces, slots = mix(docs, block, share, repeat)
    took = slots.hint("merge").join(pieces, ["source_no", "rank"]).groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
    some = rows.where("size > 0").join(took, ["source_no", "start"], "left")
    rest = rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    out = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
    return some.select(*out).union(rest.select(*out))


def mix_documents(docs: DataFrame, block: int = 64, share: float = 1.5, repeat: int = 2) -> DataFrame:
    """The documents of the mix, whole, with all their columns: one row for each epoch in which scheduled slots take at least half of a document's words.

    Only the document at which a source's target falls can be taken in part, so a source's words are off by up to half
    of one document. The first document of a stream is taken if slots take any of it, so that no source with a target
    goes. A document without words has no slots: it is taken in each epoch in which its place in the stream is below
    the target, and once if its source has no words at all. Rows with equal ids are told apart by their text. Order is
    not part of a table; mixed_stream gives the schedule.
    """
    row = "__row"
    while row in map(str.lower, docs.columns):
        row += "_"
    # written once, so that the numbers of the rows are the same wherever they are read
    numbered = materialise(docs.withColumn(row, F.struct(F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("n"))), "mix-docs")
    rows, pieces, slots = mix(numbered.select("doc_id", "source", "text", row), block, share, repeat, (row,))
    took = slots.hint("merge").join(pieces, ["source_no", "rank"]).groupBy(row, "epoch", "start", "size").agg(F.sum("words").alias("words"))
    taken = took.where("2 * words >= size or (start = 0 and epoch = 0)").select(row)
    wordless = " + ".join(f"int(start + {e} * source_size < target or (source_size = 0 and {e} = 0))" for e in range(repeat))
    taken = taken.unionByName(rows.where("size = 0").select(row, F.expr(f"explode(array_repeat(0, {wordless}))").alias("_")).select(row))
    copies = taken.groupBy(F.col(f"{row}.n").alias("n")).agg(F.count("*").cast("int").alias("copies"))
    joined = numbered.alias("d").hint("merge").join(copies.alias("c"), F.expr(f"d.`{row}`.n = c.n"))
    return joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col("c.copies"))).alias(row)).drop(row)

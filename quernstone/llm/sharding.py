"""Sharding by balanced label propagation.

Linked documents (here: of equal text) are drawn to one shard while all shards keep near equal bytes.

Start. Documents in hash order are cut into `shards` ranges of equal bytes.
Propagation. In each round a Spark join brings the shard histogram of each link group (group, shard, bytes: one row a
shard at most, whatever the size of the group) to its documents, which want to go where most of the group's bytes are
(ties to a shard by the group's hash). Documents that are elsewhere move there, in hash order, until the shard's quota
of linked bytes is full; the rest gather elsewhere in the next rounds, in which full shards take no part.
Balance. Documents without links follow: in each shard over its quota, documents in hash order beyond the quota go to
shards under theirs, by matching running byte counts of what is over with what is under. If linked documents alone
are over a quota, they are cut in the same way, so a group larger than a shard is split and sizes still are even.

The running counts are taken in hash buckets, so no task holds a shard.

Law: `bytes`. Cases. Null text: no bytes (size 1), an empty text for crc and links. Null id or repeated rows: rows of
their own; equal rows may be in different shards only if a quota cuts between them. Empty table: no rows. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BUCKETS = 512


def running(rows: DataFrame, by: list[str], order: list[str], size: str, name: str) -> DataFrame:
    """rows with `name`, the sum of size over the rows before it for the same `by`, in the order of (bucket, order)."""
    per = rows.groupBy(*by, "bucket").agg(F.sum(size).alias("_s"))
    w = Window.partitionBy(*by).orderBy("bucket") if by else Window.orderBy("bucket")
    base = per.withColumn("_base", F.sum("_s").over(w) - F.col("_s")).drop("_s")
    inside = Window.partitionBy(*by, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_in", F.sum(size).over(inside) - F.col(size)).join(base, [*by, "bucket"]).withColumn(name, F.col("_base") + F.col("_in")).drop("_base", "_in")


def shard(docs: DataFrame, shards: int = 8, rounds: int = 4) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text, F.lit(3)).alias("grp"), F.xxhash64("doc_id", text).alias("h"))
    rows = materialise(rows, "shard-rows")
    rows = rows.withColumn("bucket", F.pmod(F.shiftright("h", 13), F.lit(BUCKETS)))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    order = ["h", "doc_id", "size"]
    # documents with links: those of groups of two and more
    linked = rows.groupBy("grp").agg(F.count("*").alias("members")).where("members > 1")
    start = running(rows, [], order, "size", "at").withColumn("shard", F.least(F.floor(F.col("at") * shards / max(total, 1)), F.lit(shards - 1)).cast("int"))
    state = start.join(linked, "grp", "left").select("doc_id", "size", "text_crc32", "grp", "h", "bucket", F.col("members").isNotNull().alias("linked"), "shard")
    state = materialise(state, "shard-start")
    free, held = state.where("not linked"), state.where("linked")
    quota = total // shards + 1
    for k in range(rounds):
        # at most `shards` rows; a shard that linked documents fill takes no more and keeps what it has
        loads = {r.shard: r.bytes for r in held.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
        full = [s for s, n in loads.items() if n >= 0.98 * quota] if k else []
        still, open_rows = (held.where(F.col("shard").isin(full)), held.where(~F.col("shard").isin(full))) if full else (None, held)
        counts = open_rows.groupBy("grp", "shard").agg(F.sum("size").alias("bytes"))
        # ties go by a hash of the group, so that groups don't all favour one shard
        want = counts.groupBy("grp").agg(F.max_by("shard", F.struct("bytes", F.pmod(F.xxhash64("grp", "shard"), F.lit(1 << 20)))).alias("want"))
        drawn = open_rows.join(want, "grp").withColumn("moves", (F.col("want") != F.col("shard")).cast("int"))
        # those already there come first, then the arrivals, up to the quota of the shard
        placed = drawn.groupBy("want", "moves").agg(F.sum("size").alias("bytes")).where("moves = 0").select("want", F.col("bytes").alias("there"))
        ranked = running(drawn, ["want", "moves"], order, "size", "at").join(F.broadcast(placed), "want", "left")  # at most `shards` rows
        arrives = (F.col("moves") == 1) & (F.coalesce("there", F.lit(0)) + F.col("at") + F.col("size") <= quota)
        moved = ranked.withColumn("shard", F.when(arrives, F.col("want")).otherwise(F.col("shard"))).select(*state.columns)
        held = materialise(moved if still is None else moved.unionByName(still), f"shard-round{k}")
    # linked documents first, then free ones: what lies beyond a shard's quota goes to shards that are under theirs
    ranked = materialise(running(held.unionByName(free).withColumn("free", (~F.col("linked")).cast("int")), ["shard", "free"], order, "size", "at"), "shard-ranked")
    loads = {(r.shard, r.free): r.bytes for r in ranked.groupBy("shard", "free").agg(F.sum("size").alias("bytes")).collect()}  # at most 2 * shards rows
    own, over, under = [loads.get((s, 0), 0) for s in range(shards)], [], []
    for s in range(shards):
        load = own[s] + loads.get((s, 1), 0)
        if load > quota:
            over.append((s, sum(n for *_, n in over), load - quota))
        elif load < quota:
            under.append((s, sum(n for *_, n in under), quota - load))
    at = F.col("at") + F.when(F.col("free") == 1, F.element_at(F.array(*map(F.lit, own)), F.col("shard") + 1)).otherwise(0) + (F.col("size") / 2).cast("long")
    spot = F.coalesce(*[F.when((F.col("shard") == s) & (at >= quota), at - quota + before) for s, before, _ in over], F.lit(None).cast("long")) if over else F.lit(None).cast("long")
    to = F.coalesce(*[F.when(F.col("spot") < before + n, F.lit(s)) for s, before, n in under], F.col("shard")) if under else F.col("shard")
    placed = ranked.withColumn("spot", spot).withColumn("shard", F.when(F.col("spot").isNotNull(), to).otherwise(F.col("shard")))
    numbered = running(placed.withColumn("one", F.lit(1).cast("long")), ["shard"], order, "one", "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))

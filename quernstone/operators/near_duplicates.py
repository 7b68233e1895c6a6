"""First-wins near-duplicate removal over token sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators.components import components
from quernstone.scratch import materialise


def named(by: str) -> Column:
    """The group of a row, as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("none")).alias(by)


#: Tokens whose frequency is known where prefixes are cut: at most so many, as each makes up more than one part in so many of all.
COMMON = 1 << 20
#: Keys that are broadcast to find their sets; beyond, they are shuffled.
BROADCAST = 200_000
#: Tokens that a worker sorts at once, or those of one set, if more.
AT_ONCE = 1 << 17
#: Tokens that two prefixes must share: prefixes are longer by all but one of them.
SHARED = 3


def token_sets(rows: DataFrame, key: str, text: str, by: str) -> DataFrame:
    """(key, by, h, hs), written: a name of each row's token set, its own for an empty one, and the 64-bit hashes of its tokens in their group."""
    sets = rows.select(key, named(by), T.token_set(F.col(text)).alias("tokens"))
    h = F.when(F.size("tokens") > 0, F.sha2(F.array_join(F.array_sort("tokens"), "\n"), 256)).otherwise(F.concat(F.lit("empty "), F.col(key).cast("string")))
    return materialise(sets.select(key, by, h.alias("h"), F.transform("tokens", lambda t: F.xxhash64(t, F.col(by))).alias("hs")), "token-sets")


def representatives(sets: DataFrame, key: str, by: str) -> DataFrame:
    """(by, h, rep): the first row of each set."""
    return sets.groupBy(by, "h").agg(F.min(key).alias("rep"))


def slices(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose lists in column `name` have at most AT_ONCE elements in all, or of one row."""
    ends = np.cumsum(pc.list_value_length(batch.column(name)).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def cut_sets(batches: Iterator[pa.RecordBatch], key: str, percent: int, tokens: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The prefixes of batches of sets, in memory that follows AT_ONCE and the largest set; tokens, in order, and their frequencies are the common ones."""
    for b in (part for batch in batches for part in slices(batch, "hs")):
        n = pc.list_value_length(b.column("hs")).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = b.column("hs").flatten().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(n)), n)
        df = np.zeros(len(flat), np.int64)
        if len(tokens):
            at = np.minimum(np.searchsorted(tokens, flat), len(tokens) - 1)
            df = np.where(tokens[at] == flat, times[at], 0)
        order = np.lexsort((flat, df, doc))
        i = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        kept = i < (n - (n * percent + 99) // 100 + SHARED)[doc]
        take = pa.array(doc[kept])
        yield pa.RecordBatch.from_arrays([b.column(key).take(take), pa.array(n[doc[kept]].astype(np.int32)), pa.array(flat[order][kept]), pa.array((i[kept] + 1).astype(np.int32))], [key, "n", "t", "i"])


def prefixes(sets: DataFrame, key: str, percent: int) -> DataFrame:
    """(key, n, t, i): of each set of n tokens the first n - ceil(percent * n / 100) + SHARED in the order of frequency, then hash.

    Frequencies count for the tokens that are common enough to matter; all others come first, by their hashes alone.
    """
    spark = sets.sparkSession
    counts = materialise(sets.select(F.explode("hs").alias("t")).groupBy("t").agg(F.count("*").alias("df")).where("df > 1"), "token-counts")
    total = counts.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    # at most COMMON rows, as their frequencies add up to no more than all
    common = counts.where(F.col("df") > max(1, total // COMMON)).orderBy("t").toArrow()
    known = spark.sparkContext.broadcast((common.column("t").to_numpy(), common.column("df").to_numpy()))
    kind = sets.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_sets(batches, key, percent, *known.value)

    return sets.select(key, "hs").mapInArrow(cut, f"`{key}` {kind}, n int, t long, i int")


def enough(a: str, b: str, percent: int) -> Column:
    """Whether c shared prefix tokens are as many as two similar sets of a and b tokens have: fewer for sets of very few tokens."""
    return F.expr(f"least({a}, {b}) * 100 >= greatest({a}, {b}) * {percent} and c >= least({SHARED}, (least({a}, {b}) * {percent} + 99) div 100)")


def verified(met: DataFrame, sets: DataFrame, key: str, by: str, percent: int) -> DataFrame:
    """(by, a, b), written: those of the pairs (a, b) whose sets are similar."""
    met = materialise(met, "token-pairs")
    asked = materialise(met.select(F.col("a").alias(key)).union(met.select("b")).distinct(), "token-asked")
    few = asked.count() <= BROADCAST
    full = sets.select(key, by, "hs").join(F.broadcast(asked) if few else asked, key, "left_semi")
    both = met.join(full.select(F.col(key).alias("a"), by, F.col("hs").alias("ta")), "a").join(full.select(F.col(key).alias("b"), F.col("hs").alias("tb")), "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    return materialise(both.where(shared * 100 >= (F.size("ta") + F.size("tb") - shared) * percent).select(by, "a", "b"), "similar-sets")


def similar_sets(sets: DataFrame, key: str, by: str, percent: int, first_wins: bool = False) -> DataFrame:
    """(by, a, b): pairs of first rows of similar sets.

    With first_wins, only those pairs that decide which rows stay: a row that meets no earlier one in any prefix token
    stays for sure, what is similar to it goes, and what goes is compared with nothing else. So near copies of one
    row make a pair each, and not one with each other.
    """
    reps = representatives(sets, key, by)
    firsts = materialise(prefixes(sets, key, percent).join(reps.select(F.col("rep").alias(key)), key, "left_semi"), "token-prefixes")
    led = None
    if first_wins:
        met = firsts.join(firsts.groupBy("t").agg(F.min(key).alias("_m")), "t")
        sure = met.groupBy(key).agg(F.max(F.col("_m") < F.col(key)).alias("_later"), F.max("n").alias("_nm")).where("not _later").select(F.col(key).alias("_m"), "_nm")
        near = met.where(F.col("_m") < F.col(key)).join(sure, "_m").groupBy("_m", "_nm", key, "n").agg(F.count("*").alias("c"))
        led = verified(near.where(enough("_nm", "n", percent)).select(F.col("_m").alias("a"), F.col(key).alias("b")), sets, key, by, percent)
        firsts = firsts.join(led.select(F.col("b").alias(key)).distinct(), key, "left_anti")
    x, y = (firsts.select("t", F.col(key).alias(s), F.col("n").alias(f"n{s}"), F.col("i").alias(f"i{s}")) for s in "ab")
    room = f"(least(ia, ib) + least(na - ia, nb - ib)) * {100 + percent} >= (na + nb) * {percent}"
    met = x.join(y, "t").where("a < b").where(F.expr(f"least(na, nb) * 100 >= greatest(na, nb) * {percent} and {room}"))
    met = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c")).where(enough("na", "nb", percent)).select("a", "b")
    rest = verified(met, sets, key, by, percent)
    return rest if led is None else rest.unionByName(led)


def similar_pairs(rows: DataFrame, key: str, text: str, by: str, percent: int = 90) -> DataFrame:
    """(a, b) with a < b: rows of one `by` whose token sets have a Jaccard of percent / 100 or more; empty sets have none.

    Similar sets share SHARED tokens among their first n - ceil(percent * n / 100) + SHARED in any one order, rare ones
    first, so only those are compared, and only if the places of these leave room for the overlap that similarity takes.
    Tokens are 64-bit hashes, made where texts are read, and only prefixes are shuffled. Sets that are equal are joined as
    one by their hash, each to the first, beside the pairs of different sets, so that copies need not be paired with each
    other. Rows with equal keys take part as one text each: keys should be unique.
    """
    return similar_sets(token_sets(rows, key, text, by), key, by, percent).select("a", "b")


def members(rows: DataFrame, key: str, text: str, by: str) -> DataFrame:
    """(key, representative): every row whose token set isn't empty, with the first row of its `by` that has the same set.

    similar_pairs() links representatives; two rows are similar if they have one representative or theirs are a pair.
    """
    sets = rows.select(key, by, T.token_set(F.col(text)).alias("tokens")).where(F.size("tokens") > 0)
    sets = sets.select(key, by, F.sha2(F.array_join(F.array_sort("tokens"), "\n"), 256).alias("h"))
    first = sets.groupBy(by, "h").agg(F.min(key).alias("representative"))
    s, f = sets.alias("s"), first.alias("f")
    return s.join(f, F.expr(f"s.h = f.h and s.`{by}` <=> f.`{by}`")).select(F.col(f"s.`{key}`"), "representative")


def in_order(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """Of nodes numbered in order, which stay: those that no earlier one that stays has an edge (a before b) to."""
    stays = np.ones(nodes, bool)
    order = np.lexsort((a, b))
    a, b = a[order], b[order]
    begins = np.searchsorted(b, np.arange(nodes + 1))
    for k in np.unique(b):
        stays[k] = not stays[a[begins[k] : begins[k + 1]]].any()
    return stays


def settled(edges: DataFrame, key: str) -> DataFrame:
    """(rep, keep) for the nodes of edges (key, a, b), one task for the edges of each key, which must fit it."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        a, b = (table.column(c).combine_chunks() for c in "ab")
        names = pc.unique(pa.concat_arrays([a, b]))
        names = names.take(pc.sort_indices(names))
        at = [pc.index_in(x, names).to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b)]
        return pa.table({"rep": names, "keep": pa.array(in_order(*at, len(names)))})

    return edges.select(key, "a", "b").groupBy(key).applyInArrow(run, f"rep {kind}, keep boolean")


def by_rounds(edges: DataFrame) -> DataFrame:
    """(rep, keep) for the nodes of edges (a, b): in each round, who has no undecided earlier neighbour stays or, with a kept one, goes."""
    state = edges.select(F.col("a").alias("rep")).union(edges.select("b")).distinct().withColumn("keep", F.lit(None).cast("boolean"))
    while True:
        earlier = edges.join(state.select(F.col("rep").alias("a"), "keep"), "a").groupBy(F.col("b").alias("rep")).agg(F.coalesce(F.bool_or("keep"), F.lit(False)).alias("hit"), F.bool_or(F.col("keep").isNull()).alias("open"))
        step = state.join(earlier, "rep", "left").select("rep", F.when(F.col("keep").isNotNull(), F.col("keep")).when(F.coalesce("hit", F.lit(False)), False).when(~F.coalesce("open", F.lit(False)), True).alias("keep"))
        # written, so that the plan doesn't grow with the rounds; it has only rows with similar others
        state = materialise(step, "greedy-state")
        if state.where("keep is null").isEmpty():
            return state


def resolved(edges: DataFrame, by: str, bound: int = 2_000_000) -> DataFrame:
    """(rep, keep) for the nodes of edges (by, a, b) with a < b, first wins.

    A group with at most `bound` edges is settled in order by one task, whatever its chains; a larger one falls into its
    connected components, each settled so; a component over the bound, which one task shouldn't hold, goes by rounds,
    each of which settles at least the first open row of every chain.
    """
    sizes = edges.groupBy(by).agg(F.count("*").alias("_n"))
    small, large = (edges.join(sizes.where(f"_n {op} {bound}").select(by), by, "left_semi") for op in ("<=", ">"))
    out = settled(small, by)
    if large.isEmpty():
        return out
    large = materialise(large, "greedy-large")
    labels = components(large.select(F.col("a").alias("u"), F.col("b").alias("v")), "greedy-parts")
    parts = materialise(large.join(labels.select(F.col("node").alias("a"), "component"), "a").select("component", "a", "b"), "greedy-components")
    sizes = parts.groupBy("component").agg(F.count("*").alias("_n"))
    few, many = (parts.join(sizes.where(f"_n {op} {bound}").select("component"), "component", "left_semi") for op in ("<=", ">"))
    out = out.unionByName(settled(few, "component"))
    return out if many.isEmpty() else out.unionByName(by_rounds(materialise(many.select("a", "b"), "greedy-giants")))


def greedy_kept(rows: DataFrame, key: str, text: str, by: str, percent: int = 90) -> DataFrame:
    """(key, dropped): in the order of key, a row goes if a row before it that stays is similar; rows with empty sets stay.

    Copies of a set go at once (the first decides for all); the rest is settled on the edges between sets. Rows without
    `by` are a group of their own.
    """
    sets = token_sets(rows, key, text, by)
    state = resolved(similar_sets(sets, key, by, percent, first_wins=True), by)
    decided = representatives(sets, key, by).join(state, "rep", "left").select(by, "h", "rep", F.coalesce("keep", F.lit(True)).alias("keep"))
    return sets.select(key, by, "h").join(decided, [by, "h"]).select(key, (~F.col("keep") | (F.col(key) != F.col("rep"))).alias("dropped"))

"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two documents link at Jaccard 0.75 or more;
the result names each document's connected component.

Order. Shingles are ordered by how often they were met: a bounded table holds the heaviest shingles (counted in every
slice of every text, summed over the corpus), which go last; all others go by hash. Any order that all documents
share gives whole results; this one keeps licence lines and shared passages out of the prefixes.
Prefix. With n shingles, a partner shares at least o = ceil(0.75 n). The first n - o + k shingles of both then share
k or more. k grows with a document's size and its estimated candidate cost (the occurrences of heavy shingles in its
prefix), and a pair needs min(k, k') shared prefix shingles before it is verified.
Candidates. A node is a set, named by its digest, so copies of one set are one node from the start. Prefix shingles go
to the reducers as packed arrays by hash range; those met in one node only end there, which is nearly all; so do nodes
with too few shared entries for any partner. The lists of the others are worked in a fixed number of rounds: in
`HUB_ROUNDS` rounds nodes meet a few hubs of their lists (other ones in each round) and the next of a list by size; in
`NEAREST_ROUNDS` each node outside its list's largest component meets its nearest, in some lists, which ties large
components together by a few pairs; in the last, all pairs of all lists across components are looked at, in numpy.
After each, pairs are verified and components formed. Pairs inside one component need no look, as the component is the
result, and lists of one component are done with, so a group of near copies costs its size and not its square. In the
nearest and last rounds a node carries `BITS` parities of its shingles: two sets differ in at least as many shingles as
parities, so a pair that differs in too many can't link and goes no further; the others' shared entries are summed over
all ranges, and pairs with min(k, k') of them are verified. No round, size or count drops a link.
Verification. Sets of candidate nodes are built once, joined to the pairs, and intersected exactly.

Cases. Null, empty or blank text: no shingles, linked with nothing. Fewer than five words: the whole sequence is one
shingle. Null id: takes no part, component null. Repeated ids count as one document of all their rows' sets: each row
keeps its n_shingles and they share a component (but a row without words keeps its id). Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.scratch import discard

from .common import bound_batches, doc_chunks, joined, materialise, merged, mix64, partitions, texts_of, word_hashes

WORDS = 5
PERCENT = 75
#: Heavy shingles that the order knows: at most so many, and only those met so often. 1 MB is broadcast.
HEAVY, HEAVY_FROM = 1 << 17, 8
#: Rounds in which nodes meet hubs only, hubs of a list and tries of a node in a round.
HUB_ROUNDS, HUBS = 2, 3
#: Rounds in which nodes meet their nearest, in one of so many lists.
NEAREST_ROUNDS, SOME_LISTS = 2, 8
BITS = 1024


def shingle_sets(texts: list[bytes], words: int = WORDS, together: int = 1 << 20) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; about a megabyte of text is hashed at a time."""
    out, a, size = [], 0, 0
    for b, t in enumerate(texts):
        size += len(t)
        if size >= together or b == len(texts) - 1:
            out += sets_of(texts[a : b + 1], words)
            a, size = b + 1, 0
    return out


def sets_of(texts: list[bytes], words: int) -> list[np.ndarray]:
    data, begins, ends = joined([t.lower() for t in texts])
    starts, _, h = word_hashes(data)
    lo, hi = np.searchsorted(starts, begins), np.searchsorted(starts, ends)
    n = len(h) - words + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(words):
        if n > 0:
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + h[k : k + n]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                one = one * np.uint64(0xD6E8FEB86659FD93) + h[k : k + 1]
            out.append(mix64(one))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: two sums of independent mixes."""
    a = np.add.reduce(mix64(s ^ np.uint64(0xA24BAED4963EE407)), dtype=np.uint64)
    b = np.add.reduce(mix64(s * np.uint64(0x9FB21C651E98DF25) + np.uint64(1)), dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def profile(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows of two kinds: (doc_id, n, d1, d2) of each document, and (null, count, shingle, 0) of shingles met in two or more documents of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text"):
            sets = shingle_sets(texts_of(batch, "text"), words)
            d = np.array([digest(s) for s in sets], np.int64).reshape(-1, 2)
            # copies within a slice count once
            first = {(x, y): s for (x, y), s in zip(d.tolist(), sets, strict=True)}
            every = np.sort(np.concatenate(list(first.values())))
            edge = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1], [True]))) if len(every) else np.zeros(1, np.int64)
            counts = np.diff(edge)
            often = counts > 1
            ids = batch.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sets), np.int8)), ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1])], ["kind", "doc_id", "n", "d1", "d2"])
            m = int(often.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int8)), pa.nulls(m, pa.int64()), pa.array(counts[often]), pa.array(every[edge[:-1][often]].astype(np.int64) if m else np.zeros(0, np.int64)), pa.array(np.zeros(m, np.int64))], ["kind", "doc_id", "n", "d1", "d2"])

    return docs.select("doc_id", "text").mapInArrow(run, "kind byte, doc_id long, n long, d1 long, d2 long")


def ordered(s: np.ndarray, heavy: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set in the shared order, with the cost of each shingle: others by hash, then the heavy ones by weight and hash."""
    if not len(heavy):
        return s, np.zeros(len(s), np.int64)
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
    known = heavy[at] == s
    tail = np.flatnonzero(known)
    weight = cost[at[tail]]
    tail, weight = tail[order := np.argsort(weight, kind="stable")], weight[order]
    return np.concatenate((s[~known], s[tail])), np.concatenate((np.zeros(len(s) - len(tail), np.int64), weight))


def prefix(s: np.ndarray, heavy: np.ndarray, cost: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """(the prefix, k). k is one and one more for every 32 shingles, as each costs one entry and spares pairs, and grows with each tenfold of the
    estimated candidates; but where the prefix has no heavy shingle, it isn't lengthened into them."""
    n = len(s)
    o = -(-percent * n // 100)
    row, price = ordered(s, heavy, cost)
    candidates = int(price[: n - o + 1].sum())
    k = 1 + n // 32 + (candidates >= 100) + (candidates >= 1000) + (candidates >= 10000)
    light = int((price == 0).sum())
    if light > n - o:
        k = min(k, light - (n - o))
    k = min(k, o)
    return row[: n - o + k], k


def postings(docs: DataFrame, heavy: np.ndarray, cost: np.ndarray, parts: int, words: int, percent: int) -> DataFrame:
    """(part, shingles, nodes, sizes): packed prefix entries of a slice, by hash range. The size holds n * 2**20 + k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text"):
            seen, tokens, owners, sizes = set(), [], [], []
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(texts_of(batch, "text"), words), strict=True):
                if doc_id is None or not len(s) or (node := digest(s)[0]) in seen:
                    continue
                seen.add(node)
                p, k = prefix(s, heavy, cost, percent)
                tokens.append(p)
                owners.append(np.full(len(p), node, np.int64))
                sizes.append(np.full(len(p), (len(s) << 20) + k, np.int64))
            if not tokens:
                continue
            t, o, z = np.concatenate(tokens), np.concatenate(owners), np.concatenate(sizes)
            part = (mix64(t ^ np.uint64(77)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            t, o, z = t[order], o[order], z[order]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [(p, t[a:b].tobytes(), o[a:b].tobytes(), z[a:b].tobytes()) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["part", "shingles", "nodes", "sizes"])

    return docs.select("doc_id", "text").mapInArrow(run, "part int, shingles binary, nodes binary, sizes binary")


def shared_lists(entries: DataFrame, percent: int) -> DataFrame:
    """(list, doc, size, least): of each hash range the entries of shingles met in two or more nodes of comparable size; list numbers them, the range above;
    least is the least k among the comparable nodes of the list."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t, o, z = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("shingles", np.uint64), ("nodes", np.int64), ("sizes", np.int64)))
        order = np.lexsort((o, z, t))
        t, o, z = t[order], o[order], z[order]
        # copies of one set in several slices are one entry
        one = np.concatenate(([True], (t[1:] != t[:-1]) | (o[1:] != o[:-1]))) if len(t) else np.zeros(0, bool)
        t, o, z = t[one], o[one], z[one]
        n = z >> 20
        # sorted by size within a list, an entry has a comparable partner if a neighbour is comparable
        near = (t[1:] == t[:-1]) & (100 * n[:-1] >= percent * n[1:])
        keep = np.zeros(len(t), bool)
        keep[1:] |= near
        keep[:-1] |= near
        t, o, z = t[keep], o[keep], z[keep]
        number = np.cumsum(np.concatenate(([0], (t[1:] != t[:-1]).astype(np.int64)))) if len(t) else t.astype(np.int64)
        n, k = z >> 20, z & ((1 << 20) - 1)
        place = number << 32 | n
        lo = np.searchsorted(place, number << 32 | -(-percent * n // 100))
        hi = np.searchsorted(place, number << 32 | 100 * n // percent, "right")
        least = np.minimum.reduceat(np.append(k, 0), np.stack((lo, hi), axis=1).ravel())[::2] if len(k) else k
        return pa.table({"list": pa.array((np.int64(key[0].as_py()) << np.int64(40)) + number), "doc": pa.array(o), "size": pa.array(z), "least": pa.array(least)})

    return entries.groupBy("part").applyInArrow(run, "list long, doc long, size long, least long")


def parities(s: np.ndarray) -> bytes:
    """BITS parities of a set: each shingle turns one over."""
    place = (mix64(s ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(BITS)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=BITS) % 2 == 1, bitorder="little").tobytes()


def fixed_binary(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of a binary column without nulls, end to end, without an object for each value."""
    out = [np.zeros(0, np.uint8)]
    for chunk in column.chunks:
        ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1] if len(chunk) else np.zeros(1, np.int32)
        if ends[-1] > ends[0]:
            out.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0] : ends[-1]])
    return np.concatenate(out)


def bits_apart(bits: np.ndarray, i: np.ndarray, j: np.ndarray, together: int = 1 << 14) -> np.ndarray:
    """How many bits the rows i and j differ in, so many pairs at a time: the rows of a pair take a hundred times what its number does."""
    out = np.zeros(len(i), np.int64)
    for a in range(0, len(i), together):
        k = slice(a, a + together)
        out[k] = np.bitwise_count(bits[i[k]] ^ bits[j[k]]).sum(axis=1, dtype=np.int64)
    return out


def met_in_lists(left: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """(u, v): the pairs of different components in lists (list, doc, size, component, bits) that may link; or the nearest of each node outside its list's largest component."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists, doc, size, group = (table.column(c).to_numpy() for c in ("list", "doc", "size", "component"))
        bits = fixed_binary(table.column("bits")).view(np.uint64).reshape(len(doc), -1)
        order = np.lexsort((group, lists))
        lists, doc, size, group, bits = lists[order], doc[order], size[order], group[order], bits[order]
        n, k = size >> 20, size & ((1 << 20) - 1)
        first = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1])))
        length = np.diff(np.append(first, len(lists)))
        lo, many = np.repeat(first, length), np.repeat(length, length)
        # the largest component of each list
        run_at = np.flatnonzero(np.concatenate(([True], (lists[1:] != lists[:-1]) | (group[1:] != group[:-1]))))
        count = np.diff(np.append(run_at, len(lists)))
        top = np.lexsort((-count, lists[run_at]))
        top = top[np.concatenate(([True], lists[run_at][top][1:] != lists[run_at][top][:-1]))]
        outside = group != np.repeat(group[run_at][top], length)
        rows = np.flatnonzero(outside)
        total = np.concatenate(([0], np.cumsum(many[rows])))
        found, a = [np.zeros((0, 4), np.int64)], 0
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(total, total[a] + (1 << 19), "right")) - 1)
            i = np.repeat(rows[a:b], many[rows[a:b]])
            j = np.arange(len(i)) - np.repeat(total[a:b] - total[a], many[rows[a:b]]) + lo[i]
            some = (group[i] != group[j]) & (~outside[j] | (i > j) | (not all_pairs)) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[some], j[some]
            apart = bits_apart(bits, i, j)
            some = apart * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
            i, j, apart = i[some], j[some], apart[some]
            if not all_pairs:
                share = apart * 1000 // (n[i] + n[j])
                best = np.lexsort((doc[j], share, doc[i]))
                best = best[np.concatenate(([True], doc[i][best][1:] != doc[i][best][:-1]))] if len(best) else best
                i, j = i[best], j[best]
            found.append(np.stack((np.maximum(doc[i], doc[j]), np.minimum(doc[i], doc[j]), np.minimum(k[i], k[j]), np.ones(len(i), np.int64)), axis=1))
            if len(found) > 8:
                found = [counted(np.concatenate(found))]
            a = b
        u, v, need, times = counted(np.concatenate(found)).T
        return pa.table({"u": pa.array(u), "v": pa.array(v), "need": pa.array(need), "n": pa.array(times)})

    found = left.groupBy(F.shiftright("list", 40).alias("part")).applyInArrow(run, "u long, v long, need long, n long")
    return found.groupBy("u", "v").agg(F.sum("n").alias("n"), F.min("need").alias("need")).where("n >= need" if all_pairs else "true").select("u", "v")


def counted(rows: np.ndarray) -> np.ndarray:
    """Rows (u, v, need, n) with equal pairs summed."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1))))
    out = rows[first].copy()
    out[:, 3] = np.add.reduceat(rows[:, 3], first)
    return out


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that link, by the exact intersection of their sets (doc, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    a, b = sets.select(F.col("doc").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("doc").alias("v"), F.col("shingles").alias("b"))
    wide = pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", "a", "b")
    return wide.mapInArrow(run, "u long, v long")


def asked(size: str) -> F.Column:
    """k of a packed size."""
    return F.col(size).bitwiseAND((1 << 20) - 1)


def comparable(x: str, y: str, percent: int) -> F.Column:
    a, b = F.shiftright(F.col(x), 20), F.shiftright(F.col(y), 20)
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    bound_batches(spark)
    seen = materialise(profile(docs, words), "jaccard-profile")
    rows = seen.where("kind = 0")
    # The heaviest shingles: at most HEAVY rows, whatever the corpus.
    top = seen.where("kind = 1").groupBy("d1").agg(F.sum("n").alias("n")).where(F.col("n") >= HEAVY_FROM).orderBy(F.col("n").desc(), "d1").limit(HEAVY).toPandas()
    heavy = top["d1"].to_numpy(np.int64).astype(np.uint64)
    by = np.argsort(heavy)
    heavy, cost = heavy[by], top["n"].to_numpy(np.int64)[by]
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(16, int(total) // 1_500_000)
    lists = materialise(shared_lists(postings(docs, heavy, cost, parts, words, percent), percent), "jaccard-lists")
    # a node needs as many shared entries as the least k that it or a comparable node of its lists asks for; lists are left with those, twice over
    active = lists
    for _ in range(2):
        able = active.groupBy("doc").agg(F.count("*").alias("c"), F.min("least").alias("k")).where("c >= k").select("doc")
        kept = active.join(able, "doc", "left_semi")
        shared = kept.groupBy("list").agg(F.count("*").alias("c")).where("c > 1").select("list")
        before, active = active, materialise(kept.join(shared, "list", "left_semi"), "jaccard-able")
        discard(before)

    # nodes that an id has several of hang together before any pair is made
    named = rows.where("doc_id is not null and n > 0").select("doc_id", F.col("d1").alias("doc"))
    several = named.groupBy("doc_id").agg(F.min("doc").alias("v"), F.max("doc").alias("w")).where("v <> w")
    links = materialise(named.join(several, "doc_id").where("doc <> v").select(F.col("doc").alias("u"), "v").distinct(), "jaccard-links")
    labels = merged(spark.createDataFrame([], "node long, component long"), links, "jaccard-labels")

    # sets of all nodes that can be in a pair, one document each, bucketed by node: verifying moves pairs, not sets
    wanted = active.select("doc").distinct()
    wanted = named.join(wanted, "doc", "left_semi").groupBy("doc").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_chunks(batches, "text", 2 << 20):
            sets = [s for s in shingle_sets(texts_of(batch, "text"), words) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([digest(s)[0] for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([parities(s) for s in sets], pa.binary())], ["doc", "shingles", "bits"])

    table, n = f"jaccard_sets_{uuid.uuid4().hex}", partitions(spark)
    built = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(build, "doc long, shingles binary, bits binary")
    built.repartition(n, "doc").dropDuplicates(["doc"]).write.bucketBy(n, "doc").saveAsTable(table)
    sets = spark.table(table)

    tried = spark.createDataFrame([], "u long, v long")
    for k in range(HUB_ROUNDS + NEAREST_ROUNDS + 1):
        # lists of one component are done with
        marked = materialise(active.select("list", "doc", "size").join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc")), "jaccard-marked")
        mixed = marked.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("list")
        left = materialise(marked.join(mixed, "list"), "jaccard-open")
        discard(marked, active)
        active = left
        if k < HUB_ROUNDS:
            hub = F.row_number().over(Window.partitionBy("list").orderBy(F.xxhash64("doc", F.lit(k)), "doc"))
            hubs = left.withColumn("_n", hub).where(F.col("_n") <= (HUBS if k else 1)).select("list", F.struct("doc", "component", "size").alias("hub"))
            # and the next of their list by size, as near copies are nearly equal in size
            after = F.lead(F.struct("doc", "component", "size")).over(Window.partitionBy("list").orderBy("size", "doc"))
            met = left.join(hubs, "list").select("doc", "size", "component", "hub").unionByName(left.select("doc", "size", "component", after.alias("hub")))
            met = met.where("component <> hub.component").groupBy("doc", "size", F.col("hub.doc").alias("other"), F.col("hub.size").alias("size2")).agg(F.count("*").alias("n"))
            met = met.where(comparable("size", "size2", percent))  # n counts only lists in which the other is a hub, so it ranks and doesn't rule out
            nth = F.row_number().over(Window.partitionBy("doc").orderBy(F.col("n").desc(), "other"))
            new = met.withColumns({"u": F.greatest("doc", "other"), "v": F.least("doc", "other")}).join(tried, ["u", "v"], "left_anti")
            pairs = new.withColumn("_n", nth).where(F.col("_n") <= HUBS).select("u", "v").distinct()
        else:
            last = k == HUB_ROUNDS + NEAREST_ROUNDS
            some = left if last else left.where(F.pmod(F.xxhash64("list"), F.lit(SOME_LISTS)) == k % SOME_LISTS)
            pairs = met_in_lists(some.join(sets.select("doc", "bits"), "doc"), percent, last)
        pairs = materialise(pairs.join(tried, ["u", "v"], "left_anti"), f"jaccard-pairs{k}")
        tried = tried.unionByName(pairs)
        links = materialise(verified(pairs, sets, percent), f"jaccard-links{k}")
        labels = merged(labels, links, f"jaccard-labels{k}")
    discard(active)
    spark.sql(f"drop table {table}")
    # the smallest id of each component
    of = rows.where("doc_id is not null and n > 0").select("doc_id", F.col("d1").alias("node")).join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = of.select("node", "component").distinct().join(least, "component").select(F.col("node").alias("d1"), "component_id")
    # a hot component's name is joined by node, so that its rows aren't gathered
    found = rows.select("doc_id", "n", "d1").join(by_node, "d1", "left")
    alone = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all columns, of the smallest id of each component: one row where an id is repeated. Rows without an id stay."""
    kept = jaccard_components(docs, words, percent).where("doc_id = component_id").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in docs.columns if c != "doc_id"])
    some = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn("__q_nth", F.row_number().over(first)).where("__q_nth = 1").drop("__q_nth")
    return some.select(docs.columns).unionByName(docs.where("doc_id is null"))

"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search on it.

Equal vectors are one node (a list of ids). The graph starts from random-projection buckets of bounded size and is
improved by iterative Spark joins of neighbours of neighbours: each node sends its vector along its links, a node
that gets the vectors of its neighbours scores all against all of them (their number is bounded by a node's degree)
and proposes to each its best few new neighbours, and a node keeps its best `degree`. While the graph is built and walked,
vectors travel as float32 scaled by a power of two of their own, with its exponent; scores are of double range, so one
vector of any finite length takes nothing from the others. Reverse links are kept to `degree` a node by score, so that a hub's list is bounded.

Search is greedy, for all queries at once: a query starts at its own node and at fixed entry nodes; in
each step a join brings the neighbours of its best nodes that have not been opened yet, and the best `beam` stay. The
scores that are returned are inner products in double precision of the original vectors.

Index: fitted on and holding every row. Recall against brute force is measured in tests and in the README.

Cases. Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part.
Null ids take no part. Repeated ids: each row is a candidate, and each is a query with a list of its own. Fewer candidates than k: all found. Ties go to the
smaller vec_id. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, materialise, partitions

DEGREE = 32
#: Of a node's links both ways so many meet in a round, and each of them gets so many proposals.
MEET, PROPOSE = 48, 8
BUCKET = 128
TREES = 8
ROUNDS = 5
#: Candidates that a query keeps, steps of its walk, nodes that it opens in a step, entries besides its own node.
BEAM = 256
STEPS = 9
OPEN = 24
ENTRIES = 16
#: Neighbours of an opened node that go on to the query's candidates.
BEST = 24


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector as array<double>) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select("vec_id", v.alias("v")).where("vec_id is not null and v is not null")
    good = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    most = good.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1)
    return good.join(F.broadcast(most), F.size("v") == F.col("d"), "left_semi")


def packed_rows(v: np.ndarray) -> np.ndarray:
    """Rows as float32 with components up to 1, and in one more column the exponent of two that they were divided by."""
    exponent = np.frexp(np.abs(v).max(axis=1))[1]
    return np.concatenate((np.ldexp(v, -exponent[:, None]), exponent[:, None]), axis=1).astype(np.float32)


def half(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed rows as float32 vectors and the exponents of their scales."""
    x = np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1)
    return x[:, :-1], x[:, -1].astype(np.int64)


def best_of(proposals: DataFrame, degree: int) -> DataFrame:
    """(u, v, s): of proposals the best `degree` different v for each u, ties to the smaller v."""
    w = Window.partitionBy("u").orderBy(F.col("s").desc(), "v")
    return proposals.repartition("u").groupBy("u", "v").agg(F.max("s").alias("s")).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= degree).drop("_n")


def tree_start(nodes: DataFrame, n: int, dim: int, trees: int, bucket: int, degree: int) -> DataFrame:
    """Proposals from `trees` random partitions into ranges of about `bucket` nodes along a random projection of signs."""
    rng = np.random.default_rng(2)
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / bucket))) - 2)
    planes = rng.normal(size=(trees, bits + 1, dim)).astype(np.float32)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, e = half(batch.column("x").to_pylist())
            for t in range(trees):
                p = x @ planes[t].T
                cell = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(cell), pa.array(np.ldexp(p[:, bits].astype(np.float64), e)), batch.column("node"), batch.column("x")], ["tree", "cell", "along", "node", "x"])

    dealt = nodes.mapInArrow(keys, "tree int, cell long, along double, node long, x binary")
    # cells are cut into ranges of at most `bucket` along one more projection: no group grows with the data
    nth = F.row_number().over(Window.partitionBy("tree", "cell").orderBy("along", "node")) - 1
    dealt = dealt.withColumn("piece", (nth / bucket).cast("int"))

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node = np.array(table.column("node").to_pylist())
        return proposed(node, *half(table.column("x").to_pylist()), degree // 2)

    return dealt.groupBy("tree", "cell", "piece").applyInArrow(meet, "u long, v long, s double")


def proposed(node: np.ndarray, x: np.ndarray, e: np.ndarray, best: int) -> pa.Table:
    """For each of a bounded set of nodes its `best` others, as proposals (u, v, s)."""
    n = len(node)
    if n < 2:
        return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
    with np.errstate(over="ignore"):
        s = np.ldexp((x @ x.T).astype(np.float64), e[:, None] + e[None, :])
    np.fill_diagonal(s, -np.inf)
    k = min(best, n - 1)
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return pa.table({"u": pa.array(np.repeat(node, k)), "v": pa.array(node[top].ravel()), "s": pa.array(np.take_along_axis(s, top, 1).ravel())})


def descend(graph: DataFrame, nodes: DataFrame, degree: int) -> DataFrame:
    """One round of NN-descent: proposals among the neighbours (both ways) of each node."""
    back = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "s")
    both = best_of(graph.unionByName(back), max(degree, MEET))
    sent = both.select("u", F.col("v").alias("node")).unionByName(nodes.select(F.col("node").alias("u"), "node")).join(nodes, "node")

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node = np.array(table.column("node").to_pylist())
        return proposed(node, *half(table.column("x").to_pylist()), PROPOSE)

    found = sent.groupBy("u").applyInArrow(meet, "u long, v long, s double")
    return best_of(graph.unionByName(found), degree)


def build(nodes: DataFrame, n: int, dim: int, degree: int = DEGREE, rounds: int = ROUNDS, trees: int = TREES, bucket: int = BUCKET) -> DataFrame:
    """The graph (u, v, s) over nodes (node, x)."""
    graph = materialise(best_of(tree_start(nodes, n, dim, trees, bucket, degree), degree), "nn-start")
    for k in range(rounds):
        graph = materialise(descend(graph, nodes, degree), f"nn-round{k}")
    return graph


def search(vectors: DataFrame, every: int = 20, k: int = 20, degree: int = DEGREE, rounds: int = ROUNDS, beam: int = BEAM, steps: int = STEPS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by `every`, its k nearest other rows."""
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = materialise(usable(vectors).withColumn("name", F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256)).withColumn("row", F.monotonically_increasing_id()), "nn-rows")
    # equal vectors are one node, named by its first row; of its ids the k + 1 smallest can be among k nearest
    named = rows.groupBy("name").agg(F.min("row").alias("node"), F.min_by("v", "row").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.array(batch.column("v").to_pylist(), np.float64).reshape(batch.num_rows, -1)
            if not len(v):
                continue
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([x.tobytes() for x in packed_rows(v)], pa.binary()), pa.array([x.tobytes() for x in v], pa.binary()), batch.column("name")], ["node", "x", "full", "name"])

    n, dim = named.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    nodes = materialise(named.mapInArrow(pack, "node long, x binary, full binary, name string"), "nn-nodes")
    light = nodes.select("node", "x")
    graph = build(light, n, dim, degree, rounds)
    back = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "s")
    links = best_of(graph.unionByName(back), 2 * degree).select("u", F.col("v").alias("node"))
    # each node with its neighbours' vectors, bucketed by node: a step moves only what queries ask
    table = f"nn_blocks_{uuid.uuid4().hex}"
    packed = links.join(light, "node").groupBy("u").agg(F.collect_list(F.struct(F.col("node").alias("v"), "x")).alias("block"))  # at most 2 * degree
    packed.write.bucketBy(partitions(spark), "u").saveAsTable(table)
    blocks = spark.table(table)

    ids = rows.select("vec_id", "name", "row").withColumn("nth", F.row_number().over(Window.partitionBy("name", F.pmod("vec_id", F.lit(64))).orderBy("vec_id", "row"))).where(F.col("nth") <= k + 1)
    ids = ids.withColumn("nth", F.row_number().over(Window.partitionBy("name").orderBy("vec_id", "row"))).where(F.col("nth") <= k + 1).select("vec_id", "name", "row")
    members = ids.join(nodes.select("node", "name"), "name").select("node", "vec_id", "row")
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "name", F.col("row").alias("own")).join(nodes, "name").select("query_id", "own", F.col("node").alias("at"), "x", "full")
    # queries of one vector share a walk
    walks = materialise(asked.select("at", "x", "full").dropDuplicates(["at"]), "nn-walks")
    # the walk starts at its own node and at fixed entries, so that parts of the graph without links to it are met
    entries = nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).select(F.col("node").alias("v"))
    start = walks.select("at", F.col("at").alias("v"), F.lit(float("inf")).alias("score")).unionByName(walks.select("at").crossJoin(F.broadcast(entries)).select("at", "v", F.lit(float("-inf")).alias("score")))  # ENTRIES rows
    pool = start.groupBy("at", "v").agg(F.max("score").alias("score")).withColumn("opened", F.lit(False))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of an opened node's neighbours for the query that opened it."""
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                block = part.column("block")
                lens = np.array(pc.list_value_length(block).to_pylist(), np.int64)
                flat = block.flatten()
                v = flat.field("v").to_numpy(zero_copy_only=False)
                x, e = half(flat.field("x").to_pylist())
                q, qe = half(part.column("q").to_pylist())
                row = np.repeat(np.arange(len(q)), lens)
                with np.errstate(over="ignore"):
                    s = np.ldexp(np.einsum("ij,ij->i", q[row], x).astype(np.float64), e + qe[row])
                order = np.lexsort((v, -s, row))
                nth = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
                take = order[nth < BEST]
                yield pa.RecordBatch.from_arrays([part.column("at").take(pa.array(row[take])), pa.array(v[take]), pa.array(s[take])], ["at", "v", "score"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q, x = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64).reshape(batch.num_rows, -1) for c in ("full_q", "full"))
                yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("v"), pa.array(np.array([float(np.dot(a, b)) for a, b in zip(q, x, strict=True)]))], ["at", "v", "score"])

    top = Window.partitionBy("at").orderBy(F.col("score").desc(), "v")
    waiting = Window.partitionBy("at", "opened").orderBy(F.col("score").desc(), "v")
    for step in range(steps):
        kept = pool.withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= beam).drop("_n")
        marked = materialise(kept.withColumn("opening", ~F.col("opened") & (F.row_number().over(waiting) <= OPEN)), f"nn-pool{step}")
        asks = marked.where("opening").select("at", F.col("v").alias("u")).join(walks.select("at", F.col("x").alias("q")), "at")
        new = blocks.join(asks.hint("shuffle_hash"), "u").select("at", "q", "block").mapInArrow(score, "at long, v long, score double")
        pool = marked.select("at", "v", "score", (F.col("opened") | F.col("opening")).alias("opened")).unionByName(new.withColumn("opened", F.lit(False)))
        pool = pool.groupBy("at", "v").agg(F.max("score").alias("score"), F.max("opened").alias("opened"))
    last = materialise(pool.withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= 2 * k + 8).select("at", "v"), "nn-last")
    wide = last.join(nodes.select(F.col("node").alias("v"), "full"), "v").join(walks.select("at", F.col("full").alias("full_q")), "at")
    spark.sql(f"drop table {table}")
    nearest = materialise(wide.select("at", "v", "full_q", "full").mapInArrow(exact, "at long, v long, score double"), "nn-found")
    each = asked.select("query_id", "own", "at").join(nearest, "at").join(members.withColumnRenamed("node", "v"), "v").where("row <> own")
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.col("score").desc(), "vec_id", "row"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")

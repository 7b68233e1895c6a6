"""What the operators of this subpackage share: scratch tables, word hashes, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.scratch import materialise

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of bytes that are neither a space nor 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bound_batches(spark: SparkSession, size: str = "16m") -> None:
    """Arrow batches end at this many bytes, so that a batch of very long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.large_binary()).to_pylist()]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte array, a line end before, between and after them; where each begins and ends."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    return data, begins, begins + sizes


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def hash_tables(seed: int = 7) -> tuple[np.ndarray, np.uint64, np.uint64]:
    """A random value for each byte, an odd base and its inverse modulo 2**64."""
    rng = np.random.default_rng(seed)
    base = int(rng.integers(0, 2**63, dtype=np.int64)) * 2 + 5
    base %= 1 << 64
    return rng.integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1), np.uint64(base), np.uint64(pow(base, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words in a byte array (polynomial sums, mixed)."""
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    ws = space[data]
    edge = np.diff(np.concatenate(([True], ws, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    table, base, inverse = hash_tables(seed)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(base, len(data)), out=total[1:])
    return starts, ends, mix64((total[ends] - total[starts]) * powers(inverse, len(data) + 1)[starts])


def doc_chunks(batches, text: str, limit: int = 8 << 20):
    """Slices of record batches whose text has about limit bytes, so that memory follows limit and the longest text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = [x or 0 for x in pc.binary_length(batch.column(text).cast(pa.large_binary())).to_pylist()]
        off = np.concatenate(([0], np.cumsum(sizes)))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(off, off[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, component): the smallest node reachable over edges (u, v), for every node of an edge.

    Alternating large-star and small-star joins; each round is written to the shared folder. Star-shaped and
    chain-shaped inputs settle in a number of rounds that follows the logarithm of their diameter.
    """
    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = None
    while True:
        # large star: every larger neighbour of u hangs on the smallest neighbour of u
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(low.select("u", F.col("m").alias("v")).union(small).distinct(), name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())


def merged(labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """labels (node, component) after links (u, v) joined more components. A node without a row is its own component.

    Links are taken to components first, so the rounds of components() see what is new and not what is known.
    """
    a, b = (labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "uv")
    between = links.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    joined = components(between, f"{name}-edges")
    moved = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("_to")), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return materialise(moved.unionByName(joined.join(labels, "node", "left_anti")), name)

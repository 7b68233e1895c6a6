"""Balanced verification trials drawn from all pairs of rows, without making them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators.ranking import positions, running
from quernstone.scratch import materialise

#: Multipliers and addends of the rounds, below 2**31 and odd.
ROUNDS = ((1640531527, 97), (1497234673, 40503), (2053657019, 6089), (1103515245, 12345), (1812433253, 7919), (1664525, 1013904223))
#: Another multiplier, and how many seeds differ; all products stay below 2**63.
MIX, SEEDS = 1431655781, 1 << 24


def half_bits(total: int) -> int:
    """Half the bits of the smallest even power of two that holds `total` numbers."""
    return max(1, -(-max(total - 1, 1).bit_length() // 2))


def shuffled(i: Column, bits: int, seed: int = 0) -> Column:
    """A permutation of the numbers below 4**bits: a Feistel network over their halves."""
    mask = F.lit((1 << bits) - 1)
    rounds = F.array(*[F.struct(F.lit(factor).cast("long").alias("f"), F.lit(addend + (seed % SEEDS) * MIX).cast("long").alias("a")) for factor, addend in ROUNDS])

    def step(acc: Column, c: Column) -> Column:
        # a lambda's variables are read where they are used twice, so the plan doesn't double with each round
        x = acc["r"] * c["f"] + c["a"]
        y = x.bitwiseXOR(F.shiftright(x, 17)).bitwiseAND(F.lit((1 << 31) - 1)) * MIX
        return F.struct(acc["r"].alias("l"), acc["l"].bitwiseXOR(F.shiftright(y.bitwiseXOR(F.shiftright(y, 23)), 11).bitwiseAND(mask)).alias("r"))

    start = F.struct(F.shiftright(i, bits).cast("long").alias("l"), i.bitwiseAND(mask).cast("long").alias("r"))
    return F.aggregate(rounds, start, step, lambda acc: F.shiftleft(acc["l"], bits).bitwiseOR(acc["r"]))


def drawn(spark: SparkSession, total: int, n: int, seed: int = 0) -> DataFrame:
    """(number): n different numbers below `total`, each as likely; all of them if they are n or fewer.

    The permutation of a domain under four times as large is walked until n of its values are below `total`.
    """
    if total <= n:
        return spark.range(total).select(F.col("id").alias("number"))
    bits = half_bits(total)
    domain = 4**bits
    walk = min(domain, 5 * n + 1000)
    while True:
        below = spark.range(walk).select("id", shuffled(F.col("id"), bits, seed).alias("number")).where(F.col("number") < total)
        if walk == domain or below.count() >= n:
            return below.orderBy("id").limit(n).select("number")
        walk = min(domain, 2 * walk)


def balanced_trials(voices: DataFrame, key: str, speaker: str, most: int = 5000, seed: int = 0) -> DataFrame:
    """(a, b, same): `most` pairs of rows of one speaker, and as many of two, none twice; fewer where there are not so many pairs.

    All pairs of either kind are numbered by running sums over the speakers: one of n rows has n (n - 1) / 2 pairs of its
    own, and n times as many with others as rows come before it. Numbers are drawn and taken back to rows by equal joins,
    so no pair is made that isn't drawn, and a speaker with most rows costs no more. Null speakers take no part; rows are
    told apart by their place in the order of key, so repeated keys are rows of their own.
    """
    spark = voices.sparkSession
    known = voices.where(F.col(speaker).isNotNull()).select(F.col(key).alias("_key"), F.col(speaker).alias("_speaker"))
    rows = materialise(positions(known, ["_speaker"], [F.col("_key")], "_i", "_n"), "trial-rows")
    n = F.col("_n")
    groups = rows.where("_i = 0").select("_speaker", "_n")
    groups = running(groups, [], [F.col("_speaker")], {"_before": n, "_same": F.expr("_n * (_n - 1) div 2"), "_same_no": (n > 1).cast("long")})
    groups = materialise(running(groups, [], [F.col("_speaker")], {"_other": n * F.col("_before"), "_other_no": (F.col("_before") > 0).cast("long")}), "trial-groups")
    rows = rows.join(groups.select("_speaker", "_before"), "_speaker").select("_key", "_speaker", "_i", (F.col("_before") + F.col("_i")).alias("_at"))
    # two numbers: how many pairs there are of either kind
    same, other = (x or 0 for x in groups.agg(F.sum(F.expr("_n * (_n - 1) div 2")), F.sum(n * F.col("_before"))).first())

    def met(total: int, start: str, has: Column, wanted: int, salt: int) -> DataFrame:
        """Drawn numbers with their group and their place in it."""
        held = groups.where(has)
        begins = held.select(F.col(start).alias("_number"), F.lit(0).alias("_kind"))
        numbers = drawn(spark, total, wanted, seed + salt).select(F.col("number").alias("_number"), F.lit(1).alias("_kind"))
        # a number belongs to the last group that begins at or before it
        placed = running(begins.unionByName(numbers), [], [F.col("_number"), F.col("_kind")], {f"{start}_no": (1 - F.col("_kind")).cast("long")}).where("_kind = 1")
        return placed.select("_number", (F.col(f"{start}_no") - 1).alias(f"{start}_no")).join(held, f"{start}_no").withColumn("_r", F.col("_number") - F.col(start))

    wanted = min(most, same)
    one = met(same, "_same", F.col("_n") > 1, wanted, 0)
    guess = F.floor((1 + F.sqrt(8 * F.col("_r") + 1)) / 2)
    one = one.withColumn("_j", guess).withColumn("_j", F.when(F.expr("_j * (_j - 1) div 2") > F.col("_r"), F.col("_j") - 1).when(F.expr("_j * (_j + 1) div 2") <= F.col("_r"), F.col("_j") + 1).otherwise(F.col("_j")))
    one = one.select("_speaker", F.col("_j").alias("_i"), (F.col("_r") - F.expr("_j * (_j - 1) div 2")).alias("_k"))
    side = rows.select("_speaker", F.col("_i").alias("_k"), F.col("_key").alias("_b"))
    positive = one.join(rows, ["_speaker", "_i"]).join(side, ["_speaker", "_k"]).select("_key", "_b", F.lit(True).alias("same"))
    two = met(other, "_other", F.col("_before") > 0, min(wanted, other), 1)
    two = two.select("_speaker", F.expr("_r div _before").alias("_i"), F.expr("_r % _before").alias("_at"))
    negative = two.join(rows.drop("_at"), ["_speaker", "_i"]).join(rows.select("_at", F.col("_key").alias("_b")), "_at").select("_key", "_b", F.lit(False).alias("same"))
    return positive.unionByName(negative).select(F.least("_key", "_b").alias("a"), F.greatest("_key", "_b").alias("b"), "same")

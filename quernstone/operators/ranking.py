"""Positions and running sums over a whole order, without a window that holds a group in one task.

Two passes: rows are dealt to ranges of the order and written; the sums of each range, of which there are as many as
partitions (times the groups that meet in one), give every range what lies before it; inside a range a window does the
rest. So the largest task has one range, whatever the size of a group. End the order with a key: rows that tie in all
of it fall into one range and are numbered in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.scratch import materialise


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def running(rows: DataFrame, by: list[str], order: list[Column], sums: dict[str, Column], totals: dict[str, str] | None = None) -> DataFrame:
    """rows with, for each of `sums`, what the rows before this one in the order of its group add up to.

    totals maps names to names of `sums`: columns with the sum over the whole group. Null group keys are a group.
    """
    part, group = fresh(rows, "__part"), [fresh(rows, f"__by{k}") for k in range(len(by))]
    parts = {n: fresh(rows, f"__s{k}") for k, n in enumerate(sums)}
    valued = rows.withColumns({parts[n]: x for n, x in sums.items()})
    dealt = materialise(valued.repartitionByRange(*[F.col(f"`{b}`").asc() for b in by], *order).withColumn(part, F.spark_partition_id()), "ranges")
    per = dealt.groupBy(*[F.col(f"`{b}`").alias(g) for b, g in zip(by, group, strict=True)], F.col(part).alias(f"{part}b")).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(f"{s}b") for s in parts.values()])
    # one row for each range, or for each group in it: never one for each row
    within = Window.partitionBy(*group)
    before = within.orderBy(f"{part}b").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(*group, f"{part}b", *[F.coalesce(F.sum(f"{s}b").over(before), F.lit(0)).alias(f"{s}o") for s in parts.values()], *[F.sum(f"{parts[n]}b").over(within).alias(t) for t, n in (totals or {}).items()])
    met = dealt.join(base, [F.col(part) == F.col(f"{part}b"), *[F.col(f"`{b}`").eqNullSafe(F.col(g)) for b, g in zip(by, group, strict=True)]])
    inside = Window.partitionBy(part, *[f"`{b}`" for b in by]).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumns({n: F.col(f"{s}o") + F.coalesce(F.sum(s).over(inside), F.lit(0)) for n, s in parts.items()})
    return met.select(*[f"`{c}`" for c in rows.columns if c not in sums], *sums, *(totals or {}))


def positions(rows: DataFrame, by: list[str], order: list[Column], name: str = "position", size: str | None = None) -> DataFrame:
    """rows with their place from 0 in the order of their group and, if `size` names a column, the group's rows."""
    return running(rows, by, order, {name: F.lit(1).cast("long")}, {size: name} if size else None)

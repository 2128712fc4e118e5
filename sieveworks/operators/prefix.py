"""Running counts, sums and exclusive-ors along groups of any size (the base of W2, W6 and L1)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runstate import stored

PART = "__part"


def running(rows: DataFrame, by: list[str], order: list[str | Column], *, number: str | None = None, sums: Mapping[str, str | Column] | None = None, xors: Mapping[str, str | Column] | None = None) -> DataFrame:
    """The rows with running values of their group, their own row included: its number from 1, sums and exclusive-ors by new column.

    Rows are ranged by group and order into partitions, so a group of any size
    is spread over as many partitions as it fills.  A running value is that
    within the partition plus what the group has in earlier partitions, which
    only concerns the first and the last group of each partition: two rows a
    partition, which are broadcast.  The ranged rows are stored first, so that
    all reads see the same partitions.  Nulls make a group of their own and add
    nothing; rows that tie in the order follow each other in any order.
    """
    sums, xors = dict(sums or {}), dict(xors or {})
    names = [*([number] if number else []), *sums, *xors]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hidden = {n: f"__{k}" for k, n in enumerate(names)}
    given = {n: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)) for n, c in (sums | xors).items()}
    held = rows.withColumns({hidden[n]: c for n, c in given.items()})
    held = stored(held.repartitionByRange(parts, *by, *order).withColumn(PART, F.spark_partition_id()), "ranged")

    def total(n: str) -> Column:
        return F.count("*") if n == number else F.sum(hidden[n]) if n in sums else F.bit_xor(hidden[n])

    partial = held.groupBy(PART, *by).agg(*(total(n).alias(f"{hidden[n]}p") for n in names))
    if by:
        group = F.struct(*by)
        edges = held.groupBy(PART).agg(F.min(group).alias("__lo"), F.max(group).alias("__hi"))  # a row a partition
        partial = partial.join(F.broadcast(edges), PART).where(group.eqNullSafe(F.col("__lo")) | group.eqNullSafe(F.col("__hi"))).drop("__lo", "__hi")
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = {n: (F.bit_xor if n in xors else F.sum)(f"{hidden[n]}p").over(before) for n in names}
    keys = {c: f"__by{k}" for k, c in enumerate(by)}
    carry = partial.select(F.col(PART).alias("__at"), *(F.col(c).alias(k) for c, k in keys.items()), *(c.alias(f"{hidden[n]}c") for n, c in carried.items()))
    match = F.col(PART) == F.col("__at")
    for c, k in keys.items():
        match &= F.col(c).eqNullSafe(F.col(k))
    within = Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = {n: F.row_number().over(Window.partitionBy(PART, *by).orderBy(*order)).cast("long") if n == number else total(n).over(within) for n in names}
    out = held.withColumns({f"{hidden[n]}w": c for n, c in own.items()}).join(F.broadcast(carry), match, "left")

    def whole(n: str) -> Column:
        mine, earlier = F.col(f"{hidden[n]}w"), F.coalesce(f"{hidden[n]}c", F.lit(0))
        return mine.bitwiseXOR(earlier) if n in xors else mine + earlier

    kept = [c for c in rows.columns if c not in names]
    return out.select(*kept, *(whole(n).alias(n) for n in names))

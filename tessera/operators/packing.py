"""Ordered token packing: documents end to end, cut into blocks of one length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUPS = 1 << 16


def groups(df: DataFrame, order: str, many: int = GROUPS) -> Column:
    """At most `many` groups of rows that follow the order of a number, of like size if it is spread evenly, whether dense
    or hashed: its place between least and most. Rows without the number are a group before all others."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    if low is None or low == high:
        return F.when(F.col(order).isNull(), -1).otherwise(0)
    at = (F.col(order).cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low)) * many
    return F.when(F.col(order).isNull(), -1).otherwise(F.floor(at).cast("int"))


def positions(df: DataFrame, order: str, length: str, by: str | None = None, name: str = "start") -> DataFrame:
    """df with `name`, the sum of the lengths before each row in the order of a unique number: sums of groups of rows first,
    then within each group, so no task sees more than one group. Rows whose `by` is null are taken together."""
    part = (F.col(by).isNotNull(), F.coalesce(F.col(by).cast("string"), F.lit(""))) if by else (F.lit(True), F.lit(""))
    rows = df.withColumn("__q", part[0]).withColumn("__p", part[1]).withColumn("__g", groups(df, order))
    sums = rows.groupBy("__q", "__p", "__g").agg(F.sum(length).alias("__n"))
    before = sums.withColumn("__s", F.coalesce(F.sum("__n").over(Window.partitionBy("__q", "__p").orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    own = F.coalesce(F.sum(length).over(Window.partitionBy("__q", "__p", "__g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(before, ["__q", "__p", "__g"]).withColumn(name, F.col("__s") + own).drop("__q", "__p", "__g", "__s")


def pieces(df: DataFrame, order: str, ids: str, block: int, by: str | None = None) -> DataFrame:
    """(by, block, at, order, ids): the part of each row's ids that lies in each block, and where it begins there."""
    rows = positions(df.withColumn("__len", F.size(ids).cast("long")).where("__len > 0"), order, "__len", by)
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("__len") - 1) / block)
    cut = rows.withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("block") * block - F.col("start"), F.lit(0))
    hi = F.least((F.col("block") + 1) * block - F.col("start"), F.col("__len"))
    keep = ([by] if by else []) + [order]
    return cut.select(*keep, "block", (F.col("start") + lo - F.col("block") * block).cast("int").alias("at"), F.slice(ids, (lo + 1).cast("int"), (hi - lo).cast("int")).alias("ids"))


def packed(df: DataFrame, order: str, ids: str, block: int, pad: int, by: str | None = None, drop_rest: bool = False) -> DataFrame:
    """(by, block, input_ids, attention_mask): blocks in order, the last one padded or dropped. At most block rows meet in
    one block."""
    parts = pieces(df, order, ids, block, by)
    whole = parts.groupBy(*([by] if by else []), "block").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("p"))
    flat = whole.withColumn("i", F.flatten(F.transform("p", lambda x: x["ids"])))
    n = F.size("i")
    full = flat.where(n == block) if drop_rest else flat
    return full.select(*([by] if by else []), "block", F.concat("i", F.array_repeat(F.lit(pad), block - n)).alias("input_ids"), F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), block - n)).alias("attention_mask"))

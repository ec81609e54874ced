"""Sources and how much is drawn from each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.packing import positions

from tessera.functions.text import strip


def extracted(df: DataFrame, text: str = "text", low: int = 10, high: int = 100_000, languages: tuple[str, ...] | None = None, language: str | None = None) -> DataFrame:
    """Stripped texts of a length within bounds; tagged rows must be in the allowed languages, untagged ones stay."""
    out = df.withColumn(text, strip(F.col(text))).where(F.length(text).between(low, high))
    return out.where(F.col(language).isNull() | F.col(language).isin(*languages)) if languages and language else out


def probabilities(catalog: DataFrame, weight: Column, languages: str, language_weights: dict[str, float] | None = None, temperature: float = 1.0) -> DataFrame:
    """The catalog with p, proportional to (weight * first language's weight) ** (1 / T); all alike if all weigh nothing."""
    t = max(temperature, 0.01)
    lw = F.lit(1.0)
    for k, v in (language_weights or {}).items():
        lw = F.when(F.element_at(languages, 1) == k, v).otherwise(lw)
    raw = F.pow(F.coalesce(weight, F.lit(0.1)) * lw, F.lit(1.0 / t))
    every = Window.partitionBy()  # a catalog, not rows
    rows = catalog.withColumn("__r", raw)
    total = F.sum("__r").over(every)
    return rows.withColumn("p", F.when(total > 0, F.col("__r") / total).otherwise(1.0 / F.count("*").over(every))).drop("__r")


def quota(df: DataFrame, shares: DataFrame, source: str, key: str, n: int, seed: int = 7) -> DataFrame:
    """About n rows, of each source its share round(p * n), the first in hash order of the key. The hash bound that holds a
    source's share is found by counting first, so no source is sorted whole."""
    h = F.xxhash64(F.lit(seed), key)
    sizes = df.groupBy(source).agg(F.count("*").alias("__n"))
    want = sizes.join(F.broadcast(shares.select(F.col(source), F.round(F.col("p") * n).cast("long").alias("__q"))), source)
    # hashes are even: three times the share needed and some more surely holds it; what is over is cut by rank
    bound = F.least(F.lit(1.0), (3.0 * F.col("__q") + 300) / F.col("__n"))
    near = df.join(want, source).withColumn("__h", h).where((F.shiftrightunsigned("__h", 1) / F.lit(float(1 << 63))) <= bound)
    return near.withColumn("__r", F.row_number().over(Window.partitionBy(source).orderBy("__h", key))).where("__r <= __q").drop("__n", "__q", "__h", "__r")


def round_robin(df: DataFrame, source: str, order: str) -> DataFrame:
    """df with turn: the row's number within its source; sorted by turn and source it takes the sources in rotation."""
    rows = positions(df.withColumn("__one", F.lit(1)), order, "__one", source, "__before").drop("__one")
    return rows.withColumn("turn", (F.col("__before") + 1).cast("int")).drop("__before")


def acquisition(df: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    n = F.count("*")
    return df.groupBy(*by).agg(n.alias("rows"), F.sum(F.octet_length(text)).alias("bytes"), F.sum(F.length(text)).alias("chars"))

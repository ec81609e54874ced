"""Corpus statistics, all by partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import words
from tessera.operators.packing import positions


def percentiles(df: DataFrame, value: str, shares: tuple[float, ...] = (0.1, 0.5, 0.9, 0.99)) -> DataFrame:
    """One row: the value at place floor(n * p) of the sorted values for each p, and the largest. Counted over distinct
    values, of which there are far fewer than rows."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    run = counts.withColumn("upto", F.sum("n").over(Window.orderBy(value)))
    total = counts.agg(F.sum("n")).first()[0] or 0
    at = [F.min(F.when(F.col("upto") > int(total * p), F.col(value))).alias(f"p{round(p * 100)}") for p in shares]
    return run.agg(*at, F.max(value).alias("max"))


def token_rows(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(words(F.lower(text))).alias("pos", "token"))


def vocabulary_growth(df: DataFrame, text: str, source: str, order: str) -> DataFrame:
    """(source, vocabulary): distinct tokens seen up to the last row of each source, in row order. Tokens are counted at the
    row that has them first; the running sum goes by groups of rows."""
    firsts = token_rows(df, text, [order]).groupBy("token").agg(F.min(order).alias(order)).groupBy(order).agg(F.count("*").alias("__new"))
    rows = df.select(source, order).join(firsts, order, "left").withColumn("__new", F.coalesce("__new", F.lit(0)))
    upto = positions(rows, order, "__new").withColumn("__v", F.col("start") + F.col("__new"))
    return upto.groupBy(source).agg(F.max("__v").alias("vocabulary"))


def top_tokens(df: DataFrame, text: str, order: str, n: int = 1000) -> DataFrame:
    """The n commonest tokens with count and percentage of all; of equals the one seen first."""
    rows = token_rows(df, text, [order])
    counts = rows.groupBy("token").agg(F.count("*").alias("n"), F.min(F.struct(order, "pos")).alias("first"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.orderBy(F.desc("n"), "first").limit(n).select("token", "n", F.round(100.0 * F.col("n") / total, 4).alias("percent"))


def histogram(df: DataFrame, length: Column) -> DataFrame:
    label = F.when(length < 128, "<128").when(length <= 512, "128-512").when(length <= 1024, "513-1024").when(length <= 2048, "1025-2048").otherwise(">2048")
    return df.groupBy(label.alias("bin")).agg(F.count("*").alias("n"))


def balance(df: DataFrame, label: str, known: tuple[str, ...]) -> DataFrame:
    """Count and percentage of each known label, those without rows too; all others as unknown."""
    name = F.when(F.col(label).isin(*known), F.col(label)).otherwise("unknown")
    counts = df.groupBy(name.alias("label")).agg(F.count("*").alias("n"))
    fixed = df.sparkSession.createDataFrame([(k,) for k in (*known, "unknown")], "label string")
    full = fixed.join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))
    return full.withColumn("percent", 100.0 * F.col("n") / F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(1)))

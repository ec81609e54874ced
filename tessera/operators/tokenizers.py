"""What encoded rows tell about a tokenizer. Rows have input_ids, round_trip, w (words), b (bytes), c (characters)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limits of an acceptable tokenizer, and the weights of the choice.
LIMITS = {"fertility": 3.5, "unknown_rate": 0.005, "compression": 3.0, "round_trip": 0.95}
TIERS = ((500 * 1024**2, "v3-final"), (250 * 1024**2, "v2-expanded"), (50 * 1024**2, "v1-pretrain"), (0, "v0-experimental"))
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"  # category Zs


def fitness(rows: DataFrame, by: str, vocabulary: int, unknown: int = 0) -> DataFrame:
    """Per group: fertility, compression, characters a token, unknown rate, round trip, utilisation and entropy."""
    ids = F.col("input_ids")
    sums = rows.groupBy(by).agg(F.sum(F.size(ids)).alias("t"), F.sum("w").alias("w"), F.sum("b").alias("b"), F.sum("c").alias("c"), F.sum(F.size(F.filter(ids, lambda i: i == unknown))).alias("u"), F.avg(F.col("round_trip").cast("int")).alias("round_trip"))
    used = rows.select(by, F.explode(ids).alias("i")).groupBy(by, "i").agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy(by))
    kinds = used.withColumn("p", p).groupBy(by).agg(F.count("*").alias("kinds"), F.sum(-F.col("p") * F.log2("p")).alias("entropy")).withColumnRenamed(by, "__by")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return sums.join(kinds, sums[by].eqNullSafe(kinds["__by"]), "left").select(by, ratio("t", "w").alias("fertility"), ratio("b", "t").alias("compression"), ratio("c", "t").alias("chars_per_token"), ratio("u", "t").alias("unknown_rate"), "round_trip", (F.coalesce("kinds", F.lit(0)) / vocabulary).alias("utilisation"), "entropy")


def complies(limits: dict[str, float] = LIMITS) -> Column:
    return (F.col("fertility") <= limits["fertility"]) & (F.col("unknown_rate") <= limits["unknown_rate"]) & (F.col("compression") >= limits["compression"]) & (F.col("round_trip") >= limits["round_trip"])


def score(name: Column) -> Column:
    """Lower is better; unigram vocabularies have a small bonus."""
    return 0.35 * F.col("fertility") + 25 * F.col("unknown_rate") + 0.25 * (1 - F.col("round_trip")) + 0.15 / F.col("compression") - F.when(F.lower(name).contains("unigram"), 0.01).otherwise(0.0)


def winner(candidates: DataFrame, name: str) -> DataFrame:
    s = candidates.withColumn("score", score(F.col(name)))
    return s.agg(F.min_by(name, F.struct("score", name)).alias(name), F.min("score").alias("score"))


def upgrade(old: dict, new: dict) -> bool:
    """Whether a new tokenizer is worth it: over 5 % more bytes a token at no more unknowns, or a vocabulary far better used."""
    return (new["compression"] > 1.05 * old["compression"] and new["unknown_rate"] - old["unknown_rate"] <= 0.001) or (old["utilisation"] < 0.30 and new["utilisation"] > 0.60)


def unknown_context(rows: DataFrame, order: str, unknown: int, width: int = 3) -> DataFrame:
    """(order, pos, context): the ids around each unknown one."""
    at = rows.select(order, "input_ids", F.posexplode("input_ids").alias("pos", "i")).where(F.col("i") == unknown)
    lo = F.greatest(F.col("pos") - width, F.lit(0))
    return at.select(order, "pos", F.slice("input_ids", lo + 1, F.col("pos") - lo + width + 1).alias("context"))


def tier(size: Column) -> Column:
    out = F.lit(None).cast("string")
    for least, label in reversed(TIERS):
        out = F.when(size >= least, label).otherwise(out)
    return out


def valid_rows(ids: Column, mask: Column, labels: Column, longest: int) -> Column:
    n = F.size(ids)
    return (n > 0) & (n <= longest) & (F.size(mask) == n) & (labels.isNull() | (F.size(labels) == n))


def preservation(unknown_rate: Column) -> Column:
    """How much of the script survives: one less twice the unknown rate, at least none."""
    return F.greatest(1.0 - 2.0 * unknown_rate, F.lit(0.0))


def boundary_quality(tokens: Column, words: Column, indic: Column) -> Column:
    """How well words are cut, by tokens a word; 0.85 for text without Indic letters, 1 for none at all."""
    r = F.try_divide(tokens, words)
    step = F.when(r <= 2.2, 1.0).when(r <= 3.0, 0.9).when(r <= 3.5, 0.8).when(r <= 5.0, 0.6).otherwise(0.35)
    return F.when((F.coalesce(words, F.lit(0)) == 0) | (F.coalesce(tokens, F.lit(0)) == 0), 1.0).when(~indic, 0.85).otherwise(step)


def trainable(df: DataFrame, by: list[str], text: str = "text", rows: int = 100, chars: int = 10_000) -> DataFrame:
    """Per group, whether there is enough text to train on: so many rows that aren't blank, and so many characters.
    Blank is null, or nothing but spaces of any kind (Zs, as SQL's trim has it; line breaks and tabs are none)."""
    full = df.where(F.ltrim(F.col(text), F.lit(SPACES)) != "")
    return full.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(F.length(text)).alias("chars")).withColumn("trainable", (F.col("rows") >= rows) & (F.col("chars") >= chars))

"""Held-out sets, parallel pairs in running text, self-overlap, logs and thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import strip, words

# Fixed values.
DELIMITERS = ("\t", " ||| ", " | ", " => ", " :: ", " - ", "\n")
MARKERS = ("i am not sure", "however, factually")
THRESHOLDS = {"perplexity": ("max", 15.0, 4.0), "bleu": ("min", 20.0, 35.0), "chrf": ("min", 45.0, 65.0), "rouge": ("min", 25.0, 45.0), "accuracy": ("min", 65.0, 85.0), "hallucination_rate": ("max", 10.0, 2.0)}


def hallucinated(pred: Column, ref: Column) -> Column:
    """Marker phrases, or more than four times the reference's length."""
    p = F.lower(F.coalesce(pred, F.lit("")))
    said = p.contains(MARKERS[0]) | p.contains(MARKERS[1])
    return said | (F.length(p) > 4 * F.length(F.coalesce(ref, F.lit(""))))


def self_overlap(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row: the mean over rows with words of the share of a row's words that some other row has. Words are counted by
    row once instead of comparing rows with each other."""
    rows = df.select(key, F.explode(words(F.lower(text))).alias("w")).groupBy(key, "w").agg(F.count("*").alias("n"))
    shared = rows.groupBy("w").agg((F.count("*") > 1).alias("others"))
    each = rows.join(shared, "w").groupBy(key).agg((100.0 * F.sum(F.when(F.col("others"), F.col("n")).otherwise(0)) / F.sum("n")).alias("s"))
    return each.agg(F.avg("s").alias("self_overlap"))


def parallel_pairs(df: DataFrame, text: str, order: str, least: int = 10) -> DataFrame:
    """(english, indic, order): neighbouring parts of a text, one mostly Latin and the next mostly Indic, under the first
    delimiter that yields any; each pair once, the first row's."""
    latin, indic = r"[a-zA-Z]", r"[ঀ-৿ꯀ-꯿]"
    n = lambda c, p: F.regexp_count(c, F.lit(p))
    t = F.col(text)
    some = df.where((n(t, latin) >= 8) & (n(t, indic) >= 8)).select(order, t.alias("t"))

    def found(d: str) -> Column:
        parts = F.filter(F.transform(F.split("t", r"\Q" + d + r"\E"), strip), lambda p: F.length(p) >= least)
        at = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
        pairs = F.transform(at, lambda i: F.struct(F.element_at(parts, i).alias("english"), F.element_at(parts, i + 1).alias("indic")))
        return F.filter(pairs, lambda p: (n(p["english"], latin) > n(p["english"], indic)) & (n(p["indic"], indic) > n(p["indic"], latin)))

    best = F.coalesce(*[F.when(F.size(found(d)) > 0, found(d)) for d in DELIMITERS])
    rows = some.select(order, F.posexplode(best).alias("k", "p")).select(order, "k", "p.*")
    return rows.groupBy("english", "indic").agg(F.min(order).alias(order))


def held_out(df: DataFrame, text: str, order: str, least: int = 30, most: int = 1 << 30, n: int = 1000) -> DataFrame:
    """The first n rows of a length within bounds: a benchmark of stated size."""
    return df.where(F.length(text).between(least, most)).orderBy(order).limit(n)


def noised(text: Column, key: Column, seed: int = 3, share: float = 0.7, least: int = 40) -> Column:
    """A line break with a hyphen at a place told by a hash, in about `share` of the texts above a length."""
    h = F.xxhash64(F.lit(seed), key)
    at = F.pmod(h, F.greatest(F.length(text) - 10, F.lit(1))).cast("int") + 5
    hit = (F.length(text) > least) & (F.pmod(F.shiftright(h, 20), F.lit(1000)) < int(share * 1000))
    return F.when(hit, F.concat(F.substr(text, F.lit(1), at), F.lit(" -\n"), F.substr(text, at + 1, F.length(text)))).otherwise(text)


def log_summary(log: DataFrame) -> DataFrame:
    """One row of a trainer log (step, loss, eval_loss): last and least losses."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("step")))
    return log.agg(F.max("step").alias("steps"), last("loss").alias("last_loss"), F.min("loss").alias("least_loss"), last("eval_loss").alias("last_eval_loss"), F.min("eval_loss").alias("least_eval_loss"))


def checkpoints(log: DataFrame, keep: int) -> DataFrame:
    """A log's evaluated steps with the change from the step before, whether it is the best, and whether it is kept: the
    latest `keep` and the best. A log has few rows."""
    w = Window.orderBy("step")
    best = Window.orderBy(F.col("eval_loss"), "step")
    rows = log.where("eval_loss is not null").withColumn("change", F.col("eval_loss") - F.lag("eval_loss").over(w)).withColumn("best", F.row_number().over(best) == 1)
    return rows.withColumn("kept", (F.row_number().over(Window.orderBy(F.desc("step"))) <= keep) | F.col("best"))


def banded(scores: DataFrame, metric: str, value: str) -> DataFrame:
    """scores with band: ideal, acceptable or failed, by each metric's own limits; null for a metric without."""
    out = F.lit(None).cast("string")
    for name, (side, limit, ideal) in THRESHOLDS.items():
        v = F.col(value)
        good, fine = (v <= ideal, v <= limit) if side == "max" else (v >= ideal, v >= limit)
        out = F.when(F.col(metric) == name, F.when(good, "ideal").when(fine, "acceptable").otherwise("failed")).otherwise(out)
    return scores.withColumn("band", out)

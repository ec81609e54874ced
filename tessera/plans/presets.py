"""Whole pipelines put together from the operators; each stage can be left out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import quality, script, text
from tessera.operators import chunks, dedup
from tessera.plans.shared import shared_dir, spread, written


@dataclass(frozen=True)
class Config:
    min_chars: int = 3
    max_chars: int = 512
    min_quality: float = 0.45
    chunk_words: int = 2048
    overlap: int = 128
    mask: bool = True
    transliterate: str = "preserve"
    length_filter: bool = False
    dedup: bool = True
    minhash: bool = True
    dedup_chunks: bool = True
    min_chunk_quality: float = 0.40


def prepared(df: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Normalised and cleaned text, its reject reason, script, language, quality and blocked term; provenance columns stay."""
    t = F.col("text")
    out = spread(df).withColumn("text", text.clean(text.normalise(t)))
    out = out.withColumn("reason", quality.reject_reason(t)).withColumn("__s", script.dominant(t))
    out = out.withColumn("script", F.col("__s.script")).withColumn("script_confidence", F.col("__s.confidence")).drop("__s")
    out = out.withColumn("quality_score", quality.quality_score(t)).withColumn("blocked", quality.blocked_term(t))
    return out.withColumn("reason", F.coalesce("reason", F.when(F.col("blocked").isNotNull(), "toxic"), F.when(F.col("quality_score") < config.min_quality, "low_quality"), F.when(F.lit(config.length_filter) & ~quality.length_ok(t, config.min_chars, config.max_chars), "length")))


def decided(df: DataFrame, config: Config = Config(), order: str = "doc_id") -> DataFrame:  # noqa: B008
    """prepared() with the reasons of the repeats, found among all valid texts before quality counts: duplicate (exact, folded
    or fuzzy), near_duplicate (MinHash, of the masked texts that are left); texts without a reason are masked."""
    rows = written(prepared(df, config).drop("blocked"), "prepared")

    def marked(rows: DataFrame, gone: DataFrame, reason: str) -> DataFrame:
        return rows.join(gone.select(F.col("id").alias(order), F.lit(reason).alias("__d")), order, "left").withColumn("reason", F.coalesce("__d", "reason")).drop("__d")

    if config.dedup:
        valid = rows.where("reason is null or reason in ('toxic', 'low_quality')")
        rows = marked(rows, dedup.fuzzy_gone(valid, "text", order, shared_dir(df.sparkSession)), "duplicate")
    rows = rows.withColumn("document_hash", F.sha2("text", 256))
    if config.mask:
        rows = rows.withColumn("text", F.when(F.col("reason").isNull(), quality.masked(F.col("text"))["text"]).otherwise(F.col("text")))
    if config.minhash:
        rows = written(rows, "masked")
        sigs = dedup.signatures(spread(rows.where("reason is null").select(order, "text")), "text", order)
        rows = marked(rows, dedup.minhash_gone(sigs, order, shared_dir(df.sparkSession)), "near_duplicate")
    return rows


def corpus(df: DataFrame, config: Config = Config(), order: str = "doc_id") -> DataFrame:  # noqa: B008
    """The rows that pass every row rule, without exact, folded, fuzzy and MinHash repeats, masked, transliterated if asked, in
    chunks with a document hash; of equal chunks the first, if it is good enough by itself."""
    good = decided(df, config, order).where("reason is null").drop("reason")
    good = good.withColumn("text", script.transliterated(F.col("text"), config.transliterate))
    made = chunks.chunked(good, "text", config.chunk_words, config.overlap)
    if config.dedup_chunks:
        made = written(made, "chunks")
        least = made.groupBy(F.sha2(text.strip(F.col("text")), 256).alias("__k")).agg(F.min(F.struct(order, "chunk_id")).alias("__m")).select("__m.*")
        made = made.join(least, [order, "chunk_id"], "left_semi")
    t = F.col("text")
    return made.where(quality.blocked_term(t).isNull() & (quality.quality_score(t) >= config.min_chunk_quality))


def funnel(df: DataFrame, config: Config = Config(), order: str = "doc_id") -> DataFrame:  # noqa: B008
    """(reason, n): how many rows go for which reason; null: kept."""
    return decided(df, config, order).groupBy("reason").agg(F.count("*").alias("n"))

"""Sinks: exports by split, fixed-size shards with checksums, manifests, reports, event logs."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "json", "jsonl", "csv", "arrow")


def export(df: DataFrame, path: str, kind: str = "parquet", split: str | None = None, version: str | None = None) -> str:
    """Write df below path, by split if given; arrow as Parquet, which every Arrow reader opens."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind}; known: {', '.join(FORMATS)}")
    target = f"{path}/{version}" if version else path
    writer = df.write.mode("overwrite").format({"jsonl": "json", "arrow": "parquet"}.get(kind, kind))
    writer = writer.option("header", True) if kind == "csv" else writer
    (writer.partitionBy(split) if split else writer).save(target)
    return target


def shards(df: DataFrame, path: str, shard: str = "shard", split: str | None = None) -> None:
    """One folder per split and shard number, rows kept together by it."""
    keys = ([split] if split else []) + [shard]
    df.repartition(*keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def verify(spark: SparkSession, path: str, required: tuple[str, ...] = ("text", "language", "script", "source")) -> DataFrame:
    """(file, bytes, sha256, ok) of the Parquet files below path; raises if a required column is missing."""
    missing = [c for c in required if c not in spark.read.option("recursiveFileLookup", True).parquet(path).columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), (F.col("length") > 0).alias("ok"))


def manifest(df: DataFrame, path: str, **facts) -> dict:
    """A small JSON of counts by file, for a result of verify."""
    rows = [r.asDict() for r in df.orderBy("file").collect()]  # one row per file
    out = {"files": rows, "created": int(time.time()), **facts}
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, ensure_ascii=False, indent=1)
    return out


def markdown(df: DataFrame, title: str, most: int = 200) -> str:
    """A report table of a small result."""
    rows = df.limit(most).collect()
    head = f"# {title}\n\n| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    return head + "".join(f"| {' | '.join('' if v is None else str(v) for v in r)} |\n" for r in rows)


def log_event(path: str, **event) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps({"t": time.time(), **event}, ensure_ascii=False) + "\n")

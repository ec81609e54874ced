"""Readers: JSON lines, plain and tab-separated lines, Parquet, Arrow files, benchmark and log files, vector files."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import strip

TEXT_COLUMNS = ("meitei_mayek", "text", "Manipuri", "mni", "sentence", "content")
ENGLISH_COLUMNS = ("english", "English", "eng", "en")


def json_lines(spark: SparkSession, path: str, schema: str, min_length: int = 10, text: str = "text") -> DataFrame:
    """Bad and blank lines are skipped; texts are stripped and must have min_length characters."""
    parsed = T._parse_datatype_string(schema)
    full = T.StructType([*parsed.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json*").json(path)
    return rows.where("_corrupt_record is null").drop("_corrupt_record").withColumn(text, strip(F.col(text))).where(F.length(text) >= min_length)


def scan_gates(df: DataFrame, min_confidence: float = 50.0, min_quality: float = 65.0) -> DataFrame:
    """Rows whose scan scores are unknown or high enough; quality_score is quality / 100, 1 where unknown or zero."""
    passes = lambda c, m: F.col(c).isNull() | (F.col(c) >= m)
    q = F.col("quality")
    return df.where(passes("ocr_confidence", min_confidence) & passes("quality", min_quality)).withColumn("quality_score", F.when(q.isNull() | (q == 0), 1.0).otherwise(q / 100))


def with_sidecar(df: DataFrame, sidecar: DataFrame, key: str, columns: list[str], defaults: dict[str, str]) -> DataFrame:
    """Empty or missing values from the record of the same key in the sidecar, then from the defaults. The sidecar has a row
    per file; Spark broadcasts it if its size allows."""
    side = sidecar.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    full = lambda c: F.when(F.col(c) != "", F.col(c))
    out = df.join(side, key, "left")
    for c in columns:
        own = full(c) if c in df.columns else F.lit(None).cast("string")
        out = out.withColumn(c, F.coalesce(own, full(f"__{c}"), F.lit(defaults.get(c))))
    return out.drop(*[f"__{c}" for c in columns])


def lines(spark: SparkSession, path: str, min_length: int = 10, prefix: str = "line_") -> DataFrame:
    """(path, line, id, text): lines of whole files, counted from 1, skipped ones too."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("n", "value"))
    rows = files.select("path", (F.col("n") + 1).alias("line"), strip(F.col("value")).alias("text"))
    return rows.where(F.length("text") >= min_length).withColumn("id", F.concat(F.lit(prefix), F.lpad(F.col("line").cast("string"), 6, "0")))


def parallel_lines(spark: SparkSession, path: str, min_length: int = 10) -> DataFrame:
    rows = lines(spark, path, 1)
    cells = F.split("text", "\t")
    return rows.select("path", "line", "id", strip(cells[0]).alias("text"), F.when(F.size(cells) > 1, strip(cells[1])).alias("english_parallel")).where(F.length("text") >= min_length)


def pick(columns: list[str], names: tuple[str, ...]) -> str | None:
    return next((n for n in names if n in columns), None)


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All Parquet files below a path; only the columns asked for are read; text and english_parallel by known names."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    text, english = pick(rows.columns, TEXT_COLUMNS), pick(rows.columns, ENGLISH_COLUMNS)
    made: list[Column] = [F.col(c) for c in (columns or rows.columns) if c not in (text, english)]
    made += [F.col(text).alias("text")] if text else []
    made += [F.col(english).alias("english_parallel")] if english else []
    return rows.select(*made)


def split_dirs(spark: SparkSession, path: str) -> DataFrame:
    """train, validation and test folders of Parquet as one table with a split column."""
    out = None
    for split in ("train", "validation", "test"):
        if os.path.isdir(f"{path}/{split}"):
            part = spark.read.parquet(f"{path}/{split}").withColumn("split", F.lit(split))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no split folder in {path}")
    return out


def arrow(spark: SparkSession, path: str) -> DataFrame:
    """Arrow IPC files, read by the tasks, one file each."""
    import pyarrow as pa

    files = sorted(glob.glob(f"{path}/**/*.arrow", recursive=True)) if os.path.isdir(path) else [path]

    def opened(f: str):
        try:
            return pa.ipc.open_stream(f)
        except pa.ArrowInvalid:
            return pa.ipc.open_file(f)

    schema = opened(files[0]).schema
    from pyspark.sql.pandas.types import from_arrow_schema

    def run(batches):
        for b in batches:
            for f in b.column(0).to_pylist():
                r = opened(f)
                yield from (r if hasattr(r, "read_next_batch") else (r.get_batch(i) for i in range(r.num_record_batches)))

    names = spark.createDataFrame([(f,) for f in files], "path string").repartition(len(files))
    return names.mapInArrow(run, from_arrow_schema(schema))


def trainer_log(spark: SparkSession, path: str) -> DataFrame:
    """(step, loss, eval_loss, learning_rate, grad_norm) of a log with a log_history array."""
    schema = "log_history array<struct<step: long, loss: double, eval_loss: double, learning_rate: double, grad_norm: double>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("log_history").alias("x")).select("x.*")


def vectors(spark: SparkSession, path: str, most: int = 50_000) -> DataFrame:
    """(line, word, embedding) of a text vector file, its header left out, of the first `most` words."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "value"))
    parts = F.split(F.trim("value"), " ")
    return rows.where(F.size(parts) > 2).orderBy("line").limit(most).select("line", parts[0].alias("word"), F.transform(F.slice(parts, 2, 1 << 20), lambda x: x.cast("float")).alias("embedding"))


FORMATS = {"txt": lines, "tsv": parallel_lines, "parquet": parquet, "arrow": arrow}


def read(spark: SparkSession, path: str, kind: str, **options) -> DataFrame | None:
    """A reader by format; None for one unknown."""
    if kind == "jsonl":
        return json_lines(spark, path, options.pop("schema", "text string"), **options)
    return FORMATS[kind](spark, path, **options) if kind in FORMATS else None


def dict_text(c: Column) -> Column:
    """The text of a map of language to text: mni, bn, en, else the first value."""
    return F.coalesce(c["mni"], c["bn"], c["en"], F.element_at(F.map_values(c), 1))

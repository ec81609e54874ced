"""Staged runs, configuration and its hash."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame


def config_hash(files: list[str], overrides: dict[str, Any] | None = None) -> str:
    """16 hex digits of the files' contents in the order of their names, and the overrides."""
    h = hashlib.sha256()
    for f in sorted(files, key=os.path.basename):
        with open(f, "rb") as x:
            h.update(x.read())
    h.update(json.dumps(overrides or {}, sort_keys=True).encode())
    return h.hexdigest()[:16]


def from_environment(values: dict[str, Any], prefix: str = "TESSERA_") -> dict[str, Any]:
    """values with those overridden that the environment names."""
    return values | {k: type(v)(os.environ[prefix + k.upper()]) if v is not None else os.environ[prefix + k.upper()] for k, v in values.items() if prefix + k.upper() in os.environ}


@dataclass
class Run:
    """Stages by name, each from the table before; a stage's table is written and, when resumed, read instead."""

    folder: str
    stages: dict[str, Callable[[DataFrame], DataFrame]]
    history: list[dict[str, Any]] = field(default_factory=list)

    def __call__(self, df: DataFrame, resume: bool = True, dry: bool = False) -> DataFrame:
        spark = df.sparkSession
        for name, stage in self.stages.items():
            path, began = f"{self.folder}/{name}", time.time()
            done = os.path.exists(f"{path.removeprefix('file://')}/_SUCCESS")
            state = "dry" if dry else "skipped" if resume and done else "ran"
            if state == "ran":
                stage(df).write.mode("overwrite").parquet(path)
            if state != "dry":
                df = spark.read.parquet(path)
            self.history.append({"stage": name, "state": state, "seconds": time.time() - began})
        return df

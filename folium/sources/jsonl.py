"""JSON Lines in and out, and small JSON reports."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORPUS_COLUMNS = (
    "doc_id string, id string, project string, project_version string, source_path string, source_url_hint string, section_path string, heading string, chunk_index int, "
    "n_chunks_in_doc int, char_start int, char_end int, text string, n_tokens int, language string, content_type string, is_low_signal boolean, content_hash_sha256 string, "
    "duplicate_of string, split string"
)


def write_jsonl(df: DataFrame, path: str, order: list[Column | str], single_file: bool = False) -> None:
    """One object per line in the given order, nulls kept; one file only where a single task can hold it."""
    out = df.orderBy(*order)
    (out.coalesce(1) if single_file else out).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Rows with exactly these columns; blank lines are skipped, other or missing keys are an error."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    wanted = sorted(c.split()[0] for c in columns.split(", "))
    keys = F.array_sort(F.json_object_keys("value"))
    ok = F.coalesce(keys == F.array(*[F.lit(c) for c in wanted]), F.lit(False))
    checked = lines.select(F.when(ok, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("unexpected keys: "), "value"))).alias("value"))
    parsed = checked.select(F.from_json("value", columns, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")


def write_report(data: dict[str, Any], path: str | Path) -> None:
    """A small report as indented JSON."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(data, indent=2, ensure_ascii=False, default=str), encoding="utf-8")

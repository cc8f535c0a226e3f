"""Checks of question/answer candidates and the fair cap per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.functions.text import contains_evidence, length_ok, normal_question
from folium.operators.duplicates import first_seen
from folium.runtime import Stage

# How answer types are preferred inside a chunk; other types come last.
TYPE_PRIORITY = {"enum": 0, "numeric": 1, "boolean": 1, "extractive": 2, "generative": 3}


def type_priority(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = F.lit(4)
    for name, rank in TYPE_PRIORITY.items():
        out = F.when(col == name, rank).otherwise(out)
    return out


def quality_checks(candidates: DataFrame, order: list[str | Column], stage: Stage | None = None) -> DataFrame:
    """Candidates with ``evidence_verified, length_ok, not_near_duplicate_question, qc_passed``.

    Needs ``project, question, answer, evidence_span, chunk_text`` and, if there, ``llm_judge_grounded``.
    A question is judged against all earlier candidates of its project, also those that fail other checks.
    With a ``stage`` the rows are written before they meet their first ones, so that texts are read once;
    the text of the chunk is dropped then.
    """
    checked = candidates.withColumn("evidence_verified", contains_evidence("chunk_text", "evidence_span"))
    checked = checked.withColumn("length_ok", length_ok("question", "answer")).withColumn("_norm", normal_question("question"))
    if stage is not None:
        checked = stage.put(checked.drop("chunk_text"))
    checked = first_seen(checked, ["project", "_norm"], order, "not_near_duplicate_question").drop("_norm")
    judge = F.coalesce(F.col("llm_judge_grounded"), F.lit(True)) if "llm_judge_grounded" in candidates.columns else F.lit(True)
    passed = F.col("evidence_verified") & F.col("length_ok") & F.col("not_near_duplicate_question") & judge
    return checked.withColumn("qc_passed", passed)


def round_robin_cap(rows: DataFrame, doc: str, chunk: str, rank: list[Column | str], cap: int) -> DataFrame:
    """At most ``cap`` rows per document, taken from its chunks in turn, best first.

    Adds ``r`` (place within the chunk) and ``pick`` (place within the document), both from 1.
    """
    inside = rows.withColumn("r", F.row_number().over(Window.partitionBy(doc, chunk).orderBy(*rank)))
    inside = inside.where(F.col("r") <= cap)  # later ones cannot be picked: an early cut of the second sort
    return inside.withColumn("pick", F.row_number().over(Window.partitionBy(doc).orderBy("r", chunk))).where(F.col("pick") <= cap)

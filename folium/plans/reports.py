"""Reports over a corpus and over question/answer candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EXAMPLES = 20


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def corpus_counts(df: DataFrame) -> DataFrame:
    """One row: rows, low-signal rows, marked rows, clusters, mean and largest size."""
    return df.agg(
        F.count("*").alias("total_chunks"), F.count_if(F.col("is_low_signal")).alias("low_signal"), F.count("duplicate_of").alias("marked_duplicates"),
        F.count_distinct("duplicate_of").alias("clusters"), F.max("n_tokens").alias("max_tokens"), F.round(F.avg("n_tokens"), 6).alias("avg_tokens"),
    )


def split_shares(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows of each split and their share of all."""
    per = df.groupBy(split).agg(F.count("*").alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 9))


def split_report(docs: DataFrame) -> DataFrame:
    """Per project: documents, components, components and chunks per split, and warnings.

    ``docs`` has ``project, doc_id, component, split, n_chunks``.
    """
    out = docs.groupBy("project").agg(
        F.count_distinct("component").alias("n_components"), F.count_distinct("doc_id").alias("n_docs"),
        *[F.count_distinct(F.when(F.col("split") == s, F.col("component"))).alias(f"components_{s}") for s in ("train", "val", "test")],
        *[F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n_chunks"))), F.lit(0)).alias(f"chunks_{s}") for s in ("train", "val", "test")],
    )
    warn = F.array_compact(F.array(
        F.when(F.col("n_components") == 1, "single component"), F.when(F.col("components_val") == 0, "nothing in val"), F.when(F.col("components_test") == 0, "nothing in test"),
    ))
    return out.withColumn("warnings", F.array_join(warn, "; "))


def leaks(df: DataFrame, unit: str, split: str = "split") -> DataFrame:
    """Units (documents, fingerprints) that occur in more than one split."""
    return df.where(F.col(unit).isNotNull()).groupBy(unit).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")


def near_report(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (``id_a, id_b``, and if there ``cosine``) as ``a, b``, both source paths and ``similarity``."""
    known = {"id_a": "a", "id_b": "b", "cosine": "similarity"}
    named = pairs.select(*[F.col(c).alias(known.get(c, c)) for c in pairs.columns])
    a = rows.select(F.col("id").alias("a"), F.col("source_path").alias("source_path_a"))
    b = rows.select(F.col("id").alias("b"), F.col("source_path").alias("source_path_b"))
    return named.join(a, "a").join(b, "b")


def qc_counts(checked: DataFrame, final: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Counters of the question/answer stage as ``counter, value, n``; ``failed`` are chunks whose LLM call failed, by ``error``."""
    parts = [
        checked.groupBy("generation_method").agg(F.count("*").alias("n")).select(F.lit("candidates").alias("counter"), F.col("generation_method").alias("value"), "n"),
        checked.where("qc_passed").agg(F.count("*").alias("n")).select(F.lit("passed").alias("counter"), F.lit("all").alias("value"), "n"),
        final.groupBy("generation_method").agg(F.count("*").alias("n")).select(F.lit("final").alias("counter"), F.col("generation_method").alias("value"), "n"),
        final.groupBy("split").agg(F.count("*").alias("n")).select(F.lit("final_split").alias("counter"), F.col("split").alias("value"), "n"),
    ]
    if failed is not None:
        parts.append(failed.groupBy("error").agg(F.count("*").alias("n")).select(F.lit("llm_errors").alias("counter"), F.col("error").alias("value"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

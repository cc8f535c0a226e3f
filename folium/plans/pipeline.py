"""The two stages: folders to corpus, corpus to questions and answers."""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folium.functions.text import fingerprint, language_vote, path_text
from folium.operators import balance, components, duplicates, embeddings, markdown, openapi, packing, quality, questions
from folium.runtime import Stage
from folium.sources import files as files_source
from folium.sources.jsonl import CORPUS_COLUMNS
from folium.sources.settings import PipelineConfig, ProjectSource

QA_ORDER = ["order_path", "chunk_index", "ordinal"]
#: Chunks of one kind up to which near duplicates are compared exactly; beyond it candidates are hashed.
EXACT_VECTORS = 50_000

log = logging.getLogger("folium")


def watched(stage: Stage, df: DataFrame, what: str, **metrics: Column) -> DataFrame:
    """``df`` written, with its rows and ``metrics`` observed on the way and logged."""
    seen = Observation(what)
    out = stage.put(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]))
    log.info("%s: %s", what, ", ".join(f"{k} {v}" for k, v in seen.get.items()))
    return out


def read_blocks(texts: DataFrame) -> DataFrame:
    """Blocks of discovered files (``doc_id, file_kind, text``), each kind by its parser."""
    md = markdown.markdown_blocks(texts.where("file_kind = 'markdown'"))
    api = openapi.openapi_blocks(texts.where("file_kind = 'openapi_spec'"))
    return md.unionByName(api)


def flag_repeated(blocks: DataFrame, count: Callable[[str], Column] = packing.piece_count) -> DataFrame:
    """Blocks with their size by ``count`` and whether their fingerprint occurs more than once anywhere."""
    hashed = blocks.withColumn("n_tokens", count("text")).withColumn("_h", fingerprint("text"))
    many = hashed.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h", F.lit(True).alias("repeated"))
    return hashed.join(many, "_h", "left").withColumn("repeated", F.coalesce("repeated", F.lit(False))).drop("_h")


def build_corpus(
    spark: SparkSession, sources: dict[str, ProjectSource], root: str, config: PipelineConfig, encode: Callable | None = None, parity: bool = False,
    count: Callable[[str], Column] = packing.piece_count,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(corpus, documents with their component and split, near-duplicate pairs)``.

    ``encode`` and ``count`` take the place of the built-in vectors and sizes; with ``parity`` components of one weight are ordered by
    a seeded shuffle of their list, as a plain run would, which is for small runs.
    """
    stage = Stage(spark, "corpus")
    listed = files_source.read_folders(spark, files_source.canonical_folders(sources), root)
    found = files_source.with_hints(files_source.discover(listed), files_source.url_hints(listed))
    docs = watched(stage, files_source.texts(found), "files", projects=F.approx_count_distinct("project"))
    blocks = watched(stage, flag_repeated(read_blocks(docs), count), "blocks", repeated=F.count_if("repeated"), tokens=F.sum("n_tokens"))
    packed = packing.chunks(blocks, config.chunking)
    paths = blocks.select("doc_id", "section_idx", "section_path").distinct()
    meta = docs.select("doc_id", "project", "project_version", "source_url_hint")
    rows = packed.join(paths, ["doc_id", "section_idx"]).join(meta, "doc_id").withColumn("id", F.concat_ws("#", "doc_id", "chunk_index"))
    rows = duplicates.mark_duplicates(rows, "id", "text", duplicates.order_key("doc_id", "chunk_index"))
    rows = rows.withColumn("heading", F.element_at("section_path", -1)).withColumn("section_path", path_text("section_path")).withColumn("language", language_vote("text"))
    rows = watched(stage, rows, "chunks", low_signal=F.count_if("is_low_signal"), duplicates=F.count("duplicate_of"))

    pairs = spark.createDataFrame([], "id_a string, id_b string, cosine double")
    if config.dedup.near_duplicate_check:
        prose = rows.where("content_type <> 'api_spec'").select("id", "text", "content_type", "content_hash")
        vectors = embeddings.with_vectors(prose, "id", "text", encode or embeddings.hashed_ngrams)
        joined = prose.drop("text").join(vectors.withColumnRenamed("key", "id"), "id")
        joined = stage.put(joined)
        largest = joined.groupBy("content_type").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        threshold = config.dedup.near_duplicate_threshold
        if largest <= EXACT_VECTORS:
            near = duplicates.vector_pairs(joined, "id", "vector", "content_type", threshold, "content_hash")
        else:
            dims = joined.select(F.size("vector")).first()[0]
            near = duplicates.hashed_vector_pairs(joined, "id", "vector", "content_type", threshold, dims, digest="content_hash")
        pairs = watched(stage, near, "near-duplicate pairs")
    near = pairs.select(F.col("id_a").alias("u"), F.col("id_b").alias("v"))
    doc_of = rows.select("id", "doc_id")
    near_docs = near.join(doc_of.withColumnRenamed("id", "u").withColumnRenamed("doc_id", "du"), "u").join(doc_of.withColumnRenamed("id", "v").withColumnRenamed("doc_id", "dv"), "v")
    edges = components.content_edges(rows, "doc_id", "content_hash").unionByName(near_docs.select(F.col("du").alias("u"), F.col("dv").alias("v")))
    per_doc = rows.groupBy("doc_id", "project").agg(F.count("*").alias("n_chunks"))
    grouped = components.components(rows.select(F.col("doc_id").alias("node")), edges).withColumnRenamed("node", "doc_id")
    docs_by = stage.put(per_doc.join(grouped, "doc_id"))
    weights = docs_by.groupBy("component").agg(F.sum("n_chunks").alias("weight"))
    if parity:
        weights, tie = stage.put(balance.shuffled_ties(weights, config.split.seed)), F.col("tie")
    else:
        tie = balance.seeded_tie(F.col("component"), config.split.seed)
    split = balance.assign_by_weight(weights, tie, config.split.test_fraction, config.split.val_fraction)
    documents = stage.put(docs_by.join(split.select("component", "split"), "component"))
    wanted = [c.split()[0] for c in CORPUS_COLUMNS.split(", ")]
    full = rows.withColumnRenamed("content_hash", "content_hash_sha256").withColumn("source_path", F.col("doc_id")).join(documents.select("doc_id", "split"), "doc_id")
    kinds = dict(c.split() for c in CORPUS_COLUMNS.split(", "))
    return full.select(*[F.col(c).cast(kinds[c]).alias(c) for c in wanted]), documents, pairs


def build_qa(
    corpus: DataFrame, cap: int, client_factory: Callable[[], Any] | None = None, model: str = "", max_pairs: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(all checked candidates, final rows, chunks whose LLM call failed)``; without a client factory only templates are asked."""
    spark = corpus.sparkSession
    stage = Stage(spark, "qa")
    asked = questions.route(corpus)
    made = questions.with_template_pairs(asked.where("method = 'template'")).withColumn("generation_method", F.lit("template")).withColumn("error", F.lit(None).cast("string"))
    failed = spark.createDataFrame([], "id string, error string")
    if client_factory is not None:
        llm = watched(stage, questions.with_llm_pairs(asked.where("method = 'llm'"), client_factory, model, max_pairs or cap), "LLM pairs", failed_chunks=F.count("error"))
        made = made.unionByName(llm.withColumn("generation_method", F.lit("llm")))
        failed = llm.where("error is not null").select("id", "error")
    context = corpus.select("id", "doc_id", "project", "project_version", "source_path", "section_path", "chunk_index", F.col("text").alias("chunk_text"), "split")
    candidates = made.where("question is not null").join(context, "id").withColumn("order_path", F.split("doc_id", "/"))
    checked = stage.put(quality.quality_checks(candidates, QA_ORDER, stage))
    rank = [quality.type_priority("answer_type"), *QA_ORDER]
    final = quality.round_robin_cap(checked.where("qc_passed"), "doc_id", "chunk_index", rank, cap)
    final = final.withColumn("qa_id", F.concat(F.col("id"), F.lit("::qa"), (F.col("r") - 1).cast("string")))
    return checked, final, failed

"""Documentation folders as tables: discovery, contents, URL hints, and comparison of versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.sources.settings import ProjectSource

# Files that are navigation or metadata, not documentation.
NAVIGATION = ["_sidebar.md", "_coverpage.md", "_navbar.md", "coverpage.md"]
HINTS_FILE = "documentationTypes.json"


def _plain_path(path: Column) -> Column:
    return F.url_decode(F.replace(F.regexp_replace(path, r"^file:/*", "/"), F.lit("+"), F.lit("%2B")))


def read_folders(spark: SparkSession, folders: dict[tuple[str, str], str], root: str) -> DataFrame:
    """All files below the version folders, given as (project, version) -> path.

    Columns ``relative_path, project, project_version, name, size_bytes, content``; only these folders
    are listed, and ``content`` is read only where it is asked for.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(folders.values()))
    base = root.rstrip("/").rsplit("/", 1)[0] + "/"
    rel = F.substr(_plain_path(F.col("path")), F.lit(len(base) + 1))
    parts = F.split(rel, "/")
    return raw.select(
        rel.alias("relative_path"), parts[1].alias("project"), parts[2].alias("project_version"), F.element_at(parts, -1).alias("name"),
        F.col("length").alias("size_bytes"), "content",
    )


def discover(files: DataFrame) -> DataFrame:
    """Documentation files with their ``file_kind``, in no particular order; names are compared as they are."""
    kind = F.when(F.col("name").endswith(".md"), "markdown").when(F.col("name").endswith(".yaml") | F.col("name").endswith(".yml"), "openapi_spec")
    wanted = files.where(~F.col("name").isin(*NAVIGATION, HINTS_FILE))
    return wanted.withColumn("file_kind", kind).where("file_kind is not null")


def url_hints(files: DataFrame) -> DataFrame:
    """``project, project_version, guide, specifications``; none where the file is missing or malformed."""
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    parsed = F.from_json(text, "guide string, specifications string")
    rows = files.where(F.col("name") == HINTS_FILE).select("project", "project_version", parsed.alias("h"))
    return rows.groupBy("project", "project_version").agg(F.first("h.guide", True).alias("guide"), F.first("h.specifications", True).alias("specifications"))


def with_hints(found: DataFrame, hints: DataFrame) -> DataFrame:
    """Files with ``source_url_hint``: the guide's for Markdown, the specification's for OpenAPI."""
    out = found.join(hints, ["project", "project_version"], "left")
    hint = F.when(F.col("file_kind") == "markdown", F.col("guide")).otherwise(F.col("specifications"))
    return out.withColumn("source_url_hint", hint).drop("guide", "specifications")


def texts(found: DataFrame) -> DataFrame:
    """``doc_id, text`` and the file's columns; content that is not UTF-8 is an error."""
    return found.withColumn("text", F.regexp_replace(F.decode("content", "UTF-8"), r"\r\n?", "\n")).withColumnRenamed("relative_path", "doc_id").drop("content")


def with_digest(files: DataFrame) -> DataFrame:
    return files.withColumn("sha256", F.sha2("content", 256))


def inner_path(path: str | Column) -> Column:
    """What follows ``root/project/version/`` in a path."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(0))), "/")


def compare(left: DataFrame, right: DataFrame, path: str, digest: str) -> DataFrame:
    """``path, status`` over both sides: same, different, only_left or only_right."""
    a = left.select(F.col(path).alias("path"), F.col(digest).alias("da"), F.lit(1).alias("a"))
    b = right.select(F.col(path).alias("path"), F.col(digest).alias("db"), F.lit(1).alias("b"))
    status = F.when(F.col("b").isNull(), "only_left").when(F.col("a").isNull(), "only_right").when(F.col("da").eqNullSafe(F.col("db")), "same").otherwise("different")
    return a.join(b, "path", "full_outer").select("path", status.alias("status"))


def canonical_folders(sources: dict[str, ProjectSource]) -> dict[tuple[str, str], str]:
    return {(s.project, s.canonical_version): str(s.path) for s in sources.values()}

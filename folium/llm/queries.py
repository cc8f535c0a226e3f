"""Queries of this subpackage and their SQL; keys are pN_ and the problem's number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions.tokens import token_count
from folium.llm import binpack, entity_splits, linkgroups, lookalike, markup, mixing, neardup, qa_defects, split_items, standins
from folium.runtime import Stage, join_bounded, join_unique, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The token rule for DuckDB.
T_SQL = r"len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}} \t\r\n]'))"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


# ---- 2: groups of links


_P2_SQL = """
    WITH RECURSIVE pairs_ AS (
      SELECT source_path_a AS u, source_path_b AS v FROM near_dedup_report
      WHERE source_path_a IS NOT NULL AND source_path_b IS NOT NULL AND source_path_a <> '' AND source_path_b <> ''),
    both_ AS (SELECT u, v FROM pairs_ UNION SELECT v, u FROM pairs_),
    reach_ AS (SELECT u AS node, u AS label FROM both_ UNION SELECT b.v, r.label FROM reach_ r JOIN both_ b ON b.u = r.node WHERE r.label < b.v),
    group_ AS (SELECT node AS source_path, min(label) AS group_path FROM reach_ GROUP BY node)"""


@query("p2_found", f"{_P2_SQL} SELECT group_path, source_path FROM group_ WHERE group_path <> source_path")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    groups = linkgroups.link_groups(table(spark, d, "near_dedup_report"), "source_path_a", "source_path_b")
    return groups.where("node <> group").select(F.col("group").alias("group_path"), F.col("node").alias("source_path"))


@query("p2_groups", f"{_P2_SQL} SELECT source_path, group_path FROM group_")
def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every linked path with its group."""
    groups = linkgroups.link_groups(table(spark, d, "near_dedup_report"), "source_path_a", "source_path_b")
    return groups.select(F.col("node").alias("source_path"), F.col("group").alias("group_path"))


# ---- 3: oversized chunks


@query("p3_found", f"SELECT DISTINCT id FROM corpus_row WHERE {T_SQL.format('text')} > 512")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    cut = split_items.split_items(table(spark, d, "corpus_row").where("id is not null"), "id", "text", with_text=False)
    return cut.where("n_pieces > 1 and piece = 0").select("id").distinct()


@query("p3_pieces")
def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All chunks as pieces of at most 512 tokens, consecutive ones sharing 60."""
    return split_items.split_items(table(spark, d, "corpus_row"), "id", "text", carry=("section_path",))


@query("p3_roundtrip", f"SELECT id, md5(text) AS digest, {T_SQL.format('text')} AS n_tokens, {T_SQL.format('text')} > 512 AS cut FROM (SELECT DISTINCT id, text FROM corpus_row WHERE text IS NOT NULL)")
def p3_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The pieces put together again: the text of their cores, their tokens without overlaps, and whether there are several.

    A piece above the limit, or an overlap of another size, would show as a null.
    """
    rows = table(spark, d, "corpus_row").select("id", "text").distinct()
    cut = split_items.split_items(rows, "id", "text")
    core = F.substr("text", F.col("core_start") - F.col("char_start") + 1)
    fair = (F.col("n_tokens") <= 512) & (F.col("overlap_tokens") == F.when(F.col("piece") > 0, 60).otherwise(0))
    per = cut.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("piece", core.alias("core")))).alias("cores"), F.sum(F.col("n_tokens") - F.col("overlap_tokens")).alias("n"), F.bool_and(fair).alias("fair"), F.count("*").alias("pieces")
    )
    return per.select("id", F.md5(F.array_join("cores.core", "")).alias("digest"), F.when(F.col("fair"), F.col("n")).alias("n_tokens"), (F.col("pieces") > 1).alias("cut"))


# ---- 4: splits by page

SHARES = {"train": 0.6, "val": 0.2, "test": 0.2}


def _page_components(rows: DataFrame) -> DataFrame:
    entities = {"doc": F.col("doc_id"), "page": entity_splits.page_entity(F.col("doc_id"))}
    return entity_splits.entity_components(rows, "id", entities)


@query(
    "p4_found",
    r"""
    WITH r AS (
      SELECT split_part(doc_id, '/', 2) AS project, array_to_string(string_split(doc_id, '/')[4:], '/') AS page_path,
             CASE lower(regexp_replace(split, '[\s\p{Z}]+', '', 'g'))
               WHEN 'train' THEN 'train' WHEN 'training' THEN 'train'
               WHEN 'val' THEN 'val' WHEN 'valid' THEN 'val' WHEN 'validation' THEN 'val' WHEN 'dev' THEN 'val'
               WHEN 'test' THEN 'test' WHEN 'testing' THEN 'test' END AS s
      FROM corpus_row WHERE doc_id IS NOT NULL AND len(string_split(doc_id, '/')) >= 4)
    SELECT project, page_path FROM r GROUP BY ALL HAVING count(DISTINCT s) > 1""",
)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_row").select("id", "doc_id", entity_splits.split_name(F.col("split")).alias("s"))
    stage = Stage(spark, "p4")
    # a page's records are reduced to its distinct (document, split) rows, which stand for them
    slim = stage.put(rows.where("doc_id is not null").groupBy("doc_id", "s").agg(F.min("id").alias("id")))
    keyed = slim.withColumn("id", F.coalesce("id", "doc_id"))
    parts = F.split("doc_id", "/")
    named = stage.put(keyed.join(_page_components(keyed), F.col("id") == F.col("record")).select("doc_id", "s", "component"))
    leaking = named.groupBy("component").agg(F.count_distinct("s").alias("n")).where("n > 1").select("component")
    pages = named.where(F.size(parts) >= 4).select("component", parts[1].alias("project"), F.array_join(F.slice(parts, 4, F.size(parts) - 3), "/").alias("page_path")).distinct()
    return pages.join(leaking, "component").select("project", "page_path").distinct()


@query("p4_shares")
def p4_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of the chunks in every split."""
    rows = table(spark, d, "corpus_row").select("id", "doc_id")
    return entity_splits.reached_shares(entity_splits.assign(_page_components(rows), SHARES), SHARES)


@query("p4_assigned")
def p4_assigned(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk with its component and new split."""
    rows = table(spark, d, "corpus_row").select("id", "doc_id")
    out = entity_splits.assign(_page_components(rows), SHARES)
    return out.select(F.col("record").alias("id"), "component", "split")


@query(
    "p4_pages",
    r"""
    SELECT split_part(doc_id, '/', 2) AS project, array_to_string(string_split(doc_id, '/')[4:], '/') AS page_path, count(DISTINCT id) AS n_chunks, 1 AS n_splits
    FROM corpus_row WHERE len(string_split(doc_id, '/')) >= 4 GROUP BY 1, 2""",
)
def p4_pages(spark: SparkSession, d: str) -> DataFrame:
    """Chunks and new splits of every page, over all its versions: one split each."""
    rows = table(spark, d, "corpus_row").select("id", "doc_id")
    assigned = entity_splits.assign(_page_components(rows), SHARES)
    parts = F.split("doc_id", "/")
    named = rows.where(F.size(parts) >= 4).select("id", parts[1].alias("project"), F.array_join(F.slice(parts, 4, F.size(parts) - 3), "/").alias("page_path")).distinct()
    joined = named.join(assigned, F.col("id") == F.col("record"))
    return joined.groupBy("project", "page_path").agg(F.count_distinct("id").alias("n_chunks"), F.count_distinct("split").alias("n_splits"))


# ---- 6: near duplicates


def _near(spark: SparkSession, d: str) -> neardup.NearDuplicates:
    rows = table(spark, d, "corpus_row").where("content_type <> 'api_spec'")
    return neardup.NearDuplicates(rows, "id", "text", "content_type", shingle=3, threshold=0.6, min_tokens=50)


_P6_SQL = r"""
    WITH r AS (SELECT DISTINCT id, content_type, lower(text) AS t, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS norm FROM corpus_row
               WHERE content_type <> 'api_spec' AND id IS NOT NULL AND text IS NOT NULL),
    k AS (SELECT content_type, norm, any_value(t) AS t, row_number() OVER () AS c FROM r GROUP BY content_type, norm),
    w AS (SELECT c, content_type, regexp_extract_all(t, '[\p{L}\p{N}]+|[^\p{L}\p{N} \t\r\n]') AS ws FROM k),
    s AS (SELECT DISTINCT c, content_type, ws[i] || chr(31) || ws[i + 1] || chr(31) || ws[i + 2] AS g FROM (SELECT c, content_type, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 50)),
    n AS (SELECT c, count(*) AS n FROM s GROUP BY c),
    o AS (SELECT a.c AS ca, b.c AS cb, count(*) AS both_ FROM s a JOIN s b ON a.g = b.g AND a.content_type = b.content_type AND a.c < b.c GROUP BY 1, 2),
    p AS (SELECT ca, cb FROM o JOIN n x ON x.c = ca JOIN n y ON y.c = cb WHERE both_ >= 0.6 * (x.n + y.n - both_)),
    m AS (SELECT r.id, k.c FROM r JOIN k USING (content_type, norm))
    SELECT DISTINCT least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b FROM p JOIN m x ON x.c = ca JOIN m y ON y.c = cb WHERE x.id <> y.id"""


@query("p6_found", _P6_SQL)
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).id_pairs()


@query("p6_groups")
def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per record compared: its class of equal texts, its group, and the class's links to other texts.

    Copies share their group, and their class where their tokens are the same. A class without a link is a group of its own, with 0 links. Repeated rows count once;
    an id with several texts has a row for each class.
    """
    return near_groups(_near(spark, d))


def near_groups(near: neardup.NearDuplicates) -> DataFrame:
    """``id, class_id, group_id, n_links`` of every member; the links are joined so that a hot class is spread."""
    pairs = near.stage.put(near.pairs())
    groups = linkgroups.link_groups(pairs.select("a", "b").unionByName(near.copies()), "a", "b").select(F.col("node").cast("long").alias("cid"), "group")
    links = pairs.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("n_links"))
    out = join_bounded(near.members(), groups.join(links, "cid", "left"), ["cid"], "left", salt=16)
    group, n_links = F.coalesce("group", F.col("cid").cast("string")), F.coalesce("n_links", F.lit(0).cast("long"))
    return out.select("id", F.col("cid").alias("class_id"), group.alias("group_id"), n_links.alias("n_links"))


_P6_GROUPS_SQL = _P6_SQL.replace("WITH r AS", "WITH RECURSIVE r AS").rsplit("m AS (SELECT r.id", 1)[0] + r"""
    j AS (SELECT ca AS u, cb AS v FROM p UNION SELECT cb, ca FROM p),
    l AS (SELECT u AS c, count(*) AS n_links FROM j GROUP BY 1),
    m AS (SELECT r.id, k.c FROM r JOIN k USING (content_type, norm) JOIN w ON w.c = k.c WHERE len(w.ws) >= 50),
    f AS (SELECT c, min(id) AS first_id FROM m GROUP BY c),
    reach AS (SELECT c AS node, c AS other FROM f UNION SELECT j.v, reach.other FROM reach JOIN j ON j.u = reach.node)
    SELECT m.id, min(f.first_id) AS first_of_group, any_value(coalesce(l.n_links, 0)) AS n_links FROM m JOIN reach ON reach.node = m.c JOIN f ON f.c = reach.other LEFT JOIN l ON l.c = m.c GROUP BY m.id, m.c"""


@query("p6_first", _P6_GROUPS_SQL)
def p6_first(spark: SparkSession, d: str) -> DataFrame:
    """Every record compared with the smallest id of its group, and the links of its class."""
    groups = Stage(spark, "p6").put(near_groups(_near(spark, d)))
    first = groups.groupBy("group_id").agg(F.min("id").alias("first_of_group"))
    return join_unique(groups, first, "group_id").select("id", "first_of_group", "n_links")


# ---- 8: containers


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    norm = F.lower(F.btrim(F.regexp_replace("text", r"\s+", " ")))
    return docs.select("doc_id", mixing.source_name(F.col("source")).alias("source"), token_count("text").alias("n_tokens"), F.md5(norm).alias("cluster"))


@query("p8_found", f"SELECT DISTINCT doc_id FROM documents WHERE {T_SQL.format('text')} > 2048")
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    packed = binpack.pack(_sized(spark, d), "doc_id", "n_tokens", 2048, "source", "cluster")
    per = packed.groupBy("key").agg(F.count_distinct("container").alias("n"), F.max("n_pieces").alias("pieces"))
    return per.where("n > 1 and n = pieces").select(F.col("key").alias("doc_id"))  # no container holds it whole


@query("p8_containers")
def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container and position of every document or piece."""
    packed = binpack.pack(_sized(spark, d), "doc_id", "n_tokens", 2048, "source", "cluster")
    return packed.withColumnRenamed("key", "doc_id")


@query(
    "p8_checks",
    rf"""WITH t AS (SELECT {T_SQL.format('text')} AS n FROM documents WHERE text IS NOT NULL)
    SELECT sum(n)::BIGINT AS tokens, sum(greatest(1, ceil(n / 2048.0)))::BIGINT AS pieces, 0::BIGINT AS over_capacity, 0::BIGINT AS wrong_positions, 0::BIGINT AS shared_clusters, 0::BIGINT AS too_many_sources, true AS tight FROM t""",
)
def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What is placed, and containers that break a rule; ``tight`` if at most one in a hundred, and one, could be saved."""
    sized = Stage(spark, "p8").put(_sized(spark, d).where("n_tokens is not null"))
    packed = Stage(spark, "p8").put(binpack.pack(sized, "doc_id", "n_tokens", 2048, "source", "cluster"))
    meta = sized.select(F.col("doc_id").alias("key"), "source", "cluster")
    per = packed.join(meta, "key").groupBy("container").agg(
        F.sum("size").alias("size"), F.count("*").alias("n"), F.max("position").alias("last"), F.count_distinct("position").alias("places"), F.count_distinct("cluster").alias("clusters"), F.count_distinct("source").alias("sources")
    )
    tight = F.count("*") <= 1 + 1.01 * F.ceil(F.sum("size") / 2048)
    return per.agg(
        F.sum("size").alias("tokens"), F.sum("n").alias("pieces"), F.count_if(F.col("size") > 2048).alias("over_capacity"), F.count_if((F.col("places") != F.col("n")) | (F.col("last") != F.col("n") - 1)).alias("wrong_positions"),
        F.count_if(F.col("clusters") < F.col("n")).alias("shared_clusters"), F.count_if(F.col("sources") > 4).alias("too_many_sources"), tight.alias("tight"),
    )


# ---- 9: mixture


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", "source", token_count("text").alias("n_tokens"))
    docs = Stage(spark, "p9").put(docs)
    targets = table(spark, d, "mix_target")
    return docs, targets, mixing.mix(docs, targets)


@query("p9_mixture")
def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[2].withColumnRenamed("key", "doc_id")


@query("p9_shares")
def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of every source."""
    docs, targets, mixture = _mixture(spark, d)
    return mixing.reached_shares(mixture, docs, targets)


# ---- 10: look-alike texts


@query("p10_found")
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = lookalike.lookalike_pairs(table(spark, d, "documents"))
    return pairs.select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


@query("p10_classes")
def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its class of texts that look the same: the pairs in compact form."""
    return lookalike.lookalike_classes(table(spark, d, "documents")).withColumnRenamed("key", "doc_id")


@query("p10_texts")
def p10_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its consistent form."""
    return lookalike.with_canonical_text(table(spark, d, "documents").select("doc_id", "text")).drop("text")


# ---- 1: markup residue


def _marked_rows(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "corpus_row").select(F.lit("corpus_row").alias("table_name"), F.col("id").alias("row_key"), F.col("doc_id").alias("path"), "text")
    blocks = table(spark, d, "doc_block").select(F.lit("doc_block").alias("table_name"), F.col("block_id").alias("row_key"), F.col("source_path").alias("path"), "text")
    return chunks.unionByName(blocks)


def _host() -> Column:
    """The project of a documentation path stands for the host whose pages share a layout."""
    return F.get(F.split(F.col("path"), "/"), F.lit(1))


@query("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    out = markup.clean(_marked_rows(spark, d), ["table_name", "row_key"], _host(), with_text=False)
    return out.where("size(kinds) > 0 and row_key is not null").select("table_name", "row_key").distinct()


@query("p1_texts")
def p1_texts(spark: SparkSession, d: str) -> DataFrame:
    """Clean text of every chunk and block, with the constructs it held."""
    return markup.clean(_marked_rows(spark, d), ["table_name", "row_key"], _host())


# ---- 7: broken question and answer pairs


@query("p7_found")
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return qa_defects.find_defects(table(spark, d, "qa_row"))


# ---- 5: stand-ins for content


@query("p5_found")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return standins.find(table(spark, d, "corpus_row")).select(F.col("key").alias("id"))


@query("p5_corpus")
def p5_corpus(spark: SparkSession, d: str) -> DataFrame:
    """The corpus without the records that stand in for content."""
    return standins.find(table(spark, d, "corpus_row").select("id", "project", "text"), keep_real=True)

"""Queries over the documentation tables, one per operator, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folium.functions import text as tx
from folium.functions.html_text import html_text
from folium.operators import balance, components, duplicates, embeddings, markdown, packing, quality, questions
from folium.plans import pipeline, reports
from folium.plans.registry import query
from folium.runtime import Stage, join_bounded, table
from folium.sources import files

# ---- SQL fragments: white space, folding and the fingerprint as DuckDB spells them

_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _hash(c: str) -> str:
    return f"sha256(replace(lower({_collapse(c)}), 'ß', 'ss'))"


def _pieces(c: str) -> str:
    return rf"greatest(1, len(regexp_extract_all({c}, '[\p{{L}}\p{{N}}_]+|[^\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\p{{L}}\p{{N}}_]')))"


#: The latest run of every chunk, as the corpus that a later run replaces.
_ROWS_SQL = "(SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) AS rn FROM corpus_row) WHERE rn = 1)"
_QA_SQL = "(SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at DESC) AS rn FROM qa_row) WHERE rn = 1)"


def _rows(spark: SparkSession, d: str, *columns: str, **derived: Column) -> DataFrame:
    """The latest row of every chunk id; ``derived`` columns are computed before the shuffle, so texts stay behind."""
    made = [c.alias(n) for n, c in derived.items()]
    df = table(spark, d, "corpus_row").select("id", "ingested_at", *[c for c in columns if c not in ("id", "ingested_at")], *made)
    return duplicates.latest_rows(df, "id", "ingested_at")


def _qa(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    df = table(spark, d, "qa_row").select("id", "created_at", *[c for c in columns if c not in ("id", "created_at")])
    return duplicates.latest_rows(df, "id", "created_at")


# ---- text functions


@query("content_fingerprint", f"SELECT id, {_hash('text')} AS content_hash FROM corpus_row")
def content_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus_row").select("id", tx.fingerprint("text").alias("content_hash"))


_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(
    "language_vote",
    rf"""
    WITH w AS (SELECT id, regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}\p{{M}}_]+') AS ws FROM corpus_row),
         v AS (SELECT id, len(list_filter(ws, lambda x: list_contains({_LIST(tx.SPANISH_WORDS)}, x))) AS es,
                      len(list_filter(ws, lambda x: list_contains({_LIST(tx.ENGLISH_WORDS)}, x))) AS en FROM w)
    SELECT id, CASE WHEN es > en THEN 'es' WHEN en > es THEN 'en' ELSE 'unknown' END AS language FROM v""",
)
def language_vote(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus_row").select("id", tx.language_vote("text").alias("language"))


@query(
    "low_signal",
    rf"""SELECT id, {_pieces('text')} AS n_tokens,
           {_pieces('text')} < {tx.LOW_SIGNAL_TOKENS} OR regexp_matches({_strip('text')}, '(?i)^_?(to\s*do|tbd|todo|pendiente|n/a)_?\.?$') AS low_signal
        FROM corpus_row WHERE text IS NOT NULL""",
)
def low_signal(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_row").where("text is not null").select("id", "text", packing.piece_count("text").alias("n_tokens"))
    return rows.select("id", "n_tokens", tx.is_low_signal("n_tokens", "text").alias("low_signal"))


@query("normal_questions", f"SELECT id, trim({_collapse('lower(question)')}, '¿?.! ') AS norm FROM qa_row")
def normal_questions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_row").select("id", tx.normal_question("question").alias("norm"))


@query("headings", r"SELECT id, section_path AS rendered_path, regexp_replace(regexp_replace(heading, '\*\*(.+?)\*\*', '\1', 'g'), '__(.+?)__', '\1', 'g') AS heading, string_split(section_path, ' > ')[-1] AS last_title, len(string_split(section_path, ' > ')) AS depth FROM corpus_row")
def headings(spark: SparkSession, d: str) -> DataFrame:
    path = F.split("section_path", " > ")
    return table(spark, d, "corpus_row").select("id", tx.path_text(path).alias("rendered_path"), tx.clean_heading("heading").alias("heading"), F.element_at(path, -1).alias("last_title"), F.size(path).alias("depth"))


@query("html_text")
def html_texts(spark: SparkSession, d: str) -> DataFrame:
    """Text of every chunk as if it were HTML; the parser has no SQL form."""
    return table(spark, d, "corpus_row").select("id", html_text(F.col("text")).alias("clean"))


# ---- exact duplicates


def _hashed_rows(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    """Written rows with their fingerprint, so that texts are read and hashed once, and their order."""
    rows = _rows(spark, d, "source_path", "chunk_index", content_hash=tx.fingerprint("text")).where("content_hash is not null")
    return Stage(spark, "hashed").put(rows), F.struct(F.split("source_path", "/"), "chunk_index")


@query(
    "exact_duplicates",
    f"""
    WITH h AS (SELECT id, {_hash('text')} AS content_hash, string_split(source_path, '/') AS p, chunk_index FROM {_ROWS_SQL} WHERE text IS NOT NULL),
         f AS (SELECT *, first_value(id) OVER (PARTITION BY content_hash ORDER BY p, chunk_index, id) AS head FROM h)
    SELECT id, content_hash, CASE WHEN head <> id THEN head END AS duplicate_of FROM f""",
)
def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows, order = _hashed_rows(spark, d)
    return duplicates.mark_duplicates(rows, "id", None, order).select("id", "content_hash", "duplicate_of")


@query(
    "duplicate_clusters",
    f"""
    WITH h AS (SELECT id, {_hash('text')} AS content_hash, string_split(source_path, '/') AS p, chunk_index FROM {_ROWS_SQL} WHERE text IS NOT NULL),
         f AS (SELECT *, first_value(id) OVER (PARTITION BY content_hash ORDER BY p, chunk_index, id) AS head FROM h)
    SELECT head AS duplicate_of, count(*) AS n_copies, min(id) AS smallest_copy FROM f WHERE head <> id GROUP BY head""",
)
def duplicate_clusters(spark: SparkSession, d: str) -> DataFrame:
    rows, order = _hashed_rows(spark, d)
    return duplicates.duplicate_clusters(duplicates.mark_duplicates(rows, "id", None, order), "id")


@query("repeated_blocks", f"SELECT {_hash('text')} AS content_hash, count(*) AS n FROM doc_block WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def repeated_blocks(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.repeated_hashes(table(spark, d, "doc_block").where("text is not null"), "text")


# ---- packing


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of ``doc_block`` in the shape the packing takes: a section per run of one heading."""
    raw = duplicates.latest_rows(table(spark, d, "doc_block").where("text is not null"), "block_id", "parsed_at")
    doc = Window.partitionBy("source_path").orderBy("block_index")
    new = F.when(F.coalesce("heading", F.lit("")) != F.coalesce(F.lag(F.coalesce("heading", F.lit(""))).over(doc), F.lit("\x00")), 1).otherwise(0)
    sections = raw.withColumn("_new", new).withColumn("section_idx", F.sum("_new").over(doc).cast("int"))
    shaped = sections.select(
        F.col("source_path").alias("doc_id"), "section_idx", F.col("block_index").alias("block_idx"), "heading", "content_type", "text", "char_start", "char_end"
    )
    return pipeline.flag_repeated(shaped)


#: Both folds one row at a time: ``m_`` gives each section its group, ``f_`` each block its part of the group.
_GROUPS_SQL = f"""
    b_ AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY block_id ORDER BY parsed_at DESC) AS rn FROM doc_block WHERE text IS NOT NULL) WHERE rn = 1),
    n_ AS (SELECT source_path AS doc_id, block_index, content_type, text, char_start, char_end, {_pieces('text')} AS n, count(*) OVER (PARTITION BY {_hash('text')}) > 1 AS repeated,
             CASE WHEN coalesce(heading, '') IS DISTINCT FROM lag(coalesce(heading, '')) OVER (PARTITION BY source_path ORDER BY block_index) THEN 1 ELSE 0 END AS new_ FROM b_),
    s_ AS (SELECT *, CAST(sum(new_) OVER (PARTITION BY doc_id ORDER BY block_index) AS INT) AS section_idx FROM n_),
    t_ AS (SELECT doc_id, section_idx, CAST(sum(n) AS BIGINT) AS n, bool_and(content_type = 'api_spec') AS api, row_number() OVER (PARTITION BY doc_id ORDER BY section_idx) AS rn FROM s_ GROUP BY 1, 2),
    m_ AS (
      SELECT DISTINCT doc_id, 0::BIGINT AS rn, 0 AS next_, 0::BIGINT AS waiting, NULL::INT AS section_idx, NULL::INT AS group_idx FROM t_
      UNION ALL
      SELECT t.doc_id, t.rn, CASE WHEN closed THEN own + 1 ELSE own END, CASE WHEN closed THEN 0 ELSE size END, t.section_idx, own
      FROM m_ m JOIN t_ t ON t.doc_id = m.doc_id AND t.rn = m.rn + 1,
        LATERAL (SELECT CASE WHEN t.api AND m.waiting > 0 THEN m.next_ + 1 ELSE m.next_ END AS own, CASE WHEN t.api THEN t.n ELSE m.waiting + t.n END AS size),
        LATERAL (SELECT t.api OR size >= 75 AS closed))"""
_PACK_SQL = f"""{_GROUPS_SQL},
    g_ AS (SELECT s.*, m.group_idx, row_number() OVER w AS rn, count(*) OVER (PARTITION BY s.doc_id, m.group_idx) AS in_group, max(s.section_idx) OVER (PARTITION BY s.doc_id, m.group_idx) AS path_idx
           FROM s_ s JOIN m_ m ON m.doc_id = s.doc_id AND m.section_idx = s.section_idx WINDOW w AS (PARTITION BY s.doc_id, m.group_idx ORDER BY s.section_idx, s.block_index)),
    f_ AS (
      SELECT DISTINCT doc_id, group_idx, 0::BIGINT AS rn, 0 AS next_, 0::BIGINT AS held, NULL::INT AS part, false AS windowed FROM g_
      UNION ALL
      SELECT g.doc_id, g.group_idx, g.rn, CASE WHEN closed THEN own + 1 ELSE own END, CASE WHEN closed THEN 0 ELSE cur END, own, big AND (g.in_group = 1 OR NOT g.repeated)
      FROM f_ f JOIN g_ g ON g.doc_id = f.doc_id AND g.group_idx = f.group_idx AND g.rn = f.rn + 1,
        LATERAL (SELECT g.n > 512 AS big, g.repeated OR g.n > 512 AS alone),
        LATERAL (SELECT f.held > 0 AND (alone OR f.held + g.n > 512) AS flush),
        LATERAL (SELECT CASE WHEN flush THEN f.next_ + 1 ELSE f.next_ END AS own, CASE WHEN flush THEN 0 ELSE f.held END + g.n AS cur),
        LATERAL (SELECT alone OR cur >= 300 AS closed)),
    p_ AS (SELECT g.*, f.part, f.windowed FROM g_ g JOIN f_ f ON f.doc_id = g.doc_id AND f.group_idx = g.group_idx AND f.rn = g.rn),
    w_ AS (SELECT *, regexp_extract_all(text, '(?:[\\p{{L}}\\p{{N}}_]+|[^{_WS[1:-1]}\\p{{L}}\\p{{N}}_]){_WS}*') AS ps FROM p_ WHERE windowed),
    x_ AS (SELECT *, unnest(range(0, 1 + greatest(0, CAST(ceil((len(ps) - 512) / 452.0) AS BIGINT)))) AS i FROM w_),
    c_ AS (
      SELECT doc_id, group_idx, part, 0::BIGINT AS i, path_idx, string_agg(text, E'\\n\\n' ORDER BY section_idx, block_index) AS text, CAST(sum(n) AS BIGINT) AS n_tokens,
        arg_max(content_type, (length(text), -section_idx, -block_index)) AS content_type, min(char_start) AS char_start, max(char_end) AS char_end, count(*) AS k FROM p_ WHERE NOT windowed GROUP BY ALL
      UNION ALL
      SELECT doc_id, group_idx, part, i, path_idx, trim(array_to_string(ps[i * 452 + 1 : i * 452 + 512], ''), E' \\t\\r\\n'), len(ps[i * 452 + 1 : i * 452 + 512]), content_type, char_start, char_end, NULL FROM x_)"""


@query(
    "pack_chunks",
    rf"""WITH RECURSIVE {_PACK_SQL}
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY group_idx, part, i) - 1 AS chunk_index, count(*) OVER (PARTITION BY doc_id) AS n_chunks_in_doc, path_idx AS section_idx, text, n_tokens,
      content_type, char_start, char_end, k IS NOT NULL AND (n_tokens < 12 OR (k = 1 AND regexp_matches({_strip('text')}, '(?i)^_?(to\s*do|tbd|todo|pendiente|n/a)_?\.?$'))) AS is_low_signal FROM c_""",
)
def pack_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks packed from the parsed blocks."""
    return packing.chunks(_blocks(spark, d))


@query("merged_sections", f"WITH RECURSIVE {_GROUPS_SQL} SELECT doc_id, section_idx, group_idx FROM m_ WHERE section_idx IS NOT NULL")
def merged_sections(spark: SparkSession, d: str) -> DataFrame:
    blocks = _blocks(spark, d)
    sections = blocks.groupBy("doc_id", "section_idx").agg(F.sum("n_tokens").alias("n_tokens"), F.bool_and(F.col("content_type") == "api_spec").alias("api"))
    return packing.merge_sections(sections, packing.PackingConfig())


@query(
    "token_windows",
    f"""
    WITH p AS (SELECT id, regexp_extract_all(text, '(?:[\\p{{L}}\\p{{N}}_]+|[^{_WS[1:-1]}\\p{{L}}\\p{{N}}_]){_WS}*') AS ps FROM {_ROWS_SQL} WHERE text IS NOT NULL),
         n AS (SELECT id, ps, len(ps) AS n FROM p WHERE len(ps) > 512),
         w AS (SELECT id, ps, n, unnest(range(0, 1 + CAST(ceil((n - 512) / 452.0) AS BIGINT))) AS i FROM n)
    SELECT id, CAST(i AS INT) AS window_idx, CAST(len(ps[i * 452 + 1 : i * 452 + 512]) AS INT) AS n_tokens, md5(trim(array_to_string(ps[i * 452 + 1 : i * 452 + 512], ''), E' \\t\\r\\n')) AS digest FROM w""",
)
def token_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d, "text").where("text is not null").withColumn("n", packing.piece_count("text")).where("n > 512")
    cut = packing.token_windows(rows, "id", "text")
    return cut.select(F.col("key").alias("id"), F.col("window").alias("window_idx"), "n_tokens", F.md5("text").alias("digest"))


# ---- near duplicates by vectors

#: Cosine from which vectors are near duplicates.
COSINE = 0.9
#: Ids of the twins in the vector queries: every vector of the table is compared together with a twin, blurred by its right neighbours.
TWIN = 1_000_000_000
BLUR = 0.3


def _with_twins(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    size = F.size("embedding")
    blurred = F.transform("embedding", lambda x, i: x + F.lit(BLUR) * F.get("embedding", (i + 1) % size))
    return v.unionByName(v.select((F.col("vec_id") + TWIN).alias("vec_id"), blurred.alias("embedding"), "label"))


_TWINS_SQL = f"""
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
    t AS (SELECT * FROM e UNION ALL SELECT vec_id + {TWIN}, list_transform(range(1, len(v) + 1), lambda i: v[i] + {BLUR} * v[i % len(v) + 1]), label FROM e)
    SELECT a.vec_id AS id_a, b.vec_id AS id_b FROM t a JOIN t b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}"""


@query("near_vector_pairs", _TWINS_SQL)
def near_vector_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every vector meets its twin, and few others."""
    return duplicates.vector_pairs(_with_twins(spark, d), "vec_id", "embedding", "label", COSINE).select("id_a", "id_b")


@query("hashed_vector_pairs", _TWINS_SQL)
def hashed_vector_pairs(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.hashed_vector_pairs(_with_twins(spark, d), "vec_id", "embedding", "label", COSINE, 64).select("id_a", "id_b")


@query(
    "near_report",
    f"""
    SELECT r.pair_id, r.a, r.b, x.source_path AS source_path_a, y.source_path AS source_path_b
    FROM near_dedup_report r JOIN {_ROWS_SQL} x ON x.id = r.a JOIN {_ROWS_SQL} y ON y.id = r.b""",
)
def near_report(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "near_dedup_report").select("pair_id", F.col("a").alias("id_a"), F.col("b").alias("id_b"))
    return reports.near_report(pairs, _rows(spark, d, "source_path"))


# ---- components and splits

#: Reported similarity from which a pair links its documents.
NEAR = 0.9


def _doc_components(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, project, n_chunks, component``: documents linked by equal texts or reported pairs."""
    stage = Stage(spark, "docs")
    rows = stage.put(_rows(spark, d, "doc_id", h=tx.fingerprint("text")).select("id", "doc_id", "h"))
    near = table(spark, d, "near_dedup_report").where(f"similarity >= {NEAR}").select(F.col("a").alias("u"), F.col("b").alias("v"))
    of = rows.select("id", "doc_id")
    near_docs = near.join(of.toDF("u", "du"), "u").join(of.toDF("v", "dv"), "v").select(F.col("du").alias("u"), F.col("dv").alias("v"))
    edges = components.content_edges(rows, "doc_id", "h").unionByName(near_docs)
    grouped = components.components(rows.select(F.col("doc_id").alias("node")), edges).toDF("doc_id", "component")
    per = rows.groupBy("doc_id").agg(F.count("*").alias("n_chunks"))
    return stage.put(per.join(grouped, "doc_id").withColumn("project", F.split("doc_id", "/")[1]))


_COMPONENTS_SQL = f"""
    rows_ AS (SELECT id, doc_id, {_hash('text')} AS h FROM {_ROWS_SQL}),
    pairs_ AS (
      SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM (SELECT DISTINCT doc_id, h FROM rows_) a JOIN (SELECT DISTINCT doc_id, h FROM rows_) b ON a.h = b.h AND a.doc_id <> b.doc_id
      UNION SELECT x.doc_id, y.doc_id FROM near_dedup_report r JOIN rows_ x ON x.id = r.a JOIN rows_ y ON y.id = r.b WHERE r.similarity >= {NEAR} AND x.doc_id <> y.doc_id),
    both_ AS (SELECT u, v FROM pairs_ UNION SELECT v, u FROM pairs_),
    reach_ AS (SELECT DISTINCT doc_id AS node, doc_id AS label FROM rows_ UNION SELECT b.v, r.label FROM reach_ r JOIN both_ b ON b.u = r.node WHERE r.label < b.v),
    comp_ AS (SELECT node AS doc_id, min(label) AS component FROM reach_ GROUP BY node)"""


@query("doc_components", f"WITH RECURSIVE {_COMPONENTS_SQL} SELECT doc_id, component FROM comp_")
def doc_components(spark: SparkSession, d: str) -> DataFrame:
    """Component of every document; an iterative algorithm, tested against union-find."""
    return _doc_components(spark, d).select("doc_id", "component")


def _split_docs(spark: SparkSession, d: str) -> DataFrame:
    docs = _doc_components(spark, d)
    weights = docs.groupBy("component").agg(F.sum("n_chunks").alias("weight"))
    split = balance.assign_by_weight(weights, balance.seeded_tie(F.col("component"), 42))
    return Stage(spark, "split").put(docs.join(split.select("component", "split"), "component"))


def _lpt_sql(weights: str) -> str:
    """CTEs ``w_, o_, f_`` that hand out (component, weight) one by one, heaviest first."""
    goal = {"train": "o.total * (1 - 0.2::DOUBLE - 0.2::DOUBLE) - f.tr", "test": "o.total * 0.2::DOUBLE - f.te", "val": "o.total * 0.2::DOUBLE - f.va"}
    pick = f"CASE WHEN {goal['train']} >= {goal['test']} AND {goal['train']} >= {goal['val']} THEN 'train' WHEN {goal['test']} >= {goal['val']} THEN 'test' ELSE 'val' END"
    return f"""
    w_ AS (SELECT component, weight, ('0x' || substr(md5(component || ':42'), 1, 15))::BIGINT AS tie FROM ({weights})),
    o_ AS (SELECT *, row_number() OVER (ORDER BY weight DESC, tie, component) AS rn, sum(weight) OVER () AS total FROM w_),
    f_ AS (
      SELECT 0::BIGINT AS rn, 0::DOUBLE AS tr, 0::DOUBLE AS te, 0::DOUBLE AS va, NULL::VARCHAR AS component, 0::BIGINT AS weight, NULL::VARCHAR AS split
      UNION ALL
      SELECT o.rn, f.tr + CASE WHEN p = 'train' THEN o.weight ELSE 0 END, f.te + CASE WHEN p = 'test' THEN o.weight ELSE 0 END, f.va + CASE WHEN p = 'val' THEN o.weight ELSE 0 END,
             o.component, o.weight, p
      FROM f_ f JOIN o_ o ON o.rn = f.rn + 1, LATERAL (SELECT {pick} AS p))"""


@query(
    "project_lpt_split",
    f"WITH RECURSIVE {_lpt_sql('SELECT project_version AS component, count(*) AS weight FROM source_file WHERE project_version IS NOT NULL GROUP BY 1')} SELECT component, weight, split FROM f_ WHERE component IS NOT NULL",
)
def project_lpt_split(spark: SparkSession, d: str) -> DataFrame:
    """Versions balanced by their files over the splits, one by one from the heaviest."""
    weights = table(spark, d, "source_file").where("project_version is not null").groupBy(F.col("project_version").alias("component")).agg(F.count("*").alias("weight"))
    return balance.assign_by_weight(weights, balance.seeded_tie(F.col("component"), 42))


_SPLIT_SQL = f"""{_COMPONENTS_SQL}, {_lpt_sql('SELECT c.component, count(*) AS weight FROM rows_ r JOIN comp_ c ON c.doc_id = r.doc_id GROUP BY 1')},
    docs_ AS (SELECT c.doc_id, c.component, f.split, split_part(c.doc_id, '/', 2) AS project, (SELECT count(*) FROM rows_ r WHERE r.doc_id = c.doc_id) AS n_chunks
              FROM comp_ c JOIN f_ f ON f.component = c.component)"""


@query("lpt_split", f"WITH RECURSIVE {_SPLIT_SQL} SELECT doc_id, component, split FROM docs_")
def lpt_split(spark: SparkSession, d: str) -> DataFrame:
    """Split of every document by its component, balanced by chunks."""
    return _split_docs(spark, d).select("doc_id", "component", "split")


_PER_SPLIT = ", ".join(f"count(DISTINCT component) FILTER (split = '{x}') AS components_{x}, CAST(coalesce(sum(n_chunks) FILTER (split = '{x}'), 0) AS BIGINT) AS chunks_{x}" for x in ("train", "val", "test"))


@query(
    "split_report",
    f"""WITH RECURSIVE {_SPLIT_SQL}, p_ AS (SELECT project, count(DISTINCT component) AS n_components, count(DISTINCT doc_id) AS n_docs, {_PER_SPLIT} FROM docs_ GROUP BY project)
    SELECT *, concat_ws('; ', CASE WHEN n_components = 1 THEN 'single component' END, CASE WHEN components_val = 0 THEN 'nothing in val' END,
      CASE WHEN components_test = 0 THEN 'nothing in test' END) AS warnings FROM p_""",
)
def split_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.split_report(_split_docs(spark, d))


@query(
    "new_split_leaks",
    f"WITH RECURSIVE {_SPLIT_SQL} SELECT r.h AS content_hash, count(DISTINCT d.split) AS n_splits FROM rows_ r JOIN docs_ d ON d.doc_id = r.doc_id WHERE r.h IS NOT NULL GROUP BY 1 HAVING count(DISTINCT d.split) > 1",
)
def new_split_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprints in more than one of the new splits: there must be none."""
    rows = _rows(spark, d, "doc_id", content_hash=tx.fingerprint("text"))
    return reports.leaks(rows.join(_split_docs(spark, d).select("doc_id", "split"), "doc_id"), "content_hash")


@query(
    "stored_split_leaks",
    f"SELECT {_hash('text')} AS content_hash, count(DISTINCT split) AS n_splits FROM {_ROWS_SQL} WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1",
)
def stored_split_leaks(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d, "split", content_hash=tx.fingerprint("text"))
    return reports.leaks(rows, "content_hash")


@query("split_shares", f"SELECT split, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM {_ROWS_SQL} GROUP BY split")
def split_shares(spark: SparkSession, d: str) -> DataFrame:
    return reports.split_shares(_rows(spark, d, "split"))


# ---- reports and comparisons


@query(
    "corpus_counts",
    f"""SELECT count(*) AS total_chunks, CAST(count_if(is_low_signal) AS BIGINT) AS low_signal, count(duplicate_of) AS marked_duplicates, count(DISTINCT duplicate_of) AS clusters,
        max(n_tokens) AS max_tokens, round(avg(n_tokens), 6) AS avg_tokens FROM {_ROWS_SQL}""",
)
def corpus_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.corpus_counts(_rows(spark, d, "is_low_signal", "duplicate_of", "n_tokens"))


@query("counts_by_type", f"SELECT content_type, language, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM {_ROWS_SQL} GROUP BY ALL")
def counts_by_type(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d, "content_type", "language", chars=F.length("text"))
    return rows.groupBy("content_type", "language").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


@query(
    "version_compare",
    """
    WITH f AS (SELECT project, project_version, array_to_string(string_split(relative_path, '/')[4:], '/') AS path, max(size_bytes) AS size_bytes FROM source_file GROUP BY ALL),
         l AS (SELECT f.* FROM f JOIN project_source s ON s.project = f.project AND s.canonical_version = f.project_version),
         r AS (SELECT f.* FROM f WHERE project_version = 'latest')
    SELECT coalesce(l.project, r.project) || '/' || coalesce(l.path, r.path) AS path,
      CASE WHEN r.project IS NULL THEN 'only_left' WHEN l.project IS NULL THEN 'only_right' WHEN l.size_bytes IS NOT DISTINCT FROM r.size_bytes THEN 'same' ELSE 'different' END AS status
    FROM l FULL JOIN r ON l.project = r.project AND l.path = r.path""",
)
def version_compare(spark: SparkSession, d: str) -> DataFrame:
    """Files of the curated version of every project against those of its latest one."""
    rows = table(spark, d, "source_file").groupBy("project", "project_version", files.inner_path("relative_path").alias("inner")).agg(F.max("size_bytes").alias("size_bytes"))
    rows = rows.withColumn("path", F.concat_ws("/", "project", "inner")).where("project is not null")
    sources = table(spark, d, "project_source").select("project", F.col("canonical_version").alias("project_version"))
    left = join_bounded(rows, sources, ["project", "project_version"], "inner")
    return files.compare(left, rows.where("project_version = 'latest'"), "path", "size_bytes")


@query(
    "files_with_sources",
    """SELECT f.relative_path, f.file_kind, s.canonical_version = f.project_version AS canonical, s.reason
       FROM (SELECT DISTINCT relative_path, file_kind, project, project_version FROM source_file) f LEFT JOIN project_source s ON s.project = f.project""",
)
def files_with_sources(spark: SparkSession, d: str) -> DataFrame:
    """Files with their project's curated version."""
    f = table(spark, d, "source_file").select("relative_path", "file_kind", "project", "project_version").distinct()
    s = table(spark, d, "project_source").select("project", "canonical_version", "reason")
    out = join_bounded(f, s, ["project"], "left")
    return out.select("relative_path", "file_kind", (F.col("canonical_version") == F.col("project_version")).alias("canonical"), "reason")


@query(
    "chunk_order",
    f"SELECT id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index, id) - 1 AS place, count(*) OVER (PARTITION BY doc_id) AS n_in_doc FROM {_ROWS_SQL}",
)
def chunk_order(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d, "doc_id", "chunk_index").withColumnRenamed("chunk_index", "stored")
    return packing.numbered(rows, "doc_id", ["stored", "id"]).select("id", F.col("chunk_index").alias("place"), F.col("n_chunks_in_doc").alias("n_in_doc"))


# ---- questions and answers


def _template_sql() -> str:
    """All kinds of template pairs by the line grammar, with their order inside a chunk."""
    g = {k: v.replace("'", "''") for k, v in questions.LINES.items()}

    def ask(kind: str, **parts: str) -> str:
        out = "'" + questions.ASK[kind].replace("'", "''") + "'"
        for name, value in parts.items():
            out = f"replace({out}, '{{{name}}}', {value})"
        return out

    def lines(kind: str) -> str:
        return f"regexp_extract_all(text, '(?m){g[kind]}')"

    def part(kind: str, k: int, of: str = "line") -> str:
        return f"regexp_extract({of}, '(?m){g[kind]}', {k})"

    words = {r: _LIST(sorted(v)) for r, v in questions.ROLES.items()}
    at = ", ".join(f"list_filter(range(1, len(h) + 1), lambda i: list_contains({w}, lower(h[i])))[1] AS {r}_at" for r, w in words.items())
    cell = ", ".join(f"coalesce(r[{r}_at], '') AS {r}_" for r in words)
    bare = lambda c: f"trim(trim(trim({c}), '`'))"
    label = ask("label", name=bare("string_split(section_path, ' > ')[-1]"))
    described = f"trim(trim({part('property', 2)} || '. ' || {part('property', 4)}, '.'))"
    return f"""
    WITH t AS (SELECT id, text, content_type, coalesce(section_path, '') AS section_path, contains(text, 'Endpoint:') AS op FROM {_ROWS_SQL} WHERE text IS NOT NULL),
    o AS (SELECT id, text, {part('endpoint', 1, 'text')} || ' ' || {part('endpoint', 2, 'text')} AS endpoint FROM t WHERE content_type = 'api_spec' AND op AND regexp_matches(text, '(?m){g['endpoint']}')),
    s AS (SELECT id, text, trim({part('schema', 1, 'text')}) AS schema_ FROM t WHERE content_type = 'api_spec' AND NOT op AND contains(text, 'Schema:') AND regexp_matches(text, '(?m){g['schema']}')),
    pl AS (SELECT *, first_value(line) OVER (PARTITION BY id, {part('parameter', 1)} ORDER BY k) AS proof FROM (SELECT id, endpoint, unnest({lines('parameter')}) AS line, generate_subscripts({lines('parameter')}, 1) AS k FROM o)),
    rl AS (SELECT *, first_value(line) OVER (PARTITION BY id, {part('response', 1)} ORDER BY k) AS proof FROM (SELECT id, endpoint, unnest({lines('response')}) AS line, generate_subscripts({lines('response')}, 1) AS k FROM o)),
    yl AS (SELECT *, first_value(line) OVER (PARTITION BY id, {part('property', 1)} ORDER BY k) AS proof FROM (SELECT id, schema_, unnest({lines('property')}) AS line, generate_subscripts({lines('property')}, 1) AS k FROM s)),
    ls AS (SELECT id, text, section_path, list_transform(list_filter(string_split(text, chr(10)), lambda x: starts_with(trim(x), '|')), lambda x: list_transform(string_split(trim(trim(x), '|'), '|'), lambda y: trim(y))) AS cells
           FROM t WHERE content_type = 'table'),
    rs AS (SELECT id, text, section_path, cells[1] AS h, unnest(cells[3:]) AS r, generate_subscripts(cells[3:], 1) AS k FROM ls WHERE len(cells) >= 2),
    hs AS (SELECT *, {label} AS label, {at},
             CASE WHEN contains(text, '| ' || array_to_string(r, ' | ') || ' |') THEN '| ' || array_to_string(r, ' | ') || ' |'
                  ELSE list_filter(string_split(text, chr(10)), lambda l: len(list_filter(r, lambda c: c <> '' AND NOT contains(l, c))) = 0)[1] END AS proof FROM rs WHERE len(r) = len(h)),
    cs AS (SELECT *, {cell} FROM hs WHERE proof IS NOT NULL),
    es AS (SELECT *, array_to_string(list_filter(list_transform(range(1, len(h) + 1), lambda i: CASE WHEN r[i] <> '' AND i <> id_at THEN h[i] || ': ' || r[i] END), lambda x: x IS NOT NULL), '; ') AS rest FROM cs),
    every_ AS (
      SELECT id, 0 AS a, 0 AS k, 0 AS b, {ask('summary', endpoint='endpoint')} AS question, trim({part('summary', 1, 'text')}) AS answer, {part('summary', 0, 'text')} AS evidence_span, 'extractive' AS answer_type,
        'openapi_operation_summary' AS generation_detail FROM o WHERE regexp_matches(text, '(?m){g['summary']}')
      UNION ALL SELECT id, 1, k, 0, {ask('parameter', name=part('parameter', 1), place=part('parameter', 2), endpoint='endpoint')},
        trim({part('parameter', 3)} || ' (' || CASE WHEN {part('parameter', 5)} <> '' THEN 'requerido' ELSE 'opcional' END || '). ' || {part('parameter', 6)}), proof, 'extractive', 'openapi_operation_parameter_type' FROM pl
      UNION ALL SELECT id, 1, k, 1, {ask('parameter_enum', name=part('parameter', 1), endpoint='endpoint')}, {part('parameter', 4)}, proof, 'enum', 'openapi_operation_parameter_enum' FROM pl WHERE {part('parameter', 4)} <> ''
      UNION ALL SELECT id, 2, k, 0, {ask('response', status=part('response', 1), endpoint='endpoint')}, trim({part('response', 2)}), proof, 'extractive', 'openapi_operation_response' FROM rl
      UNION ALL SELECT id, 0, 0, 0, {ask('schema', schema='schema_')}, trim({part('type', 1, 'text')}), {part('type', 0, 'text')}, 'extractive', 'openapi_schema_type' FROM s WHERE regexp_matches(text, '(?m){g['type']}')
      UNION ALL SELECT id, 1, k, 0, {ask('property', name=part('property', 1), schema='schema_')}, {described} || CASE WHEN {part('property', 4)} <> '' THEN '.' ELSE '' END, proof, 'extractive', 'openapi_schema_property_type' FROM yl
      UNION ALL SELECT id, 1, k, 1, {ask('property_enum', name=part('property', 1), schema='schema_')}, {part('property', 3)}, proof, 'enum', 'openapi_schema_property_enum' FROM yl WHERE {part('property', 3)} <> ''
      UNION ALL SELECT id, 0, k, 0, CASE WHEN id_ <> '' AND type_ <> '' THEN {ask('field', name=bare('id_'), label='label')} WHEN code_ <> '' AND description_ <> '' THEN {ask('code', name=bare('code_'), label='label')}
          ELSE {ask('row', label='label', name=bare('id_'))} END,
        CASE WHEN id_ <> '' AND type_ <> '' THEN type_ || CASE WHEN description_ <> '' THEN ' (' || description_ || ')' ELSE '' END WHEN code_ <> '' AND description_ <> '' THEN description_ ELSE rest END, proof, 'extractive',
        CASE WHEN id_ <> '' AND type_ <> '' THEN 'table_field_type' WHEN code_ <> '' AND description_ <> '' THEN 'table_code_description' ELSE 'table_generic_row' END
        FROM es WHERE (id_ <> '' AND type_ <> '') OR (code_ <> '' AND description_ <> '') OR (id_at IS NOT NULL AND rest <> ''))
    SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY a, k, b) - 1 AS INT) AS ordinal, question, answer, evidence_span, answer_type, generation_detail FROM every_"""


@query("template_pairs", _template_sql())
def template_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Template questions of all API and table chunks."""
    return questions.with_template_pairs(_rows(spark, d, "text", "content_type", "section_path").where("text is not null"))


@query(
    "operation_summaries",
    rf"""
    WITH t AS (SELECT id, text FROM {_ROWS_SQL} WHERE content_type = 'api_spec' AND contains(text, 'Endpoint:'))
    SELECT id, '¿Qué hace el endpoint `' || regexp_extract(text, '(?m)^Endpoint: (\S+) (.+)$', 1) || ' ' || regexp_extract(text, '(?m)^Endpoint: (\S+) (.+)$', 2) || '`?' AS question,
           trim(regexp_extract(text, '(?m)^Summary: (.+)$', 1)) AS answer
    FROM t WHERE regexp_matches(text, '(?m)^Endpoint: \S+ .+$') AND regexp_matches(text, '(?m)^Summary: .+$')""",
)
def operation_summaries(spark: SparkSession, d: str) -> DataFrame:
    pairs = questions.with_template_pairs(_rows(spark, d, "text", "content_type", "section_path").where("text is not null and content_type = 'api_spec'"))
    return pairs.where("generation_detail = 'openapi_operation_summary'").select("id", "question", "answer")


@query(
    "question_routes",
    f"""SELECT id, CASE WHEN duplicate_of IS NOT NULL THEN 'none' WHEN content_type IN ('table', 'api_spec') THEN 'template'
          WHEN content_type = 'prose' AND NOT coalesce(is_low_signal, false) THEN 'llm' ELSE 'none' END AS method FROM {_ROWS_SQL}""",
)
def question_routes(spark: SparkSession, d: str) -> DataFrame:
    return questions.route(_rows(spark, d, "duplicate_of", "content_type", "is_low_signal")).select("id", "method")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Stored pairs with the text of their chunk, in corpus order."""
    qa = _qa(spark, d, "source_chunk_id", "question", "answer", "evidence_span", "answer_type", "generation_method", "split", "source_path")
    chunks = _rows(spark, d, "doc_id", "chunk_index", "text").select(F.col("id").alias("source_chunk_id"), "doc_id", "chunk_index", F.col("text").alias("chunk_text"))
    joined = qa.join(chunks, "source_chunk_id").withColumn("project", F.split("doc_id", "/")[1])
    return joined.withColumn("order_path", F.split("doc_id", "/"))


_ORDER = ["order_path", "chunk_index", "id"]
_CHECKED_SQL = rf"""
    c AS (SELECT q.*, r.doc_id, r.chunk_index, r.text AS chunk_text, split_part(r.doc_id, '/', 2) AS project_of
          FROM (SELECT * EXCLUDE project FROM {_QA_SQL}) q JOIN {_ROWS_SQL} r ON r.id = q.source_chunk_id),
    k AS (SELECT *, coalesce(length({_collapse('evidence_span')}) > 0 AND contains({_collapse('chunk_text')}, {_collapse('evidence_span')}), false) AS evidence_verified,
            coalesce(length({_strip('question')}) BETWEEN 8 AND 300 AND length({_strip('answer')}) > 0, false) AS length_ok,
            row_number() OVER (PARTITION BY project_of, trim({_collapse('lower(question)')}, '¿?.! ') ORDER BY string_split(doc_id, '/'), chunk_index, id) = 1 AS first_seen FROM c),
    z AS (SELECT *, evidence_verified AND length_ok AND first_seen AS passed FROM k)"""


@query("evidence_checks", f"WITH {_CHECKED_SQL} SELECT id, evidence_verified, length_ok FROM z")
def evidence_checks(spark: SparkSession, d: str) -> DataFrame:
    c = _candidates(spark, d)
    return c.select("id", tx.contains_evidence("chunk_text", "evidence_span").alias("evidence_verified"), tx.length_ok("question", "answer").alias("length_ok"))


@query("quality_cascade", f"WITH {_CHECKED_SQL} SELECT id, evidence_verified, length_ok, first_seen AS not_near_duplicate_question, passed AS qc_passed FROM z")
def quality_cascade(spark: SparkSession, d: str) -> DataFrame:
    checked = quality.quality_checks(_candidates(spark, d), _ORDER, Stage(spark, "checks"))
    return checked.select("id", "evidence_verified", "length_ok", "not_near_duplicate_question", "qc_passed")


_PRIO = "CASE answer_type WHEN 'enum' THEN 0 WHEN 'numeric' THEN 1 WHEN 'boolean' THEN 1 WHEN 'extractive' THEN 2 WHEN 'generative' THEN 3 ELSE 4 END"
_FINAL_SQL = f"""{_CHECKED_SQL},
    i AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_index ORDER BY {_PRIO}, string_split(doc_id, '/'), chunk_index, id) AS r FROM z WHERE passed),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY r, chunk_index) AS pick FROM i WHERE r <= 8 QUALIFY pick <= 8)"""


def _final(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    stage = Stage(spark, "qc")
    checked = stage.put(quality.quality_checks(_candidates(spark, d), _ORDER, stage))
    return checked, quality.round_robin_cap(checked.where("qc_passed"), "doc_id", "chunk_index", [quality.type_priority("answer_type"), *_ORDER], 8)


@query("round_robin_cap", f"WITH {_FINAL_SQL} SELECT id, doc_id, r, pick FROM f")
def round_robin_cap(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d)[1].select("id", "doc_id", "r", "pick")


@query(
    "qc_report",
    f"""WITH {_FINAL_SQL}
    SELECT 'candidates' AS counter, generation_method AS value, count(*) AS n FROM z GROUP BY 2
    UNION ALL SELECT 'passed', 'all', count(*) FROM z WHERE passed
    UNION ALL SELECT 'final', generation_method, count(*) FROM f GROUP BY 2
    UNION ALL SELECT 'final_split', split, count(*) FROM f GROUP BY 2""",
)
def qc_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.qc_counts(*_final(spark, d))


@query(
    "qa_without_chunk",
    f"SELECT q.id, q.source_chunk_id FROM {_QA_SQL} q WHERE NOT EXISTS (SELECT 1 FROM corpus_row r WHERE r.id = q.source_chunk_id)",
)
def qa_without_chunk(spark: SparkSession, d: str) -> DataFrame:
    """Pairs whose chunk is not in the corpus."""
    chunks = table(spark, d, "corpus_row").select(F.col("id").alias("source_chunk_id"))
    return _qa(spark, d, "source_chunk_id").join(chunks, "source_chunk_id", "left_anti").select("id", "source_chunk_id")


@query(
    "qa_split_mismatch",
    f"""SELECT q.id, q.split AS qa_split, r.split AS chunk_split FROM {_QA_SQL} q JOIN {_ROWS_SQL} r ON r.id = q.source_chunk_id WHERE q.split IS DISTINCT FROM r.split""",
)
def qa_split_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Pairs whose split is not their chunk's."""
    chunks = _rows(spark, d, "split").select(F.col("id").alias("source_chunk_id"), F.col("split").alias("chunk_split"))
    out = _qa(spark, d, "source_chunk_id", "split").join(chunks, "source_chunk_id")
    return out.where(~F.col("split").eqNullSafe(F.col("chunk_split"))).select("id", F.col("split").alias("qa_split"), "chunk_split")


# ---- parsing


@query("markdown_blocks")
def markdown_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Every page of ``documents`` parsed as Markdown; the parser is tested on fixtures."""
    pages = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return markdown.markdown_blocks(pages).withColumn("section_path", tx.path_text("section_path"))


@query("document_chunks")
def document_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every page of ``documents`` from text to packed chunks."""
    pages = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    blocks = Stage(spark, "pages").put(pipeline.flag_repeated(markdown.markdown_blocks(pages)))
    return packing.chunks(blocks)


@query("hashed_text_vectors")
def hashed_text_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of all chunks but API text, as the near-duplicate stage takes them."""
    rows = table(spark, d, "corpus_row").where("content_type <> 'api_spec'")
    return embeddings.with_vectors(rows, "id", "text")


@query(
    "pipe_tables",
    """
    WITH l AS (SELECT id, list_transform(list_filter(string_split(text, chr(10)), lambda x: starts_with(ltrim(x), '|')),
                 lambda x: list_transform(string_split(trim(trim(x), '|'), '|'), lambda y: trim(y))) AS cells FROM corpus_row WHERE contains(text, '|')),
         r AS (SELECT id, cells[1:1] || list_filter(cells[3:], lambda r: len(r) = len(cells[1])) AS rows_ FROM l WHERE len(cells) >= 2)
    SELECT id, len(rows_) AS n_rows, len(rows_[1]) AS n_columns, array_to_string(list_transform(rows_, lambda r: array_to_string(r, chr(9))), chr(10)) AS cells FROM r""",
)
def pipe_tables(spark: SparkSession, d: str) -> DataFrame:
    """Header and rows of every pipe table in the chunks, as tab-separated lines."""
    found = questions.tables(table(spark, d, "corpus_row"), "id", "text")
    rows = F.concat(F.array("header"), F.col("rows"))
    joined = F.array_join(F.transform(rows, lambda x: F.array_join(x, "\t")), "\n")
    return found.select(F.col("key").alias("id"), F.size(rows).alias("n_rows"), F.size("header").alias("n_columns"), joined.alias("cells"))


@query(
    "line_offsets",
    """
    WITH l AS (SELECT block_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
               FROM (SELECT DISTINCT block_id, text FROM doc_block WHERE text IS NOT NULL))
    SELECT block_id, CAST(n - 1 AS INT) AS line_no, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY block_id, text ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start FROM l""",
)
def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    """First character of every line of every block."""
    blocks = table(spark, d, "doc_block").select("block_id", "text").distinct()
    return markdown.line_offsets(blocks, "block_id", "text").withColumnRenamed("key", "block_id")

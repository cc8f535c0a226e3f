"""Queries over documents made from whole tables, so that parsers, readers and the LLM adapter have SQL to be checked by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import text as tx
from folium.operators import markdown, openapi, questions
from folium.plans import pipeline
from folium.plans.core_queries import _PRIO, _ROWS_SQL, _collapse, _hash, _pieces, _rows, _strip, _template_sql
from folium.plans.registry import query
from folium.runtime import Stage, table
from folium.sources import files, jsonl

# ---- OpenAPI: one specification per supplier

SPEC = """openapi: 3.0.0
paths:
  /supplier/{id}/items:
    get:
      operationId: get_<key>
      summary: Items of <name>
      parameters:
      - {name: id, in: path, required: true, schema: {type: integer}, description: Key <key>}
      - $ref: '#/components/parameters/page'
      - $ref: '#/components/parameters/missing'
      responses:
        '200': {description: Found <key>}
        '404': {$ref: '#/components/responses/gone'}
      security: [token]
    post:
      requestBody:
        required: true
        content:
          application/json: {schema: {$ref: '#/components/schemas/Item'}}
          text/plain: {schema: {type: array, items: {type: object, properties: {mark: {type: string, enum: [x]}}}}}
      responses: {}
    trace: {summary: not an operation here}
components:
  parameters:
    page: {name: page, in: query, schema: {type: string, enum: [a, b]}, description: Nation <nation>}
  responses:
    gone: {description: Gone <key>}
  schemas:
    Item:
      type: object
      properties:
        key: {type: integer, description: Key <key>}
        more: {$ref: '#/components/schemas/More'}
      required: [key]
    More: {type: string}
models:
  More: {type: array, items: {type: string, description: part}}
"""
_GET = """Endpoint: GET /supplier/{id}/items
Operation ID: get_<key>
Summary: Items of <name>
Parameters:
  - id (in: path, type: integer) [required]: Key <key>
  - page (in: query, type: string) enum=['a', 'b']: Nation <nation>
Responses:
  - 200: Found <key>
  - 404: Gone <key>
Security: ['token']"""
_POST = """Endpoint: POST /supplier/{id}/items
Request body [required]:
  content-type: application/json
  -> schema 'Item' (ver chunk de schemas para el detalle completo)
  content-type: text/plain
  type: array
    type: object
      - mark (string) enum=['x']"""
_ITEM = """Schema: Item
Type: object
Properties:
  - key (integer): Key <key>
  - more (-> More): 
Required: ['key']"""
_MORE = """Schema: More
Type: array
Items: string (part)"""


def _filled(template: str, **values: Column) -> Column:
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit(f"<{name}>"), value.cast("string"))
    return out


def _filled_sql(template: str, **values: str) -> str:
    out = "'" + template.replace("'", "''") + "'"
    for name, value in values.items():
        out = f"replace({out}, '<{name}>', {value}::VARCHAR)"
    return out


_SUPPLIER = {"key": "s_suppkey", "name": "s_name", "nation": "s_nationkey"}
_PARTS = [("paths", "GET /supplier/{id}/items", _GET), ("paths", "POST /supplier/{id}/items", _POST), ("schemas", "Item", _ITEM), ("schemas", "More", _MORE)]


@query(
    "openapi_sections",
    " UNION ALL ".join(
        f"SELECT s_suppkey::VARCHAR AS doc_id, {i} AS section_idx, 'swagger.yaml > {part} > {title}' AS section_path, '{title}' AS heading, 'api_spec' AS content_type, {_filled_sql(text, **_SUPPLIER)} AS text FROM supplier"
        for i, (part, title, text) in enumerate(_PARTS)
    ),
)
def openapi_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of one specification per supplier: operations, parameters and responses by reference, request bodies, schemas of both places."""
    specs = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("doc_id"), _filled(SPEC, **{k: F.col(v) for k, v in _SUPPLIER.items()}).alias("text"))
    out = openapi.openapi_blocks(specs)
    return out.select("doc_id", "section_idx", tx.path_text("section_path").alias("section_path"), "heading", "content_type", "text")


# ---- Markdown: one page per part, with what normalisation repairs

PAGE = """About <name>.

#Brand <brand>

It is **<type>**,
and of size <size>.

## Sizes __all__

| Field | Type |
|-------|------|
| size  | <size> |

### Code

```json
{&#34;key&#34;: <key>}
#not a heading
```

```mermaid
graph TD
style A fill:<size>
A --> B
style A fill:<size>
```

Last
====

<div>inside <b><brand></b></div>

1. one
2. two
"""
_NORMAL = PAGE.replace("#Brand", "# Brand").replace("&#34;", '"').replace("A --> B\nstyle A fill:<size>\n", "A --> B\n")
_BRAND, _SIZES, _CODE = "Brand <brand>", "Brand <brand> > Sizes all", "Brand <brand> > Sizes all > Code"
#: (section, block, path, kind, text, how the text stands in the page) of every block.
_BLOCKS = [
    (0, 0, "<key>", "prose", "About <name>.", None), (1, 0, _BRAND, "prose", "It is **<type>**,\nand of size <size>.", None), (2, 0, _SIZES, "table", "| Field | Type |\n|-------|------|\n| size  | <size> |", None),
    (3, 0, _CODE, "code", '```json\n{"key": <key>}\n#not a heading\n```', None), (3, 1, _CODE, "code", "```mermaid\ngraph TD\nstyle A fill:<size>\nA --> B\n```", None),
    (4, 0, "Last", "prose", "inside <brand>", "<div>inside <b>"), (4, 1, "Last", "prose", "1. one\n2. two", None),
]
_PART = {"key": "p_partkey", "name": "p_name", "brand": "p_brand", "type": "p_type", "size": "p_size"}


@query(
    "markdown_sections",
    " UNION ALL ".join(
        f"SELECT 'part/' || p_partkey || '.md' AS doc_id, {section} AS section_idx, {block} AS block_idx, {_filled_sql(path, **_PART)} AS section_path, '{kind}' AS content_type, {_filled_sql(text, **_PART)} AS text, "
        f"instr({_filled_sql(_NORMAL, **_PART)}, {_filled_sql(found or text, **_PART)}) - 1 AS char_start, instr({_filled_sql(_NORMAL, **_PART)}, {_filled_sql(found or text, **_PART)}) - 1 + length({_filled_sql(text, **_PART)}) AS char_end FROM part"
        for section, block, path, kind, text, found in _BLOCKS
    ),
)
def markdown_sections(spark: SparkSession, d: str) -> DataFrame:
    """Typed blocks of one page per part: broken and underlined headings, the heading stack, tables, fences with entities and repeated styles, HTML, lists, offsets."""
    pages = table(spark, d, "part").select(F.concat(F.lit("part/"), F.col("p_partkey"), F.lit(".md")).alias("doc_id"), _filled(PAGE, **{k: F.col(v) for k, v in _PART.items()}).alias("text"))
    out = markdown.markdown_blocks(pages)
    return out.select("doc_id", "section_idx", "block_idx", tx.path_text("section_path").alias("section_path"), "content_type", "text", "char_start", "char_end")


# ---- sources and sinks


@query(
    "discovered_files",
    """SELECT DISTINCT relative_path, CASE WHEN relative_path LIKE '%.md' THEN 'markdown' ELSE 'openapi_spec' END AS found_kind,
         CASE WHEN relative_path LIKE '%.md' THEN 'guide/' || project ELSE 'spec/' || project END AS url
       FROM source_file WHERE project IS NOT NULL AND project_version IS NOT NULL AND regexp_matches(relative_path, '\\.(md|yaml|yml)$')""",
)
def discovered_files(spark: SparkSession, d: str) -> DataFrame:
    """Listed files that are documentation, with their kind and the URL hint of their project; navigation and other files beside them are left out."""
    listed = table(spark, d, "source_file").where("project is not null and project_version is not null").select("relative_path", "project", "project_version").distinct()
    beside = listed.select("project", "project_version").distinct()
    extra = F.explode(F.array(*[F.lit(n) for n in (*files.NAVIGATION, files.HINTS_FILE, "notes.txt", "PAGE.MD")]))
    other = beside.withColumn("extra", extra).select(F.concat_ws("/", "project", "extra").alias("relative_path"), "project", "project_version")
    hint = F.to_json(F.struct(F.concat(F.lit("guide/"), "project").alias("guide"), F.concat(F.lit("spec/"), "project").alias("specifications")))
    every = listed.unionByName(other).withColumn("name", F.element_at(F.split("relative_path", "/"), -1)).withColumn("content", F.when(F.col("name") == files.HINTS_FILE, hint).cast("binary"))
    found = files.with_hints(files.discover(every), files.url_hints(every))
    return found.select("relative_path", F.col("file_kind").alias("found_kind"), F.col("source_url_hint").alias("url"))


_COLUMNS = [c.split()[0] for c in jsonl.CORPUS_COLUMNS.split(", ")]


@query("jsonl_roundtrip", f"SELECT {', '.join(_COLUMNS)} FROM corpus_row")
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The corpus written as JSON Lines and read back with strict keys."""
    kinds = dict(c.split() for c in jsonl.CORPUS_COLUMNS.split(", "))
    rows = table(spark, d, "corpus_row").select(*[F.col(c).cast(kinds[c]).alias(c) for c in _COLUMNS])
    path = f"{Stage(spark, 'jsonl').root}/corpus.jsonl"
    jsonl.write_jsonl(rows, path, [F.split("doc_id", "/"), "chunk_index"])
    return jsonl.read_jsonl(spark, path, jsonl.CORPUS_COLUMNS)


@query("block_flags", f"SELECT block_id, {_pieces('text')} AS n_tokens, count(*) OVER (PARTITION BY {_hash('text')}) > 1 AS repeated FROM doc_block WHERE text IS NOT NULL")
def block_flags(spark: SparkSession, d: str) -> DataFrame:
    """Size of every block, and whether its fingerprint occurs more than once."""
    return pipeline.flag_repeated(table(spark, d, "doc_block").where("text is not null")).select("block_id", "n_tokens", "repeated")


# ---- the LLM adapter, with a model that quotes


def _quoting_client() -> questions.ToolClient:
    """A stand-in for a model: it answers with the passage's beginning, one item that is none and one that lacks its answer."""

    def send(**request):
        message = request["messages"][0]["content"]
        section = message.split("\nSection: ", 1)[1].split("\nAt most ", 1)[0]
        passage = message.split("\n\nPassage:\n", 1)[1]
        if len(passage) % 7 == 0:
            raise questions.Refused(400)
        good = {"question": f" What does {section} say? ", "answer": passage[:24], "evidence_span": passage[:40], "answer_type": "extractive"}
        return {"content": [{"type": "text", "text": "Here."}, {"type": request["tool_choice"]["type"] + "_use", "name": questions.TOOL_NAME, "input": {"pairs": [good, "loose", good | {"answer": ""}]}}]}

    return questions.ToolClient(send)


@query(
    "llm_pairs",
    f"""WITH a AS (SELECT id, section_path, text, length(text) % 7 = 0 AS refused FROM {_ROWS_SQL} WHERE content_type = 'prose' AND NOT is_low_signal AND duplicate_of IS NULL AND text IS NOT NULL AND section_path IS NOT NULL)
    SELECT id, 0 AS ordinal, CASE WHEN NOT refused THEN 'What does ' || section_path || ' say?' END AS question, CASE WHEN NOT refused THEN trim(text[1:24], E' \\t\\r\\n') END AS answer,
      CASE WHEN NOT refused THEN text[1:40] END AS evidence_span, CASE WHEN NOT refused THEN 'extractive' END AS answer_type, CASE WHEN NOT refused THEN 'llm:quote' END AS generation_detail,
      CASE WHEN refused THEN 'Refused' END AS error FROM a""",
)
def llm_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of every prose chunk through the adapter; a chunk whose call is refused has its error instead."""
    rows = _rows(spark, d, "text", "content_type", "section_path", "is_low_signal", "duplicate_of", project=F.split("doc_id", "/")[1]).where("text is not null and section_path is not null")
    return questions.with_llm_pairs(rows, _quoting_client, "quote", 3)


# ---- the second stage as a whole


@query(
    "template_qa",
    f"""WITH j AS (SELECT t.*, r.doc_id, r.project, r.chunk_index, r.split, r.text AS chunk_text FROM ({_template_sql()}) t JOIN {_ROWS_SQL} r ON r.id = t.id WHERE r.duplicate_of IS NULL),
    k AS (SELECT *, coalesce(length({_collapse('evidence_span')}) > 0 AND contains({_collapse('chunk_text')}, {_collapse('evidence_span')}), false) AS evidence_verified,
            coalesce(length({_strip('question')}) BETWEEN 8 AND 300 AND length({_strip('answer')}) > 0, false) AS length_ok,
            row_number() OVER (PARTITION BY project, trim({_collapse('lower(question)')}, '¿?.! ') ORDER BY string_split(doc_id, '/'), chunk_index, ordinal) = 1 AS first_seen FROM j),
    i AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_index ORDER BY {_PRIO}, string_split(doc_id, '/'), chunk_index, ordinal) AS r FROM k WHERE evidence_verified AND length_ok AND first_seen),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY r, chunk_index) AS pick FROM i WHERE r <= 8 QUALIFY pick <= 8)
    SELECT id || '::qa' || (r - 1) AS qa_id, id, doc_id, split, question, answer, answer_type, pick FROM f""",
)
def template_qa(spark: SparkSession, d: str) -> DataFrame:
    """The stage from chunks to questions and answers, without a model: routing, templates, checks and the fair cap."""
    columns = ("doc_id", "project", "project_version", "source_path", "section_path", "chunk_index", "text", "split", "duplicate_of", "content_type", "is_low_signal")
    final = pipeline.build_qa(_rows(spark, d, *columns).where("text is not null"), 8)[1]
    return final.select("qa_id", "id", "doc_id", "split", "question", "answer", "answer_type", "pick")

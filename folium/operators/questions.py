"""Question/answer candidates from chunks: fixed templates for API text and tables, an LLM adapter for prose."""

from __future__ import annotations

import re
import sys
import time
from collections.abc import Callable, Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = "array<struct<question:string,answer:string,evidence_span:string,answer_type:string,generation_detail:string>>"

# Question wordings and the line grammar they read.
ASK = {
    "summary": "¿Qué hace el endpoint `{endpoint}`?",
    "parameter": "¿Qué tipo de dato tiene el parámetro `{name}` ({place}) del endpoint `{endpoint}`?",
    "parameter_enum": "¿Cuáles son los valores válidos para el parámetro `{name}` del endpoint `{endpoint}`?",
    "response": "¿Qué significa la respuesta HTTP {status} del endpoint `{endpoint}`?",
    "schema": "¿Qué tipo de dato es el schema `{schema}`?",
    "property": "¿Qué tipo de dato tiene el campo `{name}` del schema `{schema}`?",
    "property_enum": "¿Cuáles son los valores válidos para el campo `{name}` del schema `{schema}`?",
    "field": "¿Qué tipo de dato tiene `{name}` en {label}?",
    "code": "¿Qué significa el código `{name}` en {label}?",
    "row": "¿Qué información documenta {label} sobre `{name}`?",
    "label": "la tabla de `{name}`",
}
LINES = {
    "endpoint": r"^Endpoint: (?P<method>\S+) (?P<path>.+)$",
    "summary": r"^Summary: (?P<text>.+)$",
    "parameter": r"^  - (?P<name>\S+) \(in: (?P<place>\w+), type: (?P<type>\w+)\)(?: enum=(?P<enum>\[.*?\]))?(?P<required> \[required\])?: (?P<text>.*)$",
    "response": r"^  - (?P<status>\d{3}): (?P<text>.*)$",
    "schema": r"^Schema: (?P<schema>.+)$",
    "type": r"^Type: (?P<text>.+)$",
    "property": r"^  - (?P<name>\S+) \((?P<type>.+?)\)(?: enum=(?P<enum>\[.*?\]))?: (?P<text>.*)$",
}
GRAMMAR = {k: re.compile(v, re.M) for k, v in LINES.items()}
# Table headers by their role.
ROLES = {
    "id": {"field", "column", "parameter", "name", "alert"},
    "type": {"type"},
    "code": {"code", "status"},
    "description": {"description", "error", "descripcion", "descripción"},
}

Pair = tuple[str, str, str, str, str]


def _first_lines(kind: str, key: str, text: str) -> list[tuple[re.Match, str]]:
    """Matches of a grammar line, each with the first line of its key as evidence."""
    first: dict[str, str] = {}
    out = []
    for m in GRAMMAR[kind].finditer(text):
        out.append((m, first.setdefault(m[key], m[0])))
    return out


def operation_pairs(text: str) -> list[Pair]:
    """Pairs of an API operation: its summary, its parameters and their values, its responses."""
    head = GRAMMAR["endpoint"].search(text)
    if head is None:
        return []
    endpoint = f"{head['method']} {head['path']}"
    out: list[Pair] = []
    if summary := GRAMMAR["summary"].search(text):
        out.append((ASK["summary"].format(endpoint=endpoint), summary["text"].strip(), summary[0], "extractive", "openapi_operation_summary"))
    for m, line in _first_lines("parameter", "name", text):
        need = "requerido" if m["required"] else "opcional"
        question = ASK["parameter"].format(name=m["name"], place=m["place"], endpoint=endpoint)
        out.append((question, f"{m['type']} ({need}). {m['text']}".strip(), line, "extractive", "openapi_operation_parameter_type"))
        if m["enum"]:
            out.append((ASK["parameter_enum"].format(name=m["name"], endpoint=endpoint), m["enum"], line, "enum", "openapi_operation_parameter_enum"))
    for m, line in _first_lines("response", "status", text):
        out.append((ASK["response"].format(status=m["status"], endpoint=endpoint), m["text"].strip(), line, "extractive", "openapi_operation_response"))
    return out


def schema_pairs(text: str) -> list[Pair]:
    """Pairs of an API schema: its type, its properties and their values."""
    head = GRAMMAR["schema"].search(text)
    if head is None:
        return []
    schema = head["schema"].strip()
    out: list[Pair] = []
    if kind := GRAMMAR["type"].search(text):
        out.append((ASK["schema"].format(schema=schema), kind["text"].strip(), kind[0], "extractive", "openapi_schema_type"))
    for m, line in _first_lines("property", "name", text):
        described = ". ".join([m["type"], m["text"]]).strip(".").strip()
        answer = described + "." if m["text"] else described
        out.append((ASK["property"].format(name=m["name"], schema=schema), answer, line, "extractive", "openapi_schema_property_type"))
        if m["enum"]:
            out.append((ASK["property_enum"].format(name=m["name"], schema=schema), m["enum"], line, "enum", "openapi_schema_property_enum"))
    return out


def bare_name(cell: str) -> str:
    return cell.strip().strip("`").strip()


def read_table(text: str) -> tuple[list[str], list[list[str]]]:
    """Header and rows of a pipe table; the line after the header is its rule, uneven rows are left out."""
    cells = [[c.strip() for c in line.strip().strip("|").split("|")] for line in text.splitlines() if line.strip()[:1] == "|"]
    if len(cells) < 2:
        return [], []
    return cells[0], [row for row in cells[2:] if len(row) == len(cells[0])]


def tables(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, header, rows`` of every text that holds a pipe table."""
    wanted = df.select(df[key].alias("key"), df[text].alias("text")).where("contains(text, '|')")

    def run(batches):
        for b in batches:
            read = [(k, *read_table(t)) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            cols = list(zip(*[r for r in read if r[1]])) or [[]] * 3
            kinds = [b.schema.field(0).type, pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["key", "header", "rows"])

    return wanted.mapInArrow(run, f"key {dict(wanted.dtypes)['key']}, header array<string>, rows array<array<string>>")


def _row_line(text: str, row: list[str]) -> str | None:
    """The line of the text that holds a row, as written there."""
    rebuilt = f"| {' | '.join(row)} |"
    if rebuilt in text:
        return rebuilt
    filled = [c for c in row if c]
    return next((line for line in text.splitlines() if all(c in line for c in filled)), None)


def table_pairs(text: str, section_path: str) -> list[Pair]:
    """At most one pair per table row, by the roles of its columns."""
    header, rows = read_table(text)
    names = [h.lower() for h in header]
    role = {r: next((i for i, h in enumerate(names) if h in known), -1) for r, known in ROLES.items()}
    label = ASK["label"].format(name=bare_name(section_path.split(" > ")[-1]))
    out: list[Pair] = []
    for row in rows:
        line = _row_line(text, row)
        if line is None:
            continue
        cell = {r: row[i] if i >= 0 else "" for r, i in role.items()}
        if cell["id"] and cell["type"]:
            note = f" ({cell['description']})" if cell["description"] else ""
            out.append((ASK["field"].format(name=bare_name(cell["id"]), label=label), cell["type"] + note, line, "extractive", "table_field_type"))
        elif cell["code"] and cell["description"]:
            out.append((ASK["code"].format(name=bare_name(cell["code"]), label=label), cell["description"], line, "extractive", "table_code_description"))
        elif role["id"] >= 0:
            rest = "; ".join(f"{header[i]}: {v}" for i, v in enumerate(row) if v and i != role["id"])
            if rest:
                out.append((ASK["row"].format(name=bare_name(cell["id"]), label=label), rest, line, "extractive", "table_generic_row"))
    return out


def template_pairs(text: str | None, content_type: str | None, section_path: str | None) -> list[Pair]:
    """Pairs of one chunk by its type; none for prose and code."""
    if text and content_type == "api_spec":
        return operation_pairs(text) if "Endpoint:" in text else schema_pairs(text) if "Schema:" in text else []
    if text and content_type == "table":
        return table_pairs(text, section_path or "")
    return []


_KEYS = ("question", "answer", "evidence_span", "answer_type", "generation_detail")


def with_template_pairs(chunks: DataFrame) -> DataFrame:
    """Chunks (``id, text, content_type, section_path``, ...) with one row per template pair and its ``ordinal``."""
    wanted = chunks.select("id", "text", "content_type", "section_path").where("content_type in ('api_spec', 'table')")

    def run(batches):
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(4)))
            out = [(i, k, *p) for i, text, kind, path in rows for k, p in enumerate(template_pairs(text, kind, path))]
            cols = list(zip(*out)) or [[]] * 7
            kinds = [pa.string(), pa.int32(), *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "ordinal", *_KEYS])

    return wanted.mapInArrow(run, "id string, ordinal int, " + ", ".join(f"{k} string" for k in _KEYS))


# ---- LLM adapter

# The tool a model must call with its pairs, and the room it has for them.
TOOL_NAME = "submit_qa_pairs"
MAX_REPLY_TOKENS = 1536
ANSWER_TYPES = ["extractive", "generative", "numeric", "boolean"]
INSTRUCTIONS = (
    "Write question/answer pairs in the language of the passage. Use nothing but the passage. Quote, word for word, the part of it "
    "that proves each answer; leave out a pair that no quotation proves. Prefer concrete facts: limits, names, values, codes, conditions. "
    "If the passage has no facts worth asking for, return an empty list."
)


def llm_request(project: str, section_path: str, text: str, max_pairs: int, model: str) -> dict[str, Any]:
    """A request that forces the tool call, for clients that take one."""
    item = {k: {"type": "string"} for k in ("question", "answer", "evidence_span")} | {"answer_type": {"type": "string", "enum": ANSWER_TYPES}}
    pairs = {"type": "array", "items": {"type": "object", "properties": item, "required": list(item)}}
    tool = {"name": TOOL_NAME, "description": "Takes the pairs.", "input_schema": {"type": "object", "properties": {"pairs": pairs}, "required": ["pairs"]}}
    message = f"Project: {project}\nSection: {section_path}\nAt most {max_pairs} pairs.\n\nPassage:\n{text}"
    return {
        "model": model, "max_tokens": MAX_REPLY_TOKENS, "system": INSTRUCTIONS, "tools": [tool], "tool_choice": {"type": "tool", "name": TOOL_NAME},
        "messages": [{"role": "user", "content": message}],
    }

ATTEMPTS = 3
FIRST_WAIT = 2.0
RETRIED_STATUS = {429, 500, 502, 503, 529}


class Refused(Exception):
    """Raised by a client: ``status`` is the HTTP status, None for a lost connection."""

    def __init__(self, status: int | None):
        super().__init__(f"status {status}")
        self.status = status


def ask_with_retry(call: Callable[[], Any], wait: Callable[[float], None] = time.sleep) -> Any:
    """Call up to ``ATTEMPTS`` times; only lost connections and passing statuses are tried again."""
    for attempt in range(ATTEMPTS):
        try:
            return call()
        except Refused as e:
            passing = e.status is None or e.status in RETRIED_STATUS
            if not passing or attempt + 1 == ATTEMPTS:
                raise
            wait(FIRST_WAIT * 2**attempt)
    raise AssertionError("unreachable")


def usable_pairs(reply: Iterable[Any], model: str) -> list[Pair]:
    """Well-formed items of a reply: mappings with question, answer and evidence."""
    out: list[Pair] = []
    for item in reply or []:
        if isinstance(item, dict) and all(item.get(k) for k in ("question", "answer", "evidence_span")):
            kind = str(item.get("answer_type", "generative"))
            out.append((str(item["question"]).strip(), str(item["answer"]).strip(), str(item["evidence_span"]), kind, f"llm:{model}"))
    return out


def tool_pairs(reply: Any) -> list[Any]:
    """What the first tool call of a reply was given as pairs; nothing where no tool was called. A reply and its parts are objects or mappings."""

    def field(x: Any, name: str) -> Any:
        return x.get(name) if isinstance(x, dict) else getattr(x, name, None)

    call = next((p for p in field(reply, "content") or [] if field(p, "type") == "tool_use"), None)
    given = field(call, "input") if call is not None else None
    pairs = given.get("pairs") if isinstance(given, dict) else None
    return pairs if isinstance(pairs, list) else []


class ToolClient:
    """A client over a function that sends a request (``llm_request``'s keys as keywords) and returns the model's reply."""

    def __init__(self, send: Callable[..., Any]):
        self.send = send

    def submit(self, project: str, section_path: str, text: str, max_pairs: int, model: str) -> list[Any]:
        return tool_pairs(self.send(**llm_request(project, section_path, text, max_pairs, model)))


class MissingKey(Exception):
    """Raised by a client factory that finds no key."""


def usable_factory(factory: Callable[[], Any]) -> Callable[[], Any] | None:
    """The factory, or None with a warning where it finds no key: templates are asked all the same."""
    try:
        factory()
    except MissingKey as e:
        print(f"warning: no LLM client ({e}); only templates are asked", file=sys.stderr)
        return None
    return factory


def with_llm_pairs(chunks: DataFrame, client_factory: Callable[[], Any], model: str, max_pairs: int, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Prose chunks asked through an injected client, one client per task.

    ``client_factory()`` gives an object with ``submit(project, section_path, text, max_pairs, model)``
    that returns a list of mappings. A chunk whose call fails yields one row with ``error`` and no pair.
    Write the result to a table before using it: calls must not be repeated.
    """
    wanted = chunks.where("content_type = 'prose' and not is_low_signal and duplicate_of is null").select("id", "project", "section_path", "text")

    def run(batches):
        client = client_factory()
        for b in batches:
            out = []
            for i, project, path, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                try:
                    reply = ask_with_retry(lambda: client.submit(project, path, text, max_pairs, model), wait)
                    out += [(i, k, *p, None) for k, p in enumerate(usable_pairs(reply, model))]
                except Exception as e:  # one chunk's failure must not end the run
                    out.append((i, 0, None, None, None, None, None, type(e).__name__))
            cols = list(zip(*out)) or [[]] * 8
            kinds = [pa.string(), pa.int32(), *[pa.string()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "ordinal", *_KEYS, "error"])

    return wanted.mapInArrow(run, "id string, ordinal int, " + ", ".join(f"{k} string" for k in _KEYS) + ", error string")


def route(chunks: DataFrame) -> DataFrame:
    """Chunks with ``method``: template, llm or none; duplicates ask nothing, low signal keeps its templates."""
    kind = F.col("content_type")
    method = F.when(F.col("duplicate_of").isNotNull(), "none").when(kind.isin("table", "api_spec"), "template")
    method = method.when((kind == "prose") & ~F.coalesce(F.col("is_low_signal"), F.lit(False)), "llm").otherwise("none")
    return chunks.withColumn("method", method)

"""OpenAPI files as one section per operation and per schema, in a fixed line grammar."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import yaml
from pyspark.sql import DataFrame

from folium.operators.markdown import BLOCK_SCHEMA, blocks_batch

# Keys of a path that are operations, and the root of all section paths.
METHODS = {"get", "post", "put", "patch", "delete", "head", "options"}
ROOT = "swagger.yaml"


def target_name(ref: str) -> str:
    return ref.rstrip("/").split("/")[-1]


def follow(spec: Any, ref: str) -> Any:
    """What an inner reference points at; None for a broken or outer one."""
    if ref[:2] != "#/":
        return None
    for key in ref[2:].split("/"):
        spec = spec.get(key) if isinstance(spec, dict) else None
        if spec is None:
            return None
    return spec


def resolved(spec: dict, node: dict) -> dict | None:
    return follow(spec, node["$ref"]) if "$ref" in node else node


def _values(node: dict) -> str:
    return f" enum={node['enum']}" if node.get("enum") else ""


def _kind(node: dict, pointer: str) -> str:
    if node.get("type"):
        return node["type"]
    return pointer + target_name(node["$ref"]) if "$ref" in node else "object"


def body_lines(schema: dict, pad: str) -> Iterator[str]:
    """A request schema: a pointer, or its type and one level below it."""
    if "$ref" in schema:
        yield f"{pad}-> schema '{target_name(schema['$ref'])}' (ver chunk de schemas para el detalle completo)"
        return
    kind = schema.get("type", "object")
    yield f"{pad}type: {kind}"
    if kind == "array" and "items" in schema:
        yield from body_lines(schema["items"], pad + "  ")
    elif "properties" in schema:
        for name, prop in schema["properties"].items():
            yield f"{pad}  - {name} ({_kind(prop, '')}){_values(prop)}"
    elif "enum" in schema:
        yield f"{pad}  enum={schema['enum']}"


def operation_lines(spec: dict, path: str, method: str, op: dict) -> Iterator[str]:
    yield f"Endpoint: {method.upper()} {path}"
    for key, title in (("operationId", "Operation ID"), ("summary", "Summary"), ("description", "Description")):
        if op.get(key):
            yield f"{title}: {op[key]}"
    if op.get("parameters"):
        yield "Parameters:"
        for p in (resolved(spec, x) for x in op["parameters"]):
            if p is None:  # a broken reference
                continue
            schema = p.get("schema", {})
            need = " [required]" if p.get("required") else ""
            yield f"  - {p.get('name', '?')} (in: {p.get('in', '?')}, type: {schema.get('type', '?')}){_values(schema)}{need}: {p.get('description', '')}"
    if body := op.get("requestBody"):
        yield "Request body" + (" [required]" if body.get("required") else "") + ":"
        if body.get("description"):
            yield f"  {body['description']}"
        for media, content in body.get("content", {}).items():
            yield f"  content-type: {media}"
            yield from body_lines(content.get("schema", {}), "  ")
    if op.get("responses"):
        yield "Responses:"
        for status, node in op["responses"].items():
            if (r := resolved(spec, node)) is not None:
                yield f"  - {status}: {r.get('description', '')}"
    if op.get("security") is not None:
        yield f"Security: {op['security']}"


def schema_lines(name: str, schema: dict) -> Iterator[str]:
    yield f"Schema: {name}"
    yield f"Type: {schema.get('type', 'object')}"
    if schema.get("type") == "array" and "items" in schema:
        note = schema["items"].get("description", "")
        yield f"Items: {schema['items'].get('type', 'object')}" + (f" ({note})" if note else "")
    if schema.get("properties"):
        yield "Properties:"
        for prop, node in schema["properties"].items():
            yield f"  - {prop} ({_kind(node, '-> ')}){_values(node)}: {node.get('description', '')}"
    if schema.get("required"):
        yield f"Required: {schema['required']}"


def parse(text: str) -> list[dict]:
    """Blocks of an OpenAPI file: operations first, then schemas (``models`` override ``components``)."""
    spec = yaml.safe_load(text) or {}
    found: list[tuple[str, str, str]] = []
    for path, item in (spec.get("paths") or {}).items():
        for method, op in item.items() if isinstance(item, dict) else ():
            if method.lower() in METHODS and isinstance(op, dict):
                found.append(("paths", f"{method.upper()} {path}", "\n".join(operation_lines(spec, path, method, op))))
    schemas = {**((spec.get("components") or {}).get("schemas") or {}), **(spec.get("models") or {})}
    found += [("schemas", name, "\n".join(schema_lines(name, s))) for name, s in schemas.items() if isinstance(s, dict)]
    return [
        {"section_idx": i, "block_idx": 0, "heading": title, "level": 1, "section_path": [ROOT, part, title], "content_type": "api_spec", "text": body, "char_start": 0,
         "char_end": len(body)}
        for i, (part, title, body) in enumerate(found)
    ]


def openapi_blocks(files: DataFrame) -> DataFrame:
    """Blocks of OpenAPI files given as ``doc_id, text``."""

    def run(batches):
        for b in batches:
            yield blocks_batch([(d, parse(t)) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t])

    return files.select("doc_id", "text").mapInArrow(run, BLOCK_SCHEMA)

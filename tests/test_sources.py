import json
import os

import pytest
from pyspark.sql import functions as F

from folium import cli
from folium.operators import markdown, openapi, questions
from folium.plans import pipeline, reports
from folium.sources import files, jsonl, settings
from folium.streaming import ingest

PAGE = """Intro line before any title.

#Broken title

Some *text* here
over two lines.

| Field | Type | Description |
|-------|:----:|-------------|
| `id`  | int  | the key     |
| note  |      |             |

## Steps

1. first
   ```bash
   # not a title
   run
   ```
2. second

- a
- b

after the list

```json
{&#34;a&#34;: 1}
# still code
```

    indented code

---

<details><summary>More</summary>
inside <b>bold</b>
</details>

> quoted
> text

Under line
----------
[ref]: http://x
last
"""

SPEC = """
paths:
  /items/{id}:
    parameters: []
    get:
      operationId: getItem
      summary: Reads one
      parameters:
        - {$ref: '#/components/parameters/Id'}
        - {$ref: '#/components/parameters/Missing'}
        - {name: mode, in: query, required: true, description: How, schema: {type: string, enum: [A, B]}}
      requestBody: {required: true, content: {application/json: {schema: {$ref: '#/models/Item'}}}}
      responses:
        '200': {description: Found}
        default: {description: Else}
      security: []
components:
  parameters:
    Id: {name: id, in: path, schema: {type: integer}, description: Key}
  schemas:
    Item: {type: string}
models:
  Item:
    type: object
    required: [a]
    properties:
      a: {type: string, description: First, enum: [x]}
      b: {$ref: '#/models/Other'}
  Names: {type: array, items: {type: string, description: One}}
"""


def test_markdown_blocks():
    blocks = markdown.parse(markdown.normalize(PAGE), "page")
    got = [(b["content_type"], " > ".join(b["section_path"]), b["text"].split("\n")[0]) for b in blocks]
    assert got == [
        ("prose", "page", "Intro line before any title."),
        ("prose", "Broken title", "Some *text* here"),
        ("table", "Broken title", "| Field | Type | Description |"),
        ("prose", "Broken title > Steps", "1. first"),
        ("prose", "Broken title > Steps", "- a"),
        ("prose", "Broken title > Steps", "after the list"),
        ("code", "Broken title > Steps", "```json"),
        ("prose", "Broken title > Steps", "More inside bold"),
        ("prose", "Broken title > Steps", "> quoted"),
        ("prose", "Broken title > Under line", "last"),
    ]
    assert '{"a": 1}' in blocks[6]["text"] and blocks[0]["heading"] is None and blocks[0]["level"] == 0
    text = markdown.normalize(PAGE)
    assert all(text[b["char_start"] :].startswith(b["text"]) for b in blocks if "inside bold" not in b["text"])


def test_heading_stack_and_empty_pages():
    path = [b["section_path"] for b in markdown.parse("# A\n\n### C\n\nx\n\n## B\n\ny\n\n# D\n\nz", "p")]
    assert path == [["A", "C"], ["A", "B"], ["D"]]
    assert markdown.parse("# only a title", "p") == [] and markdown.parse("", "p") == []


def test_normalize_cases():
    assert markdown.normalize("```\n#no\n```\n##Yes") == "```\n#no\n```\n## Yes"
    assert markdown.normalize("&gt; stays") == "&gt; stays"
    diagram = "```mermaid\ngraph TD\nstyle a fill:#fff\na --> b\nstyle a fill:#fff\nstyle b x\n```"
    assert markdown.normalize(diagram).count("style a") == 1


def test_openapi_grammar():
    blocks = openapi.parse(SPEC)
    assert [b["heading"] for b in blocks] == ["GET /items/{id}", "Item", "Names"]
    assert blocks[0]["text"].split("\n") == [
        "Endpoint: GET /items/{id}", "Operation ID: getItem", "Summary: Reads one", "Parameters:", "  - id (in: path, type: integer): Key",
        "  - mode (in: query, type: string) enum=['A', 'B'] [required]: How", "Request body [required]:", "  content-type: application/json",
        "  -> schema 'Item' (ver chunk de schemas para el detalle completo)", "Responses:", "  - 200: Found", "  - default: Else", "Security: []",
    ]
    assert blocks[1]["text"].split("\n") == ["Schema: Item", "Type: object", "Properties:", "  - a (string) enum=['x']: First", "  - b (-> Other): ", "Required: ['a']"]
    assert blocks[2]["text"].split("\n") == ["Schema: Names", "Type: array", "Items: string (One)"]
    assert openapi.parse("") == []


def test_template_pairs():
    blocks = openapi.parse(SPEC)
    kinds = [p[4] for p in questions.template_pairs(blocks[0]["text"], "api_spec", "")]
    assert kinds == ["openapi_operation_summary", "openapi_operation_parameter_type", "openapi_operation_parameter_type", "openapi_operation_parameter_enum", "openapi_operation_response"]
    first = questions.template_pairs(blocks[0]["text"], "api_spec", "")
    assert first[1][1] == "integer (opcional). Key" and first[2][1] == "string (requerido). How" and first[3][1] == "['A', 'B']"
    schema = questions.template_pairs(blocks[1]["text"], "api_spec", "")
    assert [(p[1], p[4]) for p in schema] == [("object", "openapi_schema_type"), ("string. First.", "openapi_schema_property_type"), ("['x']", "openapi_schema_property_enum"), ("-> Other.", "openapi_schema_property_type")]
    table = "| Field | Type | Description |\n|---|---|---|\n| `id`   | int | key |\n| note | | |\n| bad | row |"
    pairs = questions.template_pairs(table, "table", "Top > `T`")
    assert pairs == [("¿Qué tipo de dato tiene `id` en la tabla de `T`?", "int (key)", "| `id`   | int | key |", "extractive", "table_field_type")]
    codes = questions.template_pairs("| Code | Error | Description |\n|--|--|--|\n| 404 | gone | x |", "table", "E")
    assert codes[0][1] == "gone" and codes[0][4] == "table_code_description"
    rows = questions.template_pairs("| Alert | When |\n|--|--|\n| A | now |", "table", "E")
    assert rows[0][1] == "When: now" and rows[0][4] == "table_generic_row"
    assert questions.template_pairs("x", "prose", "") == [] and questions.template_pairs(None, "table", None) == []


def test_retry_and_reply():
    waits, calls = [], []

    def call(statuses):
        def go():
            calls.append(1)
            s = statuses.pop(0)
            if s:
                raise questions.Refused(s if s > 0 else None)
            return "ok"

        return go

    assert questions.ask_with_retry(call([429, -1, 0]), waits.append) == "ok" and waits == [2.0, 4.0]
    with pytest.raises(questions.Refused):
        questions.ask_with_retry(call([400]), waits.append)
    calls.clear()
    with pytest.raises(questions.Refused):
        questions.ask_with_retry(call([429] * 5), waits.append)
    assert len(calls) == 3
    items = [{"question": " q ", "answer": "a", "evidence_span": "e"}, "x", {"question": "q", "answer": ""}, None]
    assert questions.usable_pairs(items, "m") == [("q", "a", "e", "generative", "llm:m")] and questions.usable_pairs(None, "m") == []


def test_llm_request_forces_the_tool():
    r = questions.llm_request("p", "A > B", "text", 3, "m")
    assert r["tool_choice"]["name"] == r["tools"][0]["name"] == "submit_qa_pairs" and r["max_tokens"] == 1536
    assert "A > B" in r["messages"][0]["content"] and "text" in r["messages"][0]["content"]


def test_replies_and_missing_keys(spark, capsys):
    sent = []

    class Block:
        type, input = "tool_use", {"pairs": [{"question": "q", "answer": "a", "evidence_span": "e"}, "loose"]}

    class Reply:
        content = [{"type": "text", "text": "x"}, Block()]

    client = questions.ToolClient(lambda **request: sent.append(request) or Reply())
    assert questions.usable_pairs(client.submit("p", "A > B", "text", 3, "m"), "m") == [("q", "a", "e", "generative", "llm:m")]
    assert sent[0]["model"] == "m" and sent[0]["tool_choice"]["name"] == questions.TOOL_NAME
    for reply in ({"content": [{"type": "text"}]}, {"content": None}, {"content": [{"type": "tool_use", "input": {"pairs": "no"}}]}, None, {"content": [{"type": "tool_use", "input": None}]}):
        assert questions.tool_pairs(reply) == []

    def no_key():
        raise questions.MissingKey("no key set")

    assert questions.usable_factory(no_key) is None and "no key set" in capsys.readouterr().err
    assert questions.usable_factory(FakeClient) is FakeClient


class FakeClient:
    def submit(self, project, section_path, text, max_pairs, model):
        if "boom" in text:
            raise ValueError("no")
        return [{"question": f"¿Qué dice {text[:20]}?", "answer": "eso", "evidence_span": text[:10], "answer_type": "extractive"}]


def test_llm_pairs_isolate_failures(spark):
    rows = [("a", "p", "s", "hello world text", "prose", False, None), ("b", "p", "s", "boom", "prose", False, None), ("c", "p", "s", "x", "prose", True, None), ("d", "p", "s", "x", "prose", False, "a")]
    df = spark.createDataFrame(rows, "id string, project string, section_path string, text string, content_type string, is_low_signal boolean, duplicate_of string")
    out = {r["id"]: (r["answer"], r["error"]) for r in questions.with_llm_pairs(df, FakeClient, "m", 3, lambda s: None).collect()}
    assert out == {"a": ("eso", None), "b": (None, "ValueError")}
    assert {r["id"]: r["method"] for r in questions.route(df).collect()} == {"a": "llm", "b": "llm", "c": "none", "d": "none"}


@pytest.fixture
def project(tmp_path):
    root = tmp_path / "docs_raw"
    guide = root / "alpha" / "latest" / "guide"
    guide.mkdir(parents=True)
    (guide / "a.md").write_bytes(PAGE.replace("\n", "\r\n").encode())
    (guide / "b.md").write_text("# Other\n\nover two lines.\n\nA longer paragraph that says what the service does with every order it receives.\n", encoding="utf-8")
    (guide / "_sidebar.md").write_text("nav", encoding="utf-8")
    (guide / "notes.txt").write_text("x", encoding="utf-8")
    specs = root / "alpha" / "latest" / "specs"
    specs.mkdir()
    (specs / "swagger.yaml").write_text(SPEC, encoding="utf-8")
    (root / "alpha" / "latest" / "documentationTypes.json").write_text(json.dumps({"guide": "http://g", "specifications": "http://s"}), encoding="utf-8")
    old = root / "alpha" / "0.1" / "guide"
    old.mkdir(parents=True)
    (old / "a.md").write_text("old", encoding="utf-8")
    beta = root / "beta" / "1.0"
    beta.mkdir(parents=True)
    (beta / "README.md").write_text("# Beta\n\nA longer paragraph that says what the service does with every order it receives.\n", encoding="utf-8")
    (beta / "documentationTypes.json").write_text("{broken", encoding="utf-8")
    config = tmp_path / "config.yaml"
    config.write_text(
        "canonical_sources: {projects: {alpha: {canonical: latest, reason: r}, beta: {canonical: '1.0'}}}\n"
        "pipeline:\n  chunking: {target_tokens: 40, max_tokens: 80, overlap_tokens: 10}\n  dedup: {near_duplicate_check: true, near_duplicate_threshold: 0.9}\n"
        "  split: {seed: 42, test_fraction: 0.2, val_fraction: 0.2}\n  qa: {max_pairs_per_document: 8, llm_model: m, enable_llm_judge: false}\n",
        encoding="utf-8",
    )
    return root, config


def test_settings(project, tmp_path):
    root, config = project
    assert settings.load_pipeline(config).chunking.step == 70
    assert {p: s.canonical_version for p, s in settings.load_sources(config, root).items()} == {"alpha": "latest", "beta": "1.0"}
    bad = tmp_path / "bad.yaml"
    bad.write_text(config.read_text().replace("overlap_tokens: 10", "overlap: 10"))
    with pytest.raises(TypeError):
        settings.load_pipeline(bad)
    bad.write_text(config.read_text().replace("'1.0'", "'9'"))
    with pytest.raises(FileNotFoundError, match="beta.*9"):
        settings.load_sources(bad, root)


def test_discovery_and_comparison(spark, project):
    root, config = project
    sources = settings.load_sources(config, root)
    listed = files.read_folders(spark, files.canonical_folders(sources), str(root))
    found = {r["relative_path"]: (r["file_kind"], r["source_url_hint"]) for r in files.with_hints(files.discover(listed), files.url_hints(listed)).collect()}
    assert found == {
        "docs_raw/alpha/latest/guide/a.md": ("markdown", "http://g"), "docs_raw/alpha/latest/guide/b.md": ("markdown", "http://g"),
        "docs_raw/alpha/latest/specs/swagger.yaml": ("openapi_spec", "http://s"), "docs_raw/beta/1.0/README.md": ("markdown", None),
    }
    a = spark.createDataFrame([("x", "1"), ("y", "1"), ("z", None)], "p string, d string")
    b = spark.createDataFrame([("x", "1"), ("y", "2"), ("w", "1")], "p string, d string")
    assert {r["path"]: r["status"] for r in files.compare(a, b, "p", "d").collect()} == {"x": "same", "y": "different", "z": "only_left", "w": "only_right"}


def test_corpus_and_questions_end_to_end(spark, project, tmp_path):
    root, config = project
    corpus, documents, pairs = pipeline.build_corpus(spark, settings.load_sources(config, root), str(root), settings.load_pipeline(config))
    rows = corpus.collect()
    assert {r["project"] for r in rows} == {"alpha", "beta"} and all(r["split"] in ("train", "val", "test") for r in rows)
    by_hash = {}
    for r in rows:
        by_hash.setdefault(r["content_hash_sha256"], set()).add(r["split"])
        assert r["id"] == f"{r['doc_id']}#{r['chunk_index']}" and r["heading"] == r["section_path"].split(" > ")[-1]
    assert all(len(v) == 1 for v in by_hash.values())
    twins = [r for r in rows if r["text"].startswith("A longer paragraph")]
    assert len(twins) == 2 and sum(r["duplicate_of"] is not None for r in twins) == 1
    checked, final, failed = pipeline.build_qa(corpus, 8, FakeClient, "m")
    assert failed.count() == 0
    qa = final.collect()
    assert qa and all(r["qc_passed"] for r in qa) and {r["generation_method"] for r in qa} == {"template", "llm"}
    texts, splits = {r["id"]: r["text"] for r in rows}, {r["id"]: r["split"] for r in rows}
    for r in qa:
        assert " ".join(r["evidence_span"].split()) in " ".join(texts[r["id"]].split()) and r["split"] == splits[r["id"]]
    assert len({r["qa_id"] for r in qa}) == len(qa)


def test_parity_and_hashed_pairs_and_errors(spark, project, monkeypatch, caplog):
    root, config = project
    sources, settings_ = settings.load_sources(config, root), settings.load_pipeline(config)
    with caplog.at_level("INFO", logger="folium"):
        corpus, documents, pairs = pipeline.build_corpus(spark, sources, str(root), settings_, parity=True)
    assert any(m.startswith("chunks: rows") for m in caplog.messages) and any("low_signal" in m for m in caplog.messages)
    monkeypatch.setattr(pipeline, "EXACT_VECTORS", 0)
    hashed = pipeline.build_corpus(spark, sources, str(root), settings_, count=lambda c: F.size(F.split(c, r"\s+")))[2]
    assert {(r["id_a"], r["id_b"]) for r in hashed.collect()} == {(r["id_a"], r["id_b"]) for r in pairs.collect()}

    class Broken(FakeClient):
        def submit(self, *args):
            raise ValueError("no")

    checked, final, failed = pipeline.build_qa(corpus, 8, Broken, "m")
    counted = {(r["counter"], r["value"]): r["n"] for r in reports.qc_counts(checked, final, failed).collect()}
    assert counted["llm_errors", "ValueError"] == failed.count() > 0 and ("candidates", "llm") not in counted


def test_cli_writes_reports(spark, project, tmp_path, capsys, monkeypatch):
    root, config = project
    out = tmp_path / "out"
    (tmp_path / "env").write_text("export FOLIUM_TEST_KEY='abc'\n# no\n", encoding="utf-8")
    monkeypatch.setenv("FOLIUM_TEST_KEY", "")
    monkeypatch.delenv("FOLIUM_TEST_KEY")
    base = ["--config", str(config), "--docs", str(root), "--env", str(tmp_path / "env")]
    cli.main([*base, "build-corpus", "--out-dir", str(out), "--single-file"])
    cli.main([*base, "build-qa", "--out-dir", str(out), "--no-llm"])
    cli.main([*base, "compare-versions"])
    manifest = json.loads((out / "manifest.json").read_text())
    assert manifest["chunks"] == sum(manifest["by_split"].values()) and manifest["projects"] == 2
    assert {p.name for p in out.iterdir()} >= {"corpus.jsonl", "qa.jsonl", "split_report.json", "dedup_report.json", "near_dedup_report.json", "qc_report.json"}
    printed = capsys.readouterr().out
    assert "'different': 1" in printed and "  different: guide/a.md" in printed and os.environ["FOLIUM_TEST_KEY"] == "abc"
    assert json.loads((out / "qc_report.json").read_text())["llm_errors"] == {}
    with pytest.raises(SystemExit):
        cli.main([*base, "build-qa", "--out-dir", str(tmp_path / "none")])


def test_jsonl_round_trip_and_strict_keys(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 1)], "k string, v int")
    jsonl.write_jsonl(df, str(tmp_path / "x"), ["k"], single_file=True)
    text = "".join(p.read_text() for p in (tmp_path / "x").glob("*.json"))
    assert text == '{"k":"a","v":1}\n{"k":"b","v":null}\n'
    assert sorted(jsonl.read_jsonl(spark, str(tmp_path / "x"), "k string, v int").collect()) == [("a", 1), ("b", None)]
    (tmp_path / "bad.json").write_text('{"k": "a"}\n\n', encoding="utf-8")
    with pytest.raises(Exception, match="unexpected keys"):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.json"), "k string, v int").collect()


def test_stream_drops_repeated_texts(spark, tmp_path):
    rows = spark.sql("select 'a' id, 'Same' text, timestamp'2025-01-01' ingested_at, 'p' project union all select 'b', ' same ', timestamp'2025-01-02', 'p' union all select 'c', 'x', timestamp'2025-01-02', 'p'")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.new_texts(spark, str(tmp_path / "in"), "id string, text string, ingested_at timestamp, project string")
    q = stream.writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("fresh").count() == 2
    counted = ingest.arrivals(spark.readStream.schema("id string, text string, ingested_at timestamp, project string").parquet(str(tmp_path / "in")))
    q = counted.writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("counted").agg(F.sum("n")).first()[0] == 3

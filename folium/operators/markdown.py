"""Markdown pages as sections and typed blocks.

A page is scanned line by line into top-level blocks: fences (code), pipe tables, HTML blocks, paragraphs,
lists and quotes (prose), headings. Indented code, rules, link definitions and empty blocks are left out.
Headings form a stack that gives each block its section path. Lines end at ``\\n``; offsets count
characters of the normalised text.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.functions.html_text import html_to_text

FENCE_OPEN = re.compile(r"^ {0,3}(`{3,}(?=[^`]*$)|~{3,})")
HEADING = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
RULE = re.compile(r"^ {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$")
UNDERLINE = re.compile(r"^ {0,3}(=+|-+)[ \t]*$")
BULLET = re.compile(r"^( {0,3})([-*+]|\d{1,9}[.)])([ \t]+|$)(.*)")
QUOTE = re.compile(r"^ {0,3}>")
TABLE_RULE = re.compile(r"^ {0,3}\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
LINK_DEFINITION = re.compile(r"^ {0,3}\[[^\]]+\]:[ \t]*\S+")
HTML_RAW = re.compile(r"^ {0,3}<(pre|script|style|textarea)(?=[\s>]|$)", re.I)
# Elements that begin an HTML block.
HTML_BLOCK_TAGS = (
    "address article aside base basefont blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frame frameset "
    "h1 h2 h3 h4 h5 h6 head header hr html iframe legend li link main menu menuitem nav noframes ol optgroup option p param search section summary table tbody td tfoot th thead "
    "title tr track ul"
).split()
HTML_BLOCK = re.compile(rf"^ {{0,3}}</?(?:{'|'.join(HTML_BLOCK_TAGS)})(?=[\s/>]|$)", re.I)
HTML_LONE = re.compile(r"^ {0,3}(?:<[A-Za-z][\w-]*(?:\s+[\w:.-]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?)*\s*/?>|</[A-Za-z][\w-]*\s*>)[ \t]*$")

BROKEN_HEADING = re.compile(r"^(#{1,6})(?=[^#\s])")
ANY_FENCE = re.compile(r"^(?:`{3,}|~{3,})")
CODE_BODY = re.compile(r"(?P<open>^```[^\n]*\n)(?P<body>.*?)(?P<close>\n```)", re.S | re.M)
DIAGRAM = re.compile(r"(?P<open>```mermaid\n)(?P<body>.*?)(?P<close>\n```)", re.S)


def normalize(text: str) -> str:
    """Repair broken headings outside fences, escaped entities in fences and repeated diagram styles."""
    fenced, lines = False, []
    for line in text.split("\n"):
        if ANY_FENCE.match(line.strip()):
            fenced = not fenced
        elif not fenced:
            line = BROKEN_HEADING.sub(r"\1 ", line)
        lines.append(line)
    text = CODE_BODY.sub(lambda m: m["open"] + html.unescape(m["body"]) + m["close"], "\n".join(lines))

    def once(m: re.Match) -> str:
        seen: set[str] = set()
        kept = [x for x in m["body"].split("\n") if not x.strip().startswith("style ") or not (x in seen or seen.add(x))]
        return m["open"] + "\n".join(kept) + m["close"]

    return DIAGRAM.sub(once, text)


def _cells(line: str) -> int:
    return len(line.strip().strip("|").split("|"))


class _Scanner:
    """Top-level blocks ``(kind, first line, line after, level, title)`` of a list of lines."""

    def __init__(self, lines: list[str]):
        self.lines, self.out = lines, []

    def blank(self, i: int) -> bool:
        return i >= len(self.lines) or not self.lines[i].strip()

    def interrupts(self, i: int) -> bool:
        """Whether line ``i`` begins a block that ends a paragraph."""
        line = self.lines[i]
        if HEADING.match(line) or FENCE_OPEN.match(line) or RULE.match(line) or QUOTE.match(line) or HTML_RAW.match(line) or HTML_BLOCK.match(line) or line.lstrip().startswith("<!--"):
            return True
        m = BULLET.match(line)
        return bool(m and m[4].strip() and (m[2] in "-*+" or m[2][:-1] == "1"))

    def fence(self, i: int) -> int:
        mark = FENCE_OPEN.match(self.lines[i])[1]
        close = re.compile(rf"^ {{0,3}}{re.escape(mark[0])}{{{len(mark)},}}[ \t]*$")
        j = i + 1
        while j < len(self.lines) and not close.match(self.lines[j]):
            j += 1
        return min(j + 1, len(self.lines))

    def until_blank(self, i: int) -> int:
        while not self.blank(i):
            i += 1
        return i

    def html_end(self, i: int) -> int | None:
        line = self.lines[i]
        raw = HTML_RAW.match(line)
        end = re.compile(rf"</{raw[1]}>", re.I) if raw else re.compile("-->") if line.lstrip().startswith("<!--") else None
        if end is not None:
            while i < len(self.lines) and not end.search(self.lines[i]):
                i += 1
            return min(i + 1, len(self.lines))
        return self.until_blank(i) if HTML_BLOCK.match(line) else None

    def list_end(self, i: int) -> int:
        m = BULLET.match(self.lines[i])
        ordered, indent = m[2] not in "-*+", len(m[1]) + len(m[2]) + 1
        kind = m[2] if not ordered else m[2][-1]
        j, fence = i + 1, None
        if (f := re.match(r"^\s*(`{3,}|~{3,})", m[4])) is not None:
            fence = f[1]
        while j < len(self.lines):
            line = self.lines[j]
            lead = len(line) - len(line.lstrip(" "))
            if fence is not None and (lead >= indent or not line.strip()):
                if line.strip().startswith(fence) and not line.strip().strip(fence[0]):
                    fence = None
                j += 1
                continue
            fence = None
            if self.blank(j):
                k = j
                while k < len(self.lines) and self.blank(k):
                    k += 1
                if k == len(self.lines) or not (self._in_list(k, indent, kind, ordered)):
                    return j
                j = k
                continue
            if self._in_list(j, indent, kind, ordered):
                if lead >= indent and (f := re.match(r"^\s*(`{3,}|~{3,})", line)) is not None:
                    fence = f[1]
            elif self.interrupts(j) or BULLET.match(line):
                return j
            j += 1
        return j

    def _in_list(self, j: int, indent: int, kind: str, ordered: bool) -> bool:
        line = self.lines[j]
        if len(line) - len(line.lstrip(" ")) >= indent:
            return True
        m = BULLET.match(line)
        return bool(m and not RULE.match(line) and ((m[2][-1] == kind and m[2] not in "-*+") if ordered else m[2] == kind))

    def scan(self) -> list[tuple[str, int, int, int, str]]:
        i, n = 0, len(self.lines)
        while i < n:
            line = self.lines[i]
            if self.blank(i):
                i += 1
            elif FENCE_OPEN.match(line):
                j = self.fence(i)
                self.out.append(("code", i, j, 0, ""))
                i = j
            elif m := HEADING.match(line):
                self.out.append(("heading", i, i + 1, len(m[1]), (m[2] or "").strip()))
                i += 1
            elif line.startswith("    ") or line.startswith("\t"):  # indented code
                while i < n and (self.blank(i) or self.lines[i].startswith(("    ", "\t"))):
                    i += 1
            elif RULE.match(line):
                i += 1
            elif QUOTE.match(line):
                j = i + 1
                while not self.blank(j) and (QUOTE.match(self.lines[j]) or not self.interrupts(j)):
                    j += 1
                self.out.append(("prose", i, j, 0, ""))
                i = j
            elif BULLET.match(line):
                j = self.list_end(i)
                self.out.append(("prose", i, j, 0, ""))
                i = j
            elif (j := self.html_end(i)) is not None or (HTML_LONE.match(line) and (j := self.until_blank(i))):
                self.out.append(("html", i, j, 0, ""))
                i = j
            elif "|" in line and i + 1 < n and "|" in self.lines[i + 1] + line and TABLE_RULE.match(self.lines[i + 1]) and "-" in self.lines[i + 1] and _cells(line) == _cells(self.lines[i + 1]):
                j = i + 2
                while not self.blank(j) and not self.interrupts(j):
                    j += 1
                self.out.append(("table", i, j, 0, ""))
                i = j
            elif LINK_DEFINITION.match(line):
                i += 1
            else:
                i = self.paragraph(i)
        return self.out

    def paragraph(self, i: int) -> int:
        j = i + 1
        while not self.blank(j):
            if m := UNDERLINE.match(self.lines[j]):
                title = " ".join(x.strip() for x in self.lines[i:j])
                self.out.append(("heading", i, j + 1, 1 if m[1][0] == "=" else 2, title))
                return j + 1
            if self.interrupts(j):
                break
            j += 1
        self.out.append(("prose", i, j, 0, ""))
        return j


def heading_title(title: str) -> str:
    return re.sub(r"\*\*(.+?)\*\*|__(.+?)__", lambda m: m[1] or m[2], title)


def line_starts(lines: list[str]) -> list[int]:
    """Offset of the first character of every line."""
    starts = [0]
    for line in lines[:-1]:
        starts.append(starts[-1] + len(line) + 1)
    return starts


def line_offsets(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line_no, char_start`` of every line of every non-null text, as the parser counts them."""
    rows = df.select(df[key].alias("key"), df[text].alias("text")).where("text is not null")

    def run(batches):
        for b in batches:
            starts = [line_starts(t.split("\n")) for t in b.column(1).to_pylist()]
            take = pa.array([i for i, s in enumerate(starts) for _ in s], pa.int64())
            numbers = pa.array([k for s in starts for k in range(len(s))], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), numbers, pa.array([x for s in starts for x in s], pa.int64())], names=["key", "line_no", "char_start"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, line_no int, char_start long")


def parse(text: str, stem: str) -> list[dict]:
    """Blocks of a page in order, with ``section_idx, heading, level, section_path, block_idx``."""
    lines = text.split("\n")
    starts = line_starts(lines)
    stack: list[tuple[int, str]] = []
    heading: str | None = None
    level, path, section, index, out = 0, [stem], 0, 0, []
    for kind, i, j, depth, title in _Scanner(lines).scan():
        if kind == "heading":
            heading, level = heading_title(title), depth
            stack = [x for x in stack if x[0] < depth] + [(depth, heading)]
            path, section, index = [t for _, t in stack], section + 1, 0
            continue
        raw = "\n".join(lines[i:j])
        body = (html_to_text(raw) if kind == "html" else raw).strip()
        if body:
            out.append(
                {"section_idx": section, "block_idx": index, "heading": heading, "level": level, "section_path": list(path), "content_type": "prose" if kind == "html" else kind,
                 "text": body, "char_start": starts[i], "char_end": starts[i] + len(body)}
            )
            index += 1
    return out


BLOCK_SCHEMA = (
    "doc_id string, section_idx int, block_idx int, heading string, level int, section_path array<string>, content_type string, text string, char_start int, char_end int"
)
_KINDS = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int32(), pa.int32()]
_NAMES = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]


def blocks_batch(docs: list[tuple[str, list[dict]]]) -> pa.RecordBatch:
    """An Arrow batch of the blocks of several documents."""
    rows = [{"doc_id": d, **b} for d, bs in docs for b in bs]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(_NAMES, _KINDS)], names=_NAMES)


def markdown_blocks(files: DataFrame) -> DataFrame:
    """Blocks of Markdown files given as ``doc_id, text``; the file's stem titles what precedes a heading."""
    rows = files.select("doc_id", F.regexp_replace("text", r"\r\n?", "\n").alias("text")).where("text is not null")

    def run(batches):
        for b in batches:
            docs = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                stem = d.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                docs.append((d, parse(normalize(t), stem)))
            yield blocks_batch(docs)

    return rows.mapInArrow(run, BLOCK_SCHEMA)

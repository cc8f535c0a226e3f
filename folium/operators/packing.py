"""Packing blocks into chunks, as ordered folds over a document.

Blocks have ``doc_id, section_idx, block_idx, content_type, text, char_start, char_end, n_tokens,
repeated`` (whether their fingerprint occurs more than once in the corpus), sections a ``section_path``.
A document's blocks meet once, in one Arrow group, and both folds are linear in them.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.functions.text import is_low_signal

#: Pieces of a text whose number is its size for packing: words and single symbols, with the blanks after them.
PIECE = r"(?U)(?:[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_])\s*"

# Unicode white space, as the pattern above means it.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = regex.compile(rf"(?:[\p{{L}}\p{{N}}_]+|[^{_BLANK}\p{{L}}\p{{N}}_])[{_BLANK}]*")


@dataclass(frozen=True)
class PackingConfig:
    target_tokens: int = 300
    max_tokens: int = 512
    overlap_tokens: int = 60

    @property
    def min_section_tokens(self) -> int:
        return max(1, self.target_tokens // 4)

    @property
    def step(self) -> int:
        return max(1, self.max_tokens - self.overlap_tokens)


def piece_count(text: str | Column) -> Column:
    """Size of a text for packing, at least 1."""
    c = F.col(text) if isinstance(text, str) else text
    return F.greatest(F.lit(1), F.regexp_count(c, F.lit(PIECE)))


def section_groups(sizes: list[int], api: list[bool], config: PackingConfig) -> list[int]:
    """Group of each section: a section below the least size waits for the next one; API sections stand alone, after what waits."""
    group, waiting, out = 0, 0, []
    for n, alone in zip(sizes, api):
        if alone:
            group += waiting > 0
            out.append(group)
            group, waiting = group + 1, 0
            continue
        out.append(group)
        waiting += n
        if waiting >= config.min_section_tokens:
            group, waiting = group + 1, 0
    return out


def block_parts(sizes: list[int], repeated: list[bool], config: PackingConfig) -> list[tuple[int, bool]]:
    """Part of each block of a group, and whether it is windowed. Blocks of one part form a chunk.

    A repeated block stands alone; one above the maximum is windowed; otherwise blocks are taken greedily up to the
    maximum, closing at the target. In a group of one block the size is looked at first, in larger groups repetition is.
    """
    part, held, out = 0, 0, []
    for n, again in zip(sizes, repeated):
        big = n > config.max_tokens
        if held and (again or big or held + n > config.max_tokens):
            part, held = part + 1, 0
        out.append((part, big and (len(sizes) == 1 or not again)))
        held += n
        if again or big or held >= config.target_tokens:
            part, held = part + 1, 0
    return out


def merge_sections(sections: DataFrame, config: PackingConfig) -> DataFrame:
    """``doc_id, section_idx, group_idx``: sections that are packed together share a group.

    ``sections`` has ``doc_id, section_idx, n_tokens, api`` (whether all its blocks are API text).
    """

    def fold(t: pa.Table) -> pa.Table:
        t = t.sort_by("section_idx")
        groups = section_groups(t.column("n_tokens").to_pylist(), t.column("api").to_pylist(), config)
        return pa.table([t.column("doc_id"), t.column("section_idx").cast(pa.int32()), pa.array(groups, pa.int32())], names=["doc_id", "section_idx", "group_idx"])

    kind = dict(sections.dtypes)["doc_id"]
    return sections.select("doc_id", "section_idx", "n_tokens", "api").groupBy("doc_id").applyInArrow(fold, f"doc_id {kind}, section_idx int, group_idx int")


def numbered(rows: DataFrame, doc: str, order: list[str]) -> DataFrame:
    """``rows`` with ``chunk_index``, their place in the document from 0, and ``n_chunks_in_doc``."""
    whole = Window.partitionBy(doc)
    return rows.withColumn("chunk_index", F.row_number().over(whole.orderBy(*order)) - 1).withColumn("n_chunks_in_doc", F.count("*").over(whole))


def cut_windows(text: str, config: PackingConfig) -> list[tuple[str, int]]:
    """Text and size of each window of a text: windows of the maximum size, each beginning a step after the last."""
    pieces = PIECES.findall(text)
    count = 1 + max(0, -(-(len(pieces) - config.max_tokens) // config.step))
    parts = [pieces[i * config.step : i * config.step + config.max_tokens] for i in range(count)]
    return [("".join(p).strip(" \t\r\n"), len(p)) for p in parts]


def token_windows(df: DataFrame, key: str, text: str, config: PackingConfig = PackingConfig()) -> DataFrame:
    """``key, window, n_tokens, text`` of every window of every non-null text."""
    rows = df.select(df[key].alias("key"), df[text].alias("text")).where("text is not null")

    def run(batches):
        for b in batches:
            cut = [cut_windows(t, config) for t in b.column(1).to_pylist()]
            take = pa.array([i for i, ws in enumerate(cut) for _ in ws], pa.int64())
            flat = [(k, n, t) for ws in cut for k, (t, n) in enumerate(ws)]
            cols = list(zip(*flat)) or [[]] * 3
            arrays = [b.column(0).take(take), *[pa.array(c, kind) for c, kind in zip(cols, (pa.int32(), pa.int32(), pa.string()))]]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "window", "n_tokens", "text"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, window int, n_tokens int, text string")


_CHUNK = [("section_idx", pa.int32()), ("text", pa.string()), ("n_tokens", pa.int64()), ("content_type", pa.string()), ("char_start", pa.int64()), ("char_end", pa.int64()), ("n_blocks", pa.int32())]


def document_chunks(blocks: list[dict], config: PackingConfig) -> list[dict]:
    """Chunks of one document's blocks in order; ``n_blocks`` is 0 for a window."""
    sections: dict[int, list[dict]] = {}
    for b in sorted(blocks, key=lambda b: (b["section_idx"], b["block_idx"])):
        sections.setdefault(b["section_idx"], []).append(b)
    groups = section_groups([sum(b["n_tokens"] for b in bs) for bs in sections.values()], [all(b["content_type"] == "api_spec" for b in bs) for bs in sections.values()], config)
    grouped: dict[int, list[dict]] = {}
    for g, bs in zip(groups, sections.values()):
        grouped.setdefault(g, []).extend(bs)
    out = []
    for bs in grouped.values():
        path = bs[-1]["section_idx"]
        parts: dict[int, list[dict]] = {}
        windowed = set()
        for b, (part, cut) in zip(bs, block_parts([b["n_tokens"] for b in bs], [b["repeated"] for b in bs], config)):
            parts.setdefault(part, []).append(b)
            if cut:
                windowed.add(part)
        for part, members in parts.items():
            starts, ends = ([b[k] for b in members if b[k] is not None] for k in ("char_start", "char_end"))
            longest = max(members, key=lambda b: len(b["text"]))  # the first of the longest
            row = {"section_idx": path, "content_type": longest["content_type"], "char_start": min(starts, default=None), "char_end": max(ends, default=None)}
            if part in windowed:
                out += [row | {"text": t, "n_tokens": n, "n_blocks": 0} for t, n in cut_windows(members[0]["text"], config)]
            else:
                out.append(row | {"text": "\n\n".join(b["text"] for b in members), "n_tokens": sum(b["n_tokens"] for b in members), "n_blocks": len(members)})
    return out


def chunks(blocks: DataFrame, config: PackingConfig = PackingConfig()) -> DataFrame:
    """Chunks of every document: ``doc_id, chunk_index, n_chunks_in_doc, section_idx, text, n_tokens,
    content_type, char_start, char_end, is_low_signal``. ``section_idx`` is the section whose path the chunk has.

    One shuffle by document, and both folds in one pass over its blocks.
    """
    kinds = dict(blocks.dtypes)

    def pack(t: pa.Table) -> pa.Table:
        rows = document_chunks(t.to_pylist(), config)
        n = len(rows)
        arrays = [pa.array([t.column("doc_id")[0].as_py()] * n, t.schema.field("doc_id").type), pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int64())]
        arrays += [pa.array([r[name] for r in rows], kind) for name, kind in _CHUNK]
        return pa.table(arrays, names=["doc_id", "chunk_index", "n_chunks_in_doc", *[name for name, _ in _CHUNK]])

    wanted = blocks.select("doc_id", "section_idx", "block_idx", "content_type", "text", F.col("char_start").cast("long"), F.col("char_end").cast("long"), F.col("n_tokens").cast("long"), "repeated")
    schema = f"doc_id {kinds['doc_id']}, chunk_index int, n_chunks_in_doc long, section_idx int, text string, n_tokens long, content_type string, char_start long, char_end long, n_blocks int"
    packed = wanted.groupBy("doc_id").applyInArrow(pack, schema)
    low = (F.col("n_blocks") > 0) & is_low_signal("n_tokens", "text", F.col("n_blocks") == 1)
    return packed.withColumn("is_low_signal", low).drop("n_blocks")

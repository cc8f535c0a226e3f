"""One consistent form for texts that look the same but differ in their characters.

Method: a batch of Arrow texts becomes one numpy array of code points. A lookup table gives each code
point its replacement (none, one or several), laid out by expansion offsets: invisible characters go,
all kinds of blanks become a space, full-width forms and ligatures become plain letters, precomposed
letters fall apart into base and marks, and look-alike letters of other scripts become Latin ones.
Words that hold a letter found in one other script only are then turned back wholly into that script,
so real Cyrillic or Greek text stays readable. Marks are put in canonical order and composed with
their bases, again by table gathers. No step calls a string method per row.

The form depends only on what is visible: it is computed from the look-alike skeleton, so two texts
that look the same get the same form. Case, accents, digits, words and the number of blanks remain.

Null texts stay null and belong to no pair; empty texts stay empty.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folium.functions.codepoints import Points, from_arrow, slices, to_arrow
from folium.runtime import Stage, join_unique

# Letters of other scripts that are drawn like a Latin letter.
CYRILLIC_LIKE_LATIN = "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX аa еe ѕs іi јj оo рp сc уy хx һh ԁd ԛq ԝw ѵv ӏl ӀI ԚQ ԜW ԌG"
GREEK_LIKE_LATIN = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ρp υu ιi αa ϲc ϳj ϹC ͿJ"
ARMENIAN_LIKE_LATIN = "օo ոn սu հh ցg զq ՕO ՍU ՏS"
CHEROKEE_LIKE_LATIN = "ᎪA ᏴB ᏟC ᎠD ᎬE ᏀG ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᎡR ᏚS ᎢT ᏙV ᎳW ᏃZ"
# Other characters drawn like a plain one.
PLAIN_LIKE = "ıi ɡg ɑa −- ʼ'"
# Characters that take no visible room.
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0xFEFF, *range(0xFE00, 0xFE10)]
# Compatibility kinds whose characters look like their plain spelling.
SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<font>", "<noBreak>")

CYRILLIC, GREEK, LATIN, ARMENIAN, CHEROKEE = 1, 2, 4, 8, 16
SCRIPT_NAMES = {"CYRILLIC": CYRILLIC, "GREEK": GREEK, "LATIN": LATIN, "ARMENIAN": ARMENIAN, "CHEROKEE": CHEROKEE}
LIKE_LATIN = {CYRILLIC: CYRILLIC_LIKE_LATIN, GREEK: GREEK_LIKE_LATIN, ARMENIAN: ARMENIAN_LIKE_LATIN, CHEROKEE: CHEROKEE_LIKE_LATIN}


def _spell(cp: int) -> str:
    """The plain spelling of one code point, with letters decomposed."""
    ch = chr(cp)
    d = unicodedata.decomposition(ch)
    if d.startswith("<"):
        kind, *parts = d.split()
        if kind not in SAME_LOOK or parts[0] == "0020" or cp == 0x17F:
            return ch
        return "".join(_spell(int(x, 16)) for x in parts)
    return "".join(_spell(int(x, 16)) for x in d.split()) if d else ch


@dataclass
class Tables:
    offset: np.ndarray
    length: np.ndarray
    pool: np.ndarray
    ccc: np.ndarray
    letter: np.ndarray
    script: np.ndarray
    back: dict[int, np.ndarray]
    pair_key: np.ndarray
    pair_value: np.ndarray


@lru_cache(maxsize=1)
def tables() -> Tables:
    size = 0x110000
    by_script = {p[0]: p[1] for pairs in LIKE_LATIN.values() for p in pairs.split()}
    like = by_script | {p[0]: p[1] for p in PLAIN_LIKE.split()}
    gone = set(INVISIBLE)
    length = np.ones(size, np.int64)
    special: dict[int, list[int]] = {}
    letter = np.zeros(size, bool)
    ccc = np.zeros(size, np.uint8)
    script = np.zeros(size, np.uint8)
    pairs: dict[int, int] = {}
    for cp in range(size):
        if 0xD800 <= cp < 0xE000 or 0xAC00 <= cp < 0xD7A4:  # Hangul keeps its syllables
            continue
        ch = chr(cp)
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Co"):
            continue
        if cat[0] == "L" or cat[0] == "M":
            letter[cp] = True
            ccc[cp] = unicodedata.combining(ch)
            script[cp] = SCRIPT_NAMES.get(unicodedata.name(ch, "").split(" ")[0], 0)
        if cp in gone:
            special[cp] = []
        elif cat == "Zs":
            special[cp] = [32]
        elif cp in (0x2010, 0x2011):
            special[cp] = [45]
        else:
            s = "".join(like.get(c, c) for c in _spell(cp))
            if s != ch:
                special[cp] = [ord(c) for c in s]
        d = unicodedata.decomposition(ch)
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", ch) == ch:
            a, b = (int(x, 16) for x in d.split())
            pairs[(a << 21) | b] = cp
    for latin in by_script.values():
        script[ord(latin)] = 0
    pool = np.arange(size, dtype=np.uint32)
    extra = np.array([c for v in special.values() for c in v], np.uint32)
    offset = np.arange(size, dtype=np.int64)
    at = size
    for cp, v in special.items():
        offset[cp], length[cp] = at, len(v)
        at += len(v)
    back = {}
    for which, table in LIKE_LATIN.items():
        m = np.arange(size, dtype=np.uint32)
        for p in reversed(table.split()):  # of two letters like one the first in the list is given back
            m[ord(p[1])] = ord(p[0])
        back[which] = m
    key = np.array(sorted(pairs), np.int64)
    return Tables(offset, length, np.concatenate([pool, extra]), ccc, letter, script, back, key, np.array([pairs[k] for k in key.tolist()], np.uint32))


def _expand(p: Points, t: Tables) -> Points:
    size = t.length[p.cps]
    total = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(t.offset[p.cps] - total[:-1], size) + np.arange(int(total[-1]))
    return Points(t.pool[where], total[p.off], p.null)


def _restore_scripts(p: Points, t: Tables) -> np.ndarray:
    """Code points with look-alike letters given back to the script of their word, or of their text."""
    cps = p.cps
    if not len(cps) or cps.max() < 0x370:
        return cps
    is_letter = t.letter[cps]
    before = np.concatenate([[False], is_letter[:-1]])
    before[p.off[:-1][p.lengths > 0]] = False
    start = np.flatnonzero(is_letter & ~before)
    if not len(start):
        return cps
    kind = np.where(is_letter, t.script[cps], 0)
    has = np.bitwise_or.reduceat(kind, start)
    row = np.searchsorted(p.off, start, "right") - 1
    n = len(p.off) - 1
    votes = {s: np.bincount(row, weights=has == s, minlength=n) for s in SCRIPT_NAMES.values() if s == LATIN or (has & s).any()}
    word_script = has.copy()
    open_words = has == 0
    others = [s for s in votes if s != LATIN]
    for s in others:
        wins = votes[s] > votes[LATIN]
        for o in others:
            wins &= votes[s] >= votes[o]
        word_script[open_words & wins[row]] = s
    word = np.cumsum(is_letter & ~before) - 1
    out = cps.copy()
    for s in others:
        if (word_script == s).any():
            pick = is_letter & (word >= 0)
            pick[pick] = word_script[word[pick]] == s
            out[pick] = t.back[s][out[pick]]
    return out


def _order_marks(cps: np.ndarray, off: np.ndarray, t: Tables) -> np.ndarray:
    """Canonical order of successive marks, by odd-even exchanges until nothing moves."""
    if not len(cps) or cps.max() < 0x300:
        return cps
    out = cps.copy()
    inner = np.ones(len(out), bool)
    inner[off[:-1][np.diff(off) > 0]] = False
    while True:
        c = t.ccc[out]
        swap = np.flatnonzero((c[:-1] > c[1:]) & (c[1:] > 0) & inner[1:])
        if not len(swap):
            return out
        swap = swap[np.concatenate([[True], np.diff(swap) > 1])]
        out[swap], out[swap + 1] = out[swap + 1], out[swap]


def _compose(p: Points, t: Tables) -> Points:
    while len(p.cps):
        c = t.ccc[p.cps]
        marks = np.flatnonzero(c > 0)
        if not len(marks):
            break
        first = p.off[np.searchsorted(p.off, marks, "right") - 1]
        starters = np.where(c == 0, np.arange(len(c)), -1)
        base = np.maximum.accumulate(starters)[marks]
        prev = np.maximum(marks - 1, 0)
        ok = (base >= first) & ((base == marks - 1) | (c[prev] < c[marks]))
        marks, base = marks[ok], base[ok]
        key = (p.cps[base].astype(np.int64) << 21) | p.cps[marks]
        at = np.minimum(np.searchsorted(t.pair_key, key), len(t.pair_key) - 1)
        hit = t.pair_key[at] == key
        marks, base, at = marks[hit], base[hit], at[hit]
        if not len(marks):
            break
        lone = np.concatenate([[True], np.diff(base) > 0])  # one mark per base in each pass
        marks, base, at = marks[lone], base[lone], at[lone]
        cps = p.cps.copy()
        cps[base] = t.pair_value[at]
        keep = np.ones(len(cps), bool)
        keep[marks] = False
        total = np.concatenate([[0], np.cumsum(keep)])
        p = Points(cps[keep], total[p.off], p.null)
    return p


def canonical(col: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The consistent form of every text of an Arrow string column."""
    t = tables()
    p = _expand(from_arrow(col), t)
    cps = _order_marks(_restore_scripts(p, t), p.off, t)
    return to_arrow(_compose(Points(cps, p.off, p.null), t))


def with_canonical_text(df: DataFrame, text: str = "text", out: str = "canonical_text") -> DataFrame:
    """``df`` with the consistent form of ``text`` in column ``out``; other columns pass through unchanged."""
    if out in df.columns:
        raise ValueError(f"column {out} exists already")
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        for b in (x for whole in batches for x in slices(whole, at)):
            arrays = [*b.columns, canonical(b.column(at))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, out])

    return df.mapInArrow(run, schema)


def lookalike_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, form, spelling, n_spellings``: the class of texts that look like the row's, its own spelling, and the class's spellings.

    The compact form of ``lookalike_pairs``: one row per key and text, whatever the size of a class. Null keys or texts belong to none.
    """
    members = _members(df, key, text)
    classes = members.select("form", "raw").distinct().groupBy("form").agg(F.count("*").alias("n_spellings"))
    return join_unique(members, classes, "form").select(F.col("k").alias("key"), "form", F.col("raw").alias("spelling"), "n_spellings")


def _members(df: DataFrame, key: str, text: str) -> DataFrame:
    """Written distinct ``k, raw, form``: a key, and digests of its text and of the text's form."""
    rows = df.select(df[key].alias("k"), df[text].alias("t")).where("k is not null and t is not null")
    forms = with_canonical_text(rows, "t", "c").select("k", F.md5("t").alias("raw"), F.md5("c").alias("form"))
    return Stage(df.sparkSession, "lookalike").put(forms.distinct())


def lookalike_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs (``a`` < ``b``) of keys whose texts look the same and differ in their characters.

    Each class of equal texts is met once: the classes of one visible form are paired with each other
    and only then expanded to their keys, so copies of one text are never compared with each other.
    Repeated rows count once; null keys or texts belong to no pair.
    """
    members = _members(df, key, text)
    classes = members.select("form", "raw").distinct()
    pairs = (
        classes.alias("x")
        .join(classes.alias("y"), "form")
        .where(F.col("x.raw") < F.col("y.raw"))
        .select(F.col("x.raw").alias("ra"), F.col("y.raw").alias("rb"))
    )
    left = members.select(F.col("raw").alias("ra"), F.col("k").alias("ka"))
    right = members.select(F.col("raw").alias("rb"), F.col("k").alias("kb"))
    out = pairs.join(left, "ra").join(right, "rb").where("ka <> kb")
    return out.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b")).distinct()

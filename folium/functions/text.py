"""Text functions as JVM-side column expressions.

White space means Unicode white space and the four ASCII separators; case-insensitive patterns are
Unicode-aware and ``^``/``$`` know ``\\n`` alone as a line end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Function words whose hits vote for a language.
SPANISH_WORDS = (
    "el la los las de del para con una uno unos unas es son que por se su sus "
    "como pero más esta están cada todos todas debe deben así también sin entre"
).split()
ENGLISH_WORDS = (
    "the and for with this that are is of to in on by be as from will can should "
    "must when not have has"
).split()
# A whole text that only holds a place.
PLACEHOLDER = r"(?i)^_?(to\s*do|tbd|todo|pendiente|n/a)_?\.?$"
# Fixed value: fewer tokens than this are a low signal.
LOW_SIGNAL_TOKENS = 12


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_spaces(c: str | Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.btrim(F.regexp_replace(_col(c), r"(?U)[\s\x1c-\x1f]+", " "))


def strip(c: str | Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def casefold(c: str | Column) -> Column:
    """Lower case with sharp s spelled out."""
    return F.replace(F.lower(_col(c)), F.lit("ß"), F.lit("ss"))


def fingerprint(c: str | Column) -> Column:
    """SHA-256 of the text after collapsing white space and folding case."""
    return F.sha2(casefold(collapse_spaces(c)), 256)


def normal_question(c: str | Column) -> Column:
    """A question as compared with others: lower case, single blanks, without outer question marks and stops."""
    return F.btrim(collapse_spaces(F.lower(_col(c))), F.lit("¿?.! "))


def is_placeholder(c: str | Column) -> Column:
    return strip(c).rlike(PLACEHOLDER)


def is_low_signal(n_tokens: str | Column, text: str | Column, single_block: Column | bool = True) -> Column:
    """Too few tokens, or a single block that only holds a place."""
    lone = F.lit(single_block) if isinstance(single_block, bool) else single_block
    return (_col(n_tokens) < LOW_SIGNAL_TOKENS) | (lone & is_placeholder(text))


def language_vote(c: str | Column) -> Column:
    """``es`` or ``en``, whichever has more function words; ``unknown`` on a tie."""

    def hits(words: list[str]) -> Column:
        return F.regexp_count(_col(c), F.lit(rf"(?iu)(?U)\b({'|'.join(words)})\b"))

    es, en = hits(SPANISH_WORDS), hits(ENGLISH_WORDS)
    return F.when(es > en, "es").when(en > es, "en").otherwise("unknown")


def clean_heading(c: str | Column) -> Column:
    """A heading without double-star or double-underscore emphasis."""
    return F.regexp_replace(_col(c), r"\*\*(.+?)\*\*|__(.+?)__", "$1$2")


def path_text(path: str | Column) -> Column:
    """A section path as ``A > B > C``."""
    return F.array_join(_col(path), " > ")


def contains_evidence(text: str | Column, evidence: str | Column) -> Column:
    """Whether the evidence, with white space collapsed, is literally in the text; false for blank evidence."""
    e = collapse_spaces(evidence)
    return F.coalesce((F.length(e) > 0) & F.contains(collapse_spaces(text), e), F.lit(False))


def length_ok(question: str | Column, answer: str | Column, least: int = 8, most: int = 300) -> Column:
    """A question of ``least`` to ``most`` characters and an answer that is not blank."""
    q, a = F.length(strip(question)), F.length(strip(answer))
    return F.coalesce(q.between(least, most) & (a > 0), F.lit(False))

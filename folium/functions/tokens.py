"""Token rule T as a JVM-side column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folium.functions.codepoints import TOKEN_PATTERN


def token_count(col: str | Column) -> Column:
    """Number of tokens of a text: runs of letters and digits, and single other symbols; null for null."""
    return F.regexp_count(F.col(col) if isinstance(col, str) else col, F.lit(TOKEN_PATTERN))

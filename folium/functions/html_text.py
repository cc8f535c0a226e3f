"""Text of an HTML fragment: its strings, stripped, joined by blanks; comments, scripts and styles are left out."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

SILENT = {"script", "style", "template"}


class _Strings(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.run: list[str] = []
        self.silent = 0

    def flush(self) -> None:
        s = "".join(self.run).strip()
        if s:
            self.parts.append(s)
        self.run = []

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        if tag in SILENT and self.silent:
            self.silent -= 1

    def handle_comment(self, data):
        self.flush()

    def handle_data(self, data):
        if not self.silent:
            self.run.append(data)


def html_to_text(fragment: str | None) -> str | None:
    if fragment is None:
        return None
    p = _Strings()
    p.feed(fragment)
    p.close()
    p.flush()
    return " ".join(p.parts)


@pandas_udf(StringType())
def _html_text(s: pd.Series) -> pd.Series:
    return s.map(html_to_text)


def html_text(c: Column) -> Column:
    return _html_text(c)

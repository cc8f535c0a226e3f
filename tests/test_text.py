import hashlib

import pytest
from pyspark.sql import functions as F

from folium.functions import text as tx
from folium.functions.html_text import html_text, html_to_text
from folium.functions.tokens import token_count


def one(spark, values, *cols):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [tuple(r) for r in df.select(*cols).collect()]


def test_fingerprint_ignores_case_and_spacing(spark):
    got = [r[0] for r in one(spark, ["Hola  Mundo", " hola mundo\n", "Straße", "STRASSE", "hola mundos", None], tx.fingerprint("t"))]
    assert got[0] == got[1] == hashlib.sha256(b"hola mundo").hexdigest()
    assert got[2] == got[3] and got[4] != got[0] and got[5] is None


def test_language_vote_and_tie(spark):
    got = [r[0] for r in one(spark, ["el perro y la casa de MÁS", "the dog of a man", "la the", "", "12 | 34"], tx.language_vote("t"))]
    assert got == ["es", "en", "unknown", "unknown", "unknown"]


@pytest.mark.parametrize("text,expected", [("TO DO.", True), ("_pendiente_", True), ("N/A", True), ("tbd.", True), ("to do it now", False), ("", False)])
def test_placeholder(spark, text, expected):
    assert one(spark, [text], tx.is_placeholder("t"))[0][0] is expected


def test_question_heading_backticks_path(spark):
    assert one(spark, ["¿Qué  es X? "], tx.normal_question("t"))[0][0] == "qué es x"
    assert one(spark, ["**Bold** and __more__ *one*"], tx.clean_heading("t"))[0][0] == "Bold and more *one*"
    assert one(spark, ["x"], tx.path_text(F.array(F.lit("A"), F.lit("B"))))[0][0] == "A > B"


def test_evidence_and_length(spark):
    rows = [("the  max\nis 5", "max is 5"), ("the max is 5", "Max is 5"), ("abc", "  "), ("abc", None), (None, "a")]
    df = spark.createDataFrame(rows, "t string, e string")
    assert [r[0] for r in df.select(tx.contains_evidence("t", "e")).collect()] == [True, False, False, False, False]
    rows = [("¿Qué es?", "sí"), ("¿Qué?", "sí"), ("x" * 301, "sí"), ("¿Qué es?", "  "), (None, "a")]
    df = spark.createDataFrame(rows, "q string, a string")
    assert [r[0] for r in df.select(tx.length_ok("q", "a")).collect()] == [True, False, False, False, False]


def test_token_rule(spark):
    assert [r[0] for r in one(spark, ["a_b c1, ñandú!", "", None, " "], token_count("t"))] == [7, 0, None, 1]


def test_html_text(spark):
    html = "<p>Hola <b>a</b>&amp;b</p><!-- x --><script>no()</script><ul><li> uno </li></ul>"
    assert html_to_text(html) == "Hola a &b uno"
    assert one(spark, [html, None], html_text(F.col("t"))) == [("Hola a &b uno",), (None,)]

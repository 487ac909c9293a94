"""The single-pass rules against the plain ones, and single-pass they must be."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import wikitext

PIECES = {
    "templates": ["{", "{{", "}", "}}", "a", "\n"],
    "file links": ["[[", "[", "File:", "Image:", "]", "]]", "a", "\n"],
    "piped links": ["[[", "[", "|", "]", "]]", "a", "\n"],
    "simple links": ["[[", "[", "|", "]", "]]", "a", "\n"],
    "comments": ["<!--", "<!-->", "-->", "-", ">", "a", "\n"],
    "labelled external links": ["[", "http://", "https://", "[http://", " ", "]", "a", "\n"],
    "bare external links": ["[", "http://", "https://", "[http://", " ", "]", "a", "\n"],
    "headings": ["=", "==", " ", "\n", "a", "b"],
    "paired references": ["<ref", ">", "</ref>", "<ref>", "a", "\n", "/", "<"],
    "closed references": ["<ref", "/>", "/ >", ">", "<ref>", "a", "\n", "/", " "],
    "tags": ["<", ">", "<>", "a", "\n", "/"],
    "whitespace": [" ", "\n", "a", "\t", " ", " "],
}


@pytest.mark.parametrize("name", list(PIECES))
def test_linear_form_equals_plain_rule(spark, name):
    random.seed(name)
    plain, replacement = next((p, r) for n, p, r in wikitext.RULES if n == name)
    texts = ["".join(random.choices(PIECES[name], k=random.randint(1, 14))) for _ in range(20_000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for row in frame.select("t", wikitext.apply_rule(F.col("t"), name).alias("s")).collect():
        assert row.s == re.sub(plain, replacement, row.t), repr(row.t)


def plain_strip(text: str) -> str:
    for _, pattern, replacement in wikitext.RULES:
        text = re.sub(pattern, replacement, text)
    return text.strip()


def test_whole_chain_on_random_markup(spark):
    random.seed(5)
    pieces = sorted({p for parts in PIECES.values() for p in parts} | {"'''", "''", "é", "漢", "\u0085", " "})
    texts = ["".join(random.choices(pieces, k=random.randint(0, 40))) for _ in range(20_000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i BIGINT, t STRING")
    got = {r.i: r.s for r in frame.select("i", wikitext.strip_markup(F.col("t")).alias("s")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == plain_strip(text), repr(text)


@pytest.mark.parametrize(
    "markup, expected",
    [
        ("{{a|b={{c}}}} x", "}} x"),
        ("[[File:a.png|thumb|x]] y", "y"),
        ("[[Target|label]] [[Plain]]", "label Plain"),
        ("'''bold''' ''it''", "bold it"),
        ("a<!-- x -->b <!-- two\nlines -->c", "ab c"),
        ("[http://e.org label] [https://e.org]", "label"),
        ("== Heading ==\ntext", "Heading text"),
        ("a<ref name=x>cite</ref>b<ref name=y />c", "abc"),
        ("a<br/>b<span\nclass=x>c</span>", "abc"),
        (" a \t\n  b ", "a b"),
        ("", ""),
        ("{{open [[open <open", "{{open [[open <open"),
    ],
)
def test_examples(spark, markup, expected):
    row = spark.createDataFrame([(markup,)], "t STRING").select(wikitext.strip_markup(F.col("t"))).first()
    assert row[0] == expected


@pytest.mark.parametrize(
    "opening", ["{{", "[[", "[[File:", "[[a|", "<!--", "[http://", "[http://x ", "<ref>", "<ref ", "<", "= ", " "]
)
def test_unfinished_markup_is_read_once(spark, opening):
    """A backtracking form needs minutes for these."""
    start = time.time()
    row = spark.range(1).select(F.length(wikitext.strip_markup(F.repeat(F.lit(opening), 40_000)))).first()
    assert row[0] is not None
    assert time.time() - start < 8

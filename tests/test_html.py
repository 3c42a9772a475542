"""HTML to text: literal expectations."""

import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from vellum.functions.html import html_to_text

CASES = [
    ("<p>One</p><p>Two</p>", "One\n\nTwo"),
    ("k<br>l<br/>m", "k\nl\nm"),
    ("<div>q</div>\n\n\n\n<div>r</div>", "q\n\nr"),
    ("<ol><li>a<li>b</ol>", "a\nb"),
    ("<!-- gone --><i>kept</i> &amp; &lt;this&gt;", "kept & <this>"),
    ("<table><tr><td>7</td><td>8</td></tr></table>", "78"),
    ("<SCRIPT>if (a<b) {'</p>'}</SCRIPT><p>z</p>", "if (a<b) {'</p>'}\nz"),
    ("<style>p>a{}</style >t", "p>a{}t"),
    ("1 < 2 and 4 > 3", "1 < 2 and 4 > 3"),
    ("x <!-- y <p> --> z", "x  z"),
    ("&#233; &#xE9; &#0; &#128; &#x110000;", "é é \ufffd € \ufffd"),
    ("&copy2024 &AMP; &notin; &unknown;", "©2024 & ∉ &unknown;"),
    ("<a href='m>n'>link</a>", "link"),
    ("", ""),
]


@pytest.mark.parametrize("html,text", CASES)
def test_html_to_text(spark, html, text):
    got = spark.createDataFrame([(html,)], "h string").select(html_to_text(F.col("h")).alias("t")).first().t
    assert got == text


NESTED = [
    ("a<!-- <script>x()</script> -->b", "ab"),
    ("a<!--[if IE]><script>x()</script><style>p{}</style><![endif]-->b", "ab"),
    ("<script>'<!--'; x()</script>b<!-- c -->d", "'<!--'; x()bd"),
    ("<a title=don't>hello it's</a> end", "hello it's end"),
    ("<a title='x>y' b=\"it's\">l</a>", "l"),
    ("<a href=q?x=\"1>m</a>", "m"),
    ("a<!-- never closed <p>b</p>", "a"),
    ("a<script>never closed <p>b</p>", "a"),
    ("a<style>p{} <script>x()</script>", "a"),
    ("a<script src='s.js'/>b", "ab"),
    ("<p title=\"<!--\">a</p>--><p>b", "a\n-->\nb"),
]


@pytest.mark.parametrize("html,text", NESTED)
def test_markup_inside_markup(spark, html, text):
    got = spark.createDataFrame([(html,)], "h string").select(html_to_text(F.col("h")).alias("t")).first().t
    assert got == text


class Collector(HTMLParser):
    """Character data, and a line break for each tag of the rule."""

    def __init__(self):
        super().__init__()
        self.out = ""

    def handle_data(self, data):
        self.out += data

    def handle_starttag(self, tag, attrs):
        self.out += "\n" * (tag in ("br", "p", "div", "li", "tr"))

    def handle_endtag(self, tag):
        self.out += "\n" * (tag in ("p", "div", "li", "tr"))


def parsed(html):
    parser = Collector()
    parser.feed(html)
    return re.sub("\n{3,}", "\n\n", parser.out).strip()


BITS = ["<p>", "</p>", "<p/>", "<div/>", "<li />", "<tr a='x'/>", "<p a=b/>", "<br>", "<br/>", "<p a='>'>", "</ p>", "</p >", "<b>", "</b>",
        "<!-- c -->", "<!-- <p> -->", "<script>", "</script>", "<style/>", "a", "b c", " & ", "&lt", "&lt;", "&amp;", "&T", "<", " < ", ">",
        "\n", "é", "<P/>", "<div class=x/>", "</div/>", "<p /a>", "<p/ >", "<x-p/>", "&#65", "&#65;", "<a title=don't>it's</a>", "\ufdd0", "\xa0"]


def test_random_texts_against_the_parser(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 9))) + rng.choice(["", "<br>"]) for _ in range(4000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, h string").select("k", html_to_text(F.col("h")).alias("t")).collect()
    wrong = [(texts[r.k], r.t, parsed(texts[r.k])) for r in rows if r.t != parsed(texts[r.k])]
    assert not wrong, wrong[:5]

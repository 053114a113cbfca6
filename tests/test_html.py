"""Text of the first element with a class."""

import random

import pytest
from pyspark.sql import functions as F

from feedlake.functions.html import class_text, parsed_text_of_class, plain_text_of_class, text_of_class

CASES = [
    ('<div class="d"><p>One.&nbsp;</p></div>', "One."),
    ('<div class="d">Two <b>b</b>, c</div>', "Two b , c"),
    ('<div class="a d b">in  side</div><div class="d">second</div>', "in  side"),
    ('<div class="dd">no</div>', ""),
    ('<div id="d">no</div>', ""),
    ("", ""),
    (None, ""),
    ('<div class="d"><div>x</div>y</div>z', "x y"),
    ('<div class="d">a &amp; b &lt;c&gt;</div>', "a & b <c>"),
    ('<div class="d">a<script>var d="</div>";</script>b<style>p{}</style></div>c', "a b"),
    ('<div class="d">a<!-- no -->b</div>', "a b"),
    ('<div class="d">a<br>b<br/>c<img src="x">d</div>e', "a b c d"),
    ('<p class="d"><b>open<br>more', "open more"),
    ('<div><p class="d">ends with its parent</div>after', "ends with its parent"),
    ('<img class="d">after', ""),
    ("<div class='d'>single quotes</div>", "single quotes"),
    ("<div class=d>no quotes</div>", "no quotes"),
    ('<DIV CLASS="d">upper</DIV>x', "upper"),
    ('<div class="D">case counts</div>', ""),
    ('<div class="d"></p>stray end</div>x', "stray end"),
    ('<!-- <div class="d">no</div> --><div class="d">yes</div>', "yes"),
    ('<div class="d"><template>t</template><ruby>k<rt>r</rt></ruby></div>', "k"),
    ('<div class="d"><div/>x</div>y', "x"),
    ('<div class="d">1 < 2</div>', "1 < 2"),
    ('<div class="&#100;">escaped class</div>', "escaped class"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_rules(page, want):
    assert text_of_class(page, "d") == want


def test_as_column(spark):
    rows = spark.createDataFrame(enumerate(c[0] for c in CASES), "i int, page string")
    got = rows.select("i", class_text(F.col("page"), "d").alias("out")).orderBy("i").collect()
    assert [r.out for r in got] == [c[1] for c in CASES]
    folded = spark.createDataFrame([('<b class="d">ﬁne\xa0①</b>',)], "page string")
    assert folded.select(class_text(F.col("page"), "d", fold=True)).first()[0] == "fine 1"


PIECES = [
    "<div>", "</div>", "<p>", "</p>", "<b>", "</b>", '<div class="w">', '<p class="a w b">', "<br>", "<br/>",
    "text", " x ", "\xa0", "&nbsp;", "&amp;", "&", "<", ">", " a < b ", "<!-- c -->", "<!-->", "<!-- a -- b -->",
    "<script>", "</script>", "<style>", "</style>", "<template>", "</template>", "<rt>", "</rt>", "<div class='w'>",
    '<DIV CLASS="w">', '<i id="x" class="w" class="z">', '<i data-class="w">', "<i class=w>", "<p/>", "</br>",
    '<a href="u?a=1&amp;b=2">', "</a>", "<![CDATA[ q ]]>", "<?pi?>", "<!DOCTYPE html>", '</p class="w">',
    '<i class="&#119;">', '"', "'", "<title>", "</title>", '<i\nclass="w">', "<o:p>", "<my-tag>",
]


def test_plain_path_agrees_with_parser():
    random.seed(7)
    plain = 0
    for _ in range(40_000):
        pieces = PIECES if random.random() < 0.3 else PIECES[:20]
        page = "".join(random.choice(pieces) for _ in range(random.randint(1, 12)))
        quick = plain_text_of_class(page, "w")
        if quick is not None:
            plain += 1
            assert quick == parsed_text_of_class(page, "w"), page
    assert plain > 5_000


def test_pages_against_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in pages.select("html", class_text(F.col("html"), "ad").alias("out")).collect():
        assert row.out == parsed_text_of_class(row.html, "ad")

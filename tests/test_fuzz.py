"""Random texts and markup: expressions against the exact rules in Python."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.functions import tree

MARKUP = [
    "<", ">", "</", "/>", "<b>", "</b>", '<p class="x">', "<p class=x>", "<a title='y>z'>", "</a>",
    '<span class="visually-hidden">', '<span class="a visually-hidden b" id="q">', "hashtag",
    "</span>", "<span>", "<br>", "<br/>", "<!--", "-->", "<!-- c -->", "<!doctype html>", "<?pi?>",
    "<![CDATA[k]]>", "<script>", "</script>", "<style>x{}</style>", "<title>", "</title>",
    "<title>t</title>", "<textarea>", "</textarea>", "&amp;", "&lt;", "&nbsp;", "&copy;", "&copy",
    "&#39;", "&#x41;", "&foo;", "&", "a", "bc", " ", "  ", "\n", "\t", " ", " ", '"', "'",
    "=", "visually-hidden", "#tag", "\x01", "<li>", "</li>", '<IMG SRC="a">', '<x y=z"w>',
    "<template>", "</template>", "!", "-", "é", '<SPAN CLASS="visually-hidden">',
    '<span  class = "visually-hidden">', '<i class="visually-hidden">', "</i>",
]
WORDS = ["#", "##", "#a", "#b,", "a#b", " ", "  ", "\n", " ", " ", "\x1c", "x", "É", "•"]


def texts(parts, n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(parts, k=rnd.randrange(1, 14))) for _ in range(n)]


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string").repartition(8)


@pytest.mark.parametrize("compact", [False, True])
def test_cleaners(spark, compact):
    values = texts(MARKUP, 8000, seed=compact)
    got = fn.with_clean_text(column(spark, values), "v", "out", compact).collect()

    def rule(html):
        root = tree.parse(html)
        return tree.compact_text(root) if compact else tree.spaced_text(root, "visually-hidden", "hashtag")

    assert [r.v for r in got if r.out != rule(r.v)] == []
    assert len(got) == 8000


def test_plain_text(spark):
    got = column(spark, texts(WORDS, 8000, seed=5)).select(
        "v",
        fn.squeeze("v").alias("squeezed"),
        fn.strip("v").alias("stripped"),
        fn.hashtags("v").alias("tags"),
        fn.format_description("v").alias("formatted"),
        fn.contains_all_terms("v", "#a x").alias("found"),
    )
    for r in got.collect():
        words = r.v.split()
        tags = list(dict.fromkeys(w for w in words if w.startswith("#") and w.strip("#")))
        assert (r.squeezed, r.stripped, r.tags) == (" ".join(words), r.v.strip(), tags)
        assert r.formatted == " ".join(words + ["#" + t for t in tags])
        assert r.found == ("x" in r.v.lower() and "#a" in r.v.lower().split())


def test_tree_keeps_every_character(spark):
    html = F.concat(F.lit("<p>"), F.regexp_replace("v", "[<>&\x01]", ""), F.lit("</p>"))
    df = column(spark, texts(WORDS, 2000, seed=9)).withColumn("h", html)
    assert df.where(~fn.clean_html("h", "tree").eqNullSafe(fn.squeeze("v"))).count() == 0

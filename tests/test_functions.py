import math
import random
import re

import pytest
from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.functions import tree


def evaluate(spark, values, build):
    """Apply ``build`` to each value and return the results in input order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").repartition(4)
    got = {r.i: r.out for r in df.select("i", build(F.col("v")).alias("out")).collect()}
    return [got[i] for i in range(len(values))]


AGES = {
    "5m": 5,
    "3h": 180,
    "3h • Edited • ": 180,
    "  7m": 7,
    " 9m •": 9,
    "\x1c4m": 4,
    "5m •\nEdited": 5,
    "2mo •": 2,
    "99999999999999999999h": 6e21,
    "1d": math.inf,
    "1w": math.inf,
    "N/A": math.inf,
    "": math.inf,
    "12 m": math.inf,
    "5M": math.inf,
    "• 5m": math.inf,
    "now": math.inf,
    "٣h": 180,
    "१२m": 12,
    "0m": 0,
    "23h •": 1380,
    "•\n5m": math.inf,
    "•5m\n": math.inf,
    "6m\n•": 6,
    "7 • 5m": math.inf,
    "\n8h": 480,
}


def test_age_minutes(spark):
    assert evaluate(spark, list(AGES), fn.age_minutes) == list(AGES.values())


def test_age_minutes_matches_the_rule(spark):
    """The rule step by step: cut at the bullet, strip, read the prefix."""

    def rule(label):
        found = re.match(r"(\d+)([mh])", re.sub(r"•.*$", "", label).strip())
        return math.inf if not found else float(found[1]) * (60 if found[2] == "h" else 1)

    rnd = random.Random(3)
    labels = ["".join(rnd.choices("12٣mhd •\n\u00a0", k=rnd.randrange(9))) for _ in range(3000)]
    assert evaluate(spark, labels, fn.age_minutes) == [rule(label) for label in labels]


def test_age_minutes_of_missing_label(spark):
    assert evaluate(spark, [None], fn.age_minutes) == [math.inf]


def test_age_strict_units(spark):
    got = evaluate(spark, ["2mo •", "2m •", "3h", "3hr"], lambda c: fn.age_minutes(c, True))
    assert got == [math.inf, 2, 180, math.inf]


def test_age_label_reads_back(spark):
    rows = spark.sql(
        "select timestamp '2024-01-02 00:00:00' t, timestamp '2024-01-02 00:59:59' a union all "
        "select timestamp '2024-01-02 00:00:00', timestamp '2024-01-02 05:30:00' union all "
        "select timestamp '2024-01-02 00:00:00', timestamp '2024-01-04 05:30:00'"
    ).select(fn.age_label("t", F.col("a"), F.lit(True)).alias("l"))
    got = rows.select("l", fn.age_minutes("l").alias("m")).collect()
    assert sorted((r.l, r.m) for r in got) == [
        ("2d • Edited • ", math.inf),
        ("59m • Edited • ", 59.0),
        ("5h • Edited • ", 300.0),
    ]


SPACES = [
    "x  y\n\tz",
    "  a   b　",
    "\x1ca\x1fb\x0bc",
    "plain text here",
    " a​b ",
    "",
    "  \u0085   ",
]


def test_strip_and_squeeze_match_python(spark):
    assert evaluate(spark, SPACES, fn.strip) == [s.strip() for s in SPACES]
    assert evaluate(spark, SPACES, fn.squeeze) == [" ".join(s.split()) for s in SPACES]


SPACED = {
    "a<b>b</b> c": "a b c",
    '<span class="visually-hidden">hashtag</span><span>#</span>tag': "# tag",
    '<span class="a visually-hidden"><b>hashtag</b></span>k': "k",
    '<span class="visually-hidden"> hashtag </span>x': "hashtag x",
    '<span class="visually-hidden">Hashtag</span>x': "Hashtag x",
    '<span class="visually-hiddenish">hashtag</span>x': "hashtag x",
    '<i class="visually-hidden">hashtag</i>x': "hashtag x",
    "x  y\n\tz": "x y z",
    "hi&amp;bye<br>x": "hi&bye x",
    'a<!-- z --><script>var t="</p>";</script>d': "a d",
    "a < b and c > d": "a < b and c > d",
    '<a title="x > y">k</a>z': "k z",
    "<a title=it's>k</a> don't": "k don't",
    "&lt;b&gt;&nbsp;&amp;copy;": "<b> &copy;",
    "caf&eacute; &#8364; &#x41;": "café € A",
    "AT&T &ampx": "AT&T &x",
    "open <b": "open <b",
    "<ul><li>a<li>b</ul>c": "a b c",
    "<p>one</p></div><p>two": "one two",
    "x<br/>y<hr>z": "x y z",
    "a</i>b</div>c": "a b c",
    "one<!-- note -->two": "one two",
    '<span class="visually-hidden">hashtag<!-- x --></span>y': "hashtag y",
    '<span class="visually-hidden"> <b>hashtag</b></span>y': "hashtag y",
    "<SPAN CLASS=\"visually-hidden\">hashtag</SPAN >y": "y",
    "<span class='visually-hidden'>hashtag</span>y": "y",
    '<span title="visually-hidden">hashtag</span>visually-hidden': "hashtag visually-hidden",
    "a\u0001b<i>c</i>": "a\u0001b c",
    "": "",
}


@pytest.mark.parametrize("path", ["auto", "tree"])
def test_clean_html(spark, path):
    got = evaluate(spark, list(SPACED), lambda c: fn.clean_html(c, path))
    assert dict(zip(SPACED, got)) == SPACED


def test_paths_agree_on_broken_markup(spark):
    broken = [
        "a<!-- never closed <i>x</i>",
        "a<script>b<i>c</i>",
        "<p a='1>x</p><i>k</i>",
        "<!doctype html><?pi x?>y<![CDATA[z]]>",
        "</>a</ b><i/>c",
        "<title>a <b> c</title>d",
        "x<a href=y?a=1&b=2>z</a>",
    ]
    assert evaluate(spark, broken, fn.clean_html) == evaluate(
        spark, broken, lambda c: fn.clean_html(c, "tree")
    )


def test_many_stray_brackets_are_read_in_one_go(spark):
    text = "a < " * 50_000
    assert evaluate(spark, [text], lambda c: fn.clean_html(c, "tree")) == [text.strip()]


COMPACT = {
    "a<b>b</b> c": "abc",
    '<span class="visually-hidden">hashtag</span><span>#</span>tag': "hashtag#tag",
    '<span class="a visually-hidden"><b>hashtag</b></span>k': "hashtagk",
    '<span class="visually-hidden"> hashtag </span>x': "hashtagx",
    "x  y\n\tz": "x  y\n\tz",
    "hi&amp;bye<br>x": "hi&byex",
    'a<!-- z --><script>var t="</p>";</script>d': "ad",
    " a  <i>  b c </i>\n<br> <br> d ": "ab cd",
    "caf&eacute; <b>x</b>": "caféx",
}


@pytest.mark.parametrize("path", ["auto", "tree", "native"])
def test_clean_html_compact(spark, path):
    cases = dict(COMPACT)
    if path == "native":
        cases.pop("caf&eacute; <b>x</b>")
    got = evaluate(spark, list(cases), lambda c: fn.clean_html_compact(c, path))
    assert dict(zip(cases, got)) == cases


@pytest.mark.parametrize("compact", [False, True])
def test_with_clean_text(spark, compact):
    cases = COMPACT if compact else SPACED
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    cleaned = fn.with_clean_text(df, "html", "text", compact)
    assert cleaned.columns == ["html", "text"]
    assert {r.html: r.text for r in cleaned.collect()} == cases


def test_text_is_cleaned_once(spark, capsys):
    df = spark.createDataFrame([("a",)], "html string")
    text = fn.with_clean_text(df, "html", "text").where("text like '%a%' and text <> 'b'")
    text.explain()
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("regexp_replace(") == 2


def test_cleaners_agree_on_whole_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for cleaner in (fn.clean_html, fn.clean_html_compact):
        both = pages.select(
            cleaner("html", "native").alias("n"),
            cleaner("html", "tree").alias("t"),
            cleaner("html").alias("a"),
        )
        assert both.where("n <> t or a <> t or n is null").count() == 0


TAGGED = {
    "we #a need #a ##b # #c, x#d #": (["#a", "##b", "#c,"], " ##a ###b ##c,"),
    "no tags": ([], ""),
    "#x #y\n#x": (["#x", "#y"], " ##x ##y"),
    "## ### #": ([], ""),
    "#a#b ##a## (#c)": (["#a#b", "##a##"], " ##a#b ###a##"),
    "": ([], ""),
}


def test_hashtags_and_format(spark):
    texts = list(TAGGED)
    assert evaluate(spark, texts, fn.hashtags) == [tags for tags, _ in TAGGED.values()]
    want = [(" ".join(t.split()) + tail).strip() for t, (_, tail) in TAGGED.items()]
    assert evaluate(spark, texts, fn.format_description) == want


def test_hashtags_match_the_word_rule(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = [t + " #" + re.sub(r"\W", "", t[:5]) + " #b #b" for t in texts]

    def rule(text):
        words = [w for w in text.split() if w.startswith("#") and w.strip("#")]
        return list(dict.fromkeys(words))

    assert evaluate(spark, texts, fn.hashtags) == [rule(t) for t in texts]


def test_contains_all_terms(spark):
    texts = ["Hiring for #ServiceNow now", "hiring #servicenow,", "for hiring #servicenow", "x", None]
    got = evaluate(spark, texts, lambda c: fn.contains_all_terms(c, "hiring for #servicenow"))
    assert got == [True, False, True, False, None]


def test_links(spark):
    cases = [
        ("https://a.example/x/y?q=1", "/in/me", "https://a.example/in/me"),
        ("https://a.example/x/y?q=1", "z", "https://a.example/x/z"),
        ("https://a.example/x/y?q=1", "../z", "https://a.example/z"),
        ("https://a.example/x/y?q=1", "//b.example/k", "https://b.example/k"),
        ("https://a.example/x/y?q=1", "http://c.example/p?x=1", "http://c.example/p?x=1"),
        ("https://a.example/x/y?q=1", "#top", "https://a.example/x/y?q=1#top"),
        ("https://a.example/x/y?q=1", "?page=2", "https://a.example/x/y?page=2"),
        ("https://a.example/x/y?q=1", "/a/./b/../c", "https://a.example/a/c"),
        ("https://a.example/x/y?q=1", None, None),
    ]
    df = spark.createDataFrame(cases, "base string, href string, want string")
    assert df.where(~fn.absolute_url("base", "href").eqNullSafe(F.col("want"))).count() == 0
    html = ['<p><a name="n">x</a><a class="k" href="/in/a&amp;b">y</a>', "<p>no link</p>",
            "<a href='/q'>z</a>", "<abbr href=\"/no\">z</abbr>", "<a href=foo>x</a>",
            '<!-- <a href="/hid"> --><a href="/shown">x</a>', '<a href="/q?a=1&#38;b=2">x</a>',
            '<b title="x>y"></b><a data-x="1>2" href="/k">x</a>', '<b title="<a href=\'/t\'>"></b><A HREF="/u">x</A>',
            "<script>var t = '<a href=\"/s\">'</script><p>it's</p><a href=\"/v\">x</a>", None]
    assert evaluate(spark, html, fn.first_href) == [
        "/in/a&b", None, "/q", None, "foo", "/shown", "/q?a=1&b=2", "/k", "/u", "/v", None]


def test_start_tags_end_open_elements():
    def text(html, tag, nth=0):
        found = [e for e in tree.parse(html).walk() if e.tag == tag]
        return tree.spaced_text(found[nth])

    assert text("<ul><li>a<p>b<li>c<ul><li>d<li>e</ul>f<li>g</ul>", "li", 1) == "c d e f"
    assert text("<ul><li>a<p>b<li>c</ul>", "li") == "a b"
    assert text("<p>a<b>b<div>c</div>d", "p") == "a b"
    assert text("<dl><dt>a<dd>b<dt>c</dl>", "dd") == "b"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>", "tr") == "a b"
    assert text("<select><option>a<option>b</select>", "option") == "a"
    assert text("<li>a<button><p>b<p>c</button>d", "li") == "a b c d"


def test_packed_texts_come_back(spark):
    values = [None, "", "a\u00e9\U0001f600\n" * 5_000, " x "]
    assert evaluate(spark, values, lambda v: fn.unpacked(fn.packed(v))) == values
    assert max(evaluate(spark, values[1:], lambda v: F.length(fn.packed(v)))) < 5_000


class _Plain(tree._Builder):
    """The library's parser for all of the markup."""

    def read_regular(self, html):
        return 0


PIECES = [
    "text", " ", "a < b", "&amp;", "&lt;p&gt;", "&amp;lt;", "&nbsp;&#39;&quot;", "&copy", "&#x41;", "&", "é ", "<p>", "</p>", "<P >", "</ p>",
    "<br>", "<br/>", '<a href="x">', "<a href='x'>", "<a href=x>", '<a  HREF="1&amp;2"  href="y" data-x_1="">', '<a b=="c">', '<a b="c"d="e">', '<a b="<">',
    "</a>", "</a b>", "<li>", "</li>", "<ul>", "</ul>", "<td>", "<tr>", "<table>", "</table>", "<div\tid='q'>", '<div id="q\n">', "</div>", "<b", "</b", "<",
    "<!doctype html>", "<!DOCTYPE>", "<!-- <p> -->", "<!--", "<?pi?>", "<![CDATA[x]]>", "<script>", "if (a<b) '</p>'", "</script>", "<style>", "</style>",
    "<title>", "</title>", "<textarea>", "</textarea>", '<span class="visually-hidden">', "</span>", "hashtag", "<x-y>", "<o:p>", "</x-y>", "\0", "<p\0>", ">",
]


def shape(node):
    if isinstance(node, tree.Element):
        return node.tag, node.attrs, [shape(c) for c in node.children]
    return node if isinstance(node, str) else ("comment", node.markup)


def test_regular_markup_is_read_like_any_other(monkeypatch):
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(PIECES, k=rnd.randrange(1, 25))) for _ in range(20_000)]
    read = []
    builder = tree._Builder
    for text in [*texts, *PIECES, ""]:
        monkeypatch.setattr(tree, "_Builder", builder)
        read.append(outcome(text))
        monkeypatch.setattr(tree, "_Builder", _Plain)
        assert read[-1] == outcome(text), text
    card = '<div class="a b"><a href="/in/1"><span dir="ltr">x &amp; y</span></a><br></div>'
    assert builder().read_regular(f"<!DOCTYPE html>{card}") == len(f"<!DOCTYPE html>{card}")


def outcome(text):
    try:
        return shape(tree.parse(text))
    except AssertionError as problem:
        return type(problem)

import dataclasses

from pyspark.sql import functions as F

from feedloom import vocabulary as v
from feedloom.operators.extract import CardRule, Field, Match, extract_cards, may_hold
from feedloom.sources import pages as src


def card(author, body, time, link, button="", mark='class="x fie-impression-container"'):
    return f"""<div {mark} data-permalink-of="p"><a href="/in/{author}"><span
      class="update-components-actor__name"><span dir="ltr"><span aria-hidden="true">{author}</span>
      <span class="visually-hidden">View profile</span></span></span></a>
      <span class="update-components-actor__sub-description"><span aria-hidden="true">{time}</span>
      <span class="visually-hidden">ago</span></span>
      <div class="update-components-text break-words">{body}</div>{button}
      <button aria-label="Open control menu for post by {author}" data-permalink="{link}"></button>
      </div>"""


BUTTON = (
    '<span class="artdeco update-components-button__text">View job</span>'
    '<i data-job-link=" https://x.example/job/1 "></i>'
)


def rows_of(spark, html, rule, **kw):
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    return extract_cards(pages, rule, **kw).orderBy("container_idx").collect()


def test_post_cards_in_document_order(spark):
    html = "<main>" + card("Ann", "a <b>b</b>", "5m •", "l1") + card("Bob", "c", "3h", "l2")
    first, second = rows_of(spark, html, src.POST_HTML_CARD)
    assert (first.container_idx, first.author, first.time_posted) == (0, "Ann", "5m •")
    assert (first.description_html, first.post_link, first.error) == ("a <b>b</b>", "l1", None)
    assert (second.container_idx, second.author, second.post_link) == (1, "Bob", "l2")


def test_description_forms(spark):
    label = '<span class="visually-hidden">hashtag</span>'
    html = card("Ann", f"a <b>b</b> {label}#c", "5m", "l1")
    spaced, compact, plain = (
        rows_of(spark, html, rule)[0].description
        for rule in (src.POST_CARD, src.COMPACT_POST_CARD, src.PLAIN_POST_CARD)
    )
    assert (spaced, compact, plain) == ("a b #c", "abhashtag#c", "a b hashtag #c")


def test_missing_fields_are_null(spark):
    (row,) = rows_of(spark, '<div class="fie-impression-container">x</div>', src.JOB_BRANCH_CARD)
    assert (row.author, row.description, row.post_link, row.has_view_job) == (None, None, None, False)


def test_container_by_id_and_first_link(spark):
    html = card("Ann", "t", "5m", "l1", mark='id="fie-impression-container"') + card("B", "t", "1m", "l")
    (row,) = rows_of(spark, html, src.PROFILE_CARD)
    assert (row.author, row.first_href) == ("Ann View profile", "/in/Ann")


def test_job_button(spark):
    html = card("A", "t", "5m", "l1", BUTTON) + card("B", "t", "5m", "l2", BUTTON.replace("View job", "View  job"))
    a, b = rows_of(spark, html, src.JOB_BRANCH_CARD)
    assert (a.has_view_job, b.has_view_job) == (True, False)
    assert a.job_link == " https://x.example/job/1 "
    assert a.time_line == "5m ago"


def test_job_list_with_nested_items(spark):
    item = (
        "<li><strong>{0}</strong><div class='job-card-container__primary-description '>{1}</div>"
        "<ul><li class='job-card-container__metadata-item'>{2}</li></ul></li>"
    )
    html = (
        "<ul><li><strong>outside</strong></li></ul><ul class='scaffold-layout__list-container'>"
        + item.format("Dev", "Co", "Rome") + item.format("Ops", "Inc", "Oslo") + "</ul>"
    )
    rows = rows_of(spark, html, src.JOB_CARD)
    assert len(rows) == 4
    full = [(r.job_title, r.company_name, r.location) for r in rows if r.job_title]
    assert full == [("Dev", "Co", "Rome"), ("Ops", "Inc", "Oslo")]


def test_rule_vocabulary(spark):
    html = (
        '<div class="c"><button aria-label="Close menu">x</button>'
        '<button aria-label="Open menu for Ann" aria-expanded="false">Copy link to post</button>'
        '<p>one</p><p>two<!-- c --> more</p><span dir="ltr">no</span>'
        '<span dir="ltr"><i><span aria-hidden="true">yes</span></i></span></div>'
    )
    button = Match(tag="button", attr_contains=(("aria-label", "Open menu"),))
    rule = CardRule(
        Match(css_class="c"),
        {
            "label": Field(((button,),), take="@aria-label"),
            "both": Field(
                ((Match(attr_contains=(("aria-label", "Open"),), attr_equals=(("aria-expanded", "false"),)),),),
                take="exists",
            ),
            "link": Field(((Match(text_contains="Copy link"),),), take="exists"),
            "exact": Field(((Match(text_equals="Copy link"),),), take="exists"),
            "second": Field(((Match(tag="p"),),), nth=1),
            "third": Field(((Match(tag="p"),),), nth=2),
            "nested": Field(((Match(tag="span", attr_equals=(("dir", "ltr"),)), Match(tag="span")),)),
        },
    )
    (r,) = rows_of(spark, html, rule)
    assert (r.label, r.both, r.link, r.exact) == ("Open menu for Ann", True, True, False)
    assert (r.second, r.third, r.nested) == ("two more", None, "yes")


def test_page_scope(spark):
    html = "<b>top</b>" + '<div class="c"><b>in</b></div>' * 2
    rule = CardRule(
        Match(css_class="c"),
        {"page": Field(((Match(tag="b"),),), scope="page"), "own": Field(((Match(tag="b"),),))},
    )
    assert [(r.page, r.own) for r in rows_of(spark, html, rule)] == [("top", "in")] * 2


def test_inner_html_round_trip(spark):
    body = 'a &amp; b &lt;i&gt;<br><img src="x?a=1&amp;b=2" alt="&quot;q&quot;"><script>1 < 2</script><!-- c -->x'
    rule = CardRule(Match(css_class="c"), {"h": Field(((Match(tag="p"),),), take="inner_html")})
    (r,) = rows_of(spark, f'<div class="c"><p>{body}</p></div>', rule)
    assert r.h == body


def test_empty_and_null_pages_keep_the_schema(spark):
    pages = spark.createDataFrame([(1, ""), (2, None), (3, "<p>")], "page_id bigint, html string")
    out = extract_cards(pages, src.POST_CARD)
    assert out.columns == ["page_id", "container_idx", *src.POST_CARD.fields, "error"]
    assert out.count() == 0


def test_bad_page_is_reported_and_others_go_on(spark):
    pages = spark.createDataFrame(
        [(1, "<![bad <p>"), (2, card("A", "t", "5m", "l"))], "page_id bigint, html string"
    )
    got = {r.page_id: (r.author, r.error) for r in extract_cards(pages, src.POST_CARD).collect()}
    assert got[2] == ("A", None)
    assert got.get(1, (None, "AssertionError"))[0] is None


def test_deep_nesting(spark):
    html = '<div class="fie-impression-container">' + "<i>" * 5000 + "x"
    rule = CardRule(Match(css_class=v.POST_CONTAINER), {"t": Field(((Match(tag="i"),),))})
    assert [r.t for r in rows_of(spark, html, rule)] == ["x"]


def test_small_output_batches(spark, monkeypatch):
    from feedloom.operators import extract

    monkeypatch.setattr(extract, "BATCH_ROWS", 2)
    html = "".join(card(f"a{i}", "t", "5m", f"l{i}") for i in range(7))
    assert [r.post_link for r in rows_of(spark, html, src.LINK_CARD)] == [f"l{i}" for i in range(7)]


def test_prefilter_keeps_every_page_with_a_container(spark):
    pages = spark.createDataFrame(
        [(1, "<p>none</p>"), (2, card("A", "t", "5m", "l")),
         (3, '<div class="fie&#45;impression-container" data-permalink="k">x</div>')],
        "page_id bigint, html string",
    )
    held = pages.where(may_hold(v.POST_CONTAINER))
    assert sorted(r.page_id for r in held.collect()) == [2, 3]
    links = extract_cards(held, src.LINK_CARD).where(F.col("container_idx") == 0)
    assert sorted(r.page_id for r in links.collect()) == [2, 3]


def test_rules_can_be_extended():
    rule = dataclasses.replace(src.LINK_CARD, container=Match(tag="article"))
    assert rule.container.tag == "article"

"""SQL pieces of the reference results: the derived posts and the text rules, written for DuckDB."""

from __future__ import annotations

from feedloom.functions.text import ODD_SPACE
from feedloom.plans.captures import CARDS_PER_PAGE, CARDS_PER_ROUND, PARTS_PER_PAGE, SITE

SPACE = f"[ {ODD_SPACE}]"


def squeezed(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE}+', ' ', 'g'))"


def stripped(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def minutes(label: str) -> str:
    head = stripped(f"regexp_replace({label}, '•.*$', '')")
    count = rf"cast(regexp_extract({head}, '^(\d+)([mh])', 1) as double)"
    unit = rf"regexp_extract({head}, '^(\d+)([mh])', 2)"
    return f"(case {unit} when 'm' then {count} when 'h' then {count} * 60 else 'infinity'::double end)"


def tags(text: str) -> str:
    words = f"string_split_regex({text}, '{SPACE}+')"
    found = f"list_filter({words}, lambda w: starts_with(w, '#') and length(trim(w, '#')) > 0)"
    return f"list_filter({found}, lambda w, i: list_position({found}, w) = i)"


# The entities in the pages; a text may end before their semicolon.
ENTITY_CODES = (
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&middot;?", "·"),
    ("&copy;?", "©"),
    ("&amp;?", "&"),
)


def without_markup(html: str) -> str:
    """Tags, comments and scripts replaced by chr(1), entities decoded."""
    for pattern in (
        "<!--.*?-->", "<script[^>]*>.*?</script>", "<style[^>]*>.*?</style>", "<[/!a-zA-Z][^>]*>"
    ):
        html = f"regexp_replace({html}, '{pattern}', chr(1), 'gs')"
    for code, char in ENTITY_CODES:
        html = f"regexp_replace({html}, '{code}', '{char}', 'g')"
    return html


def page_text(html: str) -> str:
    return squeezed(f"replace({without_markup(html)}, chr(1), ' ')")


def page_text_compact(html: str) -> str:
    return stripped(f"regexp_replace({without_markup(html)}, '{SPACE}*\\x01[\\x01 {ODD_SPACE}]*', '', 'g')")


POSTS = f"""posts as (
  select e.event_id as seq, concat('user-', e.user_id) as author,
         concat('/in/user-', e.user_id) as profile_href, e.user_id, e.event_type, e.value,
         e.ts as posted_at, e.newest,
         concat(case when e.old < 60 then concat(e.old, 'm')
                     when e.old < 1440 then concat(e.old // 60, 'h')
                     else concat(e.old // 1440, 'd') end,
                case when e.event_id % 7 = 0 then ' • Edited • ' else ' • ' end) as time_posted,
         case when e.event_type = 'signup' then 'job' else 'post' end as kind,
         e.event_type = 'purchase' as has_view_job,
         concat(' {SITE}/jobs/', e.event_id, ' ') as job_link,
         e.event_id // {CARDS_PER_PAGE} as page_id, e.event_id // {CARDS_PER_ROUND} as batch,
         concat(d.text, ' #', d.lang, ' #', d.source) as description, p.url as post_link
  from (select ev.*, t.newest, date_sub('minute', ev.ts, t.newest) as old,
               ev.event_id % nd.n as dk, ev.event_id % np.n as pk
        from events ev cross join (select max(ts) as newest from events) t
                       cross join (select count(*) as n from documents) nd
                       cross join (select count(*) as n from pages) np) e
  join documents d on d.doc_id = e.dk join pages p on p.page_id = e.pk)"""

JOBS = f"""jobs as (
  select p_brand as feed, p_partkey // {PARTS_PER_PAGE} + 1 as page_no, p_partkey as seq,
         p_name as job_title, p_brand as location,
         case when p_type <> 'ECONOMY' then p_type end as company_name
  from part)"""


def prefix(rows: str, feed: str, page: str) -> str:
    """The rows of a feed up to its first missing page, counted from 1."""
    return f"""select q.* from {rows} q join (
      select {feed} as f, {page} as p from (
        select {feed}, {page}, row_number() over (partition by {feed} order by {page}) as rn
        from (select distinct {feed}, {page} from {rows}))
      where {page} = rn) w on w.f = q.{feed} and w.p = q.{page}"""


def stagnant(after: int) -> str:
    """Stop rounds by run length over rounds(feed, round, height)."""
    return f"""
      a as (select *, case when height = lag(height) over (partition by feed order by round)
                           then 0 else 1 end as chg from rounds),
      g as (select *, sum(chg) over (partition by feed order by round) as grp from a),
      n as (select *, row_number() over (partition by feed, grp order by round) - 1 as still from g),
      stops as (select feed, min(round) as stop_round from n where still >= {after} group by feed)"""


ROUNDS = "rounds as (select user_id as feed, event_id as round, cast(floor(value / 10) as bigint) as height from events)"

from feedloom.functions.age import age_label, age_minutes
from feedloom.functions.links import absolute_url, first_href, site_root
from feedloom.functions.markup import (
    clean_html,
    clean_html_compact,
    list_item_links,
    title_text,
    with_clean_text,
)
from feedloom.functions.tags import contains_all_terms, format_description, hashtags
from feedloom.functions.text import packed, squeeze, strip, unpacked

__all__ = [
    "absolute_url",
    "age_label",
    "age_minutes",
    "clean_html",
    "clean_html_compact",
    "contains_all_terms",
    "first_href",
    "format_description",
    "hashtags",
    "list_item_links",
    "packed",
    "site_root",
    "squeeze",
    "strip",
    "title_text",
    "unpacked",
    "with_clean_text",
]

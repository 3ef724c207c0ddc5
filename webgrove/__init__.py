"""Structured data out of raw web pages, as Spark DataFrame operators."""

from webgrove.functions.selectors import SelectorError
from webgrove.functions.text import has_nofollow, nonempty, strip_blanks
from webgrove.operators.edit import clean_text, drop
from webgrove.operators.links import extract_links, iter_links, links_from_pages, restrict_domains, with_links
from webgrove.operators.parse import nodes, parse_pages
from webgrove.operators.routing import classify_html, decompress, html_only, split_html, to_pages
from webgrove.operators.select import Selection, css, select
from webgrove.plans.crawl import Rule, SeenUrls, apply_rules, frontier
from webgrove.plans.graph import attribute_profile, host_degrees, host_summary, link_graph, tag_profile, top_links
from webgrove.plans.records import Field, extract_page_fields, extract_records
from webgrove.session import configure

__all__ = [
    "Field", "Rule", "SeenUrls", "Selection", "SelectorError", "apply_rules", "attribute_profile", "classify_html", "clean_text",
    "configure", "css", "decompress", "drop", "extract_links", "extract_page_fields", "extract_records", "frontier",
    "has_nofollow", "host_degrees", "host_summary", "html_only", "iter_links", "link_graph", "links_from_pages",
    "nodes", "nonempty", "parse_pages", "restrict_domains", "select", "split_html", "strip_blanks", "tag_profile",
    "to_pages", "top_links", "with_links",
]

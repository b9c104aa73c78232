"""Wikitext by expressions: infobox parameters, links, files, leading prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def infobox(text: Column, template: str = "Infobox") -> Column:
    """Parameters of the first template whose name starts with ``template``, as a map; the first of equal names wins.

    Values run to the next line that starts with a bar or to the end of the template; nested templates on one line are dropped.
    """
    flat = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    flat = F.regexp_replace(flat, r"\{\{(?!\s*" + template + r")[^{}]*\}\}", "")
    body = F.regexp_extract(flat, r"(?is)\{\{\s*" + template + r"[^|{}]*\|(.*?)\n?\}\}", 1)
    pairs = F.filter(F.split(body, r"(?:^|\n)\s*\|"), lambda x: x.rlike(r"^[^=|\n]+="))
    entries = F.transform(pairs, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, "=", 1))).alias("k"), plain(F.regexp_replace(x, r"(?s)^[^=]*=", "")).alias("v")))
    given = F.filter(entries, lambda e: e["v"] != "")
    first = F.filter(given, lambda e, i: ~F.exists(F.slice(given, 1, i), lambda d: d["k"] == e["k"]))
    return F.map_from_entries(first)


def plain(text: Column) -> Column:
    """Without references, tags, quotes and link brackets."""
    for pattern, by in ((r"(?s)<ref[^>]*/>|<ref[^>]*>.*?</ref>", ""), (r"<[^>]+>", " "), (r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", "$1"), (r"\[\S+\s([^\]]*)\]", "$1"), (r"'{2,}", ""), (r"\s+", " ")):
        text = F.regexp_replace(text, pattern, by)
    return F.trim(text)


def links(text: Column, skip: tuple[str, ...] = ("file", "image", "category")) -> Column:
    """Targets of links outside of the skipped namespaces, each once, in order of place."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"\[\[([^\[\]|#]+)"), F.lit(1)), lambda x: F.trim(x))
    return F.array_distinct(F.filter(found, lambda x: ~x.rlike(r"(?i)^:?(?:" + "|".join(skip) + r")\s*:")))


def files(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\[\[(?:file|image):([^\[\]|]+)"), F.lit(1)), lambda x: F.trim(x)))


def lead(text: Column, most: int = 3000) -> Column:
    """Prose before the first heading: no templates, at most ``most`` characters, cut behind a sentence where there is one."""
    head = F.regexp_extract(text, r"(?s)^(.*?)(?:\n==|$)", 1)
    for _ in range(3):  # templates in templates
        head = F.regexp_replace(head, r"(?s)\{\{[^{}]*\}\}", "")
    prose = plain(F.regexp_replace(head, r"(?i)\[\[(?:file|image|category):[^\[\]]*\]\]", ""))
    cut = F.substring(prose, 1, most)
    whole = F.regexp_extract(cut, r"(?s)^(.*[.!?])", 1)
    return F.when(F.char_length(prose) <= most, prose).when(whole != "", whole).otherwise(cut)

"""Scalar functions on names, numbers, dates, places and identifiers, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and what is left without them (fixed values, by base letter).
MARKED = {
    "a": "àáâãäåāăąǎạảấầẩẫậắằẳẵặ", "c": "çćĉċč", "d": "ďđ", "e": "èéêëēĕėęěẹẻẽếềểễệ", "g": "ĝğġģ", "h": "ĥ", "i": "ìíîïĩīĭįỉị", "j": "ĵ", "k": "ķ", "l": "ĺļľ",
    "n": "ñńņň", "o": "òóôõöōŏőơọỏốồổỗộớờởỡợ", "r": "ŕŗř", "s": "śŝşš", "t": "ţť", "u": "ùúûüũūŭůűųưụủứừửữự", "w": "ŵ", "y": "ýÿŷỳỵỷỹ", "z": "źżž",
}
_FROM = "".join(MARKED.values())
_TO = "".join(base * len(marked) for base, marked in MARKED.items())


def plain(text: Column) -> Column:
    """Lower case without marks: precomposed letters by table, combining marks dropped."""
    return F.regexp_replace(F.translate(F.lower(text), _FROM, _TO), r"\p{M}+", "")


def slug(text: Column) -> Column:
    """Lower-case ASCII words joined by dashes; other characters are dropped as if they weren't there."""
    ascii_only = F.regexp_replace(plain(text), r"[^\x00-\x7F]", "")
    return F.btrim(F.regexp_replace(ascii_only, "[^a-z0-9]+", "-"), F.lit("-"))


def official_name(text: Column) -> Column:
    """Without a parenthesis at the end."""
    return F.trim(F.regexp_replace(text, r"\s*\([^()]*\)\s*$", ""))


def split_multi(text: Column) -> Column:
    """Parts between bars, without punctuation around them; empty parts go."""
    parts = F.transform(F.split(text, r"\s*\|\s*"), lambda x: F.btrim(x, F.lit(" \t\n,;.")))
    return F.filter(parts, lambda x: x != "")


def norm_url(text: Column) -> Column:
    """First token without brackets; needs a dot; http:// if no scheme is given."""
    first = F.regexp_replace(F.regexp_extract(F.trim(text), r"^(\S+)", 1), r"[\[\]<>]", "")
    return F.when(first.contains("."), F.when(first.rlike("^[a-z]+://"), first).otherwise(F.concat(F.lit("http://"), first)))


def years_in(text: Column, last: int | None = None) -> Column:
    """Four-digit years from 1800 to ``last`` (the current year, unless given), in order of place, not inside longer numbers."""
    runs = F.filter(F.regexp_extract_all(text, F.lit(r"[0-9]+"), F.lit(0)), lambda x: F.length(x) == 4)
    return F.filter(F.transform(runs, lambda x: x.cast("int")), lambda y: y.between(F.lit(1800), F.year(F.current_date()) if last is None else F.lit(last)))


def earliest_year(text: Column, last: int | None = None) -> Column:
    return F.array_min(years_in(text, last))


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda x: F.trim(x)), lambda x: x != "")


def year_after(text: Column, keyword: str) -> Column:
    """In the first sentence with the keyword and a year behind it: the year nearest behind."""
    hits = F.transform(sentences(text), lambda s: F.element_at(F.concat(years_in(F.regexp_extract(s, rf"(?is){keyword}(.*)", 1)), F.array(F.lit(None).cast("int"))), 1))
    return F.element_at(F.concat(F.filter(hits, lambda y: y.isNotNull()), F.array(F.lit(None).cast("int"))), 1)


def parse_count(text: Column) -> Column:
    """A whole number with blanks, dots or commas between thousands, from 10 to a million; not with a unit behind it."""
    digits = F.regexp_replace(F.regexp_extract(text, r"(\d{1,3}(?:[., ]\d{3})+|\d+)", 1), "[., ]", "")
    n = digits.try_cast("bigint")
    return F.when(~text.rlike(r"(?i)\d\s*(?:%|ha|km|m2|usd)(?!\p{L})") & n.between(10, 1_000_000), n)


def point(text: Column) -> Column:
    """``Point(lon lat)`` as a struct of lat and lon."""
    part = lambda k: F.regexp_extract(text, r"(?i)Point\(\s*(-?[\d.]+)\s+(-?[\d.]+)\s*\)", k).try_cast("double")
    return F.when(part(1).isNotNull(), F.struct(part(2).alias("lat"), part(1).alias("lon")))


def dms(parts: Column) -> Column:
    """Degrees, minutes, seconds and a hemisphere (an array of strings) as decimal degrees; negative for S and W."""
    numbers = F.transform(F.filter(parts, lambda x: x.rlike(r"^-?\d+(\.\d+)?$")), lambda x: x.cast("double"))
    total = F.aggregate(F.transform(numbers, lambda x, i: x / F.pow(F.lit(60.0), i)), F.lit(0.0), lambda a, x: a + x)
    return total * F.when(F.exists(parts, lambda x: x.isin("S", "W")), -1.0).otherwise(1.0)


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def email(text: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(text, r"([A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++)", 1)), F.lit(""))


def phone(text: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(text, r"(\+?\d[\d ()-]{7,}\d)", 1), r"\s+", " "), F.lit(""))


def iso_date(text: Column) -> Column:
    """A real calendar date of the form yyyy-mm-dd."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), F.try_to_date(text, "yyyy-MM-dd"))


def codes(text: Column, stop: tuple[str, ...] = ()) -> Column:
    """Three-letter upper-case codes, distinct and sorted, without the stop list."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<![0-9A-Za-z_])([A-Z]{3})(?![0-9A-Za-z_])"), F.lit(1)))
    return F.array_sort(F.array_except(found, F.array(*map(F.lit, stop)).cast("array<string>")))


def local_name(iri: Column) -> Column:
    return F.regexp_replace(iri, "^.*[#/]", "")


def compact(iri: Column, prefixes: list[tuple[str, str]]) -> Column:
    """The first prefix that fits."""
    return reduce(lambda rest, p: F.when(iri.startswith(p[1]), F.concat(F.lit(f"{p[0]}:"), F.substring(iri, len(p[1]) + 1, 1_000_000))).otherwise(rest), reversed(prefixes), iri)


def wiki_url(lang: str, title: Column) -> Column:
    return F.concat(F.lit(f"https://{lang}.wikipedia.org/wiki/"), F.replace(F.replace(F.url_encode(F.translate(title, " ", "_")), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")))


def round_half_up(x: Column) -> Column:
    """To whole numbers, halves toward positive infinity."""
    return F.floor(x + 0.5)


def truthy(column: str, kind: str) -> Column:
    """Not null, empty, zero or false."""
    c = F.col(column)
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    empty = c == "" if kind == "string" else ~c if kind == "boolean" else c == 0 if kind not in ("date", "timestamp", "timestamp_ntz") else F.lit(False)
    return F.coalesce(~empty, F.lit(False))


def bar(share: Column, width: int = 20) -> Column:
    full = F.floor(share * width + 0.5).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), F.lit(width) - full))


def tokens(text: Column, stop: tuple[str, ...] = ()) -> Column:
    words = F.filter(F.split(slug(text), "-"), lambda x: x != "")
    return F.array_distinct(F.filter(words, lambda x: ~x.isin(*stop))) if stop else F.array_distinct(words)


def jaccard(a: Column, b: Column) -> Column:
    """Zero for two empty sets."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))


def canonical_sha(*parts: Column) -> Column:
    """SHA-256 over parts as text, joined by a separator; a null is its own mark."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)), 256)


def first_rule(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The name of the first rule (pattern, name) that the text matches."""
    return reduce(lambda rest, r: F.when(text.rlike(r[0]), r[1]).otherwise(rest), reversed(rules), F.lit(default))


def tidy_parentheses(text: Column) -> Column:
    """Empty parentheses go, blanks and punctuation inside them too."""
    once = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\(\s*[,;]*\s*\)", ""), r"\(\s*[,;]\s*", "("), r"\s*[,;]\s*\)", ")")
    return F.trim(F.regexp_replace(F.regexp_replace(once(once(once(text))), r"\s{2,}", " "), r"\s+([,.;)])", "$1"))


def person(text: Column, honorifics: tuple[str, ...] = ("dr", "prof", "mr", "mrs", "ms", "sir")) -> Column:
    """Name and honorific of a person; null unless two to six capitalised words are left."""
    head = "(?i)^((?:(?:" + "|".join(honorifics) + r")\.?\s+)*)"
    name = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), head, ""), r"\s*[,(].*$", ""))
    title = F.nullif(F.trim(F.regexp_extract(F.trim(text), head, 1)), F.lit(""))
    return F.when(name.rlike(r"^\p{Lu}[\p{L}'.-]*(?:\s+\p{Lu}[\p{L}'.-]*){1,5}$"), F.struct(name.alias("name"), title.alias("honorific")))


#: Words at which a name goes on in the next line (fixed values).
JOINING = ("of", "and", "for", "in", "the", "&", "on", "at")


def english_name(text: Column) -> Column:
    """The first of the parts between bars, joined by the next ones while it ends in a joining word and they begin in upper case."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\s*\|\s*"), lambda x: F.trim(x))
    open_end = "(?i)(" + "|".join(JOINING) + ")$"
    start = F.struct(F.element_at(parts, 1).alias("name"), F.lit(False).alias("done"))
    go_on = lambda a, x: ~a["done"] & a["name"].rlike(open_end) & x.rlike(r"^\p{Lu}")
    step = lambda a, x: F.when(go_on(a, x), F.struct(F.concat_ws(" ", a["name"], x).alias("name"), F.lit(False).alias("done"))).otherwise(F.struct(a["name"].alias("name"), F.lit(True).alias("done")))
    joined = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step)["name"]
    return F.btrim(F.regexp_replace(joined, r"\s*\([^)]*\)$", ""), F.lit(" .,-"))


def keyword_class(text: Column, rules: list[tuple[str, str]], first: int = 2) -> Column:
    """The first rule (pattern, class) that the first sentences match; null if none does."""
    return first_rule(F.array_join(F.slice(sentences(text), 1, first), " "), rules)


def aliased(fields: Column, names: dict[str, str]) -> Column:
    """A map with keys under their other names too, where the map doesn't have those itself; of two, the first key in order counts."""
    extra = F.filter(F.map_entries(fields), lambda e: e["key"].isin(*names) & e["value"].isNotNull())
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    renamed = F.transform(F.array_sort(extra), lambda e: F.struct(table[e["key"]].alias("key"), e["value"].alias("value")))
    new = F.filter(renamed, lambda e: ~F.array_contains(F.map_keys(fields), e["key"]))
    once = F.filter(F.transform(new, lambda e, i: F.when(F.array_position(F.transform(new, lambda x: x["key"]), e["key"]) == i + 1, e)), lambda e: e.isNotNull())
    return F.map_concat(fields, F.map_from_entries(once))


def first_known(candidates: Column, known: Column, taken: Column | None = None) -> Column:
    """The first candidate among the known ones that isn't taken already; null if there is none."""
    ok = F.filter(candidates, lambda c: F.array_contains(known, c) & (F.lit(True) if taken is None else ~c.eqNullSafe(taken)))
    return F.get(ok, 0)

"""Infoboxes, library works and quotes, as expressions over a text's scanned templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexquarry.functions.markup import strip_links
from lexquarry.functions.templates import parameter, without
from lexquarry.functions.text import SPACE, let, strip

#: Types of infoboxes; a blank may stand for each underscore.
TYPES = (
    "politician", "country", "political_party", "person", "revolutionary", "essay", "philosopher", "company", "settlement",
    "military_person", "organization", "guerilla_organization", "youtuber", "military_conflict", "book", "religion",
    "website", "transcript", "library_work",
)
DETECT = rf"(?iU)\{{\{{[{SPACE}]*Infobox[{SPACE}]+(\w+(?:[{SPACE}]+\w+)?)"
BREAK = rf"(?i)<br[{SPACE}]*/?[{SPACE}]*>"
FIELD_LINK = r"\[\[([^\]|]+)(?:\|[^\]]+)?\]\]"
#: Parameter of a library work -> attribute.
WORK = {
    "title": "title", "author": "author", "type": "work_type", "publisher": "publisher", "published_date": "published_date",
    "published_location": "published_location", "edition_date": "edition_date", "source": "source_url", "pdf": "pdf_url",
    "translated by": "translator", "original language": "original_language", "spoken on": "spoken_on",
}


def type_of(name: Column) -> Column:
    """The type that a name (in any case) stands for, else null."""
    known = F.create_map(*[F.lit(x) for t in TYPES for name in sorted({t, t.replace("_", " ")}) for x in (name, t)])
    return F.try_element_at(known, F.lower(strip(name)))


def detect_type(text: Column) -> Column:
    """The type of the first infobox by its first words, else null."""
    return type_of(F.regexp_extract(text, DETECT, 1))


def field_value(raw: Column) -> Column:
    """(values, is_list): a blank is null; line breaks separate the items of a list; links are what they show."""
    return let(strip(raw), _field_value)


def _field_value(raw: Column) -> Column:
    items = F.filter(F.transform(F.split(raw, BREAK, -1), lambda x: strip_links(strip(x))), lambda x: x != "")
    is_list = raw.rlike(BREAK)
    return F.struct(F.when(raw == "", F.lit(None)).when(is_list, items).otherwise(F.array(strip_links(raw))).alias("values"), is_list.alias("is_list"))


def field_links(raw: Column) -> Column:
    return F.regexp_extract_all(raw, F.lit(FIELD_LINK), 1)


def infobox(text: Column, scanned: Column) -> Column:
    """type, fields (pos, name, values, is_list, raw), extracted_links, remaining_text; null without an infobox of a known type.

    The first template named so counts, whatever comes later; of a field that repeats the last value counts (see
    :func:`field_map`), its links all do.
    """
    first = F.get(F.filter(scanned, lambda t: F.lower(t["name"]).startswith("infobox")), F.lit(0))
    kind = lambda box: type_of(F.regexp_replace(F.lower(box["name"]), f"^infobox[{SPACE}]*", ""))
    both = F.struct(text.alias("text"), first.alias("box"))
    return let(both, lambda b: let(kind(b["box"]), lambda k: _infobox(b["text"], b["box"], k)))


def _infobox(text: Column, box: Column, kind: Column) -> Column:
    fields = F.transform(box["params"], lambda p, i: F.struct(i.alias("pos"), p["name"].alias("name"), field_value(p["value"]).alias("value"), strip(p["value"]).alias("raw")))
    found = F.flatten(F.transform(box["params"], lambda p: field_links(p["value"])))
    made = F.struct(kind.alias("type"), fields.alias("fields"), found.alias("extracted_links"), without(text, box).alias("remaining_text"))
    return F.when(kind.isNotNull() & text.rlike(DETECT), made)


def field_map(box: Column) -> Column:
    """name -> values, the last of a repeated name."""
    entries = F.filter(box["fields"], lambda f: ~F.exists(box["fields"], lambda g: (g["name"] == f["name"]) & (g["pos"] > f["pos"])))
    return F.map_from_entries(F.transform(entries, lambda f: F.struct(f["name"], f["value"]["values"])))


def library_work(text: Column, scanned: Column) -> Column:
    """A library work's attributes, authors and remaining text; null without one that has a title."""
    first = F.get(F.filter(scanned, lambda t: F.lower(t["name"]) == "library work"), F.lit(0))
    values = lambda work: F.struct(*[F.coalesce(parameter(work, p), parameter(work, p, any_case=True)).alias(a) for p, a in WORK.items()])
    both = F.struct(text.alias("text"), first.alias("work"))
    return let(both, lambda b: F.when(b["work"].isNotNull(), let(values(b["work"]), lambda v: _library_work(b["text"], b["work"], v))))


def _library_work(text: Column, work: Column, raw: Column) -> Column:
    value = {a: raw[a] for a in WORK.values()}
    source = F.regexp_extract(value["source_url"], rf"^\[([^{SPACE}]+)[{SPACE}]+[^\]]+\]", 1)
    value["source_url"] = let(source, lambda s: F.when(s != "", s).otherwise(raw["source_url"]))
    value["author"] = strip_links(value["author"])
    split = lambda a: F.filter(F.transform(F.split(a, ","), strip), lambda x: x != "")
    none = F.array().cast("array<string>")
    authors = let(value["author"], lambda a: F.when(a.isNull(), none).when(F.instr(a, ",") > 0, split(a)).otherwise(F.array(a)))
    made = F.struct(*[v.alias(a) for a, v in value.items()], authors.alias("authors"), without(text, work).alias("remaining_text"))
    return F.when(value["title"].isNotNull(), made)


def quotes(scanned: Column) -> Column:
    """(text, attribution) of quote templates that have a text, without one pair of quotation marks around it."""

    def quote(t: Column) -> Column:
        return let(parameter(t, "1"), lambda text: unquoted(t, text))

    def unquoted(t: Column, text: Column) -> Column:
        pair = (text.startswith('"') & text.endswith('"')) | (text.startswith("“") & text.endswith("”"))
        inner = F.when(pair & (F.length(text) == 1), "").when(pair, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
        return F.struct(strip(inner).alias("text"), parameter(t, "2").alias("attribution"))

    found = F.transform(F.filter(scanned, lambda t: F.lower(t["name"]) == "quote"), quote)
    return F.filter(found, lambda q: q["text"].isNotNull() & (q["text"] != ""))

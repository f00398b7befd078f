"""Wiki markup as column expressions: links, sections, references, flags, clean text.

Nothing here leaves the JVM. Templates that can nest need the scanner in
:mod:`lexquarry.functions.templates`, but to strip them all repeated replacement of the innermost is enough.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexquarry.functions.text import SPACE, as_column, let, strip

#: The patterns and prefixes of the markup.
INTERNAL = r"\[\[([^\[\]|]+?)(?:\|([^\[\]]*))?\]\]"
EXTERNAL = rf"\[(https?://[^{SPACE}\]]+)(?:[{SPACE}]+([^\]]+))?\]"
CATEGORY = "Category:"
IGNORED = ("File:", "Image:", "Media:", "ru:", "de:", "es:", "fr:", "zh:", "pt:", "ar:", "ja:", "ko:")
HEADER = rf"(?md)^(={{2,6}})[{SPACE}]*([^=]+?)[{SPACE}]*\1[{SPACE}]*$"
REF = rf"(?is)<ref(?:[{SPACE}]+[^>]*)?>.*?</ref>"
REF_ALONE = rf"(?i)<ref[{SPACE}]+[^>]*/[{SPACE}]*>"
REF_LIST = rf"(?is)<references[{SPACE}]*(?:/>|>.*?</references)"
CATEGORY_LINK = r"(?i)\[\[Category:([^\]|]+)(?:\|[^\]]*)?\]\]"
STUB = rf"\{{\{{[{SPACE}]*[Ss]tub[{SPACE}]*\}}\}}"
CITATION_NEEDED = rf"\{{\{{[{SPACE}]*[Cc]itation[{SPACE}]+needed[{SPACE}]*\}}\}}"
BLOCKQUOTE = r"(?i)<blockquote\b[^>]*>"
LINK_TEXT = r"\[\[([^\]|]+)(?:\|([^\]]+))?\]\]"
#: How deep templates are removed natively.
DEPTH = 12

LINK = "struct<target:string,display:string,link_type:string,section:string,start:int,end:int>"


def _found(text: Column, pattern: str, make: Callable[[Column, Column, Column], Column]) -> Column:
    """``make(match, start, end)`` for each match, places being those of the text."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    return let(found, lambda matches: _placed(text, pattern, matches, make))


def _placed(text: Column, pattern: str, matches: Column, make: Callable[[Column, Column, Column], Column]) -> Column:
    # a text is its pieces and its matches in turn, so places are running lengths
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    empty = F.array().cast("array<struct<m:string,a:int,b:int>>")
    placed = F.aggregate(
        F.zip_with(pieces, matches, lambda p, m: F.struct(p.alias("p"), m.alias("m"))),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
            F.concat(s["out"], F.array(F.struct(x["m"].alias("m"), (s["at"] + F.length(x["p"])).alias("a"), (s["at"] + F.length(x["p"]) + F.length(x["m"])).alias("b")))).alias("out"),
        ),
        lambda s: s["out"],
    )
    return F.when(F.size(matches) > 0, F.transform(placed, lambda x: make(x["m"], x["a"], x["b"]))).otherwise(F.array().cast(f"array<{LINK}>"))


def ignored(target: Column) -> Column:
    """Blank targets, files and other languages; by exact prefix."""
    out = strip(target) == ""
    for p in IGNORED:
        out |= target.startswith(p)
    return out


def links(text: Column | str, link_type: str | None = None, positions: bool = False) -> Column:
    """An array of links: internal and category links in the text's order, then external ones; all by place if ``positions``."""
    text = F.coalesce(as_column(text), F.lit(""))
    place = (lambda a: a) if positions else (lambda a: F.lit(None).cast("int"))

    def internal(m: Column, a: Column, b: Column) -> Column:
        raw, shown = F.regexp_extract(m, INTERNAL, 1), F.regexp_extract(m, INTERNAL, 2)
        category = raw.startswith(CATEGORY)
        name = F.substring(raw, len(CATEGORY) + 1, 1 << 30)
        target = F.when(category, name).otherwise(F.substring_index(raw, "#", 1))
        section = F.regexp_extract(raw, "(?s)#(.+)", 1)
        return F.struct(
            target.alias("target"),
            F.when(category, name).when(shown != "", shown).otherwise(target).alias("display"),
            F.when(category, "category").otherwise("internal").alias("link_type"),
            F.when(~category & (section != ""), section).alias("section"),
            place(a).alias("start"),
            place(b).alias("end"),
        ).cast(LINK)

    def external(m: Column, a: Column, b: Column) -> Column:
        url, shown = F.regexp_extract(m, EXTERNAL, 1), strip(F.regexp_extract(m, EXTERNAL, 2))
        return F.struct(url.alias("target"), F.when(F.regexp_extract(m, EXTERNAL, 2) != "", shown).otherwise(url).alias("display"), F.lit("external").alias("link_type"), F.lit(None).cast("string").alias("section"), place(a).alias("start"), place(b).alias("end")).cast(LINK)

    parts = []
    if link_type != "external":
        own = _found(text, INTERNAL, lambda m, a, b: F.when(~ignored(F.regexp_extract(m, INTERNAL, 1)), internal(m, a, b)))
        own = F.filter(own, lambda x: x.isNotNull())
        parts.append(F.filter(own, lambda x: x["link_type"] == link_type) if link_type else own)
    if link_type in (None, "external"):
        parts.append(_found(text, EXTERNAL, external))
    out = F.concat(*parts) if len(parts) > 1 else parts[0]
    if positions:
        out = F.array_sort(out, lambda x, y: (x["start"] - y["start"]))
    return out


def targets(text: Column | str) -> Column:
    """Distinct internal targets in the text's order."""
    return F.array_distinct(F.transform(links(text, "internal"), lambda x: x["target"]))


def sections(text: Column | str) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(as_column(text), F.lit("")), F.lit(HEADER), 2), strip)


def reference_count(text: Column | str) -> Column:
    text = F.coalesce(as_column(text), F.lit(""))
    return (F.regexp_count(text, F.lit(REF)) + F.regexp_count(text, F.lit(REF_ALONE))).cast("long")


def categories(text: Column | str) -> Column:
    """Of category links; those in another case only if there is none."""
    text = F.coalesce(as_column(text), F.lit(""))
    own = F.transform(links(text, "category"), lambda x: x["target"])
    other = F.transform(F.regexp_extract_all(text, F.lit(CATEGORY_LINK), 1), strip)
    return let(own, lambda x: F.when(F.size(x) > 0, x).otherwise(other))


def quality_flags(text: Column | str) -> dict[str, Column]:
    text = F.coalesce(as_column(text), F.lit(""))
    return {
        "is_stub": text.rlike(STUB),
        "citation_needed_count": F.regexp_count(text, F.lit(CITATION_NEEDED)).cast("long"),
        "has_blockquote": text.rlike(BLOCKQUOTE),
    }


def strip_links(text: Column | str) -> Column:
    """Links as what they show."""
    text = F.regexp_replace(as_column(text), r"\[\[[^\]|]+\|([^\]]+)\]\]", "$1")
    return F.regexp_replace(text, r"\[\[([^\]|]+)\]\]", "$1")


def strip_templates(text: Column | str, depth: int = DEPTH) -> Column:
    """Without templates: the innermost ones go, as often as they may nest."""
    text = as_column(text)
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), text, lambda t, _: F.when(F.instr(t, "{{") > 0, F.regexp_replace(t, r"\{\{[^{}]*\}\}", "")).otherwise(t))


def clean_text(text: Column | str, keep_headers: bool = False) -> Column:
    """Plain text of markup (without an infobox's or library work's remains, which are cut out before)."""
    text = F.coalesce(as_column(text), F.lit(""))
    for pattern in (REF, REF_ALONE, REF_LIST, CATEGORY_LINK):
        text = F.regexp_replace(text, pattern, "")
    text = strip_links(strip_templates(text))
    text = F.regexp_replace(text, "'{2,5}", "")
    if not keep_headers:
        text = F.regexp_replace(text, HEADER, "$2")
    inner = SPACE.replace("\t-\r", "\t\x0b-\r")  # all but the line end
    text = F.regexp_replace(text, f"[{inner}]*\n[{inner}]*", "\n")
    return strip(F.regexp_replace(text, "\n{3,}", "\n\n"))


def namespace_of_path(path: Column | str, known: tuple[str, ...]) -> Column:
    """The first folder of a relative path if it is a namespace, else the first known one."""
    first = F.split(F.regexp_replace(as_column(path), "^/+", ""), "/")[0]
    return F.when(first.isin(*known), first).otherwise(F.lit(known[0]))


def namespace_of_name(name: Column | str, prefixes: dict[str, str], default: str = "Main") -> Column:
    """By the beginning of a file's name, the first that fits."""
    out = F.lit(default)
    for prefix, namespace in reversed(prefixes.items()):
        out = F.when(as_column(name).startswith(prefix), namespace).otherwise(out)
    return out


#: Templates that hold a date as year, month and day.
DATE_TEMPLATE = rf"(?i)\{{\{{[{SPACE}]*(?:birth|death|start|end)[ _]date(?:[ _]and[ _]age)?[{SPACE}]*\|[{SPACE}]*(\d{{4}})[{SPACE}]*\|[{SPACE}]*(\d{{1,2}})[{SPACE}]*\|[{SPACE}]*(\d{{1,2}})[^{{}}]*\}}\}}"
STUB_BOX = rf"(?i)\{{\{{[{SPACE}]*Message box/Stub[{SPACE}]*(?:\|[^{{}}]*)?\}}\}}"


def template_dates(text: Column | str) -> Column:
    """Dates of date templates, in the text's order; those that aren't in the calendar are left out."""
    found = F.regexp_extract_all(F.coalesce(as_column(text), F.lit("")), F.lit(f"({DATE_TEMPLATE})"), 1)
    part = lambda m, i: F.lpad(F.regexp_extract(m, DATE_TEMPLATE, i), 4 if i == 1 else 2, "0")
    return F.array_compact(F.transform(found, lambda m: F.try_to_date(F.concat_ws("-", part(m, 1), part(m, 2), part(m, 3)), "yyyy-MM-dd")))


def transcluded(text: Column | str) -> Column:
    """What a page shows where it is included: without noinclude parts, and only the onlyinclude parts if there are any."""
    text = F.regexp_replace(F.coalesce(as_column(text), F.lit("")), "(?is)<noinclude>.*?</noinclude>", "")
    only = F.regexp_extract_all(text, F.lit("(?is)<onlyinclude>(.*?)</onlyinclude>"), 1)
    shown = let(only, lambda x: F.when(F.size(x) > 0, F.array_join(x, "")))
    return F.regexp_replace(F.coalesce(shown, text), "(?i)</?includeonly>", "")


def is_stub_box(text: Column | str) -> Column:
    """The other marker of a stub, which the flag of :func:`quality_flags` does not know."""
    return F.coalesce(as_column(text), F.lit("")).rlike(STUB_BOX)

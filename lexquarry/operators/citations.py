"""Citations of a text, from references or templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.functions.markup import strip_links
from lexquarry.functions.templates import parameter, templates_each
from lexquarry.functions.text import SPACE, let

#: Template name -> type of citation.
TYPES = {
    "citation": "book", "web citation": "web", "news citation": "news", "youtube citation": "youtube",
    "library citation": "library", "video citation": "video", "textcite": "book",
}
#: Attribute -> parameters that give it, the one that counts first.
ATTRIBUTES = {
    "author": ("author",), "title": ("title",), "year": ("year",), "url": ("web", "url"), "archive_url": ("archive_url", "archive"),
    "mia_url": ("mia",), "lg_url": ("lg",), "pdf_url": ("pdf",), "publisher": ("publisher",), "newspaper": ("newspaper",),
    "chapter": ("chapter",), "page": ("pages", "page"), "isbn": ("isbn",), "date": ("date",), "retrieved": ("retrieved",),
    "channel": ("channel",), "quote": ("quote",), "link": ("link",), "published_location": ("city",),
    "translation_title": ("trans",), "translation_language": ("translang",),
}
#: Attributes that hold addresses keep their markup.
ADDRESSES = ("url", "archive_url", "mia_url", "lg_url", "pdf_url", "link")
REF_BODY = rf"""(?is)<ref(?:[{SPACE}]+name[{SPACE}]*=[{SPACE}]*["']?([^"'>{SPACE}]+)["']?)?[{SPACE}]*>(.*?)</ref>"""
ANY_REF = REF_BODY


def citation_of(template: Column, ref_name: Column) -> Column:
    """A struct for a template whose name is known, else null."""
    kind = F.try_element_at(F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair]), F.lower(template["name"]))
    fields = []
    for attribute, names in ATTRIBUTES.items():
        value = F.coalesce(*[parameter(template, n) for n in names])
        fields.append((value if attribute in ADDRESSES else strip_links(value)).alias(attribute))
    return F.when(kind.isNotNull(), F.struct(kind.alias("type"), *fields, ref_name.alias("ref_name")))


def with_citations(df: DataFrame, text_col: str, out_col: str = "citations") -> DataFrame:
    """``df`` with an array (ref, pos, c) of its citations in document order; rows stay where they are.

    If a text has references only those are read, of each name the first; else the whole text is.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(f"({REF_BODY})"), 1)
    refs = F.transform(found, lambda m, i: F.struct(i.alias("ref"), F.nullif(F.regexp_extract(m, REF_BODY, 1), F.lit("")).alias("name"), F.regexp_extract(m, REF_BODY, 2).alias("body")))
    # a name's first place in the list of names tells its first reference
    first = let(refs, lambda rs: let(F.struct(rs.alias("rs"), F.transform(rs, lambda r: r["name"]).alias("names")), lambda x: F.filter(x["rs"], lambda r: r["name"].isNull() | (F.array_position(x["names"], r["name"]) == r["ref"] + 1))))
    whole = F.struct(F.lit(0).alias("ref"), F.lit(None).cast("string").alias("name"), text.alias("body"))
    none = F.slice(F.array(whole), 1, 0)
    kept = F.when(text.rlike(ANY_REF), first).when(F.instr(text, "{{") > 0, F.array(whole)).otherwise(none)
    out = df.withColumn("_refs", kept).withColumn("_scanned", templates_each(F.transform("_refs", lambda r: r["body"])))
    made = F.transform(F.arrays_zip("_refs", "_scanned"), lambda x: _of_ref(x["_refs"], x["_scanned"]))
    return out.withColumn(out_col, F.flatten(made)).drop("_refs", "_scanned")


def _of_ref(ref: Column, scanned: Column) -> Column:
    known = F.filter(F.transform(scanned, lambda t: citation_of(t, ref["name"])), lambda c: c.isNotNull())
    return F.transform(known, lambda c, i: F.struct(ref["ref"].alias("ref"), i.alias("pos"), c.alias("c")))


def citations(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, ref, pos, citation.*) in document order."""
    rows = with_citations(df.select(F.col(id_col), F.col(text_col).alias("_text")), "_text", "_found")
    return rows.select(id_col, F.explode("_found").alias("x")).select(id_col, "x.ref", "x.pos", "x.c.*")

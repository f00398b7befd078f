"""Entities of a corpus: names from titles, links, categories and infoboxes, their kinds, and a cleaned list of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.functions.text import contains_any, strip

#: Words of the kinds, the first kind that fits counts.
KINDS: dict[str, tuple[str, ...]] = {
    "organization": ("party", "communist", "socialist", "international", "league", "union", "front", "movement", "organization", "committee", "council", "congress", "federation", "association"),
    "location": ("republic", "kingdom", "empire", "soviet", "people's", "democratic republic", "socialist republic"),
    "event": ("revolution", "war", "strike", "uprising", "coup", "massacre", "incident", "crisis", "election"),
    "concept": ("ism", "theory", "materialism", "dialectic", "class", "capitalism", "socialism", "communism", "imperialism"),
}
NAMED_LINK = r"\[\[([^\]|]+)(?:\|[^\]]+)?\]\]"
YEAR = r"(?U)\b(1[0-9]{3}|20[0-2][0-9])\b"


def _distinct(found: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(found, strip), lambda x: x != ""))


def links_of(text: Column) -> Column:
    found = F.filter(F.regexp_extract_all(text, F.lit(NAMED_LINK), 1), lambda m: ~(m.startswith("Category:") | m.startswith("File:") | m.startswith("Image:")))
    return _distinct(found)


def with_prefix(text: Column, prefix: str) -> Column:
    """Names of links with a prefix (Category, Library)."""
    return _distinct(F.regexp_extract_all(text, F.lit(rf"\[\[{prefix}:([^\]|]+)(?:\|[^\]]+)?\]\]"), 1))


def infobox_names(text: Column) -> Column:
    found = F.concat(*[F.regexp_extract_all(text, F.lit(rf"(?i)\|\s*{n}\s*=\s*([^\n|]+)"), 1) for n in ("name", "birth_name")])
    own = F.filter(F.transform(found, strip), lambda x: (x != "") & ~(x.startswith("{{") | x.startswith("[[") | x.startswith("File:") | x.startswith("<")))
    return F.array_distinct(own)


def years_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(YEAR), 1))


def kind_of(entity: Column) -> Column:
    low = F.lower(entity)
    out = F.lit("general")
    for kind, needles in reversed([*KINDS.items()]):
        if kind == "concept":
            out = F.when(entity.startswith("Library:"), "work").otherwise(out)
        out = F.when(contains_any(low, needles), kind).otherwise(out)
    return out


def entity_counts(articles: DataFrame, title_col: str, text_col: str) -> DataFrame:
    """entity, n: one for each article's title, and one for each article that links to it."""
    own = F.concat(F.array(F.col(title_col)), links_of(F.coalesce(F.col(text_col), F.lit(""))))
    return articles.select(F.explode(own).alias("entity")).groupBy("entity").agg(F.count("*").alias("n"))


def all_entities(articles: DataFrame, title_col: str, text_col: str) -> DataFrame:
    """entity, kind: titles, links, infobox names and library references, each once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = [F.array(F.col(title_col)), links_of(text), infobox_names(text), F.transform(with_prefix(text, "Library"), lambda x: x)]
    found = articles.select(F.explode(reduce(F.array_union, parts)).alias("entity")).distinct()
    return found.withColumn("kind", kind_of(F.col("entity")))


def titles(articles: DataFrame, title_col: str, namespace_col: str, named: tuple[str, ...] = ("Main", "Library", "Essays")) -> DataFrame:
    """Titles, and those of some namespaces with their name before them."""
    own = F.array_compact(F.array(F.col(title_col), F.when(F.col(namespace_col).isin(*named), F.concat_ws(":", namespace_col, title_col))))
    return articles.select(F.explode(own).alias("title")).distinct()


def cleaned(entity: Column) -> Column:
    return F.substring_index(strip(F.regexp_replace(entity, "'''?", "")), "#", 1)


def valid(entity: Column) -> Column:
    out = F.length(entity) >= 2
    for p in ("{{", "[[", "<", "|", "=", "http://", "https://", "www."):
        out &= ~entity.startswith(p)
    for p in ("}}", "]]", ">"):
        out &= ~entity.endswith(p)
    return out & ~(entity.rlike(r"^\d+$") & (F.length(entity) != 4))


def whitelist(entities: DataFrame, entity_col: str = "entity") -> DataFrame:
    """entity, lower: cleaned, valid, each once."""
    own = entities.select(cleaned(F.col(entity_col)).alias("entity")).where(valid(F.col("entity"))).distinct()
    return own.withColumn("lower", F.lower("entity"))

"""Extraction: from markup to clean text and metadata, one row per article.

The scanner runs once per article and its result is read by all that needs templates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import markup
from lexquarry.functions.templates import templates
from lexquarry.operators.citations import with_citations as in_place
from lexquarry.operators.infobox import infobox, library_work, quotes


def extract_articles(df: DataFrame, text_col: str = "markup", keep_headers: bool = False) -> DataFrame:
    """``df`` with what its markup holds; links, sections, references and flags are those of the original text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = df.withColumn("_text", text).withColumn("_templates", templates("_text"))
    out = out.withColumn("infobox", infobox(F.col("_text"), F.col("_templates")))
    # a library work is looked for in what the infobox leaves; only then is a second scan needed
    rest = F.coalesce(F.col("infobox.remaining_text"), F.col("_text"))
    out = out.withColumn("_rest", rest).withColumn("_rest_templates", templates(F.when(F.col("infobox").isNotNull(), F.col("_rest"))))
    out = out.withColumn("library_work", library_work(F.col("_rest"), F.when(F.col("infobox").isNotNull(), F.col("_rest_templates")).otherwise(F.col("_templates"))))
    left = F.col("library_work.remaining_text")
    out = out.withColumn("_body", F.when(left != "", left).otherwise(F.col("_rest")))
    out = out.withColumns(
        {
            "clean_text": markup.clean_text("_body", keep_headers),
            "internal_links": markup.links("_text", "internal"),
            "categories": markup.categories("_text"),
            "sections": markup.sections("_text"),
            "reference_count": markup.reference_count("_text"),
            "quotes": quotes(F.col("_templates")),
            **markup.quality_flags("_text"),
        }
    )
    return out.drop("_text", "_templates", "_rest", "_rest_templates", "_body")


def with_citations(articles: DataFrame, id_col: str, text_col: str = "markup") -> DataFrame:
    """``articles`` with an ordered array of citations, null where there is none; nothing is shuffled, and identifiers may repeat."""
    own = F.transform("citations", lambda x: x["c"])
    return in_place(articles, text_col).withColumn("citations", F.when(F.size("citations") > 0, own))

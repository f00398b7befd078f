"""The template scanner: one pass over a text gives all templates with their parameters.

Templates nest, so this is the one part of extraction that regular expressions can't do. A stack of open
brackets is enough: text is read once, and what belongs to which level is known when a bracket closes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexquarry.functions.text import as_column, blank_to_null, let, strip

TEMPLATES = "array<struct<ord:int,depth:int,start:int,end:int,name:string,params:array<struct<name:string,value:string>>>>"
_MARK = re.compile(r"\{\{|\}\}|\[\[|\]\]|\||=|<!--.*?(?:-->|\Z)|<nowiki\b[^>]*/>|<nowiki\b[^>]*>.*?(?:</nowiki\s*>|\Z)", re.DOTALL | re.IGNORECASE)


def scan(text: str | None) -> list[dict]:
    """All closed templates, an outer one before those in it. Comments and unparsed parts hold none."""
    if not text or "{{" not in text:
        return []
    done: list[dict] = []
    open_: list[dict] = []  # templates and links whose end has not come yet
    for m in _MARK.finditer(text):
        mark, at = m[0], m.start()
        if mark == "{{":
            open_.append({"kind": "}}", "start": at, "bars": [], "equals": []})
        elif mark == "[[":
            open_.append({"kind": "]]", "start": at})
        elif mark == "]]":
            if open_ and open_[-1]["kind"] == "]]":
                open_.pop()
        elif mark == "}}":
            # links that were never closed are plain text
            level = next((i for i in range(len(open_) - 1, -1, -1) if open_[i]["kind"] == "}}"), None)
            if level is not None:
                own = open_[level]
                del open_[level:]
                done.append({**own, "end": m.end(), "depth": sum(x["kind"] == "}}" for x in open_)})
        elif open_ and open_[-1]["kind"] == "}}":
            top = open_[-1]
            if mark == "|":
                top["bars"].append(at)
            elif mark == "=" and top["bars"] and (not top["equals"] or top["equals"][-1] < top["bars"][-1]):
                top["equals"].append(at)
    done.sort(key=lambda t: t["start"])
    return [_template(text, i, t) for i, t in enumerate(done)]


def _template(text: str, ord_: int, t: dict) -> dict:
    edges = [*t["bars"], t["end"] - 2]
    params, unnamed = [], 0
    for a, b in zip(edges, edges[1:], strict=False):
        split = next((e for e in t["equals"] if a < e < b), None)
        if split is None:
            unnamed += 1
            params.append({"name": str(unnamed), "value": text[a + 1 : b]})
        else:
            params.append({"name": text[a + 1 : split].strip(), "value": text[split + 1 : b]})
    return {"ord": ord_, "depth": t["depth"], "start": t["start"], "end": t["end"], "name": text[t["start"] + 2 : edges[0]].strip(), "params": params}


def templates(text: Column | str) -> Column:
    """The scanner as a column."""

    @F.pandas_udf(TEMPLATES)
    def scanned(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([scan(t) for t in batch])

    return scanned.asNondeterministic()(as_column(text))  # so that the planner never copies it into what reads it


def templates_each(texts: Column | str) -> Column:
    """The scanner over an array of texts: an array per text."""

    @F.pandas_udf(f"array<{TEMPLATES}>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if own is None else [scan(t) for t in own] for own in batch])

    return scanned.asNondeterministic()(as_column(texts))


def parameter(template: Column, name: str, any_case: bool = False) -> Column:
    """The last value of a parameter of that name, trimmed; null if missing or blank."""
    same = (lambda p: F.lower(p["name"]) == name.lower()) if any_case else (lambda p: p["name"] == name)
    return let(F.filter(template["params"], same), lambda found: F.when(F.size(found) > 0, blank_to_null(F.element_at(found, -1)["value"])))


def without(text: Column, template: Column) -> Column:
    """A text without one of its templates."""
    return strip(F.concat(F.substring(text, F.lit(1), template["start"]), F.substring(text, template["end"] + 1, F.length(text))))

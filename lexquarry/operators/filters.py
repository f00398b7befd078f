"""Filters of searches: nested dictionaries compiled to columns, so that they are pushed down like any other predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "$eq": lambda c, v: c == v, "$ne": lambda c, v: c != v, "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v, "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~c.isin(list(v)),
}
_RANGE = ("$gt", "$gte", "$lt", "$lte")
_DOCUMENT = {"$contains": lambda c, v: c.contains(v), "$not_contains": lambda c, v: ~c.contains(v), "$regex": lambda c, v: c.rlike(v)}


def _joined(parts: list[Column], operator: str) -> Column:
    if not parts:
        raise ValueError(f"{operator} needs a condition")
    out = parts[0]
    for p in parts[1:]:
        out = out & p if operator == "$and" else out | p
    return out


def where(condition: dict | None) -> Column:
    """A condition on columns: {name: value}, {name: {operator: value}}, $and and $or of such; all of a dictionary's entries hold."""
    if not condition:
        return F.lit(True)
    parts = []
    for name, value in condition.items():
        if name in ("$and", "$or"):
            parts.append(_joined([where(x) for x in value], name))
        elif name.startswith("$"):
            raise ValueError(f"unknown operator {name}")
        else:
            for operator, v in value.items() if isinstance(value, dict) else [("$eq", value)]:
                if operator not in _COMPARE:
                    raise ValueError(f"unknown operator {operator}")
                if operator in _RANGE and (isinstance(v, bool) or not isinstance(v, int | float)):
                    raise ValueError(f"{operator} compares numbers, not {v!r}")
                parts.append(_COMPARE[operator](F.col(name), v))
    return _joined(parts, "$and")


def where_document(condition: dict | None, text: Column) -> Column:
    """A condition on the text: $contains, $not_contains, $regex, and $and and $or of such."""
    if not condition:
        return F.lit(True)
    parts = []
    for operator, value in condition.items():
        if operator in ("$and", "$or"):
            parts.append(_joined([where_document(x, text) for x in value], operator))
        elif operator in _DOCUMENT:
            parts.append(_DOCUMENT[operator](text, value))
        else:
            raise ValueError(f"unknown operator {operator}")
    return _joined(parts, "$and")

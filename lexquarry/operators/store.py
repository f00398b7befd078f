"""A collection of rows under identifiers, kept as Parquet; each change writes only what it adds or takes away.

A version is a short list of parts: rows, rows that cover those of the same identifiers in the parts before, and identifiers that
are gone. A reader holds the version that it opened, and a change that fails leaves the old one. Inserts ignore identifiers that are
there, as adding to a collection does; upserts replace their rows. One writer at a time changes a collection.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.operators.filters import where as compile_where

#: Stand-ins of the scalar form of metadata.
BLANK = ("section", "library_work_author", "library_work_type", "infobox_type", "primary_category")
LISTS = ("categories", "internal_links")


def insert_ignore(rows: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    """``rows`` and those of ``new`` whose identifier is not there; of an identifier that repeats in ``new`` one row."""
    return rows.unionByName(new.dropDuplicates([id_col]).join(rows.select(id_col), id_col, "left_anti").select(*rows.columns))


def upsert(rows: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    own = new.dropDuplicates([id_col])
    return rows.join(own.select(id_col), id_col, "left_anti").select(*rows.columns).unionByName(own.select(*rows.columns))


def delete(rows: DataFrame, ids: DataFrame | None = None, where: dict | None = None, id_col: str = "chunk_id") -> DataFrame:
    """``rows`` without those with an identifier of ``ids`` and without those that meet the condition."""
    if ids is not None:
        rows = rows.join(ids.select(id_col).distinct(), id_col, "left_anti").select(*rows.columns)
    return rows.where(~F.coalesce(compile_where(where), F.lit(False))) if where else rows


def serialize(rows: DataFrame) -> DataFrame:
    """Metadata as scalars: nulls as '' or -1, lists as JSON."""
    out = {c: F.coalesce(c, F.lit("")) for c in BLANK if c in rows.columns}
    out |= {c: F.to_json(F.coalesce(F.col(c), F.array().cast("array<string>"))) for c in LISTS if c in rows.columns}
    if "library_work_published_year" in rows.columns:
        year = F.col("library_work_published_year")
        out["library_work_published_year"] = F.when(year.isNull() | (year == 0), -1).otherwise(year)
    if "political_orientation" in rows.columns:
        out["political_orientation"] = F.when(F.col("political_orientation").isNull(), "").otherwise(F.to_json("political_orientation"))
    return rows.withColumns(out)


def deserialize(rows: DataFrame) -> DataFrame:
    """The inverse of :func:`serialize`, but for values that look like a stand-in."""
    out: dict[str, Column] = {c: F.nullif(F.col(c), F.lit("")) for c in BLANK if c in rows.columns}
    out |= {c: F.from_json(F.col(c), "array<string>") for c in LISTS if c in rows.columns}
    if "library_work_published_year" in rows.columns:
        out["library_work_published_year"] = F.nullif(F.col("library_work_published_year"), F.lit(-1))
    if "political_orientation" in rows.columns:
        text = F.col("political_orientation")
        out["political_orientation"] = F.when(~text.isin("", "[]"), F.from_json(text, "array<string>"))
    return rows.withColumns(out)


class Collection:
    """A named, versioned table of vectors under a folder. Rows without an identifier are left out of a change.

    Covering parts cost a reader a join each with the identifiers of later ones; beyond ``most_covering`` of them a change ends with
    :meth:`compact`.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str = "chunks", id_col: str = "chunk_id", most_covering: int = 16):
        self.spark, self.path, self.id_col, self.most_covering = spark, f"{folder.rstrip('/')}/{name}", id_col, most_covering

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _versions(self) -> list[str]:
        fs, path = self._hadoop(f"{self.path}/versions")
        found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(v for v in found if v.endswith(".json"))

    def _parts(self, version: str) -> list[dict]:
        fs, path = self._hadoop(f"{self.path}/versions/{version}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _latest(self) -> list[dict]:
        versions = self._versions()
        if not versions:
            raise LookupError(f"no collection at {self.path}")
        return self._parts(versions[-1])

    def exists(self) -> bool:
        return bool(self._versions())

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/parts/{n}" for n in names])

    def _rows(self, parts: list[dict], columns: list[str] | None = None) -> DataFrame:
        """What the parts hold, the latest of each identifier; parts with nothing covering between are read as one."""
        out, later, names = None, None, []

        def take() -> DataFrame | None:
            nonlocal names
            if not names:
                return out
            own, names = self._read(names[::-1]), []
            own = own.select(*columns) if columns else own
            own = own if later is None else own.join(later, self.id_col, "left_anti").select(*own.columns)
            return own if out is None else own.unionByName(out)

        for part in reversed(parts):
            if part["kind"] == "rows":
                names.append(part["name"])
            if part["covers"]:
                out = take()
                ids = self._read([part["name"]]).select(self.id_col)
                later = ids if later is None else later.unionByName(ids)
        return take()

    def rows(self) -> DataFrame:
        return self._rows(self._latest())

    def _ids(self) -> DataFrame:
        return self._rows(self._latest(), [self.id_col])

    def _put(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/parts/{name}")
        return name

    def _commit(self, parts: list[dict]) -> None:
        versions = self._versions()
        number = int(versions[-1].removesuffix(".json")) + 1 if versions else 0
        fs, new = self._hadoop(f"{self.path}/versions/{number:08d}-{uuid.uuid4().hex}")
        stream = fs.create(new, False)
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()
        _, path = self._hadoop(f"{self.path}/versions/{number:08d}.json")
        if fs.exists(path) or not fs.rename(new, path):
            fs.delete(new, False)
            raise RuntimeError(f"{self.path} was changed by another writer")

    def _change(self, kind: str, rows: DataFrame, covers: bool) -> None:
        before = self._latest() if self.exists() else []
        parts = [*before, {"kind": kind, "name": self._put(rows), "covers": covers}]
        self._commit(parts)
        if sum(p["covers"] for p in parts) > self.most_covering:
            self.compact()

    def add(self, new: DataFrame, mode: str = "insert_ignore") -> None:
        if mode not in ("insert_ignore", "upsert"):
            raise ValueError(f"unknown mode {mode}")
        own = new.where(F.col(self.id_col).isNotNull()).dropDuplicates([self.id_col])
        if not self.exists():
            return self._change("rows", own, False)
        own = own.select(*self._read([next(p["name"] for p in self._latest() if p["kind"] == "rows")]).columns)
        if mode == "insert_ignore":
            return self._change("rows", own.join(self._ids(), self.id_col, "left_anti").select(*own.columns), False)
        # only what replaces rows has to cover them, so that mere additions stay cheap to read
        known = not self._ids().join(own.select(self.id_col), self.id_col, "left_semi").isEmpty()
        return self._change("rows", own, known)

    def delete_rows(self, ids: DataFrame | None = None, where: dict | None = None) -> None:
        gone = [ids.select(self.id_col)] if ids is not None else []
        gone += [self.rows().where(F.coalesce(compile_where(where), F.lit(False))).select(self.id_col)] if where else []
        if gone:
            self._change("gone", union(gone).where(F.col(self.id_col).isNotNull()).distinct(), True)

    def count(self) -> int:
        return self._ids().count() if self.exists() else 0

    def drop(self) -> None:
        fs, path = self._hadoop(self.path)
        fs.delete(path, True)

    def compact(self) -> None:
        """A version of one part, with the same rows."""
        self._commit([{"kind": "rows", "name": self._put(self.rows()), "covers": False}])

    def vacuum(self, keep: int = 1) -> None:
        """Delete all versions but the last ``keep``, and the parts that none of these has."""
        versions = self._versions()
        needed = {p["name"] for v in versions[-keep:] for p in self._parts(v)}
        for v in versions[:-keep]:
            fs, path = self._hadoop(f"{self.path}/versions/{v}")
            fs.delete(path, False)
        fs, parts = self._hadoop(f"{self.path}/parts")
        for name in [s.getPath().getName() for s in fs.listStatus(parts)]:
            if name not in needed:
                fs.delete(self._hadoop(f"{self.path}/parts/{name}")[1], True)


def union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)

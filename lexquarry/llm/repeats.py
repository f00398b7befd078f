"""Removal of long repeated byte strings, by bucket-pointer refinement.

Every byte is removed that is covered by a string of ``length`` bytes which also starts anywhere else
in the corpus. A suffix array would hold each place of the corpus; here only places that can still be in a
repeat are kept, and are refined bucket by bucket:

1. *Initial buckets.* Of each window of ``length - gram + 1`` grams (strings of ``gram`` bytes) the one
   with the least hash is an anchor. Both occurrences of a repeated string have the same anchors
   at the same offsets, so a gram that is an anchor once only is in no repeat, and its bucket goes.
2. *Whole contexts.* An anchor's context is all that a string of ``length`` bytes around it can reach.
   Anchors of a bucket whose contexts are equal are one class; a class with two members or more
   repeats in all of its context, whatever the others are.
3. *Refinement.* Of buckets with several classes one member of each class is refined: bucket identifiers of
   8-byte grams at all offsets of the context are paired with the identifiers 8 bytes on, the resulting
   ones with those 16 bytes on, and so on, until they stand for strings of ``length`` bytes; these are sorted, and
   strings with an equal neighbour are repeats. What a class repeats goes back to all its members.

A bucket of many different contexts (a passage that very many documents share) is not gathered in one task:
it is first refined by the halves of the contexts (on the left and on the right of the anchor), by which nearly
all of a passage shorter than ``length`` goes, and the strings left are counted one by one.

Texts are shuffled twice (to fetch the contexts, and to cut the texts), anchors once; counts by gram are combined before
they are shuffled, and joins read written tables only, so that adaptive execution can split a skewed one. Memory is bounded by a text and its anchors.

Defined results: a null text is an empty one; texts shorter than ``length`` keep all bytes; equal rows
are two documents (so all their strings repeat); a null id is a value like any other; extra columns are not
read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm.common import discard, materialize

_RANDOM = np.random.default_rng(20240229)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Contexts of a bucket that one task refines together (about 100 MB); larger buckets are counted string by string.
TOGETHER = 32768
#: Contexts that are refined at a time, but for buckets that have more; and offsets that are sorted at a time.
CHUNK, COLUMNS = 1024, 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as the longest text so far needs."""

    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 1 << 16)
            cls.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)], dtype=np.uint64)
            cls.down = np.cumprod(np.r_[np.uint64(1), np.full(n, _INVERSE, np.uint64)], dtype=np.uint64)
        return cls.up, cls.down


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from prefix and suffix minima of blocks (van Herk)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text's anchors, their grams' hashes and their contexts' hashes."""
    n, reach = len(raw), length - gram
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    up, down = _Powers.of(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[np.frombuffer(raw, np.uint8)] * up[:n], out=sums[1:])
    m = n - gram + 1
    grams = _mix((sums[gram:] - sums[:m]) * down[:m])
    # the order of the high 32 bits, the leftmost of equal ones first
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    at = least_in_windows(ranked, reach + 1) & np.uint64(0xFFFFFFFF)
    at = at[np.r_[True, at[1:] != at[:-1]]].astype(np.int64)
    lo, hi = np.maximum(at - reach, 0), np.minimum(at + gram + reach, n)
    context = _mix((sums[hi] - sums[lo]) * down[lo] + _mix(((at - lo).astype(np.uint64) << np.uint64(32)) | (hi - at).astype(np.uint64)))
    return at, grams[at], context


def _anchor_rows(length: int, gram: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, size = [], 0
            for k, m, text in zip(batch["k"].tolist(), batch["m"].tolist(), batch["text"], strict=True):
                at, grams, contexts = anchors((text or "").encode("utf-8", "surrogatepass"), length, gram)
                if len(at):
                    parts.append((grams.view(np.int64), contexts.view(np.int64), np.full(len(at), k), np.full(len(at), m), at))
                    size += len(at)
                if size > 200_000:
                    yield frame(parts)
                    parts, size = [], 0
            if parts:
                yield frame(parts)

    def frame(parts) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("g", "e", "k", "m", "at"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    return rows


def string_ids(contexts: np.ndarray, length: int) -> np.ndarray:
    """(n, width) bytes -> identifiers of the strings of ``length`` bytes at all offsets, by pairing those of shorter ones."""
    ids = np.zeros((contexts.shape[0], contexts.shape[1] - 7), np.uint64)
    for i in range(8):  # the bytes themselves
        ids |= contexts[:, i : i + ids.shape[1]].astype(np.uint64) << np.uint64(8 * i)
    q = 8
    while q < length:
        step = min(q, length - q)
        ids = _mix(ids[:, :-step] * np.uint64(_BASE) + ids[:, step:])
        q += step
    return ids


def repeated_strings(groups: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Which (row, offset) have the same group and identifier as another row at that offset."""
    keys = _mix(ids + groups.view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
    # strings that reach over a text's end are unlike all others
    keys = np.where(valid, keys, _mix(np.arange(keys.size, dtype=np.uint64).reshape(keys.shape) ^ np.uint64(0x5851F42D4C957F2D)))
    order = np.argsort(keys, axis=0, kind="stable")
    ranked = np.take_along_axis(keys, order, axis=0)
    same = np.zeros((len(keys) + 1, keys.shape[1]), bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.empty(keys.shape, bool)
    np.put_along_axis(out, order, same[1:] | same[:-1], axis=0)
    return out & valid


def _padded(texts: list[bytes], lefts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts with the anchor at the same place, and which of the strings at each offset are whole."""
    reach = length - gram
    width = gram + 2 * reach
    out = np.zeros((len(texts), width), np.uint8)
    for row, text, left in zip(out, texts, lefts.tolist(), strict=True):
        row[reach - left : reach - left + len(text)] = np.frombuffer(text, np.uint8)
    ends = reach - lefts + np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.arange(reach + 1)
    return out, (offsets >= (reach - lefts)[:, None]) & (offsets + length <= ends[:, None])


def _refine(length: int, gram: int):
    """Rows sorted by bucket -> for each class what it repeats: from ``lo`` to ``hi`` bytes after the anchor's start."""
    reach = length - gram

    def spans(part: pd.DataFrame) -> pd.DataFrame:
        ids, valid = [], []
        for i in range(0, len(part), CHUNK):
            own = part.iloc[i : i + CHUNK]
            contexts, whole = _padded(own["context"].tolist(), own["left"].to_numpy(np.int64), length, gram)
            ids.append(string_ids(contexts, length))
            valid.append(whole)
        ids, valid, g = np.concatenate(ids), np.concatenate(valid), part["g"].to_numpy(np.int64)
        found = np.concatenate([repeated_strings(g, ids[:, i : i + COLUMNS], valid[:, i : i + COLUMNS]) for i in range(0, reach + 1, COLUMNS)], axis=1)
        some = found.any(axis=1)
        first = found.argmax(axis=1)
        last = found.shape[1] - 1 - found[:, ::-1].argmax(axis=1)
        out = pd.DataFrame({"g": g, "e": part["e"].to_numpy(), "lo": first - reach, "hi": last - reach + length})
        return out[some]

    def chunks(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Whole buckets, as many as make a chunk."""
        g, at = rows["g"].to_numpy(), 0
        while at < len(rows):
            end = int(np.searchsorted(g, g[min(at + CHUNK, len(rows)) - 1], "right"))
            yield spans(rows.iloc[at:end])
            at = end

    def refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = None
        for batch in batches:
            rows = batch if rows is None else pd.concat([rows, batch], ignore_index=True)
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(rows["g"].to_numpy(), rows["g"].iloc[-1], "left")) if len(rows) >= 2 * CHUNK else 0
            if cut:
                yield from chunks(rows.iloc[:cut])
                rows = rows.iloc[cut:]
        if rows is not None:
            yield from chunks(rows)

    return refine


def _strings_of_large(length: int, gram: int):
    """Contexts of large buckets -> a row per string that may repeat."""
    reach = length - gram
    half = reach // 2

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.iloc[i : i + 256]
                contexts, valid = _padded(part["context"].tolist(), part["left"].to_numpy(np.int64), length, gram)
                # a string holds the half on the anchor's left, or that on its right
                offsets = np.arange(reach + 1)
                left, right = part["same_left"].to_numpy(bool)[:, None], part["same_right"].to_numpy(bool)[:, None]
                valid &= (left & (reach - offsets >= half)) | (right & (offsets + length >= reach + gram + half))
                row, at = np.nonzero(valid)
                if len(row):
                    ids = string_ids(contexts, length)
                    yield pd.DataFrame({"g": part["g"].to_numpy()[row], "e": part["e"].to_numpy()[row], "offset": at, "s": ids[row, at].view(np.int64)})

    return strings


def _key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """96 bits that name a document: equal only for equal rows."""
    parts = (F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
    return F.xxhash64(*parts).alias("k"), F.hash(*parts).alias("m")


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    """(k, m, spans): per document, unless it has none, the spans of bytes that repeats cover (they may overlap)."""
    reach, half = length - gram, (length - gram) // 2
    k, m = _key(id_col, text_col)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(k, m, text.alias("text")).where(F.octet_length("text") >= length)
    rows = materialize(rows.mapInPandas(_anchor_rows(length, gram), "g long, e long, k long, m int, at int"), "anchors")
    # what a join is with is written first: then only the join deals the anchors by their gram, and a gram of very many is split
    buckets = materialize(rows.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "shared-grams")
    every, rows = rows, materialize(rows.join(buckets, "g"), "shared-anchors")
    discard(every, buckets)

    classes = rows.groupBy("g", "e").agg(F.count("*").alias("n"), F.min(F.struct("k", "m", "at")).alias("one"))
    classes = materialize(classes.select("g", "e", "n", "one.*"), "classes")
    several = materialize(classes.groupBy("g").agg(F.count("*").alias("classes")).where("classes > 1"), "mixed-grams")
    ones = classes.join(several, "g").select("g", "e", "k", "m", "at", "classes")
    raw = docs.select(k, m, text.cast("binary").alias("raw"))
    lo = F.greatest(F.lit(0), F.col("at") - reach)
    contexts = raw.join(ones, ["k", "m"]).select("g", "e", "classes", (F.col("at") - lo).alias("left"), F.substring("raw", lo + 1, F.col("at") + gram + reach - lo).alias("context"))
    # equal rows both deliver the context
    contexts = materialize(contexts.dropDuplicates(["g", "e"]), "contexts")

    small = contexts.where(F.col("classes") <= TOGETHER).select("g", "e", "left", "context").repartition("g").sortWithinPartitions("g")
    refined = small.mapInPandas(_refine(length, gram), "g long, e long, lo int, hi int")

    large = contexts.where(F.col("classes") > TOGETHER)
    left_half = F.when(F.col("left") >= half, F.xxhash64(F.substring("context", F.col("left") - half + 1, F.lit(half + gram))))
    right_half = F.when(F.length("context") - F.col("left") >= gram + half, F.xxhash64(F.substring("context", F.col("left") + 1, F.lit(gram + half))))
    large = large.select("g", "e", "left", "context", left_half.alias("lh"), right_half.alias("rh"))
    large = materialize(large, "large-buckets")
    for name, own in (("same_left", "lh"), ("same_right", "rh")):
        same = large.where(f"{own} is not null").groupBy("g", own).count().where("count > 1").select("g", own, F.lit(True).alias(name))
        large = large.join(same, ["g", own], "left")
    large = large.withColumns({x: F.coalesce(x, F.lit(False)) for x in ("same_left", "same_right")}).where("same_left or same_right")
    strings = materialize(large.select("g", "e", "left", "context", "same_left", "same_right").mapInPandas(_strings_of_large(length, gram), "g long, e long, offset int, s long"), "strings")
    same = strings.groupBy("g", "offset", "s").count().where("count > 1").drop("count")
    by_string = strings.join(same, ["g", "offset", "s"]).groupBy("g", "e").agg((F.min("offset") - reach).alias("lo"), (F.max("offset") - reach + length).alias("hi"))

    whole = classes.where("n > 1").select("g", "e", F.lit(-reach).alias("lo"), F.lit(gram + reach).alias("hi"))
    # a class with two members or more repeats everywhere, so what else is known of it says no more
    found = refined.unionByName(by_string).unionByName(whole).groupBy("g", "e").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    found = materialize(found, "repeats")
    discard(contexts, strings, classes, several)
    spans = rows.join(found, ["g", "e"]).select("k", "m", F.struct(F.greatest(F.lit(0), F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi")).alias("span"))
    return spans.groupBy("k", "m").agg(F.collect_set("span").alias("spans"))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, spans in zip(batch["text"], batch["spans"], strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            runs: list[list[int]] = []
            for lo, hi in sorted((s["lo"], min(s["hi"], len(raw))) for s in ([] if spans is None else spans)):
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
            kept, at = [], 0
            for lo, hi in runs:
                kept.append(raw[at:lo])
                at = hi
            kept.append(raw[at:])
            left = b"".join(kept)
            out.append((len(raw), len(raw) - len(left), [{"start": a, "end": b} for a, b in runs], left, hashlib.sha256(left).hexdigest()))
        frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "removed", "kept", "kept_sha256"])
        frame.insert(0, "id", batch["id"].to_numpy())
        yield frame


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = 128) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, removed (start, end; bytes), kept (binary), kept_sha256."""
    if gram < 8 or length < gram + 2:
        raise ValueError("length must be over gram + 1, and gram 8 or more")
    k, m = _key(id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    spans = materialize(repeated_spans(docs, id_col, text_col, length, gram), "spans")
    rows = docs.select(k, m, F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).join(spans, ["k", "m"], "left")
    cut = rows.select("id", "text", "spans").mapInPandas(_cut, "id string, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept binary, kept_sha256 string")
    return cut.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)

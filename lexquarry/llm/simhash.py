"""SimHash near-dedup with a pigeonring filter.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles; fingerprints
that differ in ``distance`` bits or fewer are linked, and components of links are the groups.

Candidates: the 64 bits are ``distance + 1`` segments in a ring. If two fingerprints differ in at
most ``distance`` bits, then from some segment on every chain of l consecutive segments differs in
at most floor(l * distance / (distance + 1)) = l - 1 bits (the pigeonring principle; Qin and Xiao,
VLDB 2018). So at that start the first segment is equal and the second differs in one bit at most:
both sides are joined on (start, first segment, second segment), one of them with the zero bits of
the second segment flipped in turn. Longer chains prune the joined pairs before the whole
Hamming distance is taken.

Groups of near copies are not expanded into pairs: a first pass sorts the fingerprints from each
start on and links close neighbours (verified, so never wrong), and the exact pass then joins only
rows of different components; rows of large components meet one another only in buckets that two of them share.

Defined results: null and empty texts, and texts without words, have the fingerprint 0 and are linked
like any other; texts shorter than a shingle are one shingle; rows that repeat an id are separate
rows with the same component if their texts are linked; a null id never names a component unless
no member has another (then it is null); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lexquarry.llm.common import discard, materialize, release
from lexquarry.llm.components import connected_components

#: Shingles whose bits are counted at a time (64 bytes each).
CHUNK = 1 << 16
#: Neighbours that each fingerprint is compared with in the first pass; rows of a large group.
LAGS, LARGE = 8, 64
#: Rows of a table of a few numbers (some 30 MB) up to which it is broadcast.
BROADCAST_ROWS = 1_000_000


def shingle_digests(text: str | None, n: int) -> bytes:
    """The big-endian XXH64 digests (seed 42) of a text's shingles of n words, end to end."""
    import xxhash

    digest = xxhash.xxh64_digest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return b""
    whole = b" ".join(words)
    if len(words) <= n:
        return digest(whole, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - n].tolist()]
    return b"".join([digest(whole[a : b - 1], 42) for a, b in zip(starts, ends[n - 1 :].tolist(), strict=True)])


def majority(digests: bytes) -> int:
    """The bits that are set in over half of the digests, as an unsigned number."""
    if not digests:
        return 0
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(rows), CHUNK):
        ones += np.unpackbits(rows[i : i + CHUNK], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def fingerprint(text: str | Column, n: int = 4) -> Column:
    """The fingerprint of a text column as a long (the unsigned number's two's complement)."""

    @F.pandas_udf(LongType())
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            prints = np.fromiter((majority(shingle_digests(t, n)) for t in batch), np.uint64, len(batch))
            yield pd.Series(prints.view(np.int64))

    return simhash(F.col(text) if isinstance(text, str) else text)


def ring(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the distance + 1 segments, widest first."""
    widths = [64 // (distance + 1) + (i < 64 % (distance + 1)) for i in range(distance + 1)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segment(x: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << width) - 1))


def _turned(x: Column, shift: int) -> Column:
    """The fingerprint turned so that the segment that begins at bit ``shift`` comes last."""
    return F.shiftrightunsigned(x, shift).bitwiseOR(F.shiftleft(x, 64 - shift)) if shift else x


def _chains(difference: Column, start: Column, segments: list[tuple[int, int]], distance: int) -> Column:
    """Whether from ``start`` on every chain of l segments differs in l - 1 bits at most, the whole ring in ``distance``."""
    holds = F.bit_count(difference) <= distance
    m = len(segments)
    for i in range(m):
        own = F.lit(True)
        for length in range(1, m):
            mask = 0
            for j in range(length):
                shift, width = segments[(i + j) % m]
                mask |= ((1 << width) - 1) << shift
            own &= F.bit_count(difference.bitwiseAND(F.lit(_signed(mask)))) <= length - 1
        holds &= (start != i) | own
    return holds


def _close_neighbours(distance: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted (fp, node) -> links of neighbours, each partition's as stars of what they connect."""
        tail_fp = tail_node = tail_view = np.empty(0, np.int64)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (p := parent.get(x, x)) != x:
                parent[x] = x = parent.get(p, p)
            return x

        def flush() -> pd.DataFrame:
            rows = [(x, r) for x in parent if (r := find(x)) != x]
            parent.clear()
            return pd.DataFrame(rows, columns=["a", "b"], dtype="int64")

        for batch in batches:
            fp = np.concatenate([tail_fp, batch["fp"].to_numpy(np.int64)])
            node = np.concatenate([tail_node, batch["node"].to_numpy(np.int64)])
            view = np.concatenate([tail_view, batch["view"].to_numpy(np.int64)])
            for lag in range(1, min(LAGS, len(fp) - 1) + 1):
                near = (np.bitwise_count((fp[lag:] ^ fp[:-lag]).view(np.uint64)) <= distance) & (view[lag:] == view[:-lag])
                for a, b in zip(node[lag:][near].tolist(), node[:-lag][near].tolist(), strict=True):
                    a, b = find(a), find(b)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
            tail_fp, tail_node, tail_view = fp[-LAGS:], node[-LAGS:], view[-LAGS:]
            if len(parent) > 1_000_000:
                yield flush()
        yield flush()

    return links


def linked_prints(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Distinct fingerprints (fp: long, node: long, distinct; or view: int too) -> (node, component). Views are linked each on their own."""
    segments = ring(distance)
    m = len(segments)
    if "view" not in prints.columns:
        prints = prints.withColumn("view", F.lit(0))
    turned = prints.select("node", "fp", "view", F.posexplode(F.array(*[_turned(F.col("fp"), s) for s, _ in segments])).alias("start", "turned"))
    turned = turned.withColumn("start", F.col("start") + F.col("view") * m)
    turned = turned.repartitionByRange("start", "turned").sortWithinPartitions("start", "turned", "node")
    near = materialize(turned.select("fp", "node", "view").mapInPandas(_close_neighbours(distance), "a long, b long"), "near-links")
    first = materialize(connected_components(near), "near-groups")
    labelled = prints.join(first, "node", "left").select("node", "fp", "view", F.coalesce("component", "node").alias("label"))
    labelled = materialize(labelled, "labelled")

    # labels with many rows make buckets in which nearly all rows have the same one
    large = materialize(labelled.groupBy("label").count().where(F.col("count") >= LARGE).select("label", F.lit(True).alias("large")), "large-groups")
    n_large = large.count()
    flagged = labelled.join(F.broadcast(large) if n_large <= 1_000_000 else large, "label", "left").withColumn("large", F.coalesce("large", F.lit(False)))

    def keys(rows: DataFrame, probe: bool) -> DataFrame:
        every = []
        for i, (shift, width) in enumerate(segments):
            shift2, width2 = segments[(i + 1) % m]
            base = F.shiftleft(_segment(F.col("fp"), shift, width), 32).bitwiseOR(_segment(F.col("fp"), shift2, width2)).bitwiseOR(F.shiftleft(F.col("view").cast("long") * m + i, 56))
            every.append(base)
            if probe:
                bit = lambda b, s=shift2: F.shiftrightunsigned(F.col("fp"), s + b).bitwiseAND(F.lit(1)) == 0
                every += [F.when(bit(b), base.bitwiseOR(F.lit(1 << b))) for b in range(width2)]
        every = F.array_compact(F.array(*every)) if probe else F.array(*every)
        return rows.select("fp", "label", F.explode(every).alias("key"))

    meets = (F.col("p.label") != F.col("i.label")) & _chains(F.expr("p.fp ^ i.fp"), F.shiftright(F.col("p.key"), 56) % m, segments, distance)

    def pairs(probe: DataFrame, index: DataFrame, and_: str = "true") -> DataFrame:
        joined = probe.alias("p").join(index.alias("i"), (F.col("p.key") == F.col("i.key")) & F.expr(and_) & meets)
        return joined.select(F.col("p.label").alias("a"), F.col("i.label").alias("b"))

    small, big = flagged.where("not large"), flagged.where("large")
    found = pairs(keys(small, True), keys(flagged, False))
    if n_large:
        found = found.unionByName(pairs(keys(big, True), keys(small, False)))
        # of large groups only buckets that two share, and there the rows that are not the majority's meet all, its own the others
        probe, index = keys(big, True), keys(big, False)
        mixed = probe.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
        probe = materialize(probe.join(mixed, "key"), "large-probes")
        most = probe.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("most"))
        most = materialize(most, "bucket-majorities")
        probe, index = probe.join(most, "key"), index.join(most, "key")
        found = found.unionByName(pairs(probe.where("label <> most"), index)).unionByName(pairs(probe.where("label = most"), index.where("label <> most")))
    far = materialize(found.distinct(), "far-links")
    second = connected_components(far).select(F.col("node").alias("label"), F.col("component").alias("root"))
    return labelled.join(second, "label", "left").select("node", F.coalesce("root", "label").alias("component"))


def _small(table: DataFrame) -> DataFrame:
    """A written table of a few longs a row, broadcast if it is counted to be small; else adaptive execution splits the joins' skewed keys."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    prints = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), fingerprint(F.col(f"`{text_col}`"), n).alias("fp"))
    prints = materialize(prints, "fingerprints")
    # nodes are numbered by the fingerprint itself: ids may be null or repeat
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    groups = materialize(linked_prints(distinct.select("fp", F.col("fp").alias("node")), distance), "groups")
    least = materialize(distinct.join(groups, distinct.fp == groups.node).groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    named = materialize(groups.join(_small(least), "component").select(F.col("node").alias("fp"), "component_id"), "named-fingerprints")
    out = prints.join(_small(named), "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Rows of a bucket beyond which its rows first meet its most central one; shingles that are known to be frequent.
CROWDED, FREQUENT = 16, 1_000_000
#: Shingles that a task counts before it sends a block; bytes of text for each bucket of counts, about.
BLOCK_SHINGLES, BUCKET_BYTES = 1 << 19, 1 << 23
#: Keeps rounding from turning a whole number into the next; a test that errs by it lets a pair through to the exact one.
_EPS = 1e-9


def distinct_hashes(digests: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(digests, ">u8").astype(np.int64))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    return distinct_hashes(shingle_digests(text, n))


def prefix(own: np.ndarray, similarity: float, hot: np.ndarray, counts: np.ndarray, shift: int) -> np.ndarray:
    """The first of a set's shingles in the order of (frequency, hash), so many that two sets with ``similarity`` share one of them."""
    k = len(own) - int(np.ceil(similarity * len(own) - _EPS)) + 1 if len(own) else 0
    if len(hot):
        cut = own.view(np.uint64) >> np.uint64(shift)
        at = np.minimum(np.searchsorted(hot, cut), len(hot) - 1)
        own = own[np.argsort(np.where(hot[at] == cut, counts[at], 0), kind="stable")]
    return own[:k]


def _count_blocks(n: int, bucket_bits: int):
    """Texts -> per bucket and block: the hashes of shingles, cut to the 40 bits below the bucket's, with the number of texts that have them."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, size = [], 0

        def flush() -> pd.DataFrame:
            keys, counts = np.unique(np.concatenate(sets).view(np.uint64) >> np.uint64(24 - bucket_bits), return_counts=True)
            edges = np.searchsorted(keys >> np.uint64(40), np.arange((1 << bucket_bits) + 1).astype(np.uint64)).tolist()
            high, low, counts = (keys >> np.uint64(8)).astype("<u4"), keys.astype(np.uint8), counts.astype("<u4")
            rows = [(b, high[lo:hi].tobytes() + low[lo:hi].tobytes(), counts[lo:hi].tobytes()) for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)) if hi > lo]
            return pd.DataFrame(rows, columns=["bucket", "keys", "counts"])

        for batch in batches:
            for text in batch["text"]:
                sets.append(shingle_set(text, n))
                size += len(sets[-1])
                if size >= BLOCK_SHINGLES:
                    yield flush()
                    sets, size = [], 0
        if size:
            yield flush()

    return blocks


def _merge_counts(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
    """All blocks of a bucket -> the shingles that two texts or more have: per count, the sorted keys, packed."""
    keys = []
    for own in blocks["keys"]:
        m = len(own) // 5
        keys.append((np.frombuffer(own, "<u4", m).astype(np.uint64) << np.uint64(8)) | np.frombuffer(own, np.uint8, m, 4 * m))
    keys, counts = np.concatenate(keys), np.frombuffer(b"".join(blocks["counts"]), "<u4").astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    keys, counts = keys[first] | np.uint64(int(key[0]) << 40), np.add.reduceat(counts, first)
    keys, counts = keys[counts >= 2], counts[counts >= 2]
    order = np.argsort(counts, kind="stable")
    values, starts = np.unique(counts[order], return_index=True)
    parts = np.split(keys[order], starts[1:])
    return pd.DataFrame({"count": values, "n": [len(x) for x in parts][: len(values)], "keys": [x.astype("<u8").tobytes() for x in parts][: len(values)]})


def _frequent(texts: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The most frequent shingles of all texts (their hashes' high bits, sorted), by how many texts have them, and the bits cut off.

    Every text is counted. At most ``FREQUENT`` shingles are told, all down to one count; the others, which fewer texts have, come first in
    the order of all. Any order that all texts share finds the same pairs; a better one only makes smaller buckets.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bucket_bits = min(16, max(5, (size // BUCKET_BYTES).bit_length()))
    blocks = texts.select("text").mapInPandas(_count_blocks(n, bucket_bits), "bucket long, keys binary, counts binary")
    counted = materialize(blocks.groupBy("bucket").applyInPandas(_merge_counts, "count long, n long, keys binary"), "shingle-counts")
    least, told = None, 0
    for count, m in counted.groupBy("count").agg(F.sum("n")).orderBy(F.col("count").desc()).collect():
        told += m
        if told > FREQUENT:
            break
        least = count
    found = counted.where(F.col("count") >= least).select("count", "n", "keys").collect() if least else []
    discard(counted)
    keys = np.frombuffer(b"".join(r["keys"] for r in found), "<u8").astype(np.uint64)
    counts = np.repeat(np.array([r["count"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64))
    order = np.argsort(keys)
    return keys[order], counts[order], 24 - bucket_bits


def _similar(similarity: float):
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs (a, b, x, y: sets) -> those whose sets share ``similarity`` of their shingles."""
        for batch in batches:
            near = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near[i] = both >= similarity * (len(x) + len(y) - both) - _EPS
            yield batch.loc[near, ["a", "b"]]

    return check


def _similar_pairs(keys: DataFrame, rows: DataFrame, texts: DataFrame, similarity: float, distance: int, whole) -> DataFrame:
    """Links (a, b) of distinct sets (print, size, pos, key: their first shingles) that connect all sets with ``similarity``."""
    # each step has plans of dozens of stages: what they leave in the driver goes before the next one adds its own
    spark = keys.sparkSession
    shared = materialize(keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"), "shared-keys")
    release(spark)
    once = rows.groupBy("print").agg(F.min("node").alias("node"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs, "pairs")
        needed = pairs.select(F.col("a").alias("print")).unionByName(pairs.select(F.col("b").alias("print"))).distinct().join(once, "print")
        sets = texts.join(needed, "node").dropDuplicates(["print"]).select("print", whole("text").alias("set"))
        sets = materialize(sets, "sets")
        both = pairs.join(sets.select(F.col("print").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("print").alias("b"), F.col("set").alias("y")), "b")
        links = materialize(both.select("a", "b", "x", "y").mapInPandas(_similar(similarity), "a long, b long"), "links")
        discard(pairs, sets)
        release(spark)
        return links

    sizes_fit = lambda x, y: F.least(x, y) >= F.lit(similarity) * F.greatest(x, y) - _EPS
    # a row with many shared keys has few shingles of its own, so it is near the middle of its copies
    degree = materialize(shared.groupBy("print").agg(F.count("*").alias("degree"), F.first("size").alias("size")), "degrees")
    # the groups of the fingerprints
    fps = materialize(rows.groupBy("print").agg(F.min("fp").alias("fp")), "fingerprints")
    groups = materialize(linked_prints(fps.select("fp", F.col("fp").alias("node")).distinct(), distance), "groups")
    release(spark)
    members = fps.join(groups.withColumnRenamed("node", "fp"), "fp").join(degree, "print").select("component", "print", "size", "degree")
    middle = members.groupBy("component").agg(F.max_by(F.struct("print", "size"), F.struct("degree", "print")).alias("m"))
    stars = members.join(middle, "component").where(F.col("print") != F.col("m.print")).where(sizes_fit(F.col("size"), F.col("m.size"))).select("print", "m")
    # crowded buckets, by classes of sizes
    crowded = shared.where(F.col("n") > CROWDED).join(degree.select("print", "degree"), "print").withColumn("class", F.floor(F.log("size") / np.log(1 / similarity)))
    middle = crowded.groupBy("key", "class").agg(F.max_by(F.struct("print", "size"), F.struct("degree", "print")).alias("m"))
    more = crowded.join(middle, ["key", "class"]).where(F.col("print") != F.col("m.print")).where(sizes_fit(F.col("size"), F.col("m.size"))).select("print", "m")
    stars = stars.unionByName(more).select(F.least("print", "m.print").alias("a"), F.greatest("print", "m.print").alias("b")).distinct()
    near = materialize(connected_components(verified(stars)), "near-groups").withColumnRenamed("node", "print").withColumnRenamed("component", "label")
    release(spark)

    # all other pairs: in each bucket the rows that aren't the most frequent group's meet all rows of other groups
    labelled = shared.join(near, "print", "left").withColumn("label", F.coalesce("label", "print"))
    labelled = materialize(labelled.select("key", "print", "size", "pos", "label"), "labelled-keys")
    most = labelled.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("most"), F.count("*").alias("labels")).where("labels > 1")
    mixed = materialize(labelled.join(most.select("key", "most"), "key"), "mixed-keys")
    discard(shared, labelled)
    release(spark)
    p, i = mixed.where("label <> most").alias("p"), mixed.alias("i")
    share = F.lit(similarity / (1 + similarity)) * (F.col("p.size") + F.col("i.size")) - _EPS
    # the first shingle in common has as many behind it in both as are needed; so pairs meet there, and by few others
    first = F.least(F.col("p.size") - F.col("p.pos"), F.col("i.size") - F.col("i.pos")) >= share
    meets = (F.col("p.key") == F.col("i.key")) & (F.col("p.label") != F.col("i.label")) & ((F.col("i.label") == F.col("i.most")) | (F.col("p.print") < F.col("i.print"))) & sizes_fit(F.col("p.size"), F.col("i.size")) & first
    pairs = p.join(i, meets).groupBy(F.least("p.print", "i.print").alias("a"), F.greatest("p.print", "i.print").alias("b"))
    # where a pair meets are the first shingles in common; what follows the last of these is the rest
    pairs = pairs.agg(F.count("*").alias("c"), F.first(share).alias("share"), F.min(F.least(F.col("p.size") - F.col("p.pos"), F.col("i.size") - F.col("i.pos"))).alias("rest"))
    links = verified(pairs.where(F.col("c") - 1 + F.col("rest") >= F.col("share")).select("a", "b"))
    discard(mixed)
    return links.unionByName(near.select(F.col("print").alias("a"), F.col("label").alias("b")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: float = 0.8, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` without those that are near copies of others: of each group the smallest id stays.

    Rows are linked if they share ``similarity`` or more of the distinct shingles of ``n`` words of both (exactly, up
    to collisions of 64-bit hashes), and components of links are the groups. Candidates come from two sides:

    * The pigeonring join of the SimHash fingerprints groups most copies. Each row of a group is compared with the group's most
      central one, so a group is linked by as many comparisons as it has rows.
    * Fingerprints within ``distance`` bits miss copies with more changes, so prefix filtering (Bayardo, Ma and Srikant,
      WWW 2007) completes them: with the shingles of every text in one order, two texts with that similarity
      share one of the first (1 - similarity) of theirs, and at the first one in common both have as many shingles left as are
      needed. The order puts frequent shingles last (counted over all texts), which keeps buckets of equal shingles small. Rows of crowded buckets
      first meet their bucket's most central row; then only pairs are compared that lie in different components.

    Every link is decided by the whole shingle sets. Defined results: null and empty texts and texts without words are copies
    of one another; texts shorter than a shingle are one shingle. Rows with the same id and
    text are one row and stay or go together; a null id comes after all others. Columns of any name are carried along; an empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    parts = (F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
    key = F.xxhash64(*parts)
    texts = docs.select(key.alias("node"), F.col(f"`{id_col}`").cast("long").alias("id"), parts[1].alias("text"))
    frequent = spark.sparkContext.broadcast(_frequent(texts, n))

    @F.pandas_udf("struct<print:long,fp:long,size:long,prefix:array<long>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            # few texts' shingles at a time
            parts = [rows_of(batch.iloc[i : i + 512], xxhash.xxh64_intdigest) for i in range(0, len(batch), 512)]
            yield pd.concat(parts or [rows_of(batch, xxhash.xxh64_intdigest)], ignore_index=True)

    def rows_of(texts: pd.Series, digest) -> pd.DataFrame:
        digests = [shingle_digests(t, n) for t in texts]
        sets = list(map(distinct_hashes, digests))
        prints = [_signed(digest(s.tobytes(), 42)) for s in sets]
        return pd.DataFrame({"print": prints, "fp": [_signed(majority(d)) for d in digests], "size": [len(s) for s in sets], "prefix": [prefix(s, similarity, *frequent.value).copy() for s in sets]})

    @F.pandas_udf("binary")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t, n).tobytes() for t in batch])

    rows = materialize(texts.select("node", "id", read("text").alias("r")).select("node", "id", "r.*"), "prefixes")
    # equal sets are one print; buckets of one print have no pairs
    keys = rows.groupBy("print").agg(F.min("node").alias("node"))
    keys = rows.join(keys, ["print", "node"], "left_semi").dropDuplicates(["print"]).select("print", "size", F.posexplode("prefix").alias("pos", "key"))
    keys = materialize(keys, "keys")
    prints = materialize(rows.drop("prefix", "size"), "prints")
    discard(rows)
    release(spark)
    rows = prints
    links = _similar_pairs(keys, rows, texts, similarity, distance, whole)
    discard(keys)
    frequent.destroy()
    same = materialize(connected_components(links), "copies").withColumnRenamed("node", "print")
    rows = rows.select("node", "id", "print").join(same, "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = rows.groupBy("component").agg(F.min_by("node", F.struct(F.col("id").isNull(), "id", "node")).alias("stays"), F.count("*").alias("n")).where("n > 1")
    gone = materialize(rows.join(least, "component").where("node <> stays").select(F.col("node").alias("_near_copy")).distinct(), "near-copies")
    release(spark)
    return docs.join(_small(gone), key == gone["_near_copy"], "left_anti")

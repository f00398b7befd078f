"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

Slot t of the schedule is the point vdc(t), the base-2 van der Corput sequence; a source owns the
points in its share of [0, 1) (cumulative targets). The slots of a source are ranked, and the
k-th of them takes the k-th block of ``block_words`` words of the source's shuffled documents,
laid end to end and repeated once. Any stretch of the schedule so holds every source close to its
weight, and a source's last block is cut to meet the target to the word.

The points of 2**k slots are the multiples of 2**-k, so a source's slots come from a range of
integers by reversing k bits: no join of slots with shares, and no list of sources on the driver.
Ranks and offsets come from sums per bucket and windows within a bucket; buckets are bounded,
whatever share of the rows a source holds.

Defined results: a null text has no words; documents without words take none; a null source is a
source of its own, after all others; an empty table gives an empty table. Rows that repeat an id
are separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lexquarry.llm.common import materialize

#: Rows of a source that one window sorts, and slots of the schedule that one window ranks, about.
BUCKET_ROWS = 2_000
SLOT_BITS = 16


@F.pandas_udf(LongType())
def count_words(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Words of a text: bytes.split() separates at exactly the six ASCII white-space characters."""
    for text in texts:
        yield pd.Series([0 if t is None else len(t.encode("utf-8", "surrogatepass").split()) for t in text], dtype="int64")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, repeat: int) -> DataFrame:
    """(source, size) per document -> per source: weight, source_size, target, quota (whole words).

    Shares of ``percent`` of all words by weight, none above ``repeat`` times the source's words,
    the excess shared again by weight among the others: the fixed point is min(cap, level * weight)
    with one level, found from the sources sorted by cap / weight. One row per source is sorted, in
    one task; all sums are exact integers.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    per = per.select("source", "source_size", weight.alias("weight")).withColumn("cap", F.col("source_size") * repeat)
    # order by cap / weight without division: weights are a few small integers
    common = 1
    for w in set(weights):
        common *= w
    by = Window.orderBy((F.col("cap") * (F.lit(common) / F.col("weight")).cast("long")).asc(), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
        F.sum("source_size").over(everything).alias("all_words"),
    )
    # a source stops at its cap if the level that it would get reaches the cap
    left = F.col("all_words") * percent - F.col("cap_before") * 100
    per = per.withColumn("capped", F.col("cap").cast("decimal(38,0)") * F.col("weight_left") * 100 <= left.cast("decimal(38,0)") * F.col("weight"))
    free = ~F.col("capped")
    level_n = F.min(F.when(free, F.struct("cap_before", "weight_left"))).over(everything)
    per = per.withColumn("at", level_n)
    top = (F.col("all_words") * percent - F.col("at.cap_before") * 100) * F.col("weight")
    bottom = F.col("at.weight_left") * 100
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(top.cast("double") / bottom.cast("double"))
    per = per.withColumn("target", target)
    quota = F.least(F.floor("target"), F.col("cap"))
    return per.select("source", "source_size", "weight", "target", quota.cast("long").alias("quota"))


def _schedule(targets: DataFrame, block_words: int, bits: int) -> DataFrame:
    """Per slot: source, slot, rank; rank counts the source's slots in the schedule's order."""
    n, step = 1 << bits, 1 << SLOT_BITS
    by = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.sum("quota").over(Window.partitionBy())
    upto = F.sum("quota").over(by.rowsBetween(Window.unboundedPreceding, 0))
    # least integer j with j * total >= upto * n, exactly
    edge = lambda c: F.ceil((c.cast("decimal(38,0)") * n) / total.cast("decimal(20,0)")).cast("long")
    own = targets.where("quota > 0").select("source", "quota", edge(upto - F.col("quota")).alias("lo"), edge(upto).alias("hi"), F.ceil(F.col("quota") / block_words).cast("long").alias("blocks"))
    own = materialize(own, "shares")
    points = own.where("hi > lo").select("source", "blocks", F.explode(F.sequence(F.floor(F.col("lo") / step), F.floor((F.col("hi") - 1) / step))).alias("part"), "lo", "hi").repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")
    points = points.select("source", "blocks", F.explode(F.sequence(F.greatest("lo", F.col("part") * step), F.least("hi", (F.col("part") + 1) * step) - 1)).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long") if bits else F.lit(0).cast("long")
    slots = points.select("source", "blocks", slot.alias("slot")).withColumn("stretch", F.shiftright("slot", SLOT_BITS))
    counts = slots.groupBy("source", "stretch").count()
    start = F.coalesce(F.sum("count").over(Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("source", "stretch", start.alias("start"))
    rank = F.row_number().over(Window.partitionBy("source", "stretch").orderBy("slot")) - 1
    ranked = slots.withColumn("local", rank).alias("s").join(counts.alias("c"), F.expr("s.source <=> c.source and s.stretch = c.stretch"))
    ranked = ranked.select("s.source", "s.slot", (F.col("start") + F.col("local")).alias("rank"), "s.blocks").where("rank < blocks").drop("blocks")
    # a source that the points served short by a few blocks gets them at the end of the schedule
    short = own.where("hi - lo < blocks").select("source", F.explode(F.sequence(F.col("hi") - F.col("lo"), F.col("blocks") - 1)).alias("rank"))
    return ranked.unionByName(short.select("source", (F.lit(n) + F.col("rank")).alias("slot"), "rank"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, repeat: int = 2, block_words: int = 128, seed: str = "mix-1") -> tuple[DataFrame, DataFrame]:
    """The pieces of the mix, and one row per document.

    Pieces (source, slot, rank, id, from_word, n_words): read in the order of (slot, from_word of the
    stream) they are the mix. Documents: id, source, size, source_size, target, taken, first_slot (null if nothing
    is taken) and pieces, an array (slot, from_word, n_words) in the schedule's order; rows alike in id, source and
    size have one list in common.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), count_words(F.col(f"`{text_col}`")).alias("size"))
    shuffle = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    base = materialize(base.select("id", "source", "size", shuffle.alias("mix")), "sizes")
    targets = materialize(source_targets(base.select("source", "size"), weights, percent, repeat), "targets")

    # stream: the source's documents in the order of (mix, id), as bucket sums and windows within a bucket
    rows = base.where("size > 0")
    per = rows.groupBy("source").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / BUCKET_ROWS)).cast("long").alias("buckets"))
    bucket = F.floor(F.conv(F.substring("mix", 1, 8), 16, 10).cast("long") * F.col("buckets") / F.lit(1 << 32))
    rows = rows.alias("r").join(F.broadcast(per.alias("p")) if per.count() < 100_000 else per.alias("p"), F.expr("r.source <=> p.source")).select("r.*", bucket.cast("long").alias("bucket"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    start = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("source", "bucket", start.alias("base"))
    order = Window.partitionBy("source", "bucket").orderBy("mix", F.col("id").asc_nulls_first(), "size")
    inner = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rows = rows.withColumn("inner", inner).alias("r").join(sums.alias("s"), F.expr("r.source <=> s.source and r.bucket = s.bucket"))
    rows = rows.select("r.id", "r.mix", "r.source", "r.size", (F.col("base") + F.col("inner")).alias("at"))
    rows = rows.alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source")).select("r.*", "t.source_size", "t.quota")

    # pieces: what each block holds of each document, in each of the passes through the source
    passes = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("lap")).withColumn("lo", F.col("at") + F.col("lap") * F.col("source_size"))
    passes = passes.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("quota"))).where("lo < hi")
    blocks = passes.select("*", F.explode(F.sequence(F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words))).alias("rank"))
    lo, hi = F.greatest("lo", F.col("rank") * block_words), F.least("hi", (F.col("rank") + 1) * block_words)
    blocks = blocks.select("id", "mix", "source", "size", "rank", (lo - F.col("lo")).alias("from_word"), (hi - lo).alias("n_words"))

    needed = targets.agg(F.coalesce(F.sum(F.ceil(F.col("quota") / block_words)), F.lit(0)).cast("long")).first()[0]
    bits = max(0, (needed - 1).bit_length())
    slots = _schedule(targets, block_words, bits)
    pieces = blocks.alias("b").join(slots.alias("s"), F.expr("b.source <=> s.source and b.rank = s.rank")).select("b.source", "s.slot", "b.rank", "b.id", "b.size", "b.from_word", "b.n_words")

    # a row's pieces are found again by (id, source, size); equal rows share their sum evenly, the first ones getting the rest
    taken = pieces.groupBy("id", "source", "size").agg(
        F.sum("n_words").alias("words"), F.min("slot").alias("first_slot"), F.array_sort(F.collect_list(F.struct("slot", "from_word", "n_words"))).alias("pieces")
    )
    alike = Window.partitionBy("id", "source", "size")
    whole = base.select("id", "source", "size", (F.row_number().over(alike.orderBy("mix")) - 1).alias("nth"), F.count(F.lit(1)).over(alike).alias("alike"))
    whole = whole.alias("d").join(taken.alias("k"), F.expr("d.id <=> k.id and d.source <=> k.source and d.size = k.size"), "left")
    share = F.floor(F.col("words") / F.col("alike")) + F.when(F.col("nth") < F.col("words") % F.col("alike"), 1).otherwise(0)
    whole = whole.select("d.id", "d.source", "d.size", F.coalesce(share, F.lit(0)).cast("long").alias("taken"), "k.first_slot", F.coalesce("k.pieces", F.array().cast("array<struct<slot:bigint,from_word:bigint,n_words:bigint>>")).alias("pieces"))
    out = whole.alias("w").join(targets.alias("t"), F.expr("w.source <=> t.source"))
    out = out.select(F.col("w.id").alias(id_col), F.col("w.source").alias(source_col), "w.size", "t.source_size", "t.target", "w.taken", "w.first_slot", "w.pieces")
    return pieces, out

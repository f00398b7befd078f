"""Exact dedup by a content sort.

Sampled splitters range-partition the normalised texts, Spark's external sort places equal texts
next to one another, and a window over the sorted rows compares each text with its neighbour in
full; of equal texts one row stays. Only DataFrame functions are used.

* The splitters are sampled from the first 64 characters and a 64-bit hash of a text, so that what
  the driver holds is bounded however long the texts are. Equal texts agree in both, and rows
  sort by both before the whole text decides.
* A text with ``hot_rows`` copies or more is split over several ranges by a salt from the id; the
  ranges' winners, one row per range, are then compared in full once more. No task ever
  holds more than its range.

Defined results: a null text counts as empty; a null id never stays unless its whole group has null
ids; of rows that repeat an id within a group one stays; other columns, whatever their names, are
carried along untouched; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.llm.common import materialize, text_of

#: Up to so many hot texts their hashes (16 bytes each) are broadcast; beyond, they are joined by a shuffle.
BROADCAST_HOT = 200_000


def _keyed(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column] | None, hot_rows: int) -> tuple[DataFrame, int]:
    """Rows with their key (the normalised text), its hash, and salts: over how many blocks a hot text is split, else null; and how many texts are."""
    key = text_of(text_col)
    key = normalise(key) if normalise else key
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").isNull().alias("no_text"),
        F.col(f"`{text_col}`").alias("text") if normalise else F.lit(None).cast("string").alias("text"),
        key.alias("key"),
    ).withColumn("hash", F.xxhash64("key"))
    hot = base.groupBy("hash").count().where(F.col("count") >= hot_rows)
    hot = materialize(hot.select("hash", F.ceil(F.col("count") / hot_rows).cast("long").alias("salts")), "hot-texts")
    n = hot.count()
    if not n:
        return base.withColumn("salts", F.lit(None).cast("long")), 0
    return base.join(F.broadcast(hot) if n <= BROADCAST_HOT else hot, "hash", "left"), n


def _sorted_blocks(base: DataFrame, n_hot: int, largest: bool) -> DataFrame:
    """Rows with sha, hot, place (1: the first of its block), block_id and block_size."""
    # a constant salt would keep the planner from seeing that ranges hold whole blocks
    salt = ["salt"] if n_hot else []
    base = base.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(0).cast("long")))
    base = base.withColumn("lead", F.substring("key", 1, 64)).repartitionByRange("lead", "hash", *salt)
    block = Window.partitionBy("lead", "hash", "key", *salt)
    order = F.col("id").desc_nulls_last() if largest else F.col("id").asc_nulls_last()
    return base.select(
        "rest", "id", "no_text", "text", "key",
        F.sha2("key", 256).alias("sha"),
        F.col("salts").isNotNull().alias("hot"),
        F.row_number().over(block.orderBy(order)).alias("place"),
        F.first("id").over(block.orderBy(order)).alias("block_id"),
        F.count(F.lit(1)).over(block).alias("block_size"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None, largest: bool = False, hot_rows: int = 1000) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    blocks = _sorted_blocks(*_keyed(docs, id_col, text_col, normalise, hot_rows), largest)
    key = F.when(F.col("hot") & (F.col("place") == 1), F.col("key")).alias("key")
    blocks = materialize(blocks.select("id", key, "sha", "hot", "place", "block_id", "block_size"), "blocks")
    # the first rows of a hot text's blocks, compared in full
    pick = F.max if largest else F.min
    first = blocks.where("hot and place = 1").groupBy("key", "sha")
    merged = first.agg(pick("block_id").alias("all_id"), F.sum("block_size").alias("all_size")).drop("key")
    cold = blocks.where("not hot").select("id", F.col("block_id").alias("keep_id"), F.col("block_size").alias("group_size"), (F.col("place") == 1).alias("kept"), "sha")
    hot = blocks.where("hot").join(merged, "sha")
    kept = (F.col("place") == 1) & F.col("block_id").eqNullSafe(F.col("all_id"))
    hot = hot.select("id", F.col("all_id").alias("keep_id"), F.col("all_size").alias("group_size"), kept.alias("kept"), "sha")
    both = cold.unionByName(hot)
    return both.select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None, largest: bool = False, hot_rows: int = 1000) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    base, n_hot = _keyed(docs, id_col, text_col, normalise, hot_rows)
    first = _sorted_blocks(base, n_hot, largest).where("place = 1")
    if n_hot:
        # a hot text's winner over all blocks; equal texts are combined before the shuffle, so it moves a row per text and task
        pick = F.max if largest else F.min
        winners = base.where("salts is not null").groupBy("key").agg(pick("id").alias("all_id")).select(F.sha2("key", 256).alias("sha"), "all_id", F.lit(True).alias("won"))
        # where ids repeat over blocks they share the salt, so the block too: a text has one winner
        winners = F.broadcast(winners) if n_hot <= BROADCAST_HOT else winners
        first = first.join(winners, first.hot & (first.sha == winners.sha) & first.block_id.eqNullSafe(winners.all_id), "left").where("not hot or won")
    text = F.when(~F.col("no_text"), F.col("text") if normalise else F.col("key"))
    return first.select([text.alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])

"""Health of a pipeline's stages: what is there, missing, orphaned, empty or corrupt, and what to do about it.

A stage is a table (key, namespace, size): listings of files carry all that is needed, no content is read. Repairs are a table of actions;
applying them is up to the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("extracted", "chunks", "embeddings")


def listing(files: DataFrame, suffix: str) -> DataFrame:
    """Of file metadata (path, length, as from the binaryFile source without its content): key, namespace, size; metadata folders are left out."""
    parts = F.split("path", "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    own = files.where(F.col("path").endswith(suffix) & ~F.array_contains(parts, "articles"))
    return own.select(F.concat_ws("/", F.element_at(parts, -2), stem).alias("key"), F.element_at(parts, -2).alias("namespace"), F.col("length").alias("size"))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    own = reduce(DataFrame.unionByName, [df.select(F.lit(s).alias("stage"), "size") for s, df in stages.items()])
    return own.groupBy("stage").agg(F.count("*").alias("total"), F.count_if(F.col("size") > 0).alias("non_empty"), F.count_if(F.col("size") == 0).alias("empty"))


def gaps(stages: dict[str, DataFrame]) -> DataFrame:
    """(kind, key): missing_chunks, missing_embeddings (of non-empty chunks), orphan_chunks, orphan_embeddings."""
    a, b, c = (stages[s].select("key", "size") for s in STAGES)
    parts = [
        ("missing_chunks", a.join(b, "key", "left_anti")),
        ("missing_embeddings", b.where("size > 0").join(c, "key", "left_anti")),
        ("orphan_chunks", b.join(a, "key", "left_anti")),
        ("orphan_embeddings", c.join(b, "key", "left_anti")),
    ]
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind"), "key") for k, df in parts])


def empty_by_namespace(extracted: DataFrame) -> DataFrame:
    return extracted.where("size = 0").groupBy("namespace").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "namespace")


def duplication(rows: DataFrame, key: str, value: str, threshold: float = 0.1) -> DataFrame:
    """Per key total, distinct and duplicate values, their ratio, and whether it is over the threshold."""
    per = rows.groupBy(key).agg(F.count(value).alias("total"), F.count_distinct(value).alias("distinct_values")).where("total > 0")
    per = per.withColumn("duplicates", F.col("total") - F.col("distinct_values")).withColumn("ratio", F.col("duplicates") / F.col("total"))
    return per.withColumn("corrupt", F.col("ratio") > threshold)


def verdict(stages: dict[str, DataFrame], duplicates: DataFrame | None = None) -> DataFrame:
    """One row: counts of what is wrong, and whether all is well; empty chunks and embeddings don't count."""
    counts = gaps(stages).groupBy().pivot("kind", ["missing_chunks", "missing_embeddings", "orphan_chunks", "orphan_embeddings"]).count().na.fill(0)
    counts = counts.crossJoin(stages["extracted"].agg(F.count_if(F.col("size") == 0).alias("empty_extracted")))
    bad = duplicates.agg(F.count_if("corrupt").alias("corrupt")) if duplicates is not None else counts.sparkSession.range(1).select(F.lit(0).cast("long").alias("corrupt"))
    counts = counts.crossJoin(bad)
    total = reduce(lambda x, y: x + y, [F.col(c) for c in counts.columns])
    return counts.withColumn("healthy", total == 0)


def report(stages: dict[str, DataFrame], duplicates: DataFrame | None = None, most: int = 50) -> DataFrame:
    """One row of JSON: counts, the first keys of each kind, the worst ratios."""
    found = gaps(stages)
    first = found.distinct().withColumn("_rank", F.row_number().over(Window.partitionBy("kind").orderBy("key"))).where(F.col("_rank") <= most)  # each task keeps its first ones
    keys = first.groupBy("kind").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    listed = found.groupBy("kind").agg(F.count("*").alias("n")).join(keys, "kind").select("kind", "n", "keys")
    out = verdict(stages, duplicates).select(F.struct("*").alias("summary"))
    out = out.crossJoin(stage_counts(stages).agg(F.array_sort(F.collect_list(F.struct("*"))).alias("stages")))
    out = out.crossJoin(listed.agg(F.array_sort(F.collect_list(F.struct("*"))).alias("gaps")))
    if duplicates is not None:
        worst = duplicates.where("corrupt").orderBy(F.desc("ratio")).limit(most)
        out = out.crossJoin(worst.agg(F.collect_list(F.struct("*")).alias("corrupt")))
    return out.select(F.to_json(F.struct("*")).alias("report"))


def repairs(stages: dict[str, DataFrame], duplicates: DataFrame | None = None, sources: DataFrame | None = None, stage: str | None = None) -> DataFrame:
    """(stage, key, action): delete_empty, delete_orphan, delete_corrupt, reprocess_empty or, if its source is missing, source_missing."""
    parts = [df.where("size = 0").select(F.lit(s).alias("stage"), "key", F.lit("delete_empty").alias("action")) for s, df in stages.items()]
    orphans = gaps(stages).where("kind like 'orphan%'")
    parts.append(orphans.select(F.replace("kind", F.lit("orphan_"), F.lit("")).alias("stage"), "key", F.lit("delete_orphan").alias("action")))
    if duplicates is not None:
        parts.append(duplicates.where("corrupt").select(F.lit("chunks").alias("stage"), "key", F.lit("delete_corrupt").alias("action")))
    if sources is not None:
        empty = stages["extracted"].where("size = 0").select("key")
        there = sources.select("key").distinct().withColumn("there", F.lit(True))
        parts.append(empty.join(there, "key", "left").select(F.lit("extracted").alias("stage"), "key", F.when(F.col("there"), "reprocess_empty").otherwise("source_missing").alias("action")))
    out = reduce(DataFrame.unionByName, parts)
    return out.where(F.col("stage") == stage) if stage else out


def apply_deletions(actions: DataFrame, roots: dict[str, str], suffixes: dict[str, str], dry_run: bool = True) -> list[str]:
    """Delete the files of delete actions under the stages' folders; a key that leads out of its folder is refused. Returns the paths."""
    spark = actions.sparkSession
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = []
    for r in actions.where("action like 'delete%'").toLocalIterator():  # a bounded buffer, not the whole list
        if ".." in r.key.split("/") or r.key.startswith("/"):
            raise ValueError(f"key leads out of its folder: {r.key}")
        path = path_of(f"{roots[r.stage]}/{r.key}{suffixes[r.stage]}")
        if not dry_run:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
        done.append(path.toString())
    return done


def resume(inputs: DataFrame, outputs: DataFrame, key: str = "key") -> DataFrame:
    """The inputs without an output."""
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def sample(rows: DataFrame, n: int, key: str, seed: str = "0") -> DataFrame:
    """``n`` rows, the same ones each time: those with the least hashes."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key).limit(n)

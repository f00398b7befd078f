"""Matrices in NPY files, read and written through Spark's file systems.

Reading gives (path, row_idx, embedding): files come as binary rows, of less than 2 GB each, and leave Python in batches of their rows. Writing
makes files of a bounded number of rows, in the partition's order; Spark's writer commits them, so a lost task leaves none.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = 1024
ROWS_PER_FILE = 16_384


def _parsed(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in files:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            matrix = np.load(io.BytesIO(content), allow_pickle=False).astype(np.float32, copy=False)
            for i in range(0, len(matrix), BATCH):
                part = matrix[i : i + BATCH]
                yield pd.DataFrame({"path": path, "row_idx": np.arange(i, i + len(part), dtype=np.int64), "embedding": list(part)})


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    """All matrices under a path of any file system that Spark reads."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npy").load(path)
    return files.select("path", "content").mapInPandas(_parsed, "path string, row_idx bigint, embedding array<float>")


def write_npy(df: DataFrame, path: str, embedding_col: str = "embedding", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Add files to a folder. Vectors of a partition must have one length; without rows no file is made."""
    run = uuid.uuid4().hex[:8]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        partition, n, held = TaskContext.get().partitionId(), 0, []

        def file() -> pd.DataFrame:
            out = io.BytesIO()
            np.save(out, np.stack(held).astype(np.float32), allow_pickle=False)
            return pd.DataFrame({"part": [f"part-{partition:05d}-{n:05d}-{run}"], "content": [out.getvalue()]})

        for batch in batches:
            for vector in batch["embedding"]:
                held.append(np.asarray(vector, np.float32))
                if len(held) == rows_per_file:
                    yield file()
                    n, held = n + 1, []
        if held:
            yield file()

    spark, staging = df.sparkSession, f"{path.rstrip('/')}/_{run}"
    made = df.select(F.col(embedding_col).cast("array<float>").alias("embedding")).mapInPandas(blocks, "part string, content binary")
    # the text sink writes a value's bytes as they are; the line end behind a matrix is not read
    made.select("part", F.col("content").cast("string").alias("value")).write.partitionBy("part").text(staging)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path_of(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(path_of(staging)):
        if folder.isDirectory():
            name = folder.getPath().getName().removeprefix("part=")
            file = next(s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-"))
            if not fs.rename(file, path_of(f"{path.rstrip('/')}/{name}.npy")):
                raise OSError(f"could not move {file}")
    fs.delete(path_of(staging), True)


def paired(chunks: DataFrame, vectors: DataFrame, key: str = "article") -> tuple[DataFrame, DataFrame]:
    """Chunks (article, row_idx, ...) with the vectors of the same place; and the articles whose counts differ, which are left out."""
    counts = chunks.groupBy(key).agg(F.count("*").alias("n_chunks")).join(vectors.groupBy(key).agg(F.count("*").alias("n_vectors")), key)
    bad = counts.where("n_chunks <> n_vectors")
    good = chunks.join(vectors.select(key, "row_idx", "embedding"), [key, "row_idx"]).join(bad.select(key), key, "left_anti")
    return good, bad

"""The stages from raw articles to answers: extract, chunk, embed, load, search; each resumes where it left off."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexquarry.operators import health
from lexquarry.operators.articles import extract_articles
from lexquarry.operators.chunking import ChunkConfig, TokenCounter, chunk_records, chunks, filter_stats, keep_chunks, quarter
from lexquarry.operators.embedding import EmbedConfig, HashingProvider, Provider, embed_chunks, preflight
from lexquarry.operators.search import checked_limit, rendered, search
from lexquarry.operators.store import Collection
from lexquarry.sources.files import NAMESPACES, articles


@dataclass
class Result:
    """What a stage did; ``ok`` is false if rows failed."""

    stage: str
    counts: dict[str, int] = field(default_factory=dict)
    seconds: float = 0.0

    @property
    def ok(self) -> bool:
        return not self.counts.get("errors")


class Pipeline:
    """Stages under one folder, each a Parquet table that later runs add to."""

    def __init__(self, spark: SparkSession, folder: str, config: ChunkConfig = ChunkConfig(), embed_config: EmbedConfig = EmbedConfig(), provider: Provider | None = None, count: TokenCounter = quarter):
        self.spark, self.folder, self.config, self.embed_config, self.count = spark, folder.rstrip("/"), config, embed_config, count
        self.provider = provider or HashingProvider(embed_config.dimensions)
        self.collection = Collection(spark, self.folder, "collection")

    def path(self, stage: str) -> str:
        return f"{self.folder}/{stage}"

    def _there(self, stage: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(stage))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def table(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage))

    def _todo(self, rows: DataFrame, stage: str, keys: list[str], sample: int | None) -> DataFrame:
        if self._there(stage):
            rows = rows.join(self.table(stage).select(*keys).distinct(), keys, "left_anti")
        return health.sample(rows, sample, keys[-1]) if sample else rows

    def _write(self, rows: DataFrame, stage: str, **counts) -> Result:
        began, seen = time.time(), Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]).write.mode("append").parquet(self.path(stage))
        return Result(stage, {k: int(v or 0) for k, v in seen.get.items()}, time.time() - began)

    def extract(self, root: str, namespaces: tuple[str, ...] = NAMESPACES, flat: bool = False, sample: int | None = None) -> Result:
        raw = self._todo(articles(self.spark, root, namespaces, flat), "articles", ["namespace", "title"], sample)
        return self._write(extract_articles(raw).drop("markup"), "articles", empty=F.count_if(F.col("clean_text") == ""))

    def reprocess_empty(self, root: str, namespaces: tuple[str, ...] = NAMESPACES, flat: bool = False) -> Result:
        """Extract articles without text again; those whose source is gone are errors. The table is replaced by a new one, written first."""
        began, keys = time.time(), ["namespace", "title"]
        old = self.table("articles")
        empty = old.where("clean_text = ''").select(*keys)
        found = extract_articles(articles(self.spark, root, namespaces, flat).join(empty, keys, "left_semi")).drop("markup").select(*old.columns)
        kept = old.join(found.select(*keys), keys, "left_anti").select(*old.columns)
        kept.unionByName(found).write.mode("overwrite").parquet(self.path("articles-new"))
        new = self.table("articles-new").join(empty, keys, "left_semi")
        counts = {"rows": new.where("clean_text <> ''").count(), "errors": empty.join(articles(self.spark, root, namespaces, flat), keys, "left_anti").count()}
        path_of = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path_of(self.path("articles")).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path_of(self.path("articles")), True)
        fs.rename(path_of(self.path("articles-new")), path_of(self.path("articles")))
        return Result("articles", counts, time.time() - began)

    def chunk(self, sample: int | None = None) -> Result:
        rows = self._todo(self.table("articles"), "chunked", ["namespace", "title"], sample)
        found = rows.withColumn("_f", chunks(F.col("clean_text"), self.config, self.count)).withColumn("_k", keep_chunks(F.col("_f"), self.config.min_words))
        out = self._write(chunk_records(rows, self.config, self.count), "chunks")
        stats = self._write(found.select("namespace", "title", filter_stats(F.col("_f"), F.col("_k"), self.config.min_words).alias("s")).select("namespace", "title", "s.*"), "chunked", micro=F.sum("micro_chunks_filtered"), duplicates=F.sum("consecutive_duplicates_removed"))
        return Result("chunks", {"articles": stats.counts["rows"], "chunks": out.counts["rows"], "micro": stats.counts["micro"], "duplicates": stats.counts["duplicates"]}, out.seconds + stats.seconds)

    def embed(self, sample: int | None = None) -> Result:
        preflight(self.provider, self.embed_config)
        rows = self._todo(self.table("chunks"), "embedded", ["chunk_id"], sample)
        return self._write(embed_chunks(rows, self.provider, self.embed_config), "embedded", errors=F.count_if(F.col("embedding_error").isNotNull()))

    def load(self, mode: str = "insert_ignore") -> Result:
        began = time.time()
        rows = self.table("embedded").where("embedding is not null").drop("embedding_error")
        before = self.collection.count()
        self.collection.add(rows, mode)
        return Result("collection", {"rows": self.collection.count(), "added": self.collection.count() - before}, time.time() - began)

    def search(self, query: str, limit: int = 5, where: dict | None = None, where_document: dict | None = None) -> DataFrame:
        vector = self.provider([query])[0]
        return search(self.collection.rows(), vector, checked_limit(limit), where, where_document)

    def answer(self, query: str, limit: int = 5, where: dict | None = None) -> str:
        return rendered(self.search(query, limit, where))

    def stages(self) -> dict[str, DataFrame]:
        """Stage tables for :mod:`lexquarry.operators.health`: one row per article with the size of what it has."""
        key = F.concat_ws("/", "namespace", "title").alias("key")
        out = {"extracted": self.table("articles").select(key, "namespace", F.length("clean_text").cast("long").alias("size"))}
        per = self.table("chunked").select(key, "namespace", F.col("chunks_written").alias("size"))
        done = self.table("embedded").groupBy("namespace", F.col("article_title").alias("title")).agg(F.count("embedding").alias("size"))
        return out | {"chunks": per, "embeddings": done.select(key, "namespace", "size")}

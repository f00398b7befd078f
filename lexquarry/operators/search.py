"""Exact nearest neighbours over a table of vectors, with filters, and what is made of the results.

A query is filter, projection and a bounded top list: each task keeps its best k, so nothing is sorted or
gathered. Many queries share one pass, each with its own top list by a window over partial lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.operators.filters import where as compile_where
from lexquarry.operators.filters import where_document as compile_document

LEAST_LIMIT, DEFAULT_LIMIT, MOST_LIMIT = 1, 5, 20
NOTHING = "No results found. Try a different query or broaden your search terms."
#: Queries that are broadcast together, at most; more are answered in blocks.
QUERIES_AT_ONCE = 1000


def dot(a: Column, b: Column) -> Column:
    """A dot product in doubles; a loop in generated code, as arrays have no built-in one."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def vector_column(vector: Sequence[float]) -> Column:
    """A vector as one constant; an expression per number would take the planner longer than the search."""
    return F.split(F.lit(",".join(repr(float(x)) for x in vector)), ",").cast("array<double>")


def with_norms(rows: DataFrame, embedding_col: str = "embedding", norm_col: str = "squared_norm") -> DataFrame:
    """``rows`` with each vector's product with itself, to be stored beside it."""
    return rows.withColumn(norm_col, dot(F.col(embedding_col), F.col(embedding_col)))


def distance(a: Column, b: Column, metric: str = "cosine", a_norm: Column | None = None, b_norm: Column | None = None) -> Column:
    """cosine: 1 - cosine; l2: squared distance; ip: 1 - dot product. Vectors of unequal length fail. Squared norms that are known save a pass each."""
    if metric == "cosine":
        out = 1 - dot(a, b) / F.sqrt((dot(a, a) if a_norm is None else a_norm) * (dot(b, b) if b_norm is None else b_norm))
    elif metric == "l2":
        out = F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    elif metric == "ip":
        out = 1 - dot(a, b)
    else:
        raise ValueError(f"unknown metric {metric}")
    return F.when(F.size(a) == F.size(b), out).otherwise(F.raise_error(F.lit("vectors of unequal length")).cast("double"))


def checked_limit(limit: int) -> int:
    if not LEAST_LIMIT <= limit <= MOST_LIMIT:
        raise ValueError(f"limit must be between {LEAST_LIMIT} and {MOST_LIMIT}, got {limit}")
    return limit


def search(rows: DataFrame, vector: Sequence[float], limit: int = 10, where: dict | None = None, where_document: dict | None = None, metric: str = "cosine", id_col: str = "chunk_id", embedding_col: str = "embedding", text_col: str = "text", norm_col: str | None = None) -> DataFrame:
    """The nearest rows, with their distance and score (1 - distance); equal distances by id. ``norm_col``: see :func:`with_norms`."""
    kept = rows.where(compile_where(where))
    if where_document:
        kept = kept.where(compile_document(where_document, F.col(text_col)))
    own = 0.0
    for x in vector:  # in the order of the JVM's sum
        own += float(x) * float(x)
    norm = F.col(norm_col) if norm_col else None
    found = kept.withColumn("distance", distance(F.col(embedding_col), vector_column(vector), metric, norm, F.lit(own))).withColumn("score", 1 - F.col("distance"))
    return found.orderBy("distance", id_col).limit(limit)


def search_many(rows: DataFrame, queries: DataFrame, limit: int = 10, metric: str = "cosine", id_col: str = "vec_id", embedding_col: str = "embedding", query_id: str = "query_id", query_col: str = "query", norm_col: str | None = None) -> DataFrame:
    """(query_id, id, distance, rank) of the nearest rows of each query; queries are broadcast in blocks of a fixed size. Each row's norm is summed once."""
    rows, norm_col = (rows, norm_col) if norm_col else (with_norms(rows, embedding_col, "_norm"), "_norm")
    queries = with_norms(queries, query_col, "_query_norm")
    total = queries.count()
    blocks = max(1, -(-total // QUERIES_AT_ONCE))
    out = None
    for b in range(blocks):
        own = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == b)
        pairs = rows.select(F.col(id_col), F.col(embedding_col), F.col(norm_col).alias("_norm")).crossJoin(F.broadcast(own.select(query_id, query_col, "_query_norm")))
        pairs = pairs.select(query_id, id_col, distance(F.col(embedding_col), F.col(query_col), metric, F.col("_norm"), F.col("_query_norm")).alias("distance"))
        rank = F.row_number().over(Window.partitionBy(query_id).orderBy("distance", id_col))
        part = pairs.withColumn("rank", rank).where(F.col("rank") <= limit)  # Spark keeps partial lists before the shuffle
        out = part if out is None else out.unionByName(part)
    return out


def page(rows: DataFrame, id_col: str, offset: int, limit: int, where: dict | None = None) -> DataFrame:
    return rows.where(compile_where(where)).orderBy(id_col).offset(offset).limit(limit)


def article_chunks(rows: DataFrame, title: str, namespace: str = "Main") -> DataFrame:
    return rows.where((F.col("article_title") == title) & (F.col("namespace") == namespace)).orderBy("chunk_index")


def article_text(rows: DataFrame, title: str, namespace: str = "Main") -> str:
    """The chunks of an article, joined; a message if there is none. One article is small enough to be collected."""
    parts = [r.text for r in article_chunks(rows, title, namespace).select("text", "chunk_index").collect()]
    return "\n\n".join(parts) if parts else f"Article not found: {title} ({namespace})"


def category_counts(rows: DataFrame) -> DataFrame:
    """category, n_articles; alphabetical."""
    own = rows.select("namespace", "article_title", F.explode("categories").alias("category")).distinct()
    return own.groupBy("category").agg(F.count("*").alias("n_articles")).orderBy("category")


def rendered(found: DataFrame) -> str:
    """A page of results as Markdown; at most ``MOST_LIMIT`` rows are collected."""
    parts = []
    for r in found.limit(MOST_LIMIT).collect():
        r = r.asDict()
        get = lambda k, d: r.get(k, d)
        parts.append(f"**{get('article_title', 'Unknown')}** ({get('namespace', 'Unknown')}, §{get('section', None) or '(none)'}, lines {get('line_range', '?')}) [score: {1 - r['distance']:.2f}]:\n> {r['text']}")
    return "\n\n".join(parts) or NOTHING


def retrieval_metrics(ranked: DataFrame, relevant: DataFrame, k: int = 5, depth: int = 10) -> DataFrame:
    """ranked (query_id, id, rank), relevant (query_id, id) -> per query precision and recall at k, reciprocal rank, nDCG."""
    hits = ranked.join(relevant.withColumn("hit", F.lit(1)), ["query_id", "id"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    wanted = relevant.groupBy("query_id").agg(F.count("*").alias("wanted"))
    gain = F.when(F.col("rank") <= depth, F.col("hit") / F.log2(F.col("rank") + 1)).otherwise(0.0)
    per = hits.groupBy("query_id").agg(
        F.sum(F.when(F.col("rank") <= k, F.col("hit")).otherwise(0)).alias("found"),
        F.max(F.when(F.col("hit") == 1, 1 / F.col("rank")).otherwise(0.0)).alias("reciprocal_rank"),
        F.sum(gain).alias("dcg"),
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("wanted"), F.lit(depth)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + F.lit(1)))
    per = per.join(wanted, "query_id")
    return per.select("query_id", (F.col("found") / k).alias("precision_at_k"), (F.col("found") / F.col("wanted")).alias("recall_at_k"), "reciprocal_rank", (F.col("dcg") / ideal).alias("ndcg"))

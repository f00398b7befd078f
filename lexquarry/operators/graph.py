"""The graph of links and categories, and the table of references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def degrees(links: DataFrame) -> DataFrame:
    """links (source, target) -> node, in_degree, out_degree over distinct links."""
    own = links.select("source", "target").distinct()
    ends = own.select(F.explode(F.array(F.struct(F.col("source").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("target").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e"))
    return ends.groupBy(F.col("e.node").alias("node")).agg(F.sum("e.i").alias("in_degree"), F.sum("e.o").alias("out_degree"))


def backlinks(links: DataFrame, target: str) -> DataFrame:
    return links.where(F.col("target") == target).select("source").distinct()


def cooccurrence(categories: DataFrame) -> DataFrame:
    """(article, category) -> a < b, n: pairs of categories of the same article. An article has few, so its pairs are made in place."""
    per = categories.groupBy("article").agg(F.array_sort(F.collect_set("category")).alias("cs"))
    pairs = F.flatten(F.transform("cs", lambda a, i: F.transform(F.slice("cs", i + 2, F.size("cs")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return per.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def boosted(found: DataFrame, popularity: DataFrame, id_col: str, take: int = 10) -> DataFrame:
    """A top list reordered by in-degree, the most linked first, then by distance."""
    own = found.join(popularity.select(F.col("node").alias(id_col), "in_degree"), id_col, "left").withColumn("in_degree", F.coalesce("in_degree", F.lit(0)))
    return own.orderBy(F.desc("in_degree"), "distance", id_col).limit(take)


def related(links: DataFrame, article: str) -> DataFrame:
    """Articles by the number of targets that they share with one article."""
    own = links.where(F.col("source") == article).select("target").distinct()
    other = links.where(F.col("source") != article).select("source", "target").distinct()
    return other.join(own, "target").groupBy("source").agg(F.count("*").alias("shared")).orderBy(F.desc("shared"), "source")


def explore(links: DataFrame, start: str, hops: int = 2) -> DataFrame:
    """(node, hops): what can be reached in so many steps, with the fewest that it takes."""
    edges = links.select("source", "target").distinct()
    seen = edges.sparkSession.createDataFrame([(start, 0)], "node string, hops int")
    front = seen
    for i in range(1, hops + 1):
        nodes = front.join(edges, front.node == edges.source).select(F.col("target").alias("node")).distinct()
        front = nodes.join(seen, "node", "left_anti").withColumn("hops", F.lit(i))
        seen = seen.unionByName(front)
    return seen


def with_ref_id(citations: DataFrame) -> DataFrame:
    key = F.concat_ws("|", F.lower(F.coalesce("author", F.lit(""))), F.coalesce("year", F.lit("")), F.lower(F.coalesce("title", F.lit(""))))
    return citations.withColumn("ref_id", F.sha2(key, 256))


def references(citations: DataFrame) -> DataFrame:
    """(article, author, year, title) -> ref_id, the number of citations and of articles that cite."""
    own = with_ref_id(citations)
    return own.groupBy("ref_id").agg(F.min("author").alias("author"), F.min("year").alias("year"), F.min("title").alias("title"), F.count("*").alias("n_citations"), F.count_distinct("article").alias("n_articles"))


def citing_articles(citations: DataFrame) -> DataFrame:
    """(ref_id, article), each pair once: a row each, as a reference may be cited by any number of articles."""
    return with_ref_id(citations).select("ref_id", "article").distinct()

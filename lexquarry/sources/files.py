"""Files as tables: articles, chunk and question files, and the tables that stand for folders of a pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.functions.markup import namespace_of_name

#: Namespaces are configuration; the first one is the default.
NAMESPACES = ("Main", "Library", "Essays", "Project")
PREFIXES = {"Essay_": "Essays", "Library_": "Library", "Project_": "Project"}

CHUNK_SCHEMA = (
    "chunk_id string, text string, article_title string, namespace string, section string, chunk_index int, line_range string, word_count int, "
    "categories array<string>, internal_links array<string>, is_stub boolean, citation_needed_count int, has_blockquote boolean, "
    "library_work_author string, library_work_type string, library_work_published_year int, infobox_type string, "
    "political_orientation array<string>, primary_category string, category_count int"
)
METADATA_SCHEMA = (
    "title string, namespace string, categories array<string>, internal_links array<struct<target:string,display:string>>, sections array<string>, "
    "is_stub boolean, citation_needed_count int, has_blockquote boolean, source_file string"
)
QA_SCHEMA = "qa_id string, instruction string, response string"


def title_of(path: Column) -> Column:
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.replace(stem, F.lit("_"), F.lit(" "))


def empty_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, length) of files of no bytes, which all of Spark's sources leave out; found by listing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    empty = []
    while found.hasNext():
        status = found.next()
        name = status.getPath().toString()
        if status.getLen() == 0 and name.endswith(suffix):
            empty.append((name, 0))
    return spark.createDataFrame(empty, "path string, length bigint")


def articles(spark: SparkSession, root: str, namespaces: tuple[str, ...] = NAMESPACES, flat: bool = False, with_empty: bool = True) -> DataFrame:
    """(path, namespace, title, markup): text files under the namespaces' folders or, if ``flat``, all, the namespace by the name's beginning."""
    rows = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("markup"))
    if with_empty:
        rows = rows.unionByName(empty_files(spark, root, ".txt").select("path", F.lit("").alias("markup")))
    parts = F.split("path", "/")
    if flat:
        return rows.select("path", namespace_of_name(F.element_at(parts, -1), PREFIXES, namespaces[0]).alias("namespace"), title_of(F.col("path")).alias("title"), "markup")
    folder = F.get(F.filter(parts, lambda p: p.isin(*namespaces)), F.lit(0))
    return rows.select("path", folder.alias("namespace"), title_of(F.col("path")).alias("title"), "markup").where("namespace is not null")


def texts_any_encoding(spark: SparkSession, root: str) -> DataFrame:
    """(path, text): files as UTF-8 or, if they aren't, as Latin-1."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)
    return rows.select("path", F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise(F.decode("content", "ISO-8859-1")).alias("text"))


def file_listing(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, length) of files, empty ones too; their content is not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root).select("path", "length")
    return rows.unionByName(empty_files(spark, root, suffix))


def write_articles(df: DataFrame, path: str) -> None:
    """Extracted articles as Parquet by namespace; (namespace, title) is the key, so that names may repeat over namespaces."""
    df.write.mode("overwrite").partitionBy("namespace").parquet(path)


def write_texts(df: DataFrame, path: str) -> None:
    """Clean texts as JSON lines with their names, for tools that read text."""
    df.select("namespace", "title", "clean_text").write.mode("overwrite").partitionBy("namespace").json(path)


def write_chunks(df: DataFrame, path: str) -> None:
    """Chunks as JSON lines, one object a line, nulls written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK_SCHEMA).json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).option("multiLine", True).json(path)


def with_metadata(texts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Texts (namespace, title, ...) with their metadata by both names, else by the title alone, else defaults and ``missing_metadata``."""
    own = metadata.select("namespace", "title", F.struct(*[c for c in metadata.columns if c not in ("namespace", "title")]).alias("m"))
    by_title = own.groupBy("title").agg(F.min_by("m", "namespace").alias("m2"))
    out = texts.join(own.dropDuplicates(["namespace", "title"]), ["namespace", "title"], "left").join(by_title, "title", "left")
    out = out.withColumn("_m", F.coalesce("m", "m2")).withColumn("missing_metadata", F.col("_m").isNull())
    defaults = {"categories": F.array().cast("array<string>"), "is_stub": F.lit(False), "citation_needed_count": F.lit(0), "has_blockquote": F.lit(False)}
    fields = [f.name for f in own.schema["m"].dataType.fields]
    return out.select(*texts.columns, "missing_metadata", *[F.coalesce(F.col(f"_m.{f}"), defaults[f]).alias(f) if f in defaults else F.col(f"_m.{f}").alias(f) for f in fields])


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, value): lines that aren't blank, numbered from 1 within a file.

    Numbers are the lines' places in the file's order: each file is read as one text, as curated files are small.
    """
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = rows.select("path", F.posexplode(F.split("value", "\n")).alias("i", "value"))
    return lines.where(F.trim("value") != "").select("path", (F.col("i") + 1).alias("line_no"), "value")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(filename, record_count) of a manifest: the entries of its list, in its plain form or as JSON."""
    lines = spark.read.text(path, wholetext=True)
    entries = F.regexp_extract_all("value", F.lit(r"(?s)(\"?filename\"?\s*:.*?\"?record_count\"?\s*:\s*\d+)"), 1)
    name = F.regexp_extract("e", r"\"?filename\"?\s*:\s*[\"']?([^\"'\n,]+)", 1)
    count = F.regexp_extract("e", r"record_count\"?\s*:\s*(\d+)", 1)
    return lines.select(F.explode(entries).alias("e")).select(F.trim(name).alias("filename"), count.cast("long").alias("record_count"))

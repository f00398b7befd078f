"""The catalogue: each operator applied to whole tables, with the same in DuckDB's SQL where SQL can express it.

The tables hold no wiki markup, so markup is made from documents by one expression in either dialect.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexquarry.functions import markup, text
from lexquarry.functions.text import SPACE
from lexquarry.operators import chunking, citations, curation, embedding, entities, graph, health, infobox, search, store
from lexquarry.operators.articles import extract_articles, with_citations
from lexquarry.operators.filters import where, where_document
from lexquarry.plans import folds
from lexquarry.plans.folds import chunks_sql
from lexquarry.sources import files, npy
from lexquarry.streaming.ingest import windowed_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents")


# -- markup of documents, in both dialects

NAMESPACE_FOLDERS = ("Main", "Library", "Essays", "Other")
_WIKI = (
    "'{{Infobox person|name=Doc ', doc_id, '|nationality=[[', lang, ']]<br>[[', source, '|src]]|empty=}}', NL, '== ', source, ' ==', NL, text, NL, "
    "'=== More ===', NL, 'See \"''''''bold''''''\" {{nested|a={{b}}}}. [[Category:', lang, ']] [[category:low]] [[', source, '#part|src]] [[File:x.png|thumb]] "
    "[https://e.org/', doc_id, ' the site]<ref name=\"r', doc_id % 3, '\">{{Citation|author=[[A', doc_id % 5, '|B', doc_id % 5, ']]|title=T', doc_id % 50, '|year=', 1900 + doc_id % 100, "
    "'}}</ref><ref name=\"r', doc_id % 3, '\">{{Web citation|title=again|url=https://u}}</ref>', CASE WHEN doc_id % 10 = 0 THEN '{{Stub}}' ELSE '' END, "
    "CASE WHEN doc_id % 7 = 0 THEN '{{Citation needed}}' ELSE '' END, CASE WHEN doc_id % 5 = 0 THEN '<blockquote>q</blockquote>{{Quote|\"said\"|Me}}' ELSE '' END"
)
WIKI = f"concat({_WIKI.replace('NL', 'chr(10)')})"
W_ = f"wiki AS (SELECT doc_id, lang, source, {WIKI} AS m FROM documents)"


def wiki(spark: SparkSession, folder: str) -> DataFrame:
    # Spark joins two literals with nothing between into one, so doubled quotes are written with a backslash
    return documents(spark, folder).select("doc_id", "lang", "source", F.expr(WIKI.replace("''''''bold''''''", "\\'\\'\\'bold\\'\\'\\'")).alias("m"))


def q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def words_sql(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, {q(f'[{SPACE}]+')}), lambda w: w <> ''))"


# -- search

_QUERY_VECTOR = "(SELECT embedding::DOUBLE[] AS v FROM embeddings ORDER BY vec_id LIMIT 1)"
_DISTANCE = {
    "cosine": "1 - list_dot_product(embedding::DOUBLE[], v) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(v, v))",
    "l2": "list_sum(list_transform(list_zip(embedding::DOUBLE[], v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))",
    "ip": "1 - list_dot_product(embedding::DOUBLE[], v)",
}


def _first_vector(spark: SparkSession, folder: str) -> list[float]:
    return read(spark, folder, "embeddings").orderBy("vec_id").limit(1).first().embedding


def _knn(metric: str, condition: dict | None = None, sql_condition: str = "true", limit: int = 10) -> tuple[Query, str]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        found = search.search(read(spark, folder, "embeddings"), _first_vector(spark, folder), limit, condition, metric=metric, id_col="vec_id")
        return found.select("vec_id", "label", F.round("distance", 5).alias("distance"), F.round("score", 5).alias("score"))

    sql = f"""
        SELECT vec_id, label, round(d, 5) AS distance, round(1 - d, 5) AS score
        FROM (SELECT vec_id, label, {_DISTANCE[metric]} AS d FROM embeddings, {_QUERY_VECTOR} WHERE {sql_condition}) ORDER BY d, vec_id LIMIT {limit}
    """
    return run, sql


for _metric in _DISTANCE:
    _run, _sql = _knn(_metric)
    query(_sql, f"knn_{_metric}")(_run)
_run, _sql = _knn("cosine", {"$and": [{"label": {"$in": [1, 2, 3]}}, {"vec_id": {"$gt": 10}}, {"$or": [{"label": 2}, {"label": {"$ne": 1}}]}]}, "label IN (1, 2, 3) AND vec_id > 10 AND (label = 2 OR label <> 1)")
query(_sql, "knn_filtered")(_run)

_MANY = f"""
    pairs AS (SELECT q.vec_id AS query_id, e.vec_id, {_DISTANCE["cosine"].replace("embedding", "e.embedding").replace("v)", "q.embedding::DOUBLE[])").replace("(v,", "(q.embedding::DOUBLE[],")} AS d
              FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS r FROM pairs)
"""


def _many(spark: SparkSession, folder: str, limit: int) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    queries = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return search.search_many(rows, queries, limit)


@query(f"WITH {_MANY} SELECT query_id, vec_id, round(d, 5) AS distance, r AS rank FROM ranked WHERE r <= 5")
def knn_multi_query_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _many(spark, folder, 5).select("query_id", "vec_id", F.round("distance", 5).alias("distance"), F.col("rank").cast("long").alias("rank"))


@query(
    f"""
    WITH {_MANY}, labelled AS (
        SELECT r.*, (a.label = b.label)::INT AS hit FROM ranked r JOIN embeddings a ON a.vec_id = r.query_id JOIN embeddings b ON b.vec_id = r.vec_id WHERE r <= 10
    ), wanted AS (SELECT a.vec_id AS query_id, count(*) AS wanted FROM embeddings a JOIN embeddings b ON a.label = b.label WHERE a.vec_id % 50 = 0 GROUP BY 1)
    SELECT query_id, round(sum(hit) FILTER (r <= 5) / 5, 6) AS precision_at_k, round(sum(hit) FILTER (r <= 5) / any_value(wanted), 6) AS recall_at_k,
           round(max(CASE WHEN hit = 1 THEN 1.0::DOUBLE / r ELSE 0 END), 6) AS reciprocal_rank,
           round(sum(hit / log2(r + 1)) / any_value(list_sum(list_transform(range(1, least(wanted, 10) + 1), lambda i: 1 / log2(i + 1)))), 6) AS ndcg
    FROM labelled JOIN wanted USING (query_id) GROUP BY query_id
    """
)
def retrieval_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").select("vec_id", "label")
    ranked = _many(spark, folder, 10).select("query_id", F.col("vec_id").alias("id"), "rank")
    queries = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label")
    relevant = queries.join(rows, "label").select("query_id", F.col("vec_id").alias("id"))
    out = search.retrieval_metrics(ranked, relevant)
    return out.select("query_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


for _name, _filter, _sql in (
    ("documents_containing", {"$contains": "token"}, "contains(text, 'token')"),
    ("documents_not_containing", {"$not_contains": "the"}, "NOT contains(text, 'the')"),
    ("documents_matching", {"$or": [{"$regex": "[0-9]{3}-[0-9]{4}"}, {"$and": [{"$contains": "MIT"}, {"$regex": "Licen[sc]e"}]}]}, "regexp_matches(text, '[0-9]{3}-[0-9]{4}') OR (contains(text, 'MIT') AND regexp_matches(text, 'Licen[sc]e'))"),
):
    query(f"SELECT doc_id, lang FROM documents WHERE {_sql}", _name)(lambda spark, folder, f=_filter: documents(spark, folder).where(where_document(f, F.col("text"))).select("doc_id", "lang"))


@query("SELECT doc_id, lang, n_chars FROM documents WHERE lang IN ('en', 'de') AND lang <> 'fr' AND n_chars >= 500 AND n_chars < 2000 AND source NOT IN ('src0')")
def documents_where(spark: SparkSession, folder: str) -> DataFrame:
    condition = {"lang": {"$in": ["en", "de"], "$ne": "fr"}, "n_chars": {"$gte": 500, "$lt": 2000}, "source": {"$nin": ["src0"]}}
    return documents(spark, folder).where(where(condition)).select("doc_id", "lang", "n_chars")


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 20 OFFSET 10")
def search_paging(spark: SparkSession, folder: str) -> DataFrame:
    return search.page(documents(spark, folder).select("doc_id", "n_chars"), "doc_id", 10, 20)


@query("SELECT doc_id, text, n_chars FROM documents WHERE source = 'src0' AND lang = 'en' ORDER BY n_chars, doc_id")
def article_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select("doc_id", "text", "n_chars", F.col("source").alias("article_title"), F.col("lang").alias("namespace"), F.struct("n_chars", "doc_id").alias("chunk_index"))
    return search.article_chunks(rows, "src0", "en").select("doc_id", "text", "n_chars")


# -- store


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    old = read(spark, folder, "labels").select("doc_id", F.col("quality").cast("long").alias("value"))
    return old, documents(spark, folder).select("doc_id", F.col("n_chars").alias("value"))


@query("SELECT doc_id, quality::BIGINT AS value FROM labels UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def store_insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    return store.insert_ignore(*_versions(spark, folder), "doc_id")


@query("SELECT doc_id, n_chars AS value FROM documents UNION ALL SELECT doc_id, quality::BIGINT FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def store_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return store.upsert(*_versions(spark, folder), "doc_id")


@query("SELECT doc_id, n_chars AS value FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND NOT (n_chars < 300)")
def store_delete(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _versions(spark, folder)
    return store.delete(new, old, {"value": {"$lt": 300}}, "doc_id")


@query(
    f"""
    WITH {W_} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS section, '["' || lang || '"]' AS categories,
           CASE WHEN doc_id % 4 = 0 THEN -1 ELSE 1900 + doc_id % 100 END AS year FROM wiki
    """
)
def metadata_serialize(spark: SparkSession, folder: str) -> DataFrame:
    out = store.serialize(_metadata(spark, folder))
    return out.select("doc_id", "section", "categories", F.col("library_work_published_year").cast("long").alias("year"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS section, lang AS category, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 1900 + doc_id % 100 END AS year FROM documents")
def metadata_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    out = store.deserialize(store.serialize(_metadata(spark, folder)))
    return out.select("doc_id", "section", F.array_join("categories", "|").alias("category"), F.col("library_work_published_year").cast("long").alias("year"))


def _metadata(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", F.expr("case when doc_id % 3 = 0 then null else source end").alias("section"), F.array("lang").alias("categories"), F.expr("case when doc_id % 4 = 0 then null else 1900 + doc_id % 100 end").alias("library_work_published_year"))


# -- links

_INTERNAL_SQL = f"""
    matched AS (SELECT doc_id, unnest(regexp_extract_all(m, {q(markup.INTERNAL)})) AS x, generate_subscripts(regexp_extract_all(m, {q(markup.INTERNAL)}), 1) - 1 AS i FROM wiki),
    parts AS (SELECT doc_id, i, regexp_extract(x, {q(markup.INTERNAL)}, 1) AS raw, regexp_extract(x, {q(markup.INTERNAL)}, 2) AS shown FROM matched),
    internal AS (
        SELECT doc_id, i, CASE WHEN starts_with(raw, 'Category:') THEN substr(raw, 10) ELSE split_part(raw, '#', 1) END AS target,
               CASE WHEN starts_with(raw, 'Category:') THEN substr(raw, 10) WHEN shown <> '' THEN shown ELSE split_part(raw, '#', 1) END AS display,
               CASE WHEN starts_with(raw, 'Category:') THEN 'category' ELSE 'internal' END AS link_type,
               CASE WHEN NOT starts_with(raw, 'Category:') AND regexp_extract(raw, '(?s)#(.+)', 1) <> '' THEN regexp_extract(raw, '(?s)#(.+)', 1) END AS section
        FROM parts WHERE {strip_sql("raw")} <> '' AND NOT ({" OR ".join(f"starts_with(raw, {q(p)})" for p in markup.IGNORED)})
    )
"""
_EXTERNAL_SQL = f"external AS (SELECT doc_id, unnest(regexp_extract_all(m, {q(markup.EXTERNAL)})) AS x FROM wiki)"


@query(
    f"""
    WITH {W_}, {_INTERNAL_SQL}, {_EXTERNAL_SQL}
    SELECT doc_id, target, display, link_type, section FROM internal UNION ALL
    SELECT doc_id, regexp_extract(x, {q(markup.EXTERNAL)}, 1), CASE WHEN regexp_extract(x, {q(markup.EXTERNAL)}, 2) <> '' THEN {strip_sql(f"regexp_extract(x, {q(markup.EXTERNAL)}, 2)")} ELSE regexp_extract(x, {q(markup.EXTERNAL)}, 1) END, 'external', NULL FROM external
    """
)
def links_extract(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).select("doc_id", F.explode(markup.links("m")).alias("l")).select("doc_id", "l.target", "l.display", "l.link_type", "l.section")


@query(
    f"""
    WITH {W_}, found AS (SELECT doc_id, string_split_regex(m, {q(markup.INTERNAL)}) AS p, regexp_extract_all(m, {q(markup.INTERNAL)}) AS x FROM wiki),
    placed AS (SELECT doc_id, unnest(x) AS y, unnest(list_transform(x, lambda m, i: list_sum(list_transform(p[:i], lambda s: length(s))) + coalesce(list_sum(list_transform(x[:i - 1], lambda s: length(s))), 0))) AS a FROM found)
    SELECT doc_id, a::BIGINT AS link_start, (a + length(y))::BIGINT AS link_end, y AS link FROM placed
    WHERE NOT ({" OR ".join(f"starts_with(substr(y, 3), {q(p)})" for p in markup.IGNORED)})
    """
)
def link_positions(spark: SparkSession, folder: str) -> DataFrame:
    rows = wiki(spark, folder).select("doc_id", "m", F.explode(F.concat(markup.links("m", "internal", True), markup.links("m", "category", True))).alias("l"))
    return rows.select("doc_id", F.col("l.start").cast("long").alias("link_start"), F.col("l.end").cast("long").alias("link_end"), F.substring("m", F.col("l.start") + 1, F.col("l.end") - F.col("l.start")).alias("link"))


@query(f"WITH {W_}, {_INTERNAL_SQL} SELECT doc_id, count(*) FILTER (link_type = 'internal') AS n_internal, count(*) FILTER (link_type = 'category') AS n_categories FROM internal GROUP BY doc_id")
def link_counts(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).select("doc_id", F.size(markup.links("m", "internal")).cast("long").alias("n_internal"), F.size(markup.links("m", "category")).cast("long").alias("n_categories"))


@query(f"WITH {W_}, {_INTERNAL_SQL} SELECT DISTINCT doc_id, target FROM internal WHERE link_type = 'internal'")
def unique_targets(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).select("doc_id", F.explode(markup.targets("m")).alias("target"))


# -- sections, flags, text

_HEADERS = "|".join(f"={{{k}}}[{SPACE}]*[^=]+?[{SPACE}]*={{{k}}}" for k in range(2, 7))
_HEADER_SQL = f"(?m)^(?:{_HEADERS})[{SPACE}]*$"


@query(f"WITH {W_}, h AS (SELECT doc_id, unnest(regexp_extract_all(m, {q(_HEADER_SQL)})) AS x FROM wiki) SELECT doc_id, {strip_sql(f'''regexp_replace(x, {q(f'^=+|=+[{SPACE}]*$')}, '', 'g')''')} AS section FROM h")
def sections_extract(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).select("doc_id", F.explode(markup.sections("m")).alias("section"))


@query(
    f"""
    WITH {W_}, lines AS (SELECT doc_id, unnest(string_split(m, chr(10))) AS line, generate_subscripts(string_split(m, chr(10)), 1) AS line_no FROM wiki),
    headed AS (SELECT *, CASE WHEN regexp_matches(line, {q(_HEADER_SQL)}) THEN {strip_sql(f'''regexp_replace(line, {q(f'^=+|=+[{SPACE}]*$')}, '', 'g')''')} END AS h FROM lines)
    SELECT doc_id, line_no, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS section FROM headed
    """
)
def section_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = chunking.lines_table(wiki(spark, folder), "doc_id", "m")
    header = F.regexp_extract("line", markup.HEADER, 2)
    own = F.when(F.col("line").rlike(markup.HEADER), text.strip(header))
    section = F.last(own, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("line_no"))
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), section.alias("section"))


@query(
    f"""
    WITH {W_}, lines AS (SELECT doc_id, unnest(string_split(m, chr(10))) AS line, generate_subscripts(string_split(m, chr(10)), 1) AS no, len(string_split(m, chr(10))) AS n FROM wiki),
    h AS (SELECT *, row_number() OVER w AS section_no, lead(no) OVER w - 1 AS before_next FROM lines WHERE regexp_matches(line, {q(_HEADER_SQL)}) WINDOW w AS (PARTITION BY doc_id ORDER BY no))
    SELECT doc_id, section_no, length(regexp_extract(line, '^(={{2,6}})', 1)) AS level, {strip_sql(f'''regexp_replace(line, {q(f'^=+|=+[{SPACE}]*$')}, '', 'g')''')} AS title, no AS line_start, coalesce(before_next, n) AS line_end FROM h
    """
)
def section_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.section_table(wiki(spark, folder), "doc_id", "m")


@query(
    """
    WITH made AS (SELECT doc_id, concat('{{Birth date|', 1800 + doc_id % 200, '|', doc_id % 13, '|', doc_id % 31 + 1, '|df=y}} {{death_date and age|1900|2|', doc_id % 5 + 26, '}}') AS m FROM documents),
    found AS (SELECT doc_id, unnest([1, 2]) AS i, m FROM made),
    parts AS (SELECT doc_id, i, CASE WHEN i = 1 THEN concat(1800 + doc_id % 200, '-', lpad((doc_id % 13)::VARCHAR, 2, '0'), '-', lpad((doc_id % 31 + 1)::VARCHAR, 2, '0')) ELSE concat('1900-02-', doc_id % 5 + 26) END AS d FROM found)
    SELECT doc_id, try_cast(d AS DATE)::VARCHAR AS day FROM parts WHERE try_cast(d AS DATE) IS NOT NULL
    """
)
def template_dates(spark: SparkSession, folder: str) -> DataFrame:
    made = F.expr("concat('{{Birth date|', 1800 + doc_id % 200, '|', doc_id % 13, '|', doc_id % 31 + 1, '|df=y}} {{death_date and age|1900|2|', doc_id % 5 + 26, '}}')")
    return documents(spark, folder).select("doc_id", F.explode(markup.template_dates(made)).alias("day")).withColumn("day", F.col("day").cast("string"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang || source ELSE 'a' || lang || 'b' END AS shown, doc_id % 2 = 0 AS is_stub FROM documents")
def transclusion(spark: SparkSession, folder: str) -> DataFrame:
    made = F.expr("case when doc_id % 2 = 0 then concat('x<onlyinclude>', lang, '</onlyinclude>y<onlyinclude>', source, '</onlyinclude>{{ message box/stub |a}}') else concat('a<noinclude>', source, '\n</noinclude><includeonly>', lang, '</includeonly>b') end")
    return documents(spark, folder).select("doc_id", markup.transcluded(made).alias("shown"), markup.is_stub_box(made).alias("is_stub"))


@query(f"WITH {W_} SELECT doc_id, (len(regexp_extract_all(m, {q(markup.REF)})) + len(regexp_extract_all(m, {q(markup.REF_ALONE)})))::BIGINT AS n_references FROM wiki")
def reference_counts(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).select("doc_id", markup.reference_count("m").alias("n_references"))


@query(f"WITH {W_} SELECT doc_id, regexp_matches(m, {q(markup.STUB)}) AS is_stub, len(regexp_extract_all(m, {q(markup.CITATION_NEEDED)}))::BIGINT AS citation_needed_count, regexp_matches(m, {q(markup.BLOCKQUOTE)}) AS has_blockquote FROM wiki")
def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).select("doc_id", *[c.alias(n) for n, c in markup.quality_flags("m").items()])


def _clean_sql(x: str) -> str:
    for p in (markup.REF, markup.REF_ALONE, markup.REF_LIST, markup.CATEGORY_LINK):
        x = f"regexp_replace({x}, {q(p)}, '', 'g')"
    x = f"list_reduce([{x}, {', '.join(['' + chr(39) * 2] * markup.DEPTH)}], lambda t, _: regexp_replace(t, '\\{{\\{{[^{{}}]*\\}}\\}}', '', 'g'))"
    x = rf"regexp_replace(regexp_replace({x}, '\[\[[^\]|]+\|([^\]]+)\]\]', '\1', 'g'), '\[\[([^\]|]+)\]\]', '\1', 'g')"
    x = f"regexp_replace({x}, '''{{2,5}}', '', 'g')"
    for k in range(2, 7):
        x = f"regexp_replace({x}, {q(f'(?m)^={{{k}}}[{SPACE}]*([^=]+?)[{SPACE}]*={{{k}}}[{SPACE}]*$')}, '\\1', 'g')"
    inner = SPACE.replace("\t-\r", "\t\x0b-\r")
    x = f"regexp_replace({x}, {q(f'[{inner}]*{chr(10)}[{inner}]*')}, chr(10), 'g')"
    return strip_sql(f"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"WITH {W_} SELECT doc_id, {_clean_sql('m')} AS clean FROM wiki")
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).select("doc_id", markup.clean_text("m").alias("clean"))


@query(f"SELECT doc_id, {words_sql('text')}::BIGINT AS n_words, floor({words_sql('text')} * 1.3::DOUBLE)::BIGINT AS n_tokens FROM documents")
def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", text.word_count("text").alias("n_words"), text.estimate_tokens("text").alias("n_tokens"))


@query("SELECT doc_id, nullif(regexp_extract(concat('In ', 900 + doc_id, ' or 1', doc_id, ' and ', 1800 + doc_id % 300, ', ', text), '\\b(1[0-9]{3}|20[0-9]{2})\\b', 1), '')::INT AS year FROM documents")
def year_extract(spark: SparkSession, folder: str) -> DataFrame:
    made = F.concat(F.lit("In "), (F.col("doc_id") + 900).cast("string"), F.lit(" or 1"), F.col("doc_id").cast("string"), F.lit(" and "), (F.col("doc_id") % 300 + 1800).cast("string"), F.lit(", "), F.col("text"))
    return documents(spark, folder).select("doc_id", text.year_of(made).alias("year"))


_FOLDER = f"['{NAMESPACE_FOLDERS[0]}', '{NAMESPACE_FOLDERS[1]}', '{NAMESPACE_FOLDERS[2]}', '{NAMESPACE_FOLDERS[3]}'][doc_id % 4 + 1]"


@query(f"SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'Main' ELSE {_FOLDER} END AS namespace FROM documents")
def namespace_of_path(spark: SparkSession, folder: str) -> DataFrame:
    first = F.element_at(F.array(*map(F.lit, NAMESPACE_FOLDERS)), (F.col("doc_id") % 4 + 1).cast("int"))
    path = F.concat_ws("/", F.lit(""), first, F.col("source"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return documents(spark, folder).select("doc_id", markup.namespace_of_path(path, NAMESPACE_FOLDERS[:3]).alias("namespace"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Essays' WHEN 1 THEN 'Library' ELSE 'Main' END AS namespace FROM documents")
def namespace_of_name(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.element_at(F.array(*map(F.lit, ("Essay_", "Library_", "Any_"))), (F.col("doc_id") % 3 + 1).cast("int")), F.col("source"))
    return documents(spark, folder).select("doc_id", markup.namespace_of_name(name, {"Essay_": "Essays", "Library_": "Library"}).alias("namespace"))


# -- templates, infoboxes, citations


@query(f"WITH {W_} SELECT doc_id, 'person' AS type, 'Doc ' || doc_id AS name, lang || '|src' AS nationality, true AS is_list, true AS empty_is_null, lang || '|' || source AS links FROM wiki")
def infobox_fields(spark: SparkSession, folder: str) -> DataFrame:
    out = extract_articles(wiki(spark, folder), "m").select("doc_id", "infobox", infobox.field_map(F.col("infobox")).alias("f"))
    nationality = F.element_at(F.filter("infobox.fields", lambda f: f["name"] == "nationality"), 1)
    return out.select(
        "doc_id", "infobox.type", F.array_join(F.col("f")["name"], "|").alias("name"), F.array_join(F.col("f")["nationality"], "|").alias("nationality"),
        nationality["value"]["is_list"].alias("is_list"), F.col("f")["empty"].isNull().alias("empty_is_null"), F.array_join("infobox.extracted_links", "|").alias("links"),
    )


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'military_person' END AS type FROM documents")
def infobox_types(spark: SparkSession, folder: str) -> DataFrame:
    made = F.when(F.col("doc_id") % 2 == 0, F.lit("x {{ infobox Military person\n|a=b}}")).otherwise(F.lit("{{Infobox spaceship|a=b}}"))
    return documents(spark, folder).select("doc_id", infobox.detect_type(made).alias("type"))


@query("SELECT doc_id, 0 AS ref, 'book' AS type, 'B' || doc_id % 5 AS author, 'T' || doc_id % 50 AS title, (1900 + doc_id % 100)::VARCHAR AS year, 'r' || doc_id % 3 AS ref_name FROM documents")
def citations_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return citations.citations(wiki(spark, folder), "doc_id", "m").select("doc_id", "ref", "type", "author", "title", "year", "ref_name")


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'said' END AS quote, CASE WHEN doc_id % 5 = 0 THEN 'Me' END AS attribution, 'more' AS last_section, 1::BIGINT AS n_citations FROM documents")
def articles_extract(spark: SparkSession, folder: str) -> DataFrame:
    out = with_citations(extract_articles(wiki(spark, folder), "m"), "doc_id", "m")
    quote = F.get("quotes", F.lit(0))
    return out.select("doc_id", quote["text"].alias("quote"), quote["attribution"].alias("attribution"), F.lower(F.element_at("sections", -1)).alias("last_section"), F.size("citations").cast("long").alias("n_citations"))


@query("SELECT doc_id, 'Work ' || doc_id AS title, 'Ann, Bob' AS author, 'Ann|Bob' AS authors, 'https://s.org' AS source_url, lang AS translator, 'before after' AS remaining FROM documents")
def library_works(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.functions.templates import templates

    made = F.concat(F.lit("before {{Library work|title=Work "), F.col("doc_id").cast("string"), F.lit("|author=[[x|Ann]], Bob|source=[https://s.org here]|Translated by="), F.col("lang"), F.lit("}}after"))
    rows = documents(spark, folder).select("doc_id", made.alias("m")).withColumn("t", templates("m")).withColumn("w", infobox.library_work(F.col("m"), F.col("t")))
    return rows.select("doc_id", "w.title", "w.author", F.array_join("w.authors", "|").alias("authors"), "w.source_url", "w.translator", F.col("w.remaining_text").alias("remaining"))


_CITED_AS = ["Citation", "web citation", "News Citation", "YouTube citation", "Library citation", "VIDEO citation", "textcite", "Other citation"]
_KINDS = ["book", "web", "news", "youtube", "library", "video", "book"]
_LISTED = lambda names: "[" + ", ".join(q(n) for n in names) + "]"
_UNREFERENCED = (
    "concat('Plain {{', NAME, '|author=[[A|Bo]], [[Cy]]|title= T', doc_id, ' |', CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'web=https://u/1|' END, 'url=https://v|quote=a [[x]] {{b|c=d}}|trans=|city= |page=', "
    "doc_id % 9, '}} tail ', CASE WHEN doc_id % 4 = 0 THEN '{{citation|title=Second|isbn=[[1]]}}' ELSE '' END, ' {{open|author=lost')"
)


@query(
    f"""
    WITH first AS (SELECT doc_id, 0 AS pos, {_LISTED(_KINDS)}[doc_id % 8 + 1] AS type, 'Bo, Cy' AS author, 'T' || doc_id AS title, CASE WHEN doc_id % 3 = 0 THEN 'https://v' ELSE 'https://u/1' END AS url,
           'a x {{{{b|c=d}}}}' AS quote, NULL::VARCHAR AS translation_title, (doc_id % 9)::VARCHAR AS page, NULL::VARCHAR AS isbn FROM documents WHERE doc_id % 8 < 7),
    second AS (SELECT doc_id, CASE WHEN doc_id % 8 < 7 THEN 1 ELSE 0 END AS pos, 'book' AS type, NULL AS author, 'Second' AS title, NULL AS url, NULL AS quote, NULL AS translation_title, NULL AS page, '1' AS isbn FROM documents WHERE doc_id % 4 = 0)
    SELECT *, NULL::VARCHAR AS ref_name FROM first UNION ALL SELECT *, NULL FROM second
    """
)
def citations_whole_text(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without references: all templates count, known ones in any case, unclosed ones not."""
    name = f"element_at(array({', '.join(q(n) for n in _CITED_AS)}), cast(doc_id % 8 + 1 as int))"
    rows = documents(spark, folder).select("doc_id", F.expr(_UNREFERENCED.replace("NAME", name)).alias("m"))
    return citations.citations(rows, "doc_id", "m").select("doc_id", "pos", "type", "author", "title", "url", "quote", "translation_title", "page", "isbn", "ref_name")


_REFERENCED = (
    "concat('<ref>{{citation|title=One}} and {{Web citation|title=Two|url=u}}</ref> {{textcite|title=outside}} <ref name=\"n', doc_id % 2, '\">{{news citation|title=Three}}</ref>', "
    "'<ref name=n0>{{citation|title=Four}}</ref><ref name=\"n1\">{{other|title=no}}</ref><REF>no template</REF><ref>{{citation|title=Five}}{{citation|title=</ref>')"
)


@query(
    """
    SELECT doc_id, unnest([0, 0, 1, 5]) AS ref, unnest([0, 1, 0, 0]) AS pos, unnest(['One', 'Two', 'Three', 'Five']) AS title, unnest(['book', 'web', 'news', 'book']) AS type, unnest([NULL, NULL, 'n0', NULL]) AS ref_name FROM documents WHERE doc_id % 2 = 0
    UNION ALL
    SELECT doc_id, unnest([0, 0, 1, 2, 5]), unnest([0, 1, 0, 0, 0]), unnest(['One', 'Two', 'Three', 'Four', 'Five']), unnest(['book', 'web', 'news', 'book', 'book']), unnest([NULL, NULL, 'n1', 'n0', NULL]) FROM documents WHERE doc_id % 2 = 1
    """
)
def citations_in_references(spark: SparkSession, folder: str) -> DataFrame:
    """References with several templates, repeated names, none and broken ones; templates outside them don't count."""
    rows = documents(spark, folder).select("doc_id", F.expr(_REFERENCED).alias("m"))
    return citations.citations(rows, "doc_id", "m").select("doc_id", "ref", "pos", "title", "type", "ref_name")


_BOX_NAMES = [n for t in infobox.TYPES for n in (t, t.replace("_", " ").title())] + ["spaceship", "book review"]
_BOX_TYPES = [t for t in infobox.TYPES for _ in range(2)] + [None, None]


@query(
    f"""
    WITH typed AS (SELECT doc_id, doc_id % {len(_BOX_NAMES)} AS k, [{", ".join("NULL" if t is None else q(t) for t in _BOX_TYPES)}][doc_id % {len(_BOX_NAMES)} + 1] AS type FROM documents)
    SELECT doc_id, type AS detected, type, CASE WHEN type IS NOT NULL THEN '2nd' END AS a, CASE WHEN type IS NOT NULL THEN 'x|' || doc_id || '|L' END AS b, CASE WHEN type IS NOT NULL THEN true END AS b_is_list,
           CASE WHEN type IS NOT NULL THEN 'M|L' || doc_id || '|L' END AS links, CASE WHEN type IS NOT NULL THEN 'before {{{{x|y}}}}  after {{{{Infobox book|a=later}}}}' END AS remaining
    FROM typed
    """
)
def infobox_all_types(spark: SparkSession, folder: str) -> DataFrame:
    """All types, with underscores or blanks, unknown ones, repeated fields, lists, nested templates and a second box."""
    from lexquarry.functions.templates import templates

    name = f"element_at(array({', '.join(q(n) for n in _BOX_NAMES)}), cast(doc_id % {len(_BOX_NAMES)} + 1 as int))"
    made = F.expr(f"concat('before {{{{x|y}}}} {{{{Infobox ', {name}, '|a=[[M]]|b=[[L', doc_id, '|x]]<br/>', doc_id, '<BR>[[L]]<br>|c= |a=2nd|d={{{{e|f=g}}}}}}}} after {{{{Infobox book|a=later}}}}')")
    rows = documents(spark, folder).select("doc_id", made.alias("m")).withColumn("t", templates("m")).withColumn("box", infobox.infobox(F.col("m"), F.col("t"))).withColumn("f", infobox.field_map(F.col("box")))
    b = F.get(F.filter("box.fields", lambda f: f["name"] == "b"), F.lit(0))
    return rows.select(
        "doc_id", infobox.detect_type(F.col("m")).alias("detected"), "box.type", F.array_join(F.col("f")["a"], "|").alias("a"), F.array_join(F.col("f")["b"], "|").alias("b"), b["value"]["is_list"].alias("b_is_list"),
        F.array_join("box.extracted_links", "|").alias("links"), F.col("box.remaining_text").alias("remaining"),
    )


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'A ' || lang || '|B' WHEN doc_id % 3 = 1 THEN lang || '|b' ELSE '' END AS categories FROM documents")
def category_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Categories in another case count only if there is none as it should be."""
    made = F.expr("concat('[[category: ', lang, ' |key]] text [[CATEGORY:b]]', '')")
    good = F.expr("concat('[[Category:A ', lang, ']] [[category:low]] [[Category:B|k]]')")
    rows = documents(spark, folder).select("doc_id", F.when(F.col("doc_id") % 3 == 0, good).when(F.col("doc_id") % 3 == 1, made).otherwise("[[Other:x]]").alias("m"))
    return rows.select("doc_id", F.array_join(markup.categories("m"), "|").alias("categories"))


# -- chunks

_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"
_SOME_WORDS = f"big AS (SELECT * FROM lines WHERE {words_sql('line')} >= 10), marked AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM big), kept AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS i FROM marked WHERE line IS DISTINCT FROM before)"


def _line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    made = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("text"), i.alias("chunk_index"), (i + 1).alias("line_no"), text.word_count(x).alias("word_count")))
    return documents(spark, folder).select("doc_id", "lang", "source", made.alias("found")).withColumn("kept", chunking.keep_chunks(F.col("found")))


@query(f"WITH {_LINES}, {_SOME_WORDS} SELECT k.doc_id, lang || '/' || source || '_' || k.doc_id || '#' || i AS chunk_id, k.line_no, i::INT AS chunk_index, {words_sql('line')}::BIGINT AS n_words FROM kept k JOIN documents USING (doc_id)")
def chunk_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = _line_chunks(spark, folder).select("doc_id", "lang", "source", F.explode("kept").alias("c"))
    title = F.concat_ws(" ", "source", F.col("doc_id").cast("string"))
    return rows.select("doc_id", chunking.chunk_id(F.col("lang"), title, F.col("c.chunk_index")).alias("chunk_id"), F.col("c.line_no").cast("long").alias("line_no"), F.col("c.chunk_index").cast("int").alias("chunk_index"), F.col("c.word_count").alias("n_words"))


@query(
    f"""
    WITH {_LINES}, {_SOME_WORDS}, n AS (SELECT doc_id, count(*) AS total, count(*) FILTER ({words_sql('line')} < 10) AS micro FROM lines GROUP BY 1), w AS (SELECT doc_id, count(*) AS written FROM kept GROUP BY 1)
    SELECT n.doc_id, total AS total_chunks, micro AS micro_chunks_filtered, total - micro - coalesce(written, 0) AS consecutive_duplicates_removed, coalesce(written, 0) AS chunks_written FROM n LEFT JOIN w USING (doc_id)
    """
)
def chunk_filter_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _line_chunks(spark, folder).select("doc_id", chunking.filter_stats(F.col("found"), F.col("kept")).alias("s")).select("doc_id", "s.*")


@query(f"WITH {_LINES} SELECT doc_id, line_no, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - length(line) - 1)::BIGINT AS begins, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - 1)::BIGINT AS ends FROM lines")
def line_ranges(spark: SparkSession, folder: str) -> DataFrame:
    rows = chunking.lines_table(documents(spark, folder), "doc_id", "text")
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("begin").cast("long").alias("begins"), F.col("end").cast("long").alias("ends"))


def _exploded(df: DataFrame, found: Column) -> DataFrame:
    return df.select("doc_id", F.explode(found).alias("c")).select("doc_id", "c.*")


_CHUNK = "doc_id, text, chunk_index, section, line_start, line_end, word_count, estimated_tokens"


@query(f"WITH RECURSIVE {W_}, marked AS (SELECT doc_id, {strip_sql('m')} AS body FROM wiki), {chunks_sql('marked', 200)} SELECT {_CHUNK} FROM made")
def chunk_main_fold(spark: SparkSession, folder: str) -> DataFrame:
    return _exploded(wiki(spark, folder), chunking.chunks(F.col("m"), chunking.ChunkConfig(max_tokens=200)))


@query(
    f"""
    WITH RECURSIVE {_LINES}, sized AS (SELECT doc_id, line_no, line, {words_sql('line')} AS n FROM lines),
    fold AS (
        SELECT doc_id, line_no, n AS total, 1::BIGINT AS first FROM sized WHERE line_no = 1
        UNION ALL
        SELECT s.doc_id, s.line_no, CASE WHEN floor((f.total + s.n) * 1.3::DOUBLE) >= 200 THEN s.n ELSE f.total + s.n END,
               CASE WHEN floor((f.total + s.n) * 1.3::DOUBLE) >= 200 THEN s.line_no ELSE f.first END
        FROM fold f JOIN sized s ON s.doc_id = f.doc_id AND s.line_no = f.line_no + 1
    )
    SELECT doc_id, first AS line_start, max(line_no) AS line_end, max(total)::BIGINT AS n_words FROM fold GROUP BY doc_id, first
    """
)
def chunk_words_greedy(spark: SparkSession, folder: str) -> DataFrame:
    rows = _exploded(documents(spark, folder), chunking.chunks(F.col("text"), chunking.ChunkConfig(max_tokens=200), by="words"))
    return rows.select("doc_id", F.col("line_start").cast("long").alias("line_start"), F.col("line_end").cast("long").alias("line_end"), F.col("word_count").cast("long").alias("n_words"))


@query(f"WITH RECURSIVE plain AS (SELECT doc_id, {strip_sql('text')} AS body FROM documents), {chunks_sql('plain', 100)} SELECT {_CHUNK} FROM made")
def chunk_headerless(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without headers, cut as oversized pieces."""
    return _exploded(documents(spark, folder), chunking.chunks(text.strip("text"), chunking.ChunkConfig(max_tokens=100)))


_UNEVEN = (
    "concat('== ', source, ' ==', chr(10), replace(text, '. ', CASE WHEN doc_id % 3 = 0 THEN '.' || chr(10) WHEN doc_id % 3 = 1 THEN '; ' ELSE '! ' END), chr(10), chr(10), "
    "'  === Sub = x ===', chr(10), repeat(text || ' ', (doc_id % 2)::int), chr(10), '====', lang, '====  ', chr(10), repeat('same words again. ', (doc_id % 40)::int), chr(10), substr(text, 1, 900), chr(10), '== End ==')"
)


@query(f"WITH RECURSIVE uneven AS (SELECT doc_id, {strip_sql(_UNEVEN)} AS body FROM documents), {chunks_sql('uneven', 60, 12)} SELECT {_CHUNK} FROM made")
def chunk_uneven_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines beyond the limit, headers within and after them, repeated sentences and an overlap of lines."""
    rows = documents(spark, folder).select("doc_id", text.strip(F.expr(_UNEVEN)).alias("m"))
    return _exploded(rows, chunking.chunks(F.col("m"), chunking.ChunkConfig(max_tokens=60, overlap_tokens=12)))


@query(
    f"""
    WITH RECURSIVE {W_}, {_INTERNAL_SQL}, clean AS (SELECT doc_id, {_clean_sql("m")} AS body FROM wiki), {chunks_sql("clean", 300)},
    big AS (SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY chunk_index) AS before FROM made WHERE word_count >= 10),
    kept AS (SELECT * EXCLUDE (chunk_index), (row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index) - 1)::INTEGER AS chunk_index FROM big WHERE text IS DISTINCT FROM before),
    linked AS (SELECT doc_id, string_agg(target, '|' ORDER BY i) FILTER (link_type = 'internal') AS internal_links, string_agg(target, '|' ORDER BY i) FILTER (link_type = 'category') AS categories FROM internal GROUP BY doc_id)
    SELECT lang || '/' || source || '_' || doc_id || '#' || chunk_index AS chunk_id, text, source || ' ' || doc_id AS article_title, lang AS namespace, section, chunk_index, line_start || '-' || line_end AS line_range,
           word_count::BIGINT AS word_count, categories, internal_links, doc_id % 10 = 0 AS is_stub, (doc_id % 7 = 0)::BIGINT AS citation_needed_count, doc_id % 5 = 0 AS has_blockquote,
           NULL::VARCHAR AS library_work_author, NULL::VARCHAR AS library_work_type, NULL::INTEGER AS library_work_published_year, 'person' AS infobox_type, NULL::VARCHAR AS political_orientation,
           string_split(categories, '|')[1] AS primary_category, len(string_split(categories, '|'))::INTEGER AS category_count
    FROM kept JOIN wiki USING (doc_id) JOIN linked USING (doc_id)
    """
)
def chunk_fact_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = wiki(spark, folder).select(F.col("lang").alias("namespace"), F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("title"), F.col("m").alias("markup"))
    out = chunking.chunk_records(extract_articles(rows), chunking.ChunkConfig(max_tokens=300))
    lists = {c: F.array_join(c, "|") for c in ("categories", "internal_links", "political_orientation")}
    return out.withColumns({**lists, "word_count": F.col("word_count").cast("long")})


def _per_text(returns: str, f: Callable[[str], object]) -> Callable[[Column], Column]:
    """A function of the operators in Python, over a column of texts."""

    @F.pandas_udf(returns)
    def applied(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([f(t) for t in batch])

    return lambda c: applied(F.coalesce(c, F.lit("")))


_CUT = "substr(text, 1, least(length(text), 200))"


def _after_last(*marks: str) -> str:
    return "greatest(" + ", ".join(f"CASE WHEN contains({_CUT}, {q(m)}) THEN {folds._last(_CUT, m)} + {len(m)} ELSE 0 END" for m in marks) + ", 0)"


@query(
    f"""
    WITH cut AS (SELECT doc_id, text, {_after_last(". ", "! ", "? ")} AS a, {_after_last("; ", ", ", ": ")} AS b, {_after_last(" ")} AS c, least(length(text), 200) AS e FROM documents)
    SELECT doc_id, ceil(length(text) / 4)::BIGINT AS n_tokens, greatest(1, e)::BIGINT AS longest, (CASE WHEN e >= length(text) THEN length(text) WHEN a > 1 THEN a WHEN b > 1 THEN b WHEN c > 1 THEN c ELSE e END)::BIGINT AS split_at FROM cut
    """
)
def split_positions(spark: SparkSession, folder: str) -> DataFrame:
    count = _per_text("bigint", chunking.quarter)(F.col("text"))
    longest = _per_text("bigint", lambda t: chunking.longest_prefix(t, 50, chunking.quarter))(F.col("text"))
    split = _per_text("bigint", lambda t: chunking.split_position(t, 50, chunking.quarter))(F.col("text"))
    return documents(spark, folder).select("doc_id", count.alias("n_tokens"), longest.alias("longest"), split.alias("split_at"))


@query(f"SELECT doc_id, {folds._line_ends('substr(text, 1, length(text) // 3)')}::BIGINT AS first_line, {folds._line_ends('substr(text, 1, 2 * length(text) // 3)')}::BIGINT AS last_line FROM documents WHERE length(text) > 3")
def segment_lines(spark: SparkSession, folder: str) -> DataFrame:
    found = _per_text("array<bigint>", lambda t: list(chunking.lines_of(len(t) // 3, 2 * len(t) // 3, [len(x) for x in t.split("\n")])))(F.col("text"))
    return documents(spark, folder).where("length(text) > 3").select("doc_id", found.alias("x")).select("doc_id", F.col("x")[0].alias("first_line"), F.col("x")[1].alias("last_line"))


# -- embeddings


@query()
def embed_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return embedding.embed_chunks(documents(spark, folder).select("doc_id", "text"), config=embedding.EmbedConfig(dimensions=64)).drop("text")


def _batched(spark: SparkSession, folder: str, cut: Callable[[list[str]], list[list[str]]]) -> DataFrame:
    """The batch of each document in its list of texts: per source, the documents of 100 identifiers."""

    @F.pandas_udf("array<bigint>")
    def numbers(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lists:
            yield pd.Series([[n for n, own in enumerate(cut(list(texts))) for _ in own] for texts in batch])

    rows = documents(spark, folder).groupBy("source", F.floor(F.col("doc_id") / 100).alias("part")).agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("rows"))
    rows = rows.withColumn("batches", numbers(F.transform("rows", lambda r: r["text"])))
    return rows.select("source", F.explode(F.arrays_zip(F.col("rows").alias("r"), F.col("batches").alias("batch"))).alias("x")).select("source", "x.r.doc_id", "x.batch")


@query("SELECT doc_id, source, (row_number() OVER (PARTITION BY source, doc_id // 100 ORDER BY doc_id) - 1) // 7 AS batch FROM documents")
def batches_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(spark, folder, lambda texts: embedding.fixed_batches(texts, 7))


def _token_batches_sql(group: str, tokens: int, items: int) -> str:
    return f"""
    WITH RECURSIVE numbered AS (SELECT source, doc_id, {group} AS part, ceil(length(text) / 4)::BIGINT AS t, row_number() OVER (PARTITION BY source, {group} ORDER BY doc_id) AS r FROM documents),
    fold AS (
        SELECT source, part, doc_id, r, t, 0::BIGINT AS batch, CASE WHEN t > {tokens} THEN 0 ELSE {tokens} - t END AS room, CASE WHEN t > {tokens} THEN 0 ELSE {items - 1} END AS items FROM numbered WHERE r = 1
        UNION ALL
        SELECT n.source, n.part, n.doc_id, n.r, n.t, f.batch + CASE WHEN n.t > f.room OR f.items < 1 THEN 1 ELSE 0 END,
               CASE WHEN n.t > {tokens} THEN 0 WHEN n.t > f.room OR f.items < 1 THEN {tokens} - n.t ELSE f.room - n.t END,
               CASE WHEN n.t > {tokens} THEN 0 WHEN n.t > f.room OR f.items < 1 THEN {items - 1} ELSE f.items - 1 END
        FROM fold f JOIN numbered n ON n.source = f.source AND n.part = f.part AND n.r = f.r + 1
    )
    """


@query(_token_batches_sql("doc_id // 100", 2000, 4) + "SELECT source, doc_id, batch FROM fold")
def batches_token_aware(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(spark, folder, lambda texts: embedding.token_batches(texts, 2000, 4))


@query(_token_batches_sql("0", 4000, 32) + "SELECT source, doc_id, t AS tokens, batch FROM fold")
def batch_numbers(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select("source", "doc_id", F.ceil(F.length("text") / 4).cast("long").alias("tokens"))
    return embedding.batch_ids(rows, "source", "doc_id", "tokens", 4000, 32)


# -- health

_STAGES = """
    extracted AS (SELECT doc_id::VARCHAR AS key, lang AS namespace, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars END AS size FROM documents),
    chunks AS (SELECT doc_id::VARCHAR AS key, 'x' AS namespace, quality::BIGINT AS size FROM labels),
    embeddings_ AS (SELECT vec_id::VARCHAR AS key, 'x' AS namespace, len(embedding)::BIGINT AS size FROM embeddings)
"""


def _stages(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "extracted": documents(spark, folder).select(F.col("doc_id").cast("string").alias("key"), F.col("lang").alias("namespace"), F.when(F.col("doc_id") % 9 == 0, 0).otherwise(F.col("n_chars")).cast("long").alias("size")),
        "chunks": read(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("key"), F.lit("x").alias("namespace"), F.col("quality").cast("long").alias("size")),
        "embeddings": read(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("key"), F.lit("x").alias("namespace"), F.size("embedding").cast("long").alias("size")),
    }


@query(
    f"""
    WITH {_STAGES}, every AS (SELECT 'extracted' AS stage, size FROM extracted UNION ALL SELECT 'chunks', size FROM chunks UNION ALL SELECT 'embeddings', size FROM embeddings_)
    SELECT stage, count(*) AS total, count(*) FILTER (size > 0) AS non_empty, count(*) FILTER (size = 0) AS empty FROM every GROUP BY stage
    """
)
def health_stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    return health.stage_counts(_stages(spark, folder))


_GAPS = """
    gaps AS (SELECT 'missing_chunks' AS kind, key FROM extracted WHERE key NOT IN (SELECT key FROM chunks) UNION ALL
             SELECT 'missing_embeddings', key FROM chunks WHERE size > 0 AND key NOT IN (SELECT key FROM embeddings_) UNION ALL
             SELECT 'orphan_chunks', key FROM chunks WHERE key NOT IN (SELECT key FROM extracted) UNION ALL
             SELECT 'orphan_embeddings', key FROM embeddings_ WHERE key NOT IN (SELECT key FROM chunks))
"""


@query(f"WITH {_STAGES}, {_GAPS} SELECT kind, key FROM gaps")
def health_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return health.gaps(_stages(spark, folder))


@query(f"WITH {_STAGES} SELECT namespace, count(*) AS n FROM extracted WHERE size = 0 GROUP BY namespace")
def health_empty_by_namespace(spark: SparkSession, folder: str) -> DataFrame:
    return health.empty_by_namespace(_stages(spark, folder)["extracted"])


_DUPLICATION = f"WITH {_LINES} SELECT doc_id, count(*) AS total, count(DISTINCT line) AS distinct_values, count(*) - count(DISTINCT line) AS duplicates, round((count(*) - count(DISTINCT line)) / count(*), 6) AS ratio, (count(*) - count(DISTINCT line)) / count(*) > 0.1 AS corrupt FROM lines GROUP BY doc_id"


def _duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return health.duplication(chunking.lines_table(documents(spark, folder), "doc_id", "text"), "doc_id", "line")


@query(_DUPLICATION)
def health_duplication(spark: SparkSession, folder: str) -> DataFrame:
    return _duplicates(spark, folder).withColumn("ratio", F.round("ratio", 6))


@query(
    f"""
    WITH {_STAGES}, {_GAPS}, c AS (SELECT count(*) FILTER (kind = 'missing_chunks') AS missing_chunks, count(*) FILTER (kind = 'missing_embeddings') AS missing_embeddings,
        count(*) FILTER (kind = 'orphan_chunks') AS orphan_chunks, count(*) FILTER (kind = 'orphan_embeddings') AS orphan_embeddings FROM gaps)
    SELECT c.*, (SELECT count(*) FROM extracted WHERE size = 0) AS empty_extracted, 0::BIGINT AS corrupt,
           missing_chunks + missing_embeddings + orphan_chunks + orphan_embeddings + (SELECT count(*) FROM extracted WHERE size = 0) = 0 AS healthy FROM c
    """
)
def health_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return health.verdict(_stages(spark, folder))


@query(
    f"""
    WITH {_STAGES}, {_GAPS}, dup AS ({_DUPLICATION})
    SELECT 'extracted' AS stage, key, 'delete_empty' AS action FROM extracted WHERE size = 0 UNION ALL SELECT 'chunks', key, 'delete_empty' FROM chunks WHERE size = 0 UNION ALL
    SELECT 'embeddings', key, 'delete_empty' FROM embeddings_ WHERE size = 0 UNION ALL SELECT replace(kind, 'orphan_', ''), key, 'delete_orphan' FROM gaps WHERE starts_with(kind, 'orphan') UNION ALL
    SELECT 'chunks', doc_id::VARCHAR, 'delete_corrupt' FROM dup WHERE corrupt UNION ALL
    SELECT 'extracted', key, CASE WHEN key IN (SELECT page_id::VARCHAR FROM pages) THEN 'reprocess_empty' ELSE 'source_missing' END FROM extracted WHERE size = 0
    """
)
def health_repairs(spark: SparkSession, folder: str) -> DataFrame:
    sources = read(spark, folder, "pages").select(F.col("page_id").cast("string").alias("key"))
    duplicates = _duplicates(spark, folder).withColumn("key", F.col("doc_id").cast("string"))
    return health.repairs(_stages(spark, folder), duplicates, sources)


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    return health.resume(documents(spark, folder).select("doc_id", "n_chars"), read(spark, folder, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents ORDER BY md5('0|' || doc_id), doc_id LIMIT 50")
def sample_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    return health.sample(documents(spark, folder).select("doc_id", "lang"), 50, "doc_id")


# -- entities

_ENTITY_LINKS = rf"regexp_extract_all(m, {q(entities.NAMED_LINK)}, 1)"
_ENTITIES = f"""
    linked AS (SELECT DISTINCT doc_id, {strip_sql("x")} AS entity FROM (SELECT doc_id, unnest({_ENTITY_LINKS}) AS x FROM wiki) WHERE NOT (starts_with(x, 'Category:') OR starts_with(x, 'File:') OR starts_with(x, 'Image:')) AND {strip_sql("x")} <> ''),
    titled AS (SELECT 'Union ' || source || ' war' AS entity FROM wiki)
"""


def _titled(spark: SparkSession, folder: str) -> DataFrame:
    return wiki(spark, folder).withColumn("title", F.concat(F.lit("Union "), F.col("source"), F.lit(" war")))


@query(f"WITH {W_}, {_ENTITIES}, every AS (SELECT entity FROM linked UNION ALL SELECT entity FROM titled) SELECT entity, count(*) AS n FROM every GROUP BY entity ORDER BY n DESC, entity LIMIT 30")
def entities_top(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entity_counts(_titled(spark, folder), "title", "m").orderBy(F.desc("n"), "entity").limit(30)


def _kind_sql(x: str) -> str:
    any_of = lambda ns: " OR ".join(f"contains(lower({x}), {q(n)})" for n in ns)
    k = entities.KINDS
    return f"CASE WHEN {any_of(k['organization'])} THEN 'organization' WHEN {any_of(k['location'])} THEN 'location' WHEN {any_of(k['event'])} THEN 'event' WHEN {any_of(k['concept'])} THEN 'concept' WHEN starts_with({x}, 'Library:') THEN 'work' ELSE 'general' END"


_NAMES = rf"SELECT {strip_sql('x')} AS entity FROM (SELECT unnest(regexp_extract_all(m, '(?i)\|\s*name\s*=\s*([^\n|]+)', 1)) AS x FROM wiki)"


@query(
    f"""
    WITH {W_}, {_ENTITIES}, every AS (SELECT entity FROM linked UNION SELECT entity FROM titled UNION {_NAMES} WHERE NOT (starts_with({strip_sql("x")}, '{{{{') OR starts_with({strip_sql("x")}, '[[') OR starts_with({strip_sql("x")}, 'File:') OR starts_with({strip_sql("x")}, '<')) AND {strip_sql("x")} <> '')
    SELECT DISTINCT entity, {_kind_sql("entity")} AS kind FROM every
    """
)
def entities_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    return entities.all_entities(_titled(spark, folder), "title", "m")


_RAW_ENTITY = "concat(CASE doc_id % 6 WHEN 0 THEN '''''' WHEN 1 THEN ' ' WHEN 2 THEN 'https://' WHEN 3 THEN '[[' ELSE '' END, CASE WHEN doc_id % 5 = 0 THEN doc_id::VARCHAR ELSE source || ' ' || lang || '#' || doc_id END, CASE WHEN doc_id % 6 = 4 THEN '}}' ELSE '' END)"
_VALID = "length(entity) >= 2 AND NOT regexp_matches(entity, '^(\\{\\{|\\[\\[|<|\\||=|http://|https://|www\\.)') AND NOT regexp_matches(entity, '(\\}\\}|\\]\\]|>)$') AND NOT (regexp_matches(entity, '^[0-9]+$') AND length(entity) <> 4)"


@query(f"WITH raw AS (SELECT split_part({strip_sql(f'''regexp_replace({_RAW_ENTITY}, '{chr(39) * 4}{chr(39) * 2}?', '', 'g')''')}, '#', 1) AS entity FROM documents) SELECT DISTINCT entity, lower(entity) AS lower FROM raw WHERE {_VALID}")
def whitelist_clean(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.expr(_RAW_ENTITY.replace("''''''", "\"''\"").replace("doc_id::VARCHAR", "cast(doc_id as string)"))
    return entities.whitelist(documents(spark, folder).select(raw.alias("entity")))


@query(f"WITH {W_}, y AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(m, '\\b(1[0-9]{{3}}|20[0-2][0-9])\\b', 1))) AS year FROM (SELECT doc_id, concat('In 1', doc_id % 900 + 100, ' and ', 1950 + doc_id % 50, '.') AS m FROM wiki)) SELECT doc_id, year FROM y")
def entity_years(spark: SparkSession, folder: str) -> DataFrame:
    made = F.concat(F.lit("In 1"), (F.col("doc_id") % 900 + 100).cast("string"), F.lit(" and "), (F.col("doc_id") % 50 + 1950).cast("string"), F.lit("."))
    return documents(spark, folder).select("doc_id", F.explode(entities.years_of(made)).alias("year"))


# -- curation

_PAIRS = "pairs AS (SELECT u.conv_id * 1000 + u.turn AS line_no, u.text AS instruction, a.text AS response FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations")
    u, a = rows.where("role = 'user'").alias("u"), rows.where("role = 'assistant'").alias("a")
    joined = u.join(a, (F.col("u.conv_id") == F.col("a.conv_id")) & (F.col("a.turn") == F.col("u.turn") + 1))
    return joined.select((F.col("u.conv_id") * 1000 + F.col("u.turn")).alias("line_no"), F.col("u.text").alias("instruction"), F.col("a.text").alias("response"))


_BOTH = "concat_ws(' ', instruction, response)"
# RE2's word boundaries are ASCII, Spark's are not: the rules are compared without them
_ASCII_RULES = tuple(curation.Rule(r.pattern.replace(r"\b", ""), r.author_key, r.work, r.namespace, r.category) for r in curation.RULES)
_DETECT = "CASE " + " ".join(f"WHEN regexp_matches({_BOTH}, {q('(?i)' + r.pattern)}) THEN {q(r.author_key)}" for r in _ASCII_RULES) + " ELSE 'uncategorized' END"
_SPACE_OF = "CASE author WHEN 'spanish_prose' THEN 'Essays' ELSE 'Library' END"


@query(f"WITH {_PAIRS}, d AS (SELECT line_no, {_DETECT} AS author FROM pairs) SELECT line_no, author, {_SPACE_OF} AS namespace, CASE author WHEN 'uncategorized' THEN 'low' ELSE 'high' END AS confidence FROM d")
def detect_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pairs(spark, folder).withColumn("s", curation.detect_source(F.concat_ws(" ", "instruction", "response"), _ASCII_RULES))
    return rows.select("line_no", F.col("s.author_key").alias("author"), "s.namespace", "s.confidence")


def _topic_sql() -> str:
    any_of = lambda ns: " OR ".join(f"contains(lower({_BOTH}), {q(n)})" for n in ns)
    own = [f"CASE WHEN {any_of(ns)} THEN {q(t)} END" for t, ns in curation.TOPICS.items()]
    return f"list_sort(list_filter([CASE WHEN author <> 'uncategorized' THEN replace(author, '_', '-') END, {', '.join(own)}], lambda t: t IS NOT NULL))"


_CURATED = f"""
    {_PAIRS}, d AS (SELECT *, {_DETECT} AS author FROM pairs),
    r AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY line_no) AS n, {_topic_sql()} AS topics,
                 CASE WHEN {" OR ".join(f"contains(lower(response), {q(n)})" for n in curation.TRADITIONS[0][1])} THEN 'latin' WHEN {" OR ".join(f"contains(lower(response), {q(n)})" for n in curation.TRADITIONS[1][1])} THEN 'germanic' ELSE 'other' END AS tradition FROM d)
"""


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return curation.qa_records(_pairs(spark, folder), rules=_ASCII_RULES)


_QA_ID = f"{_SPACE_OF} || '/' || list_aggregate(list_transform(string_split(author, '_'), lambda w: upper(w[1]) || w[2:]), 'string_agg', '_') || '#' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END"


@query(f"WITH {_CURATED} SELECT {_QA_ID} AS qa_id, line_no, CASE WHEN len(topics) > 0 THEN array_to_string(topics, '|') ELSE 'general' END AS topics, tradition, author FROM r")
def qa_records(spark: SparkSession, folder: str) -> DataFrame:
    return _records(spark, folder).select("qa_id", F.col("original_line").alias("line_no"), F.array_join("classification.categories", "|").alias("topics"), F.col("classification.tradition").alias("tradition"), F.col("source.author").alias("author"))


@query(f"WITH {_CURATED}, t AS (SELECT unnest(CASE WHEN len(topics) > 0 THEN topics ELSE ['general'] END) AS category FROM r) SELECT category, count(*) AS n FROM t GROUP BY category")
def qa_category_summary(spark: SparkSession, folder: str) -> DataFrame:
    return curation.category_summary(_records(spark, folder))


@query(f"WITH {_PAIRS} SELECT 'system' AS first_role, {q(curation.SYSTEM_PROMPT)} AS system, instruction AS prompt, response AS answer FROM pairs")
def chat_export(spark: SparkSession, folder: str) -> DataFrame:
    out = curation.to_chat(_pairs(spark, folder))
    return out.select(F.col("prompt")[0]["role"].alias("first_role"), F.col("prompt")[0]["content"].alias("system"), F.col("prompt")[1]["content"].alias("prompt"), "answer")


@query("SELECT text AS qa_id, count(*) AS n FROM documents WHERE text <> '' GROUP BY text HAVING count(*) > 1")
def validate_duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    return curation.duplicate_ids(documents(spark, folder).select(F.col("text").alias("qa_id")))


_ACTUAL = "actual AS (SELECT source AS filename, count(*) AS n FROM documents GROUP BY source)"


@query(f"WITH {_ACTUAL}, expected AS (SELECT source AS filename, count(*) FILTER (lang = 'en') AS e FROM documents GROUP BY source) SELECT filename, e AS expected, n AS actual FROM expected JOIN actual USING (filename) WHERE e <> n")
def validate_manifest(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder)
    expected = rows.groupBy(F.col("source").alias("filename")).agg(F.count_if(F.col("lang") == "en").alias("record_count"))
    return curation.manifest_mismatches(expected, rows.groupBy(F.col("source").alias("filename")).agg(F.count("*").alias("record_count")))


@query("SELECT event_id AS line_no, v AS value FROM (SELECT event_id, CASE WHEN event_id % 20 = 0 THEN props || '}' ELSE props END AS v FROM events) WHERE NOT json_valid(v)")
def validate_json_syntax(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "events").select(F.col("event_id").alias("line_no"), F.when(F.col("event_id") % 20 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props")).alias("value"))
    return curation.syntax_errors(rows)


@query(f"WITH {_CURATED} SELECT {_QA_ID} AS qa_id, 'there is no credential' AS rule FROM r WHERE contains(lower(response), 'token') UNION ALL SELECT {_QA_ID}, 'the answer is long' FROM r WHERE length(response) <= 400")
def validate_records(spark: SparkSession, folder: str) -> DataFrame:
    rules = curation.record_rules() | {"there is no credential": ~F.lower("response").contains("token"), "the answer is long": F.length("response") > 400}
    return curation.schema_violations(_records(spark, folder), rules)


# -- graph

_EDGES = "edges AS (SELECT DISTINCT 'd' || doc_id AS source, lang || '/' || source AS target FROM documents UNION SELECT DISTINCT lang || '/' || source, source FROM documents)"


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder)
    pair = F.concat_ws("/", "lang", "source")
    first = rows.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("source"), pair.alias("target"))
    return first.unionByName(rows.select(pair.alias("source"), F.col("source").alias("target")))


@query(f"WITH {_EDGES} SELECT node, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree FROM (SELECT source AS node, 0 AS i, 1 AS o FROM edges UNION ALL SELECT target, 1, 0 FROM edges) GROUP BY node")
def graph_degrees(spark: SparkSession, folder: str) -> DataFrame:
    return graph.degrees(_edges(spark, folder))


@query(f"WITH {_EDGES} SELECT source FROM edges WHERE target = 'src0'")
def graph_backlinks(spark: SparkSession, folder: str) -> DataFrame:
    return graph.backlinks(_edges(spark, folder), "src0")


_CATEGORIES = "cats AS (SELECT doc_id AS article, lang AS category FROM documents UNION SELECT doc_id, source FROM documents UNION SELECT doc_id, 'long' FROM documents WHERE n_chars > 1000)"


@query(f"WITH {_CATEGORIES} SELECT x.category AS a, y.category AS b, count(*) AS n FROM cats x JOIN cats y ON x.article = y.article AND x.category < y.category GROUP BY 1, 2")
def category_cooccurrence(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select(F.col("doc_id").alias("article"), F.explode(F.array_compact(F.array("lang", "source", F.when(F.col("n_chars") > 1000, F.lit("long"))))).alias("category"))
    return graph.cooccurrence(rows)


@query(f"WITH {_CATEGORIES} SELECT category, count(DISTINCT article) AS n_articles FROM cats GROUP BY category")
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select(F.lit("x").alias("namespace"), F.col("doc_id").alias("article_title"), F.array_compact(F.array("lang", "source", F.when(F.col("n_chars") > 1000, F.lit("long")))).alias("categories"))
    return search.category_counts(rows)


@query(
    f"""
    WITH top AS (SELECT vec_id, {_DISTANCE["cosine"]} AS d FROM embeddings, {_QUERY_VECTOR} ORDER BY d, vec_id LIMIT 20),
    deg AS (SELECT label AS vec_id, count(*) AS in_degree FROM embeddings GROUP BY label)
    SELECT vec_id, coalesce(in_degree, 0) AS in_degree, round(d, 5) AS distance FROM top LEFT JOIN deg USING (vec_id) ORDER BY 2 DESC, d, vec_id LIMIT 10
    """
)
def popularity_rerank(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    found = search.search(rows, _first_vector(spark, folder), 20, id_col="vec_id")
    popular = rows.groupBy(F.col("label").cast("long").alias("node")).agg(F.count("*").alias("in_degree"))
    return graph.boosted(found, popular, "vec_id").select("vec_id", "in_degree", F.round("distance", 5).alias("distance"))


@query(f"WITH {_EDGES}, own AS (SELECT target FROM edges WHERE source = 'd1') SELECT source, count(*) AS shared FROM edges WHERE source <> 'd1' AND target IN (SELECT target FROM own) GROUP BY source")
def graph_related(spark: SparkSession, folder: str) -> DataFrame:
    return graph.related(_edges(spark, folder), "d1")


@query(f"WITH {_EDGES}, one AS (SELECT DISTINCT target AS node FROM edges WHERE source = 'd1'), two AS (SELECT DISTINCT target AS node FROM edges WHERE source IN (SELECT node FROM one)) SELECT 'd1' AS node, 0 AS hops UNION ALL SELECT node, 1 FROM one WHERE node <> 'd1' UNION ALL SELECT node, 2 FROM two WHERE node <> 'd1' AND node NOT IN (SELECT node FROM one)")
def graph_explore(spark: SparkSession, folder: str) -> DataFrame:
    return graph.explore(_edges(spark, folder), "d1")


_CITED = "WITH c AS (SELECT doc_id AS article, 'B' || doc_id % 5 AS author, 'T' || doc_id % 50 AS title, (1900 + doc_id % 100)::VARCHAR AS year FROM documents), r AS (SELECT *, sha256(concat_ws('|', lower(author), year, lower(title))) AS ref_id FROM c)"


@query(f"{_CITED} SELECT ref_id, min(author) AS author, min(year) AS year, min(title) AS title, count(*) AS n_citations, count(DISTINCT article) AS n_articles FROM r GROUP BY 1")
def references_table(spark: SparkSession, folder: str) -> DataFrame:
    return graph.references(citations.citations(wiki(spark, folder), "doc_id", "m").withColumnRenamed("doc_id", "article"))


@query(f"{_CITED} SELECT DISTINCT ref_id, article FROM r")
def citing_articles(spark: SparkSession, folder: str) -> DataFrame:
    return graph.citing_articles(citations.citations(wiki(spark, folder), "doc_id", "m").withColumnRenamed("doc_id", "article"))


# -- files and collections, written to the shared folder and read back


def _scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a local session without one gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lexquarry-")
    path = f"{folder.rstrip('/')}/queries-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended already
        pass


@query("SELECT 'c' || doc_id AS chunk_id, text, source AS article_title, lang AS namespace, CASE WHEN doc_id % 2 = 0 THEN source END AS section, (doc_id % 100)::INTEGER AS chunk_index, lang || '|' || source AS categories, n_chars > 500 AS is_stub FROM documents")
def chunk_files(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk files: one JSON object a line, nulls and lists kept."""
    path = _scratch(spark)
    rows = documents(spark, folder).select(F.expr("'c' || doc_id").alias("chunk_id"), "text", F.col("source").alias("article_title"), F.col("lang").alias("namespace"), F.expr("case when doc_id % 2 = 0 then source end").alias("section"),
        F.expr("cast(doc_id % 100 as int)").alias("chunk_index"), F.array("lang", "source").alias("categories"), F.expr("n_chars > 500").alias("is_stub"))
    files.write_chunks(rows, path)
    return files.read_chunks(spark, path).select("chunk_id", "text", "article_title", "namespace", "section", "chunk_index", F.array_join("categories", "|").alias("categories"), "is_stub")


@query("SELECT 'd' || doc_id AS title, lang AS namespace, text AS markup, 'd ' || doc_id AS flat_title FROM documents WHERE lang IN ('en', 'de')")
def article_files(spark: SparkSession, folder: str) -> DataFrame:
    """Clean texts and articles under folders of namespaces, read as tables."""
    path = _scratch(spark)
    rows = documents(spark, folder).select(F.col("lang").alias("namespace"), F.expr("'d' || doc_id").alias("title"), F.col("text").alias("clean_text"))
    files.write_texts(rows, f"{path}/texts")
    files.write_articles(rows, f"{path}/articles")
    back = spark.read.schema("title string, clean_text string, namespace string").json(f"{path}/texts").where("namespace in ('en', 'de')").select("title", "namespace", F.col("clean_text").alias("markup"))
    flat = spark.read.parquet(f"{path}/articles").select("title", files.title_of(F.expr("concat('/x/', replace(title, 'd', 'd_'), '.txt')")).alias("flat_title"))
    return back.join(flat, "title")


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x, i: (x::DOUBLE * i))), 6) AS digest, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) AS row_idx, label AS article FROM embeddings")
def npy_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors through NPY files of a folder per article, paired with their rows again."""
    path, rows = _scratch(spark), read(spark, folder, "embeddings")
    numbered = rows.withColumn("row_idx", (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long"))
    for article in [r.label for r in rows.select("label").distinct().limit(100).collect()]:  # the table has ten labels
        npy.write_npy(numbered.where(F.col("label") == article).repartition(1).sortWithinPartitions("row_idx"), f"{path}/{article}", rows_per_file=1 << 30)
    vectors = npy.read_npy(spark, path).select(F.element_at(F.split("path", "/"), -2).cast("int").alias("article"), "row_idx", "embedding")
    good, _ = npy.paired(numbered.select(F.col("label").alias("article"), "row_idx", "vec_id"), vectors)
    digest = F.aggregate(F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda s, x: s + x)
    return good.select("vec_id", F.round(digest, 6).alias("digest"), "row_idx", F.col("article").cast(rows.schema["label"].dataType).alias("article"))


@query(
    """
    WITH first AS (SELECT doc_id, quality::BIGINT AS value FROM labels), added AS (SELECT * FROM first UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
    changed AS (SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN -doc_id ELSE value END AS value FROM added)
    SELECT doc_id, value FROM changed WHERE doc_id % 7 <> 0 AND NOT (value BETWEEN 300 AND 400)
    """
)
def collection_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A stored collection after additions, replacements, deletions by identifier and by condition, compaction and a clearing of old versions."""
    old, new = _versions(spark, folder)
    c = store.Collection(spark, _scratch(spark), "docs", "doc_id", most_covering=2)
    c.add(old)
    c.add(new)
    c.add(new.where("doc_id % 10 = 3").withColumn("value", -F.col("doc_id")), mode="upsert")
    c.delete_rows(new.where("doc_id % 7 = 0"))
    c.delete_rows(None, {"value": {"$gte": 300, "$lte": 400}})
    c.vacuum()
    return c.rows()


@query(
    """
    WITH t AS (SELECT doc_id, lang AS namespace, source AS title FROM documents), m AS (SELECT DISTINCT lang AS namespace, source AS title, lang || source AS note FROM documents WHERE lang IN ('en', 'de') AND source <> 'src0'),
    least AS (SELECT title, min_by(note, namespace) AS note FROM m GROUP BY title)
    SELECT doc_id, t.namespace, t.title, coalesce(m.note, least.note) AS note, coalesce(m.note, least.note) IS NULL AS missing_metadata, m.note IS NOT NULL OR least.note IS NOT NULL AS is_stub
    FROM t LEFT JOIN m ON t.namespace = m.namespace AND t.title = m.title LEFT JOIN least ON t.title = least.title
    """
)
def metadata_of_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select("doc_id", F.col("lang").alias("namespace"), F.col("source").alias("title"))
    meta = rows.where("namespace in ('en', 'de') and title <> 'src0'").select("namespace", "title", F.concat("namespace", "title").alias("note"), F.lit(True).alias("is_stub")).distinct()
    return files.with_metadata(rows, meta).select("doc_id", "namespace", "title", "note", "missing_metadata", "is_stub")


@query("SELECT doc_id // 100 || '.txt' AS path, unnest(range(1, len(string_split(text, chr(10))) + 1))::INTEGER AS line_no, unnest(string_split(text, chr(10))) AS value FROM documents WHERE doc_id % 100 = 0")
def file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of files with their numbers."""
    path = _scratch(spark)
    documents(spark, folder).where("doc_id % 100 = 0").select(F.concat(F.floor(F.col("doc_id") / 100).cast("string"), F.lit(".txt")).alias("f"), "text").write.partitionBy("f").text(path)
    return files.json_lines(spark, path).select(F.regexp_extract("path", "/f=([^/]+)/", 1).alias("path"), "line_no", "value")


_DIGEST = "string_agg({}, chr(10) ORDER BY {})"


@query(
    f"""
    WITH lines AS (SELECT lang AS category, source AS author, doc_id AS original_line, sha256('{{"qa_id":"q' || doc_id || '","instruction":' || to_json(lang || ' "x"') || ',"response":' || to_json('r/' || n_chars) || '}}') AS d FROM documents),
    blocks AS (SELECT category, author, original_line // 10000 AS block, count(*) AS n, sha256({_DIGEST.format("d", "original_line")}) AS d FROM lines GROUP BY 1, 2, 3)
    SELECT category || '/' || author || '.jsonl' AS filename, sum(n)::BIGINT AS record_count, sha256({_DIGEST.format("d", "block")}) AS sha256 FROM blocks GROUP BY category, author
    """
)
def manifest_digests(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select(F.col("lang").alias("category"), F.col("source").alias("author"), F.col("doc_id").alias("original_line"), F.expr("'q' || doc_id").alias("qa_id"), F.expr("lang || ' \"x\"'").alias("instruction"), F.expr("'r/' || n_chars").alias("response"))
    return curation.manifest(rows)


@query(
    f"""
    WITH lines AS (SELECT (doc_id % 2) AS set, lang AS path, doc_id AS line_no, sha256(text) AS d FROM documents),
    blocks AS (SELECT set, path, line_no // 10000 AS block, count(*) AS n, sha256({_DIGEST.format("d", "line_no")}) AS d FROM lines GROUP BY 1, 2, 3)
    SELECT sum(n)::BIGINT AS n_lines, sha256({_DIGEST.format("d", "set, path, block")}) AS sha256 FROM blocks
    """
)
def collection_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Sources in the order of their paths, then synthetic files."""
    rows = documents(spark, folder).select("doc_id", F.col("lang").alias("path"), F.col("doc_id").alias("line_no"), F.col("text").alias("value"))
    return curation.collection_digest(curation.ordered_sources(rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")))


# -- what readers see


@query(
    """
    WITH found AS (SELECT *, doc_id / 7.0::DOUBLE / (SELECT max(doc_id) + 1 FROM documents) AS d FROM documents ORDER BY d, doc_id LIMIT 20)
    SELECT string_agg('**' || source || '** (' || lang || ', §' || CASE WHEN doc_id % 2 = 0 THEN '(none)' ELSE 'S' END || ', lines ?) [score: ' || printf('%.2f', 1 - d) || ']:' || chr(10) || '> ' || text, chr(10) || chr(10) ORDER BY d, doc_id) AS page FROM found
    """
)
def results_page(spark: SparkSession, folder: str) -> DataFrame:
    total = documents(spark, folder).agg(F.max("doc_id") + 1).first()[0]
    rows = documents(spark, folder).select("doc_id", F.col("source").alias("article_title"), F.col("lang").alias("namespace"), F.expr("case when doc_id % 2 = 1 then 'S' end").alias("section"), "text", (F.col("doc_id") / F.lit(7.0) / F.lit(total)).alias("distance"))
    return spark.createDataFrame([(search.rendered(rows.orderBy("distance", "doc_id").limit(search.MOST_LIMIT)),)], "page string")


@query(f"WITH {_LINES} SELECT string_agg(line, chr(10) || chr(10) ORDER BY line_no) AS article, 'Article not found: Nothing (Main)' AS missing FROM lines WHERE doc_id = 7")
def article_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = chunking.lines_table(documents(spark, folder), "doc_id", "text").select(F.expr("'Doc ' || doc_id").alias("article_title"), F.lit("Main").alias("namespace"), F.col("line").alias("text"), F.col("line_no").alias("chunk_index"))
    return spark.createDataFrame([(search.article_text(rows, "Doc 7"), search.article_text(rows, "Nothing"))], "article string, missing string")


@query(f"WITH {_STAGES}, {_GAPS}, ranked AS (SELECT kind, key, row_number() OVER (PARTITION BY kind ORDER BY key) AS r, count(*) OVER (PARTITION BY kind) AS n FROM (SELECT DISTINCT kind, key FROM gaps)) SELECT kind, any_value(n) AS n, string_agg(key, '|' ORDER BY key) AS keys FROM ranked WHERE r <= 50 GROUP BY kind")
def health_report(spark: SparkSession, folder: str) -> DataFrame:
    """The gaps that the report lists."""
    report = health.report(_stages(spark, folder)).select(F.from_json("report", "gaps array<struct<kind:string,n:bigint,keys:array<string>>>").alias("r"))
    return report.select(F.explode("r.gaps").alias("g")).select("g.kind", "g.n", F.array_join("g.keys", "|").alias("keys"))


@query("SELECT DISTINCT unnest(CASE WHEN lang IN ('en', 'de') THEN [source || ' ' || doc_id % 50, lang || ':' || source || ' ' || doc_id % 50] ELSE [source || ' ' || doc_id % 50] END) AS title FROM documents")
def titles_known(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select(F.expr("source || ' ' || doc_id % 50").alias("t"), "lang")
    return entities.titles(rows, "t", "lang", ("en", "de"))


# -- windows over events, as the streaming form computes them


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    out = windowed_counts(read(spark, folder, "events"), "ts", "event_type", "value")
    return out.withColumn("total", F.round("total", 4))

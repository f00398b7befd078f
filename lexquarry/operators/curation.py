"""Questions and answers for training: sources by rules, topics, identifiers, records, and their validation.

Rules are data: a list of (pattern, key, work, namespace, category), of which the first that matches counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.functions.text import contains_any


@dataclass(frozen=True)
class Rule:
    pattern: str
    author_key: str
    work: str
    namespace: str = "Library"
    category: str = "uncategorized"


#: A neutral set of rules, topics and traditions; a corpus brings its own.
RULES = (
    Rule(r"\bthe\b.*\bof\b", "english_prose", "Collected prose", "Library", "english_prose"),
    Rule(r"\b(der|und)\b", "german_prose", "Gesammelte Prosa", "Library", "german_prose"),
    Rule(r"\b(les|des)\b", "french_prose", "Prose recueillie", "Library", "french_prose"),
    Rule(r"\b(que|los)\b", "spanish_prose", "Prosa reunida", "Essays", "spanish_prose"),
)
TOPICS: dict[str, tuple[str, ...]] = {"endings": ("tion", "ment", "ción"), "articles": (" the ", " der ", " la "), "credentials": ("token", "license")}
TRADITIONS: tuple[tuple[str, tuple[str, ...]], ...] = (("latin", ("ción", "ment")), ("germanic", ("lich", "ung")))
UNKNOWN = Rule("", "uncategorized", "Unknown")
SYSTEM_PROMPT = "You are an assistant trained on this corpus. Think step by step, then answer with sources."


def detect_source(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The first rule that matches, in any case: one CASE, so that later patterns aren't tried."""
    fields = lambda r, known: F.struct(
        F.lit(r.author_key).alias("author_key"), F.lit(r.work).alias("work_title"), F.lit(r.namespace).alias("namespace"), F.lit(r.category).alias("category"),
        F.lit("high" if known else "low").alias("confidence"), F.lit(r.pattern if known else None).cast("string").alias("matched_pattern"),
    )
    out = F.when(text.rlike(f"(?iu){rules[0].pattern}"), fields(rules[0], True))
    for r in rules[1:]:
        out = out.when(text.rlike(f"(?iu){r.pattern}"), fields(r, True))
    return out.otherwise(fields(UNKNOWN, False))


def topics(text: Column, category: Column, rules: dict[str, tuple[str, ...]] = TOPICS, default: str = "general") -> Column:
    low = F.lower(text)
    own = [F.when(category != "uncategorized", F.replace(category, F.lit("_"), F.lit("-")))] + [F.when(contains_any(low, n), t) for t, n in rules.items()]
    found = F.array_sort(F.array_distinct(F.array_compact(F.array(*own))))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def tradition(text: Column, rules: tuple[tuple[str, tuple[str, ...]], ...] = TRADITIONS, default: str = "other") -> Column:
    low, out = F.lower(text), F.lit(default)
    for name, needles in reversed(rules):
        out = F.when(contains_any(low, needles), name).otherwise(out)
    return out


def has_quote(text: Column) -> Column:
    low = F.lower(text)
    return text.rlike("""["']{2,}|["“”].*["“”]""") | low.contains("quoted") | low.contains("said:")


def slug(key: Column) -> Column:
    return F.replace(F.initcap(F.replace(key, F.lit("_"), F.lit(" "))), F.lit(" "), F.lit("_"))


def qa_records(pairs: DataFrame, order_col: str = "line_no", rules: tuple[Rule, ...] = RULES, created_date: str = "1970-01-01", created_by: str = "curation") -> DataFrame:
    """(line_no, instruction, response) -> records with an identifier that counts up per author in the lines' order.

    The numbers come from counts per author and bucket of lines plus a window within each bucket, so that an
    author with most of the lines is numbered by many tasks.
    """
    both = F.concat_ws(" ", F.coalesce("instruction", F.lit("")), F.coalesce("response", F.lit("")))
    rows = pairs.withColumn("_both", both).withColumn("_source", detect_source(F.col("_both"), rules)).withColumn("_bucket", F.floor(F.col(order_col) / 10_000))
    rows = rows.withColumn("author_key", F.col("_source.author_key"))
    sums = rows.groupBy("author_key", "_bucket").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("author_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("author_key", "_bucket", before.alias("_before"))
    rows = rows.join(sums, ["author_key", "_bucket"])
    number = F.col("_before") + F.row_number().over(Window.partitionBy("author_key", "_bucket").orderBy(order_col))
    source = F.col("_source")
    return rows.withColumn("_n", number).select(
        F.concat(source["namespace"], F.lit("/"), slug(F.col("author_key")), F.lit("#"), F.lpad(F.col("_n").cast("string"), F.greatest(F.lit(3), F.length(F.col("_n").cast("string"))), F.lit("0"))).alias("qa_id"),
        "instruction",
        "response",
        F.struct(source["namespace"].alias("namespace"), source["work_title"].alias("article_title"), F.col("author_key").alias("author"), source["work_title"].alias("work")).alias("source"),
        F.struct(topics(F.col("_both"), source["category"]).alias("categories"), tradition(F.coalesce("response", F.lit(""))).alias("tradition")).alias("classification"),
        F.struct(F.lit(False).alias("is_stub"), F.lit(0).alias("citation_needed_count"), has_quote(F.coalesce("response", F.lit(""))).alias("has_blockquote"), F.lit(True).alias("human_verified"), source["confidence"].alias("confidence")).alias("quality"),
        F.struct(F.lit(created_date).alias("created_date"), F.lit(created_by).alias("created_by"), F.lit(1).alias("version")).alias("provenance"),
        F.col(order_col).alias("original_line"),
        source["category"].alias("category"),
    )


def split_by_author(records: DataFrame, path: str) -> DataFrame:
    """Write category/author folders of JSON lines; returns the manifest: file, record_count, sha256 of the lines in order."""
    first = records.groupBy(F.col("source.author").alias("author")).agg(F.min_by("category", "original_line").alias("category"))
    rows = records.drop("category").withColumn("author", F.col("source.author")).join(first, "author")
    rows.drop("original_line").write.option("ignoreNullFields", "false").partitionBy("category", "author").json(path)
    return manifest(rows)


def manifest(rows: DataFrame) -> DataFrame:
    """Counts and digests per file. A digest is that of the digests of blocks of 10000 line numbers, each that of its lines' digests, so that no task gathers more than a block."""
    line = F.sha2(F.to_json(F.struct("qa_id", "instruction", "response")), 256)
    joined = lambda c: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["d"]), "\n"), 256)
    blocks = rows.groupBy("category", "author", F.floor(F.col("original_line") / 10_000).alias("block")).agg(F.count("*").alias("n"), joined(F.struct("original_line", line.alias("d"))).alias("d"))
    per = blocks.groupBy("category", "author").agg(F.sum("n").alias("record_count"), joined(F.struct("block", "d")).alias("sha256"))
    return per.select(F.concat(F.col("category"), F.lit("/"), F.col("author"), F.lit(".jsonl")).alias("filename"), "record_count", "sha256")


def category_summary(records: DataFrame) -> DataFrame:
    own = records.select(F.explode("classification.categories").alias("category"))
    return own.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def to_chat(records: DataFrame, system: str = SYSTEM_PROMPT) -> DataFrame:
    """prompt (system and user message) and answer; what is missing is empty."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return records.select(F.array(message("system", F.lit(system)), message("user", F.coalesce("instruction", F.lit("")))).alias("prompt"), F.coalesce("response", F.lit("")).alias("answer"))


def ordered_sources(sources: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Lines (path, line_no, value) of sources by path, then of synthetic files, with the rank of their set."""
    own = sources.select(F.lit(0).alias("set"), "path", "line_no", "value").unionByName(synthetic.select(F.lit(1).alias("set"), "path", "line_no", "value"))
    return own.orderBy("set", "path", "line_no")


def collection_digest(lines: DataFrame) -> DataFrame:
    """One row: the number of lines (set, path, line_no, value) and a digest of them in order, by file and then over the files' digests."""
    part = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", F.sha2("value", 256).alias("d")))), lambda x: x["d"]), "\n"), 256)
    files = lines.groupBy("set", "path", F.floor(F.col("line_no") / 10_000).alias("block")).agg(F.count("*").alias("n"), part.alias("d"))
    whole = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("set", "path", "block", "d"))), lambda x: x["d"]), "\n"), 256)
    return files.agg(F.sum("n").alias("n_lines"), whole.alias("sha256"))


# -- validation


def syntax_errors(lines: DataFrame) -> DataFrame:
    """(path, line_no, value) of lines that are not one JSON value.

    The parser stops at a value's end; put into an array as well as into an object, only a whole value parses.
    """
    return lines.where(F.expr("""try_parse_json(concat('[', value, ']')) is null or try_parse_json(concat('{"a":', value, '}')) is null"""))


def duplicate_ids(records: DataFrame, id_col: str = "qa_id") -> DataFrame:
    own = records.where(F.coalesce(F.col(id_col), F.lit("")) != "")
    return own.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1")


def manifest_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """filename, expected, actual: where both have a file and counts differ."""
    own = expected.select("filename", F.col("record_count").alias("expected")).join(actual.select("filename", F.col("record_count").alias("actual")), "filename")
    return own.where("expected <> actual")


def schema_violations(records: DataFrame, rules: dict[str, Column], id_col: str = "qa_id", most: int = 10) -> DataFrame:
    """(id, rule) of rules that a record breaks, at most ``most`` each; a rule is a condition that must hold."""
    broken = F.slice(F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()])), 1, most)
    return records.select(id_col, F.explode(broken).alias("rule"))


#: What a record must satisfy.
RECORD_RULES: dict[str, str] = {
    "qa_id has the form namespace/title#number": r"qa_id rlike '^[^/]+/[^#]+#[0-9]{3,}$'",
    "instruction is not blank": "trim(instruction) <> ''",
    "response is not blank": "trim(response) <> ''",
    "confidence is known": "quality.confidence in ('high', 'medium', 'low')",
    "there is a category": "size(classification.categories) > 0",
    "version is positive": "provenance.version >= 1",
}


def record_rules() -> dict[str, Column]:
    return {name: F.expr(rule) for name, rule in RECORD_RULES.items()}

"""Web-archive derivatives: from each response a metadata and a plain-text conversion record.

Both name the response in WARC-Refers-To (and the metadata record in WARC-Concurrent-To, as it is
made from the same capture), carry its target URI, date and payload digest, and have digests of
their own blocks. The metadata record is ``application/warc-fields``: the source's HTTP headers, title, language and
outlinks. Record identifiers are name-based: the same capture always gets the same ones, so a task that runs
again writes the same records.

All of it is DataFrame functions over one row per response: no shuffle, no state.

Defined results: a null page is an empty payload; a null URL has no target URI and resolves no
links; a text without words is an empty conversion; unclosed comments, scripts and tags are text
like any other; rows that repeat a page repeat its records; other columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts that are not text; what a reader doesn't see.
HIDDEN = r"(?is)<(?:!--.*?-->|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>|title\b[^>]*>.*?</title\s*>|noscript\b[^>]*>.*?</noscript\s*>|template\b[^>]*>.*?</template\s*>)"
#: Elements that begin and end a line.
BREAKS = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b(?:[^'\">]|\"[^\"]*\"|'[^']*')*>"
#: Java keeps the states of a group's repetition on its stack, so it must not go back into one.
BREAKS_JAVA = BREAKS.replace("*>", "*+>")
TAGS = r"<(?:/?[A-Za-z](?:[^'\">]|\"[^\"]*\"|'[^']*')*>|![A-Za-z][^>]*>)"
TAGS_JAVA = TAGS.replace("')*>", "')*+>")
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
LANGUAGE = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)"
LINK = r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
#: Named characters that pages use, beside the ampersand.
ENTITIES = {
    "nbsp": "\u00a0", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "reg": "®", "trade": "™", "middot": "·",
    "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»", "euro": "€", "pound": "£", "sect": "§", "deg": "°", "times": "×",
}
NUMBER = r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"


def _number(m: Column) -> Column:
    """The character of a numbered one; those outside Unicode, and surrogates, become U+FFFD."""
    code = F.when(m.rlike("^&#[xX]"), F.conv(F.regexp_extract(m, "([0-9A-Fa-f]+);", 1), 16, 10)).otherwise(F.regexp_extract(m, "([0-9]+);", 1)).cast("long")
    code = F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), 0xFFFD).otherwise(code)
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _characters(df: DataFrame, column: str) -> DataFrame:
    """Named and numbered characters in place of their names, in one pass; unknown names stay."""
    text = F.col(column)
    pattern = f"&(?:[A-Za-z]{{2,6}}|{NUMBER[1:-1]});"
    known = F.create_map(*[F.lit(x) for n, c in {**ENTITIES, "amp": "&"}.items() for x in (f"&{n};", c)])
    character = lambda m: F.when(m.startswith("&#"), _number(m)).otherwise(F.coalesce(F.try_element_at(known, m), m))
    # as an array's element, the pieces and the matches are made once, however often they are read
    parts = F.array(F.struct(F.split(text, pattern, -1).alias("rest"), F.regexp_extract_all(text, F.lit(f"({pattern})"), 1).alias("found")))
    joined = F.transform(
        parts,
        lambda p: F.concat(F.array_join(F.zip_with(F.slice(p["rest"], F.lit(1), F.size(p["found"])), F.transform(p["found"], character), lambda a, b: F.concat(a, b)), ""), F.element_at(p["rest"], -1)),
    )
    return df.withColumn(column, F.when(F.instr(text, "&") > 0, joined[0]).otherwise(text))


def _tidy(text: Column) -> Column:
    """Single spaces, no empty lines, no white space at either end."""
    text = F.regexp_replace(text, "[ \t\x0b\f\r\u00a0]{2,}|[\t\x0b\f\r\u00a0]", " ")
    text = F.regexp_replace(text, " ?\n[\n ]*", "\n")
    return F.btrim(text, F.lit(" \n"))


def plain_text(df: DataFrame, html_col: str, out_col: str) -> DataFrame:
    """``df`` with what a reader sees of a page, one line per block."""
    text = F.regexp_replace(F.col(html_col), HIDDEN, "")
    text = F.regexp_replace(text, BREAKS_JAVA, "\n")
    df = _characters(df.withColumn(out_col, F.regexp_replace(text, TAGS_JAVA, "")), out_col)
    return df.withColumn(out_col, _tidy(F.col(out_col)))


def record_id(*parts: Column) -> Column:
    """A name-based identifier in a UUID's form."""
    name = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages, which keeps neither date nor HTTP headers: ``date`` stands in."""
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    base = pages.select(F.col(f"`{id_col}`").alias("source_id"), F.col(f"`{url_col}`").alias("target_uri"), payload.alias("payload"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"))
    base = base.withColumns({"http_headers": http, "payload_digest": digest(F.col("payload")), "date": F.lit(date)})
    name = record_id(F.lit("response"), F.coalesce("target_uri", F.lit("")), F.col("date"), F.col("payload_digest"))
    return base.select("source_id", name.alias("record_id"), "target_uri", "date", "http_headers", "payload", "payload_digest")


def derive(responses: DataFrame) -> DataFrame:
    """Per response its metadata and conversion record, as the structs ``metadata`` and ``conversion``; other columns stay, but for those of the new ones' names."""
    title = F.replace(F.regexp_extract("payload", TITLE, 1), F.lit("\n"), F.lit(" "))
    links = F.regexp_extract_all("payload", F.lit(LINK), 1)
    origin = F.regexp_extract("target_uri", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract("target_uri", "^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    folder = F.regexp_extract("target_uri", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/))", 1)
    folder = F.when(folder == "", F.concat("origin", F.lit("/"))).otherwise(folder)

    def absolute(link: Column) -> Column:
        return (
            F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
            .when(link.startswith("//"), F.concat("scheme", link))
            .when(link.startswith("/"), F.concat("origin", link))
            .when(link.startswith("#"), F.lit(None))
            .when(link.startswith("?"), F.concat(F.regexp_extract("target_uri", "^([^?#]*)", 1), link))
            .otherwise(F.concat("folder", link))
        )

    own = ("record_id", "target_uri", "date", "http_headers", "payload", "payload_digest")
    found = responses.select(*own, F.struct(*[F.col(f"`{c}`") for c in responses.columns]).alias("row")).withColumns({"origin": origin, "scheme": scheme}).withColumn("folder", folder)
    found = found.withColumns({"title": title, "language": F.regexp_extract("payload", LANGUAGE, 1), "links": F.array_compact(F.transform(links, absolute))})
    found = plain_text(_characters(found, "title").withColumn("title", _tidy(F.col("title"))), "payload", "text")
    source = F.transform(F.split("http_headers", "\r\n"), lambda h: F.concat(F.lit("source-header: "), h, F.lit("\r\n")))
    fields = F.concat(
        F.coalesce(F.array_join(source, ""), F.lit("")),
        F.when(F.col("title") != "", F.concat(F.lit("title: "), "title", F.lit("\r\n"))).otherwise(""),
        F.when(F.col("language") != "", F.concat(F.lit("language: "), "language", F.lit("\r\n"))).otherwise(""),
        F.coalesce(F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))), ""), F.lit("")),
    )
    found = found.withColumn("fields", fields)

    def made(kind: str, content_type: str, block: str) -> Column:
        return F.struct(
            record_id(F.lit(kind), F.col("record_id")).alias("record_id"), F.lit(kind).alias("warc_type"), F.col("record_id").alias("refers_to"), "target_uri", "date",
            F.lit(content_type).alias("content_type"), "payload_digest", digest(F.col(block)).alias("block_digest"), F.octet_length(block).cast("long").alias("content_length"), F.col(block).alias("block"),
        )

    new = ("title", "language", "n_outlinks", "metadata", "conversion")
    kept = [F.col(f"row.`{c}`").alias(c) for c in responses.columns if c not in new]
    return found.select(*kept, "title", "language", F.coalesce(F.size("links"), F.lit(0)).cast("long").alias("n_outlinks"), made("metadata", "application/warc-fields", "fields").alias("metadata"), made("conversion", "text/plain; charset=utf-8", "text").alias("conversion"))


def archive_lines(derived: DataFrame) -> DataFrame:
    """One row (record: string) per record, as in a WARC 1.1 file but for the last of its line ends."""
    record = derived.select(F.explode(F.array("metadata", "conversion")).alias("r"), F.col("record_id").alias("response")).select("r.*", "response")
    line = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c.cast("string"), F.lit("\r\n"))).otherwise("")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Concurrent-To", F.when(F.col("warc_type") == "metadata", F.col("response"))), line("WARC-Source-Payload-Digest", F.col("payload_digest")),
        line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length")), F.lit("\r\n"),
    )
    return record.select(F.concat(head, F.col("block"), F.lit("\r\n")).alias("record"))


def write_archive(derived: DataFrame, path: str, compression: str = "gzip") -> None:
    """One archive per partition."""
    archive_lines(derived).write.option("lineSep", "\r\n").option("compression", compression).text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records (headers: map with lower-case names, block, whole) of archives whose blocks are UTF-8 text.

    Files are split where a record's first line stands; ``whole`` tells whether the block has the length that
    its header says (it has not if it holds such a line itself).
    """
    raw = spark.read.option("lineSep", "WARC/1.1\r\n").text(path).where("value <> ''")
    at = F.instr("value", "\r\n\r\n")
    raw = raw.select(F.substring("value", F.lit(1), at - 1).alias("head"), F.substring(F.col("value"), at + 4, F.length("value")).alias("rest"))
    pair = lambda h: F.struct(F.lower(F.substring_index(h, ":", 1)).alias("k"), F.trim(F.substring(h, F.instr(h, ":") + 1, F.length(h))).alias("v"))
    headers = F.map_from_entries(F.transform(F.split("head", "\r\n"), pair))
    block = F.expr("substring(rest, 1, length(rest) - 4)")
    out = raw.select(headers.alias("headers"), block.alias("block"))
    return out.select("headers", "block", (F.octet_length("block") == F.col("headers")["content-length"].cast("long")).alias("whole"))


def oracle() -> str:
    """The query in DuckDB's SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    named = "@@"  # stands for the text below, as braces are part of patterns
    for name, character in ENTITIES.items():
        named = f"replace({named}, '&{name};', {quote(character)})"
    code = r"CASE WHEN regexp_matches(m, '^&#[xX]') THEN ('0x' || regexp_extract(m, '([0-9A-Fa-f]+);', 1))::BIGINT ELSE regexp_extract(m, '([0-9]+);', 1)::BIGINT END"
    number = f"""list_transform(regexp_extract_all(@@, '{NUMBER}'), lambda m: CASE WHEN {code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr(({code})::INT) END)"""
    rest = f"string_split_regex(@@, '{NUMBER}')"

    def characters(x: str) -> str:
        n = named.replace("@@", x)
        joined = f"array_to_string(list_transform({rest.replace('@@', n)}, lambda s, i: s || coalesce({number.replace('@@', n)}[i], '')), '')"
        return f"replace({joined}, '&amp;', '&')"

    def tidy(x: str) -> str:
        x = f"regexp_replace({x}, '[ \t\x0b\f\r\u00a0]+', ' ', 'g')"
        x = f"regexp_replace({x}, ' ?\n[\n ]*', chr(10), 'g')"
        return f"regexp_replace({x}, '^[ \n]+|[ \n]+$', '', 'g')"

    uuid = lambda x: f"'<urn:uuid:' || regexp_replace(md5({x}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') || '>'"
    text = f"regexp_replace(regexp_replace(regexp_replace(payload, {quote(HIDDEN)}, '', 'g'), {quote(BREAKS)}, chr(10), 'g'), {quote(TAGS)}, '', 'g')"
    eol = "chr(13) || chr(10)"
    scheme = "[A-Za-z][A-Za-z0-9+.-]*"
    link = f"""CASE WHEN regexp_matches(l, '^{scheme}:') THEN l WHEN starts_with(l, '//') THEN scheme || l WHEN starts_with(l, '/') THEN origin || l
               WHEN starts_with(l, '#') THEN NULL WHEN starts_with(l, '?') THEN regexp_extract(target_uri, '^([^?#]*)', 1) || l ELSE folder || l END"""
    return f"""
        WITH pages_ AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS payload FROM pages),
        response AS (
            SELECT *, 'sha256:' || sha256(payload) AS payload_digest,
                   'HTTP/1.1 200 OK' || {eol} || 'Content-Type: text/html; charset=utf-8' || {eol} || 'Content-Length: ' || strlen(payload) AS http
            FROM pages_
        ), named AS (
            SELECT *, {uuid("concat_ws('|', 'response', coalesce(target_uri, ''), '1970-01-01T00:00:00Z', payload_digest)")} AS response_id,
                   regexp_extract(target_uri, '^({scheme}://[^/?#]*)', 1) AS origin, regexp_extract(target_uri, '^({scheme}:)', 1) AS scheme,
                   regexp_extract(target_uri, '^({scheme}://[^/?#]*(?:/[^?#]*/|/))', 1) AS folder_
            FROM response
        ), placed AS (SELECT *, CASE WHEN folder_ = '' THEN origin || '/' ELSE folder_ END AS folder FROM named),
        read AS (
            SELECT *, {tidy(characters(f"replace(regexp_extract(payload, {quote(TITLE)}, 1), chr(10), ' ')"))} AS title,
                   regexp_extract(payload, {quote(LANGUAGE)}, 1) AS language,
                   list_filter(list_transform(regexp_extract_all(payload, {quote(LINK)}, 1), lambda l: {link}), lambda l: l IS NOT NULL) AS links,
                   {text} AS stripped
            FROM placed
        ), conv AS (SELECT *, {tidy(characters("stripped"))} AS plain FROM read),
        meta AS (
            SELECT *, array_to_string(list_transform(string_split(http, {eol}), lambda h: 'source-header: ' || h || {eol}), '')
                   || CASE WHEN title <> '' THEN 'title: ' || title || {eol} ELSE '' END
                   || CASE WHEN language <> '' THEN 'language: ' || language || {eol} ELSE '' END
                   || coalesce(array_to_string(list_transform(links, lambda x: 'outlink: ' || x || {eol}), ''), '') AS fields
            FROM conv
        )
        SELECT page_id, response_id, payload_digest, {uuid("concat_ws('|', 'metadata', response_id)")} AS metadata_id, {uuid("concat_ws('|', 'conversion', response_id)")} AS conversion_id,
               response_id AS metadata_refers_to, response_id AS conversion_refers_to, target_uri, title, language, len(links)::BIGINT AS n_outlinks,
               'sha256:' || sha256(fields) AS metadata_digest, strlen(fields)::BIGINT AS metadata_length, 'sha256:' || sha256(plain) AS conversion_digest, strlen(plain)::BIGINT AS conversion_length, plain AS text
        FROM meta
    """

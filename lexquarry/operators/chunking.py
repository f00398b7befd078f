"""Chunking: bounded segments of a text with the lines that they come from.

A chunk's end depends on where the one before ended, so a text is folded in one go, in Python; one row is one text,
and nothing is shuffled. What follows (filters, identifiers, statistics) is expressions over arrays again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import markup
from lexquarry.functions.text import let, strip, word_count, year_of

HEADER = re.compile(r"^(={2,6})\s*([^=]+?)\s*\1\s*$")
ENDINGS = (".", "!", "?", '"', "'")
CHUNK = "struct<text:string,chunk_index:int,section:string,line_start:int,line_end:int,word_count:int,estimated_tokens:int>"


@dataclass(frozen=True)
class ChunkConfig:
    """Sizes in tokens; ``target_tokens`` and ``min_tokens`` inform, the others bound."""

    target_tokens: int = 600
    min_tokens: int = 200
    max_tokens: int = 1000
    overlap_tokens: int = 50
    min_words: int = 10
    token_estimation_factor: float = 1.3


TokenCounter = Callable[[str], int]


def quarter(text: str) -> int:
    """A token for every four characters, rounded up: the counter where no vocabulary is at hand."""
    return -(-len(text) // 4)


class VocabularyCounter:
    """Counts tokens with a vocabulary file of ranks, loaded once per worker."""

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern, self.encoding = path, pattern, None

    def __getstate__(self):
        return {"path": self.path, "pattern": self.pattern, "encoding": None}

    def __call__(self, text: str) -> int:
        if self.encoding is None:
            import base64

            import tiktoken

            with open(self.path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.encoding = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return len(self.encoding.encode_ordinary(text)) if text else 0


def estimate(text: str, factor: float) -> int:
    return int(len(text.split()) * factor)


def title_of_header(line: str) -> str | None:
    m = HEADER.match(line)
    return m[2].strip() if m else None


def trimmed(lines: list[str]) -> list[str]:
    """Without blank lines at the end."""
    n = len(lines)
    while n and not lines[n - 1].strip():
        n -= 1
    return lines[:n]


def split_oversized(text: str, limit: int, count: TokenCounter, most: int | None = None) -> list[str]:
    """A long text in segments of about three characters a token, cut after a sentence or else a word.

    Sentence ends are preferred in the order of ``. ! ?``, from the end of the window on; a segment that repeats
    the one before is dropped. ``most`` bounds the number of segments (the rest is lost), None keeps all.
    """
    if len(text) <= limit * 6 and count(text) <= limit:
        return [text]
    window, out, rest = limit * 3, [], text
    while rest.strip() and (most is None or len(out) < most):
        if len(rest) <= window * 1.5:
            out.append(rest.strip())
            break
        ends = (rest.rfind(p, 0, window + 50) for p in (". ", "! ", "? "))
        end = next((e + 2 for e in ends if e > 50), None)
        if end is None:
            blank = rest.rfind(" ", 0, window)
            end = blank + 1 if blank > 50 else window
        segment, rest = rest[:end].rstrip(), rest[end:].lstrip()
        if segment and not (out and out[-1] == segment):
            out.append(segment)
    return out or [text.strip()]


def longest_prefix(text: str, limit: int, count: TokenCounter) -> int:
    """The length of the longest beginning within ``limit`` tokens, at least 1; counts grow with length."""
    lo, hi = 1, max(1, len(text))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if count(text[:mid]) <= limit else (lo, mid - 1)
    return lo


def split_position(text: str, limit: int, count: TokenCounter) -> int:
    """Where to cut a text to stay within the limit: after a sentence, else a clause, else a word."""
    end = longest_prefix(text, limit, count)
    if end >= len(text):
        return len(text)
    for marks in ((". ", "! ", "? "), ("; ", ", ", ": "), (" ",)):
        at = max(text.rfind(m, 0, end) + len(m) if m in text[:end] else 0 for m in marks)
        if at > 1:
            return at
    return end


def lines_of(start: int, end: int, lengths: list[int]) -> tuple[int, int]:
    """The first and last line that the characters from ``start`` to ``end`` (inclusive) touch, a line's end included."""
    first = last = None
    at = 0
    for i, n in enumerate(lengths):
        if at <= end and at + n >= start:
            first, last = (i if first is None else first), i
        at += n + 1
    return (0, max(0, len(lengths) - 1)) if first is None else (first, last)


@dataclass
class _Folder:
    """The chunks of a text so far, and the lines that wait."""

    config: ChunkConfig
    count: TokenCounter
    out: list[tuple] = field(default_factory=list)
    held: list[str] = field(default_factory=list)
    begins: int = 1
    section: str | None = None

    def emit(self, text: str, first: int, last: int) -> None:
        self.out.append((text, len(self.out), self.section, first, last, len(text.split()), self.count(text)))

    def emit_segments(self, lines: list[str], first: int) -> list[str]:
        """Segments of an oversized chunk with the lines of each; returns the last one's lines."""
        whole, lengths, at, last = "\n".join(lines), [len(x) for x in lines], 0, []
        for segment in split_oversized(whole, self.config.max_tokens, self.count):
            if segment.strip():
                found = whole.find(segment, at)
                found = at if found < 0 else found
                a, b = lines_of(found, found + len(segment) - 1, lengths)
                self.emit(segment, first + a, first + b)
                at, last = found + len(segment), segment.split("\n")
        return last

    def flush(self) -> list[str]:
        """What waits becomes a chunk, or several; returns the lines that the next one may repeat."""
        lines = trimmed(self.held)
        if not lines:
            return []
        if self.count("\n".join(lines)) > self.config.max_tokens:
            return self.overlap(self.emit_segments(lines, self.begins))
        self.emit("\n".join(lines), self.begins, self.begins + len(lines) - 1)
        return self.overlap(lines)

    def overlap(self, lines: list[str]) -> list[str]:
        """Whole lines from the end, up to the overlap's size; one at least."""
        if self.config.overlap_tokens <= 0 or not lines:
            return []
        n = total = 0
        for line in reversed(lines):
            total += self.count(line)
            if n and total > self.config.overlap_tokens:
                break
            n += 1
        return lines[len(lines) - n :]

    def split_point(self) -> int:
        """How many of the waiting lines fit: up to the last blank line, else the last end of a sentence, else all before the one that is too much."""
        blank = sentence = chars = 0
        limit = self.config.max_tokens
        for i, line in enumerate(self.held):
            chars += len(line) + 1
            if chars / 4 > limit * 0.8 and self.count("\n".join(self.held[: i + 1])) > limit:
                return blank or sentence or max(1, i)
            if not line.strip():
                blank = i + 1
            elif line.rstrip().endswith(ENDINGS):
                sentence = i + 1
        return len(self.held)

    def header(self, line: str, number: int, carried: list[str]) -> list[str]:
        carried = self.flush() or carried if self.held else carried
        self.section = title_of_header(line)
        self.held = [*carried, line]
        self.begins = number - len(carried)
        return []

    def too_long(self, line: str, number: int) -> None:
        if self.held:
            self.flush()
        for segment in split_oversized(line, self.config.max_tokens, self.count):
            if segment.strip():
                self.emit(segment, number, number)
        self.held, self.begins = [], number + 1

    def add(self, line: str) -> None:
        self.held.append(line)
        limit, text = self.config.max_tokens, "\n".join(self.held)
        size = len(text) / 4
        if (self.count(text) if size >= limit * 0.7 else int(size)) < limit:
            return
        cut = self.split_point()
        head, tail = trimmed(self.held[:cut]), self.held[cut:]
        carried = []
        if head:
            self.emit("\n".join(head), self.begins, self.begins + len(head) - 1)
            carried = self.overlap(head)
        while tail and not tail[0].strip():
            cut, tail = cut + 1, tail[1:]
        self.begins += cut - len(carried)
        self.held = [*carried, *tail]


def chunk_by_tokens(text: str | None, config: ChunkConfig = ChunkConfig(), count: TokenCounter = quarter) -> list[tuple]:
    """A text's chunks: headers always begin one, and the next one repeats some lines of the one before.

    A text without headers is cut as one oversized piece, with the lines of each segment and no section.
    """
    if not text or not text.strip():
        return []
    fold, lines = _Folder(config, count), text.strip().split("\n")
    if not any(HEADER.match(x) for x in lines):
        at, lengths = 0, [len(x) for x in lines]
        for segment in split_oversized(text, config.max_tokens, count):
            segment = segment.strip()
            if segment:
                found = text.find(segment, at)
                found = at if found < 0 else found
                a, b = lines_of(found, found + len(segment) - 1, lengths)
                fold.emit(segment, a + 1, b + 1)
                at = found + len(segment)
        return fold.out
    carried: list[str] = []
    for number, line in enumerate(lines, 1):
        if HEADER.match(line):
            carried = fold.header(line, number, carried)
        elif len(line) > config.max_tokens * 3 and count(line) > config.max_tokens:
            fold.too_long(line, number)
        else:
            fold.add(line)
    fold.flush()
    return fold.out


def chunk_by_words(lines: list[str], config: ChunkConfig = ChunkConfig()) -> list[tuple]:
    """Chunks by the estimate of words times a factor, without overlap."""
    fold = _Folder(config, lambda t: estimate(t, config.token_estimation_factor))
    blank = 0

    def flush(part: list[str]) -> None:
        own = trimmed(part)
        if own:
            fold.emit("\n".join(own), fold.begins, fold.begins + len(own) - 1)

    for number, line in enumerate(lines, 1):
        if HEADER.match(line):
            flush(fold.held)
            fold.section, fold.held, fold.begins, blank = title_of_header(line), [line], number, 0
            continue
        if not line.strip():
            blank = len(fold.held)
            fold.held.append(line)
            continue
        fold.held.append(line)
        if estimate("\n".join(fold.held), config.token_estimation_factor) >= config.max_tokens:
            cut = blank or len(fold.held) - 1
            if cut > 0:
                flush(fold.held[:cut])
                while cut < len(fold.held) and not fold.held[cut].strip():
                    cut += 1
                fold.held, fold.begins, blank = fold.held[cut:], fold.begins + cut, 0
    flush(fold.held)
    return fold.out


def chunks(text: Column, config: ChunkConfig = ChunkConfig(), count: TokenCounter = quarter, by: str = "tokens") -> Column:
    """An array of chunks; ``by`` tokens or words."""
    names = [x.split(":")[0] for x in CHUNK[len("struct<") : -1].split(",")]

    @F.pandas_udf(f"array<{CHUNK}>")
    def folded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            made = (chunk_by_tokens(t, config, count) if by == "tokens" else chunk_by_words((t or "").split("\n") if t else [], config) for t in batch)
            yield pd.Series([[dict(zip(names, c, strict=True)) for c in own] for own in made])

    return folded.asNondeterministic()(text)  # so that the planner never copies it into what reads it


def keep_chunks(found: Column, min_words: int = 10) -> Column:
    """Without micro-chunks and without those equal to the one kept before, numbered anew.

    Equal to the one kept before is equal to the one before: if that is not kept, it equals the kept one itself.
    """
    own = F.filter(found, lambda c: c["word_count"] >= min_words) if min_words > 0 else found
    with_before = lambda own: F.transform(own, lambda c, i: F.struct(c.alias("c"), F.when(i > 0, F.get(own, i - 1)["text"]).alias("before")))
    kept = F.filter(let(own, with_before), lambda x: ~x["c"]["text"].eqNullSafe(x["before"]))
    return F.transform(kept, lambda x, i: x["c"].withField("chunk_index", i))


def filter_stats(found: Column, kept: Column, min_words: int = 10) -> Column:
    micro = F.size(F.filter(found, lambda c: c["word_count"] < min_words)) if min_words > 0 else F.lit(0)
    total, written = F.size(found), F.size(kept)
    return F.struct(total.cast("long").alias("total_chunks"), micro.cast("long").alias("micro_chunks_filtered"), (total - micro - written).cast("long").alias("consecutive_duplicates_removed"), written.cast("long").alias("chunks_written"))


def chunk_id(namespace: Column, title: Column, index: Column) -> Column:
    return F.concat(namespace, F.lit("/"), F.replace(title, F.lit(" "), F.lit("_")), F.lit("#"), index.cast("string"))


def chunk_records(articles: DataFrame, config: ChunkConfig = ChunkConfig(), count: TokenCounter = quarter) -> DataFrame:
    """The fact table: one row per kept chunk of articles (namespace, title, clean_text and what extraction adds)."""
    out = articles.withColumn("_found", chunks(F.col("clean_text"), config, count)).withColumn("_kept", keep_chunks(F.col("_found"), config.min_words))
    out = out.select("*", F.explode("_kept").alias("c"))
    box, work = F.col("infobox"), F.col("library_work")
    orientation = F.try_element_at(F.filter(box["fields"], lambda f: f["name"] == "political_orientation"), F.lit(-1))
    return out.select(
        chunk_id(F.col("namespace"), F.col("title"), F.col("c.chunk_index")).alias("chunk_id"),
        F.col("c.text").alias("text"),
        F.col("title").alias("article_title"),
        "namespace",
        F.col("c.section").alias("section"),
        F.col("c.chunk_index").alias("chunk_index"),
        F.concat_ws("-", F.col("c.line_start").cast("string"), F.col("c.line_end").cast("string")).alias("line_range"),
        F.col("c.word_count").alias("word_count"),
        "categories",
        F.transform("internal_links", lambda x: x["target"]).alias("internal_links"),
        "is_stub",
        "citation_needed_count",
        "has_blockquote",
        work["author"].alias("library_work_author"),
        work["work_type"].alias("library_work_type"),
        year_of(work["published_date"]).alias("library_work_published_year"),
        box["type"].alias("infobox_type"),
        orientation["value"]["values"].alias("political_orientation"),
        F.get("categories", F.lit(0)).alias("primary_category"),
        F.size("categories").alias("category_count"),
    )


def line_begins(text: Column) -> Column:
    """Where each line of a text begins; a running sum, which arrays have only at the cost of their square."""

    @F.pandas_udf("array<int>")
    def begins(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if t is None else [0, *accumulate(len(x) + 1 for x in t.split("\n")[:-1])] for t in batch])

    return begins(text)


def lines_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line_no from 1, line, word_count, begin, end): lines with their places in the text."""
    lines = F.split(F.col(text_col), "\n", -1)
    rows = df.select(F.col(id_col), F.posexplode(F.arrays_zip(lines.alias("line"), line_begins(F.col(text_col)).alias("begin"))).alias("i", "x"))
    return rows.select(id_col, (F.col("i") + 1).alias("line_no"), F.col("x.line").alias("line"), word_count("x.line").alias("word_count"), F.col("x.begin").alias("begin"), (F.col("x.begin") + F.length("x.line")).alias("end"))


def section_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, section_no, level, title, line_start, line_end): sections with their lines, up to the next header of any level."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    numbered = F.transform(lines, lambda x, i: F.struct(x.alias("line"), (i + 1).alias("no")))
    headers = F.filter(numbered, lambda x: x["line"].rlike(markup.HEADER))
    ends = let(F.struct(headers.alias("h"), F.size(lines).alias("n")), lambda s: F.transform(s["h"], lambda x, i: F.struct(x["line"].alias("line"), x["no"].alias("first"), F.coalesce(F.get(s["h"], i + 1)["no"] - 1, s["n"]).alias("last"))))
    rows = df.select(F.col(id_col), F.posexplode(ends).alias("i", "x"))
    return rows.select(
        id_col, (F.col("i") + 1).cast("long").alias("section_no"), F.length(F.regexp_extract("x.line", "^(={2,6})", 1)).cast("long").alias("level"),
        strip(F.regexp_extract("x.line", markup.HEADER, 2)).alias("title"), F.col("x.first").cast("long").alias("line_start"), F.col("x.last").cast("long").alias("line_end"),
    )

"""Secret scans by grammar inference.

Base rules find credentials by their surroundings and shapes. Their findings are the labelled
credentials from which formats are learnt: the values of each kind form a prefix tree with counts,
and states whose outgoing and stopping frequencies agree within Hoeffding's bound are merged
(ALERGIA; Carrasco and Oncina, 1994), which leaves a probabilistic automaton per kind. Ordinary words, numbers and
compounds of these give further automata. All candidates, the base findings' values and whatever base spans leave of runs of ``shortest``
or more characters of credentials, are then scored by the likelihood of their format, length included: the best of the credentials'
automata against the best of the ordinary ones. Candidates over the threshold that no base rule found are added as spans of the kind ``format``.

Automata read classes of characters (a digit, a to f, g to z, the same in upper case, each sign), so that they
learn formats, not values. They are fitted on samples of ``sample`` values a kind, those with the smallest hashes, of ``longest`` characters
at most (longer values are scored like all others). The work is two passes over the texts, one to learn and one to score, neither with a shuffle of texts.

Defined results: a null or empty text has no spans, the digest of the empty string and the span list ''; places are
code points; rows that repeat an id are separate rows; a corpus without labelled credentials gets the base
spans alone; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.llm.common import materialize

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "format")
#: The base rules.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: What must be in a text, in lower case, for the first rule to match.
HINTS = ("passw", "secret", "token", "api")

_RUN = np.zeros(256, bool)
_RUN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True


def long_runs(text: str, least: int) -> list[tuple[int, int]]:
    """Maximal runs of credentials' characters, as code points."""
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) < least:
        return []
    octets = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(octets) + 2, np.int8)
    inside[1:-1] = _RUN[octets]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    if len(starts) and len(raw) != len(text):
        skipped = np.cumsum((octets & 0xC0) == 0x80)
        starts, ends = starts - skipped[starts], ends - np.where(ends > 0, skipped[ends - 1], 0)
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def base_spans(text: str | None, runs: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base rules, sorted. A span is the whole match; an assignment's value its last part."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    # a match of the others lies in a run, and a run starts no match in another
    for a, b in long_runs(text, LEAST["access"]) if runs is None else runs:
        part = text[a:b]
        if "AKIA" in part:
            found += [("access", a + m.start(), a + m.end(), m[0]) for m in ACCESS.finditer(part) if len(m[0]) >= LEAST["access"]]
        if b - a >= LEAST["hex"]:
            found += [("hex", a + m.start(), a + m.end(), m[0]) for m in HEX.finditer(part) if len(m[0]) >= LEAST["hex"]]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: Iterable[tuple]) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def classes(value: str) -> str:
    """A value's characters by class."""
    return value.translate(_CLASSES)


_CLASSES = {ord(c): "0" for c in "0123456789"} | {ord(c): "a" for c in "abcdef"} | {ord(c): "g" for c in "ghijklmnopqrstuvwxyz"}
_CLASSES |= {ord(c): "A" for c in "ABCDEF"} | {ord(c): "G" for c in "GHIJKLMNOPQRSTUVWXYZ"}
SYMBOLS = "0agAG+/_.=-"


class Automaton:
    """A probabilistic automaton inferred from strings of classes."""

    def __init__(self, strings: list[str], alpha: float = 0.05):
        self.count, self.stop, self.next = [0], [0], [{}]
        for s in strings:
            at = 0
            self.count[0] += 1
            for c in s:
                to = self.next[at].get(c)
                if to is None:
                    to = self.next[at][c] = len(self.count)
                    self.count.append(0)
                    self.stop.append(0)
                    self.next.append({})
                at = to
                self.count[at] += 1
            self.stop[at] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self._to_logs()

    def _differ(self, f: int, n: int, g: int, m: int) -> bool:
        return abs(f / n - g / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, x: int, y: int) -> bool:
        """Whether two states agree in stopping and in every symbol, and the states after them too."""
        todo, seen = [(x, y)], set()
        while todo:
            x, y = todo.pop()
            if (x, y) in seen:
                continue
            seen.add((x, y))
            n, m = self.count[x], self.count[y]
            if self._differ(self.stop[x], n, self.stop[y], m):
                return False
            a, b = self.next[x], self.next[y]
            for c in a.keys() | b.keys():
                f, g = self.taken[x].get(c, 0), self.taken[y].get(c, 0)
                if self._differ(f, n, g, m):
                    return False
                if c in a and c in b:
                    todo.append((a[c], b[c]))
        return True

    def _fold(self, x: int, y: int) -> None:
        """Add the tree under y to the automaton at x."""
        todo = [(x, y)]
        while todo:
            x, y = todo.pop()
            self.count[x] += self.count[y]
            self.stop[x] += self.stop[y]
            for c, to in self.next[y].items():
                self.taken[x][c] = self.taken[x].get(c, 0) + self.taken[y][c]
                if c in self.next[x]:
                    todo.append((self.next[x][c], to))
                else:
                    self.next[x][c] = to

    def _merge_states(self) -> None:
        self.taken = [{c: self.count[to] for c, to in own.items()} for own in self.next]
        red = [0]
        while True:
            known = set(red)
            blue = [(-self.count[to], x, c, to) for x in red for c, to in self.next[x].items() if to not in known]
            if not blue:
                break
            _, x, c, to = min(blue)
            for r in red:
                if self._compatible(r, to):
                    self.next[x][c] = r
                    self._fold(r, to)
                    break
            else:
                red.append(to)
        self.states = red

    def _to_logs(self) -> None:
        place = {x: i for i, x in enumerate(self.states)}
        self.logs, self.steps, self.ends = [], [], []
        for x in self.states:
            n = self.count[x] + 0.5 * (len(SYMBOLS) + 1)
            self.logs.append({c: math.log((self.taken[x].get(c, 0) + 0.5) / n) for c in SYMBOLS})
            self.steps.append({c: place[to] for c, to in self.next[x].items()})
            self.ends.append(math.log((self.stop[x] + 0.5) / n))
        self.lost = -math.log(len(SYMBOLS) + 1)
        del self.count, self.stop, self.next, self.taken

    def log_likelihood(self, string: str) -> float:
        at, total = 0, 0.0
        for i, c in enumerate(string):
            total += self.logs[at].get(c, self.lost)
            to = self.steps[at].get(c)
            if to is None:  # no such credential so far: the rest is anything
                return total + self.lost * (len(string) - i)
            at = to
        return total + self.ends[at]


class Formats:
    """Automata of credentials by kind, and of ordinary runs."""

    def __init__(self, credentials: dict[str, list[str]], ordinary: dict[str, list[str]], least: float = 0.5, total: float = 12.0):
        fit = lambda values: Automaton([classes(v) for v in values])
        self.credentials = {k: fit(v) for k, v in credentials.items() if v}
        self.ordinary = {k: fit(v) for k, v in ordinary.items() if v}
        self.least, self.total, self.memo = least, total, {}

    def score(self, value: str) -> float:
        """The log-odds of a credential's format, per character."""
        string = classes(value)
        good = max((a.log_likelihood(string) for a in self.credentials.values()), default=-math.inf)
        plain = max((a.log_likelihood(string) for a in self.ordinary.values()), default=-len(string) * math.log(len(SYMBOLS) + 1))
        return (good - plain) / len(string)

    def is_secret(self, value: str) -> bool:
        known = self.memo.get(value)
        if known is None:
            string = classes(value)
            known = self.memo.get(string)
            if known is None:
                s = self.score(value)
                known = s >= self.least and s * len(value) >= self.total
            if len(self.memo) > 500_000:
                self.memo.clear()
            self.memo[value] = self.memo[string] = known
        return known


_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_JOINED = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[+/_.=-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_.=-]*")


def ordinary_kind(value: str) -> str | None:
    """Which kind of ordinary run a value may stand for, if any: a word, a number, or a compound of these with signs between."""
    return "word" if _WORD.fullmatch(value) else "number" if value.isdigit() else "compound" if _JOINED.fullmatch(value) else None


ORDINARY = ("word", "number", "compound")


def free_parts(text: str, runs: list[tuple[int, int]], base: list[tuple], shortest: int) -> list[tuple[int, str]]:
    """What the base spans leave of runs, where that is ``shortest`` characters or more."""
    if not base:
        return [(a, text[a:b]) for a, b in runs]
    out, spans, i = [], sorted((s, e) for _, s, e, _ in base), 0
    for a, b in runs:
        while i < len(spans) and spans[i][1] <= a:
            i += 1
        at, j = a, i
        while j < len(spans) and spans[j][0] < b:
            if spans[j][0] - at >= shortest:
                out.append((at, text[at : spans[j][0]]))
            at = max(at, spans[j][1])
            j += 1
        if b - at >= shortest:
            out.append((at, text[at:b]))
    return out


def _read(text: str | None, shortest: int) -> tuple[list[tuple], list[tuple[int, str]]]:
    """Base spans and free parts of a text."""
    if not text:
        return [], []
    runs = long_runs(text, min(shortest, LEAST["access"]))
    base = base_spans(text, [x for x in runs if x[1] - x[0] >= LEAST["access"]])
    return base, free_parts(text, [x for x in runs if x[1] - x[0] >= shortest], base, shortest)


def _samples(shortest: int, sample: int, longest: int):
    """Per task: of each kind the ``sample`` different values with the smallest hashes."""

    def samples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from heapq import nsmallest

        import xxhash

        digest = xxhash.xxh64_intdigest
        kinds = ("assign", "access", "hex", *ORDINARY)
        found: dict[str, dict[str, int]] = {k: {} for k in kinds}
        most = dict.fromkeys(kinds, 1 << 64)
        seen: set[str] = set()

        def add(kind: str, value: str, h: int) -> None:
            own = found[kind]
            if h < most[kind]:
                own[value] = h
                if len(own) >= 2 * sample:
                    found[kind] = dict(nsmallest(sample, own.items(), key=lambda x: (x[1], x[0])))
                    most[kind] = max(found[kind].values()) + 1

        for batch in batches:
            for text in batch["text"]:
                base, free = _read(text, shortest)
                for kind, _, _, value in base:
                    if len(value) <= longest:
                        add(kind, value, digest(value.encode()))
                for _, value in free:
                    if value not in seen and len(value) <= longest:
                        h = digest(value.encode())
                        if h < max(most[k] for k in ORDINARY) and (kind := ordinary_kind(value)):
                            add(kind, value, h)
                        if len(seen) >= 500_000:
                            seen.clear()
                        seen.add(value)
        rows = [(k, v) for k in kinds for v, _ in nsmallest(sample, found[k].items(), key=lambda x: (x[1], x[0]))]
        yield pd.DataFrame(rows, columns=["kind", "value"]).astype("object")

    return samples


def learn(texts: DataFrame, shortest: int, sample: int, longest: int) -> Formats:
    """From at most ``sample`` different values a kind, of at most ``longest`` characters."""
    rows = materialize(texts.select("text").mapInPandas(_samples(shortest, sample, longest), "kind string, value string").distinct(), "samples")
    found: dict[str, list[str]] = {}
    for kind in ("assign", "access", "hex", *ORDINARY):  # a kind at a time, each a bounded top list
        found[kind] = [r.value for r in rows.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
    return Formats({k: found[k] for k in ("assign", "access", "hex")}, {k: found[k] for k in ORDINARY})


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 8, sample: int = 2000, longest: int = 256) -> DataFrame:
    """One row per row of ``docs``: id, and the findings (kind, start, end, value, score) as an array of structs; the score is the log-odds of a credential's format, per character."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(learn(texts, shortest, sample, longest))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        formats = shared.value
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base, free = _read(text, shortest)
                found = [(*x, formats.score(x[3])) for x in base]
                if formats.credentials:
                    found += [("format", a, a + len(v), v, formats.score(v)) for a, v in free if formats.is_secret(v)]
                    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
                rows.append([dict(zip(("kind", "start", "end", "value", "score"), x, strict=True)) for x in found])
            yield pd.DataFrame({"id": batch["id"], "findings": rows})

    out = texts.mapInPandas(judge, "id string, findings array<struct<kind:string,start:long,end:long,value:string,score:double>>")
    return out.select(F.col("id").cast(kind).alias(id_col), "findings")


def digest(spans: Iterable[tuple]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()

"""Benchmark decontamination by edit distance.

A document is contaminated by a benchmark item if some part of it is within ``1 - similarity`` edits
per character of the item (both in lower case, white space collapsed). Windows of the items' sizes begin at
every word of a document and, in runs of over ``RUN`` bytes without a blank, at every ``STRIDE`` bytes (a character of most scripts that have no blanks):

* The CGK embedding (Chakraborty, Goldenberg and Koucky, STOC 2016) walks through a window with random
  steps that depend on the character read; strings with few edits between them are read in step again after each, so that the
  embeddings differ in few places. Each of ``tables`` hashes samples ``bits`` places of it; a window and an item that agree in all of the places of some hash are
  a candidate. The places are the same for all items of a class of lengths (a fifth apart), so a window
  is walked through once a class.
* Candidates are verified by the exact edit distance of the item to the best part of the text there
  (bit-parallel, Myers 1999), with no bound on their number.
* Windows that hold fewer than ``share`` of an item's ``GRAM``-grams are not walked through. Up to
  an edit distance of (1 - share) / GRAM (8 %) an item always passes; beyond, as edits leave gaps of GRAM characters somewhere, nearly always.
  Gate and hashes together find 94 % of items with 19 % of their characters edited, and more below (README).
* Items shorter than a gram are found if they occur as they are.

The only data that is broadcast is a block of the benchmark, of ``block_chars`` characters at most (and one
item); a larger benchmark is taken block by block, each against all documents, and written in between. Documents are read once a
block; nothing is shuffled, so a hot source or passage is spread as its rows are.

Defined results: null and empty texts hold nothing; items that are null, or have fewer than ``least_words`` words and fewer than GRAM bytes, are
left out, as they prove nothing; equal items are separate items; rows that repeat an id are separate rows;
extra columns are not read; an empty table on either side gives no matches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.llm.common import discard, materialize

GRAM = 12
RUN, STRIDE = 24, 3
#: Bytes of the strings that candidates are counted by before their edit distance.
SHORT = 3
#: Texts whose windows are walked through together.
TEXTS = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split())


def grams_of(raw: bytes) -> np.ndarray:
    """Hashes of all strings of GRAM bytes (8 to 16), each read as two overlapping numbers of 8 bytes."""
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    return eight[:n] * _ODD ^ eight[GRAM - 8 :] * np.uint64(0xBF58476D1CE4E5B9)


def short_grams(text: np.ndarray) -> np.ndarray:
    """All strings of SHORT bytes as numbers."""
    return text[:-2] << 16 | text[1:-1] << 8 | text[2:]


def window_starts(raw: bytes) -> np.ndarray:
    """Where windows begin: at words, and at a stride within long runs without a blank."""
    words = np.r_[0, np.flatnonzero(np.frombuffer(raw, np.uint8) == 32) + 1]
    ends = np.r_[words[1:] - 1, len(raw)]
    long = np.flatnonzero(ends - words > RUN)
    return np.unique(np.concatenate([words, *(np.arange(words[i], ends[i], STRIDE) for i in long.tolist())])) if len(long) else words


def distance_of_best_part(pattern: bytes, text: bytes, most: int) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to a part of ``text``, and the first place where such a part ends; (most + 1, 0) beyond."""
    n = len(pattern)
    masks = [0] * 256
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best = (most + 1, 0) if n > most else (n, 0)
    for j, c in enumerate(text):
        eq = masks[c]
        x = eq | down
        d = (((eq & up) + up) ^ up) | x
        add, take = down | (~(d | up) & full), up & d
        if add & top:
            score += 1
        elif take & top:
            score -= 1
        add = add << 1 & full  # a part may begin anywhere
        take = take << 1 & full
        up, down = take | (~(d | add) & full), add & d
        if score < best[0]:
            best = (score, j + 1)
    return best


class Benchmark:
    """The items of one block with all that scanning needs; pickled once, set up where it is used."""

    def __init__(self, items: list[tuple], similarity: float, tables: int, bits: int, share: float, seed: int):
        self.items, self.similarity, self.tables, self.bits, self.share, self.seed = items, similarity, tables, bits, share, seed
        self.ready = False

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("items", "similarity", "tables", "bits", "share", "seed")}

    def __setstate__(self, state):
        self.__init__(**state)

    def open(self) -> None:
        if self.ready:
            return
        self.texts = [normal(t) for _, t in self.items]
        rng = np.random.default_rng(self.seed)
        self.longest = max(map(len, self.texts), default=1)
        self.steps = rng.integers(0, 2, (2 * self.longest + 2, 256), dtype=np.uint8).astype(np.int64)
        own = [np.unique(grams_of(t)) for t in self.texts]
        self.short = [np.unique(short_grams(np.frombuffer(t, np.uint8).astype(np.int32)), return_counts=True) for t in self.texts]
        self.tiny = [i for i, t in enumerate(self.texts) if 0 < len(t) < GRAM]
        self.enough = np.array([max(1, int(self.share * len(x))) for x in own])
        # sorted grams, the items that have each, and a table that tells most other grams from them
        every, item = np.concatenate(own), np.repeat(np.arange(len(own)), list(map(len, own)))
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.owners, self.first = item[order], np.r_[first, len(every)]
        self.shift = np.uint64(64 - max(16, int(16 * len(self.grams)).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift)), np.uint8)
        self.table[(self.grams * _ODD) >> self.shift] = 1
        # classes of lengths: the places that the hashes sample, and what the items have there
        self.class_of = [int(np.log(max(len(t), 1)) / np.log(1.2)) for t in self.texts]
        self.places, self.columns, self.item_reads = {}, {}, {}
        for c in sorted(set(self.class_of)):
            items = [i for i, k in enumerate(self.class_of) if k == c]
            reach = 2 * min(len(self.texts[i]) for i in items)
            self.places[c] = np.stack([rng.choice(reach, min(self.bits, reach), replace=False) for _ in range(self.tables)])
            joined = b"".join(map(self.padded, (self.texts[i] for i in items)))
            starts = np.cumsum([0, *(len(self.texts[i]) + 2 * self.longest + 8 for i in items)])[:-1]
            self.columns[c] = np.searchsorted(np.unique(self.places[c]), self.places[c])
            self.item_reads |= dict(zip(items, self.read(np.frombuffer(joined, np.uint8), starts, self.places[c]).T, strict=True))
        self.ready = True

    def padded(self, raw: bytes) -> bytes:
        return raw + bytes(2 * self.longest + 8)

    def read(self, text: np.ndarray, starts: np.ndarray, places: np.ndarray) -> np.ndarray:
        """(place, window): the characters of the embedding at the sampled places, in order, for windows of a text that is padded with zeros."""
        needed = np.unique(places)
        out = np.empty((len(needed), len(starts)), np.uint8)
        at, i = np.asarray(starts, np.int64).copy(), 0
        for j in range(int(needed[-1]) + 1):
            symbol = text[at]
            if j == needed[i]:
                out[i] = symbol
                i += 1
            at += self.steps[j][symbol]
        return out

    def agree(self, item: int, read: np.ndarray) -> np.ndarray:
        """Which windows agree with the item in all places of some hash."""
        same = read == self.item_reads[item][:, None]
        tables = self.columns[self.class_of[item]]
        some = np.zeros(read.shape[1], bool)
        for i in range(0, len(tables), 64):
            own = same[tables[i : i + 64, 0]]
            for k in range(1, tables.shape[1]):
                own &= same[tables[i : i + 64, k]]
            some |= own.any(axis=0)
        return some

    def dense(self, raw: bytes) -> list[tuple[int, np.ndarray]]:
        """(item, starts of the windows of its size that hold enough of its grams)."""
        grams = grams_of(raw)
        maybe = np.flatnonzero(self.table[(grams * _ODD) >> self.shift])
        if not len(maybe) or not len(self.grams):
            return []
        place = np.minimum(np.searchsorted(self.grams, grams[maybe]), len(self.grams) - 1)
        hit = self.grams[place] == grams[maybe]
        place, at = place[hit], maybe[hit]
        n = self.first[place + 1] - self.first[place]
        total = int(n.sum())
        items = self.owners[np.repeat(self.first[place], n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)]
        at = np.repeat(at, n)
        found, words = [], None
        for i in np.flatnonzero(np.bincount(items, minlength=len(self.texts)) >= self.enough).tolist():
            own, size = at[items == i], len(self.texts[i])
            if words is None:
                words = window_starts(raw)
            near = words[np.searchsorted(words, own[0] - size) : np.searchsorted(words, own[-1], "right")]
            inside = np.searchsorted(own, near + size - GRAM + 1) - np.searchsorted(own, near)
            near = near[inside >= self.enough[i]]
            if len(near):
                found.append((i, near))
        return found

    def matches(self, raw: bytes) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) in the normal form of a text, the best part for each item."""
        return self.matches_of([raw])[0]

    def matches_of(self, raws: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """The matches of several texts, whose windows are walked through together."""
        out = [[(i, 0, at, at + len(self.texts[i])) for i in self.tiny if (at := raw.find(self.texts[i])) >= 0] for raw in raws]
        by_class, some = defaultdict(list), {}
        for k, raw in enumerate(raws):
            for item, starts in self.dense(raw):
                some.setdefault(k, None)
                by_class[self.class_of[item]].append((item, k, starts))
        begin = dict(zip(some, np.cumsum([0, *(len(raws[k]) + 2 * self.longest + 8 for k in some)]).tolist(), strict=False))
        text = np.frombuffer(b"".join(self.padded(raws[k]) for k in some), np.uint8)
        for c, found in by_class.items():
            every = np.unique(np.concatenate([starts + begin[k] for _, k, starts in found]))
            near = [[] for _ in found]
            for part in np.array_split(every, -(-len(every) // 4096)):
                read = self.read(text, part, self.places[c])
                for (item, k, starts), own in zip(found, near, strict=True):
                    at = starts + begin[k]
                    at = at[np.searchsorted(at, part[0]) : np.searchsorted(at, part[-1], "right")]
                    if len(at):
                        own.append(at[self.agree(item, read[:, np.searchsorted(part, at)])] - begin[k])
            for (item, k, _), own in zip(found, near, strict=True):
                best = self.verified(item, np.concatenate(own).tolist(), raws[k])
                if best:
                    out[k].append((item, *best))
        return list(map(sorted, out))

    def regions(self, item: int, starts: list[int], raw: bytes, most: int) -> list[tuple[int, int]]:
        """The parts of a text that may hold the item near the starts, in order, those that overlap as one.

        An edit spoils SHORT of the item's strings of SHORT bytes at most, so a part that shares fewer than are left then can't be near enough.
        """
        if not starts:
            return []
        size = len(self.texts[item])
        own, counts = self.short[item]
        least = size - SHORT + 1 - SHORT * most
        first, last = max(0, starts[0] - most), min(len(raw), starts[-1] + size + most)
        text = np.frombuffer(raw, np.uint8, last - first, first).astype(np.int32)
        codes = short_grams(text)
        place = np.minimum(np.searchsorted(own, codes), len(own) - 1) if least > 0 else None
        if place is not None:
            place[own[place] != codes] = len(own)
        out: list[tuple[int, int]] = []
        for start in starts:
            lo, hi = max(0, start - most), min(len(raw), start + size + most)
            if place is not None:
                shared = np.bincount(place[lo - first : max(lo, hi - SHORT + 1) - first], minlength=len(own) + 1)[: len(own)]
                if np.minimum(shared, counts).sum() < least:
                    continue
            if out and lo <= out[-1][1]:
                out[-1] = out[-1][0], hi
            else:
                out.append((lo, hi))
        return out

    def verified(self, item: int, starts: list[int], raw: bytes) -> tuple[int, int, int] | None:
        """The best part of a text, of those at the starts given, if it is near enough."""
        pattern = self.texts[item]
        at = raw.find(pattern)
        if at >= 0:
            return 0, at, at + len(pattern)
        most = int((1 - self.similarity) * len(pattern) + 1e-9)
        best, end = most + 1, 0
        for lo, hi in self.regions(item, starts, raw, most):
            distance, at = distance_of_best_part(pattern, raw[lo:hi], best - 1)
            if distance < best:
                best, end = distance, lo + at
        if best > most:
            return None
        back = raw[max(0, end - len(pattern) - best) : end][::-1]
        _, length = distance_of_best_start(pattern[::-1], back)
        return best, end - length, end


def distance_of_best_start(pattern: bytes, text: bytes) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to a beginning of ``text``, and that beginning's length."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for j, c in enumerate(text, 1):
        before, row[0] = row[0], j
        for i, p in enumerate(pattern, 1):
            before, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, before + (p != c))
        if row[-1] < best[0]:
            best = (row[-1], j)
    return best


def _scanner(shared):
    """A function of texts that finds a broadcast block's items."""

    @F.pandas_udf(MATCHES)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        own.open()
        for batch in texts:
            rows = []
            raws, matches = list(map(normal, batch)), []
            for i in range(0, len(raws), TEXTS):
                matches += own.matches_of(raws[i : i + TEXTS])
            for raw, parts in zip(raws, matches, strict=True):
                found = []
                for i, distance, start, end in parts:
                    words = raw.count(b" ", 0, start), raw.count(b" ", 0, end) + 1
                    found.append({"item": own.items[i][0], "distance": distance, "similarity": 1 - distance / len(own.texts[i]), "start_word": words[0], "end_word": words[1]})
                rows.append(found)
            yield pd.Series(rows)

    return scan


MATCHES = "array<struct<item:long,distance:long,similarity:double,start_word:long,end_word:long>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", similarity: float = 0.8, tables: int = 400, bits: int = 4, share: float = 0.02, least_words: int = 5, block_chars: int = 1 << 24, seed: int = 7) -> DataFrame:
    """``docs`` with the column ``matches`` (in place of one of that name): item, distance, similarity, and the words from which to which the best part goes."""
    spark = docs.sparkSession
    # the benchmark in blocks: an item goes to the block in which its first character would fall
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("t")).where("t is not null")
    items = items.where((F.size(F.split(F.trim(F.regexp_replace("t", r"[\x20\x09-\x0D]+", " ")), " ")) >= least_words) | (F.octet_length(F.trim(F.regexp_replace("t", r"[\x20\x09-\x0D]+", " "))) >= GRAM))
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(blocks)))
    if blocks > 1:
        items = materialize(items, "benchmark")
    name = "matches"
    out, before = docs.withColumn(name, F.array().cast(MATCHES)), None
    for b in range(blocks):
        block = Benchmark([(r.item, r.t) for r in items.where(F.col("block") == b).orderBy("item", "t").collect()], similarity, tables, bits, share, seed)
        if block.items:
            shared = spark.sparkContext.broadcast(block)
            out = out.withColumn(name, F.concat(name, _scanner(shared)(F.col(f"`{text_col}`").cast("string"))))
            if blocks > 1:  # one block's broadcast at a time
                out = materialize(out, "contamination")
                shared.destroy()
                if before is not None:
                    discard(before)
                before = out
    return out

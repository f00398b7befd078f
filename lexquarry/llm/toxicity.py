"""Toxicity from a weighted lexicon that is learnt from labelled documents.

A text is folded (lower case, homoglyphs of other scripts, digits and signs that stand for
letters) and its words are joined by blanks; an Aho-Corasick automaton then finds all entries of the lexicon in one pass. An entry is a word or the beginning of words and matches at the
start of a word only; a word also ends where the text's word ends. Of the entries that match at one
place the heaviest counts. An exception phrase that covers a match takes its weight away. The sum of the weights and
the number of matches, each also by the text's length, are the inputs of a small logistic regression.

Learning: a bounded sample of labelled rows (``most_toxic`` and ``most_clean`` rows, those with the
smallest hashes of their ids) gives the lexicon: the words and beginnings whose documents are toxic
far more often than not. Exception phrases are two-word phrases around an entry that only clean documents have.
The regression is fitted to the same sample's features with the two classes weighed as in all training rows. The model is
bounded by ``entries``, whatever the size of the corpus; it is broadcast.

Defined results: a null text is an empty one, and an empty text gets the score of no match; a null
id is the text '' for the hash and has no label; rows that repeat an id are scored each, a label that
repeats counts as its largest value; labels other than 0 and 1 and null labels are left out; without
both classes among the training rows all scores are 0; extra columns are not read; an empty table gives
an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm.common import materialize

#: Letters of other scripts, digits and signs that look like a Latin letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ѡ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ſ": "s",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e",
}
#: Lengths of the beginnings of words that may become entries.
BEGINNINGS = range(4, 9)
#: Characters of a word that can become an entry; longer words are known by their beginnings.
LONGEST = 24

_FOLD = {ord(a): b for a, b in HOMOGLYPHS.items()}
_FOLD |= {ord(a.upper()): b for a, b in HOMOGLYPHS.items() if len(a.upper()) == 1 and a.upper() != a}
_FOLD |= {c: chr(c + 32) for c in range(65, 91)}
_FOLD |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_FOLD |= {c: chr(c).lower() for c in range(0xC0, 0x250) if len(chr(c).lower()) == 1 and c not in _FOLD}
#: Every other character that is no letter becomes a gap.
_GAPS = {c: " " for r in (range(0x300), range(0x2000, 0x2070), range(0x3000, 0x3040)) for c in r if not chr(c).isalpha() and c not in _FOLD}
_ALL = _FOLD | _GAPS
#: Signs that stand for letters do so only before other characters of a word; at its end they are punctuation.
_SIGNS_AT_END = re.compile(r"[@$!|€]+(?!\w)")


def words_of(text: str | None) -> list[str]:
    """The folded words of a text."""
    return _SIGNS_AT_END.sub(" ", text).translate(_ALL).split() if text else []


def features_of(word: str) -> list[str]:
    """What a word offers as entries: itself (with a mark of its end), and its beginnings."""
    own = [word[:n] for n in BEGINNINGS if n < len(word)]
    if 2 < len(word) <= LONGEST:
        own.append(word + " ")
    return own


class Lexicon:
    """Entries with weights, exceptions, and the regression's coefficients; picklable."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], coefficients: list[float] | None = None):
        self.weights, self.exceptions, self.coefficients = weights, exceptions, coefficients
        self.machine = None

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "coefficients": self.coefficients}

    def __setstate__(self, state):
        self.__init__(**state)

    def automaton(self):
        """Entries and exceptions behind a blank, which stands before every word of the joined text."""
        import ahocorasick

        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self.machine.add_word(" " + entry, (len(entry) + 1, weight))
            for phrase in self.exceptions:
                self.machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
            self.machine.make_automaton()
        return self.machine

    def matches(self, text: str | None) -> tuple[list[tuple[int, float]], int]:
        """(place in the joined folded words, weight), heaviest entry per place, exceptions applied; and the number of words."""
        words = words_of(text)
        if not words or not (self.weights or self.exceptions):
            return [], len(words)
        joined = " " + " ".join(words) + " "
        best: dict[int, float] = {}
        spared = []
        for end, (length, weight) in self.automaton().iter(joined):
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0):
                best[start] = weight
        if spared:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in spared)}
        return sorted(best.items()), len(words)

    def inputs(self, text: str | None) -> list[float]:
        """Of the regression: 1, the weights' sum, the matches, and both by the text's length."""
        found, n = self.matches(text)
        total = sum(w for _, w in found)
        strong = sum(sorted((w for _, w in found), reverse=True)[:3])
        scale = math.sqrt(1 + n / 100)
        return [1.0, math.log1p(total), strong / 10, math.log1p(total / scale), math.log1p(len(found) / scale)]

    def score(self, text: str | None) -> float:
        if self.coefficients is None:
            return 0.0
        z = sum(c * x for c, x in zip(self.coefficients, self.inputs(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Labelled texts -> entry, number of toxic and of clean documents that have it."""
    toxic, clean = Counter(), Counter()

    def flush() -> pd.DataFrame:
        keys = list(toxic.keys() | clean.keys())
        out = pd.DataFrame({"entry": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]})
        toxic.clear()
        clean.clear()
        return out.astype({"entry": "object", "toxic": "int64", "clean": "int64"})

    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            own = {f for w in set(words_of(text)) for f in features_of(w)}
            (toxic if label else clean).update(own)
            if len(toxic) + len(clean) > 1_000_000:
                yield flush()
    yield flush()


def _phrases(lexicon: Lexicon):
    """Labelled texts -> two-word phrases around a match, with the numbers of documents."""

    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = words_of(text)
                starts = {}
                at = 0
                for i, w in enumerate(words):
                    starts[at] = i
                    at += len(w) + 1
                own = set()
                for place, _ in lexicon.matches(text)[0]:
                    i = starts[place]
                    own |= {" ".join(words[a:b]) for a, b in ((i - 1, i + 1), (i, i + 2)) if a >= 0 and b <= len(words)}
                rows += [(p, int(label), 1 - int(label)) for p in own]
        yield pd.DataFrame(rows, columns=["phrase", "toxic", "clean"]).astype({"phrase": "object", "toxic": "int64", "clean": "int64"})

    return phrases


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * len(y) * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def held_out_column(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_toxic: int = 3000, most_clean: int = 6000, entries: int = 2000) -> Lexicon:
    spark = docs.sparkSession
    own = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("id is not null and label in (0, 1)")
    own = own.where(~held_out_column(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    rates = {r.label: r["count"] for r in own.groupBy("label").count().collect()}
    if not rates.get(0) or not rates.get(1):
        return Lexicon({}, [])
    order = [F.xxhash64("id"), "id"]
    sample = own.where("label = 1").orderBy(*order).limit(most_toxic).unionByName(own.where("label = 0").orderBy(*order).limit(most_clean))
    sample = materialize(sample, "label-sample")  # bounded by the two parameters
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).join(F.broadcast(sample), "id").select("text", "label")
    texts = materialize(texts.repartition(max(8, spark.sparkContext.defaultParallelism)), "labelled-texts")

    n_toxic, n_clean = (texts.where(f"label = {y}").count() for y in (1, 0))
    if not n_toxic or not n_clean:
        return Lexicon({}, [])
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic - F.col("toxic") + 0.5)) - F.log((F.col("clean") + 0.5) / (n_clean - F.col("clean") + 0.5))
    found = texts.mapInPandas(_features, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    least = max(3, n_toxic // 1000)
    # a share of toxic documents that is 20 times that of clean ones at least, and not by chance
    found = found.where(F.col("toxic") >= least).withColumn("weight", weight).where("weight >= 3")
    found = found.orderBy(F.desc(F.col("toxic") * F.col("weight")), "entry").limit(entries).collect()
    lexicon = Lexicon({r.entry: float(r.weight) for r in found}, [])

    phrases = texts.mapInPandas(_phrases(lexicon), "phrase string, toxic long, clean long").groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    spared = phrases.where("clean >= 3 and toxic = 0").orderBy(F.desc("clean"), "phrase").limit(entries).collect()
    lexicon = Lexicon(lexicon.weights, [r.phrase for r in spared])

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [lexicon.inputs(t) for t in batch["text"]], "label": batch["label"]})

    rows = texts.mapInPandas(measured, "x array<double>, label int").collect()  # five numbers a row of the sample
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows], float)
    by_class = np.where(y == 1, rates[1] / n_toxic, rates[0] / n_clean)
    lexicon.coefficients = _fit(x, y, by_class * len(y) / by_class.sum()).tolist()
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score as a further column."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(t) for t in batch], dtype="float64")

    return docs.withColumn(out_col, score(F.col(f"`{text_col}`").cast("string")))

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexquarry.llm import simhash
from lexquarry.llm.components import connected_components


def brute_print(text, n=4):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "a", "A b c", "a b c d", "The THE the the the é É x\x0by z", "w " * 900])
def test_fingerprint_is_the_contract(text):
    assert simhash.majority(simhash.shingle_digests(text, 4)) == brute_print(text)


def test_fingerprint_agrees_with_spark_hash(spark):
    text = "one single shingle"
    got = spark.createDataFrame([(text,)], "text string").select(F.xxhash64("text").alias("h"), simhash.fingerprint("text").alias("fp")).first()
    assert got.h == got.fp


@pytest.mark.parametrize("large", [64, 2])
def test_links_against_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = np.random.default_rng(5)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 150, dtype=np.uint64)]
    for i in range(450):  # chains and clusters of prints that differ in 1 to 6 bits
        x = prints[int(rng.integers(0, len(prints)))]
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            x ^= 1 << int(b)
        prints.append(x)
    prints = sorted(set(prints))
    signed = [simhash._signed(x) for x in prints]
    df = spark.createDataFrame(list(zip(signed, range(len(prints)), strict=True)), "fp long, node long")
    for distance in (4, 2):
        want = brute_components(prints, distance)
        got = dict(map(tuple, simhash.linked_prints(df, distance).collect()))
        assert [got[i] for i in range(len(prints))] == want


def test_exact_pass_alone_finds_all(spark, monkeypatch):
    """Without the first pass the pigeonring join has to find every link."""
    rng = np.random.default_rng(6)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40, dtype=np.uint64)]
    prints = set(base)
    for x in base:
        for _ in range(4):
            y = x
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                y ^= 1 << int(b)
            prints.add(y)
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "LARGE", 2)
    monkeypatch.setattr(simhash, "_close_neighbours", lambda distance: lambda batches: (b[["fp", "node"]].set_axis(["a", "b"], axis=1).iloc[:0] for b in batches))
    df = spark.createDataFrame([(simhash._signed(x), i) for i, x in enumerate(prints)], "fp long, node long")
    got = dict(map(tuple, simhash.linked_prints(df, 4).collect()))
    assert [got[i] for i in range(len(prints))] == brute_components(prints, 4)


def test_groups_of_odd_rows(spark):
    rows = [(3, None, "x"), (2, "", "x"), (9, "a b c d e f g h", "y"), (9, "a b c d e f g h", "y"), (None, "A B c d e f g h", None), (5, "q " * 30_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.simhash_groups(df).collect())
    assert got == [(0, 9), (2, 2), (3, 2), (5, 5), (9, 9), (9, 9)]
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 90), (95, 100), (200, 200)] + [(1000, i) for i in range(300, 400)]
    df = spark.createDataFrame(chain + chain[:5] + [(None, 3)], "a long, b long")
    got = dict(map(tuple, connected_components(df).collect()))
    assert got == {i: 0 for i in range(61)} | {90: 90, 95: 90, 100: 90} | {i: 300 for i in [*range(300, 400), 1000]}

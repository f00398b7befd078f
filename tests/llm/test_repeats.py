import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lexquarry.llm import repeats


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                covered[1 + i : 1 + i + length] = True
        runs = int((covered[1:] & ~covered[:-1]).sum())
        kept = bytes(b for b, c in zip(r, covered[1:], strict=False) if not c)
        out.append((len(r), len(r) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts_of(seed, n=60, letters="abcdefgh é"):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [word(rng.randint(20, 120)) for _ in range(6)]
    out = []
    for _ in range(n):
        t = "".join(rng.choice([word(rng.randint(1, 60)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 20) :]]) for _ in range(rng.randint(1, 6)))
        if out and rng.random() < 0.3:  # a near copy
            t = list(rng.choice(out))
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = "#"
            t = "".join(t)
        out.append(t or "x")
    return [*out, None, "", "a" * 300, "ab" * 100, out[0], out[0], "xyz" * 50 + out[1]]


def run(spark, texts, **more):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, k long")
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in repeats.remove_repeats(df, **more).collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    texts = texts_of(seed)
    assert run(spark, texts, length=40, gram=16) == brute(texts, 40)
    assert run(spark, texts, length=33, gram=8) == brute(texts, 33)


def test_large_buckets_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "TOGETHER", 1)
    texts = texts_of(3, n=90)
    assert run(spark, texts, length=40, gram=16) == brute(texts, 40)


def test_400_bytes(spark):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    p, q = word(399), word(400)
    texts = [word(700) + p + word(50), p + word(300), word(30) + q + word(5), word(900) + q, "é" * 250, "é" * 200, "é" * 199, word(3000) + q[:200] + "é" + q[200:], "z" * 401, "z" * 100_000 + "y"]
    assert run(spark, texts) == brute(texts, 400)


def test_equal_rows_are_documents(spark):
    df = spark.createDataFrame([(1, "q" * 50 + "r" * 500)] * 2 + [(None, "s" * 10)], "doc_id long, text string")
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(df).collect()]
    assert sorted(got, key=repr) == sorted([(1, 550, 550), (1, 550, 550), (None, 10, 0)], key=repr)
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_windows():
    rng = np.random.default_rng(1)
    for n, w in ((5, 5), (17, 4), (100, 7), (64, 8)):
        x = rng.integers(0, 50, n).astype(np.uint64)
        assert repeats.least_in_windows(x, w).tolist() == [x[i : i + w].min() for i in range(n - w + 1)]

import random

import pytest
from pyspark.sql import functions as F

from lexquarry.llm import simhash

pipeline = pytest.importorskip("corpus_pipeline")


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near_copies(seed=2, n=120, copies=4):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("a", "en", "ion", "ou", "ers", "ing")]
    rows = []
    for base in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(60, 400))]
        rows.append((len(rows), base, " ".join(words)))
        for _ in range(rng.randint(0, copies)):
            own = list(words)
            for _ in range(rng.randint(1, max(1, len(own) // 60))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), base, " ".join(own)))
    return rows


def test_near_copies_go(spark):
    rows = near_copies()
    base_of = {i: b for i, b, _ in rows}
    odd = [(9000, "", "x"), (9001, None, "x"), (9002, "lone word", None), (None, rows[0][2], "x"), (9003, "z " * 30_000, "y"), (9003, "z " * 30_000, "y")]
    df = spark.createDataFrame([(i, t, f"s{b}") for i, b, t in rows] + odd, "doc_id long, text string, node string")
    got = simhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    kept = [r.doc_id for r in got.collect()]
    bases = [base_of[i] for i in kept if i in base_of]
    assert set(bases) == set(base_of.values())  # none is lost
    texts = {i: shingles(t) for i, _, t in rows}
    # whatever stays has no near copy left
    left = [(i, j) for i in kept for j in kept if i in texts and j in texts and i < j and base_of[i] == base_of[j] and len(texts[i] & texts[j]) / len(texts[i] | texts[j]) >= 0.8]
    assert not left
    assert 9000 in kept and 9001 not in kept and 9002 in kept and None not in kept and kept.count(9003) == 2
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_stages_on_the_small_tables(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("text", F.when(F.col("doc_id") == 3, None).otherwise(F.col("text")))
    for i, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / str(i)))
        back = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert sorted(back.dtypes) == sorted(docs.dtypes), name
            assert back.subtract(docs).count() == 0 and 0 < back.count() <= docs.count(), name
        docs = back
    rows = docs.collect()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]


def test_stages_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0


def test_stages_with_clashing_columns_and_nulls(spark):
    names = ["gone", "score", "matches", "row", "key", "salt", "hash", "label", "node", "component", "id", "size", "target", "rest", "sha", "lead"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_000, None, "en", None, 0), (900_001, "", None, "src0", 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3)], docs.schema)
    docs = docs.unionByName(odd).withColumns({n: F.lit(n) for n in names})
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert 0 < len(rows) <= docs.count() and all(r[n] == n for r in rows for n in names), name
    assert pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def jaccard(x, y):
    x, y = shingles(x), shingles(y)
    return len(x & y) / len(x | y) if x | y else 1.0


def kept_by_brute_force(rows):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(rows[i][1], rows[j][1]) >= 0.8 - 1e-9:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [rows[i][0] for i in range(len(rows)) if find(i) == i]


def changed(words, rng, n):
    own = list(words)
    for at in rng.sample(range(len(own)), n):
        own[at] = f"n{rng.random()}"
    return " ".join(own)


def test_large_groups_go_whole(spark):
    """Variants that are near copies of the base but not of one another."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(0, " ".join(base))] + [(i, changed(base, rng, 6)) for i in range(1, 301)]
    rng.shuffle(rows)
    copies = {i for i, t in rows if jaccard(t, " ".join(base)) >= 0.8}
    got = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(copies) > 200 and got & copies == {0} and got == set(kept_by_brute_force(sorted(rows)))


def test_added_and_cut_blocks_are_found(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(50, 600))]
        cut = int(len(words) * rng.uniform(0.82, 0.97))
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:cut])), (len(rows) + 2, " ".join(words + [f"x{rng.random()}" for _ in range(len(words) - cut)]))]
    got = sorted(r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == kept_by_brute_force(rows)


def test_near_copies_are_decided_exactly(spark):
    """Pairs on both sides of 0.8: none over it stays, none under it goes."""
    rng = random.Random(10)
    rows = []
    for _ in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        cut = 320 + rng.choice([-6, -3, -1, 0, 1, 3, 6])
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:cut]))]
    got = sorted(r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == kept_by_brute_force(rows) and 60 < len(got) < 120


def test_frequent_shingles_are_counted_over_all_texts(spark, monkeypatch):
    """Shingles by the number of texts that have them, from every text, however many there are; few are told, down to one count."""
    rng = random.Random(11)
    common = [f"c{i} " * 3 for i in range(30)]
    rows = [(i, f"u{i} x{i} " + "".join(common[j] for j in range(30) if rng.random() < 1 / (j + 1)) if i % 50 else None) for i in range(21_000)]
    texts = spark.createDataFrame(rows, "node long, text string").repartition(5)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 10_000)
    want = {}
    for _, t in rows:
        for h in simhash.shingle_set(t, 5).tolist():
            want[h] = want.get(h, 0) + 1
    for most in (1_000_000, 100):
        monkeypatch.setattr(simhash, "FREQUENT", most)
        keys, counts, shift = simhash._frequent(texts, 5)
        told = sorted((c for c in want.values() if c >= 2), reverse=True)
        if len(told) > most:
            told = [c for c in told if c > told[most]]
        least = min(told)
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == {h % (1 << 64) >> shift: c for h, c in want.items() if c >= least}
    empty = simhash._frequent(texts.limit(0), 5)
    assert len(empty[0]) == len(empty[1]) == 0


def test_stages_give_back_the_drivers_memory(spark):
    """Each stage has the driver's JVM collected in full before its result is computed, the near-duplicate stage after each of its steps too."""
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in pipeline.STAGES:
        before = full()
        stage(spark, docs, "/root/testdata/sf0.001")
        assert full() - before >= (5 if stage is pipeline.near else 1), name

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lexquarry.llm.exact_dedup import exact_dedup, exact_groups
from lexquarry.llm.mixing import mix_sources

ROWS = [(1, "a", "x"), (2, None, "x"), (3, "", None), (4, "a", "y"), (5, "é" * 70_000, "y"), (6, "é" * 70_000, "y"), (7, "A", "y"), (7, "A", "y"), (None, "a", "z"), (None, "lone", "z")]
SCHEMA = "doc_id long, text string, hash string"


def test_exact_groups(spark):
    df = spark.createDataFrame(ROWS + [(100 + i, "hot", "h") for i in range(50)], SCHEMA)
    for hot in (1000, 5, 2):
        for largest in (True, False):
            got = [tuple(r) for r in exact_groups(df, largest=largest, hot_rows=hot).collect()]
            groups = defaultdict(list)
            for i, t, _ in df.collect():
                groups[t or ""].append(i)
            sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
            pick = max if largest else min
            seen = Counter()
            for i, keep, n, kept, digest in got:
                ids = groups[sha[digest]]
                known = [x for x in ids if x is not None]
                assert (keep, n) == (pick(known) if known else None, len(ids))
                assert not kept or i == keep
                seen[digest] += kept
            assert len(got) == df.count() and set(seen.values()) == {1}


def test_exact_groups_normalised(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.doc_id, r.keep_id) for r in exact_groups(df, normalise=F.lower).collect()}
    assert {(1, 1), (4, 1), (7, 1), (2, 2), (3, 2)} <= got


def test_exact_dedup_keeps_rows_as_they_are(spark):
    df = spark.createDataFrame(ROWS + [(100 + i, "hot", "h") for i in range(50)], SCHEMA)
    for hot in (1000, 5):
        got = exact_dedup(df, largest=True, hot_rows=hot)
        assert got.columns == df.columns
        assert sorted(((r.doc_id or 0), r.text) for r in got.collect()) == sorted([(4, "a"), (3, ""), (6, "é" * 70_000), (7, "A"), (0, "lone"), (149, "hot")])
    kept = exact_dedup(spark.createDataFrame([(2, None, "x")], SCHEMA)).first()
    assert kept.text is None
    assert exact_dedup(df.limit(0)).count() == 0


def mixed(spark, rows, **more):
    pieces, docs = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string, size string"), **more)
    return [r.asDict() for r in pieces.collect()], [r.asDict() for r in docs.collect()]


def test_mixing(spark):
    rows = [(i, "w " * (i % 37), f"s{i % 4}", "x") for i in range(400)] + [(1000, "w\tw " * 9000, "s1", "x"), (1001, None, None, "x"), (1002, "a b", None, "x"), (1002, "a b", None, "x"), (None, "é\xa0é x", "s0", "x")]
    pieces, docs = mixed(spark, rows, block_words=16)
    words = {(r[0], r[2]): len((r[1] or "").encode().split()) for r in rows}
    assert all(d["size"] == words[d["doc_id"], d["source"]] for d in docs) and len(docs) == len(rows)
    assert all(0 <= d["taken"] <= 2 * d["size"] for d in docs)
    per = defaultdict(int)
    for d in docs:
        per[d["source"]] += d["taken"]
    target = {d["source"]: d["target"] for d in docs}
    size = {d["source"]: d["source_size"] for d in docs}
    assert all(per[s] == int(target[s]) for s in target)
    # targets by the iteration that the contract describes
    order = sorted([s for s in size if s is not None]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, fixed = {}, {}
    while True:
        left = 1.5 * sum(size.values()) - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        want = fixed | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if want[s] > 2 * size[s]]
        if not over:
            break
        fixed |= {s: 2 * size[s] for s in over}
    assert all(abs(want[s] - target[s]) < 1e-6 for s in want)
    # a document's pieces are its part of the mix
    listed = defaultdict(list)
    for p in pieces:
        listed[p["id"], p["source"], p["size"]].append((p["slot"], p["from_word"], p["n_words"]))
    for d in docs:
        own = sorted(listed[d["doc_id"], d["source"], d["size"]])
        assert [tuple(x) for x in d["pieces"]] == own and d["first_slot"] == (own[0][0] if own else None)
        if d["doc_id"] not in (1002,):
            assert d["taken"] == sum(x[2] for x in own)
    # any stretch of the schedule holds every source close to its weight
    blocks = {}
    for p in pieces:
        blocks.setdefault(p["slot"], [p["source"], 0])[1] += p["n_words"]
    assert all(n <= 16 for _, n in blocks.values())
    n, share = Counter(), {s: target[s] / sum(target.values()) for s in target}
    for i, slot in enumerate(sorted(blocks), 1):
        n[blocks[slot][0]] += 1
        assert all(abs(n[s] - i * share[s]) < 8 for s in share)
    again = mixed(spark, rows[::-1], block_words=16)[1]
    assert sorted(map(str, again)) == sorted(map(str, docs))


def test_mixing_of_nothing(spark):
    assert mixed(spark, [(1, None, "a", "x"), (2, " ", None, "x")])[1] == [
        {"doc_id": 1, "source": "a", "size": 0, "source_size": 0, "target": 0.0, "taken": 0, "first_slot": None, "pieces": []},
        {"doc_id": 2, "source": None, "size": 0, "source_size": 0, "target": 0.0, "taken": 0, "first_slot": None, "pieces": []},
    ]
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(df)[1].count() == 0

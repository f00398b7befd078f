import json

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import curation as q
from lexquarry.operators import entities as en
from lexquarry.operators import health as h


@pytest.fixture(scope="module")
def stages(spark):
    make = lambda rows: spark.createDataFrame(rows, "key string, namespace string, size long")
    return {
        "extracted": make([("Main/a", "Main", 5), ("Main/b", "Main", 0), ("Library/c", "Library", 3), ("Library/d", "Library", 0), ("Main/e", "Main", 0)]),
        "chunks": make([("Main/a", "Main", 2), ("Main/b", "Main", 0), ("Main/x", "Main", 1)]),
        "embeddings": make([("Main/a", "Main", 2), ("Main/y", "Main", 1)]),
    }


def test_counts_and_gaps(stages):
    assert {r.stage: tuple(r)[1:] for r in h.stage_counts(stages).collect()} == {"extracted": (5, 2, 3), "chunks": (3, 2, 1), "embeddings": (2, 2, 0)}
    got = {}
    for r in h.gaps(stages).collect():
        got.setdefault(r.kind, set()).add(r.key)
    assert got == {"missing_chunks": {"Library/c", "Library/d", "Main/e"}, "missing_embeddings": {"Main/x"}, "orphan_chunks": {"Main/x"}, "orphan_embeddings": {"Main/y"}}
    assert [tuple(r) for r in h.empty_by_namespace(stages["extracted"]).collect()] == [("Main", 2), ("Library", 1)]


def test_verdict_report_and_repairs(spark, stages):
    rows = spark.createDataFrame([("a", "x")] * 3 + [("b", "x"), ("b", "y"), ("c", None)], "key string, line string")
    dup = h.duplication(rows, "key", "line")
    assert {r.key: (r.total, r.distinct_values, r.duplicates, r.corrupt) for r in dup.collect()} == {"a": (3, 1, 2, True), "b": (2, 2, 0, False)}
    v = h.verdict(stages, dup).first()
    assert (v.missing_chunks, v.orphan_chunks, v.empty_extracted, v.corrupt, v.healthy) == (3, 1, 3, 1, False)
    clean = {s: df.where("key = 'Main/a'") for s, df in stages.items()}
    assert h.verdict(clean).first().healthy
    report = json.loads(h.report(stages, dup).first().report)
    assert report["summary"]["corrupt"] == 1 and len(report["gaps"]) == 4 and report["corrupt"][0]["key"] == "a"
    sources = spark.createDataFrame([("Main/b",)], "key string")
    got = {(r.stage, r.key, r.action) for r in h.repairs(stages, dup, sources).collect()}
    assert {("extracted", "Main/b", "reprocess_empty"), ("extracted", "Main/e", "source_missing"), ("chunks", "Main/x", "delete_orphan"), ("chunks", "a", "delete_corrupt"), ("chunks", "Main/b", "delete_empty")} <= got
    assert {r.stage for r in h.repairs(stages, dup, sources, stage="chunks").collect()} == {"chunks"}


def test_deletions_stay_in_their_folder(spark, tmp_path):
    (tmp_path / "Main").mkdir()
    f = tmp_path / "Main" / "a.json"
    f.write_text("x")
    actions = spark.createDataFrame([("chunks", "Main/a", "delete_empty")], "stage string, key string, action string")
    roots, suffixes = {"chunks": str(tmp_path)}, {"chunks": ".json"}
    assert len(h.apply_deletions(actions, roots, suffixes)) == 1 and f.exists()
    h.apply_deletions(actions, roots, suffixes, dry_run=False)
    assert not f.exists()
    with pytest.raises(ValueError):
        h.apply_deletions(actions.withColumn("key", F.lit("../../etc/x")), roots, suffixes)


def test_resume_and_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "key")
    assert h.resume(df, df.where("key < 90")).count() == 10
    a, b = ([r.key for r in h.sample(x, 10, "key").collect()] for x in (df, df.orderBy(F.desc("key"))))
    assert a == b and len(a) == 10


KINDS = {"Workers Party of X": "organization", "Republic of Y": "location", "French revolution": "event", "Idealism": "concept", "Library:Some book": "work", "Ann": "general", "The Soviet war": "location"}


def test_entities(spark):
    df = spark.createDataFrame([(k,) for k in KINDS], "e string")
    assert {r.e: r.k for r in df.select("e", en.kind_of(F.col("e")).alias("k")).collect()} == KINDS
    t = "[[A]] [[A|b]] [[ B ]] [[Category:C|s]] [[File:f]] [[Library:W]]\n| name = Zed\n|Name=[[no]]\n|birth_name=Born X|q\nin 1917 and 2029 and 2030"
    r = spark.createDataFrame([(t,)], "t string").select(en.links_of(F.col("t")).alias("l"), en.with_prefix(F.col("t"), "Category").alias("c"), en.with_prefix(F.col("t"), "Library").alias("w"), en.infobox_names(F.col("t")).alias("n"), en.years_of(F.col("t")).alias("y")).first()
    assert tuple(r) == (["A", "B", "Library:W", "no"], ["C"], ["W"], ["Zed", "Born X"], ["1917", "2029"])
    arts = spark.createDataFrame([("T1", "[[A]] [[A]] [[T2]]", "Main"), ("T2", "[[A]]", "Other")], "title string, t string, ns string")
    assert {r.entity: r.n for r in en.entity_counts(arts, "title", "t").collect()} == {"T1": 1, "A": 2, "T2": 2}
    assert {r.title for r in en.titles(arts, "title", "ns").collect()} == {"T1", "Main:T1", "T2"}


def test_whitelist(spark):
    raw = ["'''A b'''", " C#frag ", "x", "{{t", "[[l", "http://e", "1917", "19", "12345", "ends]]", "ok", "OK", ""]
    got = sorted((r.entity, r.lower) for r in en.whitelist(spark.createDataFrame([(x,) for x in raw], "entity string")).collect())
    assert got == [("1917", "1917"), ("A b", "a b"), ("C", "c")][:2] + [("OK", "ok"), ("ok", "ok")] or got == [("1917", "1917"), ("A b", "a b"), ("OK", "ok"), ("ok", "ok")]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(1, "What?", 'The end of it, he said: "x"'), (2, "Wo?", "der Mond und so lich"), (3, "Why?", "the middle of the road"), (4, "zz", None), (5, None, "the rest of it")], "line_no long, instruction string, response string")


def test_records(pairs):
    rows = {r.original_line: r for r in q.qa_records(pairs).collect()}
    assert {k: r.qa_id for k, r in rows.items()} == {1: "Library/English_Prose#001", 3: "Library/English_Prose#002", 5: "Library/English_Prose#003", 2: "Library/German_Prose#001", 4: "Library/Uncategorized#001"}
    assert rows[1].quality.has_blockquote and not rows[3].quality.has_blockquote and rows[4].quality.confidence == "low"
    assert rows[2].classification.tradition == "germanic" and "german-prose" in rows[2].classification.categories and rows[4].classification.categories == ["general"]


def test_first_rule_counts(spark):
    rules = (q.Rule("b", "first", "F"), q.Rule("a|b", "second", "S"))
    df = spark.createDataFrame([("a B",), ("A",), ("z",)], "t string").select(q.detect_source(F.col("t"), rules).alias("s"))
    assert [(r.s.author_key, r.s.matched_pattern) for r in df.collect()] == [("first", "b"), ("second", "a|b"), ("uncategorized", None)]


def test_split_and_manifest(spark, pairs, tmp_path):
    records = q.qa_records(pairs)
    m = {r.filename: (r.record_count, r.sha256) for r in q.split_by_author(records, str(tmp_path / "qa")).collect()}
    assert sum(n for n, _ in m.values()) == 5 and "english_prose/english_prose.jsonl" in m
    assert {r.filename: (r.record_count, r.sha256) for r in q.split_by_author(records.orderBy(F.rand()), str(tmp_path / "again")).collect()} == m
    back = spark.read.json(str(tmp_path / "qa"))
    assert back.count() == 5 and q.duplicate_ids(back).count() == 0
    actual = spark.createDataFrame([(f, n + (f.startswith("unc"))) for f, (n, _) in m.items()], "filename string, record_count long")
    expected = spark.createDataFrame([(f, n) for f, (n, _) in m.items()] + [("other", 9)], "filename string, record_count long")
    assert [r.filename for r in q.manifest_mismatches(expected, actual).collect()] == [f for f in m if f.startswith("unc")]


def test_collection_digest(spark):
    a = spark.createDataFrame([("s/b", 1, "x"), ("s/b", 2, "y"), ("s/a", 1, "z")], "path string, line_no int, value string")
    b = spark.createDataFrame([("synthetic_1", 1, "x")], "path string, line_no int, value string")
    lines = q.ordered_sources(a, b)
    assert [(r.set, r.path, r.line_no) for r in lines.collect()] == [(0, "s/a", 1), (0, "s/b", 1), (0, "s/b", 2), (1, "synthetic_1", 1)]
    one = q.collection_digest(lines).first()
    assert one.n_lines == 4 and one == q.collection_digest(lines.orderBy(F.desc("value"))).first()
    assert one.sha256 != q.collection_digest(q.ordered_sources(a.where("line_no = 1"), b)).first().sha256


def test_chat(pairs):
    r = q.to_chat(pairs.where("line_no = 4")).first()
    assert [x.role for x in r.prompt] == ["system", "user"] and r.prompt[1].content == "zz" and r.answer == ""


def test_validation(spark, pairs):
    lines = spark.createDataFrame([(1, '{"a":1}'), (2, "{"), (3, '{"a":1}}'), (4, "1,2"), (5, "x"), (6, "[1]"), (7, "1] x"), (8, '"s"')], "line_no int, value string")
    assert sorted(r.line_no for r in q.syntax_errors(lines).collect()) == [2, 3, 4, 5, 7]
    bad = {(r.qa_id, r.rule) for r in q.schema_violations(q.qa_records(pairs), q.record_rules()).collect()}
    assert bad == {("Library/Uncategorized#001", "response is not blank"), ("Library/English_Prose#003", "instruction is not blank")}

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexquarry.operators import embedding as e
from lexquarry.operators import graph, search, store
from lexquarry.operators.filters import where, where_document
from lexquarry.sources.npy import paired, read_npy, write_npy


@pytest.fixture(scope="module")
def rows(spark):
    vectors = [(f"Main/A#{i}", f"text {i}", "A" if i < 6 else "B", "Main", None if i % 2 else "S", i, f"{i}-{i + 1}", [math.cos(i / 5), math.sin(i / 5)]) for i in range(10)]
    return spark.createDataFrame(vectors, "chunk_id string, text string, article_title string, namespace string, section string, chunk_index int, line_range string, embedding array<float>")


def test_search_and_limit(rows):
    got = search.search(rows, [1.0, 0.0], 3).collect()
    assert [r.chunk_id for r in got] == ["Main/A#0", "Main/A#1", "Main/A#2"]
    assert abs(got[1].distance - (1 - math.cos(0.2))) < 1e-6 and abs(got[1].score + got[1].distance - 1) < 1e-12
    assert [r.chunk_index for r in search.search(rows, [1.0, 0.0], 2, {"article_title": "B"}, {"$contains": "text"}).collect()] == [6, 7]
    assert search.search(rows, [1.0, 0.0], 2, {"article_title": "none"}).count() == 0
    for metric in ("l2", "ip"):
        assert search.search(rows, [1.0, 0.0], 1, metric=metric).first().chunk_index == 0
    with pytest.raises(Exception, match="unequal length"):
        search.search(rows, [1.0, 0.0, 0.0], 1).collect()
    for bad in (0, 21):
        with pytest.raises(ValueError):
            search.checked_limit(bad)


def test_search_many_in_blocks(rows, monkeypatch):
    queries = rows.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query"))
    for at_once in (1000, 3):
        monkeypatch.setattr(search, "QUERIES_AT_ONCE", at_once)
        got = search.search_many(rows, queries, 2, id_col="chunk_id").collect()
        assert len(got) == 20 and all(r.chunk_id == r.query_id for r in got if r["rank"] == 1)


def test_articles_and_rendering(rows):
    assert [r.chunk_index for r in search.article_chunks(rows, "B").collect()] == [6, 7, 8, 9]
    assert search.article_text(rows, "B").startswith("text 6\n\ntext 7") and search.article_text(rows, "x").startswith("Article not found")
    said = search.rendered(search.search(rows, [1.0, 0.0], 2))
    assert said == "**A** (Main, §S, lines 0-1) [score: 1.00]:\n> text 0\n\n**A** (Main, §(none), lines 1-2) [score: 0.98]:\n> text 1"
    assert search.rendered(rows.where("false").withColumn("distance", F.lit(0.0))) == search.NOTHING


def test_metrics(spark):
    ranked = spark.createDataFrame([(1, i, i + 1) for i in range(10)], "query_id long, id long, rank int")
    relevant = spark.createDataFrame([(1, 1), (1, 3), (1, 77)], "query_id long, id long")
    r = search.retrieval_metrics(ranked, relevant).first()
    ideal = 1 + 1 / math.log2(3) + 1 / 2
    assert (r.precision_at_k, round(r.recall_at_k, 6), r.reciprocal_rank) == (0.4, round(2 / 3, 6), 0.5)
    assert abs(r.ndcg - (1 / math.log2(3) + 1 / math.log2(5)) / ideal) < 1e-9


FILTERS = [
    ({"a": 1}, [1]), ({"a": {"$ne": 1}}, [2, 3]), ({"a": {"$gt": 1, "$lte": 3}}, [2, 3]), ({"a": {"$in": [1, 3]}}, [1, 3]), ({"a": {"$nin": [1]}}, [2, 3]),
    ({"$or": [{"a": 1}, {"b": "z"}]}, [1, 3]), ({"$and": [{"a": {"$gte": 2}}, {"$or": [{"b": "y"}, {"b": "q"}]}]}, [2]), (None, [1, 2, 3]), ({"a": {"$lt": 3}, "b": "y"}, [2]),
]


@pytest.mark.parametrize(("condition", "want"), FILTERS)
def test_where(spark, condition, want):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a int, b string")
    assert [r.a for r in df.where(where(condition)).orderBy("a").collect()] == want


def test_where_refuses(spark):
    for bad in ({"a": {"$like": 1}}, {"a": {"$gt": "x"}}, {"a": {"$lt": True}}, {"$not": [{"a": 1}]}, {"$and": []}):
        with pytest.raises(ValueError):
            where(bad)
    with pytest.raises(ValueError):
        where_document({"$eq": "x"}, F.lit("x"))


def test_filter_is_pushed_down(spark, tmp_path):
    spark.range(10).withColumn("b", F.lit("x")).write.parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).where(where({"id": {"$gt": 3}})).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,3)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_collection(spark, rows, tmp_path):
    c = store.Collection(spark, str(tmp_path))
    assert c.count() == 0 and not c.exists()
    c.add(rows.limit(6))
    before = c.rows()
    changed = rows.withColumn("text", F.lit("new"))
    c.add(changed)
    assert c.count() == 10 and c.rows().where("text = 'new'").count() == 4 and before.count() == 6
    c.add(changed.unionByName(changed), mode="upsert")
    assert c.count() == 10 and c.rows().where("text = 'new'").count() == 10
    c.delete_rows(rows.where("chunk_index < 2"), None)
    c.delete_rows(None, {"chunk_index": {"$gte": 8}})
    assert sorted(r.chunk_index for r in c.rows().collect()) == list(range(2, 8))
    c.vacuum()
    assert c.count() == 6
    c.drop()
    with pytest.raises(LookupError):
        c.rows()


def test_metadata_round_trip(spark):
    df = spark.createDataFrame([("s", ["a", "é"], 1917, ["x"]), (None, None, None, None)], "section string, categories array<string>, library_work_published_year int, political_orientation array<string>")
    flat = store.serialize(df).collect()
    assert [tuple(r) for r in flat] == [("s", '["a","é"]', 1917, '["x"]'), ("", "[]", -1, "")]
    back = store.deserialize(store.serialize(df)).collect()
    assert [tuple(r) for r in back] == [("s", ["a", "é"], 1917, ["x"]), (None, [], None, None)]


def test_embedding_config():
    for bad in ({"dimensions": 0}, {"batch_size": 0}, {"max_retries": -1}, {"retry_delay": -1}, {"model": ""}):
        with pytest.raises(ValueError):
            e.EmbedConfig(**bad)


def test_batches():
    assert e.fixed_batches(list("abcde"), 2) == [["a", "b"], ["c", "d"], ["e"]]
    size = len
    assert e.token_batches(["aa", "bb", "c" * 9, "d", "e", "f"], 5, 2, size) == [["aa", "bb"], ["c" * 9], ["d", "e"], ["f"]]
    assert e.token_batches([], 5, 2, size) == []


def test_retries():
    slept, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
        return [[0.0] * 4]

    config = e.EmbedConfig(dimensions=4, retry_delay=1.0)
    assert e.with_retries(call, config, slept.append) == [[0.0] * 4] and slept == [1.0, 2.0]
    with pytest.raises(e.EmbeddingError):
        e.with_retries(lambda: 1 / 0, config, slept.append)
    n = len(slept)
    with pytest.raises(e.WrongDimension):
        e.with_retries(lambda: [[0.0] * 3], config, slept.append)
    assert len(slept) == n


def test_embedding_column(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, "boom"), (4, "c b a")], "i int, text string")

    def provider(texts):
        if any("boom" in t for t in texts):
            raise ValueError("refused")
        return e.HashingProvider(8)(texts)

    config = e.EmbedConfig(dimensions=8, batch_size=1, max_retries=0)
    got = {r.i: r for r in e.embed_chunks(df, provider, config).collect()}
    assert abs(np.linalg.norm(got[1].embedding) - 1) < 1e-6 and got[1].embedding == got[4].embedding
    assert got[2].embedding == [0.0] * 8 and got[3].embedding is None and "refused" in got[3].embedding_error
    assert e.embed_texts([], provider, config).shape == (0, 8)


def test_api_key(monkeypatch):
    monkeypatch.setenv("SOME_KEY", " ")
    with pytest.raises(e.NotAuthorised):
        e.api_key("SOME_KEY")
    monkeypatch.setenv("SOME_KEY", "k")
    assert e.api_key("SOME_KEY") == "k"


def test_npy_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, [float(i), 1.0, 2.0]) for i in range(7)], "i int, embedding array<float>").coalesce(1)
    write_npy(df, str(tmp_path / "v"))
    back = read_npy(spark, str(tmp_path / "v")).orderBy("row_idx").collect()
    assert [r.embedding for r in back] == [[float(i), 1.0, 2.0] for i in range(7)] and [r.row_idx for r in back] == list(range(7))


def test_paired(spark):
    chunks = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "article string, row_idx long")
    vectors = spark.createDataFrame([("a", 0, [1.0]), ("a", 1, [2.0]), ("b", 0, [3.0]), ("b", 1, [4.0])], "article string, row_idx long, embedding array<float>")
    good, bad = paired(chunks, vectors)
    assert sorted((r.article, r.row_idx) for r in good.collect()) == [("a", 0), ("a", 1)]
    assert [tuple(r) for r in bad.collect()] == [("b", 1, 2)]


def test_graph(spark):
    links = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("d", "b"), ("b", "c")], "source string, target string")
    assert {r.node: (r.in_degree, r.out_degree) for r in graph.degrees(links).collect()} == {"a": (0, 2), "b": (2, 1), "c": (2, 0), "d": (0, 1)}
    assert sorted(r.source for r in graph.backlinks(links, "b").collect()) == ["a", "d"]
    assert [tuple(r) for r in graph.related(links, "a").collect()] == [("b", 1), ("d", 1)]
    assert {r.node: r.hops for r in graph.explore(links, "d", 3).collect()} == {"d": 0, "b": 1, "c": 2}
    cats = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (2, "x"), (2, "z"), (2, "z")], "article int, category string")
    assert {(r.a, r.b): r.n for r in graph.cooccurrence(cats).collect()} == {("x", "y"): 2, ("x", "z"): 1, ("y", "z"): 1}


def test_a_change_writes_only_what_it_changes(spark, rows, tmp_path):
    c = store.Collection(spark, str(tmp_path), most_covering=2)
    c.add(rows.limit(6))
    c.add(rows, mode="upsert")
    parts = c._latest()
    assert [p["covers"] for p in parts] == [False, True] and c.count() == 10
    c.add(rows)  # all there: an empty part, which covers nothing
    assert c._read([c._latest()[-1]["name"]]).count() == 0
    for i in range(2):
        c.delete_rows(None, {"chunk_index": i})
    assert len(c._latest()) == 1 and c.count() == 8  # compacted
    assert len(list((tmp_path / "chunks" / "versions").glob("*.json"))) == 6
    c.vacuum()
    assert len(list((tmp_path / "chunks" / "parts").iterdir())) == 1 and c.count() == 8


def test_npy_files_are_bounded(spark, tmp_path):
    df = spark.range(10).select(F.array(F.col("id").cast("float"), F.lit(1.0)).alias("embedding")).coalesce(1)
    write_npy(df, str(tmp_path / "v"), rows_per_file=4)
    write_npy(df.limit(0), str(tmp_path / "v"))
    found = sorted((tmp_path / "v").glob("*.npy"))
    assert [np.load(f).shape for f in found] == [(4, 2), (4, 2), (2, 2)]
    assert sorted(r.embedding[0] for r in read_npy(spark, str(tmp_path / "v")).collect()) == list(map(float, range(10)))


def test_batch_numbers_stream_over_groups(spark):
    df = spark.createDataFrame([("a", i, t) for i, t in enumerate([5, 5, 20, 1, None])] + [("b", 0, 1), (None, 0, 3)], "g string, o int, t long")
    got = sorted((r.g or "", r.o, r.batch) for r in e.batch_ids(df, "g", "o", "t", 10, 2).collect())
    assert got == [("", 0, 0), ("a", 0, 0), ("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("a", 4, 2), ("b", 0, 0)]

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lexquarry.operators import health
from lexquarry.operators.chunking import ChunkConfig
from lexquarry.operators.embedding import EmbedConfig
from lexquarry.operators.store import Collection
from lexquarry.plans import cli, config, queries
from lexquarry.plans.pipeline import Pipeline
from lexquarry.sources import files
from lexquarry.streaming import ingest
from tests.oracle import connect, difference

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "corpus"
    for name, text in {
        "Main/First_article.txt": "{{Infobox person|name=Ann}}\n== Life ==\n" + "Ann wrote many words about trees and rivers. " * 40 + "[[Category:People]]",
        "Library/Some_work.txt": "{{Library work|title=W|author=Bob|published_date=May 1917}}\n" + "A long passage on machines and engines. " * 60,
        "Essays/Empty.txt": "",
        "Elsewhere/Other.txt": "not read",
    }.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    return root


def test_pipeline_end_to_end(spark, corpus, tmp_path):
    p = Pipeline(spark, str(tmp_path / "out"), ChunkConfig(max_tokens=100, overlap_tokens=10), EmbedConfig(dimensions=64))
    r = p.extract(str(corpus))
    assert r.ok and r.counts == {"rows": 3, "empty": 1}
    assert p.extract(str(corpus)).counts["rows"] == 0  # nothing is left to do
    r = p.chunk()
    assert r.counts["articles"] == 3 and r.counts["chunks"] > 4
    assert p.chunk().counts["chunks"] == 0
    r = p.embed()
    assert r.ok and r.counts["rows"] == p.table("chunks").count()
    assert p.load().counts["added"] > 0 and p.load().counts["added"] == 0
    best = p.search("machines and engines", 3).first()
    assert best.namespace == "Library" and best.library_work_author == "Bob" and best.library_work_published_year == 1917
    assert p.search("machines", 3, {"namespace": "Main"}).first().infobox_type == "person"
    said = p.answer("trees and rivers", 1)
    assert said.startswith("**First article** (Main, §(none), lines ")
    with pytest.raises(ValueError):
        p.search("x", 21)
    v = health.verdict(p.stages()).first()
    assert v.empty_extracted == 1 and not v.healthy and v.missing_chunks == 0


def test_command_line(spark, corpus, tmp_path, capsys):
    out = str(tmp_path / "out")
    assert cli.main([out, "extract", str(corpus)], spark) == 0
    assert cli.main([out, "chunk", "--max-tokens", "100"], spark) == 0
    assert cli.main([out, "embed"], spark) == 0 and cli.main([out, "load"], spark) == 0
    assert cli.main([out, "search", "engines", "--limit", "2", "--namespace", "Library"], spark) == 0
    assert "**Some work**" in capsys.readouterr().out
    assert cli.main([out, "diagnose"], spark) == 1 and cli.main([out, "diagnose", "--json"], spark) == 0
    assert cli.main([out, "repair", "--stage", "extracted"], spark) == 0 and "delete_empty" in capsys.readouterr().out
    assert cli.main([out, "search", "x", "--limit", "50"], spark) == 1
    assert cli.main([str(tmp_path / "none"), "chunk"], spark) == 1


def test_reprocessing(spark, corpus, tmp_path):
    p = Pipeline(spark, str(tmp_path / "out"))
    p.extract(str(corpus))
    (corpus / "Essays/Empty.txt").write_text("now there is text")
    (corpus / "Main/Second.txt").write_text("")
    p.extract(str(corpus))
    (corpus / "Main/Second.txt").unlink()
    r = p.reprocess_empty(str(corpus))
    assert r.counts == {"rows": 1, "errors": 1} and not r.ok
    got = {x.title: x.clean_text for x in p.table("articles").collect()}
    assert len(got) == 4 and got["Empty"] == "now there is text" and got["Second"] == ""


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "a" / "b").mkdir(parents=True)
    assert config.chunk_config(str(tmp_path / "a")) == ChunkConfig()
    (tmp_path / "pyproject.toml").write_text("[tool.lexquarry.chunking]\nmax_tokens = 7\n[tool.lexquarry.embedding]\ndimensions = 9\n")
    config.settings.cache_clear()
    assert config.chunk_config(str(tmp_path / "a" / "b")).max_tokens == 7 and config.embed_config(str(tmp_path)).dimensions == 9
    (tmp_path / "a" / "pyproject.toml").write_text("[tool.lexquarry.chunking]\nnope = 7\n")
    config.settings.cache_clear()
    with pytest.raises(ValueError):
        config.chunk_config(str(tmp_path / "a"))


def test_logging(tmp_path):
    import logging

    path = config.log_to(str(tmp_path / "logs"), "lexquarry-test")
    logging.getLogger("lexquarry-test").debug("hello")
    assert "DEBUG lexquarry-test hello" in path.read_text()


def test_sources(spark, tmp_path):
    (tmp_path / "Essay_A_b.txt").write_text("x")
    (tmp_path / "Plain.txt").write_bytes("é".encode("latin-1"))
    rows = {r.title: r.namespace for r in files.articles(spark, str(tmp_path), flat=True).collect()}
    assert rows == {"Essay A b": "Essays", "Plain": "Main"}
    assert {r.text for r in files.texts_any_encoding(spark, str(tmp_path)).collect()} == {"x", "é"}
    listing = health.listing(files.file_listing(spark, str(tmp_path), ".txt"), ".txt").collect()
    assert sorted((r.key.split("/")[1], r.size) for r in listing) == [("Essay_A_b", 1), ("Plain", 1)]


def test_chunk_files(spark, tmp_path):
    df = spark.createDataFrame([("a", "é\n", None)], "chunk_id string, text string, section string")
    files.write_chunks(df, str(tmp_path / "c"))
    line = "".join(p.read_text() for p in Path(tmp_path / "c").glob("*.json"))  # some part files are empty
    assert json.loads(line) == {"chunk_id": "a", "text": "é\n", "section": None} and "é" in line
    back = files.read_chunks(spark, str(tmp_path / "c"))
    assert len(back.columns) == 20 and back.first().text == "é\n"


def test_metadata_lookup(spark):
    texts = spark.createDataFrame([("Main", "A"), ("Main", "B"), ("Main", "C")], "namespace string, title string")
    meta = spark.createDataFrame([("Main", "A", ["k"], True), ("Library", "B", ["l"], None)], "namespace string, title string, categories array<string>, is_stub boolean")
    got = {r.title: (r.categories, r.is_stub, r.missing_metadata) for r in files.with_metadata(texts, meta).collect()}
    assert got == {"A": (["k"], True, False), "B": (["l"], False, False), "C": ([], False, True)}


def test_json_lines_and_manifest(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x":1}\n\n{"x":2}\n')
    assert [(r.line_no, r.value) for r in files.json_lines(spark, str(tmp_path / "a.jsonl")).orderBy("line_no").collect()] == [(1, '{"x":1}'), (3, '{"x":2}')]
    (tmp_path / "m.yaml").write_text("files:\n  - filename: s/a.jsonl\n    sha256: z\n    record_count: 3\n  - filename: 'b.jsonl'\n    record_count: 4\n")
    assert sorted(tuple(r) for r in files.read_manifest(spark, str(tmp_path / "m.yaml")).collect()) == [("b.jsonl", 4), ("s/a.jsonl", 3)]


def test_streaming_ingestion(spark, tmp_path):
    rows = [("Main", f"T{i}", "== H ==\n" + f"words of article {i} " * 30) for i in range(3)]
    df = spark.createDataFrame(rows, ingest.ARTICLE)
    source = str(tmp_path / "in")
    df.limit(2).write.json(source)
    c = Collection(spark, str(tmp_path / "store"))
    for _ in range(2):
        ingest.ingest(ingest.article_stream(spark, source), c, str(tmp_path / "ck")).awaitTermination()
    n = c.count()
    assert c.rows().select("article_title").distinct().count() == 2
    df.write.mode("append").json(source)
    ingest.ingest(ingest.article_stream(spark, source), c, str(tmp_path / "ck")).awaitTermination()
    assert c.rows().select("article_title").distinct().count() == 3 and n < c.count()
    assert c.rows().count() == c.rows().select("chunk_id").distinct().count()


def test_windows_of_a_stream_are_those_of_a_table(spark, tmp_path):
    events = spark.read.parquet(f"{SMALLEST}/events.parquet")
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = ingest.windowed_counts(stream, "ts", "event_type", "value", late="3650 days").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    want = ingest.windowed_counts(events, "ts", "event_type", "value").withColumn("total", F.round("total", 3))
    got = spark.table("w").withColumn("total", F.round("total", 3))
    assert got.count() == want.count() > 0 and got.subtract(want).count() == 0


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_against_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALLEST)
    if name in queries.ORACLE_SQL:
        assert difference(df, queries.ORACLE_SQL[name], connect(SMALLEST)) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_the_library_does_not_need_its_llm_part():
    code = "import sys; sys.modules['lexquarry.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parent.parent, check=True)
    assert done.stdout.split() == [str(len(queries.QUERIES)), "False"]
    for path in Path("lexquarry").rglob("*.py"):
        assert path.parts[1] == "llm" or "lexquarry.llm" not in path.read_text()

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexquarry.operators import chunking as c

SMALL = c.ChunkConfig(max_tokens=30, overlap_tokens=8, min_words=2)
TEXT = "== One ==\nFirst line here.\nSecond line follows it.\n\n== Two ==\n" + "\n".join(f"Line number {i} of the second section." for i in range(12)) + "\n\n" + "word " * 80 + "\n== Three ==\nEnd."


def test_headers_begin_chunks_and_sections_are_known():
    found = c.chunk_by_tokens(TEXT, SMALL)
    assert [x[1] for x in found] == list(range(len(found)))
    assert [x[2] for x in found][0] == "One" and found[-1][2] == "Three"
    assert all(x[5] == len(x[0].split()) and x[6] == c.quarter(x[0]) for x in found)


def test_lines_hold_the_text():
    lines = TEXT.split("\n")
    for text, _, _, first, last, _, _ in c.chunk_by_tokens(TEXT, c.ChunkConfig(max_tokens=30, overlap_tokens=0)):
        assert "\n".join(lines[first - 1 : last]).find(text.strip()[:20]) >= 0


def test_overlap_repeats_whole_lines():
    found = c.chunk_by_tokens("== A ==\n" + "\n".join(f"sentence {i} ends here." for i in range(30)), SMALL)
    assert len(found) > 2
    for a, b in zip(found, found[1:], strict=False):
        assert b[0].split("\n")[0] == a[0].split("\n")[-1] and b[3] == a[4]


def test_text_without_headers_has_no_section():
    found = c.chunk_by_tokens("para one. " * 60 + "\n\n" + "para two. " * 60, SMALL)
    assert len(found) > 3 and all(x[2] is None for x in found) and found[0][3] == 1 and found[-1][4] == 3
    assert c.chunk_by_tokens("  \n ", SMALL) == [] and c.chunk_by_tokens(None) == []


def test_a_long_line_is_split_alone():
    words = [f"w{i}" for i in range(100)]
    found = c.chunk_by_tokens("== A ==\nshort.\n" + " ".join(words) + "\nafter.", SMALL)
    own = [x for x in found if x[3] == x[4] == 3]
    assert len(own) > 2 and " ".join(x[0] for x in own).split() == words
    assert found[-1][0] == "after." and found[-1][3] == 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.just(""), st.just("== H =="), st.text(alphabet="ab .!?é", max_size=200)), max_size=40))
def test_chunks_keep_everything(lines):
    text = "\n".join(lines)
    found = c.chunk_by_tokens(text, c.ChunkConfig(max_tokens=20, overlap_tokens=0))
    assert [x[1] for x in found] == list(range(len(found)))
    assert all(x[0].strip() and x[3] >= 1 and x[4] >= x[3] for x in found)
    words = text.split()
    got = " ".join(x[0] for x in found).split()
    if not any(a == b for a, b in zip(words, words[1:], strict=False)) and len(text) < 60:
        assert "".join(got) == "".join(words)
    assert set("".join(got)) == set("".join(words))


def test_words_chunker():
    config = c.ChunkConfig(max_tokens=13)
    found = c.chunk_by_words(["a b c d", "", "e f g h", "i j k l", "== H ==", "m"], config)
    assert [(x[0], x[2], x[3], x[4]) for x in found] == [("a b c d", None, 1, 1), ("e f g h\ni j k l", None, 3, 4), ("== H ==\nm", "H", 5, 6)]
    assert c.chunk_by_words([], config) == []


def test_split_oversized():
    text = " ".join(f"Sentence {i} of some length here." for i in range(40))
    parts = c.split_oversized(text, 50, c.quarter)
    assert " ".join(parts) == text and all(p.endswith(".") for p in parts)
    assert c.split_oversized("short", 50, c.quarter) == ["short"]
    many = c.split_oversized("x" * 100_000, 10, c.quarter)
    assert len(many) < 5 and len(c.split_oversized(" ".join(map(str, range(30_000))), 10, c.quarter)) > 1000
    assert len(c.split_oversized(" ".join(map(str, range(30_000))), 10, c.quarter, most=100)) == 100


def test_a_segment_that_repeats_is_dropped():
    assert len(c.split_oversized("Same text here. " * 200, 16, c.quarter)) < 10


def test_split_position():
    t = "One two. Three four, five six seven"
    assert t[: c.split_position(t, 5, c.quarter)] == "One two. "
    assert c.split_position("short", 5, c.quarter) == 5
    assert c.longest_prefix("x" * 100, 5, c.quarter) == 20


def test_lines_of():
    assert c.lines_of(0, 2, [3, 4, 5]) == (0, 0)
    assert c.lines_of(3, 3, [3, 4, 5]) == (0, 0)
    assert c.lines_of(4, 12, [3, 4, 5]) == (1, 2)
    assert c.lines_of(99, 100, [3]) == (0, 0)


def test_headers():
    assert c.title_of_header("=== A b ===") == "A b" and c.title_of_header("== A ===") is None and c.title_of_header("= A =") is None


def test_vocabulary_counter():
    import pickle

    counter = c.VocabularyCounter("/opt/tokenizers/byte_bpe_50k.tiktoken", r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
    try:
        n = counter("Hello there, this is a text.")
    except FileNotFoundError:
        pytest.skip("no vocabulary here")
    assert 5 <= n <= 12 and counter("") == 0 and pickle.loads(pickle.dumps(counter))("Hello") >= 1


def keep(spark, rows, least=2):
    found = F.transform(F.col("t"), lambda x, i: F.struct(x.alias("text"), i.alias("chunk_index"), F.size(F.split(x, " ")).alias("word_count")))
    df = spark.createDataFrame([(rows,)], "t array<string>").withColumn("f", found).withColumn("k", c.keep_chunks(F.col("f"), least))
    r = df.select("k", c.filter_stats(F.col("f"), F.col("k"), least).alias("s")).first()
    return [(x.text, x.chunk_index) for x in r.k], tuple(r.s)


def test_filter_and_numbers(spark):
    assert keep(spark, ["a b", "x", "a b", "c d", "c d", "c d", "a b"]) == ([("a b", 0), ("c d", 1), ("a b", 2)], (7, 1, 3, 3))
    assert keep(spark, ["x", "x", "y"], 0) == ([("x", 0), ("y", 1)], (3, 0, 1, 2))
    assert keep(spark, []) == ([], (0, 0, 0, 0))


def test_fold_as_column_is_the_function(spark):
    rng = random.Random(1)
    texts = ["\n".join(rng.choice(["", "== H ==", "some words in a line.", "x " * rng.randint(1, 80)]) for _ in range(rng.randint(1, 40))) for _ in range(30)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", c.chunks(F.col("t"), SMALL).alias("c"))
    for r in df.collect():
        assert [tuple(x) for x in r.c] == c.chunk_by_tokens(texts[r.i], SMALL)


def test_chunk_ids(spark):
    assert spark.range(1).select(c.chunk_id(F.lit("Main"), F.lit("A b c"), F.lit(3))).first()[0] == "Main/A_b_c#3"

import random

from pyspark.sql import functions as F

from lexquarry.llm import toxicity


def test_folding():
    assert toxicity.words_of("Id1оt, IDI0T! ｉｄｉｏｔ $cum réÊ idiot### a—b") == ["idiot", "idiot", "idiot", "scum", "réê", "idiot", "a", "b"]
    assert toxicity.words_of(None) == toxicity.words_of("") == toxicity.words_of("?! ,") == []


def test_matching_takes_the_heaviest_and_spares_exceptions():
    lexicon = toxicity.Lexicon({"scum": 2.0, "scum ": 5.0, "fool ": 3.0}, ["fool proof"])
    assert lexicon.matches("Scum! scumble, a fool; fool proof, afool")[0] == [(0, 5.0), (5, 2.0), (15, 3.0)]
    assert lexicon.matches("") == ([], 0)


def rows_of(n=600, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice("the of and to in that it was for on are with as at be".split()) for _ in range(rng.randint(5, 200))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "v1le", "rotten", "Rоtten", "beast"]))
        elif i % 40 == 1:
            words += ["beast", "mode"]
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_learning(spark):
    docs, labels = rows_of()
    docs += [(10_000, None, None), (10_001, "", None), (None, "vile rotten", None), (3, docs[3][1], "en"), (10_002, "the " * 60_000 + "vile", "x")]
    labels += [(3, 0), (20_000, 1), (None, 1), (4, None), (5, 7)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn(d, lab)
    assert "beast mode" in lexicon.exceptions
    scored = toxicity.score_toxicity(d.select("doc_id", "text"), lexicon).withColumn("held", toxicity.held_out_column(F.col("doc_id")))
    got = scored.collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 80 and sum((r.score >= 0.3) == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    # learning again, from rows in another order, gives the same
    again = toxicity.learn(d.orderBy(F.desc("doc_id")), lab.orderBy("doc_id"))
    assert again.weights == lexicon.weights and all(abs(a - b) < 1e-6 for a, b in zip(again.coefficients, lexicon.coefficients, strict=True))


def test_nothing_to_learn_from(spark):
    d = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 1)], [(7, 1), (8, 0)]):
        lexicon = toxicity.learn(d, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert [r.score for r in toxicity.score_toxicity(d, lexicon).collect()] == [0, 0]
    assert toxicity.score_toxicity(d.limit(0), lexicon).count() == 0

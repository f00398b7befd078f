import random

import pytest

from lexquarry.llm import decontam


def edit_rows(pattern, text):
    """Least distance of the pattern to any part of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (p != c))
    return min(row)


def test_best_part_is_exact():
    rng = random.Random(1)
    for _ in range(400):
        p = bytes(rng.choice(b"abc ") for _ in range(rng.randint(1, 20)))
        t = bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 40)))
        want = edit_rows(p, t)
        got, end = decontam.distance_of_best_part(p, t, len(p))
        assert got == want
        back, n = decontam.distance_of_best_start(p[::-1], t[:end][::-1])
        assert back == want and edit_rows(p, t[end - n : end]) == want


WORDS = [f"{a}{b}{c}" for a in ("th", "re", "on", "st", "qu", "br") for b in ("a", "e", "io", "ou") for c in ("n", "r", "nd", "st", "ly")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, share, words):
    if words:
        out, left = text.split(), int(share * len(text))
        while left > 6:
            i = rng.randrange(len(out))
            left -= len(out[i])
            out[i] = "".join(rng.choice("abcdefgh") for _ in out[i])
        return " ".join(out)
    out = list(text)
    for _ in range(int(share * len(text))):
        i = rng.randrange(len(out))
        out[i : i + 1] = rng.choice([[], ["x"], [out[i], "y"]])
    return "".join(out)


@pytest.mark.parametrize(("share", "words", "least"), [(0.0, False, 1.0), (0.05, False, 0.95), (0.1, False, 0.9), (0.1, True, 0.9), (0.15, True, 0.9), (0.19, False, 0.9), (0.19, True, 0.9)])
def test_recall_against_brute_force(share, words, least):
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.randint(15, 60))) for i in range(40)]
    block = decontam.Benchmark(items, 0.8, 400, 4, 0.02, 7)
    block.open()
    found = wanted = 0
    for i, text in items * 2:
        host = decontam.normal(sentence(rng, 80) + " " + edited(rng, text, share, words) + " " + sentence(rng, 80))
        want = {j: d for j, _ in items if (d := edit_rows(block.texts[j], host)) <= int(0.2 * len(block.texts[j]))} if wanted < 3 else {i: None}
        got = {j: d for j, d, _, _ in block.matches(host)}
        assert got.keys() <= want.keys() or wanted >= 3
        assert all(want[j] in (None, got[j]) or got[j] >= want[j] for j in got if j in want)
        found += i in got
        wanted += 1
    assert found >= least * wanted


def test_documents(spark):
    rng = random.Random(4)
    items = [(i, sentence(rng, 40)) for i in range(30)]
    bench = spark.createDataFrame([*items, (100, None), (101, ""), (102, "too short"), (103, items[0][1])], "item_id long, text string")
    rows = [(i, sentence(rng, 300)) for i in range(20)]
    rows += [(50, sentence(rng, 50) + "\n" + items[3][1].upper().replace(" ", " \t ") + " " + sentence(rng, 9)), (51, items[0][1]), (51, items[0][1]), (52, None), (53, ""), (54, "too short"), (55, sentence(rng, 20_000) + " " + items[7][1])]
    df = spark.createDataFrame([(i, t, "m") for i, t in rows], "doc_id long, text string, matches string")
    for block_chars in (1 << 24, 2000):
        got = [(r.doc_id, [(m.item, m.distance, m.start_word, m.end_word) for m in r.matches]) for r in decontam.find_contamination(df, bench, block_chars=block_chars).collect()]
        want = [(i, []) for i, _ in rows if i < 50 or 51 < i < 55] + [(50, [(3, 0, 50, 90)]), (55, [(7, 0, 20_000, 20_040)])] + [(51, [(0, 0, 0, 40), (103, 0, 0, 40)])] * 2
        assert sorted((i, sorted(m)) for i, m in got) == sorted(want)
    assert decontam.find_contamination(df.limit(0), bench).count() == 0
    assert all(r.matches == [] for r in decontam.find_contamination(df, bench.limit(0)).collect())


def test_items_without_blanks_and_short_ones(spark):
    rng = random.Random(6)
    signs = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    item, token = signs(60), "".join(rng.choice("abcdefghij") for _ in range(120))
    bench = spark.createDataFrame([(1, item), (2, token), (3, "who built troy?"), (4, "a b c d e")], "item_id long, text string")
    changed = item[:20] + signs(1) + item[21:40] + signs(1) + item[41:]
    rows = [(1, signs(301) + item + signs(50)), (2, signs(300) + changed + signs(50)), (3, "z" * 401 + token + "z" * 40), (4, "they asked: who built troy? and"), (5, "x a b c d e y"), (6, signs(500))]
    got = {r.doc_id: [m.item for m in r.matches] for r in decontam.find_contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: [1], 2: [1], 3: [2], 4: [3], 5: [4], 6: []}


def test_counting_short_strings_loses_no_candidate():
    """Whatever is near enough by the edit distance alone is found, at distances up to the most."""
    rng = random.Random(12)
    letters = "abcdefghij "
    for size in (15, 40, 120, 230):
        items = [(i, "".join(rng.choice(letters) for _ in range(size)).strip().replace("  ", " a")) for i in range(5)]
        own = decontam.Benchmark(items, 0.8, 20, 2, 0.02, 7)
        own.open()
        for i, pattern in enumerate(own.texts):
            most = int(0.2 * len(pattern) + 1e-9)
            for edits in (1, most // 2, most, most + 3):
                part = bytearray(pattern)
                for at in rng.sample(range(len(part)), edits):
                    part[at] = ord(rng.choice("xyz"))
                raw = b"some words before " + bytes(part) + b" and some after"
                starts = decontam.window_starts(raw).tolist()
                want = min(decontam.distance_of_best_part(pattern, raw[max(0, s - most) : s + len(pattern) + most], most)[0] for s in starts)
                got = own.verified(i, starts, raw)
                assert (got[0] if got else most + 1) == want

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexquarry.functions import markup, text
from lexquarry.functions.templates import scan, templates
from lexquarry.operators import infobox
from lexquarry.operators.articles import extract_articles, with_citations
from lexquarry.operators.citations import citations


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, m string")


def one(spark, column, *texts):
    return [r[0] for r in frame(spark, *texts).orderBy("id").select(column).collect()]


def test_white_space_is_that_of_python(spark):
    every = "".join(chr(c) for c in [*range(1, 0x250), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000, 0xFEFF])
    texts = [f"a{c}b" for c in every] + [every, " a b\x1c", "", None]
    got = one(spark, text.word_count("m"), *texts)
    assert got[:-1] == [len(t.split()) for t in texts[:-1]]
    got = one(spark, text.strip("m"), *[f"{c}x{c}" for c in every])
    assert got == [f"{c}x{c}".strip() for c in every]


def test_years(spark):
    cases = {"in 1917.": 1917, "1917年": None, "21999 2100 0999": None, "a 2050, 1999": 2050, "": None}
    assert one(spark, text.year_of("m"), *cases) == list(cases.values())


LINKS = {
    "[[A]]": [("A", "A", "internal", None)],
    "[[A|b c]]": [("A", "b c", "internal", None)],
    "[[A|]]": [("A", "A", "internal", None)],
    "[[A#S|x]] [[#S]]": [("A", "x", "internal", "S"), ("", "", "internal", "S")],
    "[[A#]]": [("A", "A", "internal", None)],
    "[[A|b|c]]": [("A", "b|c", "internal", None)],
    "[[Category:K|sort]]": [("K", "K", "category", None)],
    "[[category:k]]": [("category:k", "category:k", "internal", None)],
    "[[File:x.png|thumb]] [[ru:Z]] [[ ]] [[file:x]]": [("file:x", "file:x", "internal", None)],
    "[http://e.org a b] [https://f.org]": [("http://e.org", "a b", "external", None), ("https://f.org", "https://f.org", "external", None)],
    "[ftp://x] [[A\n]]": [("A\n", "A\n", "internal", None)],
    "": [],
}


def test_links(spark):
    got = one(spark, markup.links("m"), *LINKS)
    assert [[(x.target, x.display, x.link_type, x.section) for x in row] for row in got] == list(LINKS.values())
    assert one(spark, markup.links("m"), None) == [[]]
    assert one(spark, F.size(markup.links("m", "category")), "[[Category:a]] [[b]]") == [1]
    assert one(spark, markup.targets("m"), "[[b]] [[a]] [[b|x]] [[Category:c]]") == [["b", "a"]]


def test_link_positions(spark):
    t = "é [[A|b]] 😀 [https://e.org x] [[C]] [[File:no]] [[D]]"
    row = one(spark, markup.links("m", positions=True), t)[0]
    assert [t[x.start : x.end] for x in row] == ["[[A|b]]", "[https://e.org x]", "[[C]]", "[[D]]"]


def test_sections_references_flags(spark):
    t = "== A ==\ntext\n=== B b ===  \n= no =\n== bad ===\n======F======\nx == y ==\n"
    assert one(spark, markup.sections("m"), t, None) == [["A", "B b", "F"], []]
    refs = '<ref>a</ref> <ref name="x">b\nc</ref> <ref name="y" /> <REF>d</REF> <references/>'
    assert one(spark, markup.reference_count("m"), refs) == [len(re.findall(r"<ref(?:\s+[^>]*)?>.*?</ref>", refs, re.S | re.I)) + 1]
    flags = markup.quality_flags("m")
    rows = frame(spark, "{{Stub}} {{citation needed}}{{Citation  needed}}", "{{STUB}}{{Citation needed|x}}<blockquote class=a>", None).orderBy("id").select(*[c.alias(n) for n, c in flags.items()]).collect()
    assert [tuple(r) for r in rows] == [(True, 2, False), (False, 0, True), (False, 0, False)]


def test_categories_of_any_case_only_without_others(spark):
    assert one(spark, markup.categories("m"), "[[Category:A]][[category:b]]", "[[category: b |x]]", "") == [["A"], ["b"], []]


CLEAN = {
    "'''Bold''' and ''it''": "Bold and it",
    "[[A|b]] [[C]]": "b C",
    "x<ref>y</ref><ref name=a /> z": "x z",
    'A<ref name="x" /> keep me <ref>B</ref> end': "A end",
    "{{a|{{b}}}}t{{c}}": "t",
    "== H ==\n\n\n\ntext  \n  more": "H\ntext\nmore",
    "a\n\n\n\nb": "a\n\nb",
    "[[Category:X]]a": "a",
    "[[File:x|thumb|cap]]": "thumb|cap",
    "[[A|]]": "[[A|]]",
    "{{open t": "{{open t",
    "[https://e.org x]": "[https://e.org x]",
}


def test_clean_text(spark):
    got = dict(zip(CLEAN, one(spark, markup.clean_text("m"), *CLEAN), strict=True))
    assert got == CLEAN
    assert one(spark, markup.clean_text("m", keep_headers=True), "== H ==\ntext") == ["== H ==\ntext"]


def test_scanner():
    found = scan("a{{X|p|q=1=2|{{Y|[[l|m]]|z}}}} {{ Z }} {{open <!-- {{no}} --> <nowiki>{{no}}</nowiki> {{W|a=1|a=2}}")
    assert [(t["name"], t["depth"]) for t in found] == [("X", 0), ("Y", 1), ("Z", 0), ("W", 1)]
    assert found[0]["params"] == [{"name": "1", "value": "p"}, {"name": "q", "value": "1=2"}, {"name": "2", "value": "{{Y|[[l|m]]|z}}"}]
    assert found[1]["params"] == [{"name": "1", "value": "[[l|m]]"}, {"name": "2", "value": "z"}]
    assert scan(None) == scan("") == scan("}}{{") == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="{}[]|=aA \n<!->", max_size=60))
def test_scanner_never_fails_and_nests(t):
    found = scan(t)
    for x in found:
        assert t[x["start"] : x["start"] + 2] == "{{" and t[x["end"] - 2 : x["end"]] == "}}"
    for a in found:
        for b in found:
            assert a is b or a["end"] <= b["start"] or b["end"] <= a["start"] or a["start"] < b["start"] < b["end"] <= a["end"] or b["start"] < a["start"] < a["end"] <= b["end"]


BOX = "{{Infobox politician\n|name = Ann\n|party=[[P|the party]]<br/>[[Q]]<br>\n|born=\n|name=Bea [[R#s]]\n|x={{flag|y}}}}\nShe [[did]]."


def test_infobox(spark):
    rows = frame(spark, BOX, "{{Infobox spaceship|a=b}}{{Infobox person|a=b}}", "no", None, "{{infobox Political party|a=1}}{{Infobox person|b=2}}")
    rows = rows.withColumn("t", templates("m")).withColumn("b", infobox.infobox(F.coalesce("m", F.lit("")), F.col("t"))).select("id", "b", infobox.field_map(F.col("b")).alias("f")).orderBy("id").collect()
    b, f = rows[0].b, rows[0].f
    assert b.type == "politician" and b.remaining_text == "She [[did]]."
    assert f == {"name": ["Bea R#s"], "party": ["the party", "Q"], "born": None, "x": ["{{flag|y}}"]}
    assert b.extracted_links == ["P", "Q", "R#s"]
    assert [x.raw for x in b.fields] == ["Ann", "[[P|the party]]<br/>[[Q]]<br>", "", "Bea [[R#s]]", "{{flag|y}}"]
    assert rows[1].b is None and rows[2].b is None and rows[3].b is None
    assert rows[4].b.type == "political_party"


def test_library_work(spark):
    t = "Intro {{Library work\n| title = The Book\n|Author=[[a|Ann]], [[Bob]]\n| type = Book|source=[https://e.org here]|translated by=T|spoken on=1 May 1917\n}}\nBody"
    rows = frame(spark, t, "{{Library work|author=x}}", "{{library work|title=t|author=One}}").withColumn("t", templates("m"))
    got = rows.select("id", infobox.library_work(F.col("m"), F.col("t")).alias("w")).orderBy("id").collect()
    w = got[0].w
    assert (w.title, w.author, w.authors, w.work_type, w.source_url, w.translator, w.spoken_on) == ("The Book", "Ann, Bob", ["Ann", "Bob"], "Book", "https://e.org", "T", "1 May 1917")
    assert w.remaining_text == "Intro \nBody" and got[1].w is None and got[2].w.authors == ["One"]


def test_quotes(spark):
    t = '{{Quote|"Said it"|Ann}}{{quote|“curly”}}{{Quote|"}}{{Quote| }}{{Quote|a|}}{{Other|b}}'
    got = one(spark, infobox.quotes(templates("m")), t)[0]
    assert [(x.text, x.attribution) for x in got] == [("Said it", "Ann"), ("curly", None), ("a", None)]


def test_citations(spark):
    t = '<ref name="a">{{Citation|author=[[A|An A]]|title=T|web=w|url=u|pages=3|page=2}}</ref><ref name="a">{{Citation|title=no}}</ref><ref>{{ web citation |url=[[x]]}}{{Unknown|a=b}}</ref>{{Citation|title=out}}'
    rows = [r.asDict() for r in citations(frame(spark, t, "{{News citation|newspaper=[[N]]|title= }}", "none", None), "id", "m").orderBy("id", "ref", "pos").collect()]
    assert [(r["id"], r["type"], r["author"], r["title"], r["url"], r["page"], r["ref_name"]) for r in rows] == [(0, "book", "An A", "T", "w", "3", "a"), (0, "web", None, None, "[[x]]", None, None), (1, "news", None, None, None, None, None)]
    assert rows[2]["newspaper"] == "N"


@pytest.fixture(scope="module")
def article(spark):
    t = BOX + '\n== Life ==\nBorn<ref>{{Citation|title=T}}</ref>.\n{{Library work|title=W}}\n{{Quote|hm}}\n[[Category:People]]'
    return with_citations(extract_articles(frame(spark, t, None, "plain"), "m"), "id", "m").orderBy("id").collect()


def test_extraction(article):
    r = article[0]
    assert r.clean_text == "She did.\nLife\nBorn."
    assert [x.target for x in r.internal_links] == ["P", "Q", "R", "did"] and r.categories == ["People"] and r.sections == ["Life"]
    assert r.reference_count == 1 and r.library_work.title == "W" and r.infobox.type == "politician"
    assert [c.title for c in r.citations] == ["T"] and [x.text for x in r.quotes] == ["hm"]
    assert article[1].clean_text == "" and article[1].infobox is None and article[2].clean_text == "plain"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="{}[]|='<>/ref \nab#:", max_size=50), min_size=1, max_size=20))
def test_extraction_never_fails(spark, texts):
    assert len(extract_articles(frame(spark, *texts), "m").collect()) == len(texts)


def test_namespaces(spark):
    known = ("Main", "Library", "Essays")
    assert one(spark, markup.namespace_of_path("m", known), "Library/a/b.txt", "/Essays/x", "Other/x", "x.txt") == ["Library", "Essays", "Main", "Main"]
    assert one(spark, markup.namespace_of_name("m", {"Essay_": "Essays", "Library_": "Library"}), "Essay_a.txt", "Library_b", "Essays") == ["Essays", "Library", "Main"]

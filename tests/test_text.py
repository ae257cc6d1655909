import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from galley.functions import language, lexical, text
from galley.sources.word_lists import read_lexicon, word_lists


def apply(spark, values, expression):
    """Results of one column expression over a few strings, in order."""
    frame = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [row[0] for row in frame.orderBy("i").select(expression(F.col("s"))).collect()]


def test_blank(spark):
    values = ["", "  ", "\n\t", "  ", " x ", "x\n"]
    assert apply(spark, values, lambda c: text.is_blank(c, compat=True)) == [False, True, True, True, False, False]
    assert apply(spark, values, text.is_blank) == [True, True, True, True, False, False]


def test_strip_non_ascii(spark):
    assert apply(spark, ["naïve", "a\u0000b\u007fc", "tab\tend"], text.strip_non_ascii) == ["nave", "abc", "tab\tend"]


@pytest.mark.parametrize("raw, compat, cleaned", [
    ("", "", ""),
    ("Visit https://www.bbc.co.uk/news/1 now", "visit  news now", "visit news now"),
    ("@bob said AI wins 3-0", "said  wins", "said wins"),
    ("Café sales up", "  sales ", "sales"),
    ("x", " ", ""),
    ("abc٣def", "abc def", "abc def"),
    ("one two three", "one two three", "one two three"),
])
def test_remove_features(spark, raw, compat, cleaned):
    assert apply(spark, [raw], lambda c: text.remove_features(c, compat=True)) == [compat]
    assert apply(spark, [raw], text.remove_features) == [cleaned]


def test_urls(spark):
    values = [
        "a http://x.yz/p/q/ b", "a http://x.yz//q b", "a http://x.yz/p//q b", "a https://www.com b",
        "a http://x.yz/p?q=1 b", "a ftp://x.yz b", "a http://x b", "é https://café.fr/é/ü z",
    ]
    pattern = re.compile(r"https?://(www.)?\w+\.\w+(/\w+)*/?")
    assert apply(spark, values, text.remove_urls) == [pattern.sub(" ", v) for v in values]


def test_long_path_does_not_exhaust_the_stack(spark):
    value = "see http://a.bc" + "/x" * 50_000 + " end"
    assert apply(spark, [value], text.remove_features) == ["see end"]


def test_stop_words(spark):
    assert apply(spark, ["The cat and the hat", " and "], text.remove_stop_words) == ["The cat hat", ""]


def test_title_digits_and_tokens(spark):
    assert apply(spark, ["Top 10 of 2021"], text.remove_digits) == ["Top  of "]
    assert apply(spark, ["It's 5pm!"], text.non_word_split) == [["it", "s", "5pm"]]


word = st.text(alphabet="aA bB\tzé@#/.:_-'19 wthpsx", max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(word, min_size=1, max_size=40))
def test_cleaning_is_idempotent(spark, values):
    once = apply(spark, values, text.remove_features)
    assert apply(spark, once, text.remove_features) == once
    assert all(re.fullmatch(r"([a-z]{3,}( [a-z]{3,})*)?", v) for v in once)


def test_article_text(spark):
    html = (
        "<html><nav><p>menu</p></nav><script>var a='<article>no</article>';</script><!-- <article>x</article> -->"
        "<ARTICLE class='a'><h1>Fish &amp; chips</h1><p>It&#39;s &lt;good&gt;,\n&#x41;&#0;</p></ARTICLE><article>2</article>"
    )
    assert apply(spark, [html, "<p>none</p>"], text.extract_article_text) == ["Fish & chips It's <good>, A�", ""]


def test_entities_are_unescaped_once(spark):
    values = ["&#38;lt; &amp;lt; &amp;#39; &lt;", "&hellip;&nbsp;&#x1F600;&#55555555; &x;"]
    assert apply(spark, values, text.unescape_html) == ["&lt; &lt; &#39; <", "…\u00a0\U0001F600\ufffd &x;"]
    values = ["caf&eacute; a&times;b &NotEqualTilde;", "&#0000000039;&#x00000041;&#x110000; &AMP;amp; &noname; & &;"]
    assert apply(spark, values, text.unescape_html) == ["café a×b ≂̸", "'A\ufffd &amp; &noname; & &;"]


def test_article_text_with_bare_signs_and_open_scripts(spark):
    pages = ["<article>a < b and c > d, <b>x</b> <3 y</article>", "<article>seen <script>var a = 1 < 2;</article>", "<article>seen <!-- never closed</article>",
             "<article>one<?php x ?> two<!DOCTYPE html></article>"]
    expected = ["a < b and c > d, x <3 y", "seen", "seen", "one two"]
    assert apply(spark, pages, text.extract_article_text) == expected


def test_article_text_of_other_pages(spark):
    pages = [
        "<article>outer one <article>inner</article> outer two</article><article>second</article>",
        "<body>menu <main><p>main</p> text</main></body>",
        "<html><head><title>t</title></head><body class=x>only <b>body</b></body></html>",
        "<article>never closed <p>text",
        "</article><article>a</article>",
        "<articles>x</articles>",
        "",
    ]
    expected = ["outer one inner outer two", "main text", "only body", "never closed text", "a", "", ""]
    assert apply(spark, pages, text.extract_article_text) == expected


def test_long_article(spark):
    body = "word " * 400_000
    found = apply(spark, [f"<article><p>{body}</p></article>"], text.extract_article_text)
    assert found == [body.strip()]


def test_table_text(spark):
    page = (
        '<table class="other"><tr><td>Text</td><td>wrong</td></tr></table>'
        '<table class="big table"><tr><td>Title</td><td>Text of title</td></tr>'
        "<tr><td><b>Text</b></td> <td>The <i>body</i> &amp; more</td><td>rest</td></tr></table>"
    )
    last_cell = '<table class="table"><tr><td>Text</td></tr><tr><td>next row</td></tr></table>'
    assert apply(spark, [page, last_cell, "<p>x</p>"], text.extract_table_text) == ["The body & more", "", ""]


def test_lookup_tables_fold_to_literals(spark, capsys):
    frame = spark.createDataFrame([("went",), ("it's",), ("none",)], "w string")
    found = frame.select(text.lookup(F.col("w"), {"went": "go", "it's": "a:b,c"}).alias("v"))
    assert [row["v"] for row in found.collect()] == ["go", "a:b,c", None]
    found.explain()
    assert "from_json" not in capsys.readouterr().out


LEMMAS = {
    "soaring": "soar", "announced": "announce", "managed": "manage", "making": "make", "stopped": "stop",
    "visited": "visit", "children": "child", "women": "woman", "companies": "company", "died": "die",
    "studied": "study", "went": "go", "houses": "house", "boxes": "box", "classes": "class", "virus": "virus",
    "perhaps": "perhaps", "morning": "morning", "series": "series", "agreed": "agree", "shared": "share",
    "offered": "offer", "created": "create", "treated": "treat", "changing": "change", "selling": "sell",
    "heroes": "hero", "potatoes": "potato", "tomatoes": "tomato", "echoes": "echo", "vetoes": "veto", "shoes": "shoe",
    "toes": "toe", "canoes": "canoe", "matrices": "matrix", "indices": "index", "vertices": "vertex", "prices": "price",
    "services": "service", "offices": "office", "appendices": "appendix", "alumni": "alumnus", "bacteria": "bacterium",
    "spun": "spin", "knelt": "kneel", "slain": "slay", "shrunk": "shrink", "leapt": "leap", "flung": "fling",
    "dreamt": "dream", "stung": "sting", "stank": "stink", "swollen": "swell", "spat": "spit", "mice": "mouse",
    "feet": "foot", "geese": "goose", "teeth": "tooth", "wolves": "wolf", "knives": "knife", "lives": "life",
    "wives": "wife", "shelves": "shelf", "leaves": "leaf", "cities": "city", "stories": "story", "movies": "movie",
    "analyses": "analysis", "crises": "crisis", "criteria": "criterion", "phenomena": "phenomenon", "cacti": "cactus",
    "buses": "bus", "wishes": "wish", "churches": "church", "glasses": "glass", "status": "status", "news": "news",
    "policemen": "policeman", "written": "write", "wrote": "write", "taken": "take", "took": "take", "began": "begin",
    "begun": "begin", "bought": "buy", "caught": "catch", "chosen": "choose", "driven": "drive", "eaten": "eat",
    "fallen": "fall", "flew": "fly", "forgotten": "forget", "frozen": "freeze", "given": "give", "grown": "grow",
    "hidden": "hide", "known": "know", "led": "lead", "meant": "mean", "paid": "pay", "ran": "run", "said": "say",
    "sold": "sell", "spoken": "speak", "stolen": "steal", "taught": "teach", "thought": "think", "thrown": "throw",
    "worn": "wear", "running": "run", "planned": "plan", "hoping": "hope", "hopped": "hop", "trying": "try",
    "tried": "try", "dying": "die", "lying": "lie", "freed": "free", "king": "king", "during": "during",
}


def test_lemmas(spark):
    assert apply(spark, list(LEMMAS), lexical.lemma) == list(LEMMAS.values())


def test_tags(spark):
    tags = {"although": "X", "quickly": "RB", "family": "NN", "went": "VB", "falling": "VB", "useful": "JJ",
            "markets": "NNS", "market": "NN", "evening": "NN"}
    assert apply(spark, list(tags), lexical.pos_tag) == list(tags.values())
    kept = apply(spark, [" ".join(tags)], lambda c: lexical.keep_pos(F.split(c, " ")))
    assert kept == [["family", "went", "falling", "useful", "markets", "market", "evening"]]


def test_lexicon_from_files(spark, tmp_path):
    (tmp_path / "verb.exc").write_text("abode abide\nwent go\n")
    (tmp_path / "noun.exc").write_text("abaci abacus abacu\n")
    (tmp_path / "index.verb").write_text("  1 licence\nfocus v 1 1\nfocalise v 1\ncombat v 1\n")
    loaded = read_lexicon(spark, str(tmp_path / "verb.exc"), str(tmp_path / "noun.exc"), str(tmp_path / "index.verb"))
    assert loaded.verbs == {"focus", "focalise", "combat"}
    values = ["abode", "abaci", "focused", "combating", "focalising", "unlisted"]
    expected = ["abide", "abacus", "focus", "combat", "focalise", "unlisted"]
    assert apply(spark, values, lambda c: lexical.lemma(c, loaded)) == expected


def test_lexicon_is_bounded():
    with pytest.raises(ValueError):
        lexical.Lexicon(verbs=frozenset(str(i) for i in range(60_000)))


def test_word_lists(spark, tmp_path):
    (tmp_path / "english").write_text("the\nand\nthe\n\n")
    (tmp_path / "french").write_text("le\n")
    rows = {tuple(row) for row in word_lists(spark, str(tmp_path)).collect()}
    assert rows == {("english", "the"), ("english", "and"), ("french", "le")}
    assert word_lists(spark).filter("lang = 'en'").count() == 179


def test_language_score(spark):
    lists = {"aa": ["x", "y"], "bb": ["y", "z"], "cc": ["q"]}
    values = ["x x x x x", "y", "z z", "none", ""]
    rows = apply(spark, values, lambda c: language.language_score(c, lists))
    assert [row["lang"] for row in rows] == ["aa", "aa", "bb", None, None]
    assert [row["score"] for row in rows] == [32 / 34, 2 / 5, 4 / 6, 0.0, 0.0]
    assert apply(spark, values, lambda c: language.detect_lang(c, lists)) == ["aa", "NA", "NA", "NA", "NA"]
    assert apply(spark, values, lambda c: language.detect_lang(c, lists, 0.6)) == ["aa", "NA", "bb", "NA", "NA"]


def test_language_of_long_text(spark):
    text_value = "the cat and the dog " * 2000
    assert apply(spark, [text_value], lambda c: language.detect_lang(c, language.built_in_stop_words())) == ["en"]


MARKED_WORD = rf"(?<![^{text.SPACE}\p{{Nd}}])[a-z]{{3,}}(?![^{text.SPACE}\p{{Nd}}])"


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abcABC12.,'@/:-_\n\x1c\x85 \u00e9\u0660\U0001d7ce\U0001f600", max_size=40), min_size=30, max_size=30))
def test_feature_words_without_blanking_marks(spark, values):
    """The words are those found after marks and digits are blanked, without that pass over the text."""
    blanked = F.regexp_extract_all(text._without_marks(F.col("s")), F.lit(MARKED_WORD), 0)
    rows = spark.createDataFrame([(v,) for v in values], "s string").select(text.feature_words(F.col("s")).alias("words"), blanked.alias("expected"))
    assert all(r.words == r.expected for r in rows.collect())
    assert "translate" not in rows.select("words")._jdf.queryExecution().optimizedPlan().toString()


def test_only_inflected_words_meet_rules(spark):
    plan = spark.range(1).select(lexical.lemmatize(F.array(F.col("id").cast("string"))))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("EndsWith" if "EndsWith" in plan else "endswith") < plan.index("men$") and plan.count("(?:ss|us|is)$") == 0

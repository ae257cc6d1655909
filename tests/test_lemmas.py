"""Lemmas against a list written down by hand, and lookup by tables of any size."""

import pytest
from pyspark.sql import functions as F

from galley.functions import lexical
from galley.functions.words import IRREGULAR_NOUNS, IRREGULAR_VERBS
from galley.operators import lemmas
from galley.sources.word_lists import lemma_exceptions, write_exceptions

# "form lemma", by common dictionaries; shared with no table of the library.
EXPECTED = """
controlled control; controlling control; travelled travel; travelling travel; cancelled cancel; modelling model; labelled label;
signalled signal; propelled propel; compelling compel; expelled expel; patrolled patrol; rebelled rebel; counselling counsel;
quarrelled quarrel; called call; filled fill; pulling pull; selling sell; killed kill; rolled roll; installed install;
enrolled enroll; recalled recall; fulfilled fulfill; lenses lens; does do; staves staff; leaves leaf; swum swim; strove strive;
striven strive; sewn sew; mown mow; forsook forsake; overran overrun; withheld withhold; foresaw foresee; undergone undergo;
bound bind; has have; was be; were be; is be; companies company; markets market; children child; women woman; policemen policeman;
went go; taken take; wrote write; making make; hoping hope; hopped hop; planned plan; running run; stopped stop; announced announce;
created create; managing manage; provided provide; studied study; studies study; tried try; dying die; lying lie; agreed agree;
boxes box; churches church; dishes dish; classes class; buzzes buzz; heroes hero; potatoes potato; shoes shoe; horses horse;
houses house; buses bus; analyses analysis; crises crisis; criteria criterion; phenomena phenomenon; mice mouse; feet foot;
teeth tooth; geese goose; wolves wolf; knives knife; lives life; shelves shelf; thieves thief; news news; series series;
species species; physics physics; politics politics; bus bus; glass glass; virus virus; analysis analysis; gas gas; lens lens;
evening evening; morning morning; building build; king king; thing thing; spring spring; red red; hundred hundred; need need;
moved move; used use; caused cause; closed close; raised raise; served serve; argued argue; continued continue; valued value;
wanted want; started start; needed need; opened open; visited visit; offered offer; happened happen; reported report;
played play; stayed stay; enjoyed enjoy; buying buy; showed show; growing grow; walking walk; asked ask; looked look; passed pass;
added add; kissed kiss; missing miss; sitting sit; getting get; beginning begin; admitted admit; referred refer; occurred occur;
bigger bigger; quick quick; useful useful; nation nation; oil oil; people people; family family; day day; days day; years year;
cities city; parties party; boys boy; keys key; eyes eye; prices price; changes change; offices office; ideas idea; videos video;
caught catch; bought buy; thought think; brought bring; taught teach; sold sell; told tell; made make; said say; led lead;
flew fly; grown grow; driven drive; broken break; chosen choose; stolen steal; swore swear; wept weep; underwent undergo
"""
PAIRS = [pair.split() for pair in EXPECTED.replace("\n", " ").split(";")]
assert len(PAIRS) >= 150


def test_expected_lemmas(spark):
    frame = spark.createDataFrame([(form,) for form, _ in PAIRS], "word string")
    found = {r.word: r.lemma for r in frame.select("word", lexical.lemma(F.col("word")).alias("lemma")).collect()}
    wrong = {form: found[form] for form, lemma in PAIRS if found[form] != lemma}
    assert wrong == {}


def table_of(spark, tmp_path):
    parts = []
    for pos, entries in (("v", IRREGULAR_VERBS), ("n", IRREGULAR_NOUNS)):
        write_exceptions(spark, entries, str(tmp_path / f"{pos}.exc"))
        parts.append(lemma_exceptions(spark, str(tmp_path / f"{pos}.exc"), pos))
    return parts[0].union(parts[1])


def test_table_gives_the_lemmas_of_the_rules(spark, tmp_path):
    words = [form for form, _ in PAIRS] + ["the", "quickly", "although"]
    frame = spark.createDataFrame([(1, words), (2, words[::-1]), (2, words[::-1]), (3, []), (4, None), (5, ["went"] * 500)], "id int, words array<string>")
    found = lemmas.lemmatize_by_table(frame.repartition(3), F.col("words"), table_of(spark, tmp_path)).collect()
    expected = {r.id: r.l for r in frame.select("id", F.array_join(lexical.lemmatize(F.col("words")), " ").alias("l")).collect()}
    assert len(found) == 6
    for r in found:
        assert r.lemmas == (expected[r.id] or "")


def test_table_larger_than_plan_literals(spark):
    n = 120_000
    table = spark.range(n).select(F.lit("n").alias("pos"), F.concat(F.lit("formx"), "id").alias("form"), F.concat(F.lit("lemma"), "id").alias("lemma"))
    frame = spark.range(0, n, 1000).select(F.array(F.concat(F.lit("formx"), "id"), F.lit("cities")).alias("words"), "id")
    found = lemmas.lemmatize_by_table(frame, F.col("words"), table).collect()
    assert {r.lemmas for r in found} == {f"lemma{i} city" for i in range(0, n, 1000)}
    assert lemmas.lemmatize_by_table(frame.where("false"), F.col("words"), table).collect() == []


@pytest.mark.parametrize("indexed", [False, True])
def test_verb_index(spark, indexed):
    table = spark.createDataFrame([("v", "abode", "abide"), ("n", "abaci", "abacus"), ("n", "abaci", "zz")], "pos string, form string, lemma string")
    verbs = spark.createDataFrame([("focus",), ("combat",), ("combat",)], "word string") if indexed else None
    words = spark.createDataFrame([("abode",), ("abaci",), ("combating",), ("unlisted",)], "word string")
    found = {r.word: r.lemma for r in lemmas.word_lemmas(words, table, verbs).collect()}
    assert found == {"abode": "abide", "abaci": "abacus", "combating": "combat" if indexed else "combate", "unlisted": "unlisted" if indexed else "unlist"}

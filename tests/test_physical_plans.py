"""The shape of physical plans that matters at scale."""

import re

import pytest
from pyspark.sql import functions as F

from galley.functions.text import feature_words
from galley.operators import features, filters, history, profile, skew
from galley.plans import scoring
from galley.plans.normalize import normalize

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return re.findall(r"Exchange (\w+)", physical(frame))


def test_normalization_shuffles_once(documents):
    plan = normalize(documents, "text", ("lang",))
    assert shuffles(plan) == ["hashpartitioning"]
    text = physical(plan)
    assert text.count("HashAggregate") == 2
    assert text.count("regexp_extract_all") == 1
    assert "Python" not in text and "Join" not in text
    assert "ReadSchema: struct<text:string,lang:string>" in text
    assert "IsNotNull(text)" in text


def test_topic_filter_is_pushed_down(documents):
    assert "EqualTo(lang,en)" in physical(filters.in_language(documents, "en"))


def test_null_counts_scan_once(documents):
    plan = physical(profile.null_value_count(documents.drop("text")))
    assert plan.count("FileScan") == 1
    assert "text" not in re.search(r"ReadSchema: \S+", plan).group()


def test_top_values_keep_no_full_sort(documents):
    assert "TakeOrderedAndProject" in physical(profile.top_values(documents, "source", 5))


def test_vocabulary_shuffles_partial_counts(documents):
    plan = features.vocabulary_counts(documents.select(feature_words(F.col("text")).alias("words")), "words")
    assert shuffles(plan) == ["hashpartitioning"]
    assert "partial_sum" in physical(plan)


def test_pages_move_once(spark):
    """One exchange carries the sources; the comparison with the history and the choice of copies see keys only."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    known = pages.select("url").limit(3)
    chosen = scoring.pages_to_score(pages, known)
    expected = pages.select("url").distinct().count() - 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = chosen._jdf.queryExecution().executedPlan().toString()
        tree = chosen._jdf.queryExecution().executedPlan()
        wide = [line for line in exchanged(tree) if "html" in line]
        assert len(wide) == 1, wide
        assert "partial_min(_hash" in text and "LeftAnti" in text and "min(html" not in text
        assert chosen.count() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def exchanged(plan):
    """Columns that each shuffle of a plan moves."""
    own = [plan.output().mkString(",")] if plan.nodeName() == "Exchange" else []
    children = plan.children()
    return own + [line for i in range(children.length()) for line in exchanged(children.apply(i))]


def test_history_reads_the_buckets_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "history")
    history.create_history(spark, path, buckets=32)
    at = F.lit("2024-01-01").cast("timestamp").alias("predicted_at")
    rows = spark.range(500).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("World").alias("category"), at, F.lit("s").alias("summary"))
    history.append_history(rows, path, "first")
    asked = spark.createDataFrame([("u7",), ("u7",), ("new",)], "url string")
    near = history.known_rows(asked, path)
    plan = physical(near)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and "PushedFilters" in plan
    buckets = {re.search(r"bucket=(\d+)", file).group(1) for file in near.inputFiles() if "bucket=" in file}
    read = {r.bucket for r in near.select("bucket").distinct().collect()}
    assert len(read) <= 2 < len(buckets) or len(buckets) <= 2
    assert [r.url for r in history.already_predicted(asked, near).distinct().collect()] == ["u7"]


def test_exact_profile_has_no_percentile(documents):
    frame = profile.profile(documents, exact=True)
    assert not re.search("percentile|Expand", physical(frame))


def test_hot_urls_can_be_split(spark):
    """The lookup of raw requests joins sorted shuffle outputs directly, which adaptive execution can split."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("url", "page_id")
    for join in (history.already_predicted, history.not_yet_predicted):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = physical(join(pages, pages.select("url").limit(3).union(pages.select("url"))))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" in plan and "HashAggregate" not in plan


def test_frequent_terms_join_without_a_shuffle(spark, documents, monkeypatch):
    """Terms with many rows meet a broadcast, the others one sorted join; the result is that of one join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = physical(features.tf_idf(documents, "doc_id", feature_words(F.col("text"))))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") >= 2
    found = []
    for parts in (1, 64, 1 << 40):
        monkeypatch.setattr(skew, "FREQUENT_PARTS", parts)
        rows = features.tf_idf(documents, "doc_id", feature_words(F.col("text"))).collect()
        found.append(sorted((r.doc_id, r.term, r.tf, r.df) for r in rows))
    assert found[0] == found[1] == found[2] and found[0]

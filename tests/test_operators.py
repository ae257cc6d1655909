from datetime import datetime

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from galley import schemas
from galley.functions import records
from galley.operators import features, filters, history, metrics, profile, skew, terms
from galley.session import evaluate_once, materialize
from galley.sources import articles, sinks


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text('Topic,Title,Summary\nWorld,"A ""quoted"" title","one,\ntwo ""x"""\nSports,,\n')
    frame = articles.read_articles(spark, str(path))
    found = [tuple(row) for row in frame.orderBy("topic").collect()]
    assert found == [("Sports", None, None, None), ("World", 'A "quoted" title', 'one,\ntwo "x"', None)]
    assert schemas.LABELLED_ARTICLE.fieldNames() == ["topic", "title", "summary"]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("Summary,id,TOPIC,Title\ns,1,World,t\n")
    assert rows(articles.read_articles(spark, str(path))) == [("World", "t", "s", None)]


def test_csv_columns_of_each_file(spark, tmp_path):
    """Every file has a header of its own; a file without a column is an error."""
    (tmp_path / "a b.csv").write_text("Topic,Title,Summary\nSports,t1,s1\n")
    (tmp_path / "b.csv").write_text('Summary,"Topic",Title\ns2,World,t2\n"s, 3",World,t3\n')
    found = rows(articles.read_articles(spark, str(tmp_path)))
    assert found == [("Sports", "t1", "s1", None), ("World", "t2", "s2", None), ("World", "t3", "s, 3", None)]
    (tmp_path / "c.csv").write_text("Topic,Text\nWorld,t\n")
    with pytest.raises(ValueError, match="summary.*title"):
        articles.read_articles(spark, str(tmp_path))


def test_vocabulary_is_not_cut(spark):
    frame = spark.range(300_000).select(F.array(F.concat(F.lit("t"), "id")).alias("words"))
    words, vectors = terms.term_vectors(frame, "words")
    found = words.agg(F.count("*"), F.count_distinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(found) == (300_000, 300_000, 0, 299_999)
    assert vectors.select(F.inline("features")).count() == 300_000


def test_csv_keeps_corrupt_rows(spark, tmp_path):
    path = tmp_path / "summaries.csv"
    path.write_text("summary\nfine\na,b,c\n")
    frame = articles.read_summaries(spark, str(path)).cache()
    assert frame.filter("_corrupt_record IS NOT NULL").count() == 1


def test_rss(spark, tmp_path):
    path = tmp_path / "feed.xml"
    path.write_text(
        "<rss><channel><item><title>T</title><description>D &amp; d</description><link>http://l</link>"
        "<pubDate>Mon, 01 Nov 2021 10:00:00 GMT</pubDate></item></channel></rss>"
    )
    assert rows(articles.read_rss(spark, str(path))) == [("T", "Mon, 01 Nov 2021 10:00:00 GMT", "D & d", "news", "http://l")]


def test_strings_become_articles(spark):
    assert rows(articles.articles_from_strings(spark, ["b", "a"])) == [("a",), ("b",)]


def test_dates(spark):
    frame = spark.createDataFrame(
        [("2021-11-01 10:00:00",), ("Mon, 01 Nov 2021 10:00:00 GMT",), ("soon",), (None,)], "d string"
    )
    parsed = [row[0] for row in frame.select(records.parse_published(F.col("d"))).collect()]
    assert parsed == [datetime(2021, 11, 1, 10), datetime(2021, 11, 1, 10), None, None]


def test_decode(spark):
    frame = spark.createDataFrame([("news", '{"title":"t"}'), ("news", "not json"), ("news", "[1]")], "topic string, value string")
    decoded = records.decode_records(frame)
    assert [row["is_valid"] for row in decoded.collect()] == [True, False, False]
    assert tuple(decoded.collect()[0]["record"]) == ("t", None, None, None, None)


def test_routing(spark, tmp_path):
    frame = spark.createDataFrame([("news", 1), ("tech", 2), ("sport", 3)], "topic string, n int")
    sinks.publish_by_topic(frame, ["news", "tech", "business"], str(tmp_path / "out"))
    sinks.append_collection(frame, str(tmp_path / "all"))
    assert rows(spark.read.text(str(tmp_path / "out")).select("topic")) == [("news",), ("tech",)]
    assert spark.read.parquet(str(tmp_path / "all")).count() == 3


def test_nulls_and_profile(spark):
    frame = spark.createDataFrame([(None, "a"), (None, "b"), ("x", "b")], "title string, topic string")
    assert rows(profile.null_value_count(frame)) == [("title", 2)]
    assert rows(profile.drop_null_rows(frame)) == [("x", "b")]
    report = {row["column_name"]: row for row in profile.profile(frame).collect()}
    assert (report["title"]["nulls"], report["topic"]["distinct"], report["topic"]["max"]) == (2, 2, "b")


def test_null_filter_reaches_the_scan(spark, tmp_path, capsys):
    spark.range(3).selectExpr("cast(id AS string) AS a", "id AS b").write.parquet(str(tmp_path / "t"))
    profile.drop_null_rows(spark.read.parquet(str(tmp_path / "t")), ["a"]).explain()
    assert "PushedFilters: [IsNotNull(a)]" in capsys.readouterr().out


def test_distinct_texts(spark):
    frame = spark.createDataFrame([("x", "Sports"), ("x", "Sports"), ("x", "World")], "t string, topic string")
    assert filters.distinct_texts(frame, ["t", "topic"]).count() == 2


def test_request_status(spark):
    frame = spark.createDataFrame([("u", "t"), ("", "t"), ("u", ""), ("u", None), (None, "t")], "u string, t string")
    found = [row[0] for row in frame.select(filters.request_status(F.col("u"), F.col("t"))).collect()]
    assert found == ["valid"] + ["invalid"] * 4


def test_history(spark, tmp_path):
    path = str(tmp_path / "history")
    history.create_history(spark, path)
    at = datetime(2024, 1, 1)
    later = datetime(2024, 1, 2)
    history.append_history(spark.createDataFrame([("b", "World", at, "s")], schemas.HISTORY), path)
    batch = [("a", "World", later, "s"), ("a", "Sports", at, "s"), ("b", "Sports", at, "s")]
    for _ in range(2):
        history.append_history(spark.createDataFrame(batch, schemas.HISTORY), path)
    stored = history.stored_history(spark, path)
    assert rows(stored.select("url", "category")) == [("a", "Sports"), ("b", "World")]
    asked = spark.createDataFrame([("a",), ("a",), ("c",)], "url string")
    assert rows(history.cached_predictions(asked, stored)) == [("a", "Sports")]
    assert rows(history.not_yet_predicted(asked, stored)) == [("c",)]
    assert rows(history.already_predicted(asked, stored)) == [("a",), ("a",)]


def test_newer_than_last_training(spark, tmp_path):
    log = str(tmp_path / "log")
    stored = spark.createDataFrame([("a", "x", datetime(2024, 1, d), "s") for d in (1, 2, 3)], schemas.HISTORY)
    empty = spark.createDataFrame([], schemas.RETRAIN_LOG)
    assert history.newer_than_last_training(stored, empty).count() == 3
    history.log_retrain(spark, log, datetime(2023, 1, 1))
    history.log_retrain(spark, log, datetime(2024, 1, 2))
    trained = spark.read.schema(schemas.RETRAIN_LOG).parquet(log)
    assert history.newer_than_last_training(stored, trained).count() == 2
    history.log_retrain(spark, log)
    assert history.newer_than_last_training(stored, spark.read.schema(schemas.RETRAIN_LOG).parquet(log)).count() == 0


def test_label_index(spark):
    topics = ["Business"] * 3 + ["World"] * 2 + ["Sports"] * 2
    frame = spark.createDataFrame([(t,) for t in topics], "topic string")
    assert rows(features.index_labels(frame).distinct()) == [("Business", 0.0), ("Sports", 1.0), ("World", 2.0)]


def test_report(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    report = {row["class"]: row for row in metrics.classification_report(frame).collect()}
    assert tuple(report["0.0"])[1:] == pytest.approx((1, 0.5, 2 / 3, 2))
    assert tuple(report["1.0"])[1:] == pytest.approx((2 / 3, 1, 0.8, 2))
    assert report["accuracy"]["f1"] == 0.75
    assert report["macro avg"]["f1"] == pytest.approx(11 / 15)
    assert report["weighted avg"]["f1"] == pytest.approx(11 / 15)
    scores = metrics.f1_and_test_error(frame).first()
    assert scores["f1"] == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(frame))
    assert scores["test_error"] == pytest.approx(4 / 15)
    assert rows(metrics.confusion_matrix(frame)) == [(0.0, 1, 1), (1.0, 0, 2)]


def test_split_is_stable(spark):
    frame = spark.range(500).selectExpr("cast(id AS string) AS k")
    train, test = features.split(frame, F.col("k"))
    assert rows(train.union(test)) == rows(frame)
    assert rows(features.split(frame.repartition(7), F.col("k"))[0]) == rows(train)
    assert 350 < train.count() < 450


@pytest.mark.parametrize("parts", [1, 3, 16, 1 << 40])
def test_tf_idf_with_hot_terms(spark, monkeypatch, parts):
    """The result does not depend on which terms count as frequent."""
    monkeypatch.setattr(skew, "FREQUENT_PARTS", parts)
    documents = [(i, ["the", "the", f"w{i % 7}", *(["rare"] if i < 2 else [])]) for i in range(60)]
    frame = spark.createDataFrame(documents, "id int, tokens array<string>")
    found = {(r["id"], r["term"]): r["tf_idf"] for r in features.tf_idf(frame, "id", F.col("tokens")).collect()}
    import math
    from collections import Counter
    df = Counter(t for _, tokens in documents for t in set(tokens))
    expected = {
        (i, t): n * (math.log(61 / (df[t] + 1)) if df[t] >= 3 else 0.0)
        for i, tokens in documents for t, n in Counter(tokens).items()
    }
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_row_term_counts(spark):
    frame = spark.createDataFrame([(["b", "a", "b", "b"],), (["x"],), ([],), (None,)], "t array<string>")
    found = [row[0] for row in frame.select(features.row_term_counts(F.col("t"))).collect()]
    assert [[tuple(e) for e in row] if row is not None else None for row in found] == [
        [("a", 1), ("b", 3)], [("x", 1)], None, None
    ]
    assert frame.select(F.inline(features.row_term_counts(F.col("t")))).count() == 3


def test_costly_columns_are_computed_once(spark, capsys):
    frame = spark.range(5).selectExpr("cast(id AS string) AS s")
    marked = evaluate_once(frame, t=F.regexp_replace("s", "3", "")).filter("t <> ''")
    marked.explain()
    assert capsys.readouterr().out.count("regexp_replace") == 1
    assert marked.count() == 4


def test_materialize_keeps_rows_and_cuts_the_plan(spark, capsys):
    copy = materialize(spark.range(5).withColumn("x", F.col("id") + 1), "copy")
    copy.explain()
    assert "FileScan parquet" in capsys.readouterr().out
    assert copy.count() == 5


def test_terms_of_a_row_are_counted_by_batch(spark):
    rows = [["b", "a", "b", "\u00e9", ""], [], None, ["a"], ["a"] * 3]
    counted = spark.createDataFrame(list(enumerate(rows)), "i int, w array<string>").select("i", F.inline(features.row_term_counts("w")))
    expected = sorted((i, term, row.count(term)) for i, row in enumerate(rows) if row for term in set(row))
    assert sorted(tuple(r) for r in counted.collect()) == expected
    assert "array_sort" not in counted._jdf.queryExecution().toString() and "sort_array" not in counted._jdf.queryExecution().toString()

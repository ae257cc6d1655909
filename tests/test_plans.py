from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from galley import schemas
from galley.operators import history
from galley.plans import model, scoring, tuning
from galley.plans.normalize import normalize, normalize_for_prediction
from galley.sources import articles
from galley.streaming import ingest, landing

WORDS = {"Sports": "match goal coach league", "World": "treaty border summit envoy", "Science": "quasar enzyme robot gene"}


@pytest.fixture(scope="module")
def labelled(spark):
    """Separable classes of unequal size, with a word all of them share."""
    texts = []
    for size, (topic, words) in zip((60, 50, 40), WORDS.items()):
        parts = words.split()
        texts += [(topic, f"report {parts[i % 4]} {parts[(i + 1) % 4]} number {'abcdefghij'[i % 10] * 3}") for i in range(size)]
    return spark.createDataFrame(texts, "topic string, summary string")


@pytest.fixture(scope="module")
def trained(labelled, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "m")
    return model.train(normalize(labelled, lang=None), path, num_features=4096), path


def test_default_chain(spark):
    frame = spark.createDataFrame([
        ("A", "The companies were quickly announcing 5 new products, and all of the other managers left for the meeting with us."),
        ("A", "The companies were quickly announcing 6 new products, and all of the other managers left for the meeting with us!"),
        ("B", "The companies were quickly announcing 5 new products, and all of the other managers left for the meeting with us."),
        ("A", "la maison est dans le jardin avec les enfants et nous sommes contents"),
        ("A", None), (None, "the cat is on the mat and it is not for us"), ("A", "and the of it is not for us"),
    ], "topic string, summary string")
    expected = "company announce new product manager leave meet"
    assert sorted(map(tuple, normalize(frame).collect())) == [("A", expected), ("B", expected)]
    assert sorted(map(tuple, normalize_for_prediction(frame).collect())) == [("cat mat",), (expected,)]


def test_compat_chain(spark):
    frame = spark.createDataFrame([("A", "The cats and la maison"), ("A", "and the")], "topic string, summary string")
    found = sorted(map(tuple, normalize(frame, compat=True).collect()))
    assert found == [("A", ""), ("A", "the cat maison")]


def test_training_beats_the_majority_class(trained):
    fitted, _ = trained
    scores = fitted.scores.first()
    assert scores["accuracy"] > 0.8
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    assert scores["f1"] == pytest.approx(evaluator.evaluate(fitted.predictions))
    support = {r["class"]: r["support"] for r in fitted.report.collect()}
    assert sum(support[t] for t in WORDS if t in support) == fitted.predictions.count() == support["accuracy"]
    assert fitted.predictions.filter("label = prediction").count() == fitted.predictions.filter("topic = category").count()


def test_saved_model_scores_the_same(trained, labelled):
    fitted, path = trained
    rows = normalize(labelled, lang=None)
    first = sorted(map(tuple, model.score(rows, fitted.model).collect()))
    assert sorted(map(tuple, model.score(rows, model.load_model(path)).collect())) == first
    without_topic = model.score(rows.select("lemm_summary"), model.load_model(path))
    assert set(without_topic.columns) == {"lemm_summary", "category", "confidence"}
    assert without_topic.count() == rows.count()


def test_class_sums_give_the_same_model(labelled):
    """Fitting on the sums per class equals fitting on the rows."""
    rows = normalize(labelled, lang=None).repartition(5)
    fitted = model._fit(rows, rows, None, num_features=256)
    featured = PipelineModel(fitted.stages[:-2]).transform(rows)
    assert model.class_sums(featured, 5).count() > 5
    direct = NaiveBayes().fit(featured)
    bayes = fitted.stages[-2]
    assert bayes.pi.toArray() == pytest.approx(direct.pi.toArray())
    assert bayes.theta.toArray() == pytest.approx(direct.theta.toArray())


def test_other_classifiers(labelled):
    rows = normalize(labelled, lang=None)
    forest = model.classifier("random_forest", numTrees=20, maxDepth=8, seed=1)
    assert model.train(rows, estimator=forest, vectorizer="count").scores.first()["accuracy"] > 0.5
    found = tuning.cross_validate(rows, num_features=(8, 2000), folds=2)
    assert found.best == 2000 and found.scores.count() == 4
    with pytest.raises(ValueError):
        model.classifier("other")


def test_retrain_uses_the_history(spark, labelled, tmp_path):
    path = str(tmp_path / "model")
    stored = spark.createDataFrame(
        [(f"u{i}", "Arts", datetime(2024, 1, 1), f"opera theatre painter {'abcdefgh'[i] * 3}") for i in range(8)], schemas.HISTORY
    )
    model.retrain(stored, labelled, path, {"lang": None}, num_features=4096)
    texts = articles.articles_from_strings(spark, ["a painter of opera", "goal of the league"])
    rows = model.score(normalize_for_prediction(texts, lang=None), model.load_model(path))
    assert {r["lemm_summary"]: r["category"] for r in rows.collect()} == {"painter opera": "Arts", "goal league": "Sports"}


def page(words):
    return f"<html><nav>goal goal goal</nav><article><p>{words}</p></article></html>"


@pytest.fixture(scope="module")
def pages(spark):
    """A third of all rows are copies of one URL."""
    hot = [("https://hot", page("treaty border summit"))] * 10
    others = [(f"https://u{i}", page("quasar enzyme robot")) for i in range(18)]
    return spark.createDataFrame([*hot, *others, ("https://none", "<p>x</p>"), ("", page("goal"))], "url string, html string")


def test_batch_scoring(spark, trained, pages, tmp_path):
    fitted, _ = trained
    at = datetime(2024, 5, 1)
    path = str(tmp_path / "history")
    history.create_history(spark, path)
    known = spark.createDataFrame([("https://u0", "Old", at, "s")], schemas.HISTORY)
    history.append_history(known, path)
    predictions = scoring.score_batch(pages, history.stored_history(spark, path), fitted.model, at, lang=None)
    history.append_history(predictions, path)
    found = {r["url"]: r["category"] for r in history.stored_history(spark, path).collect()}
    assert found == {"https://hot": "World", "https://u0": "Old", **{f"https://u{i}": "Science" for i in range(1, 18)}}


def test_stream_scoring_equals_batch(spark, trained, pages, tmp_path):
    fitted, _ = trained
    at = datetime(2024, 5, 1)
    path, source = str(tmp_path / "history"), str(tmp_path / "pages")
    history.create_history(spark, path)
    pages.repartition(3).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema("url string, html string").option("maxFilesPerTrigger", 1).parquet(source)
        landing.score_stream(stream, fitted.model, path, str(tmp_path / "cp"), at, lang=None).awaitTermination()
    empty = spark.createDataFrame([], schemas.HISTORY)
    batch = scoring.score_batch(pages, empty, fitted.model, at, lang=None)
    key = lambda f: sorted(map(tuple, f.select("url", "category", "predicted_at").collect()))
    assert key(history.stored_history(spark, path)) == key(batch.where("status = 'classified'"))


def test_every_request_is_answered(spark, trained):
    """Short texts are classified as well; what gets no class gets a reason."""
    fitted, _ = trained
    requests = [
        ("https://a", page("Goal by coach wins league match")), ("https://a", page("Goal by coach wins league match")),
        ("https://b", page("quasar enzyme")), ("https://c", "<html></html>"), ("https://d", page("it is 5")),
        ("", page("goal")), ("https://e", None),
    ]
    pages = spark.createDataFrame(requests, "url string, html string")
    empty = spark.createDataFrame([], schemas.HISTORY)
    found = {r.url: (r.status, r.category) for r in scoring.score_batch(pages, empty, fitted.model).collect()}
    assert found == {
        "https://a": ("classified", "Sports"), "https://b": ("classified", "Science"), "https://c": ("invalid", None),
        "https://d": ("empty", None), "": ("invalid", None), "https://e": ("invalid", None),
    }
    foreign = scoring.score_batch(pages, empty, fitted.model, lang="fr").where("url = 'https://b'").first()
    assert (foreign.status, foreign.category) == ("foreign", None)


def test_pages_without_address_are_answered(spark, trained):
    fitted, _ = trained
    pages = spark.createDataFrame([(None, page("goal")), (None, page("goal")), ("https://a", page("goal"))], "url string, html string")
    known = spark.createDataFrame([(None, "s", "Sports", None), ("https://b", "s", "Sports", None)], "url string, summary string, category string, at string")
    found = scoring.score_batch(pages, known, fitted.model).collect()
    assert sorted((r.url or "", r.status) for r in found) == [("", "invalid"), ("https://a", "classified")]


def responses(spark, path, numbers, date="2024-01-01 00:00:%02d"):
    made = [([(f"t{n}", date % n if "%" in date else date, "s", "news" if n % 2 else "sport", f"http://l/{n}")] * 2, 2) for n in numbers]
    spark.createDataFrame(made, schemas.API_RESPONSE).coalesce(1).write.mode("append").json(path)


def test_ingest_over_several_runs(spark, tmp_path):
    """Polls overlap and one article arrives over and over; each is stored once across restarts."""
    base = str(tmp_path)
    for numbers in ([1, 2, 3], [3, 4] + [2] * 20, [5]):
        responses(spark, f"{base}/landing", numbers)
        stream = ingest.dedup_articles(ingest.response_stream(spark, f"{base}/landing"))
        ingest.ingest_stream(
            stream, f"{base}/stored", f"{base}/published", ["news"], f"{base}/cp"
        ).awaitTermination()
    stored = sorted(r["source"] for r in spark.read.parquet(f"{base}/stored").collect())
    assert stored == [f"http://l/{n}" for n in range(1, 6)]
    published = landing.decoded(spark.read.text(f"{base}/published"))
    assert sorted(r["source"] for r in published.collect()) == ["http://l/1", "http://l/3", "http://l/5"]


def test_old_and_undated_articles_are_kept(spark, tmp_path):
    base = str(tmp_path)
    for numbers, date in (([1, 2], "2024-01-01 00:00:%02d"), ([7], "someday"), ([8], "1999-01-01 00:00:00")):
        responses(spark, f"{base}/landing", numbers, date)
        stream = ingest.dated(ingest.response_stream(spark, f"{base}/landing"))
        ingest.reject_stream(stream, f"{base}/rejected", f"{base}/cp1").awaitTermination()
        landing.land_stream(ingest.dedup_articles(stream), f"{base}/stored", f"{base}/cp2").awaitTermination()
    assert [r["source"] for r in spark.read.json(f"{base}/rejected").collect()] == ["http://l/7"] * 2
    assert sorted(r["source"][-1] for r in spark.read.parquet(f"{base}/stored").collect()) == ["1", "2", "7", "8"]
    batch = ingest.batch_dedup(ingest.dated(articles.flatten_api_articles(articles.read_api_responses(spark, f"{base}/landing"))))
    assert batch.filter(F.col("published_at").isNotNull()).count() == 3


def test_stream_keeps_the_copy_published_first(spark, tmp_path):
    """Copies arrive over three runs in any order of dates; undated ones give way, and alone they are kept."""
    base = str(tmp_path)
    polls = [("00:00:00", {1: "2024-01-05 00:00:00", 2: "someday", 3: "2024-01-01 00:00:00", 4: "never"}),
             ("00:30:00", {1: "2024-01-02 00:00:00", 2: "2024-01-09 00:00:00", 3: "2024-01-02 00:00:00"}),
             ("01:00:00", {1: "2024-01-03 00:00:00", 5: "1999-01-01 00:00:00"})]
    everything = None
    for time, dates in polls:
        made = [([(f"t{n}", date, "s", "news", f"http://l/{n}")] * 2, 2) for n, date in dates.items()]
        frame = spark.createDataFrame(made, schemas.API_RESPONSE).coalesce(1)
        everything = frame if everything is None else everything.union(frame)
        frame.withColumn("arrived", F.lit(f"2024-03-01 {time}")).write.mode("append").partitionBy("arrived").json(f"{base}/landing")
        stream = ingest.first_published(ingest.dated(ingest.arrival_stream(spark, f"{base}/landing")), gap="2 hours")
        landing.land_stream(stream, f"{base}/stored", f"{base}/cp").awaitTermination()
    closing = spark.createDataFrame([([], 0)], schemas.API_RESPONSE).withColumn("arrived", F.lit("2024-03-01 09:00:00"))
    closing.write.mode("append").partitionBy("arrived").json(f"{base}/landing")
    stream = ingest.first_published(ingest.dated(ingest.arrival_stream(spark, f"{base}/landing")), gap="2 hours")
    landing.land_stream(stream, f"{base}/stored", f"{base}/cp").awaitTermination()
    key = lambda f: sorted((r.source, r.published_date) for r in f.select("source", "published_date").collect())
    expected = key(ingest.batch_dedup(ingest.dated(articles.flatten_api_articles(everything))))
    assert key(spark.read.parquet(f"{base}/stored")) == expected
    assert dict(expected)["http://l/1"] == "2024-01-02 00:00:00" and dict(expected)["http://l/2"] == "2024-01-09 00:00:00"


def test_landing_resumes_from_its_checkpoint(spark, tmp_path):
    base = str(tmp_path)
    for value in ('{"title":"a","topic":"news"}', "broken", '{"title":"b","topic":"news"}'):
        spark.createDataFrame([("news", value)], schemas.BROKER_RECORD).write.mode("append").parquet(f"{base}/topic")
        stream = articles.read_article_stream(spark, "parquet", schemas.BROKER_RECORD, path=f"{base}/topic")
        landing.land_stream(landing.decoded(stream), f"{base}/landed", f"{base}/cp1").awaitTermination()
        landing.land_stream(landing.rejected(stream), f"{base}/rejects", f"{base}/cp2").awaitTermination()
    assert sorted(r["title"] for r in spark.read.parquet(f"{base}/landed").collect()) == ["a", "b"]
    assert [r["value"] for r in spark.read.parquet(f"{base}/rejects").collect()] == ["broken"]


def test_copies_of_one_file_leave_one_survivor(spark, tmp_path):
    """Only one copy of those that a task reads goes on to the second step of the deduplication."""
    base = str(tmp_path)
    responses(spark, f"{base}/landing", range(1, 31))
    stream = ingest.dedup_articles(ingest.response_stream(spark, f"{base}/landing"))
    query = ingest.ingest_stream(stream, f"{base}/stored", f"{base}/published", ["news"], f"{base}/cp")
    query.awaitTermination()
    kept = [sum(p["stateOperators"][i]["numRowsUpdated"] for p in map(dict, query.recentProgress)) for i in range(2)]
    assert kept == [30, 30]

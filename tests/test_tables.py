"""Term tables, the model's state, stored batches, exact profiles and cross-validation."""

import math
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from galley import schemas
from galley.operators import history, profile, sketches, skew, terms
from galley.plans import model, term_model, tuning
from galley.sources.batches import append_batch, committed, read_batches

AT = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def articles(spark):
    """Articles of three classes with shared words; one word stands in all of them."""
    rng = np.random.default_rng(7)
    words = {"A": "goal match coach", "B": "treaty border envoy", "C": "robot gene quasar"}
    rows = []
    for i in range(240):
        topic = "AAABBC"[i % 6]
        own = list(rng.choice(words[topic].split(), 3))
        other = list(rng.choice(" ".join(words.values()).split(), 2))
        rows.append((topic, " ".join(["said", *own, *other, f"w{rng.integers(60)}"])))
    return spark.createDataFrame(rows, "topic string, lemm_summary string").distinct().cache()


# --- terms


def test_dictionary_numbers_by_frequency(spark, monkeypatch):
    rng = np.random.default_rng(1)
    docs = [(i, [f"t{k}" for k in rng.zipf(1.4, 20) % 500]) for i in range(300)]
    frame = spark.createDataFrame(docs, "id long, words array<string>").repartition(6)
    for parts in (1, 16, 1 << 30):
        monkeypatch.setattr(skew, "FREQUENT_PARTS", parts)
        words, vectors = terms.term_vectors(frame, "words", "found", key="id" if parts == 16 else None)
        counts = Counter(w for _, ws in docs for w in ws)
        expected = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda c: (-c[1], c[0])))}
        assert {r.term: r["index"] for r in words.collect()} == expected
        assert {r.term: r.tf for r in words.collect()} == counts
        for r in vectors.collect():
            assert [(e["index"], e.value) for e in r.found] == sorted((expected[w], float(n)) for w, n in Counter(r.words).items())


def test_vectors_of_no_tokens(spark):
    frame = spark.createDataFrame([([],), (None,), (["a"],), (["a"],)], "words array<string>")
    words, vectors = terms.term_vectors(frame, "words")
    assert [tuple(r) for r in words.collect()] == [("a", 0, 2, 2)]
    assert sorted(len(r.features) for r in vectors.collect()) == [0, 0, 1, 1]
    words, vectors = terms.term_vectors(frame.where("false"), "words")
    assert words.collect() == [] and vectors.collect() == []
    words, vectors = terms.term_vectors(frame, "words", min_df=3)
    assert words.collect() == [] and all(r.features == [] for r in vectors.collect())


# --- term model


def library_scores(articles):
    """Class and confidence by the library's stages over all terms."""
    indexer = StringIndexer(inputCol="topic", outputCol="label").fit(articles)
    stages = [indexer, Tokenizer(inputCol="lemm_summary", outputCol="words"), CountVectorizer(inputCol="words", outputCol="raw"),
              IDF(inputCol="raw", outputCol="features", minDocFreq=3), NaiveBayes()]
    scored = Pipeline(stages=stages).fit(articles).transform(articles)
    rows = scored.select("topic", "lemm_summary", "prediction", F.array_max(vector_to_array("probability")).alias("p")).collect()
    return {(r.topic, r.lemm_summary): (indexer.labels[int(r.prediction)], r.p) for r in rows}


def test_model_equals_the_library(articles):
    fitted = term_model.fit_once(articles)
    expected = library_scores(articles)
    for r in term_model.score(articles, fitted).collect():
        category, confidence = expected[r.topic, r.lemm_summary]
        assert (r.category, r.confidence) == (category, pytest.approx(confidence, abs=1e-9))


def test_increments_add_up_to_the_whole(spark, articles, tmp_path):
    """Two overlapping increments, one of them repeated, give the model of one fit."""
    path = str(tmp_path / "state")
    part = F.pmod(F.xxhash64("lemm_summary"), F.lit(10))
    first, second = articles.where(part < 6), articles.where(part >= 4)
    term_model.add_articles(first.union(first), path, "one")
    for _ in range(2):
        term_model.add_articles(second, path, "two")
    term_model.add_articles(articles, path)
    whole, grown = term_model.fit_once(articles), term_model.fit(spark, path)
    term_model.merge_batches(spark, path, str(tmp_path / "merged"))
    merged = term_model.fit(spark, str(tmp_path / "merged"))
    weights = lambda m: {r.term: (r.idf, *r.weights) for r in m.terms.collect()}
    for other in (grown, merged):
        assert (other.labels, other.priors) == (whole.labels, whole.priors)
        assert other.bases == pytest.approx(whole.bases)
        found, expected = weights(other), weights(whole)
        assert found.keys() == expected.keys()
        assert all(found[t] == pytest.approx(expected[t]) for t in found)
    assert committed(spark, f"{path}") >= {"one", "two"}


def test_saved_model_and_odd_rows(spark, articles, tmp_path):
    fitted = term_model.fit_once(articles)
    path = str(tmp_path / "model")
    for _ in range(2):
        model.save_model(fitted, path)
    loaded = model.load_model(path)
    odd = spark.createDataFrame([(None, "x"), ("", "x"), ("never seen", "x"), ("GOAL goal  match", "x"), ("goal match", "x"), ("goal match", "x")], "lemm_summary string, term string")
    found, again = (sorted(map(tuple, model.score(odd, m).collect()), key=str) for m in (loaded, fitted))
    assert len(found) == 6 and found == again and all(r[2] == "A" for r in found)
    assert len({r[3] for r in found if r[0] in (None, "", "never seen")}) == 1
    assert model.score(odd.where("false"), fitted).collect() == []
    with pytest.raises(ValueError):
        term_model.fit(spark, str(tmp_path / "nothing"))


def test_no_term_reaches_the_driver(articles):
    """Training and scoring keep weights as a table; the objects on the driver hold one number per class."""
    fitted = term_model.fit_once(articles)
    assert len(fitted.labels) == len(fitted.priors) == len(fitted.bases) == 3
    plan = term_model.score(articles, fitted)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan


# --- batches and the history


def test_batches_become_visible_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("a",), ("b",)], "name string")
    assert read_batches(spark, path, "rows", "name string").collect() == []
    frame.write.parquet(f"{path}/rows/batch=lost")
    assert append_batch({"rows": frame}, path, "one") and not append_batch({"rows": frame.where("false")}, path, "one")
    assert read_batches(spark, path, "rows", "name string").count() == 2
    assert append_batch({"rows": frame.limit(1)}, path, "lost")
    assert read_batches(spark, path, "rows", "name string").count() == 3


def test_interleaved_appends(spark, tmp_path, monkeypatch):
    """Two appends that both looked before either wrote: the URL of both is read once, as the earlier prediction."""
    path = str(tmp_path / "history")
    history.create_history(spark, path, buckets=4)
    rows = lambda *r: spark.createDataFrame(r, schemas.HISTORY)
    later = datetime(2024, 1, 2)
    plain_append, waiting = history.append_batch, []
    monkeypatch.setattr(history, "append_batch", lambda *a: waiting.append(a))
    history.append_history(rows(("a", "World", later, "s"), ("b", "World", later, "s")), path)
    history.append_history(rows(("a", "Sports", AT, "s"), ("c", "Sports", AT, "s")), path)
    for call in waiting:
        plain_append(*call)
    monkeypatch.setattr(history, "append_batch", plain_append)
    history.append_history(rows(("c", "World", later, "s"), (None, None, later, "s")), path)
    found = sorted((r.url, r.category) for r in history.stored_history(spark, path).collect())
    assert found == [("a", "Sports"), ("b", "World"), ("c", "Sports")]
    merged = str(tmp_path / "merged")
    history.merge_history(spark, path, merged)
    assert sorted((r.url, r.category) for r in history.stored_history(spark, merged).collect()) == found
    history.append_history(rows(("c", "World", later, "s"), ("d", "World", later, "s")), merged)
    assert history.stored_history(spark, merged).count() == 4


# --- profiles


def test_exact_profile_against_plain(spark):
    rng = np.random.default_rng(2)
    hot = [7] * 4000 + list(map(int, rng.integers(-50, 50, 3001)))
    rows = [(v if i % 9 else None, float(rng.normal()) if i % 5 else float("nan"), f"v{v}", "x" * (v % 90), [v], None) for i, v in enumerate(hot)]
    frame = spark.createDataFrame(rows, "whole int, part double, name string, long string, list array<int>, none double").repartition(5)
    found = {r.column_name: r for r in profile.profile(frame, exact=True).collect()}
    assert list(found) == frame.columns or set(found) == set(frame.columns)
    whole = sorted(r[0] for r in rows if r[0] is not None)
    assert [found["whole"][q] for q in ("q25", "median", "q75")] == pytest.approx(list(np.quantile(whole, [0.25, 0.5, 0.75])))
    finite = sorted(r[1] for r in rows if not math.isnan(r[1]))
    part = finite + [math.inf] * (len(rows) - len(finite))
    assert found["part"].q25 == pytest.approx(np.quantile(part, 0.25)) and found["part"].median == pytest.approx(np.quantile(part, 0.5))
    for i, name in enumerate(frame.columns):
        values = [r[i] for r in rows if r[i] is not None]
        distinct = len({str(v) for v in values})
        assert (found[name].rows, found[name].nulls, found[name].distinct) == (len(rows), len(rows) - len(values), distinct), name
    assert found["none"].median is None and found["name"].median is None


def test_exact_profile_of_few_rows(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (-0.0,), (0.0,)], "x double")
    r = profile.profile(frame, exact=True).first()
    assert (r["distinct"], r.q25, r.median, r.q75) == (3, 0.0, 0.5, 1.25)
    r = profile.profile(frame.where("false"), exact=True).first()
    assert (r["rows"], r["distinct"], r.median) == (0, 0, None)


def test_sketches_merge_over_parts(spark):
    """Sketches of days merge to those of months and of the whole, in any order, as one sketch of the rows."""
    frame = spark.range(20_000).selectExpr(
        "id % 30 AS day", "id % 5 AS month", "id", "cast(id % 777 AS string) AS name", "if(id % 10 = 0, NULL, cast(id AS double)) AS x", "cast('NaN' AS double) AS nan"
    )
    days = sketches.sketched(frame, ["month", "day"])
    months = sketches.merged(days, ["month"])
    for merged in (sketches.merged(days), sketches.merged(months), sketches.sketched(frame.withColumn("one", F.lit(1)), ["one", "day", "month"])):
        found = {r.column_name: r for r in sketches.estimates(sketches.merged(merged)).collect()}
        assert set(found) == {"id", "name", "x", "nan"}
        assert found["id"].rows == 20_000 and found["x"].nulls == 2000
        assert abs(found["id"]["distinct"] - 20_000) < 1200 and abs(found["name"]["distinct"] - 777) < 45
        for q, share in profile.QUARTILES.items():
            assert abs(found["id"][q] / 20_000 - share) < 0.04 and abs(found["x"][q] / 20_000 - share) < 0.04
        assert found["name"].median is None and found["nan"].median is None
    one = sketches.estimates(sketches.merged(months.where("month = 3"))).where("column_name = 'id'").first()
    assert one.rows == 4000 and abs(one["distinct"] - 4000) < 240
    assert sketches.estimates(sketches.merged(sketches.sketched(frame.where("false"), ["day"]))).collect() == []


# --- cross-validation


def test_folds_equal_plain_fits(articles):
    found = tuning.cross_validate(articles, num_features=(16, 300), folds=3)
    rows = articles.select("topic", "lemm_summary", (tuning.hash_number(F.concat_ws("\x1f", "topic", "lemm_summary"), 9) % 3).alias("fold")).collect()
    terms_ = {w for r in rows for w in r.lemm_summary.split()}
    numbers = {w: int(__import__("hashlib").md5(w.encode()).hexdigest()[:8], 16) for w in terms_}
    scores = {(r.num_features, r.fold): r.f1 for r in found.scores.collect()}
    assert scores.keys() == {(n, f) for n in (16, 300) for f in range(3)}
    for (size, fold), f1 in scores.items():
        counts = [(r.topic, r.fold, Counter(numbers[w] % size for w in r.lemm_summary.split())) for r in rows]
        train = [(t, c) for t, f, c in counts if f != fold]
        df = Counter(b for _, c in train for b in c)
        idf = {b: math.log((len(train) + 1) / (n + 1)) if n >= 3 else 0.0 for b, n in df.items()}
        sums, sizes = defaultdict(Counter), Counter(t for t, _ in train)
        for t, c in train:
            for b, n in c.items():
                sums[t][b] += n * idf[b]
        pairs = []
        for t, f, c in counts:
            if f == fold:
                score = {
                    k: math.log(sizes[k] + 1) + sum(n * idf.get(b, 0) * math.log((sums[k][b] + 1) / (sum(sums[k].values()) + size)) for b, n in c.items())
                    for k in sizes
                }
                pairs.append((t, max(score, key=score.get)))
        total = 0
        for k in {t for p in pairs for t in p}:
            hit, said, real = sum(p == (k, k) for p in pairs), sum(p[1] == k for p in pairs), sum(p[0] == k for p in pairs)
            total += real * (2 * hit / (said + real) if hit else 0)
        assert f1 == pytest.approx(total / len(pairs)), (size, fold)


def test_cross_validation_of_odd_input(spark, monkeypatch):
    frame = spark.createDataFrame([("A", "x y"), ("A", "x z"), ("B", "q"), ("A", None), (None, "x")], "topic string, lemm_summary string")
    monkeypatch.setattr(tuning, "BROADCAST_ENTRIES", 0)
    found = tuning.cross_validate(frame, num_features=(8,), folds=5)
    assert found.best == 8 and found.predictions.count() == 3
    assert tuning.cross_validate(frame.where("false"), num_features=(4, 8)).scores.collect() == []

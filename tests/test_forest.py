"""The sparse forest against MLlib's, and its independence of partitions and copies."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from galley.plans import model
from galley.plans.forest import SparseForestClassifier


@pytest.fixture(scope="module")
def rows(spark):
    """Words of three classes with noise; counts go up to 40, past the number of bins."""
    random = np.random.default_rng(5)
    made = []
    for i in range(400):
        label = int(random.choice(3, p=[0.5, 0.3, 0.2]))
        words = [f"w{random.integers(60)}" for _ in range(random.integers(0, 25))]
        made.append((i, float(label), words + [f"c{label}"] * int(random.integers(0, 3)) + ["often"] * int(random.integers(0, 40) * (label + 1) // 3)))
    frame = spark.createDataFrame(made, "id int, label double, words array<string>")
    return HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 18).transform(frame).cache()


def outcome(fitted, rows, digits=9):
    scored = fitted.transform(rows).select("id", "prediction", F.transform(vector_to_array("probability"), lambda p: F.round(p, digits)).alias("p"))
    return sorted((r.id, r.prediction, tuple(r.p)) for r in scored.collect())


@pytest.mark.parametrize("options", [{}, {"impurity": "entropy", "maxDepth": 8, "maxBins": 8}, {"minInstancesPerNode": 20, "minInfoGain": 0.01}])
def test_whole_tree_is_that_of_mllib(spark, rows, options):
    """Without chance (one tree, no bags, all features) both forms give one tree; also on dense, negative values."""
    options = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", **options}
    small = HashingTF(inputCol="words", outputCol="features", numFeatures=64).transform(rows.drop("features"))
    shifted = small.withColumn("features", array_to_vector(F.transform(vector_to_array("features"), lambda v: v - 1)))
    for frame in (small, shifted):
        assert outcome(SparseForestClassifier(**options).fit(frame), frame) == outcome(RandomForestClassifier(**options).fit(frame), frame)


def test_forest_scores_like_that_of_mllib(rows):
    """The random numbers differ, the mean votes hardly: 300 trees, 32 of 1024 buckets by node."""
    hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=1024).transform(rows.drop("features"))
    options = {"numTrees": 300, "seed": 3}
    own, others = (np.array([p for _, _, p in outcome(c(**options).fit(hashed), hashed)]) for c in (SparseForestClassifier, RandomForestClassifier))
    assert np.abs(own - others).mean() < 0.02 and (own.argmax(axis=1) == others.argmax(axis=1)).mean() > 0.9


def test_forest_does_not_depend_on_partitions(rows):
    """MLlib draws by partition, so its forest changes with the number of tasks."""
    forest = model.classifier("random_forest", numTrees=40, seed=2, featureSubsetStrategy="0.3")
    assert outcome(forest.fit(rows.repartition(7)), rows) == outcome(forest.fit(rows.coalesce(1)), rows)


def test_storage_follows_the_entries(spark, rows, monkeypatch):
    """A row is kept as its entries, not as a number for each of 262,144 buckets."""
    from galley.plans import forest as module

    written = {}

    def spy(df, name, keep=module.materialize):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(module, "materialize", spy)
    model.classifier("random_forest", numTrees=5, seed=1).fit(rows)
    entries = rows.select(F.size(F.unwrap_udt("features")["indices"]).alias("n"))
    assert written["forest_bins"].agg(F.sum(F.size("index"))).first()[0] <= entries.agg(F.sum("n")).first()[0]


def test_more_nodes_than_a_pass_counts(rows, monkeypatch):
    from galley.plans import forest as module

    options = {"numTrees": 20, "seed": 4, "featureSubsetStrategy": "2000"}
    whole = outcome(SparseForestClassifier(**options).fit(rows), rows)
    monkeypatch.setattr(module, "PASS_FEATURES", 3 * 2000)
    monkeypatch.setattr(module, "BLOCK_CELLS", 5000)
    assert outcome(SparseForestClassifier(**options).fit(rows), rows) == whole


def test_copies_count_each(spark, rows):
    """Rows that come again weigh more, as in MLlib."""
    options = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 3}
    small = HashingTF(inputCol="words", outputCol="features", numFeatures=64).transform(rows.drop("features"))
    copied = small.union(small.where("label = 2")).union(small.where("label = 2"))
    assert outcome(SparseForestClassifier(**options).fit(copied), small) == outcome(RandomForestClassifier(**options).fit(copied), small)


def test_saved_forest_scores_the_same(spark, rows, tmp_path):
    path = str(tmp_path / "model")
    fitted = Pipeline(stages=[model.classifier("random_forest", numTrees=10, seed=1)]).fit(rows)
    model.save_model(fitted, path)
    assert outcome(model.load_model(path), rows) == outcome(fitted, rows)
    assert isinstance(model.load_model(path), PipelineModel)


def test_options_left_to_mllib_and_no_rows(rows):
    weighted = rows.withColumn("weight", F.lit(2.0))
    assert outcome(SparseForestClassifier(numTrees=2, weightCol="weight", maxDepth=1, seed=1).fit(weighted), rows)
    with pytest.raises(ValueError):
        SparseForestClassifier(numTrees=2).fit(rows.limit(0))

"""Deduplication that returns some columns only: the same copies, without moving the other texts."""

import itertools

import pytest

from galley import registry
from galley.streaming import ingest

DAY = "2024-01-0%d 00:00:00"


@pytest.fixture(scope="module")
def articles(spark):
    """Copies that differ in any of their columns, nulls among them; source a comes over and over."""
    rows = [("t", DAY % 1, "s", "news", "a")] * 50
    for n, (title, date, summary, topic) in enumerate(itertools.product(["t", None], [DAY % 1, DAY % 2, "someday", None], ["s", "r", "", "-", None], ["x", "y"])):
        rows += [(title, date, summary, topic, source) for source in ("a", f"b{n % 3}", f"c{n % 7}", f"d{n}", None if n % 2 else "e")]
    frame = spark.createDataFrame(rows, "title string, published_date string, summary string, topic string, source string")
    return ingest.dated(frame.repartition(6))


@pytest.mark.parametrize("columns", [["source", "title", "topic", "published_at"], ["topic", "title"], ["source", "summary"], ["source"], ["published_at", "published_date"]])
def test_named_columns_are_those_of_the_first_copies(articles, columns):
    key = lambda rows: sorted(map(str, rows))
    whole = ingest.batch_dedup(articles)
    assert whole.columns == ["source", "published_at", "title", "published_date", "summary", "topic"]
    assert key(ingest.batch_dedup(articles, columns=columns).collect()) == key(whole.select(columns).collect())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, f"Title {i}. " + "text " * (i + 1), "en", f"s{i % 3}") for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return path


def test_texts_nobody_asks_for_do_not_move(spark, folder, monkeypatch):
    """The query returns no summary, so none is part of the groups that are shuffled and sorted."""
    grouped = []

    def spy(df, name, keep=ingest.materialize):
        plan = df._jdf.queryExecution().executedPlan().toString()
        grouped.extend(line for line in plan.splitlines() if "Aggregate(" in line or "Exchange " in line)
        return keep(df, name)

    monkeypatch.setattr(ingest, "materialize", spy)
    found = registry.batch_dedup(spark, folder)
    grouped += [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(" in line]
    assert grouped and not any("summary" in line for line in grouped)


def test_responses_are_made_once(spark, folder):
    """The test for empty responses that explode brings reads the finished array."""
    rows = registry.responses_of(registry.copies_of_polls(spark, folder))
    flat = registry.src.flatten_api_articles(rows)
    tests = [line for line in flat._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert not any("split" in line for line in tests)
    assert flat.count() == rows.count() == 40

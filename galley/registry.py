"""Registered queries: every operator applied to the supplied tables.

Articles are ``documents`` (topic = ``lang``), requests and the history are ``pages``, broker
records are ``documents`` and ``events``. Long texts are returned as MD5 digests.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley import schemas
from galley.functions import language, lexical, records, text
from galley.functions.words import BUILT_IN_LANGUAGES, ENGLISH_STOP_WORDS, IRREGULAR_NOUNS, IRREGULAR_VERBS
from galley.operators import features, filters, history, lemmas, metrics, profile, sketches, terms
from galley.plans import explore, model, normalize, scoring, tuning
from galley.session import evaluate_once, materialize, scratch_path
from galley.sources import articles as src
from galley.sources import sinks
from galley.sources.word_lists import lemma_exceptions, word_lists, write_exceptions
from galley.streaming import ingest, landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMP = "yyyy-MM-dd HH:mm:ss"
TRAINED_AT = datetime(2024, 1, 1, 2)
PREDICTED_AT = datetime(2024, 2, 1)
TOPICS = ["en", "fr"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text", "lang")))


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of API articles, one minute apart."""
    minute = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id AS int))")
    return table(spark, sf_dir, "documents").select(
        F.split_part("text", F.lit("."), F.lit(1)).alias("title"),
        F.date_format(minute, STAMP).alias("published_date"),
        F.col("text").alias("summary"),
        F.col("lang").alias("topic"),
        F.concat(F.lit("https://news.example/"), "source", F.lit("/"), "doc_id").alias("link"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.project_article(raw_articles(spark, sf_dir))


def digested(df: DataFrame) -> DataFrame:
    return df.withColumn("summary", F.md5("summary"))


def seen_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history: pages served over TLS, one minute apart, with the language of their path."""
    minute = F.expr("cast(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(page_id AS int)) AS timestamp)")
    return (
        table(spark, sf_dir, "pages")
        .filter(F.col("url").startswith("https://"))
        .select(
            "url",
            F.regexp_extract("url", "/(en|fr|de|es)/", 1).alias("category"),
            minute.alias("predicted_at"),
            F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("summary"),
        )
    )


def requested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, as many without any text, and as many whose text cleans to nothing."""
    pages = table(spark, sf_dir, "pages")
    none = pages.select(F.concat("url", F.lit("&none")).alias("url"), F.lit("<html></html>").alias("html"))
    empty = pages.select(F.concat("url", F.lit("&empty")).alias("url"), F.lit("<article>it is 5</article>").alias("html"))
    return pages.select("url", "html").union(none).union(empty)


def requested_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page asked for twice."""
    return table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))


def stamp(column: str) -> Column:
    return F.date_format(column, STAMP).alias(column)


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the first mentioned name, null in most rows, and the domain of an address."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.nullif(F.regexp_extract("text", "@([A-Za-z0-9_]+)", 1), F.lit("")).alias("mention"),
        F.nullif(F.regexp_extract("text", "@[A-Za-z0-9_]+[.]([a-z]+)", 1), F.lit("")).alias("domain"),
        "lang",
    )


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per article, holding the article once per poll; there are two polls."""
    article = F.struct("title", "published_date", "summary", "topic", "link")
    return raw_articles(spark, sf_dir).select(F.array(article, article).alias("articles"), F.lit(2).cast("bigint").alias("page_size"))


def landed_responses(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "responses")
    api_responses(spark, sf_dir).write.json(path)
    return path


def broker_records(spark: SparkSession, sf_dir: str) -> str:
    """Articles as JSON records, and one truncated, unreadable record per Spanish article."""
    rows = articles(spark, sf_dir)
    value = records.to_record(rows)
    broken = F.when(F.col("topic") == "es", F.substring(value, 1, 20))
    values = F.explode(F.array_compact(F.array(value, broken))).alias("value")
    path = scratch_path(spark, "records")
    rows.select("topic", values).write.parquet(path)
    return path


# Sources


@query
def read_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "articles")
    rows = articles(spark, sf_dir)
    for part, columns in (("topic = 'en'", ["topic", "title", "summary"]), ("topic <> 'en'", ["Summary", "Topic", "Title"])):
        rows.where(part).select(*columns).write.mode("append").options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    return digested(src.read_articles(spark, path).select("topic", "title", "summary"))


@query
def read_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summaries")
    rows = articles(spark, sf_dir).select("summary")
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return digested(src.read_summaries(spark, path).select("summary"))


@query
def read_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "collection")
    articles(spark, sf_dir).write.json(path)
    return digested(src.read_collection(spark, "json", path=path))


@query
def read_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "history")
    seen_pages(spark, sf_dir).write.parquet(path)
    return src.read_history(spark, path).select("url", "category", stamp("predicted_at"), "summary")


@query
def flatten_api_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = src.read_api_responses(spark, landed_responses(spark, sf_dir))
    return digested(src.flatten_api_articles(responses))


@query
def read_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rss")
    raw_articles(spark, sf_dir).select(
        "title", F.col("summary").alias("description"), "link", F.col("published_date").alias("pubDate")
    ).write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    squeezed = {c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")) for c in ("title", "summary")}
    return src.read_rss(spark, path).select(
        "published_date", "topic", "link", squeezed["title"].alias("title"), F.md5(squeezed["summary"]).alias("summary")
    )


@query
def stop_word_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each language found in each word list; the lists have a fixed size."""
    tokens = documents(spark, sf_dir).select(
        "lang", F.explode(F.split(F.lower("text"), language.TOKEN_GAP)).alias("word")
    )
    lists = word_lists(spark).withColumnRenamed("lang", "list_lang")
    counted = tokens.groupBy("lang", "word").agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(lists), "word").groupBy("lang", "list_lang").agg(F.sum("n").alias("hits"))


# Sinks


@query
def append_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "collection")
    rows = articles(spark, sf_dir)
    sinks.append_collection(rows.filter("topic = 'en'"), path)
    sinks.append_collection(rows.filter("topic <> 'en'"), path)
    return digested(src.read_collection(spark, "parquet", path=path))


@query
def publish_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "published")
    sinks.publish_by_topic(articles(spark, sf_dir), TOPICS, path)
    return digested(landing.decoded(spark.read.text(path)))


@query
def write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "article_table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    rows = ingest.dated(articles(spark, sf_dir)).select(
        "title", F.col("published_at").alias("datetime"), "summary", "topic", "source"
    )
    sinks.write_table(rows, name, path=path)
    return digested(spark.table(name).withColumn("datetime", stamp("datetime")))


def stored_pages(spark: SparkSession, sf_dir: str) -> str:
    """A history store that holds the seen pages."""
    path = scratch_path(spark, "history")
    history.create_history(spark, path)
    history.append_history(seen_pages(spark, sf_dir), path)
    return path


@query
def append_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_pages(spark, sf_dir)
    predictions = requested_urls(spark, sf_dir).select(
        "url",
        F.concat(F.lit("attempt "), "attempt").alias("category"),
        F.lit(PREDICTED_AT).alias("predicted_at"),
        F.col("page_id").cast("string").alias("summary"),
    )
    history.append_history(predictions, path)
    return history.stored_history(spark, path).select("url", "category", stamp("predicted_at"), "summary")


# Projections


@query
def project_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(src.project_article(raw_articles(spark, sf_dir)))


@query
def select_title_summary_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(articles(spark, sf_dir).select("title", "summary", "topic"))


@query
def drop_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(articles(spark, sf_dir).drop("Title").select("summary", "topic"))


@query
def derive_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ascii_text = text.strip_non_ascii(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length("text").cast("bigint").alias("n_text"), F.length(ascii_text).cast("bigint").alias("n_ascii")
    ).withColumn("n_dropped", F.col("n_text") - F.col("n_ascii"))


@query
def rename_history_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = seen_pages(spark, sf_dir).select("url", F.col("category").alias("Category"), F.col("summary").alias("Summary"))
    return stored.withColumnsRenamed({"Category": "topic", "Summary": "summary"})


@query
def constant_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_articles(spark, sf_dir).select("link", F.lit("news").alias("topic"))


# Filters and lookups


@query
def topic_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return filters.in_topics(events, ["click", "view", "purchase"], "event_type")


@query
def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.in_language(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "en")


@query
def blank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with something behind their first sentence."""
    rest = F.regexp_replace("text", "^[^.]*[.]", "")
    rows = evaluate_once(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), rest=rest)
    return filters.without_blanks(rows, "rest").select("conv_id", "turn")


@query
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.drop_null_rows(mentions(spark, sf_dir))


@query
def null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.null_rows(mentions(spark, sf_dir), "mention").select("doc_id")


@query
def already_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.already_predicted(requested_urls(spark, sf_dir), seen_pages(spark, sf_dir))


@query
def not_yet_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.not_yet_predicted(requested_urls(spark, sf_dir), seen_pages(spark, sf_dir))


@query
def cached_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.cached_predictions(requested_urls(spark, sf_dir), seen_pages(spark, sf_dir))


@query
def request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of a page after its first address counts as the text of the request."""
    body = F.regexp_extract("text", "@[a-z]+[.]com([^\n]*)", 1)
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", body.alias("body"))
    return rows.select("doc_id", filters.request_status(F.col("source"), F.col("body")).alias("status"))


@query
def newer_than_last_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_path(spark, "retrain_log")
    history.log_retrain(spark, log, TRAINED_AT)
    trained = spark.read.schema(schemas.RETRAIN_LOG).parquet(log)
    return history.newer_than_last_training(seen_pages(spark, sf_dir), trained).select("url", stamp("predicted_at"))


@query
def search_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filters.search_articles(rows, "The Tion", "en", "text").select("doc_id")


# Counts, profiles, order


@query
def null_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_value_count(mentions(spark, sf_dir))


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(table(spark, sf_dir, "documents"))


@query
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.topic_counts(table(spark, sf_dir, "events"), "event_type")


@query
def top_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_values(articles(spark, sf_dir).select("title"), "title", 20)


@query
def average_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.average_label(features.index_labels(articles(spark, sf_dir).select("topic")))


@query
def distinct_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = filters.distinct_texts(table(spark, sf_dir, "documents"), ["text", "lang"])
    return distinct.select("lang", F.md5("text").alias("text"))


def language_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and detected language of every document."""
    guess = language.detect_lang(F.col("text"), language.built_in_stop_words())
    return documents(spark, sf_dir, "text", "lang").select(F.col("lang").alias("label"), guess.alias("prediction"))


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = ["NA", *sorted(["en", *BUILT_IN_LANGUAGES])]
    return metrics.confusion_matrix(language_guesses(spark, sf_dir), classes)


@query
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.classification_report(language_guesses(spark, sf_dir))
    return report.select("class", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


@query
def f1_and_test_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.f1_and_test_error(language_guesses(spark, sf_dir))
    return scores.select(*[F.round(c, 6).alias(c) for c in scores.columns])


@query
def profile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of three tables, one below the other."""
    rounded = [F.round(c, 4).alias(c) for c in ("avg_length", "q25", "median", "q75")]
    reports = [
        profile.profile(table(spark, sf_dir, name), exact=True).select("column_name", "rows", "nulls", "distinct", "min", "max", *rounded)
        for name in ("customer", "lineitem", "documents")
    ]
    return reduce(DataFrame.union, reports)


@query
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(table(spark, sf_dir, "documents"))


@query
def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents profiled by sketches made per source and language and merged, held against the data.

    Distinct values may be 6 % off, and the part of the values up to a quartile 4 points.
    """
    docs = table(spark, sf_dir, "documents")
    stored = materialize(sketches.sketched(docs, ["source", "lang"]), "sketches")
    found = sketches.estimates(sketches.merged(sketches.merged(stored, ["source"])))
    guesses = {row.column_name: row for row in found.collect()}  # a row per column
    checks = []
    for name, row in guesses.items():
        close = F.abs(F.count_distinct(name) - row.distinct) <= 0.06 * F.count_distinct(name)
        ranks = [F.abs(F.avg((F.col(name) <= row[q]).cast("double")) - share) <= 0.04 for q, share in profile.QUARTILES.items() if row[q] is not None]
        checks.append(docs.agg(
            F.lit(name).alias("column_name"), F.lit(row.rows).alias("rows"), F.lit(row.nulls).alias("nulls"), close.alias("distinct_close"),
            reduce(Column.__and__, ranks, F.lit(True)).alias("quartiles_close"),
        ))
    return reduce(DataFrame.union, checks)


@query
def profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_top_values(table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "source", "n_chars"])


@query
def page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = profile.page_sizes(api_responses(spark, sf_dir))
    return sizes.groupBy("page_size", "n_articles").agg(F.count("*").alias("responses"))


@query
def newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.newest_first(seen_pages(spark, sf_dir)).select("url", "category", stamp("predicted_at"))


@query
def newest_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.newest_first(seen_pages(spark, sf_dir), 5).select("url", "category", stamp("predicted_at"))


# Text functions


@query
def blank_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.regexp_replace("text", "^[^.]*[.]", "")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        text.is_blank(rest).cast("int").alias("is_blank"),
        text.is_blank(rest, compat=True).cast("int").alias("is_space"),
    )


@query
def strip_non_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = text.strip_non_ascii(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", F.md5(stripped).alias("text"))


@query
def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = language.built_in_stop_words()
    best = language.language_score(F.col("text"), lists)
    rows = evaluate_once(documents(spark, sf_dir), best=best)
    found = F.when(F.col("best.score") >= 0.9, F.col("best.lang")).otherwise("NA")
    return rows.select("doc_id", "lang", found.alias("found"), F.round("best.score", 6).alias("score"))


@query
def text_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cleaning step alone, on page sources behind their address."""
    raw = F.concat(F.lit("See "), "url", F.lit(" by @"), F.regexp_replace("url", "^https?://", ""), F.lit(" "), "html")
    pages = table(spark, sf_dir, "pages").select("page_id", raw.alias("raw"))
    column = F.col("raw")
    return pages.select(
        "page_id",
        F.md5(F.lower(column)).alias("lowered"),
        F.md5(text.remove_urls(column)).alias("no_urls"),
        F.md5(text.remove_mentions(column)).alias("no_mentions"),
        F.md5(text.remove_punctuation(column)).alias("no_punctuation"),
        F.md5(text.remove_number_words(column)).alias("no_numbers"),
        F.md5(text.remove_features(column)).alias("features"),
    )


@query
def remove_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id",
        F.md5(text.remove_features(F.col("text"))).alias("features"),
        F.md5(text.remove_features(F.col("text"), compat=True)).alias("features_compat"),
    )


@query
def remove_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = text.remove_stop_words(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", F.md5(kept).alias("text"))


@query
def pos_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct feature words with their tag and lemma."""
    words = documents(spark, sf_dir).select(F.explode(text.feature_words(F.col("text"))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.select("word", "n", lexical.pos_tag(F.col("word")).alias("tag"), lexical.lemma(F.col("word")).alias("lemma"))


@query
def keep_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lexical.keep_pos(text.split_words(F.lower("text")))
    return documents(spark, sf_dir).select("doc_id", F.md5(F.array_join(kept, " ")).alias("text"))


@query
def lemmatize(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.lemmatize(text.feature_words(F.col("text")))
    return documents(spark, sf_dir).select("doc_id", F.md5(F.array_join(found, " ")).alias("text"))


@query
def lemmatize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemmas by a table read from files in the public exception format."""
    base = scratch_path(spark, "exceptions")
    tables = []
    for pos, entries in (("v", IRREGULAR_VERBS), ("n", IRREGULAR_NOUNS)):
        write_exceptions(spark, entries, f"{base}/{pos}.exc")
        tables.append(lemma_exceptions(spark, f"{base}/{pos}.exc", pos))
    rows = documents(spark, sf_dir).select("doc_id", text.feature_words(F.col("text")).alias("words"))
    found = lemmas.lemmatize_by_table(rows, F.col("words"), tables[0].union(tables[1]))
    return found.select("doc_id", F.md5("lemmas").alias("text"))


@query
def title_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", text.remove_digits(F.col("c_name")).alias("only_str"))


@query
def non_word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explore.title_words(articles(spark, sf_dir))
    return rows.select("source", F.array_join("words", "|").alias("words"))


@query
def stop_words_remover(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", text.non_word_split(F.col("text")).alias("words"))
    kept = StopWordsRemover(inputCol="words", outputCol="filtered").transform(rows)
    return kept.select("doc_id", F.size("filtered").cast("bigint").alias("n"), F.md5(F.array_join("filtered", " ")).alias("filtered"))


@query
def white_space_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Tokenizer(inputCol="text", outputCol="words").transform(documents(spark, sf_dir))
    return rows.select("doc_id", F.size("words").cast("bigint").alias("n"), F.md5(F.array_join("words", "|")).alias("words"))


@query
def extract_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as they are, with an article inside the article, and with ``<main>`` instead."""
    inner = "<article> inner &eacute;&#0000000039; </article> tail</article>"
    nested = F.replace("html", F.lit("</article>"), F.lit(inner))
    main = F.replace(F.replace("html", F.lit("<article"), F.lit("<main")), F.lit("</article>"), F.lit("</main>"))
    forms = F.explode(F.create_map(F.lit("plain"), "html", F.lit("nested"), nested, F.lit("main"), main)).alias("form", "html")
    pages = table(spark, sf_dir, "pages").select("page_id", forms)
    return pages.select("page_id", "form", F.md5(text.extract_article_text(F.col("html"))).alias("text"))


@query
def cleaned_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.cleaned_articles(documents(spark, sf_dir))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("articles"), F.sum(F.length("clean_text")).alias("n_chars"))
    return sizes.orderBy(F.desc("articles"), "lang")


@query
def normalize_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize(documents(spark, sf_dir), "text", ("lang",))
    return rows.select("lang", F.md5("lemm_summary").alias("lemm_summary"))


@query
def normalize_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize(documents(spark, sf_dir), "text", ("lang",), compat=True)
    return rows.select("lang", F.md5("lemm_summary").alias("lemm_summary"))


@query
def normalize_for_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize_for_prediction(documents(spark, sf_dir), "text")
    return rows.select(F.md5("lemm_summary").alias("lemm_summary"))


# Records and dates


@query
def to_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("ts", stamp("ts"))
    return rows.select("event_id", records.to_record(rows).alias("value"))


@query
def decode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(broker_records(spark, sf_dir))
    checked = records.decode_records(rows)
    return checked.groupBy("topic", F.col("is_valid").cast("int").alias("is_valid")).agg(
        F.count("*").alias("n"), F.sum(F.length("record.summary")).alias("n_chars")
    )


@query
def parse_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in both feed layouts, and cut off in the middle."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    plain = F.date_format("ts", records.DATE_LAYOUT)
    rss = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    parsed = {"plain": plain, "rss": rss, "broken": F.substring(plain, 1, 12)}
    return rows.select("event_id", *[
        F.date_format(records.parse_published(column), STAMP).alias(name) for name, column in parsed.items()
    ])


@query
def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels")
    name = records.class_name(F.col("quality") + F.col("toxic"), ["neither", "one", "both"])
    return rows.groupBy(name.alias("name")).agg(F.count("*").alias("n"))


# Features and models


@query
def index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.index_labels(table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("topic")))
    return rows.select("event_id", "topic", "label")


def feature_words() -> Column:
    return text.drop_words(text.feature_words(F.col("text")), ENGLISH_STOP_WORDS)


def feature_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_once(documents(spark, sf_dir), words=feature_words()).select("doc_id", "lang", "words")


@query
def vocabulary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.vocabulary_counts(feature_tokens(spark, sf_dir), "words")


@query
def count_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total of each dictionary entry over the vectors."""
    words, rows = terms.term_vectors(documents(spark, sf_dir, "doc_id", "text"), feature_words(), key="doc_id")
    totals = rows.select(F.inline("features")).groupBy("index").agg(F.sum("value").cast("bigint").alias("tf"))
    return words.select("term", "index").join(totals, "index").select("term", "tf")


@query
def hashed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.hashed_counts(feature_tokens(spark, sf_dir), "words")
    entries = features.vector_entries(rows, "features", ["doc_id"])
    return entries.groupBy("doc_id").agg(F.sum("value").cast("bigint").alias("n_tokens"))


@query
def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.tf_idf(documents(spark, sf_dir), "doc_id", feature_words())
    return rows.groupBy("term").agg(
        F.max("df").alias("df"), F.sum("tf").alias("tf"), F.round(F.sum("tf_idf"), 4).alias("tf_idf")
    )


@query
def split_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = features.split(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"))
    return train.select("doc_id", F.lit("train").alias("part")).unionByName(test.select("doc_id", F.lit("test").alias("part")))


@query
def bag_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = explore.bag_of_words(articles(spark, sf_dir))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "topic").agg(
        F.count("*").alias("articles"), F.sum(F.size("filtered")).alias("tokens"), F.max("categoryIndex").alias("category_index")
    )


def explored(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = mentions(spark, sf_dir).select(F.col("mention").alias("title"), F.col("domain").alias("summary"), F.col("lang").alias("topic"))
        return getattr(explore.explore(rows), name)
    return run


for _part in ("null_counts", "row_count", "topics", "titles"):
    QUERIES[f"explore_{_part}"] = explored(_part)


def topic_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized documents of all languages, topic = language."""
    rows = documents(spark, sf_dir, "text", "lang").withColumnRenamed("lang", "topic")
    return normalize.normalize(rows, "text", lang=None)


@query
def naive_bayes_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the test part by a classifier over exact terms."""
    fitted = model.train(topic_articles(spark, sf_dir), vectorizer="count")
    return fitted.predictions.select(F.md5("lemm_summary").alias("lemm_summary"), "topic", "category")


@query
def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = model.train(topic_articles(spark, sf_dir), scratch_path(spark, "model"))
    return fitted.scores


@query
def train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the classifier over exact terms on the test part."""
    report = model.train(topic_articles(spark, sf_dir), vectorizer="count").report
    return report.select("class", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


@query
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = model.classifier("random_forest", seed=11)
    return model.train(topic_articles(spark, sf_dir), estimator=forest).scores


@query
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = tuning.cross_validate(topic_articles(spark, sf_dir)).scores
    return scores.select("num_features", "fold", F.round("f1", 6).alias("f1"))


def saved_model(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "model")
    model.train(topic_articles(spark, sf_dir), path, vectorizer="count")
    return path


@query
def score_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every normalized article scored by the model that was saved and loaded again."""
    loaded = model.load_model(saved_model(spark, sf_dir))
    rows = normalize.normalize(documents(spark, sf_dir, "text", "doc_id"), "text", keep=("doc_id",), lang=None, dedup=False)
    return model.score(rows, loaded).select("doc_id", "category", F.round("confidence", 4).alias("confidence"))


@query
def retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model refitted on page titles and documents, then applied to all documents."""
    path = scratch_path(spark, "model")
    base = documents(spark, sf_dir, "text", "lang").select(F.col("text").alias("summary"), F.col("lang").alias("topic"))
    fitted = model.retrain(seen_pages(spark, sf_dir), base, path, {"lang": None}, vectorizer="count")
    rows = normalize.normalize(base, keep=("topic",), lang=None)
    return model.score(rows, fitted).groupBy("topic", "category").agg(F.count("*").alias("n"))


@query
def request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.extract_requests(requested_pages(spark, sf_dir)).select("url", F.md5("summary").alias("summary"), "status")


def scored_pages(spark: SparkSession, sf_dir: str, model_path: str) -> DataFrame:
    loaded = model.load_model(model_path)
    rows = scoring.score_batch(requested_pages(spark, sf_dir), seen_pages(spark, sf_dir), loaded, PREDICTED_AT)
    return rows.select("url", "category", stamp("predicted_at"), "status")


@query
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_pages(spark, sf_dir, saved_model(spark, sf_dir))


# Streams


def run_to_end(*queries) -> None:
    for running in queries:
        running.awaitTermination()


@query
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored and published articles of both polls, each article once."""
    base = scratch_path(spark, "ingest")
    unique = ingest.dedup_articles(ingest.response_stream(spark, landed_responses(spark, sf_dir)))
    run_to_end(ingest.ingest_stream(unique, f"{base}/stored", f"{base}/published", TOPICS, f"{base}/checkpoint"))
    stored = spark.read.parquet(f"{base}/stored").groupBy("topic").agg(F.count("*").alias("stored"))
    published = spark.read.text(f"{base}/published").groupBy("topic").agg(F.count("*").alias("published"))
    return stored.join(published, "topic", "left").select("topic", "stored", F.coalesce("published", F.lit(0)).alias("published"))


@query
def reject_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the second half-hour of each hour lose the end of their date."""
    path, base = scratch_path(spark, "responses"), scratch_path(spark, "ingest")
    late = F.substring("published_date", 15, 2).cast("int") >= 30
    cut = F.when(late, F.substring("published_date", 1, 14)).otherwise(F.col("published_date"))
    rows = raw_articles(spark, sf_dir).withColumn("published_date", cut)
    rows.select(F.array(F.struct(*rows.columns)).alias("articles"), F.lit(1).alias("page_size")).write.json(path)
    stream = ingest.dated(ingest.response_stream(spark, path))
    run_to_end(ingest.reject_stream(stream, f"{base}/rejected", f"{base}/checkpoint"))
    return spark.read.schema(schemas.ARTICLE).json(f"{base}/rejected").select("source", "published_date", "topic")


def copies_of_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as two polls bring them: the second an hour after the first, dated half an hour earlier or later."""
    rows = raw_articles(spark, sf_dir)
    shift = F.when(F.length("summary") % 2 == 0, F.expr("interval -30 minutes")).otherwise(F.expr("interval 30 minutes"))
    moved = F.date_format(F.to_timestamp("published_date", STAMP) + shift, STAMP)
    second = rows.withColumn("published_date", moved).withColumn("title", F.concat(F.lit("again: "), "title"))
    return rows.withColumn("arrived", F.lit("2024-03-01 00:00:00")).union(second.withColumn("arrived", F.lit("2024-03-01 01:00:00")))


def responses_of(rows: DataFrame) -> DataFrame:
    article = F.struct("title", "published_date", "summary", "topic", "link")
    # the test for empty responses that explode brings would make the articles a second time
    made = evaluate_once(rows, articles=F.array(article))
    return made.select("arrived", "articles", F.lit(1).cast("bigint").alias("page_size"))


@query
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy of each article that was published first; an empty poll a day later ends the wait."""
    path, base = scratch_path(spark, "responses"), scratch_path(spark, "dedup")
    responses_of(copies_of_polls(spark, sf_dir)).write.partitionBy("arrived").json(path)
    closing = spark.range(1).select(F.lit("2024-03-02 12:00:00").alias("arrived"), F.array().cast("array<struct<title:string>>").alias("articles"))
    for _ in range(2):
        stream = ingest.first_published(ingest.dated(ingest.arrival_stream(spark, path)), gap="1 day")
        run_to_end(landing.land_stream(stream, f"{base}/stored", f"{base}/checkpoint"))
        closing.write.mode("append").partitionBy("arrived").json(path)
    return spark.read.parquet(f"{base}/stored").select("source", "title", "topic", stamp("published_at"))


@query
def batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.flatten_api_articles(responses_of(copies_of_polls(spark, sf_dir)))
    found = ingest.batch_dedup(ingest.dated(rows), columns=["source", "title", "topic", "published_at"])
    return found.select("source", "title", "topic", stamp("published_at"))


@query
def land_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "landing")
    stream = src.read_article_stream(spark, "parquet", schemas.BROKER_RECORD, path=broker_records(spark, sf_dir))
    run_to_end(landing.land_stream(landing.decoded(stream), f"{base}/landed", f"{base}/checkpoint"))
    return digested(src.read_collection(spark, "parquet", path=f"{base}/landed"))


@query
def land_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "landing")
    stream = src.read_article_stream(spark, "parquet", schemas.BROKER_RECORD, path=broker_records(spark, sf_dir))
    run_to_end(landing.land_stream(landing.rejected(stream), f"{base}/rejects", f"{base}/checkpoint"))
    return spark.read.schema(schemas.BROKER_RECORD).parquet(f"{base}/rejects")


@query
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages scored as a stream of files: the history afterwards, and the answers without a class."""
    base = scratch_path(spark, "scoring")
    loaded = model.load_model(saved_model(spark, sf_dir))
    stored = stored_pages(spark, sf_dir)
    requested_pages(spark, sf_dir).write.parquet(f"{base}/pages")
    stream = spark.readStream.schema("url string, html string").parquet(f"{base}/pages")
    answers = f"{base}/answers"
    run_to_end(landing.score_stream(stream, loaded, stored, f"{base}/checkpoint", PREDICTED_AT, answers_path=answers))
    kept = history.stored_history(spark, stored).withColumn("status", F.lit("stored"))
    others = spark.read.parquet(answers).where("status <> 'classified'").select(*kept.columns)
    return kept.union(others).select("url", "category", stamp("predicted_at"), "status")



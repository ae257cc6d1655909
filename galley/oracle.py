"""SQL counterparts of the registered queries, for DuckDB.

Each statement is written from the definition of the operator, with RE2 patterns instead of Java
ones. Only the word tables and rule patterns are shared with the Spark expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import SparkSession

from galley.functions import lexical
from galley.functions.words import (
    BUILT_IN_LANGUAGES,
    CLOSED_CLASS_WORDS,
    ED_ING_NON_VERBS,
    ENGLISH_STOP_WORDS,
    HTML_ENTITIES,
    IRREGULAR_NOUNS,
    IRREGULAR_VERBS,
    LY_NON_ADVERBS,
    OE_PLURALS,
)

STAMP = "'%Y-%m-%d %H:%M:%S'"
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"
PUNCTUATION = r"[!-/:-@\[-`{-~]"

ARTICLES = f"""
  articles AS (
    SELECT doc_id, split_part(text, '.', 1) AS title,
           strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id), {STAMP}) AS published_date,
           text AS summary, lang AS topic,
           'https://news.example/' || source || '/' || doc_id AS source
    FROM documents)"""
SEEN = f"""
  seen AS (
    SELECT url, regexp_extract(url, '/(en|fr|de|es)/', 1) AS category,
           strftime(TIMESTAMP '2024-01-01' + to_minutes(page_id), {STAMP}) AS predicted_at,
           regexp_extract(html, '<title>([^<]*)</title>', 1) AS summary
    FROM pages WHERE starts_with(url, 'https://'))"""
REQUESTS = "requests AS (SELECT page_id, url, unnest([1, 2]) AS attempt FROM pages)"
MENTIONS = """
  mentions AS (
    SELECT doc_id, nullif(regexp_extract(text, '@([A-Za-z0-9_]+)', 1), '') AS mention,
           nullif(regexp_extract(text, '@[A-Za-z0-9_]+[.]([a-z]+)', 1), '') AS domain, lang
    FROM documents)"""
DIGESTED = "title, published_date, md5(summary) AS summary, topic, source"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(words: Iterable[str]) -> str:
    return "[" + ", ".join(quoted(word) for word in words) + "]"


def has(words: Iterable[str], x: str) -> str:
    return f"list_contains({sql_list(words)}, {x})"


def spark_stop_words(language: str) -> set[str]:
    """A stop-word list shipped with Spark, asked of the running session (or of a new one)."""
    SparkSession.builder.getOrCreate()
    return {word.strip() for word in StopWordsRemover.loadDefaultStopWords(language)}


def without_urls(x: str) -> str:
    return f"regexp_replace({x}, 'https?://(www[^\\n])?{WORD}+\\.{WORD}+(/{WORD}+)*/?', ' ', 'g')"


def without_mentions(x: str) -> str:
    return f"regexp_replace({x}, '@{WORD}+', ' ', 'g')"


def without_punctuation(x: str) -> str:
    return f"regexp_replace({x}, '{PUNCTUATION}', ' ', 'g')"


def without_numbers(x: str) -> str:
    return f"regexp_replace({x}, '\\p{{Nd}}+', ' ', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SPACE}+'), lambda w: w <> '')"


def marked_words(x: str) -> str:
    return words(without_numbers(without_punctuation(without_mentions(without_urls(f"lower({x})")))))


def feature_words(x: str) -> str:
    return f"list_filter({marked_words(x)}, lambda w: regexp_full_match(w, '[a-z]{{3,}}'))"


def features(x: str) -> str:
    return f"array_to_string({feature_words(x)}, ' ')"


def features_compat(x: str) -> str:
    marked = f"list_transform({marked_words(x)}, lambda w: CASE WHEN regexp_full_match(w, '[a-z]{{3,}}') THEN w ELSE '' END)"
    return f"CASE WHEN ({marked})[1] = '' THEN ' ' ELSE '' END || array_to_string({marked}, ' ')"


def drop_words(x: str, dropped: Iterable[str]) -> str:
    return f"list_filter({x}, lambda w: NOT {has(dropped, 'w')})"


def is_adverb(w: str) -> str:
    return f"(ends_with({w}, 'ly') AND NOT {has(LY_NON_ADVERBS, w)})"


def keep_pos(x: str) -> str:
    return f"list_filter({x}, lambda w: NOT {has(CLOSED_CLASS_WORDS, 'w')} AND NOT {is_adverb('w')})"


def regular_verb(w: str) -> str:
    return (
        f"(((ends_with({w}, 'ing') AND length({w}) >= 5) OR (ends_with({w}, 'ed') AND length({w}) >= 4))"
        f" AND NOT {has(ED_ING_NON_VERBS, w)})"
    )


def plural(w: str) -> str:
    return f"(ends_with({w}, 's') AND NOT regexp_matches({w}, '(ss|us|is)$') AND length({w}) > 3)"


def pos_tag(w: str) -> str:
    return f"""CASE
      WHEN {has(CLOSED_CLASS_WORDS, w)} THEN 'X' WHEN {is_adverb(w)} THEN 'RB'
      WHEN {has(IRREGULAR_VERBS, w)} OR {regular_verb(w)} THEN 'VB'
      WHEN regexp_matches({w}, '{lexical.ADJECTIVE}') THEN 'JJ'
      WHEN {plural(w)} THEN 'NNS' ELSE 'NN' END"""


def found_in(table: Mapping[str, str], w: str) -> str:
    return f"{sql_list(table.values())}[list_position({sql_list(table)}, {w})]"


def cut(w: str, n: int) -> str:
    return f"{w}[1:length({w}) - {n}]"


def restored(stem: str) -> str:
    return f"""CASE
      WHEN regexp_matches({stem}, '{lexical.DOUBLED}') THEN {stem}[1:length({stem}) - 1]
      WHEN regexp_matches({stem}, '{lexical.LOST_E}') OR regexp_matches({stem}, '{lexical.SHORT_STEM}')
      THEN {stem} || 'e' ELSE {stem} END"""


def verb_lemma(w: str) -> str:
    return f"""CASE
      WHEN {has(IRREGULAR_VERBS, w)} THEN {found_in(IRREGULAR_VERBS, w)}
      WHEN regexp_matches({w}, '[aeiouy].*ing$') THEN {restored('(' + cut(w, 3) + ')')}
      WHEN ends_with({w}, 'ied') THEN CASE WHEN length({w}) = 4 THEN {cut(w, 1)} ELSE {cut(w, 3)} || 'y' END
      WHEN ends_with({w}, 'eed') THEN {w}
      WHEN regexp_matches({w}, '[aeiouy].*ed$') THEN {restored('(' + cut(w, 2) + ')')}
      ELSE {w} END"""


def noun_lemma(w: str) -> str:
    return f"""CASE
      WHEN {has(IRREGULAR_NOUNS, w)} THEN {found_in(IRREGULAR_NOUNS, w)}
      WHEN regexp_matches({w}, '[a-z][a-z]men$') THEN {cut(w, 2)} || 'an'
      WHEN NOT {plural(w)} THEN {w}
      WHEN ends_with({w}, 'ies') THEN {cut(w, 3)} || 'y'
      WHEN ends_with({w}, 'oes') AND NOT {has(OE_PLURALS, w)} THEN {cut(w, 2)}
      WHEN regexp_matches({w}, '(ches|shes|sses|xes|zzes|[^aeo]uses)$') THEN {cut(w, 2)}
      ELSE {cut(w, 1)} END"""


def lemma(w: str) -> str:
    is_verb = (
        f"NOT {has(CLOSED_CLASS_WORDS, w)} AND NOT {is_adverb(w)}"
        f" AND ({has(IRREGULAR_VERBS, w)} OR {regular_verb(w)})"
    )
    unchanged = f"({has(CLOSED_CLASS_WORDS, w)} OR {is_adverb(w)})"
    return f"CASE WHEN {unchanged} THEN {w} WHEN {is_verb} THEN {verb_lemma(w)} ELSE {noun_lemma(w)} END"


def lemmas(x: str) -> str:
    return f"list_transform({x}, lambda w: {lemma('w')})"


def non_ascii_stripped(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x01-\\x7e]', '', 'g')"


def normalized(x: str) -> str:
    kept = drop_words(feature_words(non_ascii_stripped(x)), ENGLISH_STOP_WORDS)
    return f"array_to_string({lemmas(keep_pos(kept))}, ' ')"


def normalized_compat(x: str) -> str:
    first = f"array_to_string({drop_words(words(x), ENGLISH_STOP_WORDS)}, ' ')"
    return f"array_to_string({lemmas(keep_pos(words(features_compat(first))))}, ' ')"


def stop_word_table() -> str:
    lists = {code: spark_stop_words(name) for code, name in BUILT_IN_LANGUAGES.items()}
    lists["en"] = set(ENGLISH_STOP_WORDS)
    selects = [f"SELECT {quoted(code)} AS list_lang, unnest({sql_list(sorted(found))}) AS word" for code, found in sorted(lists.items())]
    return "stops AS (" + " UNION ALL ".join(selects) + ")"


def guesses() -> str:
    """Best language, its score and the guess per document."""
    n_lists = len(BUILT_IN_LANGUAGES) + 1
    return f"""
  {stop_word_table()},
  tokens AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{{L}}'']+')) AS word FROM documents),
  hits AS (SELECT doc_id, list_lang, count(*) AS n FROM tokens JOIN stops USING (word) GROUP BY ALL),
  tops AS (SELECT doc_id, max(n) AS top, arg_min(list_lang, (-n, list_lang)) AS best,
                  count(*) AS hit_lists FROM hits GROUP BY doc_id),
  scores AS (
    SELECT doc_id, any_value(best) AS best,
           1 / (sum(pow(2.0, n - top)) + ({n_lists} - any_value(hit_lists)) * pow(2.0, -any_value(top))) AS score
    FROM hits JOIN tops USING (doc_id) GROUP BY doc_id),
  guesses AS (
    SELECT d.doc_id, d.lang AS label, coalesce(score, 0.0) AS score,
           CASE WHEN score >= 0.9 THEN best ELSE 'NA' END AS prediction
    FROM documents d LEFT JOIN scores USING (doc_id))"""


REPORT = """
  classes AS (SELECT label AS class FROM guesses UNION SELECT prediction FROM guesses),
  counted AS (
    SELECT class,
           (SELECT count(*) FROM guesses WHERE label = class AND prediction = class) AS hits,
           (SELECT count(*) FROM guesses WHERE label = class) AS support,
           (SELECT count(*) FROM guesses WHERE prediction = class) AS predicted
    FROM classes),
  rates AS (
    SELECT class, hits, support, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0 END AS precision,
           CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall FROM counted),
  report AS (
    SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
    FROM rates)"""

WEIGHTED = ", ".join(f"sum({m} * support) / sum(support)" for m in ("precision", "recall", "f1"))
REPORT_ROWS = f"""
  SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report
  UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), s
    FROM (SELECT sum(hits) / sum(support) AS a, sum(support)::BIGINT AS s FROM report)
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT
    FROM report
  UNION ALL SELECT 'weighted avg', round(p, 6), round(r, 6), round(f, 6), s
    FROM (SELECT {WEIGHTED}, sum(support)::BIGINT FROM report) AS t(p, r, f, s)"""

INVISIBLE = "(?is)<!--.*?(-->|\\z)|<script\\b.*?(</script\\s*>|\\z)|<style\\b.*?(</style\\s*>|\\z)|<nav\\b.*?</nav\\s*>"


def article_text(x: str) -> str:
    body = f"regexp_extract(regexp_replace({x}, '{INVISIBLE}', ' ', 'g'), '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)"
    visible = f"regexp_replace({body}, '</?[A-Za-z][^>]*>|<[!?][^>]*>', ' ', 'g')"
    for entity, character in HTML_ENTITIES.items():
        visible = f"replace({visible}, {quoted(entity)}, {quoted(character)})"
    return f"array_to_string({words(visible)}, ' ')"


EARLIEST = f"""
  SELECT source, CASE WHEN length(summary) % 2 = 0 THEN 'again: ' || title ELSE title END AS title, topic,
    CASE WHEN length(summary) % 2 = 0 THEN strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id) - INTERVAL 30 MINUTE, {STAMP})
      ELSE published_date END AS published_at FROM articles"""

TOPIC_ARTICLES = f"topic_articles AS (SELECT DISTINCT lang AS topic, {normalized('text')} AS lemm FROM documents)"

TRAIN_TEST = f"""{TOPIC_ARTICLES},
  rows AS (
    SELECT topic, lemm, ('0x' || substr(md5(topic || chr(31) || lemm), 1, 8))::BIGINT % 100 < 80 AS is_train
    FROM topic_articles WHERE lemm <> '')"""


def naive_bayes(rows: str, targets: str) -> str:
    """Class and confidence of ``targets(id, lemm)`` after training on ``rows(topic, lemm, is_train)``."""
    return f"""{rows + "," if rows else ""}
  terms AS (
    SELECT topic, lemm, term, count(*) AS tf
    FROM (SELECT *, unnest(string_split(lemm, ' ')) AS term FROM rows WHERE is_train) GROUP BY ALL),
  idf AS (
    SELECT term, CASE WHEN count(*) >= 3 THEN ln(((SELECT count(*) FROM rows WHERE is_train) + 1) / (count(*) + 1)) ELSE 0.0 END AS idf
    FROM terms GROUP BY term),
  weights AS (SELECT topic, term, sum(tf * idf) AS w FROM terms JOIN idf USING (term) GROUP BY ALL),
  priors AS (SELECT topic, ln(count(*) + 1) AS prior FROM rows WHERE is_train GROUP BY topic),
  totals AS (
    SELECT topic, prior, ln(total + (SELECT count(*) FROM idf)) AS denominator
    FROM priors JOIN (SELECT topic, sum(w) AS total FROM weights GROUP BY topic) USING (topic)),
  targets AS ({targets}),
  found AS (
    SELECT id, t.term, coalesce(tf * idf, 0.0) AS x
    FROM (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(string_split(lemm, ' ')) AS term FROM targets) GROUP BY ALL) t
    LEFT JOIN idf USING (term)),
  sums AS (
    SELECT id, c.topic AS category,
           any_value(c.prior) + sum(x * (ln(coalesce(w, 0.0) + 1) - c.denominator)) AS score
    FROM found f CROSS JOIN totals c LEFT JOIN weights w ON w.topic = c.topic AND w.term = f.term
    GROUP BY ALL),
  tops AS (SELECT id, max(score) AS top FROM sums GROUP BY id),
  scored AS (
    SELECT id, arg_max(category, score) AS category, 1 / sum(exp(score - top)) AS confidence
    FROM sums JOIN tops USING (id) GROUP BY id)"""


TEST_ROWS = "SELECT {'topic': topic, 'lemm': lemm} AS id, lemm FROM rows WHERE NOT is_train"
TEST_GUESSES = "guesses AS (SELECT id.topic AS label, category AS prediction FROM scored)"
REQUESTED = """requested AS (
    SELECT url, html FROM pages UNION ALL SELECT url || '&none', '<html></html>' FROM pages
    UNION ALL SELECT url || '&empty', '<article>it is 5</article>' FROM pages)"""
UNSEEN = f"""SELECT * FROM (
    SELECT url AS id, {normalized(article_text('html'))} AS lemm
    FROM requested WHERE url NOT IN (SELECT url FROM seen)) WHERE lemm <> ''"""
ANSWERS = f"""answers AS (
    SELECT url, CASE WHEN {article_text('html')} = '' THEN 'invalid' WHEN {normalized(article_text('html'))} = '' THEN 'empty'
    ELSE 'classified' END AS status FROM requested)"""


PROFILED = {
    "customer": {"c_custkey": True, "c_name": False, "c_nationkey": True, "c_acctbal": True, "c_mktsegment": False},
    "lineitem": {
        "l_orderkey": True, "l_partkey": True, "l_suppkey": True, "l_linenumber": True, "l_quantity": True, "l_extendedprice": True,
        "l_discount": True, "l_tax": True, "l_returnflag": False, "l_linestatus": False, "l_shipdate": False,
    },
    "documents": {"doc_id": True, "text": False, "lang": False, "source": False, "n_chars": True},
}


def profiles() -> str:
    selects = []
    for name, columns in PROFILED.items():
        for column, numeric in columns.items():
            quantiles = ", ".join(
                (f"round(quantile_cont({column}::DOUBLE, {q}), 4)" if numeric else "NULL::DOUBLE") + f" AS {name}"
                for q, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))
            )
            selects.append(f"""SELECT '{column}' AS column_name, count(*) AS rows, count(*) - count({column}) AS nulls,
              count(DISTINCT {column}) AS "distinct", min({column})::VARCHAR AS "min", max({column})::VARCHAR AS "max",
              round(avg(length({column}::VARCHAR)), 4) AS avg_length, {quantiles} FROM {name}""")
    return " UNION ALL ".join(selects)


def fold_scores() -> str:
    """F1 of every fold under a plain fit on the other folds, for both numbers of buckets."""
    return f"""{TOPIC_ARTICLES},
      rows AS (
        SELECT topic, lemm, ('0x' || substr(md5(topic || chr(31) || lemm), 9, 8))::BIGINT % 3 AS fold FROM topic_articles WHERE lemm <> ''),
      grid AS (SELECT unnest([1000, 2000])::BIGINT AS nf), folds AS (SELECT unnest([0, 1, 2])::BIGINT AS f),
      b AS (
        SELECT topic, lemm, fold, nf, ('0x' || substr(md5(term), 1, 8))::BIGINT % nf AS bucket, count(*) AS tf
        FROM (SELECT *, unnest(string_split(lemm, ' ')) AS term FROM rows), grid GROUP BY ALL),
      training AS (SELECT f, topic, count(*) AS n FROM rows, folds WHERE fold <> f GROUP BY ALL),
      sizes AS (SELECT f, sum(n)::BIGINT AS n FROM training GROUP BY f),
      idf AS (
        SELECT f, nf, bucket, CASE WHEN count(*) >= 3 THEN ln((any_value(n) + 1) / (count(*) + 1)) ELSE 0.0 END AS idf
        FROM b JOIN folds ON fold <> f JOIN sizes USING (f) GROUP BY ALL),
      weights AS (SELECT f, nf, topic, bucket, sum(tf * idf) AS w FROM b JOIN idf USING (nf, bucket) WHERE fold <> f GROUP BY ALL),
      totals AS (
        SELECT f, nf, topic, ln(any_value(n) + 1) AS prior, ln(sum(w) + nf) AS denominator FROM weights JOIN training USING (f, topic) GROUP BY f, nf, topic),
      sums AS (
        SELECT b.fold AS f, b.nf, b.topic AS label, lemm, c.topic AS category,
          any_value(prior) + sum(tf * coalesce(idf, 0) * (ln(coalesce(w, 0.0) + 1) - denominator)) AS score
        FROM b JOIN totals c ON c.f = b.fold AND c.nf = b.nf LEFT JOIN idf i ON i.f = b.fold AND i.nf = b.nf AND i.bucket = b.bucket
        LEFT JOIN weights w ON w.f = b.fold AND w.nf = b.nf AND w.topic = c.topic AND w.bucket = b.bucket GROUP BY ALL),
      guesses AS (SELECT f, nf, label, arg_max(category, score) AS prediction FROM sums GROUP BY f, nf, label, lemm),
      sides AS (
        SELECT f, nf, label AS class, (label = prediction)::INTEGER AS hit, 1 AS support, 0 AS predicted FROM guesses
        UNION ALL SELECT f, nf, prediction, 0, 0, 1 FROM guesses),
      rates AS (
        SELECT f, nf, class, sum(support) AS support, CASE WHEN sum(predicted) > 0 THEN sum(hit) / sum(predicted) ELSE 0 END AS p,
          CASE WHEN sum(support) > 0 THEN sum(hit) / sum(support) ELSE 0 END AS r FROM sides GROUP BY f, nf, class)
      SELECT nf AS num_features, f AS fold, round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support), 6) AS f1
      FROM rates GROUP BY nf, f"""


def top_of(column: str) -> str:
    return f"""(SELECT '{column}' AS column_name, {column}::VARCHAR AS value, count(*) AS count
      FROM documents GROUP BY value ORDER BY count DESC, value LIMIT 5)"""


def explored(select: str) -> str:
    return f"""WITH {MENTIONS}, raw AS (SELECT mention AS title, domain AS summary, lang AS topic FROM mentions),
      complete AS (SELECT * FROM raw WHERE title IS NOT NULL AND summary IS NOT NULL AND topic IS NOT NULL) {select}"""


TOKENS = f"tokens AS (SELECT doc_id, unnest({drop_words(feature_words('text'), ENGLISH_STOP_WORDS)}) AS term FROM documents)"
TITLE_WORDS = "list_filter(string_split_regex(lower(regexp_replace({}, '[0-9]+', '', 'g')), '[^A-Za-z0-9_]'), lambda w: w <> '')"


def oracle_sql() -> dict[str, str]:
    raw_page = "'See ' || url || ' by @' || regexp_replace(url, '^https?://', '') || ' ' || html"
    rest = "regexp_replace(text, '^[^.]*[.]', '')"
    seen_rows = "SELECT url, category, predicted_at, summary FROM seen"
    fresh_predictions = f"""
      SELECT url, 'attempt 1' AS category, '2024-02-01 00:00:00' AS predicted_at, page_id::VARCHAR AS summary
      FROM pages WHERE url NOT IN (SELECT url FROM seen)"""
    english = spark_stop_words("english")
    title_words = TITLE_WORDS.format("title")
    codes = ["NA", *sorted(["en", *BUILT_IN_LANGUAGES])]
    matrix = ", ".join(f"count(*) FILTER (prediction = '{code}') AS \"{code}\"" for code in codes)
    return {
        # Sources
        "read_articles": f"WITH {ARTICLES} SELECT topic, title, md5(summary) AS summary FROM articles",
        "read_summaries": "SELECT md5(text) AS summary FROM documents",
        "read_collection": f"WITH {ARTICLES} SELECT {DIGESTED} FROM articles",
        "read_history": f"WITH {SEEN} {seen_rows}",
        "flatten_api_articles": f"WITH {ARTICLES} SELECT {DIGESTED} FROM articles UNION ALL SELECT {DIGESTED} FROM articles",
        "read_rss": f"""WITH {ARTICLES} SELECT published_date, 'news' AS topic, source AS link,
            trim(regexp_replace(title, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS title,
            md5(trim(regexp_replace(summary, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))) AS summary FROM articles""",
        "stop_word_hits": f"""WITH {stop_word_table()},
            tokens AS (SELECT lang, unnest(string_split_regex(lower(text), '[^\\p{{L}}'']+')) AS word FROM documents)
            SELECT lang, list_lang, count(*) AS hits FROM tokens JOIN stops USING (word) GROUP BY ALL""",
        # Sinks
        "append_collection": f"WITH {ARTICLES} SELECT {DIGESTED} FROM articles",
        "publish_by_topic": f"WITH {ARTICLES} SELECT {DIGESTED} FROM articles WHERE topic IN ('en', 'fr')",
        "write_table": f"""WITH {ARTICLES} SELECT title, published_date AS datetime, md5(summary) AS summary, topic, source
            FROM articles""",
        "append_history": f"WITH {SEEN} {seen_rows} UNION ALL {fresh_predictions}",
        # Projections
        "project_article": f"WITH {ARTICLES} SELECT {DIGESTED} FROM articles",
        "select_title_summary_topic": f"WITH {ARTICLES} SELECT title, md5(summary) AS summary, topic FROM articles",
        "drop_title": f"WITH {ARTICLES} SELECT md5(summary) AS summary, topic FROM articles",
        "derive_columns": f"""SELECT doc_id, length(text) AS n_text, length({non_ascii_stripped('text')}) AS n_ascii,
            length(text) - length({non_ascii_stripped('text')}) AS n_dropped FROM documents""",
        "rename_history_fields": f"WITH {SEEN} SELECT url, category AS topic, summary FROM seen",
        "constant_topic": f"WITH {ARTICLES} SELECT source AS link, 'news' AS topic FROM articles",
        # Filters and lookups
        "topic_allow_list": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'purchase')",
        "language_filter": "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'",
        "blank_filter": f"SELECT conv_id, turn FROM conversations WHERE NOT regexp_full_match({rest}, '[ \\n\\t\\r]*')",
        "drop_null_rows": f"WITH {MENTIONS} SELECT * FROM mentions WHERE mention IS NOT NULL AND domain IS NOT NULL",
        "null_rows": f"WITH {MENTIONS} SELECT doc_id FROM mentions WHERE mention IS NULL",
        "already_predicted": f"""WITH {SEEN}, {REQUESTS} SELECT url, page_id, attempt FROM requests
            WHERE url IN (SELECT url FROM seen)""",
        "not_yet_predicted": f"""WITH {SEEN}, {REQUESTS} SELECT url, page_id, attempt FROM requests
            WHERE url NOT IN (SELECT url FROM seen)""",
        "cached_predictions": f"WITH {SEEN}, {REQUESTS} SELECT DISTINCT url, category FROM requests JOIN seen USING (url)",
        "request_status": """SELECT doc_id, CASE WHEN source <> '' AND regexp_extract(text, '@[a-z]+[.]com([^\\n]*)', 1) <> ''
            THEN 'valid' ELSE 'invalid' END AS status FROM documents""",
        "newer_than_last_training": f"WITH {SEEN} SELECT url, predicted_at FROM seen WHERE predicted_at >= '2024-01-01 02:00:00'",
        "search_articles": "SELECT doc_id FROM documents WHERE lang = 'en' AND contains(lower(text), 'the tion')",
        # Counts, profiles, order
        "null_value_count": f"""WITH {MENTIONS}, counts AS (
            SELECT 'mention' AS column_name, count(*) - count(mention) AS null_count FROM mentions UNION ALL
            SELECT 'domain', count(*) - count(domain) FROM mentions UNION ALL
            SELECT 'lang', count(*) - count(lang) FROM mentions UNION ALL
            SELECT 'doc_id', count(*) - count(doc_id) FROM mentions) SELECT * FROM counts WHERE null_count > 0""",
        "row_count": "SELECT count(*) AS row_count FROM documents",
        "topic_counts": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type ORDER BY count DESC, event_type",
        "top_titles": f"""WITH {ARTICLES} SELECT title, count(*) AS count FROM articles GROUP BY title
            ORDER BY count DESC, title LIMIT 20""",
        "average_label": """SELECT lang AS topic, (row_number() OVER (ORDER BY count(*) DESC, lang) - 1)::DOUBLE AS avg_label
            FROM documents GROUP BY lang""",
        "distinct_texts": "SELECT lang, md5(text) AS text FROM (SELECT DISTINCT text, lang FROM documents)",
        "confusion_matrix": f"WITH {guesses()} SELECT label, {matrix} FROM guesses GROUP BY label",
        "classification_report": f"WITH {guesses()}, {REPORT} {REPORT_ROWS}",
        "f1_and_test_error": f"""WITH {guesses()}, {REPORT}
            SELECT round(f, 6) AS f1, round(1 - f, 6) AS test_error, round(a, 6) AS accuracy
            FROM (SELECT sum(f1 * support) / sum(support) AS f, sum(hits) / sum(support) AS a FROM report)""",
        "profile_exact": profiles(),
        "profile_sketches": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, TRUE AS distinct_close, TRUE AS quartiles_close FROM documents"
            for c in ("doc_id", "text", "n_chars")
        ),
        "profile_top_values": " UNION ALL ".join(top_of(c) for c in ("doc_id", "text", "lang", "source", "n_chars")),
        "page_sizes": "SELECT 2::BIGINT AS page_size, 2::BIGINT AS n_articles, count(*) AS responses FROM documents",
        "newest_first": f"WITH {SEEN} SELECT url, category, predicted_at FROM seen ORDER BY predicted_at DESC, url",
        "newest_preview": f"WITH {SEEN} SELECT url, category, predicted_at FROM seen ORDER BY predicted_at DESC, url LIMIT 5",
        # Text functions
        "blank_flags": f"""SELECT conv_id, turn, regexp_full_match({rest}, '[ \\n]*')::INTEGER AS is_blank,
            regexp_full_match({rest}, '[ \\n]+')::INTEGER AS is_space FROM conversations""",
        "strip_non_ascii": f"SELECT doc_id, md5({non_ascii_stripped('text')}) AS text FROM documents",
        "detect_language": f"""WITH {guesses()}
            SELECT doc_id, label AS lang, prediction AS found, round(score, 6) AS score FROM guesses""",
        "text_marks": f"""WITH raw AS (SELECT page_id, {raw_page} AS raw FROM pages)
            SELECT page_id, md5(lower(raw)) AS lowered, md5({without_urls('raw')}) AS no_urls,
                   md5({without_mentions('raw')}) AS no_mentions, md5({without_punctuation('raw')}) AS no_punctuation,
                   md5({without_numbers('raw')}) AS no_numbers, md5({features('raw')}) AS features FROM raw""",
        "remove_features": f"""SELECT doc_id, md5({features('text')}) AS features,
            md5({features_compat('text')}) AS features_compat FROM documents""",
        "remove_stop_words": f"""SELECT doc_id, md5(array_to_string({drop_words(words('text'), ENGLISH_STOP_WORDS)}, ' ')) AS text
            FROM documents""",
        "pos_tags": f"""WITH found AS (SELECT unnest({feature_words('text')}) AS word FROM documents),
            counted AS (SELECT word, count(*) AS n FROM found GROUP BY word)
            SELECT word, n, {pos_tag('word')} AS tag, {lemma('word')} AS lemma FROM counted""",
        "keep_pos": f"SELECT doc_id, md5(array_to_string({keep_pos(words('lower(text)'))}, ' ')) AS text FROM documents",
        "lemmatize": f"SELECT doc_id, md5(array_to_string({lemmas(feature_words('text'))}, ' ')) AS text FROM documents",
        "lemmatize_table": f"SELECT doc_id, md5(array_to_string({lemmas(feature_words('text'))}, ' ')) AS text FROM documents",
        "title_digits": "SELECT c_custkey, regexp_replace(c_name, '[0-9]+', '', 'g') AS only_str FROM customer",
        "non_word_tokens": f"WITH {ARTICLES} SELECT source, array_to_string({title_words}, '|') AS words FROM articles",
        "stop_words_remover": f"""WITH split AS (
              SELECT doc_id, list_filter(string_split_regex(lower(text), '[^A-Za-z0-9_]'), lambda w: w <> '') AS found FROM documents),
            kept AS (SELECT doc_id, {drop_words('found', sorted(english))} AS filtered FROM split)
            SELECT doc_id, len(filtered) AS n, md5(array_to_string(filtered, ' ')) AS filtered FROM kept""",
        "white_space_tokens": """WITH split AS (
              SELECT doc_id, string_split_regex(lower(text), '[ \\t\\n\\x0b\\f\\r]') AS parts FROM documents),
            cut AS (SELECT doc_id, parts[1:coalesce(list_max([i for i in range(1, len(parts) + 1) if parts[i] <> '']), 0)] AS words
              FROM split)
            SELECT doc_id, len(words) AS n, md5(array_to_string(words, '|')) AS words FROM cut""",
        "extract_article_text": f"""WITH plain AS (SELECT page_id, {article_text('html')} AS text FROM pages)
            SELECT page_id, 'plain' AS form, md5(text) AS text FROM plain UNION ALL
            SELECT page_id, 'main', md5(text) FROM plain UNION ALL
            SELECT page_id, 'nested', md5(text || ' inner é'' tail') FROM plain""",
        "cleaned_articles": f"""WITH cleaned AS (
              SELECT DISTINCT lang, array_to_string({drop_words(feature_words('text'), ENGLISH_STOP_WORDS)}, ' ') AS clean_text
              FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL)
            SELECT lang, count(*) AS articles, sum(length(clean_text))::BIGINT AS n_chars
            FROM cleaned WHERE trim(clean_text) <> '' GROUP BY lang ORDER BY articles DESC, lang""",
        "normalize_articles": f"""WITH {guesses()}, cleaned AS (
              SELECT DISTINCT lang, {normalized('text')} AS lemm_summary
              FROM documents JOIN guesses USING (doc_id) WHERE prediction = 'en')
            SELECT lang, md5(lemm_summary) AS lemm_summary FROM cleaned WHERE lemm_summary <> ''""",
        "normalize_compat": f"""WITH cleaned AS (SELECT DISTINCT lang, {normalized_compat('text')} AS lemm_summary FROM documents)
            SELECT lang, md5(lemm_summary) AS lemm_summary FROM cleaned""",
        "normalize_for_prediction": f"""WITH {guesses()}, cleaned AS (
              SELECT DISTINCT {normalized('text')} AS lemm_summary
              FROM documents JOIN guesses USING (doc_id) WHERE prediction = 'en')
            SELECT md5(lemm_summary) AS lemm_summary FROM cleaned WHERE lemm_summary <> ''""",
        # Records and dates
        "to_record": """SELECT event_id, json_object('event_id', event_id, 'ts', strftime(ts, '%Y-%m-%d %H:%M:%S'), 'user_id', user_id, 'event_type', event_type, 'value', value, 'props', props)::VARCHAR AS value
            FROM events""",
        "decode_records": """SELECT lang AS topic, 1 AS is_valid, count(*) AS n, sum(length(text))::BIGINT AS n_chars
            FROM documents GROUP BY lang
            UNION ALL SELECT lang, 0, count(*), NULL FROM documents WHERE lang = 'es' GROUP BY lang""",
        "parse_published": f"""SELECT event_id, strftime(ts, {STAMP}) AS plain, strftime(ts, {STAMP}) AS rss,
            NULL::VARCHAR AS broken FROM events""",
        "class_names": """SELECT CASE quality + toxic WHEN 0 THEN 'neither' WHEN 1 THEN 'one' ELSE 'both' END AS name, count(*) AS n
            FROM labels GROUP BY name""",
        # Features and models
        "index_labels": """WITH ranked AS (SELECT event_type AS topic, (row_number() OVER (ORDER BY count(*) DESC, event_type) - 1)::DOUBLE AS label
              FROM events GROUP BY event_type)
            SELECT event_id, topic, label FROM events JOIN ranked ON topic = event_type""",
        "vocabulary_counts": f"WITH {TOKENS} SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM tokens GROUP BY term",
        "count_vectors": f"WITH {TOKENS} SELECT term, count(*) AS tf FROM tokens GROUP BY term",
        "hashed_counts": f"WITH {TOKENS} SELECT doc_id, count(*) AS n_tokens FROM tokens GROUP BY doc_id",
        "tf_idf": f"""WITH {TOKENS}, found AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM tokens GROUP BY term)
            SELECT term, df, tf, round(CASE WHEN df >= 3 THEN tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) ELSE 0.0 END, 4) AS tf_idf
            FROM found""",
        "split_articles": """SELECT doc_id, CASE WHEN ('0x' || substr(md5(text), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS part
            FROM documents""",
        "bag_of_words": f"""WITH {ARTICLES}, ranked AS (
              SELECT topic, (row_number() OVER (ORDER BY count(*) DESC, topic) - 1)::DOUBLE AS category_index FROM articles GROUP BY topic),
            rows AS (
              SELECT topic, len({drop_words(title_words, sorted(english))}) AS n,
                CASE WHEN ('0x' || substr(md5(topic || chr(31) || title || chr(31) || summary), 1, 8))::BIGINT % 100 < 80
                THEN 'train' ELSE 'test' END AS part FROM articles)
            SELECT part, topic, count(*) AS articles, sum(n)::BIGINT AS tokens, max(category_index) AS category_index
            FROM rows JOIN ranked USING (topic) GROUP BY part, topic""",
        "explore_null_counts": explored("""SELECT * FROM (
            SELECT 'title' AS column_name, count(*) - count(title) AS null_count FROM raw UNION ALL
            SELECT 'summary', count(*) - count(summary) FROM raw UNION ALL
            SELECT 'topic', count(*) - count(topic) FROM raw) WHERE null_count > 0"""),
        "explore_row_count": explored("SELECT count(*) AS row_count FROM complete"),
        "explore_topics": explored("SELECT topic, count(*) AS count FROM complete GROUP BY topic"),
        "explore_titles": explored("SELECT title, count(*) AS count FROM complete GROUP BY title ORDER BY count DESC, title LIMIT 20"),
        "naive_bayes_predictions": f"""WITH {naive_bayes(TRAIN_TEST, TEST_ROWS)}
            SELECT md5(id.lemm) AS lemm_summary, id.topic AS topic, category FROM scored""",
        "train_report": f"WITH {naive_bayes(TRAIN_TEST, TEST_ROWS)}, {TEST_GUESSES}, {REPORT} {REPORT_ROWS}",
        "cross_validation": f"WITH {fold_scores()}",
        "score_articles": f"""WITH {naive_bayes(TRAIN_TEST, f"SELECT * FROM (SELECT doc_id AS id, {normalized('text')} AS lemm FROM documents) WHERE lemm <> ''")}
            SELECT id AS doc_id, category, round(confidence, 4) AS confidence FROM scored""",
        "score_batch": f"""WITH {SEEN}, {REQUESTED}, {naive_bayes(TRAIN_TEST, UNSEEN)}, {ANSWERS}
            SELECT url, category, CASE WHEN status = 'classified' THEN '2024-02-01 00:00:00' END AS predicted_at, status
            FROM answers LEFT JOIN scored ON id = url WHERE url NOT IN (SELECT url FROM seen)""",
        "score_stream": f"""WITH {SEEN}, {REQUESTED}, {naive_bayes(TRAIN_TEST, UNSEEN)}, {ANSWERS}
            SELECT id AS url, category, '2024-02-01 00:00:00' AS predicted_at, 'stored' AS status FROM scored
            UNION ALL SELECT url, category, predicted_at, 'stored' FROM seen
            UNION ALL SELECT url, NULL, NULL, status FROM answers WHERE status <> 'classified'""",
        "retrain": f"""WITH {SEEN}, base AS (SELECT DISTINCT lang AS topic, {normalized('text')} AS lemm FROM documents),
            rows AS (
              SELECT DISTINCT topic, lemm, TRUE AS is_train
              FROM (SELECT * FROM base UNION ALL SELECT category, {normalized('summary')} FROM seen) WHERE lemm <> ''),
            {naive_bayes("", "SELECT {'topic': topic, 'lemm': lemm} AS id, lemm FROM base WHERE lemm <> ''")}
            SELECT id.topic AS topic, category, count(*) AS n FROM scored GROUP BY ALL""",
        "request_texts": f"""WITH {REQUESTED} SELECT url, md5({article_text('html')}) AS summary,
            CASE WHEN url <> '' AND {article_text('html')} <> '' THEN 'valid' ELSE 'invalid' END AS status FROM requested""",
        # Streams
        "ingest_stream": """SELECT lang AS topic, count(*) AS stored, count(*) FILTER (lang IN ('en', 'fr')) AS published
            FROM documents GROUP BY lang""",
        "reject_stream": f"""WITH {ARTICLES} SELECT source, published_date[1:14] AS published_date, topic FROM articles
            WHERE published_date[15:16]::INTEGER >= 30""",
        "dedup_stream": f"WITH {ARTICLES} {EARLIEST}",
        "batch_dedup": f"WITH {ARTICLES} {EARLIEST}",
        "land_stream": f"WITH {ARTICLES} SELECT {DIGESTED} FROM articles",
        "land_rejects": f"""WITH {ARTICLES} SELECT topic, ('{{"title":' || to_json(title) || ',"published_date":"' || published_date)[1:20] AS value FROM articles
            WHERE topic = 'es'""",
    }

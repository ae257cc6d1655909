"""Registered queries of the operators, with SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm import (
    bpe, cover_tree, decontaminate, language_id, near_dup, prefix_trie, quality, repair, suffix_dedup, token_counts, token_files, toxicity, url_filter,
)
from galley.llm.common import table
from galley.session import materialize, scratch_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated(table(spark, sf_dir, "documents"), length=50, unit="bytes").drop("spans")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every document."""
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), rule="start")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    tokens = bpe.encode(table(spark, sf_dir, "documents"), path, columns=["doc_id"], as_bytes=True, decoded="decoded")
    return tokens.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return token_files.checksums(token_files.read_token_files(spark, path))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return marked.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = materialize(repair.marked(repair.damaged(conversations, kind)), "marked")
    return repair.report(conversations, rows)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of conversations of which every five share the first turns of one."""
    own = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.trie(*prefix_trie.shared_heads(own, head, F.expr("conv_id - conv_id % 5")))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = materialize(quality.measured(table(spark, sf_dir, "documents").select("doc_id", "text")), "counts")
    judged = quality.judged(counted, quality.estimate(counted))
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, failed.alias("base_failed"), (~failed & F.col("is_good")).alias("kept"), "quality")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_minhash": op4_minhash,
    "op5_bpe": op5_bpe,
    "op6_cover_tree": op6_cover_tree,
    "op7_url_filter": op7_url_filter,
    "op8_token_files": op8_token_files,
    "op9_decontaminate": op9_decontaminate,
    "op10_language_id": op10_language_id,
    "op11_repair": op11_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality": op13_quality,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_PLAIN_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+')"


def _crc32(text: str) -> str:
    """Checksum of a string of ASCII characters, bit by bit."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_transform(range(8), lambda j: (ascii(({text})[i]) >> j) & 1)))"
    step = "lambda c, b: xor(c >> 1, 3988292384 * xor(c & 1, b))"
    return f"xor(list_reduce(list_transform({bits}, lambda b: b::BIGINT), {step}, 4294967295::BIGINT), 4294967295)"


def _repair_step(state: int) -> str:
    """Cheapest edits behind a row from ``state`` that begin with this row, over the values ``b`` behind it."""
    wanted = "b[4]" if state == 2 else "b[3]"
    kept = {0: "CASE i WHEN 's' THEN b[2] WHEN 'u' THEN b[3] END", 2: "CASE WHEN i = 'a' THEN b[4] END"}.get(state, "CASE WHEN i = 'u' THEN b[3] END")
    cut = "CASE WHEN fault = 3 THEN 1 ELSE 0 END"
    ways = [
        f"{{'c': 3 + b[{state + 1}].c, 'a': 'D' || b[{state + 1}].a}}",
        f"CASE WHEN fault IN (0, 3) AND {kept} IS NOT NULL THEN {{'c': {cut} + ({kept}).c, 'a': 'K' || ({kept}).a}} END",
        f"CASE WHEN fault IN (0, 3) THEN {{'c': 2 + {cut} + ({wanted}).c, 'a': 'R' || ({wanted}).a}} END",
    ]
    return f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))"


def _votes() -> str:
    return ", ".join(f"({rule.vote})::INTEGER" for rule in quality.RULES)


def _estimates(weight: str, right: int, start: float) -> str:
    """Accuracies of all rules, given the weight of a row in its class and the vote that is right there."""
    summed = lambda test: f"coalesce(sum(n * {weight}) FILTER ({test}), 0)"
    first = f"{start * quality.STRENGTH!r}::DOUBLE"
    fitted = [
        f"least({quality.MOST}, greatest({quality.LEAST}, ({summed(f'v[{j}] = {right}')} + {first}) / ({summed(f'v[{j}] <> 0')} + {quality.STRENGTH})))"
        for j in range(1, len(quality.RULES) + 1)
    ]
    return f"[{', '.join(fitted)}]::DOUBLE[]"


def _odds() -> str:
    """Logarithm of the odds of being good, over votes ``v`` and accuracies ``good`` and ``bad``."""
    vote = "CASE v[{j}] WHEN 1 THEN ln(good[{j}] / (1 - bad[{j}])) WHEN -1 THEN ln((1 - good[{j}]) / bad[{j}]) ELSE 0 END"
    return " + ".join(["ln(prior / (1 - prior))", *[vote.format(j=j) for j in range(1, len(quality.RULES) + 1)]])


ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": """
      WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
      windows AS (SELECT doc_id, p, h[2 * p + 1 : 2 * p + 100] AS g FROM t, unnest(range(0, length(h) // 2 - 49)) u(p)),
      lowest AS (SELECT g, min(doc_id) AS lo FROM windows GROUP BY g),
      hits AS (SELECT doc_id, p FROM windows JOIN lowest USING (g) WHERE lo < doc_id),
      steps AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, TRUE)::INTEGER AS new FROM hits),
      runs AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps),
      spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run),
      gaps AS (
        SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
        UNION ALL SELECT doc_id, coalesce(max(b), 0), any_value(length(h)) // 2 FROM t LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
      kept AS (SELECT doc_id, string_agg(h[2 * a + 1 : 2 * b], '' ORDER BY a) AS h FROM gaps JOIN t USING (doc_id) GROUP BY doc_id),
      counted AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
      SELECT t.doc_id, length(t.h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
        sha256(unhex(kept.h)) AS kept_sha256
      FROM t JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)""",
    "op4_minhash": f"""
      WITH RECURSIVE d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
      elements AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
          ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) END) AS g FROM d WHERE len(w) > 0),
      sizes AS (SELECT doc_id, count(*) AS n FROM elements GROUP BY doc_id),
      common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM elements x JOIN elements y USING (g)
        WHERE x.doc_id < y.doc_id GROUP BY ALL),
      links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
      edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
      reached AS (
        SELECT doc_id AS node, doc_id AS root FROM documents
        UNION SELECT edges.b, root FROM reached JOIN edges ON edges.a = reached.node),
      components AS (SELECT node AS doc_id, min(root) AS component_id FROM reached GROUP BY node)
      SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
      FROM components LEFT JOIN sizes USING (doc_id)""",
    "op6_cover_tree": """
      WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
      SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5""",
    "op9_decontaminate": f"""
      WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
      b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
      windows AS (
        SELECT DISTINCT item, least(10, len(w)) AS n, w[i : i + least(10, len(w)) - 1] AS g
        FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
      sizes AS (SELECT DISTINCT n FROM windows),
      places AS (SELECT doc_id, i, n, w[i : i + n - 1] AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i)),
      hits AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, g)),
      covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) t(k) GROUP BY doc_id),
      named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
      SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
      FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_repair": f"""
      WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
      hashed AS (SELECT *, {_crc32("k")} % 20 AS kind FROM keyed),
      rows AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
          CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM hashed, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) u(i)),
      placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM rows),
      judged AS (
        SELECT conv_id, turn, p, role, text, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS i,
          CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
            WHEN p > min(p) OVER (PARTITION BY conv_id, role, text) THEN 2
            WHEN regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM placed),
      pairs AS (SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i AS pair FROM judged),
      counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
          count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
          count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS n FROM pairs GROUP BY conv_id),
      best AS (
        SELECT conv_id, n AS p, [{{'c': 0, 'a': ''}}, {{'c': 4, 'a': 'II'}}, {{'c': 2, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS b FROM counted
        UNION ALL
        SELECT conv_id, p - 1, [list_min([w[1], {{'c': 2 + w[3].c, 'a': 'I' || w[3].a}}, {{'c': 4 + w[4].c, 'a': 'II' || w[4].a}}]),
          list_min([w[2], {{'c': 2 + w[3].c, 'a': 'I' || w[3].a}}, {{'c': 4 + w[4].c, 'a': 'II' || w[4].a}}]),
          list_min([w[3], {{'c': 2 + w[4].c, 'a': 'I' || w[4].a}}]), list_min([w[4], {{'c': 2 + w[3].c, 'a': 'I' || w[3].a}}])]
        FROM (SELECT conv_id, p, [{", ".join(_repair_step(q) for q in range(4))}] AS w
              FROM (SELECT best.conv_id, best.p, b, i, fault FROM best JOIN judged ON judged.conv_id IS NOT DISTINCT FROM best.conv_id AND judged.p = best.p))),
      chosen AS (SELECT conv_id, b[1].c AS cost, b[1].a AS audit FROM best WHERE p = 0),
      letters AS (
        SELECT conv_id, k, audit[k] AS letter, (k - length(replace(audit[:k], 'I', '')))::BIGINT AS added
        FROM chosen, unnest(range(1, length(audit) + 1)) u(k)),
      edited AS (
        SELECT l.conv_id, k, letter, role, text, CASE WHEN letter = 'K' THEN i END AS i
        FROM letters l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.p = k - added AND letter <> 'I'
        WHERE letter <> 'D'),
      sequenced AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS place FROM edited),
      starts AS (SELECT conv_id, coalesce(max(place) FILTER (letter = 'K' AND i = 's'), 0) AS s FROM sequenced GROUP BY conv_id),
      named AS (
        SELECT q.conv_id, place, CASE WHEN letter = 'K' THEN role WHEN (place - s) % 2 = 1 THEN 'user' ELSE 'assistant' END AS role,
          CASE WHEN letter = 'I' THEN '' ELSE text END AS text
        FROM sequenced q JOIN starts z ON q.conv_id IS NOT DISTINCT FROM z.conv_id),
      repaired AS (SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY place) AS t FROM named GROUP BY conv_id)
      SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
        coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
      FROM (SELECT DISTINCT conv_id FROM conversations) o
      LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
      LEFT JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
      LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op12_prefix_trie": f"""
      WITH own AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p,
          {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t FROM conversations WHERE conv_id IS NOT NULL),
      lists AS (SELECT conv_id, list(t ORDER BY p) AS l FROM own GROUP BY conv_id),
      heads AS (SELECT conv_id, l, conv_id - conv_id % 5 AS donor, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM lists),
      rebuilt AS (
        SELECT x.conv_id, list_concat(coalesce(d.l, [])[:h], x.l[h + 1:]) AS l FROM heads x LEFT JOIN lists d ON d.conv_id = x.donor),
      members AS (SELECT conv_id, d, l[:d] AS node, l[:d - 1] AS above, len(l) = d AS ends FROM rebuilt, unnest(range(len(l) + 1)) u(d)),
      nodes AS (
        SELECT node, d, min(conv_id) AS conv_id, any_value(above) AS above, count(*) AS n_convs, bool_and(ends) AS leaf,
          CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(node[d].text)) END AS saved,
          sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM members GROUP BY node, d),
      totals AS (
        SELECT a.node, count(*) FILTER (n.leaf) AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
        FROM nodes n, unnest(range(n.d + 1)) u(k), nodes a WHERE a.d = k AND a.node = n.node[:k] GROUP BY a.node),
      children AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY above)
      SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
        n_leaves, saved_tokens, n.ends_sha256
      FROM nodes n JOIN totals USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes p ON n.d > 0 AND p.node = n.above""",
    "op13_quality": f"""
      WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
      lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
          count(*) FILTER (regexp_matches(line, '[.!?][\x20\x09-\x0D]*$')) AS n_ended_lines
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
      windows AS (SELECT doc_id, p, array_to_string(w[p : p + 4], ' ') AS g FROM d, unnest(range(1, len(w) - 3)) u(p)),
      repeated AS (SELECT doc_id, list(p) AS ps FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
      repeats AS (SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM repeated, unnest(ps) s(p), unnest(range(5)) u(k) GROUP BY doc_id),
      counts AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
          len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
          coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_ended_lines, 0) AS n_ended_lines,
          len(list_filter(w, lambda x: regexp_matches(x, '{quality.SHOUTED}')))::BIGINT AS n_shouted,
          len(list_filter(w, lambda x: regexp_matches(x, '{quality.DECORATED}')))::BIGINT AS n_decorated,
          len(list_filter(w, lambda x: regexp_matches(x, '{quality.LONE_MARK}')))::BIGINT AS n_lone_marks
        FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
      votes AS (SELECT *, [{_votes()}] AS v FROM counts),
      patterns AS (SELECT v, count(*)::DOUBLE AS n FROM votes GROUP BY v),
      fitted AS (
        SELECT 0 AS round, {quality.SHARE}::DOUBLE AS prior, list_transform(range({len(quality.RULES)}), lambda i: {quality.RIGHT_GOOD}::DOUBLE) AS good,
          list_transform(range({len(quality.RULES)}), lambda i: {quality.RIGHT_BAD}::DOUBLE) AS bad
        UNION ALL
        SELECT round, prior, good, list_transform(range({len(quality.RULES)}), lambda i: greatest(bad[i + 1], 1 - good[i + 1])) AS bad
        FROM (
          SELECT round + 1 AS round, (sum(n * g) + {quality.SHARE * quality.STRENGTH}) / (sum(n) + {quality.STRENGTH}) AS prior,
            {_estimates("g", 1, quality.RIGHT_GOOD)} AS good, {_estimates("(1 - g)", -1, quality.RIGHT_BAD)} AS bad
          FROM (SELECT round, v, n, 1 / (1 + exp(-({_odds()}))) AS g FROM fitted, patterns WHERE round < {quality.ROUNDS}) GROUP BY round)),
      scored AS (
        SELECT votes.*, round(1 / (1 + exp(-({_odds()}))), 6) AS quality, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
        FROM votes, fitted WHERE round = {quality.ROUNDS})
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND quality >= 0.5 AS kept, quality FROM scored""",
}

"""Operators against plain versions, on the given tables and on rows at the edges."""

import hashlib
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from galley.llm import bpe, components, cover_tree, decontaminate, language_id, near_dup, suffix_dedup, token_counts, token_files, toxicity, url_filter
from galley.llm.common import fresh
from galley.llm.queries import QUERIES, tokenizer_path
from galley.session import scratch_path
from tests.llm import plain

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# --- suffix dedup


def test_repeated_bytes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 400 or doc_id % 3 = 0")
    expected = plain.repeated_bytes(rows(docs))
    found = suffix_dedup.repeated(docs).collect()
    assert len(found) == len(expected)
    assert sum(e[1] for e in expected.values()) > 0
    for r in found:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id], r.doc_id
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_repeated_bytes_with_every_digit_frequent_and_small_blocks(documents, monkeypatch):
    expected = plain.repeated_bytes(rows(documents))
    for name, value in (("FREQUENT", 1), ("BLOCK_BYTES", 40_000), ("BUCKET_BYTES", 20_000), ("SLICE", 10_000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    for r in suffix_dedup.repeated(documents).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id]


@pytest.mark.parametrize("length", [1, 2, 7, 8, 9, 33])
def test_repeated_bytes_of_other_lengths(spark, length):
    rng = np.random.default_rng(length)
    data = [(i, "".join(rng.choice(list("ab"), rng.integers(0, 60)))) for i in range(60)]
    expected = plain.repeated_bytes(data, length)
    for r in suffix_dedup.repeated(spark.createDataFrame(data, "doc_id long, text string"), length).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id]


def test_repeated_words(documents):
    expected = plain.without_repeated_words(rows(documents), 20)
    found = suffix_dedup.remove_repeated(documents, 20)
    assert found.columns == documents.columns
    assert {r.doc_id: r.text for r in found.collect()} == expected


@pytest.mark.parametrize("part", ["-", "ha ha, "])
def test_repeated_long_runs_of_a_short_period(spark, part):
    other = "".join(np.random.default_rng(5).choice(list("abcdef"), 300))
    data = [(1, other + part * 70_000), (2, part * 100_000 + other[:200]), (3, part * 60), (4, other)]
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    expected = plain.repeated_bytes(data)
    for r in suffix_dedup.repeated(docs).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id], r.doc_id
    words = [(1, "one " + "tick tock " * 70_000), (2, "tick tock " * 100_000 + "two"), (3, "a tick " + "tock tick " * 30)]
    found = suffix_dedup.remove_repeated(spark.createDataFrame(words, "doc_id long, text string").coalesce(1), 50)
    assert {r.doc_id: r.text for r in found.collect()} == plain.without_repeated_words(words, 50)


def test_repeated_edges(edges, no_documents):
    found = suffix_dedup.repeated(edges).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == edges.count()
    assert by_id[1].n_removed == 0 and by_id[2].n_removed == by_id[2].n_bytes and by_id[2].n_spans == 1
    assert by_id[3].n_bytes == by_id[4].n_bytes == 0 and by_id[3].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_id[None].n_removed > 0 and by_id[11].n_removed == 0
    assert suffix_dedup.repeated(no_documents).collect() == []
    cut = {r.doc_id: r for r in suffix_dedup.remove_repeated(edges).collect()}
    assert cut[2].text == "" and cut[3].text is None and cut[1].text and cut[2].score == "x" and cut[None].text == " more"
    assert suffix_dedup.remove_repeated(no_documents).collect() == []


# --- toxicity


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").collect()
    kept = [r for r in scored if r.held_out]
    assert all(r.held_out == plain.held_out(r.doc_id) for r in scored)
    assert plain.auc([r.score for r in kept], [r.toxic for r in kept]) > 0.88
    clean = [r for r in kept if not r.toxic]
    assert sum(r.predicted for r in clean) < 0.05 * len(clean)
    assert sum(r.predicted for r in kept if r.toxic) > 0.6 * sum(r.toxic for r in kept)


def test_toxicity_edges(spark, edges, no_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.fit(edges, labels)
    found = toxicity.score(edges, model).collect()
    assert len(found) == edges.count() and all(r.score == 0 and r.predicted == 0 for r in found)
    rng = np.random.default_rng(1)
    text = lambda: " ".join("".join(rng.choice(list("aeionrst"), 6)) for _ in range(60))
    model = toxicity.train([f"{text()} nastyword {text()} nastyword".encode() for _ in range(60)], [text().encode() for _ in range(60)])
    found = toxicity.score(edges, model, columns=edges.columns)
    assert found.columns == [*edges.columns, "held_out", "score_", "predicted"]
    low = {r.doc_id: r.score_ for r in found.collect()}
    assert low[3] == low[4] < 0.5 and 0 <= min(low.values()) <= max(low.values()) <= 1
    assert toxicity.remove_toxic(edges, model).columns == edges.columns
    assert toxicity.score(no_documents, model).collect() == []


# --- token counts


def test_section_tokens(documents):
    tool = Tokenizer.from_file(BYTE)
    expected = {}
    for i, text in rows(documents.limit(80)):
        found = tool.encode(text, add_special_tokens=False)
        bounds = np.cumsum([len(line) for line in text.splitlines(keepends=True)] if "\n" in text else [len(text)])
        section = np.searchsorted(bounds, [a for a, _ in found.offsets], "right")
        for s, n in enumerate(np.bincount(section, minlength=len(bounds)).tolist()):
            expected[i, s] = n
    got = {(r.doc_id, r.section): r.n_tokens for r in token_counts.section_tokens(documents.limit(80), BYTE).collect()}
    assert got == expected


def test_section_tokens_rules_and_edges(spark, edges, no_documents):
    whole = {i: len(Tokenizer.from_file(BYTE).encode(t or "", add_special_tokens=False).ids) for i, t in rows(edges)}
    for rule in ("start", "most"):
        total = {}
        for r in token_counts.section_tokens(edges.dropDuplicates(["doc_id"]), BYTE, rule).collect():
            total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
        assert total == whole
    assert token_counts.section_tokens(no_documents, BYTE).collect() == []
    # tokens of characters 0-1, 2-5, 6-6 over sections that end at 3 and 7
    first, last, ends = np.array([0, 2, 6]), np.array([1, 5, 6]), np.array([3, 7])
    assert token_counts.allocate(first, last, ends, "start")[0].tolist() == [0, 0, 1]
    chosen, crossing = token_counts.allocate(first, last, ends, "most")
    assert chosen.tolist() == [0, 1, 1] and crossing.tolist() == [False, True, False]
    with pytest.raises(ValueError):
        token_counts.section_tokens(edges, BYTE, "none")


# --- near duplicates


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(documents, k, percent):
    expected = plain.near_duplicates(rows(documents), k, percent)
    found = near_dup.near_duplicates(documents, k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A large group of near copies, cut into blocks, with links that only chains give."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    data = []
    for i in range(120):
        words = list(base)
        for p in rng.choice(300, rng.integers(0, 22), replace=False):
            words[p] = f"x{rng.integers(0, 60)}"
        data.append((int(rng.integers(0, 10**6)) * 200 + i, " ".join(words)))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    expected = plain.near_duplicates(data, 3, 85)
    assert 1 < len({c for _, c in expected.values()}) < 120
    monkeypatch.setattr(near_dup, "GROUP", 16)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs, 3, 85).collect()} == expected


def test_near_duplicates_edges(edges, no_documents):
    found = {r.doc_id: r for r in near_dup.near_duplicates(edges, 3, 85).collect()}
    assert found[2].component_id == 1 and not found[2].kept and found[1].kept
    assert found[9].component_id == 8 and found[6].n_shingles == 1
    assert found[3].n_shingles == found[4].n_shingles == found[5].n_shingles == 0
    assert found[3].component_id == 3 and found[4].kept
    assert found[None].component_id is None and found[None].kept
    kept = near_dup.keep_one(edges, 3, 85)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 11, 12]
    assert near_dup.near_duplicates(no_documents, 3, 85).collect() == []


def test_different_texts_of_one_id_are_judged_each_on_its_own(spark):
    text = lambda name: " ".join(f"{name}{n}" for n in range(80))
    copied, near = text("a"), text("a").replace("a79", "z")
    data = [(1, copied), (30, near), (30, text("c")), (30, text("c")), (None, copied)]
    data += [(i, t) for i in range(5, 25) for t in (copied, text(f"b{i}x"))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = near_dup.keep_one(docs, 3, 85)
    assert found.columns == docs.columns
    kept = [(1, copied), (30, text("c")), (0, copied), *[(i, text(f"b{i}x")) for i in range(5, 25)]]
    assert sorted((r.doc_id or 0, r.text) for r in found.collect()) == sorted(kept)


def test_agreements_misses_few():
    """Two sets at the threshold agree on fewer coordinates about once in a million pairs."""
    need = near_dup.agreements(85)
    rng = np.random.default_rng(0)
    assert (rng.binomial(near_dup.COORDINATES, 0.85, 200_000) >= need).mean() > 0.99998


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 300), (7, 7)]
    found = {r.node: r.label for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {found[i] for i in range(1, 41)} == {1} and {found[i] for i in (100, 200, 300)} == {100}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- byte-pair encoding and token files


def test_bpe(documents, edges):
    tool = Tokenizer.from_file(WORD)
    for docs in (documents, edges):
        found = bpe.decode(bpe.encode(docs, WORD, columns=["doc_id", "text"]), WORD).collect()
        assert len(found) == docs.count()
        for r in found:
            ids = tool.encode(r.text or "", add_special_tokens=False).ids
            assert r.ids == ids and r.decoded == tool.decode(ids, skip_special_tokens=False)


def test_bpe_on_odd_texts():
    tool, own = Tokenizer.from_file(WORD), bpe.WordEncoder(WORD)
    rng = np.random.default_rng(3)
    alphabet = list("abAB'stT.! \n\xe9\u0301<|>1२日²½İßǅ_\u0085\xa0\x1c\x00") + ["<|endoftext|>", "<|startoftext|>", "'ll", "aaaa"]
    texts = ["", "a" * 3001, "abab" * 700, *("".join(rng.choice(alphabet, rng.integers(1, 60))) for _ in range(1500))]
    words = [own.words(t) for t in texts]
    numbers = np.array([own.numbers[w] for found in words for w in found])
    own.learn()
    ids, offsets = own.gather(numbers, np.cumsum([len(w) for w in words]))
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == tool.encode(text, add_special_tokens=False).ids


def test_bpe_learns_many_new_words_in_little_memory():
    """What the merges hold is bounded by the words taken together, not by all new words of a block."""
    tool, own = Tokenizer.from_file(WORD), bpe.WordEncoder(WORD)
    letters = np.random.default_rng(6).integers(97, 123, 300_000 * 9, np.uint8).tobytes().decode()
    words = [letters[at : at + 9] for at in range(0, len(letters), 9)]
    words[1000], words[299_000] = "\n<|endoftext|>", "\n<|startoftext|>"
    numbers = np.array([own.numbers[w] for w in words])
    tracemalloc.start()
    own.learn()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
    ids, offsets = own.gather(numbers, np.arange(1, len(words) + 1))
    for at in [*range(0, len(words), 997), 1000, 299_000, len(words) - 1]:
        expected = tool.encode(words[at].strip(), add_special_tokens=False).ids
        assert ids[offsets[at] : offsets[at + 1]].tolist() == expected


def test_bpe_gives_blocks_out_early(spark, monkeypatch):
    """Blocks that end with a few new words, and words forgotten after each, change no row and no id."""
    tool = Tokenizer.from_file(WORD)
    data = [(i, None if i % 50 == 7 else "" if i % 50 == 8 else f"plain words x{i * 7919} \u65e5\u672c{i % 4} <|endoftext|> it's {i % 3}") for i in range(400)]
    for name, value in (("NEW_WORDS", 5), ("REMEMBERED", 20), ("SLICE", 100)):
        monkeypatch.setattr(bpe, name, value)
    docs = spark.createDataFrame([*data, data[0], (None, "no id")], "doc_id long, text string").coalesce(1)
    found = bpe.encode(docs, WORD, decoded="decoded").collect()
    expected = [tool.encode(text or "", add_special_tokens=False).ids for _, text in [*data, data[0], (None, "no id")]]
    assert [r.doc_id for r in found] == [*range(400), 0, None]
    assert [r.ids for r in found] == expected
    assert [r.decoded for r in found] == [tool.decode(ids, skip_special_tokens=False) for ids in expected]


def test_pair_index_takes_lower_ranks_first():
    """A merge that gives a pair of a lower rank, which the next merge in the word must wait for."""
    characters = bpe.byte_characters()
    vocabulary = {c: i for i, c in enumerate(characters)} | {c + "$": 256 + i for i, c in enumerate(characters)}
    merges = [("b", "c"), ("a", "bc"), ("abc", "d"), ("a", "b"), ("ab", "c"), ("a", "a"), ("d", "d"), ("x", "y"), ("xy", "x"), ("y", "x")]
    for a, b in merges:
        vocabulary.setdefault(a + b, len(vocabulary))
    index = bpe.PairIndex(vocabulary, merges, "$")
    rank = {pair: r for r, pair in enumerate(merges)}

    def slowly(word):
        parts = [*word[:-1], word[-1] + "$"]
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
            if best is None:
                return [vocabulary[p] for p in parts]
            parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]

    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdxy"), rng.integers(1, 14))) for _ in range(2000)]
    ids, counts = index.encode([w.encode() for w in words])
    for word, found in zip(words, np.split(ids, np.cumsum(counts)[:-1])):
        assert found.tolist() == slowly(word)


def test_bpe_edges(edges, no_documents):
    found = bpe.encode(edges, WORD, as_bytes=True, decoded="score")
    assert found.columns == ["doc_id", "lang", "score", "ids", "ids_", "score_"]
    empty = [r for r in found.collect() if r.doc_id in (3, 4, 5)]
    assert all(r.ids_ == b"" and r.score_ == "" for r in empty) and len(empty) == 3
    assert bpe.encode(no_documents, WORD).collect() == []


def test_token_files(spark, edges, documents):
    tool = Tokenizer.from_file(BYTE)
    for docs in (documents, edges.where("doc_id is not null")):
        path = scratch_path(spark, "tokens")
        token_files.write_token_files(docs, path, BYTE, end_id=0)
        read = token_files.read_token_files(spark, path)
        start = 0
        expected = []
        for i, text in sorted(rows(docs), key=lambda r: (r[0], r[1] or "")):
            ids = [*tool.encode(text or "", add_special_tokens=False).ids, 0]
            expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert sorted(tuple(r) for r in token_files.checksums(read).collect()) == sorted(expected)
        one = read.where("doc_id = 7")
        assert "PushedFilters" in one._jdf.queryExecution().toString() and one.count() == 1


def test_token_files_of_nothing(spark, no_documents):
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(no_documents, path, BYTE)
    assert token_files.checksums(token_files.read_token_files(spark, path)).collect() == []


# --- top-k search


def test_top_k(spark):
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(0, 0.3, 8).round(3).tolist()) for i in range(700)]
    data += [(1000 + i, data[3][1]) for i in range(300)]  # many equal vectors
    data += [(5000, None), (5001, [1.0, None]), (5002, [float("nan")] * 8), (5050, [float("inf")] * 8), (5100, []), (None, [0.1] * 8), (50, data[50][1])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    expected = plain.top_k(data, lambda i: i % 50 == 0)
    for block_rows in (8192, 97):
        found = cover_tree.top_k(vectors, vectors.vec_id % 50 == 0, block_rows=block_rows).collect()
        assert sorted(tuple(r) for r in found) == expected
    assert cover_tree.top_k(vectors.where("false"), vectors.vec_id % 50 == 0).collect() == []
    assert cover_tree.top_k(vectors.where("vec_id = 50"), vectors.vec_id % 50 == 0).collect() == []


def test_top_k_over_blocks(spark):
    """Clusters in blocks of their own, a hot one cut into pieces, ids that repeat with other vectors."""
    rng = np.random.default_rng(11)
    centers = rng.normal(0, 1, (6, 12))
    data = [(i, (centers[min(i % 9, 5)] + rng.normal(0, 0.05, 12)).round(3).tolist()) for i in range(900)]
    data += [(50, [0.0] * 12), (7, [9.0] * 12), (50, data[50][1])]
    smallest = {}
    for i, v in data:
        smallest[i] = min(smallest.get(i, v), v, key=lambda x: [int(np.floor(256 * y)) for y in x])
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
    expected = plain.top_k(list(smallest.items()), lambda i: i % 10 == 0)
    for block_rows in (64, 300):
        found = cover_tree.top_k(vectors, vectors.vec_id % 10 == 0, block_rows=block_rows).collect()
        assert sorted(tuple(r) for r in found) == expected


def clustered(count=2000, width=4):
    rng = np.random.default_rng(6)
    return np.floor(256 * np.concatenate([rng.normal(c, 0.1, (count // 5, width)) for c in range(5)]))


def test_cover_tree_covers_and_separates():
    tree = cover_tree.Tree(clustered())
    assert sorted(tree.order.tolist()) == list(range(2000)) and len(tree.nodes) > 20
    for first, stop, center, radius, norm, children, level, longest in tree.nodes:
        members = tree.rows[first:stop]
        assert np.sqrt(((members - center) ** 2).sum(axis=1)).max() <= radius + 1e-9
        assert np.sqrt((members**2).sum(axis=1)).max() <= longest + 1e-9 and norm <= longest
        assert level is None and radius == 0 or radius <= 2.0**level
        if children:
            inside = [tree.nodes[c] for c in children]
            assert [c[0] for c in inside] == [first, *(c[1] for c in inside[:-1])] and inside[-1][1] == stop
            assert all(c[6] is None or c[6] <= level - 1 for c in inside)
            centers = np.array([c[2] for c in inside])
            apart = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(axis=2))
            assert (apart[~np.eye(len(centers), dtype=bool)] > 2.0 ** (level - 1)).all()


def test_cover_tree_prunes():
    """On vectors in clusters the search computes less than 30 % of all products; floors from elsewhere save more."""
    rng = np.random.default_rng(0)
    points = np.floor(256 * (rng.normal(size=(20, 32))[rng.integers(0, 20, 4000)] + 0.05 * rng.normal(size=(4000, 32))))
    ids = np.arange(len(points))
    asked = points[::20]
    tree, query = cover_tree.Tree(points), cover_tree.Tree(asked, cover_tree.QUERY_LEAF)
    found = cover_tree.search(tree, ids[tree.order], query, ids[::20][query.order], 5)
    scores = asked[query.order] @ points.T
    scores[np.arange(len(asked)), ids[::20][query.order]] = -np.inf
    expected = np.array([np.lexsort((ids, -row))[:5] for row in scores])
    assert (found.ids == expected).all()
    assert found.compared < 0.3 * len(points) * len(asked)
    again = cover_tree.search(tree, ids[tree.order], query, ids[::20][query.order], 5, found.scores[:, -1])
    assert (again.ids == expected).all() and again.compared <= found.compared


# --- URL filter


def test_url_filter(spark):
    data = [
        (1, "https://blog.Example.ORG/en/12?x=1"), (2, "http://example.org/es/1"), (3, "http://a.example.org/es/1#top"),
        (4, "http://badexample.org/es/1"), (5, "http://x.com/fr/1"), (6, "HTTP://X.COM/de/"), (7, "http://x.com/de"),
        (8, None), (9, "no scheme"), (10, "http://example.org"), (11, "http://casino.example.net/slots/free-spins"),
        (12, "https://news.example.net/en/2024"), (12, "https://news.example.net/en/2024"), (13, "a://b://c/d"), (14, ""),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS verdict")
    model = url_filter.train(url_filter.labelled_urls(spark))
    judged = url_filter.judge(pages, model)
    found = {r.page_id: r for r in judged.collect()}
    assert judged.count() == len(data)
    assert (found[1].host, found[1].path, found[1].rule, found[1].verdict) == ("blog.example.org", "/en/12", "example.org/en/1", "block")
    assert found[2].rule == found[3].rule == "example.org/es/" and found[4].rule == "org/" and found[4].verdict == "allow"
    assert (found[5].rule, found[6].rule, found[7].rule) == ("com/fr/", "com/de/", None)
    assert (found[8].host, found[8].path, found[8].rule) == ("", "", None) and found[9].host == "" and found[14].host == ""
    assert found[10].rule is None and found[10].host == "example.org" and found[10].path == ""
    assert found[11].verdict == "block" and found[12].verdict == "allow" and found[13].host == "b:"
    assert url_filter.judge(pages.where("false"), model).collect() == []
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_url_scores(spark, small):
    """Scores are those of the weights over hashed n-grams, counted plainly."""
    model = url_filter.train(url_filter.labelled_urls(spark))
    pages = spark.read.parquet(f"{small}/pages.parquet").limit(100)
    for r in url_filter.judge(pages, model).collect():
        total = model.intercept
        for text, mark in ((f"^{r.host}$", "h"), (r.path, "p")):
            for n in url_filter.GRAMS:
                total += sum(model.weights[zlib.crc32((mark + text[p : p + n]).encode()) % url_filter.BUCKETS] for p in range(len(text) - n + 1))
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)
    labelled = url_filter.judge(url_filter.labelled_urls(spark).selectExpr("0 AS page_id", "url"), model, rules=())
    wanted = dict.fromkeys(url_filter.ALLOWED, "allow") | dict.fromkeys(url_filter.BLOCKED, "block")
    hosts = {}
    for url, verdict in wanted.items():
        rest = url.split("://")[1].split("?")[0]
        hosts[rest.partition("/")[0], "/" + rest.partition("/")[2]] = verdict
    assert all(hosts[r.host, r.path] == r.verdict for r in labelled.collect())


# --- decontamination


def test_decontaminate(spark, documents, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    expected = plain.benchmark_hits(rows(documents), items)
    assert sum(bool(hit) for _, hit, _ in expected.values()) > 0
    for limit in (decontaminate.BROADCAST_BYTES, 2000):
        found = decontaminate.mark(documents, benchmark, broadcast_bytes=limit).collect()
        for r in found:
            places, hit, names = expected[r.doc_id]
            assert (r.n_words, r.hit_words, r.items) == (len(places), sorted(hit), sorted(names))
    cut = decontaminate.remove_spans(documents, benchmark)
    assert cut.columns == documents.columns
    for r in cut.collect():
        original = dict(rows(documents))[r.doc_id]
        places, hit, _ = expected[r.doc_id]
        assert r.text == plain.cut(original, [(a, b) for a, b, _ in places], [p in hit for p in range(len(places))])
    kept = {r.doc_id for r in decontaminate.remove_documents(documents, benchmark).collect()}
    assert kept == {i for i, (_, hit, _) in expected.items() if not hit}


def test_decontaminate_edges(spark, edges, no_documents):
    items = [(1, "A b"), (1, "a B"), (2, None), (3, " .. "), (None, "word3 word4 word5"), (4, "a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.mark(edges, benchmark, n=10).collect()}
    assert found[3].n_words == 0 and found[6].items == ["4"] and found[8].items == ["1", "4"] and found[8].hit_words == [0, 1]
    assert found[1].items == ["null"] and found[12].items == []
    assert decontaminate.mark(edges, benchmark.where("false")).where("size(items) > 0").count() == 0
    assert decontaminate.mark(no_documents, benchmark).collect() == []
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(edges, benchmark).collect()}
    assert cut[6] == "" and cut[8] == " c" and cut[3] is None
    assert decontaminate.mark(edges, benchmark, columns=["doc_id", "ids"]).columns == ["doc_id", "ids", "n_words", "hit_words", "items"]


# --- language


def test_language_on_held_out_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = language_id.predict(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    kept = [r for r in found if r.held_out]
    assert len(found) == docs.count() and all(r.held_out == plain.held_out(r.doc_id) for r in found)
    assert sum(r.lang == r.lang_pred for r in kept) > 0.97 * len(kept)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edges(edges, no_documents):
    model = language_id.fit(edges)
    found = {r.doc_id: r for r in language_id.predict(edges, model).collect()}
    assert {found[i].lang_pred for i in (3, 4, 5, 7)} == {"und"} and found[1].lang_pred in ("en", "fr", "de")
    nothing = language_id.predict(edges, language_id.fit(no_documents)).collect()
    assert len(nothing) == edges.count() and {r.lang_pred for r in nothing} == {"und"}
    assert language_id.predict(no_documents, model).collect() == []
    model.reject_below = 1.1
    assert {r.lang_pred for r in language_id.predict(edges, model, reject=True).collect()} == {"und"}


def test_fresh():
    assert fresh("a", ["A", "a_"]) == "a__"


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))


def test_words_of_one_short_hash_are_told_apart(spark):
    """Two words whose 32-bit hashes are equal do not make their passages equal."""
    first = " ".join(f"word{i}" for i in range(30)) + " w1d096 " + " ".join(f"tail{i}" for i in range(29))
    docs = spark.createDataFrame([(1, first), (2, first.replace("w1d096", "w53dd3")), (3, first)], "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.text for r in suffix_dedup.remove_repeated(docs, 50).collect()}
    assert found == {1: first, 2: first.replace("w1d096", "w53dd3"), 3: ""}


def test_equal_hashes_of_different_tokens_are_told_apart(documents, monkeypatch):
    """With one hash for the contents of all runs, groups are found by their tokens alone."""
    data = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4, 1, 2], np.uint8)
    offset, size = np.array([0, 3, 6, 9]), np.array([3, 3, 3, 2])
    zeros = np.zeros(4, np.uint64)
    order, new, content = suffix_dedup._groups(zeros, zeros, np.array([4, 3, 2, 1]), size, offset, data)
    groups = {}
    for place, number in zip(order.tolist(), np.cumsum(new).tolist()):
        groups.setdefault(number, set()).add(place)
    assert sorted(groups.values(), key=min) == [{0, 1}, {2}, {3}]
    assert len(set(content.tolist())) == 3


def test_piece_encoder_equals_the_library(monkeypatch):
    from galley.llm import pieces

    tool = Tokenizer.from_file(BYTE)
    rng = np.random.default_rng(8)
    parts = ["word", "Word,", "it's", " ", "  ", "\n", "\t", " \n", "12", "日本", "é", " ", " x", "<|endoftext|>", "...", "\x00", "\x1c", "😀", "don't\nstop", "", "'s", " a"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12)).tolist()) for _ in range(3000)] + ["", " ", "a ", " a", "\n a", "a\n b", "a  b"]
    monkeypatch.setattr(pieces, "JOINED", 7)
    monkeypatch.setattr(pieces, "REMEMBERED", 300)
    for path in (BYTE, WORD):
        tool, own = Tokenizer.from_file(path), pieces.PieceEncoder(path)
        assert own.cuts == (path == BYTE)
        for at in range(0, len(texts), 100):
            some = texts[at : at + 100]
            ids, counts = own.encode(some)
            expected = [tool.encode(t, add_special_tokens=False).ids for t in some]
            assert counts.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])
    ids, counts = pieces.PieceEncoder(BYTE).encode([])
    assert len(ids) == len(counts) == 0


def test_piece_encoder_encodes_no_word_again(monkeypatch):
    """A new piece of known words needs neither the model nor the splitter."""
    from galley.llm import pieces

    own, asked = pieces.PieceEncoder(BYTE), []
    own.encode(["alpha\n beta Gamma, delta... été,"])
    monkeypatch.setattr(own, "_encoded", lambda text: asked.append(text))
    monkeypatch.setattr(own, "model", None)
    texts = ["alpha beta, delta... été\n beta,\n", None, "alpha, delta,\n"]
    ids, counts = own.encode(texts)
    tool = Tokenizer.from_file(BYTE)
    expected = [tool.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])
    assert asked == []


def test_piece_encoder_on_every_character_and_kind_of_byte():
    from galley.llm import pieces

    tool, own = Tokenizer.from_file(BYTE), pieces.PieceEncoder(BYTE)
    forms = ["{0}", "a{0}", "{0}a", "1{0}1", " {0}", "{0} a", "a {0}a", ".{0}.", "a{0}{0}b", "a\n{0}\n\nb", "é{0}9 x", "'{0}"]
    texts = [form.format(chr(c)) for c in [*range(0x300), 0x2003, 0x2028, 0x3000, 0x1F600] for form in forms]
    rng = np.random.default_rng(9)
    some = ["a", "é", "ƀ", "×", "1", ".", "\n", "\r\n", "\t", "\v", "\f", " ", " ", " ", "'s", "½", "Ω"]
    texts += ["".join(rng.choice(some, rng.integers(0, 14)).tolist()) for _ in range(20_000)]
    ids, counts = own.encode(texts)
    expected = [tool.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])


def test_keep_one_with_clashing_names(edges):
    docs = edges.withColumn("_kept", edges.doc_id).withColumn("kept_id", edges.doc_id).withColumn("Kept", edges.doc_id)
    found = near_dup.keep_one(docs)
    assert found.columns == docs.columns
    assert {r.doc_id for r in found.collect()} == {r.doc_id for r in near_dup.keep_one(edges).collect()}

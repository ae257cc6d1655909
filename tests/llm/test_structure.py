"""Conversations and quality rules against plain versions, and rows at the edges."""

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from galley.llm import ordinals, prefix_trie, quality, repair
from galley.llm.common import ship

CONVERSATIONS = "conv_id long, turn long, role string, text string, place string, part int"


def table(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATIONS)


# --- places within keys


def test_places_continue_over_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), i % 97, "r", f"t{i % 5}") for i in range(3000)]
    docs = table(spark, rows).repartition(7)
    found = ordinals.numbered(docs, "conv_id", ["turn", "role", "text"], [F.col("turn")], "place_").collect()
    by_key = defaultdict(list)
    for r in found:
        by_key[r.conv_id].append(r)
    assert len(found) == len(rows)
    for key, group in by_key.items():
        group.sort(key=lambda r: r.place_)
        assert [r.place_ for r in group] == list(range(sum(row[0] == key for row in rows)))
        assert [(r.turn, r.text) for r in group] == sorted((r.turn, r.text) for r in group)
    assert found[0].place == "x" and found[0].part == 1
    assert ordinals.numbered(docs.where("false"), "conv_id", ["turn"], [F.col("turn")], "place_").collect() == []


# --- repair


def cheapest(marks):
    """Cost and least letters by search over (cost, letters)."""
    n, seen, heap = len(marks) // 2, set(), [(0, "", 0, repair.EMPTY)]
    while True:
        cost, letters, i, state = heapq.heappop(heap)
        if i == n and state in repair.LEGAL_ENDS:
            return cost, letters
        if (i, state) not in seen:
            seen.add((i, state))
            ways = repair.arcs(marks[2 * i], marks[2 * i + 1], state) if i < n else [("I", 2, 0, repair.WANTED[state])]
            for letter, more, step, to in ways:
                heapq.heappush(heap, (cost + more, letters + letter, i + step, to))


def test_auction_finds_the_least_cheapest_edits():
    rng = random.Random(1)
    for _ in range(1500):
        marks = "".join(rng.choice("suua?") + rng.choice("0000123") for _ in range(rng.randint(0, 10)))
        assert repair.edits(marks) == cheapest(marks), marks


def test_prices_are_feasible_and_tight():
    rng = random.Random(2)
    marks = "".join(rng.choice("sua?") + rng.choice("000123") for _ in range(300))
    price = repair.prices(marks)
    for i in range(300):
        for state in range(4):
            ends = [cost + price[4 * (i + step) + to] for _, cost, step, to in repair.arcs(marks[2 * i], marks[2 * i + 1], state)]
            assert price[4 * i + state] == min(ends)


def test_prices_take_time_in_proportion(monkeypatch):
    def steps(n):
        looked = 0

        class Counting(list):
            def __getitem__(self, k):
                nonlocal looked
                looked += 1
                return super().__getitem__(k)

        monkeypatch.setattr(repair, "_ARCS", {k: Counting(v) for k, v in plain_arcs.items()})
        repair.prices("u0a1" * n)
        return looked

    plain_arcs = dict(repair._ARCS)
    assert steps(2000) < 2.1 * steps(1000)


def plain_report(rows):
    """{conv_id: (blank, duplicate, truncated, illegal, cost, audit, digest)} of rows without damage."""
    found = {}
    for conv in {r[0] for r in rows}:
        own = [(turn, " " if role is None else role, " " if text is None else text) for c, turn, role, text in rows if c == conv]
        own = [r[1:] for r in sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))]
        marks, seen, faults = "", set(), Counter()
        for role, text in own:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            marks += (role[:1] if role[:1] in ("s", "u", "a") else "?") + str(fault)
        cost, audit = cheapest(marks)
        lines, state, at = [], 0, 0
        for letter in audit:
            if letter == "I":
                state = repair.WANTED[state]
                lines.append(repair.NAMES[state] + ":")
                continue
            role, text = own[at]
            at += 1
            if letter != "D":
                state = repair.AFTER[role[0]][state] if letter == "K" else repair.WANTED[state]
                lines.append((role if letter == "K" else repair.NAMES[state]) + ":" + text)
        roles = "".join(line[0] for line in lines)
        assert re.fullmatch("(s?(ua)+)?", roles), roles
        found[conv] = (faults[1], faults[2], faults[3], repair.illegal_pairs(marks), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def odd_conversations():
    rng = random.Random(5)
    texts = ["Fine.", "Why?", "no end", "", " \t\n", None, "Tail. \n", "x" * 70_000 + "!", "é日本.", "Fine."]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(["system", "user", "assistant", "tool", "", None, "user"]), rng.choice(texts))
            for c in [None, -7, *range(12)] for _ in range(rng.randint(1, 12))]
    rows += [(100, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(9001)]
    return rows + rows[:5]


def test_report_against_plain(spark):
    rows = odd_conversations()
    talks = table(spark, rows)
    marked = repair.marked(repair.damaged(talks, F.lit(19)))
    marked = marked.cache()
    found = {r.conv_id: r for r in repair.report(talks, marked).collect()}
    expected = plain_report(rows)
    assert found.keys() == expected.keys()
    for conv, r in found.items():
        assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == expected[conv], conv
    edits = repair.repair(marked)
    turns = repair.repaired_turns(marked, edits).where("conv_id = 100").orderBy("place").collect()
    assert len(turns) >= 9000 and [t.place for t in turns] == list(range(len(turns)))
    assert "".join(t.role[0] for t in turns) == "ua" * (len(turns) // 2)
    marked.unpersist()


@pytest.mark.parametrize("kind", [0, 1, 2, 3, 4])
def test_damage(spark, kind):
    talks = table(spark, [(1, 0, "assistant", "One. Two!"), (1, None, None, None), (2, 5, "user", "a?")])
    rows = [tuple(r) for r in repair.damaged(talks, F.lit(kind)).orderBy("conv_id", "turn").collect()]
    whole = [(1, None, " ", " "), (1, 0, "assistant", "One. Two!"), (2, 5, "user", "a?")]
    assert rows == {
        0: [],
        1: [(*r[:3], "") for r in whole],
        2: [(*r[:3], re.sub("[.!?]", "", r[3])) for r in whole],
        3: [r for r in whole for _ in range(2)],
        4: [(*r[:2], "user", r[3]) for r in whole],
    }[kind]
    found = repair.report(talks, repair.marked(repair.damaged(talks, F.lit(kind)))).orderBy("conv_id").collect()
    assert [r.conv_id for r in found] == [1, 2]
    if kind == 0:
        assert all(r.cost == r.gaps == 0 and r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in found)


def test_report_of_no_rows_and_gaps(spark):
    talks = table(spark, [(1, 0, "user", "a."), (1, 4, "assistant", "b."), (1, 4, "assistant", "b."), (1, None, "user", "c."), (2, None, "user", "d.")])
    found = {r.conv_id: r.gaps for r in repair.turn_gaps(repair.marked(repair.damaged(talks, F.lit(9)))).collect()}
    assert found == {1: 3}
    none = talks.where("false")
    assert repair.report(none, repair.marked(repair.damaged(none, F.lit(9)))).collect() == []


# --- prefix trie


def plain_trie(lists):
    """Rows of the trie of {conv_id: [turn]}, a turn being (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(lists):
        for d in range(len(lists[conv]) + 1):
            members[tuple(lists[conv][:d])].append(conv)
        ends[tuple(lists[conv])].append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, inside in members.items():
        own = (len(inside) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += own
    digest = lambda node: hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
    return sorted(
        (inside[0], len(node), members[node[:-1]][0] if node else None, len(inside), children[node], leaves[node], saved[node], digest(node))
        for node, inside in members.items()
    )


def own_lists(rows):
    found = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            found[conv].append((role or "", text or ""))
    return found


def in_order(found):
    return sorted((tuple(r) for r in found.collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_of_own_turns(spark, monkeypatch, band):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    rng = random.Random(band)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None])) for c in [-3, *range(30)] for t in range(rng.randint(1, 9))]
    long = [("user", f"same {t}") for t in range(45)]
    for c, n in ((50, 45), (51, 45), (52, 31), (53, 16), (54, 32)):
        rows += [(c, t, *long[t]) for t in range(n)]
    rows += [(53, 99, "user", "other"), (None, 1, "user", "nobody"), (52, None, "user", "first"), (7, 3, "user", "tie"), (7, 3, "user", "tie")]
    own = prefix_trie.turns(table(spark, rows))
    lengths = own.groupBy("conv_id").agg(F.count("*").alias("length"))
    expected = sorted(plain_trie(own_lists(rows)), key=lambda r: tuple((x is None, x) for x in r))
    assert in_order(prefix_trie.trie(own, lengths)) == expected


def test_trie_of_shared_heads(spark):
    rng = random.Random(9)
    rows = [(c, t, "user", rng.choice("abc")) for c in (0, 1, 2, 4, 6, 7, 10, 13) for t in range(rng.randint(1, 5))] + [(3, 0, "user", "only")]
    own, lists = prefix_trie.turns(table(spark, rows)), own_lists(rows)
    found = prefix_trie.trie(*prefix_trie.shared_heads(own, F.col("conv_id") % 4, F.expr("conv_id - conv_id % 5")))
    rebuilt = {c: lists.get(c - c % 5, [])[: c % 4] + turns[c % 4 :] for c, turns in lists.items()}
    assert [] in rebuilt.values()
    assert in_order(found) == sorted(plain_trie(rebuilt), key=lambda r: tuple((x is None, x) for x in r))


def test_trie_without_conversations(spark):
    own = prefix_trie.turns(table(spark, [(None, 0, "user", "a")]))
    lengths = own.groupBy("conv_id").agg(F.count("*").alias("length"))
    assert prefix_trie.trie(own, lengths).collect() == []


# --- quality


def plain_counts(text):
    data = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", data)
    lines = [line for line in data.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[p : p + 5]) for p in range(len(words) - 4))
    covered = {p + k for p in range(len(words) - 4) if windows[tuple(words[p : p + 5])] > 1 for k in range(5)}
    kinds = [sum(bool(re.search(pattern, w)) for w in words) for pattern in (quality.SHOUTED, quality.DECORATED, quality.LONE_MARK)]
    ended = sum(bool(re.search(r"[.!?][\x20\x09-\x0D]*$", line)) for line in lines)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", data)), len(lines) - len(set(lines)), len(covered), len(lines), ended, *kinds)


def test_counts_against_plain(spark, documents, edges, monkeypatch):
    ship(spark)
    for docs in (documents, edges):
        found = quality.measured(docs.select("doc_id", "text", "score" if "score" in docs.columns else "lang")).collect()
        expected = Counter((r.doc_id, plain_counts(r.text)) for r in docs.select("doc_id", "text").collect())
        assert Counter((r.doc_id, tuple(r[c] for c in quality.COUNTS)) for r in found) == expected
    texts = ["a b c d e f " * 50, "x", "", "one two three four five " * 3 + "tail", "é\x0b日本\tX\n\nX \nX ", "word" * 9000]
    monkeypatch.setattr(quality, "SLICE_BYTES", 16)
    assert quality.counts([t.encode() for t in texts]).T.tolist() == [list(plain_counts(t)) for t in texts]


def test_windows_do_not_cross_documents():
    assert quality.counts([b"a b c", b"d e", b"a b c d e"])[4].tolist() == [0, 0, 0]


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(60_000) < 0.8
    good, bad = np.array([0.97, 0.95, 0.99, 0.9]), np.array([0.5, 0.7, 0.4, 0.6])
    right = rng.random((60_000, 4)) < np.where(truth[:, None], good, bad)
    vote = np.where(right == truth[:, None], 1, -1) * (rng.random((60_000, 4)) < 0.9)
    patterns, n = np.unique(vote, axis=0, return_counts=True)
    prior, found_good, found_bad = quality.expectation_maximisation(patterns, n.astype(float))
    assert abs(prior - 0.8) < 0.06
    assert np.abs(np.array(found_good) - good).max() < 0.05 and np.abs(np.array(found_bad) - bad).max() < 0.12


def test_quality_of_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    ship(spark)
    counted = quality.measured(docs.select("doc_id", "text")).cache()
    found = quality.judged(counted, quality.estimate(counted)).withColumnRenamed("quality", "posterior")
    rows = found.where("n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words").join(labels, "doc_id").select("is_good", "quality").collect()
    clean = [r.is_good for r in rows if r.quality == 1]
    junk = [r.is_good for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.05
    counted.unpersist()


def test_quality_edges(spark, edges, no_documents):
    clash = edges.withColumn("quality", F.lit("own")).withColumn("copy", F.lit(1)).withColumn("N_WORDS", F.lit(2))
    model = quality.estimate(quality.measured(edges.select("doc_id", "text")))
    kept = quality.keep_good(clash, model)
    assert kept.columns == clash.columns
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in edges.collect()}
    assert quality.measured(clash).columns[-len(quality.COUNTS)] == "n_words_"
    empty = quality.measured(no_documents.select("doc_id", "text"))
    assert empty.collect() == [] and quality.estimate(empty).prior == pytest.approx(quality.SHARE)
    assert quality.judged(empty, model).collect() == []

"""Conversation structure repair: the cheapest edits that give a legal order of roles.

The edits of one conversation are the paths of a lattice. A node is a number of rows consumed and what
the repaired roles so far end in; an arc is one edit, its length the edit's cost. Prices of nodes are
found by the auction algorithm for shortest paths, run for every node as origin, last rows first: the
path is extended along an arc as long as the price of its end differs by the arc's length, else the
price rises and the path contracts. Prices then equal the distances to the end, every tight arc lies on
a shortest path, and the least path is traced by always taking the tight arc of the least letter.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.llm.ordinals import numbered

#: Characters that are not blank, and the ends of complete texts.
SHOWN, FINAL = r"[^\x20\x09-\x0D]", ".!?"
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, RENAME, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: What repaired roles end in: nothing, a system turn, a user turn, an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
LEGAL_ENDS = (EMPTY, ASSISTANT)
#: The state behind an inserted or renamed turn, and behind a kept turn of each initial.
WANTED = (USER, USER, ASSISTANT, USER)
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "?": (None,) * 4}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Rows of a conversation whose marks are put together at a time.
BLOCK = 4096


def damaged(conversations: DataFrame, kind: Column) -> DataFrame:
    """``(conv_id, turn, role, text)`` after damage; null roles and texts become one space.

    ``kind`` 0 drops the row, 1 empties its text, 2 removes ends of sentences, 3 repeats it, 4 makes its
    role ``user``; any other number leaves it.
    """
    value = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(value("text"), FINAL, "")).otherwise(value("text"))
    role = F.when(kind == 4, "user").otherwise(value("role"))
    copies = F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def marked(rows: DataFrame) -> DataFrame:
    """``(conv_id, place, turn, role, text, fault)`` in order of turn (null first), role and text.

    A row's first fault counts: blank, duplicate (role and text stand earlier in the conversation),
    truncated (the last visible character ends no sentence). A null ``conv_id`` is one conversation.
    """
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)), 1, 16)
    bounds = [F.col("turn"), F.substring("role", 1, 16), F.substring("text", 1, 32)]
    placed = numbered(rows.withColumn("digest", digest), "conv_id", ["turn", "role", "text"], bounds, "place")
    first = placed.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"))
    first = first.agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = placed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    last = F.right(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), F.lit(1))
    fault = (
        F.when(~F.col("text").rlike(SHOWN), BLANK)
        .when(F.col("place") > F.col("first"), DUPLICATE)
        .when(~F.lit(FINAL).contains(last), TRUNCATED)
        .otherwise(NO_FAULT)
    )
    return joined.select("conv_id", "place", "turn", "role", "text", fault.alias("fault"))


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each conversation in ``marked`` rows.

    Returns ``conv_id, blank, duplicate, truncated, illegal, cost, audit``: rows by their first fault, pairs
    of neighbours in illegal order, the cost, and the edits' initials (K, R, D, I), ASCII-least among the
    cheapest. Keeping a row costs 0, another role 2, deletion 3 (required for blank and duplicate
    rows), insertion of a turn without text 2; truncated rows that stay cost 1 more. The roles' initials
    become ``(s?(ua)+)?``. A task holds one character and four prices per turn of a conversation.
    """
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("?")
    mark = F.concat(initial, F.col("fault").cast("string"))
    blocks = rows.groupBy("conv_id", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", mark.alias("mark")))), lambda e: e["mark"]), "").alias("marks")
    )
    schema = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_solving, schema)


def repaired_digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: digest of the repaired ``role:text`` lines, joined by line feeds.

    The edits of a conversation come before its rows in one sorted stream, so a task holds the edits of
    one conversation and a single row.
    """
    first = edits.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    lines = first.unionByName(rows.select("conv_id", "place", "role", "text"))
    schema = "conv_id long, repaired_sha256 string"
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_digesting, schema)


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)`` of the repaired conversations, ``place`` counted anew."""
    first = edits.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    lines = first.unionByName(rows.select("conv_id", "place", "role", "text"))
    schema = "conv_id long, place long, role string, text string"
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_applying, schema)


def turn_gaps(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps)``: turn numbers missing between the least and the greatest; nulls do not count."""
    turns = rows.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    return turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: ``gaps``, the columns of ``repair`` and ``repaired_sha256``.

    ``rows`` is ``marked`` and read four times, so pass a written table. A conversation without rows there
    has zeros, an empty audit and the digest of nothing. An empty table gives no row.
    """
    edits = repair(rows)
    found = conversations.select("conv_id").distinct()
    for part in (turn_gaps(rows), edits, repaired_digests(rows, edits)):
        other = part.withColumnRenamed("conv_id", "_conv")
        found = found.join(other, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


def arcs(initial: str, fault: str, state: int) -> list[tuple[str, int, int, int]]:
    """Edits at a row in a state, by letter: ``(letter, cost, rows consumed, state behind)``."""
    found = [("D", DELETE, 1, state), ("I", INSERT, 0, WANTED[state])]
    if int(fault) not in (BLANK, DUPLICATE):
        cut = CUT if int(fault) == TRUNCATED else 0
        if (kept := AFTER[initial][state]) is not None:
            found.append(("K", KEEP + cut, 1, kept))
        found.append(("R", RENAME + cut, 1, WANTED[state]))
    return found


_ARCS = {i + f: [arcs(i, f, q) for q in range(4)] for i in AFTER for f in "0123"}
_END_ARCS = [[("I", INSERT, 0, WANTED[q])] for q in range(4)]


def prices(marks: str) -> array:
    """Distances to the end of all nodes, four per number of consumed rows, by auction.

    Origins are taken from the last layer to the first, so behind each path lie exact prices. A layer starts
    at the least price behind it, which no path can fall below; so the rises in a layer are bounded by a
    constant and the whole run takes time in proportion to the rows.
    """
    n = len(marks) // 2
    price = array("q", bytes(32 * (n + 1)))
    for layer in range(n, -1, -1):
        base, behind = 4 * layer, 4 * layer + 4
        rows = _END_ARCS if layer == n else _ARCS[marks[2 * layer : 2 * layer + 2]]
        floor = 0 if layer == n else min(price[behind : behind + 4])
        price[base:behind] = array("q", [floor] * 4)
        exact = [False] * 4
        for origin in range(4):
            path = [origin]
            while not exact[path[-1]]:
                state = path[-1]
                best, target = (0, None) if layer == n and state in LEGAL_ENDS else (None, None)
                for _, cost, step, to in rows[state]:
                    length = cost + price[base + 4 * step + to]
                    if best is None or length < best:
                        best, target = length, (step, to)
                if price[base + state] < best:
                    price[base + state] = best
                    if len(path) > 1:
                        path.pop()
                elif target is None or target[0]:
                    exact[state] = True
                else:
                    path.append(target[1])
            for state in path:
                exact[state] = True
    return price


def edits(marks: str) -> tuple[int, str]:
    """Cost and letters of the cheapest edits, the ASCII-least if there are several.

    ``marks`` has two characters per row: the role's initial (``?`` for any but s, u, a) and the fault.
    """
    n, price = len(marks) // 2, prices(marks)
    layer = state = 0
    letters = []
    while layer < n or state not in LEGAL_ENDS:
        here = price[4 * layer + state]
        rows = _END_ARCS if layer == n else _ARCS[marks[2 * layer : 2 * layer + 2]]
        letter, _, step, state = next(a for a in rows[state] if here == a[1] + price[4 * (layer + a[2]) + a[3]])
        letters.append(letter)
        layer += step
    return price[0], "".join(letters)


def illegal_pairs(marks: str) -> int:
    initials = marks[::2]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def applied(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired ``(role, text)``, given the letters of the edits; rows are taken one at a time."""
    state, source = EMPTY, iter(rows)
    for letter in audit:
        if letter == "I":
            state = WANTED[state]
            yield NAMES[state], ""
            continue
        role, text = next(source)
        if letter == "K":
            state = AFTER[role[:1]][state]
            yield role, text
        elif letter == "R":
            state = WANTED[state]
            yield NAMES[state], text


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, str, Iterator]]:
    """``(conv_id, audit, rows)`` of a sorted stream; the rows are read as they are asked for."""
    def lines():
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                yield from zip(*(column.to_pylist() for column in piece.columns))

    stream = lines()
    held = next(stream, None)
    while held is not None:
        conv, _, _, audit = held
        held = None

        def rows():
            nonlocal held
            for line in stream:
                if line[0] != conv or line[1] < 0:
                    held = line
                    return
                yield line[2], line[3]

        source = rows()
        yield conv, audit, source
        for _ in source:
            pass


def _packed(rows: Iterable[tuple], *fields: tuple[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of up to 1,024."""
    schema = pa.schema(list(fields))
    rows = iter(rows)
    while held := list(islice(rows, 1024)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _digesting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digest(audit, rows):
        state, joint = hashlib.sha256(), b""
        for role, text in applied(audit, rows):
            state.update(joint + role.encode() + b":" + text.encode())
            joint = b"\n"
        return state.hexdigest()

    found = ((conv, digest(audit, rows)) for conv, audit, rows in _conversations(batches))
    yield from _packed(found, ("conv_id", pa.int64()), ("repaired_sha256", pa.string()))


def _applying(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = (
        (conv, place, role, text)
        for conv, audit, rows in _conversations(batches)
        for place, (role, text) in enumerate(applied(audit, rows))
    )
    yield from _packed(found, ("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()))


def _solving(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def whole():
        lines = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
        for conv, pieces in groupby(lines, key=lambda row: row[0]):
            yield conv, "".join(marks for _, marks in pieces)

    def solved(conv, marks):
        faults = marks[1::2]
        return conv, *(faults.count(str(f)) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal_pairs(marks), *edits(marks)

    counts = [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
    yield from _packed((solved(*c) for c in whole()), ("conv_id", pa.int64()), *counts, ("audit", pa.string()))

"""Near duplicates: an inverted join on the coordinates of MinHash signatures, confirmed on full sets.

1. A text's words are hashed, then its runs of ``k`` words; the distinct ones are its set. Equal sets
   are one class, whose representative is the smallest id, so copies cost one row a class from here on.
2. Every class has a signature of ``COORDINATES`` minima. Two sets of the threshold's similarity agree
   on at least ``need`` coordinates (5.2 standard deviations below the mean: about one such pair in a
   million agrees on fewer). A fixed-size table of counts orders the coordinate-value pairs from rare to
   frequent, the same for all classes. Classes that agree on ``need`` coordinates share a pair among the
   ``COORDINATES - need + 1`` rarest of each (prefix), so only those are posted.
3. Postings met once are dropped. Within a posting's group the signatures are compared, skipping the
   classes already joined; edges are those of a spanning forest, so no group gives all its pairs. A group
   larger than ``GROUP`` is cut into blocks, and each pair of blocks is a task of its own.
4. The components of these edges hold all candidates together. The texts of a component's classes are
   compared on their full sets, in blocks as above, and the confirmed links, again a spanning forest,
   give the components of the result.

A set element is a 64-bit hash of its words. Texts without words have an empty set and are linked with
nothing. Rows that share an id are one document. Rows without an id are linked with nothing either: they
have no component and are kept. Repeated rows give repeated results. Other columns are ignored by
``near_duplicates`` and kept by ``keep_one``. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import fresh, slices, texts_as_bytes
from galley.llm.components import components
from galley.llm.memory import tidied
from galley.session import materialize

COORDINATES = 128
#: Cells of the table of counts by which pairs are ordered; it bounds the broadcast, not the data.
CELLS = 1 << 20
GROUP, BLOCK = 4096, 1024
NO_ID = (1 << 63) - 1
_SEGMENT = 4 << 20
_RNG = np.random.default_rng(20240501)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FACTORS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_GAP_BYTE = re.compile(rb"[\x20\x09-\x0d]")
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, of a segment's length at most."""
    if len(_POWERS[0]) < size:
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(size, 1 << 16), factor, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:size], _POWERS[1][:size]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash for each word of the text, A-Z lower-cased."""
    parts, at = [], 0
    while at < len(text):
        gap = _GAP_BYTE.search(text, at + _SEGMENT)
        end = gap.start() if gap else len(text)
        data = np.frombuffer(text[at:end].lower(), np.uint8)
        gap = _GAP[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        first, stop = edge[::2], edge[1::2]
        forward, backward = _powers(len(data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * forward)])
        parts.append(mix((sums[stop] - sums[first]) * backward[first] + (stop - first).astype(np.uint64)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``k`` words; of fewer words, the whole sequence is one."""
    words = word_hashes(text)
    size = min(k, len(words))
    if not size:
        return words
    value = np.full(len(words) - size + 1, size, np.uint64)
    for step in range(size):
        value = mix(value * _BASE + words[step : step + len(value)])
    return np.unique(value)


def signature(elements: np.ndarray) -> np.ndarray:
    """The smallest 32-bit hash of the elements under each coordinate's function."""
    lowest = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(elements), 4096):
        value = np.multiply.outer(_FACTORS, elements[start : start + 4096])
        value += _SHIFTS[:, None]
        np.minimum(lowest, (value >> np.uint64(32)).min(axis=1), out=lowest)
    return lowest.astype(np.uint32)


def _sets(docs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, n_shingles, h1, h2, signature)`` per row; the hashes identify the set."""

    def run(batches):
        for batch in slices(batches, "text"):
            sizes, hashes, signatures = [], [], []
            for value in texts_as_bytes(batch.column("text")):
                elements = shingles(value, k)
                sizes.append(len(elements))
                hashes.append(hashlib.blake2b(elements.tobytes(), digest_size=16).digest())
                signatures.append(signature(elements).tobytes() if len(elements) else None)
            pairs = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "h1", "h2", "signature"],
            )

    frame = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return frame.mapInArrow(tidied(run), "doc_id long, n_shingles long, h1 long, h2 long, signature binary")


def _pairs(signatures: pa.Array) -> np.ndarray:
    """Row by row, a 64-bit hash of each coordinate with its value."""
    values = np.frombuffer(b"".join(signatures.to_pylist()), np.uint32).reshape(-1, COORDINATES).astype(np.uint64)
    return mix(values * np.uint64(COORDINATES) + np.arange(COORDINATES, dtype=np.uint64))


def _cells(classes: DataFrame) -> np.ndarray:
    """How many classes have a pair in each cell: at most ``CELLS`` numbers reach the driver."""

    def run(batches):
        counts = np.zeros(CELLS, np.int64)
        for batch in filter(len, batches):
            cells = (_pairs(batch.column("signature")) % np.uint64(CELLS)).astype(np.int64)
            counts += np.bincount(cells.ravel(), minlength=CELLS)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(counts[cells])], ["cell", "n"])

    sums = classes.select("signature").mapInArrow(tidied(run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = sums.toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return counts


def _postings(classes: DataFrame, counts: np.ndarray, prefix: int) -> DataFrame:
    """``(pair, rep)`` for the rarest pairs of each class."""
    sent = classes.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        for batch in filter(len, batches):
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                pairs = _pairs(part.column("signature"))
                weight = sent.value[(pairs % np.uint64(CELLS)).astype(np.int64)]
                order = np.lexsort((pairs, weight), axis=1)[:, :prefix]
                chosen = np.take_along_axis(pairs, order, 1).view(np.int64).ravel()
                reps = np.repeat(part.column("rep").to_numpy(), prefix)
                yield pa.RecordBatch.from_arrays([pa.array(chosen), pa.array(reps)], ["pair", "rep"])

    return classes.select("rep", "signature").mapInArrow(tidied(run), "pair long, rep long")


def _in_blocks(frame: DataFrame, key: str, member: str, size: str, limit: int) -> DataFrame:
    """Rows with columns ``i``, ``j``: groups larger than ``limit`` go to every pair of blocks they are in."""
    blocks = F.ceil(F.col(size) / F.lit(limit)).cast("int")
    with_block = frame.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(key, member), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = with_block.select("*", other.alias("other"))
    return spread.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("blocks", "other", size)


def _groups(batches, keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the consecutive rows with equal keys, over the borders of batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for first, stop in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[first] for c in columns)
            if key != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(first, stop - first))
    if held:
        yield pa.Table.from_batches(held)


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    table = np.array(edges, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(table[:, 0].copy()), pa.array(table[:, 1].copy())], ["a", "b"])


def forest(count: int, near) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest over ``0..count - 1``; ``near(x, open)`` tells which of ``open`` are next to ``x``.

    Breadth first: every node asks only about nodes that are not joined yet.
    """
    unseen = np.arange(count)
    while len(unseen):
        queue, unseen = [int(unseen[0])], unseen[1:]
        while queue and len(unseen):
            x = queue.pop()
            hit = near(x, unseen)
            found = unseen[hit]
            unseen = unseen[~hit]
            for y in found.tolist():
                yield x, y
            queue.extend(found.tolist())


def _candidate_edges(postings: DataFrame, classes: DataFrame, need: int) -> DataFrame:
    sizes = postings.groupBy("pair").agg(F.count("*").alias("size")).where("size > 1")
    shared = postings.join(sizes, "pair")

    def shorten(batches):
        for batch in filter(len, batches):
            whole = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).astype(np.uint8).reshape(-1, COORDINATES)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([row.tobytes() for row in whole], pa.binary())], ["rep", "short"])

    short = classes.select("rep", "signature").mapInArrow(tidied(shorten), "rep long, short binary")
    grouped = _in_blocks(shared, "pair", "rep", "size", GROUP).join(short, "rep")

    def run(batches):
        edges: list[tuple[int, int]] = []
        for group in _groups(batches, ["pair", "i", "j"]):
            reps = group.column("rep").to_numpy()
            rows = np.frombuffer(b"".join(group.column("short").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            edges += [(int(reps[x]), int(reps[y])) for x, y in forest(len(reps), lambda x, open_: (rows[open_] == rows[x]).sum(axis=1) >= need)]
            if len(edges) > 50_000:
                yield _edge_batch(edges)
                edges = []
        yield _edge_batch(edges)

    ordered = grouped.select("pair", "i", "j", "rep", "short").repartition("pair", "i", "j").sortWithinPartitions("pair", "i", "j", "rep")
    edges = ordered.mapInArrow(tidied(run), "a long, b long")
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _linked(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between sets, confirmed by their intersections."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(np.concatenate(sets), kind="stable")
    values = np.concatenate(sets)[order]
    new = np.append(True, values[1:] != values[:-1])
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    starts = np.append(np.flatnonzero(new), len(values))
    holders, ends = owner[order], np.cumsum(sizes)

    def near(x: int, open_: np.ndarray) -> np.ndarray:
        mine = number[ends[x] - sizes[x] : ends[x]]
        lengths = starts[mine + 1] - starts[mine]
        mine, lengths = mine[lengths > 1], lengths[lengths > 1]  # elements of x alone meet nobody
        before = np.cumsum(lengths) - lengths
        met = holders[np.arange(lengths.sum()) + np.repeat(starts[mine] - before, lengths)]
        common = np.bincount(met, minlength=len(sets))[open_]
        return 100 * common >= percent * (sizes[x] + sizes[open_] - common)

    return forest(len(sets), near)


def _confirmed_edges(docs: DataFrame, candidates: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Spanning links between the representatives within each component of candidates."""
    sizes = candidates.groupBy("label").agg(F.count("*").alias("size"))
    placed = _in_blocks(candidates.join(sizes, "label"), "label", "node", "size", BLOCK)
    texts = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("node"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        for group in _groups(batches, ["label", "i", "j"]):
            nodes = group.column("node").to_numpy()
            sets = [shingles(part, k) for chunk in group.column("text").chunks for part in texts_as_bytes(chunk)]
            yield _edge_batch([(int(nodes[x]), int(nodes[y])) for x, y in _linked(sets, percent)])

    # texts are joined before the blocks multiply them
    own = candidates.join(texts, "node").select("node", "text")
    ordered = own.join(placed, "node").select("label", "i", "j", "node", "text").repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "node")
    return ordered.mapInArrow(tidied(run), "a long, b long").where("a <> b").distinct()


def agreements(percent: int) -> int:
    """Coordinates on which two sets of this similarity agree, all but certainly."""
    share = percent / 100
    return max(1, math.floor(COORDINATES * share - 5.2 * math.sqrt(COORDINATES * share * (1 - share))))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row: links are at ``percent`` of the union or more."""
    need = agreements(percent)
    rows = materialize(_sets(docs, k, doc_id, text), "sets")
    linkable = (F.col("n_shingles") > 0) & (F.col("doc_id") != NO_ID)
    filled = rows.where(linkable)
    classes = filled.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("signature").alias("signature"))
    classes = materialize(classes, "classes")
    postings = _postings(classes, _cells(classes), COORDINATES - need + 1)
    candidates = components(_candidate_edges(postings, classes, need))
    labels = components(_confirmed_edges(docs, candidates, k, percent, doc_id, text))
    by_class = classes.select("h1", "h2", "rep").join(labels, F.col("rep") == F.col("node"), "left")
    by_class = by_class.select("h1", "h2", F.coalesce("label", "rep").alias("component"))
    found = filled.select("doc_id", "n_shingles", "h1", "h2").join(by_class, ["h1", "h2"]).select("doc_id", "n_shingles", "component")
    result = found.union(rows.where(~linkable).select("doc_id", "n_shingles", F.col("doc_id").alias("component")))
    return result.select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
        "n_shingles",
        F.nullif("component", F.lit(NO_ID)).alias("component_id"),
        (F.col("doc_id") == F.col("component")).alias("kept"),
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each component.

    Rows of one id and one text give one. Different texts that share an id are judged each on its own;
    among those of one component the smallest hash of the text decides.
    """
    key, source = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    named = docs.where(key.isNotNull())
    pairs = named.select(key.cast("long").alias("id"), F.xxhash64(source).alias("hash"))
    several = pairs.groupBy("id").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low < high")
    if several.isEmpty():
        return _one_per_number(named, k, percent, doc_id, text).union(docs.where(key.isNull()))
    number, hashed, own = fresh("number", docs.columns), fresh("hashed", docs.columns), fresh("own_id", docs.columns)
    # sorted pairs, numbered from partition to partition, keep the order of ids
    numbers = pairs.distinct().orderBy("id", "hash").select(
        F.col("id").alias(own), F.col("hash").alias(hashed), F.monotonically_increasing_id().alias(number)
    )
    marked = named.withColumn(own, key.cast("long")).withColumn(hashed, F.xxhash64(source))
    marked = materialize(marked.join(materialize(numbers, "numbers"), [own, hashed]), "numbered")
    return _one_per_number(marked, k, percent, number, text).select(*[F.col(f"`{c}`") for c in docs.columns]).union(docs.where(key.isNull()))


def _one_per_number(docs: DataFrame, k: int, percent: int, number: str, text: str) -> DataFrame:
    """One row of each kept number, where rows of one number have one text."""
    name = fresh("kept_id", docs.columns)
    kept = near_duplicates(docs, k, percent, number, text).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, F.col(f"`{number}`").cast("long") == F.col(name), "left_semi").dropDuplicates([number])

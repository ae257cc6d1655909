"""Conversation prefix trie with subtree totals, rolled up by bands of depth.

A node is a distinct sequence of first turns; it is named by a digest of 128 bits of that sequence. All
long chains are cut into bands of ``BAND`` places: the digests of complete bands form a shorter chain,
which is treated alike. So a conversation of any length is worked on in groups of at most ``BAND`` rows,
and the number of rounds is the logarithm of the longest one.

For totals over subtrees, every node adds its own figures to its ancestors inside its band only. Then
the tops of bands, whose totals within the band are complete, form a tree of their own that is rolled
up by the same rule, and each top passes its total to its ancestors in the band above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.llm.ordinals import numbered
from galley.session import materialize

#: Places of one band: no group holds more rows, and no node is repeated for more ancestors at a time.
BAND = 16
#: Ids joined into one piece before the pieces of a node are hashed in their order.
PIECE = 4096


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn_digest, n_bytes)`` of every row, in order of turn, role and text.

    Turns of no number come first; a null role or text is empty; rows without ``conv_id`` belong to no
    conversation. Rows of one turn are ordered by role and text, and repeated rows stay repeated.
    """
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", empty("role"), empty("text"))
    content = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.select("*", _short(content).alias("turn_digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    bounds = [F.col("turn"), F.substring("role", 1, 16), F.substring("text", 1, 32)]
    return numbered(rows, "conv_id", ["turn", "role", "text"], bounds, "place", drop=["turn", "role", "text"])


def shared_heads(own: DataFrame, head: Column, donor: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first ``head`` turns from ``donor``: ``(conv_id, place, ...)`` and ``(conv_id, length)``.

    The other turns are their own after the first ``head``. A donor that does not exist gives none.
    ``head`` and ``donor`` are columns over ``conv_id``; at most ``head`` rows of a donor are repeated,
    once for each conversation that names it.
    """
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("own"))
    named = sizes.select("conv_id", "own", head.cast("long").alias("head"), donor.cast("long").alias("donor"))
    given = named.join(sizes.select(F.col("conv_id").alias("donor"), F.col("own").alias("has")), "donor", "left")
    taken = F.least("head", F.coalesce("has", F.lit(0)))
    plan = materialize(given.select("conv_id", "donor", "head", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("length")), "heads")
    kept = own.join(plan.select("conv_id", "head", "taken"), "conv_id").where("place >= head")
    kept = kept.select("conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "turn_digest", "n_bytes")
    longest = plan.agg(F.max("taken")).first()[0] or 0
    first = own.where(F.col("place") < longest).withColumnRenamed("conv_id", "donor")
    heads = first.join(plan.select("conv_id", "donor", "taken"), "donor").where("place < taken")
    return kept.unionByName(heads.select("conv_id", "place", "turn_digest", "n_bytes")), plan.select("conv_id", "length")


def trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie of conversations ``rows`` (conv_id, place, turn_digest, n_bytes) of ``lengths`` (conv_id, length).

    One row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. Conversations without
    turns are members of the root alone. Without any conversation there is no node.
    """
    lengths = materialize(lengths, "lengths")
    total = lengths.agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("length").alias("deepest")).first()
    if not total.n:
        return rows.sparkSession.createDataFrame([], NODES)
    paths = materialize(_prefixes(rows, total.deepest), "paths")
    places = paths.join(lengths, "conv_id").select("conv_id", "length", "band", "entry", "nodes", F.posexplode("entries").alias("i", "entry_row"))
    places = places.select(
        "conv_id",
        "length",
        (F.col("band") * BAND + F.col("i") + 1).alias("depth"),
        F.get("nodes", F.col("i")).alias("node"),
        F.when(F.col("i") == 0, F.col("entry")).otherwise(F.get("nodes", F.col("i") - 1)).alias("parent"),
        F.slice("nodes", 1, F.col("i") + 1).alias("above"),
        F.col("entry_row.n_bytes").alias("n_bytes"),
    )
    nodes = places.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("length").alias("longest"),
        *[F.any_value(c).alias(c) for c in ("depth", "parent", "n_bytes", "above")],
    )
    own = {"n_leaves": (F.col("longest") == F.col("depth")).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}
    nodes = materialize(nodes.select("node", "conv_id", "depth", "parent", "n_convs", "above", *[v.alias(k) for k, v in own.items()]), "nodes")
    sums = _rolled_up(nodes, paths.select("conv_id", "band", "nodes"), total.deepest)
    children = nodes.where("depth > 1").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    ends = paths.join(lengths, "conv_id").where(F.col("band") == F.floor((F.col("length") - 1) / BAND))
    ends = _listed(ends.select(F.element_at("nodes", -1).alias("node"), "conv_id"))
    facts = nodes.drop("above", "n_leaves", "saved_tokens").join(sums, "node").join(children, "node", "left").join(ends, "node", "left")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("above_conv"))
    deep = facts.where("depth > 1").join(parents, "parent")
    shallow = facts.where("depth = 1").withColumn("above_conv", F.lit(total.least).cast("long"))
    none = hashlib.sha256(b"").hexdigest()
    below = deep.unionByName(shallow, allowMissingColumns=True).select(
        "conv_id",
        "depth",
        F.col("above_conv").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
    return _root(nodes, lengths, total, none).unionByName(below)


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _root(nodes: DataFrame, lengths: DataFrame, total, none: str) -> DataFrame:
    """The node of no turns. Its subtree is the whole table, so plain sums give its totals."""
    sums = nodes.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"),
        F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    )
    without = _listed(lengths.where("length = 0").select(F.lit(b"").alias("node"), "conv_id"))
    ends = without.agg(F.max("ends_sha256")).first()[0] or none
    return sums.select(
        F.lit(total.least).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(total.n).cast("long").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.lit(ends).alias("ends_sha256"),
    )


def _short(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def _bands(rows: DataFrame) -> DataFrame:
    """``(conv_id, band, entries)``: the rows of each band in order of place."""
    entry = F.struct("place", "turn_digest", "n_bytes")
    return rows.groupBy("conv_id", F.floor(F.col("place") / BAND).alias("band")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def _prefixes(rows: DataFrame, length: int) -> DataFrame:
    """``(conv_id, band, entry, entries, nodes)``: names of the prefixes that end in each band, and of the one before it.

    A prefix is named by the name of its complete bands and the digests behind them, or by the first
    alone if nothing is behind, so equal sequences get equal names wherever they stand.
    """
    bands = _bands(rows)
    inner = F.col("entries.turn_digest")
    if length <= BAND:
        whole = bands.withColumn("entry", F.lit(b"")).withColumn("leaving", F.lit(None).cast("binary"))
    else:
        bands = materialize(bands, "bands")
        complete = bands.where(F.size("entries") == BAND).select("conv_id", F.col("band").alias("place"), _joined(F.lit(b"band"), inner).alias("turn_digest"), F.lit(0).cast("long").alias("n_bytes"))
        outer = _prefixes(complete, length // BAND)
        outer = outer.select("conv_id", F.posexplode("nodes").alias("i", "name"), F.col("band").alias("outer"))
        outer = materialize(outer.select("conv_id", (F.col("outer") * BAND + F.col("i")).alias("band"), "name"), "outer")
        before = outer.select("conv_id", (F.col("band") + 1).alias("band"), F.col("name").alias("before"))
        whole = bands.join(before, ["conv_id", "band"], "left").join(outer.withColumnRenamed("name", "leaving"), ["conv_id", "band"], "left")
        whole = whole.withColumn("entry", F.coalesce("before", F.lit(b"")))
    named = F.transform(inner, lambda _, i: F.coalesce(
        F.when(i == BAND - 1, F.col("leaving")), _joined(F.concat(F.lit(b"turn"), F.col("entry")), F.slice(inner, 1, i + 1))
    ))
    return whole.select("conv_id", "band", "entry", "entries", named.alias("nodes"))


def _joined(start: Column, digests: Column) -> Column:
    """Digest of ``start`` and the digests, which all have one length."""
    return _short(F.aggregate(digests, start.cast("binary"), lambda done, d: F.concat(done, d)))


def _rolled_up(nodes: DataFrame, paths: DataFrame, length: int) -> DataFrame:
    """``(node, n_leaves, saved_tokens)``: sums over subtrees, from own values and ``above`` (the ancestors in the band).

    ``paths`` holds ``(conv_id, band, nodes)`` of every conversation.
    """
    measures = ("n_leaves", "saved_tokens")
    summed = [F.sum(m).alias(m) for m in measures]
    within = nodes.select(F.explode("above").alias("node"), *measures).groupBy("node").agg(*summed)
    if length <= BAND:
        return within
    within = materialize(within, "within")
    steps = paths.select("conv_id", F.col("band").alias("place"), F.get("nodes", F.lit(0)).alias("turn_digest"), "nodes")
    chain = materialize(_bands(steps.select("conv_id", "place", "turn_digest", F.lit(0).cast("long").alias("n_bytes"))), "tops")
    tops = chain.select("conv_id", "band", F.col("entries.turn_digest").alias("nodes"))
    placed = tops.select(F.posexplode("nodes").alias("i", "node"), "nodes").select("node", F.slice("nodes", 1, F.col("i") + 1).alias("above"))
    placed = placed.groupBy("node").agg(F.any_value("above").alias("above"))
    bands = -(-length // BAND)
    totals = materialize(_rolled_up(placed.join(within, "node"), tops, bands), "totals")
    upper = steps.select("conv_id", (F.col("place") + 1).alias("place"), F.col("nodes").alias("over"))
    links = steps.where("place > 0").join(upper, ["conv_id", "place"]).groupBy(F.col("turn_digest").alias("node")).agg(F.any_value("over").alias("over"))
    passed = links.join(totals, "node").select(F.explode("over").alias("node"), *measures)
    return within.unionByName(passed).groupBy("node").agg(*summed)


def _listed(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of the ids of each node, joined by commas in ascending order.

    A digest can only be made in order. Sorted range partitions join up to ``PIECE`` ids into one row, and
    the pieces of a node pass through one task one after the other.
    """
    ordered = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ordered.mapInArrow(_pieces, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node binary, ends_sha256 string")


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, ids, done = None, [], []

    def taken():
        rows = pa.RecordBatch.from_pylist(done, schema=pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))
        done.clear()
        return rows

    def close():
        if ids:
            done.append({"node": node, "first": ids[0], "ids": ",".join(map(str, ids))})
            ids.clear()

    for batch in batches:
        for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != node or len(ids) == PIECE:
                close()
                node = name
            ids.append(conv)
        yield taken()
    close()
    yield taken()


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state = None, None

    def row(found):
        return pa.RecordBatch.from_pylist(found, schema=pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))

    for batch in batches:
        found = []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node or state is None:
                if state is not None:
                    found.append({"node": node, "ends_sha256": state.hexdigest()})
                node, state = name, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield row(found)
    if state is not None:
        yield row([{"node": node, "ends_sha256": state.hexdigest()}])

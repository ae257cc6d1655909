"""Exact top-k search by inner product with two cover trees.

Vectors become integers, ``floor(scale * x)`` of each component. Candidates are dealt to blocks by the nearest
of some pivots, the top level of a cover tree over a bounded sample of ``SAMPLE`` rows; every row is in
one block, and a block of many rows is cut into pieces. Queries first search the block they are nearest to.
Their k-th score then rules out blocks: the largest inner product that a block's covering radius or norm
allows must reach it. The other blocks are searched with that score as a threshold.

Inside a block a task holds the candidates as a cover tree and the queries, chunk by chunk, as another. A
pair of nodes is dropped when the largest inner product that the two covering radii allow is below the
worst k-th score of the queries under the query node; equal scores go on, as the smaller id wins a tie.
Pairs of leaves are compared by one matrix product.

Rows without id or vector, or with a null or non-finite component, take no part. Of rows that share an
id, the one with the smallest vector counts. Shorter vectors count as padded with zeros. A query is not
its own candidate. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from galley.session import materialize

BLOCK_ROWS = 8192
CHUNK_ROWS = 1024
#: Rows of a leaf, of candidates and of queries.
LEAF, QUERY_LEAF = 32, 8
#: Rows from which the pivots of blocks are chosen, and the most pivots.
SAMPLE, PIVOTS = 4096, 1024
_EXACT = 2.0**53


def _distances(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - center) ** 2).sum(axis=1))


def net(rows: np.ndarray, first: int, reach: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Rows, ``first`` among them, more than ``reach`` apart that cover all rows within ``reach``: centres, owners, distances.

    None if that takes more than ``most`` centres.
    """
    centers = [first]
    nearest, owner = _distances(rows, rows[first]), np.zeros(len(rows), np.int64)
    while True:
        far = int(nearest.argmax())
        if nearest[far] <= reach:
            return np.array(centers), owner, nearest
        if len(centers) == most:
            return None
        other = _distances(rows, rows[far])
        closer = other < nearest
        nearest, owner = np.where(closer, other, nearest), np.where(closer, len(centers), owner)
        centers.append(far)


class Tree:
    """A cover tree over rows: a node has a centre, a level and a range of the ordered rows.

    All rows of a node at level i lie within 2^i of its centre (covering). The centres of its children,
    its own among them, lie more than 2^(i-1) apart (separation), and the children are of level i-1 or
    lower, as low as their rows allow. Few rows are a leaf, and so are rows that no half as many centres
    cover at half the radius: without structure there is nothing to descend into.
    """

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.leaf = leaf
        self.order = np.arange(len(rows))
        #: first row, row behind the last, centre, covering radius, norm of the centre, children, level, largest norm
        self.nodes: list[tuple[int, int, np.ndarray, float, float, list[int], int | None, float]] = []
        norms = np.sqrt((rows**2).sum(axis=1))
        if len(rows):
            self._build(rows, norms, 0, len(rows))
        self.rows = rows[self.order]

    def _build(self, rows: np.ndarray, norms: np.ndarray, first: int, stop: int) -> int:
        members = self.order[first:stop]
        center = rows[members[0]]
        apart = _distances(rows[members], center)
        radius = float(apart.max())
        level = int(np.ceil(np.log2(radius))) if radius > 0 else None
        number, children = len(self.nodes), []
        self.nodes.append((first, stop, center, radius, float(norms[members[0]]), children, level, float(norms[members].max())))
        if len(members) <= self.leaf or radius == 0:
            return number
        found = net(rows[members], 0, 2.0 ** (level - 1), len(members) // 2)
        if found is None:
            return number
        _, owner, nearest = found
        by_center = np.lexsort((nearest, owner))  # the centre, at distance 0, comes first
        self.order[first:stop] = members[by_center]
        at = first
        for size in np.bincount(owner).tolist():
            children.append(self._build(rows, norms, at, at + size))
            at += size
        return number


class TopK:
    """The k best candidates of each row of a query tree."""

    def __init__(self, count: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((count, k), -np.inf)
        self.ids = np.full((count, k), np.iinfo(np.int64).max)
        #: Scores below it are of no use to the row: its k-th score elsewhere.
        self.floor = np.full(count, -np.inf) if floor is None else floor
        #: Pairs of rows whose product was computed.
        self.compared = 0

    def worst(self, first: int, stop: int) -> float:
        return float(np.maximum(self.scores[first:stop, -1], self.floor[first:stop]).min())

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates for the rows from ``first`` on."""
        stop = first + len(scores)
        rows = np.flatnonzero((scores >= np.maximum(self.scores[first:stop, -1], self.floor[first:stop])[:, None]).any(axis=1))
        if not len(rows):
            return
        all_scores = np.concatenate([self.scores[first + rows], scores[rows]], axis=1)
        all_ids = np.concatenate([self.ids[first + rows], np.broadcast_to(ids, scores.shape)[rows]], axis=1)
        best = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.scores.shape[1]]
        self.scores[first + rows] = np.take_along_axis(all_scores, best, 1)
        self.ids[first + rows] = np.take_along_axis(all_ids, best, 1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where every sum stays below 2^53, else in integers."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < _EXACT:
        return a @ b.T
    return (a.astype(np.int64) @ b.astype(np.int64).T).astype(np.float64)


def search(data: Tree, data_ids: np.ndarray, query: Tree, query_ids: np.ndarray, k: int, floor: np.ndarray | None = None) -> TopK:
    """Dual-tree search; ids and floors are in the order of the trees' rows."""
    best = TopK(len(query.rows), k, floor)

    def bound(q: int, d: int) -> float:
        _, _, p, reach, size, _, _, longest = query.nodes[q]
        _, _, c, cover, length, _, _, most = data.nodes[d]
        # rounding of the bound itself must not drop a pair
        return min(float(p @ c) + size * cover + length * reach + reach * cover, longest * most) * (1 + 1e-9) + 1e-6

    def visit(q: int, d: int, limit: float) -> None:
        a, b, _, reach, _, q_children, *_ = query.nodes[q]
        if limit < best.worst(a, b):
            return
        first, stop, _, cover, _, d_children, *_ = data.nodes[d]
        if not q_children and not d_children:
            best.compared += (b - a) * (stop - first)
            scores = _product(query.rows[a:b], data.rows[first:stop])
            ids = data_ids[first:stop]
            scores[query_ids[a:b, None] == ids[None, :]] = -np.inf
            best.add(a, scores, ids)
        elif q_children and (not d_children or reach > cover):
            for child in q_children:
                visit(child, d, bound(child, d))
        else:
            limits = [bound(q, child) for child in d_children]
            for i in np.argsort(-np.array(limits), kind="stable").tolist():
                visit(q, d_children[i], limits[i])

    if len(query.rows) and len(data.rows):
        visit(0, 0, np.inf)
    return best


def integers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; null if any is null or not finite."""
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    lists = batch.column("vector")
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    values = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query``, its best other rows."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), integers(F.col(f"`{vector}`"), scale).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where("vec_id is not null and vector is not null").groupBy("vec_id").agg(F.min("vector").alias("vector"), F.bool_or("is_query").alias("is_query"))
    total, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(width or 0, 1)
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(-(-total // SAMPLE) or 1)) == 0).limit(2 * SAMPLE).select("vector")
    pivots = _pivots(sample.collect(), width, min(PIVOTS, -(-total // block_rows) or 1))
    placed = materialize(rows.mapInArrow(_placing(pivots, width), "vec_id long, vector array<long>, is_query boolean, block long, apart double, norm double"), "placed")
    # one row per pivot
    blocks = placed.groupBy("block").agg(F.count("*").alias("n"), F.max("apart").alias("radius"), F.max("norm").alias("longest")).orderBy("block").collect()
    cuts = F.create_map(*[x for row in blocks or [Row(block=0, n=1)] for x in (F.lit(row.block).cast("long"), F.lit(-(-row.n // block_rows)))])
    piece = F.pmod(F.xxhash64("vec_id"), F.element_at(cuts, F.col("block"))).cast("int").alias("piece")
    data = placed.select("block", piece, F.lit(0).alias("kind"), "vec_id", "vector", F.lit(None).cast("double").alias("floor"))
    all_pieces = F.explode(F.sequence(F.lit(0), (F.element_at(cuts, F.col("block")) - 1).cast("int"))).alias("piece")
    asked = placed.where("is_query").select("block", F.lit(1).alias("kind"), "vec_id", "vector")
    near = asked.select("block", all_pieces, "kind", "vec_id", "vector", F.lit(float("-inf")).alias("floor"))
    first = materialize(_searched(data, near, k, width), "near")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = first.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"), F.row_number().over(place).alias("rank"))
    floors = floors.where(F.col("rank") == k).drop("rank")
    pending = asked.join(floors, "vec_id", "left").select("block", "vec_id", "vector", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    further = pending.mapInArrow(_further(pivots, blocks, width), "block long, vec_id long, vector array<long>, floor double")
    far = further.select("block", all_pieces, F.lit(1).alias("kind"), "vec_id", "vector", "floor")
    found = first.union(_searched(data, far, k, width))
    return found.select("query_id", F.row_number().over(place).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _pivots(sample: list, width: int, most: int) -> np.ndarray:
    """Up to ``most`` rows of the sample, each the farthest from those before it."""
    if not sample:
        return np.zeros((1, width))
    rows = np.zeros((len(sample), width))
    for row, (values,) in zip(rows, sorted(sample)):
        row[: len(values)] = values
    chosen, nearest = [0], _distances(rows, rows[0])
    while len(chosen) < most and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(rows, rows[chosen[-1]]))
    return rows[chosen]


def _placing(pivots: np.ndarray, width: int):
    """Adds to each row its nearest pivot, the distance from it, and the row's norm."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                piece = batch.slice(start, CHUNK_ROWS)
                points = _matrix(piece, width)
                block = ((pivots**2).sum(axis=1) - 2 * points @ pivots.T).argmin(axis=1)
                apart, norm = np.sqrt(((points - pivots[block]) ** 2).sum(axis=1)), np.sqrt((points**2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(block), pa.array(apart), pa.array(norm)], [*piece.schema.names, "block", "apart", "norm"])

    return run


def _further(pivots: np.ndarray, blocks: list, width: int):
    """For each query the blocks, but its own, that may hold a score as good as its floor."""
    number = np.array([row.block for row in blocks], np.int64)
    radius, longest = np.array([row.radius for row in blocks], float), np.array([row.longest for row in blocks], float)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                piece = batch.slice(start, CHUNK_ROWS)
                points = _matrix(piece, width)
                size = np.sqrt((points**2).sum(axis=1))[:, None]
                limit = np.minimum(points @ pivots[number].T + size * radius, size * longest) * (1 + 1e-9) + 1e-6
                query, block = np.nonzero((limit >= piece.column("floor").to_numpy()[:, None]) & (number != piece.column("block").to_numpy()[:, None]))
                taken = piece.take(pa.array(query))
                yield pa.RecordBatch.from_arrays([pa.array(number[block]), *taken.columns[1:]], ["block", "vec_id", "vector", "floor"])

    return run


def _searched(data: DataFrame, queries: DataFrame, k: int, width: int) -> DataFrame:
    """``(query_id, vec_id, score)``: the k best of each query in each piece of a block it is sent to."""
    names = ["block", "piece", "kind", "vec_id", "vector", "floor"]
    ordered = data.select(*names).union(queries.select(*names)).repartition("block", "piece").sortWithinPartitions("block", "piece", "kind", "vec_id", "vector")

    def run(batches):
        state: dict[str, object] = {"block": None, "parts": [], "tree": None}
        for block, kind, batch in _runs(batches):
            if block != state["block"]:
                state = {"block": block, "parts": [], "tree": None}
            ids, matrix = batch.column("vec_id").to_numpy(), _matrix(batch, width)
            if kind == 0:
                state["parts"].append((ids, matrix))
                continue
            if state["tree"] is None and state["parts"]:
                own, points = (np.concatenate([p[i] for p in state["parts"]]) for i in range(2))
                tree = Tree(points)
                state |= {"tree": (tree, own[tree.order]), "parts": []}
            if state["tree"] is None:
                continue
            floor = batch.column("floor").to_numpy()
            tree, own = state["tree"]
            for start in range(0, len(ids), CHUNK_ROWS):
                some = slice(start, start + CHUNK_ROWS)
                asked = Tree(matrix[some], QUERY_LEAF)
                names = ids[some][asked.order]
                best = search(tree, own, asked, names, k, floor[some][asked.order])
                at, place = np.nonzero(np.isfinite(best.scores))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[at]), pa.array(best.ids[at, place]), pa.array(best.scores[at, place].astype(np.int64))], ["query_id", "vec_id", "score"]
                )

    return ordered.mapInArrow(run, "query_id long, vec_id long, score long")


def _runs(batches) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """Slices of equal block, piece and kind, in order."""
    for batch in batches:
        keys = np.stack([batch.column(name).to_numpy().astype(np.int64) for name in ("block", "piece", "kind")])
        bounds = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b > a:
                yield (int(keys[0, a]), int(keys[1, a])), int(keys[2, a]), batch.slice(a, b - a)

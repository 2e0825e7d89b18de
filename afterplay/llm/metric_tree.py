"""Exact top-k search by inner product with a distributed M-tree.

Inner products become distances: with M the largest squared norm, a vector x gets the further
component sqrt(M - |x|^2) and a query the further component 0. All vectors then lie on one
sphere, and the greatest inner product is the least distance.

The index is a table of trees in the shared folder. Vectors go to the nearest of a bounded
number of pivots; what a pivot attracts is dealt by a hash over as many trees as keep each at
about ``TREE_ROWS``. A tree has pages of entries. An inner entry has a routing vector, the
radius that covers its subtree, and its distance to the routing vector of the page above; a leaf
entry has that distance too. Pages are visited best first, by the least distance that their
content may have. Where the distance of query and parent, and of entry and parent, already rule
an entry out (triangle inequality), its own distance is not computed.

Queries travel in blocks. A block first asks the tree that its queries are nearest to, which
gives each query a score that its k-th answer reaches at least. Then it goes to the trees of
all pivots whose balls may hold such a score. Every answer comes from a tree; pruning is by
bounds only, so results are exact.

Defined results: null vectors, those with a null, NaN or infinite component, and those without
an id take no part; nor do empty ones. Shorter vectors count as if padded with zeros. Every row
is a candidate, also if others have its id or its vector; rows of one id are never answers to
it, and a query id that stands on several rows asks for the best of all their scores. Equal
scores go by the smaller id. An empty table gives no rows. Scaled components are whole numbers; scores are exact while they
stay below 2^53.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from afterplay.llm.components import written

SCALE = 256
TREE_ROWS = 8_192
PIVOTS = 512
LEAF_ROWS = 512
FANOUT = 16
BLOCK_QUERIES = 512
_SLACK = 1e-6


def scaled(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id, v`` with ``v`` the whole numbers floor(scale * x), for every usable row."""
    doubles = vectors.select(
        vectors[key].cast("bigint").alias("id"), vectors[vector].cast("array<double>").alias("x")
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = doubles.filter(F.col("id").isNotNull() & (F.size("x") > 0) & finite)
    return usable.select("id", F.transform("x", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))


def _numbers(rows: int, so_far: int) -> pa.Array:
    """Numbers of rows that no two tasks share; they spread the rows of one id over many groups."""
    return pa.array(np.arange(so_far, so_far + rows) + (TaskContext.get().partitionId() << 33))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of doubles, short ones padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def lifted(v: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that puts them on the sphere."""
    return np.hstack([v, np.sqrt(np.maximum(most - (v * v).sum(1), 0))[:, None]])


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(1))


class Tree:
    """Pages as arrays. Rows of a leaf lie together; inner entries point to pages."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, most: float):
        self.most = most
        points = lifted(v, most)
        self.order: list[np.ndarray] = []
        self.pages: list[tuple] = []
        self.leaf_parent = np.zeros(len(ids))
        self.filled = 0
        rows = np.arange(len(ids))
        self.center = points.mean(0)
        self._page(points, rows, self.center)
        order = np.concatenate(self.order) if self.order else rows
        self.ids, self.v = ids[order], v[order]
        del self.order

    def _page(self, points: np.ndarray, rows: np.ndarray, parent: np.ndarray) -> int:
        """Build the page of ``rows`` below the routing vector ``parent``; returns its number."""
        number = len(self.pages)
        self.pages.append(())
        if len(rows) <= LEAF_ROWS:
            begin = self.filled
            self.filled += len(rows)
            away = distances(points[rows], parent)
            by = np.argsort(away, kind="stable")
            self.order.append(rows[by])
            self.leaf_parent[begin : self.filled] = away[by]
            self.pages[number] = (begin, self.filled)
            return number
        groups = self._split(points, rows)
        routing = np.stack([points[g[0]] for g in groups])
        radius = np.array([distances(points[g], points[g[0]]).max() for g in groups])
        children = [self._page(points, g, points[g[0]]) for g in groups]
        self.pages[number] = (routing, radius, distances(routing, parent), np.array(children))
        return number

    @staticmethod
    def _split(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Groups around far-apart routing vectors, each group with its routing vector first."""
        own = points[rows]
        picked = [0]
        nearest = distances(own, own[0])
        group = np.zeros(len(rows), np.int64)
        while len(picked) < FANOUT:
            far = int(nearest.argmax())
            if nearest[far] == 0:
                break
            away = distances(own, own[far])
            closer = away < nearest
            group[closer], nearest = len(picked), np.minimum(nearest, away)
            picked.append(far)
        if len(picked) == 1:  # equal vectors: cut evenly
            return np.array_split(rows, min(FANOUT, -(-len(rows) // LEAF_ROWS)))
        out = []
        for i, first in enumerate(picked):
            members = rows[group == i]
            out.append(np.concatenate([[rows[first]], members[members != rows[first]]]))
        return out

    def search(self, query: np.ndarray, own: int, k: int, at_least: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` that reach ``at_least``, leaving the id ``own`` out."""
        point = np.append(query, 0.0)
        whole = float(query @ query) + self.most
        slack = _SLACK * (1 + np.sqrt(whole))
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)

        def reach(score: float) -> float:
            return float("inf") if score == float("-inf") else np.sqrt(max(whole - 2 * score, 0.0)) + slack

        limit = reach(at_least)
        start = float(np.sqrt(((point - self.center) ** 2).sum()))
        queue = [(0.0, 0, start)]
        while queue:
            least, number, to_parent = heapq.heappop(queue)
            if least > limit:
                break
            page = self.pages[number]
            if len(page) == 2:
                lo, hi = page
                away = self.leaf_parent[lo:hi]
                if limit < float("inf"):  # distances to the parent are sorted
                    lo, hi = lo + np.searchsorted(away, [to_parent - limit, to_parent + limit])
                scores = self.v[lo:hi] @ query
                ids = self.ids[lo:hi]
                good = (scores >= at_least) & (ids != own)
                if good.any():
                    ids, scores = np.append(best_ids, ids[good]), np.append(best, scores[good])
                    first = np.lexsort((ids, -scores))[:k]
                    best_ids, best = ids[first], scores[first]
                    if len(best) == k:
                        at_least = best[-1]
                        limit = reach(at_least)
                continue
            routing, radius, above, children = page
            maybe = np.flatnonzero(np.abs(to_parent - above) - radius <= limit)
            away = distances(routing[maybe], point)
            for i, d in zip(maybe, away):
                floor = max(d - radius[i], 0.0)
                if floor <= limit:
                    heapq.heappush(queue, (float(floor), int(children[i]), float(d)))
        return best_ids, best

    def packed(self) -> bytes:
        inner = [p for p in self.pages if len(p) == 4]
        buffer = io.BytesIO()
        np.savez(
            buffer,
            ids=self.ids, v=self.v.astype(np.int64), away=self.leaf_parent, center=self.center, most=self.most,
            leaf=np.array([p if len(p) == 2 else (-1, len(p[1])) for p in self.pages], np.int64).reshape(-1, 2),
            routing=np.concatenate([p[0] for p in inner]) if inner else np.zeros((0, len(self.center))),
            radius=np.concatenate([p[1] for p in inner]) if inner else np.zeros(0),
            above=np.concatenate([p[2] for p in inner]) if inner else np.zeros(0),
            children=np.concatenate([p[3] for p in inner]) if inner else np.zeros(0, np.int64),
        )
        return buffer.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        tree, a = cls.__new__(cls), np.load(io.BytesIO(data))
        tree.ids, tree.v, tree.leaf_parent = a["ids"], a["v"].astype(np.float64), a["away"]
        tree.center, tree.most, tree.pages = a["center"], float(a["most"]), []
        inner, at = [a[n] for n in ("routing", "radius", "above", "children")], 0
        for lo, hi in a["leaf"]:
            if lo >= 0:
                tree.pages.append((int(lo), int(hi)))
            else:
                tree.pages.append(tuple(x[at : at + hi] for x in inner))
                at += hi
        return tree


class Pivots:
    """A bounded number of lifted vectors; each vector belongs to the nearest."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.norms = (points * points).sum(1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.maximum(self.norms - 2 * points @ self.points.T + (points * points).sum(1)[:, None], 0)
        at = d.argmin(1)
        return at, np.sqrt(((points - self.points[at]) ** 2).sum(1))


class Index:
    """The table of trees, and for each pivot its radius and number of trees."""

    def __init__(self, trees: DataFrame, pivots: Pivots, radius: np.ndarray, parts: np.ndarray, most: float, width: int):
        self.trees, self.pivots, self.radius, self.parts = trees, pivots, radius, parts
        self.most, self.width = most, width


def build(vectors: DataFrame, tree_rows: int = TREE_ROWS, most_pivots: int = PIVOTS) -> Index | None:
    """Index all rows of ``id, v``. Only the pivots are a sample, of at most ``most_pivots`` vectors."""
    spark = vectors.sparkSession
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    count, most, width = vectors.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("v"))).first()
    if not count:
        return None
    wanted = min(most_pivots, max(1, count // tree_rows))
    sample = vectors.select("v", F.xxhash64("id", "v", F.lit(11)).alias("h"), "id").orderBy("h", "id").limit(wanted)
    chosen = matrix(sample.select("v").toArrow().column(0), width)
    pivots = Pivots(lifted(chosen, most))
    shared = spark.sparkContext.broadcast(pivots)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at, away = shared.value.nearest(lifted(matrix(batch.column(1), width), most))
            columns = [*batch.columns, pa.array(at.astype(np.int32)), pa.array(away), _numbers(batch.num_rows, seen)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "pivot", "away", "row"])
            seen += batch.num_rows

    routed = written(vectors.mapInArrow(route, "id bigint, v array<bigint>, pivot int, away double, row bigint"), "tree-rows")
    # one row per pivot
    summary = routed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    radius, parts = np.zeros(wanted), np.zeros(wanted, np.int64)
    for row in summary:
        radius[row.pivot], parts[row.pivot] = row.radius, -(-row.n // tree_rows)
    split = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("pivot") + 1)
    dealt = routed.select("id", "v", "pivot", F.pmod(F.xxhash64("row", F.lit(12)), split).cast("int").alias("part"))

    def grow(key: tuple, group: pa.Table) -> pa.Table:
        tree = Tree(group.column("id").to_numpy(), matrix(group.column("v"), width), most)
        return pa.table({"pivot": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "tree": [tree.packed()]})

    trees = dealt.groupBy("pivot", "part").applyInArrow(grow, "pivot int, part int, tree binary")
    return Index(written(trees, "trees"), pivots, radius, parts, most, width)


def _searched(blocks: DataFrame, index: Index, k: int) -> DataFrame:
    """Rows of (block, query, id, score) for every block at every tree it is sent to.

    Blocks and trees meet by a shuffle. Spark takes blocks for as small as the file they come from, however
    many trees each one goes to, and would collect them all in the driver to broadcast them.
    """
    pairs = blocks.hint("merge").join(index.trees, ["pivot", "part"]).select("block", "queries", "tree")
    width = index.width
    names = ["block", "query", "id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries = batch.column(1).slice(i, 1).flatten()
                tree = Tree.unpacked(batch.column(2)[i].as_py())
                ids = queries.field("id").to_numpy(zero_copy_only=False)
                bounds = queries.field("bound").to_numpy(zero_copy_only=False)
                out = [[], [], []]
                for own, query, bound in zip(ids, matrix(queries.field("v"), width), bounds):
                    found, scores = tree.search(query, own, k, bound)
                    out[0].append(np.full(len(found), own))
                    out[1].append(found)
                    out[2].append(scores.astype(np.int64))
                columns = [np.concatenate(o) for o in out]
                block = pa.array([batch.column(0)[i].as_py()] * len(columns[0]), pa.int64())
                yield pa.RecordBatch.from_arrays([block, *map(pa.array, columns)], names)

    return pairs.mapInArrow(search, "block bigint, query bigint, id bigint, score bigint")


def top_k(queries: DataFrame, index: Index, k: int, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of the index for each of ``id, v``."""
    spark = queries.sparkSession
    width, most = index.width, index.most
    near = spark.sparkContext.broadcast((index.pivots, index.radius, index.parts))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            points = np.hstack([matrix(batch.column(1), width), np.zeros((batch.num_rows, 1))])
            at, _ = near.value[0].nearest(points)
            columns = [*batch.columns, pa.array(at.astype(np.int32)), _numbers(batch.num_rows, seen)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "pivot", "row"])
            seen += batch.num_rows

    routed = written(queries.mapInArrow(route, "id bigint, v array<bigint>, pivot int, row bigint"), "queries")
    counts = {r.pivot: r.n for r in routed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    deal = [-(-counts.get(p, 1) // block_queries) for p in range(len(index.parts))]
    slots = F.element_at(F.array(*map(F.lit, deal)), F.col("pivot") + 1)
    block = F.col("pivot").cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("row", F.lit(13)), slots)
    numbered = routed.withColumn("block", block).withColumn("part", F.lit(0))

    def gathered(rows: DataFrame, bound: Column) -> DataFrame:
        # about block_queries rows each
        return rows.groupBy("block", "pivot", "part").agg(
            F.collect_list(F.struct("id", "v", bound.alias("bound"))).alias("queries")
        )

    first = _searched(gathered(numbered, F.lit(float("-inf"))), index, k)
    kth = first.groupBy("query").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("reached")
    )
    bounded = numbered.join(kth, numbered["id"] == kth["query"], "left")
    blocks = written(gathered(bounded, F.coalesce("reached", F.lit(float("-inf")))), "query-blocks")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every tree in which some query of the block may find its bound reached."""
        pivots, radius, parts = near.value
        for batch in batches:
            for i in range(batch.num_rows):
                queries = batch.column(1).slice(i, 1).flatten()
                v = matrix(queries.field("v"), width)
                points = np.hstack([v, np.zeros((len(v), 1))])
                whole = (v * v).sum(1) + most
                bounds = queries.field("bound").to_numpy(zero_copy_only=False)
                reach = np.where(np.isinf(bounds), np.inf, np.sqrt(np.maximum(whole - 2 * bounds, 0)))
                squares = pivots.norms - 2 * points @ pivots.points.T + (points * points).sum(1)[:, None]
                away = np.sqrt(np.maximum(squares, 0))
                slack = _SLACK * (1 + np.sqrt(whole))[:, None]
                wanted = np.flatnonzero((away - radius <= reach[:, None] + 1e3 * slack).any(0))
                places = [(p, part) for p in wanted for part in range(parts[p])]
                pivot, part = np.array(places, np.int32).reshape(-1, 2).T
                for at in range(0, len(pivot), 8):
                    many = len(pivot[at : at + 8])
                    repeated = batch.slice(i, 1).take(pa.array([0] * many))
                    yield pa.RecordBatch.from_arrays(
                        [*repeated.columns, pa.array(pivot[at : at + 8]), pa.array(part[at : at + 8])],
                        ["block", "queries", "pivot", "part"],
                    )

    kind = "array<struct<id:bigint,v:array<bigint>,bound:double>>"
    sent = blocks.select("block", "queries").mapInArrow(spread, f"block bigint, queries {kind}, pivot int, part int")
    answers = _searched(sent, index, k)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        answers.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
    )

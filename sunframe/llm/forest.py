"""Approximate nearest neighbours: a forest of random-projection trees with exact reranking.

The trees are fitted on a bounded sample and every vector is filed in one leaf of each tree. A query
walks all trees through one shared priority queue, least departure first, until it has collected its
leaves; the vectors in them are reranked by the exact inner product.

How many leaves a query visits is measured, not guessed: a few dozen sampled vectors are compared with
all rows, and the visits that find the target share of their true neighbours are used for all.

Equal vectors are one point of the index with its smallest ids, as many as a result can show, so a
vector that a third of all rows share costs one point. Points of a leaf are dealt to blocks, and so are
the queries that visit it: a task compares one block of either, whatever the number of both.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunframe.llm.common import prepare, table, written

K = 20
#: Trees; vectors that a leaf should hold.
TREES, LEAF = 4, 1024
#: Share of true neighbours that the visits must find, and the sampled queries that measure it.
RECALL, MEASURED = 0.95, 128
#: Vectors that the trees are fitted on, at most; a leaf is split while it has this many of them for each side.
SAMPLE, LEAST_SAMPLED = 16384, 4
#: Vectors of a leaf, and queries that visit it, that one task compares.
BLOCK, QUERY_BLOCK = 8192, 16384
SEED = 11


class Tree:
    """Splits by node number: a direction, a cut, and the children; a child under zero is leaf ``-child - 1``."""

    def __init__(self, x: np.ndarray, depth: int, r: np.random.Generator) -> None:
        self.directions: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(x, depth, r)
        self.directions = np.array(self.directions).reshape(len(self.cuts), x.shape[1])

    def _grow(self, x: np.ndarray, depth: int, r: np.random.Generator) -> int:
        if depth and len(x) >= 2 * LEAST_SAMPLED:
            d = r.standard_normal(x.shape[1])
            d /= np.linalg.norm(d)
            at = x @ d
            cut = float(np.median(at))
            right = at >= cut
            if right.any() and not right.all():
                node = len(self.cuts)
                self.directions.append(d)
                self.cuts.append(cut)
                self.children.append([0, 0])
                self.children[node] = [self._grow(x[~right], depth - 1, r), self._grow(x[right], depth - 1, r)]
                return node
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at = np.full(len(x), self.root)
        while len(rows := np.flatnonzero(at >= 0)):
            node = at[rows]
            side = np.einsum("ij,ij->i", x[rows], self.directions[node]) >= np.array(self.cuts)[node]
            at[rows] = np.array(self.children)[node, side.astype(int)]
        return -at - 1


class Forest:
    """Trees over vectors lifted by one coordinate, so that the largest inner product is the smallest distance."""

    def __init__(self, sample: np.ndarray, norm: float, depth: int, trees: int = TREES, seed: int = SEED) -> None:
        self.norm = norm
        r = np.random.default_rng(seed)
        lifted = self.lift(sample)
        self.trees = [Tree(lifted, depth, r) for _ in range(trees)]
        self.offsets = np.cumsum([0, *(t.leaves for t in self.trees)])

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - np.einsum("ij,ij->i", x, x), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def file(self, x: np.ndarray) -> np.ndarray:
        """Leaves of every row, one a tree, numbered through the forest."""
        lifted = self.lift(x)
        return np.stack([t.leaf_of(lifted) + o for t, o in zip(self.trees, self.offsets[:-1], strict=True)], axis=1)

    def search(self, q: np.ndarray, visits: int) -> list[int]:
        """Leaves to visit: those first for which the squared margins that the path crosses add up to least."""
        q = np.append(q * (self.norm / max(float(np.linalg.norm(q)), 1e-300)), 0.0)
        margins = [(t.directions @ q - np.array(t.cuts)).tolist() for t in self.trees]
        queue = [(0.0, k, t.root) for k, t in enumerate(self.trees)]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < visits:
            crossed, k, node = heapq.heappop(queue)
            if node < 0:
                found.append(int(self.offsets[k]) - node - 1)
                continue
            margin, (left, right) = margins[k][node], self.trees[k].children[node]
            heapq.heappush(queue, (crossed + max(0.0, -margin) ** 2, k, right))
            heapq.heappush(queue, (crossed + max(0.0, margin) ** 2, k, left))
        return found


def _vector(vectors: DataFrame) -> Column:
    """Floats stay floats, half the size; anything else becomes double. Arithmetic is in doubles either way."""
    kind = dict(vectors.dtypes)["embedding"]
    return F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")


def clean(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors that take part.

    Null and zero vectors, those with null or non-finite components, rows without an id, and vectors
    of another length than the most frequent one (the shorter of equally frequent ones) do not.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _vector(vectors).alias("v")).filter("vec_id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~bad & F.exists("v", lambda x: x != 0))
    top = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (top["n"] if top else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width) if len(column) else np.zeros((0, width))


def _index_rows(forest: Forest, width: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves = forest.file(_matrix(b.column(1), width))
            rows = np.repeat(np.arange(len(b)), leaves.shape[1])
            point = b.column(0).take(pa.array(rows))
            block = (point.to_numpy() * 0x9E3779B1 >> 7) % blocks  # ids of a kind, such as even ones, go to all blocks
            yield pa.RecordBatch.from_arrays([pa.array(leaves.ravel()), pa.array(block), point, b.column(2).take(pa.array(rows)), b.column(1).take(pa.array(rows))], ["leaf", "block", "point", "ids", "v"])

    return run


def _query_rows(forest: Forest, sample: Broadcast, width: int, visits: int, k: int):
    """Each query with the leaves it visits, and a score that its k + 1 best in them reach at least: that of the sample's vectors there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sample.value
        filed = forest.file(seen) if len(seen) else np.zeros((0, 1), np.int64)
        for b in batches:
            asked = _matrix(b.column(1), width)
            found = [forest.search(q, visits) for q in asked]
            least = np.full(len(b), -np.inf)
            for i, leaves in enumerate(found):
                met = seen[np.isin(filed, leaves).any(axis=1)]
                if len(met) > k:
                    least[i] = np.partition(met @ asked[i], len(met) - k - 1)[len(met) - k - 1]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(least), pa.array(found, pa.list_(pa.int64()))], ["query_id", "q", "least", "leaves"])

    return run


def _exact_rows(queries: np.ndarray, own: np.ndarray, width: int, k: int):
    """The k best points of a partition for each of a few queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(queries), 0), 0.0)
        point, vector = np.zeros((len(queries), 0), np.int64), np.zeros((len(queries), 0, width))
        for b in batches:
            x, ids = _matrix(b.column(1), width), b.column(0).to_numpy()
            score = queries @ x.T
            score[ids[None, :] == own[:, None]] = -np.inf
            keep = np.argsort(-score, axis=1, kind="stable")[:, :k]
            best = np.concatenate([best, np.take_along_axis(score, keep, 1)], axis=1)
            point, vector = np.concatenate([point, ids[keep]], axis=1), np.concatenate([vector, x[keep]], axis=1)
            top = np.argsort(-best, axis=1, kind="stable")[:, :k]
            best, point, vector = np.take_along_axis(best, top, 1), np.take_along_axis(point, top, 1), np.take_along_axis(vector, top[:, :, None], 1)
        n = best.shape[1]
        rows = pa.array(list(vector.reshape(-1, width)), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(queries)), n)), pa.array(point.ravel()), rows, pa.array(best.ravel())], ["q", "point", "v", "score"])

    return run


def visits_for(points: DataFrame, forest: Forest, queries: np.ndarray, own: np.ndarray, k: int, recall: float) -> int:
    """Visits by which the sampled queries find the share ``recall`` of their true nearest points among all rows."""
    leaves = int(forest.offsets[-1])
    if not len(queries):
        return leaves
    near = points.select("point", "v").mapInArrow(_exact_rows(queries, own, queries.shape[1], k), "q long, point long, v array<double>, score double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "point"))
    true = near.filter("score > double('-Infinity')").withColumn("place", place).filter(F.col("place") <= k).select("q", "v").collect()
    if not true:
        return leaves
    filed = forest.file(np.array([r["v"] for r in true], np.float64))
    order = np.zeros((len(queries), leaves), np.int64)
    for i, q in enumerate(queries):
        order[i, forest.search(q, leaves)] = np.arange(leaves)
    met = np.sort([order[r["q"], f].min() for r, f in zip(true, filed, strict=True)])
    return int(met[min(len(met) - 1, math.ceil(recall * len(met)) - 1)]) + 1


_FOUND = pa.schema([("query_id", pa.int64()), ("point", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])


def _rerank(width: int, k: int):
    """The k + 1 best points of a block for each query of a block, if they reach its least score: one of them may be the query itself."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(index) or not len(queries):
            return _FOUND.empty_table()
        x, point = _matrix(index["v"].combine_chunks(), width), index["point"].to_numpy()
        q_all, query = _matrix(queries["q"].combine_chunks(), width), queries["query_id"].to_numpy()
        least = queries["least"].to_numpy()
        rows, of, scores = [], [], []
        for at in range(0, len(q_all), 256):
            rough = q_all[at : at + 256] @ x.T
            for i, row in enumerate(rough):
                low = least[at + i]
                near = np.flatnonzero(row >= low - 1e-9 * max(1.0, abs(low))) if np.isfinite(low) else np.arange(len(x))
                if len(near) > k + 1:
                    kth = np.partition(row[near], len(near) - k - 1)[len(near) - k - 1]
                    near = near[row[near] >= kth - 1e-9 * max(1.0, abs(kth))]
                exact = (x[near] * q_all[at + i]).sum(axis=1)
                order = np.lexsort((point[near], -exact))[: k + 1]
                rows.append(near[order])
                of.append(np.full(len(order), query[at + i]))
                scores.append(exact[order])
        take = pa.array(np.concatenate(rows), pa.int64())
        return pa.table([pa.array(np.concatenate(of)), index["point"].take(take), index["ids"].take(take), pa.array(np.concatenate(scores))], schema=_FOUND)

    return run


def neighbours(vectors: DataFrame, is_query: Column, k: int = K, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, recall: float = RECALL, block: int | None = None, query_block: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, by the largest inner product.

    Candidates are all rows but those with the query's own id. Fewer candidates than ``k`` give fewer
    rows; ties go to the smaller id. Rows that repeat an id and its vector count once; two vectors under
    one id are two points and, as queries, share one list. Null, zero and non-finite vectors and rows
    without an id take no part (see :func:`clean`); other columns do not matter. An empty table gives no rows.
    """
    prepare(vectors.sparkSession)
    rows = written(clean(vectors), "forest-vectors")
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    points = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("point"), "v", "ids")
    points = written(points, "forest-points")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("norm"), F.max(F.size("v")).alias("width")).first()
    n, width, kind = size["n"], size["width"] or 1, dict(points.dtypes)["v"]
    drawn = points.select("point", "v").orderBy(F.xxhash64("point"), "point").limit(sample).collect()
    x, own = np.array([r["v"] for r in drawn], np.float64).reshape(-1, width), np.array([r["point"] for r in drawn], np.int64)
    forest = Forest(x, math.sqrt(size["norm"] or 0.0), math.ceil(math.log2(max(1.0, n / leaf))), trees)
    visits = visits_for(points, forest, x[:MEASURED], own[:MEASURED], k, recall)
    shared = vectors.sparkSession.sparkContext.broadcast(x)  # at most ``sample`` vectors
    blocks = max(1, math.ceil(n / max(1, min(t.leaves for t in forest.trees)) / (block or BLOCK)))
    query_block = query_block or QUERY_BLOCK
    filed = points.select("point", "v", "ids").mapInArrow(_index_rows(forest, width, blocks), f"leaf long, block long, point long, ids array<long>, v {kind}")
    asked = rows.filter(is_query).select("vec_id", "v").mapInArrow(_query_rows(forest, shared, width, visits, k), f"query_id long, q {kind}, least double, leaves array<long>")
    asked = written(asked, "forest-queries")
    # One row a leaf that many queries visit; leaves are bounded by the sample.
    busy = asked.select(F.explode("leaves").alias("busy")).groupBy("busy").count().filter(F.col("count") > query_block)
    busy = F.broadcast(written(busy.select("busy", F.ceil(F.col("count") / query_block).cast("int").alias("parts")), "forest-busy"))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    asked = asked.select("query_id", "q", "least", F.explode("leaves").alias("leaf"))
    asked = asked.join(busy, asked["leaf"] == busy["busy"], "left").withColumn("part", F.pmod(F.xxhash64("query_id", "q"), parts.cast("long")).cast("int"))
    asked = asked.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "part", "query_id", "q", "least")
    filed = filed.join(busy, filed["leaf"] == busy["busy"], "left").select(*filed.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    cell = ("leaf", "block", "part")
    found = filed.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(_rerank(width, k), "query_id long, point long, ids array<long>, score double")
    # A point found in several trees has one score, so it has one dense rank.
    place = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "point"))
    best = found.withColumn("place", place).filter(F.col("place") <= k + 1)
    each = best.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

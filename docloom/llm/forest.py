"""Operator 13, approximate nearest neighbours: a forest of random-projection trees, then exact reranking of leaf candidates.

Trees are fitted on the driver from a bounded sample (SAMPLE vectors, FIT_MB at most): a node's direction joins two random
vectors of it, and its threshold is the median. Every distinct vector is then sent to its leaf of each tree. A query goes
through all trees with one priority queue: a node's key is the log-probability that a neighbour lies below it, summed
over the splits above; a neighbour's projection is taken as normal around the query's, drawn to the node's mean.
Leaves are taken until `probes` of them are found, whatever tree they are of. How many that are is measured: for PROBED
queries all vectors are compared, and probes is the least number that finds TARGET of their nearest.
In a leaf, queries are streamed past its vectors; what may be among the best is scored anew on the original vectors.

Inner products are searched as angles: a coordinate is added in the trees that gives all vectors the largest norm.

Equal vectors are one class, with the TOP + 1 smallest ids of it (more can be in no result), so copies weigh nothing.
A leaf of many rows is cut into tiles of about TILE vectors, which spread over tasks; a tile's queries are streamed.
On vectors without structure (independent directions) a neighbour is hardly nearer than others, and the probes
that reach TARGET hold a large part of all vectors; the README has the figures.

Defined results: null ids, and vectors that are null, zero, of null or non-finite entries, or of another length than the
most common, take no part; repeated rows count once; an id with several vectors has the largest of their nearness;
fewer candidates than TOP: all that are found; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, shuffle_partitions, table
from .vectors import matrix, usable

TOP, EVERY = 20, 20  # fixed values: neighbours, queries' ids
TREES, LEAF, TILE = 4, 512, 4096
SAMPLE, FIT_MB = 65_536, 64
PROBED, TARGET = 200, 0.95
HELD = 20_000  # queries of which a task holds the best found
NEAR = 1e-9  # part of the largest product by which a block's products may be off


def log_normal(z: np.ndarray) -> np.ndarray:
    """log of the normal distribution function, by a logistic curve: close enough to order leaves, and cheap."""
    x = 1.5976 * z + 0.070566 * z ** 3
    return -np.logaddexp(0.0, -x)


@dataclass
class Forest:
    """Nodes of each tree by levels: node k has 2k + 1 and 2k + 2 below it. directions: trees, nodes, entries + 1."""

    depth: int
    norm: float
    directions: np.ndarray
    thresholds: np.ndarray
    means: np.ndarray
    spreads: np.ndarray

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0.0))
        return np.hstack((x, rest[:, None])) / self.norm

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """rows x trees: the leaf of each vector, numbered over all trees."""
        y = self.lifted(x)
        out = np.empty((len(x), len(self.directions)), np.int64)
        for t, w in enumerate(self.directions):
            at = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                low, high = (1 << level) - 1, (2 << level) - 1
                p = (y @ w[low:high].T)[np.arange(len(x)), at - low] if level < 4 else np.einsum("ij,ij->i", y, w[at])
                at = 2 * at + 1 + (p > self.thresholds[t, at])
            out[:, t] = at - (self.leaves - 1) + t * self.leaves
        return out

    def splits(self, q: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """rows x trees x nodes: log-probability that a neighbour of such a cosine lies left, and right."""
        y = np.hstack((q / np.linalg.norm(q, axis=1)[:, None], np.zeros((len(q), 1))))
        p = np.einsum("ij,tkj->itk", y, self.directions, optimize=True)
        z = (self.means + cosine * (p - self.means) - self.thresholds) / (sqrt(max(1 - cosine ** 2, 1e-6)) * self.spreads)
        return log_normal(-z), log_normal(z)

    def visit(self, left: list, right: list) -> Iterator[int]:
        """Leaves of all trees, likeliest first: one queue for the forest. left, right: a query's, by tree."""
        inner = self.leaves - 1
        queue = [(0.0, t, 0) for t in range(len(left))]
        while queue:
            cost, t, k = heappop(queue)
            if k >= inner:
                yield t * self.leaves + k - inner
                continue
            heappush(queue, (cost - left[t][k], t, 2 * k + 1))
            heappush(queue, (cost - right[t][k], t, 2 * k + 2))


def plant(sample: np.ndarray, norm: float, rows: int, trees: int = TREES, leaf: int = LEAF, seed: int = 13) -> Forest:
    """A forest for `rows` vectors with about `leaf` of them in a leaf; a leaf has 16 of the sample at least."""
    rng = np.random.default_rng(seed)
    depth = max(0, min(ceil(log2(max(rows / leaf, 1))), int(log2(max(len(sample) / 16, 1)))))
    nodes, d = (1 << depth) - 1, sample.shape[1] + 1
    forest = Forest(depth, norm, np.zeros((trees, nodes, d)), np.zeros((trees, nodes)), np.zeros((trees, nodes)), np.ones((trees, nodes)))
    y = forest.lifted(sample)
    for t in range(trees):
        inside = {0: np.arange(len(y))}
        for k in range(nodes):
            some = inside.pop(k)
            w = rng.standard_normal(d)
            if len(some) > 1:
                a, b = y[rng.choice(some, 2, replace=False)]
                w = a - b if np.any(a != b) else w
            w = w / np.linalg.norm(w)
            p = y[some] @ w
            cut = float(np.median(p)) if len(p) else 0.0
            forest.directions[t, k], forest.thresholds[t, k] = w, cut
            if len(p):
                forest.means[t, k], forest.spreads[t, k] = p.mean(), max(float(p.std()), 1e-6)
            inside[2 * k + 1], inside[2 * k + 2] = some[p <= cut], some[p > cut]
    return forest


def best_of(q: np.ndarray, v: np.ndarray, head: np.ndarray, top: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in q and in v, and products, of each query's best vectors: by product, then by head; none far below a query's
    floor. Products are summed entry by entry, so that a pair has one product wherever it meets."""
    block = q @ v.T
    least = np.partition(block, len(v) - top, axis=1)[:, len(v) - top] if len(v) > top else np.full(len(q), -np.inf)
    if floor is not None:
        least = np.maximum(least, floor)
    i, j = np.nonzero(block >= (least - NEAR * np.abs(block).max())[:, None])
    s = (q[i] * v[j]).sum(axis=1)
    order = np.lexsort((head[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    keep = rank < top
    return i[keep], j[keep], s[keep]


class Best:
    """What a task has found for each of its queries: the best `top`, each class once; at most HELD queries at a time."""

    def __init__(self, top: int):
        self.top, self.found, self.floor = top, {}, {}

    def floors(self, names: np.ndarray) -> np.ndarray:
        return np.array([self.floor.get(n, -np.inf) for n in names.tolist()])

    def add(self, name: int, s: np.ndarray, head: np.ndarray, cls: np.ndarray) -> None:
        if name in self.found:
            s, head, cls = (np.concatenate(x) for x in zip(self.found[name], (s, head, cls), strict=True))
        self.found[name] = s, head, cls = self.cut(s, head, cls)
        if len(s) == self.top:
            self.floor[name] = s[-1]

    def cut(self, s: np.ndarray, head: np.ndarray, cls: np.ndarray) -> tuple:
        order = np.lexsort((cls, head, -s))
        s, head, cls = s[order], head[order], cls[order]
        _, once = np.unique(cls, return_index=True)
        once = np.sort(once)[:self.top]
        return s[once], head[once], cls[once]

    def rows(self) -> pa.RecordBatch:
        names = list(self.found)
        cut = [self.cut(*self.found[n]) for n in names]
        s, head, cls = (np.concatenate(x) for x in zip(*cut, strict=True))
        q = np.repeat(np.array(names, np.int64), [len(x[0]) for x in cut])
        self.found, self.floor = {}, {}
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (q, cls, head, s)], ["q", "cls", "head", "score"])


def classes_of(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """cls, vector, head (smallest id), ids (the TOP + 1 smallest): a row for each different vector of rows (vec_id, vector)."""
    order = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.distinct().withColumn("k", order).filter(F.col("k") <= TOP + 1)
    each = few.groupBy("vector").agg(F.min("vec_id").alias("head"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return scratch.written(each.select(F.monotonically_increasing_id().alias("cls"), "vector", "head", "ids"), "classes")


def _best_rows(it: Iterator[pa.RecordBatch], q: np.ndarray, names: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    """Each partition's best for a few queries."""
    held = None
    for b in it:
        if not b.num_rows:
            continue
        v, head, cls = matrix(b), b.column("head").to_numpy(), b.column("cls").to_numpy()
        if held is not None:
            v, head, cls = np.vstack((held[0], v)), np.concatenate((held[1], head)), np.concatenate((held[2], cls))
        i, j, s = best_of(q, v, head, top)
        some = np.unique(j)
        held = v[some], head[some], cls[some]
        found = names[i], cls[j], head[j], s
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["q", "cls", "head", "score"])


def probes_for(classes: DataFrame, asked: DataFrame, forest: Forest, target: float) -> tuple[int, float]:
    """The least number of leaves that finds `target` of the nearest of a bounded sample of queries, and the cosine
    that orders leaves: both from exact nearest vectors."""
    few = asked.orderBy(F.xxhash64("vector", F.lit(7)), "cls").limit(PROBED).select("cls", "vector").collect()
    q, names = np.array([r.vector for r in few]), np.array([r.cls for r in few], np.int64)
    found = classes.select("cls", "vector", "head").mapInArrow(lambda it: _best_rows(it, q, names, TOP + 1), "q long, cls long, head long, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "head"))
    near = found.filter("q <> cls").withColumn("rank", rank).filter(F.col("rank") <= TOP)
    met = F.broadcast(near.select("q", "cls", "score")).join(classes.select("cls", "vector"), "cls").collect()  # PROBED * TOP rows
    if not met:
        return 1, 0.5
    row = {int(c): k for k, c in enumerate(names)}
    at = np.array([row[r.q] for r in met])
    v = np.array([r.vector for r in met])
    cosine = float(np.clip(np.median(np.array([r.score for r in met]) / np.linalg.norm(q, axis=1)[at] / forest.norm), 0.05, 0.999))
    leaves = forest.leaves_of(v)
    left, right = forest.splits(q, cosine)
    ranks = np.empty((len(q), len(forest.directions) * forest.leaves), np.int64)
    for k in range(len(q)):
        ranks[k, list(forest.visit(left[k].tolist(), right[k].tolist()))] = np.arange(ranks.shape[1])
    first = np.sort(ranks[at[:, None], leaves].min(axis=1))
    return int(first[min(len(first) - 1, ceil(target * len(first)) - 1)]) + 1, cosine


def _vectors_by_cell(forest: Forest, tiles: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                cls = b.column("cls").to_numpy()
                cell = forest.leaves_of(matrix(b)) * tiles + (cls % tiles)[:, None]
                at = pa.array(np.repeat(np.arange(b.num_rows), cell.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(cell.ravel()), pa.array(np.zeros(cell.size, np.int32)), *(b.column(c).take(at) for c in ("cls", "head", "vector"))], ["cell", "side", "cls", "head", "vector"])

    return run


def _queries_by_cell(forest: Forest, tiles: int, probes: int, cosine: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for part in (b.slice(k, 64) for k in range(0, b.num_rows, 64)):
                left, right = forest.splits(matrix(part), cosine)
                cells, at = [], []
                for k in range(part.num_rows):
                    for _, leaf in zip(range(probes), forest.visit(left[k].tolist(), right[k].tolist()), strict=False):
                        cells.extend(range(leaf * tiles, (leaf + 1) * tiles))
                    at.extend([k] * (len(cells) - len(at)))
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(np.ones(len(cells), np.int32)), *(part.column(c).take(rows) for c in ("cls", "head", "vector"))], ["cell", "side", "cls", "head", "vector"])

    return run


def _meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, vectors before queries: a cell's vectors are held, its queries stream past them. A query's best so
    far is a floor for its further cells of this task."""
    cell, held, v, best = None, [], None, Best(TOP + 1)
    for b in it:
        if not b.num_rows:
            continue
        at, side = b.column("cell").to_numpy(), b.column("side").to_numpy()
        cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(side) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(at)], strict=True):
            part = b.slice(lo, hi - lo)
            x, cls, head = matrix(part), part.column("cls").to_numpy(), part.column("head").to_numpy()
            if at[lo] != cell:
                cell, held, v = at[lo], [], None
            if side[lo] == 0:
                held.append((x, cls, head))
            elif held:
                if v is None:
                    v, names, heads = (np.concatenate(y) for y in zip(*held, strict=True))
                i, j, s = best_of(x, v, heads, best.top, best.floors(cls))
                cut = np.flatnonzero(np.diff(i, prepend=-1))
                for a, z in zip(cut, np.append(cut, len(i))[1:], strict=True):
                    best.add(int(cls[i[a]]), s[a:z], heads[j[a:z]], names[j[a:z]])
                if len(best.found) >= HELD:
                    yield best.rows()
    if best.found:
        yield best.rows()


def nearest(rows: DataFrame, every: int = EVERY, trees: int = TREES, leaf: int = LEAF, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the TOP nearest found of each row of rows (vec_id, embedding) whose id is divisible by `every`."""
    spark, kind = rows.sparkSession, rows.schema["vec_id"].dataType.simpleString()
    scratch = Scratch(spark)
    some = usable(rows.filter("vec_id is not null"), "embedding", "vec_id").filter(F.exists("vector", lambda x: x != 0))
    some = some.withColumn("vec_id", F.col("vec_id").cast("long"))
    classes = classes_of(some, scratch)
    mine = some.filter(F.col("vec_id") % every == 0).distinct().join(classes.select("cls", "vector"), "vector").select(F.col("vec_id").alias("query_id"), F.col("cls").alias("q"))
    mine = scratch.written(mine, "queries")
    asked = classes.join(mine.select(F.col("q").alias("cls")).distinct(), "cls", "left_semi")

    def sizes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most = 0, 0.0
        for b in it:
            if b.num_rows:
                n, most = n + b.num_rows, max(most, float(np.linalg.norm(matrix(b), axis=1).max()))
        yield pa.RecordBatch.from_pydict({"n": [n], "norm": [most]})

    n, norm = classes.select("vector").mapInArrow(sizes, "n long, norm double").agg(F.sum("n"), F.max("norm")).first()
    out = f"query_id {kind}, rank int, vec_id {kind}, score double"
    if not n:
        return spark.createDataFrame([], out)
    length = len(classes.select("vector").first().vector)
    most = min(SAMPLE, (FIT_MB << 20) // (8 * length))
    drawn = classes.filter((F.xxhash64("vector").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)) < 1.2 * most / n + 1e-3) if n > most else classes
    sample = drawn.orderBy(F.xxhash64("vector")).limit(most).select("vector").toArrow()
    fit_on = np.concatenate([matrix(b) for b in sample.to_batches() if b.num_rows])
    forest = plant(fit_on, norm * (1 + 1e-12), n, trees, leaf)
    probes, cosine = probes_for(classes, asked, forest, target)
    tiles = max(1, ceil(n / forest.leaves / TILE))

    cell = "cell long, side int, cls long, head long, vector array<double>"
    some = classes.select("cls", "head", "vector")
    both = some.mapInArrow(_vectors_by_cell(forest, tiles), cell).unionByName(asked.select("cls", "head", "vector").mapInArrow(_queries_by_cell(forest, tiles, probes, cosine), cell))
    pairs = both.repartition(max(shuffle_partitions(spark), 1), "cell").sortWithinPartitions("cell", "side").mapInArrow(_meet, "q long, cls long, head long, score double")
    rank = F.dense_rank().over(Window.partitionBy("q").orderBy(F.desc("score"), "head", "cls"))
    top = pairs.withColumn("rank", rank).filter(F.col("rank") <= TOP + 1).dropDuplicates(["q", "cls"])

    ids = top.join(classes.select("cls", "ids"), "cls").select("q", "score", F.explode("ids").alias("vec_id"))
    ids = ids.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    lists = ids.withColumn("rank", rank).filter(F.col("rank") <= TOP + 1).groupBy("q").agg(F.collect_list(F.struct("vec_id", "score")).alias("near"))
    each = mine.join(lists, "q").select("query_id", F.inline("near")).filter("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    each = each.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= TOP)
    return each.select(F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("vec_id").cast(kind).alias("vec_id"), "score")


def op13_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_forest": op13_forest}
#: Exact nearest vectors; a table of up to LEAF vectors is one leaf.
SQL = {"op13_forest": """
with v as (select distinct vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (select q.vec_id as query_id, c.vec_id, max(list_inner_product(q.e, c.e)) as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0 group by all),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from pairs)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 20
"""}

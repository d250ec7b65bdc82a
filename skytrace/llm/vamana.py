"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, a shard each.

Vectors are dealt to shards of about ``SHARD``: by length first (``GRADES`` grades an octave), so that in a shard the
largest inner product is nearly the least distance, then by their hash. In a shard, points enter a graph in batches:
a greedy beam search from the entry point proposes neighbours (the beam and all points met on the
way), relaxed pruning keeps the nearest and drops every candidate that a kept one is nearer to by the factor
``ALPHA``, edges are made both ways, and a list that outgrows its slack is pruned again. Searches run
for a whole batch at a time. A point that no path from the entry reaches gets an edge from its nearest
reached neighbour, so that every row can be found.

Largest inner product is least distance once each vector has a further component sqrt(M - |x|^2), M the
largest squared norm of the shard, and the query a 0 there. Graphs are kept as rows (``build``) of the
shared folder; ``search`` sends every query to every shard, where a beam search in 32-bit floats proposes
and the original vectors rank in double precision, and merges the shards' best.

Equal vectors are one point with its smallest k + 1 ids, the only ones any answer can hold. A group
of copies of any size is cut to these before the shuffle, by a window limit.

Defined cases: rows whose id or vector is null, and vectors that are empty, zero or hold null or
non-finite components take no part. Vectors of different length are never compared. Repeated rows
of one id and vector are one. An id with several vectors has its own row left out of its answers
whichever vector asks, and asks with each: its answers are the best of both. No rows: no answers. Fewer candidates than
k: all that are found. Ties go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import col

SHARD, DEGREE, SLACK, BEAM, ALPHA = 4096, 32, 48, 64, 1.2
#: Points expanded at once by one search, searches run together, queries to a packed row.
WIDE, TOGETHER, ASK = 4, 256, 1024
_FAR = np.float32(np.inf)
GRADES = 8


# ------------------------------------------------------------------------- one shard's graph
class Graph:
    """points (n, d) float32, edges (n, SLACK) of point numbers (-1: none), entry point."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entry: int):
        self.points, self.edges, self.entry = points, edges, entry

    def beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Greedy beam searches of all queries: (ids, squared distances) of the beams, nearest first, and
        (ids, squared distances) of the points expanded on the way (-1: none)."""
        m = len(queries)
        ids = np.full((m, width), -1)
        dist = np.full((m, width), _FAR)
        done = np.ones((m, width), bool)
        seen = np.zeros((m, len(self.points)), bool)
        ids[:, 0], done[:, 0], seen[:, self.entry] = self.entry, False, True
        dist[:, 0] = ((queries - self.points[self.entry]) ** 2).sum(1)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.zeros((m, len(self.points)), np.int32)
        live = np.arange(m)
        while len(live):
            open_ = ~done[live]
            nth = np.cumsum(open_, 1)
            at = np.stack([np.where(nth[:, -1] >= k, (nth >= k).argmax(1), -1) for k in range(1, WIDE + 1)], 1)
            row = np.arange(len(live))[:, None]
            node = np.where(at >= 0, ids[live[:, None], at], -1)
            far = np.where(at >= 0, dist[live[:, None], at], _FAR)
            some, slot = np.nonzero(at >= 0)
            done[live[some], at[some, slot]] = True
            log = np.full((2, m, WIDE), -1.0)
            log[0][live], log[1][live] = node, far
            steps.append((log[0].astype(np.int64), log[1].astype(np.float32)))
            more = np.where(node[:, :, None] >= 0, self.edges[node], -1).reshape(len(live), -1)
            new = (more >= 0) & ~seen[live[:, None], more]
            r, c = np.nonzero(new)
            order[live[r], more[r, c]] = c  # of equal neighbours in this step one stays
            stay = order[live[r], more[r, c]] == c
            r, c = r[stay], c[stay]
            q, p = live[r], more[r, c]
            seen[q, p] = True
            d = ((self.points[p] - queries[q]) ** 2).sum(1)
            near = np.full((len(live), more.shape[1]), _FAR)
            name = np.full(near.shape, -1)
            near[r, c], name[r, c] = d, p
            all_d = np.concatenate([dist[live], near], 1)
            best = np.argpartition(all_d, width - 1, 1)[:, :width]
            best = best[row, np.argsort(all_d[row, best], 1, kind="stable")]
            dist[live] = all_d[row, best]
            ids[live] = np.concatenate([ids[live], name], 1)[row, best]
            done[live] = np.concatenate([done[live], name < 0], 1)[row, best]
            live = live[~done[live].all(1)]
        met = np.concatenate([s[0] for s in steps], 1)
        return ids, dist, met, np.concatenate([s[1] for s in steps], 1)


def robust_prune(points: np.ndarray, own: np.ndarray, ids: np.ndarray, dist: np.ndarray, degree: int = DEGREE,
                 alpha: float = ALPHA) -> np.ndarray:
    """For each point ``own`` up to ``degree`` of its candidates (-1: none): the nearest stays, all that are nearer
    to it by the factor ``alpha`` than to the point go, and so on."""
    dist = np.where((ids < 0) | (ids == own[:, None]), _FAR, dist)
    order = np.argsort(dist, 1, kind="stable")
    row = np.arange(len(own))[:, None]
    ids, dist = ids[row, order], dist[row, order]
    width = int(np.isfinite(dist).sum(1).max(initial=0))
    ids, dist = ids[:, :width], dist[:, :width]
    out = np.full((len(own), degree), -1)
    if not width:
        return out
    x = points[np.maximum(ids, 0)]
    square = (x * x).sum(2)
    between = square[:, :, None] + square[:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
    open_ = np.isfinite(dist)
    row = np.arange(len(own))
    for k in range(degree):
        first = open_.argmax(1)
        has = open_[row, first]
        if not has.any():
            break
        out[has, k] = ids[has, first[has]]
        open_ &= (alpha * alpha) * between[row, first] > dist
        open_[row, first] = False
        open_ &= ids != out[:, k][:, None]
    return out


def _prune(graph: Graph, own: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> np.ndarray:
    out = np.full((len(own), graph.edges.shape[1]), -1)
    step = max(1, (1 << 22) // max(1, ids.shape[1] ** 2))
    for k in range(0, len(own), step):
        out[k:k + step, :DEGREE] = robust_prune(graph.points, own[k:k + step], ids[k:k + step], dist[k:k + step])
    return out


def _back_edges(graph: Graph, source: np.ndarray, target: np.ndarray) -> None:
    """Edges target -> source; lists beyond the slack are pruned."""
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    own, first, many = np.unique(target, return_index=True, return_counts=True)
    width = graph.edges.shape[1]
    have = (graph.edges[own] >= 0).sum(1)
    fit = have + many <= width
    slot = np.arange(len(target)) - np.repeat(first, many) + np.repeat(have, many)
    easy = np.repeat(fit, many)
    graph.edges[target[easy], slot[easy]] = source[easy]
    for cap in (width, 4 * width, len(graph.points)):  # few points get very many edges at once
        full = np.flatnonzero(~fit & (many <= cap))
        fit[full] = True
        step = max(1, (1 << 16) // cap)
        for k in range(0, len(full), step):
            part = full[k:k + step]
            span = int(many[part].max())
            ids = np.full((len(part), width + span), -1)
            ids[:, :width] = graph.edges[own[part]]
            r = np.repeat(np.arange(len(part)), many[part])
            c = np.arange(len(r)) - np.repeat(np.cumsum(many[part]) - many[part], many[part])
            ids[r, width + c] = source[np.repeat(first[part], many[part]) + c]
            dist = ((graph.points[ids] - graph.points[own[part]][:, None]) ** 2).sum(2)
            graph.edges[own[part]] = _prune(graph, own[part], ids, dist)


def build_graph(points: np.ndarray) -> Graph:
    n = len(points)
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    graph = Graph(points, np.full((n, SLACK), -1), entry)
    rest = np.delete(np.arange(n), entry)
    at, inside = 0, 1
    while at < len(rest):
        own = rest[at:at + max(1, min(TOGETHER, inside // 8))]
        ids, dist, met, met_dist = graph.beam(points[own], BEAM)
        again = np.concatenate([ids, met], 1)
        graph.edges[own] = _prune(graph, own, again, np.concatenate([dist, met_dist], 1))
        r, c = np.nonzero(graph.edges[own] >= 0)
        _back_edges(graph, own[r], graph.edges[own][r, c])
        at, inside = at + len(own), inside + len(own)
    _reach(graph)
    return graph


def _reach(graph: Graph) -> None:
    """Every point gets a path from the entry: those without one are chained, in a column added for the purpose, behind
    the reached point nearest to them."""
    n = len(graph.points)
    reached, front = np.zeros(n, bool), np.array([graph.entry])
    while len(front):
        reached[front] = True
        front = np.unique(graph.edges[front])
        front = front[front >= 0]
        front = front[~reached[front]]
    lost, inside = np.flatnonzero(~reached), np.flatnonzero(reached)
    if not len(lost):
        return
    y = graph.points[inside]
    square = (y * y).sum(1)
    near = np.concatenate([inside[(square - 2 * graph.points[lost[k:k + TOGETHER]] @ y.T).argmin(1)]
                           for k in range(0, len(lost), TOGETHER)])
    order = np.argsort(near, kind="stable")
    lost, near = lost[order], near[order]
    head = np.append(True, near[1:] != near[:-1])
    spare = np.full((n, 1), -1)
    spare[np.where(head, near, np.append(0, lost[:-1])), 0] = lost
    graph.edges = np.concatenate([graph.edges, spare], 1)


# ------------------------------------------------------------------------- shards as rows
def _augmented(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Points for which least distance is largest inner product, and the scale they are measured in."""
    scale = float(np.abs(x).max()) or 1.0
    y = x / scale
    square = (y * y).sum(1)
    return np.append(y, np.sqrt(np.maximum(square.max() - square, 0))[:, None], 1).astype(np.float32), scale


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard -> one row a shard."""
    def made(parts: list[pa.RecordBatch]):
        t = pa.Table.from_batches(parts).combine_chunks()
        shard, size = t["_shard"][0].as_py(), t["_size"][0].as_py()
        ids = t["_ids"].combine_chunks()
        x = np.asarray(t["_vector"].combine_chunks().flatten()).reshape(-1, size)
        points, _ = _augmented(x)
        graph = build_graph(points)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([size], pa.int32()), pa.array([graph.entry]), pa.array([graph.edges.shape[1]]),
             pa.array([graph.edges.astype("<i4").tobytes()]), pa.array([x.astype("<f8").tobytes()]),
             pa.array([np.asarray(ids.flatten()).astype("<i8").tobytes()]),
             pa.array([np.asarray(ids.value_lengths()).astype("<i4").tobytes()])], names=_INDEX_COLUMNS)

    at, parts = None, []
    for b in batches:
        keys = np.asarray(col(b, "_shard"))
        sizes = np.asarray(col(b, "_size"))
        cuts = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (sizes[1:] != sizes[:-1]))), b.num_rows)
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if parts and at != (keys[i], sizes[i]):
                yield made(parts)
                parts = []
            at = (keys[i], sizes[i])
            parts.append(b.slice(i, j - i))
    if parts:
        yield made(parts)


_INDEX_COLUMNS = ["_shard", "_size", "_entry", "_width", "_edges", "_points", "_ids", "_many"]
_INDEX = ("_shard long, _size int, _entry long, _width long, _edges binary, _points binary, _ids binary, _many binary")


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(_id, _vector) of the rows that take part."""
    v = vectors.select(vectors[id_col].cast("long").alias("_id"), vectors[vector_col].cast("array<double>").alias("_vector"))
    bad = F.exists("_vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.filter(F.col("_id").isNotNull() & F.col("_vector").isNotNull()).filter(
        ~F.coalesce(bad, F.lit(True)) & F.exists("_vector", lambda x: x != 0)).withColumn(
        "_vector", F.transform("_vector", lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are one value


def build(rows: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """Index over ``usable`` rows: one row per shard, written to the shared folder."""
    spark = rows.sparkSession
    own = Window.partitionBy("_vector").orderBy("_id")
    # rank() drops no tie of equal ids; the set drops repeated rows
    points = materialise(
        rows.select("_id", "_vector", F.dense_rank().over(own).alias("_k")).filter(F.col("_k") <= k + 1)
        .groupBy("_vector").agg(F.array_sort(F.collect_set("_id")).alias("_ids"))
        .select("_ids", "_vector", F.size("_vector").alias("_size"), _grade("_vector").alias("_grade")), "points")
    kind = ["_size", "_grade"]
    shards = points.groupBy(*kind).agg(F.ceil(F.count("*") / shard).alias("_shards"))  # a row for each grade that occurs
    share = F.pmod(F.xxhash64("_vector"), F.col("_shards"))
    dealt = points.join(F.broadcast(shards), kind).select(
        "_size", F.xxhash64("_grade", share).alias("_shard"), "_ids", "_vector", F.xxhash64("_vector", F.lit(1)).alias("_turn"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(shards.agg(F.sum("_shards")).first()[0] or 1))
    return materialise(dealt.repartition(parts, "_size", "_shard").sortWithinPartitions("_size", "_shard", "_turn")
                       .mapInArrow(_build, _INDEX), "graphs")


def _grade(vector: str) -> Column:
    """The grade of a vector's length; measured by its largest component, so that no square overflows."""
    largest = F.array_max(F.transform(vector, F.abs))
    square = F.aggregate(F.transform(vector, lambda x: (x / largest) * (x / largest)), F.lit(0.0), lambda a, x: a + x)
    return F.round(GRADES * (F.log2(largest) + F.log2(square) / 2)).cast("int")


def _packed_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct query vectors, sorted by length, in packed rows of at most ASK vectors of one length."""
    for b in batches:
        lists = col(b, "_vector")
        sizes, names = np.asarray(lists.value_lengths()), np.asarray(col(b, "_query"))
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            for k in range(0, len(at), ASK):
                part = at[k:k + ASK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size], pa.int32()), pa.array([names[part].astype("<i8").tobytes()]),
                     pa.array([np.asarray(lists.take(pa.array(part)).flatten()).astype("<f8").tobytes()])],
                    names=["_size", "_names", "_vectors"])


class _Shard:
    def __init__(self, row: dict):
        size = row["_size"]
        self.x = np.frombuffer(row["_points"], "<f8").reshape(-1, size)
        points, self.scale = _augmented(self.x)
        edges = np.frombuffer(row["_edges"], "<i4").reshape(-1, row["_width"]).astype(np.int64)
        self.graph = Graph(points, edges, row["_entry"])
        self.ids = np.frombuffer(row["_ids"], "<i8")
        many = np.frombuffer(row["_many"], "<i4").astype(np.int64)
        self.at = np.append(0, np.cumsum(many))

    def answer(self, names: np.ndarray, queries: np.ndarray, k: int, width: int) -> pa.RecordBatch:
        """The best k + 1 ids of each query."""
        scaled = queries / np.maximum(np.abs(queries).max(1, keepdims=True), 1e-300)
        norm = np.sqrt((scaled * scaled).sum(1, keepdims=True))
        reach = np.sqrt((self.graph.points[0] ** 2).sum())
        asked = np.append(scaled / norm * reach, np.zeros((len(queries), 1)), 1).astype(np.float32)
        ids, _, _, _ = self.graph.beam(asked, width)
        r, c = np.nonzero(ids >= 0)
        p = ids[r, c]
        score = np.einsum("ij,ij->i", queries[r], self.x[p])
        many = np.diff(self.at)[p]
        pick = np.repeat(np.arange(len(p)), many)
        owner = np.repeat(self.at[p] - (np.cumsum(many) - many), many) + np.arange(len(pick))
        row, score, vec = r[pick], score[pick], self.ids[owner]
        order = np.lexsort((vec, -score, row))
        row, score, vec = row[order], score[order], vec[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        on = rank <= k
        return pa.RecordBatch.from_arrays([pa.array(names[row[on]]), pa.array(vec[on]), pa.array(score[on])],
                                          names=["_query", "_vec", "_score"])


def _search(k: int, width: int):
    """Rows sorted by shard, the index before the packed queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                if row["_names"] is None:
                    shard = _Shard(row)
                    continue
                names = np.frombuffer(row["_names"], "<i8")
                queries = np.frombuffer(row["_vectors"], "<f8").reshape(len(names), -1)
                for j in range(0, len(names), TOGETHER):
                    yield shard.answer(names[j:j + TOGETHER], queries[j:j + TOGETHER], k, width)

    return run


def search(index: DataFrame, asked: DataFrame, k: int, width: int = BEAM) -> DataFrame:
    """``asked`` (_query: a number for each distinct vector, _vector) -> the best k + 1 of all shards: _query, _vec,
    _score. Every packed row of queries goes to every shard of its vector length."""
    shards = index.groupBy("_size").agg(F.collect_set("_shard").alias("_all"))  # a few bytes a shard
    packed = asked.mapInArrow(_packed_queries, "_size int, _names binary, _vectors binary")
    packed = packed.join(F.broadcast(shards), "_size").select("_size", F.explode("_all").alias("_shard"), "_names", "_vectors")
    rows = index.unionByName(packed, allowMissingColumns=True)
    n = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), index.count())
    found = (rows.repartition(n, "_size", "_shard").sortWithinPartitions("_size", "_shard", F.col("_names").isNotNull())
             .mapInArrow(_search(k, width), "_query long, _vec long, _score double"))
    best = Window.partitionBy("_query").orderBy(F.desc("_score"), "_vec")
    return found.select("*", F.row_number().over(best).alias("_rank")).filter(F.col("_rank") <= k + 1).drop("_rank")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            shard: int = SHARD, width: int = BEAM) -> DataFrame:
    """The k rows of largest inner product, its own left out, found for each row that ``queries`` (a condition on
    _id) selects: query_id, rank, vec_id, score."""
    rows = usable(vectors, id_col, vector_col)
    index = build(rows, k, shard)
    asking = rows.filter(queries).distinct()
    # queries of equal vectors are searched once, under a number
    numbered = materialise(asking.groupBy("_vector").agg(F.min("_id").alias("_least"))
                           .select("_vector", F.monotonically_increasing_id().alias("_query")), "asked")
    found = search(index, numbered, k, width).groupBy("_query").agg(F.collect_list(F.struct("_vec", "_score")).alias("_found"))
    answers = numbered.join(found, "_query").select("_vector", "_found")
    each = asking.join(answers, "_vector").select(F.col("_id").alias("query_id"), F.explode("_found").alias("_f"))
    each = each.filter("_f._vec != query_id").groupBy("query_id", F.col("_f._vec").alias("vec_id")).agg(F.max("_f._score").alias("score"))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.select("query_id", F.row_number().over(own).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)

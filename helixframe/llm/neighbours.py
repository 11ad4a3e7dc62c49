"""Nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample: a level of a tree projects on one random direction, and each of its nodes
splits at the median. The depth follows the number of distinct vectors, so that a leaf holds about LEAF_ROWS
until MAX_DEPTH (for which the sample suffices) is reached. Every row is sent to its leaf in every tree. A query
walks all trees at once through one priority queue, ordered by how far it lies on the wrong side of the splits
above a node. How many leaves it takes is measured: as many as let queries of the sample find TARGET of their
neighbours in the sample. So vectors with structure need few leaves, and vectors without any need many.

Queries meet the rows of their leaves in blocks. A row that a query meets in several trees is measured in the
first of them only (queries carry the set of their leaves, rows their leaf in each tree), exactly, in double
precision, on the original vectors. A query also brings how far the k-th nearest of the sample's rows in its
leaves is: it will meet those rows, so what is farther isn't among the k nearest that it finds, and isn't
passed on. Equal vectors are searched once and expanded to ids at the end. A leaf's
rows and its queries are both cut into blocks by a hash, so a leaf that grows with the data stays a matter of
many tasks.

Defined results: rows with a null id, or a null, zero or non-finite vector, take no part, nor do vectors of
another length than most; with fewer candidates than k all are returned; ties go to the smaller id; repeated
rows are one, and an id with several vectors is searched and found by each; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import bounded_sample, materialize
from helixframe.llm.vectors import classes, matrix, valid

#: The bounded sample that trees are fitted on, and rows of it that serve as queries to measure the search.
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 300
TREES, LEAF_ROWS, MAX_DEPTH = 4, 384, 11
#: The share of their nearest neighbours that the sample's queries must find.
TARGET = 0.95
#: Rows, and queries, of a leaf that meet in one block, about.
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 2_048


@dataclass
class Forest:
    directions: np.ndarray  # tree, level, component
    cuts: np.ndarray  # tree, node; node k has the children 2k+1 and 2k+2
    visits: int  # leaves that a query takes

    @property
    def leaves(self) -> int:
        return self.cuts.shape[1] + 1

    @property
    def trees(self) -> int:
        return len(self.cuts)

    def project(self, x: np.ndarray) -> np.ndarray:
        """row, tree, level."""
        return np.einsum("rc,tlc->rtl", x, self.directions, optimize=True)

    def route(self, x: np.ndarray) -> np.ndarray:
        """row, tree: the leaf of each row."""
        at, trees = self.project(x), np.arange(self.trees)
        node = np.zeros((len(x), self.trees), np.int64)
        for level in range(at.shape[2]):
            node = 2 * node + 1 + (at[:, :, level] >= self.cuts[trees, node])
        return node - self.cuts.shape[1]

    def search(self, at: np.ndarray, most: int) -> list[tuple[int, int]]:
        """The ``most`` best (tree, leaf) pairs of one row, given its projections, by one queue over all trees."""
        queue = [(0.0, t, 0, 0) for t in range(self.trees)]
        out, inner, depth = [], self.cuts.shape[1], at.shape[1]
        while queue and len(out) < most:
            far, tree, node, level = heapq.heappop(queue)
            while level < depth:
                m = at[tree, level] - self.cuts[tree, node]
                heapq.heappush(queue, (far + m * m, tree, 2 * node + 1 + int(m < 0), level + 1))
                node, level = 2 * node + 1 + int(m >= 0), level + 1
            out.append((tree, node - inner))
        return out


def fit(sample: np.ndarray, rows: int, k: int = 10, target: float = TARGET, seed: int = 3) -> Forest:
    """Trees for ``rows`` vectors, and the number of leaves that lets queries of the sample find their neighbours in it."""
    rng = np.random.default_rng(seed)
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(rows, 1) / LEAF_ROWS))), max(0, math.floor(math.log2(max(len(sample), 1) / 4))))
    trees, inner, dims = TREES if depth else 1, 2**depth - 1, sample.shape[1]
    directions = rng.normal(size=(trees, depth, dims))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    cuts = np.zeros((trees, inner))
    for t in range(trees):
        at, node_of = sample @ directions[t].T, [np.arange(len(sample))]
        for node in range(inner):
            mine, level = node_of[node], (node + 1).bit_length() - 1
            p = at[mine, level]
            cuts[t, node] = np.median(p) if len(mine) else 0.0
            node_of += [mine[p < cuts[t, node]], mine[p >= cuts[t, node]]]
    forest = Forest(directions, cuts, trees * (inner + 1))
    if depth:
        asked = rng.permutation(len(sample))[:SAMPLE_QUERIES]
        leaf, at, first = forest.route(sample), forest.project(sample[asked]), []
        size = (sample * sample).sum(axis=1)
        for q, own in zip(asked.tolist(), at, strict=True):
            far = size - 2 * sample @ sample[q]
            far[q] = np.inf
            near = np.argpartition(far, k)[:k] if k < len(far) - 1 else np.flatnonzero(far < np.inf)
            turn = np.full((trees, inner + 1), forest.visits)
            for n, (t, b) in enumerate(forest.search(own, forest.visits)):
                turn[t, b] = n + 1
            first.append(turn[np.arange(trees), leaf[near]].min(axis=1))
        turns = np.sort(np.concatenate(first)) if first else np.array([trees])
        forest.visits = max(trees, int(turns[min(len(turns) - 1, math.ceil(target * len(turns)) - 1)]))
    return forest


def nearest(df: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding", target: float = TARGET) -> DataFrame:
    """Each query's k nearest other rows: query_id, rank, the row's key, score (Euclidean distance)."""
    spark = df.sparkSession
    fine = df.where(valid(vector) & F.col(key).isNotNull())
    distinct, members = classes(fine, key, vector)
    distinct = materialize(distinct, "distinct-vectors")
    queries = fine.where(is_query).select(F.col(key).cast("bigint").alias("query_id")).distinct()
    members = materialize(members.distinct(), "vector-classes")
    queries = materialize(queries.join(members, F.col("query_id") == F.col(key)).select("query_id", "class"), "queries")
    sample = bounded_sample(distinct, "class", SAMPLE_ROWS).collect()
    if not sample:
        return spark.createDataFrame([], f"query_id bigint, rank int, `{key}` bigint, score double")
    widths = [len(r["vector"]) for r in sample]
    dims = max(set(widths), key=lambda n: (widths.count(n), n))
    distinct = distinct.where(F.size("vector") == dims)
    n_rows, n_queries = distinct.count(), queries.count()
    own, known = (np.array([r[c] for r in sample if len(r["vector"]) == dims], t) for c, t in (("class", np.int64), ("vector", float)))
    forest = fit(known, n_rows, k, target)
    trees, leaves, visits = forest.trees, forest.leaves, forest.visits
    shared, sampled = spark.sparkContext.broadcast(forest), spark.sparkContext.broadcast((own, known, forest.route(known)))
    salts = max(1, -(-n_rows // (leaves * BLOCK_ROWS)))
    turns = max(1, -(-n_queries * visits // (trees * leaves * BLOCK_QUERIES)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                leaf = shared.value.route(matrix(part.column(1)))
                where, n = pa.array(leaf.astype("<u2").tobytes()[2 * trees * r : 2 * trees * (r + 1)] for r in range(len(leaf))), part.num_rows
                for t in range(trees):
                    for turn in range(turns):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), pa.array(leaf[:, t].astype(np.int32)), part.column(2), pa.array(np.full(n, turn, np.int32)), part.column(0), part.column(1), where, pa.array(np.zeros(n))], names)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                vectors = matrix(part.column(1))
                found = [shared.value.search(p, visits) for p in shared.value.project(vectors)]
                seen = np.zeros((len(found), trees, leaves), bool)
                for row, pairs in enumerate(found):
                    seen[row][tuple(np.array(pairs).T)] = True
                far = pa.array(kth_distance(vectors, part.column(0).to_numpy(), seen, *sampled.value, k))
                marks = pa.array([s.tobytes() for s in np.packbits(seen.reshape(len(found), -1), axis=1)])
                which = np.repeat(np.arange(len(found)), [len(f) * salts for f in found])
                tree, leaf, salt = (np.array(c, np.int32) for c in zip(*((t, b, s) for f in found for t, b in f for s in range(salts)), strict=True))
                row = pa.array(which)
                yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(leaf), pa.array(salt), part.column(2).take(row), part.column(0).take(row), part.column(1).take(row), marks.take(row), far.take(row)], names)

    names = ["tree", "leaf", "salt", "turn", "class", "vector", "leaves", "far"]
    schema = f"tree int, leaf int, salt int, turn int, class bigint, vector {dict(distinct.dtypes)['vector']}, leaves binary, far double"
    rows = distinct.select("class", "vector", F.pmod(F.xxhash64("class"), F.lit(salts)).cast("int").alias("salt")).mapInArrow(index, schema)
    asking = distinct.join(queries.select("class").distinct(), "class", "left_semi")
    asked = asking.select("class", "vector", F.pmod(F.xxhash64(F.lit(1), "class"), F.lit(turns)).cast("int").alias("turn")).mapInArrow(ask, schema)
    place = ["tree", "leaf", "salt", "turn"]
    found = asked.groupBy(*place).cogroup(rows.groupBy(*place)).applyInArrow(lambda q, r: _block(q, r, k + 1, trees, leaves), "query bigint, class bigint, score double")
    best = Window.partitionBy("query").orderBy("score", "class")
    near = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    least = Window.partitionBy("class").orderBy(key)
    few = members.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).drop("n")
    expanded = near.drop("n").join(few, "class").withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", key))).where(F.col("n") <= k + 1)
    hits = queries.join(expanded.select(F.col("query").alias("class"), key, "score"), "class").where(F.col("query_id") != F.col(key))
    hits = hits.groupBy("query_id", key).agg(F.min("score").alias("score"))  # an id of several vectors
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", key)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", key, "score")


def kth_distance(x: np.ndarray, classes_: np.ndarray, seen: np.ndarray, own: np.ndarray, known: np.ndarray, leaf: np.ndarray, k: int) -> np.ndarray:
    """How far each query's k-th nearest is among the sample's rows in leaves that it has ``seen``; inf if they are fewer."""
    out = np.full(len(x), np.inf)
    size, trees = (known * known).sum(axis=1), np.arange(leaf.shape[1])
    for q, (vector, class_) in enumerate(zip(x, classes_, strict=True)):
        met = np.flatnonzero(seen[q][trees, leaf].any(axis=1) & (own != class_))
        if len(met) >= k:
            near = met[np.argpartition(size[met] - 2 * known[met] @ vector, k - 1)[:k]]
            out[q] = np.sqrt(((known[near] - vector) ** 2).sum(axis=1)).max() * (1 + 1e-9)
    return out


def _block(queries: pa.Table, rows: pa.Table, k: int, trees: int, leaves: int) -> pa.Table:
    """The k nearest rows of each query among those that it does not meet in an earlier tree."""
    schema = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("score", pa.float64())])
    if not queries.num_rows or not rows.num_rows:
        return schema.empty_table()
    q, x, ids = matrix(queries.column("vector")), matrix(rows.column("vector")), rows.column("class").to_numpy()
    tree = queries.column("tree")[0].as_py()
    leaf = np.frombuffer(b"".join(rows.column("leaves").to_pylist()), "<u2").reshape(len(x), trees)
    out: list[list] = [[], [], []]
    for own, vector, marks, far in zip(queries.column("class").to_numpy(), q, queries.column("leaves"), queries.column("far").to_numpy(), strict=True):
        seen = np.unpackbits(np.frombuffer(marks.as_py(), np.uint8), count=trees * leaves).reshape(trees, leaves)
        new = np.flatnonzero(~seen[np.arange(tree), leaf[:, :tree]].any(axis=1)) if tree else np.arange(len(x))
        d = np.sqrt(((x[new] - vector) ** 2).sum(axis=1))
        new, d = new[d <= far], d[d <= far]
        if len(d) > k:
            some = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
            new, d = new[some], d[some]
        order = np.lexsort((ids[new], d))[:k]
        for column, values in zip(out, (np.full(len(order), own), ids[new][order], d[order]), strict=True):
            column.append(values)
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema) if out[0] else schema.empty_table()

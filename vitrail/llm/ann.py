"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Every tree halves a sample of the vectors again and again, by the projection on the
difference of two of them, at the median.  Inner products are turned into angles first: a
vector gets one more component that lifts all to the same norm.  The trees are fitted on a
bounded sample (``sample`` rows, those with the smallest hashes); then every row gets its
leaf in every tree, one byte each.

A query walks all trees through one shared priority queue.  A node's priority is the sum of
the squared distances by which the query lies on the wrong side of the cuts above it; it
never falls on the way down, so the leaves leave the queue in the order of theirs, and a
whole batch of queries takes the first ``visited`` share of all leaves at once, level by
level.  A leaf is worth how far its priority lies below that of the last leaf taken, and a
row is worth the sum of its leaves over all trees.  The best rows by that sum are scored
exactly, in double precision on the original vectors: about ``candidates`` times the square
root of the number of rows, so the share of the table that is scored falls as it grows.
Where that line lies for a query is read off a sample of the rows.

Rows and queries are dealt into blocks, every block of queries meets every block of rows
once (a stated query set against all rows), and a block hands on its ``k + 1`` best per
query.  Vectors are stored once and move once per block of queries, with their leaves;
queries are carried with a number each.  All candidates are scored by the same sum, so
equal scores are equal and the smaller ids win.

Equal vectors are one class, searched once: a class keeps its k + 1 smallest ids, as no
query can list more of it; queries of one class share one list.  What the driver holds and
tasks share is bounded by the settings: the cuts, and a sample of leaves.

Defined cases: vectors that are null, zero, of another dimension than most, or hold null or
non-finite components take no part, neither do rows with a null id; rows that share an id
and a vector count once, and of one id with several vectors the smallest vector counts;
equal scores go to the smaller id; with fewer candidates all are listed; extra columns are
not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrail.llm.common import table, written


@dataclass(frozen=True)
class Settings:
    trees: int = 32
    leaves: int = 256          # of a tree; a power of two, 256 at most
    sample: int = 16_384       # vectors that the trees are fitted on, at most
    judged: int = 8192         # of these, rows that a query's line is read off
    visited: float = 0.3       # share of all leaves that a query takes
    candidates: float = 12.0   # rows scored per query: times the square root of the rows
    rows: int = 8192           # of a block
    queries: int = 4096        # of a block
    seed: int = 11


PRODUCTION = Settings()


# ------------------------------------------------------------------ rows and classes

def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part; floats stay floats, other components
    become doubles."""
    kind = vectors.schema[vector].dataType
    kept = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(
        "array<float>" if kept else "array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).limit(1).collect()
    if not sizes:
        return rows
    rows = rows.where(F.size("vector") == sizes[0]["d"])
    # vectors move only where ids repeat at all
    if rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        return rows
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def classes_of(rows: DataFrame, most: int) -> DataFrame:
    """(rep, vector, members): equal vectors with their ``most`` smallest ids."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("_rank", rank).where(F.col("_rank") <= most)
    return few.groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("members")
    ).select("rep", F.col("vector"), "members")


# ------------------------------------------------------------------ forest

@dataclass
class Forest:
    """Cuts by tree and node, in heap order: ``normals`` (trees, nodes, d + 1) and
    ``offsets`` (trees, nodes); all leaves are at ``depth``."""

    normals: np.ndarray
    offsets: np.ndarray
    depth: int
    top: float  # the largest norm

    def parts(self) -> tuple:
        return self.normals, self.offsets, self.depth, self.top

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top ** 2 - (x * x).sum(axis=1), 0.0))
        return np.column_stack([x, rest])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of every row in every tree."""
        y = self.lifted(x)
        out = np.zeros((len(x), len(self.normals)), dtype=np.uint8)
        for t, (normals, offsets) in enumerate(zip(self.normals, self.offsets)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", y, normals[node]) > offsets[node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2 ** self.depth - 1)
        return out

    def worth(self, queries: np.ndarray, visited: float) -> np.ndarray:
        """(queries, trees, leaves): what the leaves are worth to each query, 0 for those
        that it does not take from the shared queue."""
        norms = np.linalg.norm(queries, axis=1)
        y = np.column_stack([queries * (self.top / norms)[:, None], np.zeros(len(queries))])
        priority = np.zeros((len(y), len(self.normals), 1))
        for level in range(self.depth):
            nodes = slice(2 ** level - 1, 2 ** (level + 1) - 1)
            margin = np.tensordot(y, self.normals[:, nodes], (1, 2)) - self.offsets[:, nodes]
            below = np.empty((*margin.shape[:2], 2 * margin.shape[2]))
            below[:, :, 0::2] = priority + np.maximum(margin, 0) ** 2
            below[:, :, 1::2] = priority + np.maximum(-margin, 0) ** 2
            priority = below
        flat = priority.reshape(len(y), -1)
        take = min(flat.shape[1], max(1, math.ceil(visited * flat.shape[1])))
        last = np.partition(flat, take - 1, axis=1)[:, take - 1]
        return np.maximum(last[:, None, None] - priority, 0.0).astype(np.float32)


def sums_of_worth(worth: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """(queries, rows): each row's leaves added up."""
    total = np.zeros((len(worth), len(leaves)), dtype=np.float32)
    for t in range(leaves.shape[1]):
        total += np.take(worth[:, t], leaves[:, t], axis=1)
    return total


def grow(sample: np.ndarray, top: float, s: Settings) -> Forest:
    """A forest fitted on ``sample``, of leaves that hold some eight of it at least."""
    depth = max(0, int(math.log2(max(min(s.leaves, len(sample) / 8), 1))))
    forest = Forest(np.zeros((s.trees, 2 ** depth - 1, sample.shape[1] + 1)),
                    np.zeros((s.trees, 2 ** depth - 1)), depth, top)
    y, rng = forest.lifted(sample), np.random.default_rng(s.seed)
    for t in range(s.trees):
        members = {0: np.arange(len(y))}
        for node in range(2 ** depth - 1):
            own = members.pop(node)
            a, b = rng.choice(own, 2, replace=False)
            normal = y[a] - y[b]
            size = np.linalg.norm(normal)
            normal = normal / size if size > 0 else rng.standard_normal(len(normal))
            at = y[own] @ normal
            offset = np.median(at)
            forest.normals[t, node], forest.offsets[t, node] = normal, offset
            right = at > offset
            # points that project alike: halve them anyway, so that the tree goes on
            if right.all() or not right.any():
                right = np.arange(len(own)) % 2 == 1
            members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]
    return forest


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


#: Queries that a task looks at together.
SLICE = 64


def leaf_function(spark, forest: Forest):
    """An Arrow function from vectors to their leaves, a byte per tree."""
    shared = spark.sparkContext.broadcast(forest.parts())  # bounded by trees x leaves

    @F.arrow_udf("binary")
    def leaves(vector: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for x in Forest(*shared.value).leaves(matrix(vector))],
                        pa.binary())

    return leaves


def line_function(spark, forest: Forest, judged: np.ndarray, rank: int, visited: float):
    """An Arrow function from queries to the least sum with which a row is scored: that of
    the ``rank``-th best of the ``judged`` rows' leaves; 0 takes all rows."""
    shared = spark.sparkContext.broadcast((forest.parts(), judged))  # bounded by the sample

    @F.arrow_udf("float")
    def line(vector: pa.Array) -> pa.Array:
        parts, rows = shared.value
        q, out = matrix(vector), []
        for start in range(0, len(q), SLICE):
            sums = sums_of_worth(Forest(*parts).worth(q[start:start + SLICE], visited), rows)
            least = np.partition(sums, sums.shape[1] - rank, axis=1)[:, sums.shape[1] - rank]
            out.append(least * np.float32(1 - 1e-4))  # sums differ by rounding elsewhere
        return pa.array(np.concatenate(out) if out else np.empty(0, np.float32), pa.float32())

    return line


# ------------------------------------------------------------------ search

def scored(spark, forest: Forest, s: Settings, k: int):
    """Of the rows and the queries of one block: each query's best ``k`` candidates."""
    shared = spark.sparkContext.broadcast(forest.parts())

    def best(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if len(rows) and len(queries):
            own, asked = rows.combine_chunks(), queries.combine_chunks()
            x, reps = matrix(own["vector"].chunk(0)), own["rep"].to_numpy()
            leaves = np.frombuffer(b"".join(own["leaves"].to_pylist()), np.uint8)
            leaves = leaves.reshape(len(x), -1)
            q, names = matrix(asked["vector"].chunk(0)), asked["rep"].to_numpy()
            lines = asked["line"].to_numpy()
            for start in range(0, len(q), SLICE):
                part = q[start:start + SLICE]
                sums = sums_of_worth(Forest(*shared.value).worth(part, s.visited), leaves)
                for i in range(len(part)):
                    near = np.flatnonzero(sums[i] >= lines[start + i])
                    # the same sum whatever the place of a row in its block
                    exact = (x[near] * part[i]).sum(axis=1)
                    top = np.lexsort((reps[near], -exact))[:k]
                    found.append((np.full(len(top), names[start + i]), reps[near[top]],
                                  exact[top]))
        columns = [np.concatenate(c) for c in zip(*found)] or [np.array([])] * 3
        return pa.table({"query": pa.array(columns[0], pa.int64()),
                         "rep": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    return best


def nearest(vectors: DataFrame, is_query, k: int = 20, s: Settings = PRODUCTION,
            vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row for which ``is_query(vec_id)`` holds,
    its ``k`` nearest found among all other rows."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    classes = written(classes_of(rows, k + 1), "ann-classes")
    asking = rows.where(is_query(F.col("vec_id")))
    queries = written(asking.join(classes.select("vector", "rep"), "vector").select(
        F.col("vec_id").alias("query_id"), "rep"), "ann-queries")

    norm = F.sqrt(F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0),
                              lambda a, x: a + x * x))
    top, n = classes.agg(F.max(norm), F.count(F.lit(1))).first()
    sample = classes.orderBy(F.xxhash64(F.lit(s.seed), "rep"), "rep").limit(s.sample).select(
        "vector").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = np.array([r[0] for r in sample], dtype=np.float64)
    forest = grow(drawn, float(top), s)
    judged = forest.leaves(drawn[:s.judged])
    # as many of the sample as the candidates are of all rows, and enough for a list
    rank = max(k + 1, math.ceil(s.candidates * math.sqrt(n) * len(judged) / n))
    line = F.lit(0.0).cast("float") if rank >= len(judged) else line_function(
        spark, forest, judged, rank, s.visited)("vector")

    distinct = queries.select("rep").distinct().join(classes.select("rep", "vector"), "rep")
    asked = written(distinct.select("rep", "vector", line.alias("line")), "ann-asked")
    row_blocks = max(1, -(-n // s.rows))
    query_blocks = max(1, -(-asked.count() // s.queries))

    def block(count: int):
        return F.pmod(F.xxhash64("rep"), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    placed = classes.select("rep", "vector", leaf_function(spark, forest)("vector").alias(
        "leaves")).withColumn("rb", block(row_blocks)).withColumn("qb", every(query_blocks))
    dealt = asked.withColumn("qb", block(query_blocks)).withColumn("rb", every(row_blocks))
    met = placed.groupBy("rb", "qb").cogroup(dealt.groupBy("rb", "qb")).applyInArrow(
        scored(spark, forest, s, k + 1), "query long, rep long, score double")

    by_class = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = met.withColumn("_rank", F.row_number().over(by_class)).where(
        F.col("_rank") <= k + 1).drop("_rank")
    # the members of the classes found: one list per class that asks
    members = classes.select("rep", "members")
    listed = found.join(members, "rep").select(
        "query", "score", F.explode("members").alias("vec_id"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = written(listed.withColumn("_rank", F.row_number().over(best)).where(
        F.col("_rank") <= k + 1).groupBy("query").agg(F.sort_array(F.collect_list(
            F.struct("_rank", "vec_id", "score"))).alias("found")), "ann-lists")
    # a table beside a table: where many queries are one class, the join can be split
    own = queries.join(lists, queries["rep"] == lists["query"]).select(
        "query_id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")),
                            1, k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "f.vec_id", "f.score")


def op10_ann_forest(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)

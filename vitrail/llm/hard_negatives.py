"""Hard-negative mining by segment summary filtering.

Vectors become integers, so scores are exact.  An index row holds a vector beside the sum
and the sum of squares of each of its ``segments`` parts, which give the part's mean and
deviation; those of two neighbouring parts add up to those of their union, so one row
holds every level of halving.  For two vectors, each part's share of the inner product is
``length * mean * mean`` plus or minus ``deviation * deviation`` (root sums of squares about
the mean), by Cauchy and Schwarz.  Added up, that bounds the score from both sides; the
bounds get tighter from level to level, and pairs they exclude leave.  Only what is left
after the finest level is scored, in integers.

Pass 1 finds the positives of every anchor: rows of its label, pruned by the k-th largest
lower bound.  Pass 2 finds, for every anchor and positive, the best rows of other labels
whose score lies in the positive's band, pruned by the band and by the k-th largest lower
bound among those that lie in it for sure.  Rows and anchors are dealt into blocks, every
block of anchors meets every block of rows once (a stated query set against all rows), and
a block returns its best per anchor or positive, so what is ranked at the end is small.
Without structure in the vectors the coarse levels exclude little; results are exact anyway.

Defined cases: rows with a null id, label or vector, or a null or non-finite component,
take no part, neither do rows whose own score reaches ``2 ** 62`` (others' scores then fit
a long); rows that repeat an id count once, with the smallest (label, vector); vectors of
different lengths have no score with each other, empty ones score 0; equal scores go to
the smaller id; an anchor without positives, and a positive without negatives in its band,
give no rows; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrail.llm.common import table, written


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30        # percent of the positive's score that a negative's reaches at least
    high: int = 90       # and at most
    segments: int = 32   # of the finest level; a power of two
    rows: int = 4096     # of a block
    anchors: int = 512   # of a block


PRODUCTION = Mining()
INDEX = "vec_id long, label long, d int, vector array<long>, sums array<long>, squares array<long>"


# ------------------------------------------------------------------ index

def edges(d: int, parts: int) -> np.ndarray:
    """Where ``parts`` segments of ``d`` components begin; halving them again keeps these."""
    return d * np.arange(parts + 1) // parts


def quantised(vectors: DataFrame, m: Mining, vec_id: str, label: str, vector: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part; the vector as longs."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(label).cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform("x", lambda x: F.floor(x * F.lit(float(m.scale))))
    own = F.aggregate("x", F.lit(0.0), lambda a, x: a + F.pow(
        F.abs(x) * F.lit(float(m.scale)) + 1.0, F.lit(2.0)))
    rows = rows.where("vec_id is not null and label is not null and x is not null").where(
        finite & (own < F.lit(float(1 << 62))))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", scaled.alias("vector"))).alias(
        "r")).select("vec_id", "r.label", "r.vector")


def indexed(rows: DataFrame, m: Mining) -> DataFrame:
    """``INDEX`` rows: each vector with the sums of its finest segments."""

    def summarise(batches):
        for b in batches:
            flat, sizes = lists(b.column(2))
            starts = np.cumsum(sizes) - sizes
            sums = np.zeros((len(sizes), m.segments), dtype=np.int64)
            squares = sums.copy()
            for d in np.unique(sizes[sizes > 0]):
                own = np.flatnonzero(sizes == d)
                x = flat[starts[own][:, None] + np.arange(d)]
                sums[own], squares[own] = segment_sums(x, m.segments), segment_sums(x * x, m.segments)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes.astype(np.int32)), b.column(2),
                 pa.array(list(sums), kind), pa.array(list(squares), kind)],
                ["vec_id", "label", "d", "vector", "sums", "squares"])

    return rows.mapInArrow(summarise, INDEX)


def lists(column) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column without nulls, and the length of each list."""
    return (column.flatten().to_numpy(zero_copy_only=False),
            np.asarray(pa.compute.list_value_length(column)).astype(np.int64))


def segment_sums(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts): sums over each segment; a segment may be empty."""
    total = np.concatenate([np.zeros((len(x), 1), dtype=x.dtype), np.cumsum(x, axis=1)], axis=1)
    at = edges(x.shape[1], parts)
    return total[:, at[1:]] - total[:, at[:-1]]


# ------------------------------------------------------------------ bounds

class Side:
    """One block's vectors of one dimension, with their summaries of every level."""

    def __init__(self, ids, labels, x, sums, squares):
        self.ids, self.labels, self.x, self.d = ids, labels, x, x.shape[1]
        self.levels = []
        parts = sums.shape[1]
        while parts:
            if parts <= self.d or parts == 1:
                size = np.diff(edges(self.d, parts)).astype(float)
                root = np.sqrt(np.maximum(size, 1.0))
                mean = sums / root  # length * mean * mean is the product of two of these
                spread = np.sqrt(np.maximum(squares - mean * mean, 0.0))
                self.levels.append((mean, spread))
            if parts == 1:
                break
            # neighbours' sums are the sums of the segment that holds both
            sums = sums[:, ::2] + sums[:, 1::2]
            squares = squares[:, ::2] + squares[:, 1::2]
            parts //= 2
        self.levels.reverse()
        self.norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        self.reals = x.astype(float)


def sides(t: pa.Table) -> dict[int, Side]:
    """The rows of a block by dimension, in id order."""
    if not len(t):
        return {}
    t = t.combine_chunks().sort_by("vec_id")
    ids, labels = t["vec_id"].to_numpy(), t["label"].to_numpy()
    flat, sizes = lists(t["vector"].combine_chunks())
    starts = np.cumsum(sizes) - sizes
    sums, squares = (lists(t[c].combine_chunks())[0].reshape(len(ids), -1)
                     for c in ("sums", "squares"))
    out = {}
    for d in np.unique(sizes):
        own = np.flatnonzero(sizes == d)
        x = flat[starts[own][:, None] + np.arange(d)].reshape(len(own), d)
        out[int(d)] = Side(ids[own], labels[own], x, sums[own], squares[own])
    return out


def bounds(a: Side, at: slice, b: Side, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of the scores of some of ``a`` and all of ``b``; widened by more than
    rounding can have moved them (a deviation is off by some 1e-8 of the norm at most)."""
    (am, asd), (bm, bsd) = a.levels[level], b.levels[level]
    middle, width = am[at] @ bm.T, asd[at] @ bsd.T
    width += 1e-7 * (a.norm[at][:, None] * b.norm[None, :] + 1.0)
    return middle - width, middle + width


def exact(a: Side, i: int, b: Side, rows: np.ndarray) -> np.ndarray:
    """Scores of anchor ``i`` and some rows: doubles while they hold the integers, else
    longs, whose sums are right as the result fits one."""
    if a.norm[i] * b.norm[rows].max(initial=0.0) < 2.0 ** 52:
        return (b.reals[rows] @ a.reals[i]).astype(np.int64)
    return b.x[rows] @ a.x[i]


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """Of each row the k-th largest value, -inf where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: larger scores first, smaller ids among equals."""
    return np.lexsort((ids, -scores))[:k]


SLICE = 64


def block_positives(m: Mining):
    """(anchor_id, vec_id, score): in one block, each anchor's best rows of its label."""

    def find(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        b_all = sides(rows)
        for d, a in sides(anchors).items():
            for label in np.intersect1d(a.labels, b_all[d].labels) if d in b_all else []:
                b, q = part_of(b_all[d], b_all[d].labels == label), part_of(a, a.labels == label)
                for start in range(0, len(q.ids), SLICE):
                    at = slice(start, min(start + SLICE, len(q.ids)))
                    alive = q.ids[at][:, None] != b.ids[None, :]
                    for level in range(len(b.levels)):
                        low, high = bounds(q, at, b, level)
                        least = kth_largest(np.where(alive, low, -np.inf), m.positives)
                        alive &= high >= least[:, None]
                    for i in range(alive.shape[0]):
                        left = np.flatnonzero(alive[i])
                        score = exact(q, start + i, b, left)
                        top = best(b.ids[left], score, m.positives)
                        found.append((np.full(len(top), q.ids[start + i]), b.ids[left[top]],
                                      score[top]))
        return longs(found, ["anchor_id", "vec_id", "score"])

    return find


def block_negatives(m: Mining):
    """(anchor_id, positive_id, positive_score, vec_id, score): in one block, the best rows
    of each band."""

    def find(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        b_all = sides(rows)
        bands = dict(zip(anchors["vec_id"].to_pylist(), anchors["positives"].to_pylist()))
        for d, a in sides(anchors).items():
            if d not in b_all:
                continue
            b = b_all[d]
            for start in range(0, len(a.ids), SLICE):
                at = slice(start, min(start + SLICE, len(a.ids)))
                own = [bands[i] for i in a.ids[at].tolist()]
                # a row per anchor and a column per positive; a missing one is an empty band
                ps = np.full((len(own), m.positives), np.nan)
                for i, p in enumerate(own):
                    ps[i, :len(p)] = [x["score"] for x in p]
                slack = 1e-9 * (np.abs(ps) + 1.0)
                lo, hi = ps * m.low / 100 - slack, ps * m.high / 100 + slack
                free = a.labels[at][:, None] != b.labels[None, :]
                alive = free.copy()
                for level in range(len(b.levels)):
                    low, high = bounds(a, at, b, level)
                    some = np.zeros_like(alive)
                    for j in range(m.positives):
                        floor, top = lo[:, j:j + 1], hi[:, j:j + 1]
                        # slack narrows a sure band as much as it widens a possible one
                        sure = alive & (low >= floor + 2 * slack[:, j:j + 1]) & (
                            high <= top - 2 * slack[:, j:j + 1])
                        if sure.any():
                            least = kth_largest(np.where(sure, low, -np.inf), m.negatives)
                            floor = np.maximum(floor, least[:, None])
                        some |= (high >= floor) & (low <= top)  # never where ps is missing
                    alive &= some
                for i in range(alive.shape[0]):
                    left = np.flatnonzero(alive[i])
                    score = exact(a, start + i, b, left)
                    for p in own[i]:
                        found.append(in_band(m, a.ids[start + i], p, b.ids[left], score))
        return longs(found, ["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    return find


def in_band(m: Mining, anchor: int, positive: dict, ids: np.ndarray, score: np.ndarray) -> tuple:
    # least and greatest integers of the band, so that nothing is multiplied by 100 in longs
    least = -(-m.low * positive["score"] // 100)
    most = m.high * positive["score"] // 100
    inside = np.flatnonzero((score >= least) & (score <= most))
    top = inside[best(ids[inside], score[inside], m.negatives)]
    n = len(top)
    return (np.full(n, anchor), np.full(n, positive["vec_id"]), np.full(n, positive["score"]),
            ids[top], score[top])


def part_of(s: Side, mask: np.ndarray) -> Side:
    out = object.__new__(Side)
    out.ids, out.labels, out.x, out.d = s.ids[mask], s.labels[mask], s.x[mask], s.d
    out.levels = [(mean[mask], spread[mask]) for mean, spread in s.levels]
    out.norm, out.reals = s.norm[mask], s.reals[mask]
    return out


def longs(found: list[tuple], names: list[str]) -> pa.Table:
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)] or [
        np.array([], dtype=np.int64)] * len(names)
    return pa.table(columns, names)


# ------------------------------------------------------------------ mining

def mine(vectors: DataFrame, is_anchor, m: Mining = PRODUCTION, vec_id: str = "vec_id",
         label: str = "label", vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the
    rows for which ``is_anchor(vec_id)`` holds."""
    index = written(indexed(quantised(vectors, m, vec_id, label, vector), m), "mining-index")
    anchors = index.where(is_anchor(F.col("vec_id")))
    row_blocks = max(1, -(-index.count() // m.rows))
    anchor_blocks = max(1, -(-anchors.count() // m.anchors))

    def block(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # every row in its block, once for each block of the other side
    rows = index.withColumn("rb", block(row_blocks)).withColumn("ab", every(anchor_blocks))

    def met(asking: DataFrame, function, schema: str) -> DataFrame:
        dealt = asking.withColumn("ab", block(anchor_blocks)).withColumn("rb", every(row_blocks))
        return rows.groupBy("rb", "ab").cogroup(dealt.groupBy("rb", "ab")).applyInArrow(
            function, schema)

    def ranked(df: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    positives = ranked(met(anchors, block_positives(m), "anchor_id long, vec_id long, score long"),
                       ["anchor_id"], m.positives)
    bands = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("vec_id", "score")).alias("positives"))  # a few per anchor
    asking = written(anchors.join(bands, "vec_id"), "mining-anchors")
    found = met(asking, block_negatives(m), "anchor_id long, positive_id long, "
                "positive_score long, vec_id long, score long")
    return ranked(found, ["anchor_id", "positive_id"], m.negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         list_inner_product(a.x, r.x)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scores
  WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                          ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                           ORDER BY s.score DESC, s.vec_id) <= 10
"""


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(
        F.col("label").cast("long")))
    return mine(vectors, lambda vec_id: vec_id % 100 == 0)

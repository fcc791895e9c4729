"""N-gram Jaccard join: documents whose word n-gram sets are at least so similar.

1. Sketch: all n-grams of all documents are counted in ``2 ** SKETCH_BITS`` hash buckets.
   The order by (bucket count, hash) is the one global order of n-grams, rare ones first.
2. Classes: documents with equal sets (by 128-bit signature) are one class; its smallest id
   stands for it.
3. Prefixes: the first n-grams of a set in that order, so many that two sets which are
   similar enough must share one.  Classes meet by prefix n-gram.
4. Stars: in every n-gram's group each class is held against the group's pivot, the class
   with the fewest rarer n-grams, which in a group of edited copies is nearest to the
   original.  Links found so make components.
5. The rest: in every n-gram's group that still holds classes of different components,
   these are held against each other where they lie, all of them, so no link between
   components is lost; only pairs that pass all filters leave the group.  Pairs inside a
   component cannot change it and are not looked at.

A pair must pass the length filter and the positional filter at a shared n-gram, and then
the suffix filter: histograms of both sets by hash bin bound the size of their difference
from below.  What passes is verified once, on the words themselves.

Groups are split by a salt where the sketch says that an n-gram is very frequent, and in
step 5 into tiles of ``TILE_ROWS`` classes a side; minima are map-side combined, and joins
on n-grams can be split by adaptive execution.  The sketch (4 MB) and a filter of the ids
to verify (``FILTER_BITS``) have fixed sizes: where a corpus fills them, the order of
n-grams gets coarser and the filter lets more through, and the results stay the same.  The
tasks' sketches are added up in two steps, so that none meets more of them than the square
root of their number.

Defined cases: null and empty texts have empty sets and link with nothing; a text with
fewer words than an n-gram is one n-gram; a very long text is hashed whole, at some 60 bytes
of memory for each of its bytes; rows that share a ``doc_id`` are one document with several texts
for components, while :func:`one_of_each` tells them apart; rows with a null id are
documents by their text, and those in no other document's component have a null component;
ids must be below ``2 ** 62``; other columns pass through, and the added ones replace
columns of the same name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrail.llm.common import bounded_batches, carried, table, text_of, written
from vitrail.llm.components import components

SKETCH_BITS, SKETCH_BLOCK = 20, 4096
FILTER_BITS = 24
BINS = 64
#: Rows of one n-gram, beyond its bucket's usual noise, from which its group is salted.
SALT_ROWS = 5000
#: Classes on each side of a tile of a group.
TILE_ROWS = 2000
#: Where rows without an id get ids from their text; no component is named after those
#: unless it has no others, as they are larger.
NO_DOC = 1 << 62


@dataclass(frozen=True)
class Similarity:
    """``percent``: 100 * intersection >= percent * union."""

    words: int = 3
    percent: int = 90

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


# ------------------------------------------------------------------ n-gram sets

class Hasher:
    """64-bit hashes of the word n-grams of texts, A-Z lower-cased: sums over the bytes of a
    word, all words of a text at once."""

    def __init__(self, words: int):
        rng = np.random.default_rng(20240229)
        self.words = words
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.byte[65:91] = self.byte[97:123]
        self.gap = np.zeros(256, dtype=bool)
        self.gap[[32, *range(9, 14)]] = True
        base = 0x9E3779B97F4A7C15
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.mixers = rng.integers(1, 1 << 63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def mixed(self, h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * self.mixers[0]
        h = (h ^ (h >> np.uint64(29))) * self.mixers[1]
        return h ^ (h >> np.uint64(32))

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.full(size, self.base, dtype=np.uint64))
            self.down = np.cumprod(np.full(size, self.inverse, dtype=np.uint64))

    def ngrams(self, text: str | None) -> np.ndarray:
        """The distinct n-gram hashes, sorted."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        inside = np.concatenate([[False], ~self.gap[raw], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.empty(0, dtype=np.uint64)
        self.powers(len(raw) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.byte[raw] * self.up[:len(raw)])])
        word = self.mixed((sums[ends] - sums[starts]) * self.down[starts]
                          + (ends - starts).astype(np.uint64))
        n = min(self.words, len(word))
        gram = np.full(len(word) - n + 1, np.uint64(n))
        for i in range(n):
            gram = self.mixed(gram * self.base + word[i:len(word) - n + 1 + i])
        return np.unique(gram)


def buckets(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(texts: DataFrame, words: int) -> np.ndarray:
    """Documents per bucket of n-grams, over all texts; a fixed number of counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, size = Hasher(words), 1 << SKETCH_BITS
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0):
                np.add.at(counts, buckets(hasher.ngrams(t.as_py())), 1)
        yield from blocks_of(counts, SKETCH_BLOCK)

    parts = texts.mapInArrow(count, "block int, part int, counts array<int>")
    groups = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    add = added_counts(SKETCH_BLOCK)
    total = parts.withColumn("part", F.pmod("part", F.lit(groups)))
    for keys in (["block", "part"], ["block"]):
        total = total.groupBy(*keys).applyInArrow(add, "block int, part int, counts array<int>")
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int32).reshape(-1, SKETCH_BLOCK)
    for r in total.collect():  # 4 MB, whatever the corpus
        out[r["block"]] = r["counts"]
    return out.ravel()


def blocks_of(counts: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """The blocks of a task's counts that are not empty, under the task's number."""
    from pyspark import TaskContext

    context = TaskContext.get()
    blocks = np.minimum(counts, 2 ** 31 - 1).astype(np.int32).reshape(-1, size)
    used = np.flatnonzero(blocks.any(axis=1)).astype(np.int32)
    part = np.full(len(used), context.partitionId() if context else 0, dtype=np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(part), pa.array(list(blocks[used]), pa.list_(pa.int32()))],
        ["block", "part", "counts"])


def added_counts(size: int):
    """Of the rows of one block: one row of their sums."""

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(size, dtype=np.int64)
        for chunk in rows["counts"].chunks:
            flat = chunk.flatten().to_numpy(zero_copy_only=False)
            total += flat.reshape(-1, size).sum(axis=0, dtype=np.int64)
        return pa.table({
            "block": rows["block"].slice(0, 1), "part": rows["part"].slice(0, 1),
            "counts": pa.array([np.minimum(total, 2 ** 31 - 1).astype(np.int32)],
                               pa.list_(pa.int32()))})

    return add


SETS = ("id long, digest long, n int, s1 long, s2 long, bins binary, "
        "prefix array<struct<h:long,salts:int>>")


def gram_sets(rows: DataFrame, counts: np.ndarray, s: Similarity) -> DataFrame:
    """(id, digest, text) to ``SETS``: size, signature, histogram and prefix of every set."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)  # 4 MB

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(s.words), shared.value
        noise = 2 * float(held.mean())
        kind = pa.list_(pa.struct([("h", pa.int64()), ("salts", pa.int32())]))
        for batch in batches:
            out = []
            for id_, digest, text in zip(batch.column(0).to_pylist(),
                                         batch.column(1).to_pylist(), batch.column(2)):
                grams = hasher.ngrams(text.as_py())
                n = len(grams)
                if not n:
                    out.append((id_, digest, 0, 0, 0, b"", None))
                    continue
                often = held[buckets(grams)]
                take = s.prefix(n)
                # the first of the order (count, hash): candidates up to the last count,
                # stable as the hashes are sorted
                last = np.partition(often, take - 1)[take - 1]
                near = np.flatnonzero(often <= last)
                near = near[np.argsort(often[near], kind="stable")][:take]
                salts = np.maximum(1, np.ceil((often[near] - noise) / SALT_ROWS)).astype(np.int32)
                bins = np.bincount((grams & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
                out.append((id_, digest, n, int(hasher.mixed(grams).sum().astype(np.int64)),
                            int(np.bitwise_xor.reduce(hasher.mixed(~grams)).astype(np.int64)),
                            np.minimum(bins, 65535).astype("<u2").tobytes(),
                            pa.StructArray.from_arrays(
                                [pa.array(grams[near].astype(np.int64)), pa.array(salts)],
                                ["h", "salts"])))
            ids, digests, ns, s1, s2, bins, prefix = list(zip(*out)) or [()] * 7
            flat = [p for p in prefix if p is not None]
            sizes = np.cumsum([0] + [0 if p is None else len(p) for p in prefix])
            values = pa.concat_arrays(flat) if flat else pa.array([], kind.value_type)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(ns, pa.int32()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(bins, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)],
                [c.split()[0] for c in SETS.split(", ")])

    return rows.select("id", "digest", "text").mapInArrow(describe, SETS)


# ------------------------------------------------------------------ filters

def may_pair(a: str, b: str, s: Similarity) -> Column:
    """The length and the positional filter for rows (n, at) named with prefixes a and b."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    left = F.least(na - F.col(f"{a}at"), nb - F.col(f"{b}at"))
    return (100 * F.least(na, nb) >= s.percent * F.greatest(na, nb)) & (
        (100 + s.percent) * left >= s.percent * (na + nb))


def suffix_function(percent: int):
    """An Arrow function: whether two histograms leave the pair possible."""

    @F.arrow_udf("boolean")
    def possible(a: pa.Array, b: pa.Array) -> pa.Array:
        x = np.frombuffer(b"".join(a.to_pylist()), "<u2").reshape(-1, BINS).astype(np.int64)
        y = np.frombuffer(b"".join(b.to_pylist()), "<u2").reshape(-1, BINS).astype(np.int64)
        total = x.sum(axis=1) + y.sum(axis=1)
        # a full bin only lowers the bound on the difference; then let the pair pass
        full = (x == 65535).any(axis=1) | (y == 65535).any(axis=1)
        least = np.abs(x - y).sum(axis=1)
        return pa.array(full | ((100 + percent) * least <= (100 - percent) * total))

    return possible


def words_of_text(text: str) -> list[str]:
    low = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def gram_set(text: str, n: int) -> set[tuple[str, ...]]:
    words = words_of_text(text)
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(min(n, len(words))))))


def verify_function(s: Similarity):
    """An Arrow function: whether two texts are similar enough, by their words."""
    n, percent = s.words, s.percent

    @F.arrow_udf("boolean")
    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, known = None, set()
        for a, b in batches:
            out = []
            for x, y in zip(a, b):
                y = y.as_py()
                if y != last:  # pairs arrive sorted by their second document
                    last, known = y, gram_set(y, n)
                own = gram_set(x.as_py(), n)
                both = len(own & known)
                out.append(both > 0 and 100 * both >= percent * (len(own) + len(known) - both))
            yield pa.array(out, pa.bool_())

    return similar


# ------------------------------------------------------------------ the join

class Verifier:
    """Decides pairs (a, b) of ids, a < b, by the suffix filter and then by the words."""

    def __init__(self, texts: DataFrame, heads: DataFrame, s: Similarity):
        self.texts, self.heads, self.s = texts, heads, s

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs that pass the suffix filter, with their other columns."""
        heads = self.heads
        near = pairs.join(heads.select(F.col("id").alias("a"), F.col("bins").alias("x")), "a") \
            .join(heads.select(F.col("id").alias("b"), F.col("bins").alias("y")), "b")
        return near.where(suffix_function(self.s.percent)("x", "y")).select(*pairs.columns)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The links among pairs that have passed the suffix filter."""
        near = written(pairs.select("a", "b").distinct(), "jaccard-pairs")
        texts = self.texts.where(in_filter(id_filter(near))("id"))
        at_a = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
        at_b = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
        both = near.join(at_a, "a").join(at_b, "b")
        return written(both.where(verify_function(self.s)("x", "y")).select("a", "b").distinct(),
                       "jaccard-links")


def id_filter(pairs: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds the ids of the pairs, and perhaps others."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    parts = ids.groupBy(F.call_function("bitmap_bucket_number", spot).alias("k")).agg(
        F.call_function("bitmap_construct_agg", F.call_function(
            "bitmap_bit_position", spot)).alias("bits"))
    out = np.zeros(((1 << FILTER_BITS) // 32768 + 2, 4096), dtype=np.uint8)
    for r in parts.collect():  # 2 MB, whatever the corpus
        out[r["k"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def in_filter(bits: np.ndarray):
    """Whether an id may be in the filter; ``bits`` has a fixed size of some MB."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def looked_up(k: pa.Array, at: pa.Array) -> pa.Array:
        at = at.to_numpy(zero_copy_only=False)
        byte = shared.value[k.to_numpy(zero_copy_only=False), at // 8]
        return pa.array((byte >> (at % 8).astype(np.uint8)) & 1 == 1)

    def test(id_: str) -> Column:
        spot = F.pmod(F.xxhash64(id_), F.lit(1 << FILTER_BITS))
        return looked_up(F.call_function("bitmap_bucket_number", spot),
                         F.call_function("bitmap_bit_position", spot))

    return test


def meeting_rows(sets: DataFrame) -> DataFrame:
    """(h, id, n, at, pivot, pn, pat) for prefix n-grams that several classes share, with
    the pivot of the row's group.  One shuffle: the windows run over sorted rows."""
    one = Window.partitionBy("s1", "s2", "n").orderBy("id")
    classes = sets.where("n > 0").withColumn("_r", F.row_number().over(one)).where("_r = 1")
    rows = classes.select("id", "n", F.posexplode("prefix").alias("at", "p")).select(
        F.col("p.h").alias("h"), F.pmod(F.xxhash64("id"), F.col("p.salts")).cast("int")
        .alias("salt"), "id", "n", "at", (F.col("p.salts") > 1).alias("split"))
    group = Window.partitionBy("h", "salt").orderBy("at", "n", "id")
    rows = rows.withColumn("pivot", F.first(F.struct("id", "n", "at")).over(
        group.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("more", F.lead("id").over(group).isNotNull()
                           | F.lag("id").over(group).isNotNull() | F.col("split"))
    return rows.where("more").select(
        "h", "id", "n", "at", F.col("pivot.id").alias("pivot"), F.col("pivot.n").alias("pn"),
        F.col("pivot.at").alias("pat"))


def mixed_rows(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, id, n, at, c, members) of the groups that hold classes of different components.

    Of n-grams with the same members (by 128 bits of their ids) only the first one counts:
    the order of n-grams is the same for all, so it is the first that any two of the members
    share in that group of n-grams, which is where the positional filter is at its widest."""
    rows = met.select("h", "id", "n", "at").join(
        labels.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "h", "id", "n", "at", F.coalesce("component", "id").alias("c"))
    mixed = rows.groupBy("h").agg(
        F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("id")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit("members"), "id")).alias("x2"),
        F.sum(F.col("at").cast("long")).alias("place")).where("c0 <> c1")
    first = Window.partitionBy("x1", "x2", "members").orderBy("place", "h")
    mixed = mixed.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    return written(rows.join(mixed.select("h", "members"), "h"), "jaccard-mixed")


def star_pairs(rows: DataFrame, s: Similarity) -> DataFrame:
    """One class of each component in a group, held against the group's best."""
    best = F.min(F.struct("at", "n", "id", "c"))
    one = rows.groupBy("h", "c").agg(best.alias("x")).select("h", "x.*")
    top = rows.groupBy("h").agg(best.alias("y")).select(
        "h", *[F.col(f"y.{c}").alias(f"b_{c}") for c in ("at", "n", "id", "c")])
    met = one.select("h", *[F.col(c).alias(f"a_{c}") for c in ("at", "n", "id", "c")]).join(
        top, "h").where((F.col("a_c") != F.col("b_c")) & may_pair("a_", "b_", s))
    return met.select(*ordered("a_id", "b_id")).distinct()


def pairs_in_place(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b), a < b, of rows (h, i, j, block, id, n, at, c, bins) sorted by tile
    (h, i, j) that pass all filters.  A tile pairs the classes of blocks i and j of a group;
    it is held whole, twice ``TILE_ROWS`` rows or so."""

    def of_tiles(t: pa.Table) -> pa.RecordBatch:
        key = np.stack([t[k].to_numpy() for k in ("h", "i", "j")], axis=1)
        block, id_, n, at, c = (t[k].to_numpy() for k in ("block", "id", "n", "at", "c"))
        n, at = n.astype(np.int64), at.astype(np.int64)
        bins = np.frombuffer(b"".join(t["bins"].to_pylist()), "<u2").reshape(-1, BINS)
        full = (bins == 65535).any(axis=1)
        new = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]) if len(key) else []
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        left_in = np.repeat(start + size, size) - np.arange(len(key)) if len(key) else key
        across = key[:, 1] != key[:, 2] if len(key) else np.empty(0, bool)
        out, rows, away = [], np.arange(len(key)), 1
        while True:  # every row with the one so many places after it in its tile
            rows = rows[left_in[rows] > away]
            if not len(rows):
                break
            x, y = rows, rows + away
            may = (c[x] != c[y]) & ~(across[x] & (block[x] == block[y]))
            may &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
            rest = np.minimum(n[x] - at[x], n[y] - at[y])
            may &= (100 + percent) * rest >= percent * (n[x] + n[y])
            x, y = x[may], y[may]
            if len(x):
                apart = np.abs(bins[x].astype(np.int32) - bins[y]).sum(axis=1)
                near = full[x] | full[y] | (
                    (100 + percent) * apart <= (100 - percent) * (n[x] + n[y]))
                x, y = id_[x[near]], id_[y[near]]
                out.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
            away += 1
        found = np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])],
                                          ["a", "b"])

    kept = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = (pa.concat_tables([kept, t]) if kept is not None else t).combine_chunks()
        if not len(t):
            continue
        # the last tile may go on in the next batch
        same = np.ones(len(t), dtype=bool)
        for k in ("h", "i", "j"):
            column = t[k].to_numpy()
            same &= column == column[-1]
        last = len(t) - int(np.argmin(same[::-1])) if not same.all() else 0
        if last:
            yield of_tiles(t.slice(0, last))
        kept = t.slice(last)
    if kept is not None and len(kept):
        yield of_tiles(kept)


def rest_pairs(rows: DataFrame, heads: DataFrame, s: Similarity) -> DataFrame:
    """All pairs of classes of different components in a group that pass the filters."""
    percent = s.percent
    blocks = F.ceil(F.col("members") / TILE_ROWS).cast("int")
    own = rows.join(heads, "id").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = dealt.select("h", F.least("block", "other").alias("i"),
                         F.greatest("block", "other").alias("j"), "block", "id", "n", "at", "c",
                         "bins")
    sorted_ = tiles.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
    return sorted_.mapInArrow(lambda batches: pairs_in_place(batches, percent),
                              "a long, b long").distinct()


def ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def digest_of(text: str) -> Column:
    return F.xxhash64(text_of(text))


def id_of(doc_id: str, text: str) -> Column:
    by_text = digest_of(text).bitwiseAND(F.lit(NO_DOC - 1)) + F.lit(NO_DOC)
    return F.coalesce(F.col(doc_id).cast("long"), by_text)


def telling_ids(docs: DataFrame, doc_id: str, text: str, name: str) -> DataFrame:
    """``docs`` with an id under ``name`` that no two different texts share: its own, or,
    where rows of that id have different texts, one from id and text."""
    keyed = docs.withColumn(name, id_of(doc_id, text))
    texts = keyed.select(F.col(name).alias("_i"), digest_of(text).alias("_d")).groupBy("_i").agg(
        F.min("_d").alias("_d0"), F.max("_d").alias("_d1")).where("_d0 <> _d1").select("_i")
    if texts.isEmpty():
        return keyed
    own = F.xxhash64(name, text_of(text)).bitwiseAND(F.lit(NO_DOC - 1)) + F.lit(NO_DOC)
    return keyed.join(texts, F.col(name) == F.col("_i"), "left").withColumn(
        name, F.when(F.col("_i").isNotNull(), own).otherwise(F.col(name))).drop("_i")


def grouped(docs: DataFrame, s: Similarity, id_: str, text: str, n: str,
            component: str) -> DataFrame:
    """``docs``, which has ids in ``id_``, with the size of its set (long) in ``n`` and its
    component in ``component``."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_).alias("id"), digest_of(text).alias("digest"),
                        text_of(text).alias("text"))
    counts = sketch(texts.select("text"), s.words)
    sets = written(gram_sets(texts, counts, s), "jaccard-sets")

    # a table, so that the join on classes is between plain exchanges and can be split
    same = written(sets.where("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("k")).where("k > 1"), "jaccard-same")
    members = written(sets.where("n > 0").select("id", "s1", "s2", "n").join(
        same, ["s1", "s2", "n"]).where("id <> rep").select(
        F.col("rep").alias("a"), F.col("id").alias("b")), "jaccard-members")
    met = written(meeting_rows(sets), "jaccard-met")
    heads = sets.where("n > 0").select("id", "bins")
    judge = Verifier(texts.select("id", "text"), heads, s)

    # every class against the pivot with which it shares most; the rest leaves none out
    stars = met.where("id <> pivot").select(
        "id", "pivot", F.col("n").alias("a_n"), F.col("at").alias("a_at"),
        F.col("pn").alias("b_n"), F.col("pat").alias("b_at")).where(may_pair("a_", "b_", s))
    stars = judge.possible(stars.groupBy("id", "pivot").agg(
        F.count(F.lit(1)).alias("k")).select("id", "pivot", "k", *ordered("id", "pivot")))
    best = stars.groupBy("id").agg(F.max(F.struct("k", -F.col("pivot"), "a", "b")).alias("m"))
    links = judge.links(best.select("m.a", "m.b"))
    for rest in (False, True):
        labels = written(components(links.unionAll(members)), "jaccard-labels")
        rows = mixed_rows(met, labels)
        links = links.unionAll(judge.links(
            rest_pairs(rows, heads, s) if rest else judge.possible(star_pairs(rows, s))))
    labels = written(components(links.unionAll(members)), "jaccard-labels")

    # a row's size stands beside its id and text; rows that repeat both have one entry
    sizes = sets.select("id", "digest", "n").distinct().join(
        labels.select(F.col("node").alias("id"), "component"), "id", "left").select(
        F.col("id").alias("_id"), F.col("digest").alias("_digest"),
        F.col("n").cast("long").alias(n), F.coalesce("component", "id").alias(component))
    # the digest is a column before the join, so that a caller without the text drops it there
    own = unused(docs, ["set_digest"])[0]
    return docs.withColumn(own, digest_of(text)).join(sizes, (F.col(id_) == F.col("_id")) & (
        F.col(own) == F.col("_digest"))).drop("_id", "_digest", own)


def unused(docs: DataFrame, names: list[str]) -> list[str]:
    """The names, with underscores where ``docs`` has columns of that name."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def similar_groups(docs: DataFrame, s: Similarity = Similarity(), doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``docs`` plus ``n_shingles`` and ``component_id``, the smallest id reachable by
    links."""
    names = carried(docs, ["n_shingles", "component_id"])
    id_, n, component = unused(docs, ["set_id", "set_size", "set_component"])
    rows = grouped(docs.withColumn(id_, id_of(doc_id, text)), s, id_, text, n, component)
    return rows.select(*[F.col(f"`{c}`") for c in names], F.col(n).alias("n_shingles"),
                       F.when(F.col(component) < NO_DOC, F.col(component)).alias("component_id"))


def one_of_each(docs: DataFrame, s: Similarity = Similarity(), doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; a row goes only for
    a link or an equal text.  Rows that share an id and have different texts, like rows
    without an id, are documents by their text, which come after those with an id."""
    id_, n, component, rank = unused(docs, ["set_id", "set_size", "set_component", "set_rank"])
    rows = grouped(telling_ids(docs, doc_id, text, id_), s, id_, text, n, component).where(
        F.col(id_) == F.col(component))
    one = Window.partitionBy(id_).orderBy(F.xxhash64(*[
        F.col(f"`{c}`").cast("string") for c in docs.columns]))
    return rows.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similar_groups(docs).select("doc_id", "n_shingles", "component_id")

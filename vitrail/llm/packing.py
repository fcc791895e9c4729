"""Best-fit packing of tokenised documents into sequences, by linear grouping.

Lengths are whole numbers up to the capacity, so a plan needs only how many pieces there
are of each length, whatever the size of the corpus: at most capacity x ``BUCKETS`` counts
come to the driver.  The plan is made in four steps:

1. grouping: large lengths, sorted, fall into groups of equal cardinality and are rounded
   up to the longest of their group;
2. configurations: for these few sizes a linear program over the ways to fill a sequence
   is solved by column generation (the knapsack over the capacity gives the next column),
   and every configuration is used the whole number of times the program says;
3. substitution: the actual lengths take the places of the rounded ones;
4. best fit: what is left, longest first, goes where it leaves the least room.

A class of equal sequences is planned at once, so the work depends on the number of
different lengths only.  The pieces of a length are numbered (by hashed buckets, so that a
length that a third of all pieces share is numbered by many tasks), and a piece looks up
its sequence and offset by that number in the plan, a sorted array of bounded size.

Defined cases: a null text is empty and has only the end id; repeated rows are packed
each; an empty table gives no rows.  Other columns do not pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrail.llm.byte_bpe import parts_of, rank_encoder
from vitrail.llm.common import bounded_batches, table, text_of, written

BUCKETS = 256
#: Groups of large lengths, and the shares of the capacity from which a length is large:
#: a plan is made with each, and the shortest is taken.
GROUPS, LARGE = 32, (0.5, 0.34, 0.2)

PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long,ids:array<int>>>"


# ------------------------------------------------------------------ tokens and pieces

def cut_points(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, the first shorter."""
    first = total % capacity
    starts = ([0] if first else []) + list(range(first, total, capacity))
    return [(s, (first if first and s == 0 else capacity)) for s in starts]


def piece_function(ranks: str, pattern: str, special: dict[str, int], capacity: int,
                   end_id: int, keep_ids: bool):
    """An Arrow function from texts to their pieces.  The rank file holds the vocabulary of
    the tokenizer file, which reads strings of special tokens inside texts as those."""

    @F.arrow_udf(PIECES)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zlib

        own = rank_encoder(ranks, pattern, special)

        def ids_of(text: str) -> np.ndarray:
            if any(s in text for s in special):
                found = own.encode(text, allowed_special="all")
            else:
                found = [i for part in parts_of(text) for i in own.encode_ordinary(part)]
            return np.array([*found, end_id], dtype="<u4")

        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()),
                                   ("length", pa.int64()), ("ids_crc32", pa.int64()),
                                   ("ids", pa.list_(pa.int32()))]))
        for batch in batches:
            rows = []
            for text in batch:
                ids = ids_of(text.as_py() or "")
                rows.append([
                    (k, start, length, zlib.crc32(ids[start:start + length].tobytes()),
                     ids[start:start + length].astype("int32") if keep_ids else None)
                    for k, (start, length) in enumerate(cut_points(len(ids), capacity))])
            yield pa.array(rows, kind)

    return pieces


# ------------------------------------------------------------------ the plan

def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int):
    """Configurations (rows: how many of each size) and how often each is used in the
    linear program that covers ``demand`` with the fewest sequences."""
    k = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ demand
    for _ in range(40 * k + 200):
        prices = np.maximum(inverse.sum(axis=0), 0.0)
        column = best_filling(sizes, prices, capacity)
        if prices @ column <= 1 + 1e-7:
            break
        direction = inverse @ column
        steps = np.where(direction > 1e-9, used / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(np.argmin(steps))
        if not np.isfinite(steps[out]):
            break
        used = np.maximum(used - steps[out] * direction, 0.0)
        used[out] = steps[out]
        columns[:, out] = column
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
    return columns.T.astype(int), used


def best_filling(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """The dearest way to fill a sequence: an unbounded knapsack over the capacity."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    low = int(sizes.min())
    for room in range(low, capacity + 1):
        fits = sizes <= room
        gains = np.where(fits, prices + value[np.where(fits, room - sizes, 0)], -1.0)
        best = int(np.argmax(gains))
        value[room], choice[room] = gains[best], best
        if value[room - 1] >= value[room]:
            value[room], choice[room] = value[room - 1], -1
    column, room = np.zeros(len(sizes)), capacity
    while room >= low:
        if choice[room] < 0:
            room -= 1
        else:
            column[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return column


Classes = list[tuple[tuple[int, ...], int]]


def plan(counts: np.ndarray, capacity: int, groups: int = GROUPS,
         large: tuple[float, ...] = LARGE) -> Classes:
    """Classes (lengths in one sequence, number of such sequences) that hold
    ``counts[length]`` pieces of every length up to ``capacity``."""
    made = [_plan(counts, capacity, groups, share) for share in large]
    return min(made, key=lambda classes: sum(n for _, n in classes))


def _plan(counts: np.ndarray, capacity: int, groups: int, large: float) -> Classes:
    left = np.array(counts, dtype=np.int64)
    classes = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    lengths = np.flatnonzero(left)
    lengths = lengths[lengths >= max(1, int(large * capacity))]
    open_ = grouped(left, lengths, capacity, groups) if len(lengths) else []
    return classes + best_fit(open_, left, capacity)


def grouped(left: np.ndarray, lengths: np.ndarray, capacity: int, groups: int) -> Classes:
    """Steps 1 to 3; takes what it packs from ``left``."""
    # equal cardinality: a group ends with the length that completes its share
    ends = np.cumsum(left[lengths])
    group_of = np.minimum((ends - 1) * groups // ends[-1], groups - 1)
    members = [lengths[group_of == g] for g in np.unique(group_of)]
    sizes = np.array([m.max() for m in members])
    demand = np.array([left[m].sum() for m in members], dtype=float)
    ways, used = configurations(sizes, demand, capacity)
    # the lengths of each group, longest first, as (length, count) still to be placed
    queues = [[[int(x), int(left[x])] for x in m[::-1]] for m in members]
    out = []
    for way, times in sorted(zip(ways.tolist(), used), key=lambda x: -x[1]):
        todo = int(times + 1e-6)
        places = [g for g, n in enumerate(way) for _ in range(n)]
        while todo and places:
            heads, asked = [], {}
            for g in places:  # the next unplaced length of each place's group
                asked[g] = asked.get(g, 0) + 1
            if any(not queues[g] for g in asked):
                # a group ran out: the rest of its places stay free
                places = [g for g in places if queues[g]]
                continue
            run = todo
            for g, n in asked.items():
                run = min(run, queues[g][0][1] // n)
            if run == 0:  # fewer pieces of the head length than places: take them singly
                run = 1
                taken = []
                for g in places:
                    if not queues[g]:
                        continue
                    taken.append(queues[g][0][0])
                    queues[g][0][1] -= 1
                    if not queues[g][0][1]:
                        queues[g].pop(0)
                heads = taken
            else:
                heads = [queues[g][0][0] for g in places]
                for g, n in asked.items():
                    queues[g][0][1] -= run * n
                    if not queues[g][0][1]:
                        queues[g].pop(0)
            for x in heads:
                left[x] -= run
            out.append((tuple(heads), run))
            todo -= run
    return out


def best_fit(open_: Classes, left: np.ndarray, capacity: int) -> Classes:
    """Step 4 on classes of equal sequences: every piece goes where it leaves the least
    room, pieces in falling length; new sequences are opened where none has room."""
    by_room: list[list[list]] = [[] for _ in range(capacity + 1)]
    for lengths, n in open_:
        by_room[capacity - sum(lengths)].append([lengths, n])
    for x in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[x])
        room = x
        while todo:
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:
                each = capacity // x
                full, rest = divmod(todo, each)
                if full:
                    by_room[capacity - each * x].append([(x,) * each, full])
                if rest:
                    by_room[capacity - rest * x].append([(x,) * rest, 1])
                break
            last = by_room[room][-1]
            n = min(todo, last[1])
            if n == last[1]:
                by_room[room].pop()
            else:
                last[1] -= n
            by_room[room - x].append([last[0] + (x,), n])
            todo -= n
            room = x  # the class that was just filled may have room for another
    return [(tuple(lengths), n) for room in by_room for lengths, n in room]


def places(classes: Classes) -> dict[str, np.ndarray]:
    """The plan turned round: for every length, ranges of piece numbers with the sequence
    of the first one and the offset in it; sorted by (length, number)."""
    key, sequence, offset = [], [], []
    numbered: dict[int, int] = {}
    base = 0
    for lengths, n in classes:
        at = 0
        for x in lengths:
            first = numbered.get(x, 0)
            key.append((x << 48) | first)
            sequence.append(base)
            offset.append(at)
            numbered[x] = first + n
            at += x
        base += n
    order = np.argsort(np.array(key, dtype=np.int64), kind="stable")
    return {"key": np.array(key, dtype=np.int64)[order],
            "sequence": np.array(sequence, dtype=np.int64)[order],
            "offset": np.array(offset, dtype=np.int64)[order]}


def place_function(found: dict[str, np.ndarray], before: np.ndarray, spark):
    """An Arrow function (length, bucket, number in the bucket) -> (sequence_id, offset)."""
    shared = spark.sparkContext.broadcast((found, before))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, bucket: pa.Array, number: pa.Array) -> pa.Array:
        plan_, first = shared.value
        x = length.to_numpy(zero_copy_only=False).astype(np.int64)
        rank = first[x, bucket.to_numpy(zero_copy_only=False)] + number.to_numpy(
            zero_copy_only=False)
        key = (x << 48) | rank
        at = np.searchsorted(plan_["key"], key, side="right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(plan_["sequence"][at] + key - plan_["key"][at]),
             pa.array(plan_["offset"][at])], ["sequence_id", "offset"])

    return place


def pack(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """``pieces`` (a written table with ``length``) plus ``sequence_id`` and ``offset``;
    ``order`` are integer columns that tell pieces apart."""
    from pyspark.sql import Window

    spark = pieces.sparkSession
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int"))
    counted = rows.groupBy("length", "_bucket").count().collect()
    by_bucket = np.zeros((capacity + 1, BUCKETS), dtype=np.int64)
    for r in counted:
        by_bucket[r["length"], r["_bucket"]] = r["count"]
    found = places(plan(by_bucket.sum(axis=1), capacity))
    before = np.cumsum(by_bucket, axis=1) - by_bucket
    number = F.row_number().over(
        Window.partitionBy("length", "_bucket").orderBy(*order)) - 1
    place = place_function(found, before, spark)
    out = rows.withColumn("_number", number.cast("long")).withColumn(
        "_place", place("length", "_bucket", "_number"))
    return out.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, ranks: str, pattern: str, special: dict[str, int],
                   capacity: int = 2048, end_id: int = 0, keep_ids: bool = False,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and,
    with ``keep_ids``, the ids."""
    bounded_batches(docs.sparkSession)
    cut = piece_function(ranks, pattern, special, capacity, end_id, keep_ids)
    pieces = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                         F.explode(cut(text_of(text))).alias("p")).select("doc_id", "p.*")
    if not keep_ids:
        pieces = pieces.drop("ids")
    return pack(written(pieces, "pieces"), capacity,
                ["doc_id", "piece", "start", "length", "ids_crc32"])


def sequences(packed_: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces packed with ``keep_ids``; a sequence holds at most
    its capacity of ids."""
    rows = packed_.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))


#: Fixed value: the special token of the vocabulary file and its id.
SPECIAL = {"<|endoftext|>": 50256}


def pack_production(docs: DataFrame) -> DataFrame:
    """The packing of ``docs`` with the production vocabulary and capacity."""
    import public_tokenizers

    return pack_documents(docs.select("doc_id", "text"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN, SPECIAL)


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_production(table(spark, sf_dir, "documents"))

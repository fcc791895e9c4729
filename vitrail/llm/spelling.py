"""Spelling variant grouping by a trie-node pair dictionary.

1. Words: the runs of letters of whole texts, counted with map-side combining.
2. Numbers: the nodes of the trie of all words, and of the trie of the reversed words, get
   integers.  Words are dealt into sorted ranges; scanning one in order, a word shares its
   first nodes with the word before it and opens new ones for the rest.  A node that words
   of several ranges share is a prefix of the bound between them, so nodes on the bounds
   get their numbers from the (small) trie of the bounds, and ranges need no exchange.
3. Pairs: a word of length L yields the pairs (prefix node, suffix node) at each place, once
   whole (nothing between) and once with one position skipped.  Words that meet in a pair
   with that position skipped differ by a replacement; a word whole in a pair that another
   one has skipped differs from it by an insertion.  Nodes are exact, so nothing needs to be
   verified; of equal letters in a row only the first is skipped for insertions, so every
   neighbour is counted once.
4. A pair's words are ranked where they meet (one shuffle on two integers), and each word
   gets its number of neighbours and the best of them; no pairs of words are listed.  A pair
   holds at most one word whole and as many skipped as the alphabet has letters.
5. Roots: pointers to forms joined with themselves reach twice as far each round; along
   them counts grow by ``ratio`` at least, so a few rounds do.

The driver and the tasks hold the bounds of the ranges: at most ``ranges`` of them, of 32
code points.  Words travel as integers in the order of the words; texts and words as such
move once.

Defined cases: null and empty texts have no words; a null id is written as the empty
string before the colon; a very long run is one word and yields as many pairs as it is
long; equal counts are ordered by code points; repeated rows count as often as they are
there; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrail.llm.common import table, text_of, written

#: A-Z to a-z; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Grouping:
    letters: str = r"A-Za-zÀ-ÿ"
    min_chars: int = 6
    min_count: int = 5
    ratio: int = 5            # a form is at least so many times as frequent as the word
    range_words: int = 20_000
    ranges: int = 10_000      # at most; beyond, ranges hold more words
    bound_chars: int = 32


PRODUCTION = Grouping()
WHOLE, FIRST_SKIP, SKIP = 0, 1, 2


# ------------------------------------------------------------------ words

def runs(docs: DataFrame, g: Grouping, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): the runs of at least ``min_chars`` letters, A-Z lower-cased."""
    pattern = F.lit(f"([{g.letters}]{{{g.min_chars},}})")
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"),
                        F.explode(F.regexp_extract_all(text_of(text), pattern, F.lit(1))
                                  ).alias("run"))
    # lower() also changes letters beyond ASCII, so only what it leaves alone is spared
    return found.select("doc_id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(
        F.translate("run", UPPER, LOWER)).alias("run"))


def counted(words: DataFrame, g: Grouping, word: str = "word") -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return words.where(F.length(word) >= g.min_chars).groupBy(F.col(word).alias("word")).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= g.min_count)


# ------------------------------------------------------------------ numbers

def common(a: str, b: str) -> int:
    """How many first characters two strings share."""
    if a[:16] != b[:16] or min(len(a), len(b)) <= 16:
        n = 0
        for x, y in zip(a, b):
            if x != y:
                break
            n += 1
        return n
    low, high = 16, min(len(a), len(b))
    while low < high:  # long words: halve
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def bounds_of(words: DataFrame, n: int, g: Grouping) -> list[str]:
    """The sorted bounds of the ranges of ``w``, from a bounded sample drawn by hash."""
    parts = min(g.ranges, -(-n // g.range_words))
    if parts <= 1:
        return []
    every = max(1, n // (parts * 20))
    sample = sorted(r[0] for r in words.where(
        F.pmod(F.xxhash64("w"), F.lit(every)) == 0).select(
        F.substring("w", 1, g.bound_chars)).collect())
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)} if sample else [])


class Bounds:
    """The bounds with the numbers of their own nodes, which are negative; the root is 0."""

    def __init__(self, bounds: list[str]):
        self.bounds, self.paths, last, number = bounds, [], "", 0
        path = [0]
        for b in bounds:
            kept = common(last, b)
            path = path[:kept + 1] + [number - 1 - i for i in range(len(b) - kept)]
            number -= len(b) - kept
            self.paths.append(path)
            last = b

    def shared(self, part: int, word: str) -> list[int]:
        """The numbers of the nodes that ``word`` shares with a bound of its range."""
        best = [0]
        for i in (part - 1, part):
            if 0 <= i < len(self.bounds):
                n = common(word, self.bounds[i])
                if n + 1 > len(best):
                    best = self.paths[i][:n + 1]
        return best


def scan(bounds: Bounds, rows: Iterator[tuple[int, str]]) -> Iterator[tuple[int, list[int]]]:
    """For words sorted within ranges: (place in the order of all words, node numbers from
    the root to the word's own node)."""
    last_part, last, path, opened, place = None, "", [0], 0, 0
    for part, word in rows:
        if part != last_part:
            last_part, last, path, opened, place = part, "", [0], 0, 0
        kept = common(last, word)
        path = path[:kept + 1]
        path += bounds.shared(part, word)[kept + 1:]
        fresh = len(word) + 1 - len(path)
        path += range((part << 40) + opened + 1, (part << 40) + opened + 1 + fresh)
        opened += fresh
        yield (part << 40) + place, path
        last, place = word, place + 1


def ranged(words: DataFrame, g: Grouping, n: int) -> tuple[DataFrame, object]:
    """The rows dealt into sorted ranges of ``w``, and the broadcast bounds."""
    bounds = bounds_of(words, n, g)
    shared = words.sparkSession.sparkContext.broadcast(Bounds(bounds))  # of bounded size

    @F.arrow_udf("int")
    def part_of(w: pa.Array) -> pa.Array:
        return pa.array([bisect_right(shared.value.bounds, x) for x in w.to_pylist()], pa.int32())

    dealt = words.withColumn("part", part_of("w")).repartition(
        max(1, len(bounds) + 1), "part").sortWithinPartitions("part", "w")
    return dealt, shared


#: Pairs that a task holds before it passes them on.
HELD_PAIRS = 200_000


def with_prefix_nodes(words: DataFrame, g: Grouping, n: int) -> DataFrame:
    """(word, n) to (id, word, n, path): ``id`` follows the order of the words, ``path``
    has the numbers of the nodes of their prefixes."""
    dealt, shared = ranged(words.select(F.col("word").alias("w"), "n"), g, n)

    def number(batches):
        rows = ((b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())
                for b in batches)
        rows = ((p, w, k) for ws, ks, ps in rows for w, k, p in zip(ws, ks, ps))
        kept: list = []

        def words_only():
            for p, w, k in rows:
                kept.append((w, k))
                yield p, w

        out, held = [], 0
        for id_, path in scan(shared.value, words_only()):
            out.append((id_, *kept.pop(), path))
            held += len(path)
            if held >= HELD_PAIRS:
                yield prefix_batch(out)
                out, held = [], 0
        yield prefix_batch(out)

    return dealt.select("w", "n", "part").mapInArrow(
        number, "id long, word string, n long, path array<long>")


def prefix_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, words, counts, paths = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(words, pa.string()), pa.array(counts, pa.int64()),
         pa.array(paths, pa.list_(pa.int64()))], ["id", "word", "n", "path"])


def pairs_of(prefixed: DataFrame, g: Grouping, n: int) -> DataFrame:
    """(p, s, kind, id, n): the pairs of node numbers of all words."""
    dealt, shared = ranged(prefixed.select(F.reverse("word").alias("w"), "id", "n", "path"), g, n)

    def pair(batches):
        kept: list = []

        def words_only():
            for b in batches:
                w, ids, ns, parts = (b.column(i).to_pylist() for i in (0, 1, 2, 4))
                flat, at = b.column(3).flatten().to_numpy(), 0
                for i, word in enumerate(w):
                    kept.append((ids[i], ns[i], flat[at:at + len(word) + 1], word))
                    at += len(word) + 1
                    yield parts[i], word

        out, held = [], 0
        for _, path in scan(shared.value, words_only()):
            id_, count, prefix, back = kept.pop()
            out.append(word_pairs(id_, count, prefix, np.array(path[::-1]), back[::-1]))
            held += 2 * len(path)
            if held >= HELD_PAIRS:
                yield pair_batch(out)
                out, held = [], 0
        yield pair_batch(out)

    return dealt.select("w", "id", "n", "path", "part").mapInArrow(
        pair, "p long, s long, kind int, id long, n long")


def word_pairs(id_: int, n: int, prefix: np.ndarray, suffix: np.ndarray, word: str) -> tuple:
    """Columns of a word's pairs; ``prefix[i]`` and ``suffix[i]`` are the nodes of what lies
    before and from place i."""
    size = len(word)
    points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    first = np.concatenate([[True], points[1:] != points[:-1]])[:size]
    kind = np.concatenate([np.full(size + 1, WHOLE), np.where(first, FIRST_SKIP, SKIP)])
    return (np.concatenate([prefix, prefix[:-1]]), np.concatenate([suffix, suffix[1:]]),
            kind, np.full(2 * size + 1, id_), np.full(2 * size + 1, n))


def pair_batch(words: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*words)] or [np.array([])] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(np.int64)).cast(k) for c, k in zip(columns, kinds)],
        ["p", "s", "kind", "id", "n"])


# ------------------------------------------------------------------ neighbours and forms

def neighbours(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): how many neighbours a word has and the most frequent of them, as
    (-n, id); only words that have any."""
    met = Window.partitionBy("p", "s")
    pairs = pairs.withColumn("members", F.count(F.lit(1)).over(met)).where("members > 1")
    rank = F.struct((-F.col("n")).alias("minus_n"), "id")
    skipped, first = F.col("kind") != WHOLE, F.col("kind") == FIRST_SKIP
    ordered = met.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = pairs.withColumn("key", rank).select(
        "id", "kind", "key",
        F.count(F.when(skipped, 1)).over(ordered).alias("skips"),
        F.count(F.when(first, 1)).over(ordered).alias("firsts"),
        F.first(F.when(first, F.col("key")), ignorenulls=True).over(ordered).alias("first_1"),
        F.first(F.when(~skipped, F.col("key")), ignorenulls=True).over(ordered).alias("whole"),
        F.nth_value(F.when(skipped, F.col("key")), 1, True).over(ordered).alias("skip_1"),
        F.nth_value(F.when(skipped, F.col("key")), 2, True).over(ordered).alias("skip_2"))
    other = F.when(F.col("skip_1.id") == F.col("id"), F.col("skip_2")).otherwise(F.col("skip_1"))
    inserted = first & F.col("whole").isNotNull()
    near = F.when(~skipped, F.col("firsts")).otherwise(
        F.col("skips") - 1 + inserted.cast("long"))
    best = F.when(~skipped, F.col("first_1")).otherwise(
        F.when(inserted, F.least(other, F.col("whole"))).otherwise(other))
    return rows.select("id", near.alias("near"), best.alias("best")).where("near > 0").groupBy(
        "id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(id, root): where the pointers (id, form) end."""
    step = written(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        far = step.select(F.col("id").alias("root"), F.col("root").alias("far"))
        step = written(step.join(far, "root", "left").select(
            "id", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias(
                "moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return step.select("id", "root")
        step = step.select("id", "root")


def variants(words: DataFrame, g: Grouping = PRODUCTION) -> DataFrame:
    """(word, n), each word once, to (word, form, root, n, n_near, form_n)."""
    words = written(words, "spelling-words")
    n = words.count()
    prefixed = written(with_prefix_nodes(words, g, n), "spelling-prefixes")
    near = neighbours(pairs_of(prefixed, g, n))
    form = F.when(-F.col("best.minus_n") >= g.ratio * F.col("n"), F.col("best"))
    known = written(prefixed.select("id", "n").join(near, "id").select(
        "id", "n_near", form["id"].alias("form"), (-form["minus_n"]).alias("form_n")),
        "spelling-near")
    forms = known.where("form is not null").select("id", "form")
    names = prefixed.select("id", "word")
    spelled = forms.join(roots_of(forms), "id").join(
        names.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form").join(
        names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    out = prefixed.select("id", "word", "n").join(
        known.select("id", "n_near", "form_n"), "id", "left").join(
        spelled.select("id", "form_word", "root_word"), "id", "left")
    return out.select("word", F.col("form_word").alias("form"),
                      F.coalesce("root_word", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


# ------------------------------------------------------------------ the query

def misspelled(found: DataFrame, every: int = 199) -> DataFrame:
    """The runs as ``word``; where ``every`` divides the CRC of ``<doc_id>:<run>``, without
    one of their characters."""
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    rows = found.select("run", h.alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    less = F.concat(F.col("run").substr(F.lit(1), at),
                    F.col("run").substr(at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % every == 0, less).otherwise(F.col("run")).alias("word"))


def crc_step(byte: int) -> int:
    for _ in range(4):
        byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
    return byte


OP12_SQL = r"""
WITH RECURSIVE found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counts AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS name, count(*) AS k
  FROM found WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (SELECT run, k, hex(encode(name)) AS x FROM counts),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_transform(range(0, length(x)),
    lambda i: (strpos('0123456789ABCDEF', substr(x, xor(i, 1) + 1, 1)) - 1)::BIGINT),
    lambda acc, b: xor([CRC_STEPS][(xor(acc, b) & 15) + 1], acc >> 4),
    4294967295::BIGINT)) AS h FROM bytes),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT)
         || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM hashed),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM spelt WHERE length(word) >= 6
  GROUP BY word HAVING sum(k) >= 5),
skips AS (
  SELECT word, n, substr(word, 1, i::INT) AS p, substr(word, i::INT + 2) AS s
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM skips a JOIN skips b
    ON a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION SELECT DISTINCT w.word, s.word, s.n FROM words w JOIN skips s ON w.word = s.p || s.s
  UNION SELECT DISTINCT s.word, w.word, w.n FROM words w JOIN skips s ON w.word = s.p || s.s),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS top,
         max(other_n) AS top_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN top_n >= 5 * w.n THEN top END AS form,
         CASE WHEN top_n >= 5 * w.n THEN top_n END::BIGINT AS form_n
  FROM words w LEFT JOIN best b USING (word)),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at
  WHERE forms.form IS NOT NULL),
ends AS (
  SELECT walk.word, walk.at AS root FROM walk JOIN forms ON forms.word = walk.at
  WHERE forms.form IS NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
""".replace("CRC_STEPS", ", ".join(f"{crc_step(i)}::BIGINT" for i in range(16)))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(counted(misspelled(runs(docs, PRODUCTION)), PRODUCTION))

"""Mixing sources to target weights: Efraimidis-Spirakis sampling to token budgets.

1. Sources, in code-point order with null last, get the weights 5, 2, 1, repeating, and
   share ``share`` times all words.  A target stops at ``epochs`` times its source's size
   and the excess is shared anew: with the sources sorted by cap / weight, the capped ones
   are a prefix, which running sums find in exact integers, so no rounds are needed.
2. A target holds some complete epochs of its source, taken whole; the rest is a budget for
   a fraction of one more epoch.
3. Every document gets the key ``-ln(u) / quality``, an exponential whose rate is its
   quality, with ``u`` from a hash of its id and the seed.  Documents sorted by it within
   their source are a weighted sample without replacement, whatever their number.  Sizes
   are prefix-summed in that order; a document is taken while at least half of it lies
   below the budget, so a source misses its target by half a document at most.

The sort is one of ranges of (source, key): a source with a third of all rows is spread
over many of them, and the sources' targets reach the documents by (range, source).  Only
the columns given travel; the query gives no texts.  The seed and the id alone decide, so
reruns, partitions and lost executors change nothing.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a
source of its own; a null or non-positive quality counts as the smallest, ``1e-6``; rows
with a null id share one key; rows that share an id are documents of their own, and of
rows equal in key, id and size it doesn't matter which is taken; a very long text is one
document like others; an empty table gives no rows; other columns pass through, and the
added ones replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrail.llm.common import carried, packed, table, text_of, unpacked, words_of, written
from vitrail.operators.numbering import number_rows, running_sums


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    share: tuple[int, int] = (3, 2)  # numerator and denominator
    epochs: int = 2
    seed: int = 13


PRODUCTION = Mix()
LEAST_QUALITY = 1e-6
ADDED = ["size", "source_size", "target", "epochs", "taken"]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``size``, the number of words, and ``quality``, the share of its words
    that are different: texts that repeat themselves are sampled less often."""
    words = words_of(text_of(text))
    return docs.withColumns({"size": F.size(words).cast("long"), "quality": F.size(
        F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))})


def key_of(doc_id: str, quality: Column, seed: int) -> Column:
    """The exponential key; ``u`` is in (0, 1), from 48 bits of an MD5, which any engine can
    repeat."""
    digest = F.md5(F.concat_ws("|", F.col(doc_id).cast("string"), F.lit(str(seed))))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / F.greatest(F.coalesce(quality.cast("double"), F.lit(0.0)),
                                  F.lit(LEAST_QUALITY))


def targets(sizes: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """(source, source_size) plus ``target``, for any number of sources."""
    numbered = number_rows(sizes, [F.col("source").isNull(), "source"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in mix.weights]), (F.pmod(
        "place", F.lit(len(mix.weights))) + 1).cast("int")).cast("long")
    rows = numbered.select("source", "source_size", weight.alias("w"),
                           (mix.epochs * F.col("source_size")).alias("cap"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("w"))
    wide = "decimal(38,0)"
    rows = written(running_sums(rows, ["ratio", "cap", "source"], {
        "cap_before": F.col("cap").cast(wide), "w_before": F.col("w").cast(wide)}), "mix-caps")
    up, down = mix.share
    whole = rows.agg(F.sum("source_size").alias("words"), F.sum("w").alias("weights"),
                     ).first()  # two numbers
    budget, weights = up * int(whole["words"] or 0), int(whole["weights"] or 0)
    # capped: cap * (weights of it and those above) <= weight * (budget left to them)
    left = F.lit(budget).cast(wide) - down * F.col("cap_before").cast(wide)
    held = (down * F.col("cap").cast(wide)) * (F.lit(weights).cast(wide) - F.col("w_before").cast(wide))
    rows = rows.withColumn("capped", held <= F.col("w").cast(wide) * left)
    capped = rows.where("capped").agg(F.sum("cap"), F.sum("w")).first()
    rest = budget - down * int(capped[0] or 0)
    rest_weights = down * (weights - int(capped[1] or 0))
    return rows.select("source", "source_size", F.when(
        F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("w") * F.lit(float(rest)) / F.lit(float(max(rest_weights, 1)))).alias("target"))


def mixed(docs: DataFrame, mix: Mix = PRODUCTION, doc_id: str = "doc_id",
          source: str = "source", size: str = "size", quality: str = "quality") -> DataFrame:
    """``docs`` plus ``source_size``, ``target``, ``epochs`` (how often the mix takes the
    document, 0 upwards) and ``taken`` (its size as often)."""
    names = carried(docs, ADDED)
    rows = written(docs.select(
        packed(names), F.col(source).cast("string").alias("source"),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"),
        key_of(doc_id, F.col(quality), mix.seed).alias("key")), "mix-keys")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the empty take no words, whatever their key
    rows = running_sums(rows, ["key", "name", "size"], {"before": F.col("size")}, ["source"])
    shares = targets(sizes, mix)
    out = rows.join(F.broadcast(shares) if _few(shares) else shares,
                    rows["source"].eqNullSafe(shares["source"])).drop(shares["source"])
    full = F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.col("target") - full * F.col("source_size")
    part = (F.col("size") > 0) & (2 * F.col("before") + F.col("size") <= 2 * budget)
    times = (full + part.cast("long")).cast("int")
    return out.select(*unpacked(names), "size", "source_size", "target",
                      F.when(F.col("size") > 0, times).otherwise(0).alias("epochs")).withColumn(
        "taken", F.col("epochs") * F.col("size"))


#: Sources up to which their targets are broadcast; beyond, the join is by shuffle.
FEW_SOURCES = 100_000


def _few(shares: DataFrame) -> bool:
    return shares.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES


def repeated(mixture: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its ``epoch`` from 0."""
    return mixture.where("epochs > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))


#: The same mix in SQL; keys, sizes and targets are computed as above.
OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, source,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
docs AS (
  SELECT doc_id, source, len(ws)::BIGINT AS size,
         -ln((('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, '13')), 1, 12))::BIGINT::DOUBLE
              + 0.5::DOUBLE) / 281474976710656::DOUBLE)
         / greatest(len(list_distinct(ws))::DOUBLE / greatest(len(ws), 1)::DOUBLE, 1e-6::DOUBLE)
         AS key FROM words),
sources AS (
  SELECT source, sum(size)::HUGEINT AS s,
         ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT
         AS w FROM docs GROUP BY source),
ranked AS (
  SELECT *, coalesce(sum(2 * s) OVER below, 0)::HUGEINT AS caps_below,
         coalesce(sum(w) OVER below, 0)::HUGEINT AS w_below,
         (SELECT 3 * sum(s) FROM sources)::HUGEINT AS budget,
         (SELECT sum(w) FROM sources)::HUGEINT AS w_all FROM sources
  WINDOW below AS (ORDER BY s::DOUBLE / w::DOUBLE, s, source
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (
  SELECT *, 4 * s * (w_all - w_below) <= w * (budget - 2 * caps_below) AS full_cap FROM ranked),
rest AS (
  SELECT any_value(budget) - coalesce(sum(4 * s) FILTER (full_cap), 0) AS words,
         2 * (any_value(w_all) - coalesce(sum(w) FILTER (full_cap), 0)) AS weights FROM capped),
targets AS (
  SELECT source, s::BIGINT AS source_size, CASE WHEN full_cap THEN (2 * s)::DOUBLE
         ELSE w::DOUBLE * words::DOUBLE / weights::DOUBLE END AS target FROM capped, rest),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS full_epochs
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE size * (full_epochs + CASE WHEN 2 * before + size
         <= 2 * (target - full_epochs * source_size) THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM placed
"""


def op13_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = measured(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed(docs.drop("text")).select("doc_id", "size", "source_size", "target", "taken")

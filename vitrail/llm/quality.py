"""Quality rules: distribution divergence from language references.

Every text is described by two histograms, its character classes and its use of common
words.  The corpus gives the references: for each language the mean histograms of all its
documents long enough to measure.  A document passes when the Jensen-Shannon distances
(base 2, 0 to 1) to its nearest reference stay below the limits.  A short text is farther
from its reference by chance alone, so the limits are at least the distance expected of a
sample of its length plus a margin.  DataFrame functions only.

Defined cases: a null text has no words and fails the base rule; a null or unlisted
``lang`` takes no part in the references, and with fewer than ``min_reference`` documents
a language has no reference: such documents are held against the classes of all references
but not against their words, which say nothing of another language; with no reference at
all nothing is rejected beyond the base rule; a very long text is measured whole, in some
200 bytes of its task's memory per word; repeated rows get equal verdicts; other columns
pass through, and the added ones replace columns of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrail.llm.common import (
    GAP_CHARS,
    carried,
    packed,
    table,
    text_of,
    unpacked,
    words_of,
    written,
)

#: Frequent function words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "be", "by",
           "on", "are", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf",
           "ist", "im", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est",
           "pour", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "los", "se", "del", "las", "un", "por", "con",
           "una", "su", "para"],
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})

#: Character classes; "space" is ``GAP_CHARS``, the rest is "other".
CLASSES = ["space", "lower", "upper", "digit", "symbol", "mark", "other"]
#: What running text mostly consists of; letters without case and their marks are "lower".
CALM = r"[\p{Ll}\p{Lo}\p{Lm}\p{M}\x20\x09-\x0D]+"
NOT_UPPER, NOT_DIGIT = r"[^\p{Lu}]+", r"[^0-9]+"
NOT_SYMBOL, NOT_MARK = r"[^#*$%&|<>]+", r"""[^.,;:!?'"()\-]+"""


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict."""

    min_words: int = 50          # base rule: shorter documents fail
    max_repeat_percent: int = 50  # base rule: share of words in repeated windows
    max_class_distance: float = 0.15
    max_word_distance: float = 0.29
    reference_distance: float = 0.25  # documents farther from the first mean leave the second
    class_margin: float = 0.1    # over the distance expected of as many characters
    word_margin: float = 0.08    # over the distance expected of as many words
    guard_chars: int = 200       # shorter texts: the class histogram is not judged
    min_reference: int = 20      # documents a language needs for a reference


PRODUCTION = Limits()


def _with_histograms(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_text``, ``_words``, ``word_chars`` and the histograms ``_classes`` (in the
    order of ``CLASSES``) and ``_common`` (``VOCABULARY`` as written in running text, then
    all other words)."""
    def left(column: str, pattern: str) -> Column:
        return F.length(F.regexp_replace(column, pattern, ""))

    out = docs.withColumn("_text", text_of(text))
    out = out.withColumn("_words", words_of(F.col("_text")))
    # one scan of the text leaves the few characters the other classes are counted in
    out = out.withColumn("_loud", F.regexp_replace("_text", CALM, ""))
    out = out.withColumn("_known", F.filter("_words", lambda w: w.isin(VOCABULARY)))
    out = out.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    counted = [left("_loud", p) for p in (NOT_UPPER, NOT_DIGIT, NOT_SYMBOL, NOT_MARK)]
    out = out.withColumn("_few", F.array(*counted))
    space = F.length("_text") - F.col("word_chars").cast("int")
    lower = F.length("_text") - F.length("_loud") - space
    other = F.length("_loud") - F.col("_few")[0] - F.col("_few")[1] - F.col("_few")[2] \
        - F.col("_few")[3]
    out = out.withColumn("_classes", F.concat(F.array(space, lower), F.col("_few"),
                                              F.array(other)))
    # what array_remove takes away is how often the word occurs
    counts = F.transform(F.array(*[F.lit(w) for w in VOCABULARY]),
                         lambda v: F.size("_known") - F.size(F.array_remove("_known", v)))
    return out.withColumn("_common", F.concat(counts, F.array(
        F.size("_words") - F.size("_known")))).drop("_loud", "_known", "_few")


def _shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x)
    return F.transform(F.array(total), lambda t: F.transform(
        counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))[0]


References = dict[str, tuple[list[float], list[float]]]


def _means(shares: DataFrame, limits: Limits) -> References:
    """At most one row per entry of ``COMMON_WORDS`` comes to the driver."""
    rows = shares.groupBy("_lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(F.col("_cs")[i]) for i in range(len(CLASSES))]).alias("c"),
        F.array(*[F.avg(F.col("_ws")[i]) for i in range(len(VOCABULARY) + 1)]).alias("w"))
    return {r["_lang"]: (list(r["c"]), list(r["w"]))
            for r in rows.collect() if r["n"] >= limits.min_reference}


def references(measured: DataFrame, limits: Limits = PRODUCTION) -> References:
    """Mean class and word histograms of each listed language over all its documents of at
    least ``min_words`` words and ``guard_chars`` characters, taken twice: the second mean
    leaves out documents whose classes are far from every first mean."""
    long_enough = (F.col("n_words") >= limits.min_words) & (
        F.aggregate("_classes", F.lit(0), lambda a, x: a + x) >= limits.guard_chars)
    shares = measured.where(long_enough & F.col("_lang").isin(list(COMMON_WORDS))).select(
        "_lang", _shares("_classes").alias("_cs"), _shares("_common").alias("_ws"))
    first = _means(shares, limits)
    if not first:
        return first
    near = _nearest([js_distance("_cs", c) for c, _ in first.values()])
    return _means(shares.where(near <= limits.reference_distance), limits)


def js_distance(shares: str, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) between an array of shares and a reference."""
    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    parts = F.zip_with(shares, F.array(*[F.lit(float(x)) for x in reference]),
                       lambda p, q: term(p, (p + q) / 2) + term(q, (p + q) / 2))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _nearest(distances: list[Column]) -> Column:
    if not distances:
        return F.lit(0.0)
    return F.least(*distances) if len(distances) > 1 else distances[0]


def _expected(cells: int, n: Column) -> Column:
    """About the distance between a distribution over ``cells`` and a sample of ``n`` draws
    from it: the divergence is an eighth of chi-square over n, in nats."""
    return F.sqrt((cells - 1) / (8 * math.log(2) * F.greatest(n, F.lit(1))))


#: Texts of up to 2 to this many words have windows that fit one number with their place.
PACKED_BITS = 14


def repeated_words(words: str) -> Column:
    """Words inside 3-word windows that occur twice or more in the array, counted once.
    Windows meet by 64-bit hash within one text.  In usual texts the hash gives up as many
    low bits as the window's position needs (50 stay at least), so that plain numbers are
    sorted; texts of more than ``2 ** PACKED_BITS`` words sort whole hashes beside their
    positions."""
    w = F.col(words)
    hashes = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                         lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    bits = F.ceil(F.log2(F.greatest(F.size(w), F.lit(2)))).cast("int")
    return F.transform(F.array(F.struct(hashes.alias("h"), bits.alias("bits"))), _covered)[0]


def _covered(text: Column) -> Column:
    h, bits = text["h"], text["bits"]

    def packed(low: Column) -> Column:  # low: the bits of the position
        return F.sort_array(F.transform(
            h, lambda x, i: x.bitwiseXOR(x.bitwiseAND(low)).bitwiseOR(i.cast("long"))))

    def twice(p: Column) -> Column:
        def near(x: Column, y: Column) -> Column:
            return F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0

        same = F.filter(p, lambda x, i: near(x, F.get(p, i - 1)) | near(x, F.get(p, i + 1)))
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        return F.sort_array(F.transform(same, lambda x: x.bitwiseAND(low)))

    def span(p: Column) -> Column:
        # a window covers three words, or as many as there are before the next window
        return F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                                      lambda a, b: F.least(b - a, F.lit(3))),
                           F.lit(0).cast("long"), lambda s, x: s + x)

    def twice_whole(p: Column) -> Column:
        same = F.filter(p, lambda x, i: (x["x"] == F.get(p, i - 1)["x"])
                        | (x["x"] == F.get(p, i + 1)["x"]))
        return F.sort_array(F.transform(same, lambda x: x["at"]))

    lows = F.array(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    short = F.transform(F.transform(lows, packed), twice)[0]
    placed = F.sort_array(F.transform(h, lambda x, i: F.struct(
        x.alias("x"), i.cast("long").alias("at"))))
    long = F.transform(F.array(placed), twice_whole)[0]
    at = F.when(bits <= PACKED_BITS, short).otherwise(long)
    return F.transform(F.array(at), span)[0]


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "class_distance", "word_distance", "base_failed", "kept"]


def measure(docs: DataFrame, text: str = "text", lang: str = "lang",
            base: bool = True) -> DataFrame:
    """``docs`` plus ``_lang``, both histograms, ``n_words`` and ``word_chars``; with
    ``base`` also the other base measures."""
    out = _with_histograms(docs, text).withColumn("_lang", F.col(lang))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    if base:
        lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.btrim(
            x, F.lit(GAP_CHARS))) > 0)
        out = out.withColumn("_lines", lines)
        symbols = F.col("_classes")[CLASSES.index("symbol")]
        out = out.withColumn("n_symbols", symbols.cast("long"))
        out = out.withColumn("n_dup_lines", (
            F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        out = out.withColumn("n_repeat_words", repeated_words("_words"))
        out = out.drop("_lines")
    out = out.drop("_text", "_words")
    added = [c for c in out.columns if c not in docs.columns]
    # through a generate, below which no filter on a measure is pushed: the whole
    # expression would be evaluated again for every use of it
    return out.select(*docs.columns, F.explode(F.array(F.struct(*added))).alias("_m")).select(
        *docs.columns, *[F.col("_m")[c].alias(c) for c in added])


def verdict(measured: DataFrame, refs: References, limits: Limits = PRODUCTION) -> DataFrame:
    """Adds both distances to the nearest reference, ``base_failed`` and ``kept``."""
    out = measured.withColumn("_cs", _shares("_classes")).withColumn("_ws", _shares("_common"))
    out = out.withColumn("class_distance", _nearest(
        [js_distance("_cs", c) for c, _ in refs.values()]))
    out = out.withColumn("word_distance", _nearest(
        [js_distance("_ws", w) for _, w in refs.values()]))
    out = out.withColumn("base_failed", (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")))
    chars = F.aggregate("_classes", F.lit(0), lambda a, x: a + x)
    most_classes = F.greatest(F.lit(limits.max_class_distance),
                              limits.class_margin + _expected(len(CLASSES), chars))
    most_words = F.greatest(F.lit(limits.max_word_distance), limits.word_margin + _expected(
        len(COMMON_WORDS["en"]) + 1, F.col("n_words")))  # the words of one language, the rest
    known = F.coalesce(F.col("_lang").isin(list(refs)), F.lit(False))
    odd = ((chars >= limits.guard_chars) & (F.col("class_distance") > most_classes)) | (
        known & (F.col("word_distance") > most_words))
    out = out.withColumn("kept", ~F.col("base_failed") & ~odd)
    judged = ["class_distance", "word_distance", "base_failed", "kept"]
    rest = [c for c in measured.columns if c not in judged]
    return out.select(*rest, F.explode(F.array(F.struct(*judged))).alias("_v")).select(
        *rest, *[F.col("_v")[c].alias(c) for c in judged])


def judge(docs: DataFrame, limits: Limits = PRODUCTION, text: str = "text",
          lang: str = "lang") -> DataFrame:
    """``docs`` with the columns ``MEASURES``.  The texts are read twice: for the
    references, of which only histograms are kept, and for the verdicts."""
    seen = written(measure(docs.select(text, lang), text, lang, base=False)
                   .select("_lang", "n_words", "_classes", "_common"), "quality")
    names = carried(docs, MEASURES)
    rows = docs.select(packed(names), F.col(text).alias("text"), F.col(lang).alias("lang"))
    out = verdict(measure(rows), references(seen, limits), limits)
    return out.select(*unpacked(names), *MEASURES)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents; measured once, as no text is returned."""
    measured = written(measure(table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang")).drop("text"), "quality")
    return verdict(measured, references(measured)).select("doc_id", *MEASURES)

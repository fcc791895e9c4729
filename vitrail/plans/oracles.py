"""DuckDB SQL equivalents of the registered queries (same column names and rounding)."""

from __future__ import annotations

LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def sig(expr: str, digits: int = 10) -> str:
    """SQL twin of :func:`vitrail.functions.numeric.round_sig`."""
    x = f"CAST(({expr}) AS DOUBLE)"
    scale = (f"pow(10.0, {digits - 1} - floor(log10(CASE WHEN {x} = 0 THEN 1.0 "
             f"ELSE abs({x}) END)))")
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 THEN {x} "
            f"ELSE round({x} * {scale}) / {scale} END)")


def _unpivot_features(cols: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i} AS idx, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM lineitem"
        for i, c in enumerate(cols))
    return f"({rows})"


CLASS_DISTRIBUTION = """
SELECT l_returnflag AS class, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem), 9) AS share
FROM lineitem GROUP BY l_returnflag
"""

COL_STATS = f"""
SELECT CAST(idx AS INTEGER) AS idx, feature, count(v) AS count, {sig('avg(v)')} AS mean,
       {sig('var_samp(v)')} AS variance, CAST(count(*) FILTER (WHERE v <> 0) AS BIGINT) AS num_nonzeros,
       min(v) AS min, max(v) AS max
FROM {_unpivot_features(LINEITEM_FEATURES)} GROUP BY idx, feature
"""


def _corr_matrix() -> str:
    parts = []
    cols = LINEITEM_FEATURES
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            parts.append(
                f"SELECT CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, '{a}' AS column_i, "
                f"'{b}' AS column_j, round(corr({a}, {b}), 9) AS corr FROM lineitem")
    return " UNION ALL ".join(parts)


def _corr_pairwise() -> str:
    cols = {"quantity": "CASE WHEN l_linenumber <> 7 THEN l_quantity END",
            "price": "l_extendedprice",
            "discount": "CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END",
            "tax": "CASE WHEN l_partkey % 5 <> 0 THEN l_tax END"}
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, '{a}' AS column_i, "
        f"'{b}' AS column_j, count(*) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) AS n, "
        f"round(corr({x}, {y}), 9) AS corr FROM lineitem"
        for i, (a, x) in enumerate(cols.items()) for j, (b, y) in enumerate(cols.items()))


DESCRIBE_NUMERIC = f"""
SELECT CAST(idx AS INTEGER) AS idx, feature, count(v) AS count, {sig('avg(v)')} AS mean,
       {sig('stddev_samp(v)')} AS std, min(v) AS min,
       {sig('quantile_cont(v, 0.25)')} AS q25, {sig('quantile_cont(v, 0.5)')} AS q50,
       {sig('quantile_cont(v, 0.75)')} AS q75, max(v) AS max
FROM {_unpivot_features(LINEITEM_FEATURES)} GROUP BY idx, feature
"""


# ------------------------------------------------------------------ ingest
KEY = "(l_orderkey * 10 + l_linenumber)"
SPOILED = f"({KEY} % 50 = 0 OR {KEY} % 51 = 0)"
INGESTED = f"""(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag,
       l_returnflag || ';' || l_linestatus AS status_pair,
       strftime(l_shipdate, '%Y-%m-%d') AS ship_day
FROM lineitem WHERE NOT {SPOILED})"""

INGEST_DELIMITED = f"SELECT * FROM {INGESTED}"

INGEST_HEADER = """
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS name
FROM (DESCRIBE SELECT * FROM customer)
"""

INGEST_FILE = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(l_quantity AS DOUBLE) AS l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem
"""

INGEST_DIRTY = """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_orderkey % 7 = 0) AS line,
                  count(*) FILTER (WHERE l_orderkey % 10 = 0) AS quantity FROM lineitem)
SELECT 'key' AS column, CAST(0 AS BIGINT) AS n_bad, n AS n_rows, CAST(0 AS BIGINT) AS n_malformed
FROM c
UNION ALL SELECT 'line', line, n, 0 FROM c
UNION ALL SELECT 'quantity', quantity, n, 0 FROM c
UNION ALL SELECT 'day', 0, n, 0 FROM c
"""

DIRTY = """(SELECT l_orderkey AS key, CAST(l_orderkey AS VARCHAR) || ';' ||
  CASE WHEN l_orderkey % 7 = 0 THEN '3000000000' ELSE CAST(l_linenumber AS VARCHAR) END || ';' ||
  CASE WHEN l_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS three,
  CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day
  FROM lineitem)"""

INGEST_EXAMPLES = f"""
WITH faults AS (
  SELECT CAST(NULL AS VARCHAR) AS "column", 'width' AS fault, three AS line FROM {DIRTY}
  WHERE key % 11 = 0
  UNION ALL SELECT NULL, 'blank', '' FROM range(2)
  UNION ALL SELECT 'line', 'type', three || ';' || day FROM {DIRTY}
  WHERE key % 11 <> 0 AND key % 7 = 0
  UNION ALL SELECT 'quantity', 'type', three || ';' || day FROM {DIRTY}
  WHERE key % 11 <> 0 AND key % 10 = 0),
counted AS (SELECT "column", fault, line, count(*) AS n FROM faults GROUP BY ALL)
SELECT "column", fault, CAST(row_number() OVER (PARTITION BY "column", fault ORDER BY md5(line))
       AS INTEGER) AS rank, line, n
FROM counted QUALIFY row_number() OVER (PARTITION BY "column", fault ORDER BY md5(line)) <= 5
"""

INGEST_MALFORMED = f"""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE {SPOILED}
UNION ALL SELECT CAST(NULL AS BIGINT), CAST(NULL AS INTEGER)
"""

INGEST_PROFILE = f"""
SELECT 'lineitem' AS file, CAST(8 AS BIGINT) AS n_cols,
       CAST(count(*) FILTER (WHERE NOT {SPOILED}) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE {SPOILED}) + 1 AS BIGINT) AS n_malformed
FROM lineitem
"""

INGEST_TYPED = f"""
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice,
       CAST(l_discount AS FLOAT) AS l_discount, flag, status_pair,
       CAST(ship_day AS DATE) AS ship_day
FROM {INGESTED}
"""

INGEST_NULLS = f"SELECT flag, count(*) AS n FROM {INGESTED} GROUP BY flag"

INGEST_TABLE_SQL = f"""
SELECT flag, CAST(year(CAST(ship_day AS DATE)) AS INTEGER) AS ship_year, count(*) AS n,
       sum(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE)) AS sum_qty
FROM {INGESTED} GROUP BY flag, year(CAST(ship_day AS DATE))
"""

PARSE_POINTS = """
SELECT CAST(l_linenumber AS DOUBLE) AS label, [l_quantity, l_discount, l_tax] AS features
FROM lineitem
"""

PARSE_POINTS_SEMICOLON = """
SELECT CAST(l_linenumber AS DOUBLE) AS label,
       [CAST(l_orderkey AS DOUBLE), l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
        l_tax, ascii(l_returnflag)] AS features
FROM lineitem
"""

STRIP_ACCENTS = """
SELECT doc_id, CAST(length(strip_accents(text)) AS BIGINT) AS n_chars,
       md5(strip_accents(text)) AS md5
FROM documents
"""

LIBSVM_ROUNDTRIP = PARSE_POINTS

LIBSVM_DIRTY = f"""
WITH c AS (SELECT {", ".join(f"CAST(count(*) FILTER (l_orderkey % 20 = {k}) AS BIGINT) AS n_{f}"
                             for f, k in (("label", 1), ("token", 5), ("index", 2),
                                          ("repeat", 4), ("order", 3)))} FROM lineitem)
SELECT CAST(l_linenumber AS DOUBLE) AS label, count(*) AS n, {sig('sum(l_quantity)')} AS x0,
       {sig('sum(l_discount)')} AS x1, {sig('sum(l_tax)')} AS x2,
       any_value(n_label) AS n_label, any_value(n_token) AS n_token,
       any_value(n_index) AS n_index, any_value(n_repeat) AS n_repeat,
       any_value(n_order) AS n_order
FROM lineitem, c WHERE l_orderkey % 20 NOT BETWEEN 1 AND 5 GROUP BY l_linenumber
"""

# ------------------------------------------------------------------ splits
HASH_U = ("(CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8)) AS BIGINT)"
          " / 4294967296.0)")

HASH_SPLIT = f"""
SELECT l_orderkey, l_linenumber, CASE WHEN {HASH_U} < 0.6 THEN 0 ELSE 1 END AS split
FROM lineitem
"""

RANDOM_SPLIT = """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_in_both,
       CAST(0 AS BIGINT) AS n_moved, true AS share_holds FROM lineitem
"""

SAMPLE_ROWS = """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_invented,
       CAST(0 AS BIGINT) AS n_moved, true AS share_holds FROM lineitem
"""

REPEATED = """(SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE
        CAST(l_orderkey % 100 AS VARCHAR) || '-' || CAST(CAST(floor(l_quantity) AS BIGINT)
        AS VARCHAR) END AS k FROM lineitem)"""


def _draws(seed: int) -> str:
    return f"""(SELECT k, CAST('0x' || substr(md5(k || '|' || CAST(unnest(range(1, n + 1))
        AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT) / 4294967296.0 AS u
        FROM (SELECT k, count(*) AS n FROM {REPEATED} GROUP BY k))"""


SAMPLE_COPIES = f"""
SELECT k, count(*) AS n, CAST(count(*) FILTER (u < 0.1) AS BIGINT) AS n_kept
FROM {_draws(5)} GROUP BY k"""

SPLIT_COPIES = f"""
SELECT k, CAST(count(*) FILTER (u < 0.6) AS BIGINT) AS n0,
       CAST(count(*) FILTER (u >= 0.6 AND u < 0.9) AS BIGINT) AS n1,
       CAST(count(*) FILTER (u >= 0.9) AS BIGINT) AS n2
FROM {_draws(6)} GROUP BY k"""

# ------------------------------------------------------------------ metrics
SCORED = """(SELECT CAST(l_linenumber AS INTEGER) AS label,
        CAST(floor((l_quantity - 1) / 10) + 1 AS INTEGER) AS prediction FROM lineitem)"""

CONFUSION = f"SELECT label, prediction, count(*) AS n FROM {SCORED} GROUP BY label, prediction"

OVR = f"""(WITH cm AS ({CONFUSION}),
classes AS (SELECT label AS class FROM cm UNION SELECT prediction FROM cm),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total,
               CAST(sum(n) FILTER (WHERE label = prediction) AS BIGINT) AS correct FROM cm),
per AS (
  SELECT c.class,
         CAST(coalesce(sum(n) FILTER (WHERE label = c.class AND prediction = c.class), 0) AS BIGINT) AS tp,
         CAST(coalesce(sum(n) FILTER (WHERE prediction = c.class AND label <> c.class), 0) AS BIGINT) AS fp,
         CAST(coalesce(sum(n) FILTER (WHERE label = c.class AND prediction <> c.class), 0) AS BIGINT) AS fn
  FROM classes c, cm GROUP BY c.class)
SELECT class, tp, fp, fn, total - tp - fp - fn AS tn, correct - tp AS correct_other
FROM per, tot)"""

CONFUSION_ONE_VS_REST = f"SELECT * FROM {OVR}"

PER_CLASS = f"""(SELECT class, tp, fp, fn,
  CASE WHEN tp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN tp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall
FROM {OVR})"""


def _hm(p: str, r: str) -> str:
    return f"CASE WHEN {p} + {r} = 0 THEN 0.0 ELSE 2.0 * {p} * {r} / ({p} + {r}) END"


METRICS_PER_CLASS = f"""
SELECT class, tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round({_hm('precision', 'recall')}, 9) AS f1
FROM {PER_CLASS}
"""

METRICS_MACRO = f"""
SELECT 'quantity band' AS method, round(p, 9) AS precision, round(r, 9) AS recall,
       round({_hm('p', 'r')}, 9) AS f_measure
FROM (SELECT avg(precision) AS p, avg(recall) AS r FROM {PER_CLASS})
"""

ACCURACY_ERROR = f"""
SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS n_correct,
       round(CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) / count(*), 9) AS accuracy,
       round(1.0 - CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) / count(*), 9) AS error
FROM {SCORED}
"""


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({num}) = 0 OR ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END"


MULTILABEL_METRICS = f"""
WITH sets AS (
  SELECT user_id, list(DISTINCT event_type) AS l,
         coalesce(list(DISTINCT event_type) FILTER (WHERE value > 50), []) AS p
  FROM events GROUP BY user_id),
s AS (SELECT len(list_intersect(p, l)) AS i, len(list_distinct(list_concat(p, l))) AS u,
             len(p) AS np, len(l) AS nl FROM sets)
SELECT count(*) AS n, round(avg({_ratio('i', 'np')}), 9) AS precision,
       round(avg({_ratio('i', 'nl')}), 9) AS recall,
       round(avg({_ratio('2 * i', 'np + nl')}), 9) AS f1,
       round(avg({_ratio('i', 'u')}), 9) AS accuracy
FROM s
"""

# ------------------------------------------------------------------ closed-form models
INDEX_LABEL = """
WITH f AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
r AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS idx FROM f)
SELECT e.event_id, e.event_type, CAST(r.idx AS DOUBLE) AS idx
FROM events e JOIN r USING (event_type)
"""

_SMALL = ["l_quantity", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)"]
INDEX_FEATURES = "WITH v AS (" + " UNION ALL ".join(
    f"SELECT DISTINCT {i} AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem"
    for i, c in enumerate(_SMALL)) + """),
k AS (SELECT feature FROM v GROUP BY feature HAVING count(*) <= 10)
SELECT CAST(feature AS INTEGER) AS feature, value,
       CAST(row_number() OVER (PARTITION BY feature ORDER BY value <> 0, value) - 1 AS INTEGER)
         AS category
FROM v WHERE feature IN (SELECT feature FROM k)
"""

BANDED = f"""(SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
        CAST(floor((l_quantity - 1) / 10) AS INTEGER) AS band,
        CASE WHEN {HASH_U} < 0.6 THEN 0 ELSE 1 END AS split FROM lineitem)"""

NB_PARAMS = f"""(WITH t AS (SELECT * FROM {BANDED} WHERE split = 0),
c AS (SELECT band, count(*) AS n, sum(l_quantity) AS s0, sum(l_discount) AS s1,
             sum(l_tax) AS s2 FROM t GROUP BY band),
tot AS (SELECT sum(n) AS total, count(*) AS k FROM c)
SELECT band AS label, ln(n + 1.0) - ln(total + k * 1.0) AS log_prior,
       ln(s0 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t0,
       ln(s1 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t1,
       ln(s2 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t2
FROM c, tot)"""

NB_PARAMETERS = f"""
SELECT label, CAST(f AS INTEGER) AS feature, {sig('log_prior')} AS log_prior,
       {sig('ll')} AS log_likelihood
FROM (SELECT label, log_prior, 0 AS f, t0 AS ll FROM {NB_PARAMS}
      UNION ALL SELECT label, log_prior, 1, t1 FROM {NB_PARAMS}
      UNION ALL SELECT label, log_prior, 2, t2 FROM {NB_PARAMS})
"""

NB_CLASSIFY = f"""
WITH test AS (SELECT row_number() OVER () AS rid, * FROM {BANDED} WHERE split = 1),
scores AS (
  SELECT t.rid, t.band, p.label,
         p.log_prior + t.l_quantity * p.t0 + t.l_discount * p.t1 + t.l_tax * p.t2 AS s
  FROM test t, {NB_PARAMS} p),
best AS (SELECT rid, any_value(band) AS band, arg_max(label, s) AS pred
         FROM scores GROUP BY rid)
SELECT band AS label, pred AS prediction, count(*) AS n FROM best GROUP BY band, pred
"""

SHOW_PREDICTIONS = f"""
WITH test AS (SELECT row_number() OVER () AS rid, * FROM {BANDED} WHERE split = 1),
scores AS (
  SELECT t.rid, p.label,
         p.log_prior + t.l_quantity * p.t0 + t.l_discount * p.t1 + t.l_tax * p.t2 AS s
  FROM test t, {NB_PARAMS} p),
best AS (SELECT rid, arg_max(label, s) AS pred FROM scores GROUP BY rid)
SELECT t.l_orderkey, t.l_linenumber, t.l_quantity, t.l_discount, t.l_tax, t.band AS label,
       b.pred AS prediction
FROM test t JOIN best b USING (rid)
ORDER BY t.l_orderkey, t.l_linenumber, t.l_quantity, t.l_discount, t.l_tax LIMIT 5
"""

def _entropy(counts: list[str]) -> str:
    total = " + ".join(counts)
    terms = " ".join(
        f"- CASE WHEN {c} = 0 THEN 0 ELSE {c} / ({total}) * log2({c} / ({total})) END"
        for c in counts)
    return f"(({total}) * (0 {terms}))"


# the split of l_discount with the largest information gain for l_returnflag
STUMP = f"""
v AS (SELECT l_discount AS x, CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS a,
             CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) AS n,
             CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS r
      FROM lineitem GROUP BY l_discount),
cum AS (SELECT x, lead(x) OVER w AS nx, sum(a) OVER w AS la, sum(n) OVER w AS ln_,
               sum(r) OVER w AS lr, sum(a) OVER () - sum(a) OVER w AS ra,
               sum(n) OVER () - sum(n) OVER w AS rn, sum(r) OVER () - sum(r) OVER w AS rr
        FROM v WINDOW w AS (ORDER BY x)),
best AS (SELECT (x + nx) / 2.0 AS thr,
                CASE WHEN la >= ln_ AND la >= lr THEN 'A' WHEN ln_ >= lr THEN 'N' ELSE 'R' END AS lp,
                CASE WHEN ra >= rn AND ra >= rr THEN 'A' WHEN rn >= rr THEN 'N' ELSE 'R' END AS rp
         FROM cum WHERE nx IS NOT NULL
         ORDER BY {_entropy(['la', 'ln_', 'lr'])} + {_entropy(['ra', 'rn', 'rr'])}, thr LIMIT 1)"""

DT_STUMP = f"""
WITH {STUMP}
SELECT l_returnflag AS label, CASE WHEN l_discount <= thr THEN lp ELSE rp END AS prediction,
       count(*) AS n
FROM lineitem, best GROUP BY 1, 2
"""

TREE_TEXT = """
WITH t AS (SELECT (max(l_quantity) FILTER (WHERE l_quantity <= 25)
                   + min(l_quantity) FILTER (WHERE l_quantity > 25)) / 2.0 AS thr FROM lineitem)
SELECT CAST(0 AS INTEGER) AS line, 'If (feature 0 <= ' || thr || ')' AS text FROM t
UNION ALL SELECT CAST(1 AS INTEGER), 'Predict: 0.0'
UNION ALL SELECT CAST(2 AS INTEGER), 'Else (feature 0 > ' || thr || ')' FROM t
UNION ALL SELECT CAST(3 AS INTEGER), 'Predict: 1.0'
"""

NB_ONE_BASED = f"""
WITH h AS (SELECT *, CASE WHEN l_quantity > 25 THEN 2 ELSE 1 END AS half FROM {BANDED}),
c AS (SELECT half, count(*) AS n, sum(l_quantity) AS s0, sum(l_discount) AS s1, sum(l_tax) AS s2
      FROM h WHERE split = 0 GROUP BY half),
p AS (SELECT half, ln(n + 1.0) - ln((SELECT sum(n) FROM c) + 2.0) AS prior,
             ln(s0 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t0,
             ln(s1 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t1,
             ln(s2 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS t2 FROM c),
t AS (SELECT row_number() OVER () AS rid, * FROM h WHERE split = 1),
best AS (SELECT rid, any_value(t.half) AS label,
                arg_max(p.half, prior + l_quantity * t0 + l_discount * t1 + l_tax * t2) AS pred
         FROM t, p GROUP BY rid)
SELECT label, pred AS prediction, count(*) AS n FROM best GROUP BY 1, 2
"""


def _judged(label: str, where: str) -> str:
    return f"""
SELECT CAST({label} AS INTEGER) AS label, count(*) AS n, count(*) AS n_in_label_space,
       true AS error_holds
FROM lineitem WHERE {where} GROUP BY 1
"""


BAND, BIG, TERCILE = ("floor((l_quantity - 1) / 10)", "(l_quantity > 25)",
                      "floor((l_quantity - 1) / 17)")
DT_CLASSIFY = _judged(BAND, f"{HASH_U} >= 0.6")
GBT_CLASSIFY = _judged(BIG, f"{HASH_U} >= 0.7")
GBT_UNSEEN = """
SELECT l_linenumber, count(*) AS n, count(*) AS n_scored, true AS error_holds,
       (SELECT count(*) FROM lineitem WHERE l_linenumber > 4) AS n_unseen
FROM lineitem GROUP BY l_linenumber"""

RF_CLASSIFY = _judged(BAND, f"{HASH_U} >= 0.7")
MLP_CLASSIFY = _judged(TERCILE, f"{HASH_U} >= 0.6")
SVM_LINEAR = _judged("(l_quantity > l_discount * 500)", "true")

DT_EXACT = f"""
SELECT CAST({BAND} AS INTEGER) AS band, CAST({BAND} AS INTEGER) AS prediction, count(*) AS n
FROM lineitem WHERE {HASH_U} >= 0.6 GROUP BY 1
""".replace("AS band,", "AS label,")

# one split of l_quantity, where the variance of the label falls most
GBT_STUMP = """
WITH t AS (SELECT l_quantity AS x, CAST(l_discount * 100 + l_quantity > 40 AS INTEGER) AS y
           FROM lineitem),
v AS (SELECT x, count(*) AS n, sum(y) AS s FROM t GROUP BY x),
cum AS (SELECT x, lead(x) OVER w AS nx, sum(n) OVER w AS ln_, sum(s) OVER w AS ls,
               sum(n) OVER () - sum(n) OVER w AS rn, sum(s) OVER () - sum(s) OVER w AS rs
        FROM v WINDOW w AS (ORDER BY x)),
best AS (SELECT (x + nx) / 2.0 AS thr, CAST(2.0 * ls > ln_ AS INTEGER) AS lp,
                CAST(2.0 * rs > rn AS INTEGER) AS rp
         FROM cum WHERE nx IS NOT NULL
         ORDER BY ls * (ln_ - ls) / ln_ + rs * (rn - rs) / rn, thr LIMIT 1)
SELECT y AS label, CASE WHEN x <= thr THEN lp ELSE rp END AS prediction, count(*) AS n
FROM t, best GROUP BY 1, 2
"""

ALL_SAME = "SELECT count(*) AS n, count(*) AS n_same FROM lineitem"
MODEL_ROUNDTRIP = "SELECT count(*) AS n, count(*) AS n_same, true AS error_holds FROM lineitem"

LR_ELASTIC_NET = """
SELECT CAST(i AS INTEGER) AS feature, (SELECT count(*) FROM lineitem) AS n, true AS optimal
FROM range(4) AS r(i)
"""

LR_SATURATED = """
SELECT CAST(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS INTEGER) AS feature,
       round(ln(CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE)
                / count(*) FILTER (WHERE l_returnflag <> 'R')), 4) AS coefficient
FROM lineitem WHERE l_linestatus IN ('F', 'O') GROUP BY 1
"""

# ------------------------------------------------------------------ clustering
ASSIGNED = """(WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS p FROM embeddings),
u AS (SELECT label, i, avg(v) AS m
      FROM (SELECT label, unnest(p) AS v, generate_subscripts(p, 1) AS i FROM e)
      GROUP BY label, i),
c AS (SELECT label AS cid, list(m ORDER BY i) AS cv FROM u GROUP BY label),
d AS (SELECT vec_id, e.label, cid, list_distance(p, cv) AS dist FROM e, c),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 9), cid) AS rn
      FROM d)
SELECT vec_id, label, CAST(cid AS INTEGER) AS cluster, dist AS distance FROM r WHERE rn = 1)"""

ASSIGN_NEAREST_CENTROID = f"""
SELECT vec_id, label, cluster, round(distance, 6) AS distance FROM {ASSIGNED}
"""

ASSIGN_MANY = f"""
WITH embeddings AS (SELECT vec_id, CAST(vec_id % 97 AS INTEGER) AS label, embedding
                    FROM embeddings)
SELECT vec_id, cluster, round(distance, 6) AS distance FROM {ASSIGNED}
"""

WSSSE = f"""
SELECT count(*) AS n, {sig('sum(distance)')} AS sum_distance,
       {sig('sum(distance * distance)')} AS sum_sq_distance
FROM {ASSIGNED}
"""

CLUSTER_LABEL_COUNTS = f"""
SELECT cluster, label, count(*) AS n FROM {ASSIGNED} GROUP BY cluster, label
"""


def _crosstab(labels: range) -> str:
    cols = ", ".join(f"CAST(count(a.vec_id) FILTER (WHERE a.label = {v}) AS BIGINT) AS label_{v}"
                     for v in labels)
    return f"""
WITH k AS (SELECT DISTINCT CAST(label AS INTEGER) AS cluster FROM embeddings)
SELECT k.cluster, {cols}
FROM k LEFT JOIN {ASSIGNED} a ON a.cluster = k.cluster GROUP BY k.cluster
"""


KMEANS_FIT = """
SELECT count(*) AS n, CAST(6 AS INTEGER) AS k, true AS cost_holds, true AS best_holds
FROM embeddings
"""

GMM_FIT = """
SELECT count(*) AS n, CAST(6 AS INTEGER) AS k, CAST(4 AS INTEGER) AS d, true AS symmetric,
       true AS means_within
FROM lineitem
"""


def _gmm_moments() -> str:
    cols = LINEITEM_FEATURES
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, "
        f"{sig(f'avg({a})', 8)} AS mean_i, {sig(f'var_pop({a})', 8)} AS var_i, "
        f"round(covar_pop({a}, {b}) "
        f"/ (stddev_pop({a}) * stddev_pop({b})), 4) AS cov_ij FROM lineitem"
        for i, a in enumerate(cols) for j, b in enumerate(cols))


# ------------------------------------------------------------------ graph
PIC_EDGES = """
SELECT least(l_partkey * 2, l_suppkey * 2 + 1) AS src,
       greatest(l_partkey * 2, l_suppkey * 2 + 1) AS dst,
       CAST(count(*) AS DOUBLE) AS weight
FROM lineitem GROUP BY 1, 2
"""


PIC_CLUSTERS = """
WITH c AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS at,
                  count(*) OVER () // 4 AS cut FROM customer),
n AS (SELECT id, (SELECT min(f.id) FROM c f WHERE (f.at < f.cut) = (c.at < c.cut)) AS cluster
      FROM c)
SELECT id, cluster, id || ' -> ' || cluster AS text FROM n
"""

EDGES_DROPPED = """
WITH e AS (SELECT l_orderkey % 11 = 0 AS bad, l_orderkey % 5 = 0 AS loop, l_linenumber = 1 AS none,
                  l_orderkey + 9007199254740993 AS src FROM lineitem),
c AS (SELECT count(*) FILTER (WHERE NOT bad) AS n_rows, count(*) FILTER (WHERE bad) AS n_bad,
             count(*) FILTER (WHERE NOT bad) AS n_edges, 0 AS n_null,
             count(*) FILTER (WHERE NOT bad AND loop) AS n_loops,
             count(*) FILTER (WHERE NOT bad AND NOT loop AND none) AS n_no_weight,
             max(src) FILTER (WHERE NOT bad) AS max_src FROM e)
SELECT name AS what, CAST(value AS BIGINT) AS n FROM (UNPIVOT (
  SELECT CAST(COLUMNS(*) AS BIGINT) FROM c) ON COLUMNS(*))
"""


def registry() -> dict[str, str]:
    return {
        "class_distribution": CLASS_DISTRIBUTION,
        "col_stats": COL_STATS,
        "corr_matrix": _corr_matrix(),
        "corr_pairwise": _corr_pairwise(),
        "describe_numeric": DESCRIBE_NUMERIC,
        "ingest_delimited": INGEST_DELIMITED,
        "ingest_file": INGEST_FILE,
        "ingest_header": INGEST_HEADER,
        "ingest_dirty": INGEST_DIRTY,
        "ingest_examples": INGEST_EXAMPLES,
        "ingest_charset": INGEST_PROFILE,
        "ingest_malformed": INGEST_MALFORMED,
        "ingest_profile": INGEST_PROFILE,
        "ingest_typed": INGEST_TYPED,
        "ingest_nulls": INGEST_NULLS,
        "ingest_table_sql": INGEST_TABLE_SQL,
        "parse_points": PARSE_POINTS,
        "parse_points_semicolon": PARSE_POINTS_SEMICOLON,
        "strip_accents": STRIP_ACCENTS,
        "libsvm_roundtrip": LIBSVM_ROUNDTRIP,
        "libsvm_dirty": LIBSVM_DIRTY,
        "zip_predictions": CONFUSION,
        "hash_split": HASH_SPLIT,
        "random_split": RANDOM_SPLIT,
        "sample_rows": SAMPLE_ROWS,
        "sample_copies": SAMPLE_COPIES,
        "split_copies": SPLIT_COPIES,
        "confusion_matrix": CONFUSION,
        "confusion_one_vs_rest": CONFUSION_ONE_VS_REST,
        "metrics_per_class": METRICS_PER_CLASS,
        "metrics_macro": METRICS_MACRO,
        "accuracy_error": ACCURACY_ERROR,
        "multilabel_metrics": MULTILABEL_METRICS,
        "index_label": INDEX_LABEL,
        "index_features": INDEX_FEATURES,
        "nb_parameters": NB_PARAMETERS,
        "nb_classify": NB_CLASSIFY,
        "show_predictions": SHOW_PREDICTIONS,
        "nb_one_based": NB_ONE_BASED,
        "dt_stump": DT_STUMP,
        "tree_text": TREE_TEXT,
        "dt_classify": DT_CLASSIFY,
        "dt_exact": DT_EXACT,
        "gbt_classify": GBT_CLASSIFY,
        "gbt_stump": GBT_STUMP,
        "gbt_unseen": GBT_UNSEEN,
        "rf_classify": RF_CLASSIFY,
        "rf_one_tree": ALL_SAME,
        "mlp_classify": MLP_CLASSIFY,
        "lr_elastic_net": LR_ELASTIC_NET,
        "svm_linear": SVM_LINEAR,
        "model_roundtrip": MODEL_ROUNDTRIP,
        "lr_saturated": LR_SATURATED,
        "assign_nearest_centroid": ASSIGN_NEAREST_CENTROID,
        "assign_many": ASSIGN_MANY,
        "wssse": WSSSE,
        "cluster_label_counts": CLUSTER_LABEL_COUNTS,
        "cluster_crosstab": _crosstab(range(10)),
        "kmeans_fit": KMEANS_FIT,
        "gmm_fit": GMM_FIT,
        "gmm_moments": _gmm_moments(),
        "pic_edges": PIC_EDGES,
        "pic_clusters": PIC_CLUSTERS,
        "edges_dropped": EDGES_DROPPED,
    }

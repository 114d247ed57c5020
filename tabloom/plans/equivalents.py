"""The same results as ANSI SQL, for the queries SQL can express on whole tables."""

from __future__ import annotations

from ..operators.evaluate import DEFAULT_THRESHOLDS

MASKED_LINEITEM = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity,
       CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice END AS l_extendedprice,
       l_discount, l_tax,
       CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS l_returnflag, l_linestatus
FROM lineitem"""
MASKED_ORDERS = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END AS o_orderpriority
FROM orders"""
MASKED_CUSTOMER = """
SELECT c_custkey, c_nationkey,
       CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS c_mktsegment
FROM customer"""
SHAPE = """
SELECT doc_id, lang, n_chars,
       length(text) - length(replace(text, ' ', '')) + 1 AS words,
       length(text) - length(replace(text, chr(10), '')) + 1 AS lines
FROM documents"""
LABELLED = f"SELECT s.*, l.quality, l.toxic FROM ({SHAPE}) s JOIN labels l USING (doc_id)"
SCORED = f"""
SELECT doc_id, quality AS label, (n_chars % 101) / 101.0::DOUBLE AS probability,
       (words % 53) / 53.0::DOUBLE AS other,
       CAST((n_chars % 101) / 101.0::DOUBLE >= 0.5 AS INTEGER) AS prediction,
       CAST(words % 2 AS INTEGER) AS second, CAST(doc_id % 5 AS INTEGER) AS fold
FROM ({LABELLED})"""


def percent(part: str, total: str) -> str:
    """Share in percent with two decimals, halves rounded up in whole numbers."""
    return f"((({part}) * 20000 + ({total})) // (2 * ({total}))) / 100.0::DOUBLE"


CUSTOMER_TEXT = """SELECT o_orderkey, CASE WHEN o_custkey % 11 <> 4 THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders"""


def with_tables(body: str, **tables: str) -> str:
    heads = ", ".join(f"{k} AS ({v})" for k, v in tables.items())
    return f"WITH {heads} {body}"


def _missing_report() -> str:
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    parts = [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS count, count(*) AS n FROM m" for c in names]
    body = " UNION ALL ".join(parts)
    return with_tables(
        f'SELECT "column", count, {percent("count", "n")} AS pct FROM ({body}) WHERE count > 0', m=MASKED_LINEITEM
    )


def _numeric_summary() -> str:
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
            round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
            round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
            round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM m"""
        for c in names
    ]
    return with_tables(" UNION ALL ".join(parts), m=MASKED_LINEITEM)


def _top5() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS count FROM part GROUP BY {c}"""
        for c in ("p_brand", "p_type", "p_name")
    ]
    return with_tables(
        """SELECT "column", "unique", CAST(rank AS INTEGER) AS rank, value, count FROM (
             SELECT *, count(*) OVER (PARTITION BY "column") AS "unique",
                    row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank FROM v)
           WHERE rank <= 5""",
        v=" UNION ALL ".join(parts),
    )


def _corr(a: str, b: str) -> str:
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


def _correlation_matrix(names: list[str], source: str) -> str:
    parts = [
        f"SELECT '{a}' AS \"column\", '{b}' AS other, round({_corr(a, b)}, 4) AS r FROM m"
        for a in names for b in names
    ]
    return with_tables(" UNION ALL ".join(parts), m=source)


def _embedding_correlation() -> str:
    return with_tables(
        """SELECT 'e' || a.i AS "column", 'e' || b.i AS other,
                  round(CASE WHEN isnan(corr(a.x, b.x)) THEN NULL ELSE corr(a.x, b.x) END, 4) AS r
           FROM v a JOIN v b USING (vec_id) GROUP BY a.i, b.i""",
        v="""SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x
             FROM embeddings, (SELECT unnest(range(64)) AS i)""",
    )


def _bounds(kind: str) -> str:
    iqr = """SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
                    avg(value) AS m, stddev_samp(value) AS s FROM events"""
    low = {"iqr": "q1 - 1.5 * (q3 - q1)", "zscore": "m - 3 * s"}
    high = {"iqr": "q3 + 1.5 * (q3 - q1)", "zscore": "m + 3 * s"}
    lo = low[kind] if kind != "both" else f"greatest({low['iqr']}, {low['zscore']})"
    hi = high[kind] if kind != "both" else f"least({high['iqr']}, {high['zscore']})"
    return f"SELECT {lo} AS lo, {hi} AS hi FROM ({iqr})"


def _bounds_frame(kind: str) -> str:
    return f"""SELECT 'value' AS "column", round(lo, 4) AS lower_bound, round(hi, 4) AS upper_bound
               FROM ({_bounds(kind)})"""


def _outlier_report() -> str:
    one = """SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
             avg({c}) AS m, stddev_samp({c}) AS s FROM events"""
    stats = " UNION ALL ".join(one.format(c=c) for c in ("event_id", "user_id", "value"))
    limits = f"""SELECT "column", greatest(q1 - 1.5 * (q3 - q1), m - 3 * s) AS lo,
                        least(q3 + 1.5 * (q3 - q1), m + 3 * s) AS hi FROM ({stats})"""
    cells = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS x FROM events""" for c in ("event_id", "user_id", "value")
    )
    counted = """SELECT "column", count(*) AS n, count(*) FILTER (WHERE x < lo OR x > hi) AS outliers,
                        any_value(lo) AS lo, any_value(hi) AS hi
                 FROM c JOIN b USING ("column") GROUP BY "column" """
    return with_tables(
        f"""SELECT "column", outliers, {percent("outliers", "n")} AS pct, round(lo, 4) AS lower_bound,
                   round(hi, 4) AS upper_bound FROM ({counted}) WHERE outliers > 0""",
        b=limits, c=cells,
    )


def _pair_strength() -> str:
    pairs = [("n_chars", "words"), ("n_chars", "lines"), ("words", "lines")]
    return " UNION ALL ".join(
        f"SELECT {i} AS seq, '{a}' AS col_a, '{b}' AS col_b, abs(corr({a}, {b})) AS r FROM s"
        for i, (a, b) in enumerate(pairs)
    )


def _collinear_choice() -> str:
    """With three columns the greedy choice is written out pair by pair."""
    return with_tables(
        """SELECT unnest(CASE
             WHEN ab > 0.85 AND ab + ac >= ab + bc THEN CASE WHEN bc > 0.85
                  THEN ['n_chars', CASE WHEN ab + bc >= ac + bc THEN 'words' ELSE 'lines' END] ELSE ['n_chars'] END
             WHEN ab > 0.85 THEN CASE WHEN ac > 0.85
                  THEN ['words', CASE WHEN ab + ac >= ac + bc THEN 'n_chars' ELSE 'lines' END] ELSE ['words'] END
             WHEN ac > 0.85 AND ab + ac >= ac + bc THEN CASE WHEN bc > 0.85
                  THEN ['n_chars', CASE WHEN ab + bc >= ac + bc THEN 'words' ELSE 'lines' END] ELSE ['n_chars'] END
             WHEN ac > 0.85 THEN ['lines']
             WHEN bc > 0.85 THEN [CASE WHEN ab + bc >= ac + bc THEN 'words' ELSE 'lines' END]
             ELSE [] END) AS "column" FROM r""",
        s=SHAPE,
        r="SELECT abs(corr(n_chars, words)) AS ab, abs(corr(n_chars, lines)) AS ac, abs(corr(words, lines)) AS bc FROM s",
    )


def _impute_knn() -> str:
    """All donors of every gap; categories by sorted position."""
    width, names = 3, ("x0", "x1", "x2")
    total = " + ".join(f"coalesce((t.{x} - d.{x}) * (t.{x} - d.{x}), 0)" for x in names)
    shared = " + ".join(f"CASE WHEN t.{x} IS NULL OR d.{x} IS NULL THEN 0 ELSE 1 END" for x in names)

    def fill(x: str) -> str:
        return f"""SELECT id, avg(v) AS v FROM (
            SELECT t.id, d.{x} AS v, row_number() OVER (
                       PARTITION BY t.id ORDER BY ({total}) * {width} / ({shared}), d.id) AS pos
            FROM e t JOIN e d ON t.{x} IS NULL AND d.{x} IS NOT NULL AND ({shared}) > 0) WHERE pos <= 5 GROUP BY id"""

    code = """SELECT c_mktsegment AS seg, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code
              FROM (SELECT DISTINCT c_mktsegment FROM m WHERE c_mktsegment IS NOT NULL)"""
    encoded = """SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS x0, c_acctbal AS x1, CAST(code AS DOUBLE) AS x2
                 FROM m LEFT JOIN k ON c_mktsegment = seg"""
    return with_tables(
        """SELECT e.id AS c_custkey, round(x0, 4) AS c_nationkey, round(coalesce(x1, f1.v), 4) AS c_acctbal,
                  seg AS c_mktsegment
           FROM e LEFT JOIN f1 ON e.id = f1.id LEFT JOIN f2 ON e.id = f2.id
           LEFT JOIN k ON k.code = greatest(round_even(coalesce(x2, f2.v), 0), 0)""",
        m=MASKED_CUSTOMER, k=code, e=encoded, f1=fill("x1"), f2=fill("x2"),
    )


PASSENGERS = """
SELECT c_custkey AS id,
       ['Mr', 'Mrs', 'Miss', 'Master', 'Dr', 'Sir', 'Xyz'][c_custkey % 7 + 1] AS title,
       CAST(c_nationkey % 3 + 1 AS INTEGER) AS Pclass,
       CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey * 7 % 80 AS DOUBLE) END AS Age,
       CAST(c_custkey % 3 AS INTEGER) AS SibSp, CAST(c_custkey % 2 AS INTEGER) AS Parch,
       CASE WHEN c_custkey % 13 <> 0 THEN abs(c_acctbal) END AS Fare,
       CASE WHEN c_custkey % 3 = 0 THEN substr(c_mktsegment, 1, 1) || c_custkey END AS Cabin
FROM customer"""
PASSENGER_STEPS = {
    "p": PASSENGERS,
    "g": """SELECT *, CASE title WHEN 'Dr' THEN 'Officer' WHEN 'Sir' THEN 'Noble' WHEN 'Xyz' THEN 'Rare'
                      ELSE title END AS TitleGroup, SibSp + Parch + 1 AS FamilySize,
                   Fare / (SibSp + Parch + 1) AS fpp FROM p""",
    "a": "SELECT TitleGroup, median(Age) AS med FROM g GROUP BY TitleGroup",
    "q": "SELECT Pclass, quantile_cont(fpp, 0.33) AS q33, quantile_cont(fpp, 0.66) AS q66 FROM g GROUP BY Pclass",
    "f": """SELECT g.*, coalesce(Age, med) AS filled,
                   CASE WHEN fpp IS NULL THEN 1 WHEN fpp <= q33 THEN 0 WHEN fpp <= q66 THEN 1 ELSE 2 END AS tier
            FROM g JOIN a USING (TitleGroup) JOIN q USING (Pclass)""",
    "o": """SELECT id, Pclass, round(filled, 4) AS Age, SibSp, Parch, TitleGroup,
                   CAST(Cabin IS NOT NULL AS INTEGER) AS CabinKnown, coalesce(substr(Cabin, 1, 1), 'U') AS CabinDeck,
                   FamilySize, round(fpp, 4) AS FarePerPerson, CAST(FamilySize = 1 AS INTEGER) AS IsAlone,
                   CASE WHEN filled >= 0 AND filled <= 12 THEN 'Child' WHEN filled <= 17 THEN 'Teen'
                        WHEN filled <= 35 THEN 'Adult' WHEN filled <= 60 THEN 'Middle'
                        WHEN filled <= 120 THEN 'Senior' END AS AgeGroup,
                   (Pclass - 1) * 3 + (2 - tier) + 1 AS SocialClass, fpp FROM f""",
}


def _passenger_report() -> str:
    parts = [
        f"""SELECT '{c}' AS section, CAST({c} AS VARCHAR) AS value, CAST(count(*) AS DOUBLE) AS number
            FROM o WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in ("TitleGroup", "AgeGroup", "SocialClass", "FamilySize", "IsAlone", "CabinKnown", "CabinDeck")
    ]
    parts.append("SELECT 'AgeImputationByTitle', TitleGroup, round(med, 1) FROM a")
    parts += [
        f"SELECT 'FarePerPerson', '{name}', round({f}(fpp), 2) FROM o"
        for name, f in (("mean", "avg"), ("min", "min"), ("max", "max"))
    ]
    return with_tables(" UNION ALL ".join(parts), **PASSENGER_STEPS)


def _fill_orders(number: str, status: str, priority: str) -> str:
    return with_tables(
        f"""SELECT o_orderkey, o_custkey, round(coalesce(o_totalprice, {number}), 4) AS o_totalprice,
                   coalesce(o_orderstatus, {status}) AS o_orderstatus,
                   coalesce(o_orderpriority, {priority}) AS o_orderpriority FROM m""",
        m=MASKED_ORDERS,
    )


def _mode(column: str, table: str = "m") -> str:
    return (
        f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


def _prepare_table() -> str:
    filled = """SELECT l_orderkey, l_linenumber,
                       coalesce(l_quantity, (SELECT median(l_quantity) FROM m)) AS q,
                       coalesce(l_extendedprice, (SELECT median(l_extendedprice) FROM m)) AS p,
                       l_discount AS d, l_tax AS t, coalesce(l_returnflag, 'unknown') AS f, l_linestatus AS s FROM m"""
    bounds = """SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
                  SELECT quantile_cont(p, 0.25) AS q1, quantile_cont(p, 0.75) AS q3 FROM i)"""
    clipped = "SELECT * REPLACE (least(greatest(p, lo), hi) AS p) FROM i, b"
    return with_tables(
        """SELECT l_orderkey, l_linenumber,
                  round((q - (SELECT avg(q) FROM c)) / (SELECT stddev_pop(q) FROM c), 4) AS l_quantity,
                  round((p - (SELECT avg(p) FROM c)) / (SELECT stddev_pop(p) FROM c), 4) AS l_extendedprice,
                  round((d - (SELECT avg(d) FROM c)) / (SELECT stddev_pop(d) FROM c), 4) AS l_discount,
                  round((t - (SELECT avg(t) FROM c)) / (SELECT stddev_pop(t) FROM c), 4) AS l_tax,
                  CAST(f = 'N' AS DOUBLE) AS "l_returnflag_N", CAST(f = 'R' AS DOUBLE) AS "l_returnflag_R",
                  CAST(f = 'unknown' AS DOUBLE) AS l_returnflag_unknown,
                  CAST(s = 'O' AS DOUBLE) AS "l_linestatus_O" FROM c""",
        m=MASKED_LINEITEM, i=filled, b=bounds, c=clipped,
    )


def _share_out(total: str, counts: str) -> str:
    """Rows per class by largest remainder, equal remainders in order of appearance."""
    return f"""SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, first) <= left_over THEN 1 ELSE 0 END AS train
        FROM (SELECT *, n * n_train // total AS base, n * n_train % total AS rem,
                     n_train - sum(n * n_train // total) OVER () AS left_over
              FROM (SELECT *, sum(n) OVER () AS total, sum(n) OVER () - {total} AS n_train FROM {counts}))"""


def _split_stratified() -> str:
    return with_tables(
        """SELECT quality, 0 AS is_test, CAST(train AS BIGINT) AS rows FROM t
           UNION ALL SELECT quality, 1, CAST(n - train AS BIGINT) FROM t""",
        c="SELECT quality, count(*) AS n, min(doc_id) AS first FROM labels GROUP BY quality",
        t=_share_out("CAST(ceil(0.2 * sum(n) OVER ()) AS BIGINT)", "c"),
    )


def _fold_counts(table: str, label: str, key: str, k: int = 5) -> dict[str, str]:
    """Rows of class c in fold i: how many places i, i+k, .. the class covers when sorted."""
    return {
        "c": f"SELECT {label} AS cls, count(*) AS n, min({key}) AS first FROM {table} GROUP BY {label}",
        "z": "SELECT *, sum(n) OVER (ORDER BY first, CAST(cls AS VARCHAR)) - n AS start FROM c",
        "s": f"""SELECT cls, i, CAST(greatest((start + n - i + {k - 1}) // {k}, 0)
                        - greatest((start - i + {k - 1}) // {k}, 0) AS BIGINT) AS size
                 FROM z, (SELECT unnest(range({k})) AS i)""",
    }


def _folds_of(source: str, table: str, label: str, key: str, out: str) -> str:
    """Folds by place in id order; ``source`` is a query of (key, label)."""
    return with_tables(
        out, **{table: source} if source else {}, **_fold_counts(table, label, key),
        e="SELECT cls, i, sum(size) OVER (PARTITION BY cls ORDER BY i) AS upto FROM s",
        l=f"SELECT {key}, {label}, row_number() OVER (PARTITION BY {label} ORDER BY {key}) AS pos FROM {table}",
        f=f"""SELECT {key}, {label}, pos, CAST(min(i) AS INTEGER) AS fold FROM l JOIN e ON cls = {label} AND pos <= upto
              GROUP BY {key}, {label}, pos""",
    )


def _folds_in_order() -> str:
    return with_tables(
        """SELECT doc_id, quality, CAST(min(i) AS INTEGER) AS fold FROM (
             SELECT *, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS pos FROM labels) l
           JOIN e ON cls = quality AND pos <= upto GROUP BY doc_id, quality""",
        **_fold_counts("labels", "quality", "doc_id"),
        e="SELECT cls, i, sum(size) OVER (PARTITION BY cls ORDER BY i) AS upto FROM s",
    )


REPORT_STEPS = {
    "d": SCORED,
    "k": "SELECT label AS c FROM d UNION SELECT prediction FROM d",
    "u": """SELECT CAST(c AS VARCHAR) AS cls, (SELECT count(*) FROM d WHERE label = c) AS support,
                   (SELECT count(*) FROM d WHERE prediction = c) AS predicted,
                   (SELECT count(*) FROM d WHERE prediction = c AND label = c) AS tp FROM k""",
    "r": """SELECT cls, support, tp, coalesce(tp / nullif(predicted, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r,
                   coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f FROM u""",
}


def _class_report() -> str:
    return with_tables(
        """SELECT cls AS "class", round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support FROM r
           UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM r
           UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(support) AS BIGINT) FROM r
           UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 4),
                            round(sum(r * support) / sum(support), 4), round(sum(f * support) / sum(support), 4),
                            CAST(sum(support) AS BIGINT) FROM r""",
        **REPORT_STEPS,
    )


def _binary_metrics() -> str:
    return with_tables(
        """SELECT (SELECT round(sum(tp) / sum(support), 4) FROM r) AS accuracy, round(p, 4) AS precision,
                  round(r, 4) AS recall, round(f, 4) AS f1_score FROM r WHERE cls = '1'""",
        **REPORT_STEPS,
    )


def _threshold_counts() -> dict[str, str]:
    marks = ", ".join(f"({t!r}::DOUBLE)" for t in DEFAULT_THRESHOLDS)
    return {
        "d": SCORED,
        "t": f"SELECT * FROM (VALUES {marks}) v(t)",
        "n": """SELECT t, count(*) FILTER (WHERE label = 1 AND probability >= t) AS tp,
                       count(*) FILTER (WHERE label <> 1 AND probability >= t) AS fp,
                       count(*) FILTER (WHERE label = 1 AND probability < t) AS fn,
                       count(*) FILTER (WHERE label <> 1 AND probability < t) AS tn FROM t, d GROUP BY t""",
    }


F1_WEIGHTED = """(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) * (tp + fn)
  + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) * (tn + fp)) / (tp + fp + fn + tn)"""

EVENT_STEPS = {
    "b": _bounds("iqr"),
    "c": "SELECT event_id, event_type, least(greatest(value, lo), hi) AS v FROM events, b",
    "k": """SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code
            FROM (SELECT DISTINCT event_type FROM events)""",
}


SMALL = f"SELECT doc_id, words % 7 AS x, quality AS y, CAST(doc_id % 5 AS INTEGER) AS fold FROM ({LABELLED})"


def _one_split(seen: str) -> dict[str, str]:
    """Per way `f` of leaving rows out, the cut of least impurity and the share of class 1 on either side. `seen`: rows (f, x, y)."""
    return {
        "d": SMALL, "t": seen,
        "c": """SELECT f, cut, count(*) FILTER (t.x <= cut) AS n1, coalesce(sum(y) FILTER (t.x <= cut), 0) AS s1,
                       count(*) FILTER (t.x > cut) AS n2, coalesce(sum(y) FILTER (t.x > cut), 0) AS s2
                FROM t, (SELECT DISTINCT x AS cut FROM d) GROUP BY f, cut""",
        "best": """SELECT f, cut, s1 / n1 AS p1, s2 / n2 AS p2 FROM c WHERE n1 > 0 AND n2 > 0
                   QUALIFY row_number() OVER (PARTITION BY f ORDER BY round(s1 * (n1 - s1) / n1 + s2 * (n2 - s2) / n2, 9), cut) = 1""",
    }


_ALL_SEEN, _FOLD_LEFT_OUT = "SELECT 0 AS f, x, y FROM d", "SELECT g.fold AS f, d.x, d.y FROM d JOIN (SELECT DISTINCT fold FROM d) g ON g.fold <> d.fold"


def _model_queries() -> dict[str, str]:
    p = "CASE WHEN d.x <= cut THEN p1 ELSE p2 END"
    side = "CASE WHEN x <= cut THEN -0.3 * gl / (hl + 1) ELSE -0.3 * gr / (hr + 1) END"
    return {
        "tree_one_split": with_tables(
            f"SELECT doc_id, round({p}, 6) AS probability, CAST({p} > 0.5 AS DOUBLE) AS prediction FROM d, best", **_one_split(_ALL_SEEN)),
        "oof_one_split": with_tables(
            f"SELECT doc_id, fold, round({p}, 6) AS probability, CAST({p} > 0.5 AS DOUBLE) AS prediction FROM d JOIN best ON best.f = d.fold",
            **_one_split(_FOLD_LEFT_OUT)),
        "search_one_split": with_tables(
            f"""SELECT round(avg(hit), 6) AS score, CAST(count(*) AS INTEGER) AS folds
                FROM (SELECT fold, avg(CAST(({p} > 0.5) = (y = 1) AS DOUBLE)) AS hit FROM d JOIN best ON best.f = d.fold GROUP BY fold)""",
            **_one_split(_FOLD_LEFT_OUT)),
        "boost_one_round": with_tables(
            f"SELECT doc_id, round(1 / (1 + exp(-(start + {side}))), 6) AS probability FROM d, m, best",
            d=SMALL, m="SELECT avg(y) AS p, ln(avg(y) / (1 - avg(y))) AS start FROM d",
            g="SELECT x, sum(p - y) AS g, sum(p * (1 - p)) AS h FROM d, m GROUP BY x",
            c="""SELECT a.x AS cut, coalesce(sum(b.g) FILTER (b.x <= a.x), 0) AS gl, coalesce(sum(b.h) FILTER (b.x <= a.x), 0) AS hl,
                        coalesce(sum(b.g) FILTER (b.x > a.x), 0) AS gr, coalesce(sum(b.h) FILTER (b.x > a.x), 0) AS hr FROM g a, g b GROUP BY a.x""",
            best="""SELECT * FROM c WHERE hl >= 1 AND hr >= 1
                    ORDER BY round(gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1), 9) DESC, cut LIMIT 1"""),
    }


def _pca_two_columns() -> str:
    """The first axis lies at half the angle of (variance difference, twice the covariance); the largest loading is positive."""
    sign = lambda big, other: f"CASE WHEN abs({big}) >= abs({other}) THEN sign({big}) ELSE sign({other}) END"
    return with_tables(
        f"""SELECT doc_id, round(({sign('u', 'v')}) * ((a - ma) * u + (b - mb) * v), 4) AS "PC1",
                   round(({sign('-v', 'u')}) * ((b - mb) * u - (a - ma) * v), 4) AS "PC2" FROM s, t""",
        s=f"SELECT doc_id, n_chars / 1000.0::DOUBLE AS a, words / 100.0::DOUBLE AS b FROM ({SHAPE})",
        r="SELECT avg(a) AS ma, avg(b) AS mb, atan2(2 * covar_samp(a, b), var_samp(a) - var_samp(b)) / 2 AS angle FROM s",
        t="SELECT ma, mb, cos(angle) AS u, sin(angle) AS v FROM r",
    )


def _collinear_drop_cells() -> str:
    cells = " UNION ALL ".join(f"""SELECT doc_id, '{c}' AS "column", CAST({c} AS DOUBLE) AS value FROM ({SHAPE})""" for c in ("n_chars", "words", "lines"))
    return f"""SELECT doc_id, "column", value FROM ({cells}) WHERE "column" NOT IN (SELECT "column" FROM ({_collinear_choice()}))"""


def equivalents() -> dict[str, str]:
    sql = {
        "records_out": """SELECT to_json({c_custkey: c_custkey, c_name: c_name, c_nationkey: c_nationkey,
            c_acctbal: c_acctbal, c_mktsegment: c_mktsegment})::VARCHAR AS record FROM customer""",
        "marker_normalize": """SELECT p_partkey, CASE WHEN p_partkey % 10 IN (0, 1) THEN NULL
            WHEN p_partkey % 10 = 2 THEN 'null' ELSE p_name END AS p_name, p_brand FROM part""",
        "drop_columns": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "drop_sparse": """SELECT o_orderkey, o_totalprice,
            CASE WHEN o_orderkey % 2 <> 0 THEN o_custkey END AS o_custkey FROM orders""",
        "features_only": "SELECT doc_id, quality FROM labels",
        "numeric_block_first": "SELECT p_partkey, p_size, p_retailprice, p_brand, p_type FROM part",
        "drop_missing_rows": """SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id)
            WHERE quality IS NOT NULL""",
        "derived_columns": """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
            l_quantity > 25 AS bulk FROM lineitem""",
        "missing_report": _missing_report(),
        "numeric_summary": _numeric_summary(),
        "categorical_top5": _top5(),
        "correlation_matrix": _correlation_matrix(
            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], MASKED_LINEITEM
        ),
        "correlation_embeddings": _embedding_correlation(),
        "target_correlation": with_tables(
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", round({_corr(c, 'quality')}, 4) AS r FROM m"
                for c in ("n_chars", "words", "lines", "toxic")
            ),
            m=LABELLED,
        ),
        "class_balance": f"""SELECT o_orderstatus AS "class", count(*) AS count,
            {percent("count(*)", "(SELECT count(*) FROM orders)")} AS pct FROM orders GROUP BY o_orderstatus""",
        "class_balance_unlabelled": f"""SELECT quality AS "class", count(*) AS count,
            {percent("count(*)", "(SELECT count(*) FROM documents)")} AS pct
            FROM documents JOIN labels USING (doc_id) GROUP BY quality""",
        "target_distribution": """SELECT o_orderstatus AS value, count(*) AS count,
            (SELECT count(*) FROM orders) AS rows, 4 AS features FROM orders GROUP BY o_orderstatus""",
        "value_counts": "SELECT l_linenumber AS value, count(*) AS count FROM lineitem GROUP BY l_linenumber",
        "group_median": with_tables(
            """SELECT l_returnflag, round(median(l_extendedprice), 4) AS median FROM m
               WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""", m=MASKED_LINEITEM,
        ),
        "group_terciles": with_tables(
            """SELECT l_linestatus, round(quantile_cont(l_extendedprice, 0.33), 4) AS q33,
                      round(quantile_cont(l_extendedprice, 0.66), 4) AS q66 FROM m GROUP BY l_linestatus""",
            m=MASKED_LINEITEM,
        ),
        "group_median_many": with_tables(
            "SELECT o_custkey, round(median(o_totalprice), 4) AS median FROM m GROUP BY o_custkey", m=MASKED_ORDERS
        ),
        "group_median_searched": with_tables(
            "SELECT o_custkey, round(median(o_totalprice), 4) AS median FROM m GROUP BY o_custkey", m=MASKED_ORDERS
        ),
        "global_median": with_tables("SELECT median(l_extendedprice) AS median FROM m", m=MASKED_LINEITEM),
        "column_spread": with_tables(
            """SELECT round(avg(o_totalprice), 2) AS mean, round(min(o_totalprice), 2) AS min,
                      round(max(o_totalprice), 2) AS max FROM m""", m=MASKED_ORDERS,
        ),
        "impute_median_unknown": _fill_orders("(SELECT median(o_totalprice) FROM m)", "'unknown'", "'unknown'"),
        "impute_mean_mode": _fill_orders(
            "(SELECT avg(o_totalprice) FROM m)", _mode("o_orderstatus"), _mode("o_orderpriority")
        ),
        "impute_numeric_mode": with_tables(
            f"""SELECT l_orderkey, l_linenumber, coalesce(l_quantity, {_mode("l_quantity")}) AS l_quantity, l_returnflag
                FROM m""", m=MASKED_LINEITEM,
        ),
        "impute_group_median": with_tables(
            """SELECT c_custkey, c_nationkey, m.c_mktsegment,
                      round(coalesce(c_acctbal, CASE WHEN g.c_mktsegment IS NOT NULL THEN med
                            ELSE (SELECT median(c_acctbal) FROM k) END), 4) AS c_acctbal
               FROM m LEFT JOIN g ON m.c_mktsegment = g.c_mktsegment""",
            m=MASKED_CUSTOMER,
            k="SELECT * FROM m WHERE c_mktsegment IS DISTINCT FROM 'MACHINERY'",
            g="""SELECT c_mktsegment, median(c_acctbal) AS med FROM k WHERE c_mktsegment IS NOT NULL
                 GROUP BY c_mktsegment""",
        ),
        "impute_knn": _impute_knn(),
        "outlier_bounds_iqr": _bounds_frame("iqr"),
        "outlier_bounds_zscore": _bounds_frame("zscore"),
        "outlier_bounds_both": _bounds_frame("both"),
        "outlier_clip": with_tables(
            """SELECT event_id, round(CASE WHEN value IS NOT NULL THEN least(greatest(value, lo), hi) END, 4) AS value
               FROM m, b""",
            m="SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events",
            b="""SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
                   SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM m)""",
        ),
        "outlier_report": _outlier_report(),
        "outlier_modified": with_tables(
            "SELECT count(*) FILTER (WHERE value < lo OR value > hi) AS modified FROM events, b", b=_bounds("iqr")
        ),
        "collinear_pairs": with_tables(
            "SELECT col_a, col_b, round(r, 4) AS r FROM p WHERE r > 0.8", s=SHAPE, p=_pair_strength()
        ),
        "collinear_choice": _collinear_choice(),
        "collinear_drop_cells": _collinear_drop_cells(),
        "pca_two_columns": _pca_two_columns(),
        **_model_queries(),
        "extract_and_map": r"""SELECT p_partkey, word, CASE word WHEN 'small' THEN 'compact' WHEN 'large' THEN 'bulky'
            WHEN 'red' THEN 'coloured' WHEN 'blue' THEN 'coloured' ELSE 'Rare' END AS kind
            FROM (SELECT p_partkey, nullif(trim(regexp_extract(p_name, '^(\w+)\s', 1)), '') AS word FROM part)""",
        "row_flags": with_tables(
            """SELECT o_orderkey, coalesce(CAST(o_orderstatus = 'O' AS INTEGER), 0) AS is_open,
                      CAST(o_totalprice IS NOT NULL AS INTEGER) AS price_known,
                      coalesce(nullif(substr(o_orderpriority, 1, 1), ''), 'U') AS priority_code FROM m""",
            m=MASKED_ORDERS,
        ),
        "row_arithmetic": """SELECT l_orderkey, l_linenumber, l_linenumber + l_quantity + 1 AS total,
            round(l_extendedprice / nullif(l_linenumber - 1, 0), 4) AS price_per_line FROM lineitem""",
        "cut_bins": """SELECT p_partkey, CASE WHEN p_size >= 1 AND p_size <= 12 THEN 'Child'
            WHEN p_size > 12 AND p_size <= 17 THEN 'Teen' WHEN p_size > 17 AND p_size <= 35 THEN 'Adult'
            WHEN p_size > 35 AND p_size <= 45 THEN 'Middle' END AS bin FROM part""",
        "tier_and_score": with_tables(
            """SELECT l_orderkey, l_linenumber, tier, (level - 1) * 3 + (2 - tier) + 1 AS score FROM (
                 SELECT x.*, CASE WHEN l_extendedprice IS NULL OR q33 IS NULL THEN 1 WHEN l_extendedprice <= q33 THEN 0
                        WHEN l_extendedprice <= q66 THEN 1 ELSE 2 END AS tier
                 FROM x LEFT JOIN q USING (level))""",
            m=MASKED_LINEITEM, x="SELECT *, l_linenumber % 3 + 1 AS level FROM m",
            q="""SELECT level, quantile_cont(l_extendedprice, 0.33) AS q33, quantile_cont(l_extendedprice, 0.66) AS q66
                 FROM x WHERE level < 3 GROUP BY level""",
        ),
        "passenger_features": with_tables("SELECT * EXCLUDE (fpp) FROM o", **PASSENGER_STEPS),
        "passenger_report": _passenger_report(),
        "scale_standard": with_tables(
            """SELECT l_orderkey, l_linenumber,
                 round((l_quantity - (SELECT avg(l_quantity) FROM m)) / (SELECT stddev_pop(l_quantity) FROM m), 4) AS l_quantity,
                 round((l_extendedprice - (SELECT avg(l_extendedprice) FROM m))
                       / (SELECT stddev_pop(l_extendedprice) FROM m), 4) AS l_extendedprice FROM m""",
            m=MASKED_LINEITEM,
        ),
        "scale_minmax": with_tables(
            """SELECT l_orderkey, l_linenumber,
                 round((l_quantity - (SELECT min(l_quantity) FROM m))
                       / (SELECT max(l_quantity) - min(l_quantity) FROM m), 4) AS l_quantity,
                 round((l_tax - (SELECT min(l_tax) FROM m)) / (SELECT max(l_tax) - min(l_tax) FROM m), 4) AS l_tax FROM m""",
            m=MASKED_LINEITEM,
        ),
        "onehot": with_tables(
            """SELECT o_orderkey, CAST(coalesce(o_orderstatus = 'O', false) AS DOUBLE) AS "o_orderstatus_O",
                      CAST(coalesce(o_orderstatus = 'P', false) AS DOUBLE) AS "o_orderstatus_P",
                      CAST(o_orderstatus IS NULL AS DOUBLE) AS o_orderstatus_nan FROM m""", m=MASKED_ORDERS,
        ),
        "ordinal": with_tables(
            """SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 WHEN 'F' THEN -1 END AS DOUBLE)
               AS o_orderstatus FROM m""", m=MASKED_ORDERS,
        ),
        "label_roundtrip": """SELECT o_orderkey, o_orderpriority,
            CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS code, o_orderpriority AS decoded FROM orders""",
        "ordinal_many": with_tables(
            """SELECT o_orderkey, CASE WHEN d.customer IS NOT NULL THEN coalesce(code, -1) END AS customer
               FROM d LEFT JOIN k ON d.customer = k.customer""", d=CUSTOMER_TEXT,
            k="""SELECT customer, CAST(row_number() OVER (ORDER BY customer) - 1 AS DOUBLE) AS code
                 FROM (SELECT DISTINCT customer FROM d WHERE o_orderkey % 5 <> 0 AND customer IS NOT NULL)""",
        ),
        "label_many": with_tables(
            """SELECT o_orderkey, d.customer, code, d.customer AS decoded FROM d LEFT JOIN k ON d.customer = k.customer""",
            d=CUSTOMER_TEXT,
            k="""SELECT customer, CAST(row_number() OVER (ORDER BY customer) - 1 AS DOUBLE) AS code
                 FROM (SELECT DISTINCT customer FROM d WHERE customer IS NOT NULL)""",
        ),
        "map_many": with_tables(
            """SELECT o_orderkey, customer, coalesce(c_mktsegment, 'none') AS segment FROM d
               LEFT JOIN customer c ON d.customer = CAST(c_custkey AS VARCHAR) AND c_custkey % 2 = 0""", d=CUSTOMER_TEXT,
        ),
        "prepare_table": _prepare_table(),
        "split_stratified": _split_stratified(),
        "split_plain": """SELECT 0 AS is_test, n - CAST(ceil(0.2 * n) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM orders)
            UNION ALL SELECT 1, CAST(ceil(0.2 * n) AS BIGINT) FROM (SELECT count(*) AS n FROM orders)""",
        "folds_in_order": _folds_in_order(),
        "folds_shuffled": with_tables(
            "SELECT cls AS o_orderstatus, CAST(i AS INTEGER) AS fold, size AS rows FROM s",
            **_fold_counts("orders", "o_orderstatus", "o_orderkey"),
        ),
        "folds_many": _folds_of("", "orders", "o_custkey", "o_orderkey", "SELECT o_orderkey, o_custkey, fold FROM f"),
        "folds_text_ids": _folds_of(
            "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority FROM orders", "t", "o_orderpriority", "order_id",
            "SELECT order_id, o_orderpriority, fold FROM f"),
        "folds_repeated_ids": _folds_of(
            "", "lineitem", "l_returnflag", "l_orderkey",
            "SELECT l_orderkey, l_returnflag, fold, count(*) AS rows FROM f GROUP BY l_orderkey, l_returnflag, fold"),
        "confusion": with_tables(
            "SELECT label, prediction, count(*) AS count FROM d GROUP BY label, prediction", d=SCORED
        ),
        "class_report": _class_report(),
        "binary_metrics": _binary_metrics(),
        "threshold_scan": with_tables(
            """SELECT round(t, 2) AS threshold, tp, fp, fn, tn,
                      round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS score FROM n""",
            **_threshold_counts(),
        ),
        "best_threshold": with_tables(
            f"""SELECT round(t, 2) AS threshold, round({F1_WEIGHTED}, 4) AS score FROM n
                ORDER BY round({F1_WEIGHTED}, 4) DESC, t LIMIT 1""", **_threshold_counts(),
        ),
        "fold_accuracy": with_tables(
            """SELECT count(*) AS folds, round(avg(a), 4) AS mean, round(stddev_pop(a), 4) AS std FROM (
                 SELECT avg(CAST(label = prediction AS DOUBLE)) AS a FROM d GROUP BY fold)""", d=SCORED,
        ),
        "vote_soft": with_tables(
            """SELECT doc_id, CAST(probability * (2.0::DOUBLE / 3) + other * (1.0::DOUBLE / 3) >= 0.5 AS INTEGER) AS vote
               FROM d""", d=SCORED,
        ),
        "vote_hard": with_tables(
            "SELECT doc_id, CAST(prediction * 0.5 + second * 0.5 >= 0.5 AS INTEGER) AS vote FROM d", d=SCORED
        ),
        "leaderboard": with_tables(
            """SELECT *, row_number() OVER (PARTITION BY base ORDER BY score DESC, seq) = 1 AS best_of_base FROM (
                 SELECT lang AS base, 0 AS seq, 'prediction' AS model,
                        round(avg(CAST(label = prediction AS DOUBLE)), 6) AS score FROM j GROUP BY lang
                 UNION ALL SELECT lang, 1, 'second', round(avg(CAST(label = second AS DOUBLE)), 6) FROM j GROUP BY lang)""",
            d=SCORED, j="SELECT d.*, lang FROM d JOIN documents USING (doc_id)",
        ),
        "stream_prepared": with_tables(
            """SELECT event_id, CAST(code AS DOUBLE) AS event_type,
                      round((v - (SELECT avg(v) FROM c)) / (SELECT stddev_pop(v) FROM c), 4) AS value
               FROM c JOIN k USING (event_type)""", **EVENT_STEPS,
        ),
    }
    return sql

"""Queries for least squares, ridge, cross-validation, scoring and metrics.

Regression tables: ``li_reg`` (lineitem: quantity, discount, tax -> price) and
``ev_reg`` (event windows: mean and std of the window -> next value).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.functions import arrays as A
from pulsegrid.operators import folds as FO
from pulsegrid.operators.linear import fit_ols, fit_ridge, predict, ridge_cv
from pulsegrid.operators.metrics import mae, nmae, nmse
from pulsegrid.operators.windows import with_row_index
from pulsegrid.plans.output import sql_round as R
from pulsegrid.plans.q_stats import EV
from pulsegrid.plans.registry import register
from pulsegrid.plans.sqlsolve import ridge_solution, scatter_select
from pulsegrid.sources.tables import LI_FEATURES, ev_windows, li_reg, table

SEED = 42
K = 3
# Fixed grid of the cross-validation queries, as raw text (kept for output).
GRID_RAW = ("0", "0.1", "1", "10", "1e2")
GRID = [(r, float(r)) for r in GRID_RAW]
RIDGE_LAMBDA = 10.0
# Fold ends as shares of the row count (rows past the last end are in no fold).
RANGE_SHARES = (0.2, 0.4, 0.6, 0.8, 0.95)


def range_ends(n: int) -> list[int]:
    return [int(n * share + 1e-9) for share in RANGE_SHARES]


def range_case(idx: str = "idx", n: str = "n") -> str:
    """SQL CASE giving the fold of a row index among ``n`` rows."""
    return "CASE " + " ".join(f"WHEN {idx} < floor({n} * {f}) THEN {k}" for k, f in enumerate(RANGE_SHARES)) + " END"


def ev_reg(spark, sf_dir):
    w = ev_windows(spark, sf_dir).filter(F.col("y").isNotNull())
    return w.select("window_id", "subject", "blk",
                    F.array(A.arr_mean("x"), A.arr_std("x")).alias("features"), "y",
                    FO.fold_expr("window_id", K, SEED).alias("fold"))


# ---------------------------------------------------------------- SQL pieces
LI_SQL = "WITH d AS (SELECT l_quantity AS x0, l_discount AS x1, l_tax AS x2, l_extendedprice AS y FROM lineitem)\n"

EVREG_SQL = EV.replace("ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),",
                       "ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),\n"
                       "nxt AS (SELECT user_id * 4294967296 + blk - 1 AS window_id, v AS y FROM c WHERE i = 0 AND blk > 0),") + \
    """, d AS (SELECT window_id, avg(v) AS x0, stddev_pop(v) AS x1, any_value(y) AS y,
       ('0x' || substr(md5(concat('42:', window_id::VARCHAR)), 1, 8))::BIGINT % 3 AS fold
   FROM ev JOIN nxt USING (window_id) GROUP BY window_id)
"""


def _weights_sql(head, k, lam="0"):
    w, b = ridge_solution(k, lam)
    sel = [f"SELECT 0 AS pos, {R(b)} AS weight FROM s"]
    sel += [f"SELECT {i + 1} AS pos, {R(w[i])} AS weight FROM s" for i in range(k)]
    return head + f", s AS (SELECT {scatter_select([f'x{i}' for i in range(k)], 'y')} FROM d)\n" + \
        "\nUNION ALL ".join(sel)


def _weights_df(spark, model):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.weights())], "pos int, weight double")


@register("ols_weights", _weights_sql(LI_SQL, 3))
def q_ols(spark, sf_dir):
    """M1 + K2: least squares on lineitem (intercept first)."""
    m = fit_ols(li_reg(spark, sf_dir), "features", "y", LI_FEATURES)
    return _weights_df(spark, m)


@register("ols_weights_windows", _weights_sql(EVREG_SQL, 2))
def q_ols_windows(spark, sf_dir):
    """M1 on window statistics (mean, std) -> next value."""
    m = fit_ols(ev_reg(spark, sf_dir), "features", "y")
    return _weights_df(spark, m)


@register("ridge_weights", _weights_sql(LI_SQL, 3, str(RIDGE_LAMBDA)))
def q_ridge(spark, sf_dir):
    """M2: ridge (lambda = 10, intercept free) on lineitem."""
    m = fit_ridge(li_reg(spark, sf_dir), "features", "y", RIDGE_LAMBDA)
    return _weights_df(spark, m)


def _cv_sql(tail):
    w, b = ridge_solution(2, "g.lam")
    return EVREG_SQL + f""", g AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{r}', {float(r)})" for i, r in enumerate(GRID_RAW))}) t(pos, raw, lam)),
fk AS (SELECT DISTINCT fold AS k FROM d),
tr AS (SELECT fk.k, {scatter_select(['d.x0', 'd.x1'], 'd.y')} FROM fk JOIN d ON d.fold <> fk.k GROUP BY fk.k),
sol AS (SELECT g.pos, g.raw, g.lam, tr.k, {w[0]} AS w0, {w[1]} AS w1, {b.replace('my', 'tr.my').replace('m0', 'tr.m0').replace('m1', 'tr.m1')} AS b
        FROM tr, g),
va AS (SELECT sol.pos, sol.raw, sol.k,
              sum(power(d.y - sol.b - sol.w0 * d.x0 - sol.w1 * d.x1, 2)) AS sse,
              sum(power(d.y - yb.ym, 2)) AS sst
       FROM sol JOIN d ON d.fold = sol.k JOIN (SELECT fold, avg(y) AS ym FROM d GROUP BY fold) yb ON yb.fold = sol.k
       GROUP BY sol.pos, sol.raw, sol.k),
cv AS (SELECT pos, raw, avg(sse / sst) AS err FROM va GROUP BY pos, raw)
{tail}"""


@register("ridge_cv_errors", _cv_sql(f"SELECT pos, raw, {R('err')} AS err FROM cv"))
def q_ridge_cv(spark, sf_dir):
    """M2 + E4 + E5 + E8: mean validation NMSE per lambda over 3 seeded folds (one scan)."""
    rows, means, best, model = ridge_cv(ev_reg(spark, sf_dir), "features", "y", "fold", GRID)
    return spark.createDataFrame([(i, GRID[i][0], float(e)) for i, e in enumerate(means)],
                                 "pos int, raw string, err double")


@register("ridge_cv_best", _cv_sql("SELECT arg_min(raw, (err, pos)) AS best FROM cv"))
def q_ridge_best(spark, sf_dir):
    """E7 + K3: best lambda as its raw text (strictly smaller mean wins, first on ties)."""
    rows, means, best, model = ridge_cv(ev_reg(spark, sf_dir), "features", "y", "fold", GRID)
    return spark.createDataFrame([(best[0],)], "best string")


def _li_pred_sql():
    w, b = ridge_solution(3)
    return LI_SQL.replace("l_extendedprice AS y", "l_extendedprice AS y, l_orderkey, l_linenumber, l_partkey, l_suppkey") + \
        f""", s AS (SELECT {scatter_select(['x0', 'x1', 'x2'], 'y')} FROM d),
c AS (SELECT {b} AS b, {w[0]} AS w0, {w[1]} AS w1, {w[2]} AS w2 FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {R('b + w0 * x0 + w1 * x1 + w2 * x2')} AS prediction
FROM d, c"""


@register("predict", _li_pred_sql())
def q_predict(spark, sf_dir):
    """M6: intercept + X·w on every lineitem row with the least-squares weights."""
    d = li_reg(spark, sf_dir)
    m = fit_ols(d, "features", "y")
    return predict(d, m, "features").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "prediction")


def _li_scored(spark, sf_dir):
    d = li_reg(spark, sf_dir)
    return predict(d, fit_ols(d, "features", "y"), "features")


def _metric_sql(expr):
    w, b = ridge_solution(3)
    return LI_SQL + f""", s AS (SELECT {scatter_select(['x0', 'x1', 'x2'], 'y')} FROM d),
c AS (SELECT {b} AS b, {w[0]} AS w0, {w[1]} AS w1, {w[2]} AS w2 FROM s),
p AS (SELECT y, b + w0 * x0 + w1 * x1 + w2 * x2 AS p FROM d, c),
yb AS (SELECT avg(y) AS ym FROM d)
SELECT {expr} FROM p, yb"""


@register("metric_nmse", _metric_sql(f"count(*) AS n, {R('sum(power(y - p, 2)) / sum(power(y - ym, 2))')} AS nmse"))
def q_nmse(spark, sf_dir):
    """E1 on the least-squares predictions of lineitem."""
    return nmse(_li_scored(spark, sf_dir), "y", "prediction")


@register("metric_nmae", _metric_sql(f"count(*) AS n, {R('sum(abs(y - p)) / sum(abs(y - ym))')} AS nmae"))
def q_nmae(spark, sf_dir):
    """E2 on the least-squares predictions of lineitem."""
    return nmae(_li_scored(spark, sf_dir), "y", "prediction")


@register("metric_mae", _metric_sql(f"{R('avg(abs(y - p))')} AS mae"))
def q_mae(spark, sf_dir):
    """E3 on the least-squares predictions of lineitem."""
    return mae(_li_scored(spark, sf_dir), "y", "prediction")


@register("metric_nmse_by_fold", EVREG_SQL + f""", yb AS (SELECT fold, avg(y) AS ym FROM d GROUP BY fold)
SELECT d.fold::BIGINT AS fold, count(*) AS n, {R('sum(power(d.y - d.x0, 2)) / sum(power(d.y - yb.ym, 2))')} AS nmse
FROM d JOIN yb USING (fold) GROUP BY d.fold""")
def q_nmse_by_fold(spark, sf_dir):
    """E1 per group (ȳ of each fold): the window mean as the prediction of the next value."""
    d = ev_reg(spark, sf_dir).withColumn("p", F.col("features")[0])
    return nmse(d, "y", "p", by=["fold"])


@register("fold_assign", EVREG_SQL + """SELECT fold::BIGINT AS fold, count(*) AS n FROM d GROUP BY fold""")
def q_folds(spark, sf_dir):
    """E5: seeded 3-fold ids from md5(seed:key); fold sizes."""
    return ev_reg(spark, sf_dir).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("row_index", """SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events""")
def q_row_index(spark, sf_dir):
    """Contiguous row index in (ts, event_id) order."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return with_row_index(ev, ["ts", "event_id"]).select("event_id", "row_index")


@register("fold_ranges", f"""WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx,
                                                 count(*) OVER () AS n FROM events)
SELECT {range_case()} AS fold, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
FROM r GROUP BY 1""")
def q_fold_ranges(spark, sf_dir):
    """Fold ranges by cumulative ends over the event index; the rest in no fold."""
    ev = with_row_index(table(spark, sf_dir, "events").select("event_id"), ["event_id"], "idx")
    f = ev.withColumn("fold", FO.range_fold_expr("idx", range_ends(ev.count())))
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"),
                                 F.max("event_id").alias("last_event"))


def _cv_ranges_sql():
    w, b = ridge_solution(2, "g.lam")
    case = " ".join(f"WHEN idx < floor(n * {f}) THEN {k}" for k, f in enumerate(RANGE_SHARES))
    return EVREG_SQL + f""", dr AS (SELECT window_id, x0, x1, y, CASE {case} END AS fold
       FROM (SELECT *, row_number() OVER (ORDER BY window_id) - 1 AS idx, count(*) OVER () AS n FROM d) t),
g AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{r}', {float(r)})" for i, r in enumerate(GRID_RAW))}) t(pos, raw, lam)),
fk AS (SELECT DISTINCT fold AS k FROM dr WHERE fold IS NOT NULL),
tr AS (SELECT fk.k, {scatter_select(['dr.x0', 'dr.x1'], 'dr.y')} FROM fk JOIN dr ON dr.fold IS NULL OR dr.fold <> fk.k
       GROUP BY fk.k),
sol AS (SELECT g.pos, g.raw, g.lam, tr.k, {w[0]} AS w0, {w[1]} AS w1,
               {b.replace('my', 'tr.my').replace('m0', 'tr.m0').replace('m1', 'tr.m1')} AS b FROM tr, g),
va AS (SELECT sol.pos, sol.raw, sol.k, sum(power(dr.y - sol.b - sol.w0 * dr.x0 - sol.w1 * dr.x1, 2)) AS sse,
              sum(power(dr.y - yb.ym, 2)) AS sst
       FROM sol JOIN dr ON dr.fold = sol.k JOIN (SELECT fold, avg(y) AS ym FROM dr GROUP BY fold) yb ON yb.fold = sol.k
       GROUP BY sol.pos, sol.raw, sol.k)
SELECT pos::BIGINT AS pos, raw, k::BIGINT AS fold, {R('sse / sst')} AS nmse FROM va"""


@register("ridge_cv_ranges", _cv_ranges_sql())
def q_ridge_cv_ranges(spark, sf_dir):
    """E4 with given fold ranges (cumulative ends) over the window index; rows
    past the last end always train."""
    d = with_row_index(ev_reg(spark, sf_dir).drop("fold"), ["window_id"], "idx")
    n = d.count()
    d = d.withColumn("fold", FO.range_fold_expr("idx", [int(np.floor(n * f)) for f in RANGE_SHARES]))
    rows, means, best, model = ridge_cv(d, "features", "y", "fold", GRID)
    return spark.createDataFrame([(r[0], r[1], r[3], r[4]) for r in rows], "pos int, raw string, fold int, nmse double")

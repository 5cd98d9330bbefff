"""The flagship plan (build-plan slice 1) and the end-to-end protocol queries.

Flagship: events -> 16-sample windows per user (W0) -> mean, std, IQR and zero
crossings per window (A1, A2, A9, A16) -> least squares on those four (M1)
-> predictions (M6) for every labelled window.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import arrays as A
from pulsegrid.operators.linear import fit_ols, predict
from pulsegrid.plans.output import sql_round as R
from pulsegrid.plans.q_models import EVREG_SQL
from pulsegrid.plans.registry import register
from pulsegrid.plans.sqlsolve import ridge_solution, scatter_select
from pulsegrid.sources.tables import ev_windows

FLAGSHIP_NAMES = ["mean", "std", "iqr", "zcross"]


def flagship_table(spark, sf_dir):
    w = ev_windows(spark, sf_dir).filter(F.col("y").isNotNull())
    return w.select("window_id", F.array(A.arr_mean("x"), A.arr_std("x"), A.arr_iqr("x"),
                                         A.arr_zero_crossings("x")).alias("features"), "y")


def flagship(spark, sf_dir):
    d = flagship_table(spark, sf_dir)
    m = fit_ols(d, "features", "y", FLAGSHIP_NAMES)
    return predict(d, m, "features").select("window_id", "y", "prediction")


def _flagship_sql():
    w, b = ridge_solution(4)
    src = EVREG_SQL.replace(
        "SELECT window_id, avg(v) AS x0, stddev_pop(v) AS x1, any_value(y) AS y,",
        "SELECT window_id, avg(v) AS x0, stddev_pop(v) AS x1, "
        "quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS x2, any_value(zc) AS x3, any_value(y) AS y,")
    src = src.replace("FROM ev JOIN nxt USING (window_id) GROUP BY window_id)",
                      "FROM ev JOIN nxt USING (window_id) JOIN zcs USING (window_id) GROUP BY window_id)")
    src = src.replace(", d AS (", """, zcs AS (SELECT window_id, count(*) FILTER (WHERE (v - m) * (v1 - m) < 0)::DOUBLE AS zc
        FROM evm GROUP BY window_id),
d AS (""", 1)
    return src + f""", s AS (SELECT {scatter_select(['x0', 'x1', 'x2', 'x3'], 'y')} FROM d),
coef AS (SELECT {b} AS b, {w[0]} AS w0, {w[1]} AS w1, {w[2]} AS w2, {w[3]} AS w3 FROM s)
SELECT window_id, {R('y')} AS y, {R('b + w0 * x0 + w1 * x1 + w2 * x2 + w3 * x3')} AS prediction FROM d, coef"""


@register("flagship_window_model", _flagship_sql())
def q_flagship(spark, sf_dir):
    """W0 -> A1/A2/A9/A16 -> M1 -> M6: least squares on four window statistics."""
    return flagship(spark, sf_dir)

"""Queries for the per-window statistics (inventory 2.4, P13, W0).

Spark side: array higher-order functions from ``pulsegrid.functions.arrays`` on
windows cut from ``events`` / taken from ``embeddings``.  SQL side: the same
windows in long form (one row per sample) with aggregates and lead/lag.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import arrays as A
from pulsegrid.plans.output import sql_round as R
from pulsegrid.plans.registry import register
from pulsegrid.sources.tables import emb_axes, emb_windows, ev_windows

# ---------------------------------------------------------------- SQL long forms
EV = """WITH r AS (
  SELECT user_id, value AS v,
         CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END AS vn,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn
  FROM events),
c AS (SELECT user_id, rn // 16 AS blk, rn % 16 AS i, v, vn,
             count(*) OVER (PARTITION BY user_id, rn // 16) AS cnt FROM r),
ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),
evm AS (SELECT *, avg(v) OVER w AS m, stddev_pop(v) OVER w AS s,
               avg(vn) FILTER (WHERE NOT isnan(vn)) OVER w AS mn,
               lead(v) OVER wo AS v1, lead(v, 2) OVER wo AS v2, lag(v) OVER wo AS vp,
               lead(vn) OVER wo AS vn1, lag(vn) OVER wo AS vnp
        FROM ev WINDOW w AS (PARTITION BY window_id), wo AS (PARTITION BY window_id ORDER BY i))
"""

EMB = """WITH emb AS (
  SELECT vec_id AS window_id, label::DOUBLE AS y, unnest(embedding)::DOUBLE AS v,
         unnest(range(len(embedding))) AS i
  FROM embeddings),
embm AS (SELECT *, avg(v) OVER w AS m, stddev_pop(v) OVER w AS s, count(*) OVER w AS n
         FROM emb WINDOW w AS (PARTITION BY window_id))
"""

AXES = """WITH e AS (
  SELECT vec_id AS window_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS k
  FROM embeddings),
ax AS (SELECT a.window_id, a.k AS j, a.v AS x, b.v AS y, c.v AS z
       FROM e a JOIN e b ON b.window_id = a.window_id AND b.k = 63 - a.k
                JOIN e c ON c.window_id = a.window_id AND c.k = (a.k + 21) % 64)
"""


def _ev(spark, sf_dir):
    return ev_windows(spark, sf_dir)


def _one(name, spark_expr, table="ev"):
    def build(spark, sf_dir):
        w = ev_windows(spark, sf_dir) if table == "ev" else emb_windows(spark, sf_dir)
        return w.select("window_id", spark_expr().alias(name))
    return build


def _simple(qname, col, spark_expr, sql_agg, table="ev", where=""):
    src = "ev" if table == "ev" else "emb"
    head = EV if table == "ev" else EMB
    sql = f"{head}SELECT window_id, {R(sql_agg)} AS {col} FROM {src} {where} GROUP BY window_id"
    register(qname, sql)(_one(col, spark_expr, table))


# ---------------------------------------------------------------- W0
@register("cut_windows", EV + """SELECT window_id, i AS pos, """ + R("v") + """ AS value FROM ev""")
def q_cut_windows(spark, sf_dir):
    """Events -> 16-sample windows per user in (ts, event_id) order, long form."""
    w = ev_windows(spark, sf_dir)
    return w.select("window_id", F.posexplode("x").alias("pos", "value"))


@register("window_labels", EV.replace("ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),",
                                       "ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),\n"
                                       "nxt AS (SELECT user_id * 4294967296 + blk - 1 AS window_id, v AS y FROM c WHERE i = 0 AND blk > 0),")
          + """SELECT DISTINCT ev.window_id, """ + R("nxt.y") + """ AS y FROM ev JOIN nxt USING (window_id)""")
def q_window_labels(spark, sf_dir):
    """W0 label: value of the event right after each window (windows without one dropped)."""
    return ev_windows(spark, sf_dir).filter(F.col("y").isNotNull()).select("window_id", "y")


# ---------------------------------------------------------------- simple moments (flavour C on x)
_simple("stat_mean", "mean", lambda: A.arr_mean("x"), "avg(v)")
_simple("stat_var", "var", lambda: A.arr_var("x"), "var_pop(v)")
_simple("stat_std", "std", lambda: A.arr_std("x"), "stddev_pop(v)")
_simple("stat_min", "min", lambda: A.arr_min("x"), "min(v)")
_simple("stat_max", "max", lambda: A.arr_max("x"), "max(v)")
_simple("stat_range", "range", lambda: A.arr_range("x"), "max(v) - min(v)")
_simple("stat_rms", "rms", lambda: A.arr_rms("x"), "sqrt(avg(v * v))")
_simple("stat_energy", "energy", lambda: A.arr_energy("x"), "sum(v * v)")
_simple("stat_percentile90", "p90", lambda: A.arr_percentile("x", 90), "quantile_cont(v, 0.9)")
_simple("stat_iqr", "iqr", lambda: A.arr_iqr("x"), "quantile_cont(v, 0.75) - quantile_cont(v, 0.25)")
_simple("stat_p90_p10", "p90_p10", lambda: A.arr_p90_p10("x"), "quantile_cont(v, 0.9) - quantile_cont(v, 0.1)")
_simple("stat_skew_corrected", "skew", lambda: A.arr_skew("x", "corrected"), "skewness(v)")
_simple("stat_kurt_corrected", "kurt", lambda: A.arr_kurt("x", "corrected"), "kurtosis(v)")
_simple("stat_cv", "cv", lambda: A.arr_cv("x"), "stddev_pop(v) / (avg(v) + 1e-7)")

# flavour D (NaN skipped) on x_nan
_NN = "FILTER (WHERE NOT isnan(vn))"
_simple("stat_mean_skipnan", "mean", lambda: A.arr_mean("x_nan", "skip"), f"avg(vn) {_NN}")
_simple("stat_std_skipnan", "std", lambda: A.arr_std("x_nan", "skip"), f"stddev_pop(vn) {_NN}")
_simple("stat_min_skipnan", "min", lambda: A.arr_min("x_nan", "skip"), f"min(vn) {_NN}")
_simple("stat_max_skipnan", "max", lambda: A.arr_max("x_nan", "skip"), f"max(vn) {_NN}")
_simple("stat_range_skipnan", "range", lambda: A.arr_range("x_nan", "skip"), f"max(vn) {_NN} - min(vn) {_NN}")
_simple("stat_iqr_skipnan", "iqr", lambda: A.arr_iqr("x_nan", "skip"),
        f"quantile_cont(vn, 0.75) {_NN} - quantile_cont(vn, 0.25) {_NN}")
_simple("stat_median", "median", lambda: A.arr_median("x_nan"), f"median(vn) {_NN}")
_simple("stat_rms_skipnan", "rms", lambda: A.arr_rms("x_nan", "skip"), f"sqrt(avg(vn * vn) {_NN})")
_simple("stat_energy_skipnan", "energy", lambda: A.arr_energy("x_nan", "skip"), f"sum(vn * vn) {_NN}")
_simple("stat_slope", "slope", lambda: A.arr_slope("x_nan"),
        "sum(CASE WHEN isnan(vn) THEN 0 ELSE vn END * (i - 7.5)) / 340.0")


# ---------------------------------------------------------------- centred moments
def _evm(qname, col, spark_expr, sql_agg, where=""):
    sql = f"{EV}SELECT window_id, {R(sql_agg)} AS {col} FROM evm {where} GROUP BY window_id"
    register(qname, sql)(_one(col, spark_expr))


_evm("stat_skew_eps", "skew", lambda: A.arr_skew("x", "eps"), "avg(power((v - m) / (s + 1e-7), 3))")
_evm("stat_kurt_eps", "kurt", lambda: A.arr_kurt("x", "eps"), "avg(power((v - m) / (s + 1e-7), 4))")
_evm("stat_mad", "mad", lambda: A.arr_mad("x"), "avg(abs(v - m))")
_evm("stat_vibration", "vibration", lambda: A.arr_vibration("x"), "sum(abs(v - m))")
_evm("stat_abs_diff_mean", "abs_diff_mean", lambda: A.arr_abs_diff_mean("x"), "avg(abs(v1 - v))")
_evm("stat_abs_diff_mean_skipnan", "abs_diff_mean", lambda: A.arr_abs_diff_mean("x_nan", "skip"),
     "avg(abs(vn1 - vn)) FILTER (WHERE NOT isnan(vn1 - vn))")
_evm("stat_line_length", "line_length", lambda: A.arr_line_length("x"), "sum(abs(v1 - v))")
_evm("stat_zero_crossings", "zcross", lambda: A.arr_zero_crossings("x"),
     "count(*) FILTER (WHERE (v - m) * (v1 - m) < 0)")
_evm("stat_zero_crossings_skipnan", "zcross", lambda: A.arr_zero_crossings("x_nan", "skip"),
     "count(*) FILTER (WHERE (vn - mn) * (vn1 - mn) < 0 AND NOT isnan((vn - mn) * (vn1 - mn)))")
_evm("stat_local_extrema", "extrema", lambda: A.arr_local_extrema("x"),
     "count(*) FILTER (WHERE (v1 - v) * (v2 - v1) < 0)")
_evm("stat_turning_ratio", "turning_ratio", lambda: A.arr_turning_ratio("x"),
     "count(*) FILTER (WHERE (v1 - v) * (v2 - v1) < 0) / 16.0")
_evm("stat_tkeo", "tkeo", lambda: A.arr_tkeo("x"),
     "avg(v * v - vp * v1) FILTER (WHERE vp IS NOT NULL AND v1 IS NOT NULL)")
_evm("stat_tkeo_skipnan", "tkeo", lambda: A.arr_tkeo("x_nan", "skip"),
     "coalesce(avg(vn * vn - vnp * vn1) FILTER (WHERE vnp IS NOT NULL AND vn1 IS NOT NULL "
     "AND NOT isnan(vn * vn - vnp * vn1)), 'NaN'::DOUBLE)")
_evm("stat_crest_abs", "crest", lambda: A.arr_crest("x", True), "max(abs(v)) / (sqrt(avg(v * v)) + 1e-7)")
_evm("stat_crest_max", "crest", lambda: A.arr_crest("x", False), "max(v) / (sqrt(avg(v * v)) + 1e-7)")
_evm("stat_head_tail", "head_tail", lambda: A.arr_head_tail("x"),
     "avg(v) FILTER (WHERE i >= 6) - avg(v) FILTER (WHERE i < 10)")


@register("stat_argmax", EV + """SELECT window_id, """ + R("min(i) FILTER (WHERE v = mx) / 40.0") + """ AS argmax
FROM (SELECT window_id, i, v, max(v) OVER (PARTITION BY window_id) AS mx FROM ev) t GROUP BY window_id""")
def q_argmax(spark, sf_dir):
    """A34 first maximum position / 40."""
    return ev_windows(spark, sf_dir).select("window_id", A.arr_argmax("x").alias("argmax"))


@register("stat_diff", EV + """SELECT window_id, i AS pos, """ + R("v1 - v") + """ AS d1 FROM evm WHERE v1 IS NOT NULL""")
def q_diff(spark, sf_dir):
    """A14 first difference, long form."""
    return ev_windows(spark, sf_dir).select("window_id", F.posexplode(A.arr_diff("x")).alias("pos", "d1"))


@register("stat_diff2", EV + """SELECT window_id, i AS pos, """ + R("(v2 - v1) - (v1 - v)") + """ AS d2 FROM evm WHERE v2 IS NOT NULL""")
def q_diff2(spark, sf_dir):
    """A14 second difference, long form."""
    return ev_windows(spark, sf_dir).select("window_id", F.posexplode(A.arr_diff("x", 2)).alias("pos", "d2"))


@register("stat_autocorr", EV + """SELECT window_id,
  """ + R("sum((v - m) * (lead3 - m)) / (sum((v - m) * (v - m)) + 1e-10)") + """ AS ac3
FROM (SELECT window_id, i, v, m, lead(v, 3) OVER (PARTITION BY window_id ORDER BY i) AS lead3 FROM evm) t
GROUP BY window_id""")
def q_autocorr(spark, sf_dir):
    """A19 autocorrelation at lag 3."""
    return ev_windows(spark, sf_dir).select("window_id", A.arr_autocorr("x", 3).alias("ac3"))


@register("stat_entropy", EV + """, z AS (SELECT window_id, (v - m) / (s + 1e-7) AS z FROM evm),
b AS (SELECT window_id,
        CASE WHEN z < -2 THEN 0 WHEN z < -1 THEN 1 WHEN z < 0 THEN 2 WHEN z < 1 THEN 3 WHEN z < 2 THEN 4 ELSE 5 END AS bin
      FROM z),
bins AS (SELECT w.window_id, k.bin FROM (SELECT DISTINCT window_id FROM z) w, range(6) k(bin)),
p AS (SELECT bins.window_id, bins.bin, count(b.bin) / 16.0 + 1e-10 AS p
      FROM bins LEFT JOIN b ON b.window_id = bins.window_id AND b.bin = bins.bin GROUP BY ALL)
SELECT window_id, """ + R("-sum(p * ln(p))") + """ AS entropy FROM p GROUP BY window_id""")
def q_entropy(spark, sf_dir):
    """A20 Shannon entropy of z-score bins."""
    return ev_windows(spark, sf_dir).select("window_id", A.arr_entropy("x").alias("entropy"))


_HJ = EV + """, d AS (SELECT window_id, i, v1 - v AS d1, v2 - 2 * v1 + v AS d2 FROM evm),
s AS (SELECT window_id, stddev_pop(d1) AS s1, stddev_pop(d2) AS s2 FROM d GROUP BY window_id),
s0 AS (SELECT window_id, stddev_pop(v) AS s0 FROM ev GROUP BY window_id)
"""


@register("stat_hjorth_std", _HJ + """SELECT window_id,
  """ + R("(s1 + 1e-7) / (s0 + 1e-7)") + """ AS mobility,
  """ + R("((s2 + 1e-7) / (s1 + 1e-7)) / ((s1 + 1e-7) / (s0 + 1e-7))") + """ AS complexity
FROM s JOIN s0 USING (window_id)""")
def q_hjorth_std(spark, sf_dir):
    """A21 Hjorth parameters, epsilon on each std (bvp form)."""
    h = A.arr_hjorth("x", "std")
    return ev_windows(spark, sf_dir).select("window_id", h["mobility"].alias("mobility"),
                                            h["complexity"].alias("complexity"))


@register("stat_hjorth_denominator", _HJ + """SELECT window_id,
  """ + R("s1 / (s0 + 1e-7)") + """ AS mobility,
  """ + R("(s2 / (s1 + 1e-7)) / (s1 / (s0 + 1e-7) + 1e-7)") + """ AS complexity
FROM s JOIN s0 USING (window_id)""")
def q_hjorth_den(spark, sf_dir):
    """A21 Hjorth parameters, epsilon on each denominator (acc form)."""
    h = A.arr_hjorth("x", "denominator")
    return ev_windows(spark, sf_dir).select("window_id", h["mobility"].alias("mobility"),
                                            h["complexity"].alias("complexity"))


@register("stat_phasic", EV + """, t AS (SELECT window_id, i, v - avg(v) OVER (PARTITION BY window_id ORDER BY i
                                   ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS p FROM ev)
SELECT window_id, """ + R("sum(p * p)") + """ AS phasic_energy, """ + R("max(p)") + """ AS phasic_max,
       """ + R("stddev_pop(p)") + """ AS phasic_std
FROM t WHERE i >= 8 GROUP BY window_id""")
def q_phasic(spark, sf_dir):
    """A33 moving-average tonic / phasic residual: energy, max, std of the phasic part."""
    w = ev_windows(spark, sf_dir).select("window_id", A.arr_phasic("x").alias("p"))
    return w.select("window_id", A.arr_energy("p").alias("phasic_energy"), A.arr_max("p").alias("phasic_max"),
                    A.arr_std("p").alias("phasic_std"))


_BLK = EV + """, bm AS (SELECT window_id, least(i // 2, 5) AS b,
              coalesce(avg(vn) FILTER (WHERE NOT isnan(vn)), 'NaN'::DOUBLE) AS m
       FROM ev GROUP BY window_id, least(i // 2, 5))
"""


@register("stat_block_means", _BLK + """SELECT window_id, b AS block, """ + R("m") + """ AS block_mean FROM bm""")
def q_block_means(spark, sf_dir):
    """A35 six block means (NaN skipped), long form."""
    return ev_windows(spark, sf_dir).select(
        "window_id", F.posexplode(A.arr_block_means("x_nan")).alias("block", "block_mean"))


@register("stat_trend_block_std", _BLK + """SELECT window_id,
  """ + R("max(m) FILTER (WHERE b = 5) - max(m) FILTER (WHERE b = 0)") + """ AS trend,
  """ + R("stddev_pop(m) FILTER (WHERE NOT isnan(m))") + """ AS block_std
FROM bm GROUP BY window_id""")
def q_trend(spark, sf_dir):
    """A35 trend (last - first block mean) and block std."""
    return ev_windows(spark, sf_dir).select("window_id", A.arr_trend("x_nan").alias("trend"),
                                            A.arr_block_std("x_nan").alias("block_std"))


@register("fill_nan_zero", EV + """SELECT window_id, i AS pos, """ + R("CASE WHEN isnan(vn) THEN 0.0 ELSE vn END") + """ AS value FROM ev""")
def q_fill_zero(spark, sf_dir):
    """P13 NaN -> 0."""
    return ev_windows(spark, sf_dir).select("window_id", F.posexplode(A.fill_nan("x_nan", "zero")).alias("pos", "value"))


@register("fill_nan_median", EV + """, med AS (SELECT window_id, median(vn) FILTER (WHERE NOT isnan(vn)) AS md FROM ev GROUP BY window_id)
SELECT window_id, i AS pos, """ + R("CASE WHEN isnan(vn) THEN md ELSE vn END") + """ AS value FROM ev JOIN med USING (window_id)""")
def q_fill_median(spark, sf_dir):
    """P13 NaN -> row median."""
    return ev_windows(spark, sf_dir).select("window_id",
                                            F.posexplode(A.fill_nan("x_nan", "median")).alias("pos", "value"))


@register("stat_cross_products", EV + """SELECT window_id, """ + R("stddev_pop(v) * avg(v)") + """ AS std_x_mean,
  """ + R("(max(v) - min(v)) * sqrt(avg(v * v))") + """ AS range_x_rms FROM ev GROUP BY window_id""")
def q_products(spark, sf_dir):
    """A38 products of already computed statistics."""
    w = ev_windows(spark, sf_dir)
    return w.select("window_id", (A.arr_std("x") * A.arr_mean("x")).alias("std_x_mean"),
                    (A.arr_range("x") * A.arr_rms("x")).alias("range_x_rms"))


# ---------------------------------------------------------------- 64-sample windows (embeddings)
@register("stat_autocorr_ratio", EMB + """, l AS (SELECT window_id, v - m AS c,
      lead(v, 32) OVER wo - m AS c32, lead(v, 38) OVER wo - m AS c38
   FROM embm WINDOW wo AS (PARTITION BY window_id ORDER BY i)),
r AS (SELECT window_id, sum(c * c32) / (sum(c * c) + 1e-10) AS r32, sum(c * c38) / (sum(c * c) + 1e-10) AS r38,
             sum(c * c) AS cc FROM l GROUP BY window_id)
SELECT window_id, """ + R("r32") + """ AS ac_32, """ + R("r38") + """ AS ac_38, 0.0::DOUBLE AS ac_64,
       0.0::DOUBLE AS ac_77,
       """ + R("(r32 + r38) / (0.0 + 0.0 + 1e-7)") + """ AS ac_ratio FROM r""")
def q_ac_ratio(spark, sf_dir):
    """A19 + A36 on 64-sample windows: lags 32 and 38, and 64 / 77 (n <= lag gives 0)."""
    w = emb_windows(spark, sf_dir)
    ac = {k: A.arr_autocorr("x", k) for k in (32, 38, 64, 77)}
    return w.select("window_id", *[ac[k].alias(f"ac_{k}") for k in ac],
                    ((ac[32] + ac[38]) / (ac[64] + ac[77] + F.lit(A.EPS_STD))).alias("ac_ratio"))


@register("axes_sma", AXES + """SELECT window_id, """ + R("sum(abs(x) + abs(y) + abs(z))") + """ AS sma FROM ax GROUP BY window_id""")
def q_sma(spark, sf_dir):
    """A25 signal-magnitude area."""
    a = emb_axes(spark, sf_dir)
    return a.select("window_id", A.axes_sma("ax", "ay", "az").alias("sma"))


@register("axes_magnitude", AXES + """SELECT window_id, j AS pos, """ + R("sqrt(x*x + y*y + z*z)") + """ AS mag,
  """ + R("x*x + y*y + z*z") + """ AS norm_sq FROM ax""")
def q_magnitude(spark, sf_dir):
    """A26 magnitude and squared norm per sample."""
    a = emb_axes(spark, sf_dir)
    return a.select("window_id", F.posexplode(F.arrays_zip(
        A.axes_magnitude("ax", "ay", "az").alias("mag"), A.axes_norm_sq("ax", "ay", "az").alias("norm_sq")))
        .alias("pos", "s")).select("window_id", "pos", "s.mag", "s.norm_sq")


@register("axes_jerk", AXES + """, d AS (SELECT window_id, j,
    lead(x) OVER wo - x AS dx, lead(y) OVER wo - y AS dy, lead(z) OVER wo - z AS dz,
    lead(x, 2) OVER wo - 2 * lead(x) OVER wo + x AS sx, lead(y, 2) OVER wo - 2 * lead(y) OVER wo + y AS sy,
    lead(z, 2) OVER wo - 2 * lead(z) OVER wo + z AS sz
  FROM ax WINDOW wo AS (PARTITION BY window_id ORDER BY j))
SELECT window_id, """ + R("avg(sqrt(dx*dx + dy*dy + dz*dz))") + """ AS jerk,
       """ + R("avg(sqrt(sx*sx + sy*sy + sz*sz))") + """ AS snap FROM d GROUP BY window_id""")
def q_jerk(spark, sf_dir):
    """A27 jerk and snap magnitude means."""
    a = emb_axes(spark, sf_dir)
    return a.select("window_id", A.axes_jerk("ax", "ay", "az", 1).alias("jerk"),
                    A.axes_jerk("ax", "ay", "az", 2).alias("snap"))


@register("axes_roll_pitch", AXES + """SELECT window_id,
  """ + R("avg(atan2(y, sqrt(x*x + z*z) + 1e-7))") + """ AS roll,
  """ + R("avg(atan2(x, sqrt(y*y + z*z) + 1e-7))") + """ AS pitch FROM ax GROUP BY window_id""")
def q_roll_pitch(spark, sf_dir):
    """A28 mean roll and pitch."""
    rp = A.axes_roll_pitch("ax", "ay", "az")
    return emb_axes(spark, sf_dir).select("window_id", rp["roll"].alias("roll"), rp["pitch"].alias("pitch"))


@register("axes_corr", AXES + """, m AS (SELECT *, x - avg(x) OVER w AS xm, y - avg(y) OVER w AS ym, z - avg(z) OVER w AS zm
  FROM ax WINDOW w AS (PARTITION BY window_id))
SELECT window_id,
  """ + R("sum(xm*ym) / (sqrt(sum(xm*xm) * sum(ym*ym)) + 1e-10)") + """ AS corr_xy,
  """ + R("sum(xm*zm) / (sqrt(sum(xm*xm) * sum(zm*zm)) + 1e-10)") + """ AS corr_xz,
  """ + R("sum(ym*zm) / (sqrt(sum(ym*ym) * sum(zm*zm)) + 1e-10)") + """ AS corr_yz FROM m GROUP BY window_id""")
def q_corr(spark, sf_dir):
    """A29 cross-correlation of axis pairs."""
    a = emb_axes(spark, sf_dir)
    return a.select("window_id", A.axes_corr("ax", "ay").alias("corr_xy"), A.axes_corr("ax", "az").alias("corr_xz"),
                    A.axes_corr("ay", "az").alias("corr_yz"))


@register("axes_dominant_ratio", AXES + """SELECT window_id,
  """ + R("greatest(var_pop(x), var_pop(y), var_pop(z)) / (var_pop(x) + var_pop(y) + var_pop(z) + 1e-10)")
          + """ AS dom_ratio FROM ax GROUP BY window_id""")
def q_dom(spark, sf_dir):
    """A30 dominant-axis variance ratio."""
    return emb_axes(spark, sf_dir).select("window_id", A.axes_dominant_ratio("ax", "ay", "az").alias("dom_ratio"))


@register("axes_transitions", AXES + """, d AS (SELECT window_id, j,
    CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN 0 WHEN abs(y) >= abs(z) THEN 1 ELSE 2 END AS dom FROM ax),
t AS (SELECT window_id, dom, lead(dom) OVER (PARTITION BY window_id ORDER BY j) AS nxt FROM d)
SELECT window_id, count(*) FILTER (WHERE nxt IS NOT NULL AND nxt <> dom)::DOUBLE AS transitions
FROM t GROUP BY window_id""")
def q_transitions(spark, sf_dir):
    """A31 postural transitions (dominant-axis changes)."""
    return emb_axes(spark, sf_dir).select("window_id", A.axes_transitions("ax", "ay", "az").alias("transitions"))

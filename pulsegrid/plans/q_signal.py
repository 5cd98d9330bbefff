"""Queries for the signal operators (G1-G8) and the two feature sets.

SQL twins: peaks from gaps-and-islands over the long form plus a recursive CTE
for the minimum-distance rule; the zero-phase filter as a recursive CTE over
samples (forward, then backward); the Welch spectrum of a 64-sample window as
an explicit DFT.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import arrays as A
from pulsegrid.functions import kernels as K
from pulsegrid.operators import signal as S
from pulsegrid.operators.features import (MULTIRATE_NAMES, WEARABLE_NAMES, features_multirate,
                                          features_wearable)
from pulsegrid.plans.output import sql_round as R
from pulsegrid.plans.q_stats import EMB
from pulsegrid.plans.registry import register
from pulsegrid.plans.sqlfeatures import FEATURE_BITS, multirate_sql, wearable_sql
from pulsegrid.sources.tables import LI_ORDER, LONG_WINDOW, emb_windows, li_long, li_multi, li_wear

BEAT_FS = 64.0
BEAT_DIST = 0.3
BEAT_Q = 0.7
BREATH_FS = 25.0

LONG_SQL = f"""WITH r AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS sid, l_extendedprice AS v,
         row_number() OVER (PARTITION BY CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END
                            ORDER BY {", ".join(LI_ORDER)}) - 1 AS rn
  FROM lineitem),
c AS (SELECT sid, rn // {LONG_WINDOW} AS blk, rn % {LONG_WINDOW} AS i, v,
             count(*) OVER (PARTITION BY sid, rn // {LONG_WINDOW}) AS cnt FROM r),
src AS (SELECT sid * 4294967296 + blk AS window_id, i, v FROM c WHERE cnt = {LONG_WINDOW})
"""

EMB_SRC = EMB + ", src AS (SELECT window_id, i, v FROM emb)\n"


def peaks_sql(distance: int, q: float, src: str = "src") -> str:
    """CTEs ``kept(window_id, pos, h)``: strict maxima (flat tops at the floor of
    the middle), height >= percentile q, greedy minimum distance by height."""
    return f""", runs AS (SELECT window_id, i, v, i - row_number() OVER (PARTITION BY window_id, v ORDER BY i) AS g
               FROM {src}),
isl AS (SELECT window_id, v, min(i) AS s, max(i) AS e FROM runs GROUP BY window_id, v, g),
nb AS (SELECT isl.*, l.v AS lv, r.v AS rv FROM isl
       JOIN {src} l ON l.window_id = isl.window_id AND l.i = isl.s - 1
       JOIN {src} r ON r.window_id = isl.window_id AND r.i = isl.e + 1),
thr AS (SELECT window_id, quantile_cont(v, {q}) AS t FROM {src} GROUP BY window_id),
cand AS (SELECT nb.window_id, (nb.s + nb.e) // 2 AS pos, nb.v AS h,
                row_number() OVER (PARTITION BY nb.window_id ORDER BY nb.v DESC, (nb.s + nb.e) // 2 DESC) AS rk
         FROM nb JOIN thr USING (window_id) WHERE nb.lv < nb.v AND nb.rv < nb.v AND nb.v >= thr.t),
walk AS (SELECT window_id, 1 AS rk, [pos] AS kept FROM cand WHERE rk = 1
         UNION ALL
         SELECT w.window_id, w.rk + 1,
                CASE WHEN len(list_filter(w.kept, lambda k: abs(k - c.pos) < {distance})) > 0 THEN w.kept
                     ELSE list_append(w.kept, c.pos) END
         FROM walk w JOIN cand c ON c.window_id = w.window_id AND c.rk = w.rk + 1),
fin AS (SELECT window_id, kept FROM walk QUALIFY rk = max(rk) OVER (PARTITION BY window_id)),
kept AS (SELECT fin.window_id, u.pos, s.v AS h FROM fin, unnest(fin.kept) AS u(pos)
         JOIN {src} s ON s.window_id = fin.window_id AND s.i = u.pos)
"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _long_peaks(spark, sf_dir):
    return S.find_peaks(li_long(spark, sf_dir), "x", BEAT_FS, BEAT_DIST, BEAT_Q)


@register("find_peaks", _recursive(LONG_SQL + peaks_sql(int(BEAT_DIST * BEAT_FS), BEAT_Q)
                                   + "SELECT window_id, pos::BIGINT AS pos FROM kept"))
def q_peaks(spark, sf_dir):
    """G1: peaks of 1024-sample price windows (fs 64, distance 0.3 s, height q 0.7)."""
    return _long_peaks(spark, sf_dir).select("window_id", F.explode("peaks").alias("pos"))


_RR_SQL = f""", rr AS (SELECT window_id, pos, (lead(pos) OVER w - pos) / {BEAT_FS} * 1000.0 AS rr
           FROM kept WINDOW w AS (PARTITION BY window_id ORDER BY pos)),
dd AS (SELECT window_id, rr, lead(rr) OVER (PARTITION BY window_id ORDER BY pos) - rr AS d FROM rr WHERE rr IS NOT NULL),
st AS (SELECT window_id, avg(rr) AS mean_rr, stddev_pop(rr) AS sdnn, sqrt(avg(d * d)) AS rmssd,
              count(*) FILTER (WHERE abs(d) > 50)::DOUBLE AS nn50, count(d) AS nd,
              sqrt(0.5 * var_pop(d)) AS sd1, 2 * var_pop(rr) - 0.5 * var_pop(d) AS sd2sq
       FROM dd GROUP BY window_id)
SELECT window_id, {R('mean_rr')} AS mean_rr, {R('sdnn')} AS sdnn, {R('rmssd')} AS rmssd,
       {R('nn50 / nd * 100.0')} AS pnn50, {R('nn50')} AS nn50, {R('sd1')} AS sd1,
       {R("CASE WHEN sd2sq >= 0 THEN sqrt(sd2sq) ELSE 'NaN'::DOUBLE END")} AS sd2,
       {R("sd1 / (CASE WHEN sd2sq >= 0 THEN sqrt(sd2sq) ELSE 'NaN'::DOUBLE END + 1e-7)")} AS sd_ratio
FROM st"""


@register("rr_stats", _recursive(LONG_SQL + peaks_sql(int(BEAT_DIST * BEAT_FS), BEAT_Q) + _RR_SQL))
def q_rr(spark, sf_dir):
    """RR-interval statistics from the G1 peaks (Column function over the peak array)."""
    p = _long_peaks(spark, sf_dir)
    s = A.rr_stats("peaks", BEAT_FS)
    return p.select("window_id", *[s[k].alias(k) for k in
                                   ("mean_rr", "sdnn", "rmssd", "pnn50", "nn50", "sd1", "sd2", "sd_ratio")])


# RR series of windows with 8 peaks or more: seconds since the first interval, linear between beats
_GRID_SQL = f""", rb AS (SELECT window_id, (lead(pos) OVER w - pos) / {BEAT_FS} AS rr, row_number() OVER w AS b,
                  count(*) OVER (PARTITION BY window_id) AS np FROM kept WINDOW w AS (PARTITION BY window_id ORDER BY pos)),
rt AS (SELECT window_id, b, rr, sum(rr) OVER w - first_value(rr) OVER w AS t FROM rb WHERE rr IS NOT NULL AND np >= 8
       WINDOW w AS (PARTITION BY window_id ORDER BY b)),
sg AS (SELECT window_id, b, rr, t, lead(rr) OVER w AS rr2, lead(t) OVER w AS t2, max(b) OVER (PARTITION BY window_id) AS mb
       FROM rt WINDOW w AS (PARTITION BY window_id ORDER BY b)),
gp AS (SELECT window_id, k, max(t) * (k / {K.RESAMPLE_POINTS - 1}.0) AS x
       FROM rt, (SELECT range AS k FROM range({K.RESAMPLE_POINTS})) GROUP BY window_id, k),
iv AS (SELECT gp.window_id, gp.k, gp.x, max(sg.b) AS b FROM gp JOIN sg ON sg.window_id = gp.window_id
         AND sg.t2 IS NOT NULL AND (sg.t <= gp.x OR sg.b = 1) GROUP BY gp.window_id, gp.k, gp.x),
va AS (SELECT iv.window_id, iv.k, sg.rr + (iv.x - sg.t) / (sg.t2 - sg.t) * (sg.rr2 - sg.rr) AS r
       FROM iv JOIN sg USING (window_id, b)),
rs AS (SELECT window_id, k, r - avg(r) OVER (PARTITION BY window_id) AS rr FROM va)
"""

# Welch on the 256 points: segments of 64 that overlap by half, periodic Hann, mean removed per segment
_HRV_SQL = f""", sm AS (SELECT rs.window_id, q.s, rs.k - 32 * q.s AS i,
                  rr - avg(rr) OVER (PARTITION BY rs.window_id, q.s) AS v
       FROM rs JOIN (SELECT range AS s FROM range(7)) q ON rs.k >= 32 * q.s AND rs.k < 32 * q.s + 64),
sw AS (SELECT window_id, s, i, v * (0.5 - 0.5 * cos(2 * pi() * i / 64.0)) AS xw FROM sm),
fk AS (SELECT range AS f FROM range(33)),
ft AS (SELECT window_id, s, f, sum(xw * cos(2 * pi() * f * i / 64.0)) AS re, sum(xw * sin(2 * pi() * f * i / 64.0)) AS im
       FROM sw, fk GROUP BY window_id, s, f),
pd AS (SELECT window_id, f / 16.0 AS hz, avg((re * re + im * im) / ({K.WELCH_FS} * 24.0)
              * CASE WHEN f IN (0, 32) THEN 1 ELSE 2 END) AS p FROM ft GROUP BY window_id, f),
tz AS (SELECT pd.window_id, bd.name, sum((b.hz - pd.hz) * (b.p + pd.p) / 2) AS pw
       FROM (VALUES {", ".join(f"('{n}', {lo}, {hi})" for n, lo, hi in K.HRV_BANDS)}) bd(name, lo, hi)
       JOIN pd ON pd.hz >= bd.lo AND pd.hz < bd.hi
       JOIN pd b ON b.window_id = pd.window_id AND b.hz = pd.hz + 1 / 16.0 AND b.hz < bd.hi GROUP BY pd.window_id, bd.name),
bp AS (SELECT l.window_id, coalesce(max(pw) FILTER (WHERE name = 'vlf'), 0) AS vlf,
              coalesce(max(pw) FILTER (WHERE name = 'lf'), 0) AS lf, coalesce(max(pw) FILTER (WHERE name = 'hf'), 0) AS hf
       FROM (SELECT DISTINCT window_id FROM src) l LEFT JOIN tz USING (window_id) GROUP BY l.window_id)
SELECT window_id, {R('vlf')} AS vlf, {R('lf')} AS lf, {R('hf')} AS hf, {R('lf / (hf + 1e-10)')} AS lf_hf,
       {R('vlf + lf + hf')} AS total FROM bp"""

_BEATS = LONG_SQL + peaks_sql(int(BEAT_DIST * BEAT_FS), BEAT_Q)


@register("hrv_bands", _recursive(_BEATS + _GRID_SQL + _HRV_SQL))
def q_hrv(spark, sf_dir):
    """G4 + G5 + G6 on beats: RR series resampled to 256 points, Welch (fs 4,
    segment 64), band powers; zeros below 8 peaks."""
    return S.hrv_frequency(_long_peaks(spark, sf_dir), "peaks", BEAT_FS)


@register("rr_resample", _recursive(_BEATS + _GRID_SQL + f"SELECT window_id, k::BIGINT AS pos, {R('rr')} AS rr FROM rs"))
def q_rr_resample(spark, sf_dir):
    """The resampled, mean-removed RR series (long form)."""
    r = S.rr_resample(_long_peaks(spark, sf_dir), "peaks", BEAT_FS)
    return r.select("window_id", F.posexplode("rr_grid").alias("pos", "rr"))


_DFT = EMB + f""", s AS (SELECT window_id, i, (v - avg(v) OVER (PARTITION BY window_id))
                       * (0.5 - 0.5 * cos(2 * pi() * i / 64.0)) AS xw FROM emb),
kk AS (SELECT range AS k FROM range(33)),
dft AS (SELECT window_id, kk.k, sum(xw * cos(2 * pi() * kk.k * i / 64.0)) AS re,
               sum(xw * sin(2 * pi() * kk.k * i / 64.0)) AS im FROM s, kk GROUP BY window_id, kk.k),
psd AS (SELECT window_id, k, k / 16.0 AS f,
               (re * re + im * im) / ({K.WELCH_FS} * 24.0) * CASE WHEN k IN (0, 32) THEN 1 ELSE 2 END AS p FROM dft)
"""


@register("welch_psd", _DFT + f"SELECT window_id, k::BIGINT AS k, {R('p')} AS psd FROM psd")
def q_welch(spark, sf_dir):
    """Welch density of each 64-sample embedding window (one segment, fs 4)."""
    w = S.welch(emb_windows(spark, sf_dir), "x")
    return w.select("window_id", F.posexplode("psd").alias("k", "psd"))


def _band(name, lo, hi):
    return f"""{name} AS (SELECT window_id, coalesce(sum((f1 - f) * (p + p1) / 2.0), 0.0) AS val FROM (
    SELECT window_id, f, p, lead(f) OVER w AS f1, lead(p) OVER w AS p1 FROM psd WHERE f >= {lo} AND f < {hi}
    WINDOW w AS (PARTITION BY window_id ORDER BY k)) t GROUP BY window_id)"""


@register("band_power", _DFT + ", " + ", ".join(_band(n, lo, hi) for n, lo, hi in A.HRV_BANDS) + f"""
, ids AS (SELECT DISTINCT window_id FROM psd)
SELECT ids.window_id, {R('coalesce(vlf.val, 0.0)')} AS vlf, {R('lf.val')} AS lf, {R('hf.val')} AS hf,
       {R('lf.val / (hf.val + 1e-10)')} AS lf_hf, {R('coalesce(vlf.val, 0.0) + lf.val + hf.val')} AS total
FROM ids LEFT JOIN vlf USING (window_id) JOIN lf USING (window_id) JOIN hf USING (window_id)""")
def q_band(spark, sf_dir):
    """Trapezoid band powers (VLF, LF, HF, LF/HF, total) from the G5 spectrum."""
    w = S.welch(emb_windows(spark, sf_dir), "x")
    b = A.band_power("psd", K.WELCH_FS, K.WELCH_SEGMENT)
    return w.select("window_id", *[b[k].alias(k) for k in ("vlf", "lf", "hf", "lf_hf", "total")])


def filter_ctes() -> str:
    """CTEs ``tonic(window_id, i, tonic)`` of the 64-sample windows ``emb(window_id, i, v)``."""
    b, a = K.butter_lowpass(4, 0.05, 4.0)
    zi = [float(v) for v in K._lfilter_zi(b, a)]
    b, a = [float(v) for v in b], [float(v) for v in a]
    n, pad = 64, 15
    L = n + 2 * pad

    def step(prev, e):
        y = f"({b[0]!r} * {e} + {prev}.z1)"
        return (y, f"{b[1]!r} * {e} + {prev}.z2 - ({a[1]!r}) * {y}", f"{b[2]!r} * {e} + {prev}.z3 - ({a[2]!r}) * {y}",
                f"{b[3]!r} * {e} + {prev}.z4 - ({a[3]!r}) * {y}", f"{b[4]!r} * {e} - ({a[4]!r}) * {y}")

    def pass_sql(name, src):
        # base: j = 0 with initial state zi * first value
        y0 = f"({b[0]!r} * e + {zi[0]!r} * e)"
        base = (f"SELECT window_id, 0 AS j, {y0} AS y, "
                f"{b[1]!r} * e + {zi[1]!r} * e - ({a[1]!r}) * {y0} AS z1, "
                f"{b[2]!r} * e + {zi[2]!r} * e - ({a[2]!r}) * {y0} AS z2, "
                f"{b[3]!r} * e + {zi[3]!r} * e - ({a[3]!r}) * {y0} AS z3, "
                f"{b[4]!r} * e - ({a[4]!r}) * {y0} AS z4 FROM {src} WHERE j = 0")
        y, z1, z2, z3, z4 = step("p", "x.e")
        rec = (f"SELECT p.window_id, p.j + 1, {y}, {z1}, {z2}, {z3}, {z4} "
               f"FROM {name} p JOIN {src} x ON x.window_id = p.window_id AND x.j = p.j + 1")
        return f"{name}(window_id, j, y, z1, z2, z3, z4) AS ({base} UNION ALL {rec})"

    return f""", fx AS (SELECT window_id, max(v) FILTER (WHERE i = 0) AS x0, max(v) FILTER (WHERE i = {n - 1}) AS xl
        FROM emb GROUP BY window_id),
ext AS (SELECT e.window_id, e.i + {pad} AS j, e.v AS e FROM emb e
        UNION ALL SELECT e.window_id, {pad} - e.i AS j, 2 * fx.x0 - e.v FROM emb e JOIN fx USING (window_id)
                  WHERE e.i BETWEEN 1 AND {pad}
        UNION ALL SELECT e.window_id, {2 * n + pad - 2} - e.i AS j, 2 * fx.xl - e.v
                  FROM emb e JOIN fx USING (window_id) WHERE e.i BETWEEN {n - 1 - pad} AND {n - 2}),
{pass_sql("fwd", "ext")},
rev AS (SELECT window_id, {L - 1} - j AS j, y AS e FROM fwd),
{pass_sql("bwd", "rev")},
tonic AS (SELECT window_id, {L - 1} - j - {pad} AS i, y AS tonic FROM bwd WHERE {L - 1} - j BETWEEN {pad} AND {pad + n - 1})
"""


@register("lowpass_split", _recursive(EMB + filter_ctes() + f"""SELECT t.window_id, t.i::BIGINT AS pos, {R('t.tonic')} AS tonic,
       {R('e.v - t.tonic')} AS phasic FROM tonic t JOIN emb e ON e.window_id = t.window_id AND e.i = t.i"""))
def q_lowpass(spark, sf_dir):
    """Zero-phase 4th-order Butterworth (0.05 Hz at fs 4) tonic and phasic parts."""
    w = S.lowpass_split(emb_windows(spark, sf_dir), "x")
    return w.select("window_id", F.posexplode(F.arrays_zip("tonic", "phasic")).alias("pos", "s")).select(
        "window_id", "pos", "s.tonic", "s.phasic")


@register("scr_peaks", _recursive(EMB + filter_ctes() + """, ph AS (SELECT t.window_id, t.i, e.v - t.tonic AS v
        FROM tonic t JOIN emb e ON e.window_id = t.window_id AND e.i = t.i)
""" + peaks_sql(100, 0.8, "ph") + f""", ids AS (SELECT window_id, sum(v * v) AS energy FROM ph GROUP BY window_id)
SELECT ids.window_id, count(kept.pos)::DOUBLE AS scr_count, {R('coalesce(avg(kept.h), 0.0)')} AS scr_amp_mean,
       {R('coalesce(max(kept.h), 0.0)')} AS scr_amp_max, {R('any_value(ids.energy)')} AS phasic_energy
FROM ids LEFT JOIN kept USING (window_id) GROUP BY ids.window_id"""))
def q_scr(spark, sf_dir):
    """Skin-conductance responses on the G7 phasic part (distance 100, height p80)."""
    w = S.lowpass_split(emb_windows(spark, sf_dir), "x")
    return S.scr_peaks(w, "phasic")


@register("breath_rate", _recursive(EMB_SRC + peaks_sql(int(1.0 * BREATH_FS), 0.5) + f"""
, ids AS (SELECT DISTINCT window_id FROM src)
SELECT ids.window_id, {R(f'count(kept.pos) / (64 / {BREATH_FS}) * 60.0')} AS breath_rate
FROM ids LEFT JOIN kept USING (window_id) GROUP BY ids.window_id"""))
def q_breath(spark, sf_dir):
    """Breaths per minute (fs 25, distance 1 s, median height) of each embedding window."""
    return S.breath_rate(emb_windows(spark, sf_dir), "x", BREATH_FS)


def _long(df, names):
    return df.select("window_id", F.posexplode("features").alias("pos", "value")).select(
        "window_id", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1).alias("name"), "value")


@register("features_wearable", wearable_sql(), bits=FEATURE_BITS)
def q_fc(spark, sf_dir):
    """F-C: the 81 wearable features of every lineitem window (long form)."""
    return _long(features_wearable(li_wear(spark, sf_dir)), WEARABLE_NAMES)


@register("features_multirate", _recursive(multirate_sql(peaks_sql, filter_ctes())), bits=FEATURE_BITS)
def q_fd(spark, sf_dir):
    """F-D: the 129 multi-rate features of every lineitem window (long form)."""
    return _long(features_multirate(li_multi(spark, sf_dir)), MULTIRATE_NAMES)

"""DuckDB twins of the two feature sets: 64-sample lineitem windows in long form.

Every channel becomes rows (window_id, ch, i, v); one aggregate per channel
holds all its statistics, and the features pick theirs by name.
"""

from __future__ import annotations

import re

from pulsegrid.operators.features import BREATH_FS, BVP_FS, ECG_FS, MULTIRATE_NAMES, WEARABLE_NAMES
from pulsegrid.plans.output import sql_round
from pulsegrid.sources.tables import LI_ORDER, WEAR_WINDOW

FEATURE_BITS = (20, 30, 0.7548776662466927)   # significant bits, grid near zero, unit of the grid

_WINDOWS = f"""WITH r AS (SELECT l_suppkey AS sid, l_quantity AS x, l_discount AS y, l_tax AS z, l_extendedprice AS b,
       l_quantity * (1 - l_discount) AS e,
       row_number() OVER (PARTITION BY l_suppkey ORDER BY {", ".join(LI_ORDER)}) - 1 AS rn FROM lineitem),
c AS (SELECT sid * 4294967296 + rn // {WEAR_WINDOW} AS window_id, rn % {WEAR_WINDOW} AS i, x, y, z, b, e,
             count(*) OVER (PARTITION BY sid, rn // {WEAR_WINDOW}) AS cnt FROM r),
w AS (SELECT *, sqrt(x * x + y * y + z * z) AS mag, sqrt(z * z + y * y + x * x) AS zmag, x * x + y * y + z * z AS sq
      FROM c WHERE cnt = {WEAR_WINDOW})
"""

_CENTRED = ("count(*) FILTER (WHERE (v - m) / (s + 1e-7) >= {lo} AND (v - m) / (s + 1e-7) < {hi}) / count(*) + 1e-10")
_EDGES = ("'-inf'::DOUBLE", "-2", "-1", "0", "1", "2", "'inf'::DOUBLE")
_BINS = [_CENTRED.format(lo=lo, hi=hi) for lo, hi in zip(_EDGES[:-1], _EDGES[1:])]
_ENTROPY = "-(" + " + ".join(f"({p}) * ln({p})" for p in _BINS) + ")"


def _lag(k: int) -> str:
    return f"sum((v - m) * (lead{k} - m)) / (sum((v - m) * (v - m)) + 1e-10) AS ac{k}"


def _statistics(sg: str, lags=()) -> str:
    """CTE ``ag``: one row per (window_id, ch) of the long table ``sg``."""
    leads = "".join(f", lead(v, {k}) OVER o AS lead{k}" for k in lags)
    return f""", st AS (SELECT *, avg(v) OVER p AS m, stddev_pop(v) OVER p AS s, max(v) OVER p AS mx, lead(v) OVER o AS a1,
       lead(v, 2) OVER o AS a2, lag(v) OVER o AS l1{leads} FROM {sg}
       WINDOW p AS (PARTITION BY window_id, ch), o AS (PARTITION BY window_id, ch ORDER BY i)),
ag AS (SELECT window_id, ch, avg(v) AS mean, stddev_pop(v) AS sd, var_pop(v) AS vr, min(v) AS lo, max(v) AS hi,
       max(abs(v)) AS top, sqrt(avg(v * v)) AS rms, sum(v * v) AS energy, avg(abs(v)) AS mabs, avg(abs(v - m)) AS mad,
       sum(abs(v - m)) AS vib, avg(power((v - m) / (s + 1e-7), 3)) AS skew, avg(power((v - m) / (s + 1e-7), 4)) AS kurt,
       skewness(v) AS gskew, kurtosis(v) AS gkurt, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr,
       quantile_cont(v, 0.1) AS p10, quantile_cont(v, 0.9) AS p90,
       count(*) FILTER (WHERE (v - m) * (a1 - m) < 0)::DOUBLE AS zc,
       count(*) FILTER (WHERE (a1 - v) * (a2 - a1) < 0) / count(*) AS turn, sum(abs(a1 - v)) AS len,
       avg(abs(a1 - v)) AS adiff, avg(v * v - l1 * a1) FILTER (WHERE l1 IS NOT NULL AND a1 IS NOT NULL) AS tkeo,
       sum(v * (i - 31.5)) / 21840.0 AS slope, avg(v) FILTER (WHERE i >= 54) - avg(v) FILTER (WHERE i < 10) AS ends,
       min(i) FILTER (WHERE v = mx) / 40.0 AS at, {_ENTROPY} AS entropy{"".join(", " + _lag(k) for k in lags)}
       FROM st GROUP BY window_id, ch)
"""


def _channels(names: dict[str, str]) -> str:
    """CTE ``ch``: the columns of ``w`` as long rows."""
    return (f", ch AS (SELECT window_id, i, unnest([{', '.join(repr(n) for n in names)}]) AS ch, "
            f"unnest([{', '.join(names.values())}]) AS v FROM w)\n")


def _select(names: list[str], exprs: list[str], channels: list[str], joins: str) -> str:
    if len(names) != len(exprs):
        raise ValueError(f"{len(names)} names, {len(exprs)} expressions")
    tables = f"(SELECT DISTINCT window_id FROM w) ids JOIN " + " JOIN ".join(
        f"(SELECT * FROM ag WHERE ch = '{c}') {c} USING (window_id)" for c in channels)
    values = ", ".join(f"({e})::DOUBLE" for e in exprs)
    return f""", wide AS (SELECT ids.window_id, unnest([{', '.join(repr(n) for n in names)}]) AS name,
       unnest([{values}]) AS value FROM {tables} {joins})
SELECT window_id, name, {sql_round("value", *FEATURE_BITS)} AS value FROM wide"""


def wearable_sql() -> str:
    """F-C over ``w``: b = bvp, mag / sq = magnitude, e = eda; a digit is the order of difference."""
    head = _WINDOWS + _channels({"b": "b", "mag": "mag", "e": "e", "x": "x", "y": "y", "z": "z", "sq": "sq"}) + """,
df AS (SELECT window_id, i, ch, v, lead(v) OVER o AS n1, lead(v, 2) OVER o AS n2,
              avg(v) OVER (PARTITION BY window_id, ch ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS trail
       FROM ch WINDOW o AS (PARTITION BY window_id, ch ORDER BY i)),
sg AS (SELECT window_id, i, ch, v FROM ch
       UNION ALL SELECT window_id, i, ch || '1', n1 - v FROM df WHERE n1 IS NOT NULL AND ch IN ('b', 'mag', 'e')
       UNION ALL SELECT window_id, i, ch || '2', (n2 - n1) - (n1 - v) FROM df WHERE n2 IS NOT NULL AND ch IN ('b', 'mag')
       UNION ALL SELECT window_id, i, 'ph', v - trail FROM df WHERE ch = 'e' AND i >= 8)
""" + _statistics("sg", (16, 32, 38, 48))
    head += """, mv AS (SELECT *, lead(x) OVER o - x AS dx, lead(y) OVER o - y AS dy, lead(z) OVER o - z AS dz,
       lead(x, 2) OVER o - 2 * lead(x) OVER o + x AS sx, lead(y, 2) OVER o - 2 * lead(y) OVER o + y AS sy,
       lead(z, 2) OVER o - 2 * lead(z) OVER o + z AS sz,
       CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN 0 WHEN abs(y) >= abs(z) THEN 1 ELSE 2 END AS dom,
       x - avg(x) OVER p AS xm, y - avg(y) OVER p AS ym, z - avg(z) OVER p AS zm
       FROM w WINDOW o AS (PARTITION BY window_id ORDER BY i), p AS (PARTITION BY window_id)),
tn AS (SELECT *, lead(dom) OVER (PARTITION BY window_id ORDER BY i) AS nxt FROM mv),
xa AS (SELECT window_id, sum(abs(x) + abs(y) + abs(z)) AS sma, avg(atan2(y, sqrt(x * x + z * z) + 1e-7)) AS roll,
       avg(atan2(x, sqrt(y * y + z * z) + 1e-7)) AS pitch, avg(sqrt(dx * dx + dy * dy + dz * dz)) AS jerk,
       avg(sqrt(sx * sx + sy * sy + sz * sz)) AS snap,
       sum(xm * ym) / (sqrt(sum(xm * xm) * sum(ym * ym)) + 1e-10) AS xy,
       sum(xm * zm) / (sqrt(sum(xm * xm) * sum(zm * zm)) + 1e-10) AS xz,
       sum(ym * zm) / (sqrt(sum(ym * ym) * sum(zm * zm)) + 1e-10) AS yz,
       count(*) FILTER (WHERE nxt <> dom) AS turns FROM tn GROUP BY window_id)
"""
    mob = "((b1.sd + 1e-7) / (b.sd + 1e-7))"
    moba = "(mag1.sd / (mag.sd + 1e-7))"
    exprs = ["b.skew", "b.kurt", "b.mad", "b.iqr", "b.hi - b.lo", "b.p90 - b.p10", "b.top / (b.rms + 1e-7)", "b.rms", "b.mean"]
    exprs += [f"b1.{s}" for s in ("mabs", "vr", "skew", "kurt", "hi", "lo", "zc", "len")]
    exprs += [f"b2.{s}" for s in ("vr", "mabs", "skew", "kurt", "zc", "turn")]
    exprs += ["b.ac32", "b.ac38", "b.ac48", "0.0", "0.0", "(b.ac32 + b.ac38) / 1e-7", "b.entropy", "b.tkeo", mob,
              f"((b2.sd + 1e-7) / (b1.sd + 1e-7)) / {mob}"]
    exprs += ["xa.sma", "mag.mad", "sq.vr", "mag.rms", "x.tkeo + y.tkeo + z.tkeo", "xa.jerk", "xa.snap",
              "mag.sd / (mag.mean + 1e-7)", "mag.vib", "x.mean", "y.mean", "z.mean", "xa.roll", "xa.pitch", "xa.xy", "xa.xz",
              "xa.yz", "greatest(x.vr, y.vr, z.vr) / (x.vr + y.vr + z.vr + 1e-10)", "xa.turns"]
    exprs += ["mag.skew", "mag.kurt", "mag.iqr", "mag.hi / (mag.rms + 1e-7)", "mag.hi - mag.lo", "mag.p10", "mag.p90", "mag.zc",
              "mag.turn", moba, f"(mag2.sd / (mag1.sd + 1e-7)) / ({moba} + 1e-7)", "mag.ac16", "mag.ac32", "mag.entropy"]
    exprs += ["e.mean", "e.sd", "e.lo", "e.hi", "e.iqr", "e.ends", "e.len", "e1.zc", "ph.energy", "ph.hi", "ph.sd", "e.skew",
              "e.kurt", "e.at", "e.rms"]
    return head + _select(WEARABLE_NAMES, exprs, ["b", "b1", "b2", "mag", "mag1", "mag2", "sq", "x", "y", "z", "e", "e1", "ph"],
                          "JOIN xa USING (window_id)")


def _named(ctes: str, tag: str) -> str:
    """The peak CTEs under names of their own."""
    return re.sub(r"\b(runs|isl|nb|thr|cand|walk|fin|kept)\b", rf"\1_{tag}", ctes)


def _beats(tag: str, fs: float) -> str:
    """CTE ``rr_<tag>``: the interval statistics of the peaks; no row below 3 peaks."""
    return f""", gap_{tag} AS (SELECT window_id, pos, (lead(pos) OVER o - pos) / {fs} * 1000.0 AS rr, count(*) OVER (PARTITION BY
       window_id) AS np FROM kept_{tag} WINDOW o AS (PARTITION BY window_id ORDER BY pos)),
dd_{tag} AS (SELECT window_id, rr, lead(rr) OVER (PARTITION BY window_id ORDER BY pos) - rr AS d FROM gap_{tag}
       WHERE rr IS NOT NULL AND np >= 3),
rr_{tag} AS (SELECT window_id, avg(rr) AS mean_rr, stddev_pop(rr) AS sdnn, sqrt(avg(d * d)) AS rmssd,
       count(*) FILTER (WHERE abs(d) > 50)::DOUBLE AS nn50, count(d) AS nd, sqrt(0.5 * var_pop(d)) AS sd1,
       CASE WHEN 2 * var_pop(rr) - 0.5 * var_pop(d) >= 0 THEN sqrt(2 * var_pop(rr) - 0.5 * var_pop(d))
            ELSE 'NaN'::DOUBLE END AS sd2 FROM dd_{tag} GROUP BY window_id)
"""


def multirate_sql(peaks_sql, tonic_ctes: str) -> str:
    """F-D over ``w``: z = temp, y = eda, x = hr and breath, b = ecg and bvp; the windows are too
    short for 8 beats, so the band powers are 0."""
    head = _WINDOWS + ", emb AS (SELECT window_id, i, y AS v FROM w), price AS (SELECT window_id, i, b AS v FROM w), " \
        "breath AS (SELECT window_id, i, x AS v FROM w)\n" + tonic_ctes + """, phs AS (SELECT t.window_id, t.i, e.v - t.tonic AS v
       FROM tonic t JOIN emb e ON e.window_id = t.window_id AND e.i = t.i)
"""
    head += _channels({"z": "z", "y": "y", "x": "x", "b": "b", "mag": "mag", "zmag": "zmag"})
    head += """, sg AS (SELECT window_id, i, ch, v FROM ch UNION ALL SELECT window_id, i, 'ton', tonic FROM tonic
       UNION ALL SELECT window_id, i, 'ph', v FROM phs)
""" + _statistics("sg")
    head += """, bm AS (SELECT window_id, ch, least(i // 10, 5) AS k, avg(v) AS m FROM ch GROUP BY ALL),
tr AS (SELECT window_id, ch, max(m) FILTER (WHERE k = 5) - max(m) FILTER (WHERE k = 0) AS trend, stddev_pop(m) AS bstd
       FROM bm GROUP BY ALL)
"""
    for tag, src, distance, q in (("ecg", "price", int(0.3 * ECG_FS), 0.7), ("bvp", "price", int(0.3 * BVP_FS), 0.7),
                                  ("breath", "breath", int(1.0 * BREATH_FS), 0.5), ("scr", "phs", 100, 0.8)):
        head += _named(peaks_sql(distance, q, src), tag)
    head += _beats("ecg", ECG_FS) + _beats("bvp", BVP_FS)
    head += """, scr AS (SELECT window_id, count(*)::DOUBLE AS n, avg(h) AS amp, max(h) AS top FROM kept_scr GROUP BY window_id),
br AS (SELECT window_id, count(*)::DOUBLE AS n FROM kept_breath GROUP BY window_id)
"""
    joins = "".join(f" JOIN (SELECT * FROM tr WHERE ch = '{c}') t{c} USING (window_id)" for c in ("z", "x", "mag", "zmag"))
    joins += "".join(f" LEFT JOIN {t} USING (window_id)" for t in ("rr_ecg", "rr_bvp", "scr", "br"))

    def nine(c):
        return [f"{c}.{s}" for s in ("mean", "sd", "lo", "hi")] + [f"{c}.hi - {c}.lo"] + \
            [f"{c}.{s}" for s in ("iqr", "slope", "gskew", "gkurt")]

    def trend(c):
        return [f"t{c}.trend", f"t{c}.bstd"]

    def beat(t):
        own = [f"coalesce(rr_{t}.{s}, 0)" for s in ("mean_rr", "sdnn", "rmssd")]
        own += [f"coalesce(rr_{t}.nn50 / rr_{t}.nd * 100.0, 0)", f"coalesce(rr_{t}.nn50, 0)", f"coalesce(rr_{t}.sd1, 0)",
                f"coalesce(rr_{t}.sd2, 0)", f"coalesce(rr_{t}.sd1 / (rr_{t}.sd2 + 1e-7), 0)"]
        return own + ["0.0"] * 5 + ["b.sd", "b.hi - b.lo", "b.adiff", "b.zc", "b.tkeo"]
    rate = f"(coalesce(br.n, 0) / ({WEAR_WINDOW} / {BREATH_FS}) * 60.0)"
    exprs = nine("z") + trend("z") + nine("y") + ["y.adiff", "ton.mean", "ton.sd", "ton.slope", "ph.mean", "ph.sd", "ph.hi",
                                                  "coalesce(scr.n, 0)", "coalesce(scr.amp, 0)", "coalesce(scr.top, 0)",
                                                  "ph.energy"]
    exprs += nine("x") + ["x.adiff"] + trend("x") + beat("ecg") + beat("bvp")
    exprs += [rate] + nine("x") + ["x.adiff", "x.zc", "x.tkeo"] + trend("x")
    for c in ("mag", "zmag"):
        exprs += nine(c) + [f"{c}.adiff", f"{c}.zc", f"{c}.tkeo"] + trend(c)
    exprs += ["coalesce(rr_ecg.rmssd, 0) * coalesce(scr.n, 0)", "coalesce(rr_ecg.sdnn, 0) * ph.energy",
              f"coalesce(rr_ecg.rmssd, 0) * {rate}", "0.0", "x.sd * mag.mean", "y.mean * z.mean", f"{rate} * mag.mean"]
    return head + _select(MULTIRATE_NAMES, exprs, ["z", "y", "x", "b", "mag", "zmag", "ton", "ph"], joins)

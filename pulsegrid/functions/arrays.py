"""Per-window statistics as Spark Column expressions over array columns.

Every function takes a Column (or column name) holding ``array<float|double>``
and returns a Column, so it can be used in ``select``/``withColumn`` and in SQL
plans alike.  Arithmetic is done in double.  Two NaN flavours exist:

* ``nan="propagate"`` – plain formulas, NaN anywhere gives NaN (flavour C);
* ``nan="skip"``      – NaN (and null) samples are dropped first (flavour D).

Values computed once per row (a mean, a sorted copy) are bound with ``let`` so
that the lambdas below reference them instead of recomputing per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference formulas (must stay equal for equal results).
EPS_STD = 1e-7        # added to a standard deviation / rms / mean in ratios
EPS_CORR = 1e-10      # added to autocorrelation and correlation denominators
ENTROPY_EDGES = (-2.0, -1.0, 0.0, 1.0, 2.0)   # z-score bin edges, left-closed
TONIC_WINDOW = 8      # moving-average length of the tonic component
HEAD_TAIL = 10        # samples averaged at each end for the head/tail difference
ARGMAX_DIVISOR = 40.0  # the argmax position is divided by this
BLOCKS = 6            # number of temporal blocks

NAN = float("nan")
INF = float("inf")


# ---------------------------------------------------------------- helpers
def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(x) -> Column:
    return col(x).cast("array<double>")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean(x, nan: str = "propagate") -> Column:
    x = as_double(x)
    if nan == "skip":
        return F.filter(x, lambda v: v.isNotNull() & ~F.isnan(v))
    if nan != "propagate":
        raise ValueError("nan must be 'propagate' or 'skip'")
    return x


def div(a: Column, b: Column) -> Column:
    """IEEE-style division: x/0 gives ±inf, 0/0 gives NaN (ANSI-safe)."""
    a, b = col(a), col(b)
    return (F.when(b != 0, a / b)
             .when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
             .when(F.isnan(a) | (a == 0), F.lit(NAN))
             .otherwise(F.signum(a) * F.lit(INF)))


def asum(xs: Column, f=None) -> Column:
    """Sum of f(v) over an array (0.0 when empty)."""
    if f is None:
        return F.aggregate(xs, F.lit(0.0), lambda acc, v: acc + v)
    return F.aggregate(xs, F.lit(0.0), lambda acc, v: acc + f(v))


def n_of(xs: Column) -> Column:
    return F.size(xs).cast("double")


def _has_nan(xs: Column) -> Column:
    return F.exists(xs, lambda v: F.isnan(v))


def pairs(xs: Column, lag: int, f) -> Column:
    """Array of f(x[i], x[i+lag]) for i = 0..n-lag-1 (empty when n <= lag)."""
    n = F.size(xs)
    m = F.greatest(n - lag, F.lit(0))
    return F.zip_with(F.slice(xs, 1, m), F.slice(xs, lag + 1, m), f)


# ---------------------------------------------------------------- moments
def _mean(xs):
    return div(asum(xs), n_of(xs))


def _central(xs, m, k):
    return div(asum(xs, lambda v: F.pow(v - m, F.lit(float(k))) if k not in (1, 2)
                    else ((v - m) * (v - m) if k == 2 else v - m)), n_of(xs))


def arr_mean(x, nan: str = "propagate") -> Column:
    """A1 mean; flavour D skips NaN and gives NaN when nothing is left."""
    return let(clean(x, nan), _mean)


def arr_var(x, nan: str = "propagate") -> Column:
    """A2 population variance (divide by n)."""
    return let(clean(x, nan), lambda xs: let(_mean(xs), lambda m: _central(xs, m, 2)))


def arr_std(x, nan: str = "propagate") -> Column:
    """A2 population standard deviation."""
    return F.sqrt(arr_var(x, nan))


def arr_min(x, nan: str = "propagate") -> Column:
    """A3 minimum; flavour C gives NaN if any sample is NaN."""
    xs = clean(x, nan)
    if nan == "skip":
        return let(xs, lambda s: F.when(F.size(s) == 0, F.lit(NAN)).otherwise(F.array_min(s)))
    return let(xs, lambda s: F.when(_has_nan(s), F.lit(NAN)).otherwise(F.array_min(s)))


def arr_max(x, nan: str = "propagate") -> Column:
    """A3 maximum (Spark orders NaN last, so flavour D filters it first)."""
    xs = clean(x, nan)
    if nan == "skip":
        return let(xs, lambda s: F.when(F.size(s) == 0, F.lit(NAN)).otherwise(F.array_max(s)))
    return let(xs, lambda s: F.when(_has_nan(s), F.lit(NAN)).otherwise(F.array_max(s)))


def arr_range(x, nan: str = "propagate") -> Column:
    """A3 max - min."""
    return arr_max(x, nan) - arr_min(x, nan)


def arr_rms(x, nan: str = "propagate") -> Column:
    """A11 sqrt(mean(x^2))."""
    return let(clean(x, nan), lambda xs: F.sqrt(div(asum(xs, lambda v: v * v), n_of(xs))))


def arr_mad(x, nan: str = "propagate") -> Column:
    """A12 mean absolute deviation about the mean."""
    return let(clean(x, nan), lambda xs: let(_mean(xs), lambda m:
               div(asum(xs, lambda v: F.abs(v - m)), n_of(xs))))


def arr_energy(x, nan: str = "propagate") -> Column:
    """A37 sum of squares; flavour D counts NaN as 0."""
    return asum(clean(x, nan), lambda v: v * v)


def arr_vibration(x) -> Column:
    """A24 sum of absolute deviations from the mean."""
    return let(as_double(x), lambda xs: let(_mean(xs), lambda m: asum(xs, lambda v: F.abs(v - m))))


def arr_cv(x) -> Column:
    """A23 std / (mean + 1e-7)."""
    return arr_std(x) / (arr_mean(x) + F.lit(EPS_STD))


def _std_moments(xs, body):
    """Bind mean m and population std s of xs and call body(m, s)."""
    return let(_mean(xs), lambda m: let(F.sqrt(_central(xs, m, 2)), lambda s: body(m, s)))


def arr_skew(x, bias: str = "eps") -> Column:
    """A4 / A6 skewness.

    ``bias='eps'``: mean(((x-m)/(s+1e-7))^3) (flavour C).
    ``bias='corrected'``: adjusted Fisher-Pearson G1 = g1*sqrt(n(n-1))/(n-2)
    for n > 2, g1 otherwise, NaN for a constant row; NaN propagates.
    """
    xs0 = as_double(x)
    if bias == "eps":
        return let(xs0, lambda xs: _std_moments(xs, lambda m, s: div(
            asum(xs, lambda v: F.pow((v - m) / (s + F.lit(EPS_STD)), F.lit(3.0))), n_of(xs))))
    if bias != "corrected":
        raise ValueError("bias must be 'eps' or 'corrected'")

    def body(xs):
        n = n_of(xs)
        return let(_mean(xs), lambda m: let(
            F.struct(_central(xs, m, 2).alias("m2"), _central(xs, m, 3).alias("m3")),
            lambda mm: F.when(_has_nan(xs), F.lit(NAN))
            .when(mm["m2"] <= F.pow(F.lit(2.220446049250313e-16) * m, 2), F.lit(NAN))
            .otherwise(let(mm["m3"] / F.pow(mm["m2"], F.lit(1.5)), lambda g1:
                           F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).otherwise(g1)))))
    return let(xs0, body)


def arr_kurt(x, bias: str = "eps") -> Column:
    """A5 / A7 kurtosis.

    ``bias='eps'``: mean(((x-m)/(s+1e-7))^4), not minus 3 (flavour C).
    ``bias='corrected'``: bias-corrected excess kurtosis
    (n-1)/((n-2)(n-3))*((n+1)g2+6) for n > 3, g2 = m4/m2^2-3 otherwise.
    """
    xs0 = as_double(x)
    if bias == "eps":
        return let(xs0, lambda xs: _std_moments(xs, lambda m, s: div(
            asum(xs, lambda v: F.pow((v - m) / (s + F.lit(EPS_STD)), F.lit(4.0))), n_of(xs))))
    if bias != "corrected":
        raise ValueError("bias must be 'eps' or 'corrected'")

    def body(xs):
        n = n_of(xs)
        return let(_mean(xs), lambda m: let(
            F.struct(_central(xs, m, 2).alias("m2"), _central(xs, m, 4).alias("m4")),
            lambda mm: F.when(_has_nan(xs), F.lit(NAN))
            .when(mm["m2"] <= F.pow(F.lit(2.220446049250313e-16) * m, 2), F.lit(NAN))
            .otherwise(let(mm["m4"] / (mm["m2"] * mm["m2"]) - 3.0, lambda g2:
                           F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6.0))
                           .otherwise(g2)))))
    return let(xs0, body)


# ---------------------------------------------------------------- order statistics
def _pct_sorted(s: Column, q) -> Column:
    n = F.size(s)
    h = (n - 1).cast("double") * F.lit(float(q)) / 100.0
    lo = F.floor(h).cast("int")
    hi = F.ceil(h).cast("int")
    a, b = F.get(s, lo), F.get(s, hi)
    return F.when(n == 0, F.lit(NAN)).otherwise(a + (h - lo) * (b - a))


def arr_percentile(x, q, nan: str = "propagate") -> Column:
    """A8 percentile q (0..100), linear interpolation at (n-1)q/100."""
    xs = clean(x, nan)
    if nan == "skip":
        return let(F.array_sort(xs), lambda s: _pct_sorted(s, q))
    return let(xs, lambda v: F.when(_has_nan(v), F.lit(NAN))
               .otherwise(_pct_sorted(F.array_sort(v), q)))


def arr_percentiles(x, qs, nan: str = "propagate") -> Column:
    """Several percentiles from one sort, as a struct p<q>."""
    xs = clean(x, nan)

    def body(s):
        return F.struct(*[_pct_sorted(s, q).alias(f"p{q}") for q in qs])
    if nan == "skip":
        return let(F.array_sort(xs), body)
    return let(xs, lambda v: F.when(_has_nan(v), F.struct(*[F.lit(NAN).alias(f"p{q}") for q in qs]))
               .otherwise(body(F.array_sort(v))))


def arr_iqr(x, nan: str = "propagate") -> Column:
    """A9 p75 - p25."""
    p = arr_percentiles(x, (25, 75), nan)
    return p["p75"] - p["p25"]


def arr_p90_p10(x, nan: str = "propagate") -> Column:
    """A9 p90 - p10."""
    p = arr_percentiles(x, (10, 90), nan)
    return p["p90"] - p["p10"]


def arr_median(x) -> Column:
    """A10 median with NaN skipped (mean of the two middle values)."""
    return arr_percentile(x, 50, nan="skip")


def fill_nan(x, value="zero") -> Column:
    """P13 replace NaN by 0 (``'zero'``), by the row median (``'median'``) or a number."""
    xs = as_double(x)
    if value == "zero":
        return F.transform(xs, lambda v: F.when(F.isnan(v), F.lit(0.0)).otherwise(v))
    if value == "median":
        return let(arr_median(xs), lambda med: F.transform(
            xs, lambda v: F.when(F.isnan(v), med).otherwise(v)))
    return F.transform(xs, lambda v: F.when(F.isnan(v), F.lit(float(value))).otherwise(v))


# ---------------------------------------------------------------- sequence shape
def arr_diff(x, order: int = 1) -> Column:
    """A14 first / second difference: d[i] = x[i+1] - x[i]."""
    out = as_double(x)
    for _ in range(order):
        out = let(out, lambda xs: pairs(xs, 1, lambda a, b: b - a))
    return out


def arr_slope(x) -> Column:
    """A13 sum(x*t)/sum(t^2), t the centred index; NaN counts as 0."""
    def body(xs):
        n = n_of(xs)
        c = (n - 1.0) / 2.0
        num = F.aggregate(F.transform(xs, lambda v, i: F.when(F.isnan(v), F.lit(0.0)).otherwise(v)
                                      * (i.cast("double") - c)),
                          F.lit(0.0), lambda a, v: a + v)
        den = n * (n * n - 1.0) / 12.0
        return div(num, den)
    return let(as_double(x), body)


def arr_abs_diff_mean(x, nan: str = "propagate") -> Column:
    """A15 mean |d|; flavour D skips NaN differences."""
    d = arr_diff(x)
    return arr_mean(F.transform(d, lambda v: F.abs(v)), nan)


def arr_line_length(x) -> Column:
    """A15 sum |d|."""
    return asum(arr_diff(x), lambda v: F.abs(v))


def arr_zero_crossings(x, nan: str = "propagate") -> Column:
    """A16 count of (x[i]-m)(x[i+1]-m) < 0; NaN compares false.

    The mean is the plain mean (C) or the NaN-skipping mean (D)."""
    return let(as_double(x), lambda xs: let(arr_mean(xs, nan), lambda m: F.size(F.filter(
        pairs(xs, 1, lambda a, b: (a - m) * (b - m)), lambda p: p < 0)).cast("double")))


def arr_local_extrema(x) -> Column:
    """A17 count of d[i]*d[i+1] < 0."""
    return F.size(F.filter(pairs(arr_diff(x), 1, lambda a, b: a * b), lambda p: p < 0)).cast("double")


def arr_turning_ratio(x) -> Column:
    """A17 local extrema / n."""
    return arr_local_extrema(x) / F.size(col(x)).cast("double")


def arr_tkeo(x, nan: str = "propagate") -> Column:
    """A18 mean(x[i]^2 - x[i-1]*x[i+1]) over inner samples; 0 when n < 3."""
    def body(xs):
        n = F.size(xs)
        inner = F.greatest(n - 2, F.lit(0))
        terms = F.zip_with(F.zip_with(F.slice(xs, 1, inner), F.slice(xs, 3, inner), lambda a, b: a * b),
                           F.slice(xs, 2, inner), lambda ab, c: c * c - ab)
        return F.when(n < 3, F.lit(0.0)).otherwise(arr_mean(terms, nan))
    return let(as_double(x), body)


def arr_autocorr(x, lag: int) -> Column:
    """A19 sum c[i]c[i+lag] / (sum c^2 + 1e-10), c centred; 0 when n <= lag."""
    def body(xs):
        return let(_mean(xs), lambda m: F.when(F.size(xs) <= lag, F.lit(0.0)).otherwise(
            asum(pairs(xs, lag, lambda a, b: (a - m) * (b - m))) /
            (asum(xs, lambda v: (v - m) * (v - m)) + F.lit(EPS_CORR))))
    return let(as_double(x), body)


def arr_entropy(x) -> Column:
    """A20 entropy of z-scores in six left-closed bins; p + 1e-10, not renormalised."""
    def body(xs):
        n = n_of(xs)

        def with_z(m, s):
            zs = F.transform(xs, lambda v: (v - m) / (s + F.lit(EPS_STD)))
            e = ENTROPY_EDGES
            conds = [lambda z: z < e[0]] + \
                    [(lambda lo, hi: (lambda z: (z >= lo) & (z < hi)))(e[i], e[i + 1]) for i in range(len(e) - 1)] + \
                    [lambda z: z >= e[-1]]
            ps = [div(F.size(F.filter(zs, c)).cast("double"), n) + F.lit(EPS_CORR) for c in conds]
            total = None
            for p in ps:
                t = p * F.log(p)
                total = t if total is None else total + t
            return -total
        return _std_moments(xs, with_z)
    return let(as_double(x), body)


def arr_hjorth(x, eps_on: str = "std") -> Column:
    """A21 Hjorth mobility and complexity as struct(mobility, complexity).

    ``eps_on='std'``: 1e-7 is added to each std (bvp form);
    ``eps_on='denominator'``: 1e-7 is added to each denominator (acc form).
    """
    d1 = arr_diff(x, 1)
    d2 = arr_diff(d1, 1)
    s0, s1, s2 = arr_std(x), arr_std(d1), arr_std(d2)
    e = F.lit(EPS_STD)
    if eps_on == "std":
        mob = (s1 + e) / (s0 + e)
        com = ((s2 + e) / (s1 + e)) / mob
    elif eps_on == "denominator":
        mob = s1 / (s0 + e)
        com = (s2 / (s1 + e)) / (mob + e)
    else:
        raise ValueError("eps_on must be 'std' or 'denominator'")
    return F.struct(mob.alias("mobility"), com.alias("complexity"))


def arr_crest(x, use_abs: bool = True) -> Column:
    """A22 max(|x|) (or max x) / (rms + 1e-7)."""
    xs = as_double(x)
    top = F.array_max(F.transform(xs, lambda v: F.abs(v))) if use_abs else F.array_max(xs)
    return top / (arr_rms(xs) + F.lit(EPS_STD))


def arr_head_tail(x, k: int = HEAD_TAIL) -> Column:
    """A32 mean(last k) - mean(first k)."""
    def body(xs):
        n = F.size(xs)
        m = F.least(n, F.lit(k))
        return _mean(F.slice(xs, F.greatest(n - m + 1, F.lit(1)), m)) - _mean(F.slice(xs, 1, m))
    return let(as_double(x), body)


def arr_phasic(x, window: int = TONIC_WINDOW) -> Column:
    """A33 phasic residual x[t] - mean(x[t-window+1..t]) for t = window..n-1."""
    def body(xs):
        n = F.size(xs)
        ts = F.sequence(F.lit(window), F.greatest(n - 1, F.lit(window)))
        res = F.transform(ts, lambda t: F.get(xs, t) - asum(F.slice(xs, t - (window - 2), window)) / float(window))
        return F.when(n > window, res).otherwise(F.array().cast("array<double>"))
    return let(as_double(x), body)


def arr_argmax(x, divisor: float = ARGMAX_DIVISOR) -> Column:
    """A34 index of the first maximum / divisor."""
    xs = as_double(x)
    return let(xs, lambda s: (F.array_position(s, F.array_max(s)) - 1).cast("double") / divisor)


def arr_block_means(x, blocks: int = BLOCKS) -> Column:
    """A35 means of `blocks` blocks of floor(n/blocks); the last takes the rest (NaN skipped)."""
    def body(xs):
        n = F.size(xs)
        b = F.floor(n / blocks).cast("int")
        parts = []
        for k in range(blocks):
            start = b * k + 1
            length = b if k < blocks - 1 else n - b * (blocks - 1)
            parts.append(arr_mean(F.slice(xs, start, length), "skip"))
        return F.array(*parts)
    return let(as_double(x), body)


def arr_trend(x, blocks: int = BLOCKS) -> Column:
    """A35 last block mean - first block mean."""
    return let(arr_block_means(x, blocks), lambda bm: F.element_at(bm, blocks) - F.element_at(bm, 1))


def arr_block_std(x, blocks: int = BLOCKS) -> Column:
    """A35 population std of the block means (NaN blocks skipped)."""
    return arr_std(arr_block_means(x, blocks), "skip")


# ---------------------------------------------------------------- several axes
def axes_magnitude(x, y, z) -> Column:
    """A26 per-sample sqrt(x^2+y^2+z^2)."""
    return F.transform(axes_norm_sq(x, y, z), lambda v: F.sqrt(v))


def axes_norm_sq(x, y, z) -> Column:
    """A26 per-sample x^2+y^2+z^2."""
    return F.zip_with(F.zip_with(as_double(x), as_double(y), lambda a, b: a * a + b * b),
                      as_double(z), lambda ab, c: ab + c * c)


def axes_sma(x, y, z) -> Column:
    """A25 sum over samples of |x|+|y|+|z| (a sum, not a mean)."""
    return asum(F.zip_with(F.zip_with(as_double(x), as_double(y), lambda a, b: F.abs(a) + F.abs(b)),
                           as_double(z), lambda ab, c: ab + F.abs(c)))


def axes_jerk(x, y, z, order: int = 1) -> Column:
    """A27 mean of the magnitude of the order-th difference of the three axes."""
    return arr_mean(axes_magnitude(arr_diff(x, order), arr_diff(y, order), arr_diff(z, order)))


def axes_roll_pitch(x, y, z) -> Column:
    """A28 struct(roll, pitch) of sample-wise atan2 angles, averaged."""
    xd, yd, zd = as_double(x), as_double(y), as_double(z)
    roll = F.zip_with(F.zip_with(xd, zd, lambda a, c: F.sqrt(a * a + c * c)), yd,
                      lambda r, b: F.atan2(b, r + F.lit(EPS_STD)))
    pitch = F.zip_with(F.zip_with(yd, zd, lambda b, c: F.sqrt(b * b + c * c)), xd,
                       lambda r, a: F.atan2(a, r + F.lit(EPS_STD)))
    return F.struct(arr_mean(roll).alias("roll"), arr_mean(pitch).alias("pitch"))


def axes_corr(x, y) -> Column:
    """A29 sum(xm*ym) / (sqrt(sum xm^2 * sum ym^2) + 1e-10)."""
    xd, yd = as_double(x), as_double(y)
    return let(F.struct(arr_mean(xd).alias("mx"), arr_mean(yd).alias("my")), lambda m: let(
        F.zip_with(xd, yd, lambda a, b: F.struct((a - m["mx"]).alias("a"), (b - m["my"]).alias("b"))),
        lambda p: asum(F.transform(p, lambda s: s["a"] * s["b"])) /
        (F.sqrt(asum(F.transform(p, lambda s: s["a"] * s["a"])) *
                asum(F.transform(p, lambda s: s["b"] * s["b"]))) + F.lit(EPS_CORR))))


def axes_dominant_ratio(x, y, z) -> Column:
    """A30 max axis variance / (sum of variances + 1e-10)."""
    vx, vy, vz = arr_var(x), arr_var(y), arr_var(z)
    return F.greatest(vx, vy, vz) / (vx + vy + vz + F.lit(EPS_CORR))


def axes_transitions(x, y, z) -> Column:
    """A31 changes of the dominant axis (argmax of |x|,|y|,|z|, ties to the first)."""
    xd, yd, zd = as_double(x), as_double(y), as_double(z)
    dom = F.zip_with(F.zip_with(xd, yd, lambda a, b: F.struct(F.abs(a).alias("a"), F.abs(b).alias("b"))), zd,
                     lambda ab, c: F.when((ab["a"] >= ab["b"]) & (ab["a"] >= F.abs(c)), F.lit(0))
                     .when(ab["b"] >= F.abs(c), F.lit(1)).otherwise(F.lit(2)))
    return let(dom, lambda d: F.size(F.filter(pairs(d, 1, lambda a, b: a != b), lambda t: t))
               .cast("double"))


# ---------------------------------------------------------------- peaks / spectra helpers
def rr_stats(peaks, fs: float) -> Column:
    """G3 RR statistics from a peak index array (needs >= 3 peaks, else all 0).

    Returns struct(mean_rr, sdnn, rmssd, pnn50, nn50, sd1, sd2, sd_ratio).
    """
    pk = col(peaks).cast("array<double>")
    zero = F.lit(0.0)

    def body(rr):
        def with_d(d):
            nd = n_of(d)
            var_rr = arr_var(rr)
            var_d = arr_var(d)
            nn50 = F.size(F.filter(d, lambda v: F.abs(v) > 50.0)).cast("double")
            sd1 = F.sqrt(0.5 * var_d)
            sd2v = 2.0 * var_rr - 0.5 * var_d
            sd2 = F.when(sd2v >= 0, F.sqrt(sd2v)).otherwise(F.lit(NAN))
            return F.struct(arr_mean(rr).alias("mean_rr"), F.sqrt(var_rr).alias("sdnn"),
                            F.sqrt(div(asum(d, lambda v: v * v), nd)).alias("rmssd"),
                            (nn50 / nd * 100.0).alias("pnn50"), nn50.alias("nn50"),
                            sd1.alias("sd1"), sd2.alias("sd2"),
                            (sd1 / (sd2 + F.lit(EPS_STD))).alias("sd_ratio"))
        return let(arr_diff(rr), with_d)
    rr = F.transform(arr_diff(pk), lambda v: v / float(fs) * 1000.0)
    empty = F.struct(*[zero.alias(k) for k in
                       ("mean_rr", "sdnn", "rmssd", "pnn50", "nn50", "sd1", "sd2")],
                     (zero / (zero + F.lit(EPS_STD))).alias("sd_ratio"))
    return F.when(F.size(pk) >= 3, let(rr, body)).otherwise(empty)


# Fixed band edges (Hz) of the heart-rate-variability spectrum.
HRV_BANDS = (("vlf", 0.0033, 0.04), ("lf", 0.04, 0.15), ("hf", 0.15, 0.4))


def band_power(psd, fs: float = 4.0, segment: int = 64) -> Column:
    """G6 trapezoid band powers over bins k*fs/segment in [lo, hi).

    Returns struct(vlf, lf, hf, lf_hf, total)."""
    ps = as_double(psd)
    step = fs / segment

    def band(lo, hi):
        sel = F.filter(F.transform(ps, lambda v, k: F.struct((k * step).alias("f"), v.alias("p"))),
                       lambda s: (s["f"] >= lo) & (s["f"] < hi))
        # trapezoid over consecutive selected bins
        return let(sel, lambda b: asum(pairs(b, 1, lambda a, c: (c["f"] - a["f"]) * (a["p"] + c["p"]) / 2.0)))
    vals = {name: band(lo, hi) for name, lo, hi in HRV_BANDS}
    return F.struct(vals["vlf"].alias("vlf"), vals["lf"].alias("lf"), vals["hf"].alias("hf"),
                    (vals["lf"] / (vals["hf"] + F.lit(EPS_CORR))).alias("lf_hf"),
                    (vals["vlf"] + vals["lf"] + vals["hf"]).alias("total"))

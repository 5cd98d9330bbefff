"""Column (higher-order function) statistics equal the NumPy kernels, and
edge rules of the reference hold."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from pulsegrid.functions import arrays as A
from pulsegrid.functions import kernels as K


def _rows(spark, data, col="x"):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(data)],
                                 f"id int, {col} array<double>")


@pytest.fixture(scope="module")
def windows(spark):
    from pulsegrid.sources.tables import ev_windows
    pdf = ev_windows(spark, MEDIUM).select("window_id", "x", "x_nan").toPandas().sort_values("window_id")
    X = np.vstack(pdf.x.values)
    XN = np.vstack(pdf.x_nan.values)
    return pdf, X, XN


PAIRS = [
    ("mean", lambda c: A.arr_mean(c), lambda X: K.mean(X)),
    ("std", lambda c: A.arr_std(c), lambda X: K.std(X)),
    ("iqr", lambda c: A.arr_iqr(c), lambda X: K.iqr(X)),
    ("skew_eps", lambda c: A.arr_skew(c), K.skew_eps),
    ("kurt_eps", lambda c: A.arr_kurt(c), K.kurt_eps),
    ("skew_c", lambda c: A.arr_skew(c, "corrected"), K.skew_corrected),
    ("kurt_c", lambda c: A.arr_kurt(c, "corrected"), K.kurt_corrected),
    ("zc", lambda c: A.arr_zero_crossings(c), lambda X: K.zero_crossings(X)),
    ("ext", lambda c: A.arr_local_extrema(c), K.local_extrema),
    ("tkeo", lambda c: A.arr_tkeo(c), lambda X: K.tkeo(X)),
    ("ac3", lambda c: A.arr_autocorr(c, 3), lambda X: K.autocorr(X, 3)),
    ("ent", lambda c: A.arr_entropy(c), K.entropy),
    ("slope", lambda c: A.arr_slope(c), K.slope),
    ("mad", lambda c: A.arr_mad(c), K.mad),
    ("head_tail", lambda c: A.arr_head_tail(c), K.head_tail),
    ("argmax", lambda c: A.arr_argmax(c), K.argmax_pos),
    ("crest", lambda c: A.arr_crest(c), K.crest),
]


@pytest.mark.parametrize("name,col_fn,np_fn", PAIRS, ids=[p[0] for p in PAIRS])
def test_column_equals_kernel(spark, windows, name, col_fn, np_fn):
    pdf, X, _ = windows
    from pulsegrid.sources.tables import ev_windows
    got = ev_windows(spark, MEDIUM).select("window_id", col_fn("x").alias("v")).toPandas().sort_values("window_id")
    np.testing.assert_allclose(got.v.values, np_fn(X), rtol=1e-9, atol=1e-9)


SKIP_PAIRS = [
    ("mean", lambda c: A.arr_mean(c, "skip"), lambda X: np.nanmean(X, axis=1)),
    ("std", lambda c: A.arr_std(c, "skip"), lambda X: np.nanstd(X, axis=1)),
    ("median", lambda c: A.arr_median(c), lambda X: np.nanmedian(X, axis=1)),
    ("iqr", lambda c: A.arr_iqr(c, "skip"), lambda X: np.nanpercentile(X, 75, axis=1) - np.nanpercentile(X, 25, axis=1)),
    ("tkeo", lambda c: A.arr_tkeo(c, "skip"), lambda X: K.tkeo(X, True)),
    ("zc", lambda c: A.arr_zero_crossings(c, "skip"), lambda X: K.zero_crossings(X, True)),
    ("bstd", lambda c: A.arr_block_std(c), lambda X: K.std(K.block_means(X), True)),
]


@pytest.mark.parametrize("name,col_fn,np_fn", SKIP_PAIRS, ids=[p[0] for p in SKIP_PAIRS])
def test_nan_skipping_flavour(spark, windows, name, col_fn, np_fn):
    _, _, XN = windows
    from pulsegrid.sources.tables import ev_windows
    got = ev_windows(spark, MEDIUM).select("window_id", col_fn("x_nan").alias("v")).toPandas().sort_values("window_id")
    with np.errstate(all="ignore"):
        np.testing.assert_allclose(got.v.values, np_fn(XN), rtol=1e-9, atol=1e-9)


def test_even_count_median_and_p90(spark):
    df = _rows(spark, [[1, 2, 3, 10]])
    r = df.select(A.arr_median("x").alias("m"), A.arr_percentile("x", 90).alias("p")).first()
    assert r.m == 2.5 and abs(r.p - 7.9) < 1e-12


def test_tiny_and_constant_rows(spark):
    df = _rows(spark, [[1.0, 2.0], [5.0, 5.0, 5.0, 5.0], [float("nan")] * 3])
    r = df.orderBy("id").select(A.arr_tkeo("x").alias("t"), A.arr_skew("x", "corrected").alias("s"),
                                A.arr_mean("x", "skip").alias("m"), A.arr_autocorr("x", 5).alias("ac")).collect()
    assert r[0].t == 0.0 and r[0].ac == 0.0             # n < 3, n <= lag
    assert math.isnan(r[1].s)                            # constant -> NaN
    assert math.isnan(r[2].m)                            # all missing -> NaN


def test_flat_top_and_edges():
    row = np.array([0, 1, 3, 3, 3, 1, 0, 2, 2, 5.0])
    assert list(K.local_maxima(row)) == [3]              # middle of the plateau; last sample never counts


def test_equal_peaks_closer_than_distance():
    row = np.array([0, 5, 0, 5, 0, 1, 0.0])
    kept = K.find_peaks_row(row, 0.0, 3)
    assert list(kept) == [3]                             # the later of two equal peaks wins


def test_rr_stats_need_three_peaks():
    out = K.rr_stats([np.array([10, 20]), np.array([0, 64, 130, 190])], 64.0)
    assert np.all(out[0] == 0)
    assert out[1][0] == pytest.approx(np.mean(np.diff([0, 64, 130, 190])) / 64 * 1000)
    assert np.all(K.hrv_frequency([np.arange(0, 70, 10)], 64.0) == 0)   # fewer than 8 peaks


def test_butterworth_design():
    b, a = K.butter_lowpass(4, 0.05, 4.0)
    assert b.sum() / a.sum() == pytest.approx(1.0, rel=1e-9)
    z = np.exp(1j * np.pi * 0.025)
    assert abs(np.polyval(b, z) / np.polyval(a, z)) == pytest.approx(1 / math.sqrt(2), rel=1e-6)


def test_filtfilt_is_linear_and_matches_matrix():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(4, 40)).cumsum(axis=1)
    b, a = K.butter_lowpass(4, 0.05, 4.0)
    np.testing.assert_allclose(K.filtfilt(b, a, X), X @ K.filtfilt_matrix(40), atol=1e-9)
    with pytest.raises(ValueError):
        K.filtfilt(b, a, X[:, :15])


def test_welch_single_segment_is_periodogram():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1, 64))
    f, p = K.welch(x, 4.0, 64)
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(64) / 64)
    spec = np.abs(np.fft.rfft((x[0] - x[0].mean()) * w)) ** 2 / (4.0 * (w * w).sum())
    spec[1:-1] *= 2
    np.testing.assert_allclose(p[0], spec)
    bp = K.band_powers(f, p)
    assert bp[0, 0] == 0.0                               # VLF holds no bin at 0.0625 Hz spacing


def test_kernels_see_slices_of_a_batch(spark, monkeypatch):
    """A long Arrow batch reaches a kernel in slices of bounded size, in row order, nulls and lengths kept."""
    from pulsegrid.operators import arrow_map as AM
    import pyarrow as pa
    arrays = [None if i % 7 == 3 else [float(i)] * (1 + i % 3) for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(arrays, pa.list_(pa.float64()))],
                                       names=["k", "a"])
    monkeypatch.setattr(AM, "SLICE_VALUES", 40)
    parts = list(AM._slices(batch, ["a"]))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert len(parts) > 10 and all(sum(len(v or ()) for v in p.column("a").to_pylist()) <= 40 for p in parts)
    assert not list(AM._slices(batch.slice(0, 0), ["a"]))

"""Signal operators per window (G1-G8), run as Arrow kernels on many windows.

Each operator takes a window table with a key and an array column and adds
result columns; the work is partitioned by Spark (one kernel call per group of
equal-length windows inside each record batch).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from pulsegrid.functions import kernels as K
from pulsegrid.operators.arrow_map import INDEX, SCALAR, VECTOR, map_arrays


def find_peaks(df: DataFrame, col: str, fs: float, distance_s: float, height_q: float = 0.5,
               keep: Sequence[str] = ("window_id",), out: str = "peaks") -> DataFrame:
    """G1: peak positions per window (array<int>)."""
    def kern(m):
        return {out: K.find_peaks(m[col], fs, distance_s, height_q)}
    return map_arrays(df, [col], [(out, INDEX)], kern, keep)


def rr_intervals(df: DataFrame, peaks: str, fs: float, keep=("window_id",)) -> DataFrame:
    """G3 as a kernel (the Column form is ``arrays.rr_stats``)."""
    names = ["mean_rr", "sdnn", "rmssd", "pnn50", "nn50", "sd1", "sd2"]

    def kern(m):
        pk = [row[~np.isnan(row)].astype(np.int64) for row in m[peaks]]
        v = K.rr_stats(pk, fs)
        return {n: v[:, i] for i, n in enumerate(names)}
    return map_arrays(df, [peaks], [(n, SCALAR) for n in names], kern, keep)


def rr_resample(df: DataFrame, peaks: str, fs: float, points: int = K.RESAMPLE_POINTS,
                keep=("window_id",), out: str = "rr_grid") -> DataFrame:
    """RR series on an equal grid (null when fewer than 8 peaks)."""
    def kern(m):
        series: list = [None] * len(m[peaks])
        for i, row in zip(*K.rr_resample(list(m[peaks]), fs, points)):
            series[i] = row
        return {out: series}
    return map_arrays(df, [peaks], [(out, VECTOR)], kern, keep)


def welch(df: DataFrame, col: str, fs: float = K.WELCH_FS, segment: int = K.WELCH_SEGMENT,
          keep=("window_id",), out: str = "psd") -> DataFrame:
    """Welch power spectral density per window; bin k is at k*fs/segment Hz."""
    def kern(m):
        _, p = K.welch(m[col], fs, segment)
        return {out: p}
    return map_arrays(df, [col], [(out, VECTOR)], kern, keep)


def hrv_frequency(df: DataFrame, peaks: str, fs: float, keep=("window_id",)) -> DataFrame:
    """G4 + G5 + G6: band powers of the resampled RR series (zeros below 8 peaks)."""
    names = ["vlf", "lf", "hf", "lf_hf", "total"]

    def kern(m):
        pk = [row.astype(np.int64) for row in m[peaks]]
        v = K.hrv_frequency(pk, fs)
        return {n: v[:, i] for i, n in enumerate(names)}
    return map_arrays(df, [peaks], [(n, SCALAR) for n in names], kern, keep)


def lowpass_split(df: DataFrame, col: str, fs: float = 4.0, cutoff: float = 0.05, order: int = 4,
                  keep=("window_id",)) -> DataFrame:
    """Zero-phase Butterworth split into tonic (low-pass) and phasic (rest)."""
    def kern(m):
        t, p = K.lowpass_split(m[col], order, cutoff, fs)
        return {"tonic": t, "phasic": p}
    return map_arrays(df, [col], [("tonic", VECTOR), ("phasic", VECTOR)], kern, keep)


def scr_peaks(df: DataFrame, phasic: str, keep=("window_id",)) -> DataFrame:
    """Skin-conductance responses on the phasic signal (count, mean and max height, energy)."""
    names = ["scr_count", "scr_amp_mean", "scr_amp_max", "phasic_energy"]

    def kern(m):
        v = K.scr_features(m[phasic])
        return {n: v[:, i] for i, n in enumerate(names)}
    return map_arrays(df, [phasic], [(n, SCALAR) for n in names], kern, keep)


def breath_rate(df: DataFrame, col: str, fs: float = 25.0, distance_s: float = 1.0, height_q: float = 0.5,
                keep=("window_id",), out: str = "breath_rate") -> DataFrame:
    """Breaths per minute from peaks (distance 1 s, median height)."""
    def kern(m):
        x = m[col]
        return {out: K.breath_rate(K.find_peaks(x, fs, distance_s, height_q), x.shape[1], fs)}
    return map_arrays(df, [col], [(out, SCALAR)], kern, keep)

"""Benchmark the headline plans and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to run a subset).  Every plan is fully executed
(``noop`` sink, or the fit itself for model plans) and timed wall-clock.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pulsegrid.session import get_spark  # noqa: E402


def _run(df):
    df.write.format("noop").mode("overwrite").save()


def plans():
    from pulsegrid.functions import arrays as A
    from pulsegrid.operators import signal as S
    from pulsegrid.operators.features import features_multirate, features_wearable
    from pulsegrid.operators.linear import fit_ols, predict
    from pulsegrid.plans import q_models, q_prep
    from pulsegrid.plans.protocols import train_protocol, transform_protocol, wearable_model
    from pulsegrid.plans.q_flagship import flagship
    from pulsegrid.operators import folds as FO
    from pulsegrid.sources.tables import ev_windows, li_long, li_multi, li_reg, li_wear

    def windows_stats(spark, d):
        w = ev_windows(spark, d)
        _run(w.select("window_id", A.arr_mean("x").alias("m"), A.arr_std("x").alias("s"),
                      A.arr_iqr("x").alias("iqr"), A.arr_zero_crossings("x").alias("zc"),
                      A.arr_skew("x", "corrected").alias("sk"), A.arr_entropy("x").alias("en"),
                      A.arr_median("x_nan").alias("md"), A.arr_tkeo("x_nan", "skip").alias("tk")))

    def flagship_model(spark, d):
        _run(flagship(spark, d))

    def ols_lineitem(spark, d):
        x = li_reg(spark, d)
        _run(predict(x, fit_ols(x, "features", "y"), "features"))

    def ridge_cv_windows(spark, d):
        q_models.q_ridge_cv(spark, d).collect()

    def features_c(spark, d):
        _run(features_wearable(li_wear(spark, d)))

    def features_d(spark, d):
        _run(features_multirate(li_multi(spark, d)))

    def peaks_hrv(spark, d):
        p = S.find_peaks(li_long(spark, d), "x", 64.0, 0.3, 0.7)
        _run(S.hrv_frequency(p, "peaks", 64.0).join(p.select("window_id", A.rr_stats("peaks", 64.0).alias("rr")),
                                                     "window_id"))

    def lowpass_scr(spark, d):
        w = li_wear(spark, d).select("window_id", F.col("bvp").alias("x"))
        _run(S.scr_peaks(S.lowpass_split(w, "x"), "phasic"))

    def robust_grid(spark, d):
        q_prep.q_robust_eps(spark, d).collect()

    def part_c(spark, d):
        w = li_wear(spark, d).filter(F.col("y").isNotNull())
        w = FO.split_random(w, "window_id", 0.2)
        pred, _, _ = wearable_model(w.filter(F.col("split") == "train"), w.filter(F.col("split") == "test"))
        _run(pred)

    def part_d(spark, d):
        base = li_multi(spark, d).filter(F.col("y").isNotNull())
        base = FO.split_temporal_blocks(base, "subject", "blk", 0.2)
        feats = features_multirate(base, ["window_id", "y", "split"])
        st = train_protocol(feats.filter(F.col("split") == "train"), "d2")
        _run(transform_protocol(feats.filter(F.col("split") == "test"), st))

    return {"windows_stats": windows_stats, "flagship_model": flagship_model, "ols_lineitem": ols_lineitem,
            "ridge_cv_windows": ridge_cv_windows, "features_wearable": features_c,
            "features_multirate": features_d, "peaks_hrv": peaks_hrv, "lowpass_scr": lowpass_scr,
            "robust_grid": robust_grid, "part_c_pipeline": part_c, "part_d_protocol": part_d}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2, app="pulsegrid-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, fn in plans().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            fn(spark, sf_dir)
            times[name] = round(time.time() - t0, 3)
        except Exception as exc:  # keep going; report the failure
            times[name] = None
            print(f"{name} failed: {type(exc).__name__}: {str(exc)[:300]}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(v for v in times.values() if v is not None), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()

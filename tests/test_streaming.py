"""Streaming scoring applies the same column plan as the batch path."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL


def test_stream_scores_equal_batch(spark):
    from pulsegrid.functions import arrays as A
    from pulsegrid.operators.linear import fit_ols, predict
    from pulsegrid.session import scratch_path
    from pulsegrid.sources.tables import ev_windows
    from pulsegrid.streaming.score import read_window_stream, score_stream, write_scores

    w = ev_windows(spark, SMALL).filter(F.col("y").isNotNull()).select("window_id", "x", "y")
    feats = {"mean": A.arr_mean("x"), "std": A.arr_std("x")}
    batch = w.withColumn("features", F.array(*feats.values()))
    model = fit_ols(batch, "features", "y")
    src, out, ck = scratch_path(spark, "stream-in-" + uuid.uuid4().hex[:10]), scratch_path(spark, "stream-out-" + uuid.uuid4().hex[:10]), scratch_path(spark, "stream-ck-" + uuid.uuid4().hex[:10])
    w.repartition(3).write.parquet(src)
    stream = read_window_stream(spark, src, w.schema, max_files_per_trigger=1)
    q = write_scores(score_stream(stream, model, None, feature_exprs=feats), out, ck, trigger_once=True)
    q.awaitTermination(120)
    got = {r.window_id: r.prediction for r in spark.read.parquet(out).collect()}
    ref = {r.window_id: r.prediction for r in predict(batch, model, "features").collect()}
    assert set(got) == set(ref)
    assert max(abs(got[k] - ref[k]) for k in ref) < 1e-9

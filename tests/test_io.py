"""Sources and sinks: NPZ ingest, fold files, grid, vectors, model tables."""

import os
import tempfile

import uuid

import numpy as np
import pytest


def test_npz_directory(spark):
    from pulsegrid.sources.files import read_labels, read_npz_dir
    d = tempfile.mkdtemp(prefix="npz-")
    rng = np.random.default_rng(0)
    for name, n, lab in (("c1s01_a", 3, True), ("c1s01_b", 2, False)):
        arrs = {"e4_temp": rng.normal(size=(n, 8)), "e4_eda": rng.normal(size=(n, 8)), "e4_hr": rng.normal(size=(n, 2)),
                "e4_bvp": rng.normal(size=(n, 128)), "e4_acc": rng.normal(size=(n, 64 * 3)),
                "zephyr_ecg": rng.normal(size=(n, 500)), "zephyr_breathing": rng.normal(size=(n, 50)),
                "zephyr_acc": rng.normal(size=(n, 20 * 3))}
        if lab:
            arrs["glucose"] = rng.normal(size=n)
        np.savez(os.path.join(d, f"{name}.npz"), **arrs)
        if name == "c1s01_a":
            first = arrs
    df = read_npz_dir(spark, d)
    rows = sorted(df.collect(), key=lambda r: (r.subject, r.window))
    assert len(rows) == 5
    assert rows[0].part == "a" and rows[0].label == pytest.approx(first["glucose"][0])
    np.testing.assert_allclose(rows[0].e4_acc_y, first["e4_acc"][0].reshape(-1, 3)[:, 1], rtol=1e-6)
    lab, viol = read_labels(df)
    assert viol.count() == 2                              # the unlabelled file


def subject_files(folder, windows=24):
    rng = np.random.default_rng(5)
    for name in ("s01_a", "s01_b", "s02_a"):
        beat = rng.normal(size=(windows, 1)) + np.sin(np.arange(500) / rng.uniform(6, 12, size=(windows, 1)))
        np.savez(os.path.join(folder, f"{name}.npz"), e4_temp=rng.normal(30, 1, size=(windows, 40)),
                 e4_eda=rng.normal(size=(windows, 64)), e4_hr=rng.normal(70, 5, size=(windows, 16)),
                 e4_bvp=rng.normal(size=(windows, 256)), e4_acc=rng.normal(size=(windows, 32 * 3)),
                 zephyr_ecg=beat, zephyr_breathing=rng.normal(size=(windows, 100)),
                 zephyr_acc=rng.normal(size=(windows, 20 * 3)), glucose=rng.normal(100, 20, size=windows))


def test_subject_files_to_protocol_and_back(spark, tmp_path):
    """NPZ folder -> features -> split by part -> fitted chain -> saved, refused, loaded, replayed."""
    from pyspark.sql import functions as F

    from pulsegrid.operators import folds as FO
    from pulsegrid.operators.features import MULTIRATE_NAMES
    from pulsegrid.plans.protocols import (_state, apply_stages, fit_stages, subject_file_features, train_protocol,
                                           transform_protocol)
    from pulsegrid.session import scratch_path
    from pulsegrid.sources.files import load_model, read_npz_dir, save_model
    subject_files(tmp_path)
    rows = subject_file_features(read_npz_dir(spark, str(tmp_path)))
    assert rows.count() == 72 and rows.select("window_id").distinct().count() == 72
    split = FO.split_temporal(rows, "part", "a").persist()
    assert {(r.split, r["count"]) for r in split.groupBy("split").count().collect()} == {("train", 48), ("test", 24)}
    train, test = (split.filter(F.col("split") == s) for s in ("train", "test"))
    stages, names, out = fit_stages(train, "d2", "features", "y", MULTIRATE_NAMES)
    path = scratch_path(spark, "chain-" + uuid.uuid4().hex[:10])
    save_model(spark, {"protocol": "d2", "intercept": 0.5, "coef": np.arange(len(names)), "feature_names": names,
                       "stages": [(n, _state(s)) for n, s in stages]}, path)
    with pytest.raises(ValueError):
        load_model(spark, path, "d1")
    again = {r.window_id: r.features_out for r in transform_protocol(test, load_model(spark, path, "d2")).collect()}
    first = {r.window_id: r[out] for r in apply_stages(test, stages).select("window_id", out).collect()}
    assert set(again) == set(first) and len(first) == 24
    for k, v in first.items():
        assert len(v) == 495
        np.testing.assert_array_equal(np.asarray(again[k]), np.asarray(v))
    with pytest.raises(ValueError):          # a label that isn't finite
        train_protocol(train.withColumn("y", F.lit(float("nan"))), "d2")


def test_model_protocol_guard(spark):
    from pulsegrid.session import scratch_path
    from pulsegrid.sources.files import load_model, save_model
    path = scratch_path(spark, "model-guard-" + uuid.uuid4().hex[:10])
    save_model(spark, {"protocol": "d2", "intercept": 1.5, "coef": [1.0, 2.0], "feature_names": ["a", "b"],
                       "stages": [("scaler", {"mean": np.array([0.0, 1.0]), "std": np.array([1.0, 2.0])})]}, path)
    st = load_model(spark, path, "d2")
    assert st["intercept"] == 1.5 and list(st["coef"]) == [1.0, 2.0]
    assert st["stages"][0][0] == "scaler"
    with pytest.raises(ValueError):
        load_model(spark, path, "d3")


def test_grid_and_vectors(spark):
    from pulsegrid.operators.checks import check_lines
    from pulsegrid.session import scratch_path
    from pulsegrid.sources.files import _lines, read_grid, read_vector
    g = scratch_path(spark, "grid-t-" + uuid.uuid4().hex[:10])
    spark.createDataFrame([("0",), ("",), (" 1e2 ",), ("0.10",)], "value string").coalesce(1).write.text(g)
    rows = read_grid(spark, g).orderBy("pos").collect()
    assert [r.raw for r in rows] == ["0", "1e2", "0.10"] and rows[1].lam == 100.0
    v = scratch_path(spark, "vec-t-" + uuid.uuid4().hex[:10])
    spark.createDataFrame([("1.5",), ("2 3",), ("x",), ("nan",)], "value string").coalesce(1).write.text(v)
    vec, viol = read_vector(spark, v)
    assert viol.count() == 3
    assert check_lines(_lines(spark, v)).count() == 3


def test_fold_file_forms(spark):
    from pulsegrid.operators.windows import with_row_index
    from pulsegrid.session import scratch_path
    from pulsegrid.sources.files import read_folds
    idx = with_row_index(spark.range(10).withColumnRenamed("id", "k"), ["k"])
    f1 = scratch_path(spark, "f1-" + uuid.uuid4().hex[:10])
    spark.createDataFrame([("folds = [3, 6, 8]",)], "value string").coalesce(1).write.text(f1)
    got = {r.k: r.fold for r in read_folds(spark, f1, idx).collect()}
    assert [got[i] for i in range(10)] == [0, 0, 0, 1, 1, 1, 2, 2, None, None]
    f2 = scratch_path(spark, "f2-" + uuid.uuid4().hex[:10])
    spark.createDataFrame([("0, 1 2",), ("0 1,2, 0",), ("1 2 0",)], "value string").coalesce(1).write.text(f2)
    got = {r.k: r.fold for r in read_folds(spark, f2, idx).collect()}
    assert [got[i] for i in range(10)] == [0, 1, 2, 0, 1, 2, 0, 1, 2, 0]


def test_row_index_is_contiguous_with_hot_key(spark):
    from pyspark.sql import functions as F
    from pulsegrid.operators.windows import with_row_index
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5)).alias("g"),
                                  F.col("id"))
    out = with_row_index(df, ["id"], "rn", partition_cols=["g"], num_partitions=16)
    pdf = out.toPandas().sort_values(["g", "id"])
    for _, grp in pdf.groupby("g"):
        assert list(grp.rn) == list(range(len(grp)))


def test_line_order_over_part_files_of_unequal_size(spark, tmp_path):
    """Splits are read largest first; line numbers follow the file names."""
    from pulsegrid.sources.files import read_vector
    sizes, at = (30, 4000, 5, 900), 0
    folder = tmp_path / "parts"
    folder.mkdir()
    for k, n in enumerate(sizes):
        (folder / f"part-{k:05d}.txt").write_text("".join(f"{v}.0\n" for v in range(at, at + n)))
        at += n
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")     # the large file is read in several blocks
    try:
        vec, bad = read_vector(spark, str(folder))
        rows = vec.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == at and all(r.pos == r.value for r in rows) and bad.count() == 0


def test_npz_folder_without_files_fails(spark, tmp_path):
    from pulsegrid.sources.files import read_npz_dir
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_npz_dir(spark, str(tmp_path / "empty"))


def test_window_keys_of_long_subjects_are_unique(spark):
    from pulsegrid.operators.windows import cut_windows
    rows = spark.range(2 * 4800).selectExpr("id % 2 AS subject", "id AS t", "cast(id AS double) AS v")
    w = cut_windows(rows, "subject", ["t"], ["v"], 4)
    assert w.count() == 2400 and w.select("window_id").distinct().count() == 2400


def test_many_fold_ends_and_edges(spark):
    """More ends than one expression holds: the same folds as the expression gives, empty ranges and the
    rows past the last end included; falling ends raise."""
    from pulsegrid.operators.folds import assign_ranges, range_fold_expr
    rng = np.random.default_rng(0)
    df = spark.range(3000).withColumnRenamed("id", "row_index")
    for ends in (sorted(rng.integers(0, 2900, 400).tolist()), [0, 0, 5, 5, 2900], list(range(1, 2001)), []):
        table = spark.createDataFrame(list(enumerate(ends)), "pos long, end long")
        got = {r.row_index: r.fold for r in assign_ranges(df, table, "row_index").collect()}
        few = ends[:60]
        if len(ends) <= 60:
            want = {r.row_index: r.fold for r in df.withColumn("fold", range_fold_expr("row_index", few)).collect()}
        else:
            want = {i: int(np.searchsorted(ends, i, "right")) if i < ends[-1] else None for i in range(3000)}
        assert got == want
    with pytest.raises(Exception, match="fold ends fall"):
        assign_ranges(df, spark.createDataFrame([(0, 9), (1, 4)], "pos long, end long"), "row_index").collect()


def test_stages_save_and_load(spark):
    """Unfitted and fitted stages keep their values; a function as score can't be saved."""
    from pyspark.ml import Pipeline, PipelineModel

    from pulsegrid.operators.prep import (LassoSelector, MedianImputer, PolynomialExpansion, PopulationScaler,
                                          SelectKBest)
    from pulsegrid.session import scratch_path
    rng = np.random.default_rng(1)
    X = rng.normal(size=(80, 6))
    X[3, 2] = np.nan
    df = spark.createDataFrame([(i, X[i].tolist(), float(X[i, 0] - X[i, 4])) for i in range(80)],
                               "window_id long, f array<double>, y double")
    stages = [MedianImputer("f", "a", width=6), PopulationScaler("a", "b"), SelectKBest("b", "c", "y", k=3),
              PolynomialExpansion("c", "d", width=3, names=list("pqr")),
              LassoSelector("d", "e", "y", "window_id", alpha=0.01, k=4)]
    path = scratch_path(spark, "stages-" + uuid.uuid4().hex)
    Pipeline(stages=stages).write().save(path + "-plan")
    plan = Pipeline.load(path + "-plan")
    assert [s.arguments() for s in plan.getStages()] == [s.arguments() for s in stages]
    assert [s.uid for s in plan.getStages()] == [s.uid for s in stages]
    fitted = plan.fit(df)
    fitted.write().save(path)
    again = PipelineModel.load(path)
    a, b = ({r.window_id: r.e for r in m.transform(df).collect()} for m in (fitted, again))
    assert a == b and len(a[0]) == 4
    assert again.stages[3].out_names() == ["p", "q", "r", "p^2", "p*q", "p*r", "q^2", "q*r", "r^2"]
    # all but the last stage, as the transform step replays it
    assert "e" not in PipelineModel(again.stages[:-1]).transform(df).columns
    with pytest.raises(ValueError):
        SelectKBest("f", "g", "y", score=lambda *a: None).write()


def test_value_watch(spark):
    from pulsegrid.operators.checks import ValueWatch
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(3, [1.0, inf]), (1, [nan, None]), (2, [1.0, 2.0]), (4, None)], "k long, v array<double>")
    watch = ValueWatch("poly", "v", "k")
    assert watch.on(df).count() == 4
    assert [tuple(r) for r in watch.violations(spark).collect()] == [("finite:poly", "1", "3 rows, 4 values")]
    for clean in (df.filter("k = 2"), df.limit(0)):
        watch = ValueWatch("clean", "v", "k")
        watch.on(clean).collect()
        assert watch.violations(spark).count() == 0

"""Properties of the distributed fits (survey test strategy (3))."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def li(spark):
    from pulsegrid.sources.tables import li_reg
    from pulsegrid.operators import folds as FO
    d = li_reg(spark, MEDIUM).withColumn("fold", FO.fold_expr("l_orderkey", 3))
    pdf = d.select("features", "y", "fold").toPandas()
    return d, np.vstack(pdf.features.values), pdf.y.values, pdf.fold.values


def test_ols_equals_numpy(li):
    from pulsegrid.operators.linear import fit_ols
    d, X, y, _ = li
    m = fit_ols(d, "features", "y")
    ref = np.linalg.lstsq(np.column_stack([np.ones(len(y)), X]), y, rcond=None)[0]
    np.testing.assert_allclose(m.weights(), ref, rtol=1e-8)


def test_ridge_zero_lambda_is_ols_and_fold_moments_add_up(li):
    from pulsegrid.operators.linear import fit_ols, fit_ridge
    from pulsegrid.operators.moments import moment_sums, total
    d, X, y, f = li
    np.testing.assert_allclose(fit_ridge(d, "features", "y", 0.0).weights(), fit_ols(d, "features", "y").weights(),
                               rtol=1e-10)
    per = moment_sums(d, "features", "y", group="fold")
    tot = moment_sums(d, "features", "y")[0]
    np.testing.assert_allclose(total(per).G, tot.G, rtol=1e-9, atol=1e-6)


def test_ridge_cv_matches_masked_numpy(li):
    from pulsegrid.operators.linear import ridge_cv
    d, X, y, f = li
    grid = [("0", 0.0), ("10", 10.0), ("1e3", 1000.0)]
    rows, means, best, model = ridge_cv(d, "features", "y", "fold", grid)
    Xa = np.column_stack([np.ones(len(y)), X])
    R = np.eye(4)
    R[0, 0] = 0
    for pos, raw, lam, k, err in rows:
        tr, va = f != k, f == k
        w = np.linalg.solve(Xa[tr].T @ Xa[tr] + lam * R, Xa[tr].T @ y[tr])
        e = ((y[va] - Xa[va] @ w) ** 2).sum() / ((y[va] - y[va].mean()) ** 2).sum()
        assert err == pytest.approx(e, rel=1e-8)


def test_lasso_kkt(li):
    from pulsegrid.operators.linear import fit_lasso
    d, X, y, _ = li
    alpha = 5.0
    m = fit_lasso(d, "features", "y", alpha)
    Xc, yc = X - X.mean(0), y - y.mean()
    g = Xc.T @ (yc - Xc @ m.coef) / len(y)
    nz = m.coef != 0
    np.testing.assert_allclose(np.abs(g[nz]), alpha, rtol=1e-3)
    assert np.all(np.abs(g[~nz]) <= alpha * (1 + 1e-6))


def test_robust_objective_beats_probes(spark):
    from pulsegrid.operators.robust import ALL_ROWS, GridPoint, fit_robust_grid
    from pulsegrid.plans.q_models import ev_reg
    d = ev_reg(spark, MEDIUM)
    pdf = d.select("features", "y").toPandas()
    X, y = np.vstack(pdf.features.values), pdf.y.values
    grid = [GridPoint(0.0), GridPoint(0.01, 0.5, 5.0)]
    for method in ("mm", "wide"):
        _, models = fit_robust_grid(d, "features", "y", grid, method=method)
        for i, gp in enumerate(grid):
            m = models[(i, ALL_ROWS)]

            def obj(b, w):
                r = y - b - X @ w
                return np.mean(np.maximum(np.abs(r) - gp.epsilon, 0)) + gp.alpha * (
                    gp.l1_ratio * np.abs(w).sum() + (1 - gp.l1_ratio) / 2 * (w ** 2).sum())
            o = obj(m.intercept, m.coef)
            rng = np.random.default_rng(i)
            probes = [obj(m.intercept + rng.normal() * 0.5, m.coef + rng.normal(size=2) * 0.05) for _ in range(200)]
            assert o <= min(probes) + 1e-3 * abs(o), (method, i)


def test_robust_solver_reaches_the_minimum(spark):
    """A random descent from the solution finds nothing lower, narrow and 44 columns wide."""
    from pulsegrid.operators.robust import ALL_ROWS, GridPoint, fit_robust_grid
    rng = np.random.default_rng(8)
    for p in (2, 44):
        X = rng.normal(size=(500, p)).astype("f4").astype(float)
        y = X[:, :2] @ [3.0, -2.0] + rng.standard_t(2, size=500) * 4
        df = spark.createDataFrame([(X[i].tolist(), float(y[i])) for i in range(500)], "f array<double>, y double")
        grid = [GridPoint(0.1, 0.15, 1.0), GridPoint(0.05, 0.0, 0.0)]
        _, models = fit_robust_grid(df, "f", "y", grid, method="mm")
        for k, gp in enumerate(grid):
            m = models[(k, ALL_ROWS)]

            def obj(v):
                r = np.abs(y - v[0] - X @ v[1:])
                return np.maximum(r - gp.epsilon, 0).mean() + gp.alpha * (
                    gp.l1_ratio * np.abs(v[1:]).sum() + (1 - gp.l1_ratio) / 2 * (v[1:] ** 2).sum())
            v = np.concatenate([[m.intercept], m.coef])
            start = best = obj(v)
            assert m.meta["objective"] == pytest.approx(start, rel=1e-6)
            width = 0.3
            for _ in range(20000):
                u = v + rng.normal(size=p + 1) * width
                if (o := obj(u)) < best:
                    v, best, width = u, o, width * 1.3
                else:
                    width = max(width * 0.995, 1e-6)
            assert start <= best * (1 + 1e-4), (p, k, start, best)


def test_wide_robust_fits_are_certified(spark):
    """Collinear, constant and more columns than a narrow fit takes: the gap bounds what the narrow
    solver can still gain, folds train on their own rows, and a fit that is cut short raises."""
    from pulsegrid.operators import robust as R
    rng = np.random.default_rng(3)
    n, p = 600, 40
    X = rng.normal(size=(n, 8)) @ rng.normal(size=(8, p)) + 0.05 * rng.normal(size=(n, p))
    X[:, 0], X[:, 1] = 1.0, X[:, 2]
    X = X.astype("f4").astype(float)
    y = X[:, 3] * 2 + rng.standard_t(2, size=n) * 3 + 70
    rows = [(X[i].tolist(), float(y[i]), None if i % 4 == 3 else i % 4) for i in range(n)]
    df = spark.createDataFrame(rows, "f array<double>, y double, fold int").repartition(3).persist()
    grid = [R.GridPoint(1e-3), R.GridPoint(0.0), R.GridPoint(1e-2, 0.5, 2.0), R.GridPoint(0.1, 1.0, 1.0)]
    scores, wide = R.fit_robust_grid(df, "f", "y", grid, "fold", 3, method="wide")
    fold = np.array([-1 if r[2] is None else r[2] for r in rows])
    for (pos, f), m in wide.items():
        assert m.meta["gap"] <= R.GAP
        keep = fold != f if f != R.ALL_ROWS else np.ones(n, bool)
        gp, r = grid[pos], y[keep] - m.intercept - X[keep] @ m.coef
        value = np.maximum(np.abs(r) - gp.epsilon, 0).mean() + gp.alpha * (
            gp.l1_ratio * np.abs(m.coef).sum() + (1 - gp.l1_ratio) / 2 * (m.coef ** 2).sum())
        assert m.meta["objective"] == pytest.approx(value, rel=1e-6) and m.meta["train_rows"] == keep.sum()
    for pos, f, mae in scores:
        hold = fold == f
        m = wide[(pos, f)]
        assert mae == pytest.approx(np.abs(y[hold] - m.intercept - X[hold] @ m.coef).mean(), rel=1e-6)
    _, narrow = R.fit_robust_grid(df, "f", "y", [grid[0], grid[2]], method="mm")
    for k, pos in enumerate((0, 2)):
        m, best = wide[(pos, R.ALL_ROWS)], narrow[(k, R.ALL_ROWS)].meta["objective"]
        assert best - 1e-9 <= m.meta["objective"] * (1 + 1e-9)
        assert m.meta["objective"] - best <= m.meta["gap"] * y.std() + 1e-6     # the gap is an upper bound
    few = R._fit_wide
    try:
        R._fit_wide = lambda *a, **k: few(*a, **{**k, "max_passes": 8})
        with pytest.raises(RuntimeError, match="duality gap above"):
            R.fit_robust_grid(df, "f", "y", [R.GridPoint(0.0)], method="wide", gap=1e-9)
    finally:
        R._fit_wide = few


def test_screened_lasso_equals_the_full_solve(spark, monkeypatch):
    """More columns than the Gramian takes at once, more than rows too: same solution as on all columns,
    with a certified gap; a tiny step forces several rounds."""
    from pulsegrid.operators import linear as L
    rng = np.random.default_rng(11)
    n, p = 180, 400
    X = rng.normal(size=(n, 30)) @ rng.normal(size=(30, p)) + 0.3 * rng.normal(size=(n, p))
    X[:, 7], X[:, 9] = 2.5, X[:, 8]
    y = X[:, :6].sum(1) + rng.normal(size=n) + 12
    df = spark.createDataFrame([(X[i].tolist(), float(y[i])) for i in range(n)], "f array<double>, y double").repartition(3)
    monkeypatch.setattr(L, "SCREEN_STEP", 40)
    for alpha, l1 in ((0.05, 1.0), (0.01, 0.5)):
        m = L.fit_lasso(df, "f", "y", alpha, l1, tol=1e-9)
        assert 0 <= m.meta["gap"] + 1e-12 and m.meta["gap"] <= 1e-9 and m.coef[7] == 0.0
        Xc, yc = X - X.mean(0), y - y.mean()
        full = L.lasso_cd(Xc.T @ Xc, Xc.T @ yc, n, alpha, l1, tol=1e-12)
        obj = lambda w: ((yc - Xc @ w) ** 2).sum() / (2 * n) + alpha * (
            l1 * np.abs(w).sum() + (1 - l1) / 2 * (w ** 2).sum())
        assert obj(m.coef) == pytest.approx(obj(full), rel=1e-8)
        np.testing.assert_allclose(Xc @ m.coef, Xc @ full, atol=1e-3)


def test_exact_median_matches_numpy(spark):
    from pulsegrid.operators.prep import column_medians
    from pulsegrid.sources.tables import ev_windows
    w = ev_windows(spark, MEDIUM)
    XN = np.vstack(w.select("x_nan").toPandas().x_nan.values)
    med = column_medians(w, "x_nan", limit=20, buckets=4)      # force several refinement rounds
    np.testing.assert_allclose([med[i] for i in range(16)], np.nanmedian(XN, axis=0))


def test_fscores_match_numpy(li):
    from pulsegrid.operators.prep import f_scores, top_k_indices
    d, X, y, _ = li
    f, n = f_scores(d, "features", "y")
    r = np.array([np.corrcoef(X[:, j], y)[0, 1] for j in range(3)])
    np.testing.assert_allclose(f, r * r / (1 - r * r) * (len(y) - 2), rtol=1e-8)
    assert list(top_k_indices(np.array([1.0, np.nan, 3.0, 3.0]), 2)) == [2, 3]


def test_partition_count_does_not_change_results(li):
    from pulsegrid.operators.linear import fit_ols
    d, *_ = li
    a = fit_ols(d.repartition(3), "features", "y").weights()
    b = fit_ols(d.repartition(17), "features", "y").weights()
    np.testing.assert_allclose(a, b, rtol=1e-10)


def test_poly_order_and_names(spark):
    from pulsegrid.operators.prep import PolynomialExpansion, poly_names
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "features array<double>")
    out = PolynomialExpansion("features", "p", width=3).transform(df).first().p
    assert out == [1, 2, 3, 1, 2, 3, 4, 6, 9]
    assert poly_names(["a", "b"]) == ["a", "b", "a^2", "a*b", "b^2"]
    assert poly_names(["a", "b"], " ")[3] == "a b"


def test_population_scaler(spark):
    from pulsegrid.operators.prep import PopulationScaler
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "features array<double>")
    m = PopulationScaler().fit(df)
    assert list(m.std) == [1.0, 1.0]                     # pop std 1; zero std -> 1
    assert sorted(r.features[0] for r in m.transform(df).collect()) == [-1.0, 1.0]


def psi(m):
    return -0.5772156649015329 + sum(1.0 / i for i in range(1, int(m)))


def mi_of(x, y, k=3):
    """The estimator of one feature over all pairs (inputs scaled and jittered already)."""
    dx, dy = np.abs(x[:, None] - x), np.abs(y[:, None] - y)
    d = np.maximum(dx, dy)
    np.fill_diagonal(d, np.inf)
    eps = np.sort(d, axis=1)[:, k - 1][:, None]
    nx, ny = (dx < eps * (1 - 1e-12)).sum(1), (dy < eps * (1 - 1e-12)).sum(1)
    table = np.array([0.0, *[psi(m) for m in range(1, len(x) + 1)]])
    return max(0.0, psi(len(x)) + psi(k) - table[nx].mean() - table[ny].mean())


def mi_brute(X, y):
    ys = y / (y.std() or 1.0)
    return np.array([mi_of(X[:, j] / (X[:, j].std() or 1.0), ys) for j in range(X.shape[1])])


@pytest.mark.parametrize("bounds", [{}, {"group": 500}, {"group": 0, "cell": 16, "queries": 8}])
def test_mutual_info_of_tied_columns(spark, bounds):
    """Constant, mostly zero, few-valued, heavy-tailed and continuous columns, heavy-tailed and discrete
    labels too: the same jittered points over all pairs give the same scores, whatever the groups."""
    from pulsegrid.operators.mutual_info import mi_scores
    rng = np.random.default_rng(4)
    n = 400
    y = rng.standard_cauchy(n)
    for label in (y, np.round(np.clip(y, -9, 9))):
        X = np.column_stack([np.ones(n), np.where(rng.random(n) < 0.7, 0.0, y + rng.normal(size=n)),
                             np.round(2 * np.tanh(y)), rng.standard_cauchy(n), y + rng.normal(size=n)])
        df = spark.createDataFrame([(X[i].tolist(), float(label[i])) for i in range(n)], "f array<double>, lab double")
        seen, sizes = [], []
        got = mi_scores(df, "f", "lab", points=seen, sizes=sizes, **bounds)
        px, py = seen[0]
        np.testing.assert_allclose(got, [mi_of(x, py) for x in px.T], rtol=1e-9, atol=1e-9)
        if bounds.get("group") == 0:
            assert sizes[0] <= 2 * 16 + 2


def test_mutual_info_groups_stay_bounded(spark):
    """Independent heavy-tailed points: cells keep their size as n grows, and a cell is asked by
    a share of the points that shrinks (the rim), not by all of them."""
    from pulsegrid.operators.mutual_info import mi_scores
    share = []
    for n in (2000, 18000):
        rng = np.random.default_rng(n)
        df = spark.createDataFrame([([float(a)], float(b)) for a, b in
                                    zip(rng.standard_cauchy(n), rng.standard_cauchy(n))], "f array<double>, lab double")
        sizes, seen = [], []
        got = mi_scores(df, "f", "lab", group=0, cell=64, queries=256, sizes=sizes, points=seen)
        assert sizes[0] <= 2 * 64 + 2
        share.append(sizes[1] / n)
        np.testing.assert_allclose(got, mi_scores(df, "f", "lab"), rtol=1e-9, atol=1e-9)
    assert share[1] < share[0]


def test_mutual_info_matches_brute_force(spark):
    """k-NN MI in one group and over small cells equals the O(n^2) estimator on
    tie-free window statistics."""
    from pulsegrid.functions import arrays as A
    from pulsegrid.operators.mutual_info import mi_scores
    from pulsegrid.sources.tables import ev_windows
    w = ev_windows(spark, MEDIUM).select(
        F.array(A.arr_mean("x"), A.arr_std("x"), A.arr_rms("x")).alias("f"),
        (A.arr_mean("x") * 0.5 + A.arr_std("x")).alias("lab"))
    pdf = w.toPandas()
    X, y = np.vstack(pdf.f.values), pdf.lab.values
    for j in range(X.shape[1]):
        assert len(np.unique(X[:, j])) == len(y)      # no ties: jitter cannot change a count
    assert len(np.unique(y)) == len(y)
    # the means lie on a lattice, so distances tie: without jitter both sides see the same ties ...
    for bounds in ({}, {"group": 0, "cell": 8, "queries": 16}):
        np.testing.assert_allclose(mi_scores(w, "f", "lab", jitter=0.0, **bounds), mi_brute(X, y), rtol=1e-9, atol=1e-12)
    # ... and with it the jittered points decide
    seen = []
    got = mi_scores(w, "f", "lab", points=seen)
    np.testing.assert_allclose(got, [mi_of(x, seen[0][1]) for x in seen[0][0].T], rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(got, mi_brute(X, y), rtol=1e-3)


def test_mutual_info_edges(spark):
    from pulsegrid.operators.mutual_info import mi_scores
    schema = "f array<double>, lab double"
    assert len(mi_scores(spark.createDataFrame([], schema), "f", "lab")) == 0
    for n in (1, 2, 3):
        df = spark.createDataFrame([([float(i), 1.0], float(i * i)) for i in range(n)], schema)
        for bounds in ({}, {"group": 0, "cell": 4}):
            assert np.isfinite(mi_scores(df, "f", "lab", **bounds)).all()


def test_protocol_chains_side_by_side_equal_one_alone(spark):
    """Part d fits its fold chains concurrently; the refit chain must equal
    the same chain fitted on its own."""
    from conftest import SMALL
    from pulsegrid.operators import folds as FO
    from pulsegrid.operators.features import MULTIRATE_NAMES, features_multirate
    from pulsegrid.plans.protocols import _state, evaluate, fit_stages, train_protocol, transform_protocol
    from pulsegrid.sources.tables import li_multi
    base = li_multi(spark, SMALL).filter(F.col("y").isNotNull())
    feats = features_multirate(base).join(base.select("window_id", "y"), "window_id")
    st = train_protocol(feats, "d2")
    data = feats.select("window_id", "features", "y").withColumn("fold", FO.fold_expr("window_id", 3, 42))
    alone, names, _ = fit_stages(data, "d2", "features", "y", MULTIRATE_NAMES)
    assert names == st["feature_names"]
    assert [n for n, _ in alone] == [n for n, _ in st["stages"]]
    for (_, a), (_, b) in zip(alone, st["stages"]):
        sa = _state(a)
        assert sa.keys() == b.keys()
        for k in sa:       # selections exact; fitted statistics up to summation order
            if k == "indices":
                np.testing.assert_array_equal(np.asarray(sa[k]), np.asarray(b[k]))
            else:
                np.testing.assert_allclose(np.asarray(sa[k]), np.asarray(b[k]), rtol=1e-9, atol=1e-15)
    # the metrics, recomputed from the model state and the labels alone
    out = {r.window_id: np.asarray(r.features_out) for r in transform_protocol(feats, st).collect()}
    lab = {r.window_id: r.y for r in feats.select("window_id", "y").collect()}
    y = np.array([lab[k] for k in out])
    r = y - st["intercept"] - np.array([out[k] @ np.asarray(st["coef"]) for k in out])
    got, tops = evaluate(transform_protocol(feats, st), feats.select("window_id", "y"), st)
    got = got.first()
    assert got.n == len(y)
    np.testing.assert_allclose([got.nmse, got.nmae, got.mae],
                               [(r @ r) / ((y - y.mean()) ** 2).sum(), np.abs(r).sum() / np.abs(y - y.mean()).sum(),
                                np.abs(r).mean()], rtol=1e-9)
    assert [t.pos for t in tops.collect()] == sorted(range(495), key=lambda i: (-abs(st["coef"][i]), i))[:5]
    means = [np.mean([m for p, _, m in st["scores"] if p == i]) for i in range(9)]
    assert st["extra"]["best"] == int(np.argmin(means))


def test_d1_chains_equal_separate_fits(spark):
    """Protocol d1: chains of all folds fitted in shared scans select and scale as each one does alone."""
    from pulsegrid.operators import folds as FO
    from pulsegrid.operators.fold_chains import chain_columns, fit_chains
    rng = np.random.default_rng(2)
    n, p = 240, 9
    X = rng.normal(size=(n, p)) * rng.uniform(1, 50, p) + 3
    X[:, 4], X[:, 5] = 7.0, np.round(X[:, 5] / 20)
    y = X[:, 0] + 0.2 * X[:, 1] * X[:, 2] + rng.normal(size=n)
    X[rng.random((n, p)) < 0.05] = np.nan
    rows = [(i, X[i].tolist(), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, f array<double>, y double").withColumn("fold", FO.fold_expr("k", 3, 1)).persist()
    chains = fit_chains(df, [0, 1, 2, None], "f", "y", "fold", "k", p, "mi", False, 4, 6)
    fold = {r.k: r.fold for r in df.select("k", "fold").collect()}
    fold = np.array([fold[i] for i in range(n)])
    for c in chains:
        keep = np.ones(n, bool) if c.fold is None else fold != c.fold
        med = np.nanmedian(X[keep], axis=0)
        np.testing.assert_allclose(c.medians, med)
        Z = np.where(np.isnan(X[keep]), med, X[keep])
        std = Z.std(0)
        np.testing.assert_allclose(c.mean, Z.mean(0), rtol=1e-12)
        assert c.std[4] == 1.0
        np.testing.assert_allclose(np.delete(c.std, 4), np.delete(std, 4), rtol=1e-12)
        alone = fit_chains(df.filter((F.col("fold") != (-1 if c.fold is None else c.fold))), [None], "f", "y", "fold", "k",
                           p, "mi", False, 4, 6)[0]
        np.testing.assert_array_equal(c.base, alone.base)
        np.testing.assert_array_equal(c.final, alone.final)
        np.testing.assert_allclose(c.scores1, alone.scores1, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(c.scores2, alone.scores2, rtol=1e-9, atol=1e-9)
        assert {0} <= set(c.base.tolist())
        stages, names, out = c.stages("f", [f"x{i}" for i in range(p)], "t")
        replay = df
        for _, st in stages:
            replay = st.transform(replay)
        own = {r.k: r[out] for r in replay.select("k", out).collect()}
        fast = {r.k: r.o for r in chain_columns(df, [c], "f", ["k"], ["o"]).collect()}
        for k in own:
            np.testing.assert_allclose(own[k], fast[k], rtol=1e-5, atol=1e-5)
        assert len(names) == 6


def test_d1_protocol_end_to_end(spark):
    """E9 d1 on small windows: certified fits, 495 features, metrics recomputed from the state."""
    from pulsegrid.operators.features import features_multirate
    from pulsegrid.operators.robust import GAP
    from pulsegrid.plans.protocols import evaluate, train_protocol, transform_protocol
    from pulsegrid.sources.tables import li_multi
    base = li_multi(spark, SMALL).filter(F.col("y").isNotNull())
    feats = features_multirate(base, ["window_id", "y"]).persist()
    st = train_protocol(feats, "d1")
    assert len(st["coef"]) == len(st["feature_names"]) == 495 and st["extra"]["gap"] <= GAP
    out = {r.window_id: np.asarray(r.features_out) for r in transform_protocol(feats, st).collect()}
    lab = {r.window_id: r.y for r in feats.select("window_id", "y").collect()}
    y = np.array([lab[k] for k in out])
    r = y - st["intercept"] - np.array([out[k] @ np.asarray(st["coef"]) for k in out])
    got = evaluate(transform_protocol(feats, st), feats.select("window_id", "y"), st)[0].first()
    np.testing.assert_allclose([got.nmse, got.nmae, got.mae],
                               [(r @ r) / ((y - y.mean()) ** 2).sum(), np.abs(r).sum() / np.abs(y - y.mean()).sum(),
                                np.abs(r).mean()], rtol=1e-9)
    means = [np.mean([m for p, _, m in st["scores"] if p == i]) for i in range(3)]
    assert st["extra"]["best"] == int(np.argmin(means))


def test_wearable_model_on_whole_windows(spark):
    """Part c on a short grid: every test window gets a finite prediction by the chosen
    model, and values that aren't finite fail."""
    from conftest import SMALL
    from pulsegrid.operators import folds as FO
    from pulsegrid.plans.protocols import wearable_model
    from pulsegrid.sources.tables import li_wear
    w = FO.split_random(li_wear(spark, SMALL).filter(F.col("y").isNotNull()), "window_id", 0.2).persist()
    train, test = (w.filter(F.col("split") == s) for s in ("train", "test"))
    pred, model, info = wearable_model(train, test, alphas=(1e-2, 1.0), lasso_keep=20)
    rows = pred.collect()
    assert {r.window_id for r in rows} == {r.window_id for r in test.select("window_id").collect()}
    assert all(np.isfinite(r.prediction) for r in rows) and len(info["selected"]) == len(model.coef) == 20
    means = [np.mean([m for p, _, m in info["scores"] if p == i]) for i in range(2)]
    assert info["best"] == int(np.argmin(means)) and model.meta["alpha"] == (1e-2, 1.0)[info["best"]]
    broken = train.withColumn("bvp", F.transform("bvp", lambda v: v * float("inf")))
    with pytest.raises(ValueError):
        wearable_model(broken, test, alphas=(1.0,), lasso_keep=20)


def test_lasso_of_a_wide_support_takes_few_exact_steps(monkeypatch):
    """Collinear expanded columns and a small penalty: the support holds nearly every column."""
    from pulsegrid.operators import linear as L
    rng = np.random.default_rng(5)
    base = rng.normal(size=(900, 30))
    base[:, 20:] = base[:, :10] + 1e-3 * rng.normal(size=(900, 10))
    i, j = np.triu_indices(30)
    X = np.hstack([base, base[:, i] * base[:, j]])
    X = (X - X.mean(0)) / X.std(0)
    y = 2e4 * (X[:, 3] - X[:, 400] + rng.normal(size=900))
    y -= y.mean()
    calls, step = [], L.support_step
    monkeypatch.setattr(L, "support_step", lambda *a, **k: (calls.append(1), step(*a, **k))[1])
    C, c, yy, l1 = X.T @ X, X.T @ y, y @ y, 1e-3 * 900
    w = L.lasso_cd(C, c, 900, 1e-3, tol=1e-6, yy=yy)
    assert len(calls) <= 2 * L.STEPS
    assert L._duality_gap(C, c, yy, w, l1, 0.0) <= 1e-6 * yy
    exact = L._lasso_interior(C, c, yy, l1, 0.0, 1e-8)
    value = lambda v: 0.5 * v @ (C @ v) - c @ v + l1 * np.abs(v).sum()
    assert value(w) - value(exact) <= 1e-6 * yy


def test_interior_points_agree_with_exact_steps():
    from pulsegrid.operators import linear as L
    rng = np.random.default_rng(6)
    X = rng.normal(size=(200, 40))
    X -= X.mean(0)
    y = X[:, :5] @ [3.0, -2.0, 1.0, 4.0, -1.0] + rng.normal(size=200)
    y -= y.mean()
    for l1, l2 in ((20.0, 0.0), (10.0, 5.0)):
        got = L._lasso_interior(X.T @ X, X.T @ y, y @ y, l1, l2, 1e-13)
        want = L.lasso_cd(X.T @ X, X.T @ y, 1.0, l1 + l2, l1 / (l1 + l2), tol=1e-13, yy=y @ y)
        np.testing.assert_allclose(got, want, atol=1e-6)


def test_one_feature_may_fill_a_group():
    """Chains beyond 32,768 rows: the same scores from groups of one feature as from cells."""
    from pulsegrid.operators import mutual_info as MI
    rng = np.random.default_rng(7)
    n = MI.SHARED_POINTS + 1000
    assert n <= MI.GROUP_POINTS
    y = rng.normal(size=n)
    x = y + rng.normal(size=n)
    px, py = MI._group_psi(x[None, :], y, 3)
    score = MI._digamma_int(n) + MI._digamma_int(3) - px[0] - py[0]
    assert abs(score - 0.5 * np.log(2.0)) < 0.02           # correlation sqrt(1/2)


def test_wearable_model_fits_on_every_row(spark, monkeypatch):
    """Part c's lasso takes no sample: the rows it counts are the training rows."""
    from conftest import SMALL
    from pulsegrid.operators import folds as FO
    from pulsegrid.operators import linear as L
    from pulsegrid.plans.protocols import wearable_model
    from pulsegrid.sources.tables import li_wear

    def none(*a, **k):
        raise AssertionError("a sample was taken")
    rows, fit = [], L.fit_lasso
    monkeypatch.setattr(FO, "sample_n", none)
    monkeypatch.setattr(L, "fit_lasso", lambda *a, **k: (rows.append(fit(*a, **k)), rows[-1])[1])
    w = FO.split_random(li_wear(spark, SMALL).filter(F.col("y").isNotNull()), "window_id", 0.2).persist()
    train, test = (w.filter(F.col("split") == s) for s in ("train", "test"))
    wearable_model(train, test, alphas=(1.0,), lasso_keep=5)
    assert [m.meta["n"] for m in rows] == [train.count()]


@pytest.mark.parametrize("in_tasks", (True, False))
def test_fits_without_a_penalty_end_on_nearly_collinear_columns(spark, monkeypatch, in_tasks):
    """Directions of 1e-6 of the spread, and others of rounding only, keep no fit from its gap."""
    from pulsegrid.operators import robust as R
    if not in_tasks:
        monkeypatch.setattr(R, "TASK_VALUES", 0)
    rng = np.random.default_rng(11)
    n = 400
    X = rng.normal(size=(n, 4))
    X = np.hstack([X, X[:, :2] + 1e-6 * rng.normal(size=(n, 2)), X[:, 2:3] + 1e-9 * rng.normal(size=(n, 1))])
    X = X.astype("f4").astype(float)
    y = X[:, 0] + rng.standard_t(2, size=n)
    rows = [(X[i].tolist(), float(y[i]), i % 2) for i in range(n)]
    df = spark.createDataFrame(rows, "f array<double>, y double, fold int").repartition(2).persist()
    _, models = R.fit_robust_grid(df, "f", "y", [R.GridPoint(0.0), R.GridPoint(1e-3)], "fold", 2, method="wide")
    assert len(models) == 6
    for m in models.values():
        assert m.meta["gap"] <= R.GAP
    best = np.abs(y - np.median(y)).mean()
    assert models[(0, R.ALL_ROWS)].meta["objective"] < best


def test_derived_columns_equal_stored_ones(spark):
    """Columns made inside the passes give the moments, lasso and robust fits of the same columns in a table."""
    from pulsegrid.operators import robust as R
    from pulsegrid.operators.linear import fit_lasso
    from pulsegrid.operators.moments import Derived, moment_sums, total
    from pulsegrid.operators.prep import ExpandedMatrix, PolynomialExpansion
    rng = np.random.default_rng(12)
    X = rng.normal(size=(150, 3))
    y = X[:, 0] * X[:, 1] + rng.normal(size=150)
    rows = [(X[i].tolist(), float(y[i]), i % 2) for i in range(150)]
    df = spark.createDataFrame(rows, "f array<double>, y double, fold int").repartition(3).persist()
    held = PolynomialExpansion("f", "z", width=3).transform(df).persist()
    made = Derived("z", "f", ExpandedMatrix(3), 9)
    a, b = (total(moment_sums(d, c, "y")) for d, c in ((held, "z"), (df, made)))
    np.testing.assert_allclose(a.centered(), b.centered(), rtol=1e-12, atol=1e-9)
    np.testing.assert_allclose(total(moment_sums(df, made.at([8, 1]), None)).mean(), a.mean()[[8, 1]], rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(fit_lasso(held, "z", "y", 0.01).coef, fit_lasso(df, made, "y", 0.01).coef, atol=1e-7)
    single = Derived("z", "f", ExpandedMatrix(3, single=True), 9)
    fits = [R.fit_robust_grid(d, c, "y", [R.GridPoint(1e-2)], "fold", 2, method="wide") for d, c in ((held, "z"), (df, single))]
    for k, m in fits[0][1].items():
        assert abs(m.meta["objective"] - fits[1][1][k].meta["objective"]) <= R.GAP * y.std()


def test_mutual_information_sends_columns_not_products(spark, monkeypatch):
    """A group multiplies what it is sent: far fewer columns travel than there are features, groups and jobs stay
    under their sizes, and scores don't depend on how the groups are cut."""
    from pulsegrid.operators import mutual_info as MI
    i, j = np.triu_indices(80)
    products = np.append(np.arange(80), i), np.append(np.full(80, -1), j)
    groups = MI._groups(450_000, 3320, products)
    np.testing.assert_array_equal(np.sort(np.concatenate([own for _, own in groups])), np.arange(3320))
    assert sum(len(columns) + 2 for columns, _ in groups) < 3320 / 5
    assert all(8 * 450_000 * (len(columns) + 2) <= MI.GROUP_BYTES for columns, _ in groups)
    rng = np.random.default_rng(13)
    X = rng.normal(size=(300, 4))
    y = X[:, 0] * X[:, 1] + 0.1 * rng.normal(size=300)
    df = spark.createDataFrame([(k, X[k].tolist(), float(y[k])) for k in range(300)], "k long, f array<double>, y double").persist()
    i, j = np.triu_indices(4)
    left, right = np.append(np.arange(4), i), np.append(np.full(4, -1), j)
    whole = np.hstack([X, X[:, i] * X[:, j]])

    def read(wide):
        def rows(b):
            Z = MI.feature_matrix(b, "f")
            yield (0, np.hstack([Z, Z[:, i] * Z[:, j]]) if wide else Z, b.column("y").to_numpy(), b.column("k").to_numpy())
        return rows
    shift = {0: np.append(whole[0], y[0])}
    want = MI.mi_scores_chains(df, read(True), {0: 14}, shift)[0]
    monkeypatch.setattr(MI, "SIDE", 2)
    monkeypatch.setattr(MI, "LOT_BYTES", 8 * 300 * 8)
    got = MI.mi_scores_chains(df, read(False), {0: 14}, shift, products={0: (left, right)})[0]
    np.testing.assert_allclose(got, want, rtol=1e-12, atol=1e-12)
    cells = MI.mi_scores_chains(df, read(False), {0: 14}, shift, group=10, cell=60, products={0: (left, right)})[0]
    np.testing.assert_allclose(cells, want, rtol=1e-9, atol=1e-9)
    assert want.argmax() == 5      # the product of the first two


def test_windows_write_only_the_columns_they_hold(spark, monkeypatch):
    """The sort columns end with the sort, and the sort's shuffle files with the write."""
    from pulsegrid.operators import windows as W
    from pulsegrid.session import SHUFFLE_CLEANUP
    seen, write = [], W.written
    monkeypatch.setattr(W, "written", lambda df, name: (seen.append(df.columns), write(df, name))[1])
    rows = [(s, float(t), f"{t % 3}", float(s * t)) for s in (1, 2) for t in range(10)]
    df = spark.createDataFrame(rows, "s long, t double, tag string, v double")
    got = W.cut_windows(df, "s", ["t", "tag"], ["v"], 4, label_col="v").orderBy("s", "blk").collect()
    assert not {"t", "tag"} & set(seen[0]) and len(seen) == 1
    assert [(r.s, r.blk, r.v, r.y) for r in got] == [
        (s, b, [float(s * t) for t in range(4 * b, 4 * b + 4)], float(s * (4 * b + 4))) for s in (1, 2) for b in (0, 1)]
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_protocol_fits_read_the_base_features(spark, monkeypatch):
    """Part d keeps no wide column per fold: its fits derive theirs from the features, with the same values."""
    from pulsegrid.operators.fold_chains import chain_columns, derived_columns, fit_chains
    from pulsegrid.operators.moments import Derived, feature_matrix
    from pulsegrid.plans import protocols as P
    rng = np.random.default_rng(14)
    X = rng.normal(size=(120, 6))
    X[::9, 2] = np.nan
    y = np.nan_to_num(X[:, 0] * X[:, 2]) + rng.normal(size=120)
    df = spark.createDataFrame([(k, X[k].tolist(), float(y[k])) for k in range(120)], "window_id long, features array<double>, y double")
    seen, fit = [], P.fit_robust_grid
    monkeypatch.setattr(P, "fit_robust_grid", lambda data, cols, *a, **k: (seen.append(cols), fit(data, cols, *a, **k))[1])
    P.train_protocol(df, "d3", names=[f"n{i}" for i in range(6)])
    assert len(seen[0]) == 4 and all(isinstance(c, Derived) and c.source == "features" for c in seen[0].values())
    data = df.selectExpr("window_id", "features", "y", "window_id % 2 AS fold").persist()
    chains = fit_chains(data, [0, None], "features", "y", "fold", "window_id", 6, "f", True, 4, 9)
    kept = chain_columns(data, chains, "features", ["window_id"], ["a", "b"]).orderBy("window_id").collect()
    batch = data.orderBy("window_id").toArrow().combine_chunks().to_batches()[0]
    for name, column in zip("ab", derived_columns(chains, "features", ["a", "b"])):
        np.testing.assert_array_equal(feature_matrix(batch, column), np.array([r[name] for r in kept]))


def test_chain_medians_equal_numpy(spark):
    """Radix selection of every chain: odd and even counts, ties, signs, both zeros, infinities, missing values, an
    empty position, rows in no fold."""
    from pulsegrid.operators.fold_chains import Chain, _fit_medians
    rng = np.random.default_rng(15)
    n = 501
    X = np.column_stack([rng.normal(size=n) * 1e-3, rng.integers(-2, 3, n), np.where(rng.random(n) < 0.5, -1e300, 1e300),
                         np.where(rng.random(n) < 0.6, 0.0, -0.0), np.full(n, np.nan), rng.normal(size=n),
                         np.where(np.arange(n) < 300, np.inf, 5.0)])
    X[rng.random((n, 7)) < 0.1] = np.nan
    fold = [None if k % 5 == 4 else k % 3 for k in range(n)]
    df = spark.createDataFrame([(X[k].tolist(), fold[k]) for k in range(n)], "f array<double>, fold int").repartition(4).persist()
    chains = [Chain(0), Chain(1), Chain(None)]
    _fit_medians(df, chains, "f", "fold", 7)
    for c in chains:
        own = X[[c.fold is None or f != c.fold for f in fold]]
        want = [np.median(v[~np.isnan(v)]) if (~np.isnan(v)).any() else 0.0 for v in own.T]
        np.testing.assert_array_equal(c.medians, want)
        assert c.missing == [4]

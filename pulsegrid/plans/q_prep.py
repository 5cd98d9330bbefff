"""Queries for the table-level transforms (T1-T4, T6), lasso (M3), robust
models (M4, M5) and the grid search (E6)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.operators.linear import fit_lasso, predict_expr
from pulsegrid.operators.prep import (LassoSelector, MedianImputer, PolynomialExpansion, PopulationScaler,
                                      SelectKBest, column_medians, f_scores)
from pulsegrid.operators.robust import ALL_ROWS, GridPoint, best_point, fit_robust_grid
from pulsegrid.plans.output import sql_round as R
from pulsegrid.plans.q_models import EVREG_SQL, LI_SQL, ev_reg
from pulsegrid.plans.q_stats import EV
from pulsegrid.plans.registry import register
from pulsegrid.plans.sqlfit import lasso_ctes, robust_ctes
from pulsegrid.sources.tables import ev_windows, li_reg

# Fixed values of the registered grid searches.
ABS_ALPHAS = (0.0, 1e-4, 1e-2, 1.0)                 # absolute-error model, l2 penalty
EPS_GRID = [(a, l1) for a in (1e-3, 1e-2, 1e-1) for l1 in (0.15, 0.50, 0.85)]   # epsilon 5, elastic net
EPSILON = 5.0
LASSO_ALPHA = 5.0
SELECT_K = 5
# Compared digits of fits (significant bits, grid near zero, unit): two solvers agree in the minimum to about 1e-6.
FIT_BITS = (20, 20, 0.7548776662466927)
OBJECTIVE_BITS = (13, 20, 0.7548776662466927)


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("poly_expand", EVREG_SQL + """SELECT window_id, pos::BIGINT AS pos, """ + R("value") + """ AS value
FROM (SELECT window_id, unnest([x0, x1, x0 * x0, x0 * x1, x1 * x1]) AS value,
             unnest(range(5)) AS pos FROM d) t""")
def q_poly(spark, sf_dir):
    """Degree-2 expansion of the window features (mean, std) -> 5 terms."""
    d = PolynomialExpansion("features", "poly", width=2).transform(ev_reg(spark, sf_dir))
    return d.select("window_id", F.posexplode("poly").alias("pos", "value"))


@register("poly_names", EVREG_SQL + f"""SELECT pos::BIGINT AS pos, name, {R("mean")} AS mean FROM (
  SELECT unnest(range(5)) AS pos, unnest(['mean', 'std', 'mean^2', 'mean*std', 'std^2']) AS name,
         unnest([avg(x0), avg(x1), avg(x0 * x0), avg(x0 * x1), avg(x1 * x1)]) AS mean FROM d) t""")
def q_poly_names(spark, sf_dir):
    """T1 names for the expansion of (mean, std), each with the mean of its column."""
    poly = PolynomialExpansion("features", "poly", width=2, names=["mean", "std"])
    v = poly.transform(ev_reg(spark, sf_dir)).select(F.posexplode("poly").alias("pos", "value"))
    names = F.array(*[F.lit(n) for n in poly.out_names()])
    return v.groupBy("pos").agg(F.avg("value").alias("mean")).select(
        "pos", F.element_at(names, F.col("pos") + 1).alias("name"), "mean")


@register("scale_population", EVREG_SQL + """, m AS (SELECT avg(x0) AS a0, stddev_pop(x0) AS s0, avg(x1) AS a1,
                                    stddev_pop(x1) AS s1 FROM d)
SELECT window_id, """ + R("(x0 - a0) / s0") + """ AS z0, """ + R("(x1 - a1) / s1") + """ AS z1 FROM d, m""")
def q_scale(spark, sf_dir):
    """Standardise with the population std (fit and apply on the window features)."""
    d = ev_reg(spark, sf_dir)
    z = PopulationScaler("features", "z").fit(d).transform(d)
    return z.select("window_id", F.col("z")[0].alias("z0"), F.col("z")[1].alias("z1"))


@register("impute_median", EV + """SELECT i::BIGINT AS pos, """ + R("median(vn) FILTER (WHERE NOT isnan(vn))")
          + """ AS median FROM ev GROUP BY i""")
def q_impute(spark, sf_dir):
    """Exact per-position median with NaN ignored (distributed selection)."""
    med = column_medians(ev_windows(spark, sf_dir), "x_nan")
    return spark.createDataFrame([(int(k), float(v)) for k, v in sorted(med.items())], "pos int, median double")


@register("impute_apply", EV + """, med AS (SELECT i, median(vn) FILTER (WHERE NOT isnan(vn)) AS md FROM ev GROUP BY i)
SELECT window_id, i::BIGINT AS pos, """ + R("CASE WHEN isnan(vn) THEN md ELSE vn END") + """ AS value
FROM ev JOIN med USING (i)""")
def q_impute_apply(spark, sf_dir):
    """T3 applied: NaN replaced by the fitted position median."""
    w = ev_windows(spark, sf_dir)
    m = MedianImputer("x_nan", "xi", width=16).fit(w)
    return m.transform(w).select("window_id", F.posexplode("xi").alias("pos", "value"))


_REPLAY_SQL = EV + """, med AS (SELECT i, median(vn) FILTER (WHERE NOT isnan(vn)) AS md FROM ev GROUP BY i),
im AS (SELECT window_id, i, CASE WHEN isnan(vn) THEN md ELSE vn END AS v FROM ev JOIN med USING (i)),
sc AS (SELECT i, avg(v) AS m, stddev_pop(v) AS s FROM im GROUP BY i),
z AS (SELECT window_id, max(CASE WHEN i = 0 THEN (v - m) / s END) AS z0, max(CASE WHEN i = 3 THEN (v - m) / s END) AS z3
      FROM im JOIN sc USING (i) GROUP BY window_id)
"""


@register("pipeline_replay", _REPLAY_SQL + f"""SELECT window_id, {R('z0')} AS z0, {R('z3')} AS z3, {R('z0 * z0')} AS z00,
  {R('z0 * z3')} AS z03, {R('z3 * z3')} AS z33 FROM z""")
def q_pipeline_replay(spark, sf_dir):
    """Impute -> scale -> keep positions 0 and 3 -> degree 2 as a ``PipelineModel``, saved, loaded and replayed."""
    import uuid

    from pyspark.ml import Pipeline, PipelineModel

    from pulsegrid.operators.prep import SelectedModel
    from pulsegrid.session import scratch_path
    w = ev_windows(spark, sf_dir)
    fitted = Pipeline(stages=[MedianImputer("x_nan", "xi", width=16), PopulationScaler("xi", "z"),
                              SelectedModel("z", "kept", [0, 3]),
                              PolynomialExpansion("kept", "poly", width=2, names=["z0", "z3"])]).fit(w)
    path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    fitted.write().save(path)
    names = ["z0", "z3", "z00", "z03", "z33"]
    out = PipelineModel.load(path).transform(w)
    return out.select("window_id", *[F.col("poly")[i].alias(n) for i, n in enumerate(names)])


_F_SQL = EV.replace("ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),",
                    "ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),\n"
                    "nxt AS (SELECT user_id * 4294967296 + blk - 1 AS window_id, v AS y FROM c WHERE i = 0 AND blk > 0),") + \
    """, fs AS (SELECT i, corr(v, y) AS r, count(*) AS n FROM ev JOIN nxt USING (window_id) GROUP BY i),
sc AS (SELECT i, r * r / (1 - r * r) * (n - 2) AS f FROM fs)
"""


@register("select_fscore", _F_SQL + f"""SELECT i::BIGINT AS pos, {R('f')} AS fscore,
  (row_number() OVER (ORDER BY f DESC, i DESC) <= {SELECT_K}) AS selected FROM sc""")
def q_select(spark, sf_dir):
    """T4: F statistic of each window position against the next value; the top 5 kept."""
    w = ev_windows(spark, sf_dir).filter(F.col("y").isNotNull())
    sel = SelectKBest("x", "xs", "y", k=SELECT_K, score="f").fit(w)
    sc = sel.scores
    idx = set(int(i) for i in sel.indices)
    return spark.createDataFrame([(i, float(sc[i]), i in idx) for i in range(len(sc))],
                                 "pos int, fscore double, selected boolean")


CHAIN_KEEP = 6
_FOLD = "('0x' || substr(md5(concat('42:', window_id::VARCHAR)), 1, 8))::BIGINT % 3"


@register("fold_chains", _F_SQL.split(", fs AS (")[0] + f""", tr AS (
  SELECT c AS chain, window_id, i, vn, y FROM ev JOIN nxt USING (window_id), (SELECT unnest(range(4)) AS c) t
  WHERE c = 3 OR {_FOLD} <> c),
md AS (SELECT chain, i, median(vn) FILTER (WHERE NOT isnan(vn)) AS median FROM tr GROUP BY chain, i),
im AS (SELECT tr.chain, tr.i, y, median, CASE WHEN isnan(vn) THEN median ELSE vn END AS v FROM tr JOIN md USING (chain, i)),
st AS (SELECT chain, i, any_value(median) AS median, avg(v) AS mean, stddev_pop(v) AS std, corr(v, y) AS r, count(*) AS n
       FROM im GROUP BY chain, i),
sc AS (SELECT *, r * r / (1 - r * r) * (n - 2) AS f FROM st)
SELECT chain::BIGINT AS chain, i::BIGINT AS pos, {R('median')} AS median, {R('mean')} AS mean, {R('std')} AS std,
       {R('f')} AS fscore, row_number() OVER (PARTITION BY chain ORDER BY f DESC, i DESC) <= {CHAIN_KEEP} AS selected FROM sc""")
def q_fold_chains(spark, sf_dir):
    """Medians, scalers and F selection of every fold's own chain (3: all rows), from shared scans."""
    from pulsegrid.operators import folds as FO
    from pulsegrid.operators.fold_chains import fit_chains
    w = ev_windows(spark, sf_dir).filter(F.col("y").isNotNull()).withColumn("fold", FO.fold_expr("window_id", 3, 42))
    chains = fit_chains(w, [0, 1, 2, None], "x_nan", "y", "fold", "window_id", 16, "f", True, CHAIN_KEEP, 10)
    rows = [(g, i, float(c.medians[i]), float(c.mean[i]), float(c.std[i]), float(c.scores1[i]), i in set(c.base.tolist()))
            for g, c in enumerate(chains) for i in range(16)]
    return spark.createDataFrame(rows, "chain int, pos int, median double, mean double, std double, fscore double, selected boolean")


def _lasso1_sql():
    return LI_SQL + f""", s AS (SELECT count(*) AS n, avg(x0) AS m0, avg(y) AS my,
  covar_pop(x0, y) AS sxy, var_pop(x0) AS sxx FROM d),
w AS (SELECT *, sign(sxy) * greatest(abs(sxy) - {LASSO_ALPHA}, 0) / sxx AS w0 FROM s)
SELECT {R('my - w0 * m0')} AS intercept, {R('w0')} AS coef FROM w"""


@register("lasso_single", _lasso1_sql())
def q_lasso1(spark, sf_dir):
    """M3 with one feature: the lasso is the soft-thresholded least-squares slope."""
    d = li_reg(spark, sf_dir).select(F.array(F.col("features")[0]).alias("x"), "y")
    m = fit_lasso(d, "x", "y", LASSO_ALPHA)
    return spark.createDataFrame([(float(m.intercept), float(m.coef[0]))], "intercept double, coef double")


@register("lasso_weights", _recursive(LI_SQL + lasso_ctes(["x0", "x1", "x2"], LASSO_ALPHA)) + f"""SELECT pos::BIGINT AS pos,
  {R("weight", *FIT_BITS)} AS weight FROM (SELECT unnest(range(4)) AS pos, unnest(list_prepend(b, w)) AS weight FROM fit) t""",
          bits=FIT_BITS)
def q_lasso(spark, sf_dir):
    """M3: lasso (alpha 5) on lineitem, coordinate descent on the distributed Gramian."""
    m = fit_lasso(li_reg(spark, sf_dir), "features", "y", LASSO_ALPHA, tol=1e-12)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(m.weights())], "pos int, weight double")


_POLY = [f"x{i}" for i in range(5)]
_POLY_SQL = f""", ps AS (SELECT x0, x1, x0 * x0 AS x2, x0 * x1 AS x3, x1 * x1 AS x4, y FROM d),
pm AS (SELECT {", ".join(f"avg({c}) AS a{c}, stddev_pop({c}) AS s{c}" for c in _POLY)} FROM ps),
pz AS (SELECT {", ".join(f"({c} - a{c}) / s{c} AS {c}" for c in _POLY)}, y FROM ps, pm)
"""


@register("lasso_select", _recursive(EVREG_SQL + _POLY_SQL + lasso_ctes(_POLY, 0.5, "pz")) + """SELECT pos::BIGINT AS pos FROM
  (SELECT unnest(range(5)) AS pos, unnest(w) AS v FROM fit) t QUALIFY row_number() OVER (ORDER BY abs(v) DESC, pos) <= 3""")
def q_lasso_select(spark, sf_dir):
    """Lasso screening of the 5 expanded window features, keep the 3 largest |coef|."""
    d = PolynomialExpansion("features", "poly", width=2).transform(ev_reg(spark, sf_dir))
    d = PopulationScaler("poly", "poly").fit(d).transform(d)
    m = LassoSelector("poly", "sel", "y", "window_id", alpha=0.5, k=3, sample=100_000).fit(d)
    return spark.createDataFrame([(int(i),) for i in m.indices], "pos int")


def _robust(spark, sf_dir, grid):
    d = ev_reg(spark, sf_dir)
    d = PopulationScaler("features", "features").fit(d).transform(d)
    return d, *fit_robust_grid(d, "features", "y", grid, "fold", 3)


def _objectives(spark, d, grid, models):
    """The objective of each refitted model over all rows, from its weights alone."""
    def of(p, g):
        m = models[(p, ALL_ROWS)]
        off = F.greatest(F.abs(F.col("y") - predict_expr(m, "features")) - g.epsilon, F.lit(0.0))
        w = m.coef
        return (F.avg(off) + float(g.alpha * (g.l1_ratio * np.abs(w).sum() + (1 - g.l1_ratio) / 2 * (w @ w)))).alias(f"o{p}")
    row = d.agg(*[of(p, g) for p, g in enumerate(grid)]).first()
    return spark.createDataFrame([(p, float(g.alpha), float(g.l1_ratio), float(row[p])) for p, g in enumerate(grid)],
                                 "pos int, alpha double, l1_ratio double, objective double")


_Z_SQL = """, zm AS (SELECT avg(x0) AS a0, stddev_pop(x0) AS s0, avg(x1) AS a1, stddev_pop(x1) AS s1 FROM d),
z AS (SELECT (x0 - a0) / s0 AS x0, (x1 - a1) / s1 AS x1, y, fold FROM d, zm)
"""


def _robust_sql(points):
    return _recursive(EVREG_SQL + _Z_SQL + robust_ctes(points, None)) + f"""SELECT pos::BIGINT AS pos,
  {R("gp.alpha", *OBJECTIVE_BITS)} AS alpha, {R("gp.l1", *OBJECTIVE_BITS)} AS l1_ratio,
  {R("obj", *OBJECTIVE_BITS)} AS objective FROM fit JOIN gp USING (pos)"""


@register("robust_absolute", _robust_sql([(a, 0.0, 0.0) for a in ABS_ALPHAS]), bits=OBJECTIVE_BITS)
def q_robust_abs(spark, sf_dir):
    """M4: absolute-error model with l2 penalty, every alpha, 3 folds + refit: the minimum reached."""
    grid = [GridPoint(a, 0.0, 0.0) for a in ABS_ALPHAS]
    d, _, models = _robust(spark, sf_dir, grid)
    return _objectives(spark, d, grid, models)


@register("robust_epsilon", _robust_sql([(a, l1, EPSILON) for a, l1 in EPS_GRID]), bits=OBJECTIVE_BITS)
def q_robust_eps(spark, sf_dir):
    """M5: epsilon-insensitive (5.0) elastic-net model over the 3 x 3 grid, 3 folds + refit: the minima reached."""
    grid = [GridPoint(a, l1, EPSILON) for a, l1 in EPS_GRID]
    d, _, models = _robust(spark, sf_dir, grid)
    return _objectives(spark, d, grid, models)


_FOLDS_SQL = _recursive(EVREG_SQL + _Z_SQL + robust_ctes([(a, 0.0, 0.0) for a in ABS_ALPHAS], 3)) + f"""SELECT
  pos::BIGINT AS pos, fold::BIGINT AS fold, {R("obj", *OBJECTIVE_BITS)} AS objective, true AS score_holds
FROM fit WHERE fold >= 0"""


@register("grid_search_folds", _FOLDS_SQL, bits=OBJECTIVE_BITS)
def q_grid_folds(spark, sf_dir):
    """E6 by fold: the training minimum reached, and whether the validation score equals
    the MAE of the returned weights over the held-out rows."""
    grid = [GridPoint(a, 0.0, 0.0) for a in ABS_ALPHAS]
    d, scores, models = _robust(spark, sf_dir, grid)
    off = {(p, f): F.abs(F.col("y") - predict_expr(models[(p, f)], "features")) for p, f, _ in scores}
    row = d.agg(*[F.avg(F.when((F.col("fold") == f) == held, off[(p, f)])).alias(f"m{p}_{f}_{held}")
                  for p, f, _ in scores for held in (False, True)]).first()
    rows = []
    for p, f, mae in scores:
        w = models[(p, f)].coef
        rows.append((p, f, float(row[f"m{p}_{f}_False"] + grid[p].alpha / 2 * (w @ w)),
                     bool(abs(row[f"m{p}_{f}_True"] - mae) <= 1e-6 * mae)))
    return spark.createDataFrame(rows, "pos int, fold int, objective double, score_holds boolean")


@register("grid_search", None)
def q_grid(spark, sf_dir):
    """Validation MAE per (alpha, fold), mean per alpha, best (first on ties).
    An interval of intercepts may reach the minimum, so the scores have no twin (``grid_search_folds``)."""
    grid = [GridPoint(a, 0.0, 0.0) for a in ABS_ALPHAS]
    _, scores, _ = _robust(spark, sf_dir, grid)
    best = best_point(scores, len(grid))
    means = {p: float(np.mean([s[2] for s in scores if s[0] == p])) for p in range(len(grid))}
    return spark.createDataFrame([(p, float(grid[p].alpha), means[p], p == best) for p in range(len(grid))],
                                 "pos int, alpha double, mean_mae double, best boolean")


@register("fscore_all", LI_SQL + """SELECT pos::BIGINT AS pos, """ + R("r * r / (1 - r * r) * (n - 2)") + """ AS fscore
FROM (SELECT 0 AS pos, corr(x0, y) AS r, count(*) AS n FROM d UNION ALL SELECT 1, corr(x1, y), count(*) FROM d
      UNION ALL SELECT 2, corr(x2, y), count(*) FROM d) t""")
def q_fscore_all(spark, sf_dir):
    """T4 scores for the lineitem features (one moments pass)."""
    f, n = f_scores(li_reg(spark, sf_dir), "features", "y")
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(f)], "pos int, fscore double")


MI_LABEL_POS = 10     # embedding position that serves as label
MI_KEEP = 3

_MI_SQL = f"""WITH e AS (SELECT vec_id AS rid, embedding[{MI_LABEL_POS + 1}]::DOUBLE AS y0,
                  unnest(range(len(embedding))) AS j, unnest(embedding)::DOUBLE AS x0 FROM embeddings),
s AS (SELECT j, stddev_pop(x0) AS sx, stddev_pop(y0) AS sy, count(*) AS n FROM e GROUP BY j),
p AS MATERIALIZED (SELECT e.rid, e.j, e.x0 / s.sx AS x, e.y0 / s.sy AS y FROM e JOIN s USING (j)),
pr AS MATERIALIZED (SELECT a.j, a.rid, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy
       FROM p a JOIN p b ON a.j = b.j AND a.rid <> b.rid),
eps AS MATERIALIZED (SELECT j, rid, min(greatest(dx, dy), 3)[3] * (1 - 1e-12) AS r FROM pr GROUP BY j, rid),
cnt AS MATERIALIZED (SELECT j, rid, 1 + count(*) FILTER (WHERE dx < r) AS nx, 1 + count(*) FILTER (WHERE dy < r) AS ny
        FROM pr JOIN eps USING (j, rid) GROUP BY j, rid),
hr AS MATERIALIZED (SELECT i AS m, -0.5772156649015329 + coalesce(sum(1.0 / i) OVER (ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS psi FROM range(1, 200001) t(i)),
mi AS MATERIALIZED (SELECT c.j, greatest(0.0, (SELECT psi FROM hr WHERE m = (SELECT max(n) FROM s))
              + (SELECT psi FROM hr WHERE m = 3) - avg(hx.psi) - avg(hy.psi)) AS mi
       FROM cnt c JOIN hr hx ON hx.m = c.nx JOIN hr hy ON hy.m = c.ny GROUP BY c.j)
"""


def _mi(spark, sf_dir):
    from pulsegrid.operators.mutual_info import mi_scores
    from pulsegrid.sources.tables import table
    d = table(spark, sf_dir, "embeddings").select(
        F.col("embedding").cast("array<double>").alias("f"),
        F.col("embedding")[MI_LABEL_POS].cast("double").alias("y"))
    # the embeddings carry no ties, so the tie-breaking jitter is left out here
    return mi_scores(d, "f", "y", jitter=0.0)


@register("mutual_info", _MI_SQL + "SELECT j::BIGINT AS pos, " + R("mi") + " AS mi FROM mi")
def q_mi(spark, sf_dir):
    """T5: k-NN (k = 3) mutual information of every embedding position with position 10."""
    s = _mi(spark, sf_dir)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(s)], "pos int, mi double")


@register("select_mutual_info", _MI_SQL + f"""SELECT j::BIGINT AS pos,
  (row_number() OVER (ORDER BY mi DESC, j DESC) <= {MI_KEEP}) AS selected FROM mi""")
def q_select_mi(spark, sf_dir):
    """T5 selection: the 3 positions with the highest mutual information (ties: later index)."""
    from pulsegrid.operators.prep import top_k_indices
    s = _mi(spark, sf_dir)
    keep = set(int(i) for i in top_k_indices(s, MI_KEEP))
    return spark.createDataFrame([(i, i in keep) for i in range(len(s))], "pos int, selected boolean")

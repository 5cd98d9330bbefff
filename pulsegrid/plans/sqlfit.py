"""DuckDB twins of the iterative fits, by other methods than the Spark side.

* ``lasso_ctes``   coordinate descent on population covariances, one coordinate per recursion step.
* ``robust_ctes``  the robust objective minimised over two weights by shrinking 5 x 5 grids along the
  axes (where the l1 penalty has its kinks) and the diagonals (where correlated standardised
  features have their valley); the intercept is a median in closed form, of r - epsilon and r + epsilon.
"""

from __future__ import annotations

LASSO_STEPS = 4000
GRID_ROUNDS = 150         # the grids shrink by GRID_SHRINK each round
GRID_SHRINK = 0.87


def lasso_ctes(cols: list[str], alpha: float, src: str = "d", steps: int = LASSO_STEPS) -> str:
    """CTE ``fit(w, b)``: minimum of 1/(2n)||y - b - Xw||^2 + alpha ||w||_1 over the rows of ``src``."""
    p = len(cols)
    gram = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in cols) + "]" for a in cols)
    cross = ", ".join(f"covar_pop({c}, y)" for c in cols)
    means = ", ".join(f"avg({c})" for c in cols)
    # the coordinate of a step is (k % p) + 1; rho leaves its own share out
    rho = ("(ln.c[j] - list_sum(list_transform(range(1, {n}), lambda i: ln.g[j][i] * it.w[i])) + ln.g[j][j] * it.w[j])"
           .replace("{n}", str(p + 1)))
    return f""", ln AS (SELECT [{gram}] AS g, [{cross}] AS c, [{means}] AS m, avg(y) AS my FROM {src}),
it(k, w) AS (SELECT 0, {[0.0] * p}::DOUBLE[]
      UNION ALL SELECT k + 1, list_transform(range(1, {p + 1}), lambda i: CASE WHEN i <> j THEN w[i] ELSE soft END)
      FROM (SELECT k, w, j, sign(rho) * greatest(abs(rho) - {alpha}, 0) / g[j][j] AS soft
            FROM (SELECT it.k, it.w, it.k % {p} + 1 AS j, ln.g, {rho.replace("[j]", f"[it.k % {p} + 1]")} AS rho FROM it, ln)
            WHERE k < {steps})),
fit AS (SELECT w, my - list_sum(list_transform(range(1, {p + 1}), lambda i: m[i] * w[i])) AS b FROM it, ln WHERE k = {steps})
"""


def robust_ctes(points: list[tuple[float, float, float]], folds: int | None) -> str:
    """CTE ``fit(pos, fold, obj, w0, w1, b)`` over z(x0, x1, y, fold); fold -1 trains on all rows.

    ``points``: (alpha, l1_ratio, epsilon) by position; ``folds``: held-out folds to fit besides.
    """
    rows = ", ".join(f"({i}, {a}, {l1}, {e})" for i, (a, l1, e) in enumerate(points))
    held = "-1" if folds is None else ", ".join(str(k) for k in range(-1, folds))
    steps = "[-1.0, -0.5, 0.0, 0.5, 1.0]"
    return f""", gp AS (SELECT pos, alpha::DOUBLE AS alpha, l1::DOUBLE AS l1, eps::DOUBLE AS eps, fold
       FROM (VALUES {rows}) t(pos, alpha, l1, eps), (SELECT unnest([{held}]) AS fold)),
tl AS (SELECT gp.fold, list(x0) AS x0, list(x1) AS x1, list(y) AS y, count(*) AS n
       FROM (SELECT DISTINCT fold FROM gp) gp JOIN z ON z.fold <> gp.fold GROUP BY gp.fold),
ax AS (SELECT a, b FROM (SELECT unnest({steps}) AS a), (SELECT unnest({steps}) AS b)),
of AS (SELECT a, b FROM ax UNION SELECT a + b / 8, b / 8 - a FROM ax UNION SELECT a + b / 8, a - b / 8 FROM ax),
sp AS (SELECT 2 * stddev_pop(y) AS r FROM z),
zoom(k, pos, fold, r, w0, w1, obj, b0) AS (
      SELECT 0, pos, fold, sp.r, 0.0::DOUBLE, 0.0::DOUBLE, 1e300::DOUBLE, 0.0::DOUBLE FROM gp, sp
      UNION ALL SELECT k + 1, pos, fold, r * {GRID_SHRINK}, arg_min(v0, f), arg_min(v1, f), min(f), arg_min(b, f)
      FROM (SELECT k, pos, fold, r, v0, v1, b, list_sum(list_transform(res, lambda q: greatest(abs(q - b) - eps, 0))) / n
                   + alpha * (l1 * (abs(v0) + abs(v1)) + (1 - l1) / 2 * (v0 * v0 + v1 * v1)) AS f
            FROM (SELECT *, list_aggregate(list_concat(list_transform(res, lambda q: q - eps),
                                                       list_transform(res, lambda q: q + eps)), 'median') AS b
                  FROM (SELECT *, list_transform(range(1, n + 1), lambda i: y[i] - v0 * x0[i] - v1 * x1[i]) AS res
                        FROM (SELECT zoom.k, zoom.pos, zoom.fold, zoom.r, zoom.w0 + of.a * zoom.r AS v0,
                                     zoom.w1 + of.b * zoom.r AS v1, gp.alpha, gp.l1, gp.eps, tl.x0, tl.x1, tl.y, tl.n
                              FROM zoom, of, gp, tl WHERE zoom.pos = gp.pos AND zoom.fold = gp.fold
                              AND tl.fold = gp.fold AND zoom.k < {GRID_ROUNDS}) t) u) v) f
      GROUP BY k, pos, fold, r),
fit AS (SELECT pos, fold, obj, w0, w1, b0 AS b FROM zoom WHERE k = {GRID_ROUNDS})
"""

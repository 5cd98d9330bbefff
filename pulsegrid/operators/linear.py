"""Linear models fitted from distributed sufficient statistics (M1, M2, M6).

The data are scanned once per fit (or once for a whole ridge grid and all
folds); only (p+1)^2 moment matrices reach the driver, where the small linear
systems are solved.  Prediction is a column expression with the weights as a
literal array, so it is code-generated and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.moments import Derived, Moments, moment_sums, stored, total


@dataclass
class LinearModel:
    intercept: float
    coef: np.ndarray
    names: list[str] = field(default_factory=list)
    meta: dict = field(default_factory=dict)

    def weights(self) -> np.ndarray:
        """Intercept first, then coefficients (the weight-file order)."""
        return np.concatenate([[self.intercept], self.coef])


class SingularSystem(ValueError):
    pass


def _solve(A: np.ndarray, b: np.ndarray, strict: bool) -> np.ndarray:
    try:
        c = np.linalg.cond(A)
    except np.linalg.LinAlgError as exc:
        raise SingularSystem(str(exc))
    if strict and (not np.isfinite(c) or c > 1e15):
        raise SingularSystem(f"normal equations are singular (condition {c:.3g})")
    return np.linalg.solve(A, b)


def solve_ridge(m: Moments, lam: float, strict: bool = False) -> tuple[float, np.ndarray]:
    """Solve (U'U + lam R) v = U'y for U = [1, x - shift] with R = diag(0, 1, ..., 1).

    Returns (intercept, coef) in the original coordinates."""
    M = m.augmented()
    p = m.p
    A = M[:p + 1, :p + 1].copy()
    b = M[:p + 1, p + 1]
    A[np.arange(1, p + 1), np.arange(1, p + 1)] += lam
    v = _solve(A, b, strict and lam == 0)
    coef = v[1:]
    intercept = v[0] + m.shift[p] - coef @ m.shift[:p]
    return float(intercept), coef


def sse_from_moments(m: Moments, intercept: float, coef: np.ndarray) -> float:
    """Σ (y - intercept - x·coef)^2 over the rows summarised by ``m``."""
    p = m.p
    v0 = intercept - m.shift[p] + coef @ m.shift[:p]   # intercept in shifted coordinates
    u = np.concatenate([[-v0], -coef, [1.0]])
    return float(u @ m.augmented() @ u)


def sst_from_moments(m: Moments) -> float:
    """Σ (y - ȳ)^2 over the rows of ``m`` (ȳ of those rows)."""
    p = m.p
    return float(m.G[p, p] - m.s[p] ** 2 / m.n)


def fit_ols(df: DataFrame, features, label: str, names: Sequence[str] | None = None) -> LinearModel:
    """M1: least squares with intercept; raises SingularSystem on a singular X'X."""
    m = total(moment_sums(df, features, label))
    b, w = solve_ridge(m, 0.0, strict=True)
    return LinearModel(b, w, list(names or []), {"n": m.n})


def fit_ridge(df: DataFrame, features, label: str, lam: float, names=None) -> LinearModel:
    """M2: ridge with a free intercept; lam is not scaled by n."""
    m = total(moment_sums(df, features, label))
    b, w = solve_ridge(m, float(lam))
    return LinearModel(b, w, list(names or []), {"n": m.n, "lambda": float(lam)})


def ridge_cv(df: DataFrame, features, label: str, fold: str, grid: Sequence[tuple[str, float]],
             names=None):
    """M2 + E4 + E7 + E8 in one scan.

    ``grid`` is a list of (raw text, value).  Rows with a null fold always
    train.  For every (lambda, fold) the training moments are total - fold and
    the validation NMSE is computed from the fold's own moments (ȳ of the
    fold).  Returns (cv rows, best (raw, value), refitted model); cv rows are
    (pos, raw, lam, fold, nmse) and the per-lambda mean is over folds.
    """
    mom = moment_sums(df, features, label, group=fold)
    tot = total(mom)
    folds = sorted(g for g in mom if g != -1)
    rows = []
    means = []
    for pos, (raw, lam) in enumerate(grid):
        errs = []
        for k in folds:
            train = tot - mom[k]
            sst = sst_from_moments(mom[k])
            try:
                b, w = solve_ridge(train, float(lam))
                e = sse_from_moments(mom[k], b, w) / sst if sst > 0 and train.n > 0 else float("nan")
            except np.linalg.LinAlgError:      # no or degenerate training rows: this fold cannot score
                e = float("nan")
            errs.append(e)
            rows.append((pos, raw, float(lam), int(k), float(e)))
        means.append(float(np.mean(errs)) if errs else float("nan"))
    best_pos = None
    for pos, e in enumerate(means):   # strictly smaller wins; NaN never wins
        if not np.isnan(e) and (best_pos is None or e < means[best_pos]):
            best_pos = pos
    if best_pos is None:
        raise ValueError("no lambda has a finite cross-validation error")
    raw, lam = grid[best_pos]
    b, w = solve_ridge(tot, float(lam))
    model = LinearModel(b, w, list(names or []), {"n": tot.n, "lambda": float(lam), "raw": raw})
    return rows, means, (raw, float(lam)), model


def predict_expr(model: LinearModel, features) -> Column:
    """M6: intercept + x·w as a Column (features: array column or list of columns)."""
    if isinstance(features, str):
        w = F.array(*[F.lit(float(c)) for c in model.coef])
        dot = F.aggregate(F.zip_with(F.col(features).cast("array<double>"), w, lambda a, b: a * b),
                          F.lit(0.0), lambda acc, v: acc + v)
        return F.lit(float(model.intercept)) + dot
    expr = F.lit(float(model.intercept))
    for c, wv in zip(features, model.coef):
        expr = expr + F.col(c).cast("double") * F.lit(float(wv))
    return expr


def predict(df: DataFrame, model: LinearModel, features, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, predict_expr(model, features))


# Fixed value: lasso stopping rule (tolerance on the duality gap).
LASSO_TOL = 1e-4
SWEEPS = 3                # sweeps of coordinate descent of a round
JOIN = 10                 # columns that may join the support in a round, or a quarter of it
STALLED = 200             # rounds without any progress after which interior points take over
DIRECT_WIDTH = 256        # up to here one Gramian of all columns; beyond, of the screened ones
STEP_WIDTH = 256          # largest support of exact steps (one coefficient each); beyond, interior points
STEPS = 300               # exact steps of a fit; after them interior points
INTERIOR_STEPS = 200      # interior-point steps after which a fit raises
SCREEN_STEP = 256         # columns that join a round at least, if so many break the bound


def _duality_gap(C, c, yy, w, l1, l2):
    """Duality gap of 1/2||yc - Xc w||^2 + l1||w||_1 + l2/2||w||^2 from Gram terms."""
    Cw = C @ w
    xta = c - Cw - l2 * w
    dual = np.abs(xta).max(initial=0.0)
    r2 = yy + w @ Cw - 2.0 * (c @ w)
    if dual > l1 > 0:
        const = l1 / dual
        gap = 0.5 * (r2 + r2 * const ** 2)
    else:
        const = 1.0
        gap = r2
    return gap + l1 * np.abs(w).sum() - const * yy + const * (c @ w) + 0.5 * l2 * (1 + const ** 2) * (w @ w)


def support_step(C, c, w, l1, l2=0.0):
    """(w, whole) after an exact step of w'(C + l2)w / 2 - c'w + sum l1 |w| on the signed support of w, None without support.

    Along directions in which the squares don't change the l1 norm falls until a coefficient is zero;
    without such directions the step goes to the minimum for these signs (``whole``) or to the first
    coefficient that would change its sign."""
    s = np.flatnonzero(w)
    if not len(s):
        return None
    l1 = np.broadcast_to(l1, w.shape)[s]
    g = C[np.ix_(s, s)] @ w[s] + l2 * w[s] - c[s] + l1 * np.sign(w[s])
    lam, Q = np.linalg.eigh(C[np.ix_(s, s)])
    lam = lam + l2
    flat, gq = lam <= 1e-10 * max(lam[-1], 1e-300), Q.T @ g
    free = flat.any() and np.abs(gq[flat]).max() > 1e-7 * l1.max()
    step = -Q[:, flat] @ gq[flat] if free else -Q[:, ~flat] @ (gq[~flat] / lam[~flat])
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = np.where(step * w[s] < 0, -w[s] / step, np.inf)
    t = cross.min() if free else min(1.0, cross.min())
    if not np.isfinite(t):
        return None
    out = w.copy()
    out[s] += t * step
    out[s[cross <= t]] = 0.0
    return out, not free and t == 1.0


def _solver(M, block=256):
    """b -> M^-1 b of a symmetric matrix by one Cholesky factor, whose triangles are solved in blocks; a matrix
    that isn't positive to rounding is solved outright every time."""
    try:
        L = np.linalg.cholesky(M)
    except np.linalg.LinAlgError:
        return lambda b: np.linalg.solve(M, b)
    cuts = [(i, min(i + block, len(M))) for i in range(0, len(M), block)]
    inverses = [np.linalg.inv(L[i:j, i:j]) for i, j in cuts]

    def solve(b):
        x = b.copy()
        for (i, j), own in zip(cuts, inverses):
            x[i:j] = own @ (x[i:j] - L[i:j, :i] @ x[:i])
        for (i, j), own in zip(cuts[::-1], inverses[::-1]):
            x[i:j] = own.T @ (x[i:j] - L[j:, i:j].T @ x[j:])
        return x
    return solve


def _lasso_interior(C, c, yy, l1, l2, tol):
    """The lasso of ``lasso_cd`` by a primal-dual interior-point method (predictor and corrector steps).

    w = a - b with a, b >= 0 and dual slacks za, zb = l1 +- gradient; a step solves one system of C + l2 and a
    diagonal, so some tens of them do however wide the support is.  Ends once both the duality gap and the
    complementarity are below tol x yy, or raises."""
    p, diag = len(c), np.diag_indices(len(c))
    K = C.copy()
    K[diag] += l2
    M = K.copy()
    M[diag] += 1e-6 * max(np.trace(C) / p, 1e-300)
    w = np.linalg.solve(M, c)                          # the start: a ridge solution, well inside
    a, b = np.maximum(w, 0.0), np.maximum(-w, 0.0)
    room = max(np.abs(w).max(), 1e-300)
    a, b = a + room, b + room
    za = np.full(p, l1 + np.abs(K @ w - c).max())
    zb = za.copy()

    def reach(*pairs):
        return min([1.0, *((-v[d < 0] / d[d < 0]).min() for v, d in pairs if (d < 0).any())])

    for _ in range(INTERIOR_STEPS):
        g = K @ (a - b) - c
        ra, rb = g + l1 - za, -g + l1 - zb
        mu, H = (a @ za + b @ zb) / (2 * p), a / za + b / zb
        M = K.copy()
        M[diag] += 1.0 / H
        solve = _solver(M)

        def step(ca, cb):
            q = ca / za - cb / zb - a / za * ra + b / zb * rb
            dw = solve(q / H)
            kd = (q - dw) / H                          # K dw without its rounding
            return (ca - a * (kd + ra)) / za, (cb - b * (rb - kd)) / zb, kd + ra, rb - kd
        da, db, dza, dzb = step(-a * za, -b * zb)
        t = reach((a, da), (b, db), (za, dza), (zb, dzb))
        ahead = ((a + t * da) @ (za + t * dza) + (b + t * db) @ (zb + t * dzb)) / (2 * p)
        aim = (ahead / mu) ** 3 * mu
        da, db, dza, dzb = step(aim - a * za - da * dza, aim - b * zb - db * dzb)
        t = 0.99 * reach((a, da), (b, db), (za, dza), (zb, dzb))
        a, b, za, zb = a + t * da, b + t * db, za + t * dza, zb + t * dzb
        w = a - b
        gap = _duality_gap(C, c, yy, w, l1, l2)
        if gap <= tol * yy and a @ za + b @ zb <= tol * yy:
            clean = np.where(np.abs(w) > 1e-8 * np.abs(w).max(), w, 0.0)
            return clean if _duality_gap(C, c, yy, clean, l1, l2) <= tol * yy else w
        if not np.isfinite(gap):
            break
    raise RuntimeError(f"lasso stalled at a duality gap of {gap / yy:.3g}, above {tol:.3g}")


def lasso_cd(C: np.ndarray, c: np.ndarray, n: float, alpha: float, l1_ratio: float = 1.0,
             tol: float = LASSO_TOL, yy: float | None = None, w0: np.ndarray | None = None) -> np.ndarray:
    """Minimise 1/(2n)||yc - Xc w||^2 + alpha*(l1 ||w||_1 + (1-l1)/2 ||w||^2) from the
    centred Gramian C = Xc'Xc, c = Xc'yc and yy = yc'yc.

    Sweeps of coordinate descent alternate with exact steps on the signed
    support.  Both lower the objective; the fit ends once the duality gap is
    below tol x yy.  A step costs a decomposition for each coefficient that leaves,
    so a support beyond ``STEP_WIDTH`` columns and a fit that takes more than
    ``STEPS`` of them or stalls are solved by interior points to the same gap."""
    yy = float(yy) if yy is not None else float(c @ np.linalg.lstsq(C, c, rcond=None)[0])
    l1, l2 = alpha * l1_ratio * n, alpha * (1.0 - l1_ratio) * n
    w = np.zeros(len(c)) if w0 is None else w0.astype(float).copy()
    diag = np.diag(C).copy()
    best, still, steps = np.inf, 0, 0

    def objective(v):
        return 0.5 * (v @ (C @ v)) - c @ v + l1 * np.abs(v).sum() + 0.5 * l2 * (v @ v)
    while True:
        grad = c - C @ w
        # the worst offenders join in small lots, so the support seldom outgrows the rows
        outside = np.flatnonzero((w == 0) & (np.abs(grad) > l1))
        lot = max(JOIN, np.count_nonzero(w) // 4)
        at = np.union1d(np.flatnonzero(w), outside[np.argsort(-np.abs(grad[outside]), kind="stable")[:lot]])
        for _ in range(SWEEPS):
            for j in at.tolist():
                if diag[j] <= 0:
                    continue
                old, rho = w[j], grad[j] + diag[j] * w[j]
                new = (rho - l1 if rho > l1 else rho + l1 if rho < -l1 else 0.0) / (diag[j] + l2)
                if new != old:
                    grad -= C[j] * (new - old)          # C is symmetric: a contiguous row
                    w[j] = new
        gap = _duality_gap(C, c, yy, w, l1, l2)
        if gap <= tol * yy:
            return w
        if l1 > 0 and (np.count_nonzero(w) > STEP_WIDTH or steps > STEPS or still > STALLED):
            return _lasso_interior(C, c, yy, l1, l2, tol)
        whole = False
        while not whole and (step := support_step(C, c, w, l1, l2)) is not None and objective(step[0]) < objective(w):
            w, whole = step
            steps += 1
            if l1 > 0 and steps > STEPS:
                break
        value = objective(w)
        still = 0 if value < best - 1e-15 * yy else still + 1
        best = min(best, value)
        if still > STALLED and l1 <= 0:
            raise RuntimeError(f"lasso stalled at a duality gap of {gap / yy:.3g}, above {tol:.3g}")


def _screened_lasso(df, features, label, alpha, l1_ratio, tol):
    """Wide problems: columns enter the Gramian only while their correlation with the residual breaks the bound.

    Each round is two scans: the Gramian of the working columns, on which the
    fit is solved, then the residual's correlation with every column, which
    gives the duality gap of the whole problem.  Columns that the gap proves to
    be zero (gap-safe sphere) are never tried again.  Returns (n, means, w, gap / yy)."""
    m = total(moment_sums(df, features, label, second_order="diag_y"))
    p, n, mean = m.p, m.n, m.mean()
    c = m.cross_y[:p] - m.s[:p] * m.s[p] / n
    norm = np.sqrt(np.maximum(m.diag[:p] - m.s[:p] ** 2 / n, 0.0))
    yy = float(m.diag[p] - m.s[p] ** 2 / n)
    l1, l2 = alpha * l1_ratio * n, alpha * (1.0 - l1_ratio) * n
    w, open_, inner = np.zeros(p), norm > 0, tol / 10
    work = np.sort(np.argsort(-np.where(open_, np.abs(c), -1.0), kind="stable")[:SCREEN_STEP])
    while True:
        g = total(moment_sums(df, features.at(work) if isinstance(features, Derived) else _Columns(features, work), label,
                              shift=mean[np.append(work, p)]))
        S = g.centered()
        w = _placed(p, work, lasso_cd(S[:-1, :-1], S[:-1, -1], n, alpha, l1_ratio, inner, yy, w[work]))
        slope, r2 = _residual_slopes(df, features, label, mean, w)
        slope -= l2 * w
        top = np.abs(slope).max(initial=0.0)
        k = l1 / top if top > l1 > 0 else 1.0
        # primal - dual at the scaled residual
        gap = (0.5 * r2 * (1 + k * k) + 0.5 * l2 * (w @ w) * (1 + k * k) + l1 * np.abs(w).sum()
               - k * (r2 + w @ slope + l2 * (w @ w)))
        if gap <= tol * yy:
            return n, mean, w, gap / yy
        if l1 > 0:
            open_ &= (np.abs(slope) * k + np.sqrt(2 * max(gap, 0.0)) * np.sqrt(norm ** 2 + l2) >= l1) | (w != 0)
        broken = np.flatnonzero(open_ & (np.abs(slope) > l1) & ~np.isin(np.arange(p), work))
        if not len(broken):
            inner /= 10
            if inner < 1e-13:
                raise RuntimeError(f"lasso stalled at a duality gap of {gap / yy:.3g}, above {tol:.3g}")
            continue
        broken = broken[np.argsort(-np.abs(slope[broken]), kind="stable")]
        work = np.union1d(work[open_[work]], broken[:max(SCREEN_STEP, len(work))])


def _placed(p: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    w = np.zeros(p)
    w[at] = values
    return w


class _Columns(str):
    """An array column of which ``feature_matrix`` reads the given positions only."""

    def __new__(cls, name, positions):
        out = super().__new__(cls, name)
        out.positions = np.asarray(positions)
        return out

    def __reduce__(self):
        return (_Columns, (str(self), self.positions))


def _residual_slopes(df, features, label, mean, w) -> tuple[np.ndarray, float]:
    """(Xc'(yc - Xc w), squared norm of the residual) in one scan."""
    from pulsegrid.operators.moments import PARTIAL_SCHEMA, _emit, _to_batch, _vec, feature_matrix, passes, sum_partials
    p = len(w)
    data = df.select(stored(features), label)

    def kernel(batches):
        from pyspark import TaskContext
        acc = np.zeros(p + 1)
        for b in passes(batches, features):
            if b.num_rows:
                X = feature_matrix(b, features) - mean[:p]
                r = _vec(b, label) - mean[p] - X @ w
                acc[:p] += r @ X
                acc[p] += r @ r
        yield _to_batch(_emit(0, acc, TaskContext.get().partitionId()))

    vec = sum_partials(data.mapInArrow(kernel, PARTIAL_SCHEMA), data.rdd.getNumPartitions(), p + 1)
    return vec[:p], float(vec[p])


def fit_lasso(df: DataFrame, features, label: str, alpha: float, l1_ratio: float = 1.0,
              names=None, tol: float = LASSO_TOL) -> LinearModel:
    """M3: lasso (elastic net) with a free intercept.  Narrow problems are solved on one Gramian of all
    columns, wide ones on the columns that screening leaves.

    ``meta["gap"]`` is the duality gap reached as a share of the label's variation: at most ``tol``, or
    the fit raises."""
    width = (features.width if isinstance(features, Derived) else len(features) if not isinstance(features, str)
             else len((df.select(features).first() or [[]])[0]))
    if isinstance(features, str) and width > DIRECT_WIDTH:
        n, mean, w, gap = _screened_lasso(df, features, label, alpha, l1_ratio, tol)
        return LinearModel(float(mean[-1] - w @ mean[:-1]), w, list(names or []), {"n": n, "alpha": alpha, "gap": gap})
    m = total(moment_sums(df, features, label))
    p = m.p
    S = m.centered()
    C, c, yy = S[:p, :p], S[:p, p], S[p, p]
    w = lasso_cd(C, c, m.n, alpha, l1_ratio, tol=tol, yy=yy)
    gap = _duality_gap(C, c, yy, w, alpha * l1_ratio * m.n, alpha * (1.0 - l1_ratio) * m.n)
    mean = m.mean()
    return LinearModel(float(mean[p] - w @ mean[:p]), w, list(names or []),
                       {"n": m.n, "alpha": alpha, "l1_ratio": l1_ratio, "gap": float(gap / yy) if yy > 0 else 0.0})

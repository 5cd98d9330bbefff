"""SQL text for the SQL twins of small linear systems (Cramer's rule, k <= 3)."""

from __future__ import annotations


def det(m: list[list[str]]) -> str:
    k = len(m)
    if k == 1:
        return f"({m[0][0]})"
    if k == 2:
        return f"(({m[0][0]}) * ({m[1][1]}) - ({m[0][1]}) * ({m[1][0]}))"
    terms = []
    for j in range(k):
        minor = [row[:j] + row[j + 1:] for row in m[1:]]
        sign = "+" if j % 2 == 0 else "-"
        terms.append(f"{sign} ({m[0][j]}) * {det(minor)}")
    return "(" + " ".join(terms) + ")"


def cramer(C: list[list[str]], r: list[str]) -> list[str]:
    """Solutions of C w = r as SQL expressions."""
    d = det(C)
    out = []
    for i in range(len(r)):
        Ci = [row[:i] + [r[j]] + row[i + 1:] for j, row in enumerate(C)]
        out.append(f"({det(Ci)} / {d})")
    return out


def scatter_select(xs: list[str], y: str, prefix: str = "") -> str:
    """SELECT list of n, means m_i, scatter c_i_j and cross products r_i (about the means)."""
    parts = ["count(*) AS n", f"avg({y}) AS my"]
    k = len(xs)
    for i, x in enumerate(xs):
        parts.append(f"avg({x}) AS m{i}")
        parts.append(f"covar_pop({x}, {y}) * count(*) AS r{i}")
        for j in range(i, k):
            parts.append(f"covar_pop({x}, {xs[j]}) * count(*) AS c{i}_{j}")
    return ", ".join(parts)


def ridge_solution(k: int, lam: str = "0") -> tuple[list[str], str]:
    """Coefficient and intercept expressions over columns produced by scatter_select."""
    C = [[(f"c{min(i, j)}_{max(i, j)}" + (f" + {lam}" if i == j else "")) for j in range(k)] for i in range(k)]
    w = cramer(C, [f"r{i}" for i in range(k)])
    intercept = "my - (" + " + ".join(f"{w[i]} * m{i}" for i in range(k)) + ")"
    return w, intercept

"""Distributed sufficient statistics: counts, sums and Gramians per group.

One ``mapInArrow`` pass builds, per task and per group (e.g. fold), the
moments of z = [x - shift, y - shift_y]: count, sum z and the packed upper
triangle of z'z.  The partial vectors are cut into fixed-size chunks and summed
by a fan-in tree of ``groupBy`` rounds, each group holding at most ``FAN_IN``
chunks, so no task ever holds more than FAN_IN x CHUNK doubles and only the
final (p+1)^2 numbers reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 1 << 16   # doubles per partial chunk (512 KiB)
FAN_IN = 16       # chunks summed per group in one tree round
NULL_GROUP = -1   # group id for rows whose group column is null


PASS_VALUES = 1 << 20   # values of derived matrices that a pass holds at once (8 MiB)


class Derived(str):
    """The name of an array column that no table holds: ``make`` of the matrix of column ``source``.

    Passes read the source and make what they need of it, some rows at a time, so wide columns are
    neither stored nor moved.  ``make.at(positions)`` must give the maker of some of its columns."""

    def __new__(cls, name, source, make, width):
        out = super().__new__(cls, name)
        out.source, out.make, out.width = str(source), make, int(width)
        return out

    def __reduce__(self):
        return (Derived, (str(self), self.source, self.make, self.width))

    def at(self, positions):
        return Derived(str(self), self.source, self.make.at(np.asarray(positions)), len(positions))


def stored(features):
    """The columns of the table that ``features`` is read from."""
    return features.source if isinstance(features, Derived) else features


def passes(batches, *columns):
    """The batches, in slices where a derived column is read, so its matrix stays small."""
    width = sum(c.width for c in columns if isinstance(c, Derived))
    rows = max(1, PASS_VALUES // width) if width else None
    for b in batches:
        if rows is None or b.num_rows <= rows:
            yield b
        else:
            yield from (b.slice(a, rows) for a in range(0, b.num_rows, rows))


def feature_matrix(batch: pa.RecordBatch, features, dtype=np.float64) -> np.ndarray:
    """(rows x p) matrix from an array column, derived or not, or from a list of scalar columns."""
    if isinstance(features, Derived):
        return features.make(feature_matrix(batch, features.source, dtype))
    if isinstance(features, str):
        arr = batch.column(batch.schema.get_field_index(features))
        if isinstance(arr, pa.ChunkedArray):
            arr = arr.combine_chunks()
        n = len(arr)
        if n == 0:
            return np.zeros((0, 0), dtype=dtype)
        if arr.null_count:
            raise ValueError(f"null feature array in column {features}")
        flat = arr.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
        offs = arr.offsets.to_numpy()
        width = offs[1] - offs[0]
        if len(flat) != n * width or not np.all(np.diff(offs) == width):
            raise ValueError(f"feature arrays in {features} differ in length")
        matrix = flat.reshape(n, width)
        return matrix if not hasattr(features, "positions") else matrix[:, features.positions]
    cols = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in features]
    return np.column_stack([np.asarray(c, dtype=dtype) for c in cols]) if cols else np.zeros((batch.num_rows, 0))


def _vec(batch, name, dtype=np.float64):
    return np.asarray(batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False), dtype=dtype)


def _group_ids(batch, group):
    if group is None:
        return np.zeros(batch.num_rows, dtype=np.int64)
    a = batch.column(batch.schema.get_field_index(group))
    vals = a.fill_null(NULL_GROUP).to_numpy(zero_copy_only=False)
    return np.asarray(vals, dtype=np.int64)


def _emit(gid, vec, pid):
    n = len(vec)
    k = math.ceil(n / CHUNK) if n else 0
    rows = {"grp": [], "part": [], "chunk": [], "v": []}
    for c in range(k):
        rows["grp"].append(int(gid))
        rows["part"].append(int(pid))
        rows["chunk"].append(c)
        rows["v"].append(vec[c * CHUNK:(c + 1) * CHUNK])
    return rows


PARTIAL_SCHEMA = T.StructType([T.StructField("grp", T.LongType()), T.StructField("part", T.LongType()),
                               T.StructField("chunk", T.IntegerType()),
                               T.StructField("v", T.ArrayType(T.DoubleType()))])


def _to_batch(rows):
    return pa.RecordBatch.from_pydict({
        "grp": pa.array(rows["grp"], pa.int64()), "part": pa.array(rows["part"], pa.int64()),
        "chunk": pa.array(rows["chunk"], pa.int32()),
        "v": pa.array([np.asarray(v, dtype=np.float64) for v in rows["v"]], pa.list_(pa.float64()))})


def constant_to_rounding(n, mean, mean_square, var):
    """True where a variance is no more than the rounding of the sums it came from.

    ``mean`` and ``mean_square`` are of the values about the shift that was used."""
    eps = np.finfo(float).eps
    return var <= eps * np.maximum(mean_square, 0.0) + (n * mean * eps) ** 2


DIRECT_LIMIT = 1 << 23   # partial doubles (64 MiB) that may go straight to the driver


def sum_partials(partials: DataFrame, n_parts: int, length: int) -> np.ndarray:
    """Sum the per-task vectors of a single-group partial table.

    When all partials together are small (tasks x length <= DIRECT_LIMIT) they
    are collected and added on the driver (one stage, like treeAggregate with
    depth 1); otherwise the bounded fan-in tree does the sums on executors."""
    if n_parts * length <= DIRECT_LIMIT:
        acc = np.zeros(length)
        for r in partials.collect():
            v = np.asarray(r["v"])
            acc[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(v)] += v
        return acc
    rows = tree_sum(partials, ["grp", "chunk"], n_parts).collect()
    return np.concatenate([np.asarray(r["v"]) for r in sorted(rows, key=lambda r: r["chunk"])])


def tree_sum(partials: DataFrame, keys: Sequence[str], n_parts: int, value: str = "v",
             part: str = "part", fan_in: int = FAN_IN) -> DataFrame:
    """Element-wise sum of equal-length arrays per key, in rounds of bounded groups."""
    level = partials
    remaining = max(int(n_parts), 1)
    while True:
        remaining = math.ceil(remaining / fan_in)
        grouped = level.groupBy(*keys, F.floor(F.col(part) / fan_in).cast("long").alias(part)).agg(
            F.collect_list(value).alias("_l"))
        level = grouped.select(*keys, part, F.aggregate(
            F.slice("_l", 2, F.greatest(F.size("_l") - 1, F.lit(0))), F.element_at("_l", 1),
            lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b)).alias(value))
        if remaining <= 1:
            return level.drop(part)


@dataclass
class Moments:
    """Moments of z = [x - shift, y - shift_y] for one group."""
    n: float
    s: np.ndarray          # (q,) sums of z
    G: np.ndarray | None   # (q, q) z'z (None in the diagonal modes)
    shift: np.ndarray      # (q,) the shift used
    diag: np.ndarray | None = None      # Σ z_j^2 (diagonal modes)
    cross_y: np.ndarray | None = None   # Σ z_j z_last (mode diag_y)

    @property
    def p(self) -> int:
        return len(self.s) - 1

    def _combine(self, o, sign):
        def f(a, b):
            return None if a is None else a + sign * b
        return Moments(self.n + sign * o.n, self.s + sign * o.s, f(self.G, o.G), self.shift,
                       f(self.diag, o.diag), f(self.cross_y, o.cross_y))

    def __add__(self, o):
        return self._combine(o, 1.0)

    def __sub__(self, o):
        return self._combine(o, -1.0)

    def var(self) -> np.ndarray:
        """Population variance of every column."""
        d = self.diag if self.diag is not None else np.diag(self.G)
        return d / self.n - (self.s / self.n) ** 2

    def augmented(self) -> np.ndarray:
        """(q+1 x q+1) moment matrix of [1, z]."""
        q = len(self.s)
        M = np.empty((q + 1, q + 1))
        M[0, 0] = self.n
        M[0, 1:] = self.s
        M[1:, 0] = self.s
        M[1:, 1:] = self.G
        return M

    def mean(self) -> np.ndarray:
        return self.shift + self.s / self.n

    def centered(self) -> np.ndarray:
        """Σ (z - z̄)(z - z̄)' (scatter matrix about the group's own mean)."""
        return self.G - np.outer(self.s, self.s) / self.n


def _second_init(mode, q):
    if mode == "full":
        return np.zeros((q, q))
    if mode == "diag":
        return np.zeros(q)
    if mode == "diag_y":
        return [np.zeros(q), np.zeros(q)]
    return None


def _unpack(vec: np.ndarray, q: int, shift: np.ndarray) -> Moments:
    n = vec[0]
    s = vec[1:1 + q]
    iu = np.triu_indices(q)
    G = np.zeros((q, q))
    G[iu] = vec[1 + q:1 + q + len(iu[0])]
    G = G + np.triu(G, 1).T
    return Moments(float(n), s.copy(), G, shift)


def column_means(df: DataFrame, features, label: str | None = None) -> np.ndarray:
    """Means of the feature columns (and label) in one pass: a p-vector to the driver."""
    return moment_sums(df, features, label, shift=None, second_order=False)[0].mean()


def moment_sums(df: DataFrame, features, label: str | None, group: str | None = None,
                shift: np.ndarray | str | None = "mean", second_order: bool = True,
                weight: str | None = None) -> dict[int, Moments]:
    """Per-group moments of [features, label] in one distributed pass.

    ``second_order``: True / "full" (Gramian), "diag" (Σ z^2 per column),
    "diag_y" (Σ z^2 and Σ z * label per column), False (first order only).

    ``shift='mean'`` first computes global means (a cheap first-order pass) so
    that the Gramian is formed about the mean (no cancellation later when
    fold statistics are subtracted from totals).  Returns {group id: Moments};
    rows with a null group get id -1.
    """
    if isinstance(shift, str) and shift == "mean":
        shift = column_means(df, features, label)
    mode = {True: "full", False: "none"}.get(second_order, second_order)
    cols = [stored(features)] if isinstance(features, str) else list(features)
    keep = cols + ([label] if label else []) + ([group] if group else []) + ([weight] if weight else [])
    data = df.select(*keep)
    sh = None if shift is None else np.asarray(shift, dtype=np.float64)

    def kernel(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        acc = {}
        for b in passes(batches, *([features] if isinstance(features, str) else [])):
            if b.num_rows == 0:
                continue
            X = feature_matrix(b, features)
            Z = np.column_stack([X, _vec(b, label)]) if label else X
            if sh is not None:
                Z = Z - sh
            g = _group_ids(b, group)
            w = _vec(b, weight) if weight else None
            for gid in np.unique(g):
                Zg = Z[g == gid]
                q = Zg.shape[1]
                if gid not in acc:
                    acc[gid] = [0.0, np.zeros(q), _second_init(mode, q)]
                a = acc[gid]
                wg = None if w is None else w[g == gid]
                a[0] += len(Zg) if wg is None else wg.sum()
                a[1] += Zg.sum(axis=0) if wg is None else wg @ Zg
                Zw = Zg if wg is None else Zg * wg[:, None]
                if mode == "full":
                    a[2] += Zw.T @ Zg
                elif mode == "diag":
                    a[2] += (Zw * Zg).sum(axis=0)
                elif mode == "diag_y":
                    a[2][0] += (Zw * Zg).sum(axis=0)
                    a[2][1] += Zw.T @ Zg[:, -1]
        for gid, (n, s, G) in acc.items():
            q = len(s)
            parts = [np.array([n]), s]
            if mode == "full":
                parts.append(G[np.triu_indices(q)])
            elif mode == "diag":
                parts.append(G)
            elif mode == "diag_y":
                parts += [G[0], G[1]]
            yield _to_batch(_emit(gid, np.concatenate(parts), pid))

    n_parts = data.rdd.getNumPartitions()
    partials = data.mapInArrow(kernel, PARTIAL_SCHEMA)
    summed = tree_sum(partials, ["grp", "chunk"], n_parts)
    rows = summed.collect()
    by_grp: dict[int, list] = {}
    for r in rows:
        by_grp.setdefault(r["grp"], []).append((r["chunk"], r["v"]))
    out = {}
    for gid, chunks in by_grp.items():
        vec = np.concatenate([np.asarray(v) for _, v in sorted(chunks)])
        if mode in ("diag", "diag_y"):
            k = 2 if mode == "diag" else 3
            q = (len(vec) - 1) // k
            m = Moments(float(vec[0]), vec[1:1 + q].copy(), None, sh if sh is not None else np.zeros(q))
            m.diag = vec[1 + q:1 + 2 * q].copy()
            m.cross_y = vec[1 + 2 * q:1 + 3 * q].copy() if mode == "diag_y" else None
            out[gid] = m
        elif mode == "full":
            # length = 1 + q + q(q+1)/2
            q = int((-3 + math.isqrt(9 + 8 * (len(vec) - 1))) // 2)
            out[gid] = _unpack(vec, q, sh if sh is not None else np.zeros(q))
        else:
            q = len(vec) - 1
            out[gid] = Moments(float(vec[0]), vec[1:].copy(), np.zeros((q, q)),
                               sh if sh is not None else np.zeros(q))
    return out


def total(moments: dict[int, Moments]) -> Moments:
    it = iter(moments.values())
    acc = next(it)
    for m in it:
        acc = acc + m
    return acc

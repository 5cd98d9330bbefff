"""Table-level feature transforms (T1-T4, T6, T7) as pyspark.ml stages.

Every estimator works on one ``array<double>`` column; fitting runs Spark
aggregates (moments, distributed exact medians) and keeps only p-vectors on
the driver; transforming is a column expression with the fitted vectors as
literals, so it stays inside the JVM.  Stages chain in a ``pyspark.ml.Pipeline``
and ``PipelineModel(stages[:-1])`` replays all but the model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.moments import Derived, constant_to_rounding, moment_sums, stored, total


def _lit_array(v) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


class _StageWriter(MLWriter):
    """Class, uid and the constructor's arguments of a stage in the metadata file."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"arguments": self.stage.arguments()})


class _StageReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls(**{k: float("nan") if v == "nan" else v for k, v in meta["arguments"].items()})
        return stage._resetUid(meta["uid"])


def _plain(v):
    if isinstance(v, np.ndarray):
        return [_plain(x) for x in v.tolist()]
    return "nan" if isinstance(v, float) and math.isnan(v) else v


class _ArrayStage(MLWritable, MLReadable):
    """Columns and persistence (T7): stages save and load inside a ``Pipeline`` or ``PipelineModel``."""

    _arguments: tuple = ()

    def _init_cols(self, inputCol, outputCol):
        self.inputCol = inputCol
        self.outputCol = outputCol or inputCol

    def arguments(self) -> dict:
        return {a: _plain(getattr(self, a)) for a in ("inputCol", "outputCol", *self._arguments)}

    def write(self):
        bad = [a for a in self._arguments if callable(getattr(self, a))]
        if bad:
            raise ValueError(f"a stage with a function as its {bad[0]} can't be saved")
        return _StageWriter(self)

    @classmethod
    def read(cls):
        return _StageReader(cls)


# ---------------------------------------------------------------- T1
def poly_names(names: Sequence[str], sep: str = "*") -> list[str]:
    """Degree-2 names: originals, then a^2 / a<sep>b for i <= j."""
    out = list(names)
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            out.append(f"{a}^2" if i == j else f"{a}{sep}{names[j]}")
    return out


def poly_expr(x, p: int) -> Column:
    """x1..xp, then xi*xj for i <= j (p + p(p+1)/2 values)."""
    xs = F.col(x) if isinstance(x, str) else x
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.transform(
        F.slice(xs, i + 1, F.lit(p) - i), lambda v: F.get(xs, i) * v)))
    return F.concat(xs, pairs)


class ExpandedMatrix:
    """Degree-2 expansion of a matrix as ``poly_expr`` has it, scaled where ``mean`` and ``std`` are given,
    rounded to float32 where ``single``; of the columns at ``positions`` only.  Makes ``Derived`` columns."""

    def __init__(self, width, mean=None, std=None, positions=None, single=False):
        self.width, self.mean, self.std, self.single = width, mean, std, single
        self.positions = np.arange(width + width * (width + 1) // 2) if positions is None else np.asarray(positions)

    def at(self, positions):
        return ExpandedMatrix(self.width, self.mean, self.std, self.positions[positions], self.single)

    def __call__(self, X):
        i, j = np.triu_indices(self.width)
        left, right = np.append(np.arange(self.width), i)[self.positions], np.append(np.zeros(self.width, int), j)[self.positions]
        columns, pairs = np.ascontiguousarray(X.T), self.positions >= self.width
        out = columns[left]
        out[pairs] *= columns[right[pairs]]
        if self.mean is not None:
            out -= self.mean[self.positions, None]
            out /= self.std[self.positions, None]
        return (out.astype(np.float32).astype(float) if self.single else out).T


class PolynomialExpansion(Transformer, _ArrayStage):
    """Degree-2 expansion without bias, terms in (i <= j) order."""

    _arguments = ("width", "names", "sep")

    def __init__(self, inputCol="features", outputCol=None, width=None, names=None, sep="*"):
        super().__init__()
        self._init_cols(inputCol, outputCol)
        self.width = width
        self.names = list(names) if names is not None else None
        self.sep = sep

    def out_names(self):
        return poly_names(self.names, self.sep) if self.names else None

    def _transform(self, df):
        p = self.width if self.width is not None else len(df.select(self.inputCol).first()[0])
        return df.withColumn(self.outputCol, poly_expr(self.inputCol, p))


# ---------------------------------------------------------------- T2
class PopulationScaler(Estimator, _ArrayStage):
    """(x - mean) / std with the population std; a zero std divides by 1."""

    def __init__(self, inputCol="features", outputCol=None):
        super().__init__()
        self._init_cols(inputCol, outputCol)

    def _fit(self, df):
        m = total(moment_sums(df.select(stored(self.inputCol)), self.inputCol, None, second_order="diag"))
        mean = m.mean()
        var = np.maximum(m.var(), 0.0)
        std = np.where(constant_to_rounding(m.n, m.s / m.n, m.diag / m.n, var), 1.0, np.sqrt(var))
        return PopulationScalerModel(self.inputCol, self.outputCol, mean, std)


class PopulationScalerModel(Model, _ArrayStage):
    _arguments = ("mean", "std")

    def __init__(self, inputCol, outputCol, mean, std):
        super().__init__()
        self._init_cols(inputCol, outputCol)
        self.mean = np.asarray(mean, dtype=float)
        self.std = np.asarray(std, dtype=float)

    def _transform(self, df):
        ms = F.arrays_zip(_lit_array(self.mean).alias("m"), _lit_array(self.std).alias("s"))
        return df.withColumn(self.outputCol, F.zip_with(
            F.col(self.inputCol).cast("array<double>"), ms, lambda v, q: (v - q["m"]) / q["s"]))

    def state(self):
        return {"mean": self.mean, "std": self.std}


# ---------------------------------------------------------------- T3
MEDIAN_LIMIT = 4096      # values per column collected once the bracket is this small
MEDIAN_BUCKETS = 1024    # histogram buckets per refinement round


def column_medians(df: DataFrame, col: str, limit: int = MEDIAN_LIMIT, buckets: int = MEDIAN_BUCKETS,
                   group: str | None = None) -> dict:
    """Exact median of every array position (NaN / null ignored), optionally per group.

    Distributed selection: each round counts values per (position, histogram
    bucket) inside the current bracket and narrows the bracket to the buckets
    holding the two middle ranks; once at most ``limit`` values remain, they
    are collected per position (a bounded group) and the middle two averaged.
    Returns {(group, pos): median} (group None when not grouped); positions
    with no observed value are absent.
    """
    spark = df.sparkSession
    g = F.col(group) if group else F.lit(0)
    long = (df.select(g.cast("long").alias("g"), F.posexplode(F.col(col).cast("array<double>")).alias("pos", "v"))
              .filter(F.col("v").isNotNull() & ~F.isnan("v")))
    base = long.groupBy("g", "pos").agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("lo"),
                                        F.max("v").alias("hi")).collect()
    st = {(r["g"], r["pos"]): dict(m=r["m"], lo=r["lo"], hi=r["hi"], inb=r["m"]) for r in base}
    done = {k: float(s["lo"]) for k, s in st.items() if s["lo"] == s["hi"]}
    while True:      # the ends of a bracket fall into different buckets, so each round leaves fewer values
        active = [k for k, s in st.items() if k not in done and s["inb"] > limit]
        if not active:
            break
        br = spark.createDataFrame([(k[0], k[1], st[k]["lo"], st[k]["hi"]) for k in active],
                                   "g long, pos int, lo double, hi double")
        j = long.join(F.broadcast(br), ["g", "pos"])   # bracket table: one row per active position
        bucket = (F.when(F.col("v") < F.col("lo"), F.lit(-1)).when(F.col("v") > F.col("hi"), F.lit(buckets))
                  .otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets)
                                     .cast("int"), F.lit(buckets - 1))))
        hist = j.groupBy("g", "pos", bucket.alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.min("v").alias("bmin"), F.max("v").alias("bmax")).collect()
        per = {}
        for r in hist:
            per.setdefault((r["g"], r["pos"]), []).append((r["b"], r["c"], r["bmin"], r["bmax"]))
        for k in active:
            s = st[k]
            rows = sorted(per.get(k, []))
            cum = sum(c for b, c, _, _ in rows if b < 0)
            spans = []          # (first rank, last rank, bmin, bmax) per non-empty bucket in order
            for b, c, bmin, bmax in rows:
                if 0 <= b < buckets:
                    spans.append((cum, cum + c - 1, bmin, bmax))
                    cum += c
            k1, k2 = (s["m"] - 1) // 2, s["m"] // 2
            b1 = next(i for i, sp in enumerate(spans) if sp[1] >= k1)
            b2 = next(i for i, sp in enumerate(spans) if sp[1] >= k2)

            def exact(sp, t):
                if sp[0] == sp[1] or sp[2] == sp[3]:
                    return sp[2]
                if t == sp[0]:
                    return sp[2]
                if t == sp[1]:
                    return sp[3]
                return None
            v1, v2 = exact(spans[b1], k1), exact(spans[b2], k2)
            if v1 is not None and v2 is not None:
                done[k] = (v1 + v2) / 2.0
                continue
            inb = spans[b2][1] - spans[b1][0] + 1
            if inb >= s["inb"]:
                raise ValueError(f"no finite range of values at position {k[1]} of {col}")
            s.update(lo=spans[b1][2], hi=spans[b2][3], inb=inb)
    rest = [k for k in st if k not in done]
    if rest:
        # final: collect the (bounded) bracket values and count what lies below
        fin = spark.createDataFrame([(k[0], k[1], st[k]["lo"], st[k]["hi"]) for k in rest],
                                    "g long, pos int, lo double, hi double")
        j = long.join(F.broadcast(fin), ["g", "pos"])
        res = j.groupBy("g", "pos").agg(
            F.count(F.when(F.col("v") < F.col("lo"), 1)).alias("below"),
            F.sort_array(F.collect_list(F.when((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")),
                                               F.col("v")))).alias("vals")).collect()
        for r in res:
            k = (r["g"], r["pos"])
            s = st[k]
            k1, k2 = (s["m"] - 1) // 2 - r["below"], s["m"] // 2 - r["below"]
            done[k] = (r["vals"][k1] + r["vals"][k2]) / 2.0
    if group is None:
        return {pos: v for (_, pos), v in done.items()}
    return done


class MedianImputer(Estimator, _ArrayStage):
    """NaN -> exact per-position median (mean of the two middle values).

    A position with no observed value is filled with 0 and listed in
    ``model.missing`` (the reference would silently drop the column)."""

    _arguments = ("width",)

    def __init__(self, inputCol="features", outputCol=None, width=None):
        super().__init__()
        self._init_cols(inputCol, outputCol)
        self.width = width

    def _fit(self, df):
        med = column_medians(df, self.inputCol)
        p = self.width if self.width is not None else len(df.select(self.inputCol).first()[0])
        vals = np.array([med.get(i, 0.0) for i in range(p)])
        return MedianImputerModel(self.inputCol, self.outputCol, vals, [i for i in range(p) if i not in med])


class MedianImputerModel(Model, _ArrayStage):
    _arguments = ("medians", "missing")

    def __init__(self, inputCol, outputCol, medians, missing=()):
        super().__init__()
        self._init_cols(inputCol, outputCol)
        self.medians = np.asarray(medians, dtype=float)
        self.missing = list(missing)

    def _transform(self, df):
        return df.withColumn(self.outputCol, F.zip_with(
            F.col(self.inputCol).cast("array<double>"), _lit_array(self.medians),
            lambda v, m: F.when(v.isNull() | F.isnan(v), m).otherwise(v)))

    def state(self):
        return {"medians": self.medians}


# ---------------------------------------------------------------- T4 / T5 / T6 selection
def f_from_sums(n, sx, sxx, sxy, sy, syy) -> np.ndarray:
    """F statistics r^2/(1-r^2)(n-2) from sums about any shift (NaN for constant columns)."""
    var = np.maximum(sxx / n - (sx / n) ** 2, 0.0)
    flat = constant_to_rounding(n, sx / n, sxx / n, var) | (var <= 1e-12 * sxx / n)
    with np.errstate(invalid="ignore", divide="ignore"):
        r = (sxy - sx * sy / n) / np.sqrt(var * n * (syy - sy * sy / n))
        r = np.where(flat, np.nan, r)
        return r * r / (1 - r * r) * (n - 2)


def f_scores(df: DataFrame, col: str, label: str) -> tuple[np.ndarray, float]:
    """Univariate F statistics from one moments pass (NaN for constant columns)."""
    m = total(moment_sums(df.select(col, label), col, label, second_order="diag_y"))
    p = m.p
    return f_from_sums(m.n, m.s[:p], m.diag[:p], m.cross_y[:p], m.s[p], m.diag[p]), m.n


def top_k_indices(scores: np.ndarray, k: int) -> np.ndarray:
    """k best scores (NaN lowest; among equal scores the later index wins), sorted by index."""
    s = np.where(np.isnan(scores), -np.finfo(float).max, scores)
    if k >= len(s):
        return np.arange(len(s))
    return np.sort(np.argsort(s, kind="stable")[-k:])


def slice_expr(col: str, idx: Sequence[int]) -> Column:
    """P5: keep positions idx (0-based) of an array column."""
    xs = F.col(col)
    return F.array(*[F.get(xs, int(i)) for i in idx]) if len(idx) else F.array().cast("array<double>")


class SelectKBest(Estimator, _ArrayStage):
    """T4 / T5: keep the k positions with the best univariate score.

    ``score`` is 'f' (F statistic from moments), 'mi' (k-NN mutual
    information, ``pulsegrid.operators.mutual_info``) or a callable
    (df, col, label) -> scores."""

    _arguments = ("labelCol", "k", "score")

    def __init__(self, inputCol="features", outputCol=None, labelCol="y", k=10, score="f"):
        super().__init__()
        self._init_cols(inputCol, outputCol)
        self.labelCol = labelCol
        self.k = k
        self.score = score

    def _scores(self, df):
        if callable(self.score):
            return np.asarray(self.score(df, self.inputCol, self.labelCol), dtype=float)
        if self.score == "f":
            return f_scores(df, self.inputCol, self.labelCol)[0]
        if self.score == "mi":
            from pulsegrid.operators.mutual_info import mi_scores
            return mi_scores(df, self.inputCol, self.labelCol)
        raise ValueError(f"unknown score {self.score}")

    def _fit(self, df):
        sc = self._scores(df)
        return SelectedModel(self.inputCol, self.outputCol, top_k_indices(sc, self.k), sc)


class SelectedModel(Model, _ArrayStage):
    _arguments = ("indices",)

    def __init__(self, inputCol, outputCol, indices, scores=None):
        super().__init__()
        self._init_cols(inputCol, outputCol)
        self.indices = np.asarray(indices, dtype=int)
        self.scores = scores

    def _transform(self, df):
        return df.withColumn(self.outputCol, slice_expr(self.inputCol, self.indices))

    def state(self):
        return {"indices": self.indices.astype(float)}


SAMPLE_ROWS_PER_TASK = 25_000


class LassoSelector(Estimator, _ArrayStage):
    """Fit a lasso on all rows, or on at most ``sample`` (exact seeded sample), keep
    the ``k`` largest |coef| (ties: lower index), output in index order."""

    _arguments = ("labelCol", "keyCol", "alpha", "k", "sample", "seed")

    def __init__(self, inputCol="features", outputCol=None, labelCol="y", keyCol="window_id",
                 alpha=0.001, k=500, sample=None, seed=42):
        super().__init__()
        self._init_cols(inputCol, outputCol)
        self.labelCol, self.keyCol = labelCol, keyCol
        self.alpha, self.k, self.sample, self.seed = alpha, k, sample, seed

    def _fit(self, df):
        from pulsegrid.operators.folds import sample_n
        from pulsegrid.operators.linear import fit_lasso
        sub = df.select(self.keyCol, stored(self.inputCol), self.labelCol)
        if self.sample is not None:
            # the sample is bounded; a few tasks share the Gramian work, each partial is p^2/2 doubles
            sub = sample_n(sub, self.sample, self.keyCol, self.seed).repartition(
                max(1, math.ceil(self.sample / SAMPLE_ROWS_PER_TASK)))
        held = self.sample is not None or not isinstance(self.inputCol, Derived)   # a derived column's source is the caller's
        if held:
            sub = sub.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = fit_lasso(sub, self.inputCol, self.labelCol, self.alpha)
        finally:
            if held:
                sub.unpersist()
        coef = np.abs(model.coef)
        p = len(coef)
        if p <= self.k:
            idx = np.arange(p)
        else:
            idx = np.sort(np.array(sorted(range(p), key=lambda i: (-coef[i], i))[:self.k]))
        return SelectedModel(self.inputCol, self.outputCol, idx, coef)


def fitted_state(model) -> dict:
    return model.state() if hasattr(model, "state") else {}


ScoreFn = Callable[[DataFrame, str, str], np.ndarray]

"""Fold and split assignment (E5, S5/J2, P6-P10, P7) as column expressions.

Seeded assignments hash the row key with md5 so they are repeatable on any
cluster and in plain SQL:
``fold = pmod(conv(substr(md5(seed ':' key), 1, 8), 16, 10), k)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_unit(key, seed: int) -> Column:
    """A repeatable integer in [0, 2^32) from md5(seed ':' key)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, 8), 16, 10).cast("long")


def fold_expr(key, k: int, seed: int = 42) -> Column:
    """E5: seeded K-fold id (balanced in expectation)."""
    return F.pmod(hash_unit(key, seed), F.lit(k))


def assign_folds(df: DataFrame, key: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    return df.withColumn(out, fold_expr(key, k, seed))


def range_fold_expr(index_col: str, ends: Sequence[int]) -> Column:
    """Fold f holds rows with ends[f-1] <= index < ends[f]; rows past the
    last end get null (they always train).  A CASE chain instead of a join: the
    ranges are a handful of constants, so no exchange is needed at all."""
    idx = F.col(index_col)
    expr = None
    start = 0
    for f, end in enumerate(ends):
        cond = (idx >= start) & (idx < end)
        expr = F.when(cond, F.lit(f)) if expr is None else expr.when(cond, F.lit(f))
        start = end
    return expr.otherwise(F.lit(None).cast("int")) if expr is not None else F.lit(None).cast("int")


FEW_ENDS = 64       # up to here the ranges are constants of one expression
RANGE_BLOCK = 256   # rows of an index block that share a lookup of their ranges


def assign_ranges(df: DataFrame, ends: DataFrame, index_col: str, out: str = "fold") -> DataFrame:
    """S5 / J2 for any number of ends (``pos, end``): fold ``pos`` holds the indexes from the end before
    it up to its own end, as ``range_fold_expr`` has it; others get null.

    The index is cut into blocks; each range goes to the blocks it meets, so
    rows join by block and look through the few ranges of theirs.  Nothing is
    collected, and no task holds more than a block's ranges.  The ends must not
    fall, or it raises."""
    before = ends.select((F.col("pos") + 1).alias("pos"), F.col("end").alias("_lo"))
    ranges = ends.join(before, "pos", "left").select("pos", F.coalesce("_lo", F.lit(0)).cast("long").alias("_lo"),
                                                     F.col("end").cast("long").alias("_hi"))
    ranges = ranges.withColumn("_hi", F.when(F.col("_hi") >= F.col("_lo"), F.col("_hi")).otherwise(
        F.raise_error(F.concat(F.lit("fold ends fall at position "), F.col("pos").cast("string"))).cast("long")))
    block = lambda c: F.floor(c / RANGE_BLOCK).cast("long")
    look = (ranges.filter("_hi > _lo")
                  .select("pos", "_lo", "_hi", F.explode(F.sequence(block(F.col("_lo")), block(F.col("_hi") - 1))).alias("_blk"))
                  .groupBy("_blk").agg(F.collect_list(F.struct("_lo", "_hi", "pos")).alias("_ranges")))
    rows = df.withColumn("_blk", block(F.col(index_col))).join(look, "_blk", "left")
    own = F.filter("_ranges", lambda r: (r["_lo"] <= F.col(index_col)) & (F.col(index_col) < r["_hi"]))
    return rows.withColumn(out, F.try_element_at(own, F.lit(1))["pos"].cast("int")).drop("_blk", "_ranges")


def train_rows(df: DataFrame, fold: str, k: int) -> DataFrame:
    """Training rows for fold k (other folds and rows in no fold)."""
    return df.filter((F.col(fold) != k) | F.col(fold).isNull())


def validation_rows(df: DataFrame, fold: str, k: int) -> DataFrame:
    """Validation rows for fold k."""
    return df.filter(F.col(fold) == k)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly n rows (all if fewer), chosen by the seeded hash of the key.

    A threshold on the hash, set from the row count, leaves little more than n
    keys; only those (hash, key) pairs are ordered and cut to n, and the rows
    are fetched by a semi join."""
    total = df.count()
    if total <= n:
        return df
    u, share = hash_unit(key, seed), (n + 5.0 * n ** 0.5 + 10.0) / total
    near = df.select(key).filter(u < int(share * (1 << 32)))
    while near.count() < n:              # a rare draw, or keys that repeat
        share *= 2.0
        near = df.select(key).filter(u < int(share * (1 << 32))) if share < 1.0 else df.select(key)
        if share >= 1.0:
            break
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    keys = near.withColumn("_h", h).orderBy("_h", key).limit(n).select(key)
    return df.join(keys, key, "left_semi")


def split_random(df: DataFrame, key: str, fraction: float, seed: int = 42, out: str = "split") -> DataFrame:
    """Random within-subject split; test when hash/2^32 < fraction."""
    u = hash_unit(key, seed) / F.lit(float(1 << 32))
    return df.withColumn(out, F.when(u < fraction, F.lit("test")).otherwise(F.lit("train")))


def split_temporal(df: DataFrame, part_col: str, train_value: str = "a", out: str = "split") -> DataFrame:
    """Temporal split by recording part: the earlier part trains, the later tests."""
    return df.withColumn(out, F.when(F.col(part_col) == train_value, F.lit("train")).otherwise(F.lit("test")))


def split_temporal_blocks(df: DataFrame, subject: str, block: str, fraction: float,
                          out: str = "split") -> DataFrame:
    """P9 without part labels: per subject the first (1 - fraction) of the blocks
    train and the rest test.  The per-subject block count is a partial
    aggregate (one row per subject), joined back on the subject key."""
    nb = df.groupBy(subject).agg(F.max(block).alias("_maxblk"))
    cut = F.floor((F.col("_maxblk") + 1) * (1.0 - fraction))
    return (df.join(nb, subject)
              .withColumn(out, F.when(F.col(block) < cut, F.lit("train")).otherwise(F.lit("test")))
              .drop("_maxblk"))


def split_subjects(df: DataFrame, subject: str, test_subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P10: cross-subject split; ``test_subjects`` is a one-column table of subjects
    (semi / anti join — Spark broadcasts it only when its measured size allows)."""
    t = test_subjects.select(F.col(test_subjects.columns[0]).alias(subject)).distinct()
    return df.join(t, subject, "left_anti"), df.join(t, subject, "left_semi")

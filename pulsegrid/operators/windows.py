"""Row indexing and cutting sample tables into fixed-length windows.

Both operators avoid ``Window.partitionBy(subject)``: one subject may hold a
third of all rows, and a per-subject window function would sort it in a single
task.  Instead rows are range-partitioned on (subject, order...), so a hot
subject is split over many tasks, and positions come from per-partition counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import written

WINDOW_SPAN = 1 << 32   # window keys: subject * WINDOW_SPAN + blk
_LOCAL_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row_in_partition


def _ranged_scan(df: DataFrame, keys: Sequence[str], groups: Sequence[str], flag: str | None,
                 out: str, num_partitions: int | None, keep: Sequence[str] | None = None) -> DataFrame:
    """Shared plan of ``with_row_index`` and ``running_count``.

    1. range exchange on ``keys`` + sort within partitions (a hot group spreads
       over many tasks);
    2. one Arrow pass over each sorted partition: for every row the flagged
       rows before it within its run of equal group keys (a run is a group's
       stretch inside one partition); the tagged rows are written once, of their
       columns those in ``keep`` (range bounds are re-sampled on every evaluation);
    3. a summary of two rows per partition (its first and last row) goes to
       the driver, which chains the carry-in of every partition: the flagged
       rows of its first group that lie in earlier partitions;
    4. the carries (one row per partition) are broadcast and added.
    No shuffle beyond the range exchange, no join on the group key."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql import types as T

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    if keep is not None:
        ranged = ranged.select(*keep)
    extra = [T.StructField("_pid", T.LongType()), T.StructField("_cum", T.LongType()),
             T.StructField("_first", T.BooleanType()), T.StructField("_edge", T.IntegerType()),
             T.StructField("_runv", T.LongType())]
    schema = T.StructType(list(ranged.schema.fields) + extra)
    names = [f.name for f in schema.fields]
    groups = list(groups)

    def kern(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        prev_key, run_id, run_v = None, -1, 0
        pending = None
        for b in batches:
            m = b.num_rows
            if m == 0:
                continue
            v = (np.asarray(b.column(b.schema.get_field_index(flag)).to_numpy(zero_copy_only=False), dtype=np.int64)
                 if flag else np.ones(m, dtype=np.int64))
            if groups:
                kdf = pd.DataFrame({g: b.column(b.schema.get_field_index(g)).to_pandas() for g in groups})
                start = (kdf != kdf.shift()).any(axis=1).to_numpy()
                start[0] = run_id < 0 or tuple(kdf.iloc[0]) != prev_key
                prev_key = tuple(kdf.iloc[-1])
            else:
                start = np.zeros(m, dtype=bool)
                start[0] = run_id < 0
            run_idx = run_id + np.cumsum(start)
            excl = np.cumsum(v) - v                           # flagged rows before, within the batch
            last_start = np.maximum.accumulate(np.where(start, np.arange(m), -1))
            cum = np.where(last_start >= 0, excl - excl[np.maximum(last_start, 0)], excl + run_v)
            run_v = int(cum[-1] + v[-1])
            run_id = int(run_idx[-1])
            cols = list(b.columns) + [pa.array(np.full(m, pid, np.int64)), pa.array(cum.astype(np.int64)),
                                      pa.array(run_idx == 0), pa.array(np.zeros(m, np.int32)),
                                      pa.array(np.zeros(m, np.int64))]
            batch = pa.RecordBatch.from_arrays(cols, names=names)
            if pending is None:
                e = np.zeros(m, np.int32)
                e[0] = 1
                batch = batch.set_column(names.index("_edge"), "_edge", pa.array(e))
            else:
                yield pending
            pending = batch
        if pending is not None:   # mark the partition's last row (2, or 3 when it is also the first)
            e = pending.column(names.index("_edge")).to_numpy(zero_copy_only=False).copy()
            e[-1] = e[-1] + 2
            rv = np.zeros(pending.num_rows, np.int64)
            rv[-1] = run_v
            pending = pending.set_column(names.index("_edge"), "_edge", pa.array(e.astype(np.int32)))
            pending = pending.set_column(names.index("_runv"), "_runv", pa.array(rv))
            yield pending

    tagged = written(ranged.mapInArrow(kern, schema), "ranged")
    edges = tagged.filter(F.col("_edge") > 0).select("_pid", "_edge", "_first", "_runv", *groups).collect()
    info = {}
    for r in edges:
        d = info.setdefault(r["_pid"], {})
        key = tuple(r[g] for g in groups)
        if r["_edge"] & 1:
            d["first_key"] = key
        if r["_edge"] & 2:
            d["last_key"], d["last_runv"], d["single"] = key, r["_runv"], bool(r["_first"])
    carry, prev = {}, None
    for pid in sorted(info):
        d = info[pid]
        c = 0
        if prev is not None and (not groups or d["first_key"] == prev["last_key"]):
            c = prev["last_runv"] + (prev["carry"] if prev["single"] else 0)
        d["carry"] = c
        carry[pid] = c
        prev = d
    ctab = spark.createDataFrame([(int(k), int(v)) for k, v in carry.items()] or [(0, 0)], "_pid long, _carry long")
    res = tagged.join(F.broadcast(ctab), "_pid")        # one row per partition
    val = F.col("_cum") + F.when(F.col("_first"), F.col("_carry")).otherwise(F.lit(0))
    return res.withColumn(out, val.cast("long")).drop("_pid", "_cum", "_first", "_edge", "_runv", "_carry")


def with_row_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "row_index",
                   partition_cols: Sequence[str] = (), num_partitions: int | None = None,
                   keep: Sequence[str] | None = None) -> DataFrame:
    """Contiguous 0-based index in the total order of ``order_cols``
    (restarting per group of ``partition_cols``; a group's rows still spread
    over many tasks).  The order must be total, or the index is not repeatable.
    ``keep``: the columns returned beside the index, ``partition_cols`` among them."""
    keys = list(partition_cols) + list(order_cols)
    return _ranged_scan(df, keys, partition_cols, None, index_col, num_partitions, keep)


def _field(name):
    return lambda s: s[name]


def cut_windows(samples: DataFrame, subject: str, order_cols: Sequence[str], value_cols: Sequence[str],
                n: int, label_col: str | None = None,
                extra_first: Sequence[str] = ()) -> DataFrame:
    """Consecutive blocks of ``n`` samples per subject in time order.

    Returns one row per complete window: ``subject, blk, window_id`` and one
    ``array<double>`` per value column in time order; short tails are dropped.
    ``window_id`` packs (subject, blk) into one long, blk in the lower 32 bits:
    unique for integer subjects below 2^31 with fewer than 2^32 windows each.
    With ``label_col`` the window also gets ``y`` = that column of the sample
    right after the window (windows without a next sample get null).
    Groups are (subject, blk), so no group ever exceeds n + 1 rows.
    """
    keep = dict.fromkeys([subject, *value_cols, *([label_col] if label_col else []), *extra_first])
    idx = with_row_index(samples, list(order_cols), "_rn", partition_cols=[subject], keep=list(keep))
    blk = F.floor(F.col("_rn") / n).cast("long")
    pos = (F.col("_rn") % n).cast("int")
    rows = idx.select(subject, blk.alias("blk"), pos.alias("_pos"),
                      *[F.col(c).cast("double").alias(c) for c in value_cols],
                      *([F.col(label_col).cast("double").alias("_lab")] if label_col else []),
                      *extra_first)
    if label_col:
        # the first sample of block b+1 is also the label of block b
        lab = (rows.filter((F.col("_pos") == 0) & (F.col("blk") > 0))
                   .select(subject, (F.col("blk") - 1).alias("blk"), F.col("_lab").alias("y")))
    agg = [F.count(F.lit(1)).alias("_n"),
           F.array_sort(F.collect_list(F.struct("_pos", *value_cols))).alias("_s")]
    agg += [F.first(c).alias(c) for c in extra_first]
    win = rows.groupBy(subject, "blk").agg(*agg).filter(F.col("_n") == n)
    sel = [subject, "blk", (F.col(subject).cast("long") * WINDOW_SPAN + F.col("blk")).alias("window_id")]
    sel += [F.transform("_s", _field(c)).alias(c) for c in value_cols]
    sel += list(extra_first)
    win = win.select(*sel)
    if label_col:
        win = win.join(lab, [subject, "blk"], "left")
    return win


def running_count(df: DataFrame, order_cols: Sequence[str], flag: str, out: str = "before",
                  partition_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Rows with ``flag`` = 1 strictly before each row in the total order of
    ``order_cols`` (restarting per group of ``partition_cols``); same plan as
    ``with_row_index``."""
    keys = list(partition_cols) + list(order_cols)
    return _ranged_scan(df, keys, partition_cols, flag, out, num_partitions)

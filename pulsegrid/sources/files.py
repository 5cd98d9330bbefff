"""Sources (S1, S3-S8) and sinks (K1-K7).

Text formats keep the reference's layouts (one value per line with 10
decimals, ``raw,err`` CV lines, bracketed fold ends) but are read and written
by Spark: ordered outputs are range-sorted and written as ordered part files,
so no single task holds a whole output.
"""

from __future__ import annotations

import io
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.windows import with_row_index


# ---------------------------------------------------------------- S1 / P1 / P2
def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line (one line read, no schema inference)."""
    first = spark.read.text(path).limit(1).collect()
    return [c.strip() for c in first[0][0].split(",")] if first else []


def read_wide_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  header: list[str] | None = None) -> DataFrame:
    """Wide CSV of windows with an explicit all-double schema built from the header."""
    if schema is None:
        names = header or csv_header(spark, path)
        schema = T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def feature_columns(df: DataFrame, label: str = "hr", exclude=()) -> list[str]:
    """All columns but the label (and keys), in file order."""
    return [c for c in df.columns if c != label and c not in exclude]


def pack_channels(df: DataFrame, prefixes, keep=()) -> DataFrame:
    """One array column per column-name prefix, file column order kept."""
    arrays = [F.array(*[F.col(f"`{c}`") for c in df.columns if c.startswith(p)]).alias(p.rstrip("_"))
              for p in prefixes]
    return df.select(*keep, *arrays)


def prepend_intercept(col) -> F.Column:
    """[1, x...]."""
    return F.concat(F.array(F.lit(1.0)), F.col(col).cast("array<double>"))


# ---------------------------------------------------------------- S3 / S4
# The channel names of the subject files.
NPZ_CHANNELS = ("e4_temp", "e4_eda", "e4_hr", "e4_bvp", "e4_acc", "zephyr_ecg", "zephyr_breathing", "zephyr_acc")
NPZ_AXES = ("e4_acc", "zephyr_acc")
NPZ_LABEL = "glucose"


def read_npz_dir(spark: SparkSession, path: str, channels=NPZ_CHANNELS, label: str = NPZ_LABEL) -> DataFrame:
    """S3: every ``*.npz`` of a folder -> one row per window.

    Columns: subject (file stem), part (suffix after the last '_', e.g. a/b),
    window (index in the file), label (null when absent) and one
    ``array<float>`` per channel; 3-axis channels become ``<name>_x/_y/_z``.
    Files are decoded by ``mapInArrow`` (one file per task at most 2 GB), and
    windows are emitted in small batches.  Fails when the folder has no file.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.npz")
             .option("recursiveFileLookup", "false").load(path).select("path", "content"))
    fields = [T.StructField("subject", T.StringType()), T.StructField("part", T.StringType()),
              T.StructField("window", T.LongType()), T.StructField("label", T.DoubleType())]
    out_ch = []
    for c in channels:
        if c in NPZ_AXES:
            out_ch += [f"{c}_x", f"{c}_y", f"{c}_z"]
        else:
            out_ch.append(c)
    fields += [T.StructField(c, T.ArrayType(T.FloatType())) for c in out_ch]
    schema = T.StructType(fields)
    arrow_schema = pa.schema([pa.field("subject", pa.string()), pa.field("part", pa.string()),
                              pa.field("window", pa.int64()), pa.field("label", pa.float64())] +
                             [pa.field(c, pa.list_(pa.float32())) for c in out_ch])

    def decode(batches):
        for b in batches:
            for p, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                stem = os.path.splitext(os.path.basename(p))[0]
                part = stem.rsplit("_", 1)[1] if "_" in stem else ""
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    n = z[channels[0]].shape[0]
                    lab = np.asarray(z[label], dtype=np.float64) if label in z.files else None
                    arrs = {}
                    for c in channels:
                        a = np.asarray(z[c], dtype=np.float32)
                        if c in NPZ_AXES:
                            a = a.reshape(n, -1, 3)
                            for k, ax in enumerate("xyz"):
                                arrs[f"{c}_{ax}"] = a[:, :, k]
                        else:
                            arrs[c] = a.reshape(n, -1)
                for s0 in range(0, n, 256):
                    s1 = min(n, s0 + 256)
                    cols = [pa.array([stem] * (s1 - s0)), pa.array([part] * (s1 - s0)),
                            pa.array(np.arange(s0, s1, dtype=np.int64)),
                            pa.array(lab[s0:s1] if lab is not None else [None] * (s1 - s0), pa.float64())]
                    for c in out_ch:
                        m = arrs[c][s0:s1]
                        cols.append(pa.ListArray.from_arrays(
                            pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.ravel())))
                    yield pa.RecordBatch.from_arrays(cols, schema=arrow_schema)

    if files.select("path").limit(1).count() == 0:
        raise FileNotFoundError(f"no *.npz file in {path}")
    return files.mapInArrow(decode, schema)


def read_labels(df: DataFrame, key=("subject", "window"), label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(key, label) with column pruning, plus violations for missing or
    non-finite labels."""
    k = list(key)
    lab = df.select(*k, label)
    bad = lab.filter(F.col(label).isNull() | F.isnan(label) | (F.abs(label) == float("inf")))
    viol = bad.select(F.lit("label_finite").alias("rule"), F.concat_ws(":", *[F.col(c).cast("string") for c in k])
                      .alias("key"), F.coalesce(F.col(label).cast("string"), F.lit("missing")).alias("detail"))
    return lab, viol


# ---------------------------------------------------------------- S5 / S6 / S7 / S8
def _lines(spark, path):
    """Text lines with their 0-based line number over all part files in name order.

    Splits are read largest first, so the place of a line is its file, the
    start of its block in that file, then its order inside the block.
    """
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"),
                                     F.col("_metadata.file_block_start").alias("_block"),
                                     F.monotonically_increasing_id().alias("_mid"))
    keys = ["_file", "_block", "_mid"]
    return with_row_index(t, keys, "line").drop(*keys)


def read_folds(spark: SparkSession, path: str, indexed: DataFrame, index_col: str = "row_index",
               out: str = "fold") -> DataFrame:
    """S5 + J2: fold spec -> ``indexed`` with a fold column.

    Form 1, ``[e1, e2, ...]``: cumulative ends; fold f = [e(f-1), e(f)); rows
    past the last end get null (they always train).  Form 2: one fold id per
    row (comma or blank separated), matched on the row index."""
    from pulsegrid.operators.folds import FEW_ENDS, assign_ranges, range_fold_expr
    brk = spark.read.text(path).filter(F.col("value").contains("[")).limit(1)
    text = F.regexp_extract("value", r"\[([^\]]*)\]", 1)
    ends = (brk.select(F.posexplode(F.filter(F.transform(F.split(text, ","), lambda v: F.trim(v)), lambda v: v != "")).alias("pos", "v"))
               .select("pos", F.col("v").cast("long").alias("end")))
    if not brk.isEmpty():
        few = ends.limit(FEW_ENDS + 1).collect()
        if len(few) <= FEW_ENDS:      # the same folds without a join
            return indexed.withColumn(out, range_fold_expr(index_col, [r["end"] for r in sorted(few)]))
        return assign_ranges(indexed, ends, index_col, out)
    lines = _lines(spark, path)
    toks = (lines.select("line", F.posexplode(F.split(F.trim(F.regexp_replace("value", ",", " ")), r"\s+"))
                         .alias("tpos", "tok")).filter(F.col("tok") != ""))
    ids = with_row_index(toks, ["line", "tpos"], "_ri").select(F.col("_ri").alias(index_col),
                                                              F.col("tok").cast("int").alias(out))
    return indexed.join(ids, index_col, "left")


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """One lambda per line, blanks skipped, raw text kept -> (pos, raw, lam)."""
    lines = _lines(spark, path).select("line", F.trim("value").alias("raw")).filter(F.col("raw") != "")
    g = with_row_index(lines, ["line"], "pos")
    return g.select(F.col("pos").cast("int").alias("pos"), "raw", F.col("raw").cast("double").alias("lam"))


def read_vector(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S7 + V6: one number per line -> (pos, value) and violations (line, detail)."""
    lines = _lines(spark, path)
    toks = F.split(F.trim("value"), r"\s+")
    parsed = lines.select("line", "value", F.size(toks).alias("ntok"),
                          F.expr("try_cast(trim(value) AS DOUBLE)").alias("num"))
    viol = parsed.filter((F.col("ntok") != 1) | F.col("num").isNull() | F.isnan("num") |
                         (F.abs("num") == float("inf"))).select(
        F.lit("one_value_per_line").alias("rule"), F.col("line").cast("string").alias("key"),
        F.col("value").alias("detail"))
    return parsed.select(F.col("line").alias("pos"), F.col("num").alias("value")), viol


def read_cv_table(spark: SparkSession, path: str) -> DataFrame:
    """``raw,err`` lines -> (pos, raw, lam, err)."""
    lines = _lines(spark, path)
    parts = F.split("value", ",")
    return lines.select(F.col("line").alias("pos"), F.trim(parts[0]).alias("raw"),
                        F.expr("try_cast(trim(split(value, ',')[0]) AS DOUBLE)").alias("lam"),
                        F.expr("try_cast(trim(split(value, ',')[1]) AS DOUBLE)").alias("err"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Stored feature table (key, features)."""
    return spark.read.parquet(path)


# ---------------------------------------------------------------- sinks
def format_values(df: DataFrame, col: str, decimals: int = 10) -> DataFrame:
    return df.select(F.format_string(f"%.{decimals}f", F.col(col)).alias("value"))


def write_predictions(df: DataFrame, key, col: str, path: str, decimals: int = 10) -> None:
    """K1: one value per line in key order (ordered part files)."""
    keys = [key] if isinstance(key, str) else list(key)
    (df.orderBy(*keys).select(F.format_string(f"%.{decimals}f", F.col(col)).alias("value"))
       .write.mode("overwrite").text(path))


def write_weights(spark: SparkSession, model, path: str) -> None:
    """K2: intercept first, then the coefficients, 10 decimals."""
    w = spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.weights())], "pos int, w double")
    w.orderBy("pos").select(F.format_string("%.10f", "w").alias("value")).coalesce(1) \
        .write.mode("overwrite").text(path)


def write_best(spark: SparkSession, raw: str, path: str) -> None:
    """K3: the best lambda as its raw text."""
    spark.createDataFrame([(raw,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_cv_table(cv: DataFrame, path: str) -> None:
    """K4: ``raw,err`` with 6 decimals in grid order (cv columns pos, raw, err)."""
    cv.orderBy("pos").select(F.concat(F.col("raw"), F.lit(","), F.format_string("%.6f", "err")).alias("value")) \
        .coalesce(1).write.mode("overwrite").text(path)


def write_features(df: DataFrame, path: str, key=("window_id",), col: str = "features") -> None:
    """K5: the transformed feature table as Parquet (key, features)."""
    df.select(*key, col).write.mode("overwrite").parquet(path)


def drop_label(df: DataFrame, label: str) -> DataFrame:
    """K7: a copy without the label column for blind scoring."""
    return df.drop(label)


# ---------------------------------------------------------------- K6 model state
MODEL_FORMAT = 1


def save_model(spark: SparkSession, state: dict, path: str) -> None:
    """K6: model state as Parquet rows (stage, name, values) + a JSON metadata row.

    ``state``: {"protocol": str, "intercept": float, "coef": array, "feature_names":
    [...], "stages": [(stage name, {name: array})]}.  No pickle."""
    rows = [("model", "coef", [float(v) for v in state["coef"]]),
            ("model", "intercept", [float(state["intercept"])])]
    for si, (stage, arrays) in enumerate(state.get("stages", [])):
        for name, arr in arrays.items():
            rows.append((f"{si:02d}:{stage}", name, [float(v) for v in np.asarray(arr).ravel()]))
    meta = {"format_version": MODEL_FORMAT, "protocol": state["protocol"],
            "feature_names": list(state.get("feature_names", [])),
            "stage_order": [s for s, _ in state.get("stages", [])], "extra": state.get("extra", {})}
    rows.append(("meta", "json", []))
    df = spark.createDataFrame(rows, "stage string, name string, vals array<double>") \
        .withColumn("meta", F.when(F.col("stage") == "meta", F.lit(json.dumps(meta))))
    df.coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str, protocol: str | None = None) -> dict:
    """K6: read a model table back; refuses another protocol or format."""
    rows = spark.read.parquet(path).collect()
    meta = json.loads(next(r["meta"] for r in rows if r["stage"] == "meta"))
    if meta.get("format_version") != MODEL_FORMAT:
        raise ValueError(f"unsupported model format {meta.get('format_version')}")
    if protocol is not None and meta["protocol"] != protocol:
        raise ValueError(f"the stored model belongs to protocol {meta['protocol']}, not {protocol}")
    stages = {}
    for r in rows:
        if r["stage"] not in ("meta", "model"):
            stages.setdefault(r["stage"], {})[r["name"]] = np.asarray(r["vals"])
    model = {r["name"]: np.asarray(r["vals"]) for r in rows if r["stage"] == "model"}
    return {"protocol": meta["protocol"], "intercept": float(model["intercept"][0]), "coef": model["coef"],
            "feature_names": meta["feature_names"], "extra": meta.get("extra", {}),
            "stages": [(k.split(":", 1)[1], stages[k]) for k in sorted(stages)]}

"""Queries for sources and sinks (S1, S5-S8, K1-K7), checks (V1-V13),
projections / splits (P1-P12), alignment and reports (J1, O1, O3).

Files are written from the driver tables into the shared scratch folder
(under ``spark.checkpoint.dir``) and read back, so every round trip works on
data Spark derives from the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pulsegrid.functions import arrays as A
from pulsegrid.operators import checks as C
from pulsegrid.operators import folds as FO
from pulsegrid.operators.linear import fit_ols, predict, ridge_cv
from pulsegrid.operators.metrics import align, report, top_features
from pulsegrid.operators.prep import slice_expr
from pulsegrid.operators.windows import with_row_index
from pulsegrid.plans.output import sql_round as R
from pulsegrid.plans.q_models import EVREG_SQL, GRID_RAW, LI_SQL, _weights_sql, ev_reg, range_case, range_ends
from pulsegrid.plans.q_stats import EV
from pulsegrid.plans.registry import register
from pulsegrid.plans.sqlsolve import ridge_solution, scatter_select
from pulsegrid.session import scratch_path
from pulsegrid.sources import files as IO
from pulsegrid.sources.tables import LI_FEATURES, ev_windows, li_reg, table

SPLIT_FRACTION = 0.2     # share of windows / subjects / blocks that go to test
SAMPLE_N = 100


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _hash_sql(key, seed=42):
    return f"('0x' || substr(md5(concat('{seed}:', ({key})::VARCHAR)), 1, 8))::BIGINT"


def _wide(spark, sf_dir):
    w = ev_windows(spark, sf_dir).filter(F.col("y").isNotNull())
    return w.select("window_id", *[F.col("x")[i].alias(f"v_{i}") for i in range(16)], F.col("y").alias("hr"))


# ---------------------------------------------------------------- sources / sinks
@register("wide_csv_roundtrip", EVREG_SQL + f"""SELECT window_id, 16::BIGINT AS width, {R('x0')} AS mean FROM d""")
def q_wide_csv(spark, sf_dir):
    """S1 + P1 + P2 + K7: windows written as a wide CSV (label dropped for the
    scoring copy), read back with an explicit schema, channels packed by prefix."""
    path = _scratch(spark, "wide")
    IO.drop_label(_wide(spark, sf_dir), "hr").write.option("header", True).csv(path)
    df = IO.read_wide_csv(spark, path)
    cols = IO.feature_columns(df, "hr", exclude=("window_id",))
    packed = IO.pack_channels(df.select("window_id", *cols), ["v_"], keep=["window_id"])
    return packed.select(F.col("window_id").cast("long").alias("window_id"), F.size("v").cast("long").alias("width"),
                         A.arr_mean("v").alias("mean"))


@register("predictions_text", EV + f"""SELECT row_number() OVER (ORDER BY window_id) - 1 AS pos,
  {R("round(avg(v), 10)")} AS value FROM ev GROUP BY window_id""")
def q_pred_text(spark, sf_dir):
    """K1 + S7: values written one per line with 10 decimals in key order, read back."""
    path = _scratch(spark, "pred")
    w = ev_windows(spark, sf_dir).select("window_id", A.arr_mean("x").alias("p"))
    IO.write_predictions(w, "window_id", "p", path)
    vec, _ = IO.read_vector(spark, path)
    return vec


@register("weights_text", _weights_sql(LI_SQL, 3).replace(" AS weight", " AS value").replace("0 AS pos", "0::BIGINT AS pos"))
def q_weights_text(spark, sf_dir):
    """K2 + S7: least-squares weights (intercept first) written and read back."""
    path = _scratch(spark, "weights")
    IO.write_weights(spark, fit_ols(li_reg(spark, sf_dir), "features", "y"), path)
    vec, _ = IO.read_vector(spark, path)
    return vec


def _cv_files(spark, sf_dir):
    gpath = _scratch(spark, "grid")
    spark.createDataFrame([(r,) for r in GRID_RAW[:2]] + [("",)] + [(r,) for r in GRID_RAW[2:]],
                          "value string").coalesce(1).write.text(gpath)
    grid = IO.read_grid(spark, gpath)
    g = [(r["raw"], r["lam"]) for r in grid.orderBy("pos").collect()]
    rows, means, best, model = ridge_cv(ev_reg(spark, sf_dir), "features", "y", "fold", g)
    cv = spark.createDataFrame([(i, g[i][0], float(e)) for i, e in enumerate(means)], "pos int, raw string, err double")
    cpath, bpath = _scratch(spark, "cv"), _scratch(spark, "best")
    IO.write_cv_table(cv, cpath)
    IO.write_best(spark, best[0], bpath)
    return grid, IO.read_cv_table(spark, cpath), spark.read.text(bpath), best


def _cv_sql(tail):
    from pulsegrid.plans.q_models import _cv_sql as base
    return base(tail)


@register("cv_table_text", _cv_sql(f"SELECT (pos)::BIGINT AS pos, raw, {R('round(err, 6)')} AS err FROM cv"))
def q_cv_text(spark, sf_dir):
    """S6 + K4 + S7: grid read from text (blank line skipped, raw kept), CV table
    written as ``raw,err`` with 6 decimals and read back."""
    _, cv, _, _ = _cv_files(spark, sf_dir)
    return cv.select("pos", "raw", "err")


@register("best_lambda_text", _cv_sql("SELECT arg_min(raw, (err, pos)) AS value FROM cv"))
def q_best_text(spark, sf_dir):
    """K3: the best lambda file holds the raw candidate text."""
    _, _, best, _ = _cv_files(spark, sf_dir)
    return best


@register("check_cv", _cv_sql("""SELECT 'lambda_nonnegative' AS rule, '1' AS key, '-1' AS detail
UNION ALL SELECT 'candidate_order', '1', '-1'
UNION ALL SELECT 'best_is_argmin', arg_max(raw, (round(err, 6), pos)), arg_min(raw, (round(err, 6), pos)) FROM cv
UNION ALL SELECT 'best_is_argmin', '7', arg_min(raw, (round(err, 6), pos)) FROM cv
UNION ALL SELECT 'best_is_candidate', '7', 'not listed'"""))
def q_check_cv(spark, sf_dir):
    """V7 + V10: clean files give nothing; a negative candidate, a table that reports
    another one, a best that is not the argmin and one that is no candidate are told."""
    grid, cv, _, best = _cv_files(spark, sf_dir)
    wrong = grid.withColumns({"raw": F.when(F.col("pos") == 1, "-1").otherwise(F.col("raw")),
                              "lam": F.when(F.col("pos") == 1, -1.0).otherwise(F.col("lam"))})
    worst = cv.agg(F.max_by("raw", F.struct("err", "pos"))).first()[0]
    found = [C.check_grid(grid), C.check_cv(cv, grid, best[0]), C.check_grid(wrong),
             C.check_cv(cv, wrong, best[0]), C.check_cv(cv, grid, worst), C.check_cv(cv, grid, "7")]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


@register("folds_file_ranges", f"""WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx,
                                                       count(*) OVER () AS n FROM events)
SELECT {range_case()} AS fold, count(*) AS n FROM r GROUP BY 1""")
def q_folds_file(spark, sf_dir):
    """S5 form 1 + J2: ``[e1, ...]`` cumulative ends over the event index."""
    path = _scratch(spark, "folds1")
    ev = with_row_index(table(spark, sf_dir, "events").select("event_id"), ["event_id"])
    spark.createDataFrame([("[" + ", ".join(str(e) for e in range_ends(ev.count())) + "]",)], "value string") \
        .coalesce(1).write.text(path)
    f = IO.read_folds(spark, path, ev)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("folds_many_ranges", """WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events)
SELECT event_id, CASE WHEN idx < (SELECT max(e) FROM (SELECT 3 * (idx // 3) + 3 AS e FROM r WHERE 3 * (idx // 3) + 3 <= (SELECT count(*) FROM r)) t)
                      THEN idx // 3 END AS fold FROM r""")
def q_folds_many(spark, sf_dir):
    """S5 form 1 + J2 with an end every three rows: as many ranges as a third of the table has rows."""
    path = _scratch(spark, "folds3")
    ev = with_row_index(table(spark, sf_dir, "events").select("event_id"), ["event_id"])
    ends = ev.filter((F.col("row_index") + 1) % 3 == 0).select((F.col("row_index") + 1).alias("e"))
    (ends.agg(F.array_sort(F.collect_list("e")).alias("l"))            # the format keeps all ends on one line
         .select(F.concat(F.lit("["), F.array_join(F.col("l").cast("array<string>"), ", "), F.lit("]")).alias("value"))
         .coalesce(1).write.text(path))
    return IO.read_folds(spark, path, ev).select("event_id", "fold")


@register("folds_file_ids", f"""SELECT event_id, ({_hash_sql('event_id')} % 5)::BIGINT AS fold FROM events""")
def q_folds_ids(spark, sf_dir):
    """S5 form 2: one fold id per row (comma and blank separated lines), matched on the row index."""
    path = _scratch(spark, "folds2")
    ev = with_row_index(table(spark, sf_dir, "events").select("event_id"), ["event_id"])
    ids = ev.withColumn("fold", FO.fold_expr("event_id", 5))
    # ten ids per line, commas inside a line
    lines = (ids.groupBy(F.floor(F.col("row_index") / 10).alias("ln"))
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "fold"))),
                                              lambda s: s["fold"].cast("string")), ", ").alias("value")))
    # several part files of unequal size: splits are not read in file order
    doubling = F.floor(F.log2(F.col("ln") + 1))
    lines.repartitionByRange(5, doubling).sortWithinPartitions("ln").select("value").write.text(path)
    f = IO.read_folds(spark, path, ev)
    return f.select("event_id", "fold")


@register("features_parquet", EV + """SELECT count(DISTINCT window_id) AS n_rows, 0::BIGINT AS width_violations,
  count(DISTINCT window_id) FILTER (WHERE isnan(vn)) AS finite_violations FROM ev""")
def q_features_parquet(spark, sf_dir):
    """K5 + S8 + V1 + V4: a feature table written as Parquet, read back and checked."""
    path = _scratch(spark, "features")
    IO.write_features(ev_windows(spark, sf_dir), path, col="x_nan")
    f = IO.read_features(spark, path)
    return spark.createDataFrame([(f.count(), C.check_width(f, "x_nan", 16).count(),
                                   C.check_finite(f, ["x_nan"], "window_id").count())],
                                 "n_rows long, width_violations long, finite_violations long")


@register("model_roundtrip", _weights_sql(LI_SQL, 3, "10.0"))
def q_model(spark, sf_dir):
    """K6: a fitted model saved as Parquet rows + metadata, loaded back (protocol checked)."""
    from pulsegrid.operators.linear import fit_ridge
    m = fit_ridge(li_reg(spark, sf_dir), "features", "y", 10.0)
    path = _scratch(spark, "model")
    IO.save_model(spark, {"protocol": "ridge", "intercept": m.intercept, "coef": m.coef,
                          "feature_names": list(LI_FEATURES)}, path)
    st = IO.load_model(spark, path, protocol="ridge")
    w = [st["intercept"]] + list(st["coef"])
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "pos int, weight double")


# ---------------------------------------------------------------- checks
@register("check_finite", EV + """SELECT 'finite' AS rule, window_id::VARCHAR AS key,
  'x_nan:' || count(*) FILTER (WHERE isnan(vn))::VARCHAR AS detail FROM ev GROUP BY window_id
  HAVING count(*) FILTER (WHERE isnan(vn)) > 0""")
def q_check_finite(spark, sf_dir):
    """Windows with NaN samples."""
    return C.check_finite(ev_windows(spark, sf_dir), ["x_nan"], "window_id")


@register("check_values", """WITH b AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount = 0),
n AS (SELECT min((l_orderkey, l_linenumber)) AS f, count(*) AS c FROM b)
SELECT unnest(['finite:poly', 'finite:prediction']) AS rule, f[1]::VARCHAR || ':' || f[2]::VARCHAR AS key,
       unnest([c || ' rows, ' || 4 * c || ' values', c || ' rows, ' || c || ' values']) AS detail FROM n WHERE c > 0""")
def q_check_values(spark, sf_dir):
    """Infinite ratios (price by discount) in the degree-2 table and in predictions from it, counted
    while both are written; four of nine terms hold the ratio."""
    from pulsegrid.operators.prep import PolynomialExpansion
    keys = ["l_orderkey", "l_linenumber"]
    li = table(spark, sf_dir, "lineitem").select(*keys, F.array(
        F.col("l_quantity").cast("double"),
        F.when(F.col("l_discount") == 0, float("inf")).otherwise(F.try_divide(F.lit(1.0), F.col("l_discount").cast("double"))),
        F.col("l_tax").cast("double") + 1.0).alias("x"))
    poly = PolynomialExpansion("x", "poly", width=3).transform(li)
    watches = [C.ValueWatch("poly", "poly", keys), C.ValueWatch("prediction", "p", keys)]
    path = _scratch(spark, "watched")
    watches[0].on(poly.select(*keys, "poly")).write.parquet(path)
    pred = spark.read.parquet(path).select(*keys, F.aggregate("poly", F.lit(0.0), lambda a, v: a + v).alias("p"))
    watches[1].on(pred).write.parquet(_scratch(spark, "watched-p"))
    return watches[0].violations(spark).unionByName(watches[1].violations(spark))


@register("check_rows", EV.replace("ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),",
                                   "ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),\n"
                                   "nxt AS (SELECT user_id * 4294967296 + blk - 1 AS window_id, v AS y FROM c WHERE i = 0 AND blk > 0),")
          + """SELECT DISTINCT 'same_rows' AS rule, window_id::VARCHAR AS key, 'left only' AS detail FROM ev
WHERE window_id NOT IN (SELECT window_id FROM nxt)""")
def q_check_rows(spark, sf_dir):
    """V5: windows without a label row (full outer join on the key)."""
    w = ev_windows(spark, sf_dir)
    return C.check_rows(w.select("window_id"), w.filter(F.col("y").isNotNull()).select("window_id"), "window_id")


@register("check_folds", EVREG_SQL + f"""SELECT 'fold_range' AS rule, window_id::VARCHAR AS key,
  ({_hash_sql('window_id')} % 5)::VARCHAR AS detail FROM d WHERE {_hash_sql('window_id')} % 5 >= 3""")
def q_check_folds(spark, sf_dir):
    """V8: fold ids outside 0..k-1 (5 hashed folds checked against k = 3)."""
    d = ev_reg(spark, sf_dir).withColumn("f5", FO.fold_expr("window_id", 5))
    return C.check_folds(d, "f5", 3, "window_id")


@register("check_label_spread", """SELECT 'label_spread' AS rule, l_orderkey::VARCHAR AS key, min(l_tax)::VARCHAR AS detail
FROM lineitem GROUP BY l_orderkey HAVING min(l_tax) = max(l_tax)""")
def q_check_spread(spark, sf_dir):
    """Groups (orders) whose label (tax) is constant."""
    return C.check_label_spread(table(spark, sf_dir, "lineitem"), "l_tax", ["l_orderkey"])


@register("check_numeric", """SELECT 'numeric' AS rule, event_id::VARCHAR AS key, 'props=' || props AS detail
FROM events WHERE props IS NOT NULL AND try_cast(props AS DOUBLE) IS NULL""")
def q_check_numeric(spark, sf_dir):
    """V3: text values that are not numbers."""
    return C.check_numeric(table(spark, sf_dir, "events"), ["props"], "event_id")


@register("check_lines", """SELECT 'one_value_per_line' AS rule, (row_number() OVER (ORDER BY event_id) - 1)::VARCHAR AS key,
  event_type, value, event_id FROM events""".replace(
    "event_type, value, event_id FROM events",
    "CASE WHEN event_type = 'error' THEN printf('%.2f %.2f', value, value) ELSE printf('%.2f', value) END AS detail "
    "FROM events QUALIFY event_type = 'error'"))
def q_check_lines(spark, sf_dir):
    """V6: lines that do not hold exactly one number (error events carry two)."""
    path = _scratch(spark, "lines")
    ev = table(spark, sf_dir, "events")
    txt = ev.select("event_id", F.when(F.col("event_type") == "error",
                                       F.format_string("%.2f %.2f", "value", "value"))
                    .otherwise(F.format_string("%.2f", "value")).alias("value"))
    txt.orderBy("event_id").select("value").write.text(path)
    return C.check_lines(IO._lines(spark, path))


@register("check_width", EV + """SELECT DISTINCT 'width' AS rule, window_id::VARCHAR AS key, '16' AS detail FROM ev""")
def q_check_width(spark, sf_dir):
    """V1: arrays whose width differs from the expectation (16 samples checked against 15)."""
    return C.check_width(ev_windows(spark, sf_dir), "x", 15)


@register("check_schema", EVREG_SQL + """SELECT 'same_order' AS rule, '1' AS key, 'v_0 / v_1' AS detail, count(*) AS rows
  FROM d""")
def q_check_schema(spark, sf_dir):
    """V2: stored training and scoring copies must list the same features in the same order;
    violations come with the rows of the scoring copy they concern."""
    w = _wide(spark, sf_dir)
    train, test = _scratch(spark, "schema-train"), _scratch(spark, "schema-test")
    w.write.parquet(train)
    w.select("window_id", "v_1", "v_0", *[f"v_{i}" for i in range(2, 16)]).write.parquet(test)
    stored = spark.read.parquet(test)
    found = C.check_schema(spark, spark.read.parquet(train).columns, stored.columns, "hr", expected=17)
    return found.withColumn("rows", F.lit(stored.count()))


def _check_consistent_sql():
    w, b = ridge_solution(2)
    return EVREG_SQL + f""", so AS (SELECT {scatter_select(['x0', 'x1'], 'y')} FROM d),
co AS (SELECT {b} AS b, {w[0]} AS w0, {w[1]} AS w1 FROM so),
p AS (SELECT window_id, b + w0 * x0 + w1 * x1 AS ref FROM d, co),
q AS (SELECT *, CASE window_id % 5 WHEN 0 THEN ref * 1.001 + 1 WHEN 1 THEN ref * (1 + 1e-8) ELSE ref END AS p FROM p)
SELECT 'consistent' AS rule, window_id::VARCHAR AS key FROM q WHERE abs(p - ref) > 1e-6 + 1e-5 * abs(ref)"""


@register("check_consistent", _check_consistent_sql())
def q_check_consistent(spark, sf_dir):
    """V9: predictions reproduce intercept + X.w within rtol 1e-5, atol 1e-6; a fifth
    of the stored predictions is off by more, another fifth by less."""
    d = ev_reg(spark, sf_dir)
    m = fit_ols(d, "features", "y")
    p, turn = F.col("prediction"), F.col("window_id") % 5
    stored = predict(d, m, "features").withColumn(
        "prediction", F.when(turn == 0, p * 1.001 + 1).when(turn == 1, p * (1 + 1e-8)).otherwise(p))
    return C.check_consistent(stored, d, m, "window_id", "features").select("rule", "key")


def _subject_split(spark, sf_dir):
    w = ev_reg(spark, sf_dir)
    subj = w.select("subject").distinct().filter(FO.hash_unit("subject", 42) / F.lit(float(1 << 32)) < SPLIT_FRACTION)
    return w, FO.split_subjects(w, "subject", subj)


_SUBJ_SQL = EVREG_SQL.replace("SELECT window_id, avg(v) AS x0", "SELECT window_id, any_value(window_id // 4294967296) AS subject, avg(v) AS x0") + \
    f""", ts AS (SELECT DISTINCT subject FROM d WHERE {_hash_sql('subject')} / 4294967296.0 < {SPLIT_FRACTION})
"""


@register("check_disjoint", _SUBJ_SQL + """SELECT 'disjoint_rows' AS rule, window_id::VARCHAR AS key, 'both' AS detail
FROM d WHERE subject IN (SELECT subject FROM ts)
UNION ALL SELECT 'disjoint_subjects', subject::VARCHAR, 'both' FROM ts""")
def q_check_disjoint(spark, sf_dir):
    """Overlap between the whole table and the held-out subjects (rows and subjects)."""
    w, (train, test) = _subject_split(spark, sf_dir)
    ok = C.check_disjoint(train, test, "window_id", "subject")        # a real split: empty
    return ok.unionByName(C.check_disjoint(w, test, "window_id", "subject"))


# ---------------------------------------------------------------- splits / projections
@register("split_subjects", _SUBJ_SQL + """SELECT window_id, CASE WHEN subject IN (SELECT subject FROM ts)
  THEN 'test' ELSE 'train' END AS side FROM d""")
def q_split_subjects(spark, sf_dir):
    """P10: cross-subject split by a hashed subject list (anti / semi join)."""
    _, (train, test) = _subject_split(spark, sf_dir)
    return train.select("window_id", F.lit("train").alias("side")).unionByName(
        test.select("window_id", F.lit("test").alias("side")))


@register("split_random", EVREG_SQL + f"""SELECT window_id, CASE WHEN {_hash_sql('window_id')} / 4294967296.0 < {SPLIT_FRACTION}
  THEN 'test' ELSE 'train' END AS split FROM d""")
def q_split_random(spark, sf_dir):
    """Seeded random split of windows."""
    return FO.split_random(ev_reg(spark, sf_dir), "window_id", SPLIT_FRACTION).select("window_id", "split")


@register("split_temporal", EVREG_SQL.replace("SELECT window_id, avg(v) AS x0", "SELECT window_id, any_value(window_id // 4294967296) AS subject, any_value(window_id % 4294967296) AS blk, avg(v) AS x0")
          + f""", mb AS (SELECT subject, max(blk) AS mx FROM d GROUP BY subject)
SELECT window_id, CASE WHEN blk < floor((mx + 1) * {1 - SPLIT_FRACTION}) THEN 'train' ELSE 'test' END AS split
FROM d JOIN mb USING (subject)""")
def q_split_temporal(spark, sf_dir):
    """Per subject the earlier blocks train, the last share tests."""
    return FO.split_temporal_blocks(ev_reg(spark, sf_dir), "subject", "blk", SPLIT_FRACTION).select("window_id", "split")


@register("sample_n", EVREG_SQL + f"""SELECT window_id FROM d ORDER BY md5(concat('42:', window_id::VARCHAR)), window_id
LIMIT {SAMPLE_N}""")
def q_sample(spark, sf_dir):
    """Exactly N windows chosen by the seeded hash (take-ordered)."""
    return FO.sample_n(ev_reg(spark, sf_dir), SAMPLE_N, "window_id").select("window_id")


@register("fold_filter", EVREG_SQL + """SELECT window_id, fold::BIGINT AS fold FROM d WHERE fold <> 1""")
def q_fold_filter(spark, sf_dir):
    """Training rows of fold 1 (every other fold)."""
    return FO.train_rows(ev_reg(spark, sf_dir), "fold", 1).select("window_id", "fold")


@register("union_tables", EVREG_SQL + """SELECT fold::BIGINT AS fold, count(*) AS n FROM d GROUP BY fold""")
def q_union(spark, sf_dir):
    """Per-fold tables concatenated by name (union of row sets)."""
    d = ev_reg(spark, sf_dir)
    parts = [FO.validation_rows(d, "fold", k) for k in range(3)]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("concat_features", EV + f"""SELECT window_id, pos::BIGINT AS pos, {R('value')} AS value FROM (
  SELECT window_id, unnest([avg(v), stddev_pop(v), min(v), max(v)]) AS value, unnest(range(4)) AS pos
  FROM ev GROUP BY window_id) t""")
def q_concat(spark, sf_dir):
    """Feature arrays concatenated column-wise."""
    w = ev_windows(spark, sf_dir)
    f = F.concat(F.array(A.arr_mean("x"), A.arr_std("x")), F.array(A.arr_min("x"), A.arr_max("x")))
    return w.select("window_id", F.posexplode(f).alias("pos", "value"))


@register("keep_positions", EV + f"""SELECT window_id, (i // 2)::BIGINT AS pos, {R('v')} AS value FROM ev WHERE i IN (1, 3, 5)""")
def q_keep(spark, sf_dir):
    """P5: keep positions 1, 3, 5 (sorted index list)."""
    w = ev_windows(spark, sf_dir)
    return w.select("window_id", F.posexplode(slice_expr("x", [1, 3, 5])).alias("pos", "value"))


@register("prepend_intercept", EV + f"""SELECT window_id, 0::BIGINT AS pos, 1.0::DOUBLE AS value FROM ev WHERE i = 0
UNION ALL SELECT window_id, (i + 1)::BIGINT, {R('v::FLOAT')} FROM ev""")
def q_prepend(spark, sf_dir):
    """P3 + P4: [1, x] after a cast to float32 (values as stored at rest)."""
    w = ev_windows(spark, sf_dir).select("window_id", F.col("x").cast("array<float>").alias("xf"))
    return w.select("window_id", F.posexplode(IO.prepend_intercept("xf")).alias("pos", "value"))


# ---------------------------------------------------------------- alignment / reports
@register("align_scores", EV.replace("ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),",
                                     "ev AS (SELECT user_id * 4294967296 + blk AS window_id, i, v, vn FROM c WHERE cnt = 16),\n"
                                     "nxt AS (SELECT user_id * 4294967296 + blk - 1 AS window_id, v AS y FROM c WHERE i = 0 AND blk > 0),")
          + f"""SELECT window_id, {R('avg(v)')} AS prediction, {R('any_value(y)')} AS y
FROM ev JOIN nxt USING (window_id) GROUP BY window_id""")
def q_align(spark, sf_dir):
    """Predictions and labels matched by key (inner equi-join)."""
    w = ev_windows(spark, sf_dir)
    p = w.select("window_id", A.arr_mean("x").alias("prediction"))
    lab = w.filter(F.col("y").isNotNull()).select("window_id", "y")
    return align(p, lab, "window_id")


def _li_weights_sql():
    w, b = ridge_solution(3)
    return LI_SQL + f""", s AS (SELECT {scatter_select(['x0', 'x1', 'x2'], 'y')} FROM d),
c AS (SELECT {b} AS b, {w[0]} AS w0, {w[1]} AS w1, {w[2]} AS w2 FROM s)
"""


@register("top_features", _li_weights_sql() + f""", t AS (SELECT * FROM (VALUES (0, 'l_quantity'), (1, 'l_discount'), (2, 'l_tax')) v(pos, name)),
cw AS (SELECT t.pos, t.name, CASE t.pos WHEN 0 THEN w0 WHEN 1 THEN w1 ELSE w2 END AS coef FROM t, c)
SELECT (row_number() OVER (ORDER BY abs(coef) DESC, pos) - 1)::BIGINT AS rank, pos::BIGINT AS pos, name, {R('coef')} AS coef
FROM cw QUALIFY rank < 2""")
def q_top(spark, sf_dir):
    """O1: the 2 largest |coef| of the least-squares model (ties: lower index)."""
    m = fit_ols(li_reg(spark, sf_dir), "features", "y", LI_FEATURES)
    return top_features(spark, m, 2)


@register("report", _li_weights_sql() + """, p AS (SELECT y, b + w0 * x0 + w1 * x1 + w2 * x2 AS p FROM d, c),
yb AS (SELECT avg(y) AS ym FROM d),
m AS (SELECT count(*)::DOUBLE AS n, sum(power(y - p, 2)) / sum(power(y - ym, 2)) AS nmse,
             sum(abs(y - p)) / sum(abs(y - ym)) AS nmae, avg(abs(y - p)) AS mae FROM p, yb)
SELECT metric, """ + R("value") + """ AS value FROM m UNPIVOT (value FOR metric IN (n, nmse, nmae, mae))""")
def q_report(spark, sf_dir):
    """O3: metric report (n, NMSE, NMAE, MAE) of the least-squares predictions."""
    d = li_reg(spark, sf_dir)
    return report(predict(d, fit_ols(d, "features", "y"), "features"), "y", "prediction")

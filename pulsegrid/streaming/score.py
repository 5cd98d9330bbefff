"""Scoring windows as they arrive, with Structured Streaming.

The reference scores a finished test set; on Spark the same fitted pipeline is
a set of column expressions (statistics as higher-order functions, the model
as intercept + x.w with literal weights), so it applies unchanged to a
streaming DataFrame.  Windows arrive as files of the window table (Parquet);
``score_stream`` adds predictions, ``metrics_sink`` keeps running error sums
per micro-batch in a table under the shared folder.  No state is kept beyond
Spark's own checkpoint, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.linear import LinearModel, predict_expr


def read_window_stream(spark: SparkSession, path: str, schema: T.StructType,
                       max_files_per_trigger: int = 64) -> DataFrame:
    """Window rows appended as Parquet files to ``path``."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def score_stream(stream: DataFrame, model: LinearModel, features, key: str = "window_id",
                 feature_exprs: dict | None = None) -> DataFrame:
    """Add ``prediction`` (and optional feature expressions) to a window stream."""
    if feature_exprs:
        stream = stream.withColumn("features", F.array(*[e for e in feature_exprs.values()]))
        features = "features"
    return stream.withColumn("prediction", predict_expr(model, features))


def write_scores(scored: DataFrame, out_path: str, checkpoint: str, key: str = "window_id",
                 trigger_once: bool = False):
    """Append (key, prediction) to Parquet; the checkpoint folder makes it restartable."""
    w = (scored.select(key, "prediction").writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()


def metrics_sink(scored: DataFrame, label: str, table_path: str, checkpoint: str, trigger_once: bool = False):
    """Per micro-batch error sums (n, Σ|e|, Σe², Σy, Σy²) appended to a table;
    NMSE / NMAE of everything seen so far follow from the running sums."""
    def each(batch: DataFrame, batch_id: int):
        e = F.col(label) - F.col("prediction")
        agg = batch.agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(e)).alias("sae"), F.sum(e * e).alias("sse"),
                        F.sum(label).alias("sy"), F.sum(F.col(label) * F.col(label)).alias("syy"))
        agg.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(table_path)
    w = scored.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()

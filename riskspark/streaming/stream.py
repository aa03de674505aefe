"""Structured Streaming forms of the daily monitoring loop (ST-01..06).

Every stream reads files with a declared schema, keeps state bounded by a
watermark, and writes through a checkpointed sink in the shared folder named
by ``spark.checkpoint.dir`` (so a restarted driver or lost executor resumes
from the last committed batch).  ``run_to_table`` drives a stream to the end
of its input with ``availableNow`` and returns the sink as a batch DataFrame —
the form used by the batch-twin checks.
"""

from __future__ import annotations

import sys
import uuid

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from riskspark.session import ensure_checkpoint_dir

# The state handler runs in Python workers that may not have this package on
# their path: ship this module's functions by value instead of by reference.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskspark-stream/{name}-{uuid.uuid4().hex[:12]}"


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None, glob: str | None = None) -> DataFrame:
    """Streaming file source over a directory (optionally only files matching ``glob``), with the
    schema taken once from the existing files; TIMESTAMP_NTZ columns become TIMESTAMP (session
    time zone UTC) because event-time operators need TIMESTAMP."""
    batch = spark.read.format(fmt)
    if glob:
        batch = batch.option("pathGlobFilter", glob)
    schema = batch.load(path).schema
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.load(path)
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name)
                       for f in schema.fields])


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of part files."""
    root = sf_dir.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return file_stream(spark, f"{root}/{name}.parquet", max_files=max_files)
    return file_stream(spark, root, max_files=max_files, glob=f"{name}.parquet")


def run_to_table(df: DataFrame, name: str, mode: str = "append", fmt: str = "parquet") -> DataFrame:
    """Run a streaming DataFrame to the end of its input into a checkpointed sink; return the sink."""
    spark = df.sparkSession
    base = scratch(spark, name)
    out, ckpt = f"{base}/out", f"{base}/_checkpoint"
    if mode == "append":
        q = df.writeStream.format(fmt).option("path", out).option("checkpointLocation", ckpt).outputMode("append") \
              .trigger(availableNow=True).start()
    else:
        # update / complete aggregates: each micro-batch rewrites the latest full result
        def write(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").format(fmt).save(out)
        q = df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.format(fmt).load(out)


def daily_aggregates(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """ST-01: tumbling 1-day windows per event type behind a watermark."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day").alias("w"), "event_type") \
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"))


def sliding_aggregates(events: DataFrame, length: str = "30 days", slide: str = "1 day", delay: str = "1 day") -> DataFrame:
    """ST-02: sliding windows (30 days every day) per event type."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", length, slide).alias("w"), "event_type") \
                 .agg(F.count(F.lit(1)).alias("n"))


def closed_rates(events: DataFrame, kinds: list[str], length: str, slide: str = "1 day", delay: str = "1 day") -> DataFrame:
    """ST-02: rates of event types in sliding windows, for append mode: a window is given out once, when the
    watermark has passed its end, and its state is freed then."""
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", length, slide).alias("w"))
    return w.agg(F.count(F.lit(1)).alias("n"), *[(F.count_if(F.col("event_type") == k) / F.count(F.lit(1))).alias(f"{k}_rate") for k in kinds])


def mark_late(df: DataFrame, ts: str, delay: str, name: str = "late") -> DataFrame:
    """ST-04: all rows of a stream with ``epoch`` and ``late``: whether the row came behind the watermark of the batches before its own.

    The latest time of each batch is one row of a side table, so a batch reads no
    earlier rows; a batch that is run again replaces itself."""
    spark = df.sparkSession
    base = scratch(spark, name)

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        kind = df.schema[ts].dataType.simpleString()
        seen = spark.read.schema(f"top {kind}, epoch long").parquet(f"{base}/top").where(F.col("epoch") < epoch) if epoch else spark.createDataFrame([], f"top {kind}, epoch long")
        mark = seen.agg((F.max("top") - F.expr(f"INTERVAL {delay}")).alias("mark")).scalar()
        batch.withColumn("late", F.coalesce(F.col(ts) < mark, F.lit(False))).write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")
        batch.agg(F.max(ts).alias("top")).write.mode("overwrite").parquet(f"{base}/top/epoch={epoch}")
        batch.unpersist()

    df.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField("late", T.BooleanType()), T.StructField("epoch", T.LongType())])) \
                .option("basePath", f"{base}/out").parquet(f"{base}/out")


def outcome_join(scores: DataFrame, outcomes: DataFrame, horizon_days: int = 120, delay: str = "30 days", how: str = "inner") -> DataFrame:
    """ST-04: delayed labels as a stream-stream join bounded in time; outcomes later
    than the watermark are dropped by the engine (``mark_late`` counts them), so ``delay``
    covers how late files come.  With ``how="leftOuter"`` a decision without an outcome is
    given out, with nulls, when the watermark has closed its horizon."""
    s = scores.withWatermark("score_ts", delay).alias("s")
    o = outcomes.withWatermark("outcome_ts", delay).alias("o")
    cond = (F.col("s.id") == F.col("o.oid")) & (F.col("o.outcome_ts") >= F.col("s.score_ts")) & \
           (F.col("o.outcome_ts") <= F.col("s.score_ts") + F.expr(f"INTERVAL {horizon_days} DAYS"))
    return s.join(o, cond, how)


RUN_SCHEMA = "feature string, batch_day int, psi double, consecutive long, action string"
RUN_STATE = "days array<int>, psis array<double>"


def _runs(key, pdfs, state):
    """ST-05 state handler: the feature's days so far, one number each.  Days may come in any order
    and number of batches: every day from the earliest new one on is given out (again)."""
    known = dict(zip(*state.get)) if state.exists else {}
    fresh = pd.concat(list(pdfs))
    known.update(zip(fresh["batch_day"].astype(int).tolist(), fresh["psi"].astype(float).tolist()))
    first, run, out = int(fresh["batch_day"].min()), 0, []
    for day in sorted(known):
        psi = known[day]
        run = run + 1 if psi > 0.1 else 0
        if day >= first:
            action = "RETIRE" if (run == 5 and psi > 0.3) else ("RETRAIN" if run == 2 else None)
            out.append((key[0], day, psi, run, action))
    state.update((list(known), list(known.values())))
    yield pd.DataFrame(out, columns=["feature", "batch_day", "psi", "consecutive", "action"])


def consecutive_alerts(psi_stream: DataFrame) -> DataFrame:
    """ST-05: consecutive-alert counter kept in state per feature (batch twin: WIN-10).

    An update stream: a day that comes late corrects the later days it changes
    (``run_updates`` keeps the last row of each feature and day)."""
    return psi_stream.groupBy("feature").applyInPandasWithState(_runs, RUN_SCHEMA, RUN_STATE, "update", GroupStateTimeout.NoTimeout)


def run_updates(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an update stream to the end of its input; the last row given out for each of ``keys``.

    Each micro-batch owns one folder, so a batch that is run again replaces itself."""
    out = run_epochs(df, name, lambda batch, epoch, log: batch, "update")
    last = F.max(F.struct("epoch", *[c for c in df.columns if c not in keys])).alias("_last")
    return out.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in df.columns if c not in keys])


def run_epochs(df: DataFrame, name: str, make, mode: str) -> DataFrame:
    """Run a stream whose batch ``n`` writes ``make(batch, n, log of earlier batches)`` to folder epoch=n; all of it."""
    spark, schema = df.sparkSession, df.schema
    logged = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    base = scratch(spark, name)

    def log(before: int | None = None) -> DataFrame:
        found = spark.read.schema(logged).option("basePath", f"{base}/out").parquet(f"{base}/out")
        return found if before is None else found.where(F.col("epoch") < before)

    def write(batch: DataFrame, epoch: int) -> None:
        empty = spark.createDataFrame([], logged)
        make(batch, epoch, log(epoch) if epoch else empty).write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")

    df.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/_checkpoint").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return log()


def dedupe_decisions(decisions: DataFrame, name: str = "decisions", key: str = "id") -> DataFrame:
    """ST-06: exactly-once decision log: a batch adds the ids that no earlier batch has.

    Exact whatever the order of arrival: an id is looked up in the log itself by an
    anti-join, and nothing is given up behind a watermark."""
    return run_epochs(decisions, name, lambda batch, epoch, log: batch.dropDuplicates([key]).join(log.select(key), key, "left_anti"), "append").drop("epoch")

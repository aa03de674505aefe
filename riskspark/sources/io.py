"""Scans and sinks (SRC-01..08, SNK-01..06).

Readers always pass an explicit schema where the format has no footer, so no
inference pass runs over the data.  Writers are plain DataFrameWriter calls;
results stay DataFrames and JSON reports are only an optional sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-04: Parquet scan of one driver table (filters and pruning reach the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """SRC-01/02: CSV scan with a declared schema; FAILFAST so contract breaks surface."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


CORRUPT = "_corrupt_record"


def read_csv_permissive(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """DQ-07 at the reader: every line becomes a row; a line that does not fit the schema keeps its
    text in ``_corrupt_record``.  Spark converts only the cells that are read; that column asks for
    all of them, so a line is judged whole whichever columns are taken beside it."""
    read = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"').option("columnPruning", False).csv(path)
    )
    every_cell = F.length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in schema.names])) >= 0
    return read.withColumn(CORRUPT, F.when(every_cell, F.col(CORRUPT)))


def line_fault(n_columns: int, line: str = CORRUPT) -> Column:
    """Why a line did not fit, from its text: ``open_quote``, ``short``, ``long`` or else ``mistyped``; null for a sound line."""
    bare = F.regexp_replace(F.col(line), '"([^"]|"")*"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    return F.when(F.col(line).isNull(), F.lit(None)).when(F.contains(bare, F.lit('"')), "open_quote") \
            .when(cells < n_columns, "short").when(cells > n_columns, "long").otherwise("mistyped")


def write_quarantined(df: DataFrame, reasons: Column, path: str, mode: str = "overwrite") -> None:
    """DQ-07: one pass that writes ``status=clean`` and ``status=quarantine`` below ``path``; a row with
    any of ``reasons`` (an array of names) is quarantined and carries them."""
    named = df.withColumn("reasons", F.coalesce(reasons, F.array().cast("array<string>")))
    named.withColumn("status", F.when(F.size("reasons") > 0, "quarantine").otherwise("clean")).write.mode(mode).partitionBy("status").parquet(path)


def strip_column_names(df: DataFrame) -> DataFrame:
    """SRC-03 remainder: trim header names after converting a sheet to CSV once."""
    return df.toDF(*[c.strip() for c in df.columns])


def read_daily_batches(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: a directory of ``batch_day=N`` partitions, pruned by day filters."""
    return spark.read.option("basePath", path).parquet(path)


def read_markdown_tree(spark: SparkSession, root: str) -> DataFrame:
    """SRC-06: one row per ``*.md`` file below ``root`` (whole text, file name)."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.md")
        .text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text"))
    )


def file_fingerprints(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SRC-07: SHA-256 of each file's bytes, computed on executors."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))
    )


def read_json_artifact(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08: multi-line JSON artefact (medians, feature order)."""
    return spark.read.option("multiLine", True).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """SNK-01 / SNK-05: Parquet intermediates, partitioned by day or split where given."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-02."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-03: one JSON object per result row."""
    df.write.mode(mode).json(path)


def append_audit_log(df: DataFrame, path: str) -> None:
    """SNK-06: append-only decision log, one JSON document per line."""
    df.write.mode("append").json(path)


def to_json_column(df: DataFrame, name: str = "json") -> DataFrame:
    """SNK-03 as a column: every row serialised as one JSON string."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def markdown_table(df: DataFrame) -> str:
    """SNK-04: format an already aggregated result as Markdown, every row of it.

    The rows come to the driver a partition at a time; the text is as long as the report.
    """
    cols = df.columns
    out = ["| " + " | ".join(cols) + " |", "|" + "---|" * len(cols)]
    for r in df.toLocalIterator():
        out.append("| " + " | ".join("" if r[c] is None else str(r[c]) for c in cols) + " |")
    return "\n".join(out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Convert NaN in floating columns to NULL at the scan (pandas NaN = missing)."""
    cols: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)

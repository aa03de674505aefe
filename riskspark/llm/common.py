"""Helpers the corpus operators share: shared-folder tables, groups of a sorted
stream, buckets cut into bounded cells, and connected components."""

from __future__ import annotations

import atexit
import os
import pathlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import riskspark
from riskspark.session import ensure_checkpoint_dir


_READY: set[str] = set()


def ready_workers(spark: SparkSession) -> None:
    """Makes sure, once per application, that Python workers can import this package; ships it if they can't."""
    app = spark.sparkContext.applicationId
    if app in _READY:
        return
    _READY.add(app)

    def found(batches):
        import importlib.util

        import pyarrow
        for _ in batches:
            yield pyarrow.RecordBatch.from_arrays([pyarrow.array([importlib.util.find_spec("riskspark") is not None])], names=["found"])

    if not spark.range(1).mapInArrow(found, "found boolean").first()[0]:
        root = pathlib.Path(riskspark.__file__).parent
        # Spark's file server reads it for as long as the application runs
        folder = os.path.realpath(tempfile.mkdtemp())
        atexit.register(shutil.rmtree, folder, True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/riskspark", "zip", root.parent, root.name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, *partition_by: str, compression: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back.

    Cuts the lineage at a copy every executor can reach, so a lost executor
    costs only its own tasks.  The folder goes when the application ends.
    ``partition_by`` columns become folders, which a filter on them selects;
    ``compression`` is that of the session if none is given.
    """
    spark = df.sparkSession
    ready_workers(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path, compression=compression)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def discard(table: DataFrame) -> None:
    """Deletes the files of a table that ``written`` made and nothing will read again."""
    spark = table.sparkSession
    files = table.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Sent:
    """A broadcast value of bounded size; ``built`` makes something from it once per Python worker."""

    def __init__(self, spark: SparkSession, value):
        ready_workers(spark)
        self.broadcast = spark.sparkContext.broadcast(value)
        self.number = self.broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value

    def built(self, make: Callable, *args):
        key = (self.number, make.__qualname__, args)
        if key not in _BUILT:
            # few at a time, so that a worker that served many queries holds no old ones
            while len(_BUILT) > 2:
                _BUILT.pop(next(iter(_BUILT)))
            _BUILT[key] = make(self.value, *args)
        return _BUILT[key]


_BUILT: dict[tuple, object] = {}


def held_out(doc_id: Column | str, mod: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % mod == remainder, F.lit(False))


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """One dict of column arrays per run of equal ``keys``; only the open run is held."""
    held: list[dict[str, np.ndarray]] = []
    last: tuple | None = None

    def joined() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}

    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        cols = {f: b.column(i).to_numpy(zero_copy_only=False) for i, f in enumerate(b.schema.names)}
        change = np.zeros(max(n - 1, 0), dtype=bool)
        for k in keys:
            change |= cols[k][1:] != cols[k][:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        if held and last != tuple(cols[k][0] for k in keys):
            yield joined()
            held = []
        for s, e in zip(cuts, cuts[1:]):
            held.append({c: v[s:e] for c, v in cols.items()})
            if e < n:
                yield joined()
                held = []
        last = tuple(cols[k][n - 1] for k in keys)
    if held:
        yield joined()


def bucket_cells(df: DataFrame, keys: list[str], ident: str, rows: int) -> DataFrame:
    """Cells of at most about ``2 * rows`` rows that hold every pair of every bucket once.

    A bucket (equal ``keys``) of n rows is dealt into ceil(n / rows) slices by a
    hash of ``ident``; cell (a, b), a <= b, gets slices a and b.  Columns added:
    ``_s`` (the row's slice), ``_a``, ``_b``.  Pairs inside one slice belong to
    cell (s, s) only; the other cells hold cross pairs.  Buckets of one row go.
    """
    size = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    slices = F.ceil(F.col("_n") / rows).cast("int")
    return (
        df.join(size, keys)
        .withColumn("_k", slices)
        .withColumn("_s", F.pmod(F.xxhash64(ident, F.lit(7)), F.col("_k")).cast("int"))
        .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("_a", F.least("_s", "_j"))
        .withColumn("_b", F.greatest("_s", "_j"))
        .drop("_n", "_k", "_j")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v longs): one row (node, root) per node.

    ``root`` is the smallest node reachable.  Alternates the large-star and
    small-star steps of Kiveris et al. (2014); each round is a few aggregations
    and joins over the remaining edges, checkpointed in the shared folder, and
    the loop ends when a round leaves the edge set as it was.  Degrees are
    never collected: a hub's neighbours stay separate rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.select("u", "v")
        if larger:
            both = both.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        j = both.join(low, "u")
        if larger:
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            # neighbours of u are all smaller here; u itself joins the smallest too
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def print_of(e: DataFrame) -> tuple:
        h = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(e.agg(F.count(F.lit(1)), F.sum(h)).first())

    cur = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    seen = print_of(cur)
    while seen[0]:
        # large star: every larger neighbour of u is linked to the smallest node u knows
        cur = star(star(cur, True), False).checkpoint()
        now = print_of(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).groupBy("node").agg(F.min("root").alias("root"))

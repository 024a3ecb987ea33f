"""Helpers that several operators share: tables, hold-outs, staging, ranks."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables through Spark, whatever store it lies in."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand Python this many rows at once, as a batch of whole texts must fit in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only a local-mode session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _own_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends in good order."""
    path = f"{shared_dir(spark)}/readloom-{name}-{uuid.uuid4().hex}"
    sc = spark.sparkContext

    def remove() -> None:
        if sc._jsc is not None:
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)

    atexit.register(remove)
    return path


def staged(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs one re-read, and what is used
    several times is computed once. ``most`` bounds the files, for callers that
    know how much there is: small tables are not to become as many files as a
    shuffle has partitions.
    """
    path = new_path(df.sparkSession, name)
    (df if most is None else df.coalesce(most)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null keys fall in fold of the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def bounded_sample(rows: DataFrame, key: str, limit: int, salt: str, *ties: str) -> DataFrame:
    """At most ``limit`` rows, the same ones in every run: those of least salted md5, then least ``ties``."""
    return rows.orderBy(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), key, *ties).limit(limit)


def slice_key(*cols: Column) -> Column:
    """One of 4096 three-digit slices that the columns decide (the start of their md5)."""
    text = F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.substring(F.md5(text), 1, 3)


def gapless_rank(df: DataFrame, groups: list[str], slice_by: Column, order: list[str], name: str) -> DataFrame:
    """Number the rows of every group from 0 without gaps, in column ``name`` (in place of one so named).

    A group is cut into 4096 slices: a slice's rows are numbered by one task and
    moved by the count of the slices before it, so a group with a third of all
    rows is spread over many tasks. Null group keys form a group. ``df`` must
    give the same rows each time it is read.
    """
    part, at, n, start = (fresh(df, x) for x in ("_slice", "_at", "_n", "_start"))
    keys = [*groups, part]
    other = [fresh(df, f"_r{i}") for i in range(len(keys))]
    cut = df.withColumn(part, slice_by)
    counts = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(start, F.coalesce(F.sum(n).over(before), F.lit(0))).select(*[F.col(k).alias(o) for k, o in zip(keys, other)], start)
    within = Window.partitionBy(*keys).orderBy(*order)
    ranked = cut.withColumn(at, F.row_number().over(within) - 1)
    same = F.lit(True)
    for k, o in zip(keys, other):
        same = same & F.col(k).eqNullSafe(F.col(o))
    joined = ranked.join(starts, same, "left").withColumn(start, (F.col(at) + F.col(start)).cast("long"))
    return joined.select(*[c for c in df.columns if c != name], F.col(start).alias(name))

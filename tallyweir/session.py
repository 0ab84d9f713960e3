"""Session-level helpers: table reading, lineage cuts, scratch folders and size-checked broadcasts."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many rows and bytes may be broadcast by small_side().
BROADCAST_ROWS, BROADCAST_BYTES = 20_000, 8_000_000
#: Bits of among(), broadcast 64 in a row.
MARKS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. RuntimeError where none is set; none is made up."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if at is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this session, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_made: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that later steps of a query read; deleted when the driver's process ends, or by clean()."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def clean() -> None:
    """Deletes all scratch tables made so far. Frames that read them can't be run again."""
    while _made:
        try:
            remove(*_made.pop())
        except Exception:  # the session or its JVM is gone already
            continue


def written(df: DataFrame, name: str, sort: list[str] | None = None, **options) -> DataFrame:
    """df as a parquet table in the shared folder, sorted within its files: columns and row groups can be left out when it is read."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    (df.sortWithinPartitions(*sort) if sort else df).write.options(**options).mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder: rows read twice are computed once and outlive executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Marks df for broadcast if it has at most ``rows`` rows and ``size`` bytes as JSON, measured first; else the join shuffles (AQE then splits skew). df should be cheap to read twice: a cut or a small table."""
    n, held = df.limit(rows + 1).agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return F.broadcast(df) if n <= rows and (held or 0) <= size else df


def among(df: DataFrame, on: list[str], keys: DataFrame) -> DataFrame:
    """Rows of df whose ``on`` may be among the keys (columns in that order and of those types): all whose ``on`` is, and of the others those whose hash falls on a key's.

    For a join that comes after: what has no partner needs no shuffle. At most MARKS bits are broadcast, however many keys there are.
    """
    place = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(MARKS))
    mark = F.expr("shiftleft(1L, cast(__bit & 63 as int))")
    marks = keys.select(place(keys.columns).alias("__bit")).groupBy(F.shiftright("__bit", 6).alias("__at")).agg(F.bit_or(mark).alias("__marks"))
    placed = df.withColumn("__bit", place(on)).withColumn("__at", F.shiftright("__bit", 6))
    return placed.join(F.broadcast(marks), "__at").where(F.col("__marks").bitwiseAND(mark) != 0).select(*df.columns)

"""Session helpers shared by all operators: tables, scratch storage, size-checked broadcasts."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast up to so many rows and so many bytes, both counted.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64_000_000

_OWN: dict[str, str] = {}
_WRITTEN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table of a data directory."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir.

    Where that is unset, a folder of our own serves on one machine (master local); on a cluster, whose
    executors could not read it, that is an error.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="veldspar-")
        atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
    return "file://" + _OWN["dir"]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; release() deletes it."""
    path = f"{scratch_root(spark)}/veldspar-{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Write df once into the shared folder and read it back.

    The lineage is cut by a table every executor can read again, so a lost executor costs a
    re-read and not the stages before it.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far and return their number; call it once results are saved."""
    n = len(_WRITTEN)
    for path in _WRITTEN:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _WRITTEN.clear()
    return n


def _bytes_of(kind: T.DataType, c: Column) -> Column:
    """About how many bytes a value holds: strings and binaries by length, arrays and structs by their parts."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        flat = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))
        size = F.size(c) * 8 if flat else F.aggregate(F.transform(c, lambda e: _bytes_of(kind.elementType, e)), F.lit(0), lambda a, e: a + e)
        return F.coalesce(size, F.lit(0)) + 24
    if isinstance(kind, T.StructType):
        return functools.reduce(lambda a, b: a + b, [_bytes_of(f.dataType, c[f.name]) for f in kind.fields], F.lit(16))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.size(c) * 64, F.lit(0)) + 24
    return F.lit(8)


def is_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether df has so many rows and bytes at most (BROADCAST_ROWS, BROADCAST_BYTES); no more than max_rows + 1 rows are looked at."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    size = functools.reduce(lambda a, b: a + b, [_bytes_of(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields], F.lit(0))
    n, b = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return n <= max_rows and b <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """df with a broadcast hint if it is small in rows and bytes, else df as it is.

    df must be cheap to read (a materialized or file-backed table).
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def ship_package(spark: SparkSession) -> None:
    """Give the executors the package's code, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_veldspar_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="veldspar-zip-")  # Spark serves the archive from the driver to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    out = os.path.join(folder, "veldspar.zip")
    with zipfile.ZipFile(out, "w") as z:
        for base, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.join("veldspar", os.path.relpath(full, root)))
    sc.addPyFile(out)
    sc._veldspar_shipped = True


def first_rows(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """Of the rows of each key the one with the lowest order value, with the given columns.

    Keys of one row, nearly all, stay where they are; only the rows of keys that come again are moved, and
    combined on the map side, so a key that is delivered again and again is no hot group. Where too
    many keys come again for a broadcast, all rows are combined so. Rows with a null key are dropped: they name
    no record. Ties of the order column are settled by the columns' own values.
    """
    rows = df.filter(F.col(key).isNotNull())
    again = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key), "again")
    if not is_small(again):
        return _lowest(rows, key, order, columns)
    once = rows.join(F.broadcast(again), key, "left_anti").select(key, *[F.col(c) for c in columns])
    return once.unionByName(_lowest(rows.join(F.broadcast(again), key, "left_semi"), key, order, columns))


def _lowest(rows: DataFrame, key: str, order: str, columns: tuple[str, ...]) -> DataFrame:
    picked = F.struct(F.col(order).alias("o"), *[F.col(c).alias(c) for c in columns])
    return rows.groupBy(F.col(key)).agg(F.min(picked).alias("r")).select(F.col(key), *[F.col(f"r.{c}").alias(c) for c in columns])


def only_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by order, with all columns; rows with a null key are dropped.

    As in first_rows(), keys of one row stay where they are. The rank of the others is cut on the map side. Of tied
    rows any one is kept.
    """
    rows = df.filter(F.col(key).isNotNull())
    again = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key), "again")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    if not is_small(again):
        return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    once = rows.join(F.broadcast(again), key, "left_anti")
    multi = rows.join(F.broadcast(again), key, "left_semi").withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return once.unionByName(multi)

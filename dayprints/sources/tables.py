"""Stored tables by name: over JDBC, or as Parquet folders.

A Parquet table is either appended to, or replaced as a whole by ``replace_table``. Each append
is a folder ``append=N`` below the table's own, each replacement a folder ``version=N``. Spark puts
``_SUCCESS`` into a folder when all of its files are in place, and readers take complete folders
only: all appends, or the newest version. So an append is whole or absent, whenever a task or the
driver dies, and the next one takes the place of a part that was left behind. A folder that was
written otherwise, without either, is read and appended to as it is. One job at a time writes a
table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from dayprints.session import cut_lineage


def _jdbc_options(options: dict) -> dict:
    """Connection options; user and password may come from the environment."""
    out = dict(options)
    for key, env in (("user", "DAYPRINTS_DB_USER"), ("password", "DAYPRINTS_DB_PASSWORD")):
        if key not in out and env in os.environ:
            out[key] = os.environ[env]
    return out


def _folder(name: str, options: dict) -> str:
    return f"{options['path'].rstrip('/')}/{name}"


def _numbered(spark: SparkSession, folder: str, kind: str) -> tuple[list[int], bool]:
    """Numbers of the complete folders of a kind, the first ones first; whether there are any."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    done = files.globStatus(path(f"{folder}/{kind}=*/_SUCCESS")) or []
    numbers = sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)
    return numbers, bool(files.globStatus(path(f"{folder}/{kind}=*")))


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, name: str, options: dict) -> DataFrame:
    """Read a stored table.

    With ``url`` in the options this is a JDBC read; give ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` for big tables so that it
    is not read by one task. Otherwise ``path`` is the folder of Parquet tables.
    """
    if "url" in options:
        return spark.read.format("jdbc").options(dbtable=name, **_jdbc_options(options)).load()
    folder = _folder(name, options)
    versions, replaced = _numbered(spark, folder, "version")
    if versions:
        return spark.read.parquet(f"{folder}/version={versions[-1]}")
    appends, appended = _numbered(spark, folder, "append")
    if appends:
        parts = [f"{folder}/append={n}" for n in appends]
        return spark.read.option("basePath", folder).parquet(*parts).drop("append")
    if replaced or appended:
        raise FileNotFoundError(f"the table {name} was never written to its end")
    return spark.read.parquet(folder)


def read_table_or_empty(spark: SparkSession, name: str, options: dict, schema) -> DataFrame:
    """Read a stored table; one that was never written, or never to its end, is empty.

    A database table that is absent is created, by appending no rows.
    """
    empty = spark.createDataFrame([], schema)
    if "url" in options:
        write_table(empty, name, options)
    try:
        return read_table(spark, name, options)
    except FileNotFoundError:
        return empty
    except AnalysisException as error:
        if not any(c in str(error) for c in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise
        return empty


def replace_table(df: DataFrame, name: str, options: dict) -> None:
    """Write the whole table anew; ``df`` may read the version it replaces.

    A run that dies leaves the version before in place, and its own part is overwritten
    by the next run. The version before is kept for readers that are still at it. A
    database table is overwritten as the driver does it, without versions.
    """
    if "url" in options:
        write_table(cut_lineage(df), name, options, "overwrite")
        return
    spark, folder = df.sparkSession, _folder(name, options)
    done, _ = _numbered(spark, folder, "version")
    df.write.mode("overwrite").parquet(f"{folder}/version={(done or [0])[-1] + 1}")
    for old in done[:-1]:
        _delete(spark, f"{folder}/version={old}")


def write_table(df: DataFrame, name: str, options: dict, mode: str = "append",
                partition_by: str | None = None) -> None:
    """Append to or overwrite a stored table, same options as ``read_table``.

    Over JDBC an append is as whole as the database's own transactions make it, per task.
    """
    if "url" in options:
        (df.write.format("jdbc").options(dbtable=name, **_jdbc_options(options))
         .mode(mode).save())
        return
    spark, folder = df.sparkSession, _folder(name, options)
    if mode == "overwrite":
        _delete(spark, folder)  # df must not read this table
    appends, _ = _numbered(spark, folder, "append")
    otherwise = not appends and _exists(spark, f"{folder}/_SUCCESS")
    if otherwise:  # a folder of files, not of appends
        path, mode = folder, "append"
    else:
        path, mode = f"{folder}/append={(appends or [-1])[-1] + 1}", "overwrite"
    if partition_by:
        # few files per folder; AQE splits what one value has too much of
        writer = df.hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by)
    else:
        writer = df.write.mode(mode)
    writer.parquet(path)
